"""A compact set of strings that says "no" for sure and "yes" with few mistakes, for rows that need not reach a join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: Bits for each distinct key, and most bits in all: one value of at most 2 MB, however many keys there are.
BITS_PER_KEY, MOST_BITS = 16, 1 << 24


class KeyFilter:
    """Four bits a key in one array, which Spark hands to the tasks as a single value.

    Beyond ``MOST_BITS`` / ``BITS_PER_KEY`` keys the array stops growing and more strangers pass; no key is ever lost.
    """

    def __init__(self, keys: DataFrame, column: str, most_bits: int = MOST_BITS):
        held = keys.select(F.col(column).alias("k")).filter(F.col("k").isNotNull()).distinct()
        wanted = min(max(held.count() * BITS_PER_KEY, 64), most_bits)
        self.bits = 1 << (wanted - 1).bit_length()
        words = self.bits // 64
        one = F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.col("at") % 64).cast("int"))
        set_bits = held.select(F.explode(F.array(*self._places(F.col("k")))).alias("at")).select(
            F.floor(F.col("at") / 64).alias("word"), one.alias("b")
        )
        zeros = keys.sparkSession.range(words).select(F.col("id").alias("word"), F.lit(0).cast("bigint").alias("b"))
        table = set_bits.unionByName(zeros).groupBy("word").agg(F.bit_or("b").alias("b"))
        in_order = F.array_sort(F.collect_list(F.struct("word", "b")))
        self._array = table.agg(F.transform(in_order, lambda s: s["b"]).alias("bits"))

    def _places(self, value: Column) -> list[Column]:
        mask = F.lit(self.bits - 1).cast("bigint")
        hashes = (F.xxhash64(value), F.xxhash64(value, F.lit(1)))
        return [F.shiftrightunsigned(h, n).bitwiseAND(mask) for h in hashes for n in (0, 32)]

    def may_hold(self, value: Column) -> Column:
        """False only if ``value`` is no key; null is no key."""
        array = self._array.scalar()
        held = F.lit(True)
        for at in self._places(value):
            word = F.element_at(array, F.floor(at / 64).cast("int") + 1)
            held = held & (F.getbit(word, (at % 64).cast("int")) == 1)
        return value.isNotNull() & held
