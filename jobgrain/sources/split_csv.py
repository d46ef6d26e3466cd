"""CSV with line breaks inside quotes, many tasks a file.

Lines are read as ordinary text, so a file is split like any other. Whether a split begins inside a quoted field depends
on all before it, so a first pass carries both answers through each split; a split maps the state before it to the state
after it, and the maps compose in file order by window functions over one row per split. A second pass starts each split
in its true state. Records that cross a border are cut in pieces: those few pieces (at most two a split) are put
together by file order, all other records never leave their task. Spark's own CSV parser reads the records.

Line breaks are line feeds, with or without a carriage return before them; in a file whose first line has the return,
those inside quotes become plain line feeds, as Spark's reader has it. Quotes are doubled inside quotes, and a quote
opens a field only as its first character. What travels to every task is two numbers for each split that begins inside
quotes, and one for each file with returns.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from jobgrain.session import materialise

#: Place of a record: its file, the start of the split it begins in, and its number among the records and pieces of that split.
PLACE = ["_file", "_block", "_position"]

_CLOSING = re.compile(r'[^"]*(?:""[^"]*)*"(?!")')
_WHOLE, _BEGIN, _END, _MIDDLE = range(4)


def inside_after(line: str, inside: bool) -> bool:
    """Whether the end of a line lies inside quotes, given whether its start does."""
    if '"' not in line:
        return inside
    at = 0
    while True:
        if inside:
            found = _CLOSING.match(line, at)
            if not found:
                return True
            at, inside = found.end(), False
        elif line.startswith('"', at):
            at, inside = at + 1, True
            continue
        at = line.find(",", at) + 1
        if not at:
            return False


def _lines(spark: SparkSession, path: str) -> DataFrame:
    text = spark.read.option("lineSep", "\n").text(path)
    file = F.col("_metadata.file_path")
    return text.select("value", file.alias("file"), F.xxhash64(file).alias("mark"), F.col("_metadata.file_block_start").alias("block"))


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, int, str]]:
    """``file, mark, block, line`` of every line; a split's lines follow each other."""
    for batch in batches:
        lines, files = batch.column(0).to_pylist(), batch.column(1).dictionary_encode()
        names, codes = files.dictionary.to_pylist(), files.indices.to_pylist()
        yield from zip((names[c] for c in codes), batch.column(2).to_pylist(), batch.column(3).to_pylist(), lines)


def split_starts(lines: DataFrame) -> DataFrame:
    """``file, mark, block, inside, first``: the state in which each split begins, and the first line of a file."""

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, states, first, out = None, [False, True], None, []
        for file, mark, block, line in _runs(batches):
            if place != (file, mark, block):
                if place:
                    out.append((*place, *states, first))
                place, states, first = (file, mark, block), [False, True], line if block == 0 else None
            if '"' in line:
                states = [inside_after(line, s) for s in states]
        if place:
            out.append((*place, *states, first))
        names = ["file", "mark", "block", "plain", "quoted", "first"]
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], kind) for i, kind in enumerate(kinds)], names)

    maps = lines.mapInArrow(mapped, "file string, mark long, block long, plain boolean, quoted boolean, first string")
    order = Window.partitionBy("file").orderBy("block")
    before, upto = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(Window.unboundedPreceding, 0)
    fixed = F.col("plain") == F.col("quoted")  # the state after such a split does not depend on the one before
    turns = (~fixed & F.col("plain")).cast("int")  # and such a split turns it over
    counted = maps.withColumn("turns", F.sum(turns).over(upto)).withColumn("fixed", F.when(fixed, F.col("plain").cast("int")))
    since = F.last(F.when(F.col("fixed").isNotNull(), F.struct(F.col("fixed").alias("state"), "turns")), True).over(before)
    known = counted.withColumn("since", since).withColumn("passed", F.coalesce(F.lag("turns").over(order), F.lit(0)))
    state = F.coalesce(F.col("since.state"), F.lit(0)) + F.col("passed") - F.coalesce(F.col("since.turns"), F.lit(0))
    return known.select("file", "mark", "block", (state % 2 == 1).alias("inside"), "first")


def _records(lines: DataFrame, inside: set[tuple[int, int]], returns: set[int], pieces: bool) -> DataFrame:
    """``_file, _block, _position, kind, record``: the whole records of every split, or the pieces at its ends."""
    known = lines.sparkSession.sparkContext.broadcast((inside, returns))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        quoted, paired = known.value
        place, position, held, state, begun = None, 0, [], False, True

        def close() -> None:
            if place and held:
                out.append((place[0], place[2], position, _BEGIN if begun else _MIDDLE, "\n".join(held)))

        def batch() -> pa.RecordBatch:
            kept = [r for r in out if (r[3] != _WHOLE) == pieces]
            out.clear()
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in kept], kind) for i, kind in enumerate(kinds)], [*PLACE, "kind", "record"])

        for file, mark, block, line in _runs(batches):
            if place != (file, mark, block):
                close()
                place, position, held = (file, mark, block), 0, []
                state = (mark, block) in quoted
                begun = not state
            state = inside_after(line, state)
            held.append(line.removesuffix("\r") if mark in paired else line)
            if not state:
                out.append((file, block, position, _WHOLE if begun else _END, "\n".join(held).removesuffix("\r")))
                position, held, begun = position + 1, [], True
                if len(out) >= 4096:
                    yield batch()
        close()
        yield batch()

    return lines.mapInArrow(cut, "_file string, _block long, _position long, kind int, record string")


def _joined(pieces: DataFrame) -> DataFrame:
    """Records put together from their pieces, placed where they begin. A file that ends inside quotes leaves its last one open."""
    order = Window.partitionBy("_file").orderBy("_block", "_position")
    numbered = pieces.withColumn("number", F.sum((F.col("kind") == _BEGIN).cast("int")).over(order))
    parts = F.array_sort(F.collect_list(F.struct("_block", "_position", "record")))
    whole = numbered.groupBy("_file", "number").agg(parts.alias("parts"))
    return whole.select(
        "_file", F.col("parts")[0]["_block"].alias("_block"), F.col("parts")[0]["_position"].alias("_position"),
        F.array_join("parts.record", "\n").alias("record"),
    )


def read_split(spark: SparkSession, path: str, options: dict[str, str]) -> DataFrame:
    """All columns as text, by the header that every file must share, and the place of each record in ``PLACE``."""
    schema = spark.read.options(**options).csv(path).schema
    lines = _lines(spark, path)
    starts = materialise(split_starts(lines), "splits")
    firsts = [r[0].removeprefix("\ufeff").removesuffix("\r") for r in starts.select("first").dropna().distinct().collect()]
    headers = {tuple(next(csv.reader([line]), ())) for line in firsts}
    if len(headers) > 1:
        raise ValueError(f"files with different headers: {sorted(headers)[:2]}")
    inside = {(r["mark"], r["block"]) for r in starts.filter("inside").select("mark", "block").collect()}
    returns = {r["mark"] for r in starts.filter(F.col("first").endswith("\r")).select("mark").collect()}
    pieces = materialise(_records(lines, inside, returns, True), "pieces")
    records = _records(lines, inside, returns, False).select(*PLACE, "record").unionByName(_joined(pieces))
    body = records.filter((F.col("record") != "") & ~((F.col("_block") == 0) & (F.col("_position") == 0)))
    kept = {k: v for k, v in options.items() if k not in ("header", "enforceSchema")}
    parsed = body.select(*PLACE, F.from_csv("record", _ddl(schema), kept).alias("row"))
    return parsed.select(*[F.col("row").getField(name).alias(name) for name in schema.names], *PLACE)


def _ddl(schema) -> str:
    return ", ".join("`" + name.replace("`", "``") + "` STRING" for name in schema.names)
