"""Skill extraction by phrases: text to set of canonical skills."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from jobgrain.functions.arrays import unfold
from jobgrain.functions.membership import KeyFilter
from jobgrain.functions.text import TOKEN, pieces, tokens
from jobgrain.session import materialise
from jobgrain.sources.lexicon import phrase_keys

# Up to this many phrases the lexicon travels inside the expression; beyond it the match is a join.
INLINE_PHRASES = 2_000
TOP_FLAGS = 50


def _literal(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values]) if values else F.array().cast("array<string>")


def skills_of_tokens(words: Column, phrases: list[tuple[str, str]]) -> Column:
    """Sorted set of skills whose phrase occurs in the token array, overlaps included.

    Single tokens are found by one set intersection. A longer phrase is looked for in the joined text only when its
    first token occurs, so the cost per row hardly depends on the lexicon.
    """
    by_key: dict[str, list[str]] = {}
    for skill, key in phrases:
        by_key.setdefault(key, []).append(skill)
    single = sorted(k for k in by_key if " " not in k)
    longer = sorted(k for k in by_key if " " in k)
    found = F.array_intersect(words, _literal(single))
    if longer:
        starts = F.array_intersect(words, _literal(sorted({k.split(" ")[0] for k in longer})))
        joined = F.concat(F.lit(" "), F.array_join(words, " "), F.lit(" "))
        candidates = F.array(
            *[F.struct(F.lit(k).alias("key"), F.lit(f" {k} ").alias("padded"), F.lit(k.split(" ")[0]).alias("first"))
              for k in longer]
        )
        probe = F.struct(starts.alias("starts"), joined.alias("joined"))
        # The probe is bound once per row by a one-element transform, so neither part is evaluated per phrase.
        multi = F.flatten(
            F.transform(
                F.array(probe),
                lambda p: F.transform(
                    F.filter(
                        candidates,
                        lambda c: F.array_contains(p["starts"], c["first"]) & p["joined"].contains(c["padded"]),
                    ),
                    lambda c: c["key"],
                ),
            )
        )
        found = F.concat(found, F.when(F.size(starts) > 0, multi).otherwise(_literal([])))
    names = F.create_map(*[x for k in sorted(by_key) for x in (F.lit(k), _literal(sorted(set(by_key[k]))))])
    skills = F.flatten(F.transform(found, lambda k: names[k]))
    return F.array_sort(F.array_distinct(skills))


def extract_phrases(df: DataFrame, lexicon: DataFrame, text_column: str = "description_clean", id_column: str = "job_id",
                    inline_phrases: int = INLINE_PHRASES) -> DataFrame:
    """Add ``skills``, a sorted array, empty for null text. Raises on an unknown column.

    A lexicon of ordinary size is inlined and the step is a map over the rows: no join, no shuffle, no skew. A very
    large one takes ``match_phrases`` and one shuffle of its hits by row; rows and column order are the same.
    """
    keys = phrase_keys(lexicon).select("skill", "phrase_key")
    phrases = [tuple(r) for r in keys.limit(inline_phrases + 1).collect()]
    if len(phrases) <= inline_phrases:
        words = F.coalesce(tokens(F.col(text_column)), _literal([]))
        # Tokens get a column of their own so that the expression is evaluated once per row.
        return (
            df.withColumn("_words", words)
            .withColumn("skills", skills_of_tokens(F.col("_words"), phrases) if phrases else _literal([]))
            .drop("_words")
        )
    # A number of its own keeps rows apart whose ids repeat or are null; written, it is the same in both branches.
    numbered = materialise(df.withColumn("_row", F.monotonically_increasing_id()), "numbered")
    found = (
        match_phrases(numbered, lexicon, text_column, "_row")
        .groupBy("_row")
        .agg(F.array_sort(F.collect_set("skill")).alias("skills"))
    )
    return numbered.join(found, "_row", "left").select(*df.columns, F.coalesce("skills", _literal([])).alias("skills"))


def phrase_probes(df: DataFrame, keys: DataFrame, text_column: str, id_column: str) -> DataFrame:
    """Places where a phrase may begin: (id, position, prefix, following), one row for each prefix that may be one.

    A prefix is the first two tokens of a phrase, or its only one. A place costs one lookup of its token among the first
    tokens; where that passes, a second ``KeyFilter`` is asked for the prefixes, so a frequent token that begins some
    phrase does not bring all its places along. Both stand in the task that unfolds the places.
    """
    longest = keys.agg(F.max("n_tokens")).first()[0] or 1
    words, at = F.col("_words"), F.col("position")
    first = KeyFilter(keys.withColumn("_first", F.substring_index("prefix", " ", 1)), "_first")
    known = KeyFilter(keys, "prefix")
    following = F.slice(words, at + 1, F.lit(longest))
    pair = F.concat_ws(" ", "_w0", F.get(words, at + 1)) if longest > 1 else F.lit(None).cast("string")
    has_next = at + 1 < F.size(words)
    # The array of tokens stays beside its unfolded items: what follows a place is only read where the place passes.
    return (
        df.select(id_column, F.coalesce(tokens(F.col(text_column)), _literal([])).alias("_words"))
        .select(id_column, "_words", F.posexplode_outer("_words").alias("position", "_w0"))
        .filter(first.may_hold(F.col("_w0")))
        .select(
            id_column, "position", following.alias("following"),
            F.explode(
                F.array(F.when(known.may_hold(F.col("_w0")), F.col("_w0")), F.when(has_next & known.may_hold(pair), pair))
            ).alias("prefix"),
        )
        .filter(F.col("prefix").isNotNull())
    )


def match_phrases(df: DataFrame, lexicon: DataFrame, text_column: str, id_column: str) -> DataFrame:
    """Every phrase occurrence as (id, position, n_tokens, skill, phrase_key); position counts tokens from 0.

    The places of ``phrase_probes`` join the lexicon on the prefix. Spark measures the lexicon in bytes at run time: it
    is broadcast below the session's threshold, and beyond it shuffled by prefix, where skewed ones are split.
    """
    keys = phrase_keys(lexicon).withColumn("prefix", F.substring_index("phrase_key", " ", 2))
    same = F.array_join(F.slice("following", F.lit(1), F.col("n_tokens")), " ") == F.col("phrase_key")
    return (
        phrase_probes(df, keys, text_column, id_column)
        .join(keys, "prefix")
        .filter((F.col("n_tokens") <= 2) | same)
        .select(id_column, "position", "n_tokens", "skill", "phrase_key")
    )


def phrase_offsets(df: DataFrame, lexicon: DataFrame, text_column: str, id_column: str,
                   inline_phrases: int = INLINE_PHRASES) -> DataFrame:
    """Phrase occurrences with character offsets: (id, start, end, skill, surface), end exclusive."""
    listed = _listed(df.select(id_column, text_column), lexicon, text_column, inline_phrases, "inner")
    return listed.select(id_column, F.inline_outer("_found")).filter(F.col("start").isNotNull())


def phrase_lists(df: DataFrame, lexicon: DataFrame, text_column: str, name: str = "hits",
                 inline_phrases: int = INLINE_PHRASES) -> DataFrame:
    """The same beside each row: ``df`` with an array of (start, end, skill, surface), empty where nothing is found.

    For what is done with the spans and their text together: neither has to be brought back to the other by a join.
    Unfold them with ``inline_outer``: a plain ``inline`` adds a filter below, which finds all spans a second time.
    """
    listed = _listed(df, lexicon, text_column, inline_phrases, "left")
    none = F.array().cast("array<struct<start:bigint,end:bigint,skill:string,surface:string>>")
    return listed.select(*[F.col(f"`{c}`") for c in df.columns], F.coalesce("_found", none).alias(name))


def _listed(df: DataFrame, lexicon: DataFrame, text_column: str, inline_phrases: int, how: str) -> DataFrame:
    """``df`` with the array ``_found``.

    With a lexicon of ordinary size everything happens in the row of the text: no join and no shuffle. Above
    ``inline_phrases`` the token join of ``match_phrases`` finds the hits, whatever the size of the lexicon, and they
    come back to their text once for their offsets.
    """
    keys = phrase_keys(lexicon).select("skill", "phrase_key")
    phrases = [tuple(r) for r in keys.limit(inline_phrases + 1).collect()]
    if len(phrases) <= inline_phrases:
        return _found_in_row(df, phrases, text_column)
    numbered = materialise(df.withColumn("_row", F.monotonically_increasing_id()), "numbered")
    hits = match_phrases(numbered, lexicon, text_column, "_row")
    own = hits.groupBy("_row").agg(F.collect_list(F.struct("position", "n_tokens", "skill")).alias("_hits"))
    found = F.transform("_hits", lambda h: _hit(h["position"] + 1, h["n_tokens"], h["skill"]))
    return _measured(numbered.join(own, "_row", how), text_column).withColumn("_found", found)


_BLOCK = 64


def _total(lengths: Column) -> Column:
    return F.aggregate(lengths, F.lit(0).cast("bigint"), lambda acc, n: acc + n)


def _running(values: Column) -> Column:
    """What lies before each value: 0, the first, the first two and so on."""
    start = F.struct(F.lit(0).cast("bigint").alias("total"), F.array().cast("array<bigint>").alias("before"))
    return F.aggregate(
        values,
        start,
        lambda acc, n: F.struct((acc["total"] + n).alias("total"), F.array_append(acc["before"], acc["total"]).alias("before")),
        lambda acc: acc["before"],
    )


def _blocks(values: Column | str, size: Column) -> Column:
    """Sums of the values by blocks; at least one."""
    return F.transform(
        F.sequence(F.lit(0), F.greatest(F.floor((size - 1) / _BLOCK).cast("int"), F.lit(0))),
        lambda b: _total(F.slice(values, b * _BLOCK + 1, F.lit(_BLOCK))),
    )


def _with_starts(df: DataFrame) -> DataFrame:
    """``_starts``: what lies before each of ``_lengths``, by blocks and blocks of blocks, so in time linear in their number."""
    part = lambda values, b: F.slice(values, b * _BLOCK + 1, F.lit(_BLOCK))
    return (
        df.withColumn("_sums", _blocks("_lengths", F.size("_lengths")))
        .withColumn("_far", _running(_blocks("_sums", F.size("_sums"))))
        .withColumn("_near", F.flatten(F.transform("_far", lambda far, b: F.transform(_running(part("_sums", b)), lambda n: n + far))))
        .withColumn(
            "_starts",
            F.flatten(F.transform("_near", lambda near, b: F.transform(_running(part("_lengths", b)), lambda n: n + near))),
        )
    )


def _measured(df: DataFrame, text_column: str) -> DataFrame:
    """Tokens as written, the gaps before them, and what lies before each of them and its gap."""
    text = F.col(text_column)
    return _with_starts(
        df.withColumn("_written", F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0)))
        # One gap more than tokens: the last one follows the last token and is not needed.
        .withColumn("_gaps", F.slice(F.split(text, TOKEN), F.lit(1), F.size("_written")))
        .withColumn("_lengths", F.zip_with("_written", "_gaps", lambda w, g: F.length(g) + F.length(w)))
    )


def _span(start: Column, skill: Column, surface: Column) -> Column:
    return F.struct(
        start.alias("start"), (start + F.length(surface)).alias("end"), skill.alias("skill"), surface.alias("surface")
    )


def _hit(i: Column, n_tokens: Column, skill: Column) -> Column:
    """Span of ``n_tokens`` tokens from the ``i``-th (from 1)."""
    # The text of a phrase is put together from its tokens and the gaps between them.
    rest = F.zip_with(
        F.slice("_gaps", i + 1, n_tokens - 1), F.slice("_written", i + 1, n_tokens - 1), lambda g, w: F.concat(g, w)
    )
    surface = F.concat(F.element_at("_written", i), F.when(n_tokens == 1, "").otherwise(F.array_join(rest, "")))
    return _span(F.element_at("_starts", i) + F.length(F.element_at("_gaps", i)), skill, surface)


def _found_in_row(df: DataFrame, phrases: list[tuple[str, str]], text_column: str) -> DataFrame:
    """The text is cut before the places where a phrase may begin; only these are compared with the lexicon.

    So what follows the one pass over the text costs by candidate places, not by tokens. Places are found whatever the
    case, a few too many; the comparison takes the lower case of the tokens there, offsets the text as written.
    """
    by_first: dict[str, list[Column]] = {}
    for skill, key in sorted(phrases):
        phrase = F.struct(F.lit(skill).alias("skill"), F.lit(key).alias("key"), F.lit(key.count(" ") + 1).alias("n"))
        by_first.setdefault(key.split(" ")[0], []).append(phrase)
    none = F.array().cast("array<struct<skill:string,key:string,n:int>>")
    lexicon = F.create_map(*[x for first, held in by_first.items() for x in (F.lit(first), F.array(*held))])
    longest = max((k.count(" ") + 1 for _, k in phrases), default=1)
    every = lambda pattern, text: F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    front = rf"^(?:{TOKEN}\s*+){{1,{longest}}}+"

    def hit(i: Column, n: Column, skill: Column) -> Column:
        written = F.get("_written", i)
        # Tokens with the gaps after them, but for the last.
        before = F.array_join(F.slice(every(rf"{TOKEN}\s*+", F.get("_fronts", i)), F.lit(1), n - 1), "")
        surface = F.when(n == 1, F.get(written, F.lit(0))).otherwise(F.concat(before, F.element_at(written, n)))
        return _span(F.get("_starts", i), skill, surface)

    source = (
        df.withColumn("_pieces", F.coalesce(pieces(F.col(text_column), [k for _, k in phrases]), _literal([])))
        .withColumn("_lengths", F.transform("_pieces", lambda p: F.length(p)))
        # Each piece has a token at least, but a blank first one.
        .withColumn(
            "_fronts",
            F.transform(
                "_pieces", lambda p, i: F.regexp_extract(F.array_join(F.slice("_pieces", i + 1, F.lit(longest)), ""), front, 0)
            ),
        )
        .withColumn("_written", F.transform("_fronts", lambda f: every(TOKEN, f)))
        .withColumn("_words", F.transform("_written", lambda ws: F.transform(ws, lambda w: F.lower(w))))
    )
    found = F.transform(
        "_words",
        lambda ws, i: F.transform(
            F.filter(
                F.coalesce(F.try_element_at(lexicon, F.get(ws, F.lit(0))), none) if phrases else none,
                lambda c: (c["n"] == 1) | (F.array_join(F.slice(ws, F.lit(1), c["n"]), " ") == c["key"]),
            ),
            lambda c: hit(i, c["n"], c["skill"]),
        ),
    )
    return _with_starts(source).withColumn("_found", F.flatten(found))


def union_skills(first: DataFrame, second: DataFrame, id_column: str = "job_id") -> DataFrame:
    """Distinct (id, skill) of two extractors."""
    return first.select(id_column, "skill").unionByName(second.select(id_column, "skill")).distinct()


def attach_skills(df: DataFrame, found: DataFrame, id_column: str = "job_id") -> DataFrame:
    """Join (id, skill) rows back as the ``skills`` array; rows without any keep an empty one."""
    sets = found.groupBy(id_column).agg(F.array_sort(F.collect_set("skill")).alias("skills"))
    return df.join(sets, id_column, "left").withColumn("skills", F.coalesce("skills", _literal([])))


def add_skill_columns(df: DataFrame) -> DataFrame:
    """``extracted_skills`` as a sorted ``;`` list and ``num_skills`` from the ``skills`` array."""
    return df.withColumns(
        {"extracted_skills": F.array_join(F.array_sort("skills"), ";"), "num_skills": F.size("skills")}
    )


def top_skills(df: DataFrame, top_n: int = TOP_FLAGS) -> DataFrame:
    """Skills by number of postings, ties by name."""
    return (
        unfold(df, "skills", "skill")
        .groupBy("skill")
        .agg(F.count("*").alias("count"))
        .orderBy(F.desc("count"), "skill")
        .limit(top_n)
    )


def flag_name(skill: str) -> str:
    return "has_" + skill.replace(" ", "_").replace("-", "_").lower()


def add_skill_flags(df: DataFrame, top_n: int = TOP_FLAGS) -> DataFrame:
    """One boolean column per skill of the overall top list; at most ``top_n`` names reach the driver."""
    names = [r["skill"] for r in top_skills(df, top_n).collect()]
    return df.withColumns({flag_name(n): F.array_contains("skills", n) for n in names})


def skill_statistics(df: DataFrame) -> DataFrame:
    """One row: postings, postings with skills, mean, median, maximum and distinct skills."""
    # One pass: a posting yields its skills and its number of skills; the rest is arithmetic on these few counts.
    size = F.struct(F.lit(None).cast("string").alias("skill"), F.size("skills").alias("size"))
    items = F.transform("skills", lambda s: F.struct(s.alias("skill"), F.lit(None).cast("int").alias("size")))
    counts = (
        df.select(F.explode_outer(F.array_append(items, size)).alias("item"))
        .groupBy("item.skill", "item.size")
        .agg(F.count("*").alias("n"))
    )
    n = F.when(F.col("size").isNotNull(), F.col("n"))
    return counts.agg(
        F.coalesce(F.sum(n), F.lit(0)).alias("total_jobs"),
        F.coalesce(F.sum(F.when(F.col("size") > 0, n)), F.lit(0)).alias("jobs_with_skills"),
        F.try_divide(F.sum(F.col("size") * n), F.sum(n)).alias("avg_skills_per_job"),
        F.percentile("size", F.lit(0.5), F.coalesce(n, F.lit(0))).alias("median_skills_per_job"),
        F.max("size").alias("max_skills_per_job"),
        F.count("skill").alias("total_unique_skills"),
    )


def skills_by_category(df: DataFrame, lexicon: DataFrame) -> DataFrame:
    """Mentions and distinct skills per category and subcategory, with subtotals (null subcategory) and the total.

    Postings are counted per skill first, so the join and the rollup see one row per skill.
    """
    per_skill = unfold(df, "skills", "skill").groupBy("skill").agg(F.count("*").alias("mentions"))
    names = lexicon.select(F.trim(F.lower("skill_name")).alias("skill"), "category", "subcategory").distinct()
    return (
        per_skill.join(names, "skill")
        .rollup("category", "subcategory")
        .agg(F.sum("mentions").alias("mentions"), F.count_distinct("skill").alias("skills"))
    )
