"""Every operator of this subpackage bound to the driver's tables, with SQL where SQL can express it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from jobgrain.llm import blob_ledger, bpe, decontaminate, exact, html_text, lexical, pivot_index, quality, simhash, token_counts, url_lists, wavelet, whitening
from jobgrain.session import shared_path


def _read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def op1_wavelet_shards(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of all documents written to wavelet matrix shards in the shared folder and read back."""
    shards = shared_path(spark, "wavelet")
    wavelet.write_shards(_read(spark, folder, "documents"), shards, public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return wavelet.document_spans(spark, shards)


def op2_main_text(spark: SparkSession, folder: str) -> DataFrame:
    """Article text of every page."""
    return html_text.extract(_read(spark, folder, "pages"))


def dated_captures(pages: DataFrame) -> DataFrame:
    """The pages with a fetch date spread over one year by their id."""
    return pages.select("page_id", "url", F.date_add(F.lit("2024-01-01").cast("date"), F.pmod(F.col("page_id") * 7919, F.lit(366)).cast("int")).alias("fetched"))


def dated_entries(pages: DataFrame) -> DataFrame:
    """List entries drawn from the hosts, domains and first path segments of the pages by a hash of the value."""
    host, parts = url_lists.host_of(F.col("url")), url_lists.segments_of(F.col("url"))
    places = pages.select(host.alias("host"), F.try_element_at(parts, F.lit(1)).alias("top")).filter("host != ''").distinct()
    labels = F.split("host", r"\.")
    values = (
        places.select(F.lit("spam").alias("list"), F.lit("host").alias("kind"), F.col("host").alias("value"))
        .unionByName(places.select(F.lit("adult").alias("list"), F.lit("domain").alias("kind"), F.array_join(F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), 2), ".").alias("value")))
        .unionByName(places.filter("top is not null").select(F.lit("ads").alias("list"), F.lit("prefix").alias("kind"), F.concat_ws("/", "host", "top").alias("value")))
        .distinct()
    )
    mark = F.conv(F.substring(F.md5(F.concat_ws("|", "kind", "value").cast("binary")), 1, 4), 16, 10).cast("int")
    marked = values.withColumn("m", mark).filter("m % 3 < 2")
    start = F.lit("2024-01-01").cast("date")
    steps = F.array(
        F.struct(F.lit("add").alias("action"), F.date_add(start, F.col("m") % 200).alias("date")),
        F.struct(F.lit("remove").alias("action"), F.date_add(start, F.col("m") % 200 + F.floor(F.col("m") / 16).cast("int") % 120).alias("date")),
        F.struct(F.lit("add").alias("action"), F.date_add(start, F.lit(300) + F.col("m") % 50).alias("date")),
    )
    return marked.select("list", "kind", "value", F.explode(steps).alias("s")).select("list", "kind", "value", "s.*")


def op3_url_lists(spark: SparkSession, folder: str) -> DataFrame:
    """Every page judged by the list entries active when it was fetched."""
    pages = _read(spark, folder, "pages")
    return url_lists.judge(dated_captures(pages), dated_entries(pages))


def op4_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of every document under the byte-level vocabulary."""
    return token_counts.count_tokens(_read(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op5_simhash_groups(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    return simhash.near_duplicates(_read(spark, folder, "documents"))


def op6_benchmark_passages(spark: SparkSession, folder: str) -> DataFrame:
    """Benchmark windows in every document."""
    found = decontaminate.find_passages(_read(spark, folder, "documents"), _read(spark, folder, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated",
    )


def op7_quality_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Quality of every document by a network fitted on the labels outside the held-out part."""
    return quality.score(_read(spark, folder, "documents"), _read(spark, folder, "labels"))


def op8_bpe_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of every document and the text decoded from them, as digests."""
    return bpe.round_trip(_read(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op9_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets of every document, through a ledger in the shared folder that two scans bring up to date.

    The first scan knows the base rules only; the second finds their pairs in the ledger and adds those of the other rules.
    """
    docs, ledger = _read(spark, folder, "documents"), shared_path(spark, "ledger")
    blob_ledger.scan_new(blob_ledger.addressed(docs), ledger, blob_ledger.BASE_RULES)
    found = blob_ledger.scan_versions(docs, ledger)
    base = [rule.kind for rule in blob_ledger.BASE_RULES]
    own = F.filter("spans", lambda s: s["kind"].isin(base))

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select(
        F.col("path").alias("doc_id"), *map(count, base),
        F.sha2(blob_ledger.span_list(own).cast("binary"), 256).alias("base_sha256"),
        blob_ledger.span_list(F.col("spans")).alias("spans"),
    )


def op10_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Keeper and size of the group of equal texts of every document."""
    return exact.copy_groups(_read(spark, folder, "documents"))


def op11_similar_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """Links and component of every vector at a cosine of 0.9."""
    return pivot_index.similar_vectors(_read(spark, folder, "embeddings"))


def op12_lexical_ranks(spark: SparkSession, folder: str) -> DataFrame:
    """The 50 best documents of every benchmark item."""
    return lexical.rank(_read(spark, folder, "documents"), _read(spark, folder, "benchmark"))


def op13_whitened_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """The 16 leading whitened components of every vector."""
    return whitening.whiten(_read(spark, folder, "embeddings"))


def _span_sql() -> str:
    """Per rule: matches, the gaps between them, and positions as sums of their lengths."""
    parts = []
    for order, rule in enumerate(blob_ledger.RULES):
        pattern = rule.pattern.replace("'", "''")
        parts.append(f"""
            SELECT r, {order} AS ord, '{rule.kind}' AS kind, i,
                   list_sum(list_transform(gaps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(whole[1:i-1], lambda x: length(x))), 0) AS s,
                   length(whole[i]) AS w, length(val[i]) >= {rule.least} AS passes
            FROM (SELECT r, whole, val, gaps, unnest(range(1, len(whole) + 1)) AS i FROM (
                SELECT r, regexp_extract_all(t, '{pattern}', 0) AS whole, regexp_extract_all(t, '{pattern}', {rule.group}) AS val,
                       regexp_split_to_array(t, '{pattern}') AS gaps FROM d WHERE regexp_matches(t, '{pattern}')))""")
    return " UNION ALL ".join(parts)


ORACLE = {
    "op3_url_lists": rf"""
        WITH c AS (SELECT row_number() OVER () AS r, page_id, url, DATE '2024-01-01' + CAST((page_id * 7919) % 366 AS INT) AS fetched,
                          regexp_replace(lower(regexp_extract(url, '{url_lists.HOST}', 1)), '\.$', '') AS host,
                          list_filter(string_split(regexp_extract(url, '{url_lists.PATH}', 1), '/'), lambda s: s != '') AS seg FROM pages),
        p AS (SELECT DISTINCT host, seg[1] AS top, string_split(host, '.') AS labels FROM c WHERE host != ''),
        v AS (SELECT 'spam' AS list, 'host' AS kind, host AS value FROM p
              UNION SELECT 'adult', 'domain', array_to_string(labels[-2:], '.') FROM p
              UNION SELECT 'ads', 'prefix', host || '/' || top FROM p WHERE top IS NOT NULL),
        m AS (SELECT *, CAST('0x' || md5(kind || '|' || value)[1:4] AS INT) AS m FROM v),
        e AS (SELECT list, kind, value, 'add' AS action, DATE '2024-01-01' + m % 200 AS date FROM m WHERE m % 3 < 2
              UNION ALL SELECT list, kind, value, 'remove', DATE '2024-01-01' + (m % 200 + (m // 16) % 120) FROM m WHERE m % 3 < 2
              UNION ALL SELECT list, kind, value, 'add', DATE '2024-01-01' + (300 + m % 50) FROM m WHERE m % 3 < 2),
        k AS (SELECT c.r, list FROM c JOIN (SELECT DISTINCT list, kind, value FROM e) e ON
                  kind = 'host' AND value = host OR kind = 'domain' AND ('.' || host) LIKE '%.' || value
                  OR kind = 'prefix' AND value = host || '/' || seg[1]
              WHERE (SELECT arg_max(action, struct_pack(d := date, a := action)) FROM e x
                     WHERE x.list = e.list AND x.kind = e.kind AND x.value = e.value AND x.date <= c.fetched) = 'add')
        SELECT page_id, url, fetched, count(list) AS n_entries, coalesce(string_agg(DISTINCT list, ',' ORDER BY list), '') AS lists,
               count(list) > 0 AS blocked
        FROM c LEFT JOIN k USING (r) GROUP BY r, page_id, url, fetched""",
    "op9_secret_scan": f"""
        WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
        m AS ({_span_sql()}),
        g AS (SELECT r, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
                     count(*) FILTER (kind = 'hex') AS n_hex,
                     string_agg(kind || ':' || CAST(s AS BIGINT) || ':' || CAST(s + w AS BIGINT), ',' ORDER BY s, ord)
                         FILTER (ord < {len(blob_ledger.BASE_RULES)}) AS base,
                     string_agg(kind || ':' || CAST(s AS BIGINT) || ':' || CAST(s + w AS BIGINT), ',' ORDER BY s, ord) AS spans
              FROM m WHERE passes GROUP BY r)
        SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
               sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
        FROM d LEFT JOIN g USING (r)""",
    "op10_exact_dedup": r"""
        WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n, row_number() OVER () AS r,
                          sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256 FROM documents)
        SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
               row_number() OVER w = 1 AS kept, text_sha256
        FROM d WINDOW w AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id, r)""",
    "op11_similar_vectors": """
        WITH RECURSIVE v AS MATERIALIZED (
            SELECT row_number() OVER () AS r, vec_id, CASE WHEN list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
                   AND list_bool_or(list_transform(embedding, lambda x: x != 0)) THEN CAST(embedding AS DOUBLE[]) END AS e FROM embeddings),
        l AS MATERIALIZED (SELECT a.r, b.r AS s FROM v a JOIN v b ON a.r != b.r AND len(a.e) = len(b.e)
                           WHERE CASE WHEN len(a.e) = len(b.e) THEN list_cosine_similarity(a.e, b.e) >= 0.9 END),
        c(r, s) AS (SELECT r, r FROM v UNION SELECT c.r, l.s FROM c JOIN l ON c.s = l.r),
        m AS (SELECT c.r, min(v.vec_id) AS component_id FROM c JOIN v ON c.s = v.r GROUP BY c.r),
        n AS (SELECT r, count(*) AS n_links FROM l GROUP BY r)
        SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id IS NOT DISTINCT FROM component_id AS kept
        FROM v JOIN m USING (r) LEFT JOIN n USING (r)""",
    "op12_lexical_ranks": r"""
        WITH t AS MATERIALIZED (SELECT r, unnest(regexp_extract_all(x, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM (
                 SELECT row_number() OVER () AS r, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS x FROM documents)),
        q AS MATERIALIZED (SELECT DISTINCT q, unnest(regexp_extract_all(x, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM (
                 SELECT row_number() OVER () AS q, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS x FROM benchmark)),
        n AS (SELECT r, count(*) AS n FROM t GROUP BY r), s AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS len FROM n),
        f AS (SELECT r, term, count(*) AS tf FROM t WHERE term IN (SELECT term FROM q) GROUP BY r, term),
        w AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM f, s GROUP BY term, docs),
        i AS (SELECT r, term, w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // len))) AS score FROM f JOIN n USING (r) JOIN w USING (term), s),
        g AS (SELECT q, r, CAST(sum(score) AS BIGINT) AS score FROM q JOIN i USING (term) GROUP BY q, r HAVING sum(score) > 0),
        k AS (SELECT q, d.doc_id, score, CAST(row_number() OVER (PARTITION BY q ORDER BY score DESC, d.doc_id NULLS LAST) AS INT) AS rank
              FROM g JOIN (SELECT row_number() OVER () AS r, doc_id FROM documents) d USING (r))
        SELECT item_id, rank, doc_id, score FROM k JOIN (SELECT row_number() OVER () AS q, item_id FROM benchmark) USING (q) WHERE rank <= 50""",
}

QUERIES = {"op1_wavelet_shards": op1_wavelet_shards, "op2_main_text": op2_main_text, "op3_url_lists": op3_url_lists, "op4_token_counts": op4_token_counts, "op5_simhash_groups": op5_simhash_groups, "op6_benchmark_passages": op6_benchmark_passages,
    "op7_quality_scores": op7_quality_scores, "op8_bpe_round_trip": op8_bpe_round_trip, "op9_secret_scan": op9_secret_scan, "op10_exact_dedup": op10_exact_dedup,
    "op11_similar_vectors": op11_similar_vectors, "op12_lexical_ranks": op12_lexical_ranks, "op13_whitened_vectors": op13_whitened_vectors}
