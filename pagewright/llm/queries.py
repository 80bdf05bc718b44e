"""The queries of the training-data operators: each takes (spark, sf_dir)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bpe_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import bpe

    return bpe.round_trip(table(spark, sf_dir, "documents"), bpe_vocabulary())


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import quality

    return quality.scored(table(spark, sf_dir, "documents"))


def op2_linededup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import linededup

    return linededup.deduplicated(table(spark, sf_dir, "documents"))


def op3_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import langid

    return langid.identified(table(spark, sf_dir, "documents"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import warc

    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return warc.archived(table(spark, sf_dir, "pages")).select(*columns)


def op5_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from . import topk

    vectors = table(spark, sf_dir, "embeddings").select("vec_id", topk.quantised(F.col("embedding")).alias("v"))
    return topk.search(vectors, F.col("vec_id") % 50 == 0, 5)


def op7_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import neardup

    return neardup.classes(table(spark, sf_dir, "documents"))


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import licenses

    return licenses.scan(table(spark, sf_dir, "documents"))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import decontaminate

    return decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import html

    return html.extract(table(spark, sf_dir, "pages"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality": op1_quality,
    "op2_linededup": op2_linededup,
    "op3_langid": op3_langid,
    "op4_warc": op4_warc,
    "op5_topk": op5_topk,
    "op6_bpe": op6_bpe,
    "op7_neardup": op7_neardup,
    "op8_licenses": op8_licenses,
    "op9_decontaminate": op9_decontaminate,
    "op10_html": op10_html,
}

ORACLES: dict[str, str] = {
    "op2_linededup": r"""
WITH l AS (
    SELECT doc_id, text AS whole, generate_subscripts(string_split(text, chr(10)), 1) AS line, unnest(string_split(text, chr(10))) AS value
    FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL
), t AS (
    SELECT *, list_sort(list_distinct(list_filter(string_split(lower(value), ' '), lambda x: x <> ''))) AS s FROM l
), c AS (SELECT s, min((doc_id, line)) AS first, row_number() OVER (ORDER BY s) AS id FROM t WHERE len(s) > 0 GROUP BY s),
e AS (SELECT id, len(s) AS n, unnest(s) AS tok FROM c WHERE len(s) >= 4),
f AS (SELECT tok, count(*) AS df FROM e GROUP BY tok),
r AS (SELECT id, n, tok, row_number() OVER (PARTITION BY id ORDER BY df, tok) AS i FROM e JOIN f USING (tok)),
p AS (SELECT * FROM r WHERE i <= n - (4 * n + 4) // 5 + 1),
k AS (SELECT DISTINCT a.id AS x, b.id AS y FROM p a JOIN p b ON a.tok = b.tok AND a.id <> b.id AND 5 * a.n >= 4 * b.n AND 5 * b.n >= 4 * a.n),
g AS (
    SELECT DISTINCT x FROM k JOIN c a ON a.id = x JOIN c b ON b.id = y
    WHERE b.first < a.first AND 9 * len(list_intersect(a.s, b.s)) >= 4 * (len(a.s) + len(b.s))
), m AS (
    SELECT t.doc_id, t.whole, t.line, t.value, c.id IS NOT NULL AND (c.first < (t.doc_id, t.line)) AS again, c.id IN (SELECT x FROM g) AS sim
    FROM t LEFT JOIN c ON t.s = c.s
), o AS (
    SELECT doc_id, whole, count(*) AS n_lines, count(*) FILTER (again OR sim) AS n_removed, count(*) FILTER (again) AS n_repeats,
        coalesce(string_agg(value, chr(10) ORDER BY line) FILTER (NOT coalesce(again OR sim, FALSE)), '') AS text
    FROM m GROUP BY doc_id, whole
)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(o.text, d.text) END AS text,
    coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed, coalesce(n_repeats, 0) AS n_repeats
FROM documents d LEFT JOIN o ON d.doc_id = o.doc_id AND d.text = o.whole""",
    "op4_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
h AS (SELECT page_id, strlen(html) AS n, sha1(html) AS x FROM p),
v AS (SELECT page_id, n, x, list_transform(range(8), lambda k: CAST('0x' || substr(x, CAST(5 * k + 1 AS INTEGER), 5) AS BIGINT)) AS parts FROM h),
d AS (
    SELECT page_id, n, array_to_string(flatten(list_transform(parts, lambda b:
        list_transform([15, 10, 5, 0], lambda s: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((b >> s) & 31 AS INTEGER) + 1, 1)))), '') AS digest
    FROM v
), m AS (SELECT *, max(page_id) OVER (PARTITION BY digest) AS top FROM d)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest, CASE WHEN page_id IS DISTINCT FROM top THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN page_id IS DISTINCT FROM top THEN top END AS refers_to
FROM m""",
    "op5_topk": """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS e FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5""",
}
