"""Page and document quality: buckets, scores, elements, findings, and a checker pipeline."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import rating
from .tables import LINES, PAGES, table, text_lines, text_pages

BUCKETS = (("empty", 10), ("short", 100), ("medium", 500))


def bucket(n: Column) -> Column:
    """A page by the length of its text."""
    return F.when(n < 10, "empty").when(n < 100, "short").when(n < 500, "medium").otherwise("long")


def _in_bucket(name: str) -> Column:
    return F.count_if(bucket(F.col("n")) == name)


def _share(part: Column, whole: Column) -> Column:
    """A percentage with one decimal, 0 of nothing; rounded from whole thousandths."""
    return F.when(whole > 0, F.round(100.0 * part / whole, 1)).otherwise(F.lit(0.0))


def page_stats(pages: DataFrame, *by: str) -> DataFrame:
    """Counts by bucket, issues (nearly empty and under 50 characters), garbled pages, score and review flag by group."""
    issues = F.sum((F.col("n") < 10).cast("long") + (F.col("n") < 50).cast("long") + F.col("garbled").cast("long"))
    replaced = F.length("body") - F.length(F.replace("body", F.lit("�"), F.lit("")))
    pages = pages.withColumn("garbled", (F.length("body") > 0) & (replaced > 0.05 * F.length("body")))
    names = [b for b, _ in BUCKETS] + ["long"]
    out = pages.groupBy(*by).agg(F.count("*").alias("pages"), *[_in_bucket(b).alias(f"{b}_pages") for b in names], issues.alias("issues"), F.count_if("garbled").alias("garbled_pages"))
    good = F.col("medium_pages") + F.col("long_pages")
    review = (F.col("empty_pages") > 0.2 * F.col("pages")) | (F.col("issues") > 0.1 * F.col("pages"))
    return out.withColumns({"score": _share(good, F.col("pages")), "needs_review": review})


def doc_quality_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = page_stats(text_pages(table(spark, sf_dir, "documents")), "doc_id", "source")
    return out.orderBy(F.desc("score"), "doc_id")


_STATS = """count(*) AS pages, count(*) FILTER (n < 10) AS empty_pages, count(*) FILTER (n >= 10 AND n < 100) AS short_pages,
    count(*) FILTER (n >= 100 AND n < 500) AS medium_pages, count(*) FILTER (n >= 500) AS long_pages,
    CAST(sum((n < 10)::BIGINT + (n < 50)::BIGINT + (length(body) > 0 AND length(body) - length(replace(body, chr(65533), '')) > 0.05 * length(body))::BIGINT) AS BIGINT) AS issues,
    count(*) FILTER (length(body) > 0 AND length(body) - length(replace(body, chr(65533), '')) > 0.05 * length(body)) AS garbled_pages"""
_SCORE = "round(100.0::DOUBLE * (medium_pages + long_pages) / pages, 1) AS score, empty_pages > 0.2 * pages OR issues > 0.1 * pages AS needs_review"


def page_length_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_pages(table(spark, sf_dir, "documents")).groupBy(bucket(F.col("n")).alias("bucket")).agg(F.count("*").alias("pages"), F.sum("n").alias("chars"))


def quality_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per language and source, per language, and overall."""
    pages = text_pages(table(spark, sf_dir, "documents"))
    names = [b for b, _ in BUCKETS] + ["long"]
    out = pages.rollup("lang", "source").agg(F.count("*").alias("pages"), *[_in_bucket(b).alias(f"{b}_pages") for b in names], F.grouping_id().cast("long").alias("level"))
    return out.withColumn("score", _share(F.col("medium_pages") + F.col("long_pages"), F.col("pages")))


def page_length_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = text_pages(table(spark, sf_dir, "documents")).groupBy("source")
    return out.agg(F.count("*").alias("pages"), F.round(F.sum("n") / F.count("*"), 2).alias("mean_chars"), F.median("n").alias("median_chars"), F.max("n").alias("max_chars"))


def quality_rating_dist(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = page_stats(text_pages(table(spark, sf_dir, "documents")), "doc_id")
    return scored.groupBy(rating(F.col("score")).alias("rating")).agg(F.count("*").alias("docs"), F.count_if("needs_review").alias("to_review"))


ELEMENTS = {
    "tables": lambda c: c.rlike(r"(?md)^\s*\|.*\|") & c.rlike(r"\|[\s:]*-+[\s:|-]*\|"),
    "formulas": lambda c: c.rlike(r"\$\$[^$]+\$\$|\$[^$]+\$"),
    "images": lambda c: c.rlike(r"!\[.*?\]\(.*?\)|<figure>"),
    "code": lambda c: c.rlike(r"```"),
    "pipes": lambda c: F.contains(c, F.lit("|")),
}


def element_detection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and sources by the elements their pages hold; element by element in one pass."""
    pages = text_pages(table(spark, sf_dir, "documents"))
    return pages.groupBy("source").agg(*[F.count_if(test(F.col("body"))).alias(name) for name, test in ELEMENTS.items()], F.count("*").alias("pages"))


def repeated_garbled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with a run of eleven equal characters, or with more
    than 5 % of replacement characters."""
    pages = text_pages(table(spark, sf_dir, "documents"))
    run = F.col("body").rlike(r"(.)\1{10,}")
    replaced = F.length("body") - F.length(F.replace("body", F.lit("�"), F.lit("")))
    return pages.groupBy("source").agg(F.count_if(run).alias("repeated"), F.count_if((F.length("body") > 0) & (replaced > 0.05 * F.length("body"))).alias("garbled"))


_RUNS = "|".join(f"{c}{{11}}" for c in [*"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789 #%&,;:=@_~!-", *(rf"\{c}" for c in ".*|$^()[]?+")])


def syntax_counts(c: Column) -> dict[str, Column]:
    """What leaks from model output into a text: JSON fences and keys, and literal \\n outside formulas."""
    bare = F.regexp_replace(F.regexp_replace(F.regexp_replace(c, r"(?s)\$\$.*?\$\$", ""), r"\$[^$]+\$", ""), r"(?s)\\\[.*?\\\]", "")
    return {
        "json_fences": F.regexp_count(c, F.lit("(?i)```json")),
        "body_text_keys": F.regexp_count(c, F.lit('"body_text":')),
        "chart_type_keys": F.regexp_count(c, F.lit('"chart_type":')),
        "literal_newlines": F.regexp_count(bare, F.lit(r"\\n")),
        "code_blocks": F.regexp_count(c, F.lit("(?s)```.*?```")),
        "note_labels": F.regexp_count(c, F.lit(r"\*\*Footnotes:\*\*")),
    }


def markdown_counts(c: Column) -> dict[str, Column]:
    return {
        "page_headings": F.regexp_count(c, F.lit(r"(?m)^## Page \d+")),
        "figure_headings": F.regexp_count(c, F.lit(r"(?m)^### Fig \d+:")),
        "headings": F.regexp_count(c, F.lit(r"(?m)^#{1,6} ")),
        "chars": F.length(c),
    }


def split_pages(c: Column) -> Column:
    """A Markdown text's pages: what stands between `## Page n` headings, without a preamble that is a heading."""
    parts = F.filter(F.transform(F.split(c, r"(?m)^## Page \d+", -1), lambda x: F.regexp_replace(x, r"^[\s\p{Z}]+|[\s\p{Z}]+$", "")), lambda x: x != "")
    return F.when((F.size(parts) > 0) & F.startswith(F.get(parts, F.lit(0)), F.lit("#")), F.slice(parts, 2, F.size(parts))).otherwise(parts)


# Checkers: DataFrame of documents (name, text) -> findings

Checker = Callable[[DataFrame], DataFrame]


def finding(df: DataFrame, check: str, severity: str, when: Column, message: Column) -> DataFrame:
    return df.where(when).select(F.lit(check).alias("check"), F.lit(severity).alias("severity"), F.col("name").alias("target"), message.alias("message"))


def check_syntax(docs: DataFrame) -> DataFrame:
    d = docs.withColumns(syntax_counts(F.col("text")))
    rules = [
        ("issue", F.col("json_fences") > 0, F.format_string("%d JSON code blocks", "json_fences")),
        ("issue", F.col("body_text_keys") > 0, F.format_string("%d body_text keys", "body_text_keys")),
        ("warning", F.col("chart_type_keys") > 0, F.format_string("%d chart_type keys", "chart_type_keys")),
        ("warning", (F.col("literal_newlines") > 0) & (F.col("literal_newlines") > 10 * F.col("code_blocks")), F.format_string("%d literal newlines", "literal_newlines")),
        ("warning", F.col("note_labels") > 0, F.lit("note label in the text")),
    ]
    return reduce(DataFrame.unionByName, [finding(d, "syntax", *r) for r in rules])


def check_markdown(docs: DataFrame) -> DataFrame:
    d = docs.withColumns(markdown_counts(F.col("text")))
    rules = [("warning", F.col("page_headings") == 0, F.lit("no pages")), ("warning", F.col("chars") < 1000, F.format_string("only %d characters", "chars"))]
    return reduce(DataFrame.unionByName, [finding(d, "markdown", *r) for r in rules])


def check_pages(docs: DataFrame) -> DataFrame:
    d = docs.select("name", F.posexplode(split_pages(F.col("text"))).alias("page", "body")).withColumn("n", F.length("body"))
    rules = [
        ("issue", F.col("n") < 10, F.format_string("page %d is nearly empty", F.col("page") + 1)),
        ("issue", F.col("n") < 50, F.format_string("page %d is short", F.col("page") + 1)),
        ("issue", F.col("body").rlike(r"(.)\1{10,}"), F.format_string("page %d repeats a character", F.col("page") + 1)),
    ]
    return reduce(DataFrame.unionByName, [finding(d, "pages", *r) for r in rules])


def validate(docs: DataFrame, checkers: Sequence[Checker] = (check_syntax, check_markdown, check_pages)) -> DataFrame:
    """The findings of all checkers, in one table; a run passes if it holds no issue."""
    return reduce(DataFrame.unionByName, [c(docs) for c in checkers])


def passed(findings: DataFrame) -> DataFrame:
    return findings.agg(F.count_if(F.col("severity") == "issue").alias("issues"), F.count_if(F.col("severity") == "warning").alias("warnings")).withColumn("passed", F.col("issues") == 0)


def latex_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Formula spans by document; unbalanced are those whose brackets don't pair up in number."""
    spans = text_lines(table(spark, sf_dir, "documents")).select("doc_id", F.explode(F.regexp_extract_all("line", F.lit(r"\$([^$]+)\$"), F.lit(1))).alias("span"))
    n = lambda c: F.length("span") - F.length(F.replace("span", F.lit(c), F.lit("")))
    odd = (n("{") != n("}")) | (n("(") != n(")")) | (n("[") != n("]"))
    return spans.groupBy("doc_id").agg(F.count("*").alias("spans"), F.count_if(odd).alias("unbalanced"), F.sum(F.length("span")).alias("chars"))


QUERIES = {
    "doc_quality_score": doc_quality_score,
    "page_length_buckets": page_length_buckets,
    "quality_rollup": quality_rollup,
    "page_length_stats": page_length_stats,
    "quality_rating_dist": quality_rating_dist,
    "element_detection": element_detection,
    "repeated_garbled": repeated_garbled,
    "latex_spans": latex_spans,
}
ORACLES = {
    "doc_quality_score": f"SELECT *, {_SCORE} FROM (SELECT doc_id, source, {_STATS} FROM {PAGES} GROUP BY ALL)",
    "page_length_buckets": f"SELECT CASE WHEN n < 10 THEN 'empty' WHEN n < 100 THEN 'short' WHEN n < 500 THEN 'medium' ELSE 'long' END AS bucket, count(*) AS pages, CAST(sum(n) AS BIGINT) AS chars FROM {PAGES} GROUP BY 1",
    "quality_rollup": f"""SELECT *, round(100.0::DOUBLE * (medium_pages + long_pages) / pages, 1) AS score FROM (
        SELECT lang, source, count(*) AS pages, count(*) FILTER (n < 10) AS empty_pages, count(*) FILTER (n >= 10 AND n < 100) AS short_pages,
        count(*) FILTER (n >= 100 AND n < 500) AS medium_pages, count(*) FILTER (n >= 500) AS long_pages, CAST(grouping_id(lang, source) AS BIGINT) AS level
        FROM {PAGES} GROUP BY ROLLUP (lang, source))""",
    "page_length_stats": f"SELECT source, count(*) AS pages, round(sum(n)::DOUBLE / count(*), 2) AS mean_chars, CAST(median(n) AS DOUBLE) AS median_chars, max(n) AS max_chars FROM {PAGES} GROUP BY source",
    "quality_rating_dist": f"""SELECT CASE WHEN score >= 90 THEN 'excellent' WHEN score >= 80 THEN 'good' WHEN score >= 60 THEN 'fair' WHEN score >= 40 THEN 'poor' ELSE 'bad' END AS rating,
        count(*) AS docs, count(*) FILTER (needs_review) AS to_review FROM (SELECT *, {_SCORE} FROM (SELECT doc_id, {_STATS} FROM {PAGES} GROUP BY ALL)) GROUP BY 1""",
    "element_detection": rf"""SELECT source, count(*) FILTER (regexp_matches(body, '(?m)^\s*\|.*\|') AND regexp_matches(body, '\|[\s:]*-+[\s:|-]*\|')) AS tables,
        count(*) FILTER (regexp_matches(body, '\$\$[^$]+\$\$|\$[^$]+\$')) AS formulas, count(*) FILTER (regexp_matches(body, '!\[.*?\]\(.*?\)|<figure>')) AS images,
        count(*) FILTER (contains(body, '```')) AS code, count(*) FILTER (contains(body, '|')) AS pipes, count(*) AS pages FROM {PAGES} GROUP BY source""",
    "repeated_garbled": rf"""SELECT source, count(*) FILTER (regexp_matches(body, '{_RUNS}')) AS repeated,
        count(*) FILTER (length(body) > 0 AND length(body) - length(replace(body, chr(65533), '')) > 0.05 * length(body)) AS garbled FROM {PAGES} GROUP BY source""",
    "latex_spans": rf"""WITH s AS (SELECT doc_id, unnest(regexp_extract_all(line, '\$([^$]+)\$', 1)) AS span FROM {LINES}),
        n AS (SELECT doc_id, span, length(span) - length(replace(span, '{{', '')) <> length(span) - length(replace(span, '}}', '')) OR length(replace(span, '(', '')) <> length(replace(span, ')', ''))
            OR length(replace(span, '[', '')) <> length(replace(span, ']', '')) AS odd FROM s)
        SELECT doc_id, count(*) AS spans, count(*) FILTER (odd) AS unbalanced, CAST(sum(length(span)) AS BIGINT) AS chars FROM n GROUP BY doc_id""",
}
