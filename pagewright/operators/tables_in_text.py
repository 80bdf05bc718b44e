"""Tables that were seen in figures, as sections of a sheet: read from metadata, labels filtered, laid out and injected."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from . import sheets
from .tables import LINES, table, text_lines

FIGURES = (
    "array<struct<chart_identification:struct<chart_title:string, image_type:string, page_number:int>, "
    "visual_content:struct<content_description:string, key_insight:string, text_labels:array<string>, key_elements:array<string>>>>"
)
# Headings of tables that are no items.
COMMON_HEADERS = [
    "nome popular", "característica", "características", "cultura", "indicação", "biofertilizante", "quantidade", "dose", "dosagem", "ingrediente", "ingredientes", "espécie", "planta", "plantas",
    "plantar indicadoras de solo", "plantas indicadoras de solo",
]


def tables_of(sidecar: Column) -> Column:
    """The figures of a sidecar (JSON; a list, or an object that holds one) that are tables, by page."""
    figures = F.coalesce(F.from_json(sidecar, f"struct<figures:{FIGURES}>")["figures"], F.from_json(sidecar, FIGURES))
    kept = F.filter(figures, lambda f: f["chart_identification"]["image_type"] == "table")
    page = lambda f: F.coalesce(f["chart_identification"]["page_number"], F.lit(0))
    ordered = lambda every: F.array_sort(F.transform(every, lambda f, i: F.struct(page(f).alias("page"), i.alias("i"))))
    return T.let(kept, lambda every: F.transform(ordered(every), lambda o: F.get(every, o["i"])))


def filtered_labels(labels: Column, elements: Column, title: Column) -> Column:
    """Labels that say something: neither the table's headings nor its title nor a common heading, three characters or
    more, not only digits."""
    skip = F.concat(F.transform(F.coalesce(elements, F.array().cast("array<string>")), F.lower), F.array(F.lower(title)), F.array(*map(F.lit, COMMON_HEADERS)))
    said = lambda s, x: ~F.array_contains(s, F.lower(T.strip(x))) & (F.length(T.strip(x)) >= 3) & ~T.strip(x).rlike(r"(?U)^\d+$")
    return T.let(skip, lambda s: F.filter(F.coalesce(labels, F.array().cast("array<string>")), lambda x: said(s, x)))


def table_section(t: Column, translated=lambda c: c) -> Column:
    """A table as a section: title, description, items, insight. `translated` is applied to what was written by a model."""
    title = F.coalesce(t["chart_identification"]["chart_title"], F.lit("Tabela"))
    seen = t["visual_content"]
    about, insight = [translated(F.coalesce(seen[c], F.lit(""))) for c in ("content_description", "key_insight")]
    labels = filtered_labels(seen["text_labels"], seen["key_elements"], title)
    items = T.let(labels, lambda ls: F.when(F.size(ls) > 0, F.concat(F.lit("**Itens:**\n"), F.array_join(F.transform(ls, lambda x: F.concat(F.lit("* "), x)), "\n"))))
    return F.concat_ws("\n", F.concat(F.lit("### "), title), F.lit(""), F.when(about != "", F.concat(about, F.lit("\n"))), items, F.when(insight != "", F.concat(F.lit("\n**Insight:** "), insight)))


def with_tables(document: Column, sidecar: Column) -> Column:
    """A document with the sections of its sidecar's tables; as it is without any."""
    section = F.array_join(F.transform(tables_of(sidecar), lambda t: table_section(t)), "\n\n")
    return T.let(section, lambda made: sheets.inject_tables(document, F.coalesce(made, F.lit(""))))


def counts(c: Column) -> dict[str, Column]:
    """Headings by level, items and paragraphs of an optimised text."""
    return {
        "h1": F.regexp_count(c, F.lit("(?m)^# [^#]")).cast("long"), "h2": F.regexp_count(c, F.lit("(?m)^## [^#]")).cast("long"), "h3": F.regexp_count(c, F.lit("(?m)^### [^#]")).cast("long"),
        "bullets": F.regexp_count(c, F.lit(r"(?m)^\s*\* ")).cast("long"), "paragraphs": F.regexp_count(c, F.lit(r"\n\n[A-Z]")).cast("long"), "chars": F.length(c).cast("long"),
    }


def _sidecar() -> Column:
    """For a part: two tables (the second page first) and a figure that is none."""
    one = lambda title, kind, page, labels: F.struct(
        F.struct(title.alias("chart_title"), F.lit(kind).alias("image_type"), F.lit(page).alias("page_number")).alias("chart_identification"),
        F.struct(F.lit("About it").alias("content_description"), F.when(F.col("p_size") % 2 == 0, "so").otherwise("").alias("key_insight"), labels.alias("text_labels"), F.array(F.lit("Head")).alias("key_elements")).alias("visual_content"),
    )
    labels = F.array(F.lit("head"), F.lit("12345"), F.lit("ab"), F.lit("Dose"), F.col("p_name"), F.col("p_type"))
    return F.to_json(F.struct(F.array(one(F.col("p_type"), "table", 2, labels), one(F.lit("x"), "figure", 1, labels), one(F.col("p_name"), "table", 1, labels)).alias("figures")))


def injected_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as sheets with an `Importante` section, in front of which their tables go."""
    # Rows are short and take long: a small file would be one task.
    part = table(spark, sf_dir, "part").repartition(spark.sparkContext.defaultParallelism, "p_partkey")
    part = part.select("p_partkey", with_tables(F.lit("# T\n\n## Importante!\nend"), _sidecar()).alias("document"))
    return part.select("p_partkey", F.md5("document").alias("digest"), F.length("document").cast("long").alias("chars"))


def optimised_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts over texts whose lines are headings of three levels, items and paragraphs in turn, by language."""
    lines = text_lines(table(spark, sf_dir, "documents")).where(F.col("line").rlike("^[A-Z][a-z]"))
    mark = F.element_at(F.array(*map(F.lit, ("# ", "## ", "### ", "* ", "\n\n"))), (F.col("line_no") % 5 + 1).cast("int"))
    made = lines.select("doc_id", "lang", F.concat(F.lit("\n"), mark, "line").alias("md")).select("lang", *[c.alias(n) for n, c in counts(F.col("md")).items()])
    return made.groupBy("lang").agg(*[F.sum(n).alias(n) for n in counts(F.col("md"))])


QUERIES = {f.__name__: f for f in (injected_tables, optimised_summary)}
_ITEMS = lambda title: f"array_to_string(list_transform(list_filter([p_name, p_type], lambda x: lower(x) <> lower({title})), lambda x: '* ' || x), chr(10))"
_PART = lambda title: f"'### ' || {title} || b || 'About it' || b || '**Itens:**' || chr(10) || {_ITEMS(title)} || CASE WHEN p_size % 2 = 0 THEN b || '**Insight:** so' ELSE '' END"
_K = "line_no % 5"
ORACLES = {
    "injected_tables": f"""SELECT p_partkey, md5(d) AS digest, CAST(length(d) AS BIGINT) AS chars FROM (SELECT p_partkey, '# T' || b || {_PART('p_name')} || b || {_PART('p_type')} || b || '## Importante!' || chr(10) || 'end' AS d
        FROM (SELECT *, chr(10) || chr(10) AS b FROM part))""",
    "optimised_summary": f"""SELECT lang, count(*) FILTER ({_K} = 0) AS h1, count(*) FILTER ({_K} = 1) AS h2, count(*) FILTER ({_K} = 2) AS h3, count(*) FILTER ({_K} = 3) AS bullets, count(*) FILTER ({_K} = 4) AS paragraphs,
        CAST(sum(length(line) + CASE {_K} WHEN 0 THEN 3 WHEN 1 THEN 4 WHEN 2 THEN 5 WHEN 3 THEN 3 ELSE 3 END) AS BIGINT) AS chars FROM {LINES} WHERE regexp_matches(line, '^[A-Z][a-z]') GROUP BY 1""",
}
