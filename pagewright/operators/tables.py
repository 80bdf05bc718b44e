"""The views that lift the tables into lines, pages, chunks, figures and calls, in both dialects."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import strip


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_lines(docs: DataFrame) -> DataFrame:
    """doc_id, source, lang, line_no (from 1) and line."""
    parts = F.posexplode(F.split("text", "\n", -1)).alias("at", "line")
    return docs.select("doc_id", "source", "lang", parts).select("doc_id", "source", "lang", (F.col("at") + 1).cast("long").alias("line_no"), "line")


def text_pages(docs: DataFrame) -> DataFrame:
    """One line as a page: doc_id, source, lang, page, body and n, the length of the trimmed body."""
    return text_lines(docs).select("doc_id", "source", "lang", F.col("line_no").alias("page"), F.col("line").alias("body"), F.length(strip(F.col("line"))).cast("long").alias("n"))


def figures(lineitem: DataFrame) -> DataFrame:
    """Order lines as figures of a document: doc, page, level (of confidence), confidence and has_meta."""
    flag = F.col("l_returnflag")
    level = F.when(flag == "A", "high").when(flag == "N", "medium").otherwise("low")
    value = F.when(flag == "A", 1.0).when(flag == "N", 0.6).otherwise(0.3)
    return lineitem.select(F.col("l_orderkey").alias("doc"), F.col("l_linenumber").cast("long").alias("page"), level.alias("level"), value.alias("confidence"), (F.col("l_discount") < 0.095).alias("has_meta"), (F.col("l_quantity") >= 3).alias("ok"), F.col("l_partkey").alias("part"), F.col("l_extendedprice").alias("price"))


def calls(events: DataFrame) -> DataFrame:
    """Events as model calls: event_id, ts, key, ok and latency."""
    return events.select("event_id", F.col("ts").cast("timestamp").alias("ts"), F.col("user_id").alias("key"), (F.col("event_type") != "error").alias("ok"), F.col("value").alias("latency"), "event_type", "props")


#: Neighbouring keys that are numbered and summed together before the groups' totals are.
RUN = 4096



def running(df: DataFrame, group: str, key: Column, order: list[str], value: str, run: int = RUN) -> DataFrame:
    """df with `number` (from 1) and `before` (the sum of value over the rows before), within group by order.

    key (a number that `order` follows) is cut into runs: rows are numbered within their run, and what stands before a run
    comes from the runs' totals. So a task holds a run and no group as a whole."""
    own = df.withColumn("__run", F.floor(key / run))
    before = Window.partitionBy(group).orderBy("__run").rowsBetween(Window.unboundedPreceding, -1)
    totals = own.groupBy(group, "__run").agg(F.sum(value).alias("__sum"), F.count("*").alias("__rows"))
    totals = totals.select(group, "__run", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}0") for c in ("__sum", "__rows")])
    inside = Window.partitionBy(group, "__run").orderBy(*order)
    own = own.withColumns({"__n": F.row_number().over(inside), "__b": F.coalesce(F.sum(value).over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))})
    out = own.join(totals, [group, "__run"])
    return out.select(*df.columns, (F.col("__n") + F.col("__rows0")).cast("long").alias("number"), (F.col("__b") + F.col("__sum0")).alias("before"))


LINES = "(SELECT doc_id, source, lang, CAST(generate_subscripts(string_split(text, chr(10)), 1) AS BIGINT) AS line_no, unnest(string_split(text, chr(10))) AS line FROM documents)"
PAGES = rf"(SELECT doc_id, source, lang, line_no AS page, line AS body, CAST(length(regexp_replace(line, '^[\s\p{{Z}}]+|[\s\p{{Z}}]+$', '', 'g')) AS BIGINT) AS n FROM {LINES})"
FIGURES = "(SELECT l_orderkey AS doc, CAST(l_linenumber AS BIGINT) AS page, CASE l_returnflag WHEN 'A' THEN 'high' WHEN 'N' THEN 'medium' ELSE 'low' END AS level, CAST(CASE l_returnflag WHEN 'A' THEN 1.0 WHEN 'N' THEN 0.6 ELSE 0.3 END AS DOUBLE) AS confidence, l_discount < CAST(0.095 AS DOUBLE) AS has_meta, l_quantity >= 3 AS ok, l_partkey AS part, l_extendedprice AS price FROM lineitem)"
CALLS = "(SELECT event_id, ts, user_id AS key, event_type <> 'error' AS ok, value AS latency, event_type, props FROM events)"
