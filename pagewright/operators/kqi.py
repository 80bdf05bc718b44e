"""Quality indicators of converted documents: per document, rolled up by page weight, gated."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import FIGURES, figures, table

INSERTION, CONFIDENCE, SUCCESS, COMPLETE = 0.95, 0.85, 0.95, 0.6


def rate(part: Column, whole: Column) -> Column:
    """Four decimals; 0 of nothing."""
    return F.when(whole > 0, F.round(part / whole, 4)).otherwise(F.lit(0.0))


def indicators(figs: DataFrame, *by: str) -> DataFrame:
    """Insertion, confidence and success rates, confidence bands and element counts. figs: level, confidence, has_meta, ok, page."""
    # Confidence is summed in tenths, so that the order of summation can't show.
    tenths = F.round(F.col("confidence") * 10).cast("long")
    out = figs.groupBy(*by).agg(
        F.count("*").alias("figures"), F.count_if("has_meta").alias("with_meta"), F.sum(tenths).alias("tenths"), F.count_if("ok").alias("ok_pages"),
        F.count_if(F.col("confidence") >= 0.9).alias("high"), F.count_if((F.col("confidence") >= 0.5) & (F.col("confidence") < 0.9)).alias("medium"), F.count_if(F.col("confidence") < 0.5).alias("low"),
    )
    out = out.withColumns({"insertion_rate": rate(F.col("with_meta"), F.col("figures")), "avg_confidence": rate(F.col("tenths"), F.col("figures") * 10), "success_rate": rate(F.col("ok_pages"), F.col("figures"))})
    return out.drop("tenths")


def gate_columns() -> dict[str, Column]:
    passes = {"insertion_pass": F.col("insertion_rate") >= INSERTION, "confidence_pass": F.col("avg_confidence") >= CONFIDENCE, "success_pass": F.col("success_rate") >= SUCCESS}
    return passes | {"overall_pass": (F.col("insertion_rate") >= INSERTION) & (F.col("avg_confidence") >= CONFIDENCE) & (F.col("success_rate") >= SUCCESS)}


def figure_kqi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return indicators(figures(table(spark, sf_dir, "lineitem")), "doc")


_KQI = f"""SELECT *, round(with_meta::DOUBLE / figures, 4) AS insertion_rate, round(tenths::DOUBLE / (figures * 10), 4) AS avg_confidence, round(ok_pages::DOUBLE / figures, 4) AS success_rate FROM (
    SELECT doc, count(*) AS figures, count(*) FILTER (has_meta) AS with_meta, CAST(sum(CAST(round(confidence * 10) AS BIGINT)) AS BIGINT) AS tenths, count(*) FILTER (ok) AS ok_pages,
    count(*) FILTER (confidence >= 0.9) AS high, count(*) FILTER (confidence >= 0.5 AND confidence < 0.9) AS medium, count(*) FILTER (confidence < 0.5) AS low FROM {FIGURES} GROUP BY doc)"""


def kqi_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that stop the delivery, and why: one row each for every indicator that fails."""
    docs = figure_kqi(spark, sf_dir).withColumns(gate_columns())
    names = [("insertion", "insertion_pass", "insertion_rate"), ("confidence", "confidence_pass", "avg_confidence"), ("success", "success_pass", "success_rate")]
    failing = F.filter(F.array(*[F.when(~F.col(p), F.struct(F.lit(n).alias("indicator"), F.col(v).alias("value"))) for n, p, v in names]), lambda x: x.isNotNull())
    return docs.select("doc", F.explode(failing).alias("f")).select("doc", "f.indicator", "f.value")


def kqi_compliance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of complying documents by customer segment."""
    docs = figure_kqi(spark, sf_dir).withColumns(gate_columns())
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    joined = docs.join(orders, docs.doc == orders.o_orderkey).join(customer, orders.o_custkey == customer.c_custkey)
    out = joined.groupBy("c_mktsegment").agg(F.count("*").alias("docs"), F.count_if("overall_pass").alias("passing"), F.count_if("insertion_pass").alias("insertion_ok"), F.count_if("confidence_pass").alias("confidence_ok"), F.count_if("success_pass").alias("success_ok"))
    return out.withColumn("compliance", F.round(100.0 * F.col("passing") / F.col("docs"), 1))


def weighted_rollup(parts: DataFrame, *by: str) -> DataFrame:
    """Parts of a document into one row: rates weigh by pages, counts add, flags hold if all hold (missing ones do).

    Rates count in ten-thousandths, so sums are whole numbers."""
    scaled = lambda c: F.sum(F.round(F.col(c) * 10000).cast("long") * F.col("figures"))
    # Half up in whole numbers: a quotient of doubles may fall on either side of a tie.
    mean = lambda c: F.floor((2 * scaled(c) + F.sum("figures")) / (2 * F.sum("figures"))) / 10000
    return parts.groupBy(*by).agg(
        F.count("*").alias("parts"), F.sum("figures").alias("figures"), mean("insertion_rate").alias("insertion_rate"), mean("avg_confidence").alias("avg_confidence"), mean("success_rate").alias("success_rate"),
        F.bool_and(F.coalesce("overall_pass", F.lit(True))).alias("all_pass"),
    )


def kqi_weighted_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = figure_kqi(spark, sf_dir).withColumns(gate_columns())
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    out = weighted_rollup(parts.join(orders, parts.doc == orders.o_orderkey), "o_custkey")
    return out.withColumn("complete", F.col("avg_confidence") >= COMPLETE)


_PASS = f"insertion_rate >= {INSERTION} AND avg_confidence >= {CONFIDENCE} AND success_rate >= {SUCCESS}"


def page_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals over successful pages, failures and batch totals by ship year."""
    lines = table(spark, sf_dir, "lineitem").groupBy(F.year("l_shipdate").cast("long").alias("year"))
    ok = F.col("l_quantity") >= 3
    cents = F.round(F.col("l_extendedprice") * 100).cast("long")
    out = lines.agg(F.count("*").alias("pages"), F.count_if(ok).alias("ok"), F.count_if(~ok).alias("failed"), F.sum(F.when(ok, cents).otherwise(0)).alias("cents"))
    return out.withColumn("rate", F.round(100.0 * F.col("ok") / F.col("pages"), 1))


QUERIES = {
    "figure_kqi": figure_kqi,
    "kqi_gate": kqi_gate,
    "kqi_compliance": kqi_compliance,
    "kqi_weighted_rollup": kqi_weighted_rollup,
    "page_summary": page_summary,
}
ORACLES = {
    "figure_kqi": f"SELECT * EXCLUDE (tenths) FROM ({_KQI})",
    "kqi_gate": f"""WITH k AS ({_KQI}) SELECT doc, 'insertion' AS indicator, insertion_rate AS value FROM k WHERE insertion_rate < {INSERTION}
        UNION ALL SELECT doc, 'confidence', avg_confidence FROM k WHERE avg_confidence < {CONFIDENCE} UNION ALL SELECT doc, 'success', success_rate FROM k WHERE success_rate < {SUCCESS}""",
    "kqi_compliance": f"""SELECT c_mktsegment, count(*) AS docs, count(*) FILTER ({_PASS}) AS passing, count(*) FILTER (insertion_rate >= {INSERTION}) AS insertion_ok,
        count(*) FILTER (avg_confidence >= {CONFIDENCE}) AS confidence_ok, count(*) FILTER (success_rate >= {SUCCESS}) AS success_ok, round(100.0::DOUBLE * count(*) FILTER ({_PASS}) / count(*), 1) AS compliance
        FROM ({_KQI}) JOIN orders ON doc = o_orderkey JOIN customer ON o_custkey = c_custkey GROUP BY 1""",
    "kqi_weighted_rollup": f"""SELECT *, avg_confidence >= {COMPLETE} AS complete FROM (SELECT o_custkey, count(*) AS parts, CAST(sum(figures) AS BIGINT) AS figures,
        CAST((2 * sum(CAST(round(insertion_rate * 10000) AS BIGINT) * figures) + sum(figures)) // (2 * sum(figures)) AS DOUBLE) / 10000 AS insertion_rate,
        CAST((2 * sum(CAST(round(avg_confidence * 10000) AS BIGINT) * figures) + sum(figures)) // (2 * sum(figures)) AS DOUBLE) / 10000 AS avg_confidence,
        CAST((2 * sum(CAST(round(success_rate * 10000) AS BIGINT) * figures) + sum(figures)) // (2 * sum(figures)) AS DOUBLE) / 10000 AS success_rate, bool_and({_PASS}) AS all_pass
        FROM ({_KQI}) JOIN orders ON doc = o_orderkey GROUP BY o_custkey)""",
    "page_summary": """SELECT CAST(year(l_shipdate) AS BIGINT) AS year, count(*) AS pages, count(*) FILTER (l_quantity >= 3) AS ok, count(*) FILTER (l_quantity < 3) AS failed,
        CAST(sum(CASE WHEN l_quantity >= 3 THEN CAST(round(l_extendedprice * 100) AS BIGINT) ELSE 0 END) AS BIGINT) AS cents, round(100.0::DOUBLE * count(*) FILTER (l_quantity >= 3) / count(*), 1) AS rate FROM lineitem GROUP BY 1""",
}
