"""Progress as a table of page events: state, completion, resumption."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import figures, table

LEAST_RATE, LEAST_SIZE = 0.9, 500


def upsert(state: DataFrame, changes: DataFrame, keys: list[str], order: str = "updated_at") -> DataFrame:
    """State after changes: the latest row of each key (of equal times, that of changes), without a window."""
    both = state.withColumn("__new", F.lit(0)).unionByName(changes.withColumn("__new", F.lit(1)))
    values = [c for c in state.columns if c not in keys]
    last = both.groupBy(*keys).agg(F.max_by(F.struct(*values), F.struct(order, "__new")).alias("v"))
    return last.select(*keys, *[F.col(f"v.{c}").alias(c) for c in values])


def pending(expected: DataFrame, done: DataFrame, key: str) -> DataFrame:
    return expected.join(done, key, "left_anti")


def completion(docs: DataFrame) -> DataFrame:
    """docs: listed, size (null: no file), pages, ok -> complete and the first reason against."""
    rate = F.col("ok") / F.greatest(F.col("pages"), F.lit(1))
    reason = F.when(~F.col("listed"), "not listed").when(F.col("size").isNull(), "no file").when(F.col("size") < LEAST_SIZE, "file too small").when(rate < LEAST_RATE, "too many failed pages")
    return docs.withColumn("reason", reason).withColumn("complete", F.col("reason").isNull())


def doc_completion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as documents: listed unless open, their price as size."""
    orders, figs = table(spark, sf_dir, "orders"), figures(table(spark, sf_dir, "lineitem"))
    pages = figs.groupBy("doc").agg(F.count("*").alias("pages"), F.count_if("ok").alias("ok"))
    docs = orders.join(pages, orders.o_orderkey == pages.doc, "left")
    docs = docs.select("o_orderkey", (F.col("o_orderstatus") != "O").alias("listed"), F.floor("o_totalprice").cast("long").alias("size"), F.coalesce("pages", F.lit(0)).alias("pages"), F.coalesce("ok", F.lit(0)).alias("ok"))
    return completion(docs).select("o_orderkey", "complete", "reason")


def step_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages by priority as steps: completed, failed and pending ones (documents without pages count as one pending)."""
    orders, figs = table(spark, sf_dir, "orders"), figures(table(spark, sf_dir, "lineitem"))
    joined = orders.join(figs, orders.o_orderkey == figs.doc, "left").groupBy("o_orderpriority")
    return joined.agg(F.count_if("ok").alias("completed"), F.count_if(~F.col("ok")).alias("failed"), F.count_if(F.col("ok").isNull()).alias("pending"))


QUERIES = {f.__name__: f for f in (doc_completion, step_status)}
_PAGES = "(SELECT l_orderkey, count(*) AS pages, count(*) FILTER (l_quantity >= 3) AS ok FROM lineitem GROUP BY 1)"
ORACLES = {
    "doc_completion": f"""SELECT o_orderkey, reason IS NULL AS complete, reason FROM (SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN 'not listed' WHEN floor(o_totalprice) < {LEAST_SIZE} THEN 'file too small'
        WHEN coalesce(ok, 0)::DOUBLE / greatest(coalesce(pages, 0), 1) < {LEAST_RATE} THEN 'too many failed pages' END AS reason FROM orders LEFT JOIN {_PAGES} ON o_orderkey = l_orderkey)""",
    "step_status": """SELECT o_orderpriority, count(*) FILTER (l_quantity >= 3) AS completed, count(*) FILTER (l_quantity < 3) AS failed, count(*) FILTER (l_orderkey IS NULL) AS pending
        FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1""",
}
