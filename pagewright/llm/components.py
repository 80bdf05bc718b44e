"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import dropped, lookup, written


def _nearest(pairs: DataFrame, strict: bool) -> DataFrame:
    """(u, v, m): m is the least of u and its neighbours v; u may hold a large part of the links."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("links"))
    out = lookup(pairs, "u", least, "links", F.xxhash64("v"))
    return out.withColumn("m", F.least("u", "m")) if not strict else out


def _large(links: DataFrame) -> DataFrame:
    both = links.union(links.select(F.col("v"), F.col("u"))).toDF("u", "v")
    return _nearest(both, False).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    near = _nearest(down, True)
    own = near.select("u", F.col("m").alias("v"))
    rest = near.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return own.union(rest)


def _state(links: DataFrame) -> tuple:
    mark = F.xxhash64("u", "v").cast("decimal(38,0)")
    return tuple(links.agg(F.count("*"), F.sum(mark)).first())


def components(links: DataFrame) -> DataFrame:
    """(u, v) links of integer nodes -> (node, label): the least node of its component, for all nodes but these least.

    Both kinds of star keep connectivity and bring every node closer to its component's least one; when a round
    changes nothing, every link is (node, least). The links of each round are a written table.
    """
    links = written(links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    before = _state(links)
    while before[0]:
        after = written(_small(_large(links).where("u <> v").distinct()).where("u <> v").distinct(), "links")
        dropped(links)
        links, state = after, _state(after)
        if state == before:
            break
        before = state
    return links.select(F.col("u").alias("node"), F.col("v").alias("label"))
