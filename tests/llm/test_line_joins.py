"""What the joins of line dedup compare: few pairs, and every similar one."""

import random

from pyspark.sql import functions as F

from pagewright.llm import linededup


def level_of(rare, token):
    return F.get(rare, linededup._hash(token).bitwiseAND(F.lit((1 << linededup.SKETCH_BITS) - 1)).cast("int"))


def test_numbers_are_sorted_as_plain_longs(spark):
    """Spark sorts arrays that may hold nulls by boxed values."""
    rare = F.array(F.lit(0).cast("long"))
    set_ = spark.range(1).select(linededup.numbers(F.array(F.lit(5).cast("long")), rare).alias("set")).schema["set"].dataType
    assert not set_.containsNull


def test_fine_levels(spark):
    docs = spark.range(1024).selectExpr("id AS doc_id", "concat_ws(' ', 'all', if(id % 128 = 0, 'eight', ''), if(id % 256 = 0, 'four', ''), if(id < 3, 'three', '')) AS text")
    rare = linededup.rarity(docs, share=1, fine=True)
    got = spark.range(1).select(*[level_of(rare, F.lit(t)).alias(t) for t in ("all", "eight", "four", "three", "none")]).first()
    assert tuple(got) == (9, 2, 1, 0, 0)


def test_sets_meet_under_their_first_shared_token(spark):
    """Sets of 50 that are similar share 45: they meet among the first 6, though prefixes have 11."""
    r = random.Random(3)
    base = [f"w{i}" for i in range(50)]
    docs = [(i, " ".join([*r.sample(base, 49), f"x{i}"])) for i in range(30)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    distinct = linededup.sets(linededup.numbered(df, linededup.rarity(df, share=1, fine=True)))
    entries = linededup.candidates(distinct)
    assert distinct.selectExpr("max(size(prefix)) AS x").first().x == 11
    got = entries.agg(F.max("i").alias("last"), F.countDistinct("k1", "parity").alias("sets")).first()
    assert (got.last, got.sets) == (5, 30)
    assert {x.doc_id: x.n_removed for x in linededup.deduplicated(df).collect()} == {i: int(i > 0) for i in range(30)}


def test_entries_of_frequent_tokens_share_a_key_if_they_may_match(spark):
    every = spark.range(4, 130).select(F.col("id").cast("int").alias("n"))
    every = every.select("n", F.explode(F.sequence(F.lit(0), linededup._prefix(F.col("n")) - 1)).alias("i"))
    token = F.lit(linededup.FREQUENT << linededup._TOKEN)
    every = every.select("n", "i", linededup._keys(token, F.col("n"), F.col("i")).alias("keys")).localCheckpoint()
    pairs = every.alias("a").crossJoin(every.alias("b")).where(linededup._places("a", "b", F.lit(0)))
    assert pairs.count() > 10000 and pairs.where(~F.arrays_overlap("a.keys", "b.keys")).count() == 0
    assert every.agg(F.avg(F.size("keys")).alias("x")).first().x < 1.5 and every.where("size(keys) > 2").count() == 0


def shuffles(spark, monkeypatch, make):
    """The exchanges, and those that stand for another, in the plan of what make() writes last."""
    seen, written = [], linededup.written
    monkeypatch.setattr(linededup, "written", lambda df, name: seen.append(df) or written(df, name))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        make()
        plan = seen[-1]._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.unset("spark.sql.adaptive.enabled")
    return plan.count("Exchange hashpartitioning") - plan.count("ReusedExchange"), plan.count("ReusedExchange")


CHOSEN = ["id AS k1", "id AS parity", "id % 3 AS key", "struct(id AS doc_id, 0 AS line, xxhash64(concat('a b c d ', id)) AS row) AS first", "5 AS n"]


def test_sets_verified_among_themselves_are_shuffled_once(spark, monkeypatch):
    chosen = linededup.written(spark.range(20).selectExpr(*CHOSEN, "split('a b c d e', ' ') AS set"), "chosen")
    # The join's one exchange, and that of distinct().
    assert shuffles(spark, monkeypatch, lambda: linededup._verified(chosen, chosen)) == (2, 1)


def test_texts_of_chosen_lines_are_shuffled_once(spark, monkeypatch):
    docs = spark.range(20).selectExpr("id AS doc_id", "concat('a b c d ', id) AS text")
    docs = linededup.written(docs.unionAll(docs), "docs")
    chosen = linededup.written(spark.range(20).selectExpr(*CHOSEN), "chosen")
    got = []
    # Of the texts and of the chosen lines.
    assert shuffles(spark, monkeypatch, lambda: got.extend(linededup.with_tokens(docs, chosen).collect())) == (2, 0)
    assert {(r.k1, r.set[-1], len(r.set)) for r in got} == {(i, str(i), 5) for i in range(20)} and len(got) == 20
