"""That nothing is left out of what an operator reads."""

from pyspark.sql import functions as F

from pagewright.llm import linededup


def levels_used(spark, monkeypatch, run):
    """The levels of 400 tokens, each in four of 400 documents, as line dedup numbers its tokens by them."""
    seen, numbered = [], linededup.numbered
    monkeypatch.setattr(linededup, "numbered", lambda docs, rare: seen.append(rare) or numbered(docs, rare))
    docs = spark.range(400).selectExpr("id AS doc_id", "concat_ws(' ', transform(sequence(0, 3), i -> concat('u', (id + i) % 400))) AS text", "0L AS n_chars")
    run(docs).collect()
    level = F.get(seen[0], linededup._hash(F.col("t")).bitwiseAND(F.lit((1 << linededup.SKETCH_BITS) - 1)).cast("int"))
    return [r.x for r in spark.range(400).selectExpr("concat('u', id) AS t").select(level.alias("x")).collect()]


def test_tokens_are_counted_in_all_documents(spark, monkeypatch):
    assert levels_used(spark, monkeypatch, linededup.deduplicated) == [1] * 400


def test_the_pipeline_counts_tokens_in_all_documents(spark, monkeypatch):
    import corpus_pipeline

    assert levels_used(spark, monkeypatch, lambda docs: corpus_pipeline.drop_repeated_lines(spark, docs, "")) == [1] * 400
