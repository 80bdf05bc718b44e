import gc
import random

import pytest
from pyspark.sql import functions as F
from test_duplicates import brute_classes, brute_leaks, lines_kept

from pagewright.llm import neardup
from pagewright.llm.runtime import written

corpus_pipeline = pytest.importorskip("corpus_pipeline")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        before = kept
        kept = stage(spark, before, sf_dir)
        assert kept.columns == docs.columns
        assert {r.doc_id for r in kept.select("doc_id").collect()} <= {r.doc_id for r in before.select("doc_id").collect()}
    last = corpus_pipeline.STAGES[-1][1](spark, kept, sf_dir)
    rows = {tuple(r) for r in last.collect()}
    assert rows == {tuple(r) for r in corpus_pipeline.run(spark, sf_dir).collect()} and 0 < len(rows) <= docs.count()


def test_stages_begin_with_small_heaps(spark, monkeypatch):
    """A heap that an earlier stage made large is given back before the next one's Python workers start."""
    runtime = spark._jvm.java.lang.Runtime.getRuntime()
    held = [spark._jvm.java.nio.ByteBuffer.allocate(50 << 20) for _ in range(24)]
    before = runtime.totalMemory() >> 20
    del held
    gc.collect()
    after = corpus_pipeline.alone(lambda *_: runtime.totalMemory() >> 20)(spark, None, "")
    assert before > 1200 and after < before - 600

    class Swept(Exception):
        pass

    def swept(session):
        raise Swept

    monkeypatch.setattr(corpus_pipeline, "swept", swept)
    for _, stage in corpus_pipeline.STAGES:
        with pytest.raises(Swept):
            stage(spark, None, "")


def test_texts_reach_python_in_small_batches(spark, sf_dir, monkeypatch):
    """The last stage has run when it returns, and while it ran a batch held BATCH rows at most."""
    name, seen = "spark.sql.execution.arrow.maxRecordsPerBatch", []
    monkeypatch.setattr(corpus_pipeline, "written", lambda df, n: seen.append(spark.conf.get(name)) or written(df, n))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert seen == [str(corpus_pipeline.BATCH)] and int(spark.conf.get(name)) > corpus_pipeline.BATCH
    assert "MapInArrow" not in out._jdf.queryExecution().toString() and out.count() == docs.count()


def made():
    r = random.Random(31)
    word = lambda: f"w{r.randrange(900)}"
    line = lambda n: " ".join(word() for _ in range(n))
    pool, items = [line(12) for _ in range(6)], [(i, line(30)) for i in range(4)]
    docs = [(i, "\n".join([line(40), *r.sample(pool, r.randrange(3)), *([items[i % 4][1]] if i % 5 == 0 else []), line(25)])) for i in range(40)]
    docs += [(100 + i, docs[i][1].replace(" ", "  ", 1)) for i in range(6)]
    return docs, items


def test_against_brute_force(spark, tmp_path):
    """The middle stages on what the first one kept, each worked out without the operators."""
    docs, items = made()
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    df = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in docs], SCHEMA)
    stages = [f for _, f in corpus_pipeline.STAGES]
    deduplicated = stages[1](spark, df, str(tmp_path))
    lines = {i: t for i, t in lines_kept(docs).items() if t.strip()}
    assert {r.doc_id: r.text for r in deduplicated.collect()} == lines
    known = [(i, t) for i, t in lines.items()]
    one = stages[2](spark, deduplicated, str(tmp_path))
    classes = brute_classes(known, neardup.inverse_frequencies(deduplicated))
    assert {r.doc_id for r in one.collect()} == {i for i, c in classes.items() if i == c}
    left = [(i, t) for i, t in known if classes[i] == i]
    clean = stages[3](spark, one, str(tmp_path))
    assert {r.doc_id for r in clean.collect()} == {i for i, _ in left} - {d for d, _ in brute_leaks(left, items)}


def test_odd_rows(spark, tmp_path):
    docs, items = made()
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    long = " ".join(f"the{i}" for i in range(60000))
    rows = [(i, t, "en", "s", len(t)) for i, t in docs[:12]] + [(1, docs[1][1], "en", "s", 1), (None, "words of no document", None, None, None), (200, None, "en", "s", None), (201, "", None, "s", 0), (202, "12 %%", "en", None, 5), (203, long, "en", "s", len(long))]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"class_id": F.lit("x"), "score": F.lit(1), "row": F.lit(None).cast("int")})
    for docs_ in (df, df.limit(0)):
        kept = docs_
        for _, stage in corpus_pipeline.STAGES[:-1]:
            kept = stage(spark, kept, str(tmp_path))
            assert kept.columns == df.columns
        ids = [r.doc_id for r in kept.select("doc_id").collect()]
        assert {200, 201, 202}.isdisjoint(ids) and (203 in ids) == (docs_ is df)
        assert corpus_pipeline.STAGES[-1][1](spark, kept, str(tmp_path)).count() == len(ids)
