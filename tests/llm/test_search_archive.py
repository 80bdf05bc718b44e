import numpy as np
import pytest
from pyspark.sql import functions as F

from pagewright.llm import topk, warc
from pagewright.llm.queries import ORACLES, QUERIES


def brute(ids, v, k=5):
    out = []
    for i, q in enumerate(ids):
        if q % 50 == 0:
            scores = sorted((-int(sum(int(a) * int(b) for a, b in zip(v[i], v[j]))), int(c)) for j, c in enumerate(ids) if c != q)[:k]
            out += [(int(q), r + 1, c, -s) for r, (s, c) in enumerate(scores)]
    return sorted(out)


@pytest.mark.parametrize("top, n", [(150, 230), (1, 120), (2**28, 60), (10, 4)])
def test_topk(spark, top, n):
    r = np.random.default_rng(top % 97)
    ids, v = np.arange(n), r.integers(-top, top + 1, (n, 7))
    df = spark.createDataFrame([(int(i), [int(x) for x in row]) for i, row in zip(ids, v)], "vec_id long, v array<long>").repartition(3)
    got = topk.search(df, F.col("vec_id") % 50 == 0)
    assert sorted((x.query_id, x.rank, x.vec_id, x.score) for x in got.collect()) == brute(ids, v)


def test_topk_common_vector(spark):
    """One vector on a third of the rows: the smallest ids win, and a task sends k of them for a query, not all."""
    r = np.random.default_rng(8)
    v = r.integers(-40, 41, (1800, 6))
    v[::3] = 60
    df = spark.createDataFrame([(int(i), [int(x) for x in row]) for i, row in enumerate(v)], "vec_id long, v array<long>").repartition(3)
    got = topk.search(df, F.col("vec_id") % 50 == 0)
    assert sorted((x.query_id, x.rank, x.vec_id, x.score) for x in got.collect()) == brute(np.arange(1800), v)
    rows, ids, scores = np.array([0, 0, 0, 1]), np.array([9, 4, 7, 1]), np.array([5, 5, 6, 2])
    best = [np.zeros((2, 2), np.int64), np.full((2, 2), topk.LOWEST)]
    topk._kept(best, rows, ids, scores, 2)
    topk._kept(best, np.array([0]), np.array([3]), np.array([5]), 2)
    assert best[0].tolist() == [[7, 3], [1, 0]] and best[1][0].tolist() == [6, 5]


def test_topk_odd_rows(spark):
    rows = [(0, [1.0, 2.0]), (1, None), (2, [float("nan"), 1.0]), (3, [None, 1.0]), (4, [float("inf"), 1.0]), (5, [0.5, 0.5]), (6, []), (7, [1.0]), (None, [1.0, 1.0]), (5, [0.5, 0.5])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").select("vec_id", topk.quantised(F.col("embedding")).alias("v"))
    got = topk.search(df, F.col("vec_id") % 50 == 0).orderBy("rank").collect()
    # 5 stands twice, 7 lacks a component, 6 has none; the others take no part.
    assert [(r.vec_id, r.score) for r in got] == [(5, 98304), (5, 98304), (7, 65536), (6, 0)]
    assert topk.search(df.limit(0), F.lit(True)).count() == 0


def test_topk_query(spark, sf_dir):
    from oracle import connect, same

    same(QUERIES["op5_topk"](spark, sf_dir).toPandas(), connect(sf_dir).sql(ORACLES["op5_topk"]).df())


def test_warc(spark, tmp_path):
    import base64
    import hashlib

    pages = [(1, "http://a/ x", "same é"), (2, None, "same é"), (3, "http://c", "other WARC/1.1\r\n\r\nContent-Length: 3\r\n"), (4, "u", None), (5, "u", ""), (None, "n", "same é"), (6, "u", "x" * 70000), (2, None, "same é")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("first", F.lit(1))
    path = str(tmp_path / "warc")
    warc.write(warc.resolved(warc.records(df)), path)
    got = warc.read(spark, path).collect()
    text = {1: "same é", 2: "same é", 3: pages[2][2], 4: "", 5: "", 6: "x" * 70000, None: "same é"}
    assert len(got) == len(pages)
    for r in got:
        raw = text[r.page_id].encode()
        assert (r.payload_bytes, r.payload_digest) == (len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode())
        assert (r.record_type, r.refers_to) == {1: ("revisit", 2), 4: ("revisit", 5), None: ("revisit", 2)}.get(r.page_id, ("response", None))
        assert r.payload is None if r.record_type == "revisit" else bytes(r.payload) == raw
    names = {r.record_id: r.page_id for r in got}
    assert len(names) == len(got)
    assert all(names[r.refers_to_id] == r.refers_to for r in got if r.refers_to)
    warc.deduplicated(spark, path, str(tmp_path / "again"))
    again = warc.read(spark, str(tmp_path / "again")).collect()
    key = lambda r: (r.page_id or 0, r.record_type, r.refers_to, r.payload_digest, r.payload_bytes)
    assert sorted(map(key, again), key=str) == sorted(map(key, got), key=str) and len({r.record_id for r in again}) == len(again)
    assert all({x.record_id: x.page_id for x in again}[r.refers_to_id] == r.refers_to for r in again if r.refers_to)
    assert warc.archived(df.limit(0), str(tmp_path / "none")).count() == 0
    least = warc.resolved(warc.records(df), least=7).where("refers_to IS NOT NULL")
    assert {r.payload for r in least.collect()} == {"same é"}


def test_warc_bytes_and_lost_responses(spark, tmp_path):
    """Payloads that aren't UTF-8 keep their bytes; a revisit without its response in the source stays one."""
    raw = bytes(range(256))
    df = spark.createDataFrame([(1, "u", bytearray(raw)), (2, "u", bytearray(raw))], "page_id long, url string, html binary")
    df = df.withColumn("html", F.col("html").cast("string"))
    path, part = str(tmp_path / "a"), str(tmp_path / "b")
    warc.write(warc.resolved(warc.records(df)), path)
    assert bytes(warc.read(spark, path).where("page_id = 2").first().payload) == raw
    recs = warc.resolved(warc.records(df))
    warc.write(recs.where("page_id = 1"), part)
    warc.deduplicated(spark, part, str(tmp_path / "c"))
    (lost,) = warc.read(spark, str(tmp_path / "c")).collect()
    assert (lost.page_id, lost.record_type, lost.refers_to, lost.payload_bytes) == (1, "revisit", 2, 256)


def test_warc_query(spark, sf_dir):
    from oracle import connect, same

    same(QUERIES["op4_warc"](spark, sf_dir).toPandas(), connect(sf_dir).sql(ORACLES["op4_warc"]).df())
