from pyspark.sql import functions as F

from pagewright.operators import tables, telemetry
from pagewright.sources import sidecars
from pagewright.streaming import health


def test_key_health(spark, sf_dir, tmp_path):
    path = f"{sf_dir}/events.parquet"
    events = spark.read.parquet(path)
    stream = spark.readStream.schema(events.schema).parquet(path.replace("events.parquet", "event[s].parquet"))
    out = health.run_to_table(health.key_health(health.stream_calls(stream)), "key_health", str(tmp_path / "a"))
    assert out.count() == events.count()
    # Every run of failures ends with its length: compare with the batch form.
    batch = telemetry.streaks(tables.calls(events))
    want = {(r.key, r.length): r.n for r in batch.groupBy("key", "length").agg(F.count("*").alias("n")).collect()}
    longest = {k: max(n for (key, n) in want if key == k) for k, _ in want}
    got = {r.key: r.m for r in out.groupBy("key").agg(F.max("failures").alias("m")).where("m > 0").collect()}
    assert got == longest
    assert out.where("opened").count() == batch.where("opens").count()


def test_throughput(spark, sf_dir, tmp_path):
    path = f"{sf_dir}/events.parquet"
    events = spark.read.parquet(path)
    stream = spark.readStream.schema(events.schema).parquet(path.replace("events.parquet", "event[s].parquet"))
    out = health.run_to_table(health.throughput(health.stream_calls(stream)), "throughput", str(tmp_path / "b"), "complete")
    want = events.groupBy(F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("start")).count()
    assert {(r.start, r.calls) for r in out.collect()} == {(r.start, r["count"]) for r in want.collect()}


def test_sidecars(spark, tmp_path):
    spark.dataSource.register(sidecars.SidecarSource)
    rows = spark.createDataFrame([("a", '{"version": "1.0", "notes": [{"page": 1, "id": 1, "text": "é"}]}'), ("VALIDATION_REPORT_x", "{}")], "name string, data string")
    rows.write.format("sidecar").mode("append").option("path", str(tmp_path)).save()
    (tmp_path / "broken.yaml").write_text("a: [1")
    got = {r.name: r for r in spark.read.format("sidecar").option("path", str(tmp_path)).load().collect()}
    assert set(got) == {"a", "broken"} and '"é"' in got["a"].data and got["broken"].error and got["broken"].data is None


def test_files(spark, tmp_path):
    docs = spark.createDataFrame([("one", "# A\ntext"), ("QUALITY_REPORT", "x")], "name string, document string")
    sidecars.write_markdown(docs, str(tmp_path / "out"))
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "one.md").write_text("# A\ntext")
    (tmp_path / "in" / "QUALITY_REPORT.md").write_text("x")
    assert [(r.name, r.text) for r in sidecars.markdown_files(spark, str(tmp_path / "in")).collect()] == [("one", "# A\ntext")]
    files = spark.createDataFrame([("My doc", f) for f in ("b.md", "a.md", "x.yaml", "y_all_figures.yaml", "z.validation.yaml", "n.footnotes.yaml")], "document string, file string")
    got = {r.kind: (r.file, r.delivered) for r in sidecars.delivery(files).collect()}
    assert got == {"text": ("a.md", "My-doc.md"), "figures": ("y_all_figures.yaml", "My-doc.yaml"), "notes": ("n.footnotes.yaml", "My-doc.footnotes.yaml")}
