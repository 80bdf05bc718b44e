"""What has to hold on larger tables and longer texts than the given ones."""

import time

import pyarrow.parquet as pq
import pytest
from oracle import connect, same
from pyspark.sql import functions as F

from pagewright.functions import markdown as M
from pagewright.plans import catalogue


@pytest.fixture
def timed():
    """A function's result, and the seconds it took."""

    def run(f):
        began = time.perf_counter()
        return f(), time.perf_counter() - began

    return run


def written(df, tmp_path, name):
    pq.write_table(df.toArrow(), tmp_path / f"{name}.parquet")
    return str(tmp_path)


def compared(spark, folder, name):
    """A query against its SQL on a folder's tables."""
    same(catalogue.QUERIES[name](spark, folder).toPandas(), connect(folder).sql(catalogue.ORACLES[name]).df())


def test_table_match_by_titles_not_by_parts(spark, tmp_path, timed):
    """60000 parts of one brand and size: 576 million pairs of parts, but 36 pairs of titles."""
    name = F.array(*[F.lit(f"{a} {b}") for a in ("big", "old", "red") for b in ("bolt", "ring")])
    key = F.col("id") + 1
    part = spark.range(60000).select(key.alias("p_partkey"), F.get(name, (key % 6).cast("int")).alias("p_name"), F.lit("b").alias("p_brand"), F.lit(7).alias("p_size"))
    folder = written(part, tmp_path, "part")
    rows, took = timed(lambda: catalogue.QUERIES["table_match"](spark, folder).collect())
    assert len(rows) == 12000 and all(r.score == 1 and r.candidates == 48000 and r.table_key % 6 == r.p_partkey % 6 for r in rows)
    assert took < 60


def test_key_health_of_more_calls_than_a_batch_holds(spark, tmp_path):
    """25000 calls of a key, in no order: three of Arrow's batches. Besides, calls of one time and event_id, and nulls."""
    i = F.col("id")
    at = F.timestamp_seconds(i * 7919 % 25000).cast("timestamp_ntz")
    event = F.when(i % 7 == 0, "error").when(i % 11 == 0, F.lit(None)).when(F.xxhash64("id") % 5 == 0, "click").otherwise("error")
    columns = [F.when(i % 4001 != 0, at).alias("ts"), F.when(i > 24900, i % 3).otherwise(1).alias("user_id"), event.alias("event_type"), F.lit(1.0).alias("value"), F.lit("{}").alias("props")]
    events = spark.range(25000).select(i.alias("event_id"), *columns)
    twice = spark.range(100).select((i * 5).alias("event_id"), *columns).withColumn("event_type", F.when(F.col("event_id") % 2 == 0, "error").otherwise("click"))
    lost = spark.range(5).select(F.lit(None).cast("long").alias("event_id"), *columns)
    compared(spark, written(events.unionByName(twice).unionByName(lost), tmp_path, "events"), "stream_key_health")


def documents(spark, tmp_path, texts):
    rows = [(i + 1, text, "en", "web", len(text)) for i, text in enumerate(texts)]
    return written(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"), tmp_path, "documents")


def test_page_offset_beyond_a_thousand_pages(spark, tmp_path, one):
    texts = ["\n".join(f"line {i} ends." for i in range(n)) for n in (985, 995, 1300)]
    compared(spark, documents(spark, tmp_path, texts), "page_offset")
    assert one(M.apply_page_offset(F.lit("![f](images/page_990.png) ![f](images/page_1200.png)"), F.lit(10))) == "![f](images/page_1000.png) ![f](images/page_1210.png)"


def test_lines_with_other_line_ends_are_real(spark, tmp_path):
    """As in the SQL, only a line feed ends a line."""
    compared(spark, documents(spark, tmp_path, ["c\r1.\nA\nC d\u20281.", "A.b", "no stop"]), "broken_anchors")


@pytest.fixture(scope="module")
def long_texts(spark, tmp_path_factory):
    """A text with a line of 400000 small letters without a full stop, and one of 5000 lines."""
    texts = ["A line ends.\n" + "word" * 100000 + "\nlast one.", "\n".join(f"Line {i} goes on and ends." for i in range(5000))]
    return documents(spark, tmp_path_factory.mktemp("long"), texts)


LIFTED = [
    "aligned_tables", "broken_anchors", "chapter_headings", "chapters_placed", "checker_findings", "clean_artifacts", "clean_books", "clean_sheets", "headers_footers", "heading_jumps", "hyphenation",
    "literal_newlines", "page_order", "punctuation", "title_headers", "toc",
]


@pytest.mark.parametrize("name", LIFTED)
def test_time_grows_with_the_text(spark, long_texts, timed, name):
    rows, took = timed(lambda: catalogue.QUERIES[name](spark, long_texts).toPandas())
    same(rows, connect(long_texts).sql(catalogue.ORACLES[name]).df())
    assert took < 20


def test_injected_tables_in_many_tasks(spark, sf_dir):
    """A small file of parts isn't one task."""
    assert catalogue.QUERIES["injected_tables"](spark, sf_dir).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
