"""Readers and writers of run records: split plans, validation and retry files, logs, monitor summaries, JSON."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SPLIT = (
    "stats struct<pdfs: map<string, struct<pages:int, size_mb:double, chunks:int, status:string, error:string>>>, "
    "chunks array<struct<path:string, chunk_idx:int, total_chunks:int, start_page:int, end_page:int, pages:int, size_mb:double, original_pdf:string>>, "
    "direct array<struct<pdf_path:string, pdf_name:string>>"
)
RETRY = "attempted_retries long, successful_retries long, permanent_failures array<struct<chunk:string, page:int, error:string>>, skipped_pages array<struct<chunk:string, page:int, error:string, reason:string>>"


def split_plan(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SPLIT).option("multiLine", True).json(path)


def stem(path: Column) -> Column:
    return F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"\.[^.]*$", "")


def planned_documents(plan: DataFrame) -> DataFrame:
    """document, chunks (in order; none for a file that wasn't split) and pages of a split plan."""
    chunks = plan.select(F.explode("chunks").alias("c")).groupBy(stem(F.col("c.original_pdf")).alias("document"))
    whole = chunks.agg(F.array_sort(F.collect_list(F.struct("c.chunk_idx", "c.path", "c.pages"))).alias("chunks"), F.sum("c.pages").alias("pages"))
    direct = plan.select(F.explode("direct").alias("d")).select(stem(F.coalesce("d.pdf_name", "d.pdf_path")).alias("document"))
    kind = whole.schema["chunks"].dataType
    return whole.unionByName(direct.select("document", F.array().cast(kind).alias("chunks"), F.lit(None).cast("long").alias("pages")))


def unsplit(plan: DataFrame) -> DataFrame:
    """Files that couldn't be split, with the error: any of them stops a run."""
    files = plan.select(F.explode("stats.pdfs").alias("document", "info"))
    return files.where("info.status = 'error'").select("document", F.coalesce("info.error", F.lit("")).alias("error"))


def yaml_files(spark: SparkSession, path: str) -> DataFrame:
    """path, name, data (as JSON) and error of YAML files that a path or pattern names, through Spark's own reader."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import yaml

        for batch in batches:
            data, errors = [], []
            for content in batch.column(1):
                try:
                    data.append(json.dumps(yaml.safe_load(content.as_py().decode()), ensure_ascii=False, default=str))
                    errors.append(None)
                except (yaml.YAMLError, UnicodeDecodeError) as e:
                    data.append(None)
                    errors.append(str(e))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(data, pa.string()), pa.array(errors, pa.string())], ["path", "data", "error"])

    files = spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, "path string, data string, error string")
    return files.select("path", stem(F.col("path")).alias("name"), "data", "error")


def validations(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """Validation files exactly one level below a folder, as typed columns; name without its ending."""
    files = yaml_files(spark, f"{folder}/*/*.validation.yaml")
    return files.select(F.regexp_replace("name", r"\.validation$", "").alias("name"), F.from_json("data", schema).alias("v"), "error").select("name", "v.*", "error")


def retries(files: DataFrame) -> DataFrame:
    """What a retry run left (data of yaml_files): counts, 0 where there is none."""
    r = F.from_json("data", RETRY)
    none = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    one = files.select(r.alias("r"))
    size = lambda c: none(F.size(F.coalesce(c, F.slice(c, 1, 0))))
    many = one.select(none(F.col("r.attempted_retries")).alias("attempted"), none(F.col("r.successful_retries")).alias("recovered"), F.greatest(size(F.col("r.permanent_failures")), F.lit(0)).alias("permanent"), F.greatest(size(F.col("r.skipped_pages")), F.lit(0)).alias("skipped"))
    return many.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in many.columns])


def log_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(F.col("value").alias("line"))


def monitor_summary(files: DataFrame, task: str) -> DataFrame:
    """Of summaries (name, data) that of the task, else the newest by name."""
    own = F.contains("name", F.lit(task)).cast("int")
    return files.agg(F.max_by(F.struct("name", "data"), F.struct(own, "name")).alias("f")).where("f IS NOT NULL").select("f.*")


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def append_events(df: DataFrame, path: str) -> None:
    """Adds rows as JSON lines; what is there stays."""
    df.write.mode("append").json(path)
