"""YAML sidecars as a Spark data source: one row per file read, one file per row written.

    spark.dataSource.register(SidecarSource)
    spark.read.format("sidecar").option("path", folder).load()

Paths are local to all machines (a shared mount). A file that can't be parsed gives a row with its error instead of data.
"""

from __future__ import annotations

import glob
import json
import os
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

SCHEMA = "path string, name string, data string, error string, bytes long"


class _Files(InputPartition):
    def __init__(self, paths: list[str]):
        self.paths = paths


class SidecarReader(DataSourceReader):
    def __init__(self, options: dict):
        self.folder = options["path"]
        self.skip = options.get("exclude", "VALIDATION_REPORT")
        self.per_task = int(options.get("filespertask", 500))

    def partitions(self) -> list[InputPartition]:
        found = sorted(glob.glob(os.path.join(self.folder, "**", "*.yaml"), recursive=True))
        found = [f for f in found if not os.path.basename(f).startswith(self.skip)]
        return [_Files(found[i : i + self.per_task]) for i in range(0, len(found), self.per_task)] or [_Files([])]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        import yaml

        for path in partition.paths:
            data = error = None
            try:
                with open(path, encoding="utf-8") as f:
                    data = json.dumps(yaml.safe_load(f), ensure_ascii=False, default=str)
            except (yaml.YAMLError, UnicodeDecodeError) as e:
                error = str(e)
            yield path, os.path.basename(path).removesuffix(".yaml"), data, error, os.path.getsize(path)


class SidecarWriter(DataSourceWriter):
    def __init__(self, options: dict):
        self.folder = options["path"]

    def write(self, iterator: Iterator) -> WriterCommitMessage:
        import yaml

        os.makedirs(self.folder, exist_ok=True)
        for row in iterator:
            # Written aside and moved into place, so that a retried task leaves whole files only.
            target = os.path.join(self.folder, f"{row.name}.yaml")
            aside = f"{target}.{os.getpid()}.tmp"
            with open(aside, "w", encoding="utf-8") as f:
                yaml.safe_dump(json.loads(row.data), f, allow_unicode=True, sort_keys=False)
            os.replace(aside, target)
        return WriterCommitMessage()


class SidecarSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "sidecar"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        return SidecarReader(self.options)

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return SidecarWriter(self.options)


def markdown_files(spark: SparkSession, folder: str, skip: str = "QUALITY_REPORT") -> DataFrame:
    """name and text of all Markdown files below a folder, through Spark's own reader."""
    files = spark.read.text(folder, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.md")
    name = F.regexp_replace(F.element_at(F.split("_metadata.file_path", "/"), -1), r"\.md$", "")
    return files.select(name.alias("name"), F.col("value").alias("text")).where(~F.startswith("name", F.lit(skip)))


def pdf_files(spark: SparkSession, folder: str) -> DataFrame:
    """Path, size and time of PDFs below a folder; their bytes only where asked for."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.pdf").load(folder)


def batch_reports(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """Batch reports, each once."""
    return spark.read.schema(schema).option("multiLine", True).option("recursiveFileLookup", True).option("pathGlobFilter", "batch_report_*.json").json(folder).dropDuplicates()


def write_markdown(docs: DataFrame, folder: str) -> None:
    """One text file per document, below a folder of its name."""
    docs.select("name", F.col("document").alias("value")).write.partitionBy("name").mode("overwrite").text(folder)


def delivery(files: DataFrame) -> DataFrame:
    """name, document, file of documents' files -> the Markdown, figures and notes to deliver, with their new names.

    Of several, the first by name; all-figures sidecars before other sidecars."""
    from pyspark.sql import Window

    from ..functions.text import short_name

    kind = F.when(F.endswith("file", F.lit(".md")), "text").when(F.endswith("file", F.lit(".footnotes.yaml")), "notes").when(F.endswith("file", F.lit(".yaml")) & ~F.contains("file", F.lit(".validation.")), "figures")
    rank = F.row_number().over(Window.partitionBy("document", "kind").orderBy(~F.endswith("file", F.lit("_all_figures.yaml")), "file"))
    end = F.when(F.col("kind") == "text", ".md").when(F.col("kind") == "notes", ".footnotes.yaml").otherwise(".yaml")
    out = files.withColumn("kind", kind).where("kind IS NOT NULL").withColumn("rank", rank).where("rank = 1")
    return out.select("document", "kind", "file", F.concat(short_name(F.col("document")), end).alias("delivered"))
