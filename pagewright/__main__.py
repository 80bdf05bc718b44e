"""Command line: python -m pagewright COMMAND ... (see --help)."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import markdown, text
from .operators import quality, report, sheets
from .plans import catalogue
from .sources import sidecars


def _out(df: DataFrame, path: str | None, rows: int) -> None:
    if path:
        df.write.mode("overwrite").parquet(path)
    else:
        df.show(rows, truncate=80)


def _queries(spark: SparkSession, a: argparse.Namespace) -> None:
    print("\n".join(sorted(catalogue.QUERIES)))


def _run(spark: SparkSession, a: argparse.Namespace) -> None:
    _out(catalogue.QUERIES[a.name](spark, a.tables), a.out, a.rows)


def _sheets(spark: SparkSession, a: argparse.Namespace) -> None:
    _out(sheets.convert(sidecars.markdown_files(spark, a.folder)), a.out, a.rows)


def _clean(spark: SparkSession, a: argparse.Namespace) -> None:
    docs = sidecars.markdown_files(spark, a.folder)
    cleaned = text.clean_sheet(F.col("text")) if a.sheets else text.clean_book(F.col("text"), F.col("name"))
    _out(docs.select("name", cleaned.alias("text")), a.out, a.rows)


def _postprocess(spark: SparkSession, a: argparse.Namespace) -> None:
    docs = sidecars.markdown_files(spark, a.folder).withColumn("json", markdown.remove_json(F.col("text")))
    docs = docs.select("name", markdown.process(F.col("json.text")).alias("text"), F.col("json.fixes").alias("json_fixes"))
    warned = markdown.heading_warnings(F.col("text"))
    _out(docs.select("name", "text", "json_fixes", warned.alias("warnings"), markdown.broken_links(F.col("text")).alias("broken_links")), a.out, a.rows)


def _validate(spark: SparkSession, a: argparse.Namespace) -> None:
    docs = sidecars.markdown_files(spark, a.folder)
    pages = docs.select("name", F.explode(quality.split_pages(F.col("text"))).alias("body")).withColumn("n", F.length("body").cast("long"))
    print(report.quality_report(pages, quality.validate(docs)))


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser("pagewright", description="Document analytics on Spark.")
    commands = top.add_subparsers(required=True)

    def command(name: str, about: str, fn, *arguments: str, out: bool = True) -> argparse.ArgumentParser:
        one = commands.add_parser(name, help=about)
        for x in arguments:
            one.add_argument(x)
        if out:
            one.add_argument("--out", help="write Parquet there instead of showing rows")
            one.add_argument("--rows", type=int, default=20)
        one.set_defaults(fn=fn)
        return one

    command("queries", "list the registered queries", _queries, out=False)
    command("run", "run a registered query over a folder of Parquet tables", _run, "name", "tables")
    command("sheets", "convert the sheets (Markdown) below a folder", _sheets, "folder")
    command("clean", "clean the books (or sheets) below a folder", _clean, "folder").add_argument("--sheets", action="store_true")
    command("postprocess", "JSON, line ends, tables and warnings of Markdown files below a folder", _postprocess, "folder")
    command("validate", "print a quality report of the Markdown files below a folder", _validate, "folder", out=False)
    return top


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    a = parser().parse_args(argv)
    a.fn(spark or SparkSession.builder.appName("pagewright").getOrCreate(), a)


if __name__ == "__main__":
    main()
