"""Documents as wholes: their chunks, expected and present parts, roll-ups that need every part, retries, logs and sections.

Order lines stand for pages of a document (see tables.figures), lines of a text for its pages, events for calls.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as T
from .kqi import INSERTION, figure_kqi, gate_columns, rate
from .tables import FIGURES, LINES, figures, running, table, text_lines

#: Tokens of input that a page is taken to need where they weren't recorded.
INPUT_TOKENS_PER_PAGE = 1500


def chunks_by_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks of each document (texts of a source) in order, each with the number of all of them."""
    docs = table(spark, sf_dir, "documents").select("source", "doc_id", F.size(F.split("text", "\n", -1)).cast("long").alias("pages"))
    out = running(docs, "source", F.col("doc_id"), ["doc_id"], "pages")
    total = docs.groupBy("source").agg(F.count("*").alias("total_chunks"), F.sum("pages").alias("total_pages"))
    return out.join(total, "source").select("source", "doc_id", F.col("number").alias("chunk"), "total_chunks", "pages", "total_pages")


def expected_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of each source that are expected and that have a report, and whether the count is right."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels").select("doc_id", F.lit(1).alias("has"))
    out = docs.join(labels, "doc_id", "left").groupBy("source").agg(F.count("*").alias("expected"), F.count("has").alias("found"))
    return out.withColumns({"missing": F.col("expected") - F.col("found"), "complete": F.col("expected") == F.col("found")})


def document_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each document: its pages, its elements (0 where none are known) and whether it is among the judged ones."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", F.size(F.split("text", "\n", -1)).cast("long").alias("pages"))
    elements = text_lines(table(spark, sf_dir, "documents")).where(F.col("line").contains("|") | F.col("line").contains("$$"))
    elements = elements.groupBy("doc_id").agg(F.count("*").alias("element_pages"))
    judged = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("long").alias("quality"), F.lit(True).alias("judged"))
    out = docs.join(elements, "doc_id", "left").join(judged, "doc_id", "left")
    return out.select("doc_id", "source", "pages", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("element_pages", "quality")], F.coalesce("judged", F.lit(False)).alias("judged"))


def figure_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Figures with the title of the first metadata record of their number, else Untitled."""
    first = table(spark, sf_dir, "part").where("p_size % 4 <> 0").groupBy(F.col("p_size").cast("long").alias("ref")).agg(F.min_by("p_name", "p_partkey").alias("title"))
    figs = figures(table(spark, sf_dir, "lineitem")).select("doc", "page", F.col("part"), (F.col("part") % 60).alias("ref"))
    return figs.join(first, "ref", "left").select("doc", "page", "part", "ref", F.coalesce("title", F.lit("Untitled")).alias("title"))


def recovered_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recovered pages (failed ones with metadata) with what is known of their document."""
    pages = figures(table(spark, sf_dir, "lineitem")).where("NOT ok AND has_meta").select("doc", "page", "part")
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("doc"), "o_orderstatus", "o_custkey")
    return pages.join(orders, "doc")


def complete_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents all of whose chunks have a validation; one missing is enough for none."""
    parts = figures(table(spark, sf_dir, "lineitem")).select("doc", "page", F.when(F.col("has_meta"), F.round(F.col("confidence") * 10).cast("long")).alias("tenths"))
    out = parts.groupBy("doc").agg(F.count("*").alias("chunks"), F.count("tenths").alias("found"), F.sum("tenths").alias("tenths")).where("found = chunks")
    return out.select("doc", "chunks", F.round(F.col("tenths") / (F.col("chunks") * 10), 4).alias("confidence"))


def gate_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What stops a delivery: documents without a report, and reports whose flag is false. A report without a flag (here:
    of a document without metadata) doesn't."""
    reports = figure_kqi(spark, sf_dir).withColumns(gate_columns()).select("doc", F.when(F.col("with_meta") > 0, F.col("overall_pass")).alias("flag"), F.lit(True).alias("there"))
    out = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("doc")).join(reports, "doc", "left")
    finding = F.when(F.col("there").isNull(), "missing").when(~F.col("flag"), "failed")
    return out.withColumn("finding", finding).where("finding IS NOT NULL").select("doc", "finding")


def split_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By batch (order priority): files, those that couldn't be split (status P), and whether the batch has to stop."""
    out = table(spark, sf_dir, "orders").groupBy(F.col("o_orderpriority").alias("batch")).agg(F.count("*").alias("files"), F.count_if(F.col("o_orderstatus") == "P").alias("errors"))
    return out.withColumn("stop", F.col("errors") > 0)


def boundary_pages(spark: SparkSession, sf_dir: str, low: int = 91, high: int = 96) -> DataFrame:
    """The pages around a chunk's end, for reading on both sides of it."""
    lines = text_lines(table(spark, sf_dir, "documents")).where(F.col("line_no").between(low, high))
    return lines.select("doc_id", F.col("line_no").alias("page"), F.col("line").alias("body"))


def failed_pages(detail: DataFrame, page: Column, error: Column) -> DataFrame:
    """Failed pages of a report; entries whose page is no whole number are left out."""
    number = F.when(page.rlike(r"^[+-]?\d{1,9}$"), page.cast("int"))
    return detail.withColumns({"page": number, "error": F.coalesce(error, F.lit(""))}).where("page IS NOT NULL")


def failed_page_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Failed calls as a report's entries; every third one has no usable page."""
    e = table(spark, sf_dir, "events").where("event_type = 'error'")
    entry = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("p"), F.col("user_id"))).otherwise(F.col("user_id").cast("string"))
    return failed_pages(e.withColumn("entry", entry), F.col("entry"), F.get_json_object("props", "$.k")).select("event_id", F.col("page").cast("long").alias("page"), "error")


def document_completion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether a document's output is there and not empty; without a record of progress that is all that counts."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.octet_length("text").cast("long").alias("bytes"))
    state = table(spark, sf_dir, "labels").select("doc_id", (F.col("quality") == 1).alias("valid"))
    return docs.join(state, "doc_id", "left").select("doc_id", F.coalesce("valid", F.coalesce("bytes", F.lit(0)) > 0).alias("complete"))


def table_verify(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of a table's metadata (the figures with metadata) against those in its text (all figures; documents with an
    odd number have none): how many tables agree."""
    figs = figures(table(spark, sf_dir, "lineitem")).groupBy("doc").agg(F.count_if("has_meta").alias("data_rows"), F.count("*").alias("text_rows"))
    text_rows = F.when(F.col("doc") % 2 == 0, F.col("text_rows"))
    status = F.when(F.col("data_rows") == 0, "EMPTY").when(text_rows.isNull(), "PARTIAL").when(F.col("data_rows") == text_rows, "PASS").otherwise("PARTIAL")
    return figs.groupBy(status.alias("status")).agg(F.count("*").alias("tables"))


def retry_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By document class: failed pages, those that were tried again, recovered, failed for good and left out."""
    pages = figures(table(spark, sf_dir, "lineitem")).where("NOT ok")
    skip, good = F.col("level") == "low", F.col("has_meta")
    out = pages.groupBy((F.col("part") % 10).alias("part_class")).agg(F.count("*").alias("failures"), F.count_if(~skip).alias("attempted"), F.count_if(~skip & good).alias("recovered"), F.count_if(~skip & ~good).alias("permanent"), F.count_if(skip).alias("skipped"))
    return out.withColumn("recovery", F.when(F.col("attempted") > 0, F.round(100.0 * F.col("recovered") / F.col("attempted"), 1)).otherwise(F.lit(0.0)))


def page_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of a document's successful pages, and how many failed."""
    figs = figures(table(spark, sf_dir, "lineitem"))
    some = lambda c: F.count_if(F.col("ok") & c)
    return figs.groupBy("doc").agg(some(F.lit(True)).alias("pages"), some(F.col("has_meta")).alias("figures"), some(F.col("level") == "high").alias("sure"), F.coalesce(F.sum(F.when(F.col("ok"), F.col("part"))), F.lit(0)).alias("tokens"), F.count_if(~F.col("ok")).alias("failed"))


def recorded_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens by status of the document, over pages that succeeded: those recorded (where there is metadata), else a page's
    estimate of input and the one sum that there is as output."""
    figs = figures(table(spark, sf_dir, "lineitem")).where("ok").join(table(spark, sf_dir, "orders"), F.col("doc") == F.col("o_orderkey"))
    tokens_in = F.when(F.col("has_meta"), F.col("part")).otherwise(INPUT_TOKENS_PER_PAGE)
    return figs.groupBy("o_orderstatus").agg(F.count("*").alias("pages"), F.sum(tokens_in).alias("tokens_in"), F.sum(F.when(F.col("has_meta"), F.col("page")).otherwise(F.col("part"))).alias("tokens_out"))


def notes(pages: DataFrame, *by: str) -> DataFrame:
    """Notes of pages (an array each), numbered from 1 on every page; empty ones have no number."""
    return pages.select(*by, F.posexplode(F.filter("notes", lambda x: F.length(T.strip(x)) > 0)).alias("at", "text")).select(*by, (F.col("at") + 1).cast("long").alias("id"), "text")


def footnote_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sentences of every page as its notes."""
    lines = text_lines(table(spark, sf_dir, "documents"))
    return notes(lines.select("doc_id", F.col("line_no").alias("page"), F.split("line", r"\. ", -1).alias("notes")), "doc_id", "page")


def footnote_sidecars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One sidecar for every document, with or without notes: version, name, pages and the number of notes."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.size(F.split("text", "\n", -1)).cast("long").alias("total_pages"))
    found = footnote_ids(spark, sf_dir).where(F.col("text").rlike("[0-9]")).groupBy("doc_id").agg(F.count("*").alias("notes"))
    return docs.join(found, "doc_id", "left").select(F.lit("1.0").alias("version"), F.concat(F.lit("doc_"), "doc_id").alias("pdf_name"), "total_pages", F.coalesce("notes", F.lit(0)).alias("notes"))


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calls as lines of a log."""
    e = table(spark, sf_dir, "events")
    line = F.concat(F.lit("Page "), "event_id", F.lit(": "), F.col("user_id") * 10, F.lit("+"), F.pmod("event_id", F.lit(997)), F.lit(" tokens ("), F.pmod("event_id", F.lit(60)), F.lit(".5s)"))
    return e.select("event_id", "event_type", line.alias("line"))


def log_numbers(line: Column) -> Column:
    """What a log line says: tokens in and out (of all its `a+b tokens`), and seconds."""
    pairs = lambda n: F.aggregate(F.regexp_extract_all(line, F.lit(r"(\d+)\+(\d+) tokens"), F.lit(n)), F.lit(0).cast("long"), lambda a, x: a + x.cast("long"))
    seconds = F.transform(F.regexp_extract_all(line, F.lit(r"[(:\s](\d+\.?\d*)s\)?"), F.lit(1)), lambda x: x.cast("double"))
    return F.struct(pairs(1).alias("tokens_in"), pairs(2).alias("tokens_out"), F.get(seconds, F.lit(0)).alias("seconds"))


def log_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = log_lines(spark, sf_dir).select("event_type", log_numbers(F.col("line")).alias("n"))
    return said.groupBy("event_type").agg(F.count("*").alias("calls"), F.sum("n.tokens_in").alias("tokens_in"), F.sum("n.tokens_out").alias("tokens_out"), F.round(F.sum("n.seconds") / F.count("*"), 4).alias("seconds"))


def log_tail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last thousand lines."""
    return log_lines(spark, sf_dir).orderBy(F.desc("event_id")).limit(1000).select("event_id", "line")


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twenty newest runs."""
    orders = table(spark, sf_dir, "orders")
    return orders.orderBy(F.desc("o_orderdate"), F.desc("o_orderkey")).limit(20).select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"), "o_orderstatus")


def skipped_and_processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Skipped pages (already done) before the processed ones, all rows of both."""
    pages = figures(table(spark, sf_dir, "lineitem")).select("doc", "page", "part", "has_meta", "ok")
    skipped = pages.where("has_meta").select("doc", "page", "part", F.lit("skipped").alias("how"))
    return skipped.unionByName(pages.where("NOT has_meta AND ok").select("doc", "page", "part", F.lit("processed").alias("how")))


def row_keys(rows: Column) -> Column:
    """The keys of all rows (maps), sorted, x first."""
    keys = F.array_distinct(F.flatten(F.transform(rows, F.map_keys)))
    rest = F.array_sort(F.array_remove(keys, "x"))
    return F.when(F.array_contains(keys, "x"), F.concat(F.array(F.lit("x")), rest)).otherwise(rest)


def metadata_table(rows: Column) -> Column:
    """Rows (maps of texts) as a Markdown table; null without rows. Whole numbers lose their fraction."""
    columns = row_keys(rows)
    cell = lambda row, c: F.coalesce(F.regexp_replace(F.element_at(row, c), r"^(-?\d+)\.0+$", "$1"), F.lit(""))
    line = lambda cells: F.concat(F.lit("| "), F.array_join(cells, " | "), F.lit(" |"))
    rule = F.concat(F.lit("|"), F.array_join(F.transform(columns, lambda _: F.lit("---")), "|"), F.lit("|"))
    body = F.transform(rows, lambda row: line(F.transform(columns, lambda c: cell(row, c))))
    return F.when(F.size(rows) > 0, F.array_join(F.concat(F.array(line(columns), rule), body), "\n"))


def data_rows(series: Column) -> Column:
    """Rows of a data series (structs with data_points, which may be null): points where the first entry has them, else entries."""
    first = F.get(series, F.lit(0))["data_points"]
    points = F.aggregate(series, F.lit(0), lambda a, x: a + F.coalesce(F.size(x["data_points"]), F.lit(0)))
    return F.when(F.coalesce(F.size(series), F.lit(0)) <= 0, 0).when(first.isNotNull(), points).otherwise(F.size(series)).cast("long")


def metadata_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as rows of a table: quantity as x, the price under the line's status, some without a value."""
    line = table(spark, sf_dir, "lineitem")
    row = F.map_filter(F.create_map(F.lit("x"), F.col("l_quantity").cast("string"), F.lit("page"), F.col("l_linenumber").cast("string"), F.concat(F.lit("part_"), "l_linestatus"), F.when(F.col("l_linenumber") != 2, F.col("l_partkey").cast("string"))), lambda _, v: v.isNotNull())
    key = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    rows = line.groupBy(F.col("l_orderkey").alias("doc")).agg(F.collect_list(F.struct(key.alias("k"), row.alias("row"))).alias("rows"))
    ordered = F.transform(F.array_sort("rows", lambda a, b: F.when(a["k"] < b["k"], -1).when(a["k"] > b["k"], 1).otherwise(0)), lambda x: x["row"])
    return rows.select("doc", metadata_table(ordered).alias("markdown"))


def normalized_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of parts as chunk files."""
    part = table(spark, sf_dir, "part")
    name = F.concat(F.replace("p_name", F.lit(" "), F.lit("_")), F.lit("_part"), F.col("p_size"), F.lit("of50_chunk"), F.col("p_partkey") % 7)
    return part.select("p_partkey", T.normalized_name(name).alias("name"))


def duration_long(seconds: Column) -> Column:
    """Hours, minutes and seconds; what is 0 in front is left out."""
    h, m, s = F.floor(seconds / 3600), F.floor(seconds % 3600 / 60), F.floor(seconds % 60)
    part = lambda x, unit: F.concat(x.cast("long").cast("string"), F.lit(unit))
    return F.when(h > 0, F.concat_ws(" ", part(h, "h"), part(m, "m"), part(s, "s"))).when(m > 0, F.concat_ws(" ", part(m, "m"), part(s, "s"))).otherwise(part(s, "s"))


def elapsed(started: Column, ended: Column) -> Column:
    """Whole seconds between two ISO stamps, never below 0; 0 where one is missing or none."""
    micros = lambda x: F.unix_micros(F.try_to_timestamp(x))
    return F.greatest(F.coalesce(F.floor((micros(ended) - micros(started)) / 1000000), F.lit(0)), F.lit(0)).cast("long")


def durations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By key: the time from its first to its last call, from ISO stamps, written in both ways."""
    e = table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("key")).agg(F.min("ts").alias("a"), F.max("ts").alias("b"))
    iso = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
    e = e.withColumn("seconds", elapsed(iso("a"), iso("b")) % 100000)
    return e.select("key", "seconds", T.duration(F.col("seconds")).alias("short"), duration_long(F.col("seconds")).alias("long"))


def response_text(c: Column) -> Column:
    """The text of a response (JSON), whatever shape its content has: a text, an object with a text, or a list of either."""
    content = F.try_variant_get(F.try_parse_json(c), "$.output.choices[0].message.content", "variant")
    kind = F.schema_of_variant(content)
    get = lambda path: F.try_variant_get(content, path, "string")
    out = F.when(kind == "STRING", get("$")).when(F.startswith(kind, F.lit("OBJECT")), F.coalesce(get("$.text"), get("$")))
    out = out.when(F.startswith(kind, F.lit("ARRAY")), F.when(F.startswith(F.schema_of_variant(F.try_variant_get(content, "$[0]", "variant")), F.lit("OBJECT")), get("$[0].text")).otherwise(get("$[0]")))
    return F.coalesce(out, F.lit(""))


def response_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns wrapped as responses of five shapes, the last without any choice."""
    conv = table(spark, sf_dir, "conversations").select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text", F.pmod(F.col("conv_id") + F.col("turn"), F.lit(5)).alias("shape"))
    quoted = F.to_json(F.struct(F.col("text")))
    content = F.when(F.col("shape") == 0, F.get_json_object(F.to_json(F.struct(F.array("text").alias("a"))), "$.a")).when(F.col("shape") == 1, F.concat(F.lit("["), quoted, F.lit("]"))).when(F.col("shape") == 2, quoted)
    one = F.regexp_extract(F.get_json_object(F.to_json(F.struct(F.array("text").alias("a"))), "$.a"), r"(?s)^\[(.*)\]$", 1)
    content = content.when(F.col("shape") == 3, one)
    response = F.when(F.col("shape") == 4, F.lit('{"output": {"choices": []}}')).otherwise(F.concat(F.lit('{"output": {"choices": [{"message": {"content": '), content, F.lit("}}]}}")))
    return conv.select("conv_id", "turn", "role", response_text(response).alias("text"))


def page_section(page: Column, body: Column, tables: Column, formulas: Column, figs: Column) -> Column:
    """A page of the document: heading, text, tables (number, caption, markdown), formulas and figures (ref, title,
    description, file)."""
    some = lambda c: F.length(T.strip(F.coalesce(c, F.lit("")))) > 0
    part = lambda c: F.when(some(c), F.concat(c, F.lit("\n\n"))).otherwise(F.lit(""))
    each = lambda items, fn: F.array_join(F.transform(items, fn), "")
    one_table = lambda t: F.concat(F.when(some(F.concat(t["number"], t["caption"])), F.concat(F.lit("### "), t["number"], F.lit(": "), t["caption"], F.lit("\n\n"))).otherwise(F.lit("")), part(t["markdown"]))
    number = F.lpad(page.cast("string"), 3, "0")
    named = lambda f: F.concat(f["ref"], F.lit(": "), f["title"])
    one_figure = lambda f: F.concat(
        F.lit("\n### "), named(f), F.lit("\n\n"), F.when(some(f["description"]), F.concat(F.lit("*"), f["description"], F.lit("*\n\n"))).otherwise(F.lit("")),
        F.lit("!["), named(f), F.lit("](images/page_"), number, F.lit(".png)\n\n"),
        F.when(some(f["file"]), F.concat(F.lit("*YAML Metadata: [yaml_metadata/"), f["file"], F.lit("](yaml_metadata/"), f["file"], F.lit(")*\n\n"))).otherwise(F.lit("")),
    )
    return F.concat(F.lit("## Page "), page.cast("string"), F.lit("\n\n"), part(T.strip(body)), each(tables, one_table), each(formulas, part), each(figs, one_figure))


def page_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as pages: every fifth has a table, every seventh a formula, every third a figure."""
    lines = text_lines(table(spark, sf_dir, "documents"))
    page = F.col("line_no")
    only = lambda every, item: F.when(page % every == 0, F.array(item)).otherwise(F.slice(F.array(item), 1, 0))
    tables = only(5, F.struct(F.concat(F.lit("T"), page).alias("number"), F.col("lang").alias("caption"), F.lit("| a |").alias("markdown")))
    ref = F.concat(F.lit("Fig_"), page)
    figs = only(3, F.struct(ref.alias("ref"), F.col("source").alias("title"), F.when(page % 2 == 0, "seen").otherwise("").alias("description"), F.concat(ref, F.lit("_page"), page, F.lit(".yaml")).alias("file")))
    return lines.select("doc_id", page.alias("page"), F.md5(page_section(page, F.col("line"), tables, only(7, F.lit("$$x$$")), figs)).alias("section"))


def markdown_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document's file: name, stamp, model, statistics, a note where there are notes, rule and pages, as a digest."""
    docs = table(spark, sf_dir, "documents")
    pages = F.transform(F.split("text", "\n", -1), lambda x, i: F.concat(F.lit("## Page "), (i + 1).cast("string"), F.lit("\n\n"), x, F.lit("\n\n")))
    tables = F.size(F.filter(F.split("text", "\n", -1), lambda x: x.contains("|")))
    head = F.concat(F.lit("# doc_"), "doc_id", F.lit("\n\n*Processed on 2024-01-01*\n\n*Model: "), "source", F.lit("*\n\n*Statistics: "), tables, F.lit(" tables*\n\n"), F.when(F.col("doc_id") % 4 == 0, "*Footnotes: sidecar*\n\n").otherwise(""), F.lit("---\n\n"))
    return docs.select("doc_id", F.md5(F.concat(head, F.array_join(pages, "\n"))).alias("digest"))


#: A prompt's text is the caller's; what stands in braces is filled in.
PROMPT = "Describe page {page} of {pages}. Before: {before} Text: {text} After: {after}"
PROMPT_CHART = "Describe the charts of page {page} of {pages}. Before: {before} After: {after}"


def filled(template: Column, values: dict[str, Column]) -> Column:
    for name, value in values.items():
        template = F.replace(template, F.lit("{" + name + "}"), value)
    return template


def prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A turn's prompt: with its text, or for a chart (every fourth) without it. Values that hold braces stay as they are."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    conv = table(spark, sf_dir, "conversations").select("conv_id", F.col("turn").cast("long").alias("turn"), "role", F.lag("role").over(order).alias("before"), F.length("text").cast("string").alias("text"), F.lead("role").over(order).alias("after"))
    template = F.when(F.col("turn") % 4 == 0, PROMPT_CHART).otherwise(PROMPT)
    values = {"page": (F.col("turn") + 1).cast("string"), "pages": F.lit("9"), "before": F.coalesce("before", F.lit("N/A")), "text": F.col("text"), "after": F.coalesce("after", F.lit("N/A"))}
    return conv.select("conv_id", "turn", "role", filled(template, values).alias("prompt"))


def sidecar_findings(c: Column) -> Column:
    """What is wrong with a footnote sidecar, as JSON: not a mapping, fields that are missing, notes that aren't a list."""
    v = F.try_parse_json(c)
    kind = F.schema_of_variant(v)
    has = lambda name: F.schema_of_variant(F.try_variant_get(v, f"$.{name}", "variant"))
    missing = lambda name: F.when(has(name).isNull(), F.lit(f"missing {name}"))
    notes_ = F.when(~F.startswith(F.coalesce(has("notes"), F.lit("")), F.lit("ARRAY")), F.lit("notes is not a list"))
    inside = F.filter(F.array(missing("version"), missing("pdf_name"), notes_), lambda x: x.isNotNull())
    return F.when(v.isNull(), F.array(F.lit("cannot be read"))).when(~F.startswith(kind, F.lit("OBJECT")), F.array(F.lit("not a mapping"))).otherwise(inside)


_SIDECARS = ['{"version": "1.0", "pdf_name": "a", "notes": []}', '{"version": "1.0", "notes": [1]}', '{"pdf_name": "a", "notes": {}}', "[1, 2]", '{"version": ', "{}"]


def sidecar_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six kinds of sidecars, one to a document, and what is wrong with them, by source."""
    docs = table(spark, sf_dir, "documents")
    sidecar = F.element_at(F.array(*map(F.lit, _SIDECARS)), (F.pmod("doc_id", F.lit(6)) + 1).cast("int"))
    return docs.select("source", F.explode(sidecar_findings(sidecar)).alias("finding")).groupBy("source", "finding").agg(F.count("*").alias("sidecars"))


def structural_kqi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where no validation is there, a document complies if it has a sidecar, a title and page headings; strict if any is."""
    docs = table(spark, sf_dir, "documents")
    judged = table(spark, sf_dir, "labels").select("doc_id", F.lit(True).alias("has_yaml"))
    lead = F.when(F.col("doc_id") % 3 != 0, F.concat(F.lit("# doc_"), "doc_id", F.lit("\n\n"))).otherwise(F.lit(""))
    page = F.when(F.col("doc_id") % 5 != 0, F.lit("## Page 1\n\n")).otherwise(F.lit(""))
    files = docs.join(judged, "doc_id", "left").select("lang", F.coalesce("has_yaml", F.lit(False)).alias("has_yaml"), F.concat(lead, page, "text").alias("md"))
    title, pages = F.col("md").rlike(r"(?m)^# "), F.col("md").rlike(r"(?m)^## Page")
    out = files.groupBy("lang").agg(F.count("*").alias("files"), F.count_if(F.col("has_yaml") & title & pages).alias("compliant"), F.count_if(~F.col("has_yaml")).alias("no_yaml"), F.count_if(~title).alias("no_title"), F.count_if(~pages).alias("no_pages"))
    return out.select("*", F.round(100.0 * F.col("compliant") / F.col("files"), 1).alias("compliance"), F.when(F.col("no_yaml") < F.col("files"), "strict").otherwise("structural").alias("mode"))


def validation_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reports after a retry: pages that succeeded now leave the failed ones, the others stay with their new error; the rates follow."""
    pages = figures(table(spark, sf_dir, "lineitem"))
    retried = pages.where("NOT ok AND level <> 'low'").groupBy("doc").agg(F.count("*").alias("tried"), F.count_if("has_meta").alias("now_ok"))
    base = pages.groupBy("doc").agg(F.count("*").alias("pages"), F.count_if("ok").alias("good"))
    out = base.join(retried, "doc", "left").withColumn("good", F.col("good") + F.coalesce("now_ok", F.lit(0)))
    return out.select("doc", "pages", "good", (F.col("pages") - F.col("good")).alias("failed"), rate(F.col("good"), F.col("pages")).alias("success_rate"), F.coalesce(F.col("tried") > 0, F.lit(False)).alias("updated"))


def status_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A line for each status, as people read it."""
    orders = table(spark, sf_dir, "orders").groupBy("o_orderstatus").agg(F.count("*").alias("n"), F.count_if(F.col("o_totalprice") > 100000).alias("done"))
    share = F.format_string("%d", F.floor(100 * F.col("done") / F.col("n")))
    return orders.select("o_orderstatus", F.concat(F.col("o_orderstatus"), F.lit(": "), F.col("done"), F.lit("/"), F.col("n"), F.lit(" ("), share, F.lit("%)")).alias("line"))


def cost_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON object for each status of documents: pages, tokens and cost in hundredths."""
    cost = recorded_cost(spark, sf_dir).withColumn("cents", F.floor((F.col("tokens_in") + F.col("tokens_out")) * 2 / 1000))
    return cost.select("o_orderstatus", F.to_json(F.struct("pages", "tokens_in", "tokens_out", "cents")).alias("summary"))


def validation_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document's validation as JSON: name, rate and findings."""
    k = figure_kqi(spark, sf_dir)
    findings = F.filter(F.array(F.when(F.col("insertion_rate") < INSERTION, "insertion"), F.when(F.col("ok_pages") < F.col("figures"), "pages")), lambda x: x.isNotNull())
    return k.select("doc", F.to_json(F.struct("doc", "figures", findings.alias("findings"))).alias("report"))


def monitor_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each key the summary of its own task (type purchase) if there is one, else its newest."""
    e = table(spark, sf_dir, "events")
    own = F.max_by("event_id", F.struct((F.col("event_type") == "purchase").cast("int"), "event_id"))
    return e.groupBy("user_id").agg(own.alias("event_id"), F.bool_or(F.col("event_type") == "purchase").alias("own"))


QUERIES = {
    f.__name__: f
    for f in (
        chunks_by_document, expected_reports, document_report, figure_titles, recovered_pages, complete_rollup, gate_findings, split_guard, boundary_pages, failed_page_list, document_completion,
        table_verify, retry_summary, page_totals, recorded_cost, footnote_ids, footnote_sidecars, log_tokens, log_tail, history, skipped_and_processed, metadata_tables, normalized_names, durations,
        response_texts, page_sections, markdown_documents, prompts, sidecar_schema, structural_kqi, validation_updates, status_text, cost_summary, validation_json, monitor_summary,
    )
}

_KQI = f"SELECT doc, count(*) AS figures, count(*) FILTER (has_meta) AS with_meta, count(*) FILTER (ok) AS ok_pages, CAST(sum(CAST(round(confidence * 10) AS BIGINT)) AS BIGINT) AS tenths FROM {FIGURES} GROUP BY doc"
_SECONDS = "SELECT user_id AS key, greatest(epoch(date_trunc('second', max(ts)) - date_trunc('second', min(ts)))::BIGINT, 0) % 100000 AS seconds FROM events GROUP BY 1"
_SOME = lambda c: f"length(regexp_replace({c}, '[\\s\\p{{Z}}]', '', 'g')) > 0"
_COST = f"""SELECT o_orderstatus, count(*) AS pages, CAST(sum(CASE WHEN has_meta THEN part ELSE {INPUT_TOKENS_PER_PAGE} END) AS BIGINT) AS tokens_in,
    CAST(sum(CASE WHEN has_meta THEN page ELSE part END) AS BIGINT) AS tokens_out FROM {FIGURES} JOIN orders ON doc = o_orderkey WHERE ok GROUP BY 1"""
_NOTES = rf"(SELECT doc_id, line_no AS page, list_filter(string_split(line, '. '), lambda x: {_SOME('x')}) AS s FROM {LINES})"
_NOTE_IDS = f"SELECT doc_id, page, CAST(generate_subscripts(s, 1) AS BIGINT) AS id, unnest(s) AS text FROM {_NOTES}"
_LOG = "'Page ' || event_id || ': ' || user_id * 10 || '+' || event_id % 997 || ' tokens (' || event_id % 60 || '.5s)'"
ORACLES = {
    "chunks_by_document": """WITH d AS (SELECT source, doc_id, CAST(len(string_split(text, chr(10))) AS BIGINT) AS pages FROM documents)
        SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS chunk, count(*) OVER (PARTITION BY source) AS total_chunks, pages, CAST(sum(pages) OVER (PARTITION BY source) AS BIGINT) AS total_pages FROM d""",
    "expected_reports": "SELECT source, count(*) AS expected, count(l.doc_id) AS found, count(*) - count(l.doc_id) AS missing, count(*) = count(l.doc_id) AS complete FROM documents d LEFT JOIN labels l USING (doc_id) GROUP BY 1",
    "document_report": f"""SELECT d.doc_id, source, CAST(len(string_split(text, chr(10))) AS BIGINT) AS pages, coalesce(n, 0) AS element_pages, CAST(coalesce(quality, 0) AS BIGINT) AS quality, l.doc_id IS NOT NULL AS judged
        FROM documents d LEFT JOIN (SELECT doc_id, count(*) AS n FROM {LINES} WHERE contains(line, '|') OR contains(line, '$$') GROUP BY 1) USING (doc_id) LEFT JOIN labels l ON l.doc_id = d.doc_id""",
    "figure_titles": f"""SELECT doc, page, part, part % 60 AS ref, coalesce(title, 'Untitled') AS title FROM {FIGURES} LEFT JOIN
        (SELECT CAST(p_size AS BIGINT) AS r, arg_min(p_name, p_partkey) AS title FROM part WHERE p_size % 4 <> 0 GROUP BY 1) ON part % 60 = r""",
    "recovered_pages": f"SELECT doc, page, part, o_orderstatus, o_custkey FROM {FIGURES} JOIN orders ON doc = o_orderkey WHERE NOT ok AND has_meta",
    "complete_rollup": f"SELECT doc, count(*) AS chunks, round(sum(CAST(round(confidence * 10) AS BIGINT))::DOUBLE / (count(*) * 10), 4) AS confidence FROM {FIGURES} GROUP BY doc HAVING bool_and(has_meta)",
    "gate_findings": f"""SELECT o_orderkey AS doc, CASE WHEN k.doc IS NULL THEN 'missing' ELSE 'failed' END AS finding FROM orders LEFT JOIN ({_KQI}) k ON k.doc = o_orderkey
        WHERE k.doc IS NULL OR (with_meta > 0 AND NOT (round(with_meta::DOUBLE / figures, 4) >= 0.95 AND round(tenths::DOUBLE / (figures * 10), 4) >= 0.85 AND round(ok_pages::DOUBLE / figures, 4) >= 0.95))""",
    "split_guard": "SELECT o_orderpriority AS batch, count(*) AS files, count(*) FILTER (o_orderstatus = 'P') AS errors, count(*) FILTER (o_orderstatus = 'P') > 0 AS stop FROM orders GROUP BY 1",
    "boundary_pages": f"SELECT doc_id, line_no AS page, line AS body FROM {LINES} WHERE line_no BETWEEN 91 AND 96",
    "failed_page_list": "SELECT event_id, CAST(user_id AS BIGINT) AS page, coalesce(json_extract_string(props, '$.k'), '') AS error FROM events WHERE event_type = 'error' AND event_id % 3 <> 0",
    "document_completion": "SELECT d.doc_id, coalesce(quality = 1, coalesce(strlen(text), 0) > 0) AS complete FROM documents d LEFT JOIN labels l USING (doc_id)",
    "table_verify": f"""SELECT CASE WHEN d = 0 THEN 'EMPTY' WHEN doc % 2 = 1 THEN 'PARTIAL' WHEN d = t THEN 'PASS' ELSE 'PARTIAL' END AS status, count(*) AS tables
        FROM (SELECT doc, count(*) FILTER (has_meta) AS d, count(*) AS t FROM {FIGURES} GROUP BY doc) GROUP BY 1""",
    "retry_summary": f"""SELECT *, CASE WHEN attempted > 0 THEN round(100.0::DOUBLE * recovered / attempted, 1) ELSE 0 END AS recovery FROM (SELECT part % 10 AS part_class, count(*) AS failures, count(*) FILTER (level <> 'low') AS attempted,
        count(*) FILTER (level <> 'low' AND has_meta) AS recovered, count(*) FILTER (level <> 'low' AND NOT has_meta) AS permanent, count(*) FILTER (level = 'low') AS skipped FROM {FIGURES} WHERE NOT ok GROUP BY 1)""",
    "page_totals": f"""SELECT doc, count(*) FILTER (ok) AS pages, count(*) FILTER (ok AND has_meta) AS figures, count(*) FILTER (ok AND level = 'high') AS sure, CAST(coalesce(sum(part) FILTER (ok), 0) AS BIGINT) AS tokens,
        count(*) FILTER (NOT ok) AS failed FROM {FIGURES} GROUP BY doc""",
    "recorded_cost": _COST,
    "footnote_ids": _NOTE_IDS,
    "footnote_sidecars": f"""SELECT '1.0' AS version, 'doc_' || d.doc_id AS pdf_name, CAST(len(string_split(text, chr(10))) AS BIGINT) AS total_pages, coalesce(n, 0) AS notes FROM documents d LEFT JOIN
        (SELECT doc_id, count(*) AS n FROM ({_NOTE_IDS}) WHERE regexp_matches(text, '[0-9]') GROUP BY 1) USING (doc_id)""",
    "log_tokens": "SELECT event_type, count(*) AS calls, CAST(sum(user_id * 10) AS BIGINT) AS tokens_in, CAST(sum(event_id % 997) AS BIGINT) AS tokens_out, round(sum(event_id % 60 + 0.5::DOUBLE) / count(*), 4) AS seconds FROM events GROUP BY 1",
    "log_tail": f"SELECT event_id, {_LOG} AS line FROM events ORDER BY event_id DESC LIMIT 1000",
    "history": "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day, o_orderstatus FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 20",
    "skipped_and_processed": f"SELECT doc, page, part, CASE WHEN has_meta THEN 'skipped' ELSE 'processed' END AS how FROM {FIGURES} WHERE has_meta OR ok",
    "metadata_tables": """WITH r AS (SELECT l_orderkey AS doc, list({'n': l_linenumber, 'p': l_partkey, 's': l_linestatus, 'q': CAST(l_quantity AS BIGINT)} ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS rows,
            bool_or(l_linestatus = 'F' AND l_linenumber <> 2) AS f, bool_or(l_linestatus = 'O' AND l_linenumber <> 2) AS o FROM lineitem GROUP BY 1)
        SELECT doc, '| x | page' || CASE WHEN f THEN ' | part_F' ELSE '' END || CASE WHEN o THEN ' | part_O' ELSE '' END || ' |' || chr(10) || '|---|---' || CASE WHEN f THEN '|---' ELSE '' END || CASE WHEN o THEN '|---' ELSE '' END || '|' || chr(10) ||
            array_to_string(list_transform(rows, lambda x: '| ' || x.q || ' | ' || x.n || CASE WHEN f THEN ' | ' || CASE WHEN x.s = 'F' AND x.n <> 2 THEN CAST(x.p AS VARCHAR) ELSE '' END ELSE '' END ||
                CASE WHEN o THEN ' | ' || CASE WHEN x.s = 'O' AND x.n <> 2 THEN CAST(x.p AS VARCHAR) ELSE '' END ELSE '' END || ' |'), chr(10)) AS markdown FROM r""",
    "normalized_names": "SELECT p_partkey, lower(regexp_replace(p_name, '[-_ ]', '', 'g')) AS name FROM part",
    "durations": f"""SELECT key, seconds, CASE WHEN seconds < 60 THEN seconds || 's' WHEN seconds < 3600 THEN seconds // 60 || 'm ' || seconds % 60 || 's' ELSE seconds // 3600 || 'h ' || seconds % 3600 // 60 || 'm' END AS short,
        CASE WHEN seconds >= 3600 THEN seconds // 3600 || 'h ' || seconds % 3600 // 60 || 'm ' || seconds % 60 || 's' WHEN seconds >= 60 THEN seconds // 60 || 'm ' || seconds % 60 || 's' ELSE seconds || 's' END AS long FROM ({_SECONDS})""",
    "response_texts": "SELECT conv_id, CAST(turn AS BIGINT) AS turn, role, CASE WHEN (conv_id + turn) % 5 = 4 THEN '' ELSE text END AS text FROM conversations",
    "page_sections": rf"""WITH p AS (SELECT *, regexp_replace(line, '^[\s\p{{Z}}]+|[\s\p{{Z}}]+$', '', 'g') AS t, chr(10) || chr(10) AS b, 'Fig_' || line_no AS r FROM {LINES})
        SELECT doc_id, line_no AS page, md5('## Page ' || line_no || b || CASE WHEN t <> '' THEN t || b ELSE '' END || CASE WHEN line_no % 5 = 0 THEN '### T' || line_no || ': ' || lang || b || '| a |' || b ELSE '' END
            || CASE WHEN line_no % 7 = 0 THEN '$$x$$' || b ELSE '' END || CASE WHEN line_no % 3 = 0 THEN chr(10) || '### ' || r || ': ' || source || b || CASE WHEN line_no % 2 = 0 THEN '*seen*' || b ELSE '' END
            || '![' || r || ': ' || source || '](images/page_' || lpad(CAST(line_no AS VARCHAR), 3, '0') || '.png)' || b || '*YAML Metadata: [yaml_metadata/' || r || '_page' || line_no || '.yaml](yaml_metadata/' || r || '_page' || line_no || '.yaml)*' || b ELSE '' END) AS section FROM p""",
    "markdown_documents": f"""WITH p AS (SELECT doc_id, string_agg('## Page ' || line_no || chr(10) || chr(10) || line || chr(10) || chr(10), chr(10) ORDER BY line_no) AS pages, count(*) FILTER (contains(line, '|')) AS tables FROM {LINES} GROUP BY 1)
        SELECT doc_id, md5('# doc_' || doc_id || b || '*Processed on 2024-01-01*' || b || '*Model: ' || source || '*' || b || '*Statistics: ' || tables || ' tables*' || b || CASE WHEN doc_id % 4 = 0 THEN '*Footnotes: sidecar*' || b ELSE '' END || '---' || b || pages) AS digest
        FROM (SELECT doc_id, source, chr(10) || chr(10) AS b FROM documents) JOIN p USING (doc_id)""",
    "prompts": """SELECT conv_id, CAST(turn AS BIGINT) AS turn, role, CASE WHEN turn % 4 = 0 THEN 'Describe the charts of page ' || turn + 1 || ' of 9. Before: ' || b ELSE 'Describe page ' || turn + 1 || ' of 9. Before: ' || b || ' Text: ' || length(text) END || ' After: ' || a AS prompt
        FROM (SELECT *, coalesce(lag(role) OVER w, 'N/A') AS b, coalesce(lead(role) OVER w, 'N/A') AS a FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text))""",
    "sidecar_schema": """SELECT source, f AS finding, count(*) AS sidecars FROM (SELECT source, unnest(CASE doc_id % 6 WHEN 0 THEN [] WHEN 1 THEN ['missing pdf_name'] WHEN 2 THEN ['missing version', 'notes is not a list'] WHEN 3 THEN ['not a mapping']
        WHEN 4 THEN ['cannot be read'] ELSE ['missing version', 'missing pdf_name', 'notes is not a list'] END) AS f FROM documents) GROUP BY 1, 2""",
    "structural_kqi": """SELECT *, round(100.0::DOUBLE * compliant / files, 1) AS compliance, CASE WHEN no_yaml < files THEN 'strict' ELSE 'structural' END AS mode FROM (SELECT lang, count(*) AS files, count(*) FILTER (l.doc_id IS NOT NULL AND d.doc_id % 3 <> 0 AND d.doc_id % 5 <> 0) AS compliant,
        count(*) FILTER (l.doc_id IS NULL) AS no_yaml, count(*) FILTER (d.doc_id % 3 = 0) AS no_title, count(*) FILTER (d.doc_id % 5 = 0) AS no_pages FROM documents d LEFT JOIN labels l USING (doc_id) GROUP BY 1)""",
    "validation_updates": f"""SELECT doc, pages, good, pages - good AS failed, round(good::DOUBLE / pages, 4) AS success_rate, tried > 0 AS updated FROM (SELECT doc, count(*) AS pages,
        count(*) FILTER (ok OR (level <> 'low' AND has_meta)) AS good, count(*) FILTER (NOT ok AND level <> 'low') AS tried FROM {FIGURES} GROUP BY doc)""",
    "status_text": "SELECT o_orderstatus, o_orderstatus || ': ' || count(*) FILTER (o_totalprice > 100000) || '/' || count(*) || ' (' || 100 * count(*) FILTER (o_totalprice > 100000) // count(*) || '%)' AS line FROM orders GROUP BY 1",
    "cost_summary": f"""SELECT o_orderstatus, '{{"pages":' || pages || ',"tokens_in":' || tokens_in || ',"tokens_out":' || tokens_out || ',"cents":' || (tokens_in + tokens_out) * 2 // 1000 || '}}' AS summary FROM ({_COST})""",
    "validation_json": f"""SELECT doc, '{{"doc":' || doc || ',"figures":' || figures || ',"findings":[' || array_to_string(list_filter([CASE WHEN round(with_meta::DOUBLE / figures, 4) < {INSERTION} THEN '"insertion"' END,
        CASE WHEN ok_pages < figures THEN '"pages"' END], lambda x: x IS NOT NULL), ',') || ']}}' AS report FROM ({_KQI})""",
    "monitor_summary": "SELECT user_id, coalesce(max(event_id) FILTER (event_type = 'purchase'), max(event_id)) AS event_id, bool_or(event_type = 'purchase') AS own FROM events GROUP BY 1",
}
