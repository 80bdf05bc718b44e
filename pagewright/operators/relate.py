"""Lines, pages and names as relations: contexts, paragraphs, offsets, gaps, splits, upserts and matches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as T
from .tables import FIGURES, LINES, figures, running, table, text_lines

# What hints at a chart; text budgets of a context by mode (0: no limit).
CHART_HINTS = [
    r"Figure\s*\d+", r"Fig\.\s*\d+", r"Table\s*\d+", r"Chart\s*\d+", r"Graph\s*\d+", r"Diagram\s*\d+", "%", r"\$\d", "million", "billion", "percent",
    r"x[\-\s]?axis", r"y[\-\s]?axis", "legend", "scatter", "histogram", "bar chart", "pie chart",
]
BUDGETS = {"minimal": (100, 300, 100), "standard": (500, 0, 500), "full": (2000, 0, 2000)}
MAX_PAGES, MAX_MB = 50, 50


def has_chart(c: Column) -> Column:
    return F.coalesce(c, F.lit("")).rlike("(?iu)" + "|".join(CHART_HINTS))


def truncated(c: Column, limit: int) -> Column:
    """A text cut to a budget, its figure references kept where they fit."""
    if not limit:
        return F.when(F.coalesce(c, F.lit("")) == "", F.lit("N/A")).otherwise(c)
    refs = F.array_join(F.regexp_extract_all(c, F.lit(r"(?iu)((?:Figure|Fig\.?|Table|Chart)\s*\d+[^.]*\.)"), F.lit(1)), " ")
    left = limit - F.length(refs) - 20
    kept = F.concat(F.substring(c, F.lit(1), left), F.lit("...\n[Refs: "), refs, F.lit("]"))
    cut = F.concat(F.substring(c, 1, limit), F.lit("..."))
    fits = (F.length(refs) > 0) & (F.length(refs) < limit) & (left > 50)
    return F.when(F.coalesce(c, F.lit("")) == "", F.lit("N/A")).when(F.length(c) <= limit, c).when(fits, kept).otherwise(cut)


def _turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    conv = table(spark, sf_dir, "conversations")
    return conv.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", F.lag("text").over(order).alias("before"), "text", F.lead("text").over(order).alias("after"))


def _window(spark: SparkSession, sf_dir: str, budget: str) -> DataFrame:
    a, b, c = BUDGETS[budget]
    return _turns(spark, sf_dir).select("conv_id", "turn", "role", truncated(F.col("before"), a).alias("before"), truncated(F.col("text"), b).alias("current"), truncated(F.col("after"), c).alias("after"))


def context_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each turn with its neighbours cut to the standard budget."""
    return _window(spark, sf_dir, "standard")


def context_window_minimal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _window(spark, sf_dir, "minimal")


def context_window_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _window(spark, sf_dir, "full")


def prompt_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Simple, unless the turn or a neighbour hints at a chart."""
    hint = has_chart(F.col("before")) | has_chart(F.col("text")) | has_chart(F.col("after"))
    return _turns(spark, sf_dir).select("conv_id", "turn", "role", F.when(hint, "enhanced").otherwise("simple").alias("mode"))


def chart_indicators(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return docs.groupBy("lang").agg(F.count("*").alias("docs"), F.count_if(has_chart(F.col("text"))).alias("with_chart"))


def paragraphs(lines: DataFrame) -> DataFrame:
    """doc_id, block, first_line and text: lines joined into paragraphs, by windows (see functions.text.absorbs)."""
    order = Window.partitionBy("doc_id").orderBy("line_no")
    before = F.lag("line").over(order)
    new = F.when(before.isNotNull() & T.absorbs(before, F.col("line")), 0).otherwise(1)
    lines = lines.withColumn("new", new).withColumn("block", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    whole = F.when(F.startswith("line", F.lit("#")), F.col("line")).when(F.col("new") == 1, F.regexp_replace("line", r"(?U)\s+$", "")).otherwise(T.strip(F.col("line")))
    lines = lines.withColumn("part", whole)
    parts = F.array_sort(F.collect_list(F.struct("line_no", "part")))
    return lines.groupBy("doc_id", "block").agg(F.min("line_no").alias("first_line"), F.array_join(F.transform(parts, lambda p: p["part"]), " ").alias("text"))


def paragraph_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paragraphs(text_lines(table(spark, sf_dir, "documents")).select("doc_id", "line_no", "line"))


def spacing_normalised(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", T.normalize_spacing(F.col("text")).alias("text"))


def slug_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    return part.select("p_partkey", T.slug_id(F.concat("p_name", F.lit(".md"))).alias("slug"))


def short_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", T.short_name(F.col("url")).alias("name"))


def author_display(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations, regions = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    names = nations.groupBy("n_regionkey").agg(F.array_sort(F.collect_list("n_name")).alias("names"))
    out = regions.join(names, regions.r_regionkey == names.n_regionkey, "left")
    return out.select("r_name", T.authors_display(F.coalesce("names", F.array().cast("array<string>"))).alias("authors"))


def chunk_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as a source's chunks, in order: the pages before each."""
    docs = table(spark, sf_dir, "documents").select("source", "doc_id", F.size(F.split("text", "\n", -1)).cast("long").alias("pages"))
    return running(docs, "source", F.col("doc_id"), ["doc_id"], "pages").select("source", "doc_id", F.col("number").alias("chunk"), "pages", F.col("before").alias("offset"))


def split_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks of each order as a file of so many pages (its lines' quantities) and MB (a thousandth of its price)."""
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.sum(F.col("l_quantity").cast("long")).alias("pages"))
    files = table(spark, sf_dir, "orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey")).select("o_orderkey", "pages", (F.col("o_totalprice") / 1000).alias("mb"))
    n = F.least(F.greatest(F.ceil(F.col("pages") / MAX_PAGES), F.ceil(F.col("mb") / MAX_MB)), F.col("pages")).cast("long")
    files = files.withColumn("chunks", n).where("chunks > 1").withColumn("size", F.ceil(F.col("pages") / F.col("chunks")).cast("long"))
    each = files.withColumn("chunk", F.explode(F.sequence(F.lit(1).cast("long"), F.col("chunks"))))
    first, last = (F.col("chunk") - 1) * F.col("size") + 1, F.least(F.col("chunk") * F.col("size"), F.col("pages"))
    return each.select("o_orderkey", "chunk", "chunks", first.alias("first_page"), last.alias("last_page")).where("first_page <= last_page")


def page_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Jumps in the page numbers of successful pages: after which page, and how many are missing."""
    order = Window.partitionBy("doc").orderBy("page")
    pages = figures(table(spark, sf_dir, "lineitem")).where("ok").select("doc", "page", F.lead("page").over(order).alias("following"))
    return pages.where(F.col("following") - F.col("page") > 1).select("doc", "page", (F.col("following") - F.col("page") - 1).alias("missing"))


def new_index_after_removal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines left after removing three ranges of lines (2-3, 5, and what starts with a number), and their new numbers."""
    lines = text_lines(table(spark, sf_dir, "documents"))
    gone = F.col("line_no").between(2, 3) | (F.col("line_no") == 5) | F.col("line").rlike("^[0-9]")
    order = Window.partitionBy("doc_id").orderBy("line_no")
    return lines.where(~gone).select("doc_id", "line_no", F.row_number().over(order).cast("long").alias("new_no"))


def pairing_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return docs.join(labels, "doc_id", "left_anti").select("doc_id", "source")


def pending_work(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders none of whose pages succeeded."""
    done = figures(table(spark, sf_dir, "lineitem")).where("ok").select("doc")
    orders = table(spark, sf_dir, "orders")
    return orders.join(done, orders.o_orderkey == done.doc, "left_anti").select("o_orderkey", "o_orderstatus")


def expected_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct origins: sources of documents and hosts of pages."""
    hosts = table(spark, sf_dir, "pages").select(F.lit("host").alias("kind"), F.regexp_extract("url", "^[a-z]+://([^/?#]+)", 1).alias("origin"))
    both = table(spark, sf_dir, "documents").select(F.lit("source").alias("kind"), F.col("source").alias("origin")).unionByName(hosts)
    return both.distinct()


def figure_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MERGE on (document, page): figures of later parts update those with data; unmatched ones don't enter."""
    figs = figures(table(spark, sf_dir, "lineitem"))
    old = figs.select("doc", "page", "level", F.col("part").alias("value"))
    new = figs.where("has_meta AND part % 3 = 0").select("doc", "page", (F.col("part") * 10).alias("fresh")).where("fresh > 0")
    return old.join(new, ["doc", "page"], "left").select("doc", "page", "level", F.coalesce("fresh", "value").alias("value"), F.col("fresh").isNotNull().alias("updated"))


def page_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages replaced where a retry has them, added where only a retry has them (one page past every tenth text)."""
    lines = text_lines(table(spark, sf_dir, "documents")).select("doc_id", F.col("line_no").alias("page"), "line")
    retry = lines.where("page % 4 = 0").select("doc_id", "page", F.concat(F.lit("retried: "), "line").alias("fresh"))
    last = lines.where("doc_id % 10 = 0").groupBy("doc_id").agg((F.max("page") + 1).alias("page")).withColumn("fresh", F.lit("placeholder"))
    merged = lines.join(retry.unionByName(last), ["doc_id", "page"], "full")
    return merged.select("doc_id", "page", F.md5(F.coalesce("fresh", "line")).alias("digest"), F.col("fresh").isNotNull().alias("fresh"), F.col("line").isNull().alias("added"))


def table_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Best title match in a band: parts as metadata (page: size), parts of the same brand as tables on pages p-1..p+1.

    Scored by the overlap of the titles' words; the best score wins, ties go to the lower page and key; a score below 0.2
    only counts where it is the only candidate. What has the same brand, page and words has the same scores, so such parts
    are compared once: of tables the one with the lowest key can win, all of them count as candidates."""
    words = F.array_sort(T.keywords(F.col("p_name"))).alias("words")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand", F.col("p_size").cast("long").alias("page"), words)
    meta = part.where("p_partkey % 5 = 0")
    tables = part.where("p_partkey % 5 <> 0").groupBy("p_brand", F.col("page").alias("table_page"), F.col("words").alias("table_words"))
    tables = tables.agg(F.min("p_partkey").alias("table_key"), F.count("*").alias("n"))
    near = tables.withColumn("page", F.explode(F.array(F.col("table_page") - 1, F.col("table_page"), F.col("table_page") + 1)))
    titles = meta.select("p_brand", "page", "words").distinct()
    # The best score is the least struct of score (negative), page and key: no sort of a title's candidates.
    score = F.round(T.jaccard(F.col("words"), F.col("table_words")), 4)
    found = titles.join(near, ["p_brand", "page"]).groupBy("p_brand", "page", "words")
    found = found.agg(F.min(F.struct((-score).alias("less"), "table_page", "table_key")).alias("best"), F.sum("n").alias("candidates"))
    found = found.select("p_brand", "page", "words", F.col("best.table_key").alias("table_key"), (-F.col("best.less")).alias("score"), "candidates")
    found = found.where("score >= 0.2 OR candidates = 1")
    return meta.join(found, ["p_brand", "page", "words"]).select("p_partkey", "table_key", "score", "candidates")


def longest_prefix(names: DataFrame, key: str, finals: DataFrame) -> DataFrame:
    """names (key, name) with final: the longest of finals (one distinct column, final) that the name starts with, or null.

    Every name is taken at all lengths that finals have, so this is a join by equality."""
    sizes = [r.n for r in finals.select(F.length("final").alias("n")).distinct().orderBy("n").collect()]
    heads = F.filter(F.array(*map(F.lit, sizes)), lambda n: n <= F.length("name"))
    tried = names.select(key, "name", F.explode_outer(heads).alias("n")).withColumn("final", F.substring("name", F.lit(1), F.col("n")))
    found = tried.join(finals, "final", "left_semi").groupBy(key).agg(F.max_by("final", "n").alias("final"))
    return names.join(found, key, "left")


def prefix_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of chunk files (parts with their size) against names of delivered ones (every third part), both normalised."""
    part = table(spark, sf_dir, "part")
    names = part.select("p_partkey", T.normalized_name(F.concat("p_name", F.lit("-"), F.col("p_size"), F.lit("_part1of2"))).alias("name"))
    return longest_prefix(names, "p_partkey", part.where("p_partkey % 3 = 0").select(T.normalized_name(F.col("p_name")).alias("final")).distinct())


def top_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fifty dearest figures."""
    figs = figures(table(spark, sf_dir, "lineitem"))
    return figs.orderBy(F.desc("price"), "doc", "page").limit(50).select("doc", "page", "price")


def status_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by status, and how many have pages at all."""
    orders = table(spark, sf_dir, "orders")
    pages = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("pages"))
    joined = orders.join(pages, orders.o_orderkey == pages.l_orderkey, "left")
    return joined.groupBy("o_orderstatus").agg(F.count("*").alias("orders"), F.count("pages").alias("with_pages"), F.sum(F.coalesce("pages", F.lit(0))).alias("pages"))


QUERIES = {
    f.__name__: f
    for f in (
        context_window, context_window_minimal, context_window_full, prompt_mode, chart_indicators, paragraph_join, spacing_normalised, slug_id, short_name, author_display, chunk_offsets, split_plan, page_gaps,
        new_index_after_removal, pairing_missing, pending_work, expected_distinct, figure_upsert, page_upsert, table_match, prefix_match, top_details, status_summary,
    )
}

_TURNS = "(SELECT conv_id, CAST(turn AS BIGINT) AS turn, role, lag(text) OVER w AS before, text, lead(text) OVER w AS after FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text))"
_HINT = "(?i)" + "|".join(CHART_HINTS).replace("'", "''")
_REFS = r"array_to_string(regexp_extract_all({c}, '(?i)((?:Figure|Fig\.?|Table|Chart)\s*\d+[^.]*\.)', 1), ' ')"


def _cut(c: str, limit: int) -> str:
    r = _REFS.replace("{c}", c)
    if not limit:
        return f"CASE WHEN coalesce({c}, '') = '' THEN 'N/A' ELSE {c} END"
    return f"CASE WHEN coalesce({c}, '') = '' THEN 'N/A' WHEN length({c}) <= {limit} THEN {c} WHEN length({r}) > 0 AND {limit} - length({r}) - 20 > 50 THEN substr({c}, 1, {limit} - length({r}) - 20) || '...' || chr(10) || '[Refs: ' || {r} || ']' ELSE substr({c}, 1, {limit}) || '...' END"


_STRIP = r"regexp_replace({c}, '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g')"
_strip = lambda c: _STRIP.replace("{c}", c)
_rstrip = lambda c: rf"regexp_replace({c}, '[\s\p{{Z}}]+$', '')"
_WORDS = r"list_filter(list_distinct(regexp_split_to_array(regexp_replace(lower(p_name), '[^\w\s]', ' ', 'g'), '\s+')), lambda x: length(x) > 2)"
ORACLES = {
    "context_window": f"SELECT conv_id, turn, role, {_cut('before', 500)} AS before, {_cut('text', 0)} AS current, {_cut('after', 500)} AS after FROM {_TURNS}",
    "context_window_minimal": f"SELECT conv_id, turn, role, {_cut('before', 100)} AS before, {_cut('text', 300)} AS current, {_cut('after', 100)} AS after FROM {_TURNS}",
    "context_window_full": f"SELECT conv_id, turn, role, {_cut('before', 2000)} AS before, {_cut('text', 0)} AS current, {_cut('after', 2000)} AS after FROM {_TURNS}",
    "prompt_mode": f"SELECT conv_id, turn, role, CASE WHEN regexp_matches(coalesce(before, '') || chr(10) || text || chr(10) || coalesce(after, ''), '{_HINT}') THEN 'enhanced' ELSE 'simple' END AS mode FROM {_TURNS}",
    "chart_indicators": f"SELECT lang, count(*) AS docs, count(*) FILTER (regexp_matches(text, '{_HINT}')) AS with_chart FROM documents GROUP BY lang",
    "paragraph_join": rf"""WITH b AS (SELECT doc_id, line_no, line, lag(line) OVER (PARTITION BY doc_id ORDER BY line_no) AS before FROM {LINES}),
        n AS (SELECT *, CASE WHEN before IS NOT NULL AND {_strip('before')} <> '' AND NOT starts_with(before, '#') AND {_strip('line')} <> '' AND NOT regexp_matches({_strip('line')}, '^(#|\* |- |• |\d+\.\s)')
            AND (regexp_matches({_strip('line')}, '^[\p{{Ll}}(\[]') OR NOT regexp_matches({_rstrip('before')}, '[.!?)\]]$')) THEN 0 ELSE 1 END AS new FROM b),
        g AS (SELECT *, CAST(sum(new) OVER (PARTITION BY doc_id ORDER BY line_no ROWS UNBOUNDED PRECEDING) AS BIGINT) AS block FROM n)
        SELECT doc_id, block, min(line_no) AS first_line, string_agg(CASE WHEN starts_with(line, '#') THEN line WHEN new = 1 THEN {_rstrip('line')} ELSE {_strip('line')} END, ' ' ORDER BY line_no) AS text FROM g GROUP BY doc_id, block""",
    "spacing_normalised": rf"""WITH l AS (SELECT doc_id, line_no, regexp_extract(line, '^[\s\p{{Z}}]*', 0) AS indent, line FROM {LINES}),
        t AS (SELECT doc_id, line_no, indent || regexp_replace(regexp_replace(regexp_replace(substr(line, length(indent) + 1), '  +', ' ', 'g'), '[\s\p{{Z}}]+([.,;:!?)])', '\1', 'g'), '[\s\p{{Z}}]+$', '') AS line FROM l)
        SELECT doc_id, regexp_replace(string_agg(line, chr(10) ORDER BY line_no), '\n{{4,}}', repeat(chr(10), 3), 'g') AS text FROM t GROUP BY doc_id""",
    "slug_id": rf"SELECT p_partkey, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(translate(lower(p_name), '{T.ACCENTS[0]}', '{T.ACCENTS[1]}'), '^\d+[-_]', ''), '[-_]\d+$', ''), '[\s\-]+', '_', 'g'), '[^a-z0-9_]', '', 'g'), '_+', '_', 'g'), '^_+|_+$', '', 'g') AS slug FROM part",
    "short_name": "SELECT page_id, regexp_replace(replace(substr(url, 1, 50), ' ', '-'), '[^a-zA-Z0-9-]', '', 'g') AS name FROM pages",
    "author_display": """WITH n AS (SELECT n_regionkey, list_sort(list(n_name)) AS names FROM nation GROUP BY 1) SELECT r_name, CASE WHEN names IS NULL THEN '' WHEN len(names) = 1 THEN names[1]
        ELSE array_to_string(names[1:len(names) - 1], ', ') || ' e ' || names[len(names)] END AS authors FROM region LEFT JOIN n ON r_regionkey = n_regionkey""",
    "chunk_offsets": """SELECT source, doc_id, row_number() OVER w AS chunk, pages, CAST(coalesce(sum(pages) OVER (PARTITION BY source ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS "offset"
        FROM (SELECT source, doc_id, CAST(len(string_split(text, chr(10))) AS BIGINT) AS pages FROM documents) WINDOW w AS (PARTITION BY source ORDER BY doc_id)""",
    "split_plan": f"""WITH f AS (SELECT o_orderkey, pages, o_totalprice / 1000 AS mb FROM orders JOIN (SELECT l_orderkey, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS pages FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey),
        c AS (SELECT *, CAST(least(greatest(ceil(pages::DOUBLE / {MAX_PAGES}), ceil(mb / {MAX_MB})), pages) AS BIGINT) AS chunks FROM f), s AS (SELECT *, CAST(ceil(pages::DOUBLE / chunks) AS BIGINT) AS size, unnest(range(1, chunks + 1)) AS chunk FROM c WHERE chunks > 1)
        SELECT * FROM (SELECT o_orderkey, chunk, chunks, (chunk - 1) * size + 1 AS first_page, least(chunk * size, pages) AS last_page FROM s) WHERE first_page <= last_page""",
    "page_gaps": f"SELECT doc, page, following - page - 1 AS missing FROM (SELECT doc, page, lead(page) OVER (PARTITION BY doc ORDER BY page) AS following FROM {FIGURES} WHERE ok) WHERE following - page > 1",
    "new_index_after_removal": f"SELECT doc_id, line_no, row_number() OVER (PARTITION BY doc_id ORDER BY line_no) AS new_no FROM {LINES} WHERE NOT (line_no BETWEEN 2 AND 3 OR line_no = 5 OR regexp_matches(line, '^[0-9]'))",
    "pairing_missing": "SELECT doc_id, source FROM documents ANTI JOIN labels USING (doc_id)",
    "pending_work": f"SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey NOT IN (SELECT doc FROM {FIGURES} WHERE ok)",
    "expected_distinct": "SELECT DISTINCT 'source' AS kind, source AS origin FROM documents UNION SELECT DISTINCT 'host', regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) FROM pages",
    "figure_upsert": f"""SELECT o.doc, o.page, o.level, coalesce(n.fresh, o.part) AS value, n.fresh IS NOT NULL AS updated FROM {FIGURES} o
        LEFT JOIN (SELECT doc, page, part * 10 AS fresh FROM {FIGURES} WHERE has_meta AND part % 3 = 0 AND part > 0) n ON o.doc = n.doc AND o.page = n.page""",
    "page_upsert": f"""WITH l AS (SELECT doc_id, line_no AS page, line FROM {LINES}), r AS (SELECT doc_id, page, 'retried: ' || line AS fresh FROM l WHERE page % 4 = 0
        UNION ALL SELECT doc_id, max(page) + 1, 'placeholder' FROM l WHERE doc_id % 10 = 0 GROUP BY doc_id)
        SELECT doc_id, page, md5(coalesce(fresh, line)) AS digest, r.fresh IS NOT NULL AS fresh, line IS NULL AS added FROM l FULL JOIN r USING (doc_id, page)""",
    "table_match": f"""WITH p AS (SELECT p_partkey, p_brand, CAST(p_size AS BIGINT) AS page, {_WORDS} AS words FROM part),
        s AS (SELECT m.p_partkey, t.p_partkey AS table_key, t.page AS table_page, CASE WHEN len(m.words) > 0 AND len(t.words) > 0 THEN round(len(list_intersect(m.words, t.words))::DOUBLE / len(list_distinct(list_concat(m.words, t.words))), 4) ELSE 0 END AS score
            FROM p m JOIN p t ON m.p_brand = t.p_brand AND abs(m.page - t.page) <= 1 WHERE m.p_partkey % 5 = 0 AND t.p_partkey % 5 <> 0),
        r AS (SELECT *, row_number() OVER (PARTITION BY p_partkey ORDER BY score DESC, table_page, table_key) AS n, count(*) OVER (PARTITION BY p_partkey) AS candidates FROM s)
        SELECT p_partkey, table_key, score, candidates FROM r WHERE n = 1 AND (score >= 0.2 OR candidates = 1)""",
    "prefix_match": """SELECT p_partkey, name, arg_max(final, length(final)) AS final FROM (SELECT p_partkey, lower(regexp_replace(p_name, '[-_ ]', '', 'g')) || p_size AS name FROM part)
        LEFT JOIN (SELECT DISTINCT lower(regexp_replace(p_name, '[-_ ]', '', 'g')) AS final FROM part WHERE p_partkey % 3 = 0) ON starts_with(name, final) GROUP BY 1, 2""",
    "top_details": f"SELECT doc, page, price FROM {FIGURES} ORDER BY price DESC, doc, page LIMIT 50",
    "status_summary": """SELECT o_orderstatus, count(*) AS orders, count(pages) AS with_pages, CAST(sum(coalesce(pages, 0)) AS BIGINT) AS pages FROM orders
        LEFT JOIN (SELECT l_orderkey, count(*) AS pages FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey GROUP BY 1""",
}
