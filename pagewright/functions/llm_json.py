"""Reading model responses: finding, repairing and typing their JSON."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

PAGE_SCHEMA = (
    "page_number int, has_figures boolean, figures array<struct<figure_number:string, title:string, description:string, confidence:string, image_type:string>>, "
    "tables array<struct<table_number:string, caption:string, markdown:string>>, formulas array<string>, body_text string, footnotes array<string>"
)
# Confidence levels as numbers, for indicators and for figure metadata.
CONFIDENCE = {"high": 1.0, "medium": 0.6, "low": 0.3}
META_CONFIDENCE = {"high": 0.95, "medium": 0.70, "low": 0.40}


def json_part(c: Column) -> Column:
    """A json fence's content, else a fenced object, else from the first to the last brace, else everything."""
    fenced = F.regexp_extract(c, r"(?s)```json\s*(.*?)\s*```", 1)
    plain = F.regexp_extract(c, r"(?s)```\s*(\{.*?\})\s*```", 1)
    braces = F.regexp_extract(c, r"(?s)\{.*\}", 0)
    return F.when(c.rlike(r"(?s)```json.*?```"), fenced).otherwise(F.coalesce(F.nullif(plain, F.lit("")), F.nullif(braces, F.lit("")), c))


def fix_escapes(c: Column) -> Column:
    """Doubles the backslashes that JSON doesn't know: those of formulas. A control letter followed by a letter begins a
    command; escaped backslashes, quotes and slashes and \\uXXXX stay."""
    # What may stay is set aside behind marks, the rest doubled, the marks taken back.
    keep = F.replace(c, F.lit("\\\\"), F.lit("\u0002"))
    keep = F.regexp_replace(keep, r"\\([\"/]|[bfnrt](?!\p{L})|u[0-9a-fA-F]{4})", "\u0001$1")
    doubled = F.replace(keep, F.lit("\\"), F.lit("\\\\"))
    return F.replace(F.replace(doubled, F.lit("\u0001"), F.lit("\\")), F.lit("\u0002"), F.lit("\\\\"))


def parsed_page(c: Column) -> Column:
    """A response as a typed page, null where even the repaired JSON can't be read."""
    raw = json_part(c)
    options = {"mode": "PERMISSIVE"}
    whole = lambda x: F.when(F.try_parse_json(x).isNotNull(), F.from_json(x, PAGE_SCHEMA, options))
    return F.coalesce(whole(raw), whole(fix_escapes(raw)))


_TOKEN = re.compile(r'"((?:[^"\\]|\\.)*)"?|[\[\]{}:,]', re.S)


def closed(raw: str) -> str:
    """JSON that breaks off, with what is open in it closed: a string, then brackets from the inside out."""
    due, inside, escaped = [], False, False
    for c in raw:
        if inside:
            inside, escaped = escaped or c != '"', c == "\\" and not escaped
        elif c == '"':
            inside = True
        elif c in "{[":
            due.append("}" if c == "{" else "]")
        elif c in "}]" and due:
            due.pop()
    return raw + '"' * inside + "".join(reversed(due))


def _plain(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: {"n": "\n", "t": "\t"}.get(m[1], m[1]), text, flags=re.S)


def fields(raw: str) -> dict[str, list[str]]:
    """The strings that follow each key of broken JSON: its value, or all of a list's."""
    out: dict[str, list[str]] = {}
    key, last, in_list = None, None, False
    for m in _TOKEN.finditer(raw):
        if m[1] is not None:
            if key is not None:
                out.setdefault(key, []).append(_plain(m[1]))
                key = key if in_list else None
            last = m[1]
        elif m[0] == ":":
            key, in_list = last, False
        elif m[0] == "[":
            in_list = key is not None
        elif m[0] in "]{}" or not in_list:
            key, in_list = None, False
    return out


def salvage(response: str, page: int) -> dict:
    """A response whose JSON breaks off: as it is once closed, if that is a page; else its text, or description and labels,
    whichever is longer; else all of the response."""
    fence = response.find("```json")
    raw = response[fence + 7 :].split("```")[0] if fence >= 0 else response[max(response.find("{"), 0) :]
    try:
        whole = json.loads(closed(raw.strip()), strict=False)
    except ValueError:
        whole = None
    if isinstance(whole, dict) and not {"page_number", "body_text", "figures", "tables"}.isdisjoint(whole):
        return whole
    said = fields(raw)
    labels = [f"- {x}" for x in said.get("text_labels", [])]
    about = "\n".join([*(f"{x}\n" for x in said.get("description", [])[:1]), *labels])
    texts = [about, *said.get("body_text", [])[:1]]
    if max(map(len, texts)) < 100:
        texts.append(response.replace("```json", "").replace("```", "").strip())
    return {"page_number": page, "figures": [], "tables": [], "formulas": [], "body_text": max(texts, key=len) or response, "footnotes": []}


@F.pandas_udf(T.StringType())
def salvaged_text(response: pd.Series, page: pd.Series) -> pd.Series:
    """The body text of responses that can't be parsed: repair by trial needs a parser in the loop."""
    return pd.Series([None if r is None else str(salvage(r, int(p)).get("body_text", "")) for r, p in zip(response, page, strict=True)])


def page_text(response: Column, page: Column) -> Column:
    """The body text of any response: typed where it parses, else salvaged."""
    typed = parsed_page(response)["body_text"]
    return F.when(typed.isNotNull(), typed).otherwise(salvaged_text(response, page))


def level_value(level: Column, values: dict[str, float] = CONFIDENCE) -> Column:
    """A confidence level as a number; anything else counts as medium."""
    out = F.when(F.lower(level) == "high", values["high"]).when(F.lower(level) == "low", values["low"])
    return out.otherwise(F.lit(values["medium"]))


def figure_record(figure: Column, page: Column) -> Column:
    """A figure's metadata in sections, with defaults."""
    number = F.coalesce(figure["figure_number"], F.lit("Unknown"))
    return F.struct(
        F.struct(number.alias("figure_number"), page.alias("page_number"), F.coalesce(figure["title"], F.lit("")).alias("chart_title"), F.coalesce(figure["image_type"], F.lit("other")).alias("image_type")).alias("chart_identification"),
        F.struct(F.coalesce(figure["description"], F.lit("")).alias("description")).alias("visual_content"),
        F.struct(level_value(figure["confidence"], META_CONFIDENCE).alias("overall_confidence")).alias("quality_check"),
        F.concat(F.regexp_replace(number, r"[^\w.-]+", "_"), F.lit("_page"), page.cast("string"), F.lit(".yaml")).alias("file_name"),
    )


def analysis(c: Column) -> Column:
    """A book analysis response as a struct: metadata (scalars or lists), chapters and 1-based inclusive ranges to remove.
    Null without JSON; chapters without title or line and ranges without two ends are left out."""
    v = F.try_parse_json(json_part(c))
    text = lambda path: F.try_variant_get(v, path, "string")

    def listed(path: str) -> Column:
        many, one = F.try_variant_get(v, path, "array<string>"), F.try_variant_get(v, path, "string")
        # A list can be read as text too, so it goes first.
        return F.coalesce(many, F.when(F.coalesce(one, F.lit("")) != "", F.array(one)), F.array().cast("array<string>"))

    chapters = F.coalesce(F.try_variant_get(v, "$.capitulos", "array<struct<titulo:string, linha_inicio:int, nivel:string>>"), F.array().cast("array<struct<titulo:string, linha_inicio:int, nivel:string>>"))
    good = F.filter(chapters, lambda x: (F.coalesce(x["titulo"], F.lit("")) != "") & (F.coalesce(x["linha_inicio"], F.lit(0)) > 0))
    chapters = F.transform(good, lambda x: F.struct(x["titulo"].alias("title"), x["linha_inicio"].alias("line"), F.coalesce(x["nivel"], F.lit("chapter")).alias("level")))
    none = F.array().cast("array<array<int>>")
    pairs = [F.coalesce(F.try_variant_get(v, f"$.remover.{k}", "array<array<int>>"), none) for k in ("figuras", "referencias")]
    single = [F.coalesce(F.array(F.try_variant_get(v, f"$.remover.{k}", "array<int>")), none) for k in ("toc", "frontmatter")]
    ranges = F.filter(F.concat(*pairs, *single), lambda r: r.isNotNull() & (F.size(r) == 2))
    ranges = F.transform(ranges, lambda r: F.struct(F.get(r, F.lit(0)).alias("low"), F.get(r, F.lit(1)).alias("high")))
    out = F.struct(
        F.coalesce(text("$.metadados.titulo"), F.lit("")).alias("title"), listed("$.metadados.autores").alias("authors"), listed("$.metadados.editora").alias("publishers"),
        text("$.metadados.ano").alias("year"), text("$.metadados.isbn").alias("isbn"), listed("$.metadados.tags").alias("tags"), chapters.alias("chapters"), ranges.alias("ranges"),
    )
    return F.when(v.isNotNull(), out)
