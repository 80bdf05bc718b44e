"""Technical sheets: metadata out of the text, and a restructured document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T

_CAPS = "A-ZÁÉÍÓÚÀÃÕÂÊÔÇ"
# The series' headings, the institution, keywords and their tags, section and step headings.
SERIES = "Nutrição de Plantas"
HEADER_WORDS = ["Fichas", "Agroecológicas", "Tecnologias Apropriadas", "Fertilidade do Solo", "Nutrição de Plantas"]
FOOTERS = ["Ministério da Agricultura", "gov.br/agricultura"]
NOT_SUMMARY = ["Fichas", "Agroecológicas", "Ministério"]
REFERENCES = "Referências bibliográficas"
BASE_TAG = "agroecologia"
TAG_KEYWORDS = {
    "biofertilizante": "biofertilizante", "fermentação": "fermentacao", "anaeróbica": "fermentacao-anaerobica", "aeróbica": "fermentacao-aerobica",
    "esterco": "esterco", "esterco bovino": "esterco-bovino", "composto": "compostagem", "adubação verde": "adubacao-verde", "leguminosas": "leguminosas",
    "gramíneas": "gramineas", "mamona": "mamona", "supermagro": "supermagro", "bokashi": "bokashi", "húmus": "humus", "minhoca": "minhoca", "microrganismos": "microrganismos-eficientes",
}
SECTIONS = [
    (r"^(Ingredientes)\s*:?\s*$", "## $1"), (r"^(Como preparar[^:\n]*)\s*:?\s*$", "## $1"), (r"^(Importante)\s*!?\s*$", "## Importante!"), (r"^(Como (?:utilizar|aplicar)[^:\n]*)\s*:?\s*$", "## $1"),
    (r"^(Aplicação[^:\n]*)\s*:?\s*$", "## $1"), (r"^(Modo de preparo[^:\n]*)\s*:?\s*$", "## $1"), (r"^(Materiais[^:\n]*)\s*:?\s*$", "## $1"), (r"^(Referências bibliográficas)\s*:?\s*$", "## $1"),
    (r"^(Dica [Aa]groecológica)\s*!?\s*$", "### $1!"), (r"^(Atenção)\s*!?\s*$", "### Atenção!"),
]
TITLE_LINES = ["**Fichas Agroecológicas**", "**Tecnologias Apropriadas para Agricultura Orgânica**"]
ISSUER = ["Ministério da Agricultura e Pecuária", "https://www.gov.br/agricultura/pt-br/assuntos/sustentabilidade/organicos/fichas-agroecologicas"]


def title_case(c: Column) -> Column:
    """Capital first letters after anything that isn't a letter, the rest lower."""
    step = lambda acc, x: F.concat(acc, F.when(F.substring(F.concat(F.lit(" "), acc), -1, 1).rlike(r"\p{L}"), F.lower(x)).otherwise(F.upper(x)))
    return F.aggregate(F.split(F.coalesce(c, F.lit("")), ""), F.lit(""), step)


def title(c: Column) -> Column:
    """The line in capitals after the series' name and number, else any such line of at least nine characters."""
    after = F.regexp_extract(c, rf"(?Umd){SERIES}\s*\n\d+\s*\n+([{_CAPS}][{_CAPS}\s*\-]+)$", 1)
    any_ = F.regexp_extract(c, rf"(?Umd)^([{_CAPS}][{_CAPS}\s*\-]{{8,}})$", 1)
    return T.strip(F.coalesce(F.nullif(after, F.lit("")), any_))


def authors(c: Column) -> Column:
    """`SURNAME, I. I.` pairs of the authors' line as `I. I. Surname`."""
    raw = F.regexp_extract(c, r"(?iu)Elaborador(?:es|) da ficha:\s*(.+?)(?:\n|$)", 1)
    pair = rf"(?iu)([{_CAPS}]+),\s*([A-Z]\.\s*(?:[A-Z]\.\s*)*)"
    names, initials = [F.regexp_extract_all(raw, F.lit(pair), F.lit(n)) for n in (1, 2)]
    return F.zip_with(names, initials, lambda s, i: F.concat(F.regexp_replace(T.strip(i), r"\s+", " "), F.lit(" "), title_case(s)))


def number(c: Column, file_name: Column) -> Column:
    inside = F.regexp_extract(c, rf"{SERIES}\s*\n(\d+)", 1)
    return F.coalesce(F.nullif(inside, F.lit("")), F.regexp_extract(file_name, r"^(\d+)-", 1))


def summary(c: Column, name: Column) -> Column:
    """The first long line that is no heading, item, quote, image, title or series line; cut at a word after 150 characters."""
    start = F.lower(F.substring(name, 1, 20))

    def fits(x: Column) -> Column:
        out = (F.length(x) >= 50) & ~x.rlike(r"^[#*\->!]") & ~((F.length(name) > 0) & F.startswith(F.lower(x), start))
        for word in NOT_SUMMARY:
            out = out & ~F.contains(x, F.lit(word))
        return out

    first = F.coalesce(F.get(F.filter(F.transform(T.lines(c), T.strip), fits), F.lit(0)), F.lit(""))
    return F.when(F.length(first) > 150, F.concat(F.regexp_replace(F.substring(first, 1, 150), r" [^ ]*$", ""), F.lit("..."))).otherwise(first)


def tag(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(T.transliterate(c), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def tags(name: Column, c: Column) -> Column:
    """The base tag, the title's longer words, and tags whose keyword stands anywhere in the text."""
    words = F.filter(F.split(tag(F.coalesce(name, F.lit(""))), "-"), lambda w: F.length(w) > 3)
    found = F.array(*[F.when(F.contains(F.lower(c), F.lit(k)), F.lit(v)) for k, v in TAG_KEYWORDS.items()])
    return F.array_distinct(F.concat(F.array(F.lit(BASE_TAG)), words, F.filter(found, lambda x: x.isNotNull())))


def extract(c: Column, file_name: Column, raw: Column) -> Column:
    """title (of the uncleaned text), authors, number, summary and warnings of a sheet."""
    name = title(raw)
    warn = F.filter(
        F.array(*[F.when(w, F.lit(m)) for w, m in ((name == "", "no title"), (F.size(authors(c)) == 0, "no authors"), (number(c, file_name) == "", "no number"), (summary(c, name) == "", "no summary"))]),
        lambda x: x.isNotNull(),
    )
    return F.struct(name.alias("title"), authors(c).alias("authors"), number(c, file_name).alias("number"), summary(c, name).alias("summary"), warn.alias("warnings"))


def restructure(c: Column) -> Column:
    """Section and step lines as headings."""
    return T.replaced(c, [*SECTIONS, (r"^(\d+)º\s*[Pp]asso\s*:?\s*$", "### $1º passo")])


def body(c: Column, name: Column) -> Column:
    """The text after the sheet's header (which ends at the first real line), without footer and authors."""
    has = lambda x, words: F.array_contains(F.array(*[F.contains(x, F.lit(w)) for w in words]), True)
    kind = "struct<out:array<string>, on:boolean>"
    start = F.struct(F.array().cast("array<string>").alias("out"), F.lit(False).alias("on")).cast(kind)

    def step(acc: Column, line: Column) -> Column:
        x = T.strip(line)
        header = ~acc["on"] & (has(x, HEADER_WORDS) | x.rlike(r"^\d+$") | ((F.length(name) > 0) & (F.upper(x) == F.upper(name))))
        on = acc["on"] | ((F.length(x) > 20) & ((F.upper(x) != x) | (F.upper(x) == F.lower(x))))
        drop = has(x, FOOTERS) | F.startswith(x, F.lit("Elaborador"))
        refs = F.concat(acc["out"], F.array(F.lit(""), F.lit(f"## {REFERENCES}")))
        kept = F.when(drop, acc["out"]).when(F.contains(x, F.lit(REFERENCES)), refs).when(on, F.concat(acc["out"], F.array(line))).otherwise(acc["out"])
        return F.when(header, acc).otherwise(F.struct(kept.alias("out"), on.alias("on"))).cast(kind)

    return T.collapse_lines(T.strip(T.unlines(F.aggregate(T.lines(c), start, step, lambda acc: acc["out"]))))


def frontmatter(file_name: Column, meta: Column, tag_list: Column) -> Column:
    name = meta["title"]
    about = F.when((meta["summary"] == "") & (name != ""), F.concat(F.lit("Ficha técnica sobre "), F.lower(name), F.lit("."))).otherwise(meta["summary"])
    rows = [
        F.lit("---"), F.concat(F.lit("id: "), T.slug_id(file_name)), F.lit("tipo: ficha_agroecologica"), F.concat(F.lit("titulo: "), title_case(name)),
        F.concat(F.lit("autores: ["), F.array_join(meta["authors"], ", "), F.lit("]")), F.lit("instituicao: [Ministério da Agricultura e Pecuária]"),
        F.concat(F.lit("tags: ["), F.array_join(tag_list, ", "), F.lit("]")), F.concat(F.lit("ficha_numero: "), meta["number"]), F.concat(F.lit("resumo: "), about), F.lit("---"),
    ]
    return F.concat_ws("\n", *rows)


def inject_tables(c: Column, section: Column, markers: tuple[str, ...] = ("## Referências", "## Importante", "## Aplicação", "### Dica", "## Como")) -> Column:
    """A section in front of the first of the markers, else at the end."""
    at = F.least(*[F.nullif(F.instr(c, m), F.lit(0)) for m in markers])
    inside = F.concat(F.substring(c, F.lit(1), at - 1), section, F.lit("\n\n"), F.substring(c, at, F.length(c)))
    return F.when(F.coalesce(section, F.lit("")) == "", c).when(at.isNotNull(), inside).otherwise(F.concat(c, F.lit("\n\n"), section))


def convert(sheets: DataFrame) -> DataFrame:
    """name and text of sheets -> name, meta, tags and document. Columns only: no shuffle."""
    cleaned = T.clean_sheet(F.col("text"))
    out = sheets.withColumn("cleaned", cleaned)
    out = out.withColumn("meta", extract(F.col("cleaned"), F.col("name"), F.col("text")))
    out = out.withColumn("tags", tags(F.col("meta.title"), F.col("cleaned")))
    inner = T.optimize(T.format_bullets(restructure(body(F.col("cleaned"), F.col("meta.title")))), sheet=True)
    shown = T.authors_display(F.col("meta.authors"))
    heading = F.when(F.col("meta.title") != "", title_case(F.col("meta.title"))).otherwise(F.lit("Sem Título"))
    parts = [
        frontmatter(F.col("name"), F.col("meta"), F.col("tags")), F.lit(""), F.concat(F.lit("# "), heading), F.lit(""), F.when(shown != "", F.concat(F.lit("> Autores: "), shown, F.lit("\n"))),
        *map(F.lit, TITLE_LINES), F.concat(F.lit("**Fertilidade do Solo e Nutrição de Plantas "), F.col("meta.number"), F.lit("**")), F.lit(""), inner, F.lit(""), *map(F.lit, ISSUER),
    ]
    return out.select("name", "meta", "tags", F.concat_ws("\n", *parts).alias("document"))
