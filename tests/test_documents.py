from pyspark.sql import functions as F

from pagewright.operators import books, quality, report, sheets, state

SHEET = """# 12-adubo-foliar-3

*Statistics: 1 figure*
*Model: y*

---

## Page 1

Fichas Agroecológicas
Fertilidade do Solo e Nutrição de Plantas
12

ADUBO FOLIAR

Elaborador da ficha: SILVA, A. B.; REIS, C.
O adubo foliar descrito aqui serve para nutrir plantas novas em canteiros e viveiros,
feito com esterco e minhoca.

Ingredientes:
- esterco
1º passo:
misturar tudo.
Referências bibliográficas
Livro.
Ministério da Agricultura e Pecuária
"""


def test_sheet(spark):
    row = sheets.convert(spark.createDataFrame([("12-adubo-foliar-3.md", SHEET)], "name string, text string")).first()
    assert (row.meta.title, row.meta.authors, row.meta.number) == ("ADUBO FOLIAR", ["A. B. Silva", "C. Reis"], "12")
    assert row.tags == ["agroecologia", "adubo", "foliar", "esterco", "minhoca"]
    for part in ("id: adubo_foliar\n", "# Adubo Foliar\n", "> Autores: A. B. Silva e C. Reis\n", "viveiros, feito com", "## Ingredientes\n* esterco\n### 1º passo", "## Referências bibliográficas\nLivro."):
        assert part in row.document
    assert row.document.count("Ministério da Agricultura e Pecuária") == 2 and "Elaborador" not in row.document


def test_inject_tables(one):
    assert one(sheets.inject_tables(F.lit("a\n## Importante\nb"), F.lit("T"))) == "a\nT\n\n## Importante\nb"
    assert one(sheets.inject_tables(F.lit("a"), F.lit("T"))) == "a\n\nT"
    assert one(sheets.inject_tables(F.lit("a"), F.lit(""))) == "a"


BOOK = "CAPA\nFICHA\nMANUAL DO SOLO VIVO\n\nINTRODUÇÃO\n\nO solo é um orga-\nnismo vivo\ne complexo.\n\nÁgua\ntexto.\n"
RESPONSE = (
    'Here: {"metadados":{"titulo":"Manual do Solo Vivo","autores":["Ana Reis","Rui Sá"],"editora":"Terra","ano":1999,"tags":["solo"]},'
    '"capitulos":[{"titulo":"Água","linha_inicio":11},{"titulo":"","linha_inicio":1}],"remover":{"frontmatter":[1,2],"figuras":[[3]]}}'
)


def test_book(spark):
    kind = "name string, text string, response string, notes array<struct<page:int,text:string>>"
    df = spark.createDataFrame([("manual.md", BOOK, RESPONSE, [(3, "Nota longa aqui"), (4, "¹")])], kind)
    row = books.convert(df, "useful").first()
    for part in ("titulo: Manual do Solo Vivo\n", "editora: [Terra]\nano: 1999\n", "## INTRODUÇÃO\n", "O solo é um organismo vivo e complexo.", "## Água\ntexto.", "**¹ (p. 3)** Nota longa aqui"):
        assert part in row.document
    assert "CAPA" not in row.document and "²" not in row.document
    assert "## Notas" not in books.convert(df).first().document


def test_chapters(one):
    ranges = F.array(F.struct(F.lit(1).alias("low"), F.lit(2).alias("high")), F.struct(F.lit(2).alias("low"), F.lit(3).alias("high")))
    chapters = F.array(F.struct(F.lit("A").alias("title"), F.lit(5).alias("line"), F.lit("part").alias("level")), F.struct(F.lit("B").alias("title"), F.lit(2).alias("line"), F.lit("chapter").alias("level")))
    assert [(c.title, c.line) for c in one(books.moved_chapters(chapters, ranges))] == [("A", 2)]
    assert one(books.remove_ranges(F.lit("1\n2\n3\n4"), ranges)) == "4"
    titles = ["CAPÍTULO 1 - INTRODUÇÃO", "INTRODUÇÃO", "IV. Fim", "2. Solo", "VOLUME"]
    assert [one(books.chapter_title(F.lit(t))) for t in titles] == ["INTRODUÇÃO", "INTRODUÇÃO", "Fim", "Solo", "VOLUME"]


def test_checkers_and_report(spark):
    good = "# a\n\n## Page 1\n" + "words and more words " * 60 + "\n\n## Page 2\n" + "other words " * 60
    bad = "## Page 1\nx\n```json\n{}\n```\n\"body_text\": \n\n## Page 2\naaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa"
    docs = spark.createDataFrame([("good", good), ("bad", bad)], "name string, text string")
    found = quality.validate(docs)
    assert {r.target for r in found.where("severity = 'issue'").collect()} == {"bad"}
    assert {r.check for r in found.collect()} == {"syntax", "markdown", "pages"}
    assert quality.passed(found).first().passed is False and quality.passed(found.where("target = 'good'")).first().passed is True
    pages = docs.select("name", F.explode(quality.split_pages(F.col("text"))).alias("body")).withColumn("n", F.length("body"))
    text = report.quality_report(pages, found, top=1)
    assert "| good | 2 | 0 | 100.0 |  |" in text and "… 1 more" in text and "passed: no" in text


def test_state(spark):
    kind = "doc int, page int, status string, updated_at int"
    old = spark.createDataFrame([(1, 1, "failed", 1), (1, 2, "done", 5)], kind)
    new = spark.createDataFrame([(1, 1, "done", 2), (1, 2, "failed", 4), (2, 1, "done", 1)], kind)
    got = {(r.doc, r.page): r.status for r in state.upsert(old, new, ["doc", "page"]).collect()}
    assert got == {(1, 1): "done", (1, 2): "done", (2, 1): "done"}
