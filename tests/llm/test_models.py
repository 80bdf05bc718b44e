import numpy as np
import pytest
from pyspark.sql import functions as F

from pagewright.llm import boosting, html, langid, quality

DOCS = "doc_id long, text string, lang string"


def test_language(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet".replace("sf0.001", "sf0.01"))
    got = langid.identified(docs).join(docs.select("doc_id", "lang"), "doc_id")
    held = got.where("held_out")
    assert 0 < held.count() < docs.count() / 3
    assert held.where("lang_pred = lang").count() / held.count() > 0.97
    assert got.where("score < 0 OR score > 1").isEmpty()
    assert langid.accepted(docs).count() > 0.98 * docs.count() and langid.accepted(docs).columns == docs.columns


def test_language_odd_rows(spark):
    rows = [(i, f"the {w} of this", "en") for i, w in enumerate("cat dog sun tree".split() * 5)] + [(100 + i, f"la {w} de que", "es") for i, w in enumerate("casa sol perro".split() * 6)]
    rows += [(900, None, "en"), (901, "", None), (902, "12 %% 3", "es"), (None, "the cat", "en"), (903, "la casa", None), (1, "the dog of this", "en")]
    df = spark.createDataFrame(rows, DOCS).withColumns({"score": F.lit("x"), "lang_pred": F.lit(1)})
    got = {(r.doc_id): r for r in langid.identified(df).collect()}
    assert langid.identified(df).count() == len(rows)
    assert all((got[i].lang_pred, got[i].score) == ("und", 0.0) for i in (900, 901, 902))
    assert got[903].lang_pred == "es" and got[None].held_out is False and got[0].lang_pred == "en"
    assert {r.doc_id for r in langid.accepted(df).collect()}.isdisjoint({900, 901, 902})
    none = langid.identified(df.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r.lang_pred for r in none} == {"und"}
    assert langid.identified(df.limit(0)).count() == 0


def test_score_with_many_families():
    """Sure texts keep a high score among dozens of families."""
    r = np.random.default_rng(4)
    texts, langs = [], []
    for k in range(40):
        words = ["".join(r.choice(list("abcdefghijklmnopqrstuvwxyz"), 5)) for _ in range(25)]
        for _ in range(12):
            texts.append(" ".join(r.choice(words, 40)).encode())
            langs.append(f"x{k}")
    x = langid.features.matrix(texts)
    learned = np.arange(len(x)) % 3 > 0
    model = langid.fit(x[learned], [n for n, keep in zip(langs, learned, strict=True) if keep])
    got, score = model.predict(x[~learned])
    assert got == [n for n, keep in zip(langs, learned, strict=True) if not keep]
    assert (score >= langid.LEAST_SCORE).all() and score.mean() > 0.6 and score.max() <= 1


def test_estimate():
    """Labellers of known accuracy: the posteriors find the hidden classes and better labellers weigh more."""
    r = np.random.default_rng(1)
    y = r.random(6000) < 0.8
    right = np.array([0.95, 0.9, 0.85, 0.7, 0.6])
    votes = np.where(r.random((6000, 5)) < right, y[:, None], ~y[:, None])
    votes = np.where(r.random((6000, 5)) < 0.2, 0, np.where(votes, 1, -1))
    names = ["".join("-0+"[v + 1] for v in row) for row in votes]
    counts = {n: names.count(n) for n in set(names)}
    post = quality.estimate(counts)
    guess = np.array([post[n] > 0.5 for n in names])
    majority = votes.sum(1) > 0
    assert (guess == y).mean() > max(0.93, (majority == y).mean())
    assert quality.estimate({}) == {}


def test_votes():
    vote = lambda text: dict(zip(quality.LABELLERS, quality.votes(text), strict=True))
    assert vote("word")["repetition"] == vote("word")["variety"] == 0
    assert vote("buy now " * 40)["variety"] == -1 and vote("spam " * 40)["repetition"] == -1
    prose = " ".join(f"w{chr(97 + i % 26)}{chr(97 + i % 17)}" for i in range(200))
    assert vote(prose)["variety"] == vote(" ".join([prose] * 50))["variety"] == 1
    assert set(vote(None).values()) == {0, -1} and vote("")["letters"] == -1


def test_estimate_by_hand():
    """The same steps, one pattern, labeller and class at a time."""
    counts, rounds = {"++-": 40, "+0+": 25, "--0": 12, "-+-": 9, "000": 3}, 7
    good = {p: 1 / (1 + np.exp(-(p.count("+") - 3 * p.count("-")))) for p in counts}
    total = sum(counts.values())
    for _ in range(rounds):
        of = lambda p, c: good[p] if c else 1 - good[p]
        odds = {}
        for p in counts:
            by_class = []
            for c in (0, 1):
                value = (sum(n * of(q, c) for q, n in counts.items()) + 1) / (total + 2)
                for at in range(3):
                    held = {v: sum(n * of(q, c) for q, n in counts.items() if q[at] == v) + 5 * ({"-": 0.7, "0": 1, "+": 0.3} if c == 0 else {"-": 0.3, "0": 1, "+": 0.7})[v] for v in "-0+"}
                    value *= held[p[at]] / sum(held.values())
                by_class.append(value)
            odds[p] = by_class[1] / (by_class[0] + by_class[1])
        good = odds
    got = quality.estimate(counts, rounds)
    assert all(abs(got[p] - good[p]) < 1e-9 for p in counts)


def test_language_votes():
    """The family by the greatest margin, the language by votes of pairs, each worked out one text at a time."""
    r = np.random.default_rng(6)
    texts, langs = [], []
    for lang in ("en", "de", "nl", "fr", "es", "zz"):
        words = ["".join(r.choice(list("abcdefghijklmnop"), 4)) for _ in range(12)]
        texts += [" ".join(r.choice(words, 8)).encode() for _ in range(20)]
        langs += [lang] * 20
    x = langid.features.matrix(texts)
    model = langid.fit(x, langs)
    got, _ = model.predict(x)
    for row, lang in zip(x, got, strict=True):
        margins = [float(row @ w[:-1] + w[-1]) for w in model.family_weights]
        family = model.families[int(np.argmax(margins))]
        own, votes = model.languages[family], {}
        for a, b, w in model.pairs[family]:
            m = float(row @ w[:-1] + w[-1])
            votes[own[a if m > 0 else b]] = votes.get(own[a if m > 0 else b], 0) + 1
        assert langid.family_of(lang) == family and votes.get(lang, 0) == max(votes.values(), default=0)


def test_many_languages(spark):
    """No language is left out, however many there are."""
    rows = [(1000 * k + i, " ".join(f"{chr(97 + k % 26)}{chr(97 + k // 26)}{c}" for c in "abcde"), f"x{k}") for k in range(130) for i in range(3)]
    model = langid.learn(spark.createDataFrame(rows, DOCS))
    assert sum(map(len, model.languages.values())) > 120


def test_quality(spark, sf_dir):
    base = sf_dir.replace("sf0.001", "sf0.01")
    docs, labels = spark.read.parquet(f"{base}/documents.parquet"), spark.read.parquet(f"{base}/labels.parquet")
    got = quality.scored(docs).join(labels, "doc_id").toPandas()
    assert ((got["keep"]) == (got["quality"] == 1)).mean() > 0.93
    assert got[got["quality"] == 1]["keep"].mean() > 0.95 and got[got["quality"] == 0]["keep"].mean() < 0.3
    odd = spark.createDataFrame([(1, None), (2, ""), (None, "a b c"), (3, "! " * 50000), (1, None)], "doc_id long, text string").withColumn("keep", F.lit(3))
    rows = quality.scored(odd).collect()
    assert len(rows) == 5 and all(0 <= r.score <= 1 and 0 <= r.posterior <= 1 for r in rows)
    assert quality.scored(odd.limit(0)).count() == 0


def test_boosting():
    r = np.random.default_rng(2)
    x = r.normal(size=(3000, 6))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    model = boosting.fit(x[:2000], y[:2000], rounds=30)
    assert ((model.margin(x[2000:]) > 0) == y[2000:]).mean() > 0.95


def test_parse():
    p = html.parse('<p>a<b>c<br>d<p>e<script>var t="</p><p>x";</script><ul><li>1<li>2</ul><!-- <p>no --><img alt=">">f &amp; g')
    assert html.rendered(p, [True] * len(p.parent)) == "ac d\ne\n1\n2\nf & g"
    assert html.rendered(html.parse(""), [True]) == ""
    assert html.rendered(html.parse("a < b <"), [True]) == "a < b <"
    deep = html.parse("<div>" * 5000 + "x")
    assert html.rendered(deep, [True] * len(deep.parent)) == "x"


def test_parse_embedded():
    """SVG, MathML and fallbacks are nodes like others; a closed one skips nothing."""
    p = html.parse('<p>a <svg class="i"/>b <math><mi>x</mi><mo>=</mo><mn>1</mn></math> c</p><math/><object>d</object><noscript><p>e</p></noscript><svg><path d="m"/><text>f</text></svg><p>g')
    assert html.rendered(p, [True] * len(p.parent)).replace("\n", " ") == "a b x=1 c d e f g"
    open_ = html.parse("<article><svg><path><p>h</p></article>")
    assert open_.tag[open_.runs[0][0]] == "p"
    assert {"math", "object", "noscript", "svg"} <= set(p.tag)


def test_decode_keeps_no_child_of_a_dropped_node():
    p = html.parse("<div><p>a</p></div><div><p>b</p></div>")
    odds = np.array([1.0, -5.0, 2.0, 1.0, 3.0])
    assert html.decode(p, odds) == [True, False, False, True, True]
    assert html.decode(p, np.array([1.0, -1.0, 2.0, 1.0, -3.0])) == [True, True, True, True, False]


@pytest.fixture(scope="module")
def model():
    return html.trained()


def test_extract_held_out_pages(model):
    maker, good = html._Maker(12345), 0
    for _ in range(150):
        page = maker.page()
        p = html.parse(page)
        main = p.marked[:]
        for i in range(1, len(main)):
            main[i] = main[i] or main[p.parent[i]]
        good += html.rendered(p, main) == html.extract_batch([page.replace(f" {html.MARK}", "")], model)[0]
    assert good > 0.9 * 150


def test_extract(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    rows = html.extract(pages.withColumn("text", F.lit(1))).collect()
    assert len(rows) == pages.count()
    import re
    from html import unescape

    raw = {r.page_id: r.html for r in pages.collect()}
    for r in rows:
        inside = re.search("<article>(.*)</article>", raw[r.page_id], re.S)[1]
        blocks = [" ".join(unescape(re.sub("</?b>|<br>", " ", b)).split()) for b in re.split("</?(?:p|h1)>", inside)]
        assert r.text == "\n".join(b for b in blocks if b) and r.n_chars == len(r.text)
    odd = spark.createDataFrame([(1, "u", None), (2, None, ""), (None, "u", "<p>x"), (3, "u", "<script>only")], "page_id long, url string, html string")
    assert {(r.page_id, r.text, r.n_chars) for r in html.extract(odd).collect() if r.page_id != None} == {(1, "", 0), (2, "", 0), (3, "", 0)}  # noqa: E711
    assert html.extract(odd.limit(0)).count() == 0
