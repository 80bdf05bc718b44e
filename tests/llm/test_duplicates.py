import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from pagewright.llm import components, decontaminate, linededup, neardup, shingles
from pagewright.llm.queries import ORACLES, QUERIES


def labels_of(n, links):
    up = list(range(n))

    def find(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


@pytest.mark.parametrize("links", [[], [(i, i + 1) for i in range(60)], [(0, i) for i in range(1, 50)] + [(70, 71), (71, 72)], [(5, 5)]])
def test_components(spark, links):
    got = components.components(spark.createDataFrame(links, "u long, v long"))
    want = {i: label for i, label in enumerate(labels_of(80, links)) if label != i}
    assert {r.node: r.label for r in got.collect()} == want


def test_random_components(spark):
    r = random.Random(4)
    links = [(r.randrange(200), r.randrange(200)) for _ in range(150)]
    want = {i: label for i, label in enumerate(labels_of(200, links)) if label != i}
    assert {x.node: x.label for x in components.components(spark.createDataFrame(links, "u long, v long")).collect()} == want


def variants(r, n, words, changes):
    base = [f"w{r.randrange(5000)}" for _ in range(words)]
    out = []
    for _ in range(n):
        v = base[:]
        for _ in range(r.randrange(changes + 1)):
            v[r.randrange(words)] = f"x{r.randrange(9999)}"
        out.append(" ".join(v))
    return out


def brute_classes(docs, idf):
    features = [neardup.weights(shingles.shingle_hashes(shingles.word_hashes(t)), idf) for _, t in docs]
    links = [(i, j) for i in range(len(docs)) for j in range(i) if len(features[i][0]) and len(features[j][0]) and neardup.similarity(features[i], features[j]) >= neardup.LEAST]
    label = labels_of(len(docs), links)
    least = defaultdict(lambda: 1 << 60)
    for (i, _), c in zip(docs, label, strict=True):
        least[c] = min(least[c], i)
    return {i: least[c] for (i, _), c in zip(docs, label, strict=True)}


def test_near_duplicates(spark):
    r = random.Random(6)
    docs = []
    for n, words, changes in ((40, 60, 3), (25, 200, 9), (30, 80, 0), (5, 12, 1)):
        docs += variants(r, n, words, changes)
    docs += ["one two", "One, two!", "one", "", None, "!!", "same words here now yes", "same words here now yes"]
    docs += [" ".join(f"u{r.randrange(10**6)}" for _ in range(40)) for _ in range(30)] + variants(r, 3, 20000, 900)
    r.shuffle(docs)
    docs = list(enumerate(docs))
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"class_id": F.lit("x"), "fp": F.lit(1)}).repartition(5)
    want = brute_classes(docs, neardup.inverse_frequencies(df))
    got = {x.doc_id: x.class_id for x in neardup.classes(df).collect()}
    assert got == want and len(set(want.values())) < len(docs) - 40
    kept = neardup.one_of_each(df)
    assert {x.doc_id for x in kept.collect()} == {i for i, c in want.items() if i == c} and kept.columns == df.columns
    assert neardup.classes(df.limit(0)).count() == 0


def test_near_duplicates_repeated_rows(spark):
    rows = [(1, "a b c d e f g"), (1, "a b c d e f g"), (2, "a b c d e f g"), (None, "a b c d e f g"), (3, "z y x w v u t")]
    got = sorted((r.doc_id or 0, r.class_id or 0) for r in neardup.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == [(0, 1), (1, 1), (1, 1), (2, 1), (3, 3)]


def test_document_counts_are_exact(spark):
    """However many other shingles there are: one held by one document weighs 2."""
    r = random.Random(5)
    docs = [(i, " ".join(f"z{r.getrandbits(60)}" for _ in range(3000)) + " by all of these texts") for i in range(700)] + [(900, None)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(8)
    idf = neardup.inverse_frequencies(df)
    found, weight = neardup.weights(shingles.shingle_hashes(shingles.word_hashes(docs[3][1])), idf)
    last = shingles.shingle_hashes(shingles.word_hashes("by all of these texts"))[0]
    assert len(idf.found) > 2 * 10**6 and np.allclose(weight[found != last], 2.0)
    assert np.isclose(weight[found == last], 1 + math.log1p(701 / 700) / math.log1p(701))
    assert {x.class_id for x in neardup.classes(df.limit(20)).collect()} <= {i for i, _ in docs}


@pytest.mark.parametrize("size, similarity", [(500, 0.8), (500, 0.6), (20000, 0.8), (20000, 0.85)])
def test_samples_agree(size, similarity):
    """Samples of texts of any length agree as often as the texts are similar, so such texts nearly always share a band."""
    r = np.random.default_rng(3)
    met, agree, runs = 0, 0.0, 30 if size > 1000 else 200
    for _ in range(runs):
        common = round(size * 2 * similarity / (1 + similarity))
        shared, own = r.integers(0, 2**63, common, dtype=np.uint64), r.integers(0, 2**63, 2 * (size - common), dtype=np.uint64)
        # Rare shingles weigh more than the shared ones would, if those were common: here all weigh the same.
        a, b = (neardup.samples(x, np.full(len(x), 1.7)) for x in (np.sort(np.concatenate((shared, o))) for o in np.split(own, 2)))
        met += (neardup.bands(a) == neardup.bands(b)).any()
        agree += (a == b).mean()
    assert abs(agree / runs - similarity) < 4 * math.sqrt(similarity * (1 - similarity) / (neardup.SAMPLES * runs)) + 0.01
    assert similarity < 0.8 or met >= 0.99 * runs


def lines_kept(docs):
    """The rule by brute force: which lines of which documents stay."""
    places = sorted((i, n, set(line.lower().split(" ")) - {""}) for i, t in docs if t is not None for n, line in enumerate(t.split("\n")))
    gone = {(i, n) for k, (i, n, s) in enumerate(places) if s and any(e and 5 * len(e & s) >= 4 * len(e | s) and (j, m) < (i, n) for j, m, e in places[:k])}
    return {i: None if t is None else "\n".join(x for n, x in enumerate(t.split("\n")) if (i, n) not in gone) for i, t in docs}


def test_line_dedup(spark):
    r = random.Random(8)
    pool = sum((variants(r, n, words, changes) for n, words, changes in ((60, 30, 4), (40, 12, 1), (30, 5, 1), (20, 90, 20), (10, 3, 1))), []) + ["", " ", "a", "A", "a  a", "b a"]
    docs = [(i, "\n".join(r.choices(pool, k=r.randint(0, 6)))) for i in range(80)] + [(500, None), (501, ""), (502, "w " * 3000 + "\n" + "w " * 2999 + "q")]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"gone": F.lit(1), "line": F.lit("x"), "n_chars": F.lit(7)}).repartition(4)
    got = linededup.deduplicated(df)
    want = lines_kept(docs)
    assert {x.doc_id: x.text for x in got.collect()} == want
    stage = linededup.stage(df)
    assert stage.columns == df.columns
    assert {x.doc_id: (x.text, x.n_chars) for x in stage.collect()} == {i: (want[i], None if want[i] is None else len(want[i])) for i, t in docs if want[i] == t or want[i].strip()}
    assert linededup.deduplicated(df.limit(0)).count() == 0


@pytest.mark.parametrize("share", [1, 8, 1 << 40])
def test_order_of_tokens_never_changes_the_result(spark, monkeypatch, share):
    """Whether all documents, some or none are drawn to estimate how rare tokens are."""
    monkeypatch.setattr(linededup, "SHARE", share)
    r = random.Random(12)
    pool = variants(r, 40, 25, 4) + variants(r, 25, 8, 1) + ["the of " + x for x in variants(r, 25, 12, 3)]
    docs = [(i, "\n".join(r.choices(pool, k=r.randint(1, 5)))) for i in range(60)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    assert {x.doc_id: x.text for x in linededup.deduplicated(df).collect()} == lines_kept(docs)


def test_rarity_is_estimated_from_a_share(spark):
    docs = spark.range(40000).selectExpr("id AS doc_id", "concat('common u', id) AS text")
    level = F.get(linededup.rarity(docs), linededup._hash(F.lit("common")).bitwiseAND(F.lit((1 << linededup.SKETCH_BITS) - 1)).cast("int"))
    assert spark.range(1).select(level.alias("x")).first().x == math.floor(math.log(40000, 4))
    own = F.get(linededup.rarity(docs.where("doc_id < 400")), linededup._hash(F.col("t")).bitwiseAND(F.lit((1 << linededup.SKETCH_BITS) - 1)).cast("int"))
    drawn = spark.range(400).selectExpr("concat('u', id) AS t").where(own > 0).count()
    assert 0 < drawn < 40  # 400 / SHARE of the documents are counted, about


def test_long_lines(spark):
    r = random.Random(9)
    base = [f"t{i}" for i in range(2500)]
    near = base[:2400] + [f"n{i}" for i in range(100)]
    docs = [(1, " ".join(base)), (2, " ".join(r.sample(near, len(near)))), (3, " ".join(base[:1500]))]
    got = linededup.deduplicated(spark.createDataFrame(docs, "doc_id long, text string"))
    assert {x.doc_id: x.n_removed for x in got.collect()} == {1: 0, 2: 1, 3: 0}


def test_line_dedup_query(spark, sf_dir):
    from oracle import connect, same

    same(QUERIES["op2_linededup"](spark, sf_dir).toPandas(), connect(sf_dir).sql(ORACLES["op2_linededup"]).df())


def brute_leaks(docs, items, least=0.8):
    split = lambda t: [w for w in re.split(r"[\W_]+", (t or "").lower()) if w]
    runs = lambda w, k: [tuple(w[i : i + k]) for i in range(len(w) - k + 1)]
    out = {}
    known = [(i, split(t)) for i, t in items if split(t)]
    sets = [(i, runs(w, min(5, len(w)))) for i, w in known]
    count = Counter(s for _, v in sets for s in set(v))
    weight = lambda ss: sum(math.log1p(len(sets) / max(1, count.get(s, 0))) for s in ss)
    for d, t in docs:
        for i, v in sets:
            own = runs(split(t), len(v[0]))
            best = 0.0
            for at in range(max(1, len(own) - len(v) + 1)):
                win = set(own[at : at + len(v)])
                if win & set(v):
                    best = max(best, weight(win & set(v)) / max(weight(win), weight(set(v))))
            if best >= least:
                out[d, i] = max(out.get((d, i), 0), best)
    return out


def test_decontamination(spark):
    r = random.Random(10)
    word = lambda: f"w{r.randrange(400)}"
    items = [(i, " ".join(word() for _ in range(n))) for i, n in enumerate((20, 35, 14, 50, 7, 5, 3, 1, 28))] + [(20, None), (21, "!!"), (22, "w1 W2, w3 w4 w5 w6 w7 w8")]
    docs = []
    for d in range(60):
        own = [word() for _ in range(r.randint(0, 120))]
        i, text = items[r.randrange(9)]
        inside = text.split()
        if d % 3:
            for _ in range(r.randrange(2)):
                inside[r.randrange(len(inside))] = word()
            at = r.randrange(len(own) + 1)
            own[at:at] = inside
        docs.append((d, " ".join(own).title() if d % 2 else ", ".join(own)))
    docs += [(100, None), (101, ""), (102, items[3][1]), (102, items[3][1]), (103, items[3][1] * 40)]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"hs": F.lit(1), "n": F.lit("x"), "item_id": F.lit(2)}).repartition(4)
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(5))
    got = {(x.doc_id, x.item_id): x.similarity for x in decontaminate.matches(df, bench).collect()}
    want = brute_leaks(docs, items)
    # Windows are laid where shingles meet, brute force tries all: the same leaks, and never a better window.
    assert set(got) == set(want) and all(got[k] <= want[k] + 1e-9 for k in got)
    clean = decontaminate.clean(df, bench)
    assert {x.doc_id for x in clean.collect()} == {d for d, _ in docs} - {d for d, _ in want} and clean.columns == df.columns
    assert decontaminate.matches(df.limit(0), bench).count() == 0 and decontaminate.matches(df, bench.limit(0)).count() == 0


def test_shared_prompt_is_no_leak(spark):
    """What all of many items share weighs ln 2, not more."""
    r = random.Random(12)
    text = lambda n: " ".join(f"q{r.getrandbits(50)}" for _ in range(n))
    prompt = text(100)
    items = [(i, f"{prompt} {text(8)}") for i in range(100)]
    docs = [(1, f"{prompt} {text(8)}"), (2, items[7][1]), (3, text(80))]
    got = decontaminate.matches(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {(x.doc_id, x.item_id) for x in got.collect()} == {(2, 7)} == set(brute_leaks(docs, items))


def test_radius_guarantee(spark):
    """Fingerprints within the guaranteed radius meet; of pairs at a similarity of 0.8 nearly all do, of others few."""
    r = np.random.default_rng(11)
    a = r.integers(-(2**63), 2**63, 300, dtype=np.int64)
    near = lambda p: a ^ np.packbits(r.random((len(a), 64)) < p, axis=1).view(np.int64)[:, 0]
    exact = [a.copy() for _ in range(3)]
    for n in range(len(a)):
        for bit in r.choice(64, decontaminate.GUARANTEED, replace=False):
            exact[0][n] ^= np.int64(1) << np.int64(bit)
    share = lambda s: math.acos(s) / math.pi
    met = {}
    for name, b in (("guaranteed", exact[0]), (0.8, near(share(0.8))), (0.9, near(share(0.9))), ("other", near(0.5))):
        rows = [(i, int(x), int(y)) for i, (x, y) in enumerate(zip(a, b, strict=True))]
        df = spark.createDataFrame(rows, "i long, x long, y long")
        met[name] = df.where(F.arrays_overlap(decontaminate.keys_of(F.col("x"), 1), decontaminate.keys_of(F.col("y"), 2))).count() / len(a)
    assert met["guaranteed"] == 1 and met[0.8] > 0.92 and met[0.9] > 0.98 and met["other"] < 0.1


def test_recall_of_leaks(spark):
    """Passages with one to four changed words in 60: at least nine of ten matches by brute force are found."""
    r = random.Random(19)
    word = lambda: f"w{r.randrange(3000)}"
    items = [(i, " ".join(word() for _ in range(60))) for i in range(40)]
    docs = []
    for d in range(200):
        inside = items[d % 40][1].split()
        for _ in range(d % 5):
            inside[r.randrange(60)] = word()
        docs.append((d, " ".join([word() for _ in range(30)] + inside + [word() for _ in range(30)])))
    got = {(x.doc_id, x.item_id) for x in decontaminate.matches(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    want = set(brute_leaks(docs, items))
    assert got <= want and len(got) >= 0.9 * len(want) > 60


@pytest.mark.parametrize("least", [0.8, 0.6])
def test_no_leak_is_left_out(spark, least):
    """Pairs near the threshold, and pairs whose own words outweigh what they share with all other items."""
    r = random.Random(23)
    word = lambda: f"w{r.randrange(10**6)}"
    text = lambda n: " ".join(word() for _ in range(n))
    items, docs = [(i, text(60)) for i in range(20)], []
    for d in range(60):
        inside = items[d % 20][1].split()
        for at in range(d % 7, 60, r.choice((17, 23, 31))):
            inside[at] = word()
        docs.append((d, " ".join([text(9), *inside, text(9)])))
    prompt = text(60)
    items += [(100 + i, f"{prompt} {text(3)}") for i in range(20)]
    docs += [(1000 + i, f"{text(20)} {prompt} {' '.join(items[20 + i][1].split()[-3:][: 1 + i % 3])} {text(20)}") for i in range(20)]
    # The start of an item is an item too; a document that ends there holds both.
    items += [(200, text(64)), (201, text(60))]
    items += [(300, items[-2][1] + " " + text(3)), (301, items[-1][1] + " " + text(2))]
    docs += [(2000, items[-4][1]), (2001, items[-3][1])]
    got = decontaminate.matches(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), least)
    want = brute_leaks(docs, items, least)
    assert {(x.doc_id, x.item_id) for x in got.collect()} == set(want) and {(2000, 200), (2000, 300), (2001, 201), (2001, 301)} <= set(want) and len(want) > 40


def test_long_items_and_shared_ids(spark):
    r = random.Random(20)
    text = lambda n: " ".join(f"q{r.getrandbits(50)}" for _ in range(n))
    long, other = text(20000), text(30)
    items = [(1, long), (1, other), (2, "one two"), (2, "one two")]
    docs = [(1, f"{text(50)} {long} {text(50)}"), (2, f"{text(5)} {other}"), (2, "nothing"), (3, "say one two three"), (4, long[: len(long) // 2])]
    got = decontaminate.matches(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {(x.doc_id, x.item_id, x.first_word) for x in got.collect()} == {(1, 1, 50), (2, 1, 5), (3, 2, 1)}



def test_rows_that_share_an_id_keep_their_own_lines(spark):
    rows = [(1, "p q r s"), (2, "p q r s"), (2, "a wholly different line"), (None, "p q r s"), (3, "a wholly\na wholly different line")]
    got = sorted((r.doc_id or 0, r.text, r.n_removed, r.n_repeats) for r in linededup.deduplicated(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == [(0, "p q r s", 0, 0), (1, "p q r s", 0, 0), (2, "", 1, 1), (2, "a wholly different line", 0, 0), (3, "a wholly", 1, 1)]


def test_a_very_common_token(spark):
    """More lines than FREQUENT tokens count hold it; sizes in neighbouring classes still meet."""
    r = random.Random(15)
    lines = [f"the the{i} it{i} was{i}" + " and" * (i % 2) for i in range(17000)]
    near = ["the a b c d e f g h i", "the a b c d e f g h i j", "the a b c d e f g h", "the a b c d e f z y x"]
    docs = [(i, "\n".join(lines[170 * i : 170 * (i + 1)])) for i in range(100)] + [(200 + i, x) for i, x in enumerate(near)]
    r.shuffle(docs)
    got = {x.doc_id: x.n_removed for x in linededup.deduplicated(spark.createDataFrame(docs, "doc_id long, text string").repartition(4)).where("n_removed > 0").collect()}
    assert got == {201: 1, 202: 1}


def test_many_lines(spark):
    """One text of very many lines takes time in proportion."""
    own = [f"u{i} v{i} w{i}" for i in range(60000)]
    docs = [(1, "\n".join(own[::2])), (2, "\n".join(own))]
    got = {x.doc_id: x.text for x in linededup.deduplicated(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == {1: docs[0][1], 2: "\n".join(own[1::2])}
