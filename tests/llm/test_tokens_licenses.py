import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from pagewright.llm import bpe, licenses
from pagewright.llm.queries import bpe_vocabulary


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(bpe_vocabulary())


def texts():
    r = random.Random(1)
    parts = ["a", "A", " ", "  ", "\n", "é", "1", "22", "'s", "the", "ing", "ß", "中", "😀", "<|endoftext|>", "\x1c", "\x85", "aa", "-", "=", "\t", "!!", " "]
    out = ["".join(r.choices(parts, k=r.randint(0, 40))) for _ in range(3000)]
    return out + [c * k for c in "ae =-1_\n" for k in range(1, 60)] + ["ab" * 4000, " " * 3000, "zqx" * 9000, ""]


def test_encode_like_library(library):
    own = bpe.ByteBpe(bpe_vocabulary())
    data = texts()
    ids = own.encode_batch(data)
    want = [x.ids for x in library.encode_batch(data, add_special_tokens=False)]
    assert [x.tolist() for x in ids] == want
    assert own.decode_batch(ids) == [library.decode(x, skip_special_tokens=False) for x in want]


def test_texts_are_split_without_ranges_they_do_not_hold(library):
    """The pattern for all code points is slow: it is made for a text that needs it, and all patterns split alike."""
    own = bpe.ByteBpe(bpe_vocabulary())
    odd = ["it's \x00\x7f a1 \x1c\x1d  b", "\x80\xa0 été 中文٣\ue000\uffff x\u3000 y", "<|endoftext|>a <|endoftext|>é"]
    wide = [f"{t} \U0001d538\U00010348 \U0010ffff{t}" for t in odd]
    got = [x.tolist() for x in own.encode_batch(odd)]
    assert "pattern" not in vars(own)
    got += [x.tolist() for x in own.encode_batch(wide)]
    assert got == [x.ids for x in library.encode_batch(odd + wide, add_special_tokens=False)]
    assert all(own.pattern.findall(t) == own.basic_pattern.findall(t) for t in odd) and own.pattern.findall(odd[0]) == own.ascii_pattern.findall(odd[0])


def test_waiting_workers_hold_no_words(spark):
    """A Python worker that waits for more tasks stands beside the executor's other stages: its memory of words goes."""
    path = bpe_vocabulary()
    df = spark.createDataFrame([(i, f"zq{i}x some words{i}") for i in range(400)], "doc_id long, text string").repartition(8)
    assert bpe.round_trip(df, path).agg(F.sum("n_tokens")).first()[0] > 400

    def words(batches):
        import pyarrow as pa

        rows = sum(b.num_rows for b in batches)
        known = bpe.vocabulary(path)
        yield pa.RecordBatch.from_pydict({"rows": [rows], "words": [len(known.cache) + len(known.older)]})

    assert {r.words for r in spark.range(8).repartition(8).mapInArrow(words, "rows long, words long").collect()} == {0}


def test_pairs_and_merges():
    own = bpe.ByteBpe(bpe_vocabulary())
    r = random.Random(2)
    words = [bytes(r.choices(b"aeioutnrs -", k=r.randint(1, 60))) for _ in range(500)]
    assert all(own.merged(w) == own.merged_short(w) for w in words)
    made = [i for i in own.by_bytes.values()]
    import numpy as np

    a, b = np.array(r.choices(made, k=2000)), np.array(r.choices(made, k=2000))
    want = [own.merged(own.token_bytes[x] + own.token_bytes[y]) == [x, y] for x, y in zip(a, b, strict=True)]
    assert own.compatible(a, b).tolist() == want


def test_round_trip(spark, library):
    rows = [(1, "Hello the world"), (2, None), (3, ""), (None, "x"), (1, "Hello the world"), (4, "<|endoftext|>é")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("token_ids", F.lit("clash"))
    got = bpe.round_trip(df, bpe_vocabulary()).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    for i, text in dict(rows).items():
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert by_id[i].n_tokens == len(ids)
        assert by_id[i].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert by_id[i].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()
    assert bpe.round_trip(df.limit(0), bpe_vocabulary()).count() == 0


def base_places(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    found = [(i, label) for label, p in licenses.BASE.items() for i in range(len(words)) if words[i : i + len(p.split())] == p.split()]
    return len(words), sorted(found)


def labels_of(text):
    """Every template tried at every word."""
    file = licenses.words(text)
    here = lambda t, start: all(start + at >= 0 and file[start + at : start + at + len(p)] == p for at, p in t.phrases)
    return sorted({t.label for t in licenses.templates() for start in range(-len(t.words), len(file)) if here(t, start)})


def test_license_labels():
    r = random.Random(5)
    bodies = [t.words for t in licenses.templates()]
    index = licenses.Index(licenses.templates(), 100, {w: r.randrange(100) for b in bodies for w in b})
    for _ in range(400):
        file = []
        for _ in range(r.randint(0, 4)):
            body = list(r.choice(bodies))
            if r.random() < 0.4:
                body[r.randrange(len(body))] = b"other"
            file += body[r.randrange(3) :] + [b"the"] * r.randrange(3)
        text = b" ".join(file).decode()
        got = index.scan(text)
        assert got[5] == ",".join(labels_of(text)) and bool(got[5]) == (got[6] > 0)
    bare, whole = index.scan("the mit license"), index.scan(licenses.AROUND["mit"])
    assert 0 < bare[6] < 0.7 and whole[6] == 1.0 and (bare[2], whole[2]) == (1, 6)


def test_licenses(spark):
    r = random.Random(3)
    parts = ["mit", "license", "MIT License", "apache", "Apache\nLicense", "general public", "license", "gnu", "É", "x9", ".", "--", "version 2 0", "Licensed under CC BY-NC 4.0."]
    rows = [(i, " ".join(r.choices(parts, k=r.randint(0, 25)))) for i in range(300)]
    rows += [(900, None), (901, ""), (902, "Redistribution and use in source and binary forms, with or without modification, are permitted"), (903, "general public license general public license"), (None, "mit license"), (904, "mit license " * 3000)]
    got = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string").withColumn("labels", F.lit(1))).collect()
    by_id = {x.doc_id: x for x in got}
    assert len(got) == len(rows)
    for i, text in rows:
        n, found = base_places(text)
        x = by_id[i]
        assert (x.n_words, x.n_base) == (n, len(found))
        assert (x.first_word, x.last_word) == ((found[0][0], found[-1][0]) if found else (None, None))
        assert x.base_labels == ",".join(sorted({label for _, label in found}))
        assert set(filter(None, x.base_labels.split(","))) <= set(filter(None, x.labels.split(","))) and 0 <= x.score <= 1
        assert bool(x.labels) == (x.score > 0)
    assert by_id[902].labels == "bsd" and "cc-by-nc-4.0" in {y for x in got for y in x.labels.split(",")}
    assert licenses.scan(spark.createDataFrame([], "doc_id long, text string")).count() == 0
