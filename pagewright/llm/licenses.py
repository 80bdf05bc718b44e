"""Licence scan by a positional index of rare words.

Every template is a word sequence with mandatory key phrases that must stand in it. The index maps each word of the key
phrases to (template, position); the document frequency of all template words is counted over the whole corpus. In a
file, the licence words it holds are looked up from the one with the highest IDF on; each word's places name the starts
where a template can lie, and the starts of the file's ANCHORS rarest words of a template are intersected. A template goes
as soon as its starts are empty. At the starts that are left all key phrases are verified, word by word. Any occurrence
holds all words of its phrases, so none is missed.

The score is the share of a template's IDF mass that stands in its place around the best occurrence, so a bare phrase scores
less than a whole notice.

A null text is an empty one: no words, no labels, score 0. Repeated rows are scanned each. Words are what is left when
A-Z are lower-cased and all other ASCII but digits and a-z separates.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import arrow_map

ANCHORS = 3
_TABLE = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)

# The base phrases and their labels.
BASE = {"mit": "mit license", "apache": "apache license", "gpl": "general public license"}
# The notices that base phrases mostly stand in, and public licence notices with the phrases that identify them.
AROUND = {
    "mit": "this project is licensed under the mit license see the license file for details",
    "apache": "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license",
    "gpl": "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation",
}
NOTICES = [
    ("apache-2.0", "licensed under the apache license version 2 0", ["apache license version 2 0"]),
    ("gpl-2.0", "licensed under the gnu general public license version 2", ["gnu general public license version 2"]),
    ("gpl-3.0", "licensed under the gnu general public license version 3", ["gnu general public license version 3"]),
    ("lgpl", "under the terms of the gnu lesser general public license", ["gnu lesser general public license"]),
    ("agpl", "under the terms of the gnu affero general public license", ["gnu affero general public license"]),
    ("cc-by-4.0", "licensed under cc by 4 0", ["cc by 4 0"]),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0", ["cc by sa 4 0"]),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0", ["cc by nc 4 0"]),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", ["permission is hereby granted free of charge"]),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee", ["permission to use copy modify and or distribute"]),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", ["redistribution and use in source and binary forms", "with or without modification"]),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", ["mozilla public license v 2 0"]),
    ("zlib", "this software is provided as is without any express or implied warranty permission is granted to anyone to use this software for any purpose including commercial applications", ["without any express or implied warranty", "permission is granted to anyone to use this software for any purpose"]),
    ("epl-2.0", "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0", ["eclipse public license 2 0"]),
    ("cc0-1.0", "to the extent possible under law the author has waived all copyright under creative commons zero cc0 1 0 universal", ["cc0 1 0 universal"]),
    ("boost-1.0", "distributed under the boost software license version 1 0", ["boost software license version 1 0"]),
    ("unlicense", "this is free and unencumbered software released into the public domain", ["free and unencumbered software"]),
]


def words(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_TABLE).split()


@dataclass
class Template:
    label: str
    base: bool
    words: list[bytes]
    #: (start in the template, words)
    phrases: list[tuple[int, list[bytes]]]


def _within(inner: list[bytes], outer: list[bytes]) -> int:
    return next(i for i in range(len(outer)) if outer[i : i + len(inner)] == inner)


def templates(notices=NOTICES) -> list[Template]:
    out = []
    for base, label, text, phrases in [*((True, n, AROUND[n], [p]) for n, p in BASE.items()), *((False, *n) for n in notices)]:
        body = words(text)
        out.append(Template(label, base, body, [(_within(words(p), body), words(p)) for p in phrases]))
    return out


def document_frequencies(df: DataFrame, vocabulary: set[bytes], text_col: str = "text") -> tuple[int, dict[bytes, int]]:
    """The number of documents, and of those that hold each word of the (fixed, small) vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for text in batch.column(0):
                seen.update(vocabulary.intersection(words(text.as_py())))
                seen[b""] += 1
        out = [pa.array([w.decode() for w in seen], pa.string()), pa.array(seen.values(), pa.int64())]
        yield pa.RecordBatch.from_arrays(out, ["word", "docs"])

    found = df.select(F.col(text_col).alias("text")).mapInArrow(run, "word string, docs long")
    counts = {r.word.encode(): r.docs for r in found.groupBy("word").agg(F.sum("docs").alias("docs")).collect()}
    return counts.pop(b"", 0), counts


class Index:
    def __init__(self, items: list[Template], documents: int, frequency: dict[bytes, int]):
        self.idf = {w: math.log((1 + documents) / (1 + frequency.get(w, 0))) + 1e-6 for t in items for w in t.words}
        self.items = items
        self.mass = [[self.idf[w] for w in t.words] for t in items]
        self.postings: dict[bytes, list[tuple[int, int]]] = {}
        for n, t in enumerate(items):
            for at, w in {(at + i, w) for at, p in t.phrases for i, w in enumerate(p)}:
                self.postings.setdefault(w, []).append((n, at))
        self.needed = [len({w for _, p in t.phrases for w in p}) for t in items]

    def places(self, file: list[bytes]) -> list[tuple[int, int]]:
        """(template, start in the file) of every verified place."""
        held = set(file).intersection(self.postings)
        words_of = Counter(n for w in held for n in {n for n, _ in self.postings[w]})
        # Only templates all of whose mandatory words are somewhere in the file.
        open_ = {n for n, found in words_of.items() if found == self.needed[n]}
        if not open_:
            return []
        stands: dict[bytes, list[int]] = {w: [] for w in held}
        for i, w in enumerate(file):
            if w in stands:
                stands[w].append(i)
        starts: dict[int, set[int]] = {}
        used: Counter = Counter()
        for w in sorted(held, key=lambda w: (-self.idf[w], w)):
            mine: dict[int, list[int]] = {}
            for n, at in self.postings[w]:
                if n in open_ and used[n] < ANCHORS:
                    mine.setdefault(n, []).append(at)
            for n, ats in mine.items():
                # A word that stands several times in a template must be there each time.
                for at in ats:
                    here = {i - at for i in stands[w]}
                    starts[n] = starts[n] & here if n in starts else here
                used[n] += 1
                if not starts[n]:
                    open_.discard(n)
        whole = lambda n, start: all(start + at >= 0 and file[start + at : start + at + len(p)] == p for at, p in self.items[n].phrases)
        return [(n, start) for n in sorted(open_) for start in starts[n] if whole(n, start)]

    def scan(self, text: str | None) -> tuple:
        file = words(text)
        base, base_labels, labels, score = [], set(), set(), 0.0
        for n, start in self.places(file):
            t, mass = self.items[n], self.mass[n]
            same = sum(m for i, (w, m) in enumerate(zip(t.words, mass, strict=True)) if 0 <= start + i < len(file) and file[start + i] == w)
            score = max(score, min(1.0, same / sum(mass)))
            labels.add(t.label)
            if t.base:
                base.append(start + t.phrases[0][0])
                base_labels.add(t.label)
        ends = (min(base), max(base)) if base else (None, None)
        return len(file), len(base), *ends, ",".join(sorted(base_labels)), ",".join(sorted(labels)), score


COLUMNS = [("n_words", "long"), ("n_base", "long"), ("first_word", "long"), ("last_word", "long"), ("base_labels", "string"), ("labels", "string"), ("score", "double")]


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", notices=NOTICES) -> DataFrame:
    """One row per row of df: the id and COLUMNS."""
    items = templates(notices)
    index = Index(items, *document_frequencies(df, {w for t in items for w in t.words}, text_col))
    source = df.select(F.col(id_col).alias("key"), F.col(text_col).alias("text"))
    kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [index.scan(t.as_py()) for t in batch.column(1)]
        cols = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
        return pa.RecordBatch.from_arrays([batch.column(0), *cols], ["key", *(c for c, _ in COLUMNS)])

    schema = f"key {source.schema['key'].dataType.simpleString()}, " + ", ".join(f"{c} {t}" for c, t in COLUMNS)
    return arrow_map(source, run, schema).withColumnRenamed("key", id_col)
