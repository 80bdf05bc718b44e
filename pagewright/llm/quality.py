"""Quality classifier from weak labels.

LABELLERS look at a whole text and vote good (1), bad (-1) or not at all (0). The votes of every document are counted
by pattern (at most 3^LABELLERS numbers, whatever the corpus); expectation-maximisation over these counts estimates how
often each labeller is right for good and for bad texts, and so each pattern's posterior probability of good. The
posteriors of at most SAMPLE documents, picked by a hash of the id, are the soft labels of a hashed linear scorer, which
then scores every document. A document is kept if the mean of its posterior and its score is 0.5 or more.

A null text is an empty one; one without words gets a bad vote on its letters and no other, one with fewer than FEW words
none on repetition and variety. Variety is measured in pieces of PIECE words, so that it doesn't depend on a text's length.
Repeated rows count each. An empty table gives no rows. Only id and text are read; further columns of any name pass by.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import islice
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import features
from .runtime import arrow_map

SAMPLE = 4000
FEW, PIECE = 5, 100
_SYMBOLS = re.compile(r"[#$%&*^~<>{}\\|=_@]")
_ENDS = re.compile(r"[.!?][\"')\]]*(?:\s|$)")



def votes(text: str | None) -> tuple[int, ...]:
    """Each labeller's vote, in the order of LABELLERS."""
    text = text or ""
    words = text.split()
    if not words:
        return (0, 0, 0, 0, 0, 0, -1)
    n, chars = len(words), len(text)
    symbols = len(_SYMBOLS.findall(text)) / chars
    letters = sum(map(str.isalpha, text))
    upper = sum(map(str.isupper, text)) / max(letters, 1)
    shouted = text.count("!") / n
    repeated = sum(map(eq, words, islice(words, 1, None))) / max(n - 1, 1)
    distinct = sum(len(set(words[i : i + PIECE])) for i in range(0, n, PIECE)) / n
    ends = len(_ENDS.findall(text)) / n
    return (
        -1 if symbols > 0.03 else int(symbols < 0.004),
        0 if letters < 20 else -1 if upper > 0.2 else int(upper < 0.08),
        -1 if shouted > 0.1 else 0,
        0 if n < FEW else -1 if repeated > 0.25 else int(repeated < 0.08),
        0 if n < FEW else -1 if distinct < 0.4 else int(distinct > 0.55),
        -1 if ends < 0.01 and n > 30 else int(0.03 < ends < 0.5),
        -1 if letters / chars < 0.5 else int(letters / chars > 0.72),
    )


LABELLERS = ("symbols", "capitals", "exclamation", "repetition", "variety", "sentences", "letters")


def pattern(text: str | None) -> str:
    return "".join("-0+"[v + 1] for v in votes(text))


def estimate(counts: dict[str, int], rounds: int = 100) -> dict[str, float]:
    """Each pattern's posterior of good, by expectation-maximisation over two classes and independent labellers.

    Starting from the share of good votes, labellers' vote rates in each class and the classes' shares are
    re-estimated (with a small prior that labellers are right rather than wrong) until the rounds are over.
    """
    if not counts:
        return {}
    names = sorted(counts)
    v = np.array([["-0+".index(c) for c in p] for p in names])
    n = np.array([counts[p] for p in names], float)
    seen = np.eye(3)[v]  # pattern, labeller, vote
    # A bad vote weighs more than a good one: heuristics fire on faults, and pass most texts.
    good = 1 / (1 + np.exp(-((v == 2).sum(1) - 3.0 * (v == 0).sum(1))))
    prior = 5.0 * np.array([[0.7, 1.0, 0.3], [0.3, 1.0, 0.7]])  # class bad, good; vote -, 0, +
    for _ in range(rounds):
        of = np.stack([1 - good, good])
        weight = of * n
        share = (weight.sum(1) + 1) / (n.sum() + 2)
        rate = np.einsum("cp,plv->clv", weight, seen) + prior[:, None, :]
        rate /= rate.sum(2, keepdims=True)
        log = np.log(share)[:, None] + np.einsum("plv,clv->cp", seen, np.log(rate))
        good = 1 / (1 + np.exp(np.clip(log[0] - log[1], -500, 500)))
    return dict(zip(names, good.tolist(), strict=True))


def pattern_counts(docs: DataFrame, text_col: str = "text") -> dict[str, int]:
    """How many documents have each pattern of votes; partial counts are made in the tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            seen.update(pattern(t.as_py()) for t in batch.column(0))
        yield pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.string()), pa.array(seen.values(), pa.int64())], ["p", "n"])

    found = docs.select(F.col(text_col).alias("text")).mapInArrow(run, "p string, n long")
    return {r.p: r.n for r in found.groupBy("p").agg(F.sum("n").alias("n")).collect()}


def learn(docs: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> tuple[dict[str, float], np.ndarray]:
    """The posteriors of all patterns, and the scorer's weights."""
    counts = pattern_counts(docs, text_col)
    posterior = estimate(counts)
    total = sum(counts.values())
    none = np.zeros(features.DIM + 1, np.float32)
    if not total:
        return posterior, none
    rows = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))
    draw = F.pmod(F.xxhash64("id"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    rows = rows.withColumn("draw", draw).where(F.col("draw") < min(1.0, sample / total))
    rows = rows.orderBy("draw", "id").limit(sample).repartition(16, "id").select("text")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column(0).to_pylist()
        vectors = [features.ngram_counts((t or "").encode()).astype(np.float32).tobytes() for t in texts]
        return pa.RecordBatch.from_arrays([pa.array([pattern(t) for t in texts], pa.string()), pa.array(vectors, pa.binary())], ["p", "x"])

    got = arrow_map(rows, run, "p string, x binary").toArrow()
    if not got.num_rows:
        return posterior, none
    x, target = features.gathered(got["x"]), np.array([posterior[p] for p in got["p"].to_pylist()], np.float32)
    del got
    # The rarer class counts as much as the other.
    good = max(float(target.sum()), 1.0)
    bad = max(float((1 - target).sum()), 1.0)
    return posterior, features.fit_logistic(x, target, target / good + (1 - target) / bad)


def scored(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> DataFrame:
    """One row per row of docs: the id, posterior (of the votes), score (of the text) and keep."""
    posterior, w = learn(docs, sample, id_col, text_col)
    source = docs.select(F.col(id_col).alias("key"), F.col(text_col).alias("text"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [t or "" for t in batch.column(1).to_pylist()]
        z = features.margins(features.matrix([t.encode() for t in texts]), w)
        score = 1 / (1 + np.exp(-np.clip(z, -30, 30).astype(np.float64)))
        weak = np.array([posterior[pattern(t)] for t in texts], np.float64)
        columns = [batch.column(0), pa.array(weak), pa.array(score), pa.array(score + weak >= 1)]
        return pa.RecordBatch.from_arrays(columns, ["key", "posterior", "score", "keep"])

    schema = f"key {source.schema['key'].dataType.simpleString()}, posterior double, score double, keep boolean"
    return arrow_map(source, run, schema).withColumnRenamed("key", id_col)
