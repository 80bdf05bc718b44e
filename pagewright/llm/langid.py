"""Language identification in two steps: the language family, then the languages within it.

A linear SVM per family (one against the rest) picks the family; one-versus-one SVMs vote among its languages. The
features are hashed byte n-grams of the whole lower-cased text, letters only. The models are fitted on the driver to a
sample of at most PER_LANGUAGE texts of each language and about SAMPLE texts in all, whatever the number of languages; the
sample's features are computed on the executors. Everything else covers all rows.

A text that is null or has no letter is `und` with score 0, and so is every text if nothing could be learned. Repeated
rows count each. Only id, text and (for learning) lang are read; further columns of any name pass by. The pipeline's stage
rejects `und` and scores below LEAST_SCORE.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import features
from .runtime import BROADCAST_IDS, arrow_map, written

PER_LANGUAGE = 400
#: Texts that are learned from, of all languages together, about (16 kB of the driver's memory each).
SAMPLE = 8000
UNKNOWN = "und"
#: The pipeline's stage rejects texts below this score.
LEAST_SCORE = 0.3

# Families of closely related languages; a language that isn't listed is a family of its own.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is af fy lb",
    "romance": "fr es it pt ro ca gl oc",
    "slavic": "ru uk be pl cs sk bg sr hr bs sl mk",
    "baltic": "lt lv",
    "uralic": "fi et hu",
    "turkic": "tr az kk uz tt",
    "indo-aryan": "hi bn mr ur pa gu ne",
    "semitic": "ar he mt",
}
_FAMILY = {lang: family for family, langs in FAMILIES.items() for lang in langs.split()}
_LETTERS = features.letters_only()
_LETTER = regex.compile(r"\p{L}")


def family_of(lang: str) -> str:
    return _FAMILY.get(lang, lang)


def prepared(text: str | None) -> bytes | None:
    """The bytes whose n-grams count; None for a text without letters."""
    if not text or not _LETTER.search(text):
        return None
    return text.lower().encode().translate(_LETTERS)


def held_out(id_col: Column) -> Column:
    """Rows that nothing is learned from: crc32 of the id as text leaves 0 when divided by 5."""
    return F.coalesce(F.crc32(id_col.cast("string")) % 5 == 0, F.lit(False))


@dataclass
class Model:
    families: list[str] = field(default_factory=list)
    family_weights: np.ndarray | None = None
    languages: dict[str, list[str]] = field(default_factory=dict)
    #: By family: the weights that tell a pair (a, b), positive for a.
    pairs: dict[str, list[tuple[int, int, np.ndarray]]] = field(default_factory=dict)

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        if not self.families:
            return [UNKNOWN] * len(x), np.zeros(len(x))
        fam = features.margins(x, self.family_weights.T) if len(self.families) > 1 else np.zeros((len(x), 1))
        p = 1 / (1 + np.exp(-3 * fam))
        best = p.argmax(axis=1)
        # Against the runner-up only: a sum over all families would shrink the score with their number.
        top = np.sort(p, axis=1)[:, -2:]
        out, score = [""] * len(x), top[:, -1] / top.sum(axis=1)
        for n, family in enumerate(self.families):
            rows = np.flatnonzero(best == n)
            langs = self.languages[family]
            votes, strength = np.zeros((len(rows), len(langs))), np.zeros((len(rows), len(langs)))
            for a, b, w in self.pairs[family]:
                m = features.margins(x[rows], w)
                votes[:, a] += m > 0
                votes[:, b] += m <= 0
                q = 1 / (1 + np.exp(-3 * m))
                strength[:, a] += q
                strength[:, b] += 1 - q
            # Votes decide, the strength of the margins breaks ties.
            pick = (votes + strength / (len(langs) + 1)).argmax(axis=1)
            sure = strength / max(len(langs) - 1, 1) if len(langs) > 1 else np.ones((len(rows), 1))
            for r, k in zip(rows, pick, strict=True):
                out[r] = langs[k]
            score[rows] *= sure[np.arange(len(rows)), pick]
        return out, score


def fit(x: np.ndarray, langs: list[str]) -> Model:
    names = sorted(set(langs))
    if not names:
        return Model()
    label = np.array(langs)
    model = Model(families=sorted({family_of(n) for n in names}))
    fam = np.array([family_of(n) for n in langs])
    if len(model.families) > 1:
        model.family_weights = np.stack([features.fit_svm(x, np.where(fam == f, 1.0, -1.0).astype(np.float32)) for f in model.families])
    for f in model.families:
        own = model.languages[f] = [n for n in names if family_of(n) == f]
        model.pairs[f] = []
        for (i, a), (j, b) in combinations(enumerate(own), 2):
            side = np.where(label == a, 1.0, np.where(label == b, -1.0, 0.0)).astype(np.float32)
            model.pairs[f].append((i, j, features.fit_svm(x, side)))
    return model


def learn(docs: DataFrame, per_language: int = PER_LANGUAGE, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """The models, from rows that aren't held out and have a lang."""
    rows = docs.where(F.col(id_col).isNotNull() & ~held_out(F.col(id_col)) & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    rows = rows.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    counts = written(rows.groupBy("lang").agg(F.count("*").alias("texts")), "languages")
    languages = counts.count()
    if not languages:
        return Model()
    # A share of each language's rows that gives so many of them, picked by a hash of the id.
    each = max(1, min(per_language, SAMPLE // languages))
    draw = F.pmod(F.xxhash64("id"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    small = F.broadcast(counts) if languages <= BROADCAST_IDS else counts
    sample = rows.withColumn("draw", draw).join(small, "lang").where(F.col("draw") < each / F.col("texts"))
    sample = sample.orderBy("draw", "id").limit(each * languages).repartition(16, "id")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        data = [prepared(t.as_py()) for t in batch.column(0)]
        vectors = [None if d is None else features.ngram_counts(d).astype(np.float32).tobytes() for d in data]
        return pa.RecordBatch.from_arrays([batch.column(1), pa.array(vectors, pa.binary())], ["lang", "x"])

    got = arrow_map(sample.select("text", "lang"), run, "lang string, x binary").where("x IS NOT NULL").toArrow()
    if not got.num_rows:
        return Model()
    x, langs = features.gathered(got["x"]), got["lang"].to_pylist()
    del got
    return fit(x, langs)


def predict(df: DataFrame, model: Model, text_col: str = "text", names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """df with two more columns: the language of the whole text and its score from 0 to 1."""
    schema = T.StructType([*df.schema.fields, T.StructField(names[0], T.StringType()), T.StructField(names[1], T.DoubleType())])
    columns = df.columns
    at = columns.index(text_col)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        data = [prepared(t.as_py()) for t in batch.column(at)]
        rows = [i for i, d in enumerate(data) if d is not None]
        langs, scores = [UNKNOWN] * len(data), np.zeros(len(data))
        for i, lang, score in zip(rows, *model.predict(features.matrix([data[i] for i in rows])), strict=True):
            langs[i], scores[i] = lang, score
        more = [pa.array(langs, pa.string()), pa.array(scores, pa.float64())]
        return pa.RecordBatch.from_arrays([*batch.columns, *more], [*columns, *names])

    return arrow_map(df, run, schema)


def identified(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document."""
    out = predict(docs.select("doc_id", "text"), learn(docs))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def accepted(docs: DataFrame, least: float = LEAST_SCORE) -> DataFrame:
    """The documents whose language could be told: not `und`, and a score of at least `least`."""
    out = predict(docs, learn(docs), names=("__lang", "__score"))
    return out.where((F.col("__lang") != UNKNOWN) & (F.col("__score") >= least)).select(*docs.columns)
