"""Near duplicates by improved consistent weighted sampling over TF-IDF shingles.

A shingle of five words weighs its count in the text times 1 + ln(1 + N / df) / ln(1 + N), where df is the number of
documents that hold it, counted exactly: documents are dealt to blocks, every block sends its distinct shingles and in how
many of its documents they stand to PARTS that grow with the corpus, and gets back their counts over all documents. What
a task holds depends on the sizes of a block and of a part only. SAMPLES consistent weighted samples per text are banded, BANDS x ROWS; two texts meet if a band agrees (0.9992 of
pairs at a similarity of 0.8). Meetings are verified: links have a weighted Jaccard similarity of at least `least`.

Texts of the same words are one node from the start. In each band's bucket, every node is verified against the bucket's
centre (the text with most copies), so a bucket of any size takes as many verifications as it has nodes. Where that
leaves a bucket in several components, the nodes outside the largest one are compared with all nodes of the other ones,
chunk by chunk, first by their samples (SHARED of them must agree), then by their texts: pairs within a component can't
change the classes. A class is a connected component; its id is the least doc_id.

Nulls and texts without words are in no class but their own. Rows sharing a doc_id are the same document. A null doc_id
gives a null class. Texts of fewer than five words are one shingle. An empty table gives no rows. Only id and text are
read; further columns of any name pass by.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shingles
from .components import components
from .runtime import arrow_map, dropped, keyed, lookup, written

LEAST = 0.8
BANDS, ROWS = 10, 3
SAMPLES = BANDS * ROWS
#: Characters of a block of documents, and at most so many documents; characters whose shingles make up a part, about.
BLOCK_CHARS, BLOCK_ROWS, PART_CHARS = 2_000_000, 4096, 12_000_000
#: Pairs of one centre that are verified beside one copy of its text.
PER_CENTRE = 200
#: Nodes of a bucket that are compared with as many others in one task, about.
CHUNK = 512
#: The same for their samples, without texts; and how many of the SAMPLES a pair must share for its texts to be compared:
#: of pairs at a similarity of 0.8, 997 of 1000 do.
WIDE_CHUNK, SHARED = 4096, 18


def _quantiles() -> np.ndarray:
    """Of the gamma distribution of shape 2, at 2^16 places."""
    at = (np.arange(1 << 16) + 0.5) / (1 << 16)
    x = np.maximum(-np.log(1 - at), np.sqrt(2 * at))
    for _ in range(60):  # Newton's method
        x -= (1 - (1 + x) * np.exp(-x) - at) / (x * np.exp(-x))
        x = np.maximum(x, 1e-6)
    return x


_GAMMA = _quantiles()
_R, _LN_C = _GAMMA.astype(np.float32), np.log(_GAMMA).astype(np.float32)
#: One odd factor a sample: a shingle's own random numbers are the upper bits of the product with its hash.
_FACTORS = np.random.default_rng(77).integers(0, 1 << 63, SAMPLES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


@dataclass
class Frequencies:
    """Shingles in order of their hashes, how many of the n documents hold each."""

    found: np.ndarray
    df: np.ndarray
    n: int

    def counts(self, found: np.ndarray) -> np.ndarray:
        if len(found) == len(self.found):
            return self.df
        return self.df[np.searchsorted(self.found, found)]


def weights(hashes: np.ndarray, idf: Frequencies) -> tuple[np.ndarray, np.ndarray]:
    """A text's distinct shingles, in order of their hashes, and their weights."""
    found, counts = np.unique(hashes, return_counts=True)
    return found, counts * (1 + np.log1p(idf.n / idf.counts(found)) / np.log1p(idf.n))


def packed(df: np.ndarray) -> bytes:
    return zlib.compress(df.astype(np.uint32).tobytes(), 1)


def unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(data), np.uint32).astype(np.int64)


def weights_of(words: np.ndarray, df: bytes, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The weights of a text whose shingles' packed counts are df."""
    hashes = shingles.shingle_hashes(words)
    return weights(hashes, Frequencies(shingles.distinct(hashes), unpacked(df), n))


def shown(words: np.ndarray) -> str:
    """The fingerprint of a text's words as text."""
    return "%x:%x" % tuple(x & (1 << 64) - 1 for x in shingles.fingerprint(words))


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard: the sum of the lesser weights over that of the greater ones."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    low = float(np.minimum(a[1][i], b[1][j]).sum())
    high = float(a[1].sum() + b[1].sum()) - low
    return low / high if high else 0.0


def samples(found: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """The consistent weighted samples of a text with at least one shingle, as SAMPLES hashes. Every shingle draws r, c and
    beta from its own hash."""
    n = SAMPLES
    best = np.full(n, np.inf, np.float32)
    shingle, level = np.zeros(n, np.uint64), np.zeros(n, np.int64)
    every = np.arange(n)
    for at in range(0, len(found), 1024):
        part, log_w = found[at : at + 1024], np.log(weight[at : at + 1024]).astype(np.float32)
        draws = (_FACTORS[:, None] * part).view(np.int64)
        r = np.take(_R, draws >> 48 & 0xFFFF, mode="clip")
        value = (draws >> 16 & 0xFFFF).astype(np.float32)
        value += 0.5
        value *= 2.0**-16  # beta
        t = log_w / r
        t += value
        np.floor(t, out=t)
        value -= t
        value -= 1
        value *= r
        value += np.take(_LN_C, draws >> 32 & 0xFFFF, mode="clip")
        first = value.argmin(axis=1)
        low = value[every, first]
        less = low < best
        best[less], shingle[less], level[less] = low[less], part[first[less]], t[every, first][less].astype(np.int64)
    return shingles.mixed(shingle + shingles.mixed(level.astype(np.uint64)))


def bands(drawn: np.ndarray) -> np.ndarray:
    """BANDS keys of a text's samples."""
    one = drawn.reshape(BANDS, ROWS)
    out = np.arange(1, BANDS + 1, dtype=np.uint64)
    for k in range(ROWS):
        out = shingles.mixed(out * np.uint64(31) + one[:, k])
    return out.view(np.int64)


def blocked(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, int, int]:
    """doc_id, text, row and block (of neighbouring rows) of every row, written; the number of rows and of parts."""
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    size = source.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("chars")).first()
    rows = max(1, min(BLOCK_ROWS, BLOCK_CHARS * size.n // max(size.chars, 1)))
    source = source.withColumn("row", F.monotonically_increasing_id())
    return written(source.withColumn("block", F.floor(F.col("row") / rows)), "blocks"), size.n, max(1, -(-size.chars // PART_CHARS))


def _spaced(hashes: np.ndarray) -> bytes:
    """Ascending hashes by their distances, the distances' equal bytes next to each other: what is 0 packs well."""
    return np.diff(hashes, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T.tobytes()


def _unspaced(data: bytes) -> np.ndarray:
    apart = np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T)
    return np.cumsum(apart.view(np.uint64).ravel(), dtype=np.uint64)


SENT = "block long, first long, part long, hashes binary, counts binary"


def _sent(blocks: DataFrame, parts: int) -> DataFrame:
    """For each block, the part's distinct shingles with their numbers of documents. Where a file is split within a block,
    each of its runs of rows (from row `first` on) sends its own."""

    def sent(block: int, first: int, each: list[np.ndarray]) -> pa.RecordBatch:
        found, counts = np.unique(np.concatenate(each), return_counts=True)
        # Parts are ranges of hashes.
        part = ((found >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
        names, at = np.unique(part, return_index=True)
        cuts = list(zip(at.tolist(), [*at[1:].tolist(), len(found)]))
        hashes, numbers = [_spaced(found[i:j]) for i, j in cuts], [counts[i:j].astype(np.uint32).tobytes() for i, j in cuts]
        same = [pa.array([x] * len(names), pa.int64()) for x in (block, first)]
        return pa.RecordBatch.from_arrays([*same, pa.array(names, pa.int64()), pa.array(hashes, pa.binary()), pa.array(numbers, pa.binary())], ["block", "first", "part", "hashes", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, first, each = -1, -1, []
        for batch in batches:
            for text, row, own in zip(*batch.columns, strict=True):
                if own.as_py() != block:
                    if each:
                        yield sent(block, first, each)
                    block, first, each = own.as_py(), row.as_py(), []
                each.append(shingles.distinct(shingles.shingle_hashes(shingles.word_hashes(text.as_py()))))
        if each:
            yield sent(block, first, each)

    return blocks.select("text", "row", "block").mapInArrow(run, SENT)


def _added(sent: DataFrame) -> DataFrame:
    """For each of the rows sent, how many documents of all blocks hold each of its shingles."""

    def run(group: pa.Table) -> pa.Table:
        hashes = [_unspaced(x.as_py()) for x in group["hashes"]]
        counts = np.concatenate([np.frombuffer(x.as_py(), np.uint32) for x in group["counts"]])
        _, at = np.unique(np.concatenate(hashes), return_inverse=True)
        df = np.bincount(at, weights=counts).astype(np.int64)[at]
        cuts = np.cumsum([len(h) for h in hashes])[:-1]
        return group.select(["block", "first", "part"]).append_column("df", pa.array([packed(x) for x in np.split(df, cuts)], pa.binary()))

    return sent.groupBy("part").applyInArrow(run, "block long, first long, part long, df binary")


def document_counts(blocks: DataFrame, parts: int) -> DataFrame:
    """block, first, part, df: how many documents hold the shingles of a block's run of rows, in order of their hashes."""
    return written(_added(_sent(blocks, parts)), "counts")


def inverse_frequencies(docs: DataFrame, text_col: str = "text") -> Frequencies:
    """The counts of all shingles in one place, for tables that the driver can hold."""
    blocks, n, parts = blocked(docs.select(F.lit(0).alias("__id"), F.col(text_col)), "__id", text_col)
    sent = written(_sent(blocks, parts), "sent")
    rows = sent.join(_added(sent), ["block", "first", "part"]).select("hashes", "df").collect()
    found = np.concatenate([_unspaced(r.hashes) for r in rows] or [np.empty(0, np.uint64)])
    df = np.concatenate([unpacked(r.df) for r in rows] or [np.empty(0, np.int64)])
    found, at = np.unique(found, return_index=True)
    return Frequencies(found, df[at], n)


def signatures(blocks: DataFrame, counts: DataFrame, n: int) -> DataFrame:
    """doc_id, fp (of the words; null without words), df (the packed counts of its shingles), drawn (32 bits of each sample)
    and the band keys of every row."""
    names = [f"b{i}" for i in range(BANDS)]

    def run(texts: pa.Table, counts: pa.Table) -> pa.Table:
        texts, counts = texts.sort_by("row"), counts.sort_by([("first", "ascending"), ("part", "ascending")])
        words = [shingles.word_hashes(t) for t in texts["text"].to_pylist()]
        firsts, at = np.unique(counts["first"].to_numpy(), return_index=True)
        own = np.maximum(np.searchsorted(firsts, texts["row"].to_numpy(), "right") - 1, 0).tolist()
        df, cuts = counts["df"].to_pylist(), [*at.tolist(), counts.num_rows]
        fps, dfs, drawn, keys = [None] * len(words), [None] * len(words), [None] * len(words), np.zeros((len(words), BANDS), np.int64)
        for k in range(len(firsts)):
            hashes = {i: shingles.shingle_hashes(w) for i, w in enumerate(words) if own[i] == k and len(w)}
            known = np.concatenate([unpacked(x) for x in df[cuts[k] : cuts[k + 1]]])
            every = Frequencies(shingles.distinct(np.concatenate(list(hashes.values()))), known, n)
            for i, h in hashes.items():
                found, weight = weights(h, every)
                one = samples(found, weight)
                fps[i], dfs[i], drawn[i], keys[i] = shown(words[i]), packed(every.counts(found)), one.astype(np.uint32).tobytes(), bands(one)
        cols = [pa.array(np.ascontiguousarray(c)) for c in keys.T]
        known = [pa.array(fps, pa.string()), pa.array(dfs, pa.binary()), pa.array(drawn, pa.binary())]
        return pa.Table.from_arrays([texts["doc_id"], *known, *cols], ["doc_id", "fp", "df", "drawn", *names])

    both = blocks.groupBy("block").cogroup(counts.groupBy("block"))
    return both.applyInArrow(run, "doc_id long, fp string, df binary, drawn binary, " + ", ".join(f"{b} long" for b in names))


def verified(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, n: int, least: float, id_col: str, text_col: str) -> DataFrame:
    """The links (u, v) among pairs (u, u_fp, v, v_fp) whose texts are similar enough; one v may have very many u."""
    pairs = written(pairs, "pairs")
    counts = pairs.groupBy("v").agg(F.count("*").alias("n"))
    counted = lookup(pairs, "v", counts.withColumn("parts", F.ceil(F.col("n") / PER_CENTRE)), "n", F.col("u"))
    counted = counted.withColumn("salt", F.pmod(F.xxhash64("u"), F.col("parts")))
    ids = pairs.select(F.col("u").alias("id")).union(pairs.select("v")).distinct()
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    texts = keyed(texts, "id", ids, "left_semi").join(nodes.select(F.col("node").alias("id"), "fp", "df"), "id")
    texts = written(texts, "texts")
    of = lambda x: texts.select(F.col("id").alias(x), F.col("fp").alias(f"{x}_fp"), F.struct("text", "df").alias(f"{x}_text"))
    left = counted.join(of("u"), ["u", "u_fp"])
    parts = counts.select("v", F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col("n") / PER_CENTRE) - 1)).alias("salt"))
    right = parts.join(of("v"), "v")
    both = left.join(right, ["v", "v_fp", "salt"]).select("u", "u_fp", "u_text", "v", "v_fp", "v_text")
    both = both.where("u_text.text IS NOT NULL AND v_text.text IS NOT NULL")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        keep, known = [], {}

        def of(text: str, fp: str, df: bytes):
            if (text, fp) not in known:
                if len(known) > 8:
                    known.clear()
                words = shingles.word_hashes(text)
                known[text, fp] = weights_of(words, df, n) if fp == shown(words) else None
            return known[text, fp]

        for i in range(batch.num_rows):
            u, v = (of(batch.column(c + 1)[i]["text"].as_py(), batch.column(c)[i].as_py(), batch.column(c + 1)[i]["df"].as_py()) for c in (1, 4))
            if u is not None and v is not None and similarity(u, v) >= least:
                keep.append(i)
        at = pa.array(keep, pa.int64())
        return pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(3).take(at)], ["u", "v"])

    return written(arrow_map(both, run, "u long, v long"), "links")


def _dealt(open_: DataFrame, whole: DataFrame, chunk: int, columns: list[str]) -> DataFrame:
    """key, x, y, outer and columns: the nodes of a bucket outside its main component (outer) and all of its nodes, so that
    each of the first meets each of the second in one group (key, x, y) of about twice `chunk` rows."""
    parts = lambda n: F.greatest(F.ceil(F.col(n) / chunk), F.lit(1)).cast("long")
    dealt = lambda n: F.pmod(F.xxhash64("node"), parts(n))
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), parts(n) - 1))
    left = whole.where("label <> main").select("key", dealt("others").alias("x"), each("n").alias("y"), F.lit(True).alias("outer"), *columns)
    return left.union(whole.select("key", each("others").alias("x"), dealt("n").alias("y"), F.lit(False).alias("outer"), *columns))


def promising(open_: DataFrame, nodes: DataFrame) -> DataFrame:
    """(key, node): the nodes of a bucket with a partner in another of its components that shares SHARED samples or more,
    and these partners. Only the samples travel; a row comes out for a node, not for a pair."""
    whole = open_.join(nodes.select("node", "fp", "drawn"), ["node", "fp"])

    def compare(group: pa.Table) -> pa.Table:
        outer, label, node = (group[c].to_numpy() for c in ("outer", "label", "node"))
        drawn = np.frombuffer(b"".join(group["drawn"].to_pylist()), np.uint32).reshape(-1, SAMPLES)
        a, b = np.flatnonzero(outer), np.flatnonzero(~outer)
        good = np.zeros(len(node), bool)
        for at in range(0, len(a), 256):
            i = a[at : at + 256]
            same = np.zeros((len(i), len(b)), np.int8)
            for k in range(SAMPLES):
                same += drawn[i, k][:, None] == drawn[b, k]
            pairs = (same >= SHARED) & (label[i][:, None] != label[b])
            good[i] |= pairs.any(axis=1)
            good[b] |= pairs.any(axis=0)
        return pa.table({"key": pa.array([group["key"][0].as_py()] * int(good.sum()), pa.int64()), "node": pa.array(node[good])})

    return _dealt(open_, whole, WIDE_CHUNK, ["node", "label", "drawn"]).groupBy("key", "x", "y").applyInArrow(compare, "key long, node long").distinct()


def _opened(labelled: DataFrame) -> DataFrame:
    """The rows (key, node, fp, label) of buckets that hold several components, with main (the largest of those), n (nodes)
    and others (nodes that aren't in it)."""
    sizes = labelled.groupBy("key", "label").agg(F.count("*").alias("size"))
    sizes = sizes.groupBy("key").agg(F.max_by("label", F.struct("size", "label")).alias("main"), F.sum("size").alias("n"), F.max("size").alias("most"))
    sizes = sizes.where("most < n").withColumn("others", F.col("n") - F.col("most")).drop("most").withColumn("rows", F.col("n"))
    return written(lookup(labelled, "key", sizes, "rows", F.col("node")).where("main IS NOT NULL"), "open")


def across(open_: DataFrame, nodes: DataFrame, docs: DataFrame, n: int, least: float, id_col: str, text_col: str) -> DataFrame:
    """Links (u, v) between components that share a bucket: one for each node outside the bucket's main component and
    each component it is linked to there.

    Both sides of a bucket are dealt to chunks of about CHUNK nodes, so no task holds more than two of them, and pairs
    are compared within a task, not as rows. A pair that shares several buckets is compared in the first of them.
    """
    source = docs.select(F.col(id_col).cast("long").alias("node"), F.col(text_col).alias("text"))
    texts = keyed(source, "node", open_.select("node").distinct(), "left_semi")
    texts = written(texts.join(nodes.select("node", "fp", "df", F.array(*[f"b{i}" for i in range(BANDS)]).alias("keys")), "node"), "texts")
    whole = open_.join(texts, ["node", "fp"])
    both = _dealt(open_, whole, CHUNK, ["node", "fp", "label", "keys", "text", "df"])

    def compare(group: pa.Table) -> pa.Table:
        key, rows, outer = group["key"][0].as_py(), [], group["outer"].to_pylist()
        for fp, text, df in zip(*(group[c].to_pylist() for c in ("fp", "text", "df")), strict=True):
            words = shingles.word_hashes(text)
            rows.append(weights_of(words, df, n) if fp == shown(words) else None)
        label, node = group["label"].to_numpy(), group["node"].to_numpy()
        keys = np.array(group["keys"].to_pylist(), np.int64).reshape(-1, BANDS)
        inner = [i for i, r in enumerate(rows) if r is not None and not outer[i]]
        us, vs = [], []
        if inner:
            found, ids = np.unique(np.concatenate([rows[i][0] for i in inner]), return_inverse=True)
            w = np.concatenate([rows[i][1] for i in inner])
            lengths = [len(rows[i][0]) for i in inner]
            starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
            total = np.add.reduceat(w, starts)
            at = np.array(inner)
            for i in (i for i, r in enumerate(rows) if r is not None and outer[i]):
                same = keys[at] == keys[i]
                first = np.take_along_axis(np.broadcast_to(keys[i], same.shape), same.argmax(axis=1)[:, None], 1)[:, 0]
                wanted = same.any(axis=1) & (first == key) & (label[at] != label[i])
                if not wanted.any():
                    continue
                mine = np.zeros(len(found))
                place = np.minimum(np.searchsorted(found, rows[i][0]), len(found) - 1)
                hit = found[place] == rows[i][0]
                mine[place[hit]] = rows[i][1][hit]
                low = np.add.reduceat(np.minimum(mine[ids], w), starts)
                good = at[wanted & (low >= least * (total + rows[i][1].sum() - low))]
                _, one = np.unique(label[good], return_index=True)
                us += [int(node[i])] * len(one)
                vs += node[good[one]].tolist()
        return pa.table({"u": pa.array(us, pa.int64()), "v": pa.array(vs, pa.int64())})

    return written(both.groupBy("key", "x", "y").applyInArrow(compare, "u long, v long"), "links")


def classes(docs: DataFrame, least: float = LEAST, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and class_id of every row."""
    blocks, n, parts = blocked(docs, id_col, text_col)
    counts = document_counts(blocks, parts)
    rows = written(signatures(blocks, counts, n), "signatures")
    dropped(blocks)
    dropped(counts)
    names = [f"b{i}" for i in range(BANDS)]
    nodes = rows.where("fp IS NOT NULL AND doc_id IS NOT NULL").groupBy("fp")
    nodes = written(nodes.agg(F.min("doc_id").alias("node"), F.count("*").alias("copies"), F.first("df").alias("df"), F.first("drawn").alias("drawn"), *[F.first(b).alias(b) for b in names]), "nodes")
    members = nodes.select("node", "fp", "copies", F.explode(F.array(*names)).alias("key"))
    best = F.max_by(F.struct("node", "fp"), F.struct("copies", -F.col("node"))).alias("centre")
    centres = members.groupBy("key").agg(best, F.count("*").alias("n")).where("n > 1")
    members = written(lookup(members, "key", centres, "n", F.col("node")).where("centre IS NOT NULL"), "members")
    pairs = members.where("node <> centre.node").select(F.col("node").alias("u"), F.col("fp").alias("u_fp"), F.col("centre.node").alias("v"), F.col("centre.fp").alias("v_fp"))
    links = verified(pairs.distinct(), nodes, docs, n, least, id_col, text_col)
    label = components(links)

    # Buckets that hold several components: all pairs across them, but for those within the largest one. First by their
    # samples, then, of those nodes that are left, by their texts.
    labelled = members.join(label, "node", "left").withColumn("label", F.coalesce("label", "node")).select("key", "node", "fp", "label")
    open_ = _opened(labelled)
    if not open_.isEmpty():
        left = written(promising(open_, nodes), "promising")
        open_ = _opened(open_.select("key", "node", "fp", "label").join(left, ["key", "node"], "left_semi"))
        known = label.select(F.col("node").alias("u"), F.col("label").alias("v"))
        label = components(known.union(across(open_, nodes, docs, n, least, id_col, text_col)))
    named = nodes.join(label, "node", "left").select("fp", F.coalesce("label", "node").alias("class_id"), "copies")
    out = lookup(rows.select("doc_id", "fp"), "fp", named, "copies", F.col("doc_id"))
    return out.select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """The documents whose doc_id is their class's id."""
    out = classes(docs)
    repeated = written(out.where("doc_id <> class_id").select("doc_id").distinct(), "repeated")
    return keyed(docs, "doc_id", repeated, "left_anti")
