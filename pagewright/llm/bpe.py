"""Byte-level BPE: encoding by speculation and verification, and decoding.

A word's tokens are proposed by greedy longest match. A token sequence is the merge algorithm's own result exactly if
every two neighbours, taken alone, would not have been merged across their border; that is checked for all neighbours
of a batch at once with array operations. Only words with a failing pair are merged exactly, step by step.

Nulls encode like the empty text: no tokens. Repeated rows, very long words (heap-ordered merging) and added tokens
inside a text (their content maps to their id, as the public library does) are covered. Inputs may have further
columns of any name; only the id and the text are read.
"""

from __future__ import annotations

import heapq
import json
import re
import sys
from functools import cached_property, lru_cache
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tokenizers import Regex
from tokenizers.pre_tokenizers import Split

from .runtime import arrow_map

NEVER = 1 << 40
#: Words of a generation of a worker's memory; the words of the last generation are still found and move on.
CACHE_WORDS = 120_000


def _class(letter: str, last: int) -> str:
    """The code points up to `last` of a general category's first letter, as ranges of a character class. The library's own tables
    say which they are (Unicode versions differ); the standard library's matcher is the faster one to run."""
    out, splitter = [], Split(Regex(rf"[^\p{{{letter}}}]+"), "removed")
    for start in range(0, last + 1, 1 << 14):
        if not 0xD800 <= start < 0xE000:
            points = [c for c in range(start, min(start + (1 << 14), last + 1)) if not 0xD800 <= c < 0xE000]
            runs = splitter.pre_tokenize_str("".join(map(chr, points)))
            out += [f"\\U{points[a]:08x}-\\U{points[z - 1]:08x}" for _, (a, z) in runs]
    return "".join(out)


def split_pattern(last: int = sys.maxunicode) -> re.Pattern:
    """For texts of code points up to `last`. The matcher looks ranges up to U+FFFF up in a bitmap, but walks through all
    ranges beyond for every other character, so most texts are split without those."""
    # The public byte-level pattern; white space as Unicode's White_Space.
    space = r"\t-\r \x85\xa0  -     　"
    letters, numbers = _class("L", last), _class("N", last)
    return re.compile(
        f"'s|'t|'re|'ve|'m|'ll|'d| ?[{letters}]+| ?[{numbers}]+| ?[^{space}{letters}{numbers}]+"
        f"|[{space}]+(?![^{space}])|[{space}]+"
    )


def byte_alphabet() -> list[str]:
    """The printable stand-in for each byte: printable bytes stand for themselves, others follow from U+0100 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


#: Tokens are looked up by their first bytes; where no token of so many begins, only shorter ones are tried.
HEAD = 4
#: Bytes of a word up to which a scan for the least rank is faster than a heap.
SHORT = 40


class ByteBpe:
    """A byte-level BPE vocabulary in the public JSON format."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in merges]
        alphabet = byte_alphabet()
        code = {c: b for b, c in enumerate(alphabet)}
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens", ())}
        self.added_pattern = re.compile("|".join(map(re.escape, sorted(self.added, key=len, reverse=True)))) if self.added else None
        n = max([*vocab.values(), *self.added.values()]) + 1
        self.size = n
        self.token_bytes: list[bytes] = [b""] * n
        for text, i in [*vocab.items(), *self.added.items()]:
            self.token_bytes[i] = bytes(code[c] for c in text) if all(c in code for c in text) else text.encode()
        self.byte_id = [vocab[c] for c in alphabet]
        self.rank = np.full(n, -1, np.int64)
        self.left, self.right = np.zeros(n, np.int64), np.zeros(n, np.int64)
        self.merge: dict[tuple[int, int], tuple[int, int]] = {}
        self.due: dict[tuple[int, int], int] = {}
        self.made: list[int] = []
        codes = np.empty(len(merges), np.int64)
        for r, (a, b) in enumerate(merges):
            x, y, z = vocab[a], vocab[b], vocab[a + b]
            self.merge[x, y] = (r, z)
            self.due[x, y] = r
            self.made.append(z)
            self.rank[z], self.left[z], self.right[z] = r, x, y
            codes[r] = x * n + y
        order = np.argsort(codes)
        self.pair_codes, self.pair_ranks = codes[order], order.astype(np.int64)
        # What greedy matching may propose: single bytes and results of merges; longest token by its first HEAD bytes.
        made = [*self.byte_id, *(z for _, z in self.merge.values())]
        self.by_bytes = {self.token_bytes[i]: i for i in made}
        self.longest: dict[bytes, int] = {}
        for t in self.by_bytes:
            if len(t) >= HEAD:
                self.longest[t[:HEAD]] = max(self.longest.get(t[:HEAD], 0), len(t))
        self.lengths = np.array([len(t) for t in self.token_bytes], np.int64)
        self.starts = np.concatenate(([0], np.cumsum(self.lengths)[:-1]))
        self.all_bytes = np.frombuffer(b"".join(self.token_bytes), np.uint8)
        self.cache: dict[str, bytes] = {}  # token ids of 32 bits
        self.older: dict[str, bytes] = {}

    @cached_property
    def pattern(self) -> re.Pattern:
        return split_pattern()

    @cached_property
    def basic_pattern(self) -> re.Pattern:
        return split_pattern(0xFFFF)

    @cached_property
    def ascii_pattern(self) -> re.Pattern:
        return split_pattern(0x7F)

    # Speculation

    def propose(self, word: bytes) -> list[int]:
        out, at, end, known, longest = [], 0, len(word), self.by_bytes, self.longest
        while at < end:
            for stop in range(min(end, at + longest.get(word[at : at + HEAD], HEAD - 1)), at, -1):
                if (i := known.get(word[at:stop])) is not None:
                    out.append(i)
                    at = stop
                    break
        return out

    # Verification

    def pair_rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        wanted = a * self.size + b
        at = np.minimum(np.searchsorted(self.pair_codes, wanted), len(self.pair_codes) - 1)
        return np.where(self.pair_codes[at] == wanted, self.pair_ranks[at], NEVER)

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether merging a's and b's bytes together leaves exactly a, b.

        Both tokens are taken apart again from the last merge backwards, along their common border. In each state, the
        two pieces at the border lived until the merge that made the piece they came from; a merge of the two that is
        due before that (at an equal rank the one further left comes first) would have crossed the border.
        """
        ok = np.ones(len(a), bool)
        who = np.arange(len(a))
        a, b = a.astype(np.int64), b.astype(np.int64)
        until_a = until_b = np.full(len(a), NEVER)
        while len(who):
            due = self.pair_rank(a, b)
            crossed = (due < until_a) & (due <= until_b)
            ok[who[crossed]] = False
            made_a, made_b = self.rank[a], self.rank[b]
            on = ~crossed & ((made_a >= 0) | (made_b >= 0))
            who, a, b, made_a, made_b = who[on], a[on], b[on], made_a[on], made_b[on]
            until_a, until_b = until_a[on], until_b[on]
            last_a = made_a > made_b
            until_a, a = np.where(last_a, made_a, until_a), np.where(last_a, self.right[a], a)
            until_b, b = np.where(last_a, until_b, made_b), np.where(last_a, b, self.left[b])
        return ok

    # Exact merging

    def merged_short(self, word: bytes) -> list[int]:
        """Merges in order of rank, leftmost first; the least rank is looked for among all pairs each time."""
        due, made = self.due.get, self.made
        ids = [self.byte_id[b] for b in word]
        ranks = [due(p, NEVER) for p in zip(ids, ids[1:])]
        while ranks and (r := min(ranks)) < NEVER:
            i = ranks.index(r)
            ids[i : i + 2] = [z] = [made[r]]
            del ranks[i]
            if i:
                ranks[i - 1] = due((ids[i - 1], z), NEVER)
            if i < len(ranks):
                ranks[i] = due((z, ids[i + 1]), NEVER)
        return ids

    def merged(self, word: bytes) -> list[int]:
        """The same for long words. Merges in order of rank, leftmost first; a heap over a linked list, so long words stay near-linear."""
        ids = [self.byte_id[b] for b in word]
        n = len(ids)
        after, before, merge = [*range(1, n), -1], [-1, *range(n - 1)], self.merge
        heap = [(m[0], i, m[1], ids[i], ids[i + 1]) for i in range(n - 1) if (m := merge.get((ids[i], ids[i + 1])))]
        heapq.heapify(heap)
        while heap:
            _, i, z, x, y = heapq.heappop(heap)
            j = after[i]
            if ids[i] != x or j < 0 or ids[j] != y:
                continue
            ids[i], ids[j] = z, -1
            after[i] = k = after[j]
            if k >= 0:
                before[k] = i
                if m := merge.get((z, ids[k])):
                    heapq.heappush(heap, (m[0], i, m[1], z, ids[k]))
            if (h := before[i]) >= 0 and (m := merge.get((ids[h], z))):
                heapq.heappush(heap, (m[0], h, m[1], ids[h], z))
        return [i for i in ids if i >= 0]

    # Words and texts

    def learn(self, words: list[str]) -> None:
        """Puts the tokens of these distinct words into the cache."""
        raw = [w.encode() for w in words]
        proposed = [self.propose(w) for w in raw]
        counts = np.fromiter(map(len, proposed), np.int64, len(proposed))
        flat = np.fromiter(chain.from_iterable(proposed), np.int64, int(counts.sum()))
        word_of = np.repeat(np.arange(len(words)), counts)
        inner = np.flatnonzero(word_of[1:] == word_of[:-1]) if len(flat) else np.empty(0, np.int64)
        pairs, of_pair = np.unique(flat[inner] * self.size + flat[inner + 1], return_inverse=True)
        ok = self.compatible(pairs // self.size, pairs % self.size)
        failing = np.zeros(len(words), bool)
        failing[word_of[inner[~ok[of_pair]]]] = True
        for i in np.flatnonzero(failing).tolist():
            proposed[i] = self.merged_short(raw[i]) if len(raw[i]) <= SHORT else self.merged(raw[i])
        packed = np.fromiter(chain.from_iterable(proposed), np.int32).tobytes()
        ends = [4 * n for n in accumulate(map(len, proposed))]
        self.cache.update(zip(words, (packed[a:z] for a, z in zip([0, *ends], ends)), strict=True))

    def words_of(self, text: str) -> list[str]:
        if text.isascii():
            pattern = self.ascii_pattern
        else:
            pattern = self.basic_pattern if len(text.encode("utf-16-le")) == 2 * len(text) else self.pattern
        if self.added_pattern is None or not any(t in text for t in self.added):
            return pattern.findall(text)
        out, at = [], 0
        for m in self.added_pattern.finditer(text):
            out += pattern.findall(text[at : m.start()])
            out.append("\x00\x00added" + m[0])
            at = m.end()
        return out + pattern.findall(text[at:])

    def forget(self) -> None:
        """Empties the memory of words."""
        self.cache, self.older = {}, {}

    def encode_batch(self, texts: list[str | None]) -> list[np.ndarray]:
        split = [self.words_of(t) if t else [] for t in texts]
        if len(self.cache) > CACHE_WORDS:
            self.older, self.cache = self.cache, {}
        new = set().union(*split).difference(self.cache)
        self.cache.update((w, self.older[w]) for w in new if w in self.older)
        new = {w for w in new if w not in self.cache}
        for t, i in self.added.items():
            if (mark := "\x00\x00added" + t) in new:
                new.discard(mark)
                self.cache[mark] = np.int32(i).tobytes()
        if new:
            self.learn([*new])
        known = self.cache
        return [np.frombuffer(b"".join(map(known.__getitem__, words)), np.int32) for words in split]

    def decode_batch(self, batch: list[np.ndarray]) -> list[str]:
        out = []
        for ids in batch:
            ids = ids.astype(np.int64)
            lengths = self.lengths[ids]
            shift = self.starts[ids] - np.concatenate(([0], np.cumsum(lengths)[:-1])) if len(ids) else lengths
            where = np.repeat(shift, lengths) + np.arange(int(lengths.sum()))
            out.append(self.all_bytes[where].tobytes().decode("utf-8", "replace"))
        return out


@lru_cache(maxsize=2)
def vocabulary(path: str) -> ByteBpe:
    """Read once in each worker; the file lies at the same path on every machine."""
    return ByteBpe(path)


def _flat(ids: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate(([0], np.cumsum([len(x) for x in ids]))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids) if ids else np.empty(0, np.int32), pa.int32()))


def encode(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", decoded: bool = False) -> DataFrame:
    """One row per row of df: the id column (null stays null) and token_ids, an array of int (empty for null or ''); with
    decoded, also the text that these ids decode to, made by the same Python worker."""
    key = df.select(F.col(id_col).alias("key"), F.col(text_col).alias("text"))
    kind = key.schema["key"].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids = vocabulary(path).encode_batch(batch.column(1).to_pylist())
        columns = {"key": batch.column(0), "token_ids": _flat(ids)}
        if decoded:
            columns["decoded"] = pa.array(vocabulary(path).decode_batch(ids), pa.string())
        return pa.RecordBatch.from_pydict(columns)

    out = arrow_map(key, run, f"key {kind}, token_ids array<int>" + ", decoded string" * decoded, rows=128, done=lambda: vocabulary(path).forget())
    return out.withColumnRenamed("key", id_col)


def decode(df: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "token_ids") -> DataFrame:
    """One row per row of df: the id column, the tokens and their text; bytes that aren't UTF-8 become U+FFFD."""
    key = df.select(F.col(id_col).alias("key"), F.col(ids_col).alias("ids"))
    kind = key.schema["key"].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids = batch.column(1)
        lists = [np.asarray(x.values, np.int32) if x.is_valid else np.empty(0, np.int32) for x in ids]
        texts = pa.array(vocabulary(path).decode_batch(lists), pa.string())
        return pa.RecordBatch.from_arrays([batch.column(0), ids, texts], ["key", "ids", "decoded"])

    out = arrow_map(key, run, f"key {kind}, ids array<int>, decoded string")
    return out.select(F.col("key").alias(id_col), F.col("ids").alias(ids_col), "decoded")


def ids_digest(ids: Column) -> Column:
    """SHA-256 of the decimal ids joined by commas."""
    return F.sha2(F.array_join(ids.cast("array<string>"), ","), 256)


def round_trip(df: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every text."""
    both = encode(df, path, decoded=True)
    ids = F.col("token_ids")
    return both.select(
        "doc_id",
        F.size(ids).cast("long").alias("n_tokens"),
        ids_digest(ids).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )
