"""Line dedup by an exact set-similarity join. DataFrame functions only.

A line is the set of its lower-cased tokens (split at spaces). Lines stand in corpus order, by doc_id and line
number. A line is removed if an earlier line has the same set, or one with a Jaccard similarity of 4/5 or more; which
earlier line that is, and whether it goes itself, doesn't matter. Lines without tokens stay. Rows that share a doc_id
are told apart by their texts and keep their own lines; of lines in the same place (doc_id and line number) none is
later than the other.

Tokens are ordered by rarity: the logarithm, to the base of 2, of a count over all documents in a sketch of 2^20 counters
(tokens that make up less than a millionth of the corpus stand first in whatever order), then by their hash. Distinct sets, told apart by 128 bits, are grouped first; each enters the join once, under the tokens of its
prefix (two sets that are similar enough share a token there):

1. A semi-join keeps the entries that have, under the same prefix token, a partner that passes the length filter, the
   positional filter (as the first token that both share) and a bound on the symmetric difference from 64 parity bits (128
   for long lines). All but rare tokens are split by classes of set sizes; what is still large is split by Spark's skew join.
2. The sets that are left, with their tokens, meet under their rarest such token: a semi-join with the exact Jaccard
   similarity of the tokens themselves finds an earlier partner of most.
3. For sets without one so far, all their entries are taken: those with an earlier partner that passes the filters of 1.,
   for long lines now with 256 parity bits, and these partners are verified with the tokens as in 2. So every similar pair
   has been met under the first token that it shares, which both prefixes hold.

Semi-joins end at the first partner, so a group of many similar lines gives one row a line, never its pairs.

Null texts stay null, empty ones empty. A row without a doc_id has no place: it stays as it is, and removes nothing. An
empty table gives no rows. Further columns of any name pass by.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .runtime import HOT_GROUPS, dropped, settings, written

#: Counters of the rarity sketch.
SKETCH_BITS = 20
#: rarity() by itself estimates from one of so many documents (a power of two). Line dedup doesn't: it counts in all of them.
SHARE = 32
#: Where a token's level of rarity stands in its number, over 59 bits of its hash; and in the 31 bits that entries have.
_LEVEL, _TOKEN = 58, 26
#: Level (count of 2^(level + 1) and more) from which on a token's entries are split by size.
FREQUENT = 5
#: Parts of the tokens, joined one after the other; a power of two.
ROUNDS = 2
#: Tokens of a set from which on 128 parity bits count instead of 64.
LONG = 96
#: While tokens are counted: room for all counters in the map that Spark compiles for an aggregate.
COUNTING = {"spark.sql.codegen.aggregate.fastHashMap.capacityBit": str(SKETCH_BITS)}
#: Bytes of line numbers that are broadcast to the documents at most; more are shuffled.
BROADCAST_BYTES = 32 << 20


def lines_of(text: Column) -> Column:
    return F.split(text, "\n")


def tokens_of(line: Column) -> Column:
    """Tokens, and empty strings where spaces stand together: those have to be left out by whoever asks."""
    return F.split(F.lower(line), " ")


def _shift(name: str, value: Column, by: Column) -> Column:
    return F.call_function(name, value, by)


def _hash(token: Column) -> Column:
    """_LEVEL bits."""
    return F.shiftrightunsigned(F.xxhash64(token), 64 - _LEVEL)


def rarity(docs: DataFrame, share: int | None = None, fine: bool = False) -> Column:
    """A literal array of every counter's level: floor(log4) of its tokens in all documents, 15 at most, or if fine one less than
    floor(log2), 0 to 31; with a share above 1 (SHARE unless given) as one of so many documents lets expect."""
    share = SHARE if share is None else share
    drawn = docs if share == 1 else docs.where(F.xxhash64("doc_id", "text").bitwiseAND(F.lit(share - 1)) == 0)
    tokens = drawn.select(F.explode(tokens_of(F.replace(F.col("text"), F.lit("\n"), F.lit(" ")))).alias("t"))
    counted = tokens.groupBy(_hash("t").bitwiseAND(F.lit((1 << SKETCH_BITS) - 1)).alias("b")).count()
    log = F.log2(F.col("count") * share)
    level = (F.least(F.greatest(F.floor(log) - 1, F.lit(0)), F.lit(31)) if fine else F.least(F.floor(log / 2), F.lit(15))).cast("long")
    # 8 levels travel to the driver in one number.
    byte = _shift("shiftleft", level, F.col("b").bitwiseAND(F.lit(7)).cast("int") * 8)
    with settings(docs.sparkSession, COUNTING):
        packed = counted.groupBy(F.shiftright("b", 3).alias("slot")).agg(F.bit_or(byte).alias("levels")).where("levels <> 0").toArrow()
    slots = np.zeros(1 << SKETCH_BITS - 3, np.int64)
    slots[packed["slot"].to_numpy()] = packed["levels"].to_numpy()
    levels = slots[:, None] >> np.arange(0, 64, 8) & 31
    return F.split(F.lit(",".join(map(str, levels.ravel().tolist()))), ",").cast("array<long>")


def numbers(hashes: Column, rare: Column) -> Column:
    """Token hashes as numbers, rarest first. None of them may be null: then Spark sorts them as plain longs. rare has all counters,
    so an index needs neither a cast nor a default: lambdas are interpreted, and each step of theirs counts."""
    level = lambda h: rare[h.bitwiseAND(F.lit((1 << SKETCH_BITS) - 1))]
    return F.sort_array(F.transform(hashes, lambda h: h.bitwiseOR(F.shiftleft(level(h), _LEVEL))))


def _overlap(a: Column, b: Column) -> Column:
    """The tokens that sets of a and b elements must share for a Jaccard similarity of 4/5: 4/9 of a + b, or more."""
    return F.floor((4 * (a + b) + 8) / 9)


def _prefix(n: Column) -> Column:
    """Elements of a set of n that hold a shared token of any similar set: n - ceil(4n/5) + 1."""
    return (n - F.floor((4 * n + 4) / 5) + 1).cast("int")


def _parity(tokens: Column, half: bool = False) -> Column:
    """For each of 64 bits, whether an odd number of tokens falls on it; with half, of the tokens whose seventh bit is 0.
    Bits that differ need tokens that differ. Both together tell of 128 bits: the other half is their XOR."""

    def one(k: Column) -> Column:
        bit = _shift("shiftleft", F.lit(1).cast("long"), k.bitwiseAND(F.lit(63)).cast("int"))
        return F.when(k.bitwiseAND(F.lit(64)) == 0, bit).otherwise(F.lit(0).cast("long")) if half else bit

    return F.aggregate(tokens, F.lit(0).cast("long"), lambda a, k: a.bitwiseXOR(one(k)))


def _row(text: str = "text") -> Column:
    """Tells rows of the same doc_id apart."""
    return F.xxhash64(text)


def numbered(docs: DataFrame, rare: Column) -> DataFrame:
    """One row per line with tokens: its place, and its set's 128 bits, size and prefix (31 bits a token)."""
    # Two steps: a row of the explosion then takes along no text.
    rows = docs.where("doc_id IS NOT NULL AND text IS NOT NULL").select("doc_id", _row().alias("row"), lines_of(F.col("text")).alias("every"))
    rows = rows.select("doc_id", "row", F.posexplode("every").alias("line", "value"))
    hashes = F.array_distinct(F.transform(tokens_of(F.col("value")), _hash))
    rows = rows.select("doc_id", "row", "line", F.array_remove(hashes, _hash(F.lit(""))).alias("hs"))
    rows = rows.select("doc_id", "row", "line", "hs", F.size("hs").alias("n"), numbers(F.col("hs"), rare).alias("set"))
    rows = rows.select(
        "doc_id", "row", "line", F.xxhash64("set").alias("k1"), _parity(F.col("hs")).alias("parity"), "n",
        F.when(F.col("n") > LONG, _parity(F.col("hs"), half=True)).otherwise(F.lit(0).cast("long")).alias("half"),
        F.transform(F.slice("set", 1, _prefix(F.col("n"))), lambda x: F.shiftright(x, _LEVEL - _TOKEN).cast("int")).alias("prefix"),
    )
    # Filtered once it is written: before, Spark would make the tokens a second time for the filter.
    return written(rows, "lines").where("n > 0")


def sets(lines: DataFrame) -> DataFrame:
    """One row per distinct set, with its first place and its number of lines."""
    first = F.min(F.struct("doc_id", "line", "row")).alias("first")
    return written(lines.groupBy("k1", "parity").agg(first, F.count("*").alias("lines"), *[F.first(c).alias(c) for c in ("n", "half", "prefix")]), "sets")


def _sizes(a: str, b: str) -> Column:
    na, nb = F.col(f"{a}.n"), F.col(f"{b}.n")
    return (5 * na >= 4 * nb) & (5 * nb >= 4 * na)


def _places(a: str, b: str, differ: Column) -> Column:
    """The filters on two entries of one token, if it is the first that the sets share: sizes, the bits that differ, and the
    token's positions ia and ib. The tokens before it are in one set only, so ia + ib tokens differ at least, and the sets
    share no more than what stands from it on. A similar pair passes under its first shared token, which both prefixes hold."""
    na, nb, ia, ib = [F.col(f"{s}.{c}") for c in ("n", "i") for s in (a, b)]
    need = _overlap(na, nb)
    return _sizes(a, b) & (differ <= na + nb - 2 * need) & (ia + ib <= na + nb - 2 * need) & (F.least(na - ia, nb - ib) >= need)


def _may_match(a: str, b: str) -> Column:
    """The filters on two entries of different sets, with the parities of lines."""
    of = lambda s, c: F.col(f"{s}.{c}")
    na, nb = of(a, "n"), of(b, "n")
    apart, low = [of(a, c).bitwiseXOR(of(b, c)) for c in ("parity", "half")]
    long = (na > LONG) & (nb > LONG)
    differ = F.when(long, F.bit_count(low) + F.bit_count(apart.bitwiseXOR(low))).otherwise(F.bit_count(apart))
    return _places(a, b, differ) & ((of(a, "k1") != of(b, "k1")) | (apart != 0))


def _keys(token: Column, n: Column, i: Column) -> Column:
    """What entries of a token meet under: the token, or for a frequent one the class of their set's size, where they meet
    smaller ones and their own class, and the next class if a set that large may still pass _places at position i: it asks
    for n - i >= 4/9 of both sizes."""
    size = lambda x: F.floor(F.log(x.cast("double")) / F.log(F.lit(1.25)) + 1e-9)
    own = token.cast("long") * 1024 + 1 + size(n)
    rare = token < FREQUENT << _TOKEN
    return F.when(rare, F.array(token.cast("long") * 1024)).when(size(F.shiftright(5 * n - 9 * i, 2)) > size(n), F.array(own, own + 1)).otherwise(F.array(own))


def candidates(distinct: DataFrame) -> DataFrame:
    """The entries (a set, its i-th token's key) that have a partner under the same key which passes the filters.

    Tokens are taken in ROUNDS parts, one after the other, so that the disk holds one part's shuffle at a time."""
    columns = ["k1", "parity", "half", "n"]
    entries = distinct.where("n >= 4").select(*columns, F.posexplode("prefix").alias("i", "token"))
    found = []
    for r in range(ROUNDS):
        part = entries.where(F.col("token").bitwiseAND(F.lit(ROUNDS - 1)) == r)
        part = part.select(*columns, "i", F.explode(_keys(F.col("token"), F.col("n"), F.col("i"))).alias("key"))
        a, b = part.alias("a"), part.alias("b")
        found.append(written(a.join(b, (F.col("a.key") == F.col("b.key")) & _may_match("a", "b"), "left_semi").select("k1", "parity", "i", "key"), "entries"))
    return reduce(DataFrame.unionByName, found)


def beside(docs: DataFrame, of_rows: DataFrame, numbers: str) -> DataFrame:
    """docs LEFT JOIN of_rows ON (doc_id, row), where `numbers` is an array of line numbers: by broadcast if all of them fit
    BROADCAST_BYTES, else by a shuffle."""
    held = of_rows.agg(F.coalesce(F.sum(F.size(numbers) * 4 + 64), F.lit(0))).first()[0]
    small = F.broadcast(of_rows) if held <= BROADCAST_BYTES else of_rows
    left = docs.withColumn("__row", _row())
    return left.join(small.withColumnsRenamed({"doc_id": "__id", "row": "__its"}), (F.col("doc_id") == F.col("__id")) & (F.col("__row") == F.col("__its")), "left").drop("__id", "__row", "__its")


def with_tokens(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """chosen (with first) and the line that first is: set, its distinct tokens."""
    wanted = written(chosen.groupBy(F.col("first.doc_id").alias("doc_id"), F.col("first.row").alias("row")).agg(F.array_sort(F.collect_set("first.line")).alias("__at")), "wanted")
    texts = beside(docs.select("doc_id", "text"), wanted, "__at").where("__at IS NOT NULL")
    texts = texts.select("doc_id", _row().alias("row"), "__at", lines_of(F.col("text")).alias("every"))
    # The texts' lines are used twice, so Spark splits a text once and not for every line.
    texts = texts.where(F.size("every") > 0).select("doc_id", "row", F.explode(F.transform("__at", lambda i: F.struct(i.alias("line"), F.get("every", i).alias("value")))).alias("at"))
    texts = texts.select("doc_id", "row", "at.line", F.array_remove(F.array_distinct(tokens_of(F.col("at.value"))), "").alias("set"))
    # By plain columns: what dropDuplicates shuffles then stands as the join needs it.
    place = ["doc_id", "line", "row"]
    same = reduce(Column.__and__, [F.col(f"first.{c}") == F.col(c) for c in place])
    return written(chosen.join(texts.dropDuplicates(place), same).drop(*place), "texts")


def _wide(chosen: DataFrame) -> DataFrame:
    """chosen and, for its long lines, q0 to q3: 256 parity bits of set."""
    hashes = chosen.withColumn("hs", F.when(F.col("n") > LONG, F.transform("set", _hash)))
    parity = lambda q: _parity(F.filter("hs", lambda h: F.shiftright(h, 6).bitwiseAND(F.lit(3)) == q)).alias(f"q{q}")
    return hashes.select(*chosen.columns, *map(parity, range(4)))


_EARLIER = "struct(a.first.doc_id, a.first.line) < struct(b.first.doc_id, b.first.line)"


def _verified(b: DataFrame, a: DataFrame) -> DataFrame:
    """(k1, parity) of the rows of b that have an earlier partner in a under their key: key, first, n, set."""
    # Earlier partners are other sets anyway. Asked for, they keep both sides' columns alike: a table beside itself is shuffled once.
    other = F.expr("a.k1 <> b.k1 OR a.parity <> b.parity")
    shared = F.size(F.array_intersect("a.set", "b.set"))
    same = (F.col("a.key") == F.col("b.key")) & other & F.expr(_EARLIER) & _sizes("a", "b") & (9 * shared >= 4 * (F.col("a.n") + F.col("b.n")))
    return written(b.alias("b").join(a.alias("a"), same, "left_semi").select("k1", "parity").distinct(), "similar")


def similar_to_earlier(docs: DataFrame, distinct: DataFrame) -> DataFrame:
    """(k1, parity) of the sets that have an earlier partner with a Jaccard similarity of 4/5 or more."""
    entries = candidates(distinct)
    ids = ["k1", "parity"]
    # The first key of each set: i and key in one number, which Spark needs no sort to find the least of.
    packed = F.min(_shift("shiftleft", F.col("i").cast("long"), F.lit(44)).bitwiseOR(F.col("key")))
    chosen = entries.groupBy(*ids).agg(packed.bitwiseAND(F.lit((1 << 44) - 1)).alias("key"))
    chosen = written(chosen.join(distinct.select(*ids, "first", "n"), ids), "chosen")
    chosen = with_tokens(docs, chosen)
    found = _verified(chosen, chosen)
    bits = [f"q{q}" for q in range(4)]
    firsts = _wide(chosen).select(*ids, "first", "n", *bits).join(found.withColumn("done", F.lit(True)), ids, "left")
    every = written(entries.join(firsts, ids), "entries")
    apart = lambda c: F.bit_count(F.col(f"a.{c}").bitwiseXOR(F.col(f"b.{c}")))
    long = (F.col("a.n") > LONG) & (F.col("b.n") > LONG)
    differ = F.when(long, reduce(lambda x, y: x + y, map(apart, bits))).otherwise(apart("parity"))
    met = (F.col("a.key") == F.col("b.key")) & F.expr(_EARLIER) & _places("a", "b", differ)
    open_ = every.where("done IS NULL")
    left = written(open_.alias("b").join(every.alias("a"), met, "left_semi"), "left")
    right = written(every.alias("a").join(left.alias("b"), met, "left_semi").select(*ids, "key"), "right")
    texts = chosen.select(*ids, "first", "n", "set")
    more = _verified(left.select(*ids, "key").join(texts, ids), right.join(texts, ids))
    for table in (entries, every, left, right, chosen):
        dropped(table)
    return found.unionByName(more)


def _lines_in(lines: DataFrame, groups: DataFrame) -> DataFrame:
    """lines JOIN groups, of `lines` lines each, ON the set: the HOT_GROUPS largest groups (a fixed number of rows) by broadcast,
    so that no task gets more than 1/HOT_GROUPS of the lines for one set."""
    ids = ["k1", "parity"]
    hot = written(groups.orderBy(F.desc("lines"), *ids).limit(HOT_GROUPS), "hot")
    rest = lines.join(F.broadcast(hot.select(*ids)), ids, "left_anti").join(groups, ids)
    return lines.join(F.broadcast(hot), ids).unionByName(rest)


def removed_lines(docs: DataFrame) -> DataFrame:
    """For rows (doc_id, row) that lose any lines: gone, their positions (from 0), and repeats, how many of them repeat an
    earlier set."""
    lines = numbered(docs, rarity(docs, share=1, fine=True))
    distinct = sets(lines)
    similar = similar_to_earlier(docs, distinct).withColumn("similar", F.lit(True))
    marks = distinct.select("k1", "parity", "first", "lines").join(similar, ["k1", "parity"], "left").where("lines > 1 OR similar")
    marks = written(marks.select("k1", "parity", "first", F.coalesce("similar", F.lit(False)).alias("similar"), "lines"), "marks")
    dropped(distinct)
    out = _lines_in(lines.select("doc_id", "row", "line", "k1", "parity"), marks)
    repeat = F.struct("first.doc_id", "first.line") < F.struct("doc_id", "line")
    out = out.select("doc_id", "row", "line", "similar", repeat.alias("repeat")).where("similar OR repeat")
    repeats = F.size(F.collect_set(F.when(F.col("repeat"), F.col("line")))).alias("repeats")
    removed = written(out.groupBy("doc_id", "row").agg(F.collect_set("line").alias("gone"), repeats), "removed")
    dropped(lines)
    return removed


def _marked(docs: DataFrame) -> DataFrame:
    """docs with the lines that stay in text, and __lines, __removed, __repeats beside it."""
    taken = removed_lines(docs).withColumnsRenamed({"gone": "__gone", "repeats": "__again"})
    both = beside(docs, taken, "__gone").withColumn("__every", lines_of(F.col("text")))
    every = F.when(F.col("__gone").isNotNull(), F.array_except(F.sequence(F.lit(0), F.size("__every") - 1), F.col("__gone")))
    # The lines are used several times, so Spark splits a text once and not for every line.
    kept = F.array_join(F.transform(every, lambda i: F.get("__every", i)), "\n")
    text = F.when(F.col("__gone").isNull(), F.col("text")).otherwise(kept).alias("text")
    count = lambda c, name: F.coalesce(c, F.lit(0)).cast("long").alias(name)
    counts = [count(F.size("__every"), "__lines"), count(F.size("__gone"), "__removed"), count(F.col("__again"), "__repeats")]
    return both.select(*[text if c == "text" else F.col(c) for c in docs.columns], *counts)


def deduplicated(docs: DataFrame) -> DataFrame:
    """doc_id, text (the lines that stay), n_lines, n_removed, n_repeats (removed for an equal set) of every document."""
    out = _marked(docs.select("doc_id", "text"))
    return out.select("doc_id", "text", *[F.col(f"__{c}").alias(f"n_{c}") for c in ("lines", "removed", "repeats")])


def stage(docs: DataFrame) -> DataFrame:
    """docs without repeated lines, n_chars anew; documents that lose all their lines go, empty ones stay."""
    out = _marked(docs).where((F.col("__removed") == 0) | (F.length(F.trim("text")) > 0))
    return out.select(*[F.length("text").cast("long").alias(c) if c == "n_chars" else F.col(c) for c in docs.columns])
