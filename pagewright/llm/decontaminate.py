"""Benchmark decontamination by SimHash over item-sized windows. DataFrame functions only.

1. Items and documents become hashes of five-word shingles (of all words, for an item with fewer). A sketch of the items'
   shingles (its size follows the benchmark) tells at once which positions of a document can hold an item's shingle at
   all. A window that shares no shingle with an item has similarity 0, so windows, of an item's size, are laid only where
   a shingle of an item meets the same one in the document. Of those, what no item holds may be 1 - `least` of a window
   that matches at most, as such shingles weigh most; windows with more of it are left out.
2. A shingle weighs ln(1 + items / items that hold it), by exact counts joined to the distinct windows and items. Every
   window and item gets a 64-bit SimHash of its distinct shingles, by the roots of their weights (their cosine is then
   never below the similarity of 4., whatever weighs most), cut into BLOCKS blocks. Items are entered under every value within
   ITEM_BITS of their own blocks and windows ask for every value within WINDOW_BITS of theirs, so a pair that differs in at
   most ITEM_BITS + WINDOW_BITS bits of one block meets: by the pigeonhole principle all fingerprints within GUARANTEED
   bits do. Pairs that meet and are at most RADIUS bits apart are candidates.
3. The rest: a pair that is similar enough shares one of the heaviest shingles of both sides, those before which less
   than 1 - `least` of the weight stands. Pairs that meet there and by no fingerprint are candidates too, so none is lost.
4. Candidates are verified exactly: the shared shingles' weight over that of the heavier side must reach `least`.

A pair at a similarity of 0.8 differs in 13 of 64 bits on average and meets in 97 of 100 cases, one at 0.9 in 999 of
1000 (tests measure it); unrelated fingerprints meet in 4 of 100, and one of 100 is then within RADIUS.

Null and empty texts hold nothing; an item without words matches nothing. Repeated rows give one row per id and item;
documents or items that share an id with another text count each, their matches go to the one id. Items and windows of
any length are handled, a row at a time. An empty table on either side gives no rows. Further columns of any name pass by.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .runtime import BROADCAST_IDS, keyed, lookup, written

LEAST = 0.8
WIDTH = 5
BLOCKS, BLOCK_BITS = 4, 16
ITEM_BITS, WINDOW_BITS = 1, 2
#: BLOCKS blocks that each differ in more than ITEM_BITS + WINDOW_BITS bits differ in more bits than this.
GUARANTEED = BLOCKS * (ITEM_BITS + WINDOW_BITS + 1) - 1
#: Pairs that meet may differ in so many bits.
RADIUS = 26
PROBES = 4
#: Bytes of window places that are broadcast to the documents at most; more are shuffled.
BROADCAST_BYTES = 32 << 20


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def shingles(ws: Column, width: int) -> Column:
    """A hash for each run of `width` words, in order; none for fewer words."""
    n = F.size(ws)
    at = F.sequence(F.lit(0), n - width)
    return F.when(n >= width, F.transform(at, lambda i: F.xxhash64(*[F.get(ws, i + j) for j in range(width)]))).otherwise(F.array().cast("array<long>"))


class Sketch:
    """Whether an item can hold a shingle: a bit at PROBES places each, 64 of them to a number. It only spares work: a
    full one lets everything through, which the joins with the items' shingles then decide."""

    def __init__(self, held: DataFrame):
        """held: item, h (distinct)."""
        n = held.count()
        self.bits = min(24, max(14, (16 * max(n, 1) - 1).bit_length()))
        place = held.select(F.explode(F.array(*[self._place(F.col("h"), j) for j in range(PROBES)])).alias("place"))
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("place").bitwiseAND(F.lit(63)))
        packed = place.groupBy(F.shiftright("place", 6).alias("slot")).agg(F.bit_or(bit).alias("held")).toArrow()
        slots = np.zeros(1 << self.bits - 6, np.int64)  # at most 2^18
        slots[packed["slot"].to_numpy()] = packed["held"].to_numpy()
        self.table = F.split(F.lit(",".join(map(str, slots.tolist()))), ",").cast("array<long>")
        self.items = held.select("item").distinct().count()
        self.counts = written(held.groupBy("h").agg(F.count("*").alias("c")), "held")

    def _place(self, h: Column, j: int) -> Column:
        return F.shiftrightunsigned(h, (64 - self.bits) * j // (PROBES - 1)).bitwiseAND(F.lit((1 << self.bits) - 1)).cast("int")

    def _bit(self, h: Column, j: int) -> Column:
        place = self._place(h, j)
        return F.call_function("shiftrightunsigned", F.get(self.table, F.shiftright(place, 6)), place.bitwiseAND(F.lit(63))).bitwiseAND(F.lit(1))

    def holds(self, h: Column) -> Column:
        return reduce(lambda a, b: a & b, [self._bit(h, j) > 0 for j in range(PROBES)])

    def weighed(self, lists: DataFrame, key: str, hs: str, small) -> DataFrame:
        """lists (one row per key) and ws, the weights of the shingles hs."""
        each = lists.select(key, F.posexplode(hs).alias("i", "h"))
        # Most lists share the same shingles: the count of one is looked up once, not once for each list.
        heavy = self.counts.join(each.groupBy("h").agg(F.count("*").alias("uses")), "h")
        found = each.join(small(self.counts), "h", "left") if small is F.broadcast else lookup(each, "h", heavy, "uses", F.col(key))
        weight = F.log1p(F.lit(float(self.items)) / F.coalesce("c", F.lit(1)))
        found = found.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("i", weight.alias("w")))).alias("ws"))
        return written(lists.join(found.select(key, F.col("ws.w").alias("ws")), key), "weighed")


def simhash(hs: Column, ws: Column) -> Column:
    """64 bits: whether the shingles with the bit set outweigh those without."""

    def bit(b: Column) -> Column:
        one = lambda i: F.get(ws, i) * (F.lit(1) - 2 * F.call_function("shiftright", F.get(hs, i), b).bitwiseAND(F.lit(1)))
        total = F.aggregate(F.sequence(F.lit(0), F.size(hs) - 1), F.lit(0.0), lambda a, i: a + one(i))
        return F.when(total < 0, F.call_function("shiftleft", F.lit(1).cast("long"), b)).otherwise(F.lit(0).cast("long"))

    return F.aggregate(F.sequence(F.lit(0), F.lit(63)), F.lit(0).cast("long"), lambda a, b: a.bitwiseOR(bit(b)))


def _block(sim: Column, k: int) -> Column:
    return F.shiftrightunsigned(sim, BLOCK_BITS * k).bitwiseAND(F.lit((1 << BLOCK_BITS) - 1)).cast("int")


def keys_of(sim: Column, bits: int) -> Column:
    """The values within so many bits of each block, with the block's number above."""
    masks = [sum(1 << b for b in own) for n in range(bits + 1) for own in combinations(range(BLOCK_BITS), n)]
    near = lambda k: F.transform(F.array(*map(F.lit, masks)), lambda m: _block(sim, k).bitwiseXOR(m) + (k << BLOCK_BITS))
    return F.flatten(F.array(*map(near, range(BLOCKS))))


def _sum(xs: Column) -> Column:
    return F.aggregate(xs, F.lit(0.0), lambda a, x: a + x)


def _heaviest_first(hs: str) -> Column:
    """The distinct shingles with their weights (negative), in an order that all windows and items share."""
    return F.array_sort(F.array_distinct(F.zip_with(hs, "ws", lambda h, w: F.struct((-w).alias("nw"), h.alias("h")))))


def _marked(es: str) -> Column:
    """Shingles with their weights, as texts: those can be intersected by hashing."""
    return F.transform(es, lambda e: F.concat_ws(":", e["h"].cast("string"), (-e["nw"]).cast("string")))


def _leading(es: str, least: float) -> Column:
    """The shingles before which at most 1 - least of the weight stands. Two sides whose first common shingle lies beyond
    one's share less than `least` of its weight. A little more is taken for the rounding of sums."""
    bound = (1 - least + 1e-9) * F.col("mass")
    start = F.struct(F.lit(0.0).alias("before"), F.lit(0).alias("k"))
    more = lambda a, e: F.struct((a["before"] - e["nw"]).alias("before"), (a["k"] + (a["before"] <= bound).cast("int")).alias("k"))
    return F.transform(F.slice(es, 1, F.aggregate(es, start, more, lambda a: a["k"])), lambda e: e["h"])


def _judged(lists: DataFrame, hs: str, least: float) -> DataFrame:
    """With the fingerprint (sim), the weight (mass), the leading shingles (lead) and all of them (set)."""
    lists = lists.withColumn("es", _heaviest_first(hs)).withColumn("mass", _sum(F.transform("es", lambda e: -e["nw"])))
    sim = simhash(F.transform("es", lambda e: e["h"]), F.transform("es", lambda e: F.sqrt(-e["nw"])))
    return lists.withColumns({"sim": sim, "lead": _leading("es", least), "set": _marked("es")}).drop("es")


def _hits(texts: DataFrame, widths: list[int], sketch: Sketch) -> DataFrame:
    """doc_id, row, width, pos, h: every position of a document whose shingle an item may hold. One pass for all widths."""
    made = texts.select("doc_id", "row", *[shingles(F.col("ws"), w).alias(f"h{w}") for w in widths])

    def found(w: int) -> Column:
        hs = F.col(f"h{w}")
        at = F.when(F.size(hs) > 0, F.filter(F.sequence(F.lit(0), F.size(hs) - 1), lambda i: sketch.holds(F.get(hs, i)))).otherwise(F.array().cast("array<int>"))
        return F.transform(at, lambda i: F.struct(F.lit(w).alias("width"), i.alias("pos"), F.get(hs, i).alias("h")))

    hits = made.select("doc_id", "row", F.concat(*map(found, widths)).alias("hits"))
    # explode_outer, as explode would filter by all this a second time.
    return hits.select("doc_id", "row", F.explode_outer("hits").alias("hit")).where("hit IS NOT NULL").select("doc_id", "row", "hit.*")


def windows(texts: DataFrame, items: DataFrame, widths: list[int], sketch: Sketch, small, least: float) -> DataFrame:
    """doc_id, row, width, n, start and win (the shingles) of every window that is worth a fingerprint."""
    postings = items.select("width", F.size("hs").alias("n"), F.posexplode("hs").alias("at", "h")).distinct()
    start = F.greatest(F.col("pos") - F.col("at"), F.lit(0)).alias("start")
    laid = _hits(texts, widths, sketch).join(small(postings), ["width", "h"]).select("doc_id", "row", "width", "n", start).distinct()
    places = written(laid.groupBy("doc_id", "row").agg(F.collect_list(F.struct("width", "n", "start")).alias("places")), "places")
    held = places.agg(F.coalesce(F.sum(F.size("places") * 16 + 64), F.lit(0))).first()[0]
    own = F.broadcast(places) if held <= BROADCAST_BYTES else places
    both = texts.join(own, ["doc_id", "row"]).select("doc_id", "row", "places", *[shingles(F.col("ws"), w).alias(f"h{w}") for w in widths])
    each = both.select("doc_id", "row", *[f"h{w}" for w in widths], F.explode("places").alias("p"))
    win = F.coalesce(*[F.when(F.col("p.width") == w, F.slice(f"h{w}", F.col("p.start") + 1, F.col("p.n"))) for w in widths])
    each = each.select("doc_id", "row", "p.*", win.alias("win")).repartition(F.xxhash64("doc_id", "row", "start"))
    known = F.size(F.filter(F.array_distinct("win"), sketch.holds))
    return written(each.withColumns({"known": known, "all": F.size(F.array_distinct("win"))}), "laid").where(F.col("known") >= (least - 1e-9) * F.col("all")).drop("known", "all")


def matches(docs: DataFrame, benchmark: DataFrame, least: float = LEAST) -> DataFrame:
    """doc_id, item_id, similarity (the best window's) and first_word (where the first matching window begins)."""
    items = benchmark.where("item_id IS NOT NULL").select("item_id", words(F.col("text")).alias("ws")).where(F.size("ws") > 0)
    items = items.withColumns({"width": F.least(F.size("ws"), F.lit(WIDTH)), "item": F.xxhash64("item_id", "ws")})
    hs = F.coalesce(*[F.when(F.col("width") == w, shingles(F.col("ws"), w)) for w in range(1, WIDTH + 1)])
    items = written(items.select("item_id", "item", "width", hs.alias("hs")).dropDuplicates(["item"]), "benchmark")
    texts = docs.where("doc_id IS NOT NULL").select("doc_id", F.xxhash64("text").alias("row"), words(F.col("text")).alias("ws"))
    held = items.select("item", F.explode(F.array_distinct("hs")).alias("h"))
    widths = [r.width for r in items.select("width").distinct().orderBy("width").collect()]
    if not widths:
        kind = docs.schema["doc_id"].dataType.simpleString(), benchmark.schema["item_id"].dataType.simpleString()
        return docs.sparkSession.createDataFrame([], f"doc_id {kind[0]}, item_id {kind[1]}, similarity double, first_word long")
    size = items.agg(F.sum(F.size("hs")).alias("shingles"), F.count("*").alias("items")).first()
    entered = size["items"] * BLOCKS * (1 + BLOCK_BITS)  # rows of the index
    small = F.broadcast if max(size["shingles"], entered) <= BROADCAST_IDS else lambda x: x
    sketch = Sketch(held)

    # The size counts too: a window that ends with its document may hold what a window for smaller items holds.
    laid = windows(texts, items, widths, sketch, small, least).withColumn("same", F.xxhash64("width", "n", "win"))
    laid = written(laid, "windows")
    # Equal windows are judged once, however many documents hold them.
    lists = written(laid.groupBy("same").agg(F.first("width").alias("width"), F.first("n").alias("n"), F.first("win").alias("win"), F.count("*").alias("rows")), "lists")
    lists = sketch.weighed(lists, "same", "win", small).repartition("same")
    lists = written(_judged(lists, "win", least).select("same", "width", "n", "rows", "sim", "mass", "lead", "set"), "fingerprints")
    known = sketch.weighed(items.select("item_id", "item", "width", "hs", F.size("hs").alias("n")), "item", "hs", small).repartition("item")
    known = written(_judged(known, "hs", least).select("item_id", "item", "width", "n", "sim", "mass", "lead", F.col("set").alias("item_set")), "items")
    near = candidates(lists, known, small)
    near = near.unionByName(rest(lists, known, near, small, least))
    near = near.join(lists.select("same", "rows", "set"), "same").join(small(known.select("item_id", "item", "item_set")), "item")

    weight = lambda xs: _sum(F.transform(xs, lambda x: F.substring_index(x, ":", -1).cast("double")))
    shared = weight(F.array_intersect("set", "item_set"))
    near = near.withColumn("similarity", shared / F.greatest(weight(F.col("set")), weight(F.col("item_set")))).where(F.col("similarity") >= least)
    found = written(near.groupBy("same").agg(F.first("rows").alias("rows"), F.collect_list(F.struct("item_id", "similarity")).alias("found")), "found")
    out = lookup(laid.select("doc_id", "start", "same"), "same", found, "rows", F.xxhash64("doc_id", "start")).where("found IS NOT NULL")
    out = out.select("doc_id", "start", F.explode("found").alias("m")).groupBy("doc_id", F.col("m.item_id").alias("item_id"))
    return out.agg(F.max("m.similarity").alias("similarity"), F.min("start").cast("long").alias("first_word"))


def candidates(lists: DataFrame, known: DataFrame, small) -> DataFrame:
    """(same, item): the distinct pairs of a window and an item of its size whose fingerprints meet within RADIUS."""
    entries = known.select("width", "n", "item", F.col("sim").alias("item_sim"), F.explode(keys_of(F.col("sim"), ITEM_BITS)).alias("key"))
    asked = lists.select("width", "n", "same", "sim", F.explode(keys_of(F.col("sim"), WINDOW_BITS)).alias("key"))
    near = asked.join(small(entries), ["width", "n", "key"]).where(F.bit_count(F.col("sim").bitwiseXOR(F.col("item_sim"))) <= RADIUS)
    return written(near.select("same", "item").distinct(), "near")


def rest(lists: DataFrame, known: DataFrame, near: DataFrame, small, least: float) -> DataFrame:
    """(same, item): the distinct pairs that share a leading shingle, weigh alike, and whose fingerprints don't meet."""
    entries = known.select("width", "n", "item", F.col("mass").alias("item_mass"), F.explode("lead").alias("h"))
    asked = lists.select("width", "n", "same", "mass", F.explode("lead").alias("h"))
    alike = F.least("mass", "item_mass") >= (least - 1e-9) * F.greatest("mass", "item_mass")
    met = asked.join(small(entries), ["width", "n", "h"]).where(alike).select("same", "item").distinct()
    return written(met.join(near, ["same", "item"], "left_anti"), "rest")


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no benchmark item."""
    leaks = matches(docs, benchmark).select("doc_id").distinct()
    return keyed(docs, "doc_id", leaks, "left_anti")
