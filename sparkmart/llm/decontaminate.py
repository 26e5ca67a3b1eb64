"""Benchmark decontamination (operator 3), DataFrame and SQL functions only.

Texts and items are lower-cased and cut into words of letters and digits. Of a
document, windows as long as an item are compared with the items by the
multiset of their five-word shingles (an item of fewer words is one shingle):
weighted Jaccard similarity, a shingle's weight being how often it occurs. A
document shorter than an item has one window for it, its whole text, if that
has the ``threshold * m`` shingles without which it cannot reach the threshold.

1. Window selection, without loss, whatever the order of the shared passages.
   At threshold t a window of w and an item of m shingles share at least
   ``need = t * (w + m) / (1 + t)``; so of a window as long as the item at most
   ``misses(m) = floor(m * (1 - t) / (1 + t))`` shingles are not the item's.
   Looking at every ``stride``-th shingle of a document therefore meets a
   shared one. (A whole text shorter than the item by d has d / (1 + t) fewer
   that may miss, and is met too.) Of the documents met, all shingles are looked
   up: windows are taken that hold ``need`` shingles of items of their length.
2. Each distinct window gets a 64-bit SimHash of its shingles. Fingerprints are
   cut into eight blocks of 8 bits; within distance r one block differs by at
   most r // 8 bits, so joining the windows' blocks with all such variants of
   the items' blocks finds every pair within the radius. ``radius`` comes from
   the threshold and the wanted recall (vectors of unlike length at one
   similarity have the larger cosine, so a short text keeps it too).
3. Pairs within the radius are verified exactly on their shingle multisets.

Cases: null or empty texts, and texts without ``threshold * m`` shingles, have no
window; null items match nothing; an item
repeated under one id counts once; rows repeated under one id with one text
are one document; extra columns are not read; ties between windows of a
document and an item go to the leftmost.
"""

from __future__ import annotations

from math import acos, comb, pi

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.llm.common import written

SHINGLE = 5
BLOCKS, BITS = 8, 8
NOT_WORD = r"[^\p{L}\p{N}]+"
BROADCAST_KEYS = 1_000_000   # shingle keys of the benchmark that may be broadcast (24 bytes each); more are shuffled


def radius(threshold: float = 0.8, recall: float = 0.999) -> int:
    """Hamming distance that pairs at the threshold keep with this probability:
    their shingle vectors have the cosine 2t / (1 + t), each bit differs with
    probability angle / pi."""
    p = acos(2 * threshold / (1 + threshold)) / pi
    total = 0.0
    for d in range(65):
        total += comb(64, d) * p ** d * (1 - p) ** (64 - d)
        if total >= recall:
            return d
    return 64


def _words(text: str = "text"):
    return F.filter(F.split(F.lower(F.col(text).cast("string")), NOT_WORD), lambda w: w != "")


def _shingles(words, size):
    """Hashes of all runs of ``size`` words (at least one run is assumed)."""
    return F.transform(F.sequence(F.lit(1), F.size(words) - size + 1),
                       lambda i: F.xxhash64(F.slice(words, i, size)))


def _add_bits(j: int, mask):
    return lambda a, h: a + F.shiftrightunsigned(h, j).bitwiseAND(mask)


def _look_up(words: str, size: int):
    return lambda i: F.struct((i - 1).alias("pos"), F.xxhash64(F.slice(words, i, size)).alias("h"))


def _simhash(sh):
    """64-bit SimHash of an array of hashes. Two 32-bit counters share a long,
    so 32 sums count all bits; a bit is set where more than half of the hashes
    have it."""
    two = F.lit((1 << 32) + 1)
    half = F.floor(F.size(sh) / 2).cast("bigint")
    out = F.lit(0).cast("bigint")
    for j in range(32):
        n = F.aggregate(sh, F.lit(0).cast("bigint"), _add_bits(j, two))
        over = (n + (F.lit((1 << 30) - 1) - half) * two).bitwiseAND(F.lit((1 << 62) + (1 << 30)))
        out = out.bitwiseOR(F.shiftleft(F.shiftrightunsigned(over, 30), j))
    return out


def _counted(sh):
    """An array of hashes as a set: the k-th copy of a hash becomes (hash, k)."""
    s = F.array_sort(sh)
    return F.transform(s, lambda x, i: F.xxhash64(x, i + 1 - F.array_position(s, x)))


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for x in parts[1:]:
        out = out.unionAll(x)
    return out


def _items(bench: DataFrame, id_col: str, text_col: str) -> DataFrame:
    it = bench.select(F.col(id_col).alias("item_id"), _words(text_col).alias("words"))
    it = it.where(F.size("words") > 0).dropDuplicates(["item_id", "words"])
    it = it.withColumn("n", F.size("words")).withColumn("size", F.least(F.lit(SHINGLE), F.col("n")))
    return it.withColumn("sh", _shingles(F.col("words"), F.col("size")))


def _misses(m, threshold: float):
    return F.floor(m * ((1 - threshold) / (1 + threshold)) + 1e-9).cast("int")


def matches(docs: DataFrame, bench: DataFrame, threshold: float = 0.8, recall: float = 0.999,
            id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
            item_text: str = "text") -> DataFrame:
    """(row_key, doc_id, item_id, similarity, start, n_words): per document and
    item its most similar window, where that reaches the threshold. ``row_key``
    is a hash of id and text; ``n_words`` is the window's length."""
    r = radius(threshold, recall)
    items = _items(bench, item_col, item_text)
    m = F.size("sh")
    # per shingle size: how far apart a document's looked-up shingles may lie
    strides = {x["size"]: x["stride"] for x in items.groupBy("size").agg(
        F.min(F.floor(m / (_misses(m, threshold) + 1))).cast("int").alias("stride")).collect()}  # at most five rows
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    base = base.where(F.col("text").isNotNull()).withColumn("row_key", F.xxhash64("doc_id", "text"))
    if not strides:
        strides = {SHINGLE: 1}

    # 1. documents that share a looked-up shingle with items of n words
    words = base.select("row_key", _words().alias("words"))
    looked = []
    for size, stride in strides.items():
        enough = words.where(F.size("words") >= size)
        at = F.sequence(F.lit(1), F.size("words") - size + 1, F.lit(max(1, stride)))
        looked.append(enough.select("row_key", F.size("words").alias("len"),
                                    F.explode(F.transform(at, _look_up("words", size))).alias("s")))
    keys = items.select("n", F.size("sh").alias("m"), F.explode("sh").alias("h")).distinct()
    if keys.count() <= BROADCAST_KEYS:
        keys = F.broadcast(keys)
    held = F.col("len") - F.least(F.lit(SHINGLE), F.col("n")) + 1    # shingles of the whole document
    met = _union(looked).select("row_key", "len", "s.h").join(keys, "h").where(held >= threshold * F.col("m") - 1e-9)
    met = met.groupBy("row_key").agg(F.collect_set("n").alias("ns"))
    met = written(base.join(met, "row_key").dropDuplicates(["row_key"]).select(
        "row_key", "doc_id", _words().alias("words"), "ns"), "decontaminate")

    # all their shingles that are such items', and the windows that hold enough of them
    looked = [met.where(F.size("words") >= size).select(
        "row_key", "ns", F.size("words").alias("len"),
        F.explode(F.transform(F.sequence(F.lit(1), F.size("words") - size + 1), _look_up("words", size))).alias("s"))
        for size in strides]
    shared = _union(looked).select("row_key", "ns", "len", "s.pos", "s.h").join(keys, "h").where(F.array_contains("ns", F.col("n")))
    shared = shared.groupBy("row_key", "len", "n", "m").agg(F.array_sort(F.collect_set("pos")).alias("at"))
    shared = shared.withColumn("held", held).withColumn("w", F.least(F.col("m"), F.col("held")))
    need = F.ceil(threshold * (F.col("w") + F.col("m")) / (1 + threshold) - 1e-9).cast("int")
    shared = shared.withColumn("need", F.greatest(F.lit(1), need)).where(F.size("at") >= F.col("need"))
    # each run of ``need`` such places, and the starts of windows that hold it
    runs = F.transform(F.sequence(F.col("need"), F.size("at")), lambda j: F.struct(
        F.greatest(F.lit(0), F.element_at("at", j) - F.col("w") + 1).alias("first"),
        F.least(F.element_at("at", j - F.col("need") + 1), F.col("held") - F.col("w")).alias("last")))
    starts = F.transform(F.filter(runs, lambda x: x["first"] <= x["last"]), lambda x: F.sequence(x["first"], x["last"]))
    starts = shared.select("row_key", "n", F.array_distinct(F.flatten(starts)).alias("starts"))
    windows = (met.join(starts, "row_key")
               .select("row_key", "doc_id", "words", "n", F.explode("starts").alias("start"))
               .select("row_key", "doc_id", "n", "start", F.slice("words", F.col("start") + 1, F.col("n")).alias("win"))
               .withColumn("content", F.md5(F.concat_ws(" ", "win"))))

    # 2. distinct windows, fingerprints, Hamming blocks
    own = windows.groupBy("n", "content").agg(F.any_value("win").alias("win"))
    own = own.withColumn("sh", _shingles(F.col("win"), F.least(F.lit(SHINGLE), F.col("n")))).drop("win")
    own = own.withColumn("print", _simhash(F.col("sh"))).withColumn("set", _counted(F.col("sh"))).drop("sh")
    theirs = items.select("item_id", "n", _simhash(F.col("sh")).alias("item_print"), _counted(F.col("sh")).alias("item_set"))
    near = [v for v in range(1 << BITS) if v.bit_count() <= r // BLOCKS]
    numbers = F.array(*[F.lit(b) for b in range(BLOCKS)])

    def block(print_col, b):
        return F.expr(f"int(shiftrightunsigned({print_col}, {b} * {BITS}) & {(1 << BITS) - 1})")

    left = own.select("n", "content", "print", "set", F.explode(numbers).alias("block"))
    left = left.withColumn("value", block("print", "block"))
    right = theirs.select("item_id", "n", "item_print", "item_set", F.explode(numbers).alias("block"))
    right = right.withColumn("own", block("item_print", "block")).withColumn(
        "mask", F.explode(F.array(*[F.lit(v) for v in near])))
    right = right.withColumn("value", F.col("own").bitwiseXOR(F.col("mask")))
    # a pair is taken in the first block that brings it together, so it comes once
    pairs = left.join(right, ["n", "block", "value"])
    diff = F.col("print").bitwiseXOR(F.col("item_print"))
    hit_blocks = F.filter(numbers, lambda b: F.bit_count(
        F.call_function("shiftrightunsigned", diff, b * BITS).bitwiseAND(F.lit((1 << BITS) - 1))) <= r // BLOCKS)
    pairs = pairs.where((F.bit_count(diff) <= r) & (F.element_at(hit_blocks, 1) == F.col("block")))

    # 3. exact similarity
    both = F.size(F.array_intersect("set", "item_set"))
    sim = both / (F.size("set") + F.size("item_set") - both)
    verified = pairs.select("n", "content", "item_id", sim.alias("similarity")).where(F.col("similarity") >= threshold - 1e-12)
    found = windows.select("row_key", "doc_id", "n", "start", "content", F.size("win").alias("n_words")).join(verified, ["n", "content"])
    best = F.max_by(F.struct("similarity", "start", "n_words"), F.struct("similarity", -F.col("start"))).alias("b")
    return found.groupBy("row_key", "doc_id", "item_id").agg(best).select(
        "row_key", "doc_id", "item_id", F.col("b.similarity").alias("similarity"), F.col("b.start").alias("start"),
        F.col("b.n_words").alias("n_words"))


def clean(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` in which no item is found, all columns kept."""
    bad = matches(docs, bench, id_col=id_col, text_col=text_col, **options).select(F.col("row_key").alias("_bad")).distinct()
    key = F.xxhash64(F.col(id_col), F.col(text_col).cast("string"))
    return docs.join(bad, key == F.col("_bad"), "left_anti")
