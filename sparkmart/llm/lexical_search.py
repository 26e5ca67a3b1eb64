"""Ranked lexical search by pair-bound MaxScore (operator 13).

All documents are ranked for every item of a query table. A document's score
for an item is the sum, over the item's terms with repeats, of
``w * ((10**9 * tf) div (1000 * tf + 12 * m))`` with the term's weight
``w = floor(1000 * ln((2N + 2) / (2df + 1)))`` and the document's length norm
``m = 75 + (25 * n * N) div L``; everything but the logarithm is integer.

1. ``postings``: every task turns its texts into segments of about ``SEGMENT``
   bytes: postings (document, tf) of the terms that some item asks for, and the
   documents' lengths. N, L and df are sums over the segments of all documents.
2. ``paired``: with these known, the intersection lists of the term pairs of the
   items (an item's terms in order of weight, taken two by two) are precomputed
   per segment with their joint maximum impact, and stored with the postings.
3. ``searched``: MaxScore over the segments. A pair cannot add more than the
   larger of its joint maximum and either term's own maximum, which is less
   than the sum of the two maxima wherever no document has both at their best.
   The bounds of an item's pairs are combined; the pairs of least bound whose sum
   stays under the k-th best score so far are not traversed, only looked up for
   documents that the others have brought into reach, and a document is left as
   soon as the bounds of what is not yet looked up cannot lift it. The first
   threshold comes from the k-th best joint impact of an intersection list.

Every task keeps the k best per item; a last rank joins the tasks' lists.
Items are a stated query set: they are searched in blocks of about
``BLOCK_BYTES`` of text, so what is broadcast has a bound.

Cases: null and empty texts have no term; an item without terms, or whose terms
occur nowhere, has no row; rows of ``documents`` given twice are two documents;
items given twice with one id and text count once; rows without doc_id take no
part; equal scores rank by ascending doc_id; other columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkmart.llm.common import grouped, written

SEGMENT = 8 << 20
BLOCK_BYTES = 4 << 20
K = 20
# ASCII letters to lower case; digits and bytes of other characters as they are; the rest separates terms
_FOLD = bytes(c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else c + 0x20 if 0x41 <= c <= 0x5A else 0x20
              for c in range(256))


def terms(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_FOLD).split()


@dataclass
class Item:
    """A query: its key and its distinct terms with their repeats; ``units`` are
    pairs of terms in descending order of weight (the last may stand alone)."""
    key: int
    counts: dict[int, int]
    units: list[tuple[int, ...]] = field(default_factory=list)


_POSTINGS = "docs array<bigint>, lengths array<bigint>, terms array<int>, starts array<int>, places array<int>, tf array<int>"


def postings(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """Segments of (doc_id, text) rows: the documents that hold a term of
    ``vocabulary``, their lengths, and per term its (place in docs, tf) list;
    ``n_docs`` and ``n_terms`` count all of the segment's documents."""
    known = docs.sparkSession.sparkContext.broadcast(vocabulary)
    i32, i64 = pa.list_(pa.int32()), pa.list_(pa.int64())
    schema = pa.schema([("docs", i64), ("lengths", i64), ("terms", i32), ("starts", i32), ("places", i32), ("tf", i32),
                        ("n_docs", pa.int64()), ("n_terms", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = known.value.get
        for batch in grouped(batches, SEGMENT):
            ids, lengths, keys, n_docs, n_terms = [], [], [], 0, 0
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = terms(text.as_py())
                n_docs += bool(found)
                n_terms += len(found)
                hit = [t for t in map(get, found) if t is not None]
                if hit:
                    keys.append(np.array(hit, np.int64) << 32 | len(ids))
                    ids.append(doc_id)
                    lengths.append(len(found))
            key, tf = np.unique(np.concatenate(keys), return_counts=True) if keys else (np.zeros(0, np.int64),) * 2
            named, starts = np.unique(key >> 32, return_index=True)
            cols = [ids, lengths, named, np.append(starts, len(key)), key & 0xFFFFFFFF, tf]
            yield pa.RecordBatch.from_arrays([pa.array([c], type=f.type) for c, f in zip([*cols, n_docs, n_terms], schema)],
                                             schema=schema)

    return docs.select("doc_id", "text").mapInArrow(run, _POSTINGS + ", n_docs bigint, n_terms bigint")


class Segment:
    """Impacts of a segment's postings and, once built or read, its pair lists."""

    def __init__(self, cols: dict, weights: np.ndarray, n: int, total: int):
        self.docs = np.asarray(cols["docs"], np.int64)
        norm = 75 + (25 * np.asarray(cols["lengths"], np.int64) * n) // max(total, 1)
        named, starts = np.asarray(cols["terms"], np.int64), np.asarray(cols["starts"], np.int64)
        places, tf = np.asarray(cols["places"], np.int64), np.asarray(cols["tf"], np.int64)
        impact = np.repeat(weights[named], np.diff(starts)) * ((10 ** 9 * tf) // (1000 * tf + 12 * norm[places]))
        top = np.maximum.reduceat(impact, starts[:-1]) if len(named) else impact
        self.lists = {t: (places[a:b], impact[a:b]) for t, a, b in zip(named.tolist(), starts.tolist(), starts[1:].tolist())}
        self.top = dict(zip(named.tolist(), top.tolist()))
        self.pairs: dict[tuple[int, int], tuple[int, np.ndarray]] = {}

    def intersect(self, a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
        """Places that hold both terms, and the sums of their impacts."""
        if a not in self.lists or b not in self.lists:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        (pa_, ia), (pb, ib) = sorted((self.lists[a], self.lists[b]), key=lambda x: len(x[0]))
        at = np.minimum(np.searchsorted(pb, pa_), len(pb) - 1)
        both = pb[at] == pa_
        return pa_[both], ia[both] + ib[at[both]]

    def joint(self, pair: tuple[int, int]) -> np.ndarray:
        """Joint impacts over a pair's stored intersection list."""
        out = np.zeros(len(self.pairs[pair][1]), np.int64) if pair in self.pairs else np.zeros(0, np.int64)
        for t in pair if len(out) else ():
            p, imp = self.lists[t]
            out += imp[np.searchsorted(p, self.pairs[pair][1])]
        return out

    def bound(self, unit: tuple[int, ...], counts: dict[int, int], pairs: bool = True) -> int:
        """The most that a document can gain from a unit's terms."""
        single = [counts[t] * self.top.get(t, 0) for t in unit]
        if len(unit) == 1 or not pairs:
            return sum(single)
        if unit not in self.pairs:
            return max(single)
        a, b = unit
        least = min(counts[a], counts[b])
        return max(*single, least * self.pairs[unit][0] + (counts[a] - least) * self.top[a] + (counts[b] - least) * self.top[b])

    def start(self, item: Item, k: int) -> int:
        """A score that k documents of the segment reach at least: the k-th best
        joint impact of a pair list, or the k-th best impact of a term."""
        best = 0
        for unit in item.units:
            for gain in [self.joint(unit)] if len(unit) == 2 else []:
                if len(gain) >= k:
                    best = max(best, int(np.partition(gain, -k)[-k]))
            for t in unit:
                if t in self.lists and len(self.lists[t][1]) >= k:
                    best = max(best, item.counts[t] * int(np.partition(self.lists[t][1], -k)[-k]))
        return best

    def search(self, item: Item, least: int, touched: list | None = None, pairs: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """(doc ids, scores) of all documents whose score is positive and
        ``least`` at least. ``touched`` collects how many postings were read."""
        bounds = [(self.bound(u, item.counts, pairs), u) for u in item.units]
        bounds = sorted((b for b in bounds if b[0]), key=lambda b: b[0])
        rest, skip = 0, 0
        while skip < len(bounds) and rest + bounds[skip][0] < least:
            rest += bounds[skip][0]
            skip += 1
        score = np.zeros(len(self.docs), np.int64)
        read = 0
        for _, unit in bounds[skip:]:
            for t in unit:
                if t in self.lists:
                    p, imp = self.lists[t]
                    score[p] += item.counts[t] * imp
                    read += len(p)
        near = np.flatnonzero((score > 0) & (score + rest >= least))
        for most, unit in reversed(bounds[:skip]):
            rest -= most
            for t in unit:
                if t in self.lists and len(near):
                    p, imp = self.lists[t]
                    at = np.minimum(np.searchsorted(p, near), len(p) - 1)
                    hit = p[at] == near
                    score[near[hit]] += item.counts[t] * imp[at[hit]]
                    read += len(near)
            near = near[score[near] + rest >= least]
        if touched is not None:
            touched.append(read)
        return self.docs[near], score[near]


def paired(index: DataFrame, pairs: list[tuple[int, int]], weights: np.ndarray, n: int, total: int) -> DataFrame:
    """The segments with the intersection lists of ``pairs`` and their joint maxima."""
    shared = index.sparkSession.sparkContext.broadcast((pairs, weights))
    names = [f.split()[0] for f in _POSTINGS.split(", ")]
    i32, i64 = pa.list_(pa.int32()), pa.list_(pa.int64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, w = shared.value
        for batch in batches:
            for at in range(batch.num_rows):
                one = batch.slice(at, 1)
                seg = Segment({c: one.column(c)[0].values.to_numpy() for c in names}, w, n, total)
                which, most, places = [], [], []
                for i, pair in enumerate(asked):
                    both, gain = seg.intersect(*pair)
                    if len(both):
                        which.append(i)
                        most.append(int(gain.max()))
                        places.append(both)
                starts = np.cumsum([0, *map(len, places)])
                yield pa.RecordBatch.from_arrays(
                    [*[one.column(c) for c in names], pa.array([which], i32), pa.array([most], i64), pa.array([starts], i32),
                     pa.array([np.concatenate(places) if places else []], i32)],
                    names=[*names, "pairs", "joint_max", "pair_starts", "pair_places"])

    return index.select(*names).mapInArrow(
        run, _POSTINGS + ", pairs array<int>, joint_max array<bigint>, pair_starts array<int>, pair_places array<int>")


def searched(index: DataFrame, items: list[Item], pairs: list[tuple[int, int]], weights: np.ndarray, n: int, total: int,
             k: int) -> DataFrame:
    """(item, doc_id, score): the k best of every task for every item."""
    shared = index.sparkSession.sparkContext.broadcast((items, pairs, weights))
    schema = pa.schema([("item", pa.int32()), ("doc_id", pa.int64()), ("score", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, listed, w = shared.value
        best = {q.key: (np.zeros(0, np.int64), np.zeros(0, np.int64)) for q in asked}
        for batch in batches:
            for at in range(batch.num_rows):
                cols = {c: batch.column(c)[at].values.to_numpy() for c in batch.schema.names}
                seg = Segment(cols, w, n, total)
                lists = np.split(cols["pair_places"].astype(np.int64), cols["pair_starts"][1:-1])
                for i, most, places in zip(cols["pairs"].tolist(), cols["joint_max"].tolist(), lists):
                    seg.pairs[listed[i]] = (most, places)
                for q in asked:
                    ids, scores = best[q.key]
                    least = int(scores[-1]) if len(ids) == k else seg.start(q, k)
                    found, gained = seg.search(q, least)
                    if len(found):
                        ids, scores = np.append(ids, found), np.append(scores, gained)
                        order = np.lexsort((ids, -scores))[:k]
                        best[q.key] = ids[order], scores[order]
        out = [(key, i, s) for key, (ids, scores) in best.items() for i, s in zip(ids.tolist(), scores.tolist())]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    return index.mapInArrow(run, "item int, doc_id bigint, score bigint")


def search(docs: DataFrame, items: DataFrame, k: int = K, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents of every item."""
    spark = docs.sparkSession
    d = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    d = d.where(F.col("doc_id").isNotNull())
    asked = items.select(F.col(item_col).alias("item_id"), F.col(item_text_col).cast("string").alias("text")).where(
        F.col("text").isNotNull()).distinct()
    size = asked.agg(F.sum(F.octet_length("text")).alias("size")).first()["size"] or 0
    blocks = max(1, -(-size // block_bytes))
    kind = asked.schema["item_id"].dataType.simpleString()
    parts = []
    for b in range(blocks):
        mine = asked.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).orderBy("item_id", "text").collect()
        vocabulary: dict[bytes, int] = {}
        for r in mine:
            for t in terms(r["text"]):
                vocabulary.setdefault(t, len(vocabulary))
        if not vocabulary:
            continue
        index = written(postings(d, vocabulary), "postings")
        facts = index.agg(F.sum("n_docs").alias("n"), F.sum("n_terms").alias("total")).first()
        n, total = facts["n"] or 0, facts["total"] or 0
        held = index.select(F.explode(F.arrays_zip(
            "terms", F.transform("terms", lambda t, i: F.col("starts")[i + 1] - F.col("starts")[i]).alias("df"))).alias("x"))
        df = {r["t"]: r["df"] for r in held.groupBy(F.col("x.terms").alias("t")).agg(F.sum("x.df").alias("df")).collect()}
        weights = np.zeros(len(vocabulary), np.int64)      # one row per term of the block's items
        for t, f in df.items():
            weights[t] = math.floor(1000 * math.log((2 * n + 2) / (2 * f + 1)))
        queries = [_item(i, r["text"], vocabulary, weights) for i, r in enumerate(mine)]
        pairs = sorted({u for q in queries for u in q.units if len(u) == 2})
        ready = written(paired(index, pairs, weights, n, total), "paired")
        found = searched(ready, queries, pairs, weights, n, total, k)
        w = Window.partitionBy("item").orderBy(F.desc("score"), "doc_id")
        found = found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
        names = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(mine)], f"item int, item_id {kind}")
        parts.append(found.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"))
    if not parts:
        return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id bigint, score bigint")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionAll(p)
    return out


def _item(key: int, text: str, vocabulary: dict[bytes, int], weights: np.ndarray) -> Item:
    counts = Counter(vocabulary[t] for t in terms(text))
    order = sorted((t for t in counts if weights[t]), key=lambda t: (-weights[t], t))
    return Item(key, dict(counts), [tuple(order[i:i + 2]) for i in range(0, len(order), 2)])
