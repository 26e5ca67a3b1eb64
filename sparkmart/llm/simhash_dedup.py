"""SimHash near-duplicates by the generalised pigeonhole principle (operator 12).

A text's words (ASCII lower case) give three-word shingles, repeats included; a
bit of its 64-bit fingerprint is 1 where more than half of the shingles' XXH64
(seed 42) have it. Fingerprints that differ in at most ``radius`` bits are
linked, and a component of links is one class of near-duplicates.

1. Documents of one fingerprint are one node, so copies never meet in pairs.
2. ``layout``: bits that correlate go into one partition, as their values
   repeat most and so are worth one threshold between them. Partition i gets a
   threshold T[i] >= -1 with sum(T) = radius - parts + 1: of two fingerprints
   within the radius some partition differs by at most T[i] bits, whichever
   layout is taken. Dynamic programming picks the thresholds, and the number of
   partitions with them, that cost the fewest candidates and probes, estimated on a
   bounded sample of fingerprints (``SAMPLE``); only the cost depends on it.
3. Every node is stored under its value of every partition with T[i] >= 0 and
   probes the values within T[i] bits (of two nodes the one whose lowest
   differing bit is 0 probes).
4. In each cell, nodes within the radius of its most copied node are tied to it
   (one row a node); the components of these ties get a label. Cells with
   more than one label are then verified between different labels, in blocks of
   ``BLOCK`` rows; a block pair returns ties of labels, never a row per pair.
   A dense group of near copies thus costs its first step and no more.
5. Components of labels are the classes; ids come back by fingerprint, those of
   fingerprints with more than a thousandth of all rows (at most 1000) by broadcast.

Cases: a text of one or two words is one shingle; null, empty and blank texts
have fingerprint 0, linked like any other; rows given twice are listed twice; rows
without doc_id take part and name no component (a component of such rows only
has a null id); other columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.llm.common import id_text, map_arrow, written
from sparkmart.llm.components import components

N, RADIUS, SEED = 3, 3, 42
SAMPLE, BLOCK = 2048, 2048
ROW_COST = 20                 # a shuffled probe costs about as much as so many verified candidates
MOST_PROBES = 600             # values that a node may probe in a partition; thresholds that need more are not taken
_LOWER = bytes(c + 0x20 if 0x41 <= c <= 0x5A else c for c in range(256))


def fingerprint(text: str | None, n: int = N, chunk: int = 1 << 15) -> int:
    """The fingerprint of a whole text, unsigned."""
    words = (text or "").encode().translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    last = ends[n - 1:] if len(words) >= n else ends[-1:]
    digest, total, ones = xxhash.xxh64_intdigest, len(last), np.zeros(64, np.int64)
    for at in range(0, total, chunk):
        span = zip(starts[at:min(at + chunk, total)].tolist(), last[at:at + chunk].tolist())
        h = np.array([digest(joined[a:b], SEED) for a, b in span], "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(sum(1 << i for i in np.flatnonzero(2 * ones > total).tolist()))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp) of every row; ``fp`` is the fingerprint as a signed bigint."""
    def run(cols):
        return {"doc_id": cols["doc_id"], "fp": [_signed(fingerprint(t)) for t in cols["text"]]}

    return map_arrow(docs, run, "doc_id bigint, fp bigint")


def bit_groups(sample: np.ndarray, parts: int) -> list[list[int]]:
    """The 64 bits in ``parts`` groups of almost equal width; a group starts with
    the bit that correlates most with all that are left, and takes its nearest."""
    bits = (sample[:, None] >> np.arange(64, dtype=np.uint64) & np.uint64(1)).astype(np.float64)
    bits -= bits.mean(0) if len(bits) else 0
    norm = np.sqrt((bits * bits).sum(0))
    bits /= np.where(norm > 0, norm, 1)
    near = np.abs(bits.T @ bits)
    left, out = list(range(64)), []
    for p in range(parts):
        width = len(left) // (parts - p)
        group = [max(left, key=lambda b: (near[b, left].sum(), -b))]
        left.remove(group[0])
        while len(group) < width:
            nxt = max(left, key=lambda b: (near[b, group].sum(), -b))
            group.append(nxt)
            left.remove(nxt)
        out.append(sorted(group))
    return out


def allocate(costs: list[list[float]], total: int) -> tuple[float, list[int]]:
    """Thresholds of least summed cost; ``costs[i][t + 1]`` is what threshold t
    (-1 and up) costs in partition i, and the thresholds sum to ``total``."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for row in costs:
        step: dict[int, tuple[float, list[int]]] = {}
        for so_far, (cost, chosen) in best.items():
            for t, c in enumerate(row, -1):
                if so_far + t not in step or cost + c < step[so_far + t][0]:
                    step[so_far + t] = (cost + c, [*chosen, t])
        best = step
    return best[total]


def layout(sample: np.ndarray, n: int, radius: int = RADIUS) -> list[tuple[list[int], int]]:
    """(bits, threshold) of every partition, for ``n`` fingerprints like the sample."""
    n = max(n, 1000)
    i, j = np.triu_indices(len(sample), 1)
    apart = sample[i] ^ sample[j]
    best = None
    for parts in range(1, radius + 3):
        groups, costs = bit_groups(sample, parts), []
        for g in groups:
            d = np.bitwise_count(apart & np.uint64(sum(1 << b for b in g)))
            row = [0.0]
            for t in range(min(radius, len(g)) + 1):
                probes = sum(comb(len(g), x) for x in range(t + 1))
                share = max(float((d <= t).mean()) if len(d) else 0.0, probes / 2.0 ** len(g))
                cost = n * (n - 1) / 2 * share + ROW_COST * n * (1 + (probes - 1) / 2)
                row.append(cost if probes <= MOST_PROBES else float("inf"))
            costs.append(row)
        cost, chosen = allocate(costs, radius - parts + 1)
        if best is None or cost < best[0]:
            best = (cost, list(zip(groups, chosen)))
    return best[1]


def cells(nodes: DataFrame, parts: list[tuple[list[int], int]]) -> DataFrame:
    """(part, cell, probe, fp): every node under its own value and, as a probe,
    under the values at 1 to T bits whose lowest changed bit is 0 in the node."""
    flips = []
    for p, (bits, most) in enumerate(parts):
        mask = _signed(sum(1 << b for b in bits))
        flips += [(p, mask, 0, 0)] if most >= 0 else []
        for d in range(1, most + 1):
            flips += [(p, mask, _signed(sum(1 << b for b in c)), _signed(1 << min(c))) for c in combinations(bits, d)]
    one = F.explode(F.array(*[F.struct(F.lit(p).alias("part"), F.lit(m).cast("bigint").alias("mask"),
                                       F.lit(x).cast("bigint").alias("flip"), F.lit(low).cast("bigint").alias("low"))
                              for p, m, x, low in flips]))
    rows = nodes.select("fp", "copies", one.alias("f")).where(F.col("fp").bitwiseAND(F.col("f.low")) == 0)
    return rows.select(F.col("f.part").alias("part"), F.col("fp").bitwiseAND(F.col("f.mask")).bitwiseXOR(F.col("f.flip")).alias("cell"),
                       (F.col("f.flip") != 0).alias("probe"), "fp", "copies")


def _apart(a: str, b: str):
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def _with_cell(rows: DataFrame, facts: DataFrame, often: int) -> DataFrame:
    """Rows joined to their cell's facts; cells of more than ``often`` rows (a
    thousandth of all, so a thousand cells) come by broadcast and are not shuffled."""
    hot, cold = facts.where(F.col("n") > often), facts.where(F.col("n") <= often)
    keys = ["part", "cell"]
    return rows.join(F.broadcast(hot), keys).unionAll(
        rows.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(cold, keys))


def _block_links(stream: DataFrame, radius: int) -> DataFrame:
    """Ties (a, b) of labels from rows (part, cell, i, j, side, probe, fp, label)
    of one block pair each that lie together."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows, out = None, [], []
        for batch in batches:
            for part, cell, i, j, side, probe, fp, label in zip(*(c.to_pylist() for c in batch.columns)):
                if (part, cell, i, j) != key:
                    out += _ties(key, rows, radius)
                    key, rows = (part, cell, i, j), []
                rows.append((side, probe, fp, label))
            if len(out) > 20_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], schema=schema)
                out = []
        out += _ties(key, rows, radius)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], schema=schema)

    return stream.mapInArrow(run, "a bigint, b bigint")


def _ties(key, rows: list, radius: int) -> list[tuple[int, int]]:
    """Each label of a block pair with the least label that it is tied to."""
    if len(rows) < 2:
        return []
    side, probe, fp, label = (np.array(c) for c in zip(*rows))
    fp = fp.astype(np.int64).view(np.uint64)
    names, at = np.unique(label, return_inverse=True)
    if len(names) < 2:
        return []
    left, right = (np.flatnonzero(side == s) if key[2] != key[3] else np.arange(len(rows)) for s in (0, 1))
    if not len(left) or not len(right):
        return []
    near = np.bitwise_count(fp[left][:, None] ^ fp[right][None, :]) <= radius
    near &= (at[left][:, None] != at[right][None, :]) & ~(probe[left][:, None] & probe[right][None, :])
    x, y = np.nonzero(near)
    x, y = at[left[x]], at[right[y]]
    root, moved = np.arange(len(names)), True
    while moved:
        low = np.minimum(root[x], root[y])
        step = root.copy()
        np.minimum.at(step, x, low)
        np.minimum.at(step, y, low)
        step = step[step]
        moved = bool((step != root).any())
        root = step
    return [(int(names[i]), int(names[r])) for i, r in enumerate(root.tolist()) if i != r]


def classes(nodes: DataFrame, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """(fp, root) of every node that is linked to another (``nodes``: distinct
    fp, copies); ``root`` is common to a component."""
    n = nodes.count()
    picked = nodes.select("fp").orderBy(F.xxhash64("fp"), "fp").limit(SAMPLE).collect()       # SAMPLE rows at most
    parts = layout(np.array([r["fp"] for r in picked], np.int64).view(np.uint64), n, radius)
    rows = written(cells(nodes, parts), "cells")
    heads = rows.groupBy("part", "cell").agg(
        F.count("*").alias("n"), F.max_by("fp", F.when(~F.col("probe"), F.struct("copies", "fp"))).alias("head"))
    heads = written(heads.where((F.col("n") > 1) & F.col("head").isNotNull()), "heads")
    often = max(block, rows.count() // 1000)
    met = written(_with_cell(rows.drop("copies"), heads, often), "met")
    stars = met.where((F.col("fp") != F.col("head")) & (_apart("fp", "head") <= radius))
    first = components(stars.select(F.col("fp").alias("a"), F.col("head").alias("b")).distinct())
    named = met.join(first.withColumnRenamed("node", "fp"), "fp", "left").withColumn("label", F.coalesce("label", "fp"))
    named = written(named, "named")
    open_ = named.groupBy("part", "cell").agg(F.count("*").alias("n"), (F.min("label") != F.max("label")).alias("many"))
    again = _with_cell(named.select("part", "cell", "probe", "fp", "label"), open_.where("many").select("part", "cell", "n"), often)
    again = again.withColumn("blocks", F.ceil(F.col("n") / block).cast("int"))
    again = again.withColumn("mine", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
    again = again.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    again = again.select("part", "cell", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"),
                         (F.col("mine") > F.col("other")).cast("int").alias("side"), "probe", "fp", "label")
    keys = ["part", "cell", "i", "j"]
    ties = _block_links(again.repartition(*keys).sortWithinPartitions(*keys), radius)
    top = components(ties.distinct())
    linked = first.select(F.col("node").alias("fp"), "label").unionAll(
        top.join(first, top["node"] == first["node"], "left_anti").select(F.col("node").alias("fp"), F.col("node").alias("label")))
    up = top.select(F.col("node").alias("label"), F.col("label").alias("top"))
    return linked.join(up, "label", "left").select("fp", F.coalesce("top", "label").alias("root"))


def dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row."""
    docs = written(fingerprints(id_text(df.withColumn(id_col, F.col(id_col).cast("bigint")), id_col, text_col)), "fingerprints")
    nodes = written(docs.groupBy("fp").agg(F.min("doc_id").alias("low"), F.count("*").alias("copies")), "nodes")
    rooted = nodes.join(classes(nodes.select("fp", "copies"), radius, block), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    rooted = written(rooted, "rooted")
    least = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    often = max(1000, docs.count() // 1000)
    known = written(rooted.join(least, "root").select("fp", "copies", "component_id"), "classes")
    hot = F.broadcast(known.where(F.col("copies") > often).drop("copies"))                 # a thousand rows at most
    cold = known.where(F.col("copies") <= often).drop("copies")
    out = docs.join(hot, "fp").unionAll(docs.join(hot.select("fp"), "fp", "left_anti").join(cold, "fp"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
