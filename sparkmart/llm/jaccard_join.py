"""N-gram Jaccard join by MinHash banding (operator 2).

Documents are sets of five-word n-grams (fewer words: the whole text is one
n-gram). All pairs of documents whose sets have a Jaccard similarity of
``threshold`` or more are linked; a class is a connected component of links.

1. Documents with equal sets are one text (a node), so copies never form pairs.
2. MinHash signatures in ``bands`` bands of ``rows``, chosen so that a pair at
   the threshold shares a band with probability ``recall`` at least. Rows are
   shuffled on band hashes; within a band bucket each node is tied to the
   bucket's least node (a star, not all pairs). Two nodes of one bucket are
   then in one component of these ties.
3. Each component's full n-gram sets are verified against each other inside
   tasks, in square blocks of ``block`` nodes: a component of m nodes is
   (m / block)**2 / 2 tasks' work, spread over the cluster; what leaves a task is
   one row per node (its number of links and the least node it is tied to),
   never a row per pair.
4. Components of the verified links are the classes.

Cases: texts without words (null, empty, white space) have the empty set and
are copies of each other; rows repeated under one id with one text are one
document, listed as often as given; ties take the least id; extra columns are
not read; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.llm.common import gram_hashes, map_arrow, mix64, slices, word_hashes, written
from sparkmart.llm.components import components

N = 5
BLOCK = 256


def banding(threshold: float = 0.8, recall: float = 0.999, most: int = 200) -> tuple[int, int]:
    """(bands, rows): the most selective layout (largest rows) with at most
    ``most`` hashes whose probability to catch a pair at the threshold is
    ``recall`` or more."""
    best = (1, 1)
    for rows in range(1, 20):
        p, bands = threshold ** rows, 1
        while 1 - (1 - p) ** bands < recall:
            bands += 1
        if bands * rows <= most:
            best = (bands, rows)
    return best


def gram_sets(texts: list[str | None], n: int = N) -> Iterator[np.ndarray]:
    """Sorted distinct n-gram hashes of each text."""
    h, counts = word_hashes([(t or "").encode() for t in texts])
    at = 0
    for k in counts.tolist():
        w = h[at:at + k]
        at += k
        yield np.unique(gram_hashes(w, min(n, k))) if k else np.zeros(0, np.uint64)


def signatures(sets: list[np.ndarray], bands: int, rows: int) -> np.ndarray:
    """Band hashes (sets, bands) of non-empty sets."""
    rng = np.random.default_rng(20_11)
    mul = rng.integers(1 << 62, size=bands * rows).astype(np.uint64) * np.uint64(2) + np.uint64(1)
    xor = rng.integers(1 << 62, size=bands * rows).astype(np.uint64)
    flat = np.concatenate(sets)
    at = np.cumsum([0, *(len(s) for s in sets[:-1])])
    out = np.zeros((len(sets), bands), np.uint64)
    for b in range(bands):
        acc = np.full(len(sets), b, np.uint64)
        for r in range(b * rows, (b + 1) * rows):
            v = (flat ^ xor[r]) * mul[r]
            v ^= v >> np.uint64(32)
            acc = mix64(acc ^ np.minimum.reduceat(v * mul[r], at))
        out[:, b] = acc
    return out


def _signed(docs: DataFrame, n: int, bands: int, rows: int) -> DataFrame:
    def run(cols):
        sets = list(gram_sets(cols["text"], n))
        full = [i for i, s in enumerate(sets) if len(s)]
        got: list = [[] for _ in sets]
        at = 0
        while at < len(full):
            to, size = at, 0
            while to < len(full) and (to == at or size < 200_000):
                size += len(sets[full[to]])
                to += 1
            for i, s in zip(full[at:to], signatures([sets[i] for i in full[at:to]], bands, rows).view(np.int64).tolist()):
                got[i] = s
            at = to
        return {"row_key": cols["row_key"], "doc_id": cols["doc_id"],
                "set_id": [hashlib.md5(s.tobytes()).digest() for s in sets], "bands": got}

    return map_arrow(docs.select("row_key", "doc_id", "text"), run,
                     "row_key bigint, doc_id bigint, set_id binary, bands array<bigint>", max_bytes=2 << 20)


def _verify(members: DataFrame, threshold: float) -> DataFrame:
    """(node, links, copies, root) per node and block pair, from rows (comp, i,
    j, node, side, n_copies, grams) that lie together and in order."""
    schema = pa.schema([("node", pa.int64()), ("texts", pa.int64()), ("docs", pa.int64()), ("root", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows, out = None, [], []
        for batch in batches:
            for part in slices(batch, 16 << 20):
                cols = [part.column(i).to_pylist() for i in range(part.num_columns)]
                for comp, i, j, node, side, copies, grams in zip(*cols):
                    if (comp, i, j) != key:
                        out += compare(key, rows, threshold)
                        key, rows = (comp, i, j), []
                    rows.append((node, side, copies, np.frombuffer(grams, np.uint64)))
                if len(out) > 20_000:
                    yield _batch(out, schema)
                    out = []
        out += compare(key, rows, threshold)
        if out:
            yield _batch(out, schema)

    return members.mapInArrow(run, "node bigint, texts bigint, docs bigint, root bigint")


def _batch(rows, schema):
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def shared_counts(sets: list[np.ndarray], width: int = 4096) -> np.ndarray:
    """Sizes of all pairwise intersections: products of 0/1 matrices, a range
    of n-grams at a time; n-grams of a single set are left out first."""
    flat = np.concatenate(sets)
    of = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order = np.argsort(flat, kind="stable")
    flat, of = flat[order], of[order]
    new = np.concatenate([[True], flat[1:] != flat[:-1]])
    gram = np.cumsum(new) - 1
    often = np.bincount(gram) > 1
    keep = often[gram]
    rank = np.cumsum(often) - 1
    gram, of = rank[gram[keep]], of[keep]
    out = np.zeros((len(sets), len(sets)), np.float64)
    for at in range(0, int(often.sum()), width):
        lo, hi = np.searchsorted(gram, [at, at + width])
        m = np.zeros((len(sets), width), np.float32)
        m[of[lo:hi], gram[lo:hi] - at] = 1
        out += m @ m.T
    return out


def compare(key, rows: list, threshold: float) -> list[tuple]:
    """Links among the nodes of one block, or between the two sides of a block pair."""
    if not rows:
        return []
    size = np.array([len(r[3]) for r in rows])
    if len(rows) == 2:
        both = np.zeros((2, 2))
        both[0, 1] = both[1, 0] = len(np.intersect1d(rows[0][3], rows[1][3], assume_unique=True))
    else:
        both = shared_counts([r[3] for r in rows])
    linked = both >= threshold * (size[:, None] + size[None, :] - both) - 1e-9
    np.fill_diagonal(linked, False)
    if key[1] != key[2]:  # nodes of one side meet in their own block
        side = np.array([r[1] for r in rows])
        linked &= side[:, None] != side[None, :]
    copies = np.array([r[2] for r in rows])
    node = np.array([r[0] for r in rows])
    root = node.copy()
    while True:  # least node reachable within the block
        low = np.where(linked, root[None, :], np.iinfo(np.int64).max).min(1)
        new = np.minimum(root, low)
        if (new == root).all():
            break
        root = new
    return list(zip(node.tolist(), linked.sum(1).tolist(), (linked * copies[None, :]).sum(1).tolist(), root.tolist()))


def join(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.8, n: int = N,
         recall: float = 0.999, block: int = BLOCK) -> DataFrame:
    """(doc_id, class_id, n_links, n_text_links, n_copies, row_key) per row:
    ``class_id`` is the least id of the class, ``n_links`` the number of other
    documents linked (copies included), ``n_text_links`` the number of other
    n-gram sets linked, ``n_copies`` the number of documents with this set."""
    bands, rows = banding(threshold, recall)
    docs = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    docs = docs.withColumn("row_key", F.xxhash64("doc_id", "text"))
    signed = written(_signed(docs, n, bands, rows), "signed")
    one = signed.groupBy("row_key").agg(F.any_value("doc_id").alias("doc_id"), F.any_value("set_id").alias("set_id"),
                                        F.any_value("bands").alias("bands"))
    # 1. a node per set
    nodes = written(one.groupBy("set_id").agg(F.min("row_key").alias("node"), F.count("*").alias("n_copies"),
                                              F.min("doc_id").alias("least_id"), F.any_value("bands").alias("bands")), "nodes")
    # 2. stars within band buckets, their components
    banded = nodes.select("node", F.posexplode("bands").alias("band", "h"))
    heads = banded.groupBy("band", "h").agg(F.min("node").alias("head"), F.count("*").alias("n")).where("n > 1")
    ties = banded.join(heads, ["band", "h"]).groupBy("node").agg(F.collect_set("head").alias("heads"))  # one per band at most
    # a node is tied to the least of its heads, and so is each of its heads: the same components with few edges
    star = ties.select(F.explode(F.array_union(F.array("node"), "heads")).alias("a"), F.array_min("heads").alias("b"))
    comp = components(star).withColumnRenamed("label", "comp")
    # 3. verification in square blocks
    blocks = comp.groupBy("comp").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    placed = comp.join(blocks, "comp").join(nodes.select("node", "n_copies"), "node").withColumn(
        "mine", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    text = docs.join(placed, docs["row_key"] == placed["node"]).dropDuplicates(["node"])
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    sets = map_arrow(text.select("comp", "blocks", "mine", "node", "n_copies", "text"), lambda cols: {
        **{c: cols[c] for c in ("comp", "blocks", "mine", "node", "n_copies")},
        "grams": [s.tobytes() for s in gram_sets(cols["text"], n)]},
        "comp bigint, blocks int, mine int, node bigint, n_copies bigint, grams binary", max_bytes=4 << 20)
    members = sets.select("*", other).select(
        "comp", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "node",
        (F.col("mine") <= F.col("other")).cast("int").alias("side"), "n_copies", "grams")
    members = members.repartition("comp", "i", "j").sortWithinPartitions("comp", "i", "j")
    met = written(_verify(members, threshold), "links")
    # 4. classes of verified links; what is known of a node meets in one aggregate
    label = components(met.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b")))
    known = (nodes.select("node", "set_id", "n_copies", "least_id").unionByName(label, allowMissingColumns=True)
             .unionByName(met.select("node", "texts", "docs"), allowMissingColumns=True))
    classed = known.groupBy("node").agg(
        F.max("set_id").alias("set_id"), F.max("n_copies").alias("n_copies"), F.min("least_id").alias("least_id"),
        F.max("label").alias("label"), F.sum("texts").alias("texts"), F.sum("docs").alias("docs"))
    classed = classed.select("set_id", "n_copies", "least_id", F.coalesce("label", "node").alias("label"),
                             F.coalesce("texts", F.lit(0)).alias("n_text_links"),
                             (F.coalesce("docs", F.lit(0)) + F.col("n_copies") - 1).alias("n_links"))
    least = classed.groupBy("label").agg(F.min("least_id").alias("class_id"))
    classed = classed.join(least, "label").drop("label", "least_id")
    return signed.select("row_key", "doc_id", "set_id").join(classed, "set_id").select(
        "doc_id", "class_id", "n_links", "n_text_links", "n_copies", "row_key")


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row of ``df`` per class, all columns kept: the one of the least id,
    then of the least row key."""
    got = join(df, id_col, text_col, **options).select("class_id", "doc_id", "row_key")
    first = got.groupBy("class_id").agg(F.min(F.struct("doc_id", "row_key")).alias("f")).select(F.col("f.row_key").alias("_key"))
    keyed = df.withColumn("_key", F.xxhash64(F.col(id_col), F.col(text_col).cast("string")))
    return keyed.join(first, "_key", "left_semi").dropDuplicates(["_key"]).drop("_key")
