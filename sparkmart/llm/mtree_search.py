"""Exact top-k inner product search by an M-tree (operator 9).

Vectors are turned to integers, floor(scale * x). With one more component,
sqrt(R**2 - |x|**2) for rows (R: the largest norm) and 0 for queries, a larger
inner product is a smaller Euclidean distance, so a metric tree applies.

Root level: ``routers``, routing objects picked by a hash of the id (at most
``MAX_ROUTERS``, so their table is bounded); every row belongs to its nearest
one and stores its distance to it; a node's covering radius is its rows'
largest distance. A node is dealt into as many blocks of about ``block`` rows
as it needs, by a hash, so that a node with a third of all rows (copies, say)
is many tasks' work. Within a block rows lie in pages around routing objects of
the block, each with its covering radius and its rows' parent distances.

Search: each query visits its nearest node first, which bounds its k-th
distance, and then only nodes that the bound, the distance to their routing
object and their covering radius do not exclude. In a block, pages are taken
best first; a page's rows are skipped where |d(q, routing) - parent distance|
is over the bound; the rest get exact integer products.

Queries are a stated set, so blocks of queries meet blocks of rows; all rows
are indexed and searched, results are exact.

Cases: vectors that are null, empty or hold null or non-finite components take
no part, as query or candidate; shorter vectors are filled with zeros; rows
repeated with one id and one vector count once; ties go to the smaller id;
fewer candidates than k give fewer rows; null ids take no part. Large components
take part: from squared norms of 2**53 on, products are taken in Python's
integers; a score beyond 64 bits counts as the nearest 64-bit value, and a
vector whose scaled component is beyond the doubles takes no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkmart.llm.common import written

MAX_ROUTERS = 256
BLOCK, PAGE = 8192, 128
LOWEST, HIGHEST = -(1 << 63), (1 << 63) - 1
EXACT = float(1 << 53)   # squared norms below this: float products are exact


def quantised(df: DataFrame, id_col: str, vec_col: str, scale: int) -> DataFrame:
    v = df.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("v"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    v = v.where(F.col("vec_id").isNotNull() & (F.size("v") > 0) & ~F.coalesce(bad, F.lit(True)))
    # integers held as doubles: from 2**52 on every double is one, so nothing overflows
    whole = F.transform("v", lambda x: F.when(F.abs(x * scale) < float(1 << 52), F.floor(x * scale).cast("double")).otherwise(x * scale) + F.lit(0.0))
    v = v.select("vec_id", whole.alias("v")).where(~F.exists("v", lambda x: F.abs(x) == float("inf")))
    return v.dropDuplicates(["vec_id", "v"])


def _limit(base: float, least: int | None) -> float:
    """The largest distance at which a score of ``least`` or more can lie, with
    room for rounding (of a distance: the root of that of its square)."""
    if least is None or least <= LOWEST:
        return np.inf
    return np.sqrt(max(base - 2 * least, 0)) + 1e-3 + 1e-5 * np.sqrt(base)


def _products(rows: np.ndarray, q: np.ndarray, exact: bool) -> np.ndarray:
    """Integer inner products: of floats where all sums are under 2**53 by the
    norms, of Python's integers beyond, cut to 64 bits."""
    if exact:
        return (rows @ q).astype(np.int64)
    whole = [int(x) for x in q]
    return np.array([min(max(sum(int(a) * b for a, b in zip(r, whole)), LOWEST), HIGHEST) for r in rows.tolist()], np.int64)


def _matrix(rows: list, width: int) -> np.ndarray:
    out = np.zeros((len(rows), width), np.float64)
    for i, r in enumerate(rows):
        out[i, :len(r)] = r
    return out


def _lift(m: np.ndarray, top: float) -> np.ndarray:
    """Rows with the component that makes all their norms sqrt(top)."""
    return np.hstack([m, np.sqrt(np.maximum(top - (m * m).sum(1), 0))[:, None]])


def _distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    d = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T)
    return np.sqrt(np.maximum(d, 0))


class Block:
    """The pages of one block of rows."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, top: float, page: int = PAGE):
        self.ids, self.rows, self.top = ids, rows, top
        x = _lift(rows, top)
        self.routing = np.arange(0, len(ids), page)
        d = _distance(x, x[self.routing])
        owner = d.argmin(1)
        self.router = x[self.routing]
        self.pages, self.parent = [], []
        self.radius = np.zeros(len(self.routing))
        for p in range(len(self.routing)):
            mine = np.flatnonzero(owner == p)
            self.pages.append(mine)
            self.parent.append(d[mine, p])
            self.radius[p] = self.parent[p].max(initial=0)

    def search(self, qid: int, q: np.ndarray, k: int, bound: int | None, to_router: np.ndarray) -> list[tuple[int, int]]:
        """The k best (score, id) of the block that can beat or tie ``bound``,
        the k-th best score known so far. Best first over pages."""
        base = float(q @ q) + self.top
        best: list[tuple[int, int]] = []          # (-score, id), sorted
        least = bound
        low = to_router - self.radius
        for p in np.argsort(low, kind="stable").tolist():
            limit = _limit(base, least)
            if low[p] > limit:
                break
            near = self.pages[p]
            if limit < np.inf:
                near = near[np.abs(to_router[p] - self.parent[p]) <= limit]
            if not len(near):
                continue
            score = _products(self.rows[near], q, self.top < EXACT)
            if least is not None:
                ok = score >= least
                near, score = near[ok], score[ok]
            best += [(-int(s), int(i)) for s, i in zip(score, self.ids[near]) if i != qid]
            best = sorted(best)[:k]
            if len(best) == k:
                least = -best[-1][0] if least is None else max(least, -best[-1][0])
        return best


def _searched(stream: DataFrame, width: int, top: float, k: int, block: int) -> DataFrame:
    """Rows (node, chunk, kind, vec_id, v, bound) in order, a block's rows
    (kind 0) before its queries (kind 1): (query_id, vec_id, score)."""
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids, rows, tree = None, [], [], None
        for batch in batches:
            cols = [batch.column(i).to_pylist() for i in range(batch.num_columns)]
            out, asked = [], []
            for node, chunk, kind, vec_id, v, bound in zip(*cols):
                if (node, chunk) != key:
                    out += ask(tree, asked)
                    asked, key, ids, rows, tree = [], (node, chunk), [], [], None
                if kind == 0:
                    ids.append(vec_id)
                    rows.append(v)
                elif ids:
                    if tree is None:
                        tree = Block(np.array(ids), _matrix(rows, width), top)
                        rows = []
                    asked.append((vec_id, v, bound))
            out += ask(tree, asked)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, type=pa.int64()) for c in zip(*out)], schema=schema)

    def ask(tree, asked):
        out = []
        for at in range(0, len(asked) if tree is not None else 0, 256):
            part = asked[at:at + 256]
            q = _matrix([a[1] for a in part], width)
            d = _distance(np.hstack([q, np.zeros((len(part), 1))]), tree.router)
            for i, (qid, _, bound) in enumerate(part):
                out += [(qid, vec_id, -s) for s, vec_id in tree.search(qid, q[i], k, bound, d[i])]
        return out

    return stream.mapInArrow(run, "query_id bigint, vec_id bigint, score bigint")


def search(df: DataFrame, is_query, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = 256,
           block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): for every row where ``is_query`` (a
    condition on ``vec_id``) holds, the k best other rows."""
    spark = df.sparkSession
    base = written(quantised(df, id_col, vec_col, scale), "vectors")
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    facts = base.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("width"), F.max(square).alias("top")).first()
    n, width, top = facts["n"], facts["width"] or 1, float(facts["top"] or 0)
    want = int(min(MAX_ROUTERS, max(1, n // 2048)))
    picked = base.orderBy(F.xxhash64("vec_id"), "vec_id").limit(want).collect()   # at most MAX_ROUTERS rows
    routers = _lift(np.unique(_matrix([r["v"] for r in picked], width), axis=0), top)
    shared = spark.sparkContext.broadcast(routers)
    route = pa.schema([("vec_id", pa.int64()), ("v", pa.list_(pa.float64())), ("node", pa.int32()), ("dist", pa.float64())])

    def to_node(batches):
        for b in batches:
            d = _distance(_lift(_matrix(b.column(1).to_pylist(), width), top), shared.value)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(d.argmin(1).astype(np.int32)), pa.array(d.min(1))],
                                             schema=route)

    placed = base.select("vec_id", "v").mapInArrow(to_node, "vec_id bigint, v array<double>, node int, dist double")
    nodes = {r["node"]: (r["radius"], -(-r["n"] // block)) for r in placed.groupBy("node").agg(
        F.max("dist").alias("radius"), F.count("*").alias("n")).collect()}            # at most MAX_ROUTERS rows
    chunks = F.element_at(F.create_map(*[F.lit(x) for m, (_, c) in nodes.items() for x in (m, c)]) if nodes
                          else F.create_map(F.lit(0), F.lit(1)), F.col("node"))
    rows = placed.select("node", F.pmod(F.xxhash64("vec_id"), chunks).cast("int").alias("chunk"), F.lit(0).alias("kind"),
                         "vec_id", "v", F.lit(None).cast("bigint").alias("bound"))
    asked = base.where(is_query).select("vec_id", "v")
    visit = pa.schema([("node", pa.int32()), ("chunk", pa.int32()), ("kind", pa.int32()), ("vec_id", pa.int64()),
                       ("v", pa.list_(pa.float64())), ("bound", pa.int64())])
    order = sorted(nodes)
    radius = np.array([nodes[m][0] for m in order])

    def visits(batches):
        """The blocks that a query visits: its nearest node if it has no bound
        yet; with one, all others that the bound does not exclude."""
        for b in batches:
            vs, bounds = b.column(1).to_pylist(), b.column(2).to_pylist()
            q = _matrix(vs, width)
            d = _distance(np.hstack([q, np.zeros((len(q), 1))]), shared.value[order]) if order else np.zeros((len(q), 0))
            out = []
            for i, (qid, v, bound, first) in enumerate(zip(b.column(0).to_pylist(), vs, bounds, b.column(3).to_pylist())):
                near = int(d[i].argmin())
                if first:
                    go = [near]
                else:
                    limit = _limit(float(q[i] @ q[i]) + top, bound)
                    go = [j for j in np.flatnonzero(d[i] - radius <= limit).tolist() if j != near]
                out += [(order[j], c, 1, qid, v, bound) for j in go for c in range(nodes[order[j]][1])]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*out), visit)], schema=visit)

    def round_of(queries: DataFrame, first: bool) -> DataFrame:
        go = queries.select("vec_id", "v", "bound", F.lit(first).alias("first")).mapInArrow(
            visits, "node int, chunk int, kind int, vec_id bigint, v array<double>, bound bigint")
        stream = rows.unionAll(go).repartition("node", "chunk").sortWithinPartitions("node", "chunk", "kind", "vec_id")
        return _searched(stream, width, top, k, block)

    def best(found: DataFrame) -> DataFrame:
        w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)

    if not nodes:
        return base.select(F.col("vec_id").alias("query_id"), F.lit(0).alias("rank"), "vec_id", F.col("vec_id").alias("score")).limit(0)
    near = written(best(round_of(asked.withColumn("bound", F.lit(None).cast("bigint")), True)), "near")
    known = near.groupBy("query_id").agg(F.min("score").alias("low"), F.count("*").alias("n"))
    bounded = asked.join(known, asked["vec_id"] == known["query_id"], "left").select(
        "vec_id", "v", F.when(F.col("n") >= k, F.col("low")).alias("bound"))
    far = round_of(bounded, False)
    return best(near.select("query_id", "vec_id", "score").unionAll(far)).select("query_id", "rank", "vec_id", "score")
