"""Keyed table operators: first-wins de-duplication, INSERT IGNORE, SQL
``NOT IN`` / ``IN`` deletes, cascades, lookups and surrogate keys.

Design rules used throughout:

* de-duplication is an aggregate (``min_by`` over a total order), never a
  window, so a key holding a large share of the rows is collapsed map-side
  before the shuffle instead of being sorted in one task;
* reference key sets are reduced with ``distinct`` (also map-side combined)
  before an anti / semi join, so hot keys on the reference side cost nothing;
* three-valued ``NOT IN`` logic is decided by two scalar aggregates of the
  reference (row count, NULL count) evaluated as scalar subqueries - no
  cross join, no null-aware broadcast nested loop join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmart.session import written

__all__ = [
    "first_wins", "insert_ignore", "insert_ignore_table", "anti_not_in", "delete_not_in",
    "delete_in", "cascade_delete", "greedy_unique", "with_parent", "unseen", "lookup_first", "with_surrogate_key",
    "apply_defaults", "nulls_for_nan", "keys_distinct", "update_from",
]


def _cols(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def _order_struct(order_by: Sequence) -> Column:
    parts = []
    for i, o in enumerate(order_by):
        c = F.col(o) if isinstance(o, str) else o
        parts.append(c.alias(f"_o{i}"))
    return F.struct(*parts)


def first_wins(df: DataFrame, keys: str | Sequence[str], order_by: Sequence, count: str | None = None) -> DataFrame:
    """Keep, per key, the row that is first in ``order_by`` (ascending; wrap a
    column in ``F.desc``-free negation or pass an expression for descending).

    Implemented as ``min_by(struct(row), struct(order))`` per key: partial
    aggregation runs before the shuffle, so skewed keys are pre-reduced. Where
    the order names every column, the least order is the row and travels once.
    Rows whose key has a NULL part are all kept (NULL never conflicts).
    ``count`` names a column for the number of rows that had the key.
    """
    keys = _cols(keys)
    some_null = F.lit(False)
    for k in keys:
        some_null = some_null | F.col(k).isNull()
    # one branch: a row with an open key gets a filler of its own, so it meets no other
    named = [F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]
    filler = F.when(some_null, F.monotonically_increasing_id()).alias("_open")
    n = [] if count is None else [F.count(F.lit(1)).alias(count)]
    kept = [] if count is None else [count]
    by_key = [f"_k{i}" for i in range(len(keys))] + ["_open"]
    if all(isinstance(o, str) for o in order_by) and sorted(order_by) == sorted(df.columns):
        whole = df.select(*named, filler, F.struct(*order_by).alias("_row"))
        best = whole.groupBy(*by_key).agg(F.min("_row").alias("_r"), *n)
        return best.select(*[F.col(f"_r.{c}").alias(c) for c in df.columns], *kept)
    row = F.struct(*[F.col(c) for c in df.columns])
    keyed = df.select(*named, filler, row.alias("_row"), _order_struct(order_by).alias("_order"))
    best = keyed.groupBy(*by_key).agg(F.min_by("_row", "_order").alias("_r"), *n)
    return best.select("_r.*", *kept)


def keys_distinct(df: DataFrame, keys: Sequence[str], names: Sequence[str] | None = None) -> DataFrame:
    """Distinct non-NULL key tuples (map-side combined)."""
    names = list(names or keys)
    out = df.select(*[F.col(k).alias(n) for k, n in zip(keys, names)])
    for n in names:
        out = out.filter(F.col(n).isNotNull())
    return out.distinct()


def _anti_existing(batch: DataFrame, existing: DataFrame, keys: Sequence[str]) -> DataFrame:
    ref = keys_distinct(existing, keys)
    return batch.join(ref, on=list(keys), how="left_anti").select(*batch.columns)


def insert_ignore(target: DataFrame, batch: DataFrame, pk: str | Sequence[str],
                  uniques: Sequence[Sequence[str]] = (), order_by: Sequence | None = None,
                  fks: Sequence[tuple[Sequence[str], DataFrame, Sequence[str]]] = (),
                  lengths: dict[str, int] | None = None) -> DataFrame:
    """Rows of ``batch`` that ``INSERT IGNORE INTO target`` would add.

    Rules: FK orphans are rejected first (a NULL FK passes), then rows that
    clash with an existing row on the PK or a UNIQUE key; the rest go in one by
    one in arrival order (``order_by``, the PK if not given; ties by the rows'
    values), a row being ignored if a row *that went in* holds one of its keys.
    Keys with a NULL part never clash. Over-long strings are cut to ``lengths``.
    """
    pk = _cols(pk)
    rows = batch
    if lengths:
        rows = rows.select(*[F.substring(F.col(c), 1, lengths[c]).alias(c) if c in lengths else F.col(c)
                             for c in rows.columns])
    for child_cols, parent, parent_cols in fks:
        rows = with_parent(rows, child_cols, parent, parent_cols)
    keys = [pk, *[_cols(u) for u in uniques]]
    for key in keys:
        rows = _anti_existing(rows, target, key)
    order = [*(order_by or pk), F.xxhash64(*batch.columns)]
    kept = first_wins(rows, pk, order) if len(keys) == 1 else greedy_unique(rows, keys, order)
    return kept.select(*batch.columns)


def _key_text(df: DataFrame, key: Sequence[str]) -> Column:
    """A key tuple as one comparable text, NULL where a part is NULL."""
    kinds = dict(df.dtypes)
    parts = [(F.col(c) + F.lit(0.0) if kinds[c] in ("double", "float") else F.col(c)).alias(c) for c in key]   # -0.0 equals 0.0
    some_null = F.lit(False)
    for c in key:
        some_null = some_null | F.col(c).isNull()
    return F.when(~some_null, F.to_json(F.struct(*parts)))


def _key_hash(df: DataFrame, key: Sequence[str]) -> Column:
    """A 64-bit hash of a key tuple, NULL where a part is NULL: equal keys have equal hashes."""
    kinds = dict(df.dtypes)
    parts = [F.col(c) + F.lit(0.0) if kinds[c] in ("double", "float") else F.col(c) for c in key]   # -0.0 equals 0.0
    some_null = F.lit(False)
    for c in key:
        some_null = some_null | F.col(c).isNull()
    return F.when(~some_null, F.xxhash64(*parts))


def greedy_unique(df: DataFrame, keys: Sequence[Sequence[str]], order_by: Sequence) -> DataFrame:
    """The rows that sequential insertion in ``order_by`` order would keep under
    several unique keys at once: a row is kept unless an earlier *kept* row
    holds one of its keys (a rejected row shuts out nobody).

    First the keys that clash at all are looked for, by counting 64-bit hashes of
    the key values, and nothing else travels. Keys no two rows share shut out nobody; if
    only one of ``keys`` clashes, its first rows stay. Else the rows with a clashing
    hash are numbered in order and settled in rounds over (row, key) pairs: a row that
    is first among the open rows in every key it has is kept; open rows that hold a key
    of a kept row are rejected; the others stay open. Every round settles the first open
    row of each group of clashing rows at least, and mostly nearly all; there are as
    many rounds as the longest chain of rows of which each is let in by the rejection of
    the one before. Firsts are found by a map-side combined minimum, so a key that very
    many rows hold is reduced before the shuffle.
    """
    base = df.withColumn("_rid", F.monotonically_increasing_id())
    base = written(base, "rows")    # ids must outlive a lost task
    hashes = [F.struct(F.lit(i).alias("_i"), _key_hash(df, k).alias("_h")) for i, k in enumerate(keys)]
    each = base.select("_rid", F.explode(F.filter(F.array(*hashes), lambda x: x["_h"].isNotNull())).alias("_x")).select("_rid", "_x._i", "_x._h")
    clashes = written(each.groupBy("_i", "_h").agg(F.count(F.lit(1)).alias("_c")).where("_c > 1").select("_i", "_h"), "clashes")
    clashing = sorted(r["_i"] for r in clashes.select("_i").distinct().collect())     # at most len(keys)
    if not clashing:
        return base.drop("_rid")
    if len(clashing) == 1:
        order = [*order_by, F.col("_rid")]
        for i, k in enumerate(keys):
            if i != clashing[0] and set(k) <= {o for o in order_by if isinstance(o, str)}:      # no two whole keys are equal: no ties behind it
                order = [o if isinstance(o, str) else F.when(_key_hash(df, k).isNull(), o) for o in order]
        return first_wins(base, keys[clashing[0]], order).drop("_rid")
    touched = written(each.join(clashes, ["_i", "_h"], "left_semi").groupBy("_rid").agg(F.collect_set("_i").alias("_is")), "touched")
    held = F.filter(F.array(*[F.struct(F.lit(i).alias("_i"), _key_text(df, k).alias("_k")) for i, k in enumerate(keys)]),
                    lambda x: F.array_contains("_is", x["_i"]))
    slim = base.join(touched, "_rid").select("_rid", held.alias("_held"), _order_struct([*order_by, "_rid"]).alias("_order"))
    ranked = with_surrogate_key(slim, "_rank", ["_order"], keep=["_rid", "_held"])
    open_ = ranked.select("_rid", "_rank", F.size("_held").alias("_n"), F.explode("_held").alias("_x")).select(
        "_rid", "_rank", "_n", "_x._i", "_x._k")
    open_, kept = written(open_, "open"), []
    while not open_.isEmpty():
        first = open_.groupBy("_i", "_k").agg(F.min(F.struct("_rank", "_rid", "_n")).alias("_f")).select("_i", "_k", "_f._rid", "_f._n")
        w = first.groupBy("_rid", "_n").agg(F.count("*").alias("_c"), F.collect_list(F.struct("_i", "_k")).alias("_keys"))
        into = w.where(F.col("_c") == F.col("_n")).select("_rid", "_keys")
        into = written(into, "kept")       # at most len(keys) keys a row
        kept.append(into.select("_rid"))
        taken = into.select(F.explode("_keys").alias("_x")).select("_x._i", "_x._k")
        settled = open_.join(taken, ["_i", "_k"], "left_semi").select("_rid").distinct()
        open_ = written(open_.join(settled, "_rid", "left_anti"), "open")
    ids = kept[0]
    for k in kept[1:]:
        ids = ids.unionAll(k)
    lost = touched.select("_rid").join(ids, "_rid", "left_anti")
    return base.join(lost, "_rid", "left_anti").drop("_rid")


def with_parent(df: DataFrame, child_cols, parent: DataFrame, parent_cols) -> DataFrame:
    """Rows that satisfy a foreign key: the parent exists, or a part of the key
    is NULL. One left join to the distinct parent keys, no second branch."""
    child_cols, parent_cols = _cols(child_cols), _cols(parent_cols)
    ref = keys_distinct(parent, parent_cols, child_cols).withColumn("_parent", F.lit(True))
    some_null = F.lit(False)
    for c in child_cols:
        some_null = some_null | F.col(c).isNull()
    return df.join(ref, child_cols, "left").where(some_null | F.col("_parent").isNotNull()).select(*df.columns)


def insert_ignore_table(target: DataFrame, batch: DataFrame, pk, **kw) -> DataFrame:
    """The target after the insert: existing rows plus the accepted ones."""
    added = insert_ignore(target, batch, pk, **kw)
    return target.unionByName(added.select(*target.columns))


def _not_in_stats(ref: DataFrame, ref_key: str) -> tuple[Column, Column]:
    both = ref.select(F.struct(F.count(F.lit(1)).alias("n"), F.count_if(F.col(ref_key).isNull()).alias("nulls"))).scalar()
    return both["n"], both["nulls"]   # one aggregate; the two reads share its subquery


def anti_not_in(df: DataFrame, key: str, ref: DataFrame, ref_key: str | None = None) -> DataFrame:
    """Rows for which ``key NOT IN (SELECT ref_key FROM ref)`` is TRUE.

    Empty ref: every row (NULL keys too). Ref holding a NULL: no row.
    Otherwise non-NULL keys absent from ref.
    """
    ref_key = ref_key or key
    n_ref, n_null = _not_in_stats(ref, ref_key)
    refk = keys_distinct(ref, [ref_key], [key])
    out = df.join(refk, on=key, how="left_anti")
    return out.filter((n_ref == 0) | ((n_null == 0) & F.col(key).isNotNull())).select(*df.columns)


def delete_not_in(df: DataFrame, key: str, ref: DataFrame, ref_key: str | None = None) -> DataFrame:
    """Survivors of ``DELETE FROM df WHERE key NOT IN (SELECT ref_key FROM ref)``.

    A row is deleted only where the predicate is TRUE: empty ref deletes
    everything; a NULL in ref deletes nothing; otherwise NULL-key rows and
    rows whose key is in ref survive.
    """
    ref_key = ref_key or key
    n_ref, n_null = _not_in_stats(ref, ref_key)
    refk = keys_distinct(ref, [ref_key], [key]).withColumn("_hit", F.lit(True))
    out = df.join(refk, on=key, how="left")
    keep = (n_ref > 0) & ((n_null > 0) | F.col(key).isNull() | F.col("_hit").isNotNull())
    return out.filter(keep).select(*df.columns)


def delete_in(df: DataFrame, key: str | Sequence[str], ids: DataFrame,
              ids_key: str | Sequence[str] | None = None) -> DataFrame:
    """Survivors of ``DELETE FROM df WHERE key IN (ids)`` (NULL keys survive)."""
    key = _cols(key)
    ids_key = _cols(ids_key) if ids_key else key
    return df.join(keys_distinct(ids, ids_key, key), on=key, how="left_anti")


def cascade_delete(tables: dict[str, DataFrame], edges: Sequence[tuple[str, str, str, str]],
                   root: str, root_key: str, ids: DataFrame, ids_key: str | None = None
                   ) -> dict[str, DataFrame]:
    """Delete ``ids`` from ``root`` and, following ``ON DELETE CASCADE`` edges
    ``(parent, parent_key, child, child_fk)``, every dependent row.

    Returns the surviving version of every table in ``tables``.
    """
    gone = {root: keys_distinct(ids, [ids_key or root_key], [root_key])}   # per table: a condition frame on its columns
    hits: dict[str, list[tuple[str, DataFrame]]] = {root: [(root_key, gone[root])]}
    out = dict(tables)
    for table in _parents_first(edges, root):
        found = hits.get(table, [])
        flagged = tables[table]
        for i, (fk, keys) in enumerate(found):   # a row goes if any of its parents goes
            flagged = flagged.join(keys.withColumn(f"_gone{i}", F.lit(True)), fk, "left")
        any_gone = F.coalesce(*[F.col(f"_gone{i}") for i in range(len(found))], F.lit(False))
        out[table] = flagged.where(~any_gone).select(*tables[table].columns)
        for parent, pkey, child, fk in edges:
            if parent == table:
                hits.setdefault(child, []).append((fk, keys_distinct(flagged.where(any_gone), [pkey], [fk])))
    return out


def _parents_first(edges: Sequence[tuple[str, str, str, str]], root: str) -> list[str]:
    """The tables reached from ``root``, every parent before its children; a
    cycle of cascades is refused."""
    reached, todo = {root}, [root]
    while todo:
        for child in [c for p, _, c, _ in edges if p == todo[-1] and c not in reached]:
            reached.add(child)
            todo.insert(0, child)
        todo.pop()
    order: list[str] = []
    while len(order) < len(reached):
        ready = [t for t in sorted(reached - set(order))
                 if all(p in order or p not in reached for p, _, c, _ in edges if c == t)]
        if not ready:
            raise ValueError(f"cascades form a cycle among {sorted(reached - set(order))}")
        order += ready
    return order


def unseen(df: DataFrame, key: str, seen: DataFrame, seen_key: str | None = None) -> DataFrame:
    """Incremental filter: rows whose key is not yet loaded. With nothing seen,
    everything (NULL keys too) is new; otherwise NULL keys are dropped."""
    return anti_not_in(df, key, seen, seen_key)


def lookup_first(df: DataFrame, dim: DataFrame, on: str | Sequence[str], order_by: Sequence,
                 dim_on: str | Sequence[str] | None = None) -> DataFrame:
    """Left join to ``dim`` taking only the first dim row per key (missing
    gives NULLs). The dim is de-duplicated by aggregation first, so the join
    never multiplies rows."""
    on = _cols(on)
    dim_on = _cols(dim_on) if dim_on else on
    d = dim
    if dim_on != on:
        d = d.select(*[F.col(a).alias(b) for a, b in zip(dim_on, on)],
                     *[c for c in d.columns if c not in dim_on])
    d = first_wins(d.filter(F.col(on[0]).isNotNull()), on, order_by)
    return df.join(d, on=on, how="left")


def with_surrogate_key(df: DataFrame, name: str, order_by: Sequence, start: int | Column = 0,
                       materialize: bool = True, keep: Sequence[str] | None = None) -> DataFrame:
    """Number rows 1..n in ``order_by`` order and add ``start`` (the current
    maximum of the target, like AUTO_INCREMENT / SERIAL). ``keep`` names the columns
    that are wanted besides the number, where the others only give the order.

    Distributed two-pass numbering: range-partition + sort, count rows per
    partition (one tiny row per partition), prefix-sum the counts and add the
    offset of each row's partition to its position inside the partition.

    Partition ids and positions are assigned at run time, so a
    re-evaluation (a second action, or a stage recomputed after an executor
    loss) is not guaranteed to reproduce the same numbering for rows that
    tie; by default the range-partitioned, position-tagged frame is written
    once as Parquet and both the per-partition counts and the
    numbering are derived from that fixed copy, so every consumer sees the
    same ids. (The broadcast offsets table has one row per partition.)
    """
    order_cols = [F.col(o) if isinstance(o, str) else o for o in order_by]
    ranged = (df.repartitionByRange(*order_cols).sortWithinPartitions(*order_cols)
              .withColumn("_pid", F.spark_partition_id())
              .withColumn("_mid", F.monotonically_increasing_id()))
    if keep is not None:
        ranged = ranged.select(*keep, "_pid", "_mid")
    if materialize:
        # one fixed copy: the count branch and the numbering branch must see
        # the same partition ids (AQE may coalesce two separate exchanges
        # differently, and a recomputed stage may place ties differently)
        ranged = written(ranged, "ranged")
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_m0"))
    from pyspark.sql import Window
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", "_m0", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    start_col = start if isinstance(start, Column) else F.lit(start)
    out = ranged.join(F.broadcast(offsets), "_pid")
    return out.withColumn(name, (F.col("_off") + (F.col("_mid") - F.col("_m0")) + 1 + start_col).cast("long")) \
        .drop("_pid", "_mid", "_m0", "_off")


def apply_defaults(df: DataFrame, spec: dict[str, object], now=None) -> DataFrame:
    """Fill column defaults: a value, ``'now'`` (the given ``now``), or NULL.
    Missing columns are added."""
    from sparkmart.functions.temporal import lit_ts
    out = df
    for c, v in spec.items():
        dflt = lit_ts(now) if v == "now" else F.lit(v)
        out = out.withColumn(c, F.coalesce(F.col(c), dflt) if c in df.columns else dflt)
    return out


def nulls_for_nan(df: DataFrame) -> DataFrame:
    """NaN in float / double columns becomes NULL before writing."""
    kinds = dict(df.dtypes)
    return df.select(*[F.when(F.isnan(c), F.lit(None)).otherwise(F.col(c)).alias(c)
                       if kinds[c] in ("double", "float") else F.col(c) for c in df.columns])


def update_from(target: DataFrame, updates: DataFrame, key: str | Sequence[str],
                assignments: dict[str, str], order_by: Sequence | None = None) -> DataFrame:
    """``UPDATE target SET col = updates.val WHERE key matches``: unmatched rows
    and NULL values keep the old value. ``assignments`` maps target column ->
    updates column. Of several updates for a key the first in ``order_by`` holds
    as a whole (without one, the greatest by its values), so no row gets values of
    two updates and the target's rows never multiply."""
    key = _cols(key)
    values = F.struct(*[F.col(v).alias(f"_u_{c}") for c, v in assignments.items()])
    one = F.min_by(values, _order_struct([*order_by, values])) if order_by else F.max(values)
    u = updates.groupBy(*key).agg(one.alias("_u"))
    j = target.join(u, on=key, how="left")
    for c in assignments:
        j = j.withColumn(c, F.coalesce(F.col(f"_u._u_{c}"), F.col(c)))
    return j.select(*target.columns)
