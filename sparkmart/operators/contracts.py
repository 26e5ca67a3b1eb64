"""Table contracts (NOT NULL, PK / UNIQUE, FK, ENUM domain, VARCHAR length)
and their audit as a DataFrame of violations."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.operators.relational import keys_distinct
from sparkmart.sources.keyed_table import KeyedTable


@dataclass
class ForeignKey:
    columns: Sequence[str]
    parent: DataFrame
    parent_columns: Sequence[str]
    name: str = "fk"


@dataclass
class Contract:
    name: str
    pk: Sequence[str] = ()
    uniques: Sequence[Sequence[str]] = ()
    not_null: Sequence[str] = ()
    fks: Sequence[ForeignKey] = ()
    enums: dict[str, Sequence[str]] = field(default_factory=dict)
    lengths: dict[str, int] = field(default_factory=dict)


def _dup_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Number of rows sharing a complete key with another row (aggregate,
    map-side combined)."""
    complete = df
    for k in keys:
        complete = complete.filter(F.col(k).isNotNull())
    return (complete.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
            .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")))


def audit_contract(df: DataFrame, contract: Contract) -> DataFrame:
    """One row per rule: ``(table, rule, n_violations)``.

    Row-level rules (NOT NULL, ENUM, length) are counted in a single scan;
    key rules are grouped aggregates; FK rules are anti joins against the
    distinct parent keys.
    """
    row_rules = {}
    for c in contract.not_null:
        row_rules[f"not_null:{c}"] = F.col(c).isNull()
    for c, vals in contract.enums.items():
        row_rules[f"enum:{c}"] = F.col(c).isNotNull() & ~F.col(c).isin(*vals)
    for c, n in contract.lengths.items():
        row_rules[f"length:{c}<={n}"] = F.char_length(F.col(c)) > n
    parts = []
    if row_rules:
        counts = df.agg(*[F.count_if(v).alias(f"r{i}") for i, v in enumerate(row_rules.values())])
        stack = ", ".join(f"'{k}', r{i}" for i, k in enumerate(row_rules))
        parts.append(counts.selectExpr(f"stack({len(row_rules)}, {stack}) AS (rule, n_violations)"))
    key_sets = ([("pk", contract.pk)] if contract.pk else []) + [("unique", u) for u in contract.uniques]
    for kind, keys in key_sets:
        parts.append(_dup_rows(df, list(keys)).select(
            F.lit(f"{kind}:{','.join(keys)}").alias("rule"), F.col("n").alias("n_violations")))
    for fk in contract.fks:
        child = df
        for c in fk.columns:
            child = child.filter(F.col(c).isNotNull())
        ref = keys_distinct(fk.parent, list(fk.parent_columns), list(fk.columns))
        orphans = child.join(ref, list(fk.columns), "left_anti")
        parts.append(orphans.agg(F.count(F.lit(1)).alias("n_violations")).select(
            F.lit(f"{fk.name}:{','.join(fk.columns)}").alias("rule"), "n_violations"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select(F.lit(contract.name).alias("table_name"), "rule",
                      F.col("n_violations").cast("bigint").alias("n_violations"))


class KeyCounts:
    """UNIQUE and FK rules audited batch by batch: per key the number of rows that
    hold it (``n_rows``) and of parent rows that offer it (``n_parents``), kept in a
    ``KeyedTable`` on the key, so a batch reads the counts of its own keys only. The
    counts add up in any order: a parent may come after its children, and
    deleted rows are taken off. Keys with a NULL part break no rule."""

    def __init__(self, table: KeyedTable):
        self.table = table

    @staticmethod
    def schema(rows: DataFrame, key: Sequence[str]):
        return rows.select(*key, F.lit(0).cast("long").alias("n_rows"), F.lit(0).cast("long").alias("n_parents")).schema

    def add(self, batch_id: int, rows: DataFrame | None = None, parents: DataFrame | None = None,
            deleted: DataFrame | None = None) -> None:
        key, changes = self.table.key, None
        for df, n_rows, n_parents in ((rows, 1, 0), (parents, 0, 1), (deleted, -1, 0)):
            if df is not None:
                one = df.select(*key, F.lit(n_rows).cast("long").alias("n_rows"), F.lit(n_parents).cast("long").alias("n_parents"))
                changes = one if changes is None else changes.unionByName(one)
        if changes is not None:
            self.table.merge(self._sum(changes), batch_id, self._sum)

    def _sum(self, df: DataFrame) -> DataFrame:
        n = df.groupBy(*self.table.key).agg(F.sum("n_rows").alias("n_rows"), F.sum("n_parents").alias("n_parents"))
        return n.where((F.col("n_rows") != 0) | (F.col("n_parents") != 0))

    def violations(self) -> DataFrame:
        """(rule, n_violations): rows that share their key, rows without a parent."""
        n = self.table.read().agg(F.coalesce(F.sum(F.when(F.col("n_rows") > 1, F.col("n_rows"))), F.lit(0)).alias("u"),
                                  F.coalesce(F.sum(F.when(F.col("n_parents") == 0, F.col("n_rows"))), F.lit(0)).alias("f"))
        return n.selectExpr("stack(2, 'unique', u, 'fk', f) AS (rule, n_violations)")
