"""File sources and sinks (CSV, Parquet tables, stored pages, JSON payloads)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

__all__ = [
    "PANDAS_NA_STRINGS", "read_csv_clean", "export_delimited", "read_pages", "read_payloads",
    "TableStore", "append_with_rejects", "overwrite_snapshot", "write_vectors",
]

# Strings that pandas' CSV reader treats as missing by default
# (the reference reads its CSV with pandas defaults).
PANDAS_NA_STRINGS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
                     "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
                     "nan", "null"]


def read_csv_clean(spark: SparkSession, path: str, schema: StructType | str | None = None,
                   upper: bool = True) -> DataFrame:
    """CSV with a header: header names are stripped (and upper-cased), the
    pandas missing-value strings become NULL. Without a schema every column
    is a string (no inference pass over the data)."""
    reader = spark.read.option("header", True).option("multiLine", True).option("escape", '"')
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.csv(path)
    names = [c.strip().upper() if upper else c.strip() for c in df.columns]
    kinds = dict(df.dtypes)
    out = []
    for old, new in zip(df.columns, names):
        c = F.col(f"`{old}`")
        if kinds[old] == "string":
            c = F.when(F.trim(c).isin(*PANDAS_NA_STRINGS) | c.isNull(), F.lit(None).cast("string")).otherwise(c)
        elif kinds[old] in ("double", "float"):
            c = F.when(F.isnan(c), F.lit(None)).otherwise(c)
        out.append(c.alias(new))
    return df.select(*out)


def export_delimited(df: DataFrame, path: str, sep: str = "\t",
                     partition_by: Sequence[str] = (), header: bool = True) -> None:
    """Delimited export (TSV per key partition / labelled CSV)."""
    w = df.write.mode("overwrite").option("header", header).option("sep", sep)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.csv(path)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Stored pages: a Parquet table ``(page_id, url, html)`` or a folder of
    HTML files (one row per file: ``url`` = file path, ``html`` = whole text)."""
    if path.endswith(".parquet"):
        return spark.read.parquet(path)
    raw = spark.read.text(path, wholetext=True)
    return raw.select(F.xxhash64(F.input_file_name()).alias("page_id"),
                      F.input_file_name().alias("url"), F.col("value").alias("html"))


def read_payloads(spark: SparkSession, path: str, schema: StructType | str, lines: bool = False) -> DataFrame:
    """JSON payload files with an explicit schema: one document per file, or
    with ``lines`` one per line (such files are split)."""
    return spark.read.schema(schema).option("multiLine", not lines).json(path)


def overwrite_snapshot(df: DataFrame, path: str) -> DataFrame:
    """Replace the table at ``path`` with ``df`` (delete-all + insert). An
    empty ``df`` leaves an empty table. Lineage is cut with a reliable
    checkpoint first, so ``df`` may itself read the old snapshot."""
    snap = df.checkpoint(eager=True)
    snap.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def write_vectors(df: DataFrame, path: str, dim: int, vector_col: str = "vector",
                  mode: str = "append") -> DataFrame:
    """Vector sink: rejects rows whose vector length is not ``dim``; returns
    the rejected rows (empty when all are valid)."""
    ok = F.size(F.col(vector_col)) == dim
    df.filter(ok).write.mode(mode).parquet(path)
    return df.filter(~ok | F.col(vector_col).isNull())


class TableStore:
    """Named Parquet tables under one root folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def read(self, name: str, columns: Sequence[str] | None = None) -> DataFrame:
        df = self.spark.read.parquet(self.path(name))
        return df.select(*columns) if columns else df

    def exists(self, name: str) -> bool:
        jvm = self.spark._jvm
        p = jvm.org.apache.hadoop.fs.Path(self.path(name))
        fs = p.getFileSystem(self.spark._jsc.hadoopConfiguration())
        return fs.exists(p)

    def write(self, name: str, df: DataFrame, mode: str = "overwrite") -> None:
        df.write.mode(mode).parquet(self.path(name))

    def overwrite(self, name: str, df: DataFrame) -> DataFrame:
        return overwrite_snapshot(df, self.path(name))


def append_with_rejects(batch: DataFrame, rules: dict[str, object]) -> DataFrame:
    """Per-row checks: ``rules`` maps a reason to a Column that is TRUE for a
    bad row; the first failing rule (in order) is the row's ``reject_reason``
    (NULL = accepted). One pass, nothing fails the whole batch."""
    reason = F.lit(None).cast("string")
    for name, bad in reversed(list(rules.items())):
        reason = F.when(F.coalesce(bad, F.lit(False)), F.lit(name)).otherwise(reason)
    return batch.withColumn("reject_reason", reason)
