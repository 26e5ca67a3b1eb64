"""A Parquet table kept in key buckets, for jobs that add to it batch by batch.

Rows lie in folders by the hash of their key, and a batch reads only the
buckets that its own keys fall into. A bucket is a prefix of the hash bits; one
that outgrows ``rows_per_bucket`` is split by the next bits, so a bucket keeps its
size while the table grows, and what a batch reads is bounded by its own number
of keys. Rows whose key has a NULL part meet no other row: they lie apart, dealt
by their values, and are never read by a batch.

Every batch leaves one manifest (a small JSON file: folders and row count of each
bucket), written beside its place and renamed. A batch reads the newest manifest
*before* its own id and writes into folders of its own id, so a batch that is
replayed after a failure gives the same table, and a reader never sees half a
batch. Batch ids must ascend, so one stream (one checkpoint) feeds a table. Folders that no manifest names any more are left to ``vacuum``.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sparkmart.operators import relational as R

MAX_DEPTH = 16          # at most 65,536 buckets: the table that maps hash bits to buckets is broadcast
OPEN = -1               # the bucket of rows with a NULL key part


@dataclass
class Bucket:
    depth: int
    bits: int               # the first ``depth`` bits of the key's hash
    rows: int = 0
    folders: list[str] = field(default_factory=list)


@dataclass
class Manifest:
    batch_id: int
    buckets: dict[int, Bucket]
    read_rows: int = 0      # rows of the buckets that the batch read
    added_rows: int = 0


class KeyedTable:
    """``schema``: the rows' columns; ``key``: the columns of the key;
    ``rows_per_bucket``: size at which a bucket is split; ``max_folders``:
    folders of a bucket (one a batch) at which it is written as one."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType, key: str | Sequence[str],
                 rows_per_bucket: int = 1_000_000, max_folders: int = 16):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.key = [key] if isinstance(key, str) else list(key)
        self.rows_per_bucket, self.max_folders = rows_per_bucket, max_folders

    # ------------------------------------------------------------ manifests
    def _fs(self, path: str):
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self.spark._jsc.hadoopConfiguration()), where

    def _manifest_ids(self) -> list[int]:
        fs, where = self._fs(f"{self.path}/manifest")
        if not fs.exists(where):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(where)]
        return sorted(int(n[6:-5]) for n in names if n.startswith("batch-") and n.endswith(".json"))

    def manifest(self, before: int | None = None) -> Manifest:
        """The newest manifest, or the newest of the batches before ``before``."""
        ids = [i for i in self._manifest_ids() if before is None or i < before]
        if not ids:
            return Manifest(-1, {0: Bucket(0, 0), OPEN: Bucket(0, 0)})
        text = self.spark.read.text(f"{self.path}/manifest/batch-{ids[-1]:012d}.json", wholetext=True).first()[0]
        d = json.loads(text)
        return Manifest(d["batch_id"], {int(k): Bucket(**b) for k, b in d["buckets"].items()}, d["read_rows"], d["added_rows"])

    def _write_manifest(self, m: Manifest) -> None:
        text = json.dumps({"batch_id": m.batch_id, "read_rows": m.read_rows, "added_rows": m.added_rows,
                           "buckets": {k: vars(b) for k, b in m.buckets.items()}})
        place = f"{self.path}/manifest/batch-{m.batch_id:012d}.json"
        fs, beside = self._fs(f"{self.path}/manifest/.{uuid.uuid4().hex}")
        out = fs.create(beside, True)
        out.write(bytearray(text.encode()))
        out.close()
        _, where = self._fs(place)
        if fs.exists(where):                       # of a batch that failed later and is replayed
            fs.delete(where, False)
        if not fs.rename(beside, where):
            raise OSError(f"{place} could not be written")

    # -------------------------------------------------------------- buckets
    def _hash(self) -> Column:
        return F.shiftrightunsigned(F.xxhash64(*self.key), 64 - MAX_DEPTH).cast("int")

    def _open(self) -> Column:
        some = F.lit(False)
        for k in self.key:
            some = some | F.col(k).isNull()
        return some

    def _placed(self, df: DataFrame, buckets: dict[int, Bucket]) -> DataFrame:
        """``df`` with its ``bucket``."""
        depth = max(b.depth for b in buckets.values())
        rows = []
        for number, b in buckets.items():
            if number != OPEN:
                spread = depth - b.depth
                rows += [((b.bits << spread) + i, number) for i in range(1 << spread)]
        where = F.broadcast(self.spark.createDataFrame(rows, "_bits int, bucket int"))   # at most 2 ** MAX_DEPTH rows
        bits = F.when(self._open(), F.lit(None)).otherwise(F.shiftright(self._hash(), MAX_DEPTH - depth))
        placed = df.withColumn("_bits", bits).join(where, "_bits", "left").drop("_bits")
        return placed.withColumn("bucket", F.coalesce("bucket", F.lit(OPEN)))

    def _load(self, folders: Iterable[str]) -> DataFrame:
        folders = [f"{self.path}/{f}" for f in folders]
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*folders)

    def _store(self, placed: DataFrame, folder: str) -> dict[int, int]:
        """Writes rows by bucket into ``folder``; rows per bucket."""
        names = [f.name for f in self.schema.fields]
        salt = F.when(F.col("bucket") == OPEN, F.pmod(F.xxhash64(*names), F.lit(64)))     # open rows have no bound
        (placed.select(*names, "bucket").repartition("bucket", salt).write.mode("overwrite")
         .partitionBy("bucket").parquet(f"{self.path}/{folder}"))
        back = self.spark.read.schema(StructType(self.schema.fields[:]).add("bucket", "integer")).parquet(f"{self.path}/{folder}")
        return {r["bucket"]: r["n"] for r in back.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row a bucket

    def _touched(self, placed: DataFrame, m: Manifest) -> list[int]:
        got = placed.select("bucket").distinct().collect()                 # at most a row a bucket
        return [r[0] for r in got if r[0] != OPEN and m.buckets[r[0]].folders]

    def _tidy(self, m: Manifest, folder: str) -> None:
        """Buckets that are too large are split, those of many folders written as one."""
        split = {}
        for k, b in m.buckets.items():
            if k == OPEN:
                continue
            parts = 0
            while b.depth + parts < MAX_DEPTH and b.rows >> parts > self.rows_per_bucket:
                parts += 1
            if parts or len(b.folders) > self.max_folders:
                split[k] = parts
        if not split:
            return
        old = {k: m.buckets.pop(k) for k in split}
        number = max([k for k in [*m.buckets, *old]]) + 1
        fresh = {}
        for k, b in old.items():
            for i in range(1 << split[k]):
                fresh[number] = Bucket(b.depth + split[k], (b.bits << split[k]) + i)
                number += 1
        rows = self._load([f for b in old.values() for f in b.folders])
        counts = self._store(self._placed(rows, {**m.buckets, **fresh}), folder)
        for k, n in counts.items():
            fresh[k].rows, fresh[k].folders = n, [f"{folder}/bucket={k}"]
        m.buckets.update(fresh)

    # --------------------------------------------------------------- batches
    def insert_ignore(self, batch: DataFrame, batch_id: int, order_by: Sequence | None = None) -> Manifest:
        """Adds the rows whose key is not held yet (first in ``order_by`` among
        themselves). Of the buckets they fall into only the key columns are read."""
        m = self.manifest(before=batch_id)
        batch = batch.select(*[f.name for f in self.schema.fields]).persist()
        touched = self._touched(self._placed(batch, m.buckets), m)
        held = self._load([f for k in touched for f in m.buckets[k].folders]).select(*self.key)
        added = R.insert_ignore(held, batch, self.key, order_by=order_by)
        folder = f"data/batch={batch_id}"
        counts = self._store(self._placed(added, m.buckets), folder)
        batch.unpersist()
        out = Manifest(batch_id, m.buckets, sum(m.buckets[k].rows for k in touched), sum(counts.values()))
        for k, n in counts.items():
            out.buckets[k].rows += n
            out.buckets[k].folders.append(f"{folder}/bucket={k}")
        self._tidy(out, f"data/batch={batch_id}-tidy")
        self._write_manifest(out)
        return out

    def merge(self, batch: DataFrame, batch_id: int, fold: Callable[[DataFrame], DataFrame]) -> Manifest:
        """Replaces the rows of the keys in ``batch`` by ``fold`` of the held and the
        new rows together. ``fold`` works key by key and must give the same rows
        whichever way the input is cut into batches (a top-k, a sum, ...). Only the
        buckets that the batch falls into are read and written. Rows with a NULL
        key part are left out."""
        m = self.manifest(before=batch_id)
        names = [f.name for f in self.schema.fields]
        batch = batch.select(*names).where(~self._open()).persist()
        touched = self._touched(self._placed(batch, m.buckets), m)
        held = self._load([f for k in touched for f in m.buckets[k].folders])
        folded = fold(held.unionByName(batch)).select(*names)
        folder = f"data/batch={batch_id}"
        counts = self._store(self._placed(folded, m.buckets), folder)
        batch.unpersist()
        read = sum(m.buckets[k].rows for k in touched)
        out = Manifest(batch_id, m.buckets, read, sum(counts.values()) - read)
        for k in {*touched, *counts}:
            out.buckets[k].rows = counts.get(k, 0)
            out.buckets[k].folders = [f"{folder}/bucket={k}"] if k in counts else []
        self._tidy(out, f"data/batch={batch_id}-tidy")
        self._write_manifest(out)
        return out

    def lookup(self, keys: DataFrame) -> DataFrame:
        """The rows of the given keys (``keys`` has the key columns), read from
        the buckets that those fall into."""
        m = self.manifest()
        keys = R.keys_distinct(keys, self.key).persist()
        touched = self._touched(self._placed(keys, m.buckets), m)
        found = self._load([f for k in touched for f in m.buckets[k].folders])
        return found.join(keys, self.key, "left_semi").select(*[f.name for f in self.schema.fields])

    def read(self) -> DataFrame:
        return self._load(f for b in self.manifest().buckets.values() for f in b.folders)

    def vacuum(self) -> None:
        """Drops the folders and manifests that the newest manifest does not need
        (readers and replays of earlier batches must have ended)."""
        m = self.manifest()
        keep = {f.split("/bucket=")[0] for b in m.buckets.values() for f in b.folders}
        fs, where = self._fs(f"{self.path}/data")
        for s in fs.listStatus(where) if fs.exists(where) else []:
            if f"data/{s.getPath().getName()}" not in keep:
                fs.delete(s.getPath(), True)
        for i in self._manifest_ids():
            if i < m.batch_id:
                fs.delete(self._fs(f"{self.path}/manifest/batch-{i:012d}.json")[1], False)
