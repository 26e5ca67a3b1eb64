"""Helpers shared by the operators: input projection, Arrow batches, files in
the shared folder, and word / byte hashing in numpy."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmart.session import ensure_checkpoint_dir, ship_package

# ASCII white space that separates words; bytes.split() splits on the same six.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def prepare(spark: SparkSession) -> None:
    """Workers can import the package, checkpoint() has its shared folder, and
    Arrow batches of long texts stay small (unless the session sets a size)."""
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    if spark.conf.get(BATCH_BYTES, None) is None:
        spark.conf.set(BATCH_BYTES, str(8 << 20))


def id_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only (doc_id, text): whatever other columns the input has, and however
    they are named, they neither reach the operator nor clash with its own."""
    return df.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def held_out(id_col, folds: int = 5, fold: int = 0):
    """crc32 of the id as text, modulo the number of folds (null id: false)."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.coalesce(F.crc32(c.cast("string")) % folds == fold, F.lit(False))


def map_arrow(df: DataFrame, fn: Callable[[dict[str, list]], dict], schema: str, max_bytes: int = 8 << 20) -> DataFrame:
    """mapInArrow with ``fn`` over column lists. A batch is passed on in slices
    of about ``max_bytes`` of text (one row at least), so that what ``fn``
    builds at a time does not depend on Arrow's batch length."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    out = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, max_bytes):
                cols = fn({n: part.column(i).to_pylist() for i, n in enumerate(part.schema.names)})
                yield pa.RecordBatch.from_arrays([pa.array(cols[f.name], type=f.type) for f in out], schema=out)

    return df.mapInArrow(run, schema)


def slices(batch: pa.RecordBatch, max_bytes: int) -> Iterator[pa.RecordBatch]:
    n = batch.num_rows
    if not n:
        return
    step = max(1, int(n * max_bytes // max(batch.nbytes, 1)))
    for at in range(0, n, step):
        yield batch.slice(at, step)


def grouped(batches: Iterator[pa.RecordBatch], max_bytes: int) -> Iterator[pa.RecordBatch]:
    """Consecutive batches joined up to about ``max_bytes``, larger ones sliced."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        for part in slices(batch, max_bytes):
            if held and sum(b.nbytes for b in held) + part.nbytes > max_bytes:
                yield pa.concat_batches(held)
                held = []
            held.append(part)
    if held:
        yield pa.concat_batches(held)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below spark.checkpoint.dir for files of one run."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/sparkmart/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as Parquet in the shared folder, read back: lineage ends there,
    and a lost executor costs its own tasks only."""
    spark = df.sparkSession
    path = shared_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release_memory() -> None:
    """What Arrow and the C library keep of freed memory goes back to the
    system: a driver that has learnt from a gathered sample stays small."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


# fixed odd multipliers of the hashes below
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX1 = np.uint64(0xBF58476D1CE4E5B9)
_MIX2 = np.uint64(0x94D049BB133111EB)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of uint64 values."""
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


_UNBASE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_TABLES: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, ``n`` of each at least."""
    if len(_TABLES[0]) < n:
        for i, base in enumerate((_BASE, _UNBASE)):
            _TABLES[i] = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, base, np.uint64)]))
    return _TABLES


def word_hashes(texts: list[bytes], block: int = 1 << 20) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of all texts in order, and the number of
    words per text. A word's hash is the polynomial of its bytes modulo
    2**64, read off prefix sums (the base is odd, so the power of the word's
    place divides out), then scrambled with its length."""
    hashes, counts, at = [], [], 0
    while at < len(texts):
        to, size = at, 0
        while to < len(texts) and (to == at or size + len(texts[to]) < block):
            size += len(texts[to]) + 1
            to += 1
        h, n = _block_hashes(texts[at:to])
        hashes.append(h)
        counts.append(n)
        at = to
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(hashes), np.concatenate(counts)


def _block_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    b = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    edge = np.flatnonzero(np.diff(_SPACE[b], prepend=True))
    start, end = edge[0::2], edge[1::2]
    power, back = _powers(len(b))
    total = np.zeros(len(b) + 1, np.uint64)
    np.cumsum((b.astype(np.uint64) + np.uint64(1)) * power[:len(b)], out=total[1:])
    h = mix64((total[end] - total[start]) * back[start] ^ ((end - start).astype(np.uint64) << np.uint64(40)))
    ends = np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts)))
    return h, np.bincount(np.searchsorted(ends, start, side="right"), minlength=len(texts))


def gram_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` consecutive values of ``h`` (order matters)."""
    if len(h) < n:
        return np.zeros(0, np.uint64)
    m = len(h) - n + 1
    acc = np.zeros(m, np.uint64)
    for j in range(n):
        acc = acc * _BASE + h[j:j + m]
    return mix64(acc)
