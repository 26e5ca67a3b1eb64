"""Substring dedup by relative Lempel-Ziv parsing (operator 1).

A window of ``window`` consecutive words whose word sequence also starts
elsewhere (same document included) is a duplicate; every word covered by a
duplicate window is removed.

* Anchors. Every window names one of its word k-grams, the leftmost of least
  hash. Equal windows name the same k-gram at the same offset, so equal
  windows always meet under their anchor's hash and every window belongs to
  exactly one anchor occurrence.
* Reference blocks. For each anchor hash that occurs at two places or more,
  the passage around one occurrence is the reference block, indexed by the hash.
* Parsing. Every document is factored greedily against every reference block
  that it can share a window with: from an anchor the match is followed as far
  as the windows agree. A factor of ``window`` words or more is a duplicate
  span, of the document and of the block.
* Factor boundaries. Windows that straddle the end of a factor are not the
  block's; they can still equal windows of other documents with the same
  anchor. They are counted by content, across the corpus, and become duplicate
  where they occur twice.

An anchor that holds a large share of all rows is salted: its block goes to as
many buckets as its count asks for, so no task gets more than ``per_bucket``
occurrences of an anchor on average, and each occurrence is compared with one
block, never with all others. Windows are compared by 64-bit hashes within
their anchor (hash and offset are part of the comparison).

Cases: null and empty texts have no words (the digest of nothing); texts
shorter than a window stay whole; rows repeated under one id with one text are
one document given twice, not a second occurrence, and each gets its result;
extra columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.llm.common import gram_hashes, map_arrow, mix64, slices, word_hashes, written

GRAM = 8


def anchors_of(h: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchor hash, position, first window start, last window start) of each
    anchor occurrence in a document's word hashes."""
    none = np.zeros(0, np.int64)
    if len(h) < window:
        return np.zeros(0, np.uint64), none, none, none
    g = gram_hashes(h, gram)
    per = window - gram + 1
    view = np.lib.stride_tricks.sliding_window_view(g, per)
    pos = np.concatenate([view[at:at + 65536].argmin(1) for at in range(0, len(view), 65536)]) + np.arange(len(view))
    first = np.flatnonzero(np.diff(pos, prepend=-1))
    last = np.append(first[1:], len(pos)) - 1
    p = pos[first]
    return g[p], p, first, last


def _documents(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    d = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return d.withColumn("row_key", F.xxhash64("doc_id", "text"))


def _per_document(texts: list[str | None]) -> Iterator[np.ndarray]:
    h, n = word_hashes([(t or "").encode() for t in texts])
    at = 0
    for k in n.tolist():
        yield h[at:at + k]
        at += k


def find_anchors(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """(h, row_key, pos): all anchor occurrences of all documents."""
    schema = pa.schema([("h", pa.int64()), ("row_key", pa.int64()), ("pos", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 8 << 20):
                keys, texts = part.column(0).to_numpy(), part.column(1).to_pylist()
                hs, ks, ps = [], [], []
                for key, h in zip(keys, _per_document(texts)):
                    a, p, _, _ = anchors_of(h, window, gram)
                    hs.append(a)
                    ps.append(p.astype(np.int32))
                    ks.append(np.full(len(a), key, np.int64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(x)) for x in ([a.view(np.int64) for a in hs], ks, ps)], schema=schema)

    return docs.select("row_key", "text").mapInArrow(run, "h bigint, row_key bigint, pos int")


def _passages(found: DataFrame, window: int, gram: int, per_bucket: int) -> DataFrame:
    """The windows of each document's shared anchors: (h, bucket, row_key,
    place, wins). ``bucket`` is twice the salt, plus one unless the row is the
    reference block, which comes once per salt; ``place`` is the anchor's
    position * 512 + its distance from the first window * 2 + whether the
    anchor has more than two occurrences."""
    schema = pa.schema([("h", pa.int64()), ("bucket", pa.int32()), ("row_key", pa.int64()), ("place", pa.int64()),
                        ("wins", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 4 << 20):
                rows = []
                keys, texts, at = (part.column(i).to_pylist() for i in range(3))
                for key, h, here in zip(keys, _per_document(texts), at):
                    hashes, pos, first, last = anchors_of(h, window, gram)
                    w = gram_hashes(h, window)
                    i = np.searchsorted(pos, [a["pos"] for a in here])
                    salt = mix64(pos[i].astype(np.uint64) ^ np.array(key, np.int64).view(np.uint64)).tolist()
                    names = hashes.view(np.int64)[i].tolist()
                    for j, a, f, z, name, p in zip(salt, here, first[i].tolist(), last[i].tolist(), names, pos[i].tolist()):
                        salts = -(-a["n"] // per_bucket)
                        place = p * 512 + (p - f) * 2 + (a["n"] > 2)
                        wins = w[f:z + 1].tobytes()
                        if a["block"]:
                            rows += [(name, 2 * k, key, place, wins) for k in range(salts)]
                        else:
                            rows.append((name, 2 * (j % salts) + 1, key, place, wins))
                for lo in range(0, len(rows), 20_000):
                    yield _rows(rows[lo:lo + 20_000], schema)

    return found.select("row_key", "text", "at").mapInArrow(run, "h bigint, bucket int, row_key bigint, place bigint, wins binary")


def _parse(passages: DataFrame, window: int) -> DataFrame:
    """Factor each passage against its reference block, which precedes it in
    the partition's order: one pass, one block in memory. Factors come as
    (row_key, start, length), boundary windows also with (h, win)."""
    schema = pa.schema([("h", pa.int64()), ("win", pa.int64()), ("row_key", pa.int64()), ("start", pa.int32()), ("length", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, block = None, None          # the (anchor, salt) and its block: (row_key, position, low, windows)
        factors: set[tuple] = set()
        edges: list[tuple] = []
        for batch in batches:
            cols = [batch.column(i).to_pylist() for i in range(batch.num_columns)]
            for h, bucket, key, place, wins in zip(*cols):
                w = np.frombuffer(wins, np.int64)
                pos, low, more = place >> 9, -(place >> 1 & 255), place & 1   # low: of the first window, from the anchor
                if not bucket & 1:
                    group, block = (h, bucket), (key, pos, low, w)
                    continue
                same = np.zeros(len(w), bool)
                if group == (h, bucket - 1):
                    lo, hi = max(low, block[2]), min(low + len(w), block[2] + len(block[3]))
                    if lo < hi:
                        same[lo - low:hi - low] = w[lo - low:hi - low] == block[3][lo - block[2]:hi - block[2]]
                if same.all():
                    runs = [(0, len(w))]
                else:
                    edge = np.flatnonzero(np.diff(same, prepend=False, append=False)).tolist()
                    runs = list(zip(edge[0::2], edge[1::2]))
                    if more:               # else the block is the only other occurrence
                        edges += [(h, int(w[i]), key, pos + low + i, window) for i in np.flatnonzero(~same).tolist()]
                for a, b in runs:          # factors of window + (b - a - 1) words
                    factors.add((None, None, key, pos + low + a, window + b - a - 1))
                    factors.add((None, None, block[0], block[1] + low + a, window + b - a - 1))
            if len(factors) + len(edges) > 50_000:
                yield _rows([*factors, *edges], schema)
                factors, edges = set(), []
        if factors or edges:
            yield _rows([*factors, *edges], schema)

    return passages.mapInArrow(run, "h bigint, win bigint, row_key bigint, start int, length int")


def _rows(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def duplicate_spans(docs: DataFrame, window: int = 35, gram: int = GRAM, per_bucket: int = 512) -> DataFrame:
    """(row_key, spans array<struct<start,length>>) in words, for documents with any."""
    if window - gram > 255:
        raise ValueError("a window may be 255 words longer than its anchor")
    seen = find_anchors(docs, window, gram)
    here = F.xxhash64("row_key", "pos")
    shared = seen.groupBy("h").agg(F.count("*").cast("int").alias("n"), F.min(here).alias("block")).where("n > 1")
    at = seen.join(shared, "h").select("row_key", F.struct("pos", "n", (here == F.col("block")).alias("block")).alias("a"))
    at = at.groupBy("row_key").agg(F.collect_set("a").alias("at"))  # at most one entry per anchor of the document
    found = docs.join(at, "row_key").dropDuplicates(["row_key"])
    passages = _passages(found, window, gram, per_bucket).repartition("h", F.expr("bucket >> 1")).sortWithinPartitions("h", "bucket")
    parsed = written(_parse(passages, window), "factors")
    factors = parsed.where(F.col("h").isNull()).select("row_key", "start", "length")
    edges = parsed.where(F.col("h").isNotNull())
    twice = edges.groupBy("h", "win").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    again = edges.join(twice, ["h", "win"]).select("row_key", "start", "length")
    return factors.unionAll(again).groupBy("row_key").agg(F.collect_set(F.struct("start", "length")).alias("spans"))


def kept_words(text: str | None, starts, lengths) -> tuple[list[bytes], int]:
    """The words outside all spans, and the number of words of the text."""
    words = (text or "").encode().split()
    if starts is None or not len(starts):
        return words, len(words)
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, np.asarray(starts), 1)
    np.add.at(edge, np.asarray(starts) + np.asarray(lengths), -1)
    return [words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()], len(words)


def strip_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 35, gram: int = GRAM) -> DataFrame:
    """The rows of ``df``, all columns kept, without the words of duplicate
    spans: the words that stay are joined by one space; a text that loses
    nothing stays as it is."""
    spans = duplicate_spans(_documents(df, id_col, text_col), window, gram)
    spans = spans.select(F.col("row_key").alias("_key"), F.col("spans.start").alias("_starts"), F.col("spans.length").alias("_lengths"))

    def strip(texts: pd.Series, starts: pd.Series, lengths: pd.Series) -> pd.Series:
        out = []
        for t, a, b in zip(texts, starts, lengths):
            kept, n = kept_words(t, a, b)
            out.append(t if len(kept) == n else b" ".join(kept).decode())
        return pd.Series(out, dtype=object)

    udf = F.pandas_udf(strip, "string")
    keyed = df.withColumn("_key", F.xxhash64(F.col(id_col), F.col(text_col).cast("string"))).join(spans, "_key", "left")
    return keyed.withColumn(text_col, udf(F.col(text_col).cast("string"), "_starts", "_lengths")).select(*df.columns)


def dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 35, gram: int = GRAM,
          keep_text: bool = True) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256[, kept]): the words that stay,
    joined by one space; ``kept`` is the text itself where nothing goes."""
    docs = _documents(df, id_col, text_col)
    marked = docs.join(duplicate_spans(docs, window, gram), "row_key", "left")

    def run(cols):
        out = {"doc_id": cols["doc_id"], "n_words": [], "n_removed": [], "kept_sha256": [], "kept": []}
        for text, spans in zip(cols["text"], cols["spans"]):
            kept, n = kept_words(text, [x["start"] for x in spans or ()], [x["length"] for x in spans or ()])
            data = b" ".join(kept)
            out["n_words"].append(n)
            out["n_removed"].append(n - len(kept))
            out["kept_sha256"].append(hashlib.sha256(data).hexdigest())
            out["kept"].append(None if not keep_text else text if len(kept) == n else data.decode())
        return out

    got = map_arrow(marked.select("doc_id", "text", "spans"), run,
                    "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string, kept string")
    return got if keep_text else got.drop("kept")
