"""Byte-level BPE encoding and decoding (operator 8).

The tiktoken library with a local rank file encodes every whole text; long
texts are cut before a space that follows a non-space, where no match of the
pre-splitting pattern can span, so the ids equal those of the uncut text.
Decoding joins the ids' raw bytes.

Cases: a null text counts as empty (no ids, the digests of nothing); special
strings inside texts are ordinary text; repeated rows give repeated results; a
text without a safe boundary is encoded in one piece.
"""

from __future__ import annotations

import base64
import hashlib
import re

from pyspark.sql import DataFrame

from sparkmart.llm.common import id_text, map_arrow

CHUNK = 1 << 16
_SAFE = re.compile(r"(?<=\S) ")
_ENCODERS: dict[str, object] = {}


def safe_chunks(text: str, size: int = CHUNK):
    """``text`` in pieces of about ``size`` characters that end at safe boundaries."""
    at = 0
    while len(text) - at > size:
        cut = _SAFE.search(text, at + size)
        if cut is None:
            break
        yield text[at:cut.start()]
        at = cut.start()
    yield text[at:]


def read_ranks(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def encoder(ranks: bytes, pattern: str):
    """The library's encoder, built once per worker process."""
    key = hashlib.sha256(ranks + pattern.encode()).hexdigest()
    if key not in _ENCODERS:
        import tiktoken
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines()) if a}
        _ENCODERS[key] = tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=table, special_tokens={})
    return _ENCODERS[key]


def encode_text(enc, text: str) -> list[int]:
    if len(text) <= CHUNK:
        return enc.encode_ordinary(text)
    ids: list[int] = []
    for piece in safe_chunks(text):
        ids += enc.encode_ordinary(piece)
    return ids


def _mapper(df: DataFrame, rank_file: str, pattern: str, fields, schema: str) -> DataFrame:
    ranks = df.sparkSession.sparkContext.broadcast(read_ranks(rank_file))  # a vocabulary file: a fixed size

    def run(cols):
        enc = encoder(ranks.value, pattern)
        rows = [fields(enc, t) for t in cols["text"]]
        names = list(rows[0]) if rows else []
        return {"doc_id": cols["doc_id"], **{n: [r[n] for r in rows] for n in names}}

    return map_arrow(id_text(df), run, schema)


def encode(df: DataFrame, rank_file: str, pattern: str) -> DataFrame:
    """(doc_id, ids array<int>) for every row of ``df`` (doc_id bigint, text)."""
    return _mapper(df, rank_file, pattern, lambda enc, t: {"ids": encode_text(enc, t or "")},
                   "doc_id bigint, ids array<int>")


def decode(df: DataFrame, rank_file: str, pattern: str, ids_col: str = "ids") -> DataFrame:
    """(doc_id, data binary): the raw bytes of the ids; null ids give no bytes."""
    ranks = df.sparkSession.sparkContext.broadcast(read_ranks(rank_file))

    def run(cols):
        enc = encoder(ranks.value, pattern)
        return {"doc_id": cols["doc_id"], "data": [enc.decode_bytes(i) if i else b"" for i in cols["ids"]]}

    return map_arrow(df.select("doc_id", df[ids_col].alias("ids")), run, "doc_id bigint, data binary")


def round_trip(df: DataFrame, rank_file: str, pattern: str) -> DataFrame:
    """Encode and decode in one pass: (doc_id, n_tokens, ids_sha256,
    decoded_sha256, ok); ``ok``: the decoded bytes are the text's own."""
    def fields(enc, text):
        text = text or ""
        ids = encode_text(enc, text)
        data = enc.decode_bytes(ids)
        return {"n_tokens": len(ids), "ids_sha256": hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                "decoded_sha256": hashlib.sha256(data).hexdigest(), "ok": data == text.encode()}

    return _mapper(df, rank_file, pattern, fields,
                   "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string, ok boolean")


def encoded(df: DataFrame, rank_file: str, pattern: str) -> DataFrame:
    """(doc_id, ids, n_tokens, decoded_sha256): the ids, and the digest of the
    bytes that they decode to."""
    def fields(enc, text):
        ids = encode_text(enc, text or "")
        return {"ids": ids, "n_tokens": len(ids), "decoded_sha256": hashlib.sha256(enc.decode_bytes(ids)).hexdigest()}

    return _mapper(df, rank_file, pattern, fields, "doc_id bigint, ids array<int>, n_tokens bigint, decoded_sha256 string")
