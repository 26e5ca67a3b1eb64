import hashlib
import random

import public_tokenizers as P
import pytest

from sparkmart.llm import bpe, token_counts
from tests.llm import helpers as H

RANKS, MODEL = P.path("byte_bpe_multi_50k.tiktoken"), P.path("piece_bpe_32k.model")
PARTS = ["a", "the", "Th", " ", "  ", "▁", "\n", "\t", "\r", "é", "①", "<s>", "</s>", "<0x0A>", "\x00", "　", " ", "漢字",
         "🎉", ".", "́", "12", "'s", "'ll", "<|endoftext|>", "\x1c", "\x85"]


def fuzz(seed, n):
    rng = random.Random(seed)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randrange(0, 20))) for _ in range(n)]


@pytest.fixture(scope="module")
def enc():
    return bpe.encoder(bpe.read_ranks(RANKS), P.PATTERN)


def test_round_trip_equals_the_library(spark, enc):
    texts = [None, "", *fuzz(1, 300), "x" * 200_000, "word " * 40_000, " " * 100_000, "a\n \n" * 30_000]
    rows = [(i, t) for i, t in enumerate(texts)]
    df = H.docs(spark, rows)
    for r in bpe.round_trip(df, RANKS, P.PATTERN).collect():
        t = texts[r["doc_id"]] or ""
        ids = enc.encode_ordinary(t)
        assert r["n_tokens"] == len(ids) and r["ok"]
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(t.encode()).hexdigest()
    back = bpe.decode(bpe.encode(df, RANKS, P.PATTERN), RANKS, P.PATTERN)
    assert {r["doc_id"]: bytes(r["data"]).decode() for r in back.collect()} == {i: t or "" for i, t in rows}


def test_chunks_end_at_safe_boundaries(enc):
    for t in fuzz(2, 3000):
        pieces = list(bpe.safe_chunks(t, 5))
        assert "".join(pieces) == t
        assert sum((enc.encode_ordinary(p) for p in pieces), []) == enc.encode_ordinary(t)


def test_counts_equal_the_library(spark):
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    texts = [None, "", " ", *fuzz(3, 2000), "word " * 30_000, "\n" * 5000]
    df = H.docs(spark, [(i, t, -1) for i, t in enumerate(texts)], "doc_id bigint, text string, n_tokens int")
    for r in token_counts.token_counts(df, MODEL, limit=10).collect():
        t = texts[r["doc_id"]] or ""
        n = len(sp.encode(t))
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(t.encode()), n, n > 10), repr(t)
    assert token_counts.token_counts(H.docs(spark, []), MODEL).collect() == []


def test_the_proof_lists_whole_tokens_only():
    with open(MODEL, "rb") as f:
        c = token_counts.counter(f.read())
    assert c.facts["split"] and len(c.facts["whole"]) > 10_000
    assert all(len(c.sp.encode(w)) == 1 for w in list(c.facts["whole"])[:500])
