import random

import numpy as np
import xxhash

from sparkmart.llm import simhash_dedup
from tests.llm import helpers as H


def fingerprint(text):
    """Straight from the definition."""
    words = (text or "").translate({c: c + 32 for c in range(65, 91)}).encode().split()
    grams = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [b" ".join(words)] * bool(words)
    h = [xxhash.xxh64(g, seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def near(a, b):
    return (a ^ b).bit_count() <= 3


def check(spark, rows, **kw):
    got = simhash_dedup.dedup(H.docs(spark, rows), **kw).collect()
    fp = [fingerprint(t) for _, t in rows]
    top = H.classes(range(len(rows)), [(i, j) for i in range(len(rows)) for j in range(i) if near(fp[i], fp[j])])
    least = {}
    for i, (d, _) in enumerate(rows):
        least[top[i]] = min((x for x in (least.get(top[i]), d) if x is not None), default=None)
    want = [(d, f"{fp[i]:016x}", least[top[i]]) for i, (d, _) in enumerate(rows)]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    return {w[2] for w in want}


def variants(rng, words, n):
    return [" ".join(rng.choice(words) if rng.random() < 0.02 else w for w in words) for _ in range(n)]


def test_documents_equal_brute_force(spark):
    rng = random.Random(1)
    base = [[rng.choice([f"w{i}" for i in range(500)]) for _ in range(120)] for _ in range(6)]
    texts = [t for b in base for t in variants(rng, b, 25)] + H.random_texts(2, 60, "abcdef", 0, 9)
    texts += [texts[0]] * 5 + [None, "", " \t\n", "A", "a", "A b", "a\x0b  b", "x " * 40_000, "Été ÉTÉ été", texts[3].upper()]
    rows = list(enumerate(texts)) + [(0, texts[0]), (None, texts[30]), (None, "only here without an id")]
    assert len(check(spark, rows)) < len(rows) - 60
    check(spark, rows, block=8)


def test_every_layout_finds_every_link(spark):
    rng = random.Random(3)
    seeds = [rng.getrandbits(64) for _ in range(12)]
    seeds += [seeds[0] & ~0xFFFFFF | rng.getrandbits(24) for _ in range(12)]           # one hot partition value
    values = {s ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(0, 4))) for s in seeds for _ in range(12)} | {0, 1, 2 ** 64 - 1}
    ids = sorted(values)
    nodes = spark.createDataFrame([(simhash_dedup._signed(v), 1) for v in ids], "fp bigint, copies bigint")
    top = H.classes(ids, [(a, b) for a in ids for b in ids if a < b and near(a, b)])
    thirds = [[*range(0, 21)], [*range(21, 42)], [*range(42, 64)]]
    quarter = [[*range(i, i + 16)] for i in range(0, 64, 16)]
    for parts in (list(zip(quarter, [1, -1, 0, 0])), list(zip(thirds, [2, -1, 0]))):
        def fixed(sample, n, radius, parts=parts):
            return parts
        old, simhash_dedup.layout = simhash_dedup.layout, fixed
        try:
            got = {r["fp"] % 2 ** 64: r["root"] for r in simhash_dedup.classes(nodes, block=16).collect()}
        finally:
            simhash_dedup.layout = old
        for a in ids:
            for b in ids:
                assert (got.get(a, ("alone", a)) == got.get(b, ("alone", b))) == (top[a] == top[b]), (parts, a, b)


def test_layout_follows_the_principle_and_avoids_a_repeated_partition():
    rng = np.random.default_rng(5)
    plain = rng.integers(0, 2 ** 63, 500, dtype=np.uint64) * np.uint64(2) + rng.integers(0, 2, 500, dtype=np.uint64)
    tied = plain & ~np.uint64(0xFFFF) | np.where(plain >> np.uint64(63) > 0, np.uint64(0xFFFF), np.uint64(0))
    for sample in (plain, tied, plain[:1], plain[:0]):
        for n in (10, 10 ** 5, 10 ** 9):
            parts = simhash_dedup.layout(sample, n)
            assert sorted(b for g, _ in parts for b in g) == list(range(64))
            assert sum(t for _, t in parts) == 3 - len(parts) + 1 and min(t for _, t in parts) >= -1
    groups = simhash_dedup.bit_groups(tied, 4)
    assert any(set(range(16)) <= set(g) | {63} for g in groups)                         # the tied bits lie together
    assert simhash_dedup.allocate([[0, 5, 9], [0, 1, 2], [0, 7, 8]], 0) == (7, [0, 1, -1])


def test_empty_table_and_clashing_columns(spark):
    assert simhash_dedup.dedup(H.docs(spark, [])).collect() == []
    df = H.docs(spark, [(2, "a b c d", 1, "x"), (1, "a b c d", 2, "y")], "doc_id bigint, text string, fp int, component_id string")
    assert sorted(map(tuple, simhash_dedup.dedup(df).collect())) == [(i, f"{fingerprint('a b c d'):016x}", 1) for i in (1, 2)]
