import math
import random
import re
from collections import Counter

import numpy as np

from sparkmart.llm import lexical_search
from tests.llm import helpers as H

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))


def brute(rows, items, k):
    """Straight from the formula: {item id: [(score, doc_id)]}."""
    docs = [(i, Counter(t), len(t)) for i, t in ((i, terms(x)) for i, x in rows if i is not None)]
    n_all, total = sum(n > 0 for _, _, n in docs), sum(n for _, _, n in docs)
    df = Counter(t for _, c, _ in docs for t in c)
    out = {}
    for item, text in set(items):
        got = []
        for i, c, n in docs:
            score = 0
            for t in terms(text):
                if c[t]:
                    w = math.floor(1000 * math.log((2 * n_all + 2) / (2 * df[t] + 1)))
                    score += w * ((10 ** 9 * c[t]) // (1000 * c[t] + 12 * (75 + 25 * n * n_all // total)))
            if score > 0:
                got.append((-score, i))
        out[item] = [(i, -s) for s, i in sorted(got)[:k]]
    return out


def check(spark, rows, items, k=5, **kw):
    got = lexical_search.search(H.docs(spark, rows), spark.createDataFrame(items, "item_id bigint, text string"), k=k, **kw)
    found = {}
    for r in sorted(got.collect(), key=lambda r: (r["item_id"], r["rank"])):
        found.setdefault(r["item_id"], []).append((r["doc_id"], r["score"]))
        assert r["rank"] == len(found[r["item_id"]])
    assert found == {i: x for i, x in brute(rows, items, k).items() if x}


def test_ranks_equal_brute_force_with_ties_repeats_and_unusual_texts(spark):
    vocab = [f"t{i}" for i in range(40)] + ["Été", "日本", "x1", "ß"]
    texts = H.random_texts(5, 300, vocab, 0, 60)
    rows = list(enumerate(texts)) + [(900 + i, texts[7]) for i in range(9)] + [(900, texts[7])]      # ties, a row given twice
    rows += [(1000, None), (1001, ""), (1002, "--- ..."), (None, texts[3]), (1003, "T1 t1-T1_t1\x00t1 " * 5000), (1004, "été Été")]
    items = list(enumerate(H.random_texts(6, 25, vocab, 1, 12)))
    items += [(50, None), (51, "!!"), (52, "nowhere"), (53, "t1 t1 t2 T1"), (53, "t1 t1 t2 T1"), (54, texts[7])]
    check(spark, rows, items)
    check(spark, rows, items, block_bytes=200)      # many blocks of items, the same result


def test_several_segments_carry_their_threshold(spark, monkeypatch):
    monkeypatch.setattr(lexical_search, "SEGMENT", 2000)
    vocab = [f"t{i}" for i in range(60)]
    rows = list(enumerate(H.random_texts(8, 400, vocab, 1, 50)))
    check(spark, rows, list(enumerate(H.random_texts(9, 15, vocab, 2, 10))), k=3)


def test_pair_bounds_hold_and_read_less_than_term_maxima():
    rng = random.Random(4)
    vocab = {b"t%d" % i: i for i in range(30)}
    seg_terms = [sorted(rng.sample(range(30), rng.randrange(1, 12))) for _ in range(3000)]
    key = np.array(sorted((t << 32) | d for d, ts in enumerate(seg_terms) for t in ts))
    named, starts = np.unique(key >> 32, return_index=True)
    cols = dict(docs=np.arange(3000), lengths=[len(t) for t in seg_terms], terms=named, starts=np.append(starts, len(key)),
                places=key & 0xFFFFFFFF, tf=[rng.randrange(1, 4) for _ in key])
    weights = np.array([100 * (i + 1) for i in range(30)])
    seg = lexical_search.Segment(cols, weights, 3000, int(sum(cols["lengths"])))
    with_pairs, without = [], []
    for _ in range(20):
        item = lexical_search._item(0, " ".join(f"t{i}" for i in rng.choices(range(30), k=10)), vocab, weights)
        for u in item.units:
            both, gain = seg.intersect(*u) if len(u) == 2 else ([], [])
            if len(both):
                seg.pairs[u] = (int(gain.max()), both)
        ids, scores = seg.search(item, 0)
        for u in item.units:      # no document gains more from a unit than its bound
            gain = np.zeros(3000, np.int64)
            for t in u:
                gain[seg.lists[t][0]] += item.counts[t] * seg.lists[t][1]
            assert gain.max() <= seg.bound(u, item.counts) <= seg.bound(u, item.counts, pairs=False)
        least = int(np.sort(scores)[-5])
        assert seg.start(item, 5) <= least
        a = seg.search(item, least, with_pairs)
        b = seg.search(item, least, without, pairs=False)
        assert sorted(a[0]) == sorted(b[0]) == sorted(ids[scores >= least])
    assert sum(with_pairs) < sum(without)


def test_empty_tables_and_clashing_columns(spark):
    empty = H.docs(spark, [])
    items = spark.createDataFrame([(1, "a b")], "item_id bigint, text string")
    assert lexical_search.search(empty, items).collect() == []
    full = H.docs(spark, [(1, "a b", 9, "x"), (2, "b", 8, "y")], "doc_id bigint, text string, item int, score string")
    assert lexical_search.search(full, items.limit(0)).collect() == []
    got = lexical_search.search(full, items.selectExpr("*", "1 AS doc_id", "2 AS rank")).orderBy("rank").collect()
    assert [r["doc_id"] for r in got] == [1, 2] and got[0].asDict().keys() == {"item_id", "rank", "doc_id", "score"}
