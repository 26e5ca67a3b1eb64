import math
import random
from collections import Counter

import numpy as np

from pyspark.sql import functions as F

from sparkmart.llm import elias_fano, mtree_search, ngram_lm, quote_linking
from sparkmart.llm.queries import QUERIES
from tests.llm import helpers as H

VEC = "vec_id bigint, embedding array<double>"


def brute_top(rows, k, is_query, scale=256):
    vs = sorted({(i, tuple(math.floor(scale * x) for x in v)) for i, v in rows
                 if i is not None and v and all(x is not None and math.isfinite(x) for x in v)})
    out = {}
    for q, v in vs:
        if is_query(q):
            best = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in vs if i != q)[:k]
            out[q] = [(r + 1, i, -s) for r, (s, i) in enumerate(best)]
    return out


def _search(spark, rows, k=5, mod=7, **options):
    df = H.docs(spark, rows, VEC).selectExpr("*", "0 as score", "'q' as node")
    got = {}
    for r in mtree_search.search(df, F.col("vec_id") % mod == 0, k, **options).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    return {q: sorted(v) for q, v in got.items()}


def test_search_is_exact_with_ties_copies_and_bad_vectors(spark):
    rng = np.random.default_rng(2)
    centre = rng.normal(size=(6, 8))
    rows = [(i, (centre[i % 6] + rng.normal(size=8) * 0.2).tolist()) for i in range(400)]
    rows += [(400 + i, rows[7][1]) for i in range(60)] + [rows[14], rows[14]]
    rows += [(700, None), (707, [float("nan")] * 8), (714, [None] + [0.1] * 7), (721, []), (728, [float("inf")] + [0.0] * 7),
             (735, [0.0] * 8), (None, [1.0] * 8), (742, [0.5, 0.5])]
    want = {q: v for q, v in brute_top(rows, 5, lambda q: q % 7 == 0).items()}
    assert _search(spark, rows) == want
    assert _search(spark, rows, block=32) == want


def test_search_with_few_rows(spark):
    assert _search(spark, []) == {}
    assert _search(spark, [(7, [1.0, 0.0])]) == {}
    rows = [(7, [1.0, 0.0]), (8, [0.5, 0.5]), (14, [0.0, -1.0])]
    assert _search(spark, rows) == brute_top(rows, 5, lambda q: q % 7 == 0)


def test_search_takes_large_components_exactly(spark):
    rng = np.random.default_rng(12)
    small = [(i, rng.normal(size=4).tolist()) for i in range(60)]
    large = [(100 + i, (rng.normal(size=4) * 3e6).tolist()) for i in range(40)]
    close = [(200 + i, [1e6 + i / 256, 8e5, -7e5, 1e4]) for i in range(30)]      # products differ far below float precision
    assert _search(spark, small + large) == brute_top(small + large, 5, lambda q: q % 7 == 0)
    assert _search(spark, small + close, block=16) == brute_top(small + close, 5, lambda q: q % 7 == 0)
    huge = _search(spark, [(7, [1e200, 0.0]), (8, [1e200, 1.0]), (9, [1e308, 1.0]), (14, [-1.0, 0.0])])
    assert huge[7] == [(1, 8, 2 ** 63 - 1), (2, 14, -2 ** 63)] and 9 not in {v for q in huge.values() for _, v, _ in q}


def test_pages_are_skipped_by_the_stored_bounds():
    rng = np.random.default_rng(3)
    x = np.floor(np.concatenate([rng.normal(c * 40, 1, (200, 6)) for c in range(8)]) * 8)
    top = float((x * x).sum(1).max())
    block = mtree_search.Block(np.arange(len(x)), x, top, page=64)
    seen = []
    block.pages = [Seen(p, seen) for p in block.pages]
    q = x[-1]
    d = mtree_search._distance(np.append(q, 0)[None], block.router)[0]
    best = block.search(-1, q, 5, None, d)
    score = x @ q
    assert best == sorted((-int(s), i) for i, s in enumerate(score))[:5]
    assert 0 < len(seen) < len(block.pages)


class Seen(np.ndarray):
    def __new__(cls, a, seen):
        out = np.asarray(a).view(cls)
        out.seen = seen
        return out

    def __array_finalize__(self, a):
        self.seen = getattr(a, "seen", None)

    def __len__(self):
        if self.seen is not None and id(self) not in self.seen:
            self.seen.append(id(self))
        return super().__len__()


def test_quotes_are_linked_to_their_originals(spark):
    rows = [
        (1, 0, "user", "Where is the station?\n\nI have luggage."),
        (1, 1, "assistant", "> where is  the STATION?\nDown the road."),
        (1, 2, "user", "A new topic"),
        (1, 3, "user", "On Monday, Ann wrote:\n> Down the road.\n>> Where is the station?\nThanks!"),
        (1, 4, "assistant", "> never said\nWhat?"),
        (1, 5, "assistant", "> A new topic\n> and more\nFine."),
        (2, 0, "user", "Down the road."),
        (2, 1, "user", "> Where is the station?\nother conversation"),
        (3, 0, "user", None), (3, 1, "user", ""), (3, 1, "user", ""), (None, 1, "user", "> x"), (4, None, "user", "x"),
        (5, 0, "user", "> self\nself"),
    ]
    df = H.docs(spark, rows, "conv_id bigint, turn bigint, role string, text string").selectExpr("*", "1 as thread", "2 as own")
    got = [tuple(r) for r in quote_linking.link(df).collect()]
    by = {(r[0], r[1]): r[3:] for r in got}
    assert len(got) == len(rows)
    assert by[1, 0] == (None, 0, 0, 0, "Where is the station?\n\nI have luggage.")
    assert by[1, 1] == (0, 0, 1, 1, "Down the road.")
    assert by[1, 3] == (1, 0, 2, 2, "Thanks!")
    assert by[1, 4] == (None, 4, 1, 0, "What?")
    assert by[1, 5] == (2, 2, 1, 1, "Fine.")
    assert by[2, 1][0] is None and by[3, 0] == (None, 0, 0, 0, "") and by[5, 0][0] is None
    assert by[None, 1][0] is None and by[4, None] == (None, None, 0, 0, "x")
    order = sorted((r for r in got if r[0] == 1), key=lambda r: (r[4], r[1]))
    assert [r[1] for r in order] == [0, 1, 3, 2, 5, 4]
    ordered = quote_linking.render(quote_linking.in_order(quote_linking.link(df))).collect()
    assert len(ordered) == len(rows)
    place = sorted((r["conv_id"], r["position"], r["turn"]) for r in ordered if r["position"])
    assert place == [(1, 1, 0), (1, 2, 1), (1, 3, 3), (1, 4, 2), (1, 5, 5), (1, 6, 4), (2, 1, 0), (2, 2, 1), (3, 1, 0), (3, 2, 1), (3, 3, 1),
                     (5, 1, 0)]
    assert sorted((r["conv_id"] or 0, r["turn"] or 0) for r in ordered if r["position"] is None) == [(0, 1), (4, 0)]
    chat = "\n".join(r["chat"] for r in sorted((r for r in ordered if r["conv_id"] == 1), key=lambda r: r["position"])[1:3])
    assert chat == "<|assistant|>\nDown the road.\n<|end|>\n<|user|>\nThanks!\n<|end|>"
    assert quote_linking.link(df.where("false")).collect() == []
    assert quote_linking.in_order(quote_linking.link(df.where("false"))).collect() == []


def test_elias_fano_access_and_search():
    rng = np.random.default_rng(1)
    for n, u in ((0, 1), (1, 2**64 - 1), (9, 3), (3000, 40), (3000, 2**64 - 1), (5000, 6000)):
        v = np.sort(rng.integers(0, u, n, dtype=np.uint64, endpoint=True))
        s = elias_fano.Sequence(np.frombuffer(elias_fano.encode(v), np.uint64))
        assert (s.access(np.arange(n)) == v).all()
        q = np.concatenate([v, rng.integers(0, u, 500, dtype=np.uint64, endpoint=True), np.array([0, u], np.uint64)])
        first = {}
        for i, x in enumerate(v.tolist()):
            first.setdefault(x, i)
        assert s.find(q).tolist() == [first.get(x, -1) for x in q.tolist()]
        lo = rng.integers(0, n + 1, len(q))
        hi = np.minimum(n, lo + rng.integers(0, 40, len(q)))
        for x, a, b, i in zip(q.tolist(), lo.tolist(), hi.tolist(), s.find_between(q, lo, hi).tolist()):
            assert (a <= i < b and v[i] == x) if i >= 0 else x not in v[a:b].tolist()


def _tokens(t):
    return [*(w.lower() for w in (t or "").encode().split()), None]


def test_lm_equals_brute_force(spark):
    texts = H.random_texts(5, 40, ["a", "B", "b", "É", "é", "c."], 0, 15) + [None, "", "unseen words", "a a a a"]
    train = [i for i in range(len(texts)) if i % 3]
    rows = [(i, t) for i, t in enumerate(texts)]
    df = H.docs(spark, rows).selectExpr("*", "'n' as score")
    mu, mu3 = 3.0, 2.0
    model = ngram_lm.build(df.where("doc_id % 3 <> 0"), mu=mu, mu3=mu3, shards=5, split=4)     # frequent contexts have several parts
    assert any(key % ngram_lm.PARTS for key in model.triples)
    c = Counter(w for i in train for w in _tokens(texts[i]))
    pair = Counter(p for i in train for p in zip([0, *_tokens(texts[i])], _tokens(texts[i])))
    three = Counter(p for i in train for p in zip([0, *_tokens(texts[i])], _tokens(texts[i]), _tokens(texts[i])[1:]))
    total, size = sum(c.values()), len(c)

    def prior(w):
        return (c[w] + 1) / (total + size + 1)

    def two(u, v):
        cu = len(train) if u == 0 else c[u]
        return (pair[u, v] + mu * prior(v)) / (cu + mu) if cu else prior(v)

    for r in ngram_lm.score(df, model).collect():
        w = _tokens(texts[r["doc_id"]])
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(w), sum(c[x] > 0 for x in w), total)
        assert math.isclose(r["base_score"], sum(math.log10(prior(x)) for x in w), abs_tol=1e-9)
        s = math.log10(two(0, w[0]))
        for u, v, x in zip([0, *w], w, w[1:]):
            s += math.log10((three[u, v, x] + mu3 * two(v, x)) / (pair[u, v] + mu3))
        assert abs(r["score"] - s) < 8e-4 * len(w)


def test_lm_shards_hold_a_distribution(spark):
    texts = H.random_texts(6, 60, ["x", "y", "z", "w"], 1, 10)
    model = ngram_lm.build(H.docs(spark, list(enumerate(texts))), shards=3)
    words, successors, continuations = model.open()
    for u in range(model.size + 1):
        ids, logp = [], []
        for s in model.pairs:
            i, p = successors.successors(s, u)
            ids += i.tolist()
            logp += p.tolist()
        seen = set(ids)
        cu = ngram_lm._counts_of(words, np.array([u]), model.documents)[0]
        every = np.arange(model.size)
        rest = sum(words.prior(ngram_lm._counts_of(words, every))[[i for i in every if i not in seen]]) if len(seen) < model.size else 0
        unknown = 1 / (model.total + model.size + 1)
        if not ids:
            continue
        assert abs(sum(10.0 ** np.array(logp)) + model.mu / (cu + model.mu) * (rest + unknown) - 1) < 1e-3
        for v in ids:       # the third level: what the pair's followers leave is its share of the second one
            v, every = np.array([v]), np.arange(model.size)
            shard, place, _, share = successors.lookup(np.array([u]), v, np.array([cu]))
            w, three = continuations.successors(int(shard[0]) * ngram_lm.PARTS, int(place[0])) if shard[0] * ngram_lm.PARTS in model.triples else ([], [])
            if not len(w):
                continue        # the end of a text
            cv = ngram_lm._counts_of(words, v)[0]
            _, at, prob, _ = successors.lookup(np.repeat(v, model.size), every, np.full(model.size, cv))
            back = model.mu / (cv + model.mu)
            two = np.where(at >= 0, 10.0 ** (prob / -ngram_lm.QUANTUM), back * words.prior(ngram_lm._counts_of(words, every)))
            left = np.delete(two, w).sum() + back * unknown
            assert abs(sum(10.0 ** three) + 10.0 ** (share[0] / -ngram_lm.QUANTUM) * left - 1) < 3e-3


def test_lm_without_training_texts(spark):
    df = H.docs(spark, [(1, "a b"), (2, None)])
    got = {r["doc_id"]: tuple(r)[1:] for r in ngram_lm.score(df, ngram_lm.build(df.where("false"))).collect()}
    assert got == {1: (3, 0, 0, 0.0, 0.0), 2: (1, 0, 0, 0.0, 0.0)}
    assert ngram_lm.score(df.where("false"), ngram_lm.build(df)).collect() == []


def test_lm_beats_its_base_on_held_out_texts(spark):
    got = [r for r in QUERIES["op10_ngram_lm"].build(spark, "/root/testdata/sf0.01").collect() if r["held_out"]]
    assert sum(r["score"] for r in got) > sum(r["base_score"] for r in got)
