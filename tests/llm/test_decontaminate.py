import random
import re

from sparkmart.llm import decontaminate
from tests.llm import helpers as H

BENCH = "item_id bigint, text string"


def _norm(t):
    return [w for w in re.split(r"[^a-z0-9]+", (t or "").lower()) if w]


def _bag(w, k):
    return sorted(tuple(w[i:i + k]) for i in range(len(w) - k + 1))


def _similarity(a, b):
    from collections import Counter
    x, y = Counter(a), Counter(b)
    return sum((x & y).values()) / sum((x | y).values())


def brute(docs, items, threshold=0.8):
    out = {}
    for d, t in docs:
        w = _norm(t)
        for i, text in items:
            v = _norm(text)
            n, k = len(v), min(5, len(v))
            if not n:
                continue
            bag = _bag(v, k)
            best = max(((_similarity(_bag(w[s:s + n], k), bag), -s) for s in range(len(w) - n + 1)), default=(0, 0))
            if best[0] >= threshold - 1e-12:
                out[d, i] = (round(best[0], 9), -best[1])
    return out


def test_matches_equal_brute_force(spark):
    rng = random.Random(4)
    vocab = [f"t{i}" for i in range(80)]
    items = [(i, " ".join(rng.choice(vocab) for _ in range(n))) for i, n in enumerate((1, 3, 5, 9, 20, 37, 37, 59, 90))]
    items += [(50, None), (51, " ... "), (2, items[2][1])]
    docs = []
    for d in range(60):
        t = [rng.choice(vocab) for _ in range(rng.randrange(0, 120))]
        v = _norm(rng.choice(items[3:9])[1])
        if d % 3 == 0:
            t[len(t) // 2:len(t) // 2] = v
        if d % 3 == 1:      # near: an edit close to an end
            v[rng.choice([0, 1, -1])] = "changed"
            t[3:3] = v
        docs.append((d, ", ".join(t).upper() if d % 2 else " ".join(t)))
    docs += [(900, None), (901, ""), (902, items[5][1] + "\n" + items[5][1])]
    got = {(r["doc_id"], r["item_id"]): (round(r["similarity"], 9), r["start"])
           for r in decontaminate.matches(H.docs(spark, docs), H.docs(spark, items, BENCH)).collect()}
    want = brute(docs, items)
    assert len(want) > 40 and got == want


def test_clean_keeps_columns_rows_and_clean_documents(spark):
    item = " ".join(f"q{i}" for i in range(30))
    rows = [(1, "fine text", "a"), (1, "fine text", "a"), (2, f"x {item} y", "b"), (3, None, None), (None, item, "c")]
    df = H.docs(spark, rows, "doc_id bigint, text string, _words string")
    out = decontaminate.clean(df, H.docs(spark, [(1, item)], BENCH))
    assert out.columns == df.columns
    assert sorted(map(tuple, out.collect()), key=str) == sorted([rows[0], rows[1], rows[3]], key=str)


def test_empty_tables(spark):
    none, some = H.docs(spark, []), H.docs(spark, [(1, "a b c d e f")])
    assert decontaminate.matches(none, H.docs(spark, [(1, "a b c d e f")], BENCH)).collect() == []
    assert decontaminate.matches(some, H.docs(spark, [], BENCH)).collect() == []


def test_radius_keeps_pairs_at_the_threshold():
    assert 10 < decontaminate.radius(0.8, 0.999) < 24
    assert decontaminate.radius(1.0, 0.999) == 0


def whole(docs, items, threshold=0.8):
    """Like ``brute``, and a text shorter than the item is one window."""
    out = {}
    for d, t in docs:
        w = _norm(t)
        for i, text in items:
            v = _norm(text)
            n, k = len(v), min(5, len(v))
            if not n or len(w) < k:
                continue
            bag = _bag(v, k)
            best = max((_similarity(_bag(w[s:s + n], k), bag), -s) for s in range(max(len(w) - n, 0) + 1))
            if best[0] >= threshold - 1e-12:
                out[d, i] = (round(best[0], 9), -best[1], min(n, len(w)))
    return out


def _found(spark, docs, items):
    return {(r["doc_id"], r["item_id"]): (round(r["similarity"], 9), r["start"], r["n_words"])
            for r in decontaminate.matches(H.docs(spark, docs), H.docs(spark, items, BENCH)).collect()}


def test_documents_shorter_than_the_item(spark):
    items = [(n, " ".join(f"w{n}x{j}" for j in range(n))) for n in (2, 5, 6, 9, 15, 29, 60, 61)]
    docs = []
    for n, text in items:
        w = text.split()
        for cut in (1, 2, 3, 6, 11, 12, 13):
            if cut < n:
                docs += [(1000 * n + 10 * cut, " ".join(w[cut:])), (1000 * n + 10 * cut + 1, " ".join(w[:-cut])),
                         (1000 * n + 10 * cut + 2, " ".join(["new"] + w[1:n - cut]))]
    want = whole(docs, items)
    assert want[60010, 60] == (round(55 / 56, 9), 0, 59) and len(want) > 25
    assert _found(spark, docs, items) == want
    kept = decontaminate.clean(H.docs(spark, docs), H.docs(spark, items, BENCH)).select("doc_id").collect()
    assert {r[0] for r in kept} == {d for d, _ in docs} - {d for d, _ in want}


def test_items_whose_parts_are_in_another_order(spark):
    items = [(n, " ".join(f"w{n}x{j}" for j in range(n))) for n in (7, 40, 60, 61, 90)]
    items += [(100, " ".join(f"r{j % 30}" for j in range(80)))]     # a passage repeated within the item
    rng, docs = random.Random(9), []
    for n, text in items:
        w = text.split()
        for i in range(12):
            cuts = sorted(rng.sample(range(1, len(w)), rng.choice([1, 1, 2])))
            parts = [w[a:b] for a, b in zip([0] + cuts, cuts + [len(w)])]
            rng.shuffle(parts)
            v = [x for p in parts for x in p]
            if i % 3 == 0:
                v[rng.randrange(len(v))] = "changed"
            if i % 3 == 1:
                v.insert(rng.randrange(len(v)), "added")
            pad = [f"p{rng.randrange(50)}" for _ in range(rng.randrange(40) if i % 4 else 0)]
            docs.append((1000 * n + i, " ".join(pad + v + pad[:7])))
    w = items[2][1].split()
    docs.append((1, " ".join(["before"] * 20 + w[30:] + w[:30] + ["after"] * 20)))
    want = whole(docs, items)
    assert want[1, 60] == (round(52 / 60, 9), 20, 60) and len(want) > 40
    assert _found(spark, docs, items) == want
