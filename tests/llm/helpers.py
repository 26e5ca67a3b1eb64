"""Small frames and brute-force versions that the operators are held against."""

from __future__ import annotations

import random

SCHEMA = "doc_id bigint, text string"


def docs(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


def words(text):
    return (text or "").encode().split()


def random_texts(seed, n, alphabet, low, high):
    rng = random.Random(seed)
    return [" ".join(rng.choice(alphabet) for _ in range(rng.randrange(low, high))) for _ in range(n)]


def grams(text, n=5):
    w = words(text)
    return {tuple(w[i:i + n]) for i in range(max(len(w) - n, 0) + 1)} if w else set()


def jaccard(a, b):
    return 1.0 if not a and not b else len(a & b) / len(a | b)


def classes(ids, linked):
    """Least id of each id's component."""
    top = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a, b in linked:
            low = min(top[a], top[b])
            if top[a] != low or top[b] != low:
                top[a] = top[b] = low
                changed = True
    return top


def repeats(texts, window):
    """Per text: the places of its words that some window occurring twice covers."""
    at = {}
    ws = [words(t) for t in texts]
    for d, w in enumerate(ws):
        for i in range(len(w) - window + 1):
            at.setdefault(tuple(w[i:i + window]), []).append((d, i))
    out = [set() for _ in ws]
    for places in at.values():
        if len(places) > 1:
            for d, i in places:
                out[d].update(range(i, i + window))
    return out
