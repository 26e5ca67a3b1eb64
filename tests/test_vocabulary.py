import math
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from sparkmart.plans import classify as C
from sparkmart.plans import text_features as TF

TEXTS = ["fresh apple apple pie", "apple pie", "Fresh pear", "", None, "pear pear pear tart", "tart"]


def char_grams(s, lo, hi):
    return [s[i:i + n] for n in range(lo, hi + 1) for i in range(len(s) - n + 1)]


def test_vocabulary_is_exact_bounded_and_ordered(spark):
    df = spark.createDataFrame([(t.split() if t is not None else None,) for t in TEXTS], "t array<string>")
    rows = [t.split() for t in TEXTS if t is not None]
    cf, seen = Counter(w for r in rows for w in r), Counter(w for r in rows for w in set(r))
    for max_terms, min_df in ((100, 1), (3, 1), (100, 2), (2, 2)):
        want = sorted((w for w in cf if seen[w] >= min_df), key=lambda w: (-cf[w], w))[:max_terms]
        got = TF.vocabulary(df, "t", max_terms, min_df).collect()
        assert [tuple(r) for r in got] == [(w, cf[w], seen[w]) for w in want]
    assert TF.vocabulary(df.where("false"), "t").isEmpty()


def test_char_tfidf_weights_equal_the_formula(spark):
    texts = {i: t.lower() for i, t in enumerate(TEXTS) if t}
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "id int, text string")
    tf = {i: Counter(char_grams(t, 2, 3)) for i, t in texts.items()}
    seen, cf = Counter(g for c in tf.values() for g in c), sum(tf.values(), Counter())
    vocab = sorted((g for g in seen if seen[g] >= 2), key=lambda g: (-cf[g], g))[:9]
    got = TF.tfidf(TF.char_terms(df, "id", "text", (2, 3)), "id", F.lit(len(TEXTS)), 2, 9).collect()
    want = {}
    for i, c in tf.items():
        raw = {g: c[g] * (math.log((1 + len(TEXTS)) / (1 + seen[g])) + 1) for g in vocab if g in c}
        norm = math.sqrt(sum(x * x for x in raw.values()))
        want.update({(i, g): x / norm for g, x in raw.items()})
    assert {(r["id"], r["term"]) for r in got} == set(want)
    assert all(abs(r["weight"] - want[r["id"], r["term"]]) < 1e-12 for r in got)


def test_model_features_are_places_in_the_vocabularies_of_the_fitted_rows(spark):
    config = C.ModelConfig("m", (2, 3), 1, 1, ("apple",), ("pear",), max_terms=7)
    df = spark.createDataFrame([(i, t or "", i % 2 == 0) for i, t in enumerate(TEXTS)], "id int, norm_text string, fit boolean")
    pipe, out = C.vectorise(df, config, fit_on=F.col("fit"))
    vocabs = [s.vocabulary for s in pipe.stages if hasattr(s, "vocabulary")]
    assert sorted(vocabs[0]) == ["apple", "apple apple", "apple pie", "fresh", "fresh apple", "fresh pear", "pear"] and len(vocabs[1]) == 7
    for r in out.collect():
        x = r["features"].toArray()
        assert len(x) == 14 + 8
        words = r["norm_text"].lower().split()
        terms = words + [f"{a} {b}" for a, b in zip(words, words[1:])]
        assert {vocabs[0][i] for i in np.flatnonzero(x[:7])} == set(vocabs[0]) & set(terms)
        assert {vocabs[1][i] for i in np.flatnonzero(x[7:14])} == set(vocabs[1]) & set(char_grams(r["norm_text"].lower(), 2, 3))
        assert np.linalg.norm(x[:7]) == 0 or abs(np.linalg.norm(x[:7]) - 1) < 1e-9


def test_tfidf_of_a_large_vocabulary_joins_nothing_and_equals_the_small_one(spark, monkeypatch):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS * 3)] + [(0, "apple tart"), (None, "pear pie")], "id int, text string")

    def weights():
        return TF.tfidf(TF.word_terms(df, "id", "text", (1, 2)), "id", F.lit(len(TEXTS) * 3 + 2), 2)

    small = {tuple(r)[:4]: tuple(r)[4:] for r in weights().collect()}
    monkeypatch.setattr(TF, "BROADCAST_TERMS", 3)
    large = weights()
    got = {tuple(r)[:4]: tuple(r)[4:] for r in large.collect()}
    assert len(small) > 20 and got.keys() == small.keys()
    assert all(math.isclose(x, y, rel_tol=1e-12) for k in got for x, y in zip(got[k], small[k]))
    assert "Join" not in large._jdf.queryExecution().optimizedPlan().toString()
