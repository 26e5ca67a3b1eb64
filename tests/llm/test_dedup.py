import hashlib
import random

from sparkmart.llm import jaccard_join, substring_dedup
from tests.llm import helpers as H


def _check_substrings(spark, texts, window, gram, extra=None):
    rows = [(i, t) for i, t in enumerate(texts)]
    got = {r["doc_id"]: r for r in substring_dedup.dedup(H.docs(spark, rows), window=window, gram=gram).collect()}
    gone = H.repeats(texts, window)
    for i, t in enumerate(texts):
        w = H.words(t)
        kept = [x for j, x in enumerate(w) if j not in gone[i]]
        assert (got[i]["n_words"], got[i]["n_removed"]) == (len(w), len(gone[i])), (i, t)
        assert got[i]["kept_sha256"] == hashlib.sha256(b" ".join(kept)).hexdigest()


def test_substrings_equal_brute_force_on_random_texts(spark):
    texts = H.random_texts(1, 60, "abc", 0, 40) + ["a " * 50, "a " * 49 + "b", None, "", " \t\n", "a b c", "a b c"]
    _check_substrings(spark, texts, window=6, gram=3)


def test_substrings_at_the_production_window(spark):
    rng = random.Random(2)
    vocab = [f"w{i}" for i in range(3000)]
    passage = [rng.choice(vocab) for _ in range(60)]
    texts = []
    for i in range(30):
        t = [rng.choice(vocab) for _ in range(rng.randrange(20, 150))]
        if i % 2:
            a = rng.randrange(0, 20)
            t[10:10] = passage[a:]
        texts.append(" ".join(t))
    texts += ["x " * 200, " ".join(passage[:34]), " ".join(passage[:35]), " ".join(passage)]
    _check_substrings(spark, texts, window=35, gram=substring_dedup.GRAM)


def test_a_hot_anchor_is_split_and_loses_nothing(spark):
    rng = random.Random(3)
    vocab = [f"w{i}" for i in range(40)]
    common = "one two three four five six seven eight"
    texts = [" ".join([rng.choice(vocab), common, rng.choice(vocab), rng.choice(vocab)]) for _ in range(300)]
    rows = [(i, t) for i, t in enumerate(texts)]
    d = substring_dedup._documents(H.docs(spark, rows), "doc_id", "text")
    key = {r["row_key"]: r["doc_id"] for r in d.collect()}
    spans = substring_dedup.duplicate_spans(d, window=9, gram=4, per_bucket=16).collect()
    got = {key[r["row_key"]]: {j for s in r["spans"] for j in range(s["start"], s["start"] + s["length"])} for r in spans}
    for i, gone in enumerate(H.repeats(texts, 9)):
        assert got.get(i, set()) == gone


def test_substring_rows_given_twice_nulls_and_clashing_columns(spark):
    t = " ".join(f"u{i}" for i in range(50))
    rows = [(1, t, "x", 5), (1, t, "x", 5), (2, None, None, None), (None, "k " + t[:30], "y", 1)]
    df = H.docs(spark, rows, "doc_id bigint, text string, row_key string, spans int")
    got = sorted(substring_dedup.dedup(df).select("doc_id", "n_words", "n_removed").collect(), key=str)
    assert [tuple(r) for r in got] == [(1, 50, 0), (1, 50, 0), (2, 0, 0), (None, 11, 0)]
    kept = substring_dedup.strip_repeats(df)
    assert kept.columns == df.columns and sorted(map(tuple, kept.collect()), key=str) == sorted(rows, key=str)
    assert substring_dedup.dedup(H.docs(spark, [])).collect() == []


def test_strip_repeats_cuts_only_what_repeats(spark):
    p = " ".join(f"p{i}" for i in range(40))
    df = H.docs(spark, [(1, f"a  b\n{p}"), (2, f"{p} c"), (3, "left  as\tit is")])
    got = {r["doc_id"]: r["text"] for r in substring_dedup.strip_repeats(df).collect()}
    assert got == {1: "a b", 2: "c", 3: "left  as\tit is"}


def _near(seed, n_base=6, copies=5):
    rng = random.Random(seed)
    vocab = [f"v{i}" for i in range(500)]
    out = []
    for _ in range(n_base):
        base = [rng.choice(vocab) for _ in range(rng.randrange(60, 120))]
        for _ in range(copies):
            t = list(base)
            for _ in range(rng.randrange(0, 4)):
                t[rng.randrange(len(t))] = rng.choice(vocab)
            out.append(" ".join(t))
    return out


def _check_join(spark, texts, **options):
    rows = [(i, t) for i, t in enumerate(texts)]
    got = {r["doc_id"]: r for r in jaccard_join.join(H.docs(spark, rows), **options).collect()}
    sets = [H.grams(t) for t in texts]
    links = [(i, j) for i in range(len(texts)) for j in range(i) if H.jaccard(sets[i], sets[j]) >= 0.8 - 1e-9]
    top = H.classes(range(len(texts)), links)
    for i in range(len(texts)):
        assert got[i]["class_id"] == top[i]
        assert got[i]["n_links"] == sum(i in x for x in links)
        assert got[i]["n_copies"] == sum(s == sets[i] for s in sets)


def test_join_equals_brute_force(spark):
    texts = _near(5) + ["", None, " \n", "one two", "one  two", "one two three four five six"]
    _check_join(spark, texts)


def test_join_in_small_blocks_equals_brute_force(spark):
    _check_join(spark, _near(6, n_base=2, copies=20), block=4)


def test_join_repeated_rows_and_empty_table(spark):
    t = " ".join(f"z{i}" for i in range(30))
    df = H.docs(spark, [(4, t, 1), (4, t, 1), (2, t + " end", 0)], "doc_id bigint, text string, label int")
    got = sorted(map(tuple, jaccard_join.join(df).select("doc_id", "class_id", "n_links").collect()))
    assert got == [(2, 2, 1), (4, 2, 1), (4, 2, 1)]
    kept = jaccard_join.keep_one(df)
    assert kept.columns == df.columns and [r["doc_id"] for r in kept.collect()] == [2]
    assert jaccard_join.join(H.docs(spark, [])).collect() == []


def test_banding_meets_its_recall():
    for threshold, recall in ((0.8, 0.999), (0.9, 0.99), (0.5, 0.95)):
        b, r = jaccard_join.banding(threshold, recall)
        assert 1 - (1 - threshold ** r) ** b >= recall
