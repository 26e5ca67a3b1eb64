import random

import public_tokenizers as P

import corpus_pipeline
from sparkmart.llm import bpe
from tests.llm import helpers as H
from tests.llm.test_decontaminate import brute


def _corpus():
    rng = random.Random(8)
    vocab = [f"word{i}" for i in range(4000)]
    new = lambda n: [rng.choice(vocab) for _ in range(n)]
    docs, labels = [], []
    for i in range(120):
        bad = i % 3 == 0
        docs.append((i, " ".join(new(40)) + (". you utter wretch, awful fool. " if bad else ". a calm remark. ") + " ".join(new(20))))
        labels.append((i, int(bad)))
    base = new(90)
    for i in range(200, 206):                      # near copies
        t = list(base)
        t[i % 80] = f"edit{i}"
        docs.append((i, " ".join(t)))
    passage = new(55)
    for i in range(300, 304):                      # a passage that repeats
        docs.append((i, " ".join(new(60) + passage + new(60))))
    item = new(30)
    docs.append((400, " ".join(new(30) + item + new(30))))
    docs += [(500, None), (501, ""), (502, docs[-1][1])]
    rows = [(i, t, "en", "s", len(t) if t is not None else None) for i, t in docs]
    return rows, labels, [(1, " ".join(item)), (2, None)]


def test_stages_against_brute_force(spark, tmp_path):
    rows, labels, bench = _corpus()
    cols = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    H.docs(spark, rows, cols).write.parquet(f"{tmp_path}/documents.parquet")
    H.docs(spark, labels, "doc_id bigint, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    H.docs(spark, bench, "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    steps = dict(corpus_pipeline.STAGES)
    a = steps["toxicity"](spark, docs, str(tmp_path))
    assert a.columns == docs.columns
    left = {r["doc_id"]: r["text"] for r in a.collect()}
    assert sorted(left) == [i for i, *_ in rows if i >= 120 or i % 3]
    assert all(left[i] == t for i, t, *_ in rows if i in left)

    b = steps["ngram_jaccard_join"](spark, a, str(tmp_path))
    sets = {i: H.grams(t) for i, t in left.items()}
    links = [(i, j) for i in sets for j in sets if j < i and H.jaccard(sets[i], sets[j]) >= 0.8]
    top = H.classes(sorted(left), links)
    left = {r["doc_id"]: r["text"] for r in b.collect()}
    assert b.columns == docs.columns and sorted(left) == sorted(set(top.values())) and len(left) == len(top) - 5 - 1 - 1

    c = steps["substring_dedup"](spark, b, str(tmp_path))
    order = sorted(left)
    gone = dict(zip(order, H.repeats([left[i] for i in order], 35)))
    want = {i: " ".join(w for j, w in enumerate(left[i].split()) if j not in gone[i]) if gone[i] else left[i] for i in order}
    got = {r["doc_id"]: r for r in c.collect()}
    assert c.columns == docs.columns and {i: r["text"] for i, r in got.items()} == want
    assert sum(bool(g) for g in gone.values()) == 4
    assert all(r["n_chars"] == (None if r["text"] is None else len(r["text"])) for r in got.values())

    d = steps["benchmark_decontamination"](spark, c, str(tmp_path))
    found = {i for i, _ in brute(sorted(want.items()), bench)}
    left = {r["doc_id"]: r["text"] for r in d.collect()}
    assert d.columns == docs.columns and found == {400} and set(left) == set(want) - found

    enc = bpe.encoder(bpe.read_ranks(P.path("byte_bpe_multi_50k.tiktoken")), P.PATTERN)
    out = {r["doc_id"]: list(r["ids"]) for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert out == {i: enc.encode_ordinary(t or "") for i, t in left.items()}
