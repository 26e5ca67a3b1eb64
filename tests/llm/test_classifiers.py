import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkmart.llm import language_id, toxicity
from sparkmart.llm.queries import QUERIES, learn
from tests.llm import helpers as H

SF = "/root/testdata/sf0.01"


def out(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


def test_language_held_out_accuracy_and_folds(spark):
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").collect()}
    got = QUERIES["op5_language_id"].build(spark, SF).collect()
    assert len(got) == len(lang) and all(r["held_out"] == out(r["doc_id"]) and 0 <= r["score"] <= 1 for r in got)
    held = [r["lang_pred"] == lang[r["doc_id"]] for r in got if r["held_out"]]
    assert np.mean(held) >= 0.97


def test_language_cases(spark):
    rows = [(i, "the thing and the other thing with that", "en") for i in range(40)]
    rows += [(100 + i, "der die das und nicht mit einer schönen", "de") for i in range(40)]
    rows += [(200, None, "en"), (201, "", None), (202, "12 -- 34\n", "en"), (203, "und " * 400_000, None), (204, "½ ٣", None)]
    df = H.docs(spark, rows, "doc_id bigint, text string, lang string").selectExpr("*", "'x' as lang_pred", "1 as score")
    model = language_id.fit(df)
    got = {r["doc_id"]: r for r in language_id.predict(df, model).collect()}
    assert got[0]["lang_pred"] == "en" and got[100]["lang_pred"] == got[203]["lang_pred"] == "de"
    assert all(got[i]["lang_pred"] == "und" and got[i]["score"] == 0 and got[i]["rejected"] for i in (200, 201, 202, 204))
    none = language_id.fit(df.where("false"))
    assert none is None
    assert {r["lang_pred"] for r in language_id.predict(df, none).collect()} == {"und"}


def test_language_learns_every_label_and_null_rows_of_an_id(spark):
    rows = [(1, "some english words here", "en"), (1, "some english words here", None), (1, None, "en")] * 3
    rows += [(10 + i, f"zyx{i % 150:03d}qw " * 6, f"l{i % 150:03d}") for i in range(1500)]
    df = H.docs(spark, rows, "doc_id bigint, text string, lang string")
    model = language_id.fit(df, per_lang=5)
    assert model.langs == ["en"] + [f"l{i:03d}" for i in range(150)]
    assert len(language_id.fit(df, per_lang=500, most=151).langs) == 151
    picked = language_id.sample_rows(df.selectExpr("text", "lang AS label"), F.xxhash64("text"), F.lit(4), 10 ** 6)
    assert picked.groupBy("label").count().agg(F.max("count")).first()[0] <= 4
    assert {r["doc_id"] for r in language_id.predict(df, model).collect()} == {r[0] for r in rows}


def test_language_scores_do_not_depend_on_blocks():
    rng = np.random.default_rng(1)
    m = language_id.Model(["a", "b"], rng.normal(size=(language_id.BUCKETS, 2)).astype(np.float32), np.zeros(2), 1.0, 0.5)
    texts = ["ab cd", "x" * 3_000_000 + " yz", "", "ab cd"]
    p = language_id.score_texts(m, texts)
    assert np.allclose(p, language_id.score_texts(m, texts, block=5000), atol=1e-9)
    for i, t in enumerate(texts):
        idx, wt = language_id.features(t)
        z = (m.table[idx] * wt[:, None]).sum(0)
        want = np.exp(z - z.max()) / np.exp(z - z.max()).sum()
        assert np.allclose(p[i], want, atol=1e-3)


def test_toxicity_held_out_ranking(spark):
    toxic = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    got = QUERIES["op7_toxicity"].build(spark, SF).collect()
    assert all(r["held_out"] == out(r["doc_id"]) and r["predicted"] == int(r["score"] >= 0.5) for r in got)
    held = [(r["score"], toxic[r["doc_id"]]) for r in got if r["held_out"] and r["doc_id"] in toxic]
    pos, neg = [s for s, y in held if y], [s for s, y in held if not y]
    assert np.mean([p > n for p in pos for n in neg]) >= 0.9


@pytest.fixture(scope="module")
def small(spark):
    rows, labels = [], []
    for i in range(200):
        bad = i % 4 == 0
        rows.append((i, f"a calm line {i % 7}. " + ("you utter wretch! " if bad else "we like tea! ") + "the end of it"))
        labels.append((i, int(bad)))
    df = H.docs(spark, rows + [(900, None), (901, ""), (902, " .!? ")])
    return df, H.docs(spark, labels + [(0, 1), (None, 1), (5, None)], "doc_id bigint, toxic int")


def test_toxicity_held_out_rates_and_long_clean_texts(spark):
    """Held-out toxic documents found, clean ones left alone, and no clean text called toxic for its length."""
    d = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    model = toxicity.fit(docs, labels, eligible=learn())
    rows = docs.join(labels, "doc_id").where(~learn()).select("doc_id", "text", "toxic").collect()
    score = {r["doc_id"]: toxicity.document_score(model, [], r["text"])[0] for r in rows}
    assert np.mean([score[r["doc_id"]] >= 0.5 for r in rows if r["toxic"]]) >= 0.6      # a constant answer has 0 or fails below
    clean = [r for r in rows if not r["toxic"]]
    assert np.mean([score[r["doc_id"]] >= 0.5 for r in clean]) <= 0.02
    quiet = [r["text"] for r in clean if score[r["doc_id"]] < 0.2]
    for n in (100, 300, len(quiet)):
        assert toxicity.document_score(model, [], "\n".join(quiet[:n]))[0] < 0.5
    line = max(quiet[:50], key=len).split(".")[0] + ". "
    assert toxicity.document_score(model, [], line * 20_000)[0] < 0.5
    worst = max(rows, key=lambda r: score[r["doc_id"]])["text"]
    assert toxicity.document_score(model, [], quiet[0] + "\n" + worst)[0] >= 0.5


def test_toxicity_takes_rows_of_one_id_and_very_long_texts(spark, small):
    df, labels = small
    many = df.unionAll(df.where("doc_id = 4")).unionAll(H.docs(spark, [(7, "a calm line. " * 50_000), (7, None)]))
    model = toxicity.fit(many, labels, per_class=20, most_sentences=50)
    got = toxicity.score(many, model)
    assert got.where("doc_id = 4").count() == 2 and got.where("doc_id = 7").agg(F.max("score")).first()[0] < 0.5


def test_toxicity_locates_the_sentence(spark, small):
    df, labels = small
    model = toxicity.fit(df, labels, eligible=learn())
    got = {r["doc_id"]: r for r in toxicity.score(df, model).collect()}
    text = {r["doc_id"]: r["text"] for r in df.collect()}
    assert all(got[i]["predicted"] == int(i % 4 == 0) for i in range(200))
    spans = got[4]["offending"]
    assert [text[4][s["start"]:s["end"]].strip() for s in spans] == ["you utter wretch"]
    assert all(got[i]["score"] == 0 and got[i]["offending"] == [] for i in (900, 901, 902))
    kept = toxicity.keep_clean(df.selectExpr("*", "1 as score"), model)
    assert kept.columns == ["doc_id", "text", "score"] and sorted(r[0] for r in kept.collect()) == [
        i for i in [*range(200), 900, 901, 902] if i >= 900 or i % 4]


def test_toxicity_without_labels(spark, small):
    df, labels = small
    model = toxicity.fit(df, labels.where("false"))
    assert model is None
    assert {(r["score"], r["predicted"]) for r in toxicity.score(df, model).collect()} == {(0.0, 0)}
    assert toxicity.score(df.where("false"), model).collect() == []
