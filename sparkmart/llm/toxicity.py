"""Toxicity by multiple-instance learning (operator 7).

A text is a bag of sentences. A sentence's probability is a logistic function
of its hashed words; the document's is their noisy-or, 1 - prod(1 - p). Only
document labels are known, so the gradient of the document's loss is passed
through the noisy-or to the sentences; the fitted sentence scores then locate
the offending sentences.

A score must not rise with a clean text's length: in scoring, only what a
sentence's probability has over ``FLOOR`` counts, and twice the evidence that
clean sentences have on average (measured on a tenth of the clean sample, which
is not learnt from) is taken off per sentence.

Training reads at most about ``per_class`` labelled texts of each class (hash
of the id); scores cover every sentence of every whole text.

Cases: null and empty texts have no sentence and get the score 0; without
labels every score is 0; repeated rows give repeated results.
"""

from __future__ import annotations

import math
import re
import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmart.llm.common import map_arrow, release_memory
from sparkmart.llm.language_id import sample_rows

BUCKETS = 1 << 18
PREFIXES = (3, 4, 5)          # of a word, hashed beside the whole word: inflections share them
START_BIAS = -7.0            # a sentence is clean unless its words say otherwise
_SENTENCE = re.compile(r"[^.!?\n]+")
_STRIP = " \t\r\x0b\x0c,;:\"'()[]{}<>*#$%&/\\|_-+=~`"
FLOOR = 0.05                  # of a sentence's probability: less than that is no evidence, however many sentences have it
CACHE_WORDS, CACHE_CHARS = 300_000, 64


@dataclass
class Model:
    weights: np.ndarray      # one per bucket
    bias: float
    background: float = 0.0  # evidence that a sentence of a clean text has on average


def buckets(word: str) -> tuple[int, ...]:
    """Hash buckets of a word (edges cleaned, lower case) and of its prefixes; none if nothing is left."""
    w = word.strip(_STRIP).lower()
    if not w:
        return ()
    whole = w.encode()
    return (zlib.crc32(b"=" + whole) % BUCKETS,
            *(zlib.crc32(b"%d" % n + w[:n].encode()) % BUCKETS for n in PREFIXES if len(w) >= n))


def bag(text: str) -> list[list[int]]:
    """Buckets of the distinct words of each sentence."""
    out = []
    for m in _SENTENCE.finditer(text):
        words = {w.strip(_STRIP).lower() for w in m.group().split()}
        b = [x for w in sorted(words) for x in buckets(w)]
        if b:
            out.append(b)
    return out


def evidence(p: np.ndarray) -> float:
    """Summed -log(1 - p) of the sentences, of what their probabilities have over ``FLOOR``."""
    return float(-np.log1p(-np.clip((p - FLOOR) / (1 - FLOOR), 0, 1 - 1e-12)).sum())


def spread(sentences: list, most: int) -> list:
    """At most ``most`` evenly spaced ones, the first and the last among them."""
    return [sentences[i] for i in np.linspace(0, len(sentences) - 1, most).astype(int)] if len(sentences) > most else sentences


def train(flat: list[tuple[np.ndarray, np.ndarray, int]], labels: list[int], steps: int = 90_000, rate: float = 0.2,
          decay: float = 1e-4, min_docs: int = 4, seed: int = 3) -> Model | None:
    """Plain SGD over single documents, given as (buckets, the sentence of each,
    number of sentences). The step is the same for all words, so
    a word of few documents moves little; those of under ``min_docs`` sampled
    documents keep the weight 0."""
    if not labels:
        return None
    w, bias = np.zeros(BUCKETS), START_BIAS
    rng = np.random.default_rng(seed)
    clean_rows = [i for i, y in enumerate(labels) if not y]
    apart = set(clean_rows[::10]) if len(clean_rows) >= 20 else set()     # not learnt from: they measure the background
    epochs = min(60, max(10, steps // len(labels)))  # small samples are gone over more often
    docs = np.zeros(BUCKETS, np.int32)
    for idx, _, _ in flat:
        docs[np.unique(idx)] += 1
    for i, (idx, of, n) in enumerate(flat):  # in place: the sample is held once
        often = docs[idx] >= min_docs
        flat[i] = (idx[often], of[often], n)
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        for i in rng.permutation(len(labels)):
            idx, of, n = flat[i]
            if not n or i in apart:
                continue
            p = 1 / (1 + np.exp(-np.clip(np.bincount(of, weights=w[idx], minlength=n) + bias, -30, 30)))
            if labels[i]:
                clean = np.prod(1 - p)
                g = -p * clean / max(1 - clean, 1e-9)
            else:
                g = p
            if np.abs(g).max() >= 1e-5:
                np.subtract.at(w, idx, step * g[of])
                bias = min(bias - 0.02 * step * g.sum(), -4.0)
        w *= 1 - decay * step * len(labels) / 10
    seen, total = 0, 0.0
    for i in apart:
        idx, of, n = flat[i]
        seen += n
        total += evidence(1 / (1 + np.exp(-np.clip(np.bincount(of, weights=w[idx], minlength=n) + bias, -40, 40))))
    return Model(w.astype(np.float32), float(bias), total / max(seen, 1))


def fit(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", eligible: Column | None = None, per_class: int = 3000, clean_factor: int = 2,
        most_sentences: int = 2000) -> Model | None:
    """Train on a bounded sample of the rows that ``labels`` marks, at most
    ``per_class`` toxic and ``clean_factor`` times as many clean; ``eligible`` speaks
    of the column ``doc_id``. An id labelled twice counts by its largest label. Of
    a longer text ``most_sentences`` evenly spaced sentences are learnt from, so
    that what the driver holds is bounded; all of every text is scored."""
    lab = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("label"))
    lab = lab.where(F.col("doc_id").isNotNull() & F.col("label").isNotNull())
    lab = lab.groupBy("doc_id").agg(F.max("label").alias("label"))
    if eligible is not None:
        lab = lab.where(eligible)
    per = F.when(F.col("label") == 0, clean_factor * per_class).otherwise(per_class)
    most = 2 * (1 + clean_factor) * per_class
    ids = sample_rows(lab, F.col("doc_id"), per, most)
    docs = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).where(F.col("text").isNotNull())
    rows = sample_rows(docs.join(F.broadcast(ids), "doc_id").select("doc_id", "text", "label"), F.xxhash64("doc_id", "text"), per, most)

    def run(cols):
        bags = [spread(bag(t), most_sentences) for t in cols["text"]]
        return {"doc_id": cols["doc_id"], "label": cols["label"],
                "idx": [[x for s in b for x in s] for b in bags], "len": [[len(s) for s in b] for b in bags]}

    model = _learnt(map_arrow(rows, run, "doc_id bigint, label int, idx array<int>, len array<int>").toArrow())
    release_memory()
    return model


def _learnt(got: pa.Table) -> Model | None:
    """Train on the gathered sample (doc_id, label, idx, len)."""
    if not got.num_rows:
        return None
    got = got.combine_chunks()
    idx, lens = got.column("idx").chunk(0), got.column("len").chunk(0)
    labels = got.column("label").to_numpy()
    order = np.lexsort((labels, got.column("doc_id").to_numpy()))   # the same whatever the partitions
    flat = []
    for i in order.tolist():   # views of the gathered columns, nothing is copied
        n = lens[i].values.to_numpy()
        flat.append((idx[i].values.to_numpy(), np.repeat(np.arange(len(n), dtype=np.uint16 if len(n) < 65536 else np.int32), n), len(n)))
    labels = labels[order].tolist()
    return train(flat, labels)


class _Words(dict):
    """Word -> (its bucket, its weight with its prefixes), cached; -1 where nothing is left of it."""

    def __init__(self, weights):
        super().__init__()
        self.weights = weights

    def __missing__(self, word):
        b = buckets(word)
        v = (b[0], float(self.weights[list(b)].sum())) if b else (-1, 0.0)
        if len(word) <= CACHE_CHARS:
            self[word] = v
        return v


def sentence_scores(model: Model, words: _Words, text: str) -> list[tuple[int, int, float]]:
    """(start, end, log-odds) of every sentence with a word, in characters."""
    out = []
    for m in _SENTENCE.finditer(text):
        got = set(map(words.__getitem__, m.group().split()))
        got.discard((-1, 0.0))
        if got:
            out.append((m.start(), m.end(), model.bias + sum(v for _, v in got)))
    return out


def document_score(model: Model | None, cache: list, text: str | None) -> tuple[float, list[tuple[int, int, float]]]:
    """Noisy-or of a whole text, and (start, end, probability) of its sentences.
    ``cache`` holds the worker's word table, renewed when it is full."""
    if model is None or not text:
        return 0.0, []
    if not cache or len(cache[0]) > CACHE_WORDS:
        cache[:] = [_Words(model.weights)]
    s = sentence_scores(model, cache[0], text)
    if not s:
        return 0.0, []
    p = 1 / (1 + np.exp(-np.clip(np.array([x[2] for x in s]), -40, 40)))
    total = -math.expm1(-max(0.0, evidence(p) - 2 * model.background * len(s)))
    return min(1.0, max(0.0, total)), [(a, b, q) for (a, b, _), q in zip(s, p.tolist())]


def score(df: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text",
          sentence_threshold: float = 0.5) -> DataFrame:
    """(doc_id, score, predicted, offending array<struct<start,end,p>>): the
    noisy-or of all sentences over the background and the sentences at or over the threshold."""
    src = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    shared = df.sparkSession.sparkContext.broadcast(model)  # BUCKETS floats
    cache: list[_Words] = []

    def run(cols):
        got = [document_score(shared.value, cache, t) for t in cols["text"]]
        return {"doc_id": cols["doc_id"], "score": [x for x, _ in got], "predicted": [int(x >= 0.5) for x, _ in got],
                "offending": [[{"start": a, "end": b, "p": p} for a, b, p in s if p >= sentence_threshold] for _, s in got]}

    return map_arrow(src, run, "doc_id bigint, score double, predicted int, "
                               "offending array<struct<start:int,end:int,p:double>>")


def keep_clean(df: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` that the model does not predict toxic, all columns
    kept. The verdict is computed beside the row, so no join is needed."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    cache: list[_Words] = []

    def toxic(texts: pd.Series) -> pd.Series:
        return pd.Series([document_score(shared.value, cache, t)[0] >= 0.5 for t in texts], dtype=bool)

    verdict = F.pandas_udf(toxic, "boolean")
    return df.where(~verdict(F.col(text_col).cast("string")))
