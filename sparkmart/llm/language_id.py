"""Language identification (operator 5).

Averaged hashed subword embeddings with a linear softmax: a text is the mean
of the embeddings of its hashed byte 3- and 4-grams (ASCII lower case, every
run of non-letters one space, word edges included); the softmax over that mean
is trained with the embeddings by stochastic gradient descent in numpy. A
temperature and a rejection threshold are fitted on a tenth of the sample.

Training reads at most ``per_lang`` labelled rows per language, ``most`` in all
(a hash of id and text picks them, the same at every size); with more than
``most / per_lang`` languages each gets its equal part, and none is left out. All
else covers whole texts of all rows.

Cases: a null text or one without a letter gives ``und`` and score 0; with no
labelled row every prediction is ``und``; ties go to the language that sorts
first; repeated rows give repeated results.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkmart.llm.common import map_arrow

BUCKETS, DIM, GRAMS = 1 << 15, 16, (3, 4)
MOST_LABELS = 10_000
_LETTER = regex.compile(r"\p{L}")
# bytes: ASCII letters to lower case, UTF-8 bytes as they are, the rest to space
_FOLD = bytes(c if c >= 0x80 or 0x61 <= c <= 0x7A else c + 0x20 if 0x41 <= c <= 0x5A else 0x20 for c in range(256))


@dataclass
class Model:
    langs: list[str]
    table: np.ndarray          # (BUCKETS, languages): embedding times softmax weights
    bias: np.ndarray
    temperature: float
    threshold: float           # calibrated probability below which a prediction is rejected


def fold(text: str) -> bytes:
    return b" " + b" ".join(text.encode().translate(_FOLD).split()) + b" "


def grams(data: bytes, n: int) -> np.ndarray:
    """The bucket of the n-gram at every byte but the last n - 1."""
    c = np.frombuffer(data, np.uint8).astype(np.uint32)
    h = np.zeros(max(len(c) - n + 1, 0), np.uint32)
    for j in range(n):
        h = h * np.uint32(0x01000193) + c[j:j + len(h)] + np.uint32(n)
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x2C1B3C6D)
    return (h >> np.uint32(12)).astype(np.int32) & (BUCKETS - 1)


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a text and their shares of its grams."""
    data = fold(text)
    g = np.concatenate([grams(data, n) for n in GRAMS])
    u, n = np.unique(g, return_counts=True)
    return u, (n / max(len(g), 1)).astype(np.float32)


def sample_rows(rows: DataFrame, key: Column, per_label: Column, most: int) -> DataFrame:
    """At most ``per_label`` rows (a number as a column of ``label``) of each value
    of the column ``label``, and at most ``most / labels`` where there are so many
    labels (one row of each at least): picked row by row by a hash of ``key``, the
    same at every size and however rows are dealt. A share of the rows is taken
    first, so that next to nothing is shuffled; then the exact bound applies."""
    rows = rows.where(F.col("label").isNotNull())
    count = rows.groupBy("label").agg(F.count("*").alias("_n"))
    labels = max(count.count(), 1)
    small = F.broadcast if labels <= MOST_LABELS else (lambda t: t)      # a row per label; more of them are joined by shuffle
    count = count.withColumn("_want", F.least(F.ceil(per_label), F.lit(max(most // labels, 1))).cast("int"))
    u = F.pmod(F.xxhash64(key, F.lit(17)), F.lit(1 << 30)) / float(1 << 30)
    near = rows.withColumn("_u", u).join(small(count), "label").where(F.col("_u") * F.col("_n") < 2 * F.col("_want") + 50)
    w = Window.partitionBy("label").orderBy("_u", key)
    return near.withColumn("_i", F.row_number().over(w)).where(F.col("_i") <= F.col("_want")).select(*rows.columns)


def train(sets: list[tuple[np.ndarray, np.ndarray]], labels: list[str], epochs: int = 6, rate: float = 4.0,
          seed: int = 7) -> Model | None:
    """Plain SGD over mini-batches of 32 texts; a tenth of the texts calibrates."""
    langs = sorted(set(labels))
    if not langs:
        return None
    y = np.array([langs.index(x) for x in labels])
    rng = np.random.default_rng(seed)
    emb = rng.normal(0, 0.1, (BUCKETS, DIM)).astype(np.float32)
    w, bias = rng.normal(0, 0.1, (DIM, len(langs))).astype(np.float32), np.zeros(len(langs), np.float32)
    order = rng.permutation(len(y))
    cal, fit = order[:len(y) // 10], order[len(y) // 10:]

    def mean(rows):
        idx = np.concatenate([sets[i][0] for i in rows])
        wt = np.concatenate([sets[i][1] for i in rows])
        of = np.repeat(np.arange(len(rows)), [len(sets[i][0]) for i in rows])
        m = np.zeros((len(rows), DIM), np.float32)
        np.add.at(m, of, emb[idx] * wt[:, None])
        return m, idx, wt, of

    def softmax(z):
        z = np.exp(z - z.max(1, keepdims=True))
        return z / z.sum(1, keepdims=True)

    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        rng.shuffle(fit)
        for at in range(0, len(fit), 32):
            rows = fit[at:at + 32]
            m, idx, wt, of = mean(rows)
            g = softmax(m @ w + bias)
            g[np.arange(len(rows)), y[rows]] -= 1
            g /= len(rows)
            back = g @ w.T
            w -= step * (m.T @ g)
            bias -= step * 0.1 * g.sum(0)
            np.add.at(emb, idx, -step * 32 * wt[:, None] * back[of])
    temperature, threshold = 1.0, 0.0
    if len(cal):
        z = mean(cal)[0] @ w + bias
        grid = [0.25, 0.35, 0.5, 0.7, 1.0, 1.4, 2.0, 2.8, 4.0]
        loss = [-np.log(np.maximum(softmax(z / t)[np.arange(len(cal)), y[cal]], 1e-9)).mean() for t in grid]
        temperature = grid[int(np.argmin(loss))]
        p = softmax(z / temperature)
        conf, right = p.max(1), p.argmax(1) == y[cal]
        by = np.argsort(-conf)
        good = np.flatnonzero(np.cumsum(right[by]) / np.arange(1, len(by) + 1) >= 0.99)
        threshold = float(conf[by[good[-1]]]) if len(good) else 1.0
    return Model(langs, (emb @ w).astype(np.float32), bias, temperature, min(threshold, 0.9))


def fit(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        eligible: Column | None = None, per_lang: int = 600, most: int = 120_000) -> Model | None:
    """Train on a bounded sample; only its hashed features reach the driver."""
    src = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("label"))
    ok = F.col("text").isNotNull() & (eligible if eligible is not None else F.lit(True))
    rows = sample_rows(src.where(ok), F.xxhash64("doc_id", "text"), F.lit(per_lang), most).select("text", F.col("label").alias("lang"))

    def run(cols):
        f = [features(t) for t in cols["text"]]
        return {"lang": cols["lang"], "idx": [a.tolist() for a, _ in f], "wt": [b.tolist() for _, b in f]}

    got = map_arrow(rows, run, "lang string, idx array<int>, wt array<float>").orderBy("lang", F.xxhash64("idx")).toArrow()
    sets = [(np.array(i, np.int32), np.array(w, np.float32))
            for i, w in zip(got.column("idx").to_pylist(), got.column("wt").to_pylist())]
    return train(sets, got.column("lang").to_pylist())


def score_texts(model: Model, texts: list[str], block: int = 1 << 20) -> np.ndarray:
    """Calibrated probabilities (texts, languages); what a text gets does not
    depend on its neighbours or on ``block``, the bytes gone over at a time."""
    sums = np.zeros((len(texts), len(model.langs)))
    total = np.zeros(len(texts))
    at = 0
    while at < len(texts):
        parts, size = [], 0
        while at + len(parts) < len(texts) and (not parts or size < block):
            parts.append(fold(texts[at + len(parts)]))
            size += len(parts[-1])
        data, ends = b"".join(parts), np.cumsum([len(p) for p in parts])
        for n in GRAMS:
            for lo in range(0, size, 2 * block):
                g = grams(data[lo:lo + 2 * block + n - 1], n)
                start = np.arange(lo, lo + len(g))
                doc = np.searchsorted(ends, start, side="right")
                inside = start + n <= ends[doc]          # no gram spans two texts
                g, doc = g[inside], doc[inside]
                total[at:at + len(parts)] += np.bincount(doc, minlength=len(parts))
                for k in range(len(model.langs)):
                    sums[at:at + len(parts), k] += np.bincount(doc, weights=model.table[:, k][g], minlength=len(parts))
        at += len(parts)
    z = (sums / np.maximum(total, 1)[:, None] + model.bias) / model.temperature
    z = np.exp(z - z.max(1, keepdims=True))
    return z / z.sum(1, keepdims=True)


def predict(df: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score, rejected) for every row; ``rejected``: the
    calibrated probability is under the fitted threshold (or there is no letter)."""
    src = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    shared = df.sparkSession.sparkContext.broadcast(model)  # BUCKETS x languages floats

    def run(cols):
        m = shared.value
        ok = [m is not None and t is not None and _LETTER.search(t) is not None for t in cols["text"]]
        p = score_texts(m, [t for t, k in zip(cols["text"], ok) if k]) if any(ok) else None
        best = iter(zip(p.argmax(1).tolist(), p.max(1).tolist()) if p is not None else ())
        got = [next(best) if k else None for k in ok]
        return {"doc_id": cols["doc_id"], "lang_pred": [m.langs[g[0]] if g else "und" for g in got],
                "score": [min(1.0, g[1]) if g else 0.0 for g in got],
                "rejected": [g is None or g[1] < m.threshold for g in got]}

    return map_arrow(src, run, "doc_id bigint, lang_pred string, score double, rejected boolean")
