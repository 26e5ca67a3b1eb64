"""Name embeddings: a pluggable encoder producing unit-length vectors, and
the incremental / orphan maintenance of vector tables."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.ml.feature import HashingTF, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmart.operators import relational as R
from sparkmart.plans.text_features import char_ngrams_sql

# Fixed value: width of the stored name vectors.
EMBED_DIM = 384


def hashed_char_encoder(dim: int = EMBED_DIM, ngrams: tuple[int, int] = (2, 4)):
    """Default encoder: hashed character n-gram counts, L2-normalised -
    entirely JVM-side (HashingTF + Normalizer)."""
    def encode(df: DataFrame, text: str, out: str = "vector") -> DataFrame:
        grams = F.expr(char_ngrams_sql(f"lower(`{text}`)", *ngrams))
        tmp = df.withColumn("_grams", F.coalesce(grams, F.array().cast("array<string>")))
        tf = HashingTF(inputCol="_grams", outputCol="_tf", numFeatures=dim).transform(tmp)
        nv = Normalizer(inputCol="_tf", outputCol="_nv", p=2.0).transform(tf)
        return nv.withColumn(out, vector_to_array("_nv", "float32")).drop("_grams", "_tf", "_nv")
    return encode


def model_encoder(load_model: Callable[[], object], dim: int = EMBED_DIM, batch: int = 256):
    """Encoder backed by a sentence model, run with an iterator pandas UDF so
    the model is loaded once per Python worker and fed Arrow batches.
    ``load_model()`` must return an object with ``encode(list[str]) -> ndarray``."""
    @F.pandas_udf("array<float>")
    def enc(it):
        model = load_model()
        for texts in it:
            vecs = np.asarray(model.encode(texts.fillna("").tolist()), dtype=np.float32)
            norms = np.linalg.norm(vecs, axis=1, keepdims=True)
            vecs = vecs / np.where(norms == 0, 1, norms)
            yield pd.Series(list(vecs))

    def encode(df: DataFrame, text: str, out: str = "vector") -> DataFrame:
        return df.withColumn(out, enc(F.col(text)))
    return encode


def l2_norm(vec: Column) -> Column:
    return F.sqrt(F.aggregate(vec, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")))


def embed_new(products: DataFrame, vectors: DataFrame, key: str, text: str, encoder=None,
              vector_key: str | None = None) -> DataFrame:
    """Vectors for products that have none yet (NOT IN the vector table's
    keys; an empty table means everything is new)."""
    encoder = encoder or hashed_char_encoder()
    vk = vector_key or key
    new = R.unseen(products, key, vectors.select(F.col(vk).alias(key)))
    return encoder(new, text)


def drop_orphans(vectors: DataFrame, products: DataFrame, key: str, product_key: str | None = None) -> DataFrame:
    """Vectors whose product is still listed (semi join). An empty product
    list is refused: it would wipe the whole vector table."""
    pk = product_key or key
    n = products.select(F.count(F.lit(1))).scalar()
    kept = vectors.join(R.keys_distinct(products, [pk], [key]), key, "left_semi")
    return kept.filter(F.when(n > 0, F.lit(True)).otherwise(F.raise_error(F.lit("refusing to drop all vectors: empty product list"))))
