"""Stand-ins for the embedding jobs."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from sparkmart.plans import embed as E
from sparkmart.session import scratch_path
from sparkmart.sources.files import write_vectors
from sparkmart.standins import Tables, register


@register("emb_encode", oracle="SELECT p_partkey, 384 AS dim, 1.0 AS norm FROM part")
def q_emb_encode(spark, d):
    p = Tables(spark, d).part
    v = E.hashed_char_encoder()(p.select("p_partkey", "p_name"), "p_name")
    return v.select("p_partkey", F.size("vector").alias("dim"), F.round(E.l2_norm(F.col("vector")), 6).alias("norm"))


@register("emb_l2", oracle="""
SELECT vec_id, len(embedding) AS dim,
       round(sqrt(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)))), 6) AS norm
FROM embeddings
""")
def q_emb_l2(spark, d):
    e = Tables(spark, d).embeddings
    return e.select("vec_id", F.size("embedding").alias("dim"), F.round(E.l2_norm(F.col("embedding")), 6).alias("norm"))


@register("emb_incremental", oracle="""
SELECT p_partkey, 384 AS dim, 1.0 AS norm FROM part
WHERE p_partkey NOT IN (SELECT vec_id FROM embeddings WHERE vec_id % 2 = 0)
""")
def q_emb_incremental(spark, d):
    t = Tables(spark, d)
    products = t.part.select("p_partkey", "p_name")
    seen = t.embeddings.filter(F.col("vec_id") % 2 == 0)
    new = E.embed_new(products, seen, "p_partkey", "p_name", vector_key="vec_id")
    return new.select("p_partkey", F.size("vector").alias("dim"), F.round(E.l2_norm(F.col("vector")), 6).alias("norm"))


@register("emb_vectors", oracle="""
SELECT vec_id, vec_id % 10 <> 3 AS accepted FROM embeddings
""")
def q_emb_vectors(spark, d):
    e = Tables(spark, d).embeddings
    v = e.select("vec_id", F.when(F.col("vec_id") % 10 == 3, F.slice("embedding", 1, 10)).otherwise(F.col("embedding"))
                 .alias("vector"))
    path = scratch_path(spark, f"emb_vectors-{uuid.uuid4().hex[:12]}")
    rejected = write_vectors(v, path, dim=64).select("vec_id").checkpoint(eager=True)
    stored = spark.read.parquet(path).select("vec_id", F.lit(True).alias("accepted"))
    return stored.unionByName(rejected.select("vec_id", F.lit(False).alias("accepted")))


@register("emb_orphans", oracle="""
SELECT vec_id, label FROM embeddings WHERE vec_id IN (SELECT doc_id FROM labels)
""")
def q_emb_orphans(spark, d):
    t = Tables(spark, d)
    return E.drop_orphans(t.embeddings.select("vec_id", "label"), t.labels, "vec_id", "doc_id")


# equal names have one vector, different names have different ones, and a name
# that is part of a longer one shares its n-grams' places
@register("emb_names", oracle="""
SELECT p_name, count(*) AS n_rows, 1 AS n_vectors, 1 AS n_names_of_vector, true AS inside_extended FROM part GROUP BY p_name
""")
def q_emb_names(spark, d):
    p = Tables(spark, d).part.repartition("p_partkey", "p_name")      # a small file: its vectors are made on all cores
    encode = E.hashed_char_encoder()
    v = encode(encode(p.select("p_name", F.concat("p_name", F.lit(" extra")).alias("longer")), "p_name"), "longer", "wider")
    places = lambda c: F.filter(F.transform(c, lambda x, i: F.when(x > 0, i)), lambda i: i.isNotNull())
    inside = F.size(F.array_except(places("vector"), places("wider"))) == 0
    by_name = v.groupBy("p_name").agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("vector").cast("int").alias("n_vectors"),
                                      F.bool_and(inside).alias("inside_extended"))
    names = v.groupBy("vector").agg(F.countDistinct("p_name").cast("int").alias("n_names_of_vector"), F.first("p_name").alias("p_name"))
    return by_name.join(names, "p_name").select("p_name", "n_rows", "n_vectors", "n_names_of_vector", "inside_extended")
