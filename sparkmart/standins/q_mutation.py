"""Stand-ins for UPDATE / DELETE as DataFrame transforms."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkmart.operators import relational as R
from sparkmart.plans import hs, kok
from sparkmart.standins import Tables, register
from sparkmart.standins.frames import LINE_ORDER, kok_prices
from sparkmart.standins.q_joins import _NOT_IN_VARIANTS, _not_in_frames
from sparkmart.standins.q_jobs import PRICE_DELTA_CTES

NOW = "2024-01-15 03:00:00"


@register("dml_delete_not_in", oracle=_NOT_IN_VARIANTS + """
SELECT 'plain' AS variant, o_orderkey FROM o WHERE NOT coalesce(k NOT IN (SELECT k FROM ref_plain), false)
UNION ALL SELECT 'ref_null', o_orderkey FROM o WHERE NOT coalesce(k NOT IN (SELECT k FROM ref_null), false)
UNION ALL SELECT 'empty_ref', o_orderkey FROM o WHERE NOT coalesce(k NOT IN (SELECT k FROM ref_empty), false)
""")
def q_dml_delete_not_in(spark, d):
    o, refs = _not_in_frames(Tables(spark, d))
    out = None
    for name, ref in refs.items():
        part = R.delete_not_in(o, "k", ref).select(F.lit(name).alias("variant"), "o_orderkey")
        out = part if out is None else out.unionByName(part)
    return out


@register("dml_delete_in", oracle="""
WITH o AS (SELECT CASE WHEN o_orderkey % 1000 = 999 THEN NULL ELSE o_orderkey END AS k, o_orderkey, o_orderstatus FROM orders)
SELECT o_orderkey, o_orderstatus FROM o
WHERE NOT coalesce(k IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R' AND l_linenumber = 1), false)
""")
def q_dml_delete_in(spark, d):
    t = Tables(spark, d)
    o = t.orders.select(F.when(F.col("o_orderkey") % 1000 == 999, F.lit(None)).otherwise(F.col("o_orderkey")).alias("k"),
                        "o_orderkey", "o_orderstatus")
    ids = t.lineitem.filter((F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 1))
    return R.delete_in(o, "k", ids, "l_orderkey").drop("k")


@register("dml_cascade", oracle="""
WITH gone_c AS (SELECT c_custkey FROM customer WHERE c_nationkey = 3),
gone_o AS (SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM gone_c))
SELECT 'customer' AS tbl, c_custkey AS k1, CAST(NULL AS INTEGER) AS k2 FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM gone_c)
UNION ALL SELECT 'orders', o_orderkey, NULL FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM gone_o)
UNION ALL SELECT 'lineitem', l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM gone_o)
""")
def q_dml_cascade(spark, d):
    t = Tables(spark, d)
    tables = {"customer": t.customer, "orders": t.orders, "lineitem": t.lineitem}
    edges = [("customer", "c_custkey", "orders", "o_custkey"), ("orders", "o_orderkey", "lineitem", "l_orderkey")]
    ids = t.customer.filter(F.col("c_nationkey") == 3)
    out = R.cascade_delete(tables, edges, "customer", "c_custkey", ids)
    return (out["customer"].select(F.lit("customer").alias("tbl"), F.col("c_custkey").alias("k1"), F.lit(None).cast("int").alias("k2"))
            .unionByName(out["orders"].select(F.lit("orders").alias("tbl"), F.col("o_orderkey").alias("k1"),
                                              F.lit(None).cast("int").alias("k2")))
            .unionByName(out["lineitem"].select(F.lit("lineitem").alias("tbl"), F.col("l_orderkey").alias("k1"),
                                                F.col("l_linenumber").alias("k2"))))


_INTEGRITY_SQL = """
WITH product AS (SELECT o_orderkey AS product_id FROM orders),
detail AS (SELECT l_orderkey AS product_id, l_linenumber AS n FROM lineitem WHERE l_linenumber <= 3),
image AS (SELECT l_orderkey AS product_id, l_linenumber AS n FROM lineitem WHERE l_linenumber BETWEEN 2 AND 5),
extra AS (SELECT l_orderkey AS product_id, l_linenumber AS n FROM lineitem
          UNION ALL SELECT l_orderkey + 1000000, l_linenumber FROM lineitem WHERE l_linenumber = 1),
d1 AS (SELECT * FROM detail WHERE NOT coalesce(product_id NOT IN (SELECT product_id FROM image), false)),
i1 AS (SELECT * FROM image WHERE NOT coalesce(product_id NOT IN (SELECT product_id FROM d1), false)),
gone AS (SELECT product_id FROM product WHERE product_id NOT IN (SELECT product_id FROM d1)
         INTERSECT SELECT product_id FROM product WHERE product_id NOT IN (SELECT product_id FROM i1)),
p1 AS (SELECT * FROM product WHERE product_id NOT IN (SELECT product_id FROM gone)),
e1 AS (SELECT * FROM extra WHERE NOT coalesce(product_id NOT IN (SELECT product_id FROM p1), false))
SELECT '{p}' AS tbl, product_id, CAST(NULL AS INTEGER) AS n FROM p1
UNION ALL SELECT 'detail', product_id, n FROM d1
UNION ALL SELECT 'image', product_id, n FROM i1
UNION ALL SELECT '{e}', product_id, n FROM e1
"""


def _integrity(spark, d, repair, extra_name):
    t = Tables(spark, d)
    li = t.lineitem
    product = t.orders.select(F.col("o_orderkey").alias("product_id"))
    detail = li.filter(F.col("l_linenumber") <= 3).select(F.col("l_orderkey").alias("product_id"), F.col("l_linenumber").alias("n"))
    image = li.filter(F.col("l_linenumber").between(2, 5)).select(F.col("l_orderkey").alias("product_id"),
                                                                  F.col("l_linenumber").alias("n"))
    extra = li.select(F.col("l_orderkey").alias("product_id"), F.col("l_linenumber").alias("n")).unionByName(
        li.filter(F.col("l_linenumber") == 1).select((F.col("l_orderkey") + 1000000).alias("product_id"),
                                                     F.col("l_linenumber").alias("n")))
    out = repair(product, detail, image, extra)
    return (out["product"].select(F.lit("product").alias("tbl"), "product_id", F.lit(None).cast("int").alias("n"))
            .unionByName(out["detail"].select(F.lit("detail").alias("tbl"), "product_id", "n"))
            .unionByName(out["image"].select(F.lit("image").alias("tbl"), "product_id", "n"))
            .unionByName(out[extra_name].select(F.lit(extra_name).alias("tbl"), "product_id", "n")))


@register("hs_integrity", oracle=_INTEGRITY_SQL.format(p="product", e="list"))
def q_hs_integrity(spark, d):
    return _integrity(spark, d, lambda p, de, im, ex: hs.repair_hs(p, de, im, ex), "list")


@register("kok_integrity", oracle=_INTEGRITY_SQL.format(p="product", e="extra"))
def q_kok_integrity(spark, d):
    return _integrity(spark, d, lambda p, de, im, ex: kok.repair_integrity(p, de, im, extra=ex, key="product_id"),
                      "extra")


@register("kok_name_strip", oracle="""
WITH p AS (SELECT p_partkey, p_brand AS kok_store_name,
                  CASE p_partkey % 3 WHEN 0 THEN p_brand || '  ' || p_name WHEN 1 THEN p_brand ELSE p_name END AS kok_product_name
           FROM part),
s AS (SELECT p_partkey, kok_store_name,
             CASE WHEN kok_store_name IS NOT NULL AND kok_product_name IS NOT NULL
                       AND left(kok_product_name, length(kok_store_name)) = kok_store_name
                  THEN ltrim(substr(kok_product_name, length(kok_store_name) + 1)) ELSE kok_product_name END AS n1
      FROM p)
SELECT p_partkey, kok_store_name, CASE WHEN n1 = '' THEN kok_store_name ELSE n1 END AS kok_product_name FROM s
""")
def q_kok_name_strip(spark, d):
    p = Tables(spark, d).part
    k = F.col("p_partkey") % 3
    name = (F.when(k == 0, F.concat("p_brand", F.lit("  "), "p_name")).when(k == 1, F.col("p_brand"))
            .otherwise(F.col("p_name")))
    df = p.select("p_partkey", F.col("p_brand").alias("kok_store_name"), name.alias("kok_product_name"))
    return kok.strip_store_prefix(df)


@register("dml_update_from", oracle="""
WITH tgt AS (SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN 1 END AS cls_food FROM documents)
SELECT t.doc_id, coalesce(l.quality, t.cls_food) AS cls_food
FROM tgt t LEFT JOIN labels l ON t.doc_id = l.doc_id
""")
def q_dml_update_from(spark, d):
    t = Tables(spark, d)
    tgt = t.documents.select("doc_id", F.when(F.col("doc_id") % 4 == 0, F.lit(1)).alias("cls_food"))
    preds = t.labels.select("doc_id", F.col("quality").alias("pred"))
    return R.update_from(tgt, preds, "doc_id", {"cls_food": "pred"})


@register("dml_update_first", oracle=f"""
WITH u AS (SELECT * FROM (SELECT l_partkey, l_returnflag, l_quantity, row_number() OVER (PARTITION BY l_partkey ORDER BY
             {", ".join(LINE_ORDER)}) AS rn FROM lineitem) WHERE rn = 1)
SELECT p_partkey, p_brand, coalesce(l_returnflag, '-') AS flag, coalesce(l_quantity, -1.0) AS quantity
FROM part LEFT JOIN u ON l_partkey = p_partkey
""")
def q_dml_update_first(spark, d):
    """Many updates of one key: the first line of a part sets both columns."""
    t = Tables(spark, d)
    tgt = t.part.select("p_partkey", "p_brand", F.lit("-").alias("flag"), F.lit(-1.0).alias("quantity"))
    lines = t.lineitem.withColumnRenamed("l_partkey", "p_partkey")
    return R.update_from(tgt, lines, "p_partkey", {"flag": "l_returnflag", "quantity": "l_quantity"}, order_by=LINE_ORDER)


@register("dml_update_latest", oracle="""
WITH m AS (SELECT o_custkey, max(o_orderkey) AS mx FROM orders WHERE o_custkey % 5 = 0 GROUP BY o_custkey)
SELECT o.o_orderkey, o.o_custkey,
       CASE WHEN o.o_orderkey = m.mx THEN TIMESTAMP '2024-01-15 03:00:00' END AS renew_at
FROM orders o LEFT JOIN m ON o.o_custkey = m.o_custkey
""")
def q_dml_update_latest(spark, d):
    t = Tables(spark, d)
    o = t.orders.select("o_orderkey", "o_custkey", F.lit(None).cast("timestamp").alias("renew_at"))
    ids = o.filter(F.col("o_custkey") % 5 == 0).select(F.col("o_custkey").alias("kok_product_id"))
    return kok.stamp_latest(o, ids, NOW, product="o_custkey", arrival=["o_orderkey"])


_IMG_SQL = """
WITH img AS (
  SELECT l_partkey AS product_id,
         CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) ||
         CASE WHEN l_partkey % 7 = 0 THEN (CASE WHEN l_returnflag = 'R' THEN '/format/avif' ELSE '/format/webp' END)
              WHEN l_returnflag = 'R' THEN '/format/avif' WHEN l_returnflag = 'A' THEN '/format/webp' ELSE '.jpg' END AS img_url
  FROM lineitem
),
lst AS (SELECT p_partkey AS product_id, CAST(p_partkey % 5 + 1 AS INTEGER) AS homeshopping_id FROM part)
"""


@register("hs_image_cleanup", oracle=_IMG_SQL + """
SELECT product_id, img_url FROM img
WHERE NOT ((img_url LIKE '%format/avif%' OR img_url LIKE '%format/webp%')
           AND product_id IN (SELECT product_id FROM lst WHERE homeshopping_id = 1)
           AND product_id NOT IN (
               SELECT product_id FROM img WHERE product_id IN (SELECT product_id FROM lst WHERE homeshopping_id = 1)
               GROUP BY product_id
               HAVING count(*) FILTER (WHERE img_url NOT LIKE '%format/avif%' AND img_url NOT LIKE '%format/webp%') = 0))
""")
def q_hs_image_cleanup(spark, d):
    t = Tables(spark, d)
    li = t.lineitem
    fmt = (F.when(F.col("l_partkey") % 7 == 0,
                  F.when(F.col("l_returnflag") == "R", F.lit("/format/avif")).otherwise(F.lit("/format/webp")))
           .when(F.col("l_returnflag") == "R", F.lit("/format/avif"))
           .when(F.col("l_returnflag") == "A", F.lit("/format/webp")).otherwise(F.lit(".jpg")))
    img = li.select(F.col("l_partkey").alias("product_id"),
                    F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string"), fmt)
                    .alias("img_url"))
    lst = t.part.select(F.col("p_partkey").alias("product_id"), (F.col("p_partkey") % 5 + 1).cast("int").alias("homeshopping_id"))
    return hs.clean_image_variants(img, lst)


@register("kok_invalidate", oracle=f"""
WITH {PRICE_DELTA_CTES},
changed AS (SELECT kok_product_id FROM delta WHERE raw_price_change_flag = 'changed_raw_price'
            AND kok_product_id NOT IN (SELECT kok_product_id FROM kok_prices WHERE kok_product_id % 5 = 0)),
latest AS (SELECT kok_product_id, max(struct_pack(l_shipdate, l_orderkey, l_linenumber, l_suppkey, l_quantity,
             l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus)) AS mx
           FROM kok_prices WHERE kok_product_id IN (SELECT kok_product_id FROM changed) GROUP BY kok_product_id)
SELECT 'changed' AS tbl, kok_product_id, CAST(NULL AS BIGINT) AS n FROM changed
UNION ALL SELECT 'product_left', NULL, count(*) FROM part WHERE p_partkey NOT IN (SELECT kok_product_id FROM changed)
UNION ALL SELECT t, l_partkey, count(*) FROM lineitem, (VALUES ('image_left'), ('detail_left')) v(t)
  WHERE l_partkey NOT IN (SELECT kok_product_id FROM changed) GROUP BY ALL
UNION ALL SELECT 'review_left', conv_id, count(*) FROM conversations WHERE conv_id NOT IN (SELECT kok_product_id FROM changed) GROUP BY ALL
UNION ALL SELECT 'stamped', p.kok_product_id, NULL FROM kok_prices p JOIN latest m ON p.kok_product_id = m.kok_product_id
  AND struct_pack(l_shipdate, l_orderkey, l_linenumber, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
                  l_returnflag, l_linestatus) = m.mx
""")
def q_kok_invalidate(spark, d):
    t = Tables(spark, d)
    prices = kok_prices(t).withColumn(
        "renew_at", F.when(F.col("kok_product_id") % 5 == 0, F.lit("2024-01-01 00:00:00").cast("timestamp"))
        .otherwise(F.lit(None).cast("timestamp")))
    product = t.part.select(F.col("p_partkey").alias("kok_product_id"), F.col("p_name").alias("kok_product_name"))
    image = t.lineitem.select(F.col("l_partkey").alias("kok_product_id"), F.col("l_orderkey").alias("img_ref"))
    review = t.conversations.select(F.col("conv_id").alias("kok_product_id"), "turn")
    detail = t.lineitem.select(F.col("l_partkey").alias("kok_product_id"),
                                                                 F.col("l_returnflag").alias("detail_val"))
    out = kok.invalidate_changed({"price": prices, "product": product, "image": image, "detail": detail, "review": review},
                                 product, NOW, arrival=LINE_ORDER)
    left = [out[k].groupBy("kok_product_id").agg(F.count(F.lit(1)).alias("n")).select(F.lit(f"{k}_left").alias("tbl"), "kok_product_id", "n")
            for k in ("image", "detail", "review")]
    return left[0].unionByName(left[1]).unionByName(left[2]).unionByName(
            out["changed"].select(F.lit("changed").alias("tbl"), "kok_product_id", F.lit(None).cast("long").alias("n"))
            .unionByName(out["product"].groupBy().agg(F.count(F.lit(1)).alias("n"))
                         .select(F.lit("product_left").alias("tbl"), F.lit(None).cast("long").alias("kok_product_id"), "n"))
            .unionByName(out["price"].filter(F.col("renew_at") == F.lit(NOW).cast("timestamp"))
                         .select(F.lit("stamped").alias("tbl"), "kok_product_id", F.lit(None).cast("long").alias("n"))))
