"""Stand-ins for aggregations."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkmart.operators import aggregates as A
from sparkmart.standins import Tables, register


@register("agg_table_counts", oracle="""
SELECT 'orders' AS table_name, count(*) AS n_rows FROM orders
UNION ALL SELECT 'lineitem', count(*) FROM lineitem
UNION ALL SELECT 'part', count(*) FROM part
UNION ALL SELECT 'customer', count(*) FROM customer
UNION ALL SELECT 'documents', count(*) FROM documents
""")
def q_agg_table_counts(spark, d):
    t = Tables(spark, d)
    return A.row_counts({n: getattr(t, n) for n in ("orders", "lineitem", "part", "customer", "documents")})


@register("agg_count_diff", oracle="""
WITH b AS (SELECT 'orders' AS table_name, count(*) AS n FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'
           UNION ALL SELECT 'lineitem', count(*) FROM lineitem WHERE l_shipdate < TIMESTAMP '1998-01-01'),
a AS (SELECT 'orders' AS table_name, count(*) AS n FROM orders
      UNION ALL SELECT 'lineitem', count(*) FROM lineitem UNION ALL SELECT 'part', count(*) FROM part)
SELECT coalesce(a.table_name, b.table_name) AS table_name, coalesce(b.n, 0) AS before, coalesce(a.n, 0) AS after,
       coalesce(a.n, 0) - coalesce(b.n, 0) AS added
FROM b FULL OUTER JOIN a ON a.table_name = b.table_name
""")
def q_agg_count_diff(spark, d):
    t = Tables(spark, d)
    cut = F.lit("1998-01-01").cast("timestamp_ntz")
    before = A.row_counts({"orders": t.orders.filter(F.col("o_orderdate") < cut),
                           "lineitem": t.lineitem.filter(F.col("l_shipdate") < cut)})
    after = A.row_counts({"orders": t.orders, "lineitem": t.lineitem, "part": t.part})
    return A.count_diff(before, after)


@register("agg_count_by", oracle="""
SELECT l_partkey, count(l_orderkey) FILTER (WHERE l_returnflag = 'R') AS n_returned,
       count(*) FILTER (WHERE l_linestatus = 'O') AS n_open FROM lineitem GROUP BY l_partkey
""")
def q_agg_count_by(spark, d):
    li = Tables(spark, d).lineitem
    return li.groupBy("l_partkey").agg(
        F.count(F.when(F.col("l_returnflag") == "R", F.col("l_orderkey"))).alias("n_returned"),
        F.count_if(F.col("l_linestatus") == "O").alias("n_open"))


@register("agg_min_rep", oracle="""
SELECT p_name AS material_name, min(p_partkey) AS material_id FROM part GROUP BY p_name
""")
def q_agg_min_rep(spark, d):
    p = Tables(spark, d).part
    return p.groupBy(F.col("p_name").alias("material_name")).agg(F.min("p_partkey").alias("material_id"))


@register("agg_max_latest", oracle="""
SELECT o_custkey, max(o_orderkey) AS latest_orderkey FROM orders GROUP BY o_custkey
""")
def q_agg_max_latest(spark, d):
    o = Tables(spark, d).orders
    return o.groupBy("o_custkey").agg(F.max("o_orderkey").alias("latest_orderkey"))


@register("agg_cond_pivot", oracle="""
SELECT o_custkey,
       max(CASE WHEN o_orderstatus = 'F' THEN o_totalprice END) AS max_f,
       max(CASE WHEN o_orderstatus = 'O' THEN o_totalprice END) AS max_o,
       max(CASE WHEN o_orderstatus = 'P' THEN o_totalprice END) AS max_p,
       count(*) AS n
FROM orders GROUP BY o_custkey HAVING count(*) >= 2
""")
def q_agg_cond_pivot(spark, d):
    o = Tables(spark, d).orders
    aggs = [F.max(F.when(F.col("o_orderstatus") == s, F.col("o_totalprice"))).alias(f"max_{s.lower()}")
            for s in ("F", "O", "P")]
    return o.groupBy("o_custkey").agg(*aggs, F.count(F.lit(1)).alias("n")).filter(F.col("n") >= 2)


@register("agg_distinct", oracle="""
SELECT DISTINCT p_brand, p_type FROM part
""")
def q_agg_distinct(spark, d):
    return Tables(spark, d).part.select("p_brand", "p_type").distinct()


@register("agg_kv_pivot", oracle="""
SELECT conv_id,
       arg_max(text, turn) FILTER (WHERE role = 'user') AS "user",
       arg_max(text, turn) FILTER (WHERE role = 'assistant') AS assistant,
       arg_max(text, turn) FILTER (WHERE role = 'system') AS system
FROM conversations GROUP BY conv_id
""")
def q_agg_kv_pivot(spark, d):
    c = Tables(spark, d).conversations.withColumn("v", F.col("text"))
    return A.kv_pivot(c, ["conv_id"], "role", "v", "turn", ["user", "assistant", "system"])


@register("ml_class_balance", oracle="""
WITH c AS (SELECT quality, count(*) AS n FROM labels GROUP BY quality)
SELECT quality, n, (SELECT count(*) FROM c) < 2 AS single_class FROM c
""")
def q_ml_class_balance(spark, d):
    return A.class_balance(Tables(spark, d).labels, "quality")


@register("ml_confusion", oracle="""
SELECT quality AS y_true, toxic AS y_pred, count(*) AS n FROM labels GROUP BY quality, toxic
""")
def q_ml_confusion(spark, d):
    return A.confusion(Tables(spark, d).labels, "quality", "toxic")


@register("ml_class_report", oracle="""
WITH cm AS (SELECT quality AS y, toxic AS p, count(*) AS n FROM labels GROUP BY 1, 2),
cls AS (SELECT y AS c FROM cm UNION SELECT p FROM cm),
per AS (
  SELECT c, coalesce((SELECT sum(n) FROM cm WHERE y = c AND p = c), 0) AS tp,
         coalesce((SELECT sum(n) FROM cm WHERE p = c), 0) AS n_pred,
         coalesce((SELECT sum(n) FROM cm WHERE y = c), 0) AS support
  FROM cls),
m AS (SELECT CAST(c AS VARCHAR) AS label,
             CASE WHEN n_pred > 0 THEN tp / n_pred ELSE 0.0 END AS precision,
             CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS recall,
             CAST(support AS BIGINT) AS support, tp FROM per),
f AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1 FROM m)
SELECT label, precision, recall, f1, support FROM f
UNION ALL SELECT 'accuracy', NULL, NULL, sum(tp) / sum(support), sum(support) FROM f
UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM f
UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
                 sum(f1 * support) / sum(support), sum(support) FROM f
""")
def q_ml_class_report(spark, d):
    return A.class_report(Tables(spark, d).labels, "quality", "toxic")
