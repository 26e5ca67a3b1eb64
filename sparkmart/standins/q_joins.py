"""Stand-ins for joins, set operations, windows and top-k (SURVEY §2.3,
§2.6-2.8)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

import sparkmart.functions as SF
from sparkmart.operators import relational as R
from sparkmart.standins import Tables, register
from sparkmart.standins.frames import LINE_ORDER


@register("jn_left_aggs", oracle="""
SELECT p_partkey, p_name, r.n_returned, o.n_open
FROM part
LEFT JOIN (SELECT l_partkey, count(l_orderkey) AS n_returned FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_partkey) r
  ON r.l_partkey = p_partkey
LEFT JOIN (SELECT l_partkey, count(l_orderkey) AS n_open FROM lineitem WHERE l_linestatus = 'O' GROUP BY l_partkey) o
  ON o.l_partkey = p_partkey
""")
def q_jn_left_aggs(spark, d):
    t = Tables(spark, d)
    li = t.lineitem
    r = li.filter(F.col("l_returnflag") == "R").groupBy(F.col("l_partkey").alias("p_partkey")) \
        .agg(F.count("l_orderkey").alias("n_returned"))
    o = li.filter(F.col("l_linestatus") == "O").groupBy(F.col("l_partkey").alias("p_partkey")) \
        .agg(F.count("l_orderkey").alias("n_open"))
    return t.part.select("p_partkey", "p_name").join(r, "p_partkey", "left").join(o, "p_partkey", "left")


@register("jn_lookup_first", oracle="""
WITH dim AS (
  SELECT p_partkey AS l_partkey, p_name AS dim_name, 1 AS prio FROM part WHERE p_partkey % 17 <> 0
  UNION ALL SELECT p_partkey, 'dup-' || p_brand, 0 FROM part WHERE p_partkey % 3 = 0 AND p_partkey % 17 <> 0
),
first AS (SELECT l_partkey, dim_name FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY prio, dim_name) AS rn FROM dim) WHERE rn = 1)
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, f.dim_name FROM lineitem l LEFT JOIN first f ON l.l_partkey = f.l_partkey
""")
def q_jn_lookup_first(spark, d):
    t = Tables(spark, d)
    p = t.part.filter(F.col("p_partkey") % 17 != 0)
    dim = (p.select(F.col("p_partkey").alias("l_partkey"), F.col("p_name").alias("dim_name"), F.lit(1).alias("prio"))
           .unionByName(p.filter(F.col("p_partkey") % 3 == 0).select(
               F.col("p_partkey").alias("l_partkey"), F.concat(F.lit("dup-"), F.col("p_brand")).alias("dim_name"),
               F.lit(0).alias("prio"))))
    out = R.lookup_first(t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey"), dim, "l_partkey",
                         ["prio", "dim_name"])
    return out.drop("prio")


@register("jn_semi", oracle="""
SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')
""")
def q_jn_semi(spark, d):
    t = Tables(spark, d)
    return t.customer.join(t.orders.filter(F.col("o_orderstatus") == "P").select(F.col("o_custkey").alias("c_custkey")),
                           "c_custkey", "left_semi").select("c_custkey", "c_name")


@register("jn_semi_batch", oracle="""
WITH acc AS (SELECT o_orderkey FROM orders WHERE o_orderdate >= TIMESTAMP '1999-01-01' AND o_orderstatus <> 'P')
SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM acc)
""")
def q_jn_semi_batch(spark, d):
    t = Tables(spark, d)
    acc = t.orders.filter((F.col("o_orderdate") >= F.lit("1999-01-01").cast("timestamp_ntz"))
                          & (F.col("o_orderstatus") != "P")).select(F.col("o_orderkey").alias("l_orderkey"))
    return t.lineitem.join(acc, "l_orderkey", "left_semi").select("l_orderkey", "l_linenumber", "l_partkey")


_NOT_IN_VARIANTS = """
WITH o AS (SELECT CASE WHEN o_orderkey % 1000 = 999 THEN NULL ELSE o_orderkey END AS k, o_orderkey FROM orders),
ref_plain AS (SELECT l_orderkey AS k FROM lineitem),
ref_null AS (SELECT CASE WHEN l_orderkey % 5000 = 7 THEN NULL ELSE l_orderkey END AS k FROM lineitem),
ref_empty AS (SELECT l_orderkey AS k FROM lineitem WHERE l_orderkey < 0)
"""


def _not_in_frames(t):
    o = t.orders.select(F.when(F.col("o_orderkey") % 1000 == 999, F.lit(None)).otherwise(F.col("o_orderkey")).alias("k"),
                        "o_orderkey")
    li = t.lineitem
    refs = {
        "plain": li.select(F.col("l_orderkey").alias("k")),
        "ref_null": li.select(F.when(F.col("l_orderkey") % 5000 == 7, F.lit(None)).otherwise(F.col("l_orderkey")).alias("k")),
        "empty_ref": li.filter(F.col("l_orderkey") < 0).select(F.col("l_orderkey").alias("k")),
    }
    return o, refs


@register("jn_not_in", oracle=_NOT_IN_VARIANTS + """
SELECT 'plain' AS variant, o_orderkey FROM o WHERE k NOT IN (SELECT k FROM ref_plain)
UNION ALL SELECT 'ref_null', o_orderkey FROM o WHERE k NOT IN (SELECT k FROM ref_null)
UNION ALL SELECT 'empty_ref', o_orderkey FROM o WHERE k NOT IN (SELECT k FROM ref_empty)
""")
def q_jn_not_in(spark, d):
    o, refs = _not_in_frames(Tables(spark, d))
    out = None
    for name, ref in refs.items():
        part = R.anti_not_in(o, "k", ref).select(F.lit(name).alias("variant"), "o_orderkey")
        out = part if out is None else out.unionByName(part)
    return out


@register("jn_incremental", oracle="""
SELECT 'seen' AS variant, o_orderkey FROM orders
WHERE o_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01')
UNION ALL SELECT 'nothing_seen', o_orderkey FROM orders
""")
def q_jn_incremental(spark, d):
    o = Tables(spark, d).orders
    seen = o.filter(F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz"))
    a = R.unseen(o, "o_orderkey", seen).select(F.lit("seen").alias("variant"), "o_orderkey")
    b = R.unseen(o, "o_orderkey", seen.filter(F.lit(False))).select(F.lit("nothing_seen").alias("variant"), "o_orderkey")
    return a.unionByName(b)


@register("jn_zip", oracle="""
WITH z AS (
  SELECT conv_id, turn, string_split(text, chr(10)) AS lines,
         list_filter(string_split(regexp_replace(text, '[^A-Za-z ]', '', 'g'), ' '), lambda x: x <> '') AS words
  FROM conversations
)
SELECT conv_id, turn, i AS pos, lines[i] AS line, words[i] AS word
FROM z, range(1, 1 + least(len(lines), len(words))) AS r(i)
""")
def q_jn_zip(spark, d):
    c = Tables(spark, d).conversations
    arrs = c.select("conv_id", "turn", F.split("text", "\n").alias("lines"),
                    SF.split_nonempty(F.regexp_replace("text", "[^A-Za-z ]", ""), " ").alias("words"))
    z = arrs.select("conv_id", "turn", F.posexplode(SF.zip_shortest("lines", "words")).alias("p", "z"))
    return z.select("conv_id", "turn", (F.col("p") + 1).cast("bigint").alias("pos"),
                    F.col("z.lines").alias("line"), F.col("z.words").alias("word"))


@register("set_intersect", oracle="""
SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')
INTERSECT
SELECT c_custkey FROM customer WHERE c_nationkey NOT IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 1)
""")
def q_set_intersect(spark, d):
    t = Tables(spark, d)
    a = R.anti_not_in(t.customer, "c_custkey",
                      t.orders.filter(F.col("o_orderstatus") == "F").select(F.col("o_custkey").alias("c_custkey")))
    b = R.anti_not_in(t.customer, "c_nationkey",
                      t.nation.filter(F.col("n_regionkey") == 1).select(F.col("n_nationkey").alias("c_nationkey")))
    return a.select("c_custkey").intersect(b.select("c_custkey"))


@register("set_union_by_name", oracle="""
SELECT c_custkey AS party_id, c_name AS name, c_nationkey AS nationkey, c_acctbal AS acctbal, c_mktsegment AS segment
FROM customer
UNION ALL
SELECT s_suppkey, s_name, s_nationkey, s_acctbal, NULL FROM supplier
""")
def q_set_union_by_name(spark, d):
    t = Tables(spark, d)
    c = t.customer.select(F.col("c_custkey").alias("party_id"), F.col("c_name").alias("name"),
                          F.col("c_nationkey").alias("nationkey"), F.col("c_acctbal").alias("acctbal"),
                          F.col("c_mktsegment").alias("segment"))
    s = t.supplier.select(F.col("s_suppkey").alias("party_id"), F.col("s_name").alias("name"),
                          F.col("s_nationkey").alias("nationkey"), F.col("s_acctbal").alias("acctbal"))
    return c.unionByName(s, allowMissingColumns=True)


@register("win_latest_two", oracle="""
SELECT o_custkey, o_orderkey, rn FROM (
  SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS rn FROM orders)
WHERE rn <= 2
""")
def q_win_latest_two(spark, d):
    o = Tables(spark, d).orders
    w = Window.partitionBy("o_custkey").orderBy(F.col("o_orderkey").desc())
    return o.select("o_custkey", "o_orderkey", F.row_number().over(w).alias("rn")).filter(F.col("rn") <= 2)


@register("win_first_wins", oracle="""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY
     l_shipdate, l_orderkey, l_linenumber, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
     l_returnflag, l_linestatus, l_partkey) AS rn FROM lineitem)
WHERE rn = 1
""")
def q_win_first_wins(spark, d):
    li = Tables(spark, d).lineitem
    return R.first_wins(li, ["l_orderkey", "l_linenumber"], LINE_ORDER + ["l_partkey"])


@register("srt_batch", oracle="""
SELECT d.doc_id, d.lang FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
WHERE l.doc_id IS NULL ORDER BY d.doc_id LIMIT 500
""")
def q_srt_batch(spark, d):
    t = Tables(spark, d)
    todo = t.documents.join(t.labels, "doc_id", "left_anti").select("doc_id", "lang")
    return todo.orderBy("doc_id").limit(500)


@register("srt_limit_distinct", oracle="""
SELECT DISTINCT o_custkey FROM orders WHERE o_orderstatus = 'O' ORDER BY o_custkey LIMIT 100
""")
def q_srt_limit_distinct(spark, d):
    o = Tables(spark, d).orders
    return o.filter(F.col("o_orderstatus") == "O").select("o_custkey").distinct().orderBy("o_custkey").limit(100)


@register("srt_first_k", oracle="""
SELECT conv_id, turn, role FROM (
  SELECT conv_id, turn, role, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS rn FROM conversations)
WHERE rn <= 3
""")
def q_srt_first_k(spark, d):
    c = Tables(spark, d).conversations
    w = Window.partitionBy("conv_id").orderBy("turn")
    return c.select("conv_id", "turn", "role", F.row_number().over(w).alias("rn")).filter(F.col("rn") <= 3).drop("rn")
