"""Stand-ins for projections and filters."""

from __future__ import annotations

from pyspark.sql import functions as F

import sparkmart.functions as SF
from sparkmart.operators.projection import cast_rename, required
from sparkmart.standins import Tables, register


@register("prj_cast_rename", oracle="""
SELECT l_orderkey AS order_id, l_linenumber AS line_no, l_quantity AS qty, l_extendedprice AS price,
       CAST(round(l_discount * 100) AS DOUBLE) AS discount_rate, l_shipdate AS ship_ts,
       CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_linenumber END AS maybe_int
FROM lineitem
""")
def q_prj_cast_rename(spark, d):
    li = Tables(spark, d).lineitem
    raw = li.select(*[F.col(c).cast("string").alias(c) for c in
                      ("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_shipdate")],
                    F.concat(F.round(F.col("l_discount") * 100).cast("int").cast("string"), F.lit("%")).alias("rate_text"),
                    F.when(F.col("l_returnflag") == "R", F.lit("n/a")).otherwise(F.col("l_linenumber").cast("string"))
                    .alias("maybe_text"))
    return cast_rename(raw, [("l_orderkey", "order_id", "bigint"), ("l_linenumber", "line_no", "int"),
                             ("l_quantity", "qty", "double"), ("l_extendedprice", "price", "double"),
                             ("rate_text", "discount_rate", "num"), ("l_shipdate", "ship_ts", "timestamp_ntz"),
                             ("maybe_text", "maybe_int", "int")])


@register("prj_recipe", oracle="""
SELECT p_partkey AS recipe_id, p_name AS title, p_brand AS cooking_name, p_size AS scrap_count,
       p_type AS category FROM part
""")
def q_prj_recipe(spark, d):
    p = Tables(spark, d).part.select("p_partkey", "p_name", "p_brand", F.col("p_size").cast("string").alias("p_size"), "p_type")
    return cast_rename(p, [("p_partkey", "recipe_id", "bigint"), ("p_name", "title", "string"),
                           ("p_brand", "cooking_name", "string"), ("p_size", "scrap_count", "int"),
                           ("p_type", "category", "string")])


@register("prj_first_truthy", oracle="""
WITH e AS (SELECT event_id,
  CASE WHEN event_id % 3 = 0 THEN '' WHEN event_id % 3 = 1 THEN NULL ELSE event_type END AS a,
  CASE WHEN event_id % 5 = 0 THEN '  ' ELSE 'u' || CAST(user_id AS VARCHAR) END AS b,
  CASE WHEN event_id % 4 = 0 THEN 0 ELSE user_id END AS n1,
  CASE WHEN event_id % 6 = 0 THEN NULL ELSE event_id END AS n2
  FROM events)
SELECT event_id, coalesce(nullif(trim(a), ''), nullif(trim(b), ''), 'unknown') AS label,
       coalesce(nullif(n1, 0), nullif(n2, 0), -1) AS num
FROM e
""")
def q_prj_first_truthy(spark, d):
    ev = Tables(spark, d).events
    eid = F.col("event_id")
    a = F.when(eid % 3 == 0, F.lit("")).when(eid % 3 == 1, F.lit(None).cast("string")).otherwise(F.col("event_type"))
    b = F.when(eid % 5 == 0, F.lit("  ")).otherwise(F.concat(F.lit("u"), F.col("user_id").cast("string")))
    n1 = F.when(eid % 4 == 0, F.lit(0).cast("bigint")).otherwise(F.col("user_id"))
    n2 = F.when(eid % 6 == 0, F.lit(None).cast("bigint")).otherwise(eid)
    return ev.select("event_id", SF.first_truthy(a, b, F.lit("unknown")).alias("label"),
                     SF.first_positive(n1, n2, F.lit(-1).cast("bigint")).alias("num"))


@register("prj_blank_to_null", oracle="""
WITH c AS (SELECT conv_id, turn, CASE turn % 4 WHEN 1 THEN '' WHEN 2 THEN ' NaN ' ELSE text END AS t
           FROM conversations)
SELECT conv_id, turn, CASE WHEN lower(trim(t)) IN ('', 'nan') THEN NULL ELSE t END AS text FROM c
""")
def q_prj_blank_to_null(spark, d):
    c = Tables(spark, d).conversations
    t = (F.when(F.col("turn") % 4 == 1, F.lit("")).when(F.col("turn") % 4 == 2, F.lit(" NaN "))
         .otherwise(F.col("text")))
    return c.select("conv_id", "turn", SF.blank_to_null(t).alias("text"))


@register("prj_digits_or_zero", oracle="""
WITH o AS (SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_orderkey % 7 = 0 THEN '-12%'
                                   WHEN o_orderkey % 5 = 0 THEN '상담' ELSE o_orderpriority END AS prio FROM orders)
SELECT o_orderkey, prio, coalesce(TRY_CAST(nullif(regexp_replace(prio, '[^0-9]', '', 'g'), '') AS BIGINT), 0) AS prio_num
FROM o
""")
def q_prj_digits_or_zero(spark, d):
    o = Tables(spark, d).orders
    k = F.col("o_orderkey")
    prio = (F.when(k % 11 == 0, F.lit(None).cast("string")).when(k % 7 == 0, F.lit("-12%"))
            .when(k % 5 == 0, F.lit("상담")).otherwise(F.col("o_orderpriority")))
    return o.select("o_orderkey", prio.alias("prio"), SF.digits_or_zero(prio).alias("prio_num"))


@register("prj_case_source", oracle="""
SELECT d.doc_id,
       CASE WHEN l.quality IS NOT NULL THEN 'manual' WHEN d.text LIKE '%the%' THEN 'rule' ELSE 'pseudo' END AS label_source,
       coalesce(l.quality, CASE WHEN d.text LIKE '%the%' THEN 1 ELSE 0 END) AS label
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
""")
def q_prj_case_source(spark, d):
    t = Tables(spark, d)
    j = t.documents.join(t.labels, "doc_id", "left")
    rule = F.col("text").contains("the")
    return j.select("doc_id",
                    F.when(F.col("quality").isNotNull(), F.lit("manual")).when(rule, F.lit("rule"))
                    .otherwise(F.lit("pseudo")).alias("label_source"),
                    F.coalesce(F.col("quality"), F.when(rule, F.lit(1)).otherwise(F.lit(0))).alias("label"))


@register("prj_truncate", oracle="""
SELECT doc_id, substr(text, 1, 4000) AS text_4000, substr(text, 1, 1000) AS text_1000, length(text) AS n_chars FROM documents
""")
def q_prj_truncate(spark, d):
    t = Tables(spark, d).documents
    return t.select("doc_id", SF.truncate("text", 4000).alias("text_4000"), SF.truncate("text", 1000).alias("text_1000"),
                    F.char_length("text").alias("n_chars"))


@register("flt_required", oracle="""
SELECT d.doc_id, d.lang, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
WHERE l.quality IS NOT NULL AND l.toxic IS NOT NULL AND d.lang IS NOT NULL
""")
def q_flt_required(spark, d):
    t = Tables(spark, d)
    j = t.documents.join(t.labels, "doc_id", "left").select("doc_id", "lang", "quality", "toxic")
    return required(j, ["lang", "quality", "toxic"])


@register("flt_unlabelled", oracle="""
SELECT d.doc_id, d.source FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE l.quality IS NULL
""")
def q_flt_unlabelled(spark, d):
    t = Tables(spark, d)
    return t.documents.join(t.labels, "doc_id", "left").filter(F.col("quality").isNull()).select("doc_id", "source")


@register("flt_like", oracle="""
SELECT p_partkey, p_name FROM part WHERE p_name LIKE '%red%' AND p_name NOT LIKE '%bolt%'
""")
def q_flt_like(spark, d):
    p = Tables(spark, d).part
    return p.filter(F.col("p_name").contains("red") & ~F.col("p_name").contains("bolt")).select("p_partkey", "p_name")


@register("flt_isdigit", oracle=r"""
WITH s AS (SELECT page_id, regexp_extract(url, '^[a-z]+://[^/]+/(?:[^/?#]*/)*([^/?#]*)', 1) AS seg FROM pages)
SELECT page_id, seg FROM s WHERE regexp_full_match(seg, '[0-9]+')
""")
def q_flt_isdigit(spark, d):
    p = Tables(spark, d).pages
    seg = F.regexp_extract("url", r"^[a-z]+://[^/]+/(?:[^/?#]*/)*([^/?#]*)", 1)
    return p.select("page_id", seg.alias("seg")).filter(F.col("seg").rlike("^[0-9]+$"))


@register("flt_url", oracle="""
WITH h AS (SELECT page_id, unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS href FROM pages),
v AS (SELECT page_id, CASE WHEN href LIKE '%a%' THEN href ELSE href || '.gif' END AS href FROM h
      UNION ALL SELECT page_id, 'data:image/png;base64,AAAA' FROM pages
      UNION ALL SELECT page_id, '' FROM pages)
SELECT page_id, href FROM v
WHERE href IS NOT NULL AND href <> '' AND NOT ends_with(lower(href), '.gif') AND NOT starts_with(href, 'data:')
""")
def q_flt_url(spark, d):
    p = Tables(spark, d).pages
    h = p.select("page_id", F.explode(F.regexp_extract_all("html", F.lit('href="([^"]*)"'), 1)).alias("href"))
    v = (h.select("page_id", F.when(F.col("href").contains("a"), F.col("href"))
                  .otherwise(F.concat("href", F.lit(".gif"))).alias("href"))
         .unionByName(p.select("page_id", F.lit("data:image/png;base64,AAAA").alias("href")))
         .unionByName(p.select("page_id", F.lit("").alias("href"))))
    return v.filter(SF.keep_image_url("href"))
