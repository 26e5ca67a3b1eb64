"""Stand-ins for the scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

import sparkmart.functions as SF
from sparkmart.standins import Tables, register
from sparkmart.standins.frames import str_to_num_duck


@register("str_normalize", oracle=r"""
SELECT doc_id, trim(regexp_replace(coalesce(text, ''), '\s+', ' ', 'g')) AS norm_text FROM documents
""")
def q_str_normalize(spark, d):
    t = Tables(spark, d).documents
    return t.select("doc_id", SF.normalize_ws("text").alias("norm_text"))


@register("str_clean_text", oracle=r"""
SELECT conv_id, turn, nullif(trim(regexp_replace(coalesce(CASE WHEN turn % 7 = 0 THEN '  ' ELSE text END, ''),
       '\s+', ' ', 'g')), '') AS clean_text
FROM conversations
""")
def q_str_clean_text(spark, d):
    t = Tables(spark, d).conversations
    txt = F.when(F.col("turn") % 7 == 0, F.lit("  ")).otherwise(F.col("text"))
    return t.select("conv_id", "turn", SF.clean_text(txt).alias("clean_text"))


@register("str_num_only", oracle=r"""
SELECT c_custkey, TRY_CAST(nullif(regexp_replace(c_name, '[^0-9]', '', 'g'), '') AS BIGINT) AS num,
       TRY_CAST(nullif(regexp_replace(c_mktsegment, '[^0-9]', '', 'g'), '') AS BIGINT) AS seg_num
FROM customer
""")
def q_str_num_only(spark, d):
    t = Tables(spark, d).customer
    return t.select("c_custkey", SF.num_only("c_name").alias("num"), SF.num_only("c_mktsegment").alias("seg_num"))


_STN = str_to_num_duck("src_text")


@register("str_to_num", oracle=f"""
WITH src AS (
  SELECT 'events' AS source, event_id AS id, props AS src_text FROM events
  UNION ALL SELECT 'customer', c_custkey, c_name FROM customer
  UNION ALL SELECT 'customer_long', c_custkey, CAST(c_custkey AS VARCHAR) || repeat('7', CAST(c_custkey % 34 AS INTEGER)) || '원' FROM customer
  UNION ALL SELECT 'part', p_partkey, printf('%.3f', p_retailprice / 7) || ' 원' FROM part
  UNION ALL SELECT 'part_name', p_partkey, p_name FROM part
  UNION ALL SELECT 'part_dots', p_partkey, CAST(p_size AS VARCHAR) || '.' || CAST(p_size AS VARCHAR) || '.' FROM part
)
SELECT source, id, src_text, {_STN} AS num FROM src
""")
def q_str_to_num(spark, d):
    t = Tables(spark, d)
    src = (t.events.select(F.lit("events").alias("source"), F.col("event_id").alias("id"), F.col("props").alias("src_text"))
           .unionByName(t.customer.select(F.lit("customer").alias("source"), F.col("c_custkey").alias("id"),
                                          F.col("c_name").alias("src_text")))
           .unionByName(t.customer.select(F.lit("customer_long").alias("source"), F.col("c_custkey").alias("id"),
                                          F.concat(F.col("c_custkey").cast("string"),
                                                   F.repeat(F.lit("7"), (F.col("c_custkey") % 34).cast("int")),
                                                   F.lit("원")).alias("src_text")))
           .unionByName(t.part.select(F.lit("part").alias("source"), F.col("p_partkey").alias("id"),
                                      F.concat(F.format_string("%.3f", F.col("p_retailprice") / 7), F.lit(" 원")).alias("src_text")))
           .unionByName(t.part.select(F.lit("part_name").alias("source"), F.col("p_partkey").alias("id"),
                                      F.col("p_name").alias("src_text")))
           .unionByName(t.part.select(F.lit("part_dots").alias("source"), F.col("p_partkey").alias("id"),
                                      F.concat_ws(".", F.col("p_size").cast("string"), F.col("p_size").cast("string"),
                                                  F.lit("")).alias("src_text"))))
    return src.select("source", "id", "src_text", SF.str_to_num("src_text").alias("num"))


@register("str_https", oracle=r"""
SELECT page_id, regexp_replace(url, '^https?:', '') AS rel_url,
       CASE WHEN regexp_replace(url, '^https?:', '') = '' THEN NULL
            WHEN starts_with(regexp_replace(url, '^https?:', ''), '//') THEN 'https:' || regexp_replace(url, '^https?:', '')
            ELSE regexp_replace(url, '^https?:', '') END AS abs_url
FROM pages
""")
def q_str_https(spark, d):
    t = Tables(spark, d).pages
    rel = F.regexp_replace("url", "^https?:", "")
    return t.select("page_id", rel.alias("rel_url"), SF.https(rel).alias("abs_url"))


@register("str_drop_first", oracle="""
SELECT doc_id,
       CASE WHEN strpos(text, '|') > 0 THEN substr(text, 1, strpos(text, '|') - 1) || substr(text, strpos(text, '|') + 1)
            ELSE text END AS dropped
FROM documents
""")
def q_str_drop_first(spark, d):
    t = Tables(spark, d).documents
    return t.select("doc_id", SF.drop_first_char("text", "|").alias("dropped"))


@register("str_after_dot", oracle="""
SELECT page_id, substr(url, strpos(url, '.') + 1) AS after_dot FROM pages
""")
def q_str_after_dot(spark, d):
    t = Tables(spark, d).pages
    return t.select("page_id", SF.after_first_dot("url").alias("after_dot"))


_TEMPLATE = "https://img.example.com/static/{7}/{6}/{4}{5}/{2}{3}/onair{id}.{ext}?AR=0"


@register("str_url_template", oracle="""
WITH p AS (SELECT p_partkey, lpad(CAST(p_partkey AS VARCHAR), 10, '0') AS pid,
                  substr(p_name || '.jpg', strpos(p_name || '.jpg', '.') + 1) AS ext FROM part)
SELECT p_partkey, pid,
       'https://img.example.com/static/' || substr(pid, 8, 1) || '/' || substr(pid, 7, 1) || '/' ||
       substr(pid, 5, 1) || substr(pid, 6, 1) || '/' || substr(pid, 3, 1) || substr(pid, 4, 1) ||
       '/onair' || pid || '.' || ext || '?AR=0' AS img_url
FROM p
""")
def q_str_url_template(spark, d):
    t = Tables(spark, d).part
    pid = F.lpad(F.col("p_partkey").cast("string"), 10, "0")
    ext = SF.after_first_dot(F.concat("p_name", F.lit(".jpg")))
    return t.select("p_partkey", pid.alias("pid"),
                    SF.id_url_template(pid, _TEMPLATE, ext).alias("img_url"))


@register("str_base64", oracle="""
SELECT o_orderkey, to_base64(encode(CAST(o_orderkey AS VARCHAR))) AS b64,
       'https://shop.example.com/detail?q=' || to_base64(encode(CAST(o_orderkey AS VARCHAR))) AS query_url
FROM orders
""")
def q_str_base64(spark, d):
    t = Tables(spark, d).orders
    b = SF.base64_text("o_orderkey")
    return t.select("o_orderkey", b.alias("b64"),
                    F.concat(F.lit("https://shop.example.com/detail?q="), b).alias("query_url"))


@register("str_join", oracle="""
SELECT conv_id, turn,
       array_to_string(list_filter([role, CASE WHEN turn % 3 = 0 THEN '' ELSE text END,
                                    CAST(turn AS VARCHAR), CASE WHEN turn % 2 = 0 THEN NULL ELSE 'odd' END],
                                   lambda x: x IS NOT NULL AND trim(x) <> ''), ', ') AS joined
FROM conversations
""")
def q_str_join(spark, d):
    t = Tables(spark, d).conversations
    arr = F.array(F.col("role"),
                  F.when(F.col("turn") % 3 == 0, F.lit("")).otherwise(F.col("text")),
                  F.col("turn").cast("string"),
                  F.when(F.col("turn") % 2 == 0, F.lit(None).cast("string")).otherwise(F.lit("odd")))
    return t.select("conv_id", "turn", SF.join_nonempty(arr, ", ").alias("joined"))


@register("str_strip_currency", oracle="""
WITH o AS (SELECT o_orderkey, format('{:,}', CAST(floor(o_totalprice) AS BIGINT)) || '원' AS price_text FROM orders)
SELECT o_orderkey, price_text,
       CAST(replace(regexp_replace(regexp_replace(price_text, '\\s*(원|₩)$', ''), '^₩\\s*', ''), ',', '') AS BIGINT) AS price
FROM o
""")
def q_str_strip_currency(spark, d):
    t = Tables(spark, d).orders
    txt = F.concat(F.format_number(F.floor("o_totalprice"), 0), F.lit("원"))
    return t.select("o_orderkey", txt.alias("price_text"), SF.strip_currency(txt).cast("bigint").alias("price"))


@register("str_label_to_int", oracle="""
WITH o AS (SELECT o_orderkey,
                  CASE o_orderstatus WHEN 'F' THEN ' True ' WHEN 'O' THEN 'f' ELSE o_orderstatus END AS lbl,
                  substr(o_orderpriority, 1, 1) AS prio FROM orders)
SELECT o_orderkey, lbl, prio,
       CASE WHEN lower(trim(lbl)) IN ('식품', '1', 'true', 't', 'y') THEN 1 WHEN lbl IS NOT NULL THEN 0 END AS food_label,
       CASE WHEN lower(trim(lbl)) IN ('1', 'true', 't', 'y', 'ing', 'ingredient') THEN 1
            WHEN lower(trim(lbl)) IN ('0', 'false', 'f', 'n', 'fin', 'finished', 'product') THEN 0 END AS ing_label,
       CASE WHEN lower(trim(prio)) IN ('1', 'true', 't', 'y', 'ing', 'ingredient') THEN 1
            WHEN lower(trim(prio)) IN ('0', 'false', 'f', 'n', 'fin', 'finished', 'product') THEN 0 END AS prio_label
FROM o
""")
def q_str_label_to_int(spark, d):
    t = Tables(spark, d).orders
    lbl = (F.when(F.col("o_orderstatus") == "F", F.lit(" True ")).when(F.col("o_orderstatus") == "O", F.lit("f"))
           .otherwise(F.col("o_orderstatus")))
    prio = F.substring("o_orderpriority", 1, 1)
    return t.select("o_orderkey", lbl.alias("lbl"), prio.alias("prio"),
                    SF.label_to_int(lbl, SF.FOOD_TRUE_LABELS, []).alias("food_label"),
                    SF.label_to_int(lbl).alias("ing_label"),
                    SF.label_to_int(prio).alias("prio_label"))


@register("dt_format", oracle="""
SELECT event_id, strftime(ts, '%H:%M') AS hhmm,
       coalesce(strftime(CASE WHEN event_id % 13 = 0 THEN NULL ELSE ts END, '%Y%m%d'), '') AS yyyymmdd
FROM events
""")
def q_dt_format(spark, d):
    t = Tables(spark, d).events
    ts2 = F.when(F.col("event_id") % 13 == 0, F.lit(None)).otherwise(F.col("ts"))
    return t.select("event_id", SF.fmt_hhmm("ts").alias("hhmm"), SF.fmt_yyyymmdd(ts2).alias("yyyymmdd"))


@register("dt_on_air", oracle="""
WITH e AS (SELECT event_id,
                  CASE WHEN event_type = 'view' THEN '지금방송중' ELSE strftime(ts, '%H:%M') || ' ~ ' || strftime(ts + INTERVAL 1 HOUR, '%H:%M') END AS live_time,
                  strftime(ts + INTERVAL 1 HOUR, '%H:%M') AS end_time FROM events)
SELECT event_id, live_time,
       CASE WHEN trim(live_time) = '지금방송중' THEN strftime(TIMESTAMP '2024-01-15 03:00:00' + INTERVAL 9 HOUR, '%H:%M') || ' ~ ' || end_time
            ELSE live_time END AS live_range
FROM e
""")
def q_dt_on_air(spark, d):
    t = Tables(spark, d).events
    end = SF.fmt_hhmm(F.col("ts") + F.expr("INTERVAL 1 HOUR"))
    live = (F.when(F.col("event_type") == "view", F.lit(SF.ON_AIR_TEXT))
            .otherwise(F.concat(SF.fmt_hhmm("ts"), F.lit(" ~ "), end)))
    return t.select("event_id", live.alias("live_time"),
                    SF.on_air_range(live, end, "2024-01-15 03:00:00").alias("live_range"))


@register("dt_range", oracle="""
SELECT l_orderkey, l_linenumber, l_partkey,
       strftime(l_shipdate, '%Y-%m-%d') || ' ~ ' || strftime(l_shipdate + to_days(l_linenumber), '%Y-%m-%d') AS ship_range
FROM lineitem
""")
def q_dt_range(spark, d):
    t = Tables(spark, d).lineitem
    start = F.date_format("l_shipdate", "yyyy-MM-dd")
    end = F.date_format(F.date_add(F.col("l_shipdate"), F.col("l_linenumber")), "yyyy-MM-dd")
    return t.select("l_orderkey", "l_linenumber", "l_partkey", SF.time_range(start, end).alias("ship_range"))


_LIST_SALE_SQL = """
WITH b AS (
  SELECT l_orderkey, l_linenumber, l_partkey,
         CASE WHEN l_linenumber = 7 THEN NULL ELSE CAST(round(p_retailprice * 10) AS BIGINT) END AS list_price,
         CASE WHEN l_returnflag = 'R' AND l_linenumber = 1 THEN CAST(round(p_retailprice * 10) AS BIGINT) + 5
              ELSE CAST(round(p_retailprice * 10) AS BIGINT) - CAST(round(l_discount * 200) AS BIGINT) END AS sale_price
  FROM lineitem JOIN part ON l_partkey = p_partkey
)"""


def _list_sale(t: Tables):
    li, p = t.lineitem, t.part
    base = F.round(F.col("p_retailprice") * 10).cast("bigint")
    lst = F.when(F.col("l_linenumber") == 7, F.lit(None).cast("bigint")).otherwise(base)
    sale = (F.when((F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 1), base + 5)
            .otherwise(base - F.round(F.col("l_discount") * 200).cast("bigint")))
    return li.join(p, li.l_partkey == p.p_partkey).select(
        "l_orderkey", "l_linenumber", "l_partkey", lst.alias("list_price"), sale.alias("sale_price"))


@register("mth_discount_rate", oracle=_LIST_SALE_SQL + """
SELECT l_orderkey, l_linenumber, l_partkey, sale_price,
       coalesce(list_price, sale_price) AS list_price,
       CASE WHEN list_price IS NULL AND sale_price IS NOT NULL THEN 0
            WHEN list_price > 0 AND sale_price > 0 AND sale_price <= list_price
            THEN CAST(round_even((list_price - sale_price) * 100.0 / list_price, 0) AS INTEGER) END AS dc_rate
FROM b
""")
def q_mth_discount_rate(spark, d):
    b = _list_sale(Tables(spark, d))
    rate = F.coalesce(SF.discount_rate("list_price", "sale_price"),
                      F.when(F.col("list_price").isNull() & F.col("sale_price").isNotNull(), F.lit(0)))
    return b.select("l_orderkey", "l_linenumber", "l_partkey", "sale_price",
                    F.coalesce("list_price", "sale_price").alias("list_price"), rate.alias("dc_rate"))


@register("mth_signed_rate", oracle=_LIST_SALE_SQL + """
SELECT l_orderkey, l_linenumber, l_partkey,
       CAST(round_even((sale_price - list_price) * 100.0 / nullif(list_price, 0), 0) AS INTEGER) AS signed_rate
FROM b
""")
def q_mth_signed_rate(spark, d):
    b = _list_sale(Tables(spark, d))
    return b.select("l_orderkey", "l_linenumber", "l_partkey",
                    SF.signed_rate("sale_price", "list_price").alias("signed_rate"))


@register("arr_pad_index", oracle="""
SELECT vec_id, embedding[1] AS e0, embedding[2] AS e1, embedding[64] AS e63, embedding[71] AS e70 FROM embeddings
""")
def q_arr_pad_index(spark, d):
    t = Tables(spark, d).embeddings
    return t.select("vec_id", *[SF.pad_index("embedding", i).alias(f"e{i}") for i in (0, 1, 63, 70)])


@register("arr_srcset_last", oracle="""
WITH s AS (SELECT l_orderkey, l_linenumber, l_partkey,
                  '/img/' || l_orderkey || '-' || l_linenumber || '_s.jpg 1x, /img/' || l_orderkey || '-' ||
                  l_linenumber || '_l.jpg ' || l_linenumber || 'x' AS srcset FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, srcset, '/img/' || l_orderkey || '-' || l_linenumber || '_l.jpg' AS last_url FROM s
""")
def q_arr_srcset_last(spark, d):
    t = Tables(spark, d).lineitem
    ss = F.concat(F.lit("/img/"), F.col("l_orderkey"), F.lit("-"), F.col("l_linenumber"), F.lit("_s.jpg 1x, /img/"),
                  F.col("l_orderkey"), F.lit("-"), F.col("l_linenumber"), F.lit("_l.jpg "), F.col("l_linenumber"), F.lit("x"))
    return t.select("l_orderkey", "l_linenumber", "l_partkey", ss.alias("srcset"), SF.srcset_last(ss).alias("last_url"))


@register("json_path", oracle="""
SELECT event_id, json_extract_string(props, '$.k') AS k, json_extract_string(props, '$.props.pageProps.x') AS deep
FROM events
""")
def q_json_path(spark, d):
    t = Tables(spark, d).events
    return t.select("event_id", SF.json_path("props", "$.k").alias("k"),
                    SF.json_path("props", "$.props.pageProps.x").alias("deep"))


@register("json_key_profile", oracle="""
SELECT key, count(*) AS n_docs FROM (SELECT unnest(json_keys(props)) AS key FROM events) GROUP BY key
""")
def q_json_key_profile(spark, d):
    t = Tables(spark, d).events
    return (t.select(F.explode(SF.json_top_keys("props")).alias("key"))
            .groupBy("key").agg(F.count(F.lit(1)).alias("n_docs")))


@register("url_decompose", oracle=r"""
WITH u AS (SELECT page_id, url,
  regexp_extract(url, '^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://(?:([^:@/?#]*)(?::([^@/?#]*))?@)?([^:/?#]*)(?::([0-9]+))?)?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$',
                 ['scheme', 'usr', 'pwd', 'host', 'port', 'path', 'query', 'frag']) AS m FROM pages)
SELECT page_id, nullif(m.scheme, '') AS scheme, nullif(m.usr, '') AS "user", nullif(m.pwd, '') AS password,
       lower(nullif(m.host, '')) AS host,
       coalesce(TRY_CAST(nullif(m.port, '') AS INTEGER),
                CASE WHEN lower(m.scheme) LIKE 'mysql%' OR lower(m.scheme) LIKE 'mariadb%' THEN 3306
                     WHEN lower(m.scheme) LIKE 'postgres%' OR lower(m.scheme) LIKE 'pg%' THEN 5432 END) AS port,
       nullif(regexp_extract(url_decode(regexp_replace(m.path, '^/+', '')), '^([^/]*)', 1), '') AS database,
       nullif(m.query, '') AS query
FROM u
""")
def q_url_decompose(spark, d):
    t = Tables(spark, d).pages
    return t.select("page_id", SF.url_parts("url").alias("u")).select("page_id", "u.*")


@register("url_param", oracle=r"""
SELECT page_id,
  nullif(url_decode(regexp_extract(regexp_extract(url, '\?([^#]*)', 1), '(?:^|&)page=([^&]*)', 1)), '') AS page,
  nullif(url_decode(regexp_extract(regexp_extract(url, '\?([^#]*)', 1), '(?:^|&)ref=([^&]*)', 1)), '') AS ref,
  nullif(url_decode(regexp_extract(regexp_extract(url, '\?([^#]*)', 1), '(?:^|&)utm_source=([^&]*)', 1)), '') AS utm_source
FROM pages
""")
def q_url_param(spark, d):
    t = Tables(spark, d).pages
    return t.select("page_id", SF.url_param("url", "page").alias("page"), SF.url_param("url", "ref").alias("ref"),
                    SF.url_param("url", "utm_source").alias("utm_source"))


@register("str_to_num_sql", oracle=f"""
SELECT o_orderkey, o_orderpriority, {str_to_num_duck("o_orderpriority || '.' || CAST(o_custkey AS VARCHAR)")} AS num
FROM orders
""")
def q_str_to_num_sql(spark, d):
    """The stored SQL function form: STR_TO_NUM registered for the session
    (created if absent) and called from Spark SQL over a temp view."""
    SF.register_str_to_num(spark)
    Tables(spark, d).orders.createOrReplaceTempView("sm_orders")
    return spark.sql("SELECT o_orderkey, o_orderpriority, "
                     "STR_TO_NUM(o_orderpriority || '.' || CAST(o_custkey AS STRING)) AS num FROM sm_orders")
