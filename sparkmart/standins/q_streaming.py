"""Stand-ins for the Structured Streaming jobs."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from sparkmart.operators.contracts import KeyCounts
from sparkmart.plans import classify as C
from sparkmart.plans import kok
from sparkmart.plans import refresh as RF
from sparkmart.session import scratch_path
from sparkmart.sources.keyed_table import KeyedTable
from sparkmart.standins import Tables, register
from sparkmart.standins.frames import LINE_ORDER, kok_prices
from sparkmart.standins.q_jobs import PRICE_DELTA_CTES
from sparkmart.standins.q_text import FINISHED, INGREDIENT, _NORM, _RULE_SQL
from sparkmart.streaming import incremental as S


def _dirs(spark, name):
    base = scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")
    return f"{base}/source", f"{base}/target", f"{base}/checkpoint"


@register("stm_incremental", oracle="""
SELECT event_id, ts, user_id, event_type, value FROM events
""")
def q_stm_incremental(spark, d):
    # arrivals are simulated from the table as stored (one file per arrival
    # here; a cluster-sized arrival is many files and would set
    # maxFilesPerTrigger accordingly)
    ev = spark.read.parquet(f"{d.rstrip('/')}/events.parquet").drop("props")
    src, tgt, ckpt = _dirs(spark, "stm_incremental")
    # three arrival files; the second repeats part of the first (re-sent rows)
    ev.filter(F.col("event_id") % 3 == 0).write.mode("append").parquet(src)
    ev.filter((F.col("event_id") % 3 == 1) | (F.col("event_id") % 9 == 0)).write.mode("append").parquet(src)
    ev.filter(F.col("event_id") % 3 == 2).write.mode("append").parquet(src)
    target = KeyedTable(spark, tgt, ev.schema, "event_id")
    S.incremental_load(spark, src, ev.schema, target, ckpt, order_by=["ts", "event_id"], max_files_per_trigger=1)
    return target.read()


@register("stm_score", oracle=f"""
WITH n AS (SELECT doc_id, {_NORM} AS s FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic IS NOT NULL)), r AS (SELECT doc_id, {_RULE_SQL} AS rl FROM n)
SELECT doc_id, coalesce(CASE rl WHEN '식재료' THEN 1 WHEN '완제품' THEN 0 END, 0) AS pred,
       CASE WHEN rl IS NULL THEN 0.5 ELSE 1.0 END AS conf FROM r
""")
def q_stm_score(spark, d):
    t = Tables(spark, d)
    docs = t.documents.join(t.labels.select("doc_id", F.col("toxic").alias("cls_ing")), "doc_id", "left").select("doc_id", "text", "cls_ing")
    src, tgt, ckpt = _dirs(spark, "stm_score")
    docs.filter(F.col("doc_id") % 2 == 0).write.mode("append").parquet(src)
    docs.filter(F.col("doc_id") % 2 == 1).write.mode("append").parquet(src)
    scorer = C.rule_scorer("text", FINISHED, INGREDIENT)
    S.stream_score(spark, src, docs.schema, tgt, ckpt, lambda b: scorer(b).select("doc_id", "pred", "conf"),
                   max_files_per_trigger=1, label_col="cls_ing")
    return S.read_target(spark, tgt)


@register("kok_price_delta_incremental", oracle=f"WITH {PRICE_DELTA_CTES} SELECT * FROM delta")
def q_kok_price_delta_incremental(spark, d):
    # three arrivals that each hold old and new prices of any product; some rows are sent twice
    prices = kok_prices(Tables(spark, d))
    src, tgt, ckpt = _dirs(spark, "kok_price_delta")
    part = F.pmod(F.xxhash64("l_orderkey", "l_linenumber"), F.lit(3))
    for n in range(3):
        prices.where((part == n) | ((part == 0) & (F.col("l_orderkey") % 5 == n))).write.mode("append").parquet(src)
    state = KeyedTable(spark, tgt, prices.schema, "kok_product_id")
    S.incremental_merge(spark, src, prices.schema, state, ckpt, kok.newest_two(arrival=LINE_ORDER), max_files_per_trigger=8)
    return kok.price_delta(state.read(), arrival=LINE_ORDER)


@register("kok_refresh", oracle=f"""
WITH {PRICE_DELTA_CTES},
changed AS (SELECT kok_product_id FROM delta WHERE raw_price_change_flag = 'changed_raw_price')
SELECT p_partkey AS kok_product_id, CASE WHEN p_partkey % 2 = 0 THEN p_name ELSE p_brand END AS kok_product_name, p_size * 100 AS kok_product_price,
       CAST(p_partkey % 2 = 0 AND p_name LIKE '%e%' AS INTEGER) AS cls_ing, 1.0 AS conf, CAST(1 + p_partkey % 2 AS BIGINT) AS seq
FROM part WHERE p_partkey IN (SELECT kok_product_id FROM changed) AND p_partkey % 7 <> 0
""")
def q_kok_refresh(spark, d):
    # two invalidation runs; the even products only in the first; every seventh page is gone
    t = Tables(spark, d)
    delta = kok.price_delta(kok_prices(t), arrival=LINE_ORDER)
    changed = delta.where(F.col("raw_price_change_flag") == kok.CHANGED_FLAG).select("kok_product_id").checkpoint()
    html = F.concat(F.lit('<span class="product__title"><strong>'), F.col("p_brand"), F.lit("</strong> "),
                    F.when(F.col("p_partkey") % 2 == 0, F.col("p_name")).otherwise(F.lit("")),
                    F.lit('</span><div class="card-info-del_wrap"><del>'), F.format_number(F.col("p_size") * 100, 0), F.lit("원</del></div>"))
    pages = t.part.where(F.col("p_partkey") % 7 != 0).select(F.col("p_partkey").cast("long").alias("page_id"), html.alias("html"))
    base = scratch_path(spark, f"kok_refresh-{uuid.uuid4().hex[:12]}")
    scorer = C.keyword_scorer("kok_product_name", ["e"])
    score = lambda df: scorer(df.withColumn("kok_product_name", F.when(F.col("kok_product_name") == F.col("kok_store_name"), "")
                                            .otherwise(F.col("kok_product_name"))))
    for seq in (1, 2):
        RF.log_changes(changed if seq == 1 else changed.where("kok_product_id % 2 = 1"), f"{base}/changes", seq)
        tables = RF.refresh(spark, base, f"{base}/changes", pages, score)
    return tables["clean"].read().drop("seq", "kok_store_name").join(tables["scores"].read(), "kok_product_id").select(
        "kok_product_id", "kok_product_name", "kok_product_price", "cls_ing", "conf", "seq")


@register("contract_incremental", oracle="""
SELECT 'unique' AS rule, CAST(coalesce(sum(n), 0) AS BIGINT) AS n_violations FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey HAVING count(*) > 1)
UNION ALL SELECT 'fk', count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderkey % 10 <> 0)
""")
def q_contract_incremental(spark, d):
    # three batches of children and parents that arrive in different ones; the third also takes back rows of the first
    t = Tables(spark, d)
    li = t.lineitem.select(F.col("l_orderkey").alias("k"), "l_linenumber")
    orders = t.orders.where(F.col("o_orderkey") % 10 != 0).select(F.col("o_orderkey").alias("k"))
    path = scratch_path(spark, f"contract-{uuid.uuid4().hex[:12]}")
    counts = KeyCounts(KeyedTable(spark, path, KeyCounts.schema(li, ["k"]), "k"))
    part = F.col("l_linenumber") % 3
    again = li.where((part == 0) & (F.col("k") % 4 == 0))
    for n in range(3):
        rows = li.where(part == n)
        counts.add(n, rows if n else rows.unionAll(again), orders.where(F.col("k") % 3 == n), again if n == 2 else None)
    return counts.violations()
