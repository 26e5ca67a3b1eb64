"""Stand-ins for scans, sources and sinks."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from sparkmart.operators import relational as R
from sparkmart.operators.contracts import Contract, ForeignKey, audit_contract
from sparkmart.session import scratch_path
from sparkmart.sources import files, generators
from sparkmart.standins import Tables, register
from sparkmart.standins.frames import LINE_ORDER

NOW = "2024-01-15 03:00:00"


def _scratch(spark, name):
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")


@register("src_csv", oracle="""
SELECT n_nationkey AS N_NATIONKEY,
       CASE WHEN n_nationkey % 5 = 0 THEN NULL ELSE n_name END AS N_NAME,
       n_regionkey AS N_REGIONKEY
FROM nation
""")
def q_src_csv(spark, d):
    t = Tables(spark, d).nation
    path = _scratch(spark, "src_csv")
    raw = t.select(F.col("n_nationkey").alias(" n_nationkey "),
                   F.when(F.col("n_nationkey") % 10 == 0, F.lit("NaN"))
                   .when(F.col("n_nationkey") % 5 == 0, F.lit("")).otherwise(F.col("n_name")).alias("n_name  "),
                   F.col("n_regionkey").alias("\tn_regionkey"))
    raw.write.mode("overwrite").option("header", True).csv(path)
    df = files.read_csv_clean(spark, path, schema="n_nationkey int, n_name string, n_regionkey int")
    return df


@register("src_scan_project", oracle="""
SELECT o_orderkey, o_custkey, o_orderdate FROM orders WHERE o_orderstatus = 'F'
""")
def q_src_scan_project(spark, d):
    store = files.TableStore(spark, d)
    return store.read("orders.parquet", ["o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus"]) \
        .filter(F.col("o_orderstatus") == "F").drop("o_orderstatus")


@register("src_schema_projection", oracle="""
SELECT l_orderkey, l_partkey, l_quantity FROM lineitem
WHERE l_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_shipdate < TIMESTAMP '1998-01-01')
""")
def q_src_schema_projection(spark, d):
    li = Tables(spark, d).lineitem
    target = li.filter(F.col("l_shipdate") < F.lit("1998-01-01").cast("timestamp_ntz")) \
        .select("l_orderkey", "l_partkey", "l_quantity")
    return R.unseen(li.select(*target.columns), "l_orderkey", target)


@register("src_date_window", oracle="""
WITH days AS (SELECT DISTINCT CAST(ts AS DATE) AS base_date FROM events)
SELECT base_date, strftime(base_date + to_days(CAST(g AS INTEGER)), '%Y%m%d') AS live_date
FROM days, range(0, 11) AS r(g)
""")
def q_src_date_window(spark, d):
    ev = Tables(spark, d).events
    days = ev.select(F.to_date("ts").alias("base_date")).distinct()
    return generators.with_date_window(days, F.col("base_date"), 11)


@register("src_fanout", oracle="""
WITH s AS (SELECT CAST(min(ts) AS DATE) AS d0 FROM events)
SELECT n_nationkey, n_name, strftime(d0 + to_days(CAST(g AS INTEGER)), '%Y%m%d') AS live_date, page
FROM nation, s, range(0, 11) AS r(g), range(1, 3) AS p(page)
WHERE n_nationkey BETWEEN 11 AND 24 AND n_nationkey <> 12
""")
def q_src_fanout(spark, d):
    t = Tables(spark, d)
    d0 = t.events.select(F.min("ts").cast("date")).scalar()
    chans = t.nation.filter(F.col("n_nationkey").between(11, 24) & (F.col("n_nationkey") != 12)) \
        .select("n_nationkey", "n_name")
    out = generators.with_date_window(chans, d0, 11)
    return generators.with_page_range(out, 2).withColumn("page", F.col("page").cast("bigint"))


@register("src_seed_dim", oracle="""
SELECT 'empty' AS target, n_nationkey AS id, n_name AS name FROM nation WHERE n_nationkey < 17
UNION ALL SELECT 'filled', r_regionkey, r_name FROM region
""")
def q_src_seed_dim(spark, d):
    t = Tables(spark, d)
    reg = t.region.select(F.col("r_regionkey").alias("id"), F.col("r_name").alias("name"))
    seed = t.nation.filter(F.col("n_nationkey") < 17).select(F.col("n_nationkey").alias("id"),
                                                             F.col("n_name").alias("name"))
    empty = generators.seed_if_empty(reg.filter(F.col("id") < 0), seed)
    filled = generators.seed_if_empty(reg, seed)
    return empty.select(F.lit("empty").alias("target"), "*").unionByName(
        filled.select(F.lit("filled").alias("target"), "*"))


@register("snk_append_rejects", oracle="""
WITH b AS (
  SELECT l_orderkey, l_linenumber, CASE WHEN l_partkey % 13 = 0 THEN NULL ELSE l_partkey END AS l_partkey,
         l_suppkey, l_shipdate, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus
  FROM lineitem
),
r AS (
  SELECT *, CASE WHEN l_partkey IS NULL THEN 'not_null:l_partkey'
                 WHEN l_returnflag NOT IN ('R', 'A', 'N') THEN 'enum:l_returnflag' END AS reason0
  FROM b
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY
      l_shipdate, l_orderkey, l_linenumber, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
      l_returnflag, l_linestatus, l_partkey) AS rn
  FROM r WHERE reason0 IS NULL
)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, reason0 AS reject_reason FROM r WHERE reason0 IS NOT NULL
UNION ALL
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN rn > 1 THEN 'duplicate_key' END FROM ranked
""")
def q_snk_append_rejects(spark, d):
    li = Tables(spark, d).lineitem
    b = li.withColumn("l_partkey", F.when(F.col("l_partkey") % 13 == 0, F.lit(None)).otherwise(F.col("l_partkey")))
    checked = files.append_with_rejects(b, {
        "not_null:l_partkey": F.col("l_partkey").isNull(),
        "enum:l_returnflag": ~F.col("l_returnflag").isin("R", "A", "N"),
    })
    valid = checked.filter(F.col("reject_reason").isNull()).drop("reject_reason")
    key = ["l_orderkey", "l_linenumber"]
    counted = R.first_wins(valid, key, LINE_ORDER + ["l_partkey"], count="n")
    # every branch asks for the count, so one shuffle of the rows serves them all
    winners, clashed = counted.where(F.col("n") > 0), counted.where(F.col("n") > 1).drop("n")
    losers = valid.join(clashed.select(*key), key, "left_semi").select(*clashed.columns).exceptAll(clashed)
    winners = winners.withColumn("reject_reason", F.lit(None).cast("string"))
    losers = losers.withColumn("reject_reason", F.lit("duplicate_key"))
    cols = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "reject_reason"]
    return (checked.filter(F.col("reject_reason").isNotNull()).select(*cols)
            .unionByName(winners.select(*cols)).unionByName(losers.select(*cols)))


_UNIQUES = [["l_partkey", "l_suppkey"], ["l_suppkey", "l_shipdate"]]
_KEYS = [["l_orderkey", "l_linenumber"], *_UNIQUES]


def _insert_ignore_sql(rounds: int = 12) -> str:
    """Sequential insertion, a CTE per round: kept are the open rows that are
    first in all keys; open rows that share a key with them leave. A row still
    open after the last round makes the query fail."""
    def same(a, b, key):
        return " AND ".join(f"{a}.{c} = {b}.{c}" for c in key)

    sql = f"""
WITH ex AS (SELECT * FROM lineitem WHERE l_shipdate < TIMESTAMP '1998-01-01'),
b AS (SELECT * FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-01-01'),
fk AS (SELECT * FROM b WHERE l_orderkey IS NULL OR l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderkey % 10 <> 0)),
u0 AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY {", ".join(LINE_ORDER)}, l_partkey) AS rid FROM fk
  WHERE {" AND ".join(f"NOT EXISTS (SELECT 1 FROM ex WHERE {same('ex', 'fk', k)})" for k in _KEYS)})"""
    for r in range(rounds):
        first = " AND ".join(f"rid = min(rid) OVER (PARTITION BY {', '.join(k)})" for k in _KEYS)
        sql += f""",
a{r} AS MATERIALIZED (SELECT * FROM u{r} QUALIFY {first}),
u{r + 1} AS MATERIALIZED (SELECT * FROM u{r}
  WHERE {" AND ".join(f"NOT EXISTS (SELECT 1 FROM a{r} WHERE {same(f'a{r}', f'u{r}', k)})" for k in _KEYS)})"""
    kept = " UNION ALL ".join(f"SELECT * FROM a{r}" for r in range(rounds))
    return sql + f""",
inserted AS (SELECT * EXCLUDE (rid) FROM ({kept}) WHERE (SELECT CASE WHEN count(*) > 0 THEN error('open rows') ELSE true END FROM u{rounds}))
"""


_INSERT_IGNORE_SQL = _insert_ignore_sql()


def _insert_ignore(spark, d):
    t = Tables(spark, d)
    cut = F.lit("1998-01-01").cast("timestamp_ntz")
    ex, b = t.lineitem.filter(F.col("l_shipdate") < cut), t.lineitem.filter(F.col("l_shipdate") >= cut)
    parents = t.orders.filter(F.col("o_orderkey") % 10 != 0)
    return R.insert_ignore(ex, b, ["l_orderkey", "l_linenumber"], uniques=_UNIQUES,
                           order_by=LINE_ORDER + ["l_partkey"],
                           fks=[(["l_orderkey"], parents, ["o_orderkey"])])


@register("snk_insert_ignore", oracle=_INSERT_IGNORE_SQL + """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
       l_returnflag, l_linestatus, l_shipdate FROM inserted
""")
def q_snk_insert_ignore(spark, d):
    return _insert_ignore(spark, d)


@register("snk_snapshot", oracle="""
SELECT event_id, ts, user_id, event_type, value FROM events WHERE event_type = 'click'
""")
def q_snk_snapshot(spark, d):
    ev = Tables(spark, d).events.drop("props")
    path = _scratch(spark, "snk_snapshot")
    files.overwrite_snapshot(ev, path)
    current = spark.read.parquet(path)
    return files.overwrite_snapshot(current.filter(F.col("event_type") == "click"), path)


@register("snk_insert_select", oracle="""
WITH cls AS (SELECT p_partkey AS product_id, p_name AS product_name, CAST(p_size % 2 AS INTEGER) AS cls_food,
                    CAST(NULL AS INTEGER) AS cls_ing, TIMESTAMP '2024-01-01 00:00:00' AS created_at
             FROM part WHERE p_partkey % 4 = 0)
SELECT * FROM cls
UNION ALL
SELECT p_partkey, p_name, NULL, NULL, TIMESTAMP '2024-01-15 03:00:00' FROM part
WHERE p_partkey NOT IN (SELECT product_id FROM cls)
""")
def q_snk_insert_select(spark, d):
    part = Tables(spark, d).part
    cls = part.filter(F.col("p_partkey") % 4 == 0).select(
        F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name"),
        (F.col("p_size") % 2).cast("int").alias("cls_food"), F.lit(None).cast("int").alias("cls_ing"),
        F.lit("2024-01-01 00:00:00").cast("timestamp").alias("created_at"))
    cand = R.anti_not_in(part.select(F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name")),
                         "product_id", cls)
    cand = R.apply_defaults(cand, {"cls_food": None, "cls_ing": None, "created_at": "now"}, now=NOW)
    cand = cand.withColumn("cls_food", F.col("cls_food").cast("int")).withColumn("cls_ing", F.col("cls_ing").cast("int"))
    return R.insert_ignore_table(cls, cand, "product_id")


@register("snk_export", oracle="""
SELECT s_suppkey, s_name, s_nationkey, s_acctbal, CAST(s_nationkey % 5 AS INTEGER) AS part_key FROM supplier
""")
def q_snk_export(spark, d):
    sup = Tables(spark, d).supplier.withColumn("part_key", (F.col("s_nationkey") % 5).cast("int"))
    path = _scratch(spark, "snk_export")
    files.export_delimited(sup, path, sep="\t", partition_by=["part_key"])
    back = spark.read.option("header", True).option("sep", "\t").schema(
        "s_suppkey long, s_name string, s_nationkey int, s_acctbal double, part_key int").csv(path)
    return back


@register("snk_surrogate_key", oracle="""
WITH ex AS (SELECT count(*) AS n FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01')
SELECT o_orderkey, o_orderdate,
       row_number() OVER (ORDER BY o_orderdate, o_orderkey) + (SELECT n FROM ex) AS live_id
FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'
""")
def q_snk_surrogate_key(spark, d):
    o = Tables(spark, d).orders
    cut = F.lit("1998-01-01").cast("timestamp_ntz")
    existing = R.with_surrogate_key(o.filter(F.col("o_orderdate") < cut), "live_id", ["o_orderdate", "o_orderkey"])
    start = existing.select(F.coalesce(F.max("live_id"), F.lit(0))).scalar()
    batch = o.filter(F.col("o_orderdate") >= cut).select("o_orderkey", "o_orderdate")
    return R.with_surrogate_key(batch, "live_id", ["o_orderdate", "o_orderkey"], start=start)


@register("snk_defaults", oracle="""
SELECT event_id, coalesce(CASE WHEN event_id % 7 = 0 THEN NULL ELSE value END, 0.0) AS value,
       TIMESTAMP '2024-01-15 03:00:00' AS created_at, 1 AS scheduled_or_cancelled
FROM events
""")
def q_snk_defaults(spark, d):
    ev = Tables(spark, d).events.select(
        "event_id", F.when(F.col("event_id") % 7 == 0, F.lit(None)).otherwise(F.col("value")).alias("value"))
    return R.apply_defaults(ev, {"value": 0.0, "created_at": "now", "scheduled_or_cancelled": 1}, now=NOW)


@register("snk_nan_to_null", oracle="""
SELECT event_id, CASE WHEN event_id % 9 = 0 THEN NULL ELSE value END AS value, event_type FROM events
""")
def q_snk_nan_to_null(spark, d):
    ev = Tables(spark, d).events.select(
        "event_id", F.when(F.col("event_id") % 9 == 0, F.lit(float("nan"))).otherwise(F.col("value")).alias("value"),
        "event_type")
    return R.nulls_for_nan(ev)


@register("contract_audit", oracle="""
SELECT 'lineitem' AS table_name, 'not_null:l_partkey' AS rule, count(*) FILTER (WHERE l_partkey % 97 = 0) AS n_violations FROM lineitem
UNION ALL SELECT 'lineitem', 'enum:l_returnflag', count(*) FILTER (WHERE l_returnflag NOT IN ('R', 'A')) FROM lineitem
UNION ALL SELECT 'lineitem', 'length:l_linestatus<=1', count(*) FILTER (WHERE length(l_linestatus) > 1) FROM lineitem
UNION ALL SELECT 'lineitem', 'pk:l_orderkey,l_linenumber', coalesce(sum(n), 0) FROM
  (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
UNION ALL SELECT 'lineitem', 'fk:l_orderkey', count(*) FROM lineitem
  WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderkey % 10 <> 0)
""")
def q_contract_audit(spark, d):
    t = Tables(spark, d)
    li = t.lineitem.withColumn("l_partkey", F.when(F.col("l_partkey") % 97 == 0, F.lit(None)).otherwise(F.col("l_partkey")))
    c = Contract("lineitem", pk=["l_orderkey", "l_linenumber"], not_null=["l_partkey"],
                 enums={"l_returnflag": ["R", "A"]}, lengths={"l_linestatus": 1},
                 fks=[ForeignKey(["l_orderkey"], t.orders.filter(F.col("o_orderkey") % 10 != 0), ["o_orderkey"])])
    return audit_contract(li, c)


@register("src_stored_files", oracle="""
SELECT 'page' AS kind, 'page ' || p_partkey AS a, p_brand AS b FROM part WHERE p_partkey < 40
UNION ALL SELECT 'payload', CAST(p_partkey AS VARCHAR), p_name FROM part
""")
def q_src_stored_files(spark, d):
    """Pages from a folder of HTML files (one per page, so a few of them) and
    payloads from JSON files, read back by the sources."""
    import uuid

    from sparkmart.plans import html_jobs
    from sparkmart.session import scratch_path
    p = Tables(spark, d).part
    base = scratch_path(spark, f"stored-{uuid.uuid4().hex[:12]}")
    html = F.concat(F.lit("<html><head><title>page "), F.col("p_partkey").cast("string"), F.lit("</title></head><body>\n<h1>"),
                    "p_brand", F.lit("</h1></body></html>"))
    pages = p.where("p_partkey < 40").select("p_partkey", html.alias("value"))
    pages.repartition("p_partkey").write.partitionBy("p_partkey").text(f"{base}/pages")
    p.select(F.col("p_partkey").cast("string").alias("id"), F.struct(F.col("p_name").alias("name")).alias("goods")).write.json(f"{base}/payloads")
    fields = html_jobs.page_fields(files.read_pages(spark, f"{base}/pages/*"))
    got = files.read_payloads(spark, f"{base}/payloads", "id string, goods struct<name:string>", lines=True)
    return fields.select(F.lit("page").alias("kind"), F.col("title").alias("a"), F.col("h1").alias("b")).unionByName(
        got.select(F.lit("payload").alias("kind"), F.col("id").alias("a"), F.col("goods.name").alias("b")))
