import pytest
from pyspark.sql import functions as F

from sparkmart.operators.contracts import Contract, ForeignKey, KeyCounts, audit_contract
from sparkmart.plans import refresh as RF
from sparkmart.sources.keyed_table import KeyedTable


def page(i, name):
    return (i, f'<span class="product__title"><strong>shop</strong> {name}</span><div class="card-info-del_wrap"><del>1,{i:03}</del></div>')


def scorer(df):
    return df.withColumn("pred", F.col("kok_product_name").contains("egg").cast("int")).withColumn("conf", F.lit(1.0))


def test_refresh_consumes_each_change_once_and_goes_on_after_a_failure(spark, tmp_path):
    base, ids = f"file:{tmp_path}/r", lambda *xs: spark.createDataFrame([(x,) for x in xs], "kok_product_id long")
    pages = spark.createDataFrame([page(1, "egg"), page(2, "pan"), page(3, "egg pan")], "page_id long, html string")
    state = lambda t: {n: sorted(map(tuple, x.read().collect())) for n, x in t.items()}
    RF.log_changes(ids(1, 2, 9), f"{base}/changes", 1)            # 9 has no page

    def broken(df):
        return scorer(df).withColumn("conf", F.raise_error(F.lit("scorer is down")).cast("double"))

    with pytest.raises(Exception):
        RF.refresh(spark, base, f"{base}/changes", pages, broken)
    first = RF.refresh(spark, base, f"{base}/changes", pages, scorer)          # only the scores are still to do
    assert first["raw"].manifest().batch_id == 0
    assert state(first)["scores"] == [(1, 1, 1.0, 1), (2, 0, 1.0, 1)]
    assert state(first)["clean"] == [(1, "shop", "egg", 1001, 1), (2, "shop", "pan", 1002, 1)]
    before = state(first), [t.manifest() for t in first.values()]
    again = RF.refresh(spark, base, f"{base}/changes", pages, scorer)
    assert (state(again), [t.manifest() for t in again.values()]) == before    # a rerun changes nothing
    RF.log_changes(ids(2, 3), f"{base}/changes", 2)
    changed = pages.where("page_id <> 2").unionAll(spark.createDataFrame([page(2, "egg cup")], pages.schema))
    last = RF.refresh(spark, base, f"{base}/changes", changed, scorer)
    assert state(last)["scores"] == [(1, 1, 1.0, 1), (2, 1, 1.0, 2), (3, 1, 1.0, 2)]


def test_key_counts_equal_a_full_audit(spark, tmp_path):
    cols = "k long, j string"
    child = [(1, "a"), (1, "a"), (2, "a"), (2, "b"), (None, "a"), (3, None), (4, "a"), (4, "a"), (4, "a")]
    parent = [(1, "a"), (2, "b")]
    df, par = spark.createDataFrame(child, cols), spark.createDataFrame(parent, cols)
    counts = KeyCounts(KeyedTable(spark, f"file:{tmp_path}/c", KeyCounts.schema(df, ["k", "j"]), ["k", "j"], rows_per_bucket=2))
    gone = spark.createDataFrame([(5, "x")], cols)
    counts.add(0, spark.createDataFrame(child[:5] + [(5, "x")], cols))
    counts.add(1, spark.createDataFrame(child[5:], cols), par)
    counts.add(1, spark.createDataFrame(child[5:], cols), par)                 # replayed
    counts.add(2, deleted=gone)
    full = audit_contract(df, Contract("t", uniques=[["k", "j"]], fks=[ForeignKey(["k", "j"], par, ["k", "j"])]))
    want = {r["rule"].split(":")[0]: r["n_violations"] for r in full.collect()}
    assert {r["rule"]: r["n_violations"] for r in counts.violations().collect()} == want == {"unique": 5, "fk": 4}
