"""Domain job cases (FIXTURES §3) and driver-contract checks."""

import datetime as dt

from pyspark.sql import functions as F

from sparkmart.plans import hs, kok, recipes
from sparkmart.plans.keywords import split_keywords
from sparkmart.plans.text_features import rule_label
from tests.conftest import SF


def test_price_delta_cases(spark):
    rows = [(1, "p1", "10%", 900), (2, "p1", "20%", 800),          # est 1000 / 1000 -> same
            (3, "p2", "10%", 900), (4, "p2", "10%", 1080),         # 1000 / 1200 -> changed
            (5, "p3", "10%", 900), (6, "p3", "100%", 0),           # rate 100 -> NULL -> changed
            (7, "p4", "5%", 950)]                                   # single row -> absent
    prices = spark.createDataFrame(rows, "kok_price_id int, kok_product_id string, kok_discount_rate string, "
                                         "kok_discounted_price long")
    got = {r.kok_product_id: r.raw_price_change_flag for r in kok.price_delta(prices).collect()}
    assert got == {"p1": "same_raw_price", "p2": "changed_raw_price", "p3": "changed_raw_price"}


def test_name_strip(spark):
    df = spark.createDataFrame([("AB", "AB 라면"), ("AB", "AB"), ("AB", "CAB")], "kok_store_name string, kok_product_name string")
    assert [r.kok_product_name for r in kok.strip_store_prefix(df).collect()] == ["라면", "AB", "CAB"]


def test_integrity_fixpoint(spark):
    product = spark.createDataFrame([(1,), (2,), (3,)], "product_id int")
    detail = spark.createDataFrame([(1,), (2,)], "product_id int")
    image = spark.createDataFrame([(1,)], "product_id int")
    out = kok.repair_integrity(product, detail, image, key="product_id")
    assert sorted(r.product_id for r in out["product"].collect()) == [1]
    again = kok.repair_integrity(out["product"], out["detail"], out["image"], key="product_id")
    for k in ("product", "detail", "image"):
        assert sorted(again[k].collect()) == sorted(out[k].collect())


def test_image_cleanup(spark):
    img = spark.createDataFrame([(1, "x.jpg"), (1, "x/format/webp"), (2, "y/format/avif"), (3, "z/format/webp"),
                                 (3, "z.jpg")], "product_id int, img_url string")
    lst = spark.createDataFrame([(1, 1), (2, 1), (3, 2)], "product_id int, homeshopping_id int")
    got = sorted(tuple(r) for r in hs.clean_image_variants(img, lst).collect())
    assert got == [(1, "x.jpg"), (2, "y/format/avif"), (3, "z.jpg"), (3, "z/format/webp")]


def test_cancel_flag(spark):
    sched = spark.createDataFrame(
        [(1, 1, dt.date(2024, 1, 20), "10:00:00", "11:00:00", 7, 1),
         (2, 1, dt.date(2024, 1, 1), "10:00:00", "11:00:00", 8, 1),
         (3, 1, dt.date(2024, 1, 20), None, "11:00:00", 9, 1),
         (4, 1, dt.date(2024, 1, 20), "12:00:00", "13:00:00", 10, 1)],
        "live_id int, homeshopping_id int, live_date date, live_start_time string, live_end_time string, "
        "product_id int, scheduled_or_cancelled int")
    current = sched.filter(F.col("live_id") == 4).select(*hs.SLOT_COLUMNS)
    got = {r.live_id: r.scheduled_or_cancelled for r in hs.flag_cancelled(sched, current, "2024-01-15").collect()}
    assert got == {1: 0, 2: 1, 3: 1, 4: 1}
    with_null = current.unionByName(sched.filter(F.col("live_id") == 3).select(*hs.SLOT_COLUMNS))
    got = {r.live_id: r.scheduled_or_cancelled for r in hs.flag_cancelled(sched, with_null, "2024-01-15").collect()}
    assert set(got.values()) == {1}


def test_materials(spark):
    df = spark.createDataFrame([(1, "[재료] 쌀\x071\x07컵|소금"), (2, "[재료] a| [양념] b")], "recipe_id int, materials string")
    got = sorted((r.recipe_id, r.material_name, r.measure_amount, r.measure_unit, r.details)
                 for r in recipes.materials(df).collect())
    assert got == [(1, "소금", None, None, None), (1, "쌀", "1", "컵", None), (2, "a", None, None, None),
                   (2, "b", None, None, None)]


def test_keywords_and_rule_label(spark):
    assert split_keywords(["%탕", "양념%", "라면"]) == (["양념%", "라면"], ["탕"])
    df = spark.createDataFrame([("라면 쌀",), ("쌀",), ("책",)], "t string")
    assert [r.l for r in df.select(rule_label(F.col("t")).alias("l")).collect()] == ["완제품", "식재료", None]


def test_entry_and_contract():
    import __spark_entry__ as E
    qs, oracles = E.queries(), E.oracle_sql()
    assert set(oracles) <= set(qs)
    assert "kok_price_delta" in oracles


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert "raw_price_change_flag" in df.columns
    assert df.count() >= 0


def test_some_queries_run_small(spark):
    import __spark_entry__ as E
    qs = E.queries()
    for name in ("hs_schedule_cancel", "snk_insert_ignore", "html_page_fields", "rcp_materials", "agg_kv_pivot"):
        assert qs[name](spark, SF).count() >= 0
