"""Hand-worked cases of operators that gave wrong answers on ordinary input."""

import json

import pytest
from pyspark.sql import functions as F

from sparkmart.functions.numeric import str_to_num, str_to_num_sql
from sparkmart.operators import html as H
from sparkmart.operators import relational as R
from sparkmart.plans import html_jobs, schedule_json
from sparkmart.plans.keywords import split_keywords
from sparkmart.streaming import incremental as S


def test_long_digit_runs_are_zero(spark):
    df = spark.createDataFrame([("7" * n,) for n in range(9, 40)] + [("0" * 40 + "12",), ("2147483646.99",), ("2147483647",)], "t string")
    got = [(r.a, r.b) for r in df.select(str_to_num("t").alias("a"), F.expr(str_to_num_sql("t")).alias("b")).collect()]
    want = [float("7" * n) if n < 10 else 0.0 for n in range(9, 40)] + [12.0, 2147483646.99, 0.0]
    assert [a for a, _ in got] == want and [b for _, b in got] == want


def test_cascade_over_a_diamond_and_a_cycle(spark):
    t = {"a": spark.createDataFrame([(1,), (2,)], "a int"),
         "b": spark.createDataFrame([(10, 1), (11, 2)], "b int, a int"),
         "c": spark.createDataFrame([(20, 1), (21, 2)], "c int, a int"),
         "d": spark.createDataFrame([(30, 10, 21), (31, 11, 20), (32, 11, 21), (33, None, None)], "d int, b int, c int"),
         "e": spark.createDataFrame([(40, 30), (41, 31), (42, 32)], "e int, d int")}
    edges = [("a", "a", "b", "a"), ("a", "a", "c", "a"), ("b", "b", "d", "b"), ("c", "c", "d", "c"), ("d", "d", "e", "d")]
    out = R.cascade_delete(t, edges, "a", "a", spark.createDataFrame([(1,)], "a int"))
    assert {k: sorted(r[0] for r in v.collect()) for k, v in out.items()} == {"a": [2], "b": [11], "c": [21], "d": [32, 33], "e": [42]}
    with pytest.raises(ValueError):
        R.cascade_delete(t, [*edges, ("e", "e", "a", "a")], "a", "a", spark.createDataFrame([(1,)], "a int"))


def test_update_from_repeated_keys_keeps_the_rows(spark):
    t = spark.createDataFrame([(1, None), (2, 5)], "k int, v int")
    u = spark.createDataFrame([(1, 7), (1, 9), (2, None)], "k int, p int")
    assert sorted(map(tuple, R.update_from(t, u, "k", {"v": "p"}).collect())) == [(1, 9), (2, 5)]


def test_schedule_items_have_their_own_slots(spark):
    sub = {"slitmCd": "9876543210", "slitmNm": "s", "brodDt": "20240202", "brodStrtDtm": "10:00", "brodEndDtm": "11:00",
           "prmoTxtCntn": "own", "thumImgNm": "t.jpg"}
    main = {"slitmCd": "123", "newBrodDt": "20240103", "brodDt": "20240101", "brodStrtDtm": "08:00", "withItemList": [sub, sub]}
    doc = json.dumps({"respData": {"broadItemList": [main]}})
    got = sorted(map(tuple, schedule_json.flatten_schedule(spark.createDataFrame([(1, doc), (2, "{}")], "homeshopping_id int, payload string")).collect()))
    assert got[0] == (1, "20240103", "08:00~", "main", "", "123", "", "", "", "", None)
    assert got[1][1:6] == ("20240202", "10:00 ~ 11:00", "sub", "own", "9876543210") and len(got) == 3
    assert got[1][10] == "https://image.example.com/static/2/3/54/76/9876543210_0.jpg?RS=125x125&AR=0&SF=webp"


def test_programme_prices_are_joined_first_row_wins(spark):
    item = {"goodsCd": "g1", "pgmNm": "p", "goods": {"productNm": "n", "brdctInfo": {"formStartDttm": "2024-01-02 03:04:00", "formEndDttm": ""}},
            "relTotalOrgan": [{"goodsCd": "g2", "imageUrl": "u", "goods": {"productNm": "m"}}]}
    prices = [{"goodsCd": "g1", "salePrice": 10, "dcPrice": 9, "dcRate": 10}, {"goodsCd": "g1", "salePrice": 99, "dcPrice": 9, "dcRate": 1}]
    row = (1, json.dumps({"data": {"resultData": {"totalOrgan": [item]}}}), json.dumps({"data": {"resultData": prices}}))
    got = sorted(map(tuple, schedule_json.flatten_programmes(spark.createDataFrame([row], "homeshopping_id int, payload string, prices string")).collect()))
    assert got == [(1, "", " ~ ", "sub", None, "g2", "m", None, None, None, "u"),
                   (1, "20240102", "03:04 ~ ", "main", "p", "g1", "n", 10, 9, 10, "https://image.example.com/new/g1_X6.jpg")]


def test_text_page_ids_and_bad_pages(spark):
    pages = spark.createDataFrame([("x", "<p>a</p>"), ("y", None)], "page_id string, html string")
    nodes = H.parse_nodes(pages, keep_tags=["p"])
    assert [(r.page_id, r.text) for r in nodes.collect()] == [("x", "a")]
    assert H.parse_rejects(nodes).collect() == []


def test_table_class_number_and_kok_images(spark):
    html = ('<table class="k"><tr><th>a</th><td>1</td></tr></table><table class="k x"><tr><th>b</th><td>2</td></tr></table>'
            '<img src="o.png"><div class="product_info_area"><img src="i.png"><img src="j.GIF"></div>')
    pages = spark.createDataFrame([(1, html)], "page_id long, html string")
    assert [r.detail_col for r in html_jobs.kv_rows(pages, "x").collect()] == ["b"]
    assert [r.detail_col for r in html_jobs.kv_rows(pages, "k", 1).collect()] == ["a"]
    assert sorted(r.detail_col for r in html_jobs.kv_rows(pages).collect()) == ["a", "b"]
    assert [r.img_url for r in html_jobs.info_images(pages).collect()] == ["i.png"]


def test_streaming_target_read_errors_are_raised(spark, tmp_path):
    schema = spark.createDataFrame([], "k int").schema
    assert S._target(spark, f"{tmp_path}/none", schema, 1).count() == 0
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "part-0.parquet").write_bytes(b"not parquet")
    with pytest.raises(Exception):
        S._target(spark, f"{tmp_path}/bad", schema, 1).collect()


def test_keyword_split():
    assert split_keywords(["%탕", "양념%", "라면", "%", "%%"]) == (["양념%", "라면"], ["탕", "%"])


def test_loaded_reviews_win_and_orphans_are_ignored(spark):
    from sparkmart.plans import runs
    price = spark.createDataFrame([(1, 1, "10%", 900), (2, 1, "10%", 900), (3, 2, "x", 5)],
                                  "kok_price_id long, kok_product_id long, kok_discount_rate string, kok_discounted_price long")
    product = spark.createDataFrame([("1", "A", "A n", "1원"), ("2", "B", "m", "2원")],
                                    "kok_product_id string, kok_store_name string, kok_product_name string, kok_product_price string")
    spec = [("kok_product_id", "kok_product_id", "bigint"), ("kok_store_name", "kok_store_name", "string"),
            ("kok_product_name", "kok_product_name", "string"), ("kok_product_price", "kok_product_price", "num")]
    old = spark.createDataFrame([(2, "B", "kept", 7.0)], "kok_product_id long, kok_store_name string, kok_product_name string, kok_product_price double")
    kid = "long, kok_product_id long, "
    image = spark.createDataFrame([(1, 1, "u"), (2, 1, "u"), (3, 9, "orphan")], f"kok_img_id {kid} kok_img_url string")
    detail = spark.createDataFrame([(1, 1, "c", "v"), (2, 1, "c", "v")], f"kok_detail_id {kid} kok_detail_col string, kok_detail_val string")
    review = spark.createDataFrame([(1, 1, "nick", "d"), (2, 1, "nick", "e")], f"kok_review_id {kid} kok_nickname string, kok_review_date string")
    loaded = spark.createDataFrame([(9, 2, "nick", "d")], review.schema)
    clean = {"price": price.limit(0).select("kok_price_id", "kok_product_id", F.lit(1).alias("kok_discount_rate"), "kok_discounted_price"),
             "product": old, "image": spark.createDataFrame([(7, 2, "w")], image.schema),
             "detail": spark.createDataFrame([(7, 2, "c", "v")], detail.schema), "review": loaded}
    out = runs.kok_preprocess({"price": price, "product": product, "image": image, "detail": detail, "review": review}, clean, spec)
    ids = {k: sorted(r[0] for r in v.select(v.columns[0] if k != "review" else "kok_review_id").collect()) for k, v in out.items()}
    assert ids == {"price": [1, 3], "product": [1, 2], "image": [1, 7], "detail": [1, 7], "review": [2, 9]}
    assert sorted(r.kok_product_name for r in out["product"].collect()) == ["kept", "n"]


def test_listing_without_its_channel_is_ignored(spark):
    df = spark.createDataFrame([(1, 1), (2, 9), (3, None)], "id int, ch int")
    info = spark.createDataFrame([(1,)], "ch int")
    assert sorted(r.id for r in R.with_parent(df, ["ch"], info, ["ch"]).collect()) == [1, 3]
