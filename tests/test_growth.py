"""Steps whose work must not grow faster than the input."""

import random

from pyspark.sql import functions as F

from sparkmart.operators import html as H
from sparkmart.operators import relational as R
from sparkmart.plans import html_jobs, schedule_json
from tests.test_page_parse import BITS


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_start_tags_known_from_other_pages_change_no_node():
    pick, known = random.Random(2), {}
    for _ in range(3000):
        html = "".join(pick.choice(BITS) for _ in range(pick.randint(0, 9)))
        alone = H.page_nodes(html, ["div.a"], {"p", "span"})
        assert H.page_nodes(html, ["div.a"], {"p", "span"}, known) == alone
    assert 0 < len(known) <= H.KNOWN_TAGS


def _card(rate, price):
    return (f'<div class="card product-section-ul-li"><span class="card-info_rate">{rate}</span>'
            f'<div class="card-info_price"><strong>{price}</strong></div></div>')


def test_price_cards_of_repeated_null_and_odd_pages(spark):
    ids = "".join(f'<a data-product-id="{i}"></a>' for i in ("7", "x", "8", "9"))
    page = ids + _card("5%", "1,000") + '<div class="product-section-ul-li"><!-- bare --></div>'
    rows = [(1, page), (2, page), (2, page), (None, page), (3, None), (4, "<p>none</p>"), (5, _card("1%", "2"))]
    got = html_jobs.price_cards(spark.createDataFrame(rows, "page_id long, html string"))
    full, bare = ("5%", 1000, "1000"), (None, None, None)
    assert sorted((tuple(r) for r in got.collect()), key=lambda r: r[:2]) == [
        (1, 1, "7", *full), (1, 2, "8", *bare),
        (2, 1, "7", *full), (2, 2, "7", *full), (2, 3, "8", *bare), (2, 4, "8", *bare)]
    assert _plan(got).count("MapInArrow") == 1 and "Join" not in _plan(got)      # the pages are parsed once and not joined


def test_schedule_payload_is_read_once(spark):
    payloads = ['{"respData":{"broadItemList":[{"slitmCd":"1234567890","brodDt":"20240101","newBrodDt":"","brodImgNm":"a.b.png","withItemList":'
                '[{"slitmCd":"12345678","brodDt":"20240102","thumImgNm":"x.jpg"},null]},{"withItemList":null},null]}}', "{}", "broken", None]
    df = spark.createDataFrame([(1, p) for p in payloads], "homeshopping_id int, payload string")
    got = schedule_json.flatten_schedule(df)
    rows = sorted((r.promotion_type, r.product_id, r.live_date, r.live_time, r.thumb_img_url or "") for r in got.collect())
    assert rows == [
        ("main", "0", "", "~", ""), ("main", "0", "", "~", ""),
        ("main", "1234567890", "20240101", "~", "https://image.example.com/static/8/7/56/34/onair1234567890.b.png?AR=0&SF=webp"),
        ("sub", "0", "", " ~ ", ""),
        ("sub", "12345678", "20240102", " ~ ", "https://image.example.com/static/8/7/56/34/12345678_0.jpg?RS=125x125&AR=0&SF=webp")]
    assert "Union" not in _plan(got)


def test_first_row_of_all_columns_travels_once_and_is_counted(spark):
    rows = [(1, "b", 2.0), (1, "a", 3.0), (1, "a", 3.0), (2, None, 1.0), (None, "c", 1.0), (None, "c", 1.0)]
    df = spark.createDataFrame(rows, "k int, s string, x double")
    for order in (["s", "x", "k"], ["s", F.col("x")]):
        got = R.first_wins(df, "k", order, count="n")
        assert sorted((tuple(r) for r in got.collect()), key=str) == sorted(
            [(1, "a", 3.0, 3), (2, None, 1.0, 1), (None, "c", 1.0, 1), (None, "c", 1.0, 1)], key=str)
    assert "min_by" not in _plan(R.first_wins(df, "k", ["s", "x", "k"]))


def test_insert_ignore_settles_rows_with_clashing_keys_only(spark, monkeypatch):
    sizes, write = {}, R.written

    def written(df, name):
        out = write(df, name)
        sizes.setdefault(name, out.count())
        return out

    monkeypatch.setattr(R, "written", written)
    tgt = spark.createDataFrame([], "a int, b int, c int, v string")
    rows = [(i, i, i, "x") for i in range(200)] + [(200, 7, 200, "b"), (8, 201, 201, "a"), (8, 202, None, "a"), (203, 7, 9, "both"), (None, None, None, "n")]
    df = spark.createDataFrame(rows, tgt.schema)
    kw = {"uniques": [["b"], ["c"]], "order_by": ["v", "c"]}
    got = sorted(tuple(r) for r in R.insert_ignore(tgt, df, "a", **kw).collect() if r["v"] != "n")
    kept, keys = [], [set(), set(), set()]
    for row in sorted(rows[:-1], key=lambda r: (r[3], -1 if r[2] is None else r[2])):       # nulls come first
        if all(k is None or k not in held for k, held in zip(row, keys)):
            kept.append(row)
            for k, held in zip(row, keys):
                held.add(k)
    assert got == sorted(kept, key=lambda r: r[:2])
    assert sizes["open"] == 8      # (row, key): three of b = 7, three of a = 8, two of c = 9; not 3 for each of 204 rows
    one = df.where("v = 'x' OR a = 200")      # b alone clashes: no rounds
    sizes.clear()
    assert R.insert_ignore(tgt, one, "a", **kw).count() == 200 and "open" not in sizes and sizes["clashes"] == 1
