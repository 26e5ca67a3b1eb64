"""Stand-ins for HTML extraction. Pages-based keys read the
driver's ``pages``; the others render HTML from a table with built-in string
functions, extract it back, and are checked against the source columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkmart.plans import html_jobs as HJ
from sparkmart.standins import Tables, register

NOW = "2024-01-15 03:00:00"
_DECODE = ("replace(replace(replace(replace(replace({x}, '&quot;', '\"'), '&#39;', ''''), '&lt;', '<'), "
           "'&gt;', '>'), '&amp;', '&')")


def _dec(x):
    return _DECODE.format(x=x)


@register("html_title", oracle=f"""
SELECT page_id, trim({_dec("regexp_extract(html, '<title>(.*?)</title>', 1)")}) AS title FROM pages
""")
def q_html_title(spark, d):
    return HJ.page_fields(Tables(spark, d).pages).select("page_id", "title")


@register("html_page_fields", oracle=f"""
SELECT page_id, trim({_dec("regexp_extract(html, '<title>(.*?)</title>', 1)")}) AS title,
       trim({_dec("regexp_extract(html, '<h1>(.*?)</h1>', 1)")}) AS h1,
       regexp_extract(html, '<html lang="([^"]*)"', 1) AS lang,
       regexp_extract(html, '<meta charset="([^"]*)"', 1) AS charset,
       len(regexp_extract_all(html, '<p[ >]')) AS n_paragraphs
FROM pages
""")
def q_html_page_fields(spark, d):
    return HJ.page_fields(Tables(spark, d).pages)


@register("html_meta", oracle="""
SELECT page_id, 'charset' AS key, regexp_extract(html, '<meta charset="([^"]*)"', 1) AS value FROM pages
UNION ALL SELECT page_id, 'lang', regexp_extract(html, '<html lang="([^"]*)"', 1) FROM pages
""")
def q_html_meta(spark, d):
    f = HJ.page_fields(Tables(spark, d).pages)
    return (f.select("page_id", F.lit("charset").alias("key"), F.col("charset").alias("value"))
            .unionByName(f.select("page_id", F.lit("lang").alias("key"), F.col("lang").alias("value"))))


@register("html_attr_values", oracle="""
WITH h AS (SELECT page_id, unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS href FROM pages)
SELECT page_id, href, regexp_full_match(regexp_replace(href, '^/', ''), '[0-9]+') AS is_digit FROM h
""")
def q_html_attr_values(spark, d):
    v = HJ.attr_values(Tables(spark, d).pages, "a", "href")
    return v.select("page_id", "href", F.regexp_replace("href", "^/", "").rlike("^[0-9]+$").alias("is_digit"))


@register("html_links", oracle=r"""
WITH l AS (SELECT page_id, url, regexp_extract_all(html, '<a href="([^"]*)"', 1) AS hs FROM pages),
h AS (SELECT page_id, url, unnest(hs) AS href, generate_subscripts(hs, 1) AS i FROM l),
b AS (SELECT *, regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)', 1) AS origin,
             regexp_replace(regexp_replace(url, '#.*$', ''), '\?.*$', '') AS no_query FROM h),
c AS (SELECT *, regexp_extract(no_query, '^(.*/)', 1) AS dir0 FROM b),
a AS (SELECT page_id, i,
  CASE WHEN starts_with(trim(href), 'http://') OR starts_with(trim(href), 'https://') OR starts_with(trim(href), 'data:') OR starts_with(trim(href), '//') THEN trim(href)
       WHEN starts_with(trim(href), '/') THEN origin || trim(href)
       WHEN starts_with(trim(href), '?') THEN no_query || trim(href)
       ELSE (CASE WHEN length(dir0) <= length(origin) THEN origin || '/' ELSE dir0 END) || regexp_replace(trim(href), '^\./', '')
  END AS link FROM c WHERE trim(href) <> ''),
f AS (SELECT page_id, CASE WHEN starts_with(link, '//') THEN 'https:' || link ELSE link END AS link, min(i) AS first_i FROM a GROUP BY ALL)
SELECT page_id, link, CAST(row_number() OVER (PARTITION BY page_id ORDER BY first_i, link) AS INTEGER) AS sort_order FROM f
""")
def q_html_links(spark, d):
    return HJ.links(Tables(spark, d).pages)


def _card_pages(t):
    o = t.orders
    k = F.col("o_orderkey")
    ids = F.concat(
        F.lit('<ul><li><a data-product-id="'), k.cast("string"), F.lit('"></a><a data-product-id="'),
        F.col("o_custkey").cast("string"), F.lit('"></a><a data-product-id="x'), k.cast("string"), F.lit('"></a>'),
        F.when(k % 4 != 0, F.concat(F.lit('<a data-product-id="'), (k + 1).cast("string"), F.lit('"></a>'))).otherwise(F.lit("")),
        F.lit("</li></ul>"))

    def card(rate, price):
        return F.concat(F.lit('<div class="card product-section-ul-li"><span class="card-info_rate">'), rate,
                        F.lit('</span><div class="card-info_price"><strong>'), price, F.lit("</strong>원</div></div>"))

    c1 = card(F.concat((k % 30).cast("string"), F.lit("%")), F.format_number(F.floor("o_totalprice"), 0))
    c2 = card(F.concat((F.col("o_custkey") % 50).cast("string"), F.lit("%")), F.format_number(F.col("o_custkey") * 7, 0))
    c3 = F.when(k % 3 == 0, card(F.lit(""), F.lit("N/A"))).otherwise(F.lit(""))
    return o.select(k.alias("page_id"), F.concat(F.lit("<html><body>"), ids, c1, c2, c3, F.lit("</body></html>")).alias("html"))


@register("html_price_cards", oracle="""
SELECT o_orderkey AS page_id, 1 AS i, CAST(o_orderkey AS VARCHAR) AS kok_product_id,
       CAST(o_orderkey % 30 AS VARCHAR) || '%' AS kok_discount_rate, CAST(floor(o_totalprice) AS BIGINT) AS kok_discounted_price,
       CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR) AS price_text FROM orders
UNION ALL
SELECT o_orderkey, 2, CAST(o_custkey AS VARCHAR), CAST(o_custkey % 50 AS VARCHAR) || '%', o_custkey * 7,
       CAST(o_custkey * 7 AS VARCHAR) FROM orders
UNION ALL
SELECT o_orderkey, 3, CAST(o_orderkey + 1 AS VARCHAR), '', NULL, 'N/A' FROM orders WHERE o_orderkey % 4 <> 0 AND o_orderkey % 3 = 0
""")
def q_html_price_cards(spark, d):
    out = HJ.price_cards(_card_pages(Tables(spark, d)))
    return out.withColumn("i", F.col("i").cast("int"))


@register("html_kv_rows", oracle="""
SELECT p_partkey AS page_id, 'brand' AS detail_col, p_brand AS detail_val FROM part
UNION ALL SELECT p_partkey, 'type', p_type FROM part
UNION ALL SELECT p_partkey, 'size', CAST(p_size AS VARCHAR) FROM part
UNION ALL SELECT p_partkey, 'name', '' FROM part WHERE p_partkey % 2 = 0
""")
def q_html_kv_rows(spark, d):
    p = Tables(spark, d).part
    html = F.concat(
        F.lit('<table class="row-table mb--40"><tr><th>brand</th><td>'), F.col("p_brand"),
        F.lit("</td></tr><tr><th> type </th><td>"), F.col("p_type"),
        F.lit("</td></tr><tr><td>size</td><td>"), F.col("p_size").cast("string"), F.lit("</td></tr>"),
        F.when(F.col("p_partkey") % 2 == 0, F.lit("<tr><th>name</th><td> </td></tr>")).otherwise(F.lit("")),
        F.lit("<tr><th></th><td></td></tr></table>"))
    pages = p.select(F.col("p_partkey").alias("page_id"), html.alias("html"))
    return HJ.kv_rows(pages).drop("row_pos")


_SENT = "list_filter(list_transform(string_split(text, '. '), lambda x: trim(regexp_replace(x, '\\s+', ' ', 'g'))), lambda x: x <> '')"


@register("html_reviews", oracle=f"""
WITH c AS (SELECT conv_id * 1000 + turn AS page_id, role, turn, {_SENT} AS s FROM conversations),
r AS (SELECT page_id, role, turn, unnest(s) AS sentence, generate_subscripts(s, 1) AS i FROM c)
SELECT page_id, CAST(i AS INTEGER) AS n, role || '-' || CAST(i AS VARCHAR) AS kok_nickname,
       '2024-01-' || lpad(CAST(i % 28 + 1 AS VARCHAR), 2, '0') AS kok_review_date,
       CAST((turn + i) % 5 + 1 AS INTEGER) AS kok_review_score,
       CASE WHEN i % 2 = 0 THEN 'good' ELSE 'ok' END AS price_eval, 'fast' AS delivery_eval, role AS taste_eval,
       sentence AS kok_review_text
FROM r WHERE i <= 10
""")
def q_html_reviews(spark, d):
    c = Tables(spark, d).conversations
    sents = F.filter(F.transform(F.split("text", r"\. "), lambda x: F.trim(F.regexp_replace(x, r"\s+", " "))),
                     lambda x: x != "")

    def item(x, i):
        n = i + 1
        s = (F.col("turn") + n) % 5 + 1
        esc = F.replace(F.replace(x, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
        return F.concat(
            F.lit('<li class="review_info_info_item"><div class="phone">'), F.col("role"), F.lit("-"), n.cast("string"),
            F.lit('</div><div class="date">2024-01-'), F.lpad((n % 28 + 1).cast("string"), 2, "0"),
            F.lit('</div><div class="stars">'), F.repeat(F.lit('<img src="/i/s_star_fill.png">'), s.cast("int")),
            F.repeat(F.lit('<img src="/i/s_star_empty.png">'), (5 - s).cast("int")),
            F.lit('</div><ul class="list"><li><p>가격</p><span>'),
            F.when(n % 2 == 0, F.lit("good")).otherwise(F.lit("ok")),
            F.lit("</span></li><li><p>배송</p><span>fast</span></li><li><p>맛</p><span>"), F.col("role"),
            F.lit('</span></li></ul><div class="text">'), esc, F.lit("</div></li>"))

    html = F.concat(F.lit("<html><body><ul>"), F.array_join(F.transform(sents, item), ""), F.lit("</ul></body></html>"))
    pages = c.select((F.col("conv_id") * 1000 + F.col("turn")).alias("page_id"), html.alias("html"))
    return HJ.reviews(pages).withColumn("n", F.col("n").cast("int")) \
        .withColumn("kok_review_score", F.col("kok_review_score").cast("int"))


@register("html_images", oracle="""
WITH p AS (SELECT p_partkey, 'https://shop.example.com' AS o, replace(p_brand, '#', '') AS b FROM part)
SELECT p_partkey AS page_id, o || '/img/' || p_partkey || '-a.jpg' AS img_url, 1 AS sort_order FROM p
UNION ALL SELECT p_partkey, 'https://cdn.example.com/img/' || p_partkey || '-a.jpg', 2 FROM p
UNION ALL SELECT p_partkey, o || '/img/spacer.gif', 3 FROM p
UNION ALL SELECT p_partkey, o || '/item/' || p_partkey || '/img/' || p_partkey || '-b.png', 4 FROM p
UNION ALL SELECT p_partkey, o || '/img/' || p_partkey || '-l.jpg', 5 FROM p
UNION ALL SELECT p_partkey, o || '/bg/' || b || '.png', 6 FROM p
""")
def q_html_images(spark, d):
    p = Tables(spark, d).part
    k = F.col("p_partkey").cast("string")
    html = F.concat(
        F.lit('<div class="product_info_area"><img src="/img/'), k, F.lit('-a.jpg" data-src="//cdn.example.com/img/'), k,
        F.lit('-a.jpg"><img data-original="img/'), k, F.lit('-b.png" src="/img/spacer.gif"><img src="/img/'), k,
        F.lit('-a.jpg"><img srcset="/img/'), k, F.lit('-s.jpg 1x, /img/'), k,
        F.lit('-l.jpg 2x"><img src="data:image/png;base64,AAAA"><div style="background:url(\'/bg/'),
        F.replace(F.col("p_brand"), F.lit("#"), F.lit("")), F.lit(".png')\"></div></div>"))
    pages = p.select(F.col("p_partkey").alias("page_id"),
                     F.concat(F.lit("https://shop.example.com/item/"), k, F.lit("/view")).alias("url"), html.alias("html"))
    return HJ.images(pages)


@register("html_embedded_json", oracle="""
SELECT p_partkey AS page_id, p_name AS name, p_brand AS brand, CAST(round(p_retailprice * 100) AS BIGINT) AS price,
       p_size AS size, CAST(NULL AS VARCHAR) AS missing FROM part
""")
def q_html_embedded_json(spark, d):
    p = Tables(spark, d).part
    js = F.to_json(F.struct(F.struct(F.struct(F.struct(
        F.col("p_name").alias("name"), F.col("p_brand").alias("brand"),
        F.round(F.col("p_retailprice") * 100).cast("bigint").alias("price"), F.col("p_size").alias("size")
    ).alias("product")).alias("pageProps")).alias("props")))
    html = F.concat(F.lit('<html><head><script id="__NEXT_DATA__" type="application/json">'), js,
                    F.lit("</script></head><body><p>x</p></body></html>"))
    pages = p.select(F.col("p_partkey").alias("page_id"), html.alias("html"))
    j = HJ.embedded_json(pages)
    g = lambda path: F.get_json_object("json_text", path)
    return j.select("page_id", g("$.props.pageProps.product.name").alias("name"),
                    g("$.props.pageProps.product.brand").alias("brand"),
                    g("$.props.pageProps.product.price").cast("bigint").alias("price"),
                    g("$.props.pageProps.product.size").cast("int").alias("size"),
                    g("$.props.pageProps.product.missing").alias("missing"))


@register("html_schedule", oracle="""
WITH o AS (SELECT o_orderkey, o_custkey, o_orderpriority, o_totalprice, o_orderstatus,
                  lpad(CAST(o_orderkey % 24 AS VARCHAR), 2, '0') || ':00' AS st,
                  lpad(CAST((o_orderkey + 1) % 24 AS VARCHAR), 2, '0') || ':30' AS en,
                  strftime(o_orderdate, '%Y%m%d') AS live_date FROM orders),
m AS (SELECT *, CASE WHEN o_orderkey % 10 = 0 THEN '12:00 ~ ' || en ELSE st || ' ~ ' || en END AS live_time,
                 CASE WHEN o_orderkey % 10 = 0 THEN '지금방송중 ' || o_orderpriority ELSE o_orderpriority END AS live_title FROM o)
SELECT o_orderkey AS page_id, live_date, live_time, 'main' AS promotion_type, live_title,
       CAST(o_orderkey AS VARCHAR) AS product_id, 'order ' || o_orderstatus AS product_name,
       CASE WHEN o_orderkey % 7 = 0 THEN '상담 예약 상품' ELSE format('{:,}', CAST(floor(o_totalprice) AS BIGINT)) END AS dc_price,
       CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE CAST(o_orderkey % 40 AS VARCHAR) || '%' END AS dc_rate,
       'https://img.example.com/o/' || o_orderkey || '.jpg' AS thumb_img_url
FROM m
UNION ALL
SELECT o_orderkey, live_date, live_time, 'sub', live_title, CAST(o_custkey AS VARCHAR), 'customer ' || o_custkey,
       CAST(o_custkey * 3 AS VARCHAR), NULL, 'https://img.example.com/c/' || o_custkey || '.jpg'
FROM m WHERE o_orderkey % 2 = 0
""")
def q_html_schedule(spark, d):
    o = Tables(spark, d).orders
    k = F.col("o_orderkey")
    st = F.concat(F.lpad((k % 24).cast("string"), 2, "0"), F.lit(":00"))
    en = F.concat(F.lpad(((k + 1) % 24).cast("string"), 2, "0"), F.lit(":30"))
    tt = F.when(k % 10 == 0, F.lit("지금방송중")).otherwise(F.concat(st, F.lit(" ~ "), en))
    price = F.when(k % 7 == 0, F.lit('<p class="counselPrd">상담 예약 상품</p>')).otherwise(
        F.concat(F.lit("<strong>"), F.format_number(F.floor("o_totalprice"), 0), F.lit("</strong>원")))
    rate = F.when(k % 5 == 0, F.lit("<span>nan</span>")).otherwise(
        F.concat(F.lit("<span>"), (k % 40).cast("string"), F.lit("%</span>")))
    sub = F.when(k % 2 == 0, F.concat(
        F.lit("<div class=\"sub-prd\"><ul><li><a onclick=\"go('"), F.col("o_custkey").cast("string"),
        F.lit("')\">x</a><p class=\"tit\">customer "), F.col("o_custkey").cast("string"),
        F.lit("</p><div class=\"price\"><strong>"), (F.col("o_custkey") * 3).cast("string"),
        F.lit("</strong></div><img src=\"//img.example.com/c/"), F.col("o_custkey").cast("string"),
        F.lit(".jpg\"></li></ul></div>"))).otherwise(F.lit(""))
    html = F.concat(
        F.lit('<div id="scheduleWrap" date="'), F.date_format("o_orderdate", "yyyyMMdd"), F.lit('">'),
        F.lit('<div id="onAirTime" bdEtimeSecond="2024-01-15 '), en, F.lit(':00"></div><ul><li class="item">'),
        F.lit('<div class="live-time"><span>'), tt, F.lit('</span><p class="time">'), tt, F.lit(" "),
        F.col("o_orderpriority"), F.lit('</p></div><a class="goods-info" onclick="go(\''), k.cast("string"),
        F.lit("')\"><p class=\"tit\">order "), F.col("o_orderstatus"), F.lit('</p></a><div class="price">'), price,
        F.lit('</div><div class="rate">'), rate, F.lit('</div><div class="goods-thumb"><img src="//img.example.com/o/'),
        k.cast("string"), F.lit('.jpg"></div>'), sub, F.lit("</li></ul></div>"))
    pages = o.select(k.alias("page_id"), html.alias("html"))
    return HJ.schedule_items(pages, NOW)


def _esc(c):
    return F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))


@register("html_meta_tags", oracle="""
SELECT p_partkey AS page_id, CAST(NULL AS VARCHAR) AS name, 'og:title' AS property, p_name AS content FROM part
UNION ALL SELECT p_partkey, 'recobell', 'eg:itemId', CAST(p_partkey AS VARCHAR) FROM part
UNION ALL SELECT p_partkey, 'author', NULL, p_brand FROM part WHERE p_partkey % 2 = 0
UNION ALL SELECT p_partkey, 'keywords', NULL, '' FROM part
""")
def q_html_meta_tags(spark, d):
    p = Tables(spark, d).part
    k = F.col("p_partkey").cast("string")
    html = F.concat(
        F.lit('<html><head><meta charset="utf-8"><meta property="og:title" content="'), _esc("p_name"),
        F.lit('"><meta property="og:title" content="later"/><meta name="recobell" property="eg:itemId" content="'), k, F.lit('">'),
        F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit('<meta name="author" content="'), _esc("p_brand"), F.lit('">'))).otherwise(""),
        F.lit('<meta name="keywords" content=""></head><body></body></html>'))
    return HJ.meta_tags(p.select(F.col("p_partkey").alias("page_id"), html.alias("html")))


@register("html_info_images", oracle="""
SELECT p_partkey AS page_id, '/img/' || p_partkey || '.jpg' AS img_url FROM part
UNION ALL SELECT p_partkey, '/img/' || p_partkey || '.jpg' FROM part WHERE p_partkey % 3 = 0
""")
def q_html_info_images(spark, d):
    p = Tables(spark, d).part
    img = F.concat(F.lit('<img src="/img/'), F.col("p_partkey").cast("string"), F.lit('.jpg">'))
    html = F.concat(F.lit('<img src="/out.png"><div class="area product_info_area"><p>'), img, F.lit('</p><img src="/a.GIF"><img src=""><img>'),
                    F.when(F.col("p_partkey") % 3 == 0, img).otherwise(""), F.lit('</div><img src="/after.png">'))
    return HJ.info_images(p.select(F.col("p_partkey").alias("page_id"), html.alias("html"))).drop("pos")


@register("html_detail_rows", oracle="""
SELECT p_partkey AS page_id, 'type' AS detail_col, p_type AS detail_val FROM part WHERE p_partkey % 4 <> 0
UNION ALL SELECT p_partkey, 'size', CAST(p_size AS VARCHAR) FROM part WHERE p_partkey % 4 <> 0
""")
def q_html_detail_rows(spark, d):
    p = Tables(spark, d).part
    two = F.concat(F.lit('<table class="row-table mb--40"><tr><th>type</th><td>'), F.col("p_type"),
                   F.lit("</td></tr><tr><th>size</th><td>"), F.col("p_size").cast("string"), F.lit("</td></tr></table>"))
    html = F.concat(F.lit('<table class="other"><tr><th>x</th><td>y</td></tr></table><table class="mb--40 row-table"><tr><th>brand</th><td>'),
                    F.col("p_brand"), F.lit("</td></tr></table>"), F.when(F.col("p_partkey") % 4 != 0, two).otherwise(""))
    return HJ.kv_rows(p.select(F.col("p_partkey").alias("page_id"), html.alias("html")), "row-table mb--40", 2).drop("row_pos")


@register("html_product_row", oracle="""
WITH p AS (SELECT *, CAST(p_partkey AS VARCHAR) AS k, p_partkey % 5 = 0 AS bare FROM part)
SELECT p_partkey AS kok_product_id, CASE WHEN NOT bare THEN p_brand END AS kok_store_name,
       CASE WHEN NOT bare THEN p_brand || p_name END AS kok_product_name,
       CASE WHEN bare THEN NULL WHEN p_partkey % 3 = 0 THEN '/og/' || k || '.png' ELSE '/t/' || k || '.jpg' END AS kok_thumbnail,
       CASE WHEN NOT bare THEN CAST(p_size * 100 AS VARCHAR) || '원' END AS kok_product_price,
       CASE WHEN NOT bare THEN '4.5' END AS kok_review_score, CASE WHEN NOT bare THEN CAST(p_size AS VARCHAR) END AS kok_review_cnt,
       CASE WHEN NOT bare THEN '5%' END AS kok_5_ratio, CASE WHEN NOT bare THEN '4%' END AS kok_4_ratio,
       CASE WHEN NOT bare THEN '3%' END AS kok_3_ratio, CAST(NULL AS VARCHAR) AS kok_2_ratio, CASE WHEN NOT bare THEN '1%' END AS kok_1_ratio,
       CASE WHEN NOT bare THEN 'cheap' END AS kok_aspect_price, CASE WHEN NOT bare THEN '11%' END AS kok_aspect_price_ratio,
       CASE WHEN NOT bare THEN 'fast' END AS kok_aspect_delivery, CASE WHEN NOT bare THEN '12%' END AS kok_aspect_delivery_ratio,
       CAST(NULL AS VARCHAR) AS kok_aspect_taste, CAST(NULL AS VARCHAR) AS kok_aspect_taste_ratio,
       CASE WHEN NOT bare THEN 'c0' || k END AS kok_seller, CASE WHEN NOT bare THEN 'c1' || k END AS kok_co_ceo,
       CASE WHEN NOT bare THEN 'c2' || k END AS kok_co_reg_no, CAST(NULL AS VARCHAR) AS kok_co_ec_reg,
       CASE WHEN NOT bare THEN 'c4' || k END AS kok_tell, CASE WHEN NOT bare THEN 'c5' || k END AS kok_ver_item,
       CASE WHEN NOT bare THEN 'c6' || k END AS kok_ver_date, CASE WHEN NOT bare THEN 'c7' || k END AS kok_co_addr,
       CAST(NULL AS VARCHAR) AS kok_return_addr, CAST(NULL AS VARCHAR) AS kok_exchange_addr
FROM p
""")
def q_html_product_row(spark, d):
    p = Tables(spark, d).part
    k = F.col("p_partkey").cast("string")
    cells = F.concat(*[F.concat(F.lit(f"<tr><th>h{i}</th><td> "), F.lit("") if i == 3 else F.concat(F.lit(f"c{i}"), k), F.lit("</td></tr>"))
                       for i in range(8)])
    per = "".join(f'<li class="per"><b>x</b><div>{v}</div></li>' for v in ("5%", "4%", "3%", "", "1%", "11%", "12%"))
    full = F.concat(
        F.lit('<html><head><meta property="og:image" content="/og/'), k, F.lit('.png"></head><body><span class="product__title"><strong>'),
        F.col("p_brand"), F.lit("</strong> "), F.col("p_name"), F.lit('</span><div class="card_main-image"><a><img src="'),
        F.when(F.col("p_partkey") % 3 == 0, F.lit("about:blank")).otherwise(F.concat(F.lit("/t/"), k, F.lit(".jpg"))),
        F.lit('"></a></div><div class="card-info-del_wrap"><p><del>'), (F.col("p_size") * 100).cast("string"),
        F.lit('원</del></p></div><button id="other"><span>0</span></button><button id="review_show"><span>4.5</span><strong>'),
        F.col("p_size").cast("string"), F.lit(f'</strong></button><div class="review_info_list"><ul>{per}<li class="info"><div>cheap</div></li>'
                                              '<li class="info"><div>fast</div></li></ul></div><table class="row-table mb--40">'),
        cells, F.lit('</table><table class="row-table mb--40"><tr><td>other</td></tr></table></body></html>'))
    html = F.when(F.col("p_partkey") % 5 == 0, F.lit("<html><body><p>gone</p></body></html>")).otherwise(full)
    return HJ.product_rows(p.select(F.col("p_partkey").alias("page_id"), html.alias("html")))


@register("html_price_block", oracle="""
WITH o AS (SELECT o_orderkey AS k, CAST(floor(o_totalprice) AS BIGINT) AS p, o_orderkey % 6 AS v FROM orders),
b AS (SELECT k, v, CASE v WHEN 0 THEN p WHEN 1 THEN p + 7 WHEN 2 THEN p WHEN 3 THEN p WHEN 4 THEN NULL ELSE p END AS sale_price,
             CASE v WHEN 0 THEN p // 2 WHEN 1 THEN p // 3 WHEN 2 THEN p WHEN 3 THEN p - 1 WHEN 4 THEN NULL ELSE p + 5 END AS dc_price FROM o)
SELECT k AS page_id, sale_price, dc_price,
       CASE v WHEN 1 THEN 66 WHEN 2 THEN 0 WHEN 4 THEN NULL WHEN 5 THEN NULL
              ELSE CAST(round_even(CAST((sale_price - dc_price) AS DOUBLE) * 100 / sale_price, 0) AS BIGINT) END AS dc_rate
FROM b
""")
def q_html_price_block(spark, d):
    o = Tables(spark, d).orders
    k, p = F.col("o_orderkey"), F.floor("o_totalprice").cast("bigint")
    won = lambda c: F.concat(F.format_number(c, 0), F.lit("원"))

    def meta(name, c):
        return F.concat(F.lit(f'<meta name="recobell" property="eg:{name}" content="'), c.cast("string"), F.lit('">'))

    cut = F.concat(F.lit('<div class="price-wrap"><em class="dc-price">'), won(F.expr("cast(floor(o_totalprice) as bigint) div 3")),
                   F.lit('</em><span class="origin-price">'), won(p + 7), F.lit('</span><b class="dc-rate">66%</b></div>'
                                                                                '<div class="price-wrap"><em class="dc-price">1</em></div>'))
    plain = F.concat(F.lit('<div class="price-wrap"><span class="current-price">'), won(p), F.lit("</span></div>"))
    v = k % 6
    html = (F.when(v == 0, F.concat(meta("originalPrice", p), meta("salePrice", F.expr("cast(floor(o_totalprice) as bigint) div 2"))))
            .when(v == 1, F.concat(meta("originalPrice", p), meta("salePrice", p), cut))
            .when(v == 2, plain)
            .when(v == 3, F.concat(meta("originalPrice", p), meta("salePrice", p - 1), F.lit('<div class="price-wrap"></div>')))
            .when(v == 4, F.lit("<p>no price</p>"))
            .otherwise(F.concat(meta("originalPrice", p), meta("salePrice", p + 5))))
    return HJ.price_block(o.select(k.alias("page_id"), html.alias("html")))
