"""Page extraction jobs built on the node table (see operators.html)."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkmart.functions.collections import srcset_last
from sparkmart.functions.text import https, num_only
from sparkmart.functions.urls import url_absolutise
from sparkmart.operators import html as H
from sparkmart.operators.aggregates import kv_pivot

# Image attributes read in this order for lazy-loaded images,
# the review aspects (label text -> column) and the filled-star icon marker.
LAZY_IMG_ATTRS = ["src", "data-src", "data-original", "data-lazy", "data-echo", "data-image", "data-img"]
REVIEW_ASPECTS = {"가격": "price_eval", "배송": "delivery_eval", "맛": "taste_eval"}
STAR_FILLED = "s_star_fill"
MAX_REVIEWS = 10


def page_fields(pages: DataFrame) -> DataFrame:
    """title, first h1, html lang, meta charset, number of <p> per page."""
    nodes = H.parse_nodes(pages, keep_tags=["html", "title", "h1", "meta", "p"])
    long = nodes.select(
        "page_id", "pos",
        F.when(F.col("tag") == "meta", F.lit("charset")).otherwise(F.col("tag")).alias("field"),
        F.when(F.col("tag") == "html", H.attr("lang")).when(F.col("tag") == "meta", H.attr("charset"))
        .otherwise(F.col("text")).alias("value"))
    firsts = long.filter(F.col("field") != "p").groupBy("page_id").pivot("field", ["title", "h1", "html", "charset"]) \
        .agg(F.min_by("value", "pos"))
    n_p = long.groupBy("page_id").agg(F.count_if(F.col("field") == "p").alias("n_paragraphs"))
    return pages.select("page_id").join(firsts, "page_id", "left").join(n_p, "page_id", "left") \
        .withColumnRenamed("html", "lang")


def attr_values(pages: DataFrame, tag: str, name: str) -> DataFrame:
    """(page_id, pos, value) of attribute ``name`` on ``tag`` elements."""
    nodes = H.parse_nodes(pages, keep_tags=[tag], materialize=False)
    return nodes.filter(H.attr(name).isNotNull()).select("page_id", "pos", H.attr(name).alias(name))


def links(pages: DataFrame) -> DataFrame:
    """Absolute link URLs per page, de-duplicated in first-seen order and
    numbered 1..n."""
    hrefs = attr_values(pages, "a", "href").join(pages.select("page_id", "url"), "page_id")
    abs_ = hrefs.select("page_id", "pos", https(url_absolutise(F.trim("href"), "url")).alias("link"))
    return H.dedupe_numbered(abs_.filter(F.col("link").isNotNull()), ["page_id"], "link")


def images(pages: DataFrame) -> DataFrame:
    """Image URLs of a page in collection order (lazy attributes of every
    <img>, then the last srcset candidate, then CSS background url()),
    absolutised, protocol-fixed, without data: URIs, de-duplicated first-seen
    and numbered 1..n."""
    nodes = H.parse_nodes(pages, keep_tags=["img", "source", "div"])
    imgs = nodes.filter(F.col("tag") == "img")
    cands = F.array(*[F.struct(F.lit(i).alias("k"), H.attr(a).alias("u")) for i, a in enumerate(LAZY_IMG_ATTRS)])
    lazy = imgs.select("page_id", "pos", F.inline(cands)).select(
        "page_id", F.lit(0).alias("phase"), "pos", "k", "u")
    sets = nodes.filter(F.col("tag").isin("img", "source") & H.attr("srcset").isNotNull()).select(
        "page_id", F.lit(1).alias("phase"), "pos", F.lit(0).alias("k"), srcset_last(H.attr("srcset")).alias("u"))
    bg = nodes.filter((F.col("tag") == "div") & H.attr("style").isNotNull()).select(
        "page_id", "pos", F.posexplode(F.regexp_extract_all(H.attr("style"), F.lit(r"(?i)url\((.*?)\)"), 1)).alias("k", "u")
    ).select("page_id", F.lit(2).alias("phase"), "pos", "k", F.regexp_replace("u", "^[ '\"]+|[ '\"]+$", "").alias("u"))
    allc = lazy.unionByName(sets).unionByName(bg).filter(F.col("u").isNotNull() & (F.col("u") != ""))
    allc = allc.join(pages.select("page_id", "url"), "page_id")
    u = https(url_absolutise(F.trim("u"), "url"))
    cleaned = allc.select("page_id", F.struct("phase", "pos", "k").alias("ord"), u.alias("img_url")) \
        .filter(~F.col("img_url").startswith("data:"))
    return H.dedupe_numbered(cleaned, ["page_id"], "img_url", order="ord")


def price_cards(pages: DataFrame, card_class: str = "product-section-ul-li", rate_class: str = "card-info_rate",
                price_class: str = "card-info_price") -> DataFrame:
    """Product ids (digit-only ``data-product-id``) zipped by position with
    the price cards of the page, cut to the shorter list; price text has the
    thousands separators removed and is read as a number when it is digits."""
    card = f"div.{card_class}"

    def pick(nodes):
        """An entry per product id and per card; a card's has its first rate and price."""
        ids, cards = [], {}
        for pos, tag, cls, attrs, text, scope, scope_pos, parent_cls in nodes:
            if "data-product-id" in attrs:
                ids.append((True, pos, attrs["data-product-id"], None, None, None, None))
            if tag == "div" and card_class in cls.split(" "):
                cards[pos] = [False, pos, None, None, None, None, None]
            if scope == card:
                entry = cards[scope_pos]
                if entry[3] is None and rate_class in cls.split(" "):
                    entry[3:5] = pos, text
                if entry[5] is None and tag == "strong" and price_class in (parent_cls or "").split(" "):
                    entry[5:7] = pos, text
        return [*ids, *cards.values()]

    entries = H.page_rows(pages, pick, pa.schema([
        ("is_id", pa.bool_()), ("key", pa.int32()), ("id", pa.string()), ("rate_pos", pa.int32()), ("rate", pa.string()),
        ("price_pos", pa.int32()), ("price", pa.string())]), scopes=[card], keep_tags=["div", "span", "strong", "a"])
    wanted = F.col("page_id").isNotNull() & (~F.col("is_id") | F.col("id").rlike("^[0-9]+$"))
    # dealt by page once: put together (a page may be there several times), numbered, and the pairs of a number joined
    found = entries.where(wanted).repartition("page_id").groupBy("page_id", "is_id", "key", "id").agg(
        F.count(F.lit(1)).alias("n"), F.min_by("rate", "rate_pos").alias("rate"), F.min_by("price", "price_pos").alias("price"))
    found = found.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))))
    numbered = found.withColumn("i", F.row_number().over(Window.partitionBy("page_id", "is_id").orderBy("key", "id")))
    is_card = ~F.col("is_id")
    pairs = numbered.groupBy("page_id", "i").agg(
        F.max(F.when(F.col("is_id"), F.col("id"))).alias("kok_product_id"), F.bool_or(is_card).alias("_card"),
        F.max(F.when(is_card, F.col("rate"))).alias("rate"), F.max(F.when(is_card, F.col("price"))).alias("price"))
    p = F.replace(F.col("price"), F.lit(","), F.lit(""))
    return pairs.where(F.col("_card") & F.col("kok_product_id").isNotNull()).select(
        "page_id", "i", "kok_product_id", F.col("rate").alias("kok_discount_rate"),
        F.when(p.rlike("^[0-9]+$"), p.cast("bigint")).alias("kok_discounted_price"),
        p.alias("price_text"))


def kv_rows(pages: DataFrame, table_class: str | None = None, table_no: int | None = None) -> DataFrame:
    """Key / value rows of tables: per <tr>, first th (else first td) is the
    key and the next cell the value; rows where both are missing are dropped.
    ``table_class`` (one or more class names) keeps tables of that class,
    ``table_no`` the n-th of them on the page (from 1)."""
    nodes = H.parse_nodes(pages, scopes=["tr", "table"], keep_tags=["tr", "th", "td", "table"],
                          materialize=bool(table_class or table_no))
    cells = nodes.filter(F.col("tag").isin("th", "td") & (F.col("scope") == "tr"))
    if table_class or table_no:
        of_class = F.lit(True)
        for c in (table_class or "").split():
            of_class = of_class & H.has_class(c)
        chosen = nodes.filter((F.col("tag") == "table") & of_class).select("page_id", F.col("pos").alias("_table"))
        if table_no:
            nth = F.row_number().over(Window.partitionBy("page_id").orderBy("_table"))
            chosen = chosen.withColumn("_n", nth).filter(F.col("_n") == table_no).drop("_n")
        rows = nodes.filter((F.col("tag") == "tr") & (F.col("scope") == "table")).select(
            "page_id", F.col("scope_pos").alias("_table"), F.col("pos").alias("scope_pos")).join(chosen, ["page_id", "_table"], "left_semi")
        cells = cells.join(rows.drop("_table"), ["page_id", "scope_pos"], "left_semi")
    per_row = cells.groupBy("page_id", "scope_pos").agg(
        F.min_by(F.struct("tag", "text"), F.col("pos")).alias("c1"),
        F.sort_array(F.collect_list(F.struct("pos", "tag", "text"))).alias("cs"))
    key = F.col("c1.text")
    val = F.when(F.col("c1.tag") == "th",
                 F.try_element_at(F.filter("cs", lambda x: x["tag"] == "td"), F.lit(1))["text"]) \
        .otherwise(F.try_element_at("cs", F.lit(2))["text"])
    out = per_row.select("page_id", F.col("scope_pos").alias("row_pos"), key.alias("detail_col"), val.alias("detail_val"))
    present = F.coalesce(F.col("detail_col"), F.lit("")) != ""
    return out.filter(present | (F.coalesce(F.col("detail_val"), F.lit("")) != ""))


def meta_tags(pages: DataFrame) -> DataFrame:
    """(page_id, name, property, content): the first <meta> of each name and property."""
    nodes = H.parse_nodes(pages, keep_tags=["meta"], materialize=False)
    tags = nodes.filter((F.col("tag") == "meta") & H.attr("content").isNotNull())
    return tags.groupBy("page_id", H.attr("name").alias("name"), H.attr("property").alias("property")).agg(
        F.min_by(H.attr("content"), "pos").alias("content"))


def info_images(pages: DataFrame, container: str = "div.product_info_area") -> DataFrame:
    """(page_id, pos, img_url): ``src`` of the images inside the container, no GIFs."""
    nodes = H.parse_nodes(pages, scopes=[container], keep_tags=["img"], materialize=False)
    src = H.attr("src")
    return nodes.filter((F.col("tag") == "img") & (F.col("scope") == container) & (src != "")
                        & ~F.lower(src).endswith(".gif")).select("page_id", "pos", src.alias("img_url"))


def _first(cond, value):
    """First value in document order where ``cond`` holds."""
    return F.min_by(F.when(cond, value), F.when(cond, F.col("pos")))


def _all(cond, value):
    """All values in document order where ``cond`` holds."""
    return F.transform(F.sort_array(F.collect_list(F.when(cond, F.struct("pos", value.alias("v"))))), lambda x: x["v"])


# The columns filled from the lists of a product page, in page order.
RATIO_COLUMNS = ["kok_5_ratio", "kok_4_ratio", "kok_3_ratio", "kok_2_ratio", "kok_1_ratio"]
ASPECT_COLUMNS = ["kok_aspect_price", "kok_aspect_delivery", "kok_aspect_taste"]
SELLER_COLUMNS = ["kok_seller", "kok_co_ceo", "kok_co_reg_no", "kok_co_ec_reg", "kok_tell", "kok_ver_item",
                  "kok_ver_date", "kok_co_addr", "kok_return_addr", "kok_exchange_addr"]


def product_rows(pages: DataFrame) -> DataFrame:
    """Product page -> one row of 28 fields (id, store, name, thumbnail, price,
    review score and count, five ratios, three aspects with ratios, ten seller
    cells); a blank is NULL, and a page without a field has NULL there. The
    thumbnail falls back to og:image when it is missing or about:blank."""
    info, seller, score = "div.review_info_list", "table.row-table.mb--40", "button#review_show"
    nodes = H.parse_nodes(pages, scopes=[info, seller, score, "div.card-info-del_wrap", "div.card_main-image"],
                          keep_tags=["span", "strong", "del", "img", "meta", "td", "div"], materialize=False)
    tag, text, scope = F.col("tag"), F.col("text"), F.col("scope")
    cell = (tag == "td") & (scope == seller)
    per_page = nodes.groupBy("page_id").agg(
        _first((tag == "strong") & H.parent_has_class("product__title"), text).alias("kok_store_name"),
        _first((tag == "span") & H.has_class("product__title"), text).alias("kok_product_name"),
        _first((tag == "img") & (scope == "div.card_main-image"), F.coalesce(H.attr("src"), F.lit(""))).alias("_thumb"),
        _first((tag == "meta") & (H.attr("property") == "og:image"), H.attr("content")).alias("_og"),
        _first((tag == "del") & (scope == "div.card-info-del_wrap"), text).alias("kok_product_price"),
        _first((tag == "span") & (scope == score), text).alias("kok_review_score"),
        _first((tag == "strong") & (scope == score), text).alias("kok_review_cnt"),
        _all((tag == "div") & (scope == info) & H.parent_has_class("per"), text).alias("_per"),
        _all((tag == "div") & (scope == info) & H.parent_has_class("info"), text).alias("_info"),
        F.sort_array(F.collect_list(F.when(cell, F.struct("scope_pos", "pos", "text")))).alias("_cells"))
    first_table = F.filter("_cells", lambda c: c["scope_pos"] == F.try_element_at(F.col("_cells"), F.lit(1))["scope_pos"])

    def at(values, i: int, name: str):
        return F.nullif(F.try_element_at(values, F.lit(i + 1)), F.lit("")).alias(name)

    def field(name: str):
        return F.nullif(F.col(name), F.lit("")).alias(name)

    cells = F.transform(first_table, lambda c: c["text"])
    no_thumb = F.coalesce(F.col("_thumb"), F.lit("")).isin("") | F.col("_thumb").contains("about:blank")
    aspects = [c for i, name in enumerate(ASPECT_COLUMNS)
               for c in (at(F.col("_info"), i, name), at(F.col("_per"), 5 + i, f"{name}_ratio"))]
    out = per_page.select(
        F.col("page_id").alias("kok_product_id"), field("kok_store_name"), field("kok_product_name"),
        F.nullif(F.when(no_thumb, F.col("_og")).otherwise(F.col("_thumb")), F.lit("")).alias("kok_thumbnail"),
        field("kok_product_price"), field("kok_review_score"), field("kok_review_cnt"),
        *[at(F.col("_per"), i, name) for i, name in enumerate(RATIO_COLUMNS)], *aspects,
        *[at(cells, i, name) for i, name in enumerate(SELLER_COLUMNS)])
    return pages.select(F.col("page_id").alias("kok_product_id")).join(out, "kok_product_id", "left")


def price_block(pages: DataFrame) -> DataFrame:
    """(page_id, sale_price, dc_price, dc_rate): list price, selling price and
    rate of a page. The recobell meta tags come first; a discount block
    overrides them, an undiscounted price only fills what they leave open (rate
    0); a rate that is nowhere given is computed (half-even) where the selling
    price is at most the list price. 0 counts as missing where a value may
    still be found elsewhere."""
    box = ".price-wrap"
    nodes = H.parse_nodes(pages, scopes=[box])
    top = nodes.filter(F.coalesce(F.col("scope") == box, F.lit(False))).groupBy("page_id").agg(F.min("scope_pos").alias("_box"))
    nodes = nodes.join(top, "page_id", "left")
    inside = (F.col("scope") == box) & (F.col("scope_pos") == F.col("_box"))

    def meta(name: str):
        return num_only(_first((F.col("tag") == "meta") & (H.attr("name") == "recobell") & (H.attr("property") == name), H.attr("content")))

    def block(cls: str):
        return _first(inside & H.has_class(cls), F.col("text"))

    got = nodes.groupBy("page_id").agg(
        meta("eg:originalPrice").alias("m_list"), meta("eg:salePrice").alias("m_sale"), block("dc-price").alias("b_dc"),
        num_only(block("dc-price")).alias("dc"), num_only(block("origin-price")).alias("origin"),
        num_only(block("dc-rate")).alias("rate"), block("current-price").alias("b_now"), num_only(block("current-price")).alias("now"))
    cut = F.col("b_dc").isNotNull()
    plain = ~cut & F.col("b_now").isNotNull() & F.col("now").isNotNull()
    filled = lambda a, b: F.coalesce(F.nullif(F.col(a), F.lit(0)), F.col(b))
    got = got.select("page_id", F.when(cut, filled("origin", "m_list")).when(plain, filled("m_list", "now")).otherwise(F.col("m_list")).alias("sale_price"),
                     F.when(cut, filled("dc", "m_sale")).when(plain, filled("m_sale", "now")).otherwise(F.col("m_sale")).alias("dc_price"),
                     F.when(cut, F.col("rate")).when(plain, F.lit(0)).alias("_rate"))
    s, d = F.col("sale_price"), F.col("dc_price")
    computed = F.when((s > 0) & (d <= s), F.bround((s - d) * 100.0 / s, 0).cast("bigint"))
    out = got.select("page_id", "sale_price", "dc_price", F.coalesce(F.col("_rate").cast("bigint"), computed).alias("dc_rate"))
    return pages.select("page_id").join(out, "page_id", "left")


def reviews(pages: DataFrame, item_class: str = "review_info_info_item") -> DataFrame:
    """First ``MAX_REVIEWS`` review items per page: nickname, date, stars
    (filled icons), price / delivery / taste aspects, text."""
    item = f"li.{item_class}"
    nodes = H.parse_nodes(pages, scopes=[item, "li"], keep_tags=["li", "div", "img", "p", "span"])
    items = nodes.filter((F.col("tag") == "li") & H.has_class(item_class)).select("page_id", F.col("pos").alias("rpos"))
    items = items.withColumn("n", F.row_number().over(Window.partitionBy("page_id").orderBy("rpos"))) \
        .filter(F.col("n") <= MAX_REVIEWS)
    inner = nodes.filter(F.col("scope") == item)
    fields = inner.filter((F.col("tag") == "div") & F.col("cls").isin("phone", "date", "text")).groupBy(
        "page_id", F.col("scope_pos").alias("rpos")).pivot("cls", ["phone", "date", "text"]).agg(F.min_by("text", "pos"))
    stars = inner.filter(F.col("tag") == "img").groupBy("page_id", F.col("scope_pos").alias("rpos")).agg(
        F.count_if(H.attr("src").contains(STAR_FILLED)).alias("kok_review_score"))
    aspect_li = inner.filter(F.col("tag") == "li").select("page_id", F.col("pos").alias("apos"), F.col("scope_pos").alias("rpos"))
    asp = nodes.filter((F.col("scope") == "li") & F.col("tag").isin("p", "span")).groupBy(
        "page_id", F.col("scope_pos").alias("apos")).pivot("tag", ["p", "span"]).agg(F.min_by("text", "pos"))
    asp = asp.filter(F.col("p").isNotNull() & F.col("span").isNotNull()).join(aspect_li, ["page_id", "apos"])
    amap = asp.withColumn("col", F.coalesce(*[F.when(F.col("p") == k, F.lit(v)) for k, v in REVIEW_ASPECTS.items()])) \
        .filter(F.col("col").isNotNull())
    aspects = kv_pivot(amap, ["page_id", "rpos"], "col", "span", "apos", list(REVIEW_ASPECTS.values()))
    out = (items.join(fields, ["page_id", "rpos"], "left").join(stars, ["page_id", "rpos"], "left")
           .join(aspects, ["page_id", "rpos"], "left"))
    return out.select("page_id", "n", F.col("phone").alias("kok_nickname"), F.col("date").alias("kok_review_date"),
                      F.coalesce("kok_review_score", F.lit(0)).alias("kok_review_score"),
                      *REVIEW_ASPECTS.values(), F.col("text").alias("kok_review_text"))


def embedded_json(pages: DataFrame, script_id: str = "__NEXT_DATA__") -> DataFrame:
    """Text of ``<script id=...>`` per page (first one), for JSON path reads."""
    nodes = H.parse_nodes(pages, keep_tags=["script"], materialize=False)
    s = nodes.filter(H.attr("id") == script_id)
    return H.first_by_pos(s, ["page_id"], F.col("text"), "json_text")


def schedule_items(pages: DataFrame, now) -> DataFrame:
    """Schedule page -> main rows (``li.item``) and their sub rows
    (``.sub-prd li``): time range (the "on air" marker replaced by the
    current KST time ~ the on-air end time of the page), title, product id
    (from the goods link), name, price (or the consultation text), rate,
    thumbnail. Sub rows inherit the main row's time and title."""
    from sparkmart.functions.temporal import ON_AIR_TEXT, on_air_range

    # texts are kept for the elements that hold a field only
    nodes = H.parse_nodes(pages, scopes=["li.item", "li"], keep_tags=["div", "span", "p", "a", "strong", "img"])
    page_attr = nodes.groupBy("page_id").agg(
        F.max(H.attr("date")).alias("live_date"),
        F.max(F.substring(F.split(H.attr("bdetimesecond"), " ").getItem(1), 1, 5)).alias("_on_air_end"))
    items = nodes.filter((F.col("tag") == "li") & H.has_class("item")).select("page_id", F.col("pos").alias("ipos"))
    subs = nodes.filter((F.col("tag") == "li") & (F.col("scope") == "li.item")).select(
        "page_id", F.col("pos").alias("spos"), F.col("scope_pos").alias("ipos"))

    def fields(scope_name):
        inner = nodes.filter(F.col("scope") == scope_name)
        return inner.groupBy("page_id", F.col("scope_pos").alias("k")).agg(
            F.min_by(F.when((F.col("tag") == "span") & H.parent_has_class("live-time"), F.col("text")),
                     F.when((F.col("tag") == "span") & H.parent_has_class("live-time"), F.col("pos"))).alias("time_text"),
            F.min_by(F.when(H.has_class("time"), F.col("text")), F.when(H.has_class("time"), F.col("pos"))).alias("time_p"),
            F.min_by(F.when(F.col("tag") == "a", F.split(H.attr("onclick"), "'").getItem(1)),
                     F.when((F.col("tag") == "a") & H.attr("onclick").isNotNull(), F.col("pos"))).alias("product_id"),
            F.min_by(F.when(H.has_class("tit"), F.col("text")), F.when(H.has_class("tit"), F.col("pos"))).alias("product_name"),
            F.min_by(F.when((F.col("tag") == "strong") & H.parent_has_class("price"), F.col("text")),
                     F.when((F.col("tag") == "strong") & H.parent_has_class("price"), F.col("pos"))).alias("_price"),
            F.min_by(F.when(H.has_class("counselPrd"), F.col("text")),
                     F.when(H.has_class("counselPrd"), F.col("pos"))).alias("_consult"),
            F.min_by(F.when((F.col("tag") == "span") & H.parent_has_class("rate"), F.col("text")),
                     F.when((F.col("tag") == "span") & H.parent_has_class("rate"), F.col("pos"))).alias("_rate"),
            F.min_by(F.when(F.col("tag") == "img", H.attr("src")), F.when(F.col("tag") == "img", F.col("pos"))).alias("_img"),
        )

    main = items.join(fields("li.item").withColumnRenamed("k", "ipos"), ["page_id", "ipos"], "left") \
        .join(page_attr, "page_id", "left")
    now_range = on_air_range(F.trim("time_text"), F.coalesce(F.col("_on_air_end"), F.lit(None)), now)
    main = main.withColumn("live_time", F.when(F.trim("time_text") == ON_AIR_TEXT, now_range)
                           .otherwise(F.trim("time_text")))
    main = main.withColumn("live_title", F.trim(F.replace(F.coalesce("time_p", F.lit("")), F.col("live_time"), F.lit(""))))

    def finish(df, kind):
        rate = F.trim("_rate")
        return df.select(
            "page_id", "live_date", "live_time", F.lit(kind).alias("promotion_type"), "live_title", "product_id",
            F.trim("product_name").alias("product_name"),
            F.coalesce(F.trim("_price"), F.trim("_consult")).alias("dc_price"),
            F.when((rate == "") | (F.lower(rate) == "nan"), F.lit(None)).otherwise(rate).alias("dc_rate"),
            https(F.col("_img")).alias("thumb_img_url"))

    sub = subs.join(fields("li").withColumnRenamed("k", "spos"), ["page_id", "spos"], "left") \
        .join(main.select("page_id", "ipos", "live_date", "live_time", "live_title"), ["page_id", "ipos"])
    return finish(main, "main").unionByName(finish(sub, "sub"))
