"""Schedule payloads (nested JSON) -> one flat schedule table with main and
sub items. Two payload forms exist: item lists with their own slot texts
(``flatten_schedule``) and programme lists whose prices come as separate rows
(``flatten_programmes``)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmart.functions.text import after_first_dot, id_url_template
from sparkmart.operators.relational import first_wins

_ITEM = ("slitmCd string, slitmNm string, sellPrc string, bbprc string, copnRate string, brodDt string, brodStrtDtm string, "
         "brodEndDtm string, prmoTxtCntn string, newBrodDt string, brodImgNm string, thumImgNm string")
PAYLOAD = f"respData struct<broadItemList: array<struct<{_ITEM.replace(' string', ': string')}, withItemList: array<struct<{_ITEM.replace(' string', ': string')}>>>>>"

_GOODS = "goodsCd: string, pgmNm: string, imageUrl: string, goods: struct<productNm: string, brdctInfo: struct<formStartDttm: string, formEndDttm: string>>"
PROGRAMMES = f"data struct<resultData: struct<totalOrgan: array<struct<{_GOODS}, relTotalOrgan: array<struct<{_GOODS}>>>>>>"
PRICES = "data struct<resultData: array<struct<goodsCd: string, salePrice: double, dcPrice: double, dcRate: double>>>"

# thumbnail addresses are spelled from characters of the product id
MAIN_THUMB = "https://image.example.com/static/{7}/{6}/{4}{5}/{2}{3}/onair{id}.{ext}?AR=0&SF=webp"
SUB_THUMB = "https://image.example.com/static/{7}/{6}/{4}{5}/{2}{3}/{id}_0.{ext}?RS=125x125&AR=0&SF=webp"
GOODS_THUMB = "https://image.example.com/new/{id}_X6.jpg"


def _text(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(""))


def flatten_schedule(payloads: DataFrame, json_col: str = "payload", channel: str = "homeshopping_id",
                     main_thumb: str = MAIN_THUMB, sub_thumb: str = SUB_THUMB) -> DataFrame:
    """Each payload's main items and their sub items as rows with
    ``promotion_type`` 'main' / 'sub'. Every item has its own date, slot and
    title; a main item's new date goes before its date. Missing texts are '',
    a missing product id is '0'; the thumbnail of an id shorter than eight
    characters is NULL."""
    parsed = payloads.select(F.col(channel).alias("homeshopping_id"), F.from_json(json_col, PAYLOAD).alias("p"))
    mains = parsed.select("homeshopping_id", F.explode("p.respData.broadItemList").alias("i"))
    # a main item and its sub items are the rows of one list, so that a payload is made and read once
    own = F.struct(*[F.col(f"i.{c.split()[0]}") for c in _ITEM.split(", ")])
    subs = F.coalesce("i.withItemList", F.array().cast(f"array<struct<{_ITEM.replace(' string', ': string')}>>"))
    new_date = F.coalesce(F.nullif(F.col("i.newBrodDt"), F.lit("")), F.col("i.brodDt"), F.lit(""))
    items = mains.select("homeshopping_id", new_date.alias("_date"), F.posexplode(F.concat(F.array(own), subs)).alias("_at", "i"))
    is_main = F.col("_at") == 0

    pid = F.coalesce("i.slitmCd", F.lit("0"))
    thumb = F.when(is_main, id_url_template(pid, main_thumb, after_first_dot(_text("i.brodImgNm")))) \
        .otherwise(id_url_template(pid, sub_thumb, after_first_dot(_text("i.thumImgNm"))))
    return items.select(
        "homeshopping_id", F.when(is_main, F.col("_date")).otherwise(_text("i.brodDt")).alias("live_date"),
        F.concat(_text("i.brodStrtDtm"), F.when(is_main, F.lit("~")).otherwise(F.lit(" ~ ")), _text("i.brodEndDtm")).alias("live_time"),
        F.when(is_main, F.lit("main")).otherwise(F.lit("sub")).alias("promotion_type"), _text("i.prmoTxtCntn").alias("live_title"),
        pid.alias("product_id"), _text("i.slitmNm").alias("product_name"), _text("i.sellPrc").alias("sale_price"),
        _text("i.bbprc").alias("dc_price"), _text("i.copnRate").alias("dc_rate"),
        F.when(F.length(pid) >= 8, thumb).alias("thumb_img_url"))


def flatten_programmes(payloads: DataFrame, json_col: str = "payload", price_col: str = "prices",
                       channel: str = "homeshopping_id", main_thumb: str = GOODS_THUMB) -> DataFrame:
    """Programme payloads with their price payload: main programmes and the
    related ones as rows; prices by product id (the first price row of the
    payload wins, none gives NULL), the slot from the start and end stamps."""
    parsed = payloads.select(F.col(channel).alias("homeshopping_id"), F.from_json(json_col, PROGRAMMES).alias("p"),
                             F.from_json(price_col, PRICES).alias("q"), F.xxhash64(json_col, price_col).alias("_doc"))
    mains = parsed.select("homeshopping_id", "_doc", F.explode("p.data.resultData.totalOrgan").alias("i"))
    subs = mains.select("homeshopping_id", "_doc", F.explode("i.relTotalOrgan").alias("i"))
    price = parsed.select("_doc", F.posexplode("q.data.resultData").alias("_at", "r")).select("_doc", "_at", "r.*")
    price = first_wins(price.where(F.col("goodsCd").isNotNull()), ["_doc", "goodsCd"], ["_at"]).drop("_at")

    def clock(c: str) -> Column:
        return F.coalesce(F.date_format(F.try_to_timestamp(c, F.lit("yyyy-MM-dd HH:mm:ss")), "HH:mm"), F.lit(""))

    def rows(items: DataFrame, kind: str, thumb: Column) -> DataFrame:
        start, end = "i.goods.brdctInfo.formStartDttm", "i.goods.brdctInfo.formEndDttm"
        day = F.date_format(F.try_to_timestamp(start, F.lit("yyyy-MM-dd HH:mm:ss")), "yyyyMMdd")
        flat = items.select(
            "homeshopping_id", "_doc", F.coalesce(day, F.lit("")).alias("live_date"),
            F.concat(clock(start), F.lit(" ~ "), clock(end)).alias("live_time"), F.lit(kind).alias("promotion_type"),
            F.col("i.pgmNm").alias("live_title"), _text("i.goodsCd").alias("product_id"),
            _text("i.goods.productNm").alias("product_name"), thumb.alias("thumb_img_url"))
        priced = flat.join(price.withColumnRenamed("goodsCd", "product_id"), ["_doc", "product_id"], "left")
        return priced.select("homeshopping_id", "live_date", "live_time", "promotion_type", "live_title", "product_id", "product_name",
                             F.col("salePrice").cast("int").alias("sale_price"), F.col("dcPrice").cast("int").alias("dc_price"),
                             F.col("dcRate").cast("int").alias("dc_rate"), "thumb_img_url")

    return rows(mains, "main", id_url_template(_text("i.goodsCd"), main_thumb)).unionByName(
        rows(subs, "sub", _text("i.imageUrl")))
