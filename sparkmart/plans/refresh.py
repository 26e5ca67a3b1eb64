"""Refresh after a price-change invalidation: the products that were taken out
are extracted, loaded and scored again.

The invalidation appends its products to a change table (one sequence number
for each run). Re-extraction, reload and rescoring are three consumers of that table, each a
stream with a checkpoint of its own, which is its place in the table: a consumer
that fails goes on from there, and a run without new changes does nothing. Their
results are keyed tables; a product's row of the highest sequence number stays.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmart.operators import relational as R
from sparkmart.plans import html_jobs, kok
from sparkmart.sources.keyed_table import KeyedTable
from sparkmart.streaming.incremental import each_batch

ID = "kok_product_id"


def log_changes(changed: DataFrame, changes: str, seq: int) -> None:
    """Appends the products of invalidation run ``seq``."""
    changed.select(F.lit(seq).cast("long").alias("seq"), F.col(ID).cast("long").alias(ID)).write.mode("append").parquet(changes)


def newest(rows: DataFrame) -> DataFrame:
    return R.first_wins(rows, ID, [-F.col("seq")])


def consume(spark: SparkSession, changes: str, place: str, state: KeyedTable, rows_of: Callable[[DataFrame], DataFrame]) -> None:
    """Merges ``rows_of`` (seq, product) of the changes behind ``place`` into ``state``."""
    def run(batch: DataFrame, batch_id: int) -> None:
        state.merge(rows_of(batch.groupBy(ID).agg(F.max("seq").alias("seq"))), batch_id, newest)

    each_batch(spark, changes, _change_schema(spark), place, run)


def _change_schema(spark: SparkSession):
    return spark.createDataFrame([], f"seq long, {ID} long").schema


def refresh(spark: SparkSession, base: str, changes: str, pages: DataFrame, scorer: Callable[[DataFrame], DataFrame],
            rows_per_bucket: int = 1_000_000) -> dict[str, KeyedTable]:
    """Runs the three consumers over the stored ``pages`` (page_id, html) until they
    are up to date. ``scorer`` adds pred and conf. Returns the tables raw, clean
    and scores. A product without a page gets no row in any of them."""
    raw_schema = spark.createDataFrame([], "seq long").join(html_jobs.product_rows(pages)).schema
    clean_schema = spark.createDataFrame([], f"{ID} long, kok_store_name string, kok_product_name string, "
                                             "kok_product_price long, seq long").schema
    score_schema = spark.createDataFrame([], f"{ID} long, cls_ing int, conf double, seq long").schema
    tables = {name: KeyedTable(spark, f"{base}/{name}", schema, ID, rows_per_bucket)
              for name, schema in (("raw", raw_schema), ("clean", clean_schema), ("scores", score_schema))}

    def extract(ids: DataFrame) -> DataFrame:
        wanted = pages.join(ids.select(F.col(ID).alias("page_id")), "page_id", "left_semi")
        return html_jobs.product_rows(wanted).join(ids, ID)

    def load(ids: DataFrame) -> DataFrame:
        rows = kok.strip_store_prefix(tables["raw"].lookup(ids).drop("seq")).join(ids, ID)
        price = F.nullif(F.regexp_replace("kok_product_price", "[^0-9]", ""), F.lit("")).cast("long")
        return rows.withColumn("kok_product_price", price)

    def score(ids: DataFrame) -> DataFrame:
        rows = tables["clean"].lookup(ids).drop("seq").join(ids, ID)
        return scorer(rows).withColumnRenamed("pred", "cls_ing")

    for name, rows_of in (("raw", extract), ("clean", load), ("scores", score)):
        consume(spark, changes, f"{base}/place-{name}", tables[name], rows_of)
    return tables
