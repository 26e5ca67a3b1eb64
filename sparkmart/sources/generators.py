"""Generated inputs: date windows, fan-out work lists, dimension seeding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

__all__ = ["date_window", "with_date_window", "with_page_range", "seed_if_empty"]


def date_window(start, n: int = 11) -> Column:
    """Array of ``n`` consecutive 'yyyyMMdd' strings from ``start`` (a date)."""
    d = F.to_date(start)
    return F.transform(F.sequence(d, F.date_add(d, n - 1)), lambda x: F.date_format(x, "yyyyMMdd"))


def with_date_window(df: DataFrame, start, n: int = 11, name: str = "live_date") -> DataFrame:
    """Fan each row out over the ``n``-day window (today ... today+n-1):
    a per-row generator, so the output grows linearly and needs no join."""
    d = F.to_date(start)
    return (df.withColumn(name, F.explode(F.sequence(d, F.date_add(d, n - 1))))
            .withColumn(name, F.date_format(F.col(name), "yyyyMMdd")))


def with_page_range(df: DataFrame, n_pages, name: str = "page") -> DataFrame:
    """Fan each row (e.g. a category) out over pages 1..n_pages."""
    n = n_pages if isinstance(n_pages, Column) else F.lit(n_pages)
    return df.withColumn(name, F.explode(F.sequence(F.lit(1), n)))


def seed_if_empty(target: DataFrame, seed: DataFrame) -> DataFrame:
    """The dimension after seeding: ``seed`` when ``target`` has no row, else
    ``target`` unchanged (decided by a scalar count, no driver round trip)."""
    n = target.select(F.count(F.lit(1))).scalar()
    return target.unionByName(seed.select(*target.columns).filter(n == 0))
