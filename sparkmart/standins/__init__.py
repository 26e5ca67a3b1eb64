"""Driver-table stand-ins: every registered query maps the driver's test
tables onto the shape one operator expects, runs the operator, and carries
the equivalent DuckDB SQL used as its oracle.

Registration order is the SURVEY inventory order; ``QUERIES`` / ``ORACLES``
are read by ``__spark_entry__``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


@dataclass
class Query:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    oracle: str | None


QUERIES: dict[str, Query] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = Query(name, fn, oracle)
        return fn
    return deco


class Tables:
    """Lazy access to the driver's parquet tables: ``T(spark, d).lineitem``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")


def load_all() -> dict[str, Query]:
    # import for side effects (registration), in inventory order
    from sparkmart.standins import (  # noqa: F401
        q_sources, q_project, q_joins, q_mutation, q_aggregates, q_scalar, q_hs, q_html,
        q_text, q_ml, q_embed, q_streaming, q_jobs, q_runs)
    return QUERIES
