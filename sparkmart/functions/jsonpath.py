"""JSON helpers over string columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sparkmart.functions._util import col

__all__ = ["json_path", "json_top_keys"]


def json_path(c, path: str) -> Column:
    """Missing-safe deep read ('$.a.b[0].c'); absent paths give NULL."""
    return F.get_json_object(col(c), path)


def json_top_keys(c) -> Column:
    """Top-level keys of a JSON object text (NULL for non-objects)."""
    return F.json_object_keys(col(c))
