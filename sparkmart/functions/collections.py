"""Array helpers (split, pad, positional zip, srcset)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sparkmart.functions._util import col

__all__ = ["pad_index", "srcset_last", "zip_shortest", "first_k", "split_nonempty"]


def pad_index(arr, i: int) -> Column:
    """0-based item ``i`` of an array, NULL beyond its end (pad-then-index)."""
    return F.get(col(arr), i)


def srcset_last(c) -> Column:
    """Last candidate URL of a srcset ('u1 1x, u2 2x' -> 'u2')."""
    parts = F.filter(F.split(F.trim(col(c)), r"\s*,\s*"), lambda x: F.trim(x) != "")
    last = F.element_at(parts, -1)
    return F.when(F.size(parts) > 0, F.split(F.trim(last), r"\s+").getItem(0))


def zip_shortest(a, b) -> Column:
    """Positional zip of two arrays cut to the shorter one."""
    n = F.least(F.size(col(a)), F.size(col(b)))
    return F.slice(F.arrays_zip(col(a), col(b)), 1, n)


def first_k(arr, k: int) -> Column:
    return F.slice(col(arr), 1, k)


def split_nonempty(c, pattern: str) -> Column:
    return F.filter(F.split(col(c), pattern), lambda x: F.trim(x) != "")
