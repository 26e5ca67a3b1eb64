"""Recipe loading: raw CSV -> clean recipe rows -> one row per material."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.functions.text import INVISIBLE_CHARS, drop_first_char, section_tags_to_bar
from sparkmart.operators.projection import cast_rename, required

# Fixed value: the separator between name / amount / unit / detail inside
# one material item (ASCII BEL).
FIELD_SEP = "\x07"
# Columns a raw recipe row must have to be loaded (reference order).
REQUIRED_COLUMNS = ["RCP_SNO", "RCP_TTL", "CKG_NM", "SRAP_CNT", "CKG_KND_ACTO_NM", "CKG_MTRL_CN",
                    "CKG_INBUN_NM", "CKG_DODF_NM", "CKG_TIME_NM", "RCP_IMG_URL", "CKG_IPDC"]
RECIPE_SPEC = [("RCP_SNO", "recipe_id", "bigint"), ("RCP_TTL", "title", "string"),
               ("CKG_NM", "cooking_name", "string"), ("SRAP_CNT", "scrap_count", "int"),
               ("CKG_KND_ACTO_NM", "category", "string"), ("CKG_IPDC", "introduction", "string"),
               ("CKG_INBUN_NM", "serving", "string"), ("RCP_IMG_URL", "thumbnail", "string")]


def clean_recipes(raw: DataFrame, required_cols: Sequence[str] = REQUIRED_COLUMNS) -> DataFrame:
    """Required-columns filter, then rename / cast projection."""
    return cast_rename(required(raw, required_cols), RECIPE_SPEC)


def _strip_item_part(c):
    """Remove invisible spaces, then strip outer white space (Python strip)."""
    v = F.regexp_replace(c, f"[{INVISIBLE_CHARS}]", "")
    return F.regexp_replace(v, r"(?U)^\s+|\s+$", "")


def materials(recipes: DataFrame, recipe_id: str = "recipe_id", text: str = "materials",
              kept: DataFrame | None = None) -> DataFrame:
    """Material text -> rows ``(recipe_id, pos, material_name, measure_amount,
    measure_unit, details)``.

    '[section]' tags become '|', blanks around '|' are removed, the first '|'
    is dropped, the text is split on '|' and each item on BEL; blank parts are
    dropped; 1 part = name, 2 = name + amount, >= 3 = name + amount + unit
    (+ detail). Items with no part are skipped. ``kept`` restricts to recipes
    that were loaded (semi join). Every step is a built-in expression.
    """
    df = recipes
    if kept is not None:
        df = df.join(kept.select(recipe_id).distinct(), recipe_id, "left_semi")
    cleaned = drop_first_char(section_tags_to_bar(F.col(text)), "|")
    items = df.select(F.col(recipe_id), F.posexplode(F.split(cleaned, r"\|", -1)).alias("pos", "item"))
    parts = F.filter(F.transform(F.split(F.col("item"), FIELD_SEP, -1), _strip_item_part), lambda p: p != "")
    rows = items.select(recipe_id, (F.col("pos") + 1).alias("pos"), parts.alias("parts")) \
        .filter(F.size("parts") > 0)
    n = F.size("parts")
    return rows.select(
        recipe_id, "pos",
        F.col("parts")[0].alias("material_name"),
        F.when(n >= 2, F.col("parts")[1]).alias("measure_amount"),
        F.when(n >= 3, F.col("parts")[2]).alias("measure_unit"),
        F.when(n >= 4, F.col("parts")[3]).alias("details"),
    )


def distinct_material_names(mat: DataFrame) -> DataFrame:
    """One row per material name with its smallest id (representative)."""
    return mat.groupBy("material_name").agg(F.min("material_id").alias("material_id"))
