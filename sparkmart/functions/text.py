"""Text cleaning functions used by the loading and feature jobs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sparkmart.functions._util import col

__all__ = [
    "normalize_ws", "clean_text", "blank_to_null", "num_only", "digits_or_zero",
    "https", "strip_invisible", "clean_time_range", "drop_first_char",
    "section_tags_to_bar", "substring_count", "strip_trailing_punct",
    "token_suffix_match", "after_first_dot", "base64_text", "join_nonempty",
    "strip_currency", "label_to_int", "truncate", "first_truthy", "first_positive", "id_url_template",
    "INVISIBLE_CHARS", "TRUE_LABELS", "FALSE_LABELS", "FOOD_TRUE_LABELS",
]

# Fixed values (must equal the reference's behaviour):
# invisible characters removed from recipe material text:
#   U+200B zero-width space, U+00A0 no-break space, U+3000 ideographic space,
#   U+2060 word joiner, U+FEFF zero-width no-break space.
INVISIBLE_CHARS = "\u200b\u00a0\u3000\u2060\ufeff"
# Text labels read as 1 by the food model (anything else is 0).
FOOD_TRUE_LABELS = ["식품", "1", "true", "t", "y"]
# Text labels of the ingredient model: these are 1, these are 0, others NULL.
TRUE_LABELS = ["1", "true", "t", "y", "ing", "ingredient"]
FALSE_LABELS = ["0", "false", "f", "n", "fin", "finished", "product"]

# Java's \s misses NBSP; (?U) turns on Unicode white space like Python's re.
_WS = r"(?U)\s+"


def normalize_ws(c) -> Column:
    """Collapse any white space run to one space and trim; NULL becomes ''."""
    return F.trim(F.regexp_replace(F.coalesce(col(c), F.lit("")), _WS, " "))


def clean_text(c) -> Column:
    """Like normalize_ws but NULL / blank results become NULL."""
    return F.nullif(normalize_ws(c), F.lit(""))


def blank_to_null(c) -> Column:
    """'' and 'nan' (any case, surrounding blanks ignored) become NULL."""
    v = col(c)
    return F.when(F.lower(F.trim(v)).isin("", "nan"), F.lit(None).cast("string")).otherwise(v)


def num_only(c) -> Column:
    """Keep ASCII digits and read them as a long; no digits gives NULL."""
    digits = F.regexp_replace(col(c), "[^0-9]", "")
    return F.nullif(digits, F.lit("")).try_cast("bigint")


def digits_or_zero(c) -> Column:
    """Digits-only integer with NULL / no digits mapped to 0."""
    return F.coalesce(num_only(c), F.lit(0).cast("bigint"))


def https(c) -> Column:
    """Protocol-relative '//host/x' becomes 'https://host/x'; blank becomes NULL."""
    v = col(c)
    return (F.when(v.isNull() | (v == ""), F.lit(None).cast("string"))
            .when(v.startswith("//"), F.concat(F.lit("https:"), v))
            .otherwise(v))


def strip_invisible(c) -> Column:
    """Remove zero-width / no-break / ideographic spaces then trim outer blanks."""
    return F.trim(F.regexp_replace(col(c), f"[{INVISIBLE_CHARS}]", ""))


def clean_time_range(c) -> Column:
    """Normalise a broadcast time range text: NBSP to space, ZWSP removed,
    full-width / wave tildes to '~', white space collapsed and trimmed."""
    v = F.regexp_replace(col(c), "\u00a0", " ")
    v = F.regexp_replace(v, "\u200b", "")
    v = F.regexp_replace(v, "[\uff5e\u301c\u223c]", "~")
    return F.trim(F.regexp_replace(v, _WS, " "))


def drop_first_char(c, ch: str = "|") -> Column:
    """Remove only the first occurrence of ``ch``."""
    v = col(c)
    pos = F.instr(v, ch)
    return F.when(pos > 0, F.concat(F.substring(v, F.lit(1), pos - 1),
                                    F.substring(v, pos + 1, F.lit(1 << 30)))).otherwise(v)


def section_tags_to_bar(c) -> Column:
    """'[tag]' sections become '|' and blanks around every '|' are removed."""
    v = F.regexp_replace(col(c), r"\[[^\]]+\]", "|")
    return F.regexp_replace(v, r"\s*\|\s*", "|")


def substring_count(c, needle: str) -> Column:
    """Non-overlapping occurrences of a literal needle (str.count semantics)."""
    v = F.coalesce(col(c), F.lit(""))
    n = len(needle)
    if n == 0:
        return F.length(v) + 1
    return ((F.length(v) - F.length(F.replace(v, F.lit(needle), F.lit("")))) / n).cast("int")


# Fixed value: characters stripped from the end of a token before a suffix test.
_TRAIL = ".,)/)]}»”’\"'"


def strip_trailing_punct(c) -> Column:
    import re
    return F.regexp_replace(col(c), "[" + "".join(re.escape(ch) for ch in sorted(set(_TRAIL))) + "]+$", "")


def token_suffix_match(c, suffixes: list[str]) -> Column:
    """True if any space-separated token (trailing punctuation removed) ends
    with one of ``suffixes``; empty text gives False."""
    if not suffixes:
        return F.lit(False)
    sfx = F.array(*[F.lit(s) for s in suffixes])
    toks = F.split(normalize_ws(c), " ")
    return F.coalesce(F.exists(toks, lambda t: F.exists(
        sfx, lambda s: strip_trailing_punct(t).endswith(s))), F.lit(False))


def after_first_dot(c) -> Column:
    """Text after the first '.', or the whole text when there is none."""
    v = col(c)
    return F.substring(v, F.instr(v, ".") + 1, F.lit(1 << 30))


def base64_text(c) -> Column:
    return F.base64(F.encode(col(c).cast("string"), "UTF-8"))


def join_nonempty(arr, sep: str = ", ") -> Column:
    """Join array items that are not NULL / blank."""
    return F.array_join(F.filter(col(arr), lambda x: x.isNotNull() & (F.trim(x) != "")), sep)


def strip_currency(c) -> Column:
    """Drop a trailing won sign / '원' and thousands separators."""
    v = F.regexp_replace(col(c), r"\s*(원|₩)$", "")
    v = F.regexp_replace(v, r"^₩\s*", "")
    return F.replace(v, F.lit(","), F.lit(""))


def label_to_int(c, true_values=None, false_values=None) -> Column:
    """Map a free text label to 1 / 0 (case and blank insensitive).

    With ``false_values`` unknown labels are NULL (ingredient model); with
    ``false_values=[]`` every label outside ``true_values`` is 0 (food model).
    """
    t = [x.lower() for x in (TRUE_LABELS if true_values is None else true_values)]
    f = [x.lower() for x in (FALSE_LABELS if false_values is None else false_values)]
    v = F.lower(F.trim(col(c).cast("string")))
    hit = F.when(v.isin(*t), F.lit(1))
    if f:
        return hit.when(v.isin(*f), F.lit(0)).otherwise(F.lit(None).cast("int"))
    return hit.when(v.isNotNull(), F.lit(0)).otherwise(F.lit(None).cast("int"))


def truncate(c, n: int) -> Column:
    return F.substring(col(c), 1, n)


def first_truthy(*cols) -> Column:
    """Python ``a or b or c`` on text: NULL and blank count as missing."""
    return F.coalesce(*[F.nullif(F.trim(col(c)), F.lit("")) for c in cols])


def first_positive(*cols) -> Column:
    """Python ``a or b`` on numbers: NULL and 0 count as missing."""
    return F.coalesce(*[F.nullif(col(c), F.lit(0)) for c in cols])


def id_url_template(id_col, template: str, ext=None) -> Column:
    """Fill a URL template from single characters of an id text.

    ``{3}`` is the 0-based 4th character of the id, ``{id}`` the whole id and
    ``{ext}`` the ``ext`` column, e.g.
    ``'https://img.example.com/{7}/{6}/{4}{5}/{2}{3}/onair{id}.{ext}'``.
    """
    import re
    v = col(id_col).cast("string")
    parts: list[Column] = []
    pos = 0
    for m in re.finditer(r"\{(\d+|id|ext)\}", template):
        if m.start() > pos:
            parts.append(F.lit(template[pos:m.start()]))
        tok = m.group(1)
        if tok == "id":
            parts.append(v)
        elif tok == "ext":
            parts.append(col(ext) if ext is not None else F.lit(""))
        else:
            parts.append(F.substring(v, int(tok) + 1, 1))
        pos = m.end()
    parts.append(F.lit(template[pos:]))
    return F.concat(*parts)
