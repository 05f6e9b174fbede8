"""Column expressions used by the models. All are built-in Spark
expressions (no Python UDFs), so they stay inside whole-stage codegen.

Regular expressions end with ``\\z`` rather than ``$``: Java's ``$`` also
matches before a final line break, the warehouse semantics do not.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Year-header suffix letters and the year types they mean,
# checked in this order, first match wins; anything else is 'Unknown'.
YEAR_TYPE_RULES = [
    ("E", "Estimate"),
    ("P", "Pro-forma"),
    ("R", "Restated"),
    ("F", "Forecast"),
]
ACTUAL = "Actual"
UNKNOWN = "Unknown"
YEAR_TYPES = [ACTUAL] + [t for _, t in YEAR_TYPE_RULES] + [UNKNOWN]

NUMERIC_TEXT = r"^-?[0-9]+(\.[0-9]+)?\z"
FOUR_DIGITS = r"^[0-9]{4}\z"
VERSION_IN_NAME = r"^.*_([0-9]+)\.[a-zA-Z]+\z"
NUMERIC_TYPE = "decimal(38,18)"
ROUNDED_TYPE = "decimal(25,4)"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def year_type(year_text) -> Column:
    """Actual / Estimate / Pro-forma / Restated / Forecast / Unknown."""
    t = F.trim(_c(year_text))
    expr = F.when(t.rlike(FOUR_DIGITS) | t.endswith("A"), F.lit(ACTUAL))
    for suffix, name in YEAR_TYPE_RULES:
        expr = expr.when(t.endswith(suffix), F.lit(name))
    return expr.otherwise(F.lit(UNKNOWN))


def leading_int(text) -> Column:
    """Leading digits as INT; no digits or out of range -> NULL."""
    digits = F.regexp_extract(_c(text), r"^[0-9]+", 0)
    return F.nullif(digits, F.lit("")).try_cast("int")


def safe_numeric(text) -> Column:
    """Plain decimal text -> DECIMAL(38,18); 'n.a.', '+5', '.5', '' -> NULL."""
    v = _c(text)
    return F.when(v.rlike(NUMERIC_TEXT), v.try_cast(NUMERIC_TYPE))


def round4(num) -> Column:
    """Round half away from zero to 4 places."""
    return F.round(_c(num), 4).cast(ROUNDED_TYPE)


def version_from_filename(filename) -> Column:
    """``name_<n>.<ext>`` -> n as INT, else NULL."""
    g = F.regexp_extract(_c(filename), VERSION_IN_NAME, 1)
    return F.nullif(g, F.lit("")).try_cast("int")


def text_array(json_array_text) -> Column:
    """JSON array text -> ARRAY<STRING> (elements keep their JSON text);
    missing -> empty array."""
    return F.coalesce(F.from_json(_c(json_array_text), "array<string>"),
                      F.array().cast("array<string>"))


def sum_as_numeric(arr) -> Column:
    """Per-row sum of a text array as DECIMAL; empty/missing -> 0. Elements
    that are not numbers and sums beyond the type give NULL for the row (the
    strict cast raises in the reference; here the row is flagged instead of
    failing the job)."""
    zero = F.lit(0).cast("decimal(38,18)")
    return F.aggregate(
        F.coalesce(_c(arr), F.array().cast("array<string>")),
        zero,
        lambda acc, x: F.try_add(acc, F.when(x.isNull(), zero).otherwise(x.try_cast("decimal(38,18)")))
        .try_cast("decimal(38,18)"),
    )


def trunc_second(ts) -> Column:
    """Cut sub-seconds, keep TIMESTAMP_NTZ."""
    return F.date_trunc("second", _c(ts)).cast("timestamp_ntz")


def uri_bucket(path) -> Column:
    """Host of ``scheme://host/key``. Cut by position, not parsed: names may
    hold blanks, percent signs and other characters a URI parser rejects."""
    return F.nullif(F.regexp_extract(_c(path), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1), F.lit(""))


def uri_key(path) -> Column:
    """Path of ``scheme://host/key`` without leading slashes (up to ? or #)."""
    return F.regexp_extract(_c(path), r"^(?:[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)?/*([^?#]*)", 1)


def display_name(key) -> Column:
    """Archive key ``<sha>_<original name>`` -> original name."""
    return F.regexp_replace(_c(key), r"^[^_]*_", "")


def a1_coord(col, row) -> Column:
    """A1 coordinate from column and row numbers (columns up to XFD and
    beyond, three letters): bijective base 26."""
    n = _c(col).cast("long")
    a = F.floor((n - 1) / 26)
    b = F.floor((a - 1) / 26)

    def letter(k):
        return F.chr(F.lit(65) + k % 26)
    return F.concat(F.when(b > 0, letter(b - 1)).otherwise(F.lit("")),
                    F.when(a > 0, letter(a - 1)).otherwise(F.lit("")),
                    letter(n - 1), _c(row).cast("string"))
