"""Text parsers for loan fields, as native Spark column expressions.

No Python UDF anywhere: each parser is a ``when`` / ``regexp`` chain that
runs inside whole-stage codegen.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from .nulls import INTEGER_TEXT, NUMERIC_TEXT, col_of, nan_to_null

# Month token format of the raw date columns, and the formats
# tried when more than 10% of a date column fails that first format.
PRIMARY_DATE_FORMAT = "MMM-yyyy"
FALLBACK_DATE_FORMATS = [
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd",
    "yyyy/MM/dd",
    "MM/dd/yyyy",
    "dd-MMM-yyyy",
    "MMM yyyy",
    "MMMM yyyy",
    "MMMM-yyyy",
    "yyyy-MM",
    "MMM-yy",
]


def snake_case_name(name: str) -> str:
    """trim, lower, space -> ``_``, ``%`` -> ``_pct``, drop ``[^0-9a-zA-Z_]``."""
    out = name.strip().lower().replace(" ", "_").replace("%", "_pct")
    return re.sub(r"[^0-9a-zA-Z_]", "", out)


def parse_percent_strict(c: str | Column) -> Column:
    """``'13.5%'`` -> 13.5, ``'1,234.56%'`` -> 1234.56, missing -> NULL.

    Any other non-number raises (ANSI cast), like the strict cleaning step.
    """
    s = F.replace(F.replace(col_of(c).cast("string"), F.lit("%"), F.lit("")), F.lit(","), F.lit(""))
    s = F.nullif(F.nullif(s, F.lit("nan")), F.lit("None"))
    return nan_to_null(s.cast("double"))


def parse_percent_lenient(c: str | Column) -> Column:
    """Remove ``%`` and coerce; anything non-numeric -> NULL (feature step)."""
    s = F.replace(col_of(c).cast("string"), F.lit("%"), F.lit(""))
    return nan_to_null(F.when(s.rlike(NUMERIC_TEXT), F.trim(s).try_cast("double")))


def extract_term(c: str | Column) -> Column:
    """First run of digits as double; no digits -> NULL."""
    digits = F.regexp_extract(col_of(c).cast("string"), r"([0-9]+)", 1)
    return F.when(digits != "", digits.cast("double"))


def emp_length_clean(c: str | Column) -> Column:
    """Cleaning-stage employment length (trim, whole-value replacements,
    strip ``' years'``, ``' year'``, ``'+'``, then numeric or NULL).

    ``'< 1 year'`` -> 0, ``'10+ years'`` -> 10, ``'5.5 years'`` -> 5.5,
    ``'<1 year'`` -> NULL, ``'n/a'`` -> NULL.
    """
    s = F.trim(col_of(c).cast("string"))
    s = (
        F.when(s == "< 1 year", F.lit("0"))
        .when(s == "1 year", F.lit("1"))
        .when(s.isin("n/a", ""), F.lit(None).cast("string"))
        .otherwise(s)
    )
    s = F.replace(F.replace(F.replace(s, F.lit(" years"), F.lit("")), F.lit(" year"), F.lit("")), F.lit("+"), F.lit(""))
    return nan_to_null(F.when(s.rlike(NUMERIC_TEXT), F.trim(s).try_cast("double")))


def emp_length_feature(c: str | Column) -> Column:
    """Feature-stage employment length (differs from the cleaning parser).

    missing / ``n/a`` / ``nan`` / ``None`` / ``''`` -> NULL; contains ``+`` ->
    the integer left after removing ``'+ years'`` / ``'+ year'`` (raises when
    that is not an integer); contains ``<`` -> 0; otherwise the first
    whitespace token as an integer, else NULL. Result is double.
    """
    s = F.trim(col_of(c).cast("string"))
    plus_part = F.trim(F.replace(F.replace(s, F.lit("+ years"), F.lit("")), F.lit("+ year"), F.lit("")))
    first_token = F.split(s, r"\s+").getItem(0)
    return (
        F.when(s.isNull() | s.isin("n/a", "nan", "None", ""), F.lit(None).cast("double"))
        .when(s.contains("+"), plus_part.cast("int").cast("double"))
        .when(s.contains("<"), F.lit(0.0))
        .when(first_token.rlike(INTEGER_TEXT), first_token.cast("long").cast("double"))
    )


def parse_month_date(c: str | Column, fmt: str = PRIMARY_DATE_FORMAT) -> Column:
    """Trimmed text -> timestamp with the month format, NULL on failure."""
    s = F.trim(col_of(c).cast("string"))
    return F.try_to_timestamp(s, F.lit(fmt))


def parse_date_fallback(c: str | Column) -> Column:
    """Free-form parse: first format of :data:`FALLBACK_DATE_FORMATS` that fits."""
    s = F.trim(col_of(c).cast("string"))
    return F.coalesce(*[F.try_to_timestamp(s, F.lit(f)) for f in FALLBACK_DATE_FORMATS])


def floor_days_between(later: Column, earlier: Column) -> Column:
    """Whole days between two timestamps, floored (negative spans floor too)."""
    diff = F.unix_micros(later.cast("timestamp")) - F.unix_micros(earlier.cast("timestamp"))
    return F.floor(diff / F.lit(86_400_000_000))
