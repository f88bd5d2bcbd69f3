"""Missing-value handling shared by every operator.

Spark keeps NaN and NULL apart (``avg`` over NaN is NaN, ``NaN > 36`` is
true, ``percentile`` sorts NaN last); the semantics we reproduce treat both
as "missing". So every float that enters an operator is normalised with
:func:`nan_to_null`, and text is turned into numbers only through
:func:`to_double`, which never lets a partially numeric string through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The tokens a CSV reader of the reference's kind turns into
# "missing" by default.
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]

# Anchored decimal / scientific literal, optional sign and surrounding blanks.
NUMERIC_TEXT = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
INTEGER_TEXT = r"^\s*[+-]?[0-9]+\s*$"

NUMERIC_TYPES = (
    T.ByteType, T.ShortType, T.IntegerType, T.LongType,
    T.FloatType, T.DoubleType, T.DecimalType,
)


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c: str | Column) -> Column:
    """NaN -> NULL for a floating column; the input is evaluated once."""
    return F.nanvl(col_of(c).cast("double"), F.lit(None).cast("double"))


def to_double(c: str | Column, dtype: T.DataType | None = None) -> Column:
    """Coerce to double; anything that is not a whole numeric literal -> NULL.

    ``try_cast`` alone is too lenient (``'5d'`` -> 5.0, ``'NaN'`` -> NaN), so
    text is matched against an anchored numeric pattern first.
    """
    c = col_of(c)
    if dtype is not None and isinstance(dtype, NUMERIC_TYPES):
        return nan_to_null(c.cast("double"))
    if dtype is not None and isinstance(dtype, T.BooleanType):
        return c.cast("double")
    s = c.cast("string")
    return nan_to_null(F.when(s.rlike(NUMERIC_TEXT), F.trim(s).try_cast("double")))


def is_numeric_type(dtype: T.DataType) -> bool:
    """Numeric for modelling purposes: booleans are *not* numeric."""
    return isinstance(dtype, NUMERIC_TYPES)


def na_tokens_to_null(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Replace the default NA tokens by NULL in string columns (one select)."""
    string_cols = {
        f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)
    }
    targets = string_cols if columns is None else string_cols & set(columns)
    return df.select(
        *[
            F.when(~F.col(f"`{c}`").isin(NA_TOKENS), F.col(f"`{c}`")).alias(c)
            if c in targets
            else F.col(f"`{c}`")
            for c in df.columns
        ]
    )


def normalise_nan(df: DataFrame) -> DataFrame:
    """NaN -> NULL in every float / double column (one select)."""
    return df.select(
        *[
            nan_to_null(F.col(f"`{f.name}`")).alias(f.name)
            if isinstance(f.dataType, (T.FloatType, T.DoubleType))
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )
