"""Binary default targets (T1-T3) and leakage removal (T4).

The three target rules really differ and are kept as three named operators:

* T1 :func:`map_target`            charged-off / default -> 1, everything
                                   else (missing included) -> 0, no drops;
* T2 :func:`define_default_target` paid -> 0 (wins), charged-off / default
                                   -> 1, every other row dropped;
* T3 :func:`ensure_default_target` existing column coerced (missing -> 0,
                                   truncated to int), else T1.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.nulls import to_double

# Substrings of the status text that mark a default, and the
# one that marks a repaid loan.
POSITIVE_MARKERS = ["charg", "default"]
NEGATIVE_MARKER = "paid"

# Post-origination columns removed before modelling.
LEAKAGE_COLUMNS = [
    "last_pymnt_d", "last_pymnt_amnt", "next_pymnt_d", "last_credit_pull_d",
    "collection_recovery_fee", "recoveries",
    "total_pymnt", "total_pymnt_inv", "total_rec_prncp", "total_rec_int",
    "out_prncp", "out_prncp_inv",
]


def _status(c: str) -> Column:
    return F.lower(F.col(f"`{c}`").cast("string"))


def is_positive_status(c: str) -> Column:
    s = _status(c)
    cond = None
    for m in POSITIVE_MARKERS:
        cond = s.contains(m) if cond is None else (cond | s.contains(m))
    return cond


def simple_target(source: str = "loan_status") -> Column:
    """T1 as a column expression (int)."""
    return F.when(is_positive_status(source), F.lit(1)).otherwise(F.lit(0)).cast("int")


def map_target(df: DataFrame, source: str = "loan_status", target: str = "default") -> DataFrame:
    """Add the simple 0/1 target."""
    return df.withColumn(target, simple_target(source))


def conservative_target(source: str = "loan_status") -> Column:
    """T2 as a column: 0 when 'paid' appears (checked first, so it wins),
    1 for charged-off / default, NULL (ambiguous) otherwise. A missing
    status reads as the text ``'nan'`` and is ambiguous."""
    s = F.coalesce(_status(source), F.lit("nan"))
    pos = None
    for m in POSITIVE_MARKERS:
        pos = s.contains(m) if pos is None else (pos | s.contains(m))
    return F.when(s.contains(NEGATIVE_MARKER), F.lit(0)).when(pos, F.lit(1)).cast("int")


def define_default_target(df: DataFrame, source: str = "loan_status", target: str = "default") -> DataFrame:
    """Add the conservative target and drop ambiguous rows."""
    return df.withColumn(target, conservative_target(source)).where(F.col(target).isNotNull())


def target_report(df: DataFrame, source: str = "loan_status") -> DataFrame:
    """T2 report as one aggregate: ``kept, dropped`` rows."""
    t = conservative_target(source)
    return df.agg(
        F.count(t).alias("kept"),
        F.sum(t.isNull().cast("long")).alias("dropped"),
    )


def ensure_default_target(df: DataFrame, target: str = "default", source: str = "loan_status") -> DataFrame:
    """Coerce an existing target (missing -> 0, truncated to int), or
    derive it with T1; raise when neither column exists."""
    if target in df.columns:
        dtype = df.schema[target].dataType
        v = F.coalesce(to_double(F.col(f"`{target}`"), dtype), F.lit(0.0))
        return df.withColumn(target, v.cast("int"))
    if source in df.columns:
        return df.withColumn(target, simple_target(source))
    raise KeyError(f"no target: the table has neither {target!r} nor a status column {source!r}")


def remove_leakage_columns(
    df: DataFrame, columns: Sequence[str] = LEAKAGE_COLUMNS
) -> tuple[DataFrame, list[str]]:
    """T4: drop post-origination columns present; also return their names."""
    removed = [c for c in columns if c in df.columns]
    return df.drop(*removed), removed


def leakage_report(spark: SparkSession, removed: Sequence[str]) -> DataFrame:
    """T4 report: one row per dropped column name (schema metadata only)."""
    return spark.createDataFrame([(i, c) for i, c in enumerate(removed)], "position int, dropped_column string")
