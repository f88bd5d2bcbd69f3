"""Raw loan table cleaning.

Every step is one ``select`` over the table; learned decisions (sparse
columns, medians) come from single fused aggregates (see :mod:`.stats`).
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.nulls import normalise_nan, to_double
from ..functions.parse import (
    emp_length_clean,
    extract_term,
    parse_date_fallback,
    parse_month_date,
    parse_percent_strict,
    snake_case_name,
)
from ..sources.stages import stage
from . import stats

DEFAULT_DROP_THRESHOLD = 0.6

# Columns removed by the cleaning stage when present
# (identifiers, administrative, free text, post-funding amounts).
IRRELEVANT_COLUMNS = [
    "id", "member_id", "url",
    "policy_code", "application_type",
    "desc", "title",
    "out_prncp", "out_prncp_inv", "collection_recovery_fee", "recoveries",
    "last_pymnt_d", "last_pymnt_amnt", "next_pymnt_d", "total_pymnt",
    "total_pymnt_inv", "total_rec_prncp", "total_rec_int",
]

# Typed column groups of the cleaning stage.
DATE_COLUMNS = ["issue_d", "earliest_cr_line", "last_pymnt_d", "next_pymnt_d"]
PERCENT_COLUMNS = ["int_rate", "revol_util"]
NUMERIC_COLUMNS = ["loan_amnt", "funded_amnt", "funded_amnt_inv", "annual_inc", "dti", "revol_bal"]
ESSENTIAL_COLUMNS = ["loan_amnt", "int_rate", "annual_inc"]
TARGET_SOURCE = "loan_status"
DATE_FALLBACK_SHARE = 0.1
CATEGORICAL_FILL = "Unknown"


def _q(c: str):
    return F.col(f"`{c}`")


# --- C1 / C5 -------------------------------------------------------------------

def snake_case_columns(df: DataFrame) -> DataFrame:
    """Normalise every column name; raise if two names collide."""
    names = [snake_case_name(c) for c in df.columns]
    dup = [n for n, k in Counter(x.lower() for x in names).items() if k > 1]
    if dup:
        raise ValueError(f"column names collide after normalisation: {dup}")
    return df.toDF(*names)


def drop_irrelevant_columns(df: DataFrame, columns: Sequence[str] = IRRELEVANT_COLUMNS) -> DataFrame:
    """Drop the listed columns that exist."""
    present = [c for c in columns if c in df.columns]
    return df.drop(*present)


# --- C6-C9, C16 -------------------------------------------------------------------

def date_fallback_columns(df: DataFrame, columns: Sequence[str] = DATE_COLUMNS) -> list[str]:
    """C6 decision: date columns where more than 10% of rows (missing ones
    included) fail the month format. One aggregate for all date columns."""
    present = [c for c in columns if c in df.columns and isinstance(
        df.schema[c].dataType, T.StringType)]
    if not present:
        return []
    row = df.agg(
        *[F.avg(parse_month_date(_q(c)).isNull().cast("double")).alias(c) for c in present]
    ).first()
    return [c for c in present if (row[c] or 0.0) > DATE_FALLBACK_SHARE]


def coerce_types(df: DataFrame, date_fallback: bool | str | Sequence[str] = "auto") -> DataFrame:
    """C16 = C6-C9 in one projection.

    dates -> timestamp (month format, with the free-form fallback for the
    columns that need it); ``int_rate``, ``revol_util`` -> double (strict);
    ``term_months``, ``emp_length_int``, ``fico_mean`` added; core numeric
    columns coerced (bad text -> NULL).

    ``date_fallback``: ``"auto"`` decides per column with one aggregate,
    ``True`` / ``False`` force it, a list names the columns.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    if date_fallback == "auto":
        fallback = set(date_fallback_columns(df))
    elif not isinstance(date_fallback, bool):
        fallback = set(date_fallback)
    elif date_fallback:
        fallback = {c for c in DATE_COLUMNS if c in df.columns}
    else:
        fallback = set()

    exprs = {}
    for c in DATE_COLUMNS:
        if c in df.columns:
            if isinstance(types[c], (T.TimestampType, T.TimestampNTZType, T.DateType)):
                exprs[c] = _q(c).cast("timestamp")
            else:
                primary = parse_month_date(_q(c))
                exprs[c] = F.coalesce(primary, parse_date_fallback(_q(c))) if c in fallback else primary
    for c in PERCENT_COLUMNS:
        if c in df.columns:
            exprs[c] = parse_percent_strict(_q(c))
    if "term" in df.columns:
        exprs["term_months"] = extract_term(_q("term"))
    if "emp_length" in df.columns:
        exprs["emp_length_int"] = emp_length_clean(_q("emp_length"))
    if "fico_range_low" in df.columns and "fico_range_high" in df.columns:
        exprs["fico_mean"] = (
            to_double(_q("fico_range_low"), types["fico_range_low"])
            + to_double(_q("fico_range_high"), types["fico_range_high"])
        ) / 2.0
    for c in NUMERIC_COLUMNS:
        if c in df.columns:
            exprs[c] = to_double(_q(c), types[c])
    return df.withColumns(exprs)


# --- C10-C14, C17 ------------------------------------------------------------------

def drop_sparse_columns(
    df: DataFrame, threshold: float = DEFAULT_DROP_THRESHOLD, rates: dict | None = None
) -> DataFrame:
    """Drop columns whose missing share is strictly above ``threshold``."""
    rates = stats.missing_rates(df) if rates is None else rates
    return df.drop(*[c for c, r in rates.items() if r > threshold])


def drop_missing_rows(df: DataFrame) -> DataFrame:
    """C11 + C12: rows need a target source and the essential columns."""
    if TARGET_SOURCE in df.columns:
        df = df.where(_q(TARGET_SOURCE).isNotNull())
    essential = [c for c in ESSENTIAL_COLUMNS if c in df.columns]
    if essential:
        df = df.na.drop(subset=essential)
    return df


@dataclass
class ImputeParams:
    """Learned state of C13 / C14: medians of numeric columns with gaps."""

    medians: dict = field(default_factory=dict)
    categorical: list = field(default_factory=list)


def fit_impute(df: DataFrame, exclude: Sequence[str] = ("row_id",)) -> ImputeParams:
    """C13 / C14 fit: missing shares of numeric columns, then exact medians
    of the columns with gaps (NaN is a gap)."""
    num = stats.numeric_columns(df, exclude=exclude)
    rates = stats.missing_rates(df, num)
    meds = stats.medians(df, [c for c in num if rates[c] > 0])
    return ImputeParams(medians=meds, categorical=list(stats.string_columns(df)))


def apply_impute(df: DataFrame, params: ImputeParams) -> DataFrame:
    """C13 / C14 apply: ``{c}_missing`` (int) flags appended, numeric gaps
    filled with the median, string gaps with ``'Unknown'``."""
    df = normalise_nan(df)
    cols = []
    for c in df.columns:
        if c in params.medians:
            m = params.medians[c]
            cols.append(F.coalesce(_q(c).cast("double"), F.lit(m).cast("double")).alias(c))
        elif c in params.categorical:
            cols.append(F.coalesce(_q(c), F.lit(CATEGORICAL_FILL)).alias(c))
        else:
            cols.append(_q(c))
    flags = [_q(c).isNull().cast("int").alias(f"{c}_missing") for c in params.medians if c in df.columns]
    return df.select(*cols, *flags)


@dataclass
class CleanParams:
    """Learned state of the whole cleaning stage, for new loans."""

    fallback_dates: list = field(default_factory=list)
    dropped: list = field(default_factory=list)
    impute: ImputeParams = field(default_factory=ImputeParams)

    # --- IO7 persistence ---------------------------------------------------------
    def save(self, spark, path: str) -> None:
        rows = [("fallback", c, None) for c in self.fallback_dates] + [("dropped", c, None) for c in self.dropped]
        rows += [("median", c, m) for c, m in self.impute.medians.items()]
        rows += [("categorical", c, None) for c in self.impute.categorical]
        rows = [(i, *x) for i, x in enumerate(rows)]
        spark.createDataFrame(rows, "position int, kind string, column string, value double") \
            .coalesce(1).write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark, path: str) -> CleanParams:
        rows = spark.read.parquet(path).orderBy("position").collect()
        of = lambda kind: [r["column"] for r in rows if r["kind"] == kind]
        medians = {r["column"]: r["value"] for r in rows if r["kind"] == "median"}
        return CleanParams(of("fallback"), of("dropped"), ImputeParams(medians, of("categorical")))


def fit_missing(df: DataFrame, drop_threshold: float = DEFAULT_DROP_THRESHOLD) -> CleanParams:
    """C17 fit: columns to drop, then medians over the rows that stay."""
    df = normalise_nan(df)
    dropped = [c for c, r in stats.missing_rates(df).items() if r > drop_threshold]
    kept = drop_missing_rows(df.drop(*dropped))
    return CleanParams(dropped=dropped, impute=fit_impute(kept))


def apply_missing(df: DataFrame, p: CleanParams) -> DataFrame:
    """C17 apply = C10 -> C11 -> C12 -> C13 -> C14 with learned parameters."""
    return apply_impute(drop_missing_rows(normalise_nan(df).drop(*p.dropped)), p.impute)


def handle_missing(df: DataFrame, drop_threshold: float = DEFAULT_DROP_THRESHOLD) -> DataFrame:
    """C17 fitted on ``df`` itself."""
    return apply_missing(df, fit_missing(df, drop_threshold))


def target_first(df: DataFrame, target: str = TARGET_SOURCE) -> DataFrame:
    """Move the target source column first."""
    if target not in df.columns:
        return df
    return df.select(_q(target), *[_q(c) for c in df.columns if c != target])


def typed(df: DataFrame, date_fallback="auto") -> tuple[DataFrame, list[str]]:
    """C1 -> C5 -> C16, and the date columns read with the free-form fallback."""
    df = drop_irrelevant_columns(snake_case_columns(df))
    if date_fallback == "auto":
        date_fallback = date_fallback_columns(df)
    elif isinstance(date_fallback, bool):
        date_fallback = [c for c in DATE_COLUMNS if c in df.columns] if date_fallback else []
    return coerce_types(df, date_fallback=date_fallback), list(date_fallback)


def fit_clean(
    df: DataFrame, drop_threshold: float = DEFAULT_DROP_THRESHOLD, date_fallback="auto", materialize: bool = True
) -> tuple[DataFrame, CleanParams]:
    """C18 on a raw table, also returning what was learned. The typed table
    is staged once (the fits and the result read it) unless ``materialize``
    is off."""
    df, fallback = typed(df, date_fallback)
    if materialize:
        df = stage(df, "typed")
    params = fit_missing(df, drop_threshold)
    params.fallback_dates = fallback
    return target_first(apply_missing(df, params)), params


def apply_clean(df: DataFrame, params: CleanParams) -> DataFrame:
    """C18 for new raw loans with frozen parameters: the same columns dropped,
    the same date formats, the training run's medians. Text columns that the
    training run did not have stay as they are."""
    return target_first(apply_missing(typed(df, params.fallback_dates)[0], params))


def clean(
    df: DataFrame, drop_threshold: float = DEFAULT_DROP_THRESHOLD, date_fallback="auto", materialize: bool = True
) -> DataFrame:
    """C1 -> C5 -> C16 -> C17 -> C15 on an already loaded raw table."""
    return fit_clean(df, drop_threshold, date_fallback, materialize)[0]
