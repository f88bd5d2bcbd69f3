"""Scalar feature expressions and the feature builder.

Each feature is a native column expression; the builder composes them in
one projection chain and adds the encoders of :mod:`.encode`.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.bins import label_bin
from ..functions.nulls import NUMERIC_TYPES, nan_to_null, normalise_nan
from ..functions.parse import (
    emp_length_feature,
    extract_term,
    floor_days_between,
    parse_date_fallback,
    parse_month_date,
    parse_percent_lenient,
)
from . import encode, stats

# Employment-length bins (right-closed, lowest included).
EMP_BIN_EDGES = [-0.1, 2, 5, 9, 100]
EMP_BIN_LABELS = ["0-2", "3-5", "6-9", "10+"]
# Interest-rate bins (right-closed, lowest included).
RATE_BIN_EDGES = [0, 8, 12, 16, 20, 100]
RATE_BIN_LABELS = ["<8", "8-12", "12-16", "16-20", ">=20"]
MISSING_LABEL = "missing"
DAYS_PER_YEAR = 365.25

# Encoder inputs.
FREQ_COLUMNS = ["emp_title", "emp_length", "addr_state"]
ONEHOT_COLUMNS = ["home_ownership", "purpose", "int_rate_bin", "emp_length_bin"]
TE_COLUMN = "emp_title"
# Identifier / post-issue columns removed at the end.
ID_COLUMNS = ["id", "member_id", "url", "desc", "title", "last_pymnt_d", "next_pymnt_d", "collection_recovery_fee"]

CATEGORY_ORDER = {
    "emp_length_bin": EMP_BIN_LABELS + [MISSING_LABEL],
    "int_rate_bin": RATE_BIN_LABELS + [MISSING_LABEL],
}


def _q(c: str) -> Column:
    return F.col(f"`{c}`")


def _is_numeric(df: DataFrame, c: str) -> bool:
    return isinstance(df.schema[c].dataType, NUMERIC_TYPES)


def _as_timestamp(df: DataFrame, c: str) -> Column:
    dt = df.schema[c].dataType
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return _q(c).cast("timestamp")
    return F.coalesce(parse_date_fallback(_q(c)), parse_month_date(_q(c)))


# --- F1-F10 --------------------------------------------------------------------------

def rate_reparse(df: DataFrame) -> Column | None:
    """``int_rate`` with ``%`` removed, coerced (bad -> NULL)."""
    if "int_rate" not in df.columns:
        return None
    if _is_numeric(df, "int_rate"):
        return nan_to_null(_q("int_rate").cast("double"))
    return parse_percent_lenient(_q("int_rate"))


def ratio_features(df: DataFrame) -> DataFrame:
    """Re-parsed ``int_rate``, ``dti_ratio`` (copy of ``dti``; a
    placeholder ``dti`` is created when only ``annual_inc`` exists) and
    ``lti = loan_amnt / annual_inc`` (zero income -> NULL)."""
    exprs = {}
    rr = rate_reparse(df)
    if rr is not None:
        exprs["int_rate"] = rr
    if "dti" not in df.columns and "annual_inc" in df.columns:
        exprs["dti"] = F.lit(None).cast("double")
    if "loan_amnt" in df.columns and "annual_inc" in df.columns:
        inc = _q("annual_inc").cast("double")
        exprs["lti"] = F.try_divide(_q("loan_amnt").cast("double"), F.when(inc != 0, inc))
    else:
        exprs["lti"] = F.lit(None).cast("double")
    out = df.withColumns(exprs)
    dti = _q("dti").cast("double") if "dti" in out.columns else F.lit(None).cast("double")
    return out.withColumn("dti_ratio", dti)


def emp_length_features(df: DataFrame) -> DataFrame:
    """F4 + F5: ``emp_length_num`` and its label bin."""
    if "emp_length" not in df.columns:
        return df
    num = emp_length_feature(_q("emp_length"))
    out = df.withColumn("emp_length_num", num)
    return out.withColumn(
        "emp_length_bin",
        label_bin(F.coalesce(_q("emp_length_num"), F.lit(-1.0)), EMP_BIN_EDGES, EMP_BIN_LABELS, MISSING_LABEL),
    )


def credit_history_years(df: DataFrame, issue: str = "issue_d", earliest: str = "earliest_cr_line") -> DataFrame:
    """floored whole days between the two dates / 365.25."""
    if issue in df.columns and earliest in df.columns:
        days = floor_days_between(_as_timestamp(df, issue), _as_timestamp(df, earliest))
        return df.withColumn("credit_history_years", days / F.lit(DAYS_PER_YEAR))
    return df.withColumn("credit_history_years", F.lit(None).cast("double"))


def rate_bin(df: DataFrame) -> DataFrame:
    """interest-rate label bin (missing -> ``'missing'``)."""
    if "int_rate" not in df.columns:
        return df
    r = F.coalesce(_q("int_rate").cast("double"), F.lit(-1.0))
    return df.withColumn("int_rate_bin", label_bin(r, RATE_BIN_EDGES, RATE_BIN_LABELS, MISSING_LABEL))


def term_features(df: DataFrame) -> DataFrame:
    """F8: ``term_months`` from the term text, ``term_long`` = more than 36
    months as 0.0 / 1.0 (missing -> 0.0); both NULL without a term."""
    if "term" not in df.columns:
        return df.withColumns({"term_months": F.lit(None).cast("double"), "term_long": F.lit(None).cast("double")})
    tm = extract_term(_q("term"))
    return df.withColumn("term_months", tm).withColumn(
        "term_long", F.coalesce(_q("term_months") > 36, F.lit(False)).cast("double")
    )


def fit_interaction(df: DataFrame) -> float | None:
    """F9 fit: exact median of ``int_rate``."""
    if "int_rate" not in df.columns:
        return None
    return stats.medians(df, ["int_rate"])["int_rate"]


def interaction(df: DataFrame, rate_median: float | None) -> DataFrame:
    """``loan_x_int = loan_amnt * int_rate`` (missing rate -> median)."""
    if "loan_amnt" in df.columns and "int_rate" in df.columns:
        rate = F.coalesce(_q("int_rate").cast("double"), F.lit(rate_median).cast("double"))
        return df.withColumn("loan_x_int", _q("loan_amnt").cast("double") * rate)
    return df.withColumn("loan_x_int", F.lit(None).cast("double"))


def log_features(df: DataFrame, columns=encode.LOG_COLUMNS) -> DataFrame:
    """``{c}_log1p = log1p(max(c, 0))``, missing kept missing."""
    return df.withColumns(
        {
            f"{c}_log1p": F.when(_q(c).isNotNull(), F.log1p(F.greatest(_q(c).cast("double"), F.lit(0.0))))
            for c in columns if c in df.columns
        }
    )


def drop_identifiers(df: DataFrame) -> DataFrame:
    """F11."""
    return df.drop(*[c for c in ID_COLUMNS if c in df.columns])


# --- F13 builder ------------------------------------------------------------------------

@dataclass
class FeatureParams:
    """Learned state of the feature builder: interaction median, frequency
    tables, one-hot levels and the target-encoding table."""

    rate_median: float | None = None
    freq_tables: dict = field(default_factory=dict)
    onehot_levels: dict = field(default_factory=dict)
    te: encode.TargetEncoding | None = None
    te_mean: DataFrame | float | None = None

    # --- IO7 persistence ---------------------------------------------------------
    def save(self, spark, path: str) -> None:
        gm = self.te_mean
        if isinstance(gm, DataFrame):
            gm = gm.first()["_gm"]
        spark.createDataFrame(
            [("rate_median", self.rate_median), ("te_global_mean", gm)], "name string, value double"
        ).coalesce(1).write.mode("overwrite").parquet(f"{path}/scalars")
        lv = [(c, i, x) for c, levels in self.onehot_levels.items() for i, x in enumerate(levels)]
        spark.createDataFrame(lv, "column string, position int, level string") \
            .coalesce(1).write.mode("overwrite").parquet(f"{path}/onehot")
        for c, t in self.freq_tables.items():
            t.write.mode("overwrite").parquet(f"{path}/freq/{c}")
        if self.te is not None:
            self.te.table.write.mode("overwrite").parquet(f"{path}/te")
        # Names every part; written last, read first.
        parts = [("freq", c) for c in self.freq_tables] + ([("te", TE_COLUMN)] if self.te is not None else [])
        spark.createDataFrame(parts, "kind string, column string").coalesce(1).write.mode("overwrite").parquet(f"{path}/parts")

    @staticmethod
    def load(spark, path: str) -> FeatureParams:
        """Every part that was saved must be there; a missing one raises."""
        parts = [(r["kind"], r["column"]) for r in spark.read.parquet(f"{path}/parts").collect()]
        sc = {r["name"]: r["value"] for r in spark.read.parquet(f"{path}/scalars").collect()}
        levels: dict = {}
        for r in spark.read.parquet(f"{path}/onehot").orderBy("column", "position").collect():
            levels.setdefault(r["column"], []).append(r["level"])
        order = [c for c in ONEHOT_COLUMNS if c in levels] + [c for c in levels if c not in ONEHOT_COLUMNS]
        freq = {c: spark.read.parquet(f"{path}/freq/{c}") for c in FREQ_COLUMNS if ("freq", c) in parts}
        te = None
        if ("te", TE_COLUMN) in parts:
            te = encode.TargetEncoding(table=spark.read.parquet(f"{path}/te"), n_splits=0)
        return FeatureParams(sc.get("rate_median"), freq, {c: levels[c] for c in order}, te, sc.get("te_global_mean"))


def scalar_features(df: DataFrame) -> DataFrame:
    """F1-F8 (no learned state); NaN counts as missing."""
    df = ratio_features(normalise_nan(df))
    df = emp_length_features(df)
    df = credit_history_years(df)
    df = rate_bin(df)
    return term_features(df)


def build_features(
    df: DataFrame,
    target: str | None = None,
    fold: Column | None = None,
    n_splits: int = 5,
    seed: int = 42,
) -> tuple[DataFrame, FeatureParams]:
    """F1-F9, E1 (counts), E2 (one-hot of ``home_ownership``,
    ``purpose``, ``int_rate_bin``, ``emp_length_bin``), E3 (out-of-fold
    ``emp_title`` target mean when ``target`` is given), F11.

    Statistics are learned on ``df`` itself (the reference's scope).
    """
    df = scalar_features(df)
    params = FeatureParams(rate_median=fit_interaction(df))
    df = interaction(df, params.rate_median)
    # With a target, the target-encoding table of ``emp_title`` already
    # holds its row counts: one join gives both encodings (one shuffle of
    # the wide table instead of two).
    shared = target is not None and TE_COLUMN in df.columns
    freq_cols = [c for c in FREQ_COLUMNS if c in df.columns]
    for c in freq_cols:
        if not (shared and c == TE_COLUMN):
            params.freq_tables[c] = encode.fit_frequency(df, c)
    for c, t in params.freq_tables.items():
        df = encode.apply_frequency(df, c, t)
    onehot = [c for c in ONEHOT_COLUMNS if c in df.columns]
    params.onehot_levels = encode.fit_onehot_levels(df, onehot, CATEGORY_ORDER)
    df = encode.apply_onehot(df, params.onehot_levels)
    if shared:
        freq_name = f"{TE_COLUMN}{encode.FREQ_SUFFIX}"
        df, params.te, params.te_mean = encode.fit_apply_target_encoding(
            df, TE_COLUMN, target, fold, n_splits, seed, freq_out=freq_name)
        params.freq_tables[TE_COLUMN] = params.te.table.select(
            "_value", F.col("_rows").cast("double").alias("_freq"))
        params.freq_tables = {c: params.freq_tables[c] for c in freq_cols}
        # Put the count column back where the separate join would have.
        cols = [c for c in df.columns if c != freq_name]
        later = [f"{c}{encode.FREQ_SUFFIX}" for c in freq_cols if c != TE_COLUMN]
        at = cols.index(later[0]) if later else cols.index("loan_x_int") + 1
        df = df.select(*[F.col(f"`{c}`") for c in cols[:at] + [freq_name] + cols[at:]])
    return drop_identifiers(df), params


def apply_features(df: DataFrame, params: FeatureParams) -> DataFrame:
    """F13 for new rows with frozen parameters: the same columns as
    :func:`build_features`; unseen values get NULL counts, all-zero dummies
    and the fitted global target mean."""
    df = scalar_features(df)
    df = interaction(df, params.rate_median)
    for c, t in params.freq_tables.items():
        if c in df.columns:
            df = encode.apply_frequency(df, c, t)
    df = encode.apply_onehot(df, {c: lv for c, lv in params.onehot_levels.items() if c in df.columns})
    if params.te is not None and TE_COLUMN in df.columns:
        gm = params.te_mean.first()["_gm"] if isinstance(params.te_mean, DataFrame) else params.te_mean
        df = encode.apply_target_encoding_new(df, TE_COLUMN, params.te, gm)
    return drop_identifiers(df)
