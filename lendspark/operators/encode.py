"""Encoders, imputers, clipping and scaling (E1-E8): aggregate, then map back.

Learned state is small and explicit: per-column literals (medians, clip
bounds, means, stds, one-hot levels) or grouped tables (value counts,
fold sums) that are joined back by value. Grouped tables are stage tables, so
the planner knows their bytes: small ones are broadcast, and beyond that the
values that hold a large share of the rows (such as ``'missing'``) are joined
through a broadcast of their own.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.nulls import normalise_nan
from ..sources.stages import stage
from . import stats
from .curves import running_sums
from .joins import lookup_join
from .quantiles import interpolate, needed_ranks, wide_order_statistics

MISSING_TOKEN = "missing"
FREQ_SUFFIX = "_freq_enc"
TE_SUFFIX = "_target_te"


def _q(c: str) -> Column:
    return F.col(f"`{c}`")


# --- E1 frequency encoding ------------------------------------------------------------

def fit_frequency(df: DataFrame, column: str) -> DataFrame:
    """E1 fit: row count per value, missing counted as ``'missing'``.
    Partial aggregation keeps hot values cheap before the shuffle."""
    v = F.coalesce(_q(column).cast("string"), F.lit(MISSING_TOKEN))
    return stage(df.groupBy(v.alias("_value")).agg(F.count(F.lit(1)).cast("double").alias("_freq")), "frequencies")


def apply_frequency(df: DataFrame, column: str, table: DataFrame, out: str | None = None) -> DataFrame:
    """E1 apply: left join on the value (unseen values -> NULL)."""
    out = out or f"{column}{FREQ_SUFFIX}"
    joined = _join_values(df, column, table, "_freq")
    return joined.withColumn(out, F.col("_freq")).drop("_freq")


def _join_values(df: DataFrame, column: str, table: DataFrame, count: str) -> DataFrame:
    """Left join of a fitted table (one row per ``_value``) by the values of
    ``column``, missing as ``'missing'``. The table's own counts name the heavy
    values, which are joined apart (:func:`.joins.lookup_join`)."""
    left = df.withColumn("_vkey", F.coalesce(_q(column).cast("string"), F.lit(MISSING_TOKEN)))
    return lookup_join(left, table.withColumnRenamed("_value", "_vkey"), "_vkey", weight=count).drop("_vkey")


def frequency_encode(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """E1 for several columns, fitted on ``df`` itself."""
    tables = {c: fit_frequency(df, c) for c in columns}
    for c, t in tables.items():
        df = apply_frequency(df, c, t)
    return df


# --- E2 one-hot ----------------------------------------------------------------------------

MAX_LEVELS = 1000


def fit_onehot_levels(
    df: DataFrame, columns: Sequence[str], categories: dict | None = None, max_levels: int = MAX_LEVELS
) -> dict[str, list[str]]:
    """E2 fit: level list per column. Columns with a fixed category order
    (``categories``) keep it, unused categories included; the others get
    their sorted distinct values, found for all columns in one action. Every
    level becomes a column of the result, so the levels come to the driver;
    more than ``max_levels`` in all are an error (use the sparse form,
    :func:`fit_onehot_vocabulary`)."""
    categories = categories or {}
    out = {c: list(categories[c]) for c in columns if c in categories}
    todo = [c for c in columns if c not in categories]
    if todo:
        pairs = F.explode(F.array(*[
            F.struct(F.lit(c).alias("col"), _q(c).cast("string").alias("v")) for c in todo
        ])).alias("p")
        found = df.select(pairs).select("p.col", "p.v").where(F.col("v").isNotNull()).distinct()
        rows = found.limit(max_levels + 1).collect()
        if len(rows) > max_levels:
            raise ValueError(f"over {max_levels} levels in {todo}: one column each is too many")
        out |= {c: sorted(r["v"] for r in rows if r["col"] == c) for c in todo}
    return {c: out[c] for c in columns}


def apply_onehot(df: DataFrame, levels: dict[str, list[str]], drop_first: bool = True) -> DataFrame:
    """E2 apply: ``{c}_{level}`` int columns (first level dropped) plus
    ``{c}_nan`` for missing values; the source columns are removed and the
    dummies appended at the end, column by column."""
    dummies = []
    for c, lv in levels.items():
        use = lv[1:] if drop_first else lv
        src = _q(c).cast("string")
        dummies += [(src == F.lit(x)).cast("int").alias(f"{c}_{x}") for x in use]
        dummies.append(F.coalesce(src.isNull().cast("int"), F.lit(0)).alias(f"{c}_nan"))
    keep = [_q(c) for c in df.columns if c not in levels]
    out = df.select(*keep, *dummies)
    return out.fillna(0, subset=[d for d in out.columns if d not in df.columns])


@dataclass
class Vocabulary:
    """Positions of the sparse one-hot vector."""

    table: DataFrame  # _column, _level (NULL: missing), _position
    columns: list
    size: int


def fit_onehot_vocabulary(
    df: DataFrame, columns: Sequence[str], categories: dict | None = None, drop_first: bool = True
) -> Vocabulary:
    """E2 fit for any number of levels: the places that
    :func:`apply_onehot`'s columns would have, as a table. Levels are found by
    one grouping and numbered by ranges in the executors
    (:func:`.curves.running_sums`); none reaches the driver. Columns with a
    fixed order (``categories``) keep it."""
    spark, categories = df.sparkSession, categories or {}
    schema = "_c int, _rank int, _level string"
    fixed = [(i, k, v) for i, c in enumerate(columns) for k, v in enumerate(categories.get(c, ()))]
    levels = spark.createDataFrame(fixed, schema)
    free = [(i, c) for i, c in enumerate(columns) if c not in categories]
    if free:
        pairs = F.explode(F.array(*[F.struct(F.lit(i).alias("_c"), _q(c).cast("string").alias("_level")) for i, c in free])).alias("p")
        found = df.select(pairs).select("p._c", F.lit(0).alias("_rank"), "p._level").where(F.col("_level").isNotNull()).distinct()
        levels = levels.unionByName(found)
    levels = stage(levels, "levels")
    if drop_first:
        # One row per column.
        first = levels.groupBy("_c").agg(F.min(F.struct("_rank", "_level")).alias("_first"))
        levels = levels.join(first, "_c").where(F.struct("_rank", "_level") > F.col("_first")).drop("_first")
    missing = spark.createDataFrame([(i, 2**31 - 1, None) for i in range(len(columns))], schema)
    every = levels.unionByName(missing).withColumn("_one", F.lit(1).cast("long"))
    placed = running_sums(every, ["_c", "_rank", "_level"], ["_one"], prefix="_upto")
    table = stage(placed.select(F.col("_c").alias("_column"), "_level", (F.col("_upto_one") - 1).cast("int").alias("_position")), "vocabulary")
    return Vocabulary(table, list(columns), table.count())


def apply_onehot_sparse(df: DataFrame, vocabulary: Vocabulary, out: str = "onehot") -> DataFrame:
    """E2 apply, sparse: ``out`` is a struct ``size, indices, values`` with a
    one at the place of every column's level, the places ascending; dropped and
    unseen levels have none. The source columns are removed. One lookup by
    value per column, heavy values apart."""
    n = len(vocabulary.columns)
    for i, c in enumerate(vocabulary.columns):
        mine = vocabulary.table.where(F.col("_column") == i)
        missing = mine.where(F.col("_level").isNull()).first()["_position"]
        known = mine.where(F.col("_level").isNotNull()).select(F.col("_level").alias("_vkey"), F.col("_position").alias(f"_p{i}"))
        df = lookup_join(df.withColumn("_vkey", _q(c).cast("string")), known, "_vkey").drop("_vkey")
        df = df.withColumn(f"_p{i}", F.when(_q(c).isNull(), F.lit(missing)).otherwise(F.col(f"_p{i}")))
    at = F.filter(F.array(*[F.col(f"_p{i}") for i in range(n)]), lambda p: p.isNotNull())
    ones = F.transform(at, lambda _: F.lit(1.0))
    sparse = F.struct(F.lit(vocabulary.size).alias("size"), at.alias("indices"), ones.alias("values"))
    return df.withColumn(out, sparse).drop(*vocabulary.columns, *[f"_p{i}" for i in range(n)])


# --- E3 out-of-fold target encoding ------------------------------------------------------

def fold_column(key: str = "row_id", n_splits: int = 5, seed: int = 42) -> Column:
    """Deterministic fold id from a row key and a seed."""
    return F.pmod(F.xxhash64(_q(key), F.lit(seed)), F.lit(n_splits)).cast("int")


@dataclass
class TargetEncoding:
    table: DataFrame  # _value, _fold_sum, _fold_n (arrays by fold), _all_sum, _all_n, _rows
    n_splits: int


def fit_target_encoding(
    df: DataFrame, column: str, target: str, fold: Column, n_splits: int = 5
) -> TargetEncoding:
    """E3 fit: per value, the target sum and count of every fold and overall
    (one grouped aggregate, partial-aggregated before the shuffle). Rows
    without a target count for the frequency (``_rows``) only."""
    v = F.coalesce(_q(column).cast("string"), F.lit(MISSING_TOKEN))
    y = _q(target).cast("double")
    work = df.select(v.alias("_v"), y.alias("_y"), fold.alias("_f"))
    table = stage(work.groupBy(F.col("_v").alias("_value")).agg(
        F.array(*[F.coalesce(F.sum(F.when(F.col("_f") == i, F.col("_y"))), F.lit(0.0)) for i in range(n_splits)]).alias("_fold_sum"),
        F.array(*[F.count(F.when(F.col("_f") == i, F.col("_y"))) for i in range(n_splits)]).alias("_fold_n"),
        F.sum("_y").alias("_all_sum"),
        F.count("_y").alias("_all_n"),
        F.count(F.lit(1)).alias("_rows"),
    ), "target-means")
    return TargetEncoding(table=table, n_splits=n_splits)


def apply_target_encoding(
    df: DataFrame,
    column: str,
    target: str,
    enc: TargetEncoding,
    fold: Column | None = None,
    out: str | None = None,
    freq_out: str | None = None,
) -> DataFrame:
    """E3 apply. With ``fold`` (training rows): mean of the value's target
    over the *other* folds; without (new rows): over all folds. Unseen or
    undefined -> the global target mean of the fitting rows. ``freq_out``
    also emits the value's row count (the frequency encoding of the same
    column) from the same join."""
    out = out or f"{column}{TE_SUFFIX}"
    left = df if fold is None else df.withColumn("_tf", fold + 1)
    joined = _join_values(left, column, enc.table, "_rows")
    if fold is not None:
        num = F.col("_all_sum") - F.element_at("_fold_sum", F.col("_tf"))
        den = F.col("_all_n") - F.element_at("_fold_n", F.col("_tf"))
    else:
        num, den = F.col("_all_sum"), F.col("_all_n")
    enc_val = F.when(den > 0, num / den)
    if freq_out:
        joined = joined.withColumn(freq_out, F.col("_rows").cast("double"))
    return joined.withColumn(out, enc_val).drop("_tf", "_fold_sum", "_fold_n", "_all_sum", "_all_n", "_rows")


def kfold_target_encode(
    df: DataFrame,
    column: str,
    target: str,
    fold: Column | None = None,
    n_splits: int = 5,
    seed: int = 42,
    out: str | None = None,
) -> DataFrame:
    """E3 fitted on ``df`` itself; the global mean enters as a literal."""
    return fit_apply_target_encoding(df, column, target, fold, n_splits, seed, out)[0]


def fit_apply_target_encoding(
    df: DataFrame,
    column: str,
    target: str,
    fold: Column | None = None,
    n_splits: int = 5,
    seed: int = 42,
    out: str | None = None,
    freq_out: str | None = None,
) -> tuple[DataFrame, TargetEncoding, DataFrame]:
    """E3 on ``df`` itself, also returning the fitted table and the one-row
    global mean (for scoring new rows later)."""
    out = out or f"{column}{TE_SUFFIX}"
    fold = fold if fold is not None else fold_column("row_id", n_splits, seed)
    enc = fit_target_encoding(df, column, target, fold, n_splits)
    gm = df.agg(F.avg(_q(target).cast("double")).alias("_gm"))
    mean = gm.first()["_gm"]
    res = apply_target_encoding(df, column, target, enc, fold, out, freq_out)
    res = res.withColumn(out, F.coalesce(F.col(out), F.lit(mean).cast("double")))
    return res, enc, gm


def apply_target_encoding_new(
    df: DataFrame, column: str, enc: TargetEncoding, global_mean: float | None, out: str | None = None
) -> DataFrame:
    """E3 for rows outside the fit (scoring): the value's mean over all
    folds; unseen or missing values get the fitted global mean."""
    out = out or f"{column}{TE_SUFFIX}"
    res = apply_target_encoding(df, column, "", enc, None, out)
    return res.withColumn(out, F.coalesce(F.col(out), F.lit(global_mean).cast("double")))


# --- E4-E7 impute / clip / log ---------------------------------------------------------------

# Skewed money fields that get a log1p companion column.
LOG_COLUMNS = ["annual_inc", "loan_amnt", "revol_bal", "installment"]
FLAG_RATE = 0.05


@dataclass
class OutlierParams:
    flag_columns: list = field(default_factory=list)
    medians: dict = field(default_factory=dict)
    bounds: dict = field(default_factory=dict)
    log_columns: list = field(default_factory=list)


def save_outlier_params(spark, p: OutlierParams, path: str) -> None:
    """IO7: the E4-E7 parameters as one small Parquet table."""
    cols = list(dict.fromkeys(list(p.medians) + list(p.flag_columns) + list(p.log_columns)))
    rows = [
        (c, p.medians.get(c), (p.bounds.get(c) or (None, None))[0], (p.bounds.get(c) or (None, None))[1],
         c in p.medians, c in p.flag_columns, c in p.log_columns)
        for c in cols
    ]
    spark.createDataFrame(
        rows, "column string, median double, low double, high double, numeric boolean, flag boolean, log boolean"
    ).coalesce(1).write.mode("overwrite").parquet(path)


def load_outlier_params(spark, path: str) -> OutlierParams:
    rows = spark.read.parquet(path).collect()
    return OutlierParams(
        flag_columns=[r["column"] for r in rows if r["flag"]],
        medians={r["column"]: r["median"] for r in rows if r["numeric"]},
        bounds={r["column"]: (r["low"], r["high"]) for r in rows if r["numeric"]},
        log_columns=[r["column"] for r in rows if r["log"]],
    )


def fit_missing_and_outliers(
    df: DataFrame,
    clip_pct: tuple[float, float] = (0.01, 0.99),
    exclude: Sequence[str] = ("row_id", "default"),
) -> OutlierParams:
    """E4-E6 fit: missing rates of every column, and exact medians and clip
    quantiles of the median-filled values of the numeric ones. One aggregate
    counts the missing values; one selection gives both kinds of quantile, as
    the fills stand next to the median in the order of the filled values."""
    ex = set(exclude)
    num = stats.numeric_columns(df, exclude=exclude)
    present = [c for c in df.columns if c not in ex]
    rates = stats.missing_rates(df, present)
    flags = [c for c, r in rates.items() if r > FLAG_RATE]
    logs = [c for c in LOG_COLUMNS if c in df.columns]
    if not num:
        return OutlierParams(flag_columns=flags, log_columns=logs)
    total = df.count()

    def ranks(sizes: dict) -> dict:
        return {c: needed_ranks(n, [0.5]) | {r for p in needed_ranks(total, clip_pct) if (r := unfilled_rank(p, n, total)) is not None}
                for c, n in sizes.items()}

    found = wide_order_statistics(df, num, ranks)
    meds, bounds = {}, {}
    for c in num:
        n, at = found.get(c, (0, {}))
        meds[c] = interpolate(at, n, 0.5)
        filled = {p: meds[c] if (r := unfilled_rank(p, n, total)) is None else at[r] for p in needed_ranks(total, clip_pct)} if n else {}
        bounds[c] = tuple(interpolate(filled, total if n else 0, p) for p in clip_pct)
    return OutlierParams(flag_columns=flags, medians=meds, bounds=bounds, log_columns=logs)


def unfilled_rank(rank: int, n: int, total: int) -> int | None:
    """Rank among ``n`` values of the one that has ``rank`` after ``total - n``
    copies of the median joined them; None for a copy."""
    below = (n - 1) // 2 + 1
    if rank < below:
        return rank
    return rank - (total - n) if rank >= below + total - n else None


def apply_missing_and_outliers(df: DataFrame, p: OutlierParams) -> DataFrame:
    """E4-E7 apply: int ``{c}_missing`` flags, median fill, clip (missing
    bounds mean no clipping), then ``{c}_log1p = log1p(max(c, 0))``. NaN
    counts as missing, here as in the fit."""
    df = normalise_nan(df)
    flags = [_q(c).isNull().cast("int").alias(f"{c}_missing") for c in p.flag_columns if c in df.columns]
    cols = []
    for c in df.columns:
        if c in p.medians:
            x = F.coalesce(_q(c).cast("double"), F.lit(p.medians[c]).cast("double"))
            lo, hi = p.bounds.get(c, (None, None))
            if lo is not None:
                x = F.greatest(x, F.lit(float(lo)))
            if hi is not None:
                x = F.least(x, F.lit(float(hi)))
            cols.append(F.when(F.coalesce(_q(c).cast("double"), F.lit(p.medians[c]).cast("double")).isNotNull(), x)
                        .alias(c))
        else:
            cols.append(_q(c))
    out = df.select(*cols, *flags)
    logs = {
        f"{c}_log1p": F.when(_q(c).isNotNull(), F.log1p(F.greatest(_q(c).cast("double"), F.lit(0.0))))
        for c in p.log_columns if c in out.columns
    }
    return out.withColumns(logs)


def handle_missing_and_outliers(
    df: DataFrame,
    clip_pct=(0.01, 0.99),
    exclude: Sequence[str] = ("row_id", "default"),
    materialize: bool = True,
) -> tuple[DataFrame, OutlierParams]:
    """E7 = E4 -> E5 -> E6 -> F10, fitted on ``df`` itself. The fit and the
    result read the input, so it is staged once first unless ``materialize``
    is off."""
    if materialize:
        df = stage(df, "outlier-input")
    params = fit_missing_and_outliers(df, clip_pct, exclude)
    return apply_missing_and_outliers(df, params), params


# --- E8 scaling -----------------------------------------------------------------------------

@dataclass
class ScalerParams:
    means: dict
    scales: dict


def fit_scaler(df: DataFrame, columns: Sequence[str]) -> ScalerParams:
    """E8 fit: mean and *population* standard deviation (zero -> 1), NULLs
    skipped, all columns in one aggregate."""
    ms = stats.mean_std_pop(df, columns)
    means = {c: (m if m is not None else 0.0) for c, (m, _) in ms.items()}
    scales = {c: (s if s not in (None, 0.0) else 1.0) for c, (_, s) in ms.items()}
    return ScalerParams(means=means, scales=scales)


def apply_scaler(df: DataFrame, p: ScalerParams) -> DataFrame:
    """E8 apply: ``(x - mean) / scale``; missing values stay missing."""
    return df.withColumns(
        {c: (_q(c).cast("double") - F.lit(p.means[c])) / F.lit(p.scales[c]) for c in p.means if c in df.columns}
    )


def scaler_table(spark, p: ScalerParams) -> DataFrame:
    """IO7: the scaler as a parameters table (column, mean, scale)."""
    return spark.createDataFrame(
        [(c, float(p.means[c]), float(p.scales[c])) for c in p.means], "column string, mean double, scale double"
    )


def load_scaler(spark, path: str) -> ScalerParams:
    """IO7: a scaler written from :func:`scaler_table`."""
    rows = spark.read.parquet(path).collect()
    return ScalerParams({r["column"]: r["mean"] for r in rows}, {r["column"]: r["scale"] for r in rows})


def numeric_projection(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """numeric columns only (booleans are not numeric), plus ``keep``."""
    num = stats.numeric_columns(df)
    extra = [c for c in keep if c in df.columns and c not in num]
    return df.select(*[_q(c) for c in num + extra])
