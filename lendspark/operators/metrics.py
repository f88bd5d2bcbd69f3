"""Model metrics and monitoring tables (A1-A16, PL10).

All of them are aggregations: results are one row (or one row per band /
period / segment / feature), never a per-row collect.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.bins import histogram_bin, percent_grid_probs, width_bin
from ..functions.nulls import nan_to_null
from ..sources.stages import stage
from .banding import assign_bands, psi_severity
from .curves import auc_ks, auc_ks_of_counts, score_counts
from .quantiles import interpolate, needed_ranks, order_statistics
from .stats import is_missing, numeric_columns


def _y(label: str) -> Column:
    return F.col(label).cast("double")


# --- A1 / A2 --------------------------------------------------------------

def auc(df: DataFrame, score: str = "pd_hat", label: str = "default") -> DataFrame:
    """A1: tie-aware ROC AUC (one row, NULL when a class is absent)."""
    return auc_ks(df, score, label).select("auc")


def ks(df: DataFrame, score: str = "pd_hat", label: str = "default") -> DataFrame:
    """A2: max |TPR - FPR| over all thresholds (one row)."""
    return auc_ks(df, score, label).select("ks")


# --- A3 / A4 --------------------------------------------------------------

def confusion_exprs(score: str, label: str, threshold: float = 0.5) -> list[Column]:
    pred = (F.col(score) >= threshold).cast("long")
    y = F.col(label).cast("long")
    tp = F.sum(pred * y)
    fp = F.sum(pred * (1 - y))
    fn = F.sum((1 - pred) * y)
    return [
        F.coalesce(F.try_divide(tp.cast("double"), (tp + fp).cast("double")), F.lit(0.0)).alias("precision"),
        F.coalesce(F.try_divide(tp.cast("double"), (tp + fn).cast("double")), F.lit(0.0)).alias("recall"),
    ]


def precision_recall(
    df: DataFrame, score: str = "pd_hat", label: str = "default", threshold: float = 0.5
) -> DataFrame:
    """A3: precision / recall of ``score >= threshold`` (0 when undefined)."""
    return df.agg(*confusion_exprs(score, label, threshold))


def brier_expr(score: str, label: str) -> Column:
    d = F.col(score) - _y(label)
    return F.avg(d * d).alias("brier")


def brier(df: DataFrame, score: str = "pd_hat", label: str = "default") -> DataFrame:
    """A4: mean squared difference between score and outcome."""
    return df.agg(brier_expr(score, label))


# --- A5 / A6 --------------------------------------------------------------

def calibration_curve(
    df: DataFrame, score: str = "pd_hat", label: str = "default", n_bins: int = 10
) -> DataFrame:
    """A5: equal-width bins on [0, 1] (right-closed), empty bins absent:
    ``bin, frac_pos, mean_pred, n``."""
    return (
        df.where(F.col(score).isNotNull())
        .groupBy(width_bin(F.col(score), n_bins).alias("bin"))
        .agg(
            F.avg(_y(label)).alias("frac_pos"),
            F.avg(score).alias("mean_pred"),
            F.count(F.lit(1)).alias("n"),
        )
    )


def calibration_table(
    df: DataFrame, score: str = "pd_hat", label: str = "default", n_bins: int = 10
) -> DataFrame:
    """Quantile bins (same rule as the score bands), mean score and
    observed rate per bin: ``band, mean_pred, frac_pos, n``."""
    banded = assign_bands(df, score, n_bins, out="_band")
    return (
        banded.where(F.col("_band").isNotNull())
        .groupBy(F.col("_band").alias("band"))
        .agg(
            F.avg(score).alias("mean_pred"),
            F.avg(_y(label)).alias("frac_pos"),
            F.count(F.lit(1)).alias("n"),
        )
    )


# --- A7 / A8 --------------------------------------------------------------

def count_metrics(counts: DataFrame, keys: Sequence[str] = (), threshold: float = 0.5) -> DataFrame:
    """``(keys, n, obs_rate, avg_pd, auc, ks, precision, recall, brier)`` from
    :func:`.curves.score_counts`, one row per key. ``counts`` should be a
    stage table: the curve and the sums both read it."""
    v, pos, lab, n = F.col("_v"), F.col("pos"), F.col("labelled"), F.col("n")
    scored = v.isNotNull()
    hit = scored & (v >= threshold)
    tp, fp = F.sum(F.when(hit, pos)), F.sum(F.when(hit, lab - pos))
    fn = F.sum(F.when(scored & (v < threshold), pos))
    share = lambda a, b: F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))
    loss = pos * (v - 1) * (v - 1) + (lab - pos) * v * v
    sums = counts.groupBy(*keys).agg(
        F.sum(n).alias("n"),
        F.try_divide(F.sum(pos).cast("double"), F.sum(lab).cast("double")).alias("obs_rate"),
        F.try_divide(F.sum(F.when(scored, v * n)), F.sum(F.when(scored, n)).cast("double")).alias("avg_pd"),
        share(F.coalesce(tp, F.lit(0)), F.coalesce(tp, F.lit(0)) + F.coalesce(fp, F.lit(0))).alias("precision"),
        share(F.coalesce(tp, F.lit(0)), F.coalesce(tp, F.lit(0)) + F.coalesce(fn, F.lit(0))).alias("recall"),
        F.try_divide(F.sum(F.when(scored, loss)), F.sum(F.when(scored, lab)).cast("double")).alias("brier"),
    )
    curve = auc_ks_of_counts(counts, keys)
    if keys:
        return sums.join(curve, on=list(keys), how="left")
    # Two one-row tables.
    return sums.crossJoin(curve)


def compute_metrics(
    df: DataFrame,
    score: str = "pd_hat",
    label: str = "default",
    threshold: float = 0.5,
    with_calibration: bool = False,
    n_bins: int = 10,
) -> DataFrame:
    """One row ``auc, ks, precision, recall, brier`` (+ optional
    calibration arrays ``frac_pos, mean_pred`` in bin order). One pass over
    ``df`` counts its distinct scores; the rest reads the counts."""
    counts = stage(score_counts(df, score, label), "score-counts")
    out = count_metrics(counts, (), threshold).select("auc", "ks", "precision", "recall", "brier")
    if with_calibration:
        curve = calibration_curve(df, score, label, n_bins).agg(
            F.sort_array(F.collect_list(F.struct("bin", "frac_pos", "mean_pred"))).alias("_c")
        )
        out = out.crossJoin(curve).select(
            "*",
            F.col("_c.frac_pos").alias("frac_pos"),
            F.col("_c.mean_pred").alias("mean_pred"),
        ).drop("_c")
    return out


def basic_metrics(df: DataFrame, score: str = "pd_hat", label: str = "default", threshold: float = 0.5) -> DataFrame:
    """``auc, ks, precision, recall``."""
    return compute_metrics(df, score, label, threshold).select("auc", "ks", "precision", "recall")


def validation_metrics(df: DataFrame, score: str = "pd_hat", label: str = "default") -> DataFrame:
    """A8 (validation flavour): ``auc, ks, brier``."""
    return compute_metrics(df, score, label).select("auc", "ks", "brier")


# --- A9 / A10 / PL10 ----------------------------------------------------------

def known_values(df: DataFrame, value: str, keys: Sequence[str] = ()) -> DataFrame:
    """``(keys, _v, n)``: every row's value with a count of one, the missing
    ones as NULL."""
    return df.select(*keys, nan_to_null(F.col(value).cast("double")).alias("_v"), F.lit(1).cast("long").alias("n"))


def psi_of_counts(
    sides: DataFrame,
    group_cols: Sequence[str] = (),
    actual_group_cols: Sequence[str] = (),
    buckets: int = 10,
    epsilon: float = 1e-8,
) -> DataFrame:
    """PSI from ``sides``: rows ``(group_cols, actual_group_cols, _act, _v,
    n)``, of single rows or of counted values. ``_act`` tells the actual side;
    the expected side leaves the actual groups NULL.

    The edges (one short array per group) are selected from the expected rows
    and come back as a small table; one pass then counts both sides by bin, and
    all else reads those counts (at most ``buckets`` a group). No value is
    shuffled.
    """
    g, ag = list(group_cols), list(actual_group_cols)
    sides = sides.where(F.col("_v").isNotNull())
    found = stability_edges(sides.where(~F.col("_act")), g, buckets)
    rows = [((*k,) if g else ()) + (e,) for k, e in found.items()]
    fields = [f"`{c}` {sides.schema[c].dataType.simpleString()}" for c in g] + ["_edges array<double>"]
    edges = sides.sparkSession.createDataFrame(rows or ([] if g else [([],)]), ", ".join(fields))

    # The edge table has one row per group, known on the driver.
    named = edges.select(*[F.col(c).alias(f"_g_{c}") for c in g], "_edges")
    here = F.lit(True)
    for c in g:
        here = here & F.col(c).eqNullSafe(F.col(f"_g_{c}"))
    joined = sides.join(F.broadcast(named), here, "left") if g else sides.crossJoin(F.broadcast(named))
    cell = histogram_bin(F.col("_v"), F.col("_edges"), buckets + 1).alias("_bin")
    counts = stage(joined.groupBy(*g, *ag, "_act", cell).agg(F.sum("n").alias("_n")), "bin-counts")
    return psi_of_bins(edges, counts, g, ag, epsilon)


def stability_edges(expected: DataFrame, group_cols: Sequence[str] = (), buckets: int = 10) -> dict:
    """Distinct quantiles of ``(group_cols, _v, n)`` on the percent grid, by
    group (a tuple of its values; 0 without groups)."""
    probs = percent_grid_probs(buckets)
    key = F.struct(*group_cols) if group_cols else F.lit(0)
    found = order_statistics(
        expected.select(key.alias("_k"), "_v", F.col("n").alias("_w")),
        lambda sizes: {k: needed_ranks(n, probs) for k, n in sizes.items()},
    )
    return {k: sorted({interpolate(at, n, p) for p in probs}) for k, (n, at) in found.items()}


def psi_of_bins(
    edges: DataFrame, counts: DataFrame, group_cols: Sequence[str] = (), actual_group_cols: Sequence[str] = (), epsilon: float = 1e-8
) -> DataFrame:
    """PSI from ``edges`` ``(group_cols, _edges)`` and ``counts`` ``(group_cols,
    actual_group_cols, _act, _bin, _n)``, a few rows each."""
    g, ag = list(group_cols), list(actual_group_cols)
    expected = counts.where(~F.col("_act")).select(*g, "_bin", F.col("_n").alias("_e"))
    actual = counts.where("_act").select(*g, *ag, "_bin", F.col("_n").alias("_a"))
    keys = actual.select(*g, *ag).distinct()
    bins = edges.where(F.size("_edges") >= 2).select(*g, F.explode(F.sequence(F.lit(0), F.size("_edges") - 2)).alias("_bin"))
    bins = bins.join(keys, on=g, how="inner") if g else bins.crossJoin(keys)
    grid = bins.join(expected, on=[*g, "_bin"], how="left").join(actual, on=[*g, *ag, "_bin"], how="left")
    grid = grid.fillna(0, subset=["_e", "_a"])

    w = Window.partitionBy(*g, *ag) if (g or ag) else Window.partitionBy(F.lit(0))
    e_share = F.greatest(F.col("_e") / (F.sum("_e").over(w) + F.lit(epsilon)), F.lit(epsilon))
    a_share = F.greatest(F.col("_a") / (F.sum("_a").over(w) + F.lit(epsilon)), F.lit(epsilon))
    terms = grid.select(*g, *ag, ((a_share - e_share) * F.log(a_share / e_share)).alias("_t"))
    if not g and not ag:
        # Exactly one row; PSI NULL when fewer than two edges exist.
        return terms.agg(F.sum("_t").alias("psi"))
    res = terms.groupBy(*g, *ag).agg(F.sum("_t").alias("psi"))
    return keys.join(res, on=[*g, *ag], how="left")


def both_sides(expected: DataFrame, actual: DataFrame, actual_group_cols: Sequence[str] = ()) -> DataFrame:
    """The input of :func:`psi_of_counts` from the rows of either side."""
    absent = {c: F.lit(None).cast(actual.schema[c].dataType) for c in actual_group_cols}
    return expected.withColumns({**absent, "_act": F.lit(False)}).unionByName(actual.withColumn("_act", F.lit(True)))


def psi_by_side(
    df: DataFrame,
    value: str,
    side_col: str,
    expected_side="train",
    actual_side="validation",
    group_cols: Sequence[str] = (),
    actual_group_cols: Sequence[str] = (),
    buckets: int = 10,
    epsilon: float = 1e-8,
) -> DataFrame:
    """A9 generalised: PSI of the ``actual_side`` rows against the
    ``expected_side`` rows of one frame, per group.

    Edges are the distinct quantiles of the expected values on a 0..100
    percent grid; counting is left-closed with the last bin closed, values
    outside the edges and missing values are ignored; shares are
    ``count / (in-range total + epsilon)`` floored at ``epsilon``;
    ``psi = sum((a - e) * ln(a / e))``; fewer than two edges -> NULL.

    ``group_cols`` key the edges (e.g. feature); ``actual_group_cols`` add
    keys on the actual side only (e.g. period), each compared with the same
    expected distribution. The input is scanned some four times for its value
    and key columns; nothing but counts is shuffled.
    """
    g, ag = list(group_cols), list(actual_group_cols)
    sides = df.where(F.col(side_col).isin(expected_side, actual_side)).withColumn("_act", F.col(side_col) == F.lit(actual_side))
    sides = sides.withColumns({c: F.when(F.col("_act"), F.col(c)) for c in ag})
    return psi_of_counts(known_values(sides, value, [*g, *ag, "_act"]), g, ag, buckets, epsilon)


def psi_grouped(
    expected: DataFrame,
    actual: DataFrame,
    value: str,
    group_cols: Sequence[str] = (),
    actual_group_cols: Sequence[str] = (),
    buckets: int = 10,
    epsilon: float = 1e-8,
) -> DataFrame:
    """A9 over two frames."""
    g, ag = list(group_cols), list(actual_group_cols)
    sides = both_sides(known_values(expected, value, g), known_values(actual, value, g + ag), ag)
    return psi_of_counts(sides, g, ag, buckets, epsilon)


def psi(
    expected: DataFrame, actual: DataFrame, value: str = "pd_hat", buckets: int = 10, epsilon: float = 1e-8
) -> DataFrame:
    """One-row PSI of one column."""
    return psi_grouped(expected, actual, value, (), (), buckets, epsilon)


def side_metrics(
    df: DataFrame,
    side_col: str = "split",
    score: str = "pd_hat",
    label: str = "default",
    expected_side="train",
    actual_side="validation",
) -> DataFrame:
    """One row ``auc, ks, brier, psi``: quality of the actual side and its
    drift against the expected side, from one pass over ``df``."""
    sides = df.where(F.col(side_col).isin(expected_side, actual_side))
    counts = stage(score_counts(sides, score, label, [side_col]), "score-counts")
    drift = psi_of_counts(counts.select((F.col(side_col) == F.lit(actual_side)).alias("_act"), "_v", "n"))
    quality = count_metrics(counts.where(F.col(side_col) == actual_side).drop(side_col))
    return quality.crossJoin(drift).select("auc", "ks", "brier", "psi")


# Features compared between the training and validation files.
DEFAULT_PSI_FEATURES = ["loan_amnt", "annual_inc", "dti", "fico_mean"]


def unpivot_features(df: DataFrame, features: Sequence[str], extra: Sequence[str] = ()) -> DataFrame:
    """``(extra..., feature, value)`` long form over ``features`` (one pass)."""
    arr = F.array(
        *[F.struct(F.lit(f).alias("feature"), F.col(f"`{f}`").cast("double").alias("value")) for f in features]
    )
    return df.select(*extra, F.explode(arr).alias("_s")).select(*extra, "_s.feature", "_s.value")


def psi_features(
    expected: DataFrame,
    actual: DataFrame,
    features: Sequence[str] = DEFAULT_PSI_FEATURES,
    buckets: int = 10,
) -> DataFrame:
    """A10: PSI for every listed feature present in both tables, one job:
    ``feature, psi, severity``."""
    feats = [f for f in features if f in expected.columns and f in actual.columns]
    e = unpivot_features(expected, feats)
    a = unpivot_features(actual, feats)
    res = psi_grouped(e, a, "value", ["feature"], (), buckets)
    return res.select("feature", "psi", psi_severity(F.col("psi")).alias("severity"))


def psi_features_by_side(
    df: DataFrame,
    side_col: str = "split",
    expected_side="train",
    actual_side="validation",
    features: Sequence[str] = DEFAULT_PSI_FEATURES,
    buckets: int = 10,
) -> DataFrame:
    """A10 over one frame holding both sides (one scan for the counts)."""
    feats = [f for f in features if f in df.columns]
    long = unpivot_features(df, feats, extra=[side_col])
    res = psi_by_side(long, "value", side_col, expected_side, actual_side, ["feature"], (), buckets)
    return res.select("feature", "psi", psi_severity(F.col("psi")).alias("severity"))


# --- A11 / A12 / A13 ------------------------------------------------------------

def period_of(ts: Column, freq: str = "Q") -> Column:
    """Period text of a timestamp: ``2018Q1`` (Q) or ``2018-01`` (M);
    missing -> ``'NaT'``."""
    if freq.upper().startswith("Q"):
        p = F.concat(F.year(ts).cast("string"), F.lit("Q"), F.quarter(ts).cast("string"))
    elif freq.upper().startswith("M"):
        p = F.date_format(ts, "yyyy-MM")
    else:
        raise ValueError(f"unsupported period frequency {freq!r}")
    return F.coalesce(p, F.lit("NaT"))


def temporal_summary(
    df: DataFrame, time_col: str = "issue_d", score: str = "pd_hat", label: str = "default", freq: str = "Q"
) -> DataFrame:
    """``period, avg_pd, obs_rate, n`` per period."""
    return df.groupBy(period_of(F.col(time_col), freq).alias("period")).agg(
        F.avg(score).alias("avg_pd"),
        F.avg(_y(label)).alias("obs_rate"),
        F.count(F.lit(1)).alias("n"),
    )


def segment_columns(df: DataFrame) -> list[str]:
    """Segments present: ``pd_band``, ``term_months``, ``grade`` (else
    ``sub_grade``)."""
    cols = [c for c in ("pd_band", "term_months") if c in df.columns]
    if "grade" in df.columns:
        cols.append("grade")
    elif "sub_grade" in df.columns:
        cols.append("sub_grade")
    return cols


def segment_performance(
    df: DataFrame,
    segment_cols: Sequence[str],
    score: str = "pd_hat",
    label: str = "default",
) -> DataFrame:
    """A12 for several segment columns at once (one job, no loop over
    segment values): ``segment_col, segment, n, obs_rate, avg_pd, auc, ks,
    brier``. Rows with a missing segment value are dropped."""
    long = df.select(
        F.col(score).alias("_p"),
        F.col(label).alias("_y"),
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(c).alias("segment_col"), F.col(f"`{c}`").cast("string").alias("segment"))
                    for c in segment_cols
                ]
            )
        ).alias("_s"),
    ).select("_s.segment_col", "_s.segment", "_p", "_y").where(F.col("segment").isNotNull())
    keys = ["segment_col", "segment"]
    counts = stage(score_counts(long, "_p", "_y", keys), "score-counts")
    return count_metrics(counts, keys).select(*keys, "n", "obs_rate", "avg_pd", "auc", "ks", "brier")


# --- A14 / A15 / A16 ------------------------------------------------------------

def feature_summary(df: DataFrame, target_col: str = "default", top: int = 10) -> DataFrame:
    """A14 as a long table ``section, metric, value``: row and column
    counts, numeric column count, class counts, and the ``top`` missing
    rates (ties broken by column name)."""
    types = {f.name: f.dataType for f in df.schema.fields}
    n_numeric = len(numeric_columns(df))
    cols = list(df.columns)
    miss = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.avg(is_missing(c, types[c]).cast("double")).alias(f"m{i}") for i, c in enumerate(cols)],
    )
    def entry(section: str, metric: str, value: Column) -> Column:
        return F.struct(F.lit(section).alias("section"), F.lit(metric).alias("metric"),
                        value.cast("double").alias("value"))

    rows = miss.select(
        F.explode(
            F.array(
                entry("shape", "rows", F.col("_rows")),
                entry("shape", "columns", F.lit(float(len(cols)))),
                entry("shape", "numeric_features", F.lit(float(n_numeric))),
                *[entry("missing", c, F.col(f"m{i}")) for i, c in enumerate(cols)],
            )
        ).alias("s")
    ).select("s.section", "s.metric", "s.value")
    w = Window.partitionBy("section").orderBy(F.col("value").desc(), F.col("metric").asc())
    rows = rows.withColumn("_r", F.row_number().over(w)).where(
        (F.col("section") != "missing") | (F.col("_r") <= top)
    ).drop("_r")
    if target_col in df.columns:
        classes = df.groupBy(F.col(target_col).cast("string").alias("metric")).agg(
            F.count(F.lit(1)).cast("double").alias("value")
        ).select(F.lit("target").alias("section"), "metric", "value")
        rows = rows.unionByName(classes)
    return rows


def split_counts(df: DataFrame, split_col: str = "split") -> DataFrame:
    """Rows per split label."""
    return df.groupBy(split_col).agg(F.count(F.lit(1)).alias("n"))


# --- PL10 -------------------------------------------------------------------------

def monitor_by_period(
    reference: DataFrame,
    current: DataFrame,
    time_col: str,
    score: str = "pd_hat",
    label: str = "default",
    freq: str = "Q",
    buckets: int = 10,
) -> DataFrame:
    """PL10: per period of ``current``: ``n, psi`` (score against the
    ``reference`` distribution), ``auc, brier`` and the three trigger flags
    of the approval rule. Missing periods are excluded."""
    counts = stage(period_counts(current, time_col, score, label, freq), "score-counts")
    return monitor_of_counts(known_values(reference, score), counts, buckets)


def period_counts(current: DataFrame, time_col: str, score: str = "pd_hat", label: str = "default", freq: str = "Q") -> DataFrame:
    """``(period, _v, n, labelled, pos)``: the counts per period and score from
    which every figure of the monitor follows. Missing periods are left out."""
    cur = current.where(F.col(time_col).isNotNull()).withColumn("period", period_of(F.col(time_col), freq))
    return score_counts(cur, score, label, ["period"])


def monitor_of_counts(reference: DataFrame, counts: DataFrame, buckets: int = 10) -> DataFrame:
    """PL10 from :func:`period_counts` (a stored table) and the reference's
    values or counts ``(_v, n)``."""
    from .banding import AUC_FLOOR, BRIER_CEILING, PSI_CEILING

    p = psi_of_counts(both_sides(reference, counts.select("period", "_v", "n"), ["period"]), (), ["period"], buckets)
    out = count_metrics(counts, ["period"]).join(p, "period", "left")
    return out.select(
        "period", "n", "psi", "auc", "brier",
        F.coalesce(F.col("psi") > PSI_CEILING, F.lit(False)).alias("psi_trigger"),
        F.coalesce(F.col("brier") > BRIER_CEILING, F.lit(False)).alias("brier_trigger"),
        F.coalesce(F.col("auc") < AUC_FLOOR, F.lit(False)).alias("auc_trigger"),
    )


class MonitorState:
    """The monitor's counts kept as a table partitioned by period.

    :meth:`put` takes the rows of some periods and replaces these periods'
    partitions (so putting a period again changes nothing), reading no other
    period. :meth:`set_reference` keeps the reference's counts beside them.
    :meth:`report` is :func:`monitor_by_period` of all rows ever put.
    """

    def __init__(self, spark: SparkSession, path: str, time_col: str, score: str = "pd_hat", label: str = "default", freq: str = "Q"):
        self.spark, self.path, self.args = spark, path.rstrip("/"), (time_col, score, label, freq)

    def set_reference(self, reference: DataFrame) -> None:
        rows = known_values(reference, self.args[1]).where(F.col("_v").isNotNull())
        rows.groupBy("_v").agg(F.sum("n").alias("n")).write.mode("overwrite").parquet(f"{self.path}/reference")

    def put(self, rows: DataFrame) -> None:
        counts = period_counts(rows, *self.args)
        counts.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("period").parquet(f"{self.path}/periods")

    def counts(self) -> DataFrame:
        schema = "_v double, n long, labelled long, pos long, period string"
        return self.spark.read.schema(schema).parquet(f"{self.path}/periods")

    def report(self, buckets: int = 10) -> DataFrame:
        return monitor_of_counts(self.spark.read.parquet(f"{self.path}/reference"), self.counts(), buckets)
