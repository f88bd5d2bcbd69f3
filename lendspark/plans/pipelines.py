"""User-facing pipelines (PL1-PL10): compositions of the operators.

Each pipeline takes DataFrames and returns DataFrames (or a small result
object holding them); writing them out is the caller's choice (IO5).
Inputs that several fits read are staged as Parquet in the shared folder
(:mod:`..sources.stages`), so each fit reads only its columns.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.bins import histogram_bin
from ..functions.nulls import nan_to_null
from ..operators import banding, clean, encode, features, joins, metrics, model, split, target
from ..session import compile_wide_rows
from ..sources.stages import stage

LABEL = "default"
TIME_COL = "issue_d"
KEY = "row_id"


# --- PL9 contract checks --------------------------------------------------------------

def require_columns(df: DataFrame, columns: Sequence[str], what: str = "input") -> None:
    """Raise before any job when required columns are absent."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{what} must contain columns {list(columns)}; missing {missing}")


# --- PL1 / PL2 feature tables -------------------------------------------------------------

@dataclass
class FeatureResult:
    table: DataFrame
    feature_params: features.FeatureParams
    outlier_params: encode.OutlierParams
    scaler: encode.ScalerParams | None = None
    dropped_leakage: list = field(default_factory=list)


def _built(df: DataFrame, fold, seed: int, fit_scope: str, train_rows) -> tuple:
    """Features and E4-E7 with their parameters, learned on all rows or, for
    ``fit_scope="train"``, on the rows where ``train_rows`` holds and applied
    to the others."""
    if fit_scope not in ("all", "train"):
        raise ValueError(f"fit_scope is 'all' or 'train', not {fit_scope!r}")
    compile_wide_rows(df.sparkSession)
    if fit_scope == "all":
        feats, fp = features.build_features(df, target=LABEL, fold=fold, seed=seed)
        feats = stage(feats, "features")
        op = encode.fit_missing_and_outliers(feats, exclude=(KEY, LABEL))
    else:
        df = df.withColumn("_train", F.coalesce(train_rows, F.lit(False)))
        fitted, fp = features.build_features(df.where("_train"), target=LABEL, fold=fold, seed=seed)
        fitted = stage(fitted, "features")
        op = encode.fit_missing_and_outliers(fitted.drop("_train"), exclude=(KEY, LABEL))
        rest = features.apply_features(df.where("not _train"), fp)
        feats = fitted.unionByName(rest.select(*[F.col(f"`{c}`") for c in fitted.columns])).drop("_train")
    return encode.apply_missing_and_outliers(feats, op), fp, op


def _with_time(feats: DataFrame, table: DataFrame) -> DataFrame:
    """The issue date as a timestamp, where the table carries it."""
    if TIME_COL not in feats.columns:
        return table
    return table.withColumn(TIME_COL, F.col(TIME_COL).cast("timestamp"))


def features_split(
    cleaned: DataFrame,
    test_size: float = 0.2,
    seed: int = 42,
    materialize_input: bool = True,
    fold=None,
    order: Sequence[str] | None = None,
    fit_scope: str = "all",
) -> FeatureResult:
    """PL1: simple target (T1) -> features -> impute / clip / log -> numeric
    projection -> stratified split -> scaler fitted on train, applied to
    both -> recombined, with ``split``, ``default`` and ``issue_d``.

    ``fit_scope="train"`` learns medians, clip bounds and encodings on the
    training part only; ``"all"`` on all rows, as the original does."""
    if materialize_input:
        cleaned = stage(cleaned, "cleaned")
    df = split.stratified_split(target.map_target(cleaned), LABEL, test_size, seed, order=order, out="split")
    feats, fp, op = _built(df, fold, seed, fit_scope, F.col("split") == "train")
    keep = ["split"] + ([TIME_COL] if TIME_COL in feats.columns else [])
    labelled = _with_time(feats, encode.numeric_projection(feats, keep=keep))
    cols = [c for c in labelled.columns if c not in (KEY, LABEL, TIME_COL, "split")]
    sc = encode.fit_scaler(labelled.where(F.col("split") == "train"), cols)
    return FeatureResult(encode.apply_scaler(labelled, sc), fp, op, sc)


def features_conservative(
    cleaned: DataFrame,
    seed: int = 42,
    materialize_input: bool = True,
    fold=None,
    fit_scope: str = "all",
    train_end: str | None = None,
) -> FeatureResult:
    """PL2 (default route): conservative target (T2) -> leakage removal ->
    features -> impute / clip / log -> numeric projection, with ``default``
    and ``issue_d`` carried along (no re-join needed).

    ``fit_scope="train"`` learns on the training period only (``train_end``
    or the time quantile). The cleaned input is staged first (several fits
    read it); pass ``materialize_input=False`` when it is a stored table."""
    if materialize_input:
        cleaned = stage(cleaned, "cleaned")
    df = target.define_default_target(cleaned)
    df, dropped = target.remove_leakage_columns(df)
    train_rows = None
    if fit_scope == "train":
        df = split.time_split_label(df, TIME_COL, train_end, out="_period")
        train_rows = F.col("_period") == "train"
    feats, fp, op = _built(df, fold, seed, fit_scope, train_rows)
    keep = [LABEL] + ([TIME_COL] if TIME_COL in feats.columns else [])
    table = _with_time(feats, encode.numeric_projection(feats, keep=keep))
    return FeatureResult(table, fp, op, None, dropped)


# --- PL3 / PL4 training and scoring --------------------------------------------------------

@dataclass
class TrainResult:
    baseline: model.PDModel
    tuned: model.PDModel | None
    best_c: float | None
    grid: list
    metrics: DataFrame          # model, auc, ks, precision, recall, brier
    decision: DataFrame         # baseline_auc, tuned_auc, delta, selected
    selected: model.PDModel
    train_rows: int
    validation_rows: int


def feature_columns(df: DataFrame) -> list[str]:
    return split.feature_label_columns(df, LABEL, TIME_COL, exclude=(KEY, "split"))


def train_inputs(
    feats: DataFrame, labels: DataFrame | None = None, cleaned: DataFrame | None = None, key: str = KEY
) -> DataFrame:
    """The feature table with target and time: the target is the table's own,
    else the labels table's, else derived from ``loan_status`` (of the
    features, or of the cleaned table by key), else an error; the time column
    is brought back from the cleaned table by key where it is absent."""
    if LABEL not in feats.columns:
        if labels is not None:
            feats = joins.attach_labels(feats, labels, key, out=LABEL)
        elif clean.TARGET_SOURCE not in feats.columns and cleaned is not None and clean.TARGET_SOURCE in cleaned.columns:
            status = joins.unique_by_key(cleaned.select(key, clean.TARGET_SOURCE), key, [clean.TARGET_SOURCE], "cleaned table")
            feats = feats.join(status, on=key, how="left")
    feats = target.ensure_default_target(feats, LABEL, clean.TARGET_SOURCE).drop(clean.TARGET_SOURCE)
    return joins.recover_time_column(feats, cleaned, TIME_COL, key)


def train(
    feats: DataFrame,
    train_end: str | None = None,
    seed: int = 42,
    tune: bool = True,
    Cs: Sequence[float] = (0.1, 1.0, 10.0),
    frac: float = 0.15,
    folds: int = 3,
    labels: DataFrame | None = None,
    cleaned: DataFrame | None = None,
) -> TrainResult:
    """PL3: target and time (:func:`train_inputs`) -> time split -> baseline (L2, C = 1, balanced) -> optional tuning
    on a stratified sample -> validation metrics -> selection rule; the
    selected model is returned and used."""
    compile_wide_rows(feats.sparkSession)
    feats = train_inputs(feats, labels, cleaned)
    require_columns(feats, [LABEL, TIME_COL], "feature table")
    # The cutoff is found on the stage table, of which its scans read one column.
    data = split.time_split_label(stage(feats, "training"), TIME_COL, train_end, out="_part")
    tr, va = (data.where(F.col("_part") == part).drop("_part") for part in ("train", "validation"))
    cols = feature_columns(tr)
    baseline = model.train_logistic(tr, cols, LABEL, C=1.0)
    spark = data.sparkSession
    base_m = metrics.compute_metrics(model.score(baseline, va, "pd_hat"), "pd_hat", LABEL)
    rows = base_m.withColumn("model", F.lit("baseline"))
    tuned, best_c, grid = None, None, []
    if tune:
        tuned, best_c, grid = model.tune_on_sample(tr, cols, LABEL, frac, Cs, folds, seed)
        tm = metrics.compute_metrics(model.score(tuned, va, "pd_hat"), "pd_hat", LABEL)
        rows = rows.unionByName(tm.withColumn("model", F.lit("tuned")))
    mrows = {r["model"]: r for r in rows.collect()}
    b_auc = mrows["baseline"]["auc"]
    t_auc = mrows["tuned"]["auc"] if "tuned" in mrows else None
    decision = model.select_model(spark, b_auc, t_auc)
    sel = decision.first()["selected"]
    selected = tuned if (sel == "tuned" and tuned is not None) else baseline
    counts = {r["_part"]: r["count"] for r in data.groupBy("_part").count().collect()}
    return TrainResult(baseline, tuned, best_c, grid, rows, decision, selected,
                       counts.get("train", 0), counts.get("validation", 0))


def score(feats: DataFrame, pd_model: model.PDModel, train_end: str | None = None) -> DataFrame:
    """PL4: score the validation period; every column is kept plus ``pd_hat``."""
    require_columns(feats, [TIME_COL], "feature table")
    _, va = split.time_split(feats, TIME_COL, train_end)
    return model.score(pd_model, va, "pd_hat")


# --- PL5 / PL6 / PL7 -------------------------------------------------------------------------

@dataclass
class BandResult:
    banded: DataFrame
    summary: DataFrame
    metrics: DataFrame
    actions: DataFrame


def band(scored: DataFrame, n_bands: int = 10) -> BandResult:
    """PL5: quantile bands -> summary -> totals -> labels / verdicts / actions."""
    require_columns(scored, ["pd_hat", LABEL], "scored table")
    banded = banding.assign_bands(scored, "pd_hat", n_bands)
    summary = banding.band_summary(banded)
    return BandResult(banded, summary, banding.band_metrics(summary), banding.band_actions(summary, n_bands))


@dataclass
class ValidationResult:
    metrics: DataFrame
    psi_score: DataFrame | None
    psi_features: DataFrame | None
    temporal: DataFrame | None
    segments: DataFrame
    approval: DataFrame


SCORE = "pd_hat"


def _grouped(df: DataFrame, sets: Sequence[str | tuple]) -> DataFrame:
    """Counts of ``df`` (``_y``, ``_s`` and grouping columns) by every one of
    ``sets``, a grouping each, with its number as ``_set``: one pass and one
    exchange of partial counts."""
    sets = [(s,) if isinstance(s, str) else tuple(s) for s in sets]
    names = list(dict.fromkeys(c for s in sets for c in s))
    mask = {sum(1 << (len(names) - 1 - i) for i, c in enumerate(names) if c not in s): k for k, s in enumerate(sets)}
    number = F.lit(None).cast("int")
    for m, k in mask.items():
        number = F.when(F.grouping_id() == m, k).otherwise(number)
    return df.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in names]).agg(
        number.alias("_set"), F.count(F.lit(1)).alias("n"), F.count("_y").alias("labelled"),
        F.coalesce(F.sum("_y"), F.lit(0)).alias("pos"), F.count("_s").alias("known"), F.sum("_s").alias("total"),
    )


def validate(scored: DataFrame, train_scored: DataFrame | None = None, time_col: str = TIME_COL) -> ValidationResult:
    """PL6: metrics, score and feature PSI (when a training table is
    given), by-period summary, segment tables, approval rule.

    The scored table is read once: one aggregate by grouping sets counts it by
    score, by period, by segment and score, and by bin of every compared
    value; all tables follow from these counts. The bins' edges are selected
    from the training table."""
    require_columns(scored, [LABEL, SCORE], "scored table")
    spark, segments = scored.sparkSession, metrics.segment_columns(scored)
    compared, edges = [], {}
    if train_scored is not None:
        compared = [c for c in [SCORE, *metrics.DEFAULT_PSI_FEATURES] if c in train_scored.columns and c in scored.columns]
    if compared:
        long = metrics.unpivot_features(train_scored, compared).select("feature", nan_to_null("value").alias("_v"), F.lit(1).alias("n"))
        found = metrics.stability_edges(long.where(F.col("_v").isNotNull()), ["feature"])
        edges = {k[0]: e for k, e in found.items()}

    def with_bins(df: DataFrame) -> list:
        at = {c: F.array(*[F.lit(float(e)) for e in edges.get(c, ())]).cast("array<double>") for c in compared}
        # A value outside the edges counts as -1, a missing one as NULL.
        inside = {c: histogram_bin(nan_to_null(f"`{c}`"), at[c], 11) for c in compared}
        return [F.when(nan_to_null(f"`{c}`").isNotNull(), F.coalesce(b, F.lit(-1))).alias(f"_b{i}") for i, (c, b) in enumerate(inside.items())]

    bins = [f"_b{i}" for i in range(len(compared))]
    period = [metrics.period_of(F.col(time_col)).alias("period")] if time_col in scored.columns else []
    sets = ["_v", *(["period"] if period else []), *[(f"_g{i}", "_v") for i in range(len(segments))], *bins]
    rows = scored.select(
        nan_to_null(SCORE).alias("_v"), nan_to_null(SCORE).alias("_s"), F.col(LABEL).cast("long").alias("_y"), *period,
        *[F.col(f"`{c}`").cast("string").alias(f"_g{i}") for i, c in enumerate(segments)], *with_bins(scored),
    )
    counts = stage(_grouped(rows, sets), "validation-counts")
    of = lambda s: counts.where(F.col("_set") == sets.index(s))

    m = metrics.count_metrics(of("_v").select("_v", "n", "labelled", "pos")).select("auc", "ks", "brier")
    temporal = None
    if period:
        share = lambda a, b: F.try_divide(F.col(a).cast("double"), F.col(b).cast("double"))
        temporal = of("period").select("period", share("total", "known").alias("avg_pd"), share("pos", "labelled").alias("obs_rate"), "n")
    segs = [
        of((f"_g{i}", "_v")).where(F.col(f"_g{i}").isNotNull()).select(F.lit(c).alias("segment_col"), F.col(f"_g{i}").alias("segment"), "_v", "n", "labelled", "pos")
        for i, c in enumerate(segments)
    ]
    empty = spark.createDataFrame([], "segment_col string, segment string, _v double, n long, labelled long, pos long")
    by_segment = metrics.count_metrics(stage(reduce(DataFrame.unionByName, segs, empty), "segment-counts"), ["segment_col", "segment"])
    by_segment = by_segment.select("segment_col", "segment", "n", "obs_rate", "avg_pd", "auc", "ks", "brier")

    psi_s = psi_f = None
    if train_scored is not None:
        sides = [spark.createDataFrame([], "feature string, _act boolean, _bin int, _n long")]
        if compared:
            train = stage(_grouped(train_scored.select(F.lit(0).alias("_y"), F.lit(0.0).alias("_s"), *with_bins(train_scored)), bins), "training-bins")
            for act, table, shift in ((False, train, 0), (True, counts, len(sets) - len(bins))):
                for i, c in enumerate(compared):
                    mine = table.where((F.col("_set") == shift + i) & F.col(f"_b{i}").isNotNull())
                    sides.append(mine.select(F.lit(c).alias("feature"), F.lit(act).alias("_act"), F.when(F.col(f"_b{i}") >= 0, F.col(f"_b{i}")).alias("_bin"), F.col("n").alias("_n")))
        table = spark.createDataFrame([(c, e) for c, e in edges.items()], "feature string, _edges array<double>")
        psi = metrics.psi_of_bins(table, reduce(DataFrame.unionByName, sides), ["feature"])
        if SCORE in compared:
            one = spark.createDataFrame([(SCORE,)], "feature string")
            psi_s = one.join(psi, "feature", "left").select("psi")
        psi_f = psi.where(F.col("feature") != SCORE).select("feature", "psi", banding.psi_severity(F.col("psi")).alias("severity"))
    psi_val = psi_s if psi_s is not None else spark.createDataFrame([(None,)], "psi double")
    return ValidationResult(m, psi_s, psi_f, temporal, by_segment, banding.approval(m.crossJoin(psi_val)))



@dataclass
class CalibrationResult:
    brier: DataFrame
    table: DataFrame
    recalibrated: DataFrame | None


def calibrate(scored: DataFrame, apply: bool = False, seed: int = 42, order: Sequence[str] | None = None) -> CalibrationResult:
    """PL7: Brier score, quantile calibration table, optional Platt step."""
    require_columns(scored, [LABEL, "pd_hat"], "scored table")
    recal = model.recalibrate(scored, "pd_hat", LABEL, seed, order) if apply else None
    return CalibrationResult(metrics.brier(scored), metrics.calibration_table(scored), recal)


# --- PL8 report tables ---------------------------------------------------------------------------

def long_report(section: str, wide: DataFrame) -> DataFrame:
    """PL8: a one-row metrics table in long form ``section, metric, value``."""
    cols = [c for c, t in wide.dtypes if t in ("double", "float", "int", "bigint")]
    arr = F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in cols])
    return wide.select(F.explode(arr).alias("s")).select(F.lit(section).alias("section"), "s.metric", "s.value")


def performance_report(spark: SparkSession, res: TrainResult) -> DataFrame:
    """PL8: training report rows (row counts, best C, metrics per model, the
    selection decision)."""
    head = spark.createDataFrame(
        [("summary", "training_rows", float(res.train_rows)),
         ("summary", "validation_rows", float(res.validation_rows)),
         ("tuning", "best_c", float(res.best_c) if res.best_c is not None else None)],
        "section string, metric string, value double",
    )
    per_model = res.metrics.select(
        F.col("model").alias("section"),
        F.explode(F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).alias("value"))
                            for c in ("auc", "ks", "precision", "recall", "brier")])).alias("s"),
    ).select("section", "s.metric", "s.value")
    decision = long_report("selection", res.decision)
    chosen = res.decision.select(
        F.lit("selection").alias("section"), F.lit("tuned_selected").alias("metric"),
        (F.col("selected") == "tuned").cast("double").alias("value"),
    )
    return head.unionByName(per_model).unionByName(decision).unionByName(chosen)


def validation_report(res: ValidationResult) -> DataFrame:
    """PL8: validation results as ``section, metric, value`` rows: the
    out-of-time metrics, score PSI, feature PSI and the number of issues
    raised by the approval rule."""
    parts = [long_report("out_of_time", res.metrics)]
    if res.psi_score is not None:
        parts.append(long_report("psi", res.psi_score))
    if res.psi_features is not None:
        parts.append(res.psi_features.select(F.lit("feature_psi").alias("section"),
                                             F.col("feature").alias("metric"), F.col("psi").alias("value")))
    parts.append(res.approval.select(F.lit("approval").alias("section"), F.lit("n_issues").alias("metric"),
                                     F.col("n_issues").cast("double").alias("value")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _keyed(section: str, df: DataFrame, key, values: Sequence[str]) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in values])
    return df.select(key.alias("key"), F.explode(pairs).alias("s")).select(F.lit(section).alias("section"), "key", "s.metric", "s.value")


def full_validation_report(res: ValidationResult) -> DataFrame:
    """PL8: :func:`validation_report` with the by-period and segment tables,
    ``section, key, metric, value``."""
    out = validation_report(res).select("section", F.lit("").alias("key"), "metric", "value")
    if res.temporal is not None:
        out = out.unionByName(_keyed("by_period", res.temporal, F.col("period"), ["avg_pd", "obs_rate", "n"]))
    at = F.concat("segment_col", F.lit("="), "segment")
    return out.unionByName(_keyed("by_segment", res.segments, at, ["n", "obs_rate", "avg_pd", "auc", "ks", "brier"]))


def calibration_report(res: CalibrationResult) -> DataFrame:
    """PL8: calibration results as ``section, key, metric, value``."""
    out = _keyed("calibration", res.table, F.col("band").cast("string"), ["mean_pred", "frac_pos", "n"])
    out = out.unionByName(_keyed("brier", res.brier, F.lit(""), ["brier"]))
    if res.recalibrated is not None:
        after = res.recalibrated.agg(metrics.brier_expr("pd_hat_recal", LABEL), F.avg("pd_hat_recal").alias("avg_pd"))
        out = out.unionByName(_keyed("recalibrated", after, F.lit(""), ["brier", "avg_pd"]))
    return out


def stability_report(
    reference: DataFrame, current: DataFrame, time_col: str = TIME_COL, freq: str = "Q",
    features: Sequence[str] = metrics.DEFAULT_PSI_FEATURES,
) -> DataFrame:
    """PL8: feature drift and the by-period summary in one table
    ``section, metric, key, value``."""
    psi = metrics.psi_features(reference, current, features)
    drift = psi.select(F.lit("feature_psi").alias("section"), F.lit("psi").alias("metric"), F.col("feature").alias("key"), F.col("psi").alias("value"))
    periods = metrics.temporal_summary(current, time_col, freq=freq)
    values = F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in ("avg_pd", "obs_rate", "n")])
    by_period = periods.select("period", F.explode(values).alias("s")).select(
        F.lit("by_period").alias("section"), "s.metric", F.col("period").alias("key"), "s.value"
    )
    return drift.unionByName(by_period)


def monitor(reference: DataFrame, current: DataFrame, time_col: str = TIME_COL, freq: str = "Q") -> DataFrame:
    """PL10: per-period PSI / AUC / Brier with the approval triggers."""
    return metrics.monitor_by_period(reference, current, time_col, "pd_hat", LABEL, freq)
