"""Driver query registry: one callable ``(spark, sf_dir) -> DataFrame`` per
operator family, over the fixture views of :mod:`lendspark.sources.fixtures`.

Floating results that depend on summation order or quantile interpolation
are rounded to :data:`DIGITS` places here and in the oracle SQL alike.
Dates are emitted as text, the target as ``is_default``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import banding, metrics, split
from ..sources import fixtures as fx
from ..sources import io, stages

DIGITS = 6
N_BANDS = 10

Query = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        _REGISTRY[name] = fn
        return fn

    return deco


def queries() -> dict[str, Query]:
    return dict(_REGISTRY)


def rounded(x: Column) -> Column:
    """``F.round(x, DIGITS)``, which goes through decimal text, only for values
    next to a tie or too large for the whole number to be exact enough."""
    scale = float(10**DIGITS)
    whole = F.floor(x * scale + 0.5).cast("double")
    clear = (F.abs(x) < 3e7) & (F.abs(x * scale - whole) < 0.49)
    return F.when(clear, whole / scale).otherwise(F.round(x, DIGITS))


def r(c: str | Column, name: str | None = None) -> Column:
    out = rounded((F.col(c) if isinstance(c, str) else c).cast("double"))
    return out.alias(name or (c if isinstance(c, str) else "value"))


def _scored_with_split(spark: SparkSession, sf: str) -> DataFrame:
    return split.time_split_label(fx.scored(spark, sf), "issue_ts")


def _banded(spark: SparkSession, sf: str) -> DataFrame:
    return banding.assign_bands(fx.scored(spark, sf), "pd_hat", N_BANDS)


# --- banding ---------------------------------------------------------------

@register("band_assign")
def q_band_assign(spark, sf):
    s = fx.scored(spark, sf)
    b = banding.assign_bands(s, "pd_hat", N_BANDS, out="pd_band")
    b = banding.assign_bands(b, "pd_tied", N_BANDS, out="tied_band")
    return b.select("row_id", "pd_band", "tied_band")


@register("band_summary")
def q_band_summary(spark, sf):
    s = banding.band_summary(_banded(spark, sf))
    return s.select(
        "band", "pd_min", "pd_max", r("observed_default_rate"), r("population_share"), "count"
    )


@register("band_metrics")
def q_band_metrics(spark, sf):
    m = banding.band_metrics(banding.band_summary(_banded(spark, sf)))
    return m.select(
        "total_observations", r("overall_default_rate"), "pd_range_min", "pd_range_max",
        "bands_created", r("avg_band_size"), r("calibration_gap"),
    )


@register("band_actions")
def q_band_actions(spark, sf):
    a = banding.band_actions(banding.band_summary(_banded(spark, sf)), N_BANDS)
    return a.select("band", "risk_label", r("calibration_diff"), "calibration", "action")


# --- metrics on a scored table ------------------------------------------------

@register("metric_auc")
def q_metric_auc(spark, sf):
    return metrics.auc(fx.scored(spark, sf)).select(r("auc"))


@register("metric_ks")
def q_metric_ks(spark, sf):
    return metrics.ks(fx.scored(spark, sf)).select(r("ks"))


@register("metric_confusion")
def q_metric_confusion(spark, sf):
    return metrics.precision_recall(fx.scored(spark, sf)).select(r("precision"), r("recall"))


@register("metric_brier")
def q_metric_brier(spark, sf):
    return metrics.brier(fx.scored(spark, sf)).select(r("brier"))


@register("metric_all")
def q_metric_all(spark, sf):
    m = metrics.compute_metrics(fx.scored(spark, sf))
    return m.select(r("auc"), r("ks"), r("precision"), r("recall"), r("brier"))


@register("calibration_width")
def q_calibration_width(spark, sf):
    c = metrics.calibration_curve(fx.scored(spark, sf))
    return c.select("bin", r("frac_pos"), r("mean_pred"), "n")


@register("calibration_quantile")
def q_calibration_quantile(spark, sf):
    c = metrics.calibration_table(fx.scored(spark, sf))
    return c.select("band", r("mean_pred"), r("frac_pos"), "n")


@register("psi_score")
def q_psi_score(spark, sf):
    s = _scored_with_split(spark, sf)
    p = metrics.psi_by_side(s, "pd_hat", "split", "train", "validation")
    return p.select(r("psi"))


def _loans_split(spark, sf):
    return split.time_split_label(fx.loans(spark, sf), "issue_d")


@register("psi_features")
def q_psi_features(spark, sf):
    p = metrics.psi_features_by_side(_loans_split(spark, sf), "split")
    return p.select("feature", r("psi"))


@register("psi_severity")
def q_psi_severity(spark, sf):
    p = metrics.psi_features_by_side(_loans_split(spark, sf), "split")
    return p.select("feature", r("psi"), "severity")


@register("temporal_summary")
def q_temporal_summary(spark, sf):
    t = metrics.temporal_summary(fx.scored(spark, sf), "issue_ts", "pd_hat", "default", "Q")
    return t.select("period", r("avg_pd"), r("obs_rate"), "n")


@register("temporal_summary_monthly")
def q_temporal_summary_monthly(spark, sf):
    t = metrics.temporal_summary(fx.scored(spark, sf), "issue_ts", "pd_hat", "default", "M")
    return t.select("period", r("avg_pd"), r("obs_rate"), "n")


@register("segment_performance")
def q_segment_performance(spark, sf):
    b = _banded(spark, sf)
    seg = metrics.segment_performance(b, metrics.segment_columns(b))
    return seg.select(
        "segment_col", "segment", "n", r("obs_rate"), r("avg_pd"), r("auc"), r("ks"), r("brier")
    )


@register("approval")
def q_approval(spark, sf):
    a = banding.approval(metrics.side_metrics(_scored_with_split(spark, sf)))
    return a.select(r("auc"), r("psi"), r("brier"), "issues", "n_issues", "decision")


@register("monitor_by_period")
def q_monitor_by_period(spark, sf):
    s = _scored_with_split(spark, sf)
    mon = metrics.monitor_by_period(s.where("split = 'train'"), s, "issue_ts")
    return mon.select(
        "period", "n", r("psi"), r("auc"), r("brier"), "psi_trigger", "brier_trigger", "auc_trigger"
    )


# --- splits ----------------------------------------------------------------------

@register("split_time")
def q_split_time(spark, sf):
    s = _scored_with_split(spark, sf)
    return s.where(F.col("split").isNotNull()).select("row_id", "split")


@register("split_counts")
def q_split_counts(spark, sf):
    train, val = split.time_split(fx.scored(spark, sf), "issue_ts")
    both = split.recombine(
        train.withColumn("split", F.lit("train")), val.withColumn("split", F.lit("validation"))
    )
    return metrics.split_counts(both, "split")


@register("split_stratified")
def q_split_stratified(spark, sf):
    s = split.stratified_split(fx.scored(spark, sf), "default", 0.2, order=["row_id"])
    return s.select("row_id", "split")


@register("subsample")
def q_subsample(spark, sf):
    s = split.stratified_subsample(fx.scored(spark, sf), "default", 0.15, order=["row_id"])
    return s.select("row_id", F.col("default").alias("is_default"))


# --- cleaning ------------------------------------------------------------------

from ..operators import clean, target  # noqa: E402

# Headers as a raw export might spell them (for the name normaliser).
MESSY_HEADERS = {
    "row_id": "Row_ID", "loan_amnt": " Loan Amnt ", "int_rate": "Int Rate",
    "revol_util": "Revol Util%", "emp_title": "Emp-Title", "addr_state": "Addr State(2)",
}


def _dates_as_text(df: DataFrame, cols=("issue_d", "earliest_cr_line")) -> DataFrame:
    present = {c: F.date_format(F.col(c), "yyyy-MM-dd") for c in cols if c in df.columns}
    return df.withColumns(present)


@register("clean_names")
def q_clean_names(spark, sf):
    raw = fx.loans_raw(spark, sf)
    messy = raw.toDF(*[MESSY_HEADERS.get(c, c) for c in raw.columns])
    return clean.snake_case_columns(messy)


@register("drop_irrelevant")
def q_drop_irrelevant(spark, sf):
    raw = fx.loans_raw(spark, sf).withColumns(
        {"id": F.col("row_id"), "url": F.concat(F.lit("loan/"), F.col("row_id").cast("string"))}
    )
    return clean.drop_irrelevant_columns(raw)


@register("clean_percent")
def q_clean_percent(spark, sf):
    t = clean.coerce_types(fx.loans_raw(spark, sf), date_fallback=False)
    return t.select("row_id", "int_rate", "revol_util")


@register("clean_term")
def q_clean_term(spark, sf):
    t = clean.coerce_types(fx.loans_raw(spark, sf), date_fallback=False)
    return t.select("row_id", "term", "term_months")


@register("clean_emp_length")
def q_clean_emp_length(spark, sf):
    t = clean.coerce_types(fx.loans_raw(spark, sf), date_fallback=False)
    return t.select("row_id", "emp_length", "emp_length_int")


@register("clean_dates")
def q_clean_dates(spark, sf):
    t = clean.coerce_types(fx.loans_raw(spark, sf), date_fallback="auto")
    return _dates_as_text(t).select("row_id", "issue_d", "earliest_cr_line")


@register("clean_fico")
def q_clean_fico(spark, sf):
    t = clean.coerce_types(fx.loans_raw(spark, sf), date_fallback=False)
    return t.select("row_id", "fico_mean", "loan_amnt", "annual_inc", "dti", "revol_bal")


@register("missing_profile")
def q_missing_profile(spark, sf):
    from ..operators import stats

    return stats.missing_profile(fx.loans_raw(spark, sf)).select("column", r("missing_rate"))


@register("drop_sparse")
def q_drop_sparse(spark, sf):
    return clean.drop_sparse_columns(fx.loans_raw(spark, sf), clean.DEFAULT_DROP_THRESHOLD)


@register("drop_missing_rows")
def q_drop_missing_rows(spark, sf):
    d = clean.drop_missing_rows(fx.loans(spark, sf))
    return d.select("row_id", "loan_status", "loan_amnt", "int_rate", "annual_inc")


@register("impute_clean")
def q_impute_clean(spark, sf):
    d = clean.drop_missing_rows(clean.drop_sparse_columns(fx.loans(spark, sf)))
    out = clean.apply_impute(d, clean.fit_impute(d))
    return _dates_as_text(out)


@register("clean_pipeline")
def q_clean_pipeline(spark, sf):
    return _dates_as_text(clean.clean(fx.loans_raw(spark, sf)))


# --- targets ---------------------------------------------------------------------

@register("target_simple")
def q_target_simple(spark, sf):
    t = target.map_target(fx.loans_raw(spark, sf))
    return t.select("row_id", "loan_status", F.col("default").alias("is_default"))


@register("target_conservative")
def q_target_conservative(spark, sf):
    t = target.define_default_target(fx.loans_raw(spark, sf))
    return t.select("row_id", "loan_status", F.col("default").alias("is_default"))


@register("target_report")
def q_target_report(spark, sf):
    return target.target_report(fx.loans_raw(spark, sf))


def _raw_default_text() -> Column:
    s = F.col("loan_status")
    return (
        F.when(s.isNull(), F.lit(None).cast("string"))
        .when(s == "Default", F.lit("1"))
        .when(s == "Charged Off", F.lit("0.7"))
        .when(s == "Current", F.lit("unknown"))
        .otherwise(F.lit("0"))
    )


@register("target_ensure")
def q_target_ensure(spark, sf):
    raw = fx.loans_raw(spark, sf).withColumn("default", _raw_default_text())
    t = target.ensure_default_target(raw)
    return t.select("row_id", F.col("default").alias("is_default"))


@register("target_ensure_derived")
def q_target_ensure_derived(spark, sf):
    t = target.ensure_default_target(fx.loans_raw(spark, sf))
    return t.select("row_id", F.col("default").alias("is_default"))


@register("drop_leakage")
def q_drop_leakage(spark, sf):
    t, _ = target.remove_leakage_columns(fx.loans_raw(spark, sf))
    return t


# --- features ----------------------------------------------------------------------

from ..operators import encode, features  # noqa: E402

SCALE_COLUMNS = ["loan_amnt", "annual_inc", "dti", "fico_mean", "revol_bal", "installment"]


def _loans_with_target(spark, sf):
    return target.map_target(fx.loans(spark, sf))


@register("feat_ratio")
def q_feat_ratio(spark, sf):
    return features.ratio_features(fx.loans(spark, sf)).select("row_id", "int_rate", "dti_ratio", "lti")


@register("feat_emp_bin")
def q_feat_emp_bin(spark, sf):
    f = features.emp_length_features(fx.loans(spark, sf))
    return f.select("row_id", "emp_length", "emp_length_num", "emp_length_bin")


@register("feat_rate_bin")
def q_feat_rate_bin(spark, sf):
    return features.rate_bin(fx.loans(spark, sf)).select("row_id", "int_rate", "int_rate_bin")


@register("feat_history")
def q_feat_history(spark, sf):
    return features.credit_history_years(fx.loans(spark, sf)).select("row_id", "credit_history_years")


@register("feat_term")
def q_feat_term(spark, sf):
    return features.term_features(fx.loans(spark, sf)).select("row_id", "term_months", "term_long")


@register("feat_interaction")
def q_feat_interaction(spark, sf):
    lo = fx.loans(spark, sf)
    f = features.interaction(lo, features.fit_interaction(lo))
    return f.select("row_id", r("loan_x_int"))


@register("feat_log")
def q_feat_log(spark, sf):
    f = features.log_features(fx.loans(spark, sf))
    return f.select("row_id", *[r(f"{c}_log1p") for c in encode.LOG_COLUMNS])


@register("enc_frequency")
def q_enc_frequency(spark, sf):
    f = encode.frequency_encode(fx.loans(spark, sf), features.FREQ_COLUMNS)
    return f.select("row_id", *[f"{c}{encode.FREQ_SUFFIX}" for c in features.FREQ_COLUMNS])


@register("enc_onehot")
def q_enc_onehot(spark, sf):
    lo = features.scalar_features(fx.loans(spark, sf))
    levels = encode.fit_onehot_levels(lo, features.ONEHOT_COLUMNS, features.CATEGORY_ORDER)
    out = encode.apply_onehot(lo, levels)
    dummies = [c for c in out.columns if c not in lo.columns]
    return out.select("row_id", *[F.col(f"`{d}`") for d in dummies])


@register("enc_target_kfold")
def q_enc_target_kfold(spark, sf):
    lo = _loans_with_target(spark, sf)
    fold = F.pmod(F.col("row_id"), F.lit(5)).cast("int")
    te = encode.kfold_target_encode(lo, "emp_title", "default", fold=fold, n_splits=5)
    return te.select("row_id", r("emp_title_target_te"))


@register("impute_clip")
def q_impute_clip(spark, sf):
    out, p = encode.handle_missing_and_outliers(fx.loans(spark, sf), exclude=("row_id",))
    num = list(p.medians)
    flags = [f"{c}_missing" for c in p.flag_columns]
    logs = [f"{c}_log1p" for c in p.log_columns]
    return out.select("row_id", *[r(c) for c in num], *flags, *[r(c) for c in logs])


@register("scale")
def q_scale(spark, sf):
    lo = _loans_split(spark, sf)
    p = encode.fit_scaler(lo.where("split = 'train'"), SCALE_COLUMNS)
    return encode.apply_scaler(lo, p).select("row_id", *[r(c) for c in SCALE_COLUMNS])


# --- joins -------------------------------------------------------------------------

from ..operators import joins, model  # noqa: E402
from . import pipelines  # noqa: E402


@register("join_labels")
def q_join_labels(spark, sf):
    feats = fx.scored(spark, sf).select("row_id", "loan_amnt")
    labels = target.define_default_target(fx.loans_raw(spark, sf)).select(
        "row_id", F.col("default").alias("target"))
    j = joins.attach_labels(feats, labels, "row_id")
    return j.select("row_id", "loan_amnt", F.col("default").alias("is_default"))


@register("recover_time")
def q_recover_time(spark, sf):
    feats = fx.scored(spark, sf).select("row_id", "pd_hat")
    cleaned = fx.loans(spark, sf).select("row_id", "issue_d")
    j = joins.recover_time_column(feats, cleaned, "issue_d", "row_id")
    return _dates_as_text(j, ("issue_d",)).select("row_id", "pd_hat", "issue_d")


# --- models and pipelines (rows-only at the driver) ------------------------------------

def _model_ready(spark, sf, fold=None):
    return pipelines.features_conservative(clean.clean(fx.loans_raw(spark, sf)), fold=fold).table


def _fold5():
    return F.pmod(F.col("row_id"), F.lit(5)).cast("int")


@register("feat_model_ready")
def q_feat_model_ready(spark, sf):
    t = _model_ready(spark, sf, fold=_fold5())
    num = [c for c, d in t.dtypes if d == "double"]
    return t.select(
        *[r(c) if c in num else F.col(f"`{c}`") for c in t.columns if c not in ("issue_d", "default")],
        F.col("default").alias("is_default"),
        F.date_format("issue_d", "yyyy-MM-dd").alias("issue_d"),
    )


@register("train_score")
def q_train_score(spark, sf):
    feats = _model_ready(spark, sf)
    res = pipelines.train(feats, tune=False)
    scored = pipelines.score(feats, res.selected)
    return scored.select("row_id", r("pd_hat"), F.col("default").alias("is_default"))


@register("tune_select")
def q_tune_select(spark, sf):
    feats = _model_ready(spark, sf)
    res = pipelines.train(feats, tune=True)
    return res.decision.withColumn("best_c", F.lit(res.best_c).cast("double"))


@register("recalibrate")
def q_recalibrate(spark, sf):
    s = fx.scored(spark, sf)
    return model.recalibrate(s, "pd_hat", "default", order=["row_id"]).select("row_id", "pd_hat", r("pd_hat_recal"))


@register("train_logistic")
def q_train_logistic(spark, sf):
    m = model.train_logistic(fx.scored(spark, sf), ["loan_amnt", "dti"], "default", tol=1e-10)
    rows = [("intercept", m.intercept), *zip(m.feature_cols, m.coefficients, strict=True)]
    return spark.createDataFrame(rows, "feature string, coefficient double").select("feature", r("coefficient"))


# --- stored inputs and parameters (IO1-IO7) --------------------------------------------

def _folder(spark, label):
    return f"{stages.stage_root(spark)}/{label}-{uuid.uuid4().hex}"


@register("io_round_trip")
def q_io_round_trip(spark, sf):
    """Quoted CSV with line breaks written, read in ranges, typed, landed and read back."""
    path = _folder(spark, "csv")
    note = F.concat(F.lit('say "it",\nrow '), F.col("row_id").cast("string"))
    raw = fx.loans_raw(spark, sf).withColumn("note", note)
    writer = raw.write.option("header", True).option("escape", '"')
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    io.land(io.read_raw_csv(spark, path, key="row_id"), f"{path}-landed")
    back = io.read_table(spark, f"{path}-landed")
    text = ["loan_status", "int_rate", "term", "emp_length", "issue_d", "home_ownership", "emp_title", "note"]
    return back.select("row_id", *text, "fico_range_low", r("loan_amnt"), r("annual_inc"), r("dti"))


@register("io_outlier_params")
def q_io_outlier_params(spark, sf):
    """Imputation and clip parameters stored, loaded and applied."""
    path, loans = _folder(spark, "outliers"), fx.loans(spark, sf)
    encode.save_outlier_params(spark, encode.fit_missing_and_outliers(loans, exclude=("row_id",)), path)
    p = encode.load_outlier_params(spark, path)
    out = encode.apply_missing_and_outliers(loans, p)
    flags = [f"{c}_missing" for c in p.flag_columns]
    return out.select("row_id", *[r(c) for c in p.medians], *flags, *[r(f"{c}_log1p") for c in p.log_columns])


@register("io_scaler")
def q_io_scaler(spark, sf):
    path, lo = _folder(spark, "scaler"), _loans_split(spark, sf)
    encode.scaler_table(spark, encode.fit_scaler(lo.where("split = 'train'"), SCALE_COLUMNS)).write.parquet(path)
    return encode.apply_scaler(lo, encode.load_scaler(spark, path)).select("row_id", *[r(c) for c in SCALE_COLUMNS])


@register("io_model")
def q_io_model(spark, sf):
    path = _folder(spark, "model")
    model.train_logistic(fx.scored(spark, sf), ["loan_amnt", "dti"], "default", tol=1e-10).save(spark, path)
    m = model.PDModel.load(spark, path)
    rows = [("intercept", m.intercept), *zip(m.feature_cols, m.coefficients, strict=True)]
    return spark.createDataFrame(rows, "feature string, coefficient double").select("feature", r("coefficient"))


# --- reports ---------------------------------------------------------------------------

@register("validate_report")
def q_validate_report(spark, sf):
    """PL6: all validation tables from one pass over the scored rows."""
    s = _scored_with_split(spark, sf)
    res = pipelines.validate(s.where("split = 'validation'"), s.where("split = 'train'"), time_col="issue_ts")
    return pipelines.full_validation_report(res).select("section", "key", "metric", r("value"))


@register("calibrate_report")
def q_calibrate_report(spark, sf):
    res = pipelines.calibrate(fx.scored(spark, sf), apply=True, order=["row_id"])
    return pipelines.calibration_report(res).select("section", "key", "metric", r("value"))


@register("performance_report")
def q_performance_report(spark, sf):
    """PL3, PL4: time split, fit and metrics on two features."""
    feats = fx.scored(spark, sf).select("row_id", "loan_amnt", "dti", "default", F.col("issue_ts").cast("timestamp").alias("issue_d"))
    res = pipelines.train(feats, tune=False)
    return pipelines.performance_report(spark, res).select("section", "metric", r("value"))


@register("monitor_state")
def q_monitor_state(spark, sf):
    """PL10 from a state that periods are added to, one of them twice."""
    s = _scored_with_split(spark, sf)
    state = metrics.MonitorState(spark, _folder(spark, "monitor"), "issue_ts")
    state.set_reference(s.where("split = 'train'"))
    early = F.col("issue_ts") < F.lit("1996-01-01").cast("timestamp")
    for part in (s.where(early), s.where(~early), s.where(early)):
        state.put(part)
    return state.report().select("period", "n", r("psi"), r("auc"), r("brier"), "psi_trigger", "brier_trigger", "auc_trigger")


@register("enc_onehot_sparse")
def q_enc_onehot_sparse(spark, sf):
    lo = features.scalar_features(fx.loans(spark, sf))
    cols = [*features.ONEHOT_COLUMNS, "emp_title"]
    vocabulary = encode.fit_onehot_vocabulary(lo, cols, features.CATEGORY_ORDER)
    out = encode.apply_onehot_sparse(lo.select("row_id", *cols), vocabulary)
    return out.select("row_id", F.col("onehot.size").alias("size"), F.array_join(F.col("onehot.indices").cast("array<string>"), ",").alias("indices"))


@register("feature_summary")
def q_feature_summary(spark, sf):
    s = metrics.feature_summary(_loans_with_target(spark, sf), "default", top=10)
    return s.select("section", "metric", r("value"))


@register("band_report")
def q_band_report(spark, sf):
    res = pipelines.band(fx.scored(spark, sf), N_BANDS)
    return res.summary.join(res.actions, "band").select(
        "band", "pd_min", "pd_max", r("observed_default_rate"), r("population_share"), "count",
        "risk_label", "calibration", "action")


@register("features_split")
def q_features_split(spark, sf):
    fr = pipelines.features_split(clean.clean(fx.loans_raw(spark, sf)), 0.2, fold=_fold5(), order=["row_id"])
    t = fr.table
    cols = [c for c in t.columns if c not in ("row_id", "default", "split", "issue_d")]
    day = F.date_format("issue_d", "yyyy-MM-dd").alias("issue_d")
    return t.select("row_id", F.col("default").alias("is_default"), "split", day, *[r(c) for c in cols])


# --- inputs the plain fixtures lack: missing scores, NaN, text dates, ties --------------------


@register("band_assign_continuous")
def q_band_assign_continuous(spark, sf):
    """One distinct score per row, and a score that is zero for half of the rows."""
    s = fx.scored(spark, sf).select("row_id", fx.continuous_score().alias("p"), fx.half_zero_score().alias("z"))
    b = banding.assign_bands(banding.assign_bands(s, "p", N_BANDS, out="p_band"), "z", N_BANDS, out="z_band")
    return b.select("row_id", "p_band", "z_band")


@register("band_summary_unscored")
def q_band_summary_unscored(spark, sf):
    s = fx.scored(spark, sf).withColumn("pd_hat", F.when(F.col("row_id") % 4 != 0, F.col("pd_hat")))
    summary = banding.band_summary(banding.assign_bands(s, "pd_hat", N_BANDS))
    total = banding.band_metrics(summary).select("total_observations", r("overall_default_rate"))
    return summary.select("band", "count", r("population_share")).crossJoin(F.broadcast(total))


def _with_nan(df, column):
    """NaN in every fifth row and NULL in every seventh."""
    k = F.col("row_id")
    v = F.col(column).cast("double")
    return df.withColumn(column, F.when(k % 7 == 0, F.lit(None)).when(k % 5 == 0, F.lit(float("nan"))).otherwise(v))


@register("psi_nan")
def q_psi_nan(spark, sf):
    s = _with_nan(_scored_with_split(spark, sf), "pd_hat")
    return metrics.psi_by_side(s, "pd_hat", "split", "train", "validation").select(r("psi"))


@register("impute_nan")
def q_impute_nan(spark, sf):
    s = _with_nan(fx.scored(spark, sf).select("row_id", "dti", "loan_amnt"), "dti")
    out, _ = encode.handle_missing_and_outliers(s, exclude=("row_id",))
    return out.select("row_id", r("dti"), "dti_missing")


@register("feat_history_text")
def q_feat_history_text(spark, sf):
    t = features.credit_history_years(fx.loans_raw(spark, sf).select("row_id", "issue_d", "earliest_cr_line"))
    return t.select("row_id", "credit_history_years")


@register("folds")
def q_folds(spark, sf):
    f = split.stratified_folds(fx.scored(spark, sf), "default", 3, order=["row_id"])
    return f.select("row_id", "fold")


@register("clean_apply_frozen")
def q_clean_apply_frozen(spark, sf):
    """Cleaning learned on four fifths of the rows, applied to the others."""
    raw = fx.loans_raw(spark, sf)
    _, params = clean.fit_clean(raw.where("row_id % 5 <> 0"), date_fallback=False)
    return _dates_as_text(clean.apply_clean(raw.where("row_id % 5 = 0"), params))


@register("train_inputs")
def q_train_inputs(spark, sf):
    """Target and time brought to a bare feature table by key."""
    feats = fx.scored(spark, sf).select("row_id", "loan_amnt")
    cleaned = fx.loans(spark, sf).select("row_id", "loan_status", "issue_d")
    t = pipelines.train_inputs(feats, None, cleaned)
    return _dates_as_text(t, ("issue_d",)).select("row_id", "loan_amnt", F.col("default").alias("is_default"), "issue_d")
