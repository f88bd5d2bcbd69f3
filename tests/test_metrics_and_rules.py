"""Metric properties, brute-force checks and the published golden rules."""

import numpy as np
from pyspark.sql import functions as F

from lendspark.operators import banding, curves, encode, metrics, split
from lendspark.sources import fixtures as fx

from conftest import SF_SMALL


def brute_auc_ks(y, p):
    y = np.asarray(y)
    p = np.asarray(p)
    pos, neg = p[y == 1], p[y == 0]
    gt = (pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()
    auc = gt / (len(pos) * len(neg))
    ks = 0.0
    for t in np.unique(p):
        tpr = (pos >= t).mean()
        fpr = (neg >= t).mean()
        ks = max(ks, abs(tpr - fpr))
    return auc, ks


def test_auc_ks_brute_force(spark):
    s = fx.scored(spark, SF_SMALL)
    rows = s.select("default", "pd_hat").collect()
    a, k = brute_auc_ks([r[0] for r in rows], [r[1] for r in rows])
    got = curves.auc_ks(s, "pd_hat", "default").first()
    assert abs(got["auc"] - a) < 1e-12
    assert abs(got["ks"] - k) < 1e-12


def test_auc_symmetry_and_ks_range(spark):
    s = fx.scored(spark, SF_SMALL).withColumn("q", 1 - F.col("pd_tied"))
    a1 = metrics.auc(s, "pd_tied").first()["auc"]
    a2 = metrics.auc(s, "q").first()["auc"]
    assert abs(a1 + a2 - 1) < 1e-12
    k = metrics.ks(s, "pd_tied").first()["ks"]
    assert 0 <= k <= 1


def test_segment_auc_single_class_is_null(spark):
    df = spark.createDataFrame([("a", 0.1, 1), ("a", 0.2, 1), ("b", 0.3, 0), ("b", 0.9, 1)],
                               "g string, pd_hat double, default int")
    res = {r["segment"]: r for r in metrics.segment_performance(df, ["g"]).collect()}
    assert res["a"]["auc"] is None and res["b"]["auc"] == 1.0


def test_psi_identical_is_zero(spark):
    s = fx.scored(spark, SF_SMALL)
    assert abs(metrics.psi(s, s, "pd_hat").first()["psi"]) < 1e-12


def test_psi_single_edge_is_null(spark):
    df = spark.createDataFrame([(1.0,), (1.0,)], "pd_hat double")
    assert metrics.psi(df, df, "pd_hat").first()["psi"] is None


def test_band_counts_sum_and_tied_bands(spark):
    s = fx.scored(spark, SF_SMALL)
    b = banding.assign_bands(s, "pd_tied", 10, out="b")
    assert b.select("b").distinct().count() == 5
    summ = banding.band_summary(banding.assign_bands(s, "pd_hat", 10))
    assert summ.agg(F.sum("count")).first()[0] == s.count()


def test_band_totals_cover_unscored_rows(spark):
    df = spark.createDataFrame([(i, None if i % 4 == 0 else i / 100, i % 2) for i in range(100)], "row_id int, pd_hat double, default int")
    summ = banding.band_summary(banding.assign_bands(df, "pd_hat", 5))
    assert abs(summ.agg(F.sum("population_share")).first()[0] - 0.75) < 1e-12
    m = banding.band_metrics(summ).first()
    assert m["total_observations"] == 100 and m["overall_default_rate"] == 0.5


def test_folds_are_even_per_class(spark):
    s = fx.scored(spark, SF_SMALL)
    got = split.stratified_folds(s, "default", 3).groupBy("default", "fold").count().collect()
    for y in (0, 1):
        sizes = [r["count"] for r in got if r["default"] == y]
        assert len(sizes) == 3 and max(sizes) - min(sizes) <= 1


def test_psi_ignores_nan(spark):
    s = fx.scored(spark, SF_SMALL).select("row_id", "pd_hat")
    part = F.col("row_id") % 5 == 0
    holes = s.withColumn("pd_hat", F.when(part, F.lit(float("nan"))).otherwise(F.col("pd_hat")))
    assert metrics.psi(holes, s, "pd_hat").first()["psi"] == metrics.psi(s.where(~part), s, "pd_hat").first()["psi"]


def test_time_split_disjoint(spark):
    s = split.time_split_label(fx.scored(spark, SF_SMALL), "issue_ts")
    c = {r["split"]: r["count"] for r in s.groupBy("split").count().collect()}
    assert c[None] == s.where("issue_ts IS NULL").count()
    assert c["train"] + c["validation"] + c[None] == s.count()


def test_stratified_split_shares(spark):
    s = fx.scored(spark, SF_SMALL)
    out = split.stratified_split(s, "default", 0.2)
    n = s.count()
    n_test = out.where("split = 'test'").count()
    assert n_test == int(np.ceil(0.2 * n))
    by = {(r["default"], r["split"]): r["count"] for r in out.groupBy("default", "split").count().collect()}
    share_all = s.where("default = 1").count() / n
    share_test = by[(1, "test")] / n_test
    assert abs(share_all - share_test) < 2 / n_test


def test_out_of_fold_encoding_ignores_own_fold(spark):
    df = spark.createDataFrame([(0, "a", 1, 0), (1, "a", 0, 1), (2, "a", 1, 1), (3, "b", 1, 0)],
                               "row_id int, v string, y int, f int")
    out = encode.kfold_target_encode(df, "v", "y", fold=F.col("f"), n_splits=2)
    got = {r["row_id"]: r["v_target_te"] for r in out.collect()}
    assert got[0] == 0.5          # folds 1 rows of 'a': y = 0, 1
    assert got[1] == 1.0          # fold 0 rows of 'a': y = 1
    assert got[3] == 0.75         # 'b' absent elsewhere -> global mean


def test_approval_golden(spark):
    # Published run: AUC 0.93, PSI not available, Brier 0.2494.
    r = banding.approval_from_values(spark, 0.9299, None, 0.2494).first()
    assert r["decision"] == "Conditional approval - address concerns"
    assert r["issues"] == "Calibration concerns (high Brier score)"
    ok = banding.approval_from_values(spark, 0.0, None, 0.1).first()
    assert ok["decision"] == "Approve with conditions"


def test_band_actions_golden(spark):
    # Published band 0 (0.0587%) and band 9 (11.0454%) observed rates.
    df = spark.createDataFrame([(0, 0.0, 0.017459, 0.000587), (9, 0.9312, 1.0, 0.110454)],
                               "band int, pd_min double, pd_max double, observed_default_rate double")
    rows = {r["band"]: r for r in banding.band_actions(df, 10).collect()}
    assert rows[0]["risk_label"] == "Minimal Risk"
    assert rows[0]["calibration"] == "Well calibrated"
    assert rows[0]["action"].startswith("**Auto-approve** - Minimal risk")
    assert rows[9]["risk_label"] == "Extreme Risk"
    assert rows[9]["calibration"] == "Over-predicting risk"
    assert rows[9]["action"].startswith("**Manual review required**")
    many = df.select(banding.risk_label(F.lit(11), 12).alias("x")).first()["x"]
    assert many == "Band 11"


def test_quantiles_equal_percentile(spark):
    from lendspark.operators import quantiles

    s = fx.loans(spark, SF_SMALL)
    cols = ["loan_amnt", "dti", "annual_inc", "fico_mean"]
    probs = [0.0, 0.01, 0.3 + 1e-17, 0.5, 0.8, 0.99, 1.0]
    got = quantiles.quantiles(s, cols, probs)
    arr = F.array(*[F.lit(p) for p in probs])
    want = s.agg(*[F.percentile(F.col(c).cast("double"), arr).alias(c) for c in cols]).first()
    assert got == {c: list(want[c]) for c in cols}


def test_quantiles_of_nothing_nan_and_ties(spark):
    from lendspark.operators import quantiles

    nan = float("nan")
    df = spark.createDataFrame([(1.0, None, nan), (1.0, None, 2.0), (nan, None, 4.0), (5.0, None, None)], "a double, b double, c double")
    assert quantiles.quantiles(df, ["a", "b", "c"], [0.0, 0.5, 1.0]) == {
        "a": [1.0, 1.0, 5.0], "b": [None, None, None], "c": [2.0, 3.0, 4.0]}
    assert quantiles.quantiles(df.limit(0), ["a"], [0.5]) == {"a": [None]}


def test_order_statistics_of_structs_by_series(spark):
    from lendspark.operators.quantiles import order_statistics

    rows = [("x", i % 7, i) for i in range(200)] + [(None, 3, 1)]
    df = spark.createDataFrame(rows, "k string, a int, b int").select(F.col("k").alias("_k"), F.struct("a", "b").alias("_v"))
    got = order_statistics(df, lambda sizes: {k: {0, n - 1, n // 2} for k, n in sizes.items()})
    want = sorted((a, b) for k, a, b in rows if k == "x")
    assert {r: tuple(v) for r, v in got["x"][1].items()} == {0: want[0], 199: want[199], 100: want[100]}
    assert got[None][0] == 1 and tuple(got[None][1][0]) == (3, 1)


def test_calibration_arrays_in_bin_order(spark):
    s = fx.scored(spark, SF_SMALL)
    row = metrics.compute_metrics(s, with_calibration=True).first()
    curve = metrics.calibration_curve(s).orderBy("bin").collect()
    assert row["frac_pos"] == [c["frac_pos"] for c in curve]
    assert row["mean_pred"] == [c["mean_pred"] for c in curve]


def test_validation_report_rows(spark):
    from lendspark.plans import pipelines

    s = split.time_split_label(fx.scored(spark, SF_SMALL), "issue_ts")
    tr = s.where("split = 'train'").withColumn("fico_mean", F.col("dti"))
    va = s.where("split = 'validation'").withColumn("fico_mean", F.col("dti"))
    res = pipelines.validate(va, tr, time_col="issue_ts")
    rep = {(r["section"], r["metric"]): r["value"] for r in pipelines.validation_report(res).collect()}
    assert {("out_of_time", "auc"), ("psi", "psi"), ("feature_psi", "loan_amnt"), ("approval", "n_issues")} <= set(rep)


def test_fixture_band_counts_and_cutoff(spark):
    """Expected values stated with the fixtures at sf0.01."""
    from conftest import SF_ORACLE

    s = fx.scored(spark, SF_ORACLE)
    counts = [r["count"] for r in banding.band_summary(banding.assign_bands(s)).orderBy("band").collect()]
    assert counts == [1501, 1500, 1500, 1499, 1501, 1500, 1499, 1501, 1500, 1499]
    assert split.time_cutoff(s, "issue_ts") == 955497600000000
    c = {r["split"]: r["count"] for r in split.time_split_label(s, "issue_ts").groupBy("split").count().collect()}
    assert (c["train"], c["validation"]) == (11831, 2957)
