"""End-to-end: raw CSV -> cleaned -> features -> train / tune -> score ->
bands -> validation -> calibration -> monitor, on the smallest fixture."""

import pytest
from pyspark.sql import functions as F

from lendspark.operators import clean, model
from lendspark.plans import pipelines
from lendspark.sources import fixtures as fx
from lendspark.sources import io

from conftest import SF_SMALL


def test_full_chain(spark, tmpdir_path):
    raw = fx.loans_raw(spark, SF_SMALL)
    raw.write.option("header", True).csv(tmpdir_path + "/raw")
    landed = io.read_raw_csv(spark, tmpdir_path + "/raw", key="row_id")
    io.land(landed, tmpdir_path + "/landed")
    cleaned = clean.clean(io.read_table(spark, tmpdir_path + "/landed"))
    assert cleaned.columns[0] == "loan_status"
    assert "mths_since_last_record" not in cleaned.columns      # 70% missing
    assert "total_pymnt" not in cleaned.columns                 # post-funding amount
    assert cleaned.where(F.col("dti").isNull()).count() == 0

    fr = pipelines.features_conservative(cleaned)
    feats = fr.table
    assert {"default", "issue_d", "lti", "emp_title_target_te"} <= set(feats.columns)
    assert dict(feats.dtypes)["issue_d"] == "timestamp"
    io.land(feats, tmpdir_path + "/features")
    feats = io.read_table(spark, tmpdir_path + "/features")

    res = pipelines.train(feats, tune=True, Cs=(0.1, 1.0), folds=2, frac=0.5)
    assert res.best_c in (0.1, 1.0)
    assert res.train_rows > 0 and res.validation_rows > 0
    dec = res.decision.first()
    assert dec["selected"] in ("baseline", "tuned")
    res.selected.save(spark, tmpdir_path + "/model")
    loaded = model.PDModel.load(spark, tmpdir_path + "/model")

    scored = pipelines.score(feats, loaded)
    assert scored.count() == res.validation_rows
    b = pipelines.band(scored)
    assert b.summary.agg(F.sum("count")).first()[0] == res.validation_rows

    val = pipelines.validate(scored)
    m = val.metrics.first()
    assert 0 <= m["auc"] <= 1 and 0 <= m["ks"] <= 1
    assert val.approval.first()["decision"] in (
        "Approve with conditions", "Conditional approval - address concerns")

    cal = pipelines.calibrate(scored, apply=True)
    assert cal.recalibrated.where(F.col("pd_hat_recal").isNull()).count() == 0

    rep = pipelines.performance_report(spark, res)
    assert rep.where("metric = 'training_rows'").first()["value"] == res.train_rows

    train_part, _ = __import__("lendspark.operators.split", fromlist=["x"]).time_split(feats, "issue_d")
    train_scored = model.score(loaded, train_part)
    mon = pipelines.monitor(train_scored, scored)
    assert mon.count() > 0


def test_train_scope_learns_on_train_rows_only(spark):
    cleaned = clean.clean(fx.loans_raw(spark, SF_SMALL))
    one = pipelines.features_split(cleaned, fit_scope="train")
    train = one.table.where("split = 'train'")
    assert train.count() > 0 and "issue_d" in one.table.columns
    alone = one.table.where("split = 'test'").count()
    assert train.count() + alone == cleaned.count()
    # The interaction's median is that of the training rows.
    ids = train.select("row_id")
    rates = cleaned.join(ids, "row_id").agg(F.percentile("int_rate", F.lit(0.5))).first()[0]
    assert one.feature_params.rate_median == rates


def test_stability_report(spark):
    s = fx.scored(spark, SF_SMALL)
    rep = pipelines.stability_report(s, s, "issue_ts", features=["loan_amnt", "dti"]).collect()
    assert {r["key"] for r in rep if r["section"] == "feature_psi"} == {"loan_amnt", "dti"}
    assert sum(r["value"] for r in rep if r["metric"] == "n") == s.count()


def test_split_table_feeds_training(spark):
    fr = pipelines.features_split(clean.clean(fx.loans_raw(spark, SF_SMALL)))
    res = pipelines.train(fr.table.drop("split"), tune=False)
    assert res.train_rows > 0 and res.validation_rows > 0


def test_features_split_route(spark):
    cleaned = clean.clean(fx.loans_raw(spark, SF_SMALL))
    fr = pipelines.features_split(cleaned, test_size=0.2)
    t = fr.table
    counts = {r["split"]: r["count"] for r in t.groupBy("split").count().collect()}
    n = cleaned.count()
    assert counts["test"] == -(-n * 2 // 10)  # ceil(0.2 n)
    train = t.where("split = 'train'")
    # scaled on train: mean ~0, population std ~1 for a varying column
    st = train.agg(F.avg("loan_amnt").alias("a"), F.stddev_pop("loan_amnt").alias("s")).first()
    assert abs(st["a"]) < 1e-9 and abs(st["s"] - 1) < 1e-9


def test_wide_projections_run_compiled(spark):
    """The feature table's projections are cut into methods that the JVM compiles."""
    from lendspark.session import METHOD_LIMIT, compile_wide_rows

    spark.conf.unset(METHOD_LIMIT)
    pipelines.features_split(clean.clean(fx.loans_raw(spark, SF_SMALL)))
    assert int(spark.conf.get(METHOD_LIMIT)) == 8000
    spark.conf.set(METHOD_LIMIT, "6000")
    compile_wide_rows(spark)
    assert int(spark.conf.get(METHOD_LIMIT)) == 6000
    spark.conf.unset(METHOD_LIMIT)


def test_rounding_is_that_of_spark(spark):
    from pyspark.sql import functions as F

    from lendspark.plans.registry import rounded

    values = [0.0, -0.0, 0.0000005, -0.0000005, 1.0000015, 2.5e-7, -1e-9, 123456.7890125, 1e15, 1e300, float("inf"), float("-inf"), float("nan"), None]
    values += [k * 0.37123457 - 40 for k in range(500)] + [(2 * k + 1) / 2e6 for k in range(500)]
    rows = spark.createDataFrame([(v,) for v in values], "x double").select("x", rounded(F.col("x")).alias("a"), F.round("x", 6).alias("b")).collect()
    assert all(str(r["a"]) == str(r["b"]) for r in rows), [r for r in rows if str(r["a"]) != str(r["b"])]


def test_mean_and_deviation_of_shifted_parts(spark):
    import numpy as np

    from lendspark.operators import model, stats

    rng = np.random.default_rng(3)
    x = 1e6 + rng.random(4000)
    rows = [(float(v) if k % 5 else None, float(k % 3), None, int(k % 2), k % 4) for k, v in enumerate(x)]
    df = spark.createDataFrame(rows, "x double, y double, z double, default int, fold int").repartition(5)
    got = stats.mean_std_pop(df, ["x", "y", "z"])
    known = x[np.arange(4000) % 5 > 0]
    assert got["x"] == (pytest.approx(known.mean(), rel=1e-12), pytest.approx(known.std(), rel=1e-9)) and got["z"] == (None, None)
    ts = model.training_set(df.drop("z"), ["x", "y"], fold=df["fold"])
    out = ts.moments_without(2)
    keep = np.arange(4000) % 4 != 2
    assert out.classes.tolist() == [(keep & (np.arange(4000) % 2 == 0)).sum(), (keep & (np.arange(4000) % 2 == 1)).sum()]
    assert out.scaler(["x", "y"]).scales["x"] == pytest.approx(x[keep & (np.arange(4000) % 5 > 0)].std(), rel=1e-9)
