"""Model tolerance against a direct Newton solve, recalibration shape,
persistence round trips and contract errors."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lendspark.operators import model
from lendspark.plans import pipelines
from lendspark.sources import fixtures as fx
from lendspark.sources import io

from conftest import SF_SMALL


def newton_logistic(X, y, w, C):
    """Minimise C * sum(w * logloss) + 0.5 * ||beta||^2 (intercept free)."""
    n, d = X.shape
    Xb = np.hstack([X, np.ones((n, 1))])
    beta = np.zeros(d + 1)
    reg = np.eye(d + 1)
    reg[-1, -1] = 0.0
    for _ in range(100):
        p = 1 / (1 + np.exp(-Xb @ beta))
        g = C * Xb.T @ (w * (p - y)) + reg @ beta
        H = C * (Xb * (w * p * (1 - p))[:, None]).T @ Xb + reg
        step = np.linalg.solve(H, g)
        beta -= step
        if np.abs(step).max() < 1e-12:
            break
    return beta


def test_logistic_matches_newton(spark):
    s = fx.scored(spark, SF_SMALL).select("row_id", "loan_amnt", "dti", "default")
    m = model.train_logistic(s, ["loan_amnt", "dti"], "default", C=1.0, tol=1e-12, max_iter=500)
    pdf = s.toPandas()
    X = pdf[["loan_amnt", "dti"]].to_numpy(float)
    X = (X - X.mean(0)) / X.std(0)
    y = pdf["default"].to_numpy(float)
    n1 = y.sum()
    n0 = len(y) - n1
    w = np.where(y == 1, len(y) / (2 * n1), len(y) / (2 * n0))
    beta = newton_logistic(X, y, w, 1.0)
    got = np.r_[m.coefficients, m.intercept]
    assert np.abs(got - beta).max() < 1e-5


def test_platt_is_monotone_sigmoid(spark):
    s = fx.scored(spark, SF_SMALL)
    cal = model.fit_platt(s, "pd_hat", "default")
    out = cal.apply(s).select("pd_hat", "pd_hat_recal").orderBy("pd_hat").toPandas()
    z = np.log(out.pd_hat_recal / (1 - out.pd_hat_recal))
    # affine in the score
    coef = np.polyfit(out.pd_hat, z, 1)
    assert np.abs(np.polyval(coef, out.pd_hat) - z).max() < 1e-8
    assert (np.diff(out.pd_hat_recal) >= -1e-15).all() == (cal.a >= 0)


def test_model_save_load(spark, tmpdir_path):
    s = fx.scored(spark, SF_SMALL).select("row_id", "loan_amnt", "dti", "default")
    m = model.train_logistic(s, ["loan_amnt", "dti"], "default")
    m.save(spark, tmpdir_path + "/m")
    m2 = model.PDModel.load(spark, tmpdir_path + "/m")
    a = model.score(m, s).select("row_id", "pd_hat").orderBy("row_id").collect()
    b = model.score(m2, s).select("row_id", "pd_hat").orderBy("row_id").collect()
    assert a == b


def test_csv_landing_round_trip(spark, tmpdir_path):
    raw = fx.loans_raw(spark, SF_SMALL)
    raw.drop("row_id").write.option("header", True).csv(tmpdir_path + "/raw_csv")
    df = io.read_raw_csv(spark, tmpdir_path + "/raw_csv")
    io.land(df, tmpdir_path + "/landed")
    back = io.read_table(spark, tmpdir_path + "/landed")
    assert back.count() == raw.count()
    assert back.select("row_id").distinct().count() == raw.count()
    # empty CSV fields are NA tokens -> NULL, like the raw NULLs
    assert back.where(F.col("loan_status").isNull()).count() == raw.where(F.col("loan_status").isNull()).count()
    assert io.read_optional(spark, tmpdir_path + "/does_not_exist") is None


def test_contract_errors(spark):
    s = fx.scored(spark, SF_SMALL)
    with pytest.raises(ValueError):
        pipelines.band(s.drop("pd_hat"))
    with pytest.raises(ValueError):
        pipelines.validate(s.drop("default"))
    with pytest.raises(KeyError):
        from lendspark.operators import split

        split.time_split(s, "no_such_col")


def test_feature_params_round_trip_and_apply(spark, tmpdir_path):
    from lendspark.operators import clean, encode, features, target

    df = target.map_target(clean.clean(fx.loans_raw(spark, SF_SMALL)))
    built, params = features.build_features(df, target="default")
    params.save(spark, tmpdir_path + "/fp")
    loaded = features.FeatureParams.load(spark, tmpdir_path + "/fp")
    applied = features.apply_features(df, loaded)
    assert applied.columns == built.columns
    cols = [c for c in built.columns if c != "emp_title_target_te"]
    a = built.select(*[F.col(f"`{c}`") for c in cols]).orderBy("row_id").collect()
    b = applied.select(*[F.col(f"`{c}`") for c in cols]).orderBy("row_id").collect()
    assert a == b
    # scoring-time target encoding: the value's mean over all training rows
    te = {r["emp_title"]: r["m"] for r in df.groupBy(F.coalesce("emp_title", F.lit("missing")).alias("emp_title"))
          .agg(F.avg(F.col("default").cast("double")).alias("m")).collect()}
    got = {r["emp_title"]: r["emp_title_target_te"] for r in applied.select("emp_title", "emp_title_target_te")
           .distinct().collect()}
    assert all(abs(got[k] - te[k]) < 1e-12 for k in got)
    # unseen values fall back to the global mean
    new = df.limit(3).withColumn("emp_title", F.lit("never seen title"))
    gm = df.agg(F.avg(F.col("default").cast("double"))).first()[0]
    vals = [r["emp_title_target_te"] for r in features.apply_features(new, loaded).collect()]
    assert all(abs(v - gm) < 1e-12 for v in vals)

    op = encode.fit_missing_and_outliers(built, exclude=("row_id", "default"))
    encode.save_outlier_params(spark, op, tmpdir_path + "/op")
    op2 = encode.load_outlier_params(spark, tmpdir_path + "/op")
    assert op2.medians == op.medians and op2.bounds == op.bounds
    assert set(op2.flag_columns) == set(op.flag_columns) and set(op2.log_columns) == set(op.log_columns)


def test_missing_artifact_raises(spark, tmpdir_path):
    from lendspark.operators import clean, features, target

    df = target.map_target(clean.clean(fx.loans_raw(spark, SF_SMALL)))
    _, params = features.build_features(df, target="default")
    params.freq_tables.pop("addr_state")
    params.save(spark, tmpdir_path + "/a")
    assert "addr_state" not in features.FeatureParams.load(spark, tmpdir_path + "/a").freq_tables
    spark.createDataFrame([("freq", "addr_state")], "kind string, column string") \
        .write.mode("append").parquet(tmpdir_path + "/a/parts")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        features.FeatureParams.load(spark, tmpdir_path + "/a")


def test_clean_params_round_trip(spark, tmpdir_path):
    from lendspark.operators import clean

    raw = fx.loans_raw(spark, SF_SMALL)
    fitted, params = clean.fit_clean(raw)
    params.save(spark, tmpdir_path + "/clean")
    loaded = clean.CleanParams.load(spark, tmpdir_path + "/clean")
    assert loaded == params
    again = clean.apply_clean(raw, loaded)
    assert again.columns == fitted.columns
    assert sorted(map(repr, again.collect())) == sorted(map(repr, fitted.collect()))


def test_best_of_grid_passes_over_nan():
    nan = float("nan")
    assert model.best_of_grid([(0.1, nan), (1.0, 0.7), (10.0, 0.7)]) == 1.0
    with pytest.raises(ValueError):
        model.best_of_grid([(0.1, nan)])


def test_csv_fields_with_line_breaks_and_index_column(spark, tmpdir_path):
    import os

    os.makedirs(tmpdir_path + "/csv")
    with open(tmpdir_path + "/csv/x.csv", "w") as f:
        f.write(',a,b\n7,"one\ntwo",NaN\n8,three,2.5\n')
    t = io.read_table(spark, tmpdir_path + "/csv/x.csv")
    assert sorted(t.collect()) == [(7, "one\ntwo", None), (8, "three", 2.5)] and t.columns[0] == "row_id"
    assert io.read_raw_csv(spark, tmpdir_path + "/csv/x.csv").count() == 2


def test_grid_fits_match_separate_newton(spark):
    """All folds and all C in shared passes, each with the scaler and weights
    of its own training part."""
    from lendspark.operators import split

    cols = ["loan_amnt", "dti", "term_months"]
    s = split.stratified_folds(fx.scored(spark, SF_SMALL).select("row_id", *cols, "default").fillna(0), "default", 3, out="_fold")
    grid = [(C, k) for C in (0.01, 1.0) for k in (None, 0, 1, 2)]
    models = model.newton_fits(model.training_set(s, cols, "default", F.col("_fold")), grid, tol=1e-10)
    pdf = s.toPandas()
    for (C, k), m in zip(grid, models):
        part = pdf[pdf["_fold"] != (-1 if k is None else k)]
        X = part[cols].to_numpy(float)
        X = (X - X.mean(0)) / X.std(0)
        y = part["default"].to_numpy(float)
        w = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (len(y) - y.sum())))
        beta = newton_logistic(X, y, w, C)
        assert np.abs(np.r_[m.coefficients, m.intercept] - beta).max() < 1e-7


def test_l1_fit_meets_its_optimality_conditions(spark):
    cols = ["loan_amnt", "dti", "term_months"]
    s = fx.scored(spark, SF_SMALL).select(*cols, "default").fillna(0)
    C = 0.01
    m = model.train_logistic(s, cols, "default", C=C, penalty="l1", class_weight=None, tol=1e-12)
    pdf = s.toPandas()
    X = pdf[cols].to_numpy(float)
    X = (X - X.mean(0)) / X.std(0)
    y, b = pdf["default"].to_numpy(float), np.array(m.coefficients)
    g = X.T @ (1 / (1 + np.exp(-(X @ b + m.intercept))) - y)
    assert abs((1 / (1 + np.exp(-(X @ b + m.intercept))) - y).sum()) < 1e-6
    for j in range(3):
        assert abs(g[j] + np.sign(b[j]) / C) < 1e-5 if b[j] else abs(g[j]) <= 1 / C + 1e-6


def test_many_tasks_add_up(spark, monkeypatch):
    s = fx.scored(spark, SF_SMALL).select("loan_amnt", "dti", "default")
    one = model.train_logistic(s, ["loan_amnt", "dti"])
    monkeypatch.setattr(model, "DIRECT", 2)
    many = model.train_logistic(s.repartition(9), ["loan_amnt", "dti"])
    assert np.abs(np.r_[one.coefficients, one.intercept] - np.r_[many.coefficients, many.intercept]).max() < 1e-9


def test_missing_feature_is_an_error(spark):
    s = spark.createDataFrame([(1.0, 0), (None, 1), (2.0, 1), (0.5, 0)], "x double, default int")
    with pytest.raises(ValueError):
        model.train_logistic(s, ["x"])
    m = model.train_logistic(s.where("x is not null"), ["x"])
    with pytest.raises(Exception, match="missing"):
        model.score(m, s).collect()


def test_platt_matches_direct_newton(spark):
    """Against a fit of all calibration rows, ties and an all-negative part."""
    rng = np.random.default_rng(1)
    rows = [(k, float(round(x, 2)), int(rng.random() < x)) for k, x in enumerate(rng.random(800))]
    df = spark.createDataFrame(rows, "row_id long, p double, y int")
    cal = model.fit_platt(df, "p", "y", 0.5, order=["row_id"])
    from lendspark.operators import split

    part = split.stratified_split(df, "y", 0.5, order=["row_id"]).where("split = 'train'").toPandas()
    pos, neg = (part.y == 1).sum(), (part.y == 0).sum()
    t = np.where(part.y == 1, (pos + 1) / (pos + 2), 1 / (neg + 2))
    p = 1 / (1 + np.exp(-(cal.a * part.p + cal.b)))
    assert abs(((p - t) * part.p).sum()) < 1e-7 and abs((p - t).sum()) < 1e-7
    none = model.fit_platt(spark.createDataFrame([(k, k / 50, 0) for k in range(50)], "row_id long, p double, y int"), "p", "y", 0.5)
    assert abs(none.a) < 1e-6
