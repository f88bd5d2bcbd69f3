"""Edge cases of the parsers and bin helpers (hand-made inputs)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lendspark.functions import bins, parse
from lendspark.operators import banding, clean, encode, features, target


def one_col(spark, values, dtype="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {dtype}")


def col_values(df, c="y"):
    return [r[c] for r in df.orderBy("i").collect()]


def test_percent_strict(spark):
    df = one_col(spark, ["13.5%", "1,234.56%", None, "nan"])
    assert col_values(df.select("i", parse.parse_percent_strict("x").alias("y"))) == [13.5, 1234.56, None, None]


def test_percent_strict_raises_on_text(spark):
    df = one_col(spark, ["abc"])
    with pytest.raises(Exception):
        df.select(parse.parse_percent_strict("x")).collect()


def test_term(spark):
    df = one_col(spark, [" 36 months", "none", None, "60"])
    assert col_values(df.select("i", parse.extract_term("x").alias("y"))) == [36.0, None, None, 60.0]


def test_emp_length_clean(spark):
    vals = ["< 1 year", "10+ years", "5.5 years", "<1 year", "n/a", "1 year", "3 years", None]
    got = col_values(one_col(spark, vals).select("i", parse.emp_length_clean("x").alias("y")))
    assert got == [0.0, 10.0, 5.5, None, None, 1.0, 3.0, None]


def test_emp_length_feature(spark):
    vals = ["< 1 year", "<1 year", "10+ years", "5.5 years", "Unknown", "n/a", "2 years", None]
    got = col_values(one_col(spark, vals).select("i", parse.emp_length_feature("x").alias("y")))
    assert got == [0.0, 0.0, 10.0, None, None, None, 2.0, None]


def test_emp_bin_edges(spark):
    vals = [-1.0, 0.0, 2.0, 2.5, 5.0, 9.0, 10.0, 101.0, None]
    df = one_col(spark, vals, "double").select(
        "i", bins.label_bin(F.coalesce(F.col("x"), F.lit(-1.0)), features.EMP_BIN_EDGES,
                            features.EMP_BIN_LABELS).alias("y"))
    assert col_values(df) == ["missing", "0-2", "0-2", "3-5", "3-5", "6-9", "10+", "missing", "missing"]


def test_rate_bin_edges(spark):
    vals = [0.0, 8.0, 12.0, 16.0, 20.0, 20.1, 100.0, -1.0, None]
    df = features.rate_bin(one_col(spark, vals, "double").withColumnRenamed("x", "int_rate"))
    got = [r["int_rate_bin"] for r in df.orderBy("i").collect()]
    assert got == ["<8", "<8", "8-12", "12-16", "16-20", ">=20", ">=20", "missing", "missing"]


def test_history_floors_negative_spans(spark):
    a = dt.datetime(2020, 1, 2, 0, 0)
    rows = [(0, a, a - dt.timedelta(days=1) + dt.timedelta(hours=1)),
            (1, a, a + dt.timedelta(days=1, hours=1))]
    df = spark.createDataFrame(rows, "i int, issue_d timestamp, earliest_cr_line timestamp")
    got = [r["credit_history_years"] for r in features.credit_history_years(df).orderBy("i").collect()]
    assert got == [0.0, -2 / 365.25]


def test_quantile_band_matches_qcut(spark):
    vals = [1, 1, 1, 2, 2, 3, 4, 5, 5, 5]
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(vals)], "i int, p double")
    got = [r["b"] for r in banding.assign_bands(df, "p", 5, out="b").orderBy("i").collect()]
    assert got == [0, 0, 0, 0, 0, 1, 2, 2, 2, 2]


def test_histogram_bin_left_closed(spark):
    vals = [0.0, 1.0, 1.0, 2.0, 3.0, None, 9.0]
    df = one_col(spark, vals, "double").select(
        bins.histogram_bin(F.col("x"), bins.lit_array([0, 1, 2, 3])).alias("b"))
    counts = {r["b"]: r["count"] for r in df.groupBy("b").count().collect()}
    assert counts == {0: 1, 1: 2, 2: 2, None: 2}


def test_map_target_and_conservative(spark):
    df = spark.createDataFrame([(0, "Default after paid"), (1, "Current"), (2, None), (3, "Charged Off")],
                               "row_id int, loan_status string")
    t1 = {r["row_id"]: r["default"] for r in target.map_target(df).collect()}
    assert t1 == {0: 1, 1: 0, 2: 0, 3: 1}
    t2 = {r["row_id"]: r["default"] for r in target.define_default_target(df).collect()}
    assert t2 == {0: 0, 3: 1}


def test_ensure_target_truncates(spark):
    df = spark.createDataFrame([(0, "0.7"), (1, None), (2, "1"), (3, "x")], "row_id int, default string")
    got = {r["row_id"]: r["default"] for r in target.ensure_default_target(df).collect()}
    assert got == {0: 0, 1: 0, 2: 1, 3: 0}
    with pytest.raises(KeyError):
        target.ensure_default_target(df.drop("default"))


def test_onehot_names(spark):
    df = spark.createDataFrame([(0, "b"), (1, "a"), (2, None), (3, "c")], "row_id int, x string")
    lv = encode.fit_onehot_levels(df, ["x"])
    out = encode.apply_onehot(df, lv)
    assert out.columns == ["row_id", "x_b", "x_c", "x_nan"]
    assert [tuple(r)[1:] for r in out.orderBy("row_id").collect()] == [(1, 0, 0), (0, 0, 0), (0, 0, 1), (0, 1, 0)]


def test_snake_case_and_collision(spark):
    df = spark.createDataFrame([(1, 2)], "`Loan Amnt` int, `Int Rate%` int")
    assert clean.snake_case_columns(df).columns == ["loan_amnt", "int_rate_pct"]
    with pytest.raises(ValueError):
        clean.snake_case_columns(spark.createDataFrame([(1, 2)], "`A b` int, `a_b` int"))


def test_date_fallback_only_when_needed(spark):
    iso = [("2015-12-01",), ("2016-01-15",), ("Dec-2015",), (None,)]
    df = spark.createDataFrame(iso, "issue_d string")
    assert clean.date_fallback_columns(df) == ["issue_d"]          # 75% fail the month format
    got = [r["issue_d"] for r in clean.coerce_types(df).collect()]
    assert [g.strftime("%Y-%m-%d") if g else None for g in got] == ["2015-12-01", "2016-01-15", "2015-12-01", None]
    mostly_months = spark.createDataFrame([("Dec-2015",)] * 19 + [("2015-12-01",)], "issue_d string")
    assert clean.date_fallback_columns(mostly_months) == []         # 5% fail: no fallback
    assert clean.coerce_types(mostly_months).where("issue_d IS NULL").count() == 1


def test_leakage_report(spark):
    df = spark.createDataFrame([(1, 2.0, 3.0, "x")], "row_id int, recoveries double, total_pymnt double, a string")
    out, removed = target.remove_leakage_columns(df)
    assert out.columns == ["row_id", "a"]
    assert [r["dropped_column"] for r in target.leakage_report(spark, removed).orderBy("position").collect()] == \
        ["recoveries", "total_pymnt"]


def test_lookup_joins_raise_on_duplicate_keys(spark):
    from lendspark.operators import joins

    feats = spark.createDataFrame([(1, 0.5), (2, 0.7)], "row_id long, x double")
    labels = spark.createDataFrame([(1, 1), (2, 0)], "row_id long, target int")
    got = {r["row_id"]: r["default"] for r in joins.attach_labels(feats, labels).collect()}
    assert got == {1: 1, 2: 0}
    dup = labels.unionByName(spark.createDataFrame([(1, 0)], "row_id long, target int"))
    with pytest.raises(Exception):
        joins.attach_labels(feats, dup).collect()
    clean_t = spark.createDataFrame([(1, "Dec-2015"), (2, "Jan-2016")], "row_id long, issue_d string")
    rec = joins.recover_time_column(feats, clean_t, "issue_d", "row_id")
    assert {r["row_id"]: r["issue_d"].month for r in rec.collect()} == {1: 12, 2: 1}
