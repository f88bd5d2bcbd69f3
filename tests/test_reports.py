"""One-pass validation, monitor state, sparse one-hot."""

import pytest
from pyspark.sql import functions as F

from lendspark.operators import encode, features, metrics, split
from lendspark.plans import pipelines
from lendspark.sources import fixtures as fx

from conftest import SF_SMALL


def rows(df, *by):
    return [tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in (df.orderBy(*by) if by else df).collect()]


def sides(spark):
    s = split.time_split_label(fx.scored(spark, SF_SMALL), "issue_ts")
    return s.where("split = 'validation'"), s.where("split = 'train'")


def test_one_pass_equals_separate_tables(spark):
    va, tr = sides(spark)
    va = va.withColumn("pd_hat", F.when(F.col("row_id") % 13 != 0, F.col("pd_hat"))).withColumn("grade", F.when(F.col("row_id") % 7 != 0, F.col("grade")))
    res = pipelines.validate(va, tr, time_col="issue_ts")
    assert rows(res.metrics) == rows(metrics.compute_metrics(va).select("auc", "ks", "brier"))
    assert rows(res.psi_score) == rows(metrics.psi(tr, va, "pd_hat"))
    assert rows(res.psi_features, "feature") == rows(metrics.psi_features(tr, va), "feature")
    assert rows(res.temporal, "period") == rows(metrics.temporal_summary(va, "issue_ts"), "period")
    by = ("segment_col", "segment")
    assert rows(res.segments, *by) == rows(metrics.segment_performance(va, metrics.segment_columns(va)), *by)


def test_scored_rows_are_read_once(spark, tmp_path):
    """The tables read counts: the scored table can go after the call."""
    va, tr = sides(spark)
    path = f"{tmp_path}/scored"
    va.write.parquet(path)
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    counted = spark.read.parquet(path)
    n = counted.count()
    counted = counted.mapInArrow(count, counted.schema)
    res = pipelines.validate(counted, tr, time_col="issue_ts")
    for table in (res.metrics, res.psi_score, res.psi_features, res.temporal, res.segments, res.approval):
        table.collect()
    assert seen.value == n


def test_validate_without_training_rows(spark):
    va, _ = sides(spark)
    res = pipelines.validate(va.select("row_id", "pd_hat", "default"))
    assert res.psi_score is None and res.temporal is None and res.segments.count() == 0
    assert res.approval.first()["psi"] is None


def test_monitor_state_adds_periods(spark, tmp_path):
    va, tr = sides(spark)
    both = tr.unionByName(va)
    state = metrics.MonitorState(spark, str(tmp_path), "issue_ts")
    state.set_reference(tr)
    year = F.year("issue_ts")
    years = sorted(r[0] for r in both.select(year).where("issue_ts is not null").distinct().collect())
    for y in years:
        state.put(both.where(year == y))
    whole = rows(metrics.monitor_by_period(tr, both, "issue_ts"), "period")
    assert rows(state.report(), "period") == whole
    # Again, and a corrected period: only its partition changes.
    before = {r["file"] for r in state.counts().select(F.col("_metadata.file_path").alias("file"), "period").distinct().collect()}
    last = both.where(year == years[-1]).withColumn("default", 1 - F.col("default"))
    state.put(last)
    after = {r["file"] for r in state.counts().select(F.col("_metadata.file_path").alias("file"), "period").distinct().collect()}
    kept = [f for f in before if f"period={years[-1]}" not in f]
    assert set(kept) <= after and len(kept) < len(before)
    fixed = both.where(year != years[-1]).unionByName(last)
    assert rows(state.report(), "period") == rows(metrics.monitor_by_period(tr, fixed, "issue_ts"), "period")


def test_sparse_one_hot_equals_dense(spark):
    lo = features.scalar_features(fx.loans(spark, SF_SMALL)).select("row_id", *features.ONEHOT_COLUMNS).where("row_id < 3000")
    levels = encode.fit_onehot_levels(lo, features.ONEHOT_COLUMNS, features.CATEGORY_ORDER)
    dense = encode.apply_onehot(lo, levels)
    names = [c for c in dense.columns if c != "row_id"]
    vocabulary = encode.fit_onehot_vocabulary(lo, features.ONEHOT_COLUMNS, features.CATEGORY_ORDER)
    assert vocabulary.size == len(names)
    sparse = encode.apply_onehot_sparse(lo, vocabulary)
    assert sparse.columns == ["row_id", "onehot"]
    want = {r["row_id"]: [i for i, c in enumerate(names) if r[c]] for r in dense.collect()}
    got = {r["row_id"]: list(r["onehot"]["indices"]) for r in sparse.collect()}
    assert got == want
    assert all(len(r["onehot"]["values"]) == len(r["onehot"]["indices"]) for r in sparse.take(20))
    unseen = spark.createDataFrame([(1, "NOBODY", None, "x", "y")], "row_id long, home_ownership string, purpose string, int_rate_bin string, emp_length_bin string")
    (r,) = encode.apply_onehot_sparse(unseen, vocabulary).collect()
    assert [names[i] for i in r["onehot"]["indices"]] == ["purpose_nan"]


def test_dense_one_hot_refuses_many_levels(spark):
    df = spark.range(50).select(F.col("id").cast("string").alias("v"))
    assert len(encode.fit_onehot_levels(df, ["v"], max_levels=50)["v"]) == 50
    with pytest.raises(ValueError, match="levels"):
        encode.fit_onehot_levels(df, ["v"], max_levels=49)
    assert encode.fit_onehot_vocabulary(df, ["v"]).size == 50
