"""Runs that resume, and stage tables bucketed by key."""

import pytest
from pyspark.sql import functions as F

from lendspark.operators import joins
from lendspark.plans import pipelines
from lendspark.sources import fixtures as fx
from lendspark.sources import stages
from lendspark.sources.stages import Run, stage, stage_by_key

from conftest import SF_SMALL


class Killed(Exception):
    pass


def chain(spark, die_after=None):
    """Four stages, each from the one before; the driver dies after some."""
    df = spark.range(100).select(F.col("id").alias("row_id"))
    for k in range(4):
        if k == die_after:
            raise Killed
        df = stage(df.withColumn(f"c{k}", F.col("row_id") + k), f"step-{k}")
    return df


def test_a_killed_run_resumes(spark, tmp_path):
    source = f"{tmp_path}/in"
    spark.range(5).write.parquet(source)
    make = lambda **p: Run(spark, f"{tmp_path}/runs", [source], p)
    with pytest.raises(Killed), make(seed=1) as run:
        chain(spark, die_after=2)
    assert (run.taken, run.written) == (0, 2)
    with make(seed=1) as run:
        out = chain(spark)
    assert (run.taken, run.written) == (2, 2)
    assert sorted(map(tuple, out.collect())) == sorted((i, i, i + 1, i + 2, i + 3) for i in range(100))
    with make(seed=1) as run:
        chain(spark)
    assert (run.taken, run.written) == (4, 0)
    with make(seed=2) as other:
        chain(spark)
    assert (other.taken, other.written) == (0, 4)
    # Changed inputs are another run.
    spark.range(6).write.mode("overwrite").parquet(source)
    assert make(seed=1).name != run.name


def test_clean_up_removes_what_was_cut_off(spark, tmp_path, monkeypatch):
    with Run(spark, str(tmp_path)) as run:
        chain(spark)
    spark.range(3).write.parquet(f"{run.folder}/0009-cut-off")
    assert run.clean_up() == [f"{run.folder}/0009-cut-off"]
    with Run(spark, str(tmp_path)) as again:
        assert chain(spark).count() == 100
    assert again.taken == 4
    assert again.clean_up(everything=True) == [run.folder]
    assert Run(spark, str(tmp_path)).manifest == {}
    # Outside a run, stages are as before.
    assert stage(spark.range(3), "plain").count() == 3


def test_feature_pipeline_resumes(spark, tmp_path):
    from lendspark.operators import clean

    def features():
        cleaned = clean.clean(fx.loans_raw(spark, SF_SMALL))
        return pipelines.features_conservative(cleaned).table

    with Run(spark, str(tmp_path), [f"{SF_SMALL}/orders.parquet"]) as first:
        a = features().orderBy("row_id").collect()
    with Run(spark, str(tmp_path), [f"{SF_SMALL}/orders.parquet"]) as second:
        b = features().orderBy("row_id").collect()
    assert a == b
    assert first.written > 3 and (second.taken, second.written) == (first.written, 0)


def test_keyed_tables_join_without_exchange(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        loans = fx.loans(spark, SF_SMALL).select("row_id", "loan_amnt")
        extra = fx.loans(spark, SF_SMALL).select("row_id", "issue_d", (F.col("row_id") % 2).alias("target"))
        left, right = stage_by_key(loans, buckets=4), stage_by_key(extra, buckets=4)
        for made, plain in (
            (joins.attach_labels(left, right.select("row_id", "target")), joins.attach_labels(loans, extra.select("row_id", "target"))),
            (joins.recover_time_column(left, right), joins.recover_time_column(loans, extra)),
        ):
            assert "Exchange" not in made._jdf.queryExecution().executedPlan().toString().replace("AQEShuffleRead", "")
            assert sorted(map(tuple, made.collect())) == sorted(map(tuple, plain.collect()))
        assert "Exchange" in plain._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_duplicate_keys_still_raise_on_keyed_tables(spark):
    left = stage_by_key(spark.range(4).select(F.col("id").alias("row_id")), buckets=2)
    right = stage_by_key(spark.createDataFrame([(1, 0), (1, 1)], "row_id long, target int"), buckets=2)
    with pytest.raises(Exception, match="duplicate key"):
        joins.attach_labels(left, right).collect()
    assert stages.fingerprint(spark, f"{SF_SMALL}/orders.parquet")[0][1] > 0
