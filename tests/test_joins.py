"""Lookup join with heavy keys apart."""

import pytest
from pyspark.sql import functions as F

from lendspark.operators.joins import heavy_keys, lookup_join


@pytest.fixture
def plain(spark):
    """No adaptive execution and no broadcast by size, so tasks show the deal."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def rows(spark, n=8000):
    """Half of the keys are one value, a tenth null, the others spread."""
    key = F.when(F.col("id") % 10 < 5, F.lit("hot")).when(F.col("id") % 10 < 9, F.concat(F.lit("k"), (F.col("id") % 397).cast("string")))
    return spark.range(n).select(F.col("id").alias("row_id"), key.alias("k"))


def lookup(left):
    return left.filter("k is not null").groupBy("k").agg(F.count("*").alias("n"), F.min("row_id").alias("first")).filter("first % 7 <> 3")


def test_equals_left_join(spark, plain):
    left = rows(spark)
    right = lookup(left)
    got = sorted(map(tuple, lookup_join(left, right, "k").collect()), key=repr)
    want = sorted(map(tuple, left.join(right, "k", "left").select("row_id", "k", "n", "first").collect()), key=repr)
    assert got == want


def test_heavy_keys_are_bounded(spark):
    found = heavy_keys(rows(spark), "k", 8).collect()
    assert [(r["_heavy"], r["_n"]) for r in found] == [("hot", 4000)]
    assert heavy_keys(rows(spark).limit(0), "k", 8).count() == 0


def test_no_task_holds_the_heavy_key(spark, plain):
    left = rows(spark)
    joined = lookup_join(left, lookup(left), "k")
    sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert len(sizes) == 8 and max(sizes) <= 2 * sorted(sizes)[len(sizes) // 2]


def test_encoders_deal_a_hot_value(spark, plain):
    """Half of emp_title missing: frequency and target encoding leave no task
    with over twice the median rows."""
    from lendspark.operators import encode

    title = F.when(F.col("id") % 2 == 0, F.concat(F.lit("job"), (F.col("id") % 999).cast("string")))
    df = spark.range(16_000).select(F.col("id").alias("row_id"), title.alias("emp_title"), (F.col("id") % 3 == 0).cast("int").alias("default"))
    for out in (encode.frequency_encode(df, ["emp_title"]), encode.kfold_target_encode(df, "emp_title", "default")):
        sizes = sorted(r["count"] for r in out.groupBy(F.spark_partition_id().alias("p")).count().collect())
        assert len(sizes) == 8 and sizes[-1] <= 2 * sizes[4]


def test_target_encoding_leaves_null_targets_out(spark):
    from lendspark.operators import encode

    rows = [(0, "a", 1), (1, "a", None), (2, "a", 1), (3, "a", 0), (4, "b", None), (5, "b", None)]
    df = spark.createDataFrame(rows, "row_id long, v string, default int")
    fold = (F.col("row_id") % 2).cast("int")
    out, enc, _ = encode.fit_apply_target_encoding(df, "v", "default", fold, 2, freq_out="n")
    got = {r["row_id"]: (r["v_target_te"], r["n"]) for r in out.collect()}
    # Fold 0 of 'a' has 1, 1; fold 1 has null, 0. 'b' has no target: the global mean.
    assert got[0] == got[2] == (0.0, 4.0) and got[1] == got[3] == (1.0, 4.0)
    assert got[4] == got[5] == (2 / 3, 2.0)
    new = encode.apply_target_encoding_new(df, "v", enc, 0.25)
    assert {r["row_id"]: r["v_target_te"] for r in new.collect()}[0] == 2 / 3
