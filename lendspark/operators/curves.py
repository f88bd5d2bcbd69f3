"""Exact running sums / ranks in a global order without a single-partition window.

A window with no ``partitionBy`` moves every row into one task. The
two-level scheme used here keeps the result exact and the work spread out:

1. rows are dealt by range of (partition columns, order columns) and written
   once with the number of their range; the ranges follow the data;
2. totals per (partition, range), a tiny table, and their running offsets;
3. a window inside each range for the running sum, plus the range's offset.

Used by AUC / KS (overall and per segment) and by one-hot vocabularies.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.nulls import nan_to_null
from ..sources.stages import stage


def running_sums(
    df: DataFrame,
    order_cols: Sequence[str],
    value_cols: Sequence[str],
    partition_cols: Sequence[str] = (),
    descending: bool = False,
    prefix: str = "cum_",
    with_totals: bool = False,
) -> DataFrame:
    """Inclusive running sums of ``value_cols`` in ``order_cols`` order.

    ``(partition_cols, order_cols)`` must identify a row. Returns ``df``
    plus ``{prefix}{v}`` (and the partition totals ``tot_{v}`` when
    ``with_totals``).
    """
    part = list(partition_cols)
    ranged = df.repartitionByRange(*part, *order_cols).withColumn("_bucket", F.spark_partition_id())
    bucketed = stage(ranged, "ranges")

    def ordered(cols):
        return [F.col(c).desc() if descending else F.col(c).asc() for c in cols]

    totals = bucketed.groupBy(*part, "_bucket").agg(
        *[F.sum(v).alias(f"_tot_{v}") for v in value_cols]
    )
    w_off = (
        Window.partitionBy(*part)
        .orderBy(F.col("_bucket").desc() if descending else F.col("_bucket").asc())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = totals.select(
        *part,
        "_bucket",
        *[F.coalesce(F.sum(f"_tot_{v}").over(w_off), F.lit(0)).alias(f"_off_{v}") for v in value_cols],
        *[
            F.sum(f"_tot_{v}").over(Window.partitionBy(*part) if part else Window.partitionBy(F.lit(0))).alias(
                f"tot_{v}"
            )
            for v in (value_cols if with_totals else [])
        ],
    )
    # One row per (partition, range): with ranges in partition order at most
    # as many as there are ranges and partitions together. The planner joins
    # it by its size.
    joined = bucketed.join(offsets, on=[*part, "_bucket"], how="inner")
    w_in = (
        Window.partitionBy(*part, "_bucket")
        .orderBy(*ordered(order_cols))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return joined.select(
        *[F.col(f"`{c}`") for c in df.columns],
        *[(F.sum(v).over(w_in) + F.col(f"_off_{v}")).alias(f"{prefix}{v}") for v in value_cols],
        *[F.col(f"tot_{v}") for v in (value_cols if with_totals else [])],
    )


def score_counts(df: DataFrame, score: str, label: str, keys: Sequence[str] = ()) -> DataFrame:
    """``(keys, _v, n, labelled, pos)`` per distinct score (NaN is missing),
    missing scores included: one pass, from which every score metric follows."""
    y = F.col(label).cast("long")
    return df.groupBy(*keys, nan_to_null(F.col(score)).alias("_v")).agg(
        F.count(F.lit(1)).alias("n"), F.count(y).alias("labelled"), F.coalesce(F.sum(y), F.lit(0)).alias("pos")
    )


def roc_points(counts: DataFrame, partition_cols: Sequence[str] = ()) -> DataFrame:
    """Distinct scores (per partition) with ``pos, neg`` and the running
    ``cum_pos, cum_neg`` in descending score order (ties folded together),
    from :func:`score_counts`. Missing scores and labels are ignored."""
    part = list(partition_cols)
    points = counts.where(F.col("_v").isNotNull() & (F.col("labelled") > 0)).select(
        *part, F.col("_v").alias("_score"), "pos", (F.col("labelled") - F.col("pos")).alias("neg")
    )
    return running_sums(points, ["_score"], ["pos", "neg"], part, descending=True, with_totals=True)


def auc_ks(df: DataFrame, score: str, label: str, partition_cols: Sequence[str] = ()) -> DataFrame:
    """:func:`auc_ks_of_counts` of a scored table."""
    return auc_ks_of_counts(score_counts(df, score, label, partition_cols), partition_cols)


def auc_ks_of_counts(counts: DataFrame, partition_cols: Sequence[str] = ()) -> DataFrame:
    """Tie-aware ROC AUC and KS (max |TPR - FPR|), one row per partition.

    AUC = sum over distinct scores of ``neg * (cum_pos_before + pos / 2)`` /
    ``(P * N)``; the numerator is accumulated exactly as
    ``sum(neg * (2 * cum_pos_before + pos))`` in decimal(38,0).
    NULL when a class is absent.
    """
    part = list(partition_cols)
    pts = roc_points(counts, part)
    dec = "decimal(38,0)"
    num = F.col("neg").cast(dec) * (
        F.lit(2).cast(dec) * (F.col("cum_pos") - F.col("pos")).cast(dec) + F.col("pos").cast(dec)
    )
    frac_gap = F.abs(
        F.try_divide(F.col("cum_pos").cast("double"), F.col("tot_pos").cast("double"))
        - F.try_divide(F.col("cum_neg").cast("double"), F.col("tot_neg").cast("double"))
    )
    agg = pts.groupBy(*part).agg(
        F.sum(num).alias("_num"),
        F.max("tot_pos").alias("_P"),
        F.max("tot_neg").alias("_N"),
        F.max(frac_gap).alias("_ks"),
    )
    valid = (F.col("_P") > 0) & (F.col("_N") > 0)
    out = agg.select(
        *part,
        F.when(
            valid,
            F.col("_num").cast("double")
            / (F.lit(2.0) * F.col("_P").cast("double") * F.col("_N").cast("double")),
        ).alias("auc"),
        F.when(valid, F.col("_ks")).alias("ks"),
    )
    return out
