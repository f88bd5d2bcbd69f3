"""Key joins (J1, J2) and the labels lookup (IO8).

Row identity is an explicit key (``row_id``); positional alignment of two
distributed tables has no meaning and is not offered. The right side of
every lookup must be unique per key: duplicates raise inside the job
(``raise_error``) instead of silently multiplying rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.parse import parse_date_fallback, parse_month_date
from ..sources.stages import stage


def heavy_keys(left: DataFrame, key: str, parts: int | None = None) -> DataFrame:
    """(key, n): the values of ``key`` that more than one ``parts``-th of the
    rows of ``left`` have; at most ``parts`` rows, written as a stage table."""
    parts = parts or int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = stage(left.filter(F.col(f"`{key}`").isNotNull()).groupBy(F.col(f"`{key}`").alias("_heavy")).agg(F.count(F.lit(1)).alias("_n")), "key-counts")
    total = counts.agg(F.sum("_n")).first()[0] or 0
    return counts.filter(F.col("_n") * parts > total)


def lookup_join(
    left: DataFrame, right: DataFrame, key: str, heavy: DataFrame | None = None, weight: str | None = None,
    row_key: str = "row_id",
) -> DataFrame:
    """Left join of ``right`` (one row per value of ``key``) without a hot task.

    The values of :func:`heavy_keys` go through a broadcast of at most one row
    for each shuffle partition. The rest is joined by key as the planner
    chooses; rows whose key is heavy or null are dealt by the hash of ``row_key``
    there (of the whole row without it), since they match nothing. A null key matches nothing. ``left``
    is read once more to count its keys, unless ``heavy`` (from
    :func:`heavy_keys`) is given, or ``weight``, the column of ``right`` that
    holds how many rows have each key.
    """
    parts = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    values = [c for c in right.columns if c != key]
    bundle = F.struct(*[F.col(f"`{c}`") for c in values])
    total = right.agg(F.sum(f"`{weight}`")).first()[0] or 0 if weight else None
    right = right.select(F.col(f"`{key}`").alias("_key"), bundle.alias("_row"))
    # Bounded: fewer than ``parts`` values can each hold over a parts-th of the rows.
    if weight:
        hot = right.where(F.col("_row")[weight] * parts > F.lit(total)).withColumn("_heavy", F.col("_key"))
    else:
        heavy = heavy_keys(left, key, parts) if heavy is None else heavy
        hot = heavy.select("_heavy").join(right, F.col("_heavy") == F.col("_key"))
    hot = hot.select("_heavy", F.col("_row").alias("_hot"))
    k = F.col(f"`{key}`")
    names = left.columns
    marked = left.join(F.broadcast(hot), k == F.col("_heavy"), "left")
    by = [row_key] if row_key in names else [f.name for f in left.schema.fields if not f.dataType.simpleString().startswith("map")]
    hashed = [F.col(f"`{c}`") for c in by]
    apart = F.pmod(F.xxhash64(*hashed), F.lit(parts)) + 1
    marked = marked.withColumn("_spread", F.when(F.col("_heavy").isNotNull() | k.isNull(), apart).otherwise(F.lit(0).cast("long")))
    # Zero, but no literal: the optimizer would take a literal out of the join's keys.
    rest = right.withColumn("_zero", F.pmod(F.xxhash64("_key"), F.lit(1)).cast("long"))
    joined = marked.join(rest, (k == F.col("_key")) & (F.col("_spread") == F.col("_zero")), "left")
    row = F.coalesce(F.col("_hot"), F.col("_row"))
    return joined.select(*[F.col(f"`{c}`") for c in names], *[row.getField(c).alias(c) for c in values])


def unique_by_key(df: DataFrame, key: str, value_cols: Sequence[str], what: str = "lookup") -> DataFrame:
    """One row per ``key``; raises at run time when a key repeats. The
    aggregate is hash-partitioned on the key, which the following join
    reuses (no extra shuffle of this side)."""
    agg = df.groupBy(key).agg(
        F.count(F.lit(1)).alias("_dup"), *[F.first(c).alias(c) for c in value_cols]
    )
    # The check sits in a filter predicate so it is always evaluated (a
    # projected-then-dropped column would be pruned by the optimizer).
    fail = F.when(F.col("_dup") > 1, F.raise_error(
        F.concat(F.lit(f"duplicate key in {what}: "), F.col(key).cast("string"))))
    return agg.where(fail.isNull()).drop("_dup")


def attach_labels(
    features: DataFrame,
    labels: DataFrame,
    key: str = "row_id",
    label_col: str | None = None,
    out: str = "default",
) -> DataFrame:
    """J1 / IO8: left join the label column onto the features by key and
    name it ``out``. The label is ``target`` when present, else the first
    non-key column."""
    if label_col is None:
        others = [c for c in labels.columns if c != key]
        if not others:
            raise ValueError("labels table has no label column")
        label_col = "target" if "target" in others else others[0]
    right = unique_by_key(labels.select(key, label_col), key, [label_col], "labels")
    joined = features.join(right, on=key, how="left")
    return joined.withColumnRenamed(label_col, out) if label_col != out else joined


def recover_time_column(
    df: DataFrame, clean: DataFrame | None, time_col: str = "issue_d", key: str = "row_id"
) -> DataFrame:
    """Bring ``time_col`` back from the cleaned table by a left join on
    ``key`` (right side unique per key). ``df`` comes back unchanged when it
    has the column or there is no cleaned table with it; a key that either
    side lacks is an error."""
    if time_col in df.columns or clean is None or time_col not in clean.columns:
        return df
    for side, table in (("features", df), ("cleaned table", clean)):
        if key not in table.columns:
            raise KeyError(f"{side}: no key column {key!r} to bring {time_col!r} back by")
    right = unique_by_key(clean.select(key, time_col), key, [time_col], "time lookup")
    dt = clean.schema[time_col].dataType.simpleString()
    if dt.startswith("timestamp") or dt == "date":
        t = F.col(time_col).cast("timestamp")
    else:
        t = F.coalesce(parse_date_fallback(F.col(time_col)), parse_month_date(F.col(time_col)))
    return df.join(right.withColumn(time_col, t), on=key, how="left")

