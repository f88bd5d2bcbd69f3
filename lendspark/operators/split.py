"""Splits and sampling.

Random parity with a NumPy shuffle is impossible; row order here comes from
a deterministic hash of ``row_id`` and the seed (or any order the caller
gives). Class quotas are exact: the order value at each class's quota is
found by exact rank selection over the label and order columns only, and a
row's label is a comparison with it, so the wide table is never shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .quantiles import order_statistics, quantiles


def _micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def time_cutoff(df: DataFrame, time_col: str = "issue_d", quantile: float = 0.8) -> float | None:
    """P2 cutoff: exact linear ``quantile`` of the time column, in epoch micros."""
    if time_col not in df.columns:
        raise KeyError(f"no column {time_col!r} to split by time")
    t = df.select(_micros(F.col(time_col)).cast("double").alias("t"))
    return quantiles(t, ["t"], [quantile])["t"][0]


def cutoff_micros(train_end: str) -> int:
    """Epoch micros (UTC) of a cutoff date text such as ``2016-12-31``."""
    import datetime as _dt

    d = _dt.datetime.fromisoformat(train_end)
    if d.tzinfo is None:
        d = d.replace(tzinfo=_dt.timezone.utc)
    return int(d.timestamp() * 1_000_000)


def time_split_label(
    df: DataFrame,
    time_col: str = "issue_d",
    train_end: str | None = None,
    quantile: float = 0.8,
    out: str = "split",
) -> DataFrame:
    """P2 as a label: ``train`` when ``time <= cutoff``, ``validation`` when
    after; rows with a missing time get NULL (they belong to neither). The
    cutoff is found once and enters the plan as a literal."""
    if time_col not in df.columns:
        raise KeyError(f"no column {time_col!r} to split by time")
    cut = float(cutoff_micros(train_end)) if train_end is not None else time_cutoff(df, time_col, quantile)
    t, c = _micros(F.col(time_col)).cast("double"), F.lit(cut).cast("double")
    return df.withColumn(out, F.when(t <= c, "train").when(t > c, "validation"))


def time_split(
    df: DataFrame, time_col: str = "issue_d", train_end: str | None = None, quantile: float = 0.8
) -> tuple[DataFrame, DataFrame]:
    """``(train, validation)``; missing times are in neither."""
    labelled = time_split_label(df, time_col, train_end, quantile, out="_split")
    train = labelled.where(F.col("_split") == "train").drop("_split")
    val = labelled.where(F.col("_split") == "validation").drop("_split")
    return train, val


def approximate_mode(class_counts: dict, n_draws: int) -> dict:
    """Per-class draws proportional to the class counts, summing to
    ``n_draws``: floor of the share, remainder to the largest fractional
    parts (ties to the class listed first)."""
    total = sum(class_counts.values())
    keys = list(class_counts)
    cont = {k: class_counts[k] / total * n_draws for k in keys}
    floored = {k: math.floor(cont[k]) for k in keys}
    need = n_draws - sum(floored.values())
    if need > 0:
        order = sorted(keys, key=lambda k: (-(cont[k] - floored[k]), keys.index(k)))
        for k in order[:need]:
            floored[k] += 1
    return floored


def _order(order: Sequence[str] | None, seed: int, key: str) -> Column:
    """The value that rows are ordered by within a class; it must tell rows apart."""
    if order:
        return F.struct(*[F.col(f"`{c}`") for c in order])
    return F.struct(F.xxhash64(F.col(f"`{key}`"), F.lit(seed)).alias("h"), F.col(f"`{key}`"))


def _class_cuts(df: DataFrame, label: str, position: Column, ends: Callable[[dict], dict]) -> tuple[DataFrame, dict]:
    """(table of ``_class, _cuts``, class counts). ``ends`` turns the class
    counts into ascending row numbers per class; ``_cuts`` holds the order
    value at each of them (none for number 0, which nothing is below)."""
    long = df.select(F.col(label).alias("_k"), position.alias("_v"))
    sizes: dict = {}

    def ranks(counts: dict) -> dict:
        order = sorted(counts, key=lambda k: (k is not None, k))
        sizes.update({k: counts[k] for k in order})
        return {k: [e - 1 for e in v if e > 0] for k, v in ends(sizes).items()}

    found = order_statistics(long, ranks)
    rows = [(k, [found[k][1].get(e - 1) for e in v]) for k, v in (ends(sizes).items() if sizes else ())]
    schema = T.StructType([T.StructField("_class", long.schema["_k"].dataType), T.StructField("_cuts", T.ArrayType(long.schema["_v"].dataType))])
    return df.sparkSession.createDataFrame(rows, schema), sizes


def _with_cuts(df: DataFrame, label: str, cuts: DataFrame) -> DataFrame:
    # One row per class, known on the driver; the planner joins it by size.
    return df.join(cuts, F.col(label).eqNullSafe(F.col("_class")), "left").drop("_class")


def stratified_split(
    df: DataFrame,
    label: str = "default",
    test_size: float = 0.2,
    seed: int = 42,
    order: Sequence[str] | None = None,
    key: str = "row_id",
    out: str = "split",
) -> DataFrame:
    """Label each row ``train`` / ``test`` keeping class shares; the
    test set has ``ceil(n * test_size)`` rows in total."""
    position = _order(order, seed, key)

    def ends(sizes: dict) -> dict:
        n = sum(sizes.values())
        return {k: [q] for k, q in approximate_mode(sizes, n - math.ceil(n * test_size)).items()}

    cuts, _ = _class_cuts(df, label, position, ends)
    inside = F.coalesce(position <= F.col("_cuts")[0], F.lit(False))
    return _with_cuts(df, label, cuts).withColumn(out, F.when(inside, "train").otherwise("test")).drop("_cuts")


def stratified_subsample(
    df: DataFrame,
    label: str = "default",
    frac: float = 0.15,
    seed: int = 42,
    order: Sequence[str] | None = None,
    key: str = "row_id",
) -> DataFrame:
    """Class-preserving subsample of ``max(2, round(n * frac))`` rows
    (half-even rounding); everything when that is not below ``n``."""
    if frac <= 0 or frac > 1:
        raise ValueError(f"a sample share lies above 0 and at most at 1, got {frac}")
    position, whole = _order(order, seed, key), []

    def ends(sizes: dict) -> dict:
        n = sum(sizes.values())
        size = max(2, round(n * frac))
        whole[:] = [size >= n]
        return {k: [q] for k, q in (sizes if size >= n else approximate_mode(sizes, size)).items()}

    cuts, sizes = _class_cuts(df, label, position, ends)
    if not sizes or whole[0]:
        return df
    return _with_cuts(df, label, cuts).where(position <= F.col("_cuts")[0]).drop("_cuts")


def stratified_folds(
    df: DataFrame,
    label: str = "default",
    k: int = 3,
    seed: int = 42,
    order: Sequence[str] | None = None,
    key: str = "row_id",
    out: str = "fold",
) -> DataFrame:
    """Fold id in ``0..k-1``: each class is cut, in order, into ``k``
    runs whose sizes differ by one at most (longer ones first)."""
    position = _order(order, seed, key)

    def ends(sizes: dict) -> dict:
        return {c: [f * (n // k) + min(f, n % k) for f in range(1, k)] for c, n in sizes.items()}

    cuts, _ = _class_cuts(df, label, position, ends)
    below = F.lit(0)
    for f in range(k - 1):
        # A cut before the first row lies below every row.
        below = below + F.coalesce(position > F.col("_cuts")[f], F.lit(True)).cast("int")
    return _with_cuts(df, label, cuts).withColumn(out, below).drop("_cuts")


def recombine(*parts: DataFrame) -> DataFrame:
    """P5: concatenate split parts back into one table."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def feature_label_columns(
    df: DataFrame, label: str = "default", time_col: str = "issue_d", exclude: Sequence[str] = ("row_id",)
) -> list[str]:
    """Feature columns = everything but the label, the time column and
    ``exclude`` (absent names ignored)."""
    drop = {label.lower(), time_col.lower(), *[e.lower() for e in exclude]}
    return [c for c in df.columns if c.lower() not in drop]
