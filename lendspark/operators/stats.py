"""Fused column statistics: one aggregate pass for all columns at once.

Each statistic family is a single pass over every requested column, and
only its result (bounded by the number of columns) reaches the driver,
where it becomes literals in the next plan.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.nulls import is_numeric_type, nan_to_null
from .quantiles import quantiles


def q(c: str) -> Column:
    return F.col(f"`{c}`")


def is_missing(c: str, dtype: T.DataType) -> Column:
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return q(c).isNull() | F.isnan(q(c))
    return q(c).isNull()


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """Numeric columns in schema order (booleans and dates are not numeric)."""
    ex = {e.lower() for e in exclude}
    return [f.name for f in df.schema.fields if is_numeric_type(f.dataType) and f.name.lower() not in ex]


def string_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    ex = {e.lower() for e in exclude}
    return [
        f.name for f in df.schema.fields
        if isinstance(f.dataType, T.StringType) and f.name.lower() not in ex
    ]


def missing_rate_exprs(df: DataFrame, columns: Sequence[str] | None = None) -> list[Column]:
    types = {f.name: f.dataType for f in df.schema.fields}
    cols = list(df.columns) if columns is None else list(columns)
    return [F.avg(is_missing(c, types[c]).cast("double")).alias(c) for c in cols]


def missing_rates(df: DataFrame, columns: Sequence[str] | None = None) -> dict[str, float]:
    """Share of missing values per column (one aggregate)."""
    cols = list(df.columns) if columns is None else list(columns)
    if not cols:
        return {}
    types = {f.name: f.dataType for f in df.schema.fields}
    known = [F.count(F.when(~is_missing(c, types[c]), 1)).alias(f"n{i}") for i, c in enumerate(cols)]
    row = df.agg(F.count(F.lit(1)).alias("rows"), *known).first()
    return {c: ((row["rows"] - row[f"n{i}"]) / row["rows"] if row["rows"] else 0.0) for i, c in enumerate(cols)}


def missing_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Long table ``(column, missing_rate)``; lazy (aggregate then unpivot)."""
    cols = list(df.columns) if columns is None else list(columns)
    wide = df.agg(*[e.alias(f"m{i}") for i, e in enumerate(missing_rate_exprs(df, cols))])
    stack = F.explode(
        F.array(
            *[
                F.struct(F.lit(c).alias("column"), F.col(f"m{i}").alias("missing_rate"))
                for i, c in enumerate(cols)
            ]
        )
    ).alias("s")
    return wide.select(stack).select("s.column", "s.missing_rate")


def medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float | None]:
    """Exact median per column (linear interpolation), missing values skipped."""
    return {c: v[0] for c, v in quantiles(df, columns, [0.5]).items()}


def mean_std_pop(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float | None, float | None]]:
    """Mean and population standard deviation per column, missing values skipped."""
    if not columns:
        return {}

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, mean, squares = (np.zeros(len(columns)) for _ in range(3))
        for batch in batches:
            for i in range(len(columns)):
                v = batch.column(i).drop_null().to_numpy(zero_copy_only=False)
                v = v[~np.isnan(v)]
                if len(v):
                    m = v.mean()
                    all_, gap = n[i] + len(v), m - mean[i]
                    squares[i] += ((v - m) ** 2).sum() + gap * gap * n[i] * len(v) / all_
                    mean[i] += gap * len(v) / all_
                    n[i] = all_
        places = pa.array(range(len(columns)), pa.int32())
        yield pa.RecordBatch.from_arrays([places, pa.array(n), pa.array(mean), pa.array(squares)], ["i", "n", "mean", "squares"])

    wide = df.select(*[q(c).cast("double").alias(f"v{i}") for i, c in enumerate(columns)])
    parts = wide.mapInArrow(sums, "i int, n double, mean double, squares double").where("n > 0")
    # The parts' means about one of them, so that nothing cancels.
    about = parts.groupBy("i").agg(
        F.sum("n").alias("n"), F.sum("squares").alias("inside"), F.collect_list(F.struct("n", "mean")).alias("parts")
    )
    out = dict.fromkeys(columns, (None, None))
    for r in about.collect():
        mean = math.fsum(x["n"] * x["mean"] for x in r["parts"]) / r["n"]
        between = math.fsum(x["n"] * (x["mean"] - mean) ** 2 for x in r["parts"])
        out[columns[r["i"]]] = (mean, math.sqrt((r["inside"] + between) / r["n"]))
    return out
