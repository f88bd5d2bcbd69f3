"""Exact quantiles and order statistics by radix selection.

A value's leading digits are its sign, power of two and sixteenth of an octave
(for text, its first character). Rows are counted by series and leading digits
with partial sums; only the cells that hold a wanted rank are split again, each
into ``SPLIT`` parts of its own value range, until the rows left in such cells
are few and their values are fetched. Scans are narrow: no row leaves its task
and nothing is written; the driver gets counts of cells (some hundred per
series and wanted rank). A few scans do for any number of rows: one by leading
digits, one for every factor of ``SPLIT`` beyond ``PICK`` rows, one to fetch.
"""

from __future__ import annotations

import datetime as dt
import math
import os
from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.nulls import nan_to_null

SPLIT = 4096  # parts that a cell is split into
PICK = 20_000  # rows in wanted cells that are fetched instead of split


def interpolate(values_at: dict[int, float], n: int, p: float) -> float | None:
    """Linear interpolation between order statistics, as ``percentile``."""
    if n == 0:
        return None
    position = (n - 1) * p
    lower, higher = math.floor(position), math.ceil(position)
    lo = values_at[lower]
    if higher == lower:
        return lo
    hi = values_at[higher]
    if hi == lo:
        return lo
    return (higher - position) * lo + (position - lower) * hi


def needed_ranks(n: int, probs: Sequence[float]) -> set[int]:
    """0-based ranks that :func:`interpolate` reads at ``probs``."""
    out = set()
    for p in probs if n else ():
        pos = (n - 1) * p
        out |= {math.floor(pos), math.ceil(pos)}
    return out


def cut_plan(n: int, probs: Sequence[float]) -> list[tuple[int, int, float]]:
    """Per probability: the two neighbouring ranks and the weight, as the
    array-library linear method computes them (``(n - 1) * p``, both ranks
    clipped to the last element at or beyond the end)."""
    plan = []
    for p in probs:
        pos = (n - 1) * p
        if pos >= n - 1:
            plan.append((n - 1, n - 1, 0.0))
            continue
        lo = math.floor(pos)
        plan.append((lo, lo + 1, pos - lo))
    return plan


def lerp(a, b, t: float):
    """Two-branch linear interpolation of the array library (bit-exact):
    ``a + (b - a) * t`` below one half, ``b - (b - a) * (1 - t)`` from it."""
    d = b - a
    return b - d * (1 - t) if t >= 0.5 else a + d * t


def _leading_digits(v: Column, kind: T.DataType) -> Column:
    """A coarse code that never falls as the value rises."""
    if isinstance(kind, T.StringType):
        return F.substring(v, 1, 1)
    x = v.cast("double")
    size = F.abs(x)
    # 16 steps an octave; log2 of the least double is -1074.
    digits = F.floor(F.log2(size) * 16) + 20_000
    digits = F.when(size == 0, 0).when(size == float("inf"), 1_000_000).otherwise(digits)
    return (digits * F.signum(x)).cast("long")


def _next_digits(kind: T.DataType) -> Column:
    """The part of its cell ``[lo, hi]`` that ``_o`` lies in; ``lo`` and
    ``hi`` are never in the same one. Texts are told apart by their first
    ``shown`` characters."""
    if isinstance(kind, T.StringType):
        return F.substring("_o", F.lit(1), F.col("shown"))
    return F.floor((F.col("_o") - F.col("lo")).cast("double") / (F.col("hi") - F.col("lo")).cast("double") * SPLIT)


def _shown(lo, hi) -> int:
    """Characters up to the first that differs, of two texts."""
    return len(os.path.commonprefix([lo, hi])) + 1 if isinstance(lo, str) else 0


def _in_order(value):
    """Sort key of a collected value; missing ones come first."""
    if isinstance(value, tuple):
        return tuple(_in_order(x) for x in value)
    return (value is not None, value)


def _comparable(v: Column, kind: T.DataType) -> tuple[Column, T.DataType]:
    """``v`` as a number or text of the same order."""
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(v), T.LongType()
    if isinstance(kind, T.DateType):
        return F.unix_date(v), T.IntegerType()
    if isinstance(kind, T.BooleanType):
        return v.cast("int"), T.IntegerType()
    if isinstance(kind, (T.NumericType, T.StringType)):
        return v, kind
    raise TypeError(f"no order statistics of {kind.simpleString()}")


def _select(rows: DataFrame, kind: T.DataType, ranks: Callable[[dict], dict[object, Iterable[int]]]) -> tuple[dict, dict]:
    """Order statistics of the column ``_o`` (a number or text) of rows
    ``_k, _o, _w``: ``({key: n}, {key: [(value, before, count, ranks)]})``, the
    ranks of equal values together with the rows below and equal to them."""
    counted = [F.count(F.lit(1)).alias("rows"), F.sum("_w").alias("n"), F.min("_o").alias("lo"), F.max("_o").alias("hi")]
    cells: dict = {}
    for r in rows.groupBy("_k", _leading_digits(F.col("_o"), kind).alias("code")).agg(*counted).collect():
        cells.setdefault(r["_k"], []).append(r)
    sizes = {k: sum(int(r["n"]) for r in v) for k, v in cells.items()}
    found: dict = {k: [] for k in sizes}
    wide: list[tuple] = []  # key, lo, hi, before, rows, ranks

    def place(k, parts, before: int, wanted: list[int]) -> None:
        """Wanted ranks to the cells (in order) that hold them."""
        at = 0
        for r in sorted(parts, key=lambda r: _in_order(r["code"])):
            n = int(r["n"])
            first = at
            while at < len(wanted) and wanted[at] < before + n:
                at += 1
            if at > first:
                if r["lo"] == r["hi"]:
                    found[k].append((r["lo"], before, n, wanted[first:at]))
                else:
                    wide.append((k, r["lo"], r["hi"], before, int(r["rows"]), wanted[first:at]))
            before += n

    for k, asked in ranks(sizes).items():
        if k in cells:
            place(k, cells[k], 0, sorted({g for g in asked if 0 <= g < sizes[k]}))
    key_type = rows.schema["_k"].dataType
    fields = [("k", key_type), ("lo", kind), ("hi", kind), ("shown", T.IntegerType()), ("cell", T.IntegerType())]
    schema = T.StructType([T.StructField(*f) for f in fields])
    while wide:
        todo, few = wide, sum(c[4] for c in wide) <= PICK
        wide = []
        table = rows.sparkSession.createDataFrame([(*c[:3], _shown(c[1], c[2]), i) for i, c in enumerate(todo)], schema)
        # One row for each cell that holds a wanted rank.
        inside = rows.join(F.broadcast(table), F.col("_k").eqNullSafe(F.col("k")) & F.col("_o").between(F.col("lo"), F.col("hi")))
        code = F.col("_o") if few else _next_digits(kind)
        parts: dict = {}
        for r in inside.groupBy("cell", code.alias("code")).agg(*counted).collect():
            parts.setdefault(r["cell"], []).append(r)
        for i, c in enumerate(todo):
            place(c[0], parts[i], c[3], c[5])
    return sizes, found


def order_statistics(long: DataFrame, ranks: Callable[[dict], dict[object, Iterable[int]]]) -> dict:
    """Values at 0-based ranks per series.

    ``long`` has ``_k`` (series), ``_v`` (a number, text, date, time, boolean,
    or a struct of such, compared field by field with missing ones first; NULL
    is left out) and optionally ``_w`` (how often the value occurs). ``ranks``
    gets the counts per series and names the ranks wanted; those beyond the
    series are left out. Returns ``{key: (n, {rank: value})}``. ``long`` is
    scanned some three times; stage it when it is dear to compute.
    """
    kind = long.schema["_v"].dataType
    weight = F.col("_w") if "_w" in long.columns else F.lit(1)
    rows = long.where(F.col("_v").isNotNull()).select("_k", "_v", weight.cast("long").alias("_w"))
    if not isinstance(kind, T.StructType):
        order, plain = _comparable(F.col("_v"), kind)
        sizes, found = _select(rows.withColumn("_o", order), plain, ranks)
        out = {k: (n, {g: c[0] for c in found[k] for g in c[3]}) for k, n in sizes.items()}
        return {k: (n, dict(zip(at, _restored(list(at.values()), kind), strict=True))) for k, (n, at) in out.items()}
    order, plain = _comparable(F.col("_v")[kind.fields[0].name], kind.fields[0].dataType)
    sizes, found = _select(rows.withColumn("_o", order), plain, ranks)
    # The rows that share the first field with a wanted one: few, unless it repeats.
    ties = [(k, *c) for k, v in found.items() for c in v]
    out = {k: (n, {}) for k, n in sizes.items()}
    if not ties:
        return out
    schema = T.StructType([T.StructField("k", long.schema["_k"].dataType), T.StructField("lo", plain), T.StructField("tie", T.IntegerType())])
    table = long.sparkSession.createDataFrame([(t[0], t[1], i) for i, t in enumerate(ties)], schema)
    same = F.col("_k").eqNullSafe(F.col("k")) & F.col("_o").eqNullSafe(F.col("lo"))
    tied = rows.withColumn("_o", order).join(F.broadcast(table), same)
    wanted = {i: [g - t[2] for g in t[4]] for i, t in enumerate(ties)}
    if sum(t[3] for t in ties) <= PICK:
        got: dict = {}
        for r in tied.groupBy("tie", "_v").agg(F.sum("_w").alias("n")).collect():
            got.setdefault(r["tie"], []).append((r["_v"], int(r["n"])))
        picked = {i: (0, _at_ranks(v, wanted[i])) for i, v in got.items()}
    else:
        first = _restored([t[1] for t in ties], kind.fields[0].dataType)
        picked = {i: (0, {g: () for g in gs}) for i, gs in wanted.items()}
        if len(kind.fields) > 1:
            rest = F.struct(*[F.col("_v")[f.name].alias(f.name) for f in kind.fields[1:]])
            picked = order_statistics(tied.select(F.col("tie").alias("_k"), rest.alias("_v"), "_w"), lambda _: wanted)
        picked = {i: (n, {g: (first[i], *v) for g, v in at.items()}) for i, (n, at) in picked.items()}
    for i, t in enumerate(ties):
        for g in t[4]:
            out[t[0]][1][g] = picked[i][1][g - t[2]]
    return out


def _at_ranks(values: list[tuple], wanted: list[int]) -> dict:
    out, before = {}, 0
    for v, n in sorted(values, key=lambda x: _in_order(x[0])):
        out |= {g: v for g in wanted if before <= g < before + n}
        before += n
    return out


def _restored(values: list, kind: T.DataType) -> list:
    """Collected numbers back in their column's type."""
    if isinstance(kind, T.TimestampType):
        return [None if v is None else dt.datetime.fromtimestamp(v // 1_000_000) + dt.timedelta(microseconds=v % 1_000_000) for v in values]
    if isinstance(kind, T.DateType):
        return [None if v is None else dt.date(1970, 1, 1) + dt.timedelta(days=v) for v in values]
    if isinstance(kind, T.BooleanType):
        return [None if v is None else bool(v) for v in values]
    return values


def long_form(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(_k, _v)`` with one row per column and row; NaN counts as missing."""
    pairs = F.array(*[F.struct(F.lit(c).alias("_k"), nan_to_null(F.col(f"`{c}`")).alias("_v")) for c in columns])
    return df.select(F.explode(pairs).alias("_s")).select("_s._k", "_s._v")


def _cells_of(df: DataFrame, columns: Sequence[str], cells: dict[int, list[tuple[int, int, int]]] | None, few: bool) -> list:
    """Counts (k, cell, code, n, lo, hi) of the double columns at the places
    ``k``: by leading digits, or of the values inside ``cells`` (number, least
    and largest key; ascending) by part, or by value if they are ``few``.

    A task counts Arrow batches of the wide rows. Keys are the bits of a double
    as an integer of the same order; the first 16 are the leading digits."""
    at = list(range(len(columns))) if cells is None else sorted(cells)
    bounds = None if cells is None else {k: tuple(np.array(x, np.int64) for x in zip(*cells[k], strict=True)) for k in at}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def key_of(v: np.ndarray) -> np.ndarray:
            bits = v.view(np.int64)
            return bits ^ ((bits >> 63) & np.int64(0x7FFFFFFFFFFFFFFF))

        def merged(parts: list[tuple]) -> list[tuple]:
            cell, code, n, lo, hi = (np.concatenate(x) for x in zip(*parts, strict=True))
            order = np.lexsort((code, cell))
            cell, code, n, lo, hi = cell[order], code[order], n[order], lo[order], hi[order]
            first = np.flatnonzero(np.concatenate([[True], (cell[1:] != cell[:-1]) | (code[1:] != code[:-1])]))
            return [(cell[first], code[first], np.add.reduceat(n, first), np.minimum.reduceat(lo, first), np.maximum.reduceat(hi, first))]

        held: dict = {k: [] for k in at}
        for batch in batches:
            for i, k in enumerate(at):
                v = batch.column(i).drop_null().to_numpy(zero_copy_only=False)
                v = np.sort(v[~np.isnan(v)] + 0.0)  # -0.0 is 0.0
                key = key_of(v)
                if bounds is None:
                    cell, code = np.zeros(len(v), np.int64), key >> 48
                else:
                    number, low, high = bounds[k]
                    place = np.searchsorted(low, key, side="right") - 1
                    inside = (place >= 0) & (key <= high[place])
                    v, key, place = v[inside], key[inside], place[inside]
                    cell = number[place]
                    code = key if few else (key - low[place]) * SPLIT // (high[place] - low[place] + 1)
                if len(v):
                    first = np.flatnonzero(np.concatenate([[True], (cell[1:] != cell[:-1]) | (code[1:] != code[:-1])]))
                    ends = np.append(first[1:], len(v))
                    held[k].append((cell[first], code[first], ends - first, v[first], v[ends - 1]))
                    if len(held[k]) >= 32:
                        held[k] = merged(held[k])
        for k, parts in held.items():
            if parts:
                ((cell, *rest),) = merged(parts)
                columns = [np.full(len(cell), k, np.int32), cell, *rest]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["k", "cell", "code", "n", "lo", "hi"])

    wide = df.select(*[F.col(f"`{columns[k]}`").cast("double").alias(f"v{k}") for k in at])
    found = wide.mapInArrow(count, "k int, cell long, code long, n long, lo double, hi double")
    return found.groupBy("k", "cell", "code").agg(F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi")).collect()


def _key(value: float) -> int:
    bits = int(np.array(value + 0.0).view(np.int64))
    return bits ^ ((bits >> 63) & 0x7FFFFFFFFFFFFFFF)


def wide_order_statistics(df: DataFrame, columns: Sequence[str], ranks: Callable[[dict], dict[str, Iterable[int]]]) -> dict:
    """:func:`order_statistics` of numeric columns as series: no row is taken
    apart, and a scan reads only the columns that still have cells to split."""
    kinds = {type(df.schema[c].dataType) for c in columns}
    if not kinds & {T.DoubleType, T.FloatType}:
        return order_statistics(long_form(df, columns), ranks)
    sizes: dict = {}
    found: dict = {}
    wide: list[tuple] = []  # k, lo, hi, before, rows, ranks

    def place(k: int, parts: list, before: int, wanted: list[int]) -> None:
        at = 0
        for r in sorted(parts, key=lambda r: r["code"]):
            first = at
            while at < len(wanted) and wanted[at] < before + r["n"]:
                at += 1
            if at > first:
                if r["lo"] == r["hi"]:
                    found[columns[k]].update(dict.fromkeys(wanted[first:at], r["lo"]))
                else:
                    wide.append((k, r["lo"], r["hi"], before, r["n"], wanted[first:at]))
            before += r["n"]

    parts: dict = {}
    for r in _cells_of(df, columns, None, False):
        parts.setdefault(r["k"], []).append(r)
    for k in sorted(parts):
        sizes[columns[k]], found[columns[k]] = sum(r["n"] for r in parts[k]), {}
    asked = ranks(sizes)
    for k, v in parts.items():
        n = sizes[columns[k]]
        place(k, v, 0, sorted({g for g in asked.get(columns[k], ()) if 0 <= g < n}))
    while wide:
        todo, few = wide, sum(c[4] for c in wide) <= PICK
        wide = []
        cells: dict = {}
        for i, c in enumerate(todo):
            cells.setdefault(c[0], []).append((i, _key(c[1]), _key(c[2])))
        parts = {}
        for r in _cells_of(df, columns, {k: sorted(v, key=lambda c: c[1]) for k, v in cells.items()}, few):
            parts.setdefault(r["cell"], []).append(r)
        for i, c in enumerate(todo):
            place(c[0], parts[i], c[3], c[5])
    return {c: (n, found[c]) for c, n in sizes.items()}


def quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float]) -> dict[str, list[float | None]]:
    """Exact quantiles of several columns in one pass over ``df``."""
    if not columns:
        return {}
    found = wide_order_statistics(df, columns, lambda sizes: {k: needed_ranks(n, probs) for k, n in sizes.items()})
    none = (0, {})
    return {c: [interpolate(found.get(c, none)[1], found.get(c, none)[0], p) for p in probs] for c in columns}
