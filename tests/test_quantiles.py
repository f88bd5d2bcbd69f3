"""Radix selection of ranks against sorting, for every kind of value."""

import datetime as dt
import math
import random

import pytest

from lendspark.operators import quantiles
from lendspark.operators.quantiles import order_statistics


def key(v):
    return tuple(key(x) for x in v) if isinstance(v, tuple) else (v is not None, v)


def check(spark, rows, schema, probs=(0, 0.1, 0.5, 0.77, 1)):
    """``rows`` of (series, value[, weight]); wants ranks at ``probs``."""
    df = spark.createDataFrame(rows, schema)
    found = order_statistics(df, lambda sizes: {k: {round((n - 1) * p) for p in probs} | {n + 3, -1} for k, n in sizes.items()})
    want = {}
    for r in rows:
        if r[1] is not None:
            want.setdefault(r[0], []).extend([r[1]] * (r[2] if len(r) > 2 else 1))
    assert set(found) == set(want)
    for k, values in want.items():
        values.sort(key=key)
        n, at = found[k]
        assert n == len(values)
        assert {g: (tuple(v) if isinstance(v, tuple) else v) for g, v in at.items()} == {
            g: values[g] for g in {round((n - 1) * p) for p in probs}
        }


@pytest.fixture(params=[20_000, 0, 40])
def pick(request, monkeypatch):
    """Fetch at once, split down to single values, or mix both."""
    monkeypatch.setattr(quantiles, "PICK", request.param)
    monkeypatch.setattr(quantiles, "SPLIT", 16 if request.param != 20_000 else 4096)


def numbers(rng, n=400):
    kinds = [lambda: rng.random(), lambda: rng.gauss(0, 1e6), lambda: rng.choice([0.0, 1.0, 1.5]), lambda: math.exp(rng.uniform(-600, 600)) * rng.choice([-1, 1])]
    f = rng.choice(kinds)
    return [f() for _ in range(n)]


def test_doubles(spark, pick):
    rng = random.Random(1)
    rows = [(k, v) for k in ("a", "b", None, "c", "d") for v in numbers(rng)]
    rows += [("a", None), ("e", float("inf")), ("e", float("-inf")), ("e", 5e-324), ("e", -5e-324), ("e", 0.0), ("f", None), ("g", 1.0)]
    check(spark, rows, "_k string, _v double")


def test_longs_dates_times_flags_and_texts(spark, pick):
    rng = random.Random(2)
    longs = [rng.randrange(-(2**63), 2**63) for _ in range(300)] + [2**62 + k for k in range(100)] + [-(2**63), 2**63 - 1, 0]
    check(spark, [(1, v) for v in longs] + [(2, v % 7) for v in longs], "_k int, _v long")
    check(spark, [(1, dt.date(1900, 1, 1) + dt.timedelta(days=rng.randrange(90_000))) for _ in range(200)], "_k int, _v date")
    check(spark, [(1, dt.datetime(2001, 1, 1) + dt.timedelta(microseconds=rng.randrange(10**15))) for _ in range(200)], "_k int, _v timestamp")
    check(spark, [(k % 2, k % 3 == 0) for k in range(50)], "_k int, _v boolean")
    texts = ["".join(rng.choice("abé€𝄞") for _ in range(rng.randrange(6))) for _ in range(300)] + ["same prefix " * 3 + str(k) for k in range(99)]
    check(spark, [(1, v) for v in texts], "_k int, _v string")


def test_weights_and_structs(spark, pick):
    rng = random.Random(3)
    check(spark, [(rng.randrange(3), rng.choice([1.0, 2.0, rng.random()]), rng.randrange(1, 9)) for _ in range(300)], "_k int, _v double, _w long")
    rows = [(rng.choice([0, 1, None]), (rng.choice([None, 5, rng.randrange(-(2**63), 2**63)]), rng.choice(["x", "xy", None, str(k)]), k)) for k in range(300)]
    check(spark, rows, "_k int, _v struct<h:long,s:string,i:int>")
    check(spark, [(1, (rng.randrange(4),)) for _ in range(90)], "_k int, _v struct<h:int>")
    assert order_statistics(spark.createDataFrame([], "_k int, _v double"), lambda s: {1: [0]}) == {}


def test_no_row_is_shuffled(spark):
    """Counting by leading digits exchanges partial counts only."""
    df = spark.range(200_000).selectExpr("0 as _k", "id / 200000 as _v")
    seen = []
    ranks = lambda s: seen.append(s) or {0: [1, 100_000, 199_998]}
    found = order_statistics(df, ranks)
    assert found[0] == (200_000, {1: 1 / 200_000, 100_000: 0.5, 199_998: 199_998 / 200_000})
    assert seen == [{0: 200_000}]


def test_wide_columns_are_selected_without_taking_rows_apart(spark, monkeypatch):
    """Doubles with ties, missing values, both zeros, infinities and one narrow range; ranks by numpy."""
    import numpy as np

    from lendspark.operators import quantiles as module

    rng = np.random.default_rng(5)
    n = 30_000
    inf, nan = float("inf"), float("nan")
    table = {
        "a": rng.normal(0, 1e3, n), "b": rng.choice([0.0, 1.0], n), "c": 1 + rng.random(n) * 1e-9,
        "d": rng.choice([-0.0, 0.0, -inf, inf, nan, 1e300, -1e300, 5e-324], n), "e": np.full(n, nan),
    }
    rows = [tuple(None if k % 7 == 0 else float(v[k]) for v in table.values()) + (k - 9,) for k in range(n)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, e double, f long").repartition(3)
    monkeypatch.setattr(module, "long_form", None)
    monkeypatch.setattr(module, "PICK", 50)
    wanted = {0, 1, 17, n // 3, n // 2, n - 1}
    found = module.wide_order_statistics(df, list("abcdef"), lambda sizes: {k: wanted | {m - 1} for k, m in sizes.items()})
    for c, v in {**table, "f": np.arange(n) - 9.0}.items():
        known = np.sort([x for k, x in enumerate(v) if (c == "f" or k % 7) and not np.isnan(x)])
        if c == "e":
            assert c not in found
            continue
        assert found[c] == (len(known), {g: known[g] for g in wanted | {len(known) - 1} if g < len(known)})
