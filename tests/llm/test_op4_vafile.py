import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lendspark.llm import op4_vafile as va
from lendspark.llm.common import ship
from tests_llm_helpers import crowd


def brute(rows, k):
    def ok(v):
        return v is not None and all(x is not None and math.isfinite(x) for x in v)

    kept = [(i, [math.floor(64 * x) for x in v]) for i, v in rows if ok(v)]
    out = []
    for a, (i, q) in enumerate(kept):
        if i is None or i % 20:
            continue
        found = sorted(
            ((-sum(x * y for x, y in zip(q, v)), j is None, j or 0) for b, (j, v) in enumerate(kept) if b != a and len(v) == len(q))
        )[:k]
        out += [(i, r + 1, None if none else j, -s) for r, (s, none, j) in enumerate(found)]
    return sorted(out, key=repr)


def run(spark, rows, k=20, extra=True):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    df = crowd(df) if extra else df
    got = ship(lambda s: va.top_k(df.repartition(3), F.col("vec_id") % 20 == 0, k))(spark).collect()
    return sorted(((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got), key=repr)


def vectors(n, dim, seed):
    rng = np.random.default_rng(seed)
    return [(i, [float(x) for x in np.float32(rng.normal(0, 0.2, dim))]) for i in range(n)]


def test_equals_brute_force_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(va, "QUERY_BLOCK", 16)
    rows = vectors(900, 12, 3)
    assert run(spark, rows) == brute(rows, 20)


def test_ties_nulls_lengths_and_repeats(spark):
    rng = random.Random(4)
    rows = [(i, [float(rng.randint(-2, 2)) / 8 for _ in range(3)]) for i in range(200)]  # many ties
    rows += [(20, [0.5, 0.5, 0.5]), (20, [0.5, 0.5, 0.5]), (None, [0.25, 0.25, 0.25])]
    rows += [(40, None), (60, [1.0, None, 2.0]), (80, [float("nan"), 0.0, 0.0]), (100, [float("inf"), 0.0, 0.0])]
    rows += [(200, []), (201, []), (220, [1.0, 2.0]), (221, [3.0, 1.0]), (240, [1e3, -1e3, 5e2, 1.0])]
    assert run(spark, rows) == brute(rows, 20)


def test_fewer_than_k_and_empty(spark):
    assert run(spark, [(0, [1.0, 2.0]), (1, [1.0, 0.0]), (20, [0.0, 1.0])], 5) == brute([(0, [1.0, 2.0]), (1, [1.0, 0.0]), (20, [0.0, 1.0])], 5)
    assert run(spark, [(0, [1.0])]) == [] and run(spark, []) == []


def test_exact_vectors_are_read_only_until_certain(tmpdir_path):
    rows = vectors(4000, 16, 5)
    v = np.floor(64 * np.array([e for _, e in rows])).astype(np.int64)
    with open(tmpdir_path + "/x.va", "wb") as f:
        for a in range(0, 4000, 500):
            f.write(va.block_bytes(list(range(a, a + 500)), v[a : a + 500]))
    from pyarrow import fs

    blocks, read = va.Blocks(fs.LocalFileSystem(), tmpdir_path + "/x.va"), []
    rows_of = blocks.rows
    blocks.rows = lambda wanted: (read.append(len(wanted)), rows_of(wanted))[1]
    q = [{"vec_id": 7, "file": "x", "row": 7, "vector": v[7].tobytes()}]
    got = list(va.search_block({"x": blocks}, q, 16, 20))
    scores = v @ v[7]
    want = sorted(((-scores[j], j) for j in range(4000) if j != 7))[:20]
    assert [(r["score"], r["vec_id"]) for r in got] == [(-s, j) for s, j in want]
    assert sum(read) < 400


@pytest.mark.parametrize("top", [100, 30_000, 2**20, 2**40])
def test_block_keeps_integers(tmpdir_path, top):
    from pyarrow import fs

    v = np.random.default_rng(1).integers(-top, top, (50, 3))
    with open(tmpdir_path + "/y.va", "wb") as f:
        f.write(va.block_bytes([None, *range(1, 50)], v))
    b = va.Blocks(fs.LocalFileSystem(), tmpdir_path + "/y.va")
    list(b.scan(3))
    ids, got = b.rows(np.array([0, 3, 49]))
    assert ids == [None, 3, 49] and (got == v[[0, 3, 49]]).all()
