import hashlib
import random
import zlib

import numpy as np
import pytest

from lendspark.llm import op12_trie
from lendspark.llm.common import ship
from lendspark.llm.op12_trie import Trie, left_extent, prefix_trie, rebuilt, right_extent, sparse_table, turn_units
from tests_llm_helpers import crowd

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows):
    """Nodes from (conv_id, turn, role, text) rows, prefix by prefix."""

    def unit(r):
        role, text = r[2] or "", r[3] or ""
        return hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest(), role, text

    turns = {}
    for r in rows:
        if r[0] is not None:
            turns.setdefault(r[0], []).append((r[1] is not None, r[1] or 0, *unit(r)))
    seqs = {c: [x[3:] for x in sorted(t)] for c, t in turns.items()}
    made = {}
    for c, own in seqs.items():
        h = zlib.crc32(str(c).encode()) % 6
        made[c] = tuple(seqs.get(c - c % 100, [])[:h] + own[h:])
    nodes = {}
    for c, s in made.items():
        for d in range(len(s) + 1):
            nodes.setdefault(s[:d], []).append(c)
    children = {}
    for p in nodes:
        if p:
            children.setdefault(p[:-1], []).append(p)

    def below(p):
        todo, leaves, saved = [p], 0, 0
        while todo:
            q = todo.pop()
            todo += children.get(q, [])
            leaves += q not in children
            saved += (len(nodes[q]) - 1) * len(q[-1][1]) if q else 0
        return leaves, saved

    out = []
    for p, members in nodes.items():
        ends = ",".join(str(c) for c in sorted(c for c in members if len(made[c]) == len(p)))
        out.append(
            (min(members), len(p), min(nodes[p[:-1]]) if p else None, len(members), len(children.get(p, [])), *below(p),
             hashlib.sha256(ends.encode()).hexdigest())
        )
    return sorted(out, key=repr)


def run(spark, df):
    got = ship(lambda s: prefix_trie(rebuilt(turn_units(df))))(spark)
    assert got.columns == COLUMNS
    return sorted((tuple(r[c] for c in COLUMNS) for r in got.collect()), key=repr)


def made(seed, n=300):
    """Shared first turns, copies, a long conversation, and few bases."""
    rng = random.Random(seed)
    texts = ["", "hi", "how are you", "ä€𝄞", "long " * 30]
    rows = []
    for _ in range(n):
        c = rng.choice([rng.randrange(100), 100 * rng.randrange(12), 700 + rng.randrange(250)])
        if any(r[0] == c for r in rows):
            continue
        for t in range(rng.choice([1, 2, 3, 8, 12])):
            rows.append((c, t, rng.choice(["user", "assistant", None]), rng.choice(texts[: rng.choice([1, 2, 5])] + [None])))
    rows += [(10_000 + k, t, "user", "same") for k in range(150) for t in range(9)]
    rows += [(20_000, t, "user", f"turn {t % 7}") for t in range(400)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_nodes_equal_brute_force(spark, seed, monkeypatch):
    monkeypatch.setattr(op12_trie, "PACK", 7)
    rows = made(seed)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert run(spark, crowd(df)) == brute(rows)


def test_one_range_and_many(spark):
    """Nodes on borders of ranges: any number of ranges gives the same nodes."""
    rows = made(3, 120)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for parts in (1, 3, 40):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            assert run(spark, df) == brute(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_nulls_repeats_ties_and_empty(spark):
    schema = "conv_id long, turn long, role string, text string"
    rows = [
        (None, 0, "user", "nobody"), (100, None, "user", "null turn is first"), (100, 0, None, None), (100, 0, None, None),
        (101, 1, "user", "tie b"), (101, 1, "user", "tie a"), (101, 1, "assistant", "tie a"), (205, 0, "user", "x"), (-5, 0, "user", "x"),
        (-5, 2, "user", ""),
    ]
    assert run(spark, spark.createDataFrame(rows, schema)) == brute(rows)
    assert run(spark, spark.createDataFrame([], schema)) == []
    # Conversations that lose their only turn: a root alone.
    alone = [(c, 0, "user", "x") for c in (1, 2, 3, 4, 7) if zlib.crc32(str(c).encode()) % 6]
    assert run(spark, spark.createDataFrame(alone, schema)) == brute(alone)


def test_extents_equal_scans():
    rng = np.random.default_rng(5)
    lcp = rng.integers(0, 4, 200)
    lcp[0] = 0
    rows = sparse_table(lcp)
    at, depth = rng.integers(0, 200, 500), rng.integers(1, 5, 500)
    for a, d, l, r in zip(at, depth, left_extent(rows, at, depth), right_extent(rows, at, depth)):
        left = right = a
        while left > 0 and lcp[left] >= d:
            left -= 1
        while right + 1 < 200 and lcp[right + 1] >= d:
            right += 1
        assert (l, r) == (left, right)


def test_candidates_in_slices(monkeypatch):
    keys = sorted({bytes([a] * 20 + [b] * 20) * n for a in range(3) for b in range(3) for n in (1, 2, 5)})
    whole = Trie(keys)
    monkeypatch.setattr(op12_trie, "CANDIDATES", 3)
    sliced = Trie(keys)
    for name in ("left", "right", "depth", "parent", "end"):
        assert (getattr(whole, name) == getattr(sliced, name)).all()
