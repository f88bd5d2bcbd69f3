import random
import re

import numpy as np
import pytest
import xxhash

from lendspark.llm.common import ship, table
from lendspark.llm.op11_simhash import Connected, Plan, connect, fingerprint, labelled, links, near_duplicates, op11_simhash
from tests_llm_helpers import SF, crowd


def plain_fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    grams = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] if w else []
    hashes = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(fps, near=3):
    up = list(range(len(fps)))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= near:
                a, b = top(i), top(j)
                up[max(a, b)] = min(a, b)
    return [top(i) for i in range(len(fps))]


def expected(rows):
    fps = [plain_fingerprint(t) for _, t in rows]
    root, least = roots(fps), {}
    for (i, _), r in zip(rows, root):
        if i is not None and (r not in least or i < least[r]):
            least[r] = i
    return sorted(((i, f, least.get(r)) for (i, _), f, r in zip(rows, fps, root)), key=repr)


def run(spark, df):
    got = ship(lambda s: near_duplicates(df))(spark)
    return sorted(((r["doc_id"], r["fp"] % (1 << 64), r["component_id"]) for r in got.collect()), key=repr)


def ball(rng, n, flips):
    """Fingerprints in groups, chains and a dense ball around one centre."""
    out = [rng.getrandbits(64) for _ in range(n)]
    centre = rng.getrandbits(64)
    for _ in range(n):
        x = centre
        for _ in range(rng.choice(flips)):
            x ^= 1 << rng.randrange(64)
        out.append(x)
    x = rng.getrandbits(64)
    for _ in range(40):
        x ^= (1 << rng.randrange(64)) | (1 << rng.randrange(64)) | (1 << rng.randrange(64))
        out.append(x)
    return sorted(set(out))


def test_fingerprint_equals_plain(monkeypatch):
    texts = ["", None, " \n", "One", "one  two", "a b c", "A b C d", "ä Ö ü ß é", "x " * 500 + "y", "\x00 \x1f \x85 \xa0 b c"]
    assert [fingerprint(t and t.encode()) for t in texts] == [plain_fingerprint(t) for t in texts]
    long = " ".join(random.Random(1).choices(["alpha", "be", "c", "delta", "Epsilon"], k=3000))
    monkeypatch.setattr("lendspark.llm.op11_simhash.TEXT_BLOCK", 100)
    assert fingerprint(long.encode()) == plain_fingerprint(long)


@pytest.mark.parametrize("seed,flips", [(1, [0, 1, 2, 3, 4, 6]), (2, [5, 6, 7, 8])])
def test_connect_equals_all_pairs(seed, flips):
    fps = ball(random.Random(seed), 300, flips)
    plan = Plan(np.array(fps[::5], np.uint64), len(fps))
    label = connect(np.array(fps, np.uint64), None, plan.pivots)
    assert len({(a, b) for a, b in zip(label.tolist(), roots(fps))}) == len(set(label.tolist())) == len(set(roots(fps)))
    side = np.arange(len(fps)) % 2 == 1
    got = connect(np.array(fps, np.uint64), side, plan.pivots)
    found = Connected(len(fps))
    pairs = [(i, j) for i in range(0, len(fps), 2) for j in range(1, len(fps), 2) if (fps[i] ^ fps[j]).bit_count() <= 3]
    if pairs:
        found.join(*np.array(pairs).T)
    assert len(set(zip(got.tolist(), found.label.tolist()))) == len(set(got.tolist())) == len(set(found.label.tolist()))


def test_linked_fingerprints_meet_in_a_cell():
    rng = random.Random(3)
    fps = np.array(ball(rng, 2000, [0, 1, 2, 3, 5]), np.uint64)
    plan = Plan(fps[::7], len(fps), cell=200)
    assert plan.cells > 8
    row, cell = plan.deal(fps)
    where = [set() for _ in fps]
    for r, c in zip(row.tolist(), cell.tolist()):
        where[r].add(c)
    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(fps[:i] ^ fps[i]) <= 3):
            assert where[i] & where[j]


@pytest.mark.parametrize("cell", [50, 400])
def test_links_with_small_cells(spark, cell):
    """Cells over the limit, dealt as pairs of parts, lose no link."""
    fps = ball(random.Random(4), 500, [1, 2, 3, 4, 6])
    df = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")
    got = ship(lambda s: labelled(links(df, cell=cell, sample=200)))(spark).collect()
    label = {r["fp"] % (1 << 64): r["label"] for r in got}
    groups = {}
    for f, r in zip(fps, roots(fps)):
        groups.setdefault(r, []).append(f)
    for members in groups.values():
        if len(members) > 1:
            assert len({label[f] for f in members}) == 1
        else:
            assert members[0] not in label
    assert len(set(label.values())) == sum(len(m) > 1 for m in groups.values())


def test_components_equal_brute_force(spark):
    rng = random.Random(5)
    pool = [f"w{k}" for k in range(50)]
    rows = []
    for g in range(30):
        base = [rng.choice(pool) for _ in range(rng.choice([2, 5, 40, 300]))]
        for _ in range(rng.choice([1, 3, 6])):
            t = list(base)
            t[rng.randrange(len(t))] = rng.choice(pool)
            rows.append(" ".join(t))
    rows += [rows[0].upper(), rows[0], "", None, " ", "x"] + [rows[5]] * 40
    rows = list(enumerate(rows)) + [(None, rows[5]), (None, "nobody's"), (3, "same id"), (3, "same id")]
    df = crowd(spark.createDataFrame(rows, "doc_id long, text string"))
    assert run(spark, df) == expected(rows)
    assert run(spark, df.limit(0)) == []
    assert run(spark, spark.createDataFrame([(4, None)], "doc_id long, text string")) == [(4, 0, 4)]


def test_whole_table(spark):
    got = sorted(map(tuple, op11_simhash(spark, SF).select("doc_id", "fingerprint", "component_id").collect()))
    rows = [(r["doc_id"], r["text"]) for r in table(spark, SF, "documents").select("doc_id", "text").collect()]
    assert got == sorted((i, f"{f:016x}", c) for i, f, c in expected(rows))
