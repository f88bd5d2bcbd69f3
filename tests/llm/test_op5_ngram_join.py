import random
import re

import numpy as np
import pytest

from lendspark.llm import op5_ngram_join as module
from lendspark.llm.op5_ngram_join import count_codes, drop_near_duplicates, near_duplicates, op5_ngram_join, repeated_shingles
from lendspark.llm.common import ship, table
from tests_llm_helpers import SF, crowd


def brute(texts, width=5):
    sets = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        if len(w) >= width:
            sets.append({tuple(w[i : i + width]) for i in range(len(w) - width + 1)})
        else:
            sets.append({tuple(w)} if w else set())
    by_gram, up = {}, list(range(len(texts)))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, s in enumerate(sets):
        seen = set()
        for g in s:
            for j in by_gram.setdefault(g, []):
                if j not in seen:
                    seen.add(j)
                    shared = len(s & sets[j])
                    if 100 * shared >= 80 * (len(s) + len(sets[j]) - shared):
                        a, b = top(i), top(j)
                        up[max(a, b)] = min(a, b)
            by_gram[g].append(i)
    return sets, [top(i) for i in range(len(texts))]


def expected(rows):
    sets, root = brute([t for _, t in rows])
    least = {}
    for (i, _), r in zip(rows, root):
        if i is not None and (r not in least or i < least[r]):
            least[r] = i
    return sorted(
        ((i, len(s), least.get(r) if s else i) for (i, _), s, r in zip(rows, sets, root)), key=repr
    )


def run(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = ship(lambda s: near_duplicates(df))(spark)
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got.collect()), key=repr)


def edits(words, share, rng, pool):
    out = list(words)
    for _ in range(max(1, int(share * len(words)))):
        k = rng.randrange(len(out))
        out[k] = rng.choice(pool)
    return out


def made(seed):
    """Groups of near copies around the threshold, a common passage in many
    documents, and groups large enough for the frequent classes."""
    rng = random.Random(seed)
    pool = [f"w{i}" for i in range(3000)]
    common = [rng.choice(pool) for _ in range(60)]
    rows = []
    for g in range(25):
        base = [rng.choice(pool) for _ in range(rng.choice([6, 9, 25, 60, 120, 420]))]
        for _ in range(rng.choice([1, 2, 5])):
            rows.append(" ".join(edits(base, rng.choice([0, 0.01, 0.02, 0.04]), rng, pool)))
    big = [rng.choice(pool) for _ in range(80)]
    rows += [" ".join(edits(big, rng.choice([0.01, 0.03, 0.05]), rng, pool)) for _ in range(150)]
    long = [rng.choice(pool) for _ in range(380)]
    rows += [" ".join(edits(long, rng.choice([0.005, 0.02, 0.03]), rng, pool)) for _ in range(80)]
    rows += [" ".join([rng.choice(pool) for _ in range(rng.choice([3, 12, 40]))] + common) for _ in range(100)]
    rows += ["a b c d e f g", "A B c d e f g", "a b", "a  b", "b a", "x", "", None, "  \n", "a b c d e f g h"]
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_brute_force(spark, seed):
    rows = made(seed)
    assert run(spark, rows) == expected(rows)


def test_many_blocks_and_buckets(spark, monkeypatch):
    monkeypatch.setattr(module, "BLOCK_BYTES", 2_000)
    monkeypatch.setattr(module, "BUCKET_SHINGLES", 300)
    rows = made(3)
    assert run(spark, rows) == expected(rows)


def test_copies_over_tasks_count_once(spark):
    rows = [(i, " ".join(f"t{i % 7}w{k}" for k in range(40))) for i in range(210)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    assert ship(lambda s: repeated_shingles(df, 210 * 36))(spark).count() == 0
    assert run(spark, rows) == expected(rows)


def test_hot_class_and_hot_component(spark):
    """A third of the rows are one text, another third one component."""
    rng = random.Random(5)
    base = [f"b{k}" for k in range(120)]
    rows = ["one text that a third of all rows hold word for word"] * 120
    rows += [" ".join(edits(base, 0.01, rng, ["x", "y", "z"])) for _ in range(120)]
    rows += [f"row {k} has words that no other row has {k} {k + 1} {k + 2}" for k in range(120)]
    rng.shuffle(rows)
    rows = list(enumerate(rows))
    assert run(spark, rows) == expected(rows)


def test_count_codes():
    codes = count_codes(np.arange(1, 200_000))
    assert codes[:127].tolist() == list(range(1, 128))
    assert (np.diff(codes.astype(int)) >= 0).all() and codes[-1] == 255


def test_whole_table_equals_brute_force(spark):
    got = op5_ngram_join(spark, SF).collect()
    rows = [(r["doc_id"], r["text"]) for r in table(spark, SF, "documents").select("doc_id", "text").collect()]
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got), key=repr) == expected(rows)


def test_nulls_repeats_and_empty(spark):
    t = "one two three four five six seven eight nine ten"
    rows = [(5, t), (5, t), (3, t + " eleven"), (None, t), (None, ""), (7, None), (9, ""), (4, "other words")]
    assert run(spark, rows) == expected(rows)
    assert run(spark, []) == []


def test_drop_keeps_one_of_each(spark):
    t = "one two three four five six seven eight nine ten eleven twelve"
    rows = [
        (5, t, "a"), (5, t, "b"), (3, t + " more", "c"), (None, t, "d"), (7, None, "e"), (9, "", "f"), (9, "lone words", "g"),
        (9, "something else entirely here now", "h"), (None, "null id but clean text", "i"), (None, "another null id", "j"),
    ]
    df = crowd(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    kept = ship(lambda s: drop_near_duplicates(df))(spark)
    assert kept.columns == df.columns
    got = sorted((r["source"]) for r in kept.collect())
    assert got == ["c", "e", "f", "g", "h", "i", "j"]
    assert ship(lambda s: drop_near_duplicates(df.limit(0)))(spark).count() == 0
