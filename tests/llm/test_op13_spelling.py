import random
import re
import zlib

import numpy as np
import pytest

from lendspark.llm import op13_spelling
from lendspark.llm.common import ship
from lendspark.llm.op13_spelling import Shard, Words, near_words, observed, one_edit, spelling_groups, vectors_of, verified, with_vectors
from tests_llm_helpers import crowd

COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


def plain_near(a, b):
    """One edit apart, by the full table of edit distances."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1] == 1


def brute(counts, ratio=10):
    near = {w: [x for x in counts if abs(len(x) - len(w)) < 2 and plain_near(w, x)] for w in counts}
    form = {}
    for w, xs in near.items():
        best = min(xs, key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * counts[w] else None
    out = []
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, counts[w], len(near[w]), counts[form[w]] if form[w] else None))
    return sorted(out)


def words_of(rows):
    out = {}
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                out[run] = out.get(run, 0) + 1
    return out


def edited(w, rng, letters):
    k = rng.randrange(len(w) + 1)
    return rng.choice([w[:k] + rng.choice(letters) + w[k:], w[:k] + rng.choice(letters) + w[k + 1 :], w[:k] + w[k + 1 :]])


def made(seed, n=120):
    """Chains of edits, anagrams, accents, words over 32 characters, and counts
    that tie and that differ by factors of ten."""
    rng, letters = random.Random(seed), "aabeiostnérxÿ"
    counts = {}
    for _ in range(n):
        w = "".join(rng.choice(letters) for _ in range(rng.choice([6, 7, 8, 12, 31, 32, 33, 50])))
        for _ in range(rng.choice([1, 3, 8])):
            counts[w] = rng.choice([2, 3, 20, 30, 200, 3000])
            w = edited(w, rng, letters)
    base = list("stressed")
    for _ in range(60):
        rng.shuffle(base)
        counts["".join(base)] = rng.choice([2, 50])
    counts |= {"a" * k: 10 ** (k % 3) * 2 for k in (7, 30, 31, 32, 33, 34, 70, 71)}
    return counts


def run(spark, counts, shard=None):
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = ship(lambda s: spelling_groups(df, **({"shard": shard} if shard else {})))(spark)
    assert got.columns == COLUMNS
    return sorted(map(tuple, got.collect()))


@pytest.mark.parametrize("seed", [1, 2])
def test_groups_equal_brute_force(spark, seed):
    counts = made(seed)
    assert run(spark, counts) == brute(counts)


def test_many_shards_and_dealt_branches(spark, monkeypatch):
    """A directory of several levels, with branches of equal vectors that are
    larger than a shard, finds the same words."""
    counts = made(3)
    held = ship(lambda s: with_vectors(spark.createDataFrame(list(counts.items()), "word string, n long")))(spark)
    monkeypatch.setattr(op13_spelling, "LEAST_SHARD", 8)
    monkeypatch.setattr(op13_spelling, "BLOCK", 50)
    top = op13_spelling.Directory(held, 8)
    assert len(top.nodes) == len(op13_spelling.GROUPS) and top.parts
    got = {r["word"].decode("latin-1"): r["n_near"] for r in near_words(held, 8).collect()}
    assert got == {w: k for w, _, _, _, k, _ in brute(counts) if k}


def test_verification_equals_edit_distance():
    rng = random.Random(7)
    pairs = []
    for _ in range(3000):
        a = "".join(rng.choice("abé") for _ in range(rng.choice([1, 2, 6, 7, 8, 31, 32, 33, 40])))
        b = edited(a, rng, "abé")
        pairs.append((a, rng.choice([a, b, edited(b, rng, "abé") if b else a])))
    enc = [(a.encode("latin-1"), b.encode("latin-1")) for a, b in pairs]
    want = [plain_near(a, b) for a, b in pairs]
    assert [one_edit(a, b) for a, b in enc] == want
    none = np.zeros((len(enc), 16), np.uint8)
    left, right = Words([a for a, _ in enc], none), Words([b for _, b in enc], none)
    every = np.arange(len(enc))
    assert np.isin(every, verified(left, every, right, every)[0]).tolist() == want


def test_search_in_small_slices(monkeypatch):
    counts = made(4, 40)
    monkeypatch.setattr(op13_spelling, "PAIRS", 64)
    words = sorted(w.encode("latin-1") for w in counts)
    vec = np.stack([np.minimum(np.bincount(op13_spelling.GROUP_OF[np.frombuffer(w, np.uint8)], minlength=16), 31) for w in words]).astype(np.uint8)
    shard = Shard(words, np.array([counts[w.decode("latin-1")] for w in words]), vec)
    n, _ = shard.search(Words(words, vec))
    near = {w: k for w, _, _, _, k, _ in brute(counts)}
    assert n.tolist() == [near[w.decode("latin-1")] for w in words]


def test_words_of_texts(spark):
    rng = random.Random(9)
    pool = ["Reading", "reading", "READINGS", "straße", "größere", "a÷bcdefg×", "short", "x" * 300, "don't", "naïveté", "日本語words"]
    rows = [(k % 90, " ".join(rng.choices(pool, k=40))) for k in range(120)] + [(None, "reading Reading größere"), (5, None), (6, ""), (7, "a_b"), (7, "reading\nreading")]
    df = crowd(spark.createDataFrame(rows, "doc_id long, text string"))
    got = {r["word"]: r["count"] for r in observed(df).groupBy("word").count().collect()}
    assert got == words_of(rows)
    assert observed(df.limit(0)).count() == 0


def test_empty_and_single(spark):
    assert run(spark, {}) == []
    assert run(spark, {"reading": 5}) == [("reading", None, "reading", 5, 0, None)]
    assert vectors_of(with_vectors(spark.createDataFrame([("ééxxx", 1)], "word string, n long")).toArrow().column(2)).sum() == 5
