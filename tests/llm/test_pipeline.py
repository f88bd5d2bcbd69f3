"""Each stage of the pipeline against brute force on its own input."""

import zlib

import corpus_pipeline as cp
import pytest
from pyspark.sql import functions as F

from lendspark.llm import op7_mix, op10_decontaminate as de
from lendspark.llm.common import stage, table
from test_op5_ngram_join import expected
from test_op7_mix import goals
from tests_llm_helpers import SF

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def small(spark, tmp):
    """A documents table with odd rows, and a benchmark table."""
    docs = table(spark, SF, "documents").limit(120)
    item = "a benchmark item with words that nobody else would ever write in this order"
    odd = [
        (9001, None, None, None, None), (9002, "", "en", "src1", 0), (9003, "12 34 -- !!", "en", "src1", 11),
        (9004, f"before {item.upper()} after it", "en", "src2", 99), (9005, "clean words only here and nothing more", "en", None, 5),
        (9006, "clean words only here and nothing more", "en", "src3", 5), (9007, "clean words only here and nothing more!", None, "src3", 5),
        (9008, "long " * 30_000, "en", "src4", 5), (None, "a row without an id but with words", "en", "src4", 5),
    ]
    rows = spark.createDataFrame(odd, docs.schema)
    docs.select(COLUMNS).unionByName(rows.select(COLUMNS)).write.parquet(f"{tmp}/documents.parquet")
    bench = [(r["item_id"], r["text"]) for r in table(spark, SF, "benchmark").limit(20).collect()]
    spark.createDataFrame([*bench, (777, item), (778, None)], "item_id long, text string").write.parquet(f"{tmp}/benchmark.parquet")
    return [*bench, (777, item)]


def test_stages_on_their_own_input(spark, tmpdir_path):
    bench = small(spark, tmpdir_path)
    steps, docs = dict(cp.STAGES), table(spark, tmpdir_path, "documents")
    rows = lambda df: [(r["doc_id"], r["text"]) for r in df.collect()]
    named = stage(steps["language ID"](spark, docs, tmpdir_path), "t")
    assert named.columns == COLUMNS
    assert sorted(rows(named), key=repr) == sorted([r for r in rows(docs) if any(c.isalpha() for c in r[1] or "")], key=repr)

    single = stage(steps["near duplicates"](spark, named, tmpdir_path), "t")
    assert single.columns == COLUMNS
    want = sorted({c if i is not None else None for i, _, c in expected(rows(named))}, key=repr)
    assert sorted((i for i, _ in rows(single)), key=repr) == want

    free = stage(steps["decontamination"](spark, single, tmpdir_path), "t")
    assert free.columns == COLUMNS
    items = [de.clean(t) for _, t in bench]
    leak = lambda t: any(de.least_edits(x, de.clean(t))[0] <= de.allowed(len(x)) for x in items)
    assert sorted(rows(free), key=repr) == sorted([r for r in rows(single) if not leak(r[1])], key=repr)
    assert 9004 not in {i for i, _ in rows(free)} and 9008 in {i for i, _ in rows(free)}

    mixed = stage(steps["mixing"](spark, free, tmpdir_path), "t")
    assert mixed.columns == COLUMNS
    size = lambda df: {r["source"]: r["n"] for r in df.groupBy("source").agg(F.sum(op7_mix.word_count(F.col("text"))).alias("n")).collect()}
    sizes, taken = size(free), size(mixed)
    for s, t in goals(sizes).items():
        largest = max(len((r["text"] or "").split()) for r in free.where(F.col("source").eqNullSafe(s)).collect())
        assert abs(taken.get(s, 0) - t) <= largest / 2 + 1

    out = steps["token files"](spark, mixed, tmpdir_path).collect()
    assert sorted((r["doc_id"] for r in out), key=repr) == sorted((i for i, _ in rows(mixed)), key=repr)
    start = 0
    for r in sorted(out, key=lambda r: r["start"]):
        assert r["start"] == start
        start += r["n_tokens"]


def test_run_equals_its_stages(spark):
    got = sorted(map(tuple, cp.run(spark, SF).collect()))
    docs = table(spark, SF, "documents")
    for name, f in cp.STAGES:
        docs = stage(f(spark, docs, SF), "t")
    assert got == sorted(map(tuple, docs.collect())) and got
    assert cp.ORACLE_SQL is None


def test_empty_table(spark, tmpdir_path):
    small(spark, tmpdir_path)
    docs = table(spark, tmpdir_path, "documents").limit(0)
    for name, f in cp.STAGES:
        docs = stage(f(spark, docs, tmpdir_path), "t")
        assert docs.count() == 0, name
