import random

import numpy as np
from pyspark.sql import functions as F

from lendspark.llm.common import ship, table
from lendspark.llm.op1_toxicity import CUT, fit, op1_toxicity, score, telling_stretches, windows
from tests_llm_helpers import crowd


def area(scores, marks):
    order = np.argsort(np.argsort(scores, kind="stable"), kind="stable") + 1.0
    p, n = marks.sum(), (~marks).sum()
    return (order[marks].sum() - p * (p + 1) / 2) / (p * n)


def made(n, seed, bad=("vilewort", "grimbast", "snarkoid")):
    rng = random.Random(seed)
    parts = ["lo", "ra", "mi", "tu", "ne", "so", "ka", "vi", "do", "pe"]
    rows = []
    for i in range(n):
        words = ["".join(rng.choices(parts, k=rng.randint(1, 4))) for _ in range(rng.randint(10, 120))]
        toxic = i % 6 == 0
        if toxic:
            for _ in range(max(2, len(words) // 15)):
                words[rng.randrange(len(words))] = rng.choice(bad)
        rows.append((i, " ".join(words), int(toxic)))
    return rows


def test_held_out_accuracy_on_the_test_tables(spark):
    sf = "/root/testdata/sf0.1"
    # Only the English documents of this table hold toxic words at all.
    lang = table(spark, sf, "documents").select("doc_id", "lang")
    rows = op1_toxicity(spark, sf).join(table(spark, sf, "labels"), "doc_id").join(lang, "doc_id")
    got = rows.where("held_out and lang = 'en'").toPandas()
    assert area(got.score.to_numpy(), got.toxic.to_numpy() == 1) > 0.9
    assert ((got.score >= CUT).astype(int) == got.predicted).all() and got.score.between(0, 1).all()


def test_separates_and_leaves_clean_alone(spark):
    rows = made(1500, 1)
    df = crowd(spark.createDataFrame(rows, "doc_id long, text string, toxic int"))
    model = ship(lambda s: fit(df.select("doc_id", "text"), df.where("doc_id < 900").select("doc_id", "toxic")))(spark)
    got = score(df, model).join(df.select("doc_id", "toxic"), "doc_id").where("doc_id >= 900").toPandas()
    marks = got.toxic.to_numpy() == 1
    assert area(got.score.to_numpy(), marks) > 0.98
    assert (got.score[~marks] >= CUT).mean() < 0.03 and (got.score[marks] >= CUT).mean() > 0.9


def test_defined_cases(spark):
    rows = made(400, 2)
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = ship(lambda s: fit(df, df.select("doc_id", "toxic")))(spark)
    odd = [(1, None), (2, ""), (3, " \n"), (None, "lo ra mi"), (4, "vilewort " * 40_000), (5, "lo ra"), (5, "lo ra")]
    got = {r["doc_id"]: r for r in score(spark.createDataFrame(odd, "doc_id long, text string"), model).collect()}
    assert got[1]["score"] == got[2]["score"] == got[3]["score"] and got[1]["windows"] == 0
    assert got[4]["score"] > 0.9 and got[4]["windows"] == -(-40_000 // 6)
    assert 0 <= got[None]["score"] <= 1
    assert score(spark.createDataFrame(odd, "doc_id long, text string").limit(0), model).count() == 0
    # No labels of one class: nothing is learned.
    assert fit(df, df.select("doc_id", F.lit(0).alias("toxic"))) is None
    assert {r["score"] for r in score(df, None).collect()} == {0.0}


def test_windows_and_stretches():
    assert windows(b"A b  C d e f g") == [b" a b c d e f ", b" g "] and windows(b" ") == []
    found = telling_stretches([b"plain zzyzx words here"] * 50, [b"plain words here"] * 50)
    assert found and all(b"zzyz" in s or b"zyzx" in s for s in found)
