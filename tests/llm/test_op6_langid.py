import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lendspark.llm import op6_langid as li
from lendspark.llm.common import ship, table
from tests_llm_helpers import SF, crowd


def symbols(text):
    out = []
    for b in text.encode():
        if 65 <= b <= 90:
            b += 32
        out.append(b - 96 if 97 <= b <= 122 else b - 101 if b >= 128 else 0)
    return out


def brute_bits(train, texts):
    """Code lengths by recursion over contexts, one symbol at a time."""
    langs = sorted(train)
    counts = {la: defaultdict(Counter) for la in langs}
    total = Counter()
    for la in langs:
        for t in train[la]:
            s = [0, 0, 0] + symbols(t)
            for i in range(3, len(s)):
                for k in range(4):
                    counts[la][tuple(s[i - k : i])][s[i]] += 1
                    total[tuple(s[i - k : i])] += 1

    def dist(la, ctx):
        base = [1 / li.SYMBOLS] * li.SYMBOLS if not ctx and ctx is not None and ctx == () else None
        base = base or dist(la, ctx[1:])
        c = counts[la].get(ctx)
        if not c:
            return base
        n, d = sum(c.values()), len(c)
        rest = sum(p for x, p in enumerate(base) if x not in c)
        return [c[x] / (n + d if rest > 0 else n) if x in c else d / (n + d) * base[x] / rest for x in range(li.SYMBOLS)]

    cache, out = {}, []
    for t in texts:
        s, row = [0, 0, 0] + symbols(t), []
        for la in langs:
            bits = 0.0
            for i in range(3, len(s)):
                ctx = tuple(s[i - 3 : i])
                while ctx and total[ctx] < li.MIN_COUNT:
                    ctx = ctx[1:]
                if (la, ctx) not in cache:
                    cache[la, ctx] = dist(la, ctx)
                bits -= math.log2(max(cache[la, ctx][s[i]], 1e-30))
            row.append(bits)
        out.append(row)
    return np.array(out)


TRAIN = {
    "en": ["the cat and the dog were in the house", "she is there with that other one", "this and that"],
    "fr": ["le chat était dans la maison", "où est-il allé après ça ?", "une autre fois"],
}


def trees():
    counts = {}
    for la, texts in TRAIN.items():
        batch = pa.RecordBatch.from_arrays([pa.array([la] * len(texts)), pa.array([t.encode() for t in texts], pa.binary())], ["lang", "text"])
        (got,) = list(li._gram_counts(iter([batch])))
        counts[la] = (got.column(1).to_numpy(), got.column(2).to_numpy().astype(float))
    return li.Trees(counts)


@pytest.mark.parametrize("piece", [5, 17, 1 << 20])
def test_code_lengths_equal_brute_force(monkeypatch, piece):
    monkeypatch.setattr(li, "PIECE", piece)
    texts = ["the house", "", "maison été", "x", "zz zz The", "çà", "q" * 40, "日本"]
    got = trees().code_lengths(*li.text_bytes(pa.array(texts)))
    assert np.allclose(got, brute_bits(TRAIN, texts), rtol=1e-4)


def test_sliced_and_null_columns():
    a = pa.array(["skip", "the house", None, "été"])
    want = trees().code_lengths(*li.text_bytes(pa.array(["the house", "", "été"])))
    assert np.allclose(trees().code_lengths(*li.text_bytes(a.slice(1))), want)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = li.op6_langid(spark, sf).join(table(spark, sf, "documents").select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r["lang_pred"] == r["lang"] for r in got) / len(got) > 0.97
    assert all(0 <= r["score"] <= 1 for r in got)


def test_folds_of_the_whole_table(spark):
    got = li.op6_langid(spark, SF).collect()
    assert len(got) == table(spark, SF, "documents").count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)


def test_defined_cases(spark):
    rows = [(1, "the other one is there " * 9, "en"), (2, "où est la maison après " * 9, "fr"), (3, None, "en"), (4, "", "fr"), (5, "12 34 !?", None),
            (None, "the house", None), (7, "le chat " * 30_000, "fr"), (7, "le chat " * 30_000, "fr"), (8, "日本語", None)]
    df = crowd(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    made = ship(lambda s: li.fit(df.select("lang", "text")))(spark)
    out = li.identify(df, made, names=("lang_pred", "sure"))
    assert out.columns == df.columns + ["lang_pred", "sure"]
    got = {(r["doc_id"], r["text"]): r["lang_pred"] for r in out.collect()}
    assert [got[(i, t)] for i, t, _ in rows[:3]] == ["en", "fr", "und"]
    assert got[(4, "")] == got[(5, "12 34 !?")] == "und" and got[(7, rows[6][1])] == "fr" and got[(8, "日本語")] in ("en", "fr")
    assert out.count() == len(rows)
    assert li.identify(df.limit(0), made).count() == 0
    none = li.identify(df, li.fit(df.where(F.lit(False)).select("lang", "text")))
    assert {r["lang_pred"] for r in none.collect()} == {"und"}


def test_sample_takes_distinct_texts_within_the_bound(spark):
    """Thousands of copies neither fill the sample nor keep other texts out."""
    hot = "one text that is copied thousands of times " * 24
    rows = [("en", hot)] * 4000 + [("en", f"text {k} of two hundred others " * 40) for k in range(200)]
    rows += [("fr", "un seul texte qui dépasse la borne " * 9000), ("de", ""), ("de", None), (None, "no language")]
    df = spark.createDataFrame(rows, "lang string, text string").repartition(5)
    for bound in (50_000, 200_000, 10_000_000):
        got = [(r["lang"], bytes(r["text"])) for r in ship(lambda s: li.sample_texts(df, bound))(spark).collect()]
        assert len(set(got)) == len(got)
        taken = [t for la, t in got if la == "en"]
        assert sum(map(len, taken)) <= 2 * bound and len(taken) >= min(201, bound // 3000)
        assert {la for la, _ in got} == {"en", "fr", "de"}
    assert len(taken) == 201


def test_too_many_languages_are_refused(spark, monkeypatch):
    monkeypatch.setattr(li, "MAX_LANGS", 2)
    df = spark.createDataFrame([(x, "some text") for x in ("a", "b", "c")], "lang string, text string")
    with pytest.raises(ValueError, match="values of lang"):
        li.fit(df)


def test_gram_counts_in_pieces_equal_those_of_whole_texts(monkeypatch):
    batch = pa.RecordBatch.from_arrays([pa.array(["en", "fr", "en", "en"]), pa.array([b"the cat and the dog " * 9, "où est".encode(), b"", b"xy"], pa.binary())], ["lang", "text"])

    def total():
        out = Counter()
        for part in li._gram_counts(iter([batch])):
            for lang, gram, n in zip(*(c.to_pylist() for c in part.columns)):
                out[lang, gram] += n
        return out

    whole = total()
    for piece in (1, 2, 7, 64):
        monkeypatch.setattr(li, "GRAM_PIECE", piece)
        assert total() == whole
