import random
import tracemalloc

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lendspark.llm import op10_decontaminate as de
from lendspark.llm.common import ship, table
from tests_llm_helpers import SF, crowd


def distance(item, text):
    """Least edits between item and any stretch, by the plain table."""
    row = [0] * (len(text) + 1)
    for a in item:
        left, row[0] = row[0], row[0] + 1
        for j, b in enumerate(text, 1):
            left, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, left + (a != b))
    return min(row)


def mutate(s, k, rng):
    s = list(s)
    for _ in range(k):
        i, o = rng.randrange(len(s)), rng.random()
        if o < 0.4:
            s[i] = rng.choice("abcdefghij ")
        elif o < 0.7:
            del s[i]
        else:
            s.insert(i, rng.choice("abcdefghij "))
    return "".join(s)


def test_least_edits_equals_the_table():
    rng = random.Random(1)
    for _ in range(60):
        item = "".join(rng.choices("abc ", k=rng.randint(1, 80)))
        text = "".join(rng.choices("abc ", k=rng.randint(0, 90)))
        assert de.least_edits(item.encode(), text.encode())[0] == distance(item, text)


def corpus(seed, items=30, docs=300):
    rng = random.Random(seed)
    parts = ["the", "on", "er", "ing", "and", "th", "ou", "re", "st", "ble", "an", "ti"]
    word = lambda: "".join(rng.choices(parts, k=rng.randint(1, 4)))
    text = lambda n: " ".join(word() for _ in range(n))
    bench = [(i, text(rng.randint(12, 45)) + ".") for i in range(items)]
    rows, planted = [], {}
    for d in range(docs):
        t = text(rng.randint(20, 150))
        if d % 3 == 0:
            i, share = rng.randrange(items), rng.choice([0, 0, 0.03, 0.07, 0.1, 0.2])
            t += " " + mutate(bench[i][1], int(share * len(bench[i][1])), rng) + " " + text(20)
        rows.append((d, t))
    return rows, bench


def test_whole_texts_equal_brute_force_up_to_target_recall(spark):
    rows, bench = corpus(2)
    want = {}
    for d, t in rows:
        c = de.clean(t)
        for i, b in bench:
            x = de.clean(b)
            e = de.least_edits(x, c)[0]
            if e <= de.allowed(len(x)):
                want[(d, i)] = e
    docs = crowd(spark.createDataFrame(rows, "doc_id long, text string"))
    items = spark.createDataFrame(bench, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["edits"] for r in ship(lambda s: de.leaks(docs, items))(spark).collect()}
    assert set(got) <= set(want)  # nothing clean is reported
    assert len(got) >= de.RECALL * len(want)
    assert all(got[k] >= want[k] for k in got)
    exact = {k for k, e in want.items() if e == 0}
    assert exact <= set(got) and all(got[k] == 0 for k in exact)
    kept = ship(lambda s: de.decontaminate(docs, items))(spark)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {d for d, _ in rows} - {d for d, _ in got}


def test_queries_find_every_verbatim_item(spark):
    got = {(r["doc_id"], r["item_id"]) for r in de.op10_decontaminate(spark, SF).collect()}
    items = [(r["item_id"], de.clean(r["text"])) for r in table(spark, SF, "benchmark").collect()]
    docs = [(r["doc_id"], de.clean(r["text"])) for r in table(spark, SF, "documents").collect()]
    assert {(d, i) for d, t in docs for i, x in items if x in t} <= got
    assert all(de.least_edits(dict(items)[i], dict(docs)[d])[0] <= de.allowed(len(dict(items)[i])) for d, i in got)


def test_defined_cases(spark, monkeypatch):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"
    rows = [(1, None), (2, ""), (3, item), (3, item), (None, "so: " + item.upper().replace(" ", " \n")), (4, "word " * 60_000 + item), (5, item[:40]), (6, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = [(10, item), (11, item), (12, None), (13, "short"), (14, "")]
    items = spark.createDataFrame(bench, "item_id long, text string")
    want = sorted([(d, i, 0) for d in (3, 3, None, 4) for i in (10, 11)], key=repr)
    assert sorted(map(tuple, ship(lambda s: de.leaks(docs, items))(spark).collect()), key=repr) == want
    monkeypatch.setattr(de, "ITEM_BLOCK", 1)  # several passes
    assert sorted(map(tuple, de.leaks(docs, items).collect()), key=repr) == want
    assert de.leaks(docs.limit(0), items).count() == 0 and de.leaks(docs, items.limit(0)).count() == 0
    assert de.decontaminate(docs, items.where(F.lit(False))).count() == len(rows)


@pytest.mark.parametrize("text", ["", " ", "A  b\t\nC", "é É"])
def test_normalise(text):
    assert de.clean(text) == " ".join(text.replace("A", "a").replace("C", "c").split(" ")).encode().replace(b"\t", b" ").replace(b"\n", b" ").replace(b"  ", b" ").replace(b"  ", b" ").strip(b" ")


def test_positions_survive_slices():
    item = "some words that make an item of a benchmark, long enough"
    index = de.Items([1], [item])
    column = pa.array(["no", "x " + item, None, item + " y"])
    assert set(index.find(column)) == {(1, 0), (3, 0)} and set(index.find(column.slice(2))) == {(1, 0)}


def test_one_very_long_item_is_found_in_bounded_memory(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choices("abcdefghij", k=rng.randint(2, 9)))
    long, short = (" ".join(word() for _ in range(n)) for n in (16_000, 30))
    tracemalloc.start()
    de.Items([1, 2], [long, short])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(long) > 90_000 and peak < 200e6
    other = " ".join(word() for _ in range(300))
    rows = [(0, other + " " + long + " " + other), (1, other + mutate(long, 40, rng)), (2, other + long[:50_000]), (3, other + " " + short), (4, other)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    items = spark.createDataFrame([(1, long), (2, short)], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["edits"] for r in ship(lambda s: de.leaks(docs, items))(spark).collect()}
    assert set(got) == {(0, 1), (1, 1), (3, 2)} and got[(0, 1)] == got[(3, 2)] == 0 < got[(1, 1)] <= 40


def test_blocks_are_bounded_by_bytes(spark, monkeypatch):
    monkeypatch.setattr(de, "ITEM_BYTES", 20_000)
    rows, _ = corpus(3, docs=400)
    items = spark.createDataFrame([(d, t) for d, t in rows], "item_id long, text string")
    blocks = list(ship(lambda s: list(de.item_blocks(items)))(spark))
    assert sorted(i for b in blocks for i in b.ids) == [d for d, _ in rows]
    assert max(sum(map(len, b.texts)) for b in blocks) < 40_000
    for b in blocks[:2]:  # embedded in the executors as here
        assert (de.Items(b.ids, [t.decode() for t in b.texts]).codes == b.codes).all()


def shared_sentence(items, docs, seed=6):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefghij", k=rng.randint(2, 9)))
    common = "choose the best answer to the following question"
    bench = [f"{common} " + " ".join(word() for _ in range(rng.randint(3, 25))) for _ in range(items)]
    texts = [" ".join([word() for _ in range(20)] + [common] + [word() for _ in range(20)]) for _ in range(docs)]
    texts[2] += " " + bench[1]
    return bench, texts


def test_items_taken_in_slices_give_the_same_windows(monkeypatch):
    bench, texts = shared_sentence(200, 12)
    index, column = de.Items(list(range(200)), bench), pa.array(texts)
    flat, begin = de.normalise(*de.text_bytes(column))
    whole = index.windows(flat, begin)[0]
    found = index.find(column)
    monkeypatch.setattr(de, "POSTINGS", 3_000)
    sliced = index.windows(flat, begin)[0]
    assert len(whole[0]) > 100 and all((a == b).all() for a, b in zip(whole, sliced, strict=True))
    assert index.find(column) == found and (2, index.ids.index(1)) in found


def test_a_sentence_of_all_items_takes_bounded_memory():
    bench, texts = shared_sentence(1_000, 40)
    index, column = de.Items(list(range(1_000)), bench), pa.array(texts)
    flat, begin = de.normalise(*de.text_bytes(column))
    tracemalloc.start()
    index.windows(flat, begin)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 150e6


def test_blocks_share_one_worker_and_ids_may_be_text(spark, monkeypatch):
    monkeypatch.setattr(de, "ITEM_BLOCK", 4)
    rows, bench = corpus(5, items=15, docs=60)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    items = spark.createDataFrame([(f"item {i}", t) for i, t in bench], "name string, text string")
    found = ship(lambda s: de.leaks(docs, items, item_id="name"))(spark)
    kept = de.decontaminate(docs, items, item_id="name")
    for df in (found, kept):
        assert df._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    monkeypatch.setattr(de, "ITEM_BLOCK", 1000)
    one = de.leaks(docs, spark.createDataFrame(bench, "item_id int, text string"))
    assert one.schema["item_id"].dataType.simpleString() == "int"
    pairs = {(r["doc_id"], r["item_id"], r["edits"]) for r in found.collect()}
    assert pairs == {(r["doc_id"], f"item {r['item_id']}", r["edits"]) for r in one.collect()}
    assert {r["doc_id"] for r in kept.collect()} == {d for d, _ in rows} - {d for d, _, _ in pairs}
