"""Quoted CSV in any number of ranges equals the csv module."""

import csv
import gzip
import io as text_io
import random

import pyarrow as pa
import pytest

from lendspark.sources import io
from lendspark.sources.csv_ranges import BATCH, BATCH_CHARS, _records, csv_records, inside_after, read_csv_text


def made(seed, n=300):
    rng = random.Random(seed)
    cells = ["plain", "", "a,b", 'say "hi"', "two\nlines", "\n\n", '"', "crlf\r\nin", "long " * 40, "x\n" * 30, "ünï", "1", "NA", ',"\n",']
    return [[str(k), *(rng.choice(cells) for _ in range(3))] for k in range(n)]


def write(path, rows, end="\n", mode=open):
    held = text_io.StringIO(newline="")
    csv.writer(held, lineterminator=end).writerows([["id", "a", "b c", "d"], *rows])
    with mode(path, "wb") as f:
        f.write(held.getvalue().encode())
    return len(held.getvalue().encode())


@pytest.fixture
def ranges(spark):
    """Runs with small splits; gives back the settings after."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(n) for n in names]

    def set_bytes(n):
        spark.conf.set(names[0], n)
        spark.conf.set(names[1], 0)

    yield set_bytes
    for n, v in zip(names, before):
        spark.conf.set(n, v)


@pytest.mark.parametrize("seed,end", [(1, "\n"), (2, "\r\n")])
def test_same_rows_in_any_number_of_ranges(spark, tmp_path, ranges, seed, end):
    rows = made(seed)
    size = write(tmp_path / "f.csv", rows, end)
    want = sorted([[c or None for c in r] for r in rows], key=lambda r: int(r[0]))
    for parts in (1, 16, 200):
        ranges(max(1, size // parts))
        df = read_csv_text(spark, str(tmp_path / "f.csv"))
        assert df.columns == ["_row", "id", "a", "b c", "d"]
        got = [list(r) for r in df.collect()]
        assert len({r[0] for r in got}) == len(rows)
        got = sorted([[c or None for c in r[1:]] for r in got], key=lambda r: int(r[0]))
        # The parser writes a line break inside quotes as \n.
        clean = lambda rs: [[c and c.replace("\r\n", "\n") for c in r] for r in rs]
        assert clean(got) == clean(want)
    assert spark.read.text(str(tmp_path / "f.csv")).rdd.getNumPartitions() > 16


def test_a_record_over_many_ranges_and_files(spark, tmp_path, ranges):
    big = "line\n" * 5000
    for k in range(3):
        write(tmp_path / f"{k}.csv", [[str(10 * k), big, "x", "y"], [str(10 * k + 1), "z", big + '"', ""]])
    ranges(2000)
    got = sorted((int(r["id"]), r["a"], r["b c"]) for r in read_csv_text(spark, str(tmp_path)).collect())
    assert got == sorted([(10 * k, big, "x") for k in range(3)] + [(10 * k + 1, "z", big + '"') for k in range(3)])


def test_row_ids_repeat_and_no_task_reads_a_whole_file(spark, tmp_path, ranges):
    size = write(tmp_path / "f.csv", [[str(k), "a,b", "c", "d"] for k in range(4000)])
    ranges(size // 16)
    one, two = (sorted((r["row_id"], r["record"]) for r in csv_records(spark, str(tmp_path / "f.csv")).collect()) for _ in range(2))
    assert one == two
    tasks = {i >> 33 for i, _ in one}
    assert len(tasks) >= 8


def test_types_gzip_and_errors(spark, tmp_path):
    rows = [["1", "1.5", "True", "007x"], ["2", "", "false", "8"], ["3", "2", "TRUE", "NA"]]
    write(tmp_path / "f.csv.gz", rows, mode=gzip.open)
    df = io.read_raw_csv(spark, str(tmp_path / "f.csv.gz"))
    assert dict(df.dtypes) == {"row_id": "bigint", "id": "bigint", "a": "double", "b c": "boolean", "d": "string"}
    assert [tuple(r)[1:] for r in df.orderBy("id").collect()] == [(1, 1.5, True, "007x"), (2, None, False, "8"), (3, 2.0, True, None)]
    keyed = io.read_raw_csv(spark, str(tmp_path / "f.csv.gz"), key="id")
    assert sorted(r["row_id"] for r in keyed.collect()) == [1, 2, 3]
    (tmp_path / "two").mkdir()
    write(tmp_path / "two" / "a.csv", rows)
    (tmp_path / "two" / "b.csv").write_text("other,names\n1,2\n")
    with pytest.raises(ValueError, match="different headers"):
        read_csv_text(spark, str(tmp_path / "two"))
    (tmp_path / "empty.csv").write_text("")
    with pytest.raises(ValueError, match="no header"):
        read_csv_text(spark, str(tmp_path / "empty.csv"))


def test_quote_rules():
    assert not inside_after('5" pipe,"ok"', False)
    assert inside_after('a,"open', False) and inside_after("still", True)
    assert not inside_after('closed",b', True) and inside_after('c"" d', True)
    assert inside_after('closed","again', True)


def test_a_task_holds_few_records_with_line_breaks():
    """Every record has a line break or is long; batches leave as they fill."""
    read = 0

    def lines(record, n):
        nonlocal read
        for _ in range(n):
            read += 1
            values = record * 500
            yield pa.RecordBatch.from_arrays([pa.array(values), pa.array(["f"] * len(values)), pa.array([0] * len(values))], ["value", "file", "start"])

    batches = _records(lines(['1,"two', 'lines"'], 100), {}, 7)
    first = next(batches)
    assert read <= BATCH // 500 + 1 and len(first) < BATCH + 500
    assert first.column(0).to_pylist() == list(range(7, 7 + len(first)))
    assert len(first) + sum(map(len, batches)) == 50_000
    read = 0
    first = next(_records(lines(["x" * 10_000, '"y' * 5000 + '\n"'], 100), {}, 0))
    assert read == 1 and len(first) * 10_000 < 2 * BATCH_CHARS
