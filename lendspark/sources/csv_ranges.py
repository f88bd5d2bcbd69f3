"""Quoted CSV in byte ranges.

A quoted field may hold line breaks, so a task that starts inside a file cannot
tell whether its first line is a new record. Two passes settle it without ever
giving a whole file to one task:

1. every range (a split of the text reader) finds the quote state at its end
   for either state at its start: outside quotes or inside them;
2. chaining these along each file (one row a range) gives every range its true
   start, and each task joins its lines to records. Pieces of records that
   reach over a border are few, at most two a range; they are put together by
   a window over the pieces.

Quotes follow the usual reader: a quote opens a quoted part only at the start of
a field, two of them inside stand for one, and a quote elsewhere is a
character. Lines end at ``\\n`` or ``\\r\\n``; empty lines outside quotes are no
records.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .stages import stage

ROW_ID = "row_id"
BATCH, BATCH_CHARS = 5000, 1 << 20  # of the records that a task holds at once


def inside_after(line: str, inside: bool, sep: str = ",") -> bool:
    """Whether a quoted part is open at the end of ``line``."""
    at, n = 0, len(line)
    while True:
        if inside:
            at = line.find('"', at)
            if at < 0:
                return True
            if line.startswith('"', at + 1):
                at += 2
                continue
            inside = False
            at += 1
        elif at < n and line[at] == '"':
            inside = True
            at += 1
            continue
        at = line.find(sep, at)
        if at < 0:
            return False
        at += 1


def _lines(spark: SparkSession, path) -> DataFrame:
    text = spark.read.option("lineSep", "\n").text(path)
    return text.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, pa.Array]]:
    """(file, start, lines) of successive lines of one range."""
    for batch in batches:
        file, start = batch.column(1).to_pylist(), batch.column(2).to_pylist()
        a = 0
        for b in range(1, len(batch) + 1):
            if b == len(batch) or start[b] != start[a] or file[b] != file[a]:
                yield file[a], start[a], batch.column(0).slice(a, b - a)
                a = b


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(file, start, from_outside, from_inside): the state at the end."""
    found: dict = {}
    for file, start, lines in _runs(batches):
        out, ins = found.get((file, start), (False, True))
        # A line without a quote leaves either state as it is.
        for line in lines.filter(pc.match_substring(lines, '"')).to_pylist():
            out, ins = inside_after(line, out), inside_after(line, ins)
        found[file, start] = (out, ins)
    if found:
        columns = zip(*((*k, *v) for k, v in found.items()), strict=True)
        types = [pa.string(), pa.int64(), pa.bool_(), pa.bool_()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["file", "start", "outside", "inside"])


def ranges_inside(lines: DataFrame) -> dict[tuple[str, int], bool]:
    """Ranges that start inside a quoted part (one row a range is read)."""
    rows = lines.mapInArrow(_ends, "file string, start long, outside boolean, inside boolean").collect()
    out, state, file = {}, False, None
    for r in sorted(rows, key=lambda r: (r["file"], r["start"])):
        if r["file"] != file:
            state, file = False, r["file"]
        if state:
            out[r["file"], r["start"]] = True
        state = r["inside"] if state else r["outside"]
    return out


def _records(batches: Iterator[pa.RecordBatch], begun: dict[tuple[str, int], bool], number: int) -> Iterator[pa.RecordBatch]:
    """Records and pieces of records of one task, numbered from ``number``, in
    batches of some ``BATCH`` rows or ``BATCH_CHARS`` characters."""
    place, inside, open_, whole_file = None, False, None, False
    rows: list[tuple] = []
    chars = 0

    def batch_of():
        nonlocal chars
        types = [pa.int64(), pa.string(), pa.bool_(), pa.string(), pa.int64(), pa.int32()]
        columns = zip(*rows, strict=True)
        names = ["row_id", "record", "first", "file", "start", "piece"]
        out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)
        rows.clear()
        chars = 0
        return out

    def put(text: str, first: bool, piece: int):
        # piece: 0 a whole record, 1 the end or the middle of one, 2 its start.
        nonlocal number, chars
        if piece == 0:
            text = text.removesuffix("\r")
            if not text:
                return
        rows.append((number, text, first, *place, piece))
        number += 1
        chars += len(text)

    def close():
        if open_:
            put("\n".join(open_), whole_file, 1 if headless else 2)

    headless = False
    for file, start, values in _runs(batches):
        if (file, start) != place:
            if place is not None:
                close()
            place, open_ = (file, start), None
            inside = headless = (file, start) in begun
            whole_file = start == 0
            if inside:
                open_ = []
        for line in values.to_pylist():
            inside = inside_after(line, inside) if '"' in line else inside
            if open_ is None and not inside:
                before = number
                put(line, whole_file, 0)
                whole_file = whole_file and number == before
                if len(rows) >= BATCH or chars >= BATCH_CHARS:
                    yield batch_of()
                continue
            open_ = open_ or []
            open_.append(line)
            if not inside:
                put("\n".join(open_), whole_file, 1 if headless else 0)
                open_, headless, whole_file = None, False, False
                if len(rows) >= BATCH or chars >= BATCH_CHARS:
                    yield batch_of()
    if place is not None:
        close()
    if rows:
        yield batch_of()


def csv_records(spark: SparkSession, path) -> DataFrame:
    """(row_id, record, first): the text of every record, ``first`` on the
    first one of each file. ``row_id`` rises with the place in the split and
    is the same when a task is run again."""
    lines = _lines(spark, path)
    begun = ranges_inside(lines)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _records(batches, begun, TaskContext.get().partitionId() << 33)

    found = stage(lines.mapInArrow(join, "row_id long, record string, first boolean, file string, start long, piece int"), "csv-records")
    pieces = found.where("piece > 0")
    # At most two pieces a range: the end of an earlier record and the start of the next.
    group = F.sum((F.col("piece") == 2).cast("int")).over(Window.partitionBy("file").orderBy("start", "piece", "row_id"))
    parts = pieces.withColumn("_g", group).groupBy("file", "_g").agg(
        F.sort_array(F.collect_list(F.struct("start", "piece", "row_id", "record", "first"))).alias("p")
    )
    text = F.regexp_replace(F.array_join(F.col("p.record"), "\n"), "\r$", "")
    joined = parts.select(F.col("p")[0]["row_id"].alias("row_id"), text.alias("record"), F.col("p")[0]["first"].alias("first"))
    return found.where("piece = 0").select("row_id", "record", "first").union(joined)


def read_csv_text(spark: SparkSession, path, schema: str | None = None) -> DataFrame:
    """Columns of a CSV with a header, as text (or by ``schema``), after
    ``row_id``. Files that name other columns than the first are an error."""
    records = csv_records(spark, path)
    heads = [r["record"] for r in records.where("first").select("record").distinct().limit(2).collect()]
    if not heads:
        raise ValueError(f"no header in {path}")
    if len(heads) > 1:
        raise ValueError(f"the files of {path} have different headers")
    names = _fields(heads[0].removeprefix("﻿"))
    ddl = schema or ", ".join(f"`{n}` string" for n in _distinct(names))
    options = {"quote": '"', "escape": '"', "mode": "PERMISSIVE"}
    row = F.from_csv(F.col("record"), ddl, options)
    return records.where("not first").select(F.col(ROW_ID).alias("_row"), row.alias("_r")).select(F.col("_row"), "_r.*")


def _fields(record: str) -> list[str]:
    import csv

    return next(csv.reader([record]))


def _distinct(names: list[str]) -> list[str]:
    """Names as a data-frame reader makes them unique: an empty one is
    ``_c<place>``, a repeated one gets ``.1``, ``.2``."""
    seen: dict[str, int] = {}
    out = []
    for i, n in enumerate(names):
        n = (n or f"_c{i}").replace("`", "")
        k = seen.get(n.lower(), 0)
        seen[n.lower()] = k + 1
        out.append(f"{n}.{k}" if k else n)
    return out
