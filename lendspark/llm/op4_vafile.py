"""Exact top-k inner products by vector-approximation files.

Tasks write the vectors into files of blocks of ``BLOCK`` rows. A block holds
the quantised cells (one byte a component, a grid of ``CELLS`` cells per
component laid over the block's own range), the ids, and the exact integers.
Queries are dealt over tasks; a task scans the cells of all files once per
``QUERY_BLOCK`` queries. A cell's centre and half width give bounds on every
inner product; the kth largest lower bound prunes rows on the way. Then the
exact vectors of what is left are read by range in order of their upper
bounds until no unread bound reaches the kth exact score.

The work is (queries x rows) by its contract; memory is one block, the
pruned candidates of one query block, and one line per block of the files.

Defined cases: vectors that are null or hold a null or a non-finite component
take no part; components are 64-bit integers after scaling, and scores are
64-bit sums; only vectors of equal length are compared (an empty vector with
empty ones, score 0); each row is a query or candidate of its own, so a row
repeated with one id can be another's neighbour; a null id is no query and
loses ties; with fewer than k candidates all are returned; an empty table
gives no row; extra columns are ignored.
"""

from __future__ import annotations

import json
import math
import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import filesystem, scratch_dir, ship, table

BLOCK = 4096
CELLS = 64
QUERY_BLOCK = 512
SCALE = 64
FIRST_READ = 32
READ_GAP = 1 << 14

QUERY = "vec_id long, file string, row long, vector binary"
RESULT = "query_id long, rank int, vec_id long, score long"


def integer_vectors(column: pa.Array, scale: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By length: the rows that take part and their integer components."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = column.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    flat = column.flatten()
    x = flat.cast(pa.float64()).fill_null(math.nan).to_numpy(zero_copy_only=False)
    starts = np.concatenate([[0], np.cumsum(np.maximum(sizes, 0))])
    out = {}
    for d in np.unique(sizes[sizes >= 0]):
        rows = np.flatnonzero(sizes == d)
        v = x[starts[rows][:, None] + np.arange(d)] if d else np.zeros((len(rows), 0))
        good = np.isfinite(v).all(axis=1)
        edge = float(1 << 62)
        out[int(d)] = rows[good], np.clip(np.floor(scale * v[good]), -edge, edge).astype(np.int64)
    return out


def _smallest(v: np.ndarray) -> np.dtype:
    top = int(np.abs(v).max()) if v.size else 0
    return np.dtype(next(t for t, m in (("<i1", 127), ("<i2", 2**15 - 1), ("<i4", 2**31 - 1), ("<i8", 2**63 - 1)) if top <= m))


def block_bytes(ids: list, v: np.ndarray) -> bytes:
    """A block: head (JSON), grid, cells, ids, exact integers."""
    low, high = (v.min(axis=0), v.max(axis=0)) if v.size else (np.zeros(v.shape[1]),) * 2
    low, high = low.astype(np.float64), high.astype(np.float64)
    step = np.maximum((high - low) / CELLS, 1e-300)
    cells = np.clip(np.floor((v - low) / step), 0, CELLS - 1).astype(np.uint8)
    kind = _smallest(v)
    known = np.array([i is not None for i in ids], "u1")
    head = json.dumps({"n": len(ids), "dim": v.shape[1], "kind": kind.str}).encode()
    parts = [low.tobytes(), step.tobytes(), cells.tobytes(), known.tobytes(), np.array([i or 0 for i in ids], "<i8").tobytes(), v.astype(kind).tobytes()]
    return struct.pack("<I", len(head)) + head + b"".join(parts)


class Blocks:
    """The blocks of one file: scanned in order, or single rows by number."""

    def __init__(self, fs, path: str):
        self.file = fs.open_input_file(path)
        self.end = self.file.size()
        self.heads: list[tuple[int, int, int, str, int]] = []  # first row, n, dim, kind, offset of the grid

    def _at(self, offset: int, length: int) -> bytes:
        self.file.seek(offset)
        return self.file.read(length)

    def scan(self, dim: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """(first row, low, step, cells) of the blocks of that length."""
        at, first = 0, 0
        self.heads = []
        while at < self.end:
            (k,) = struct.unpack("<I", self._at(at, 4))
            h = json.loads(self._at(at + 4, k))
            n, d, grid = h["n"], h["dim"], at + 4 + k
            self.heads.append((first, n, d, h["kind"], grid))
            if d == dim:
                data = self._at(grid, 16 * d + n * d)
                low, step = np.frombuffer(data, "<f8", d), np.frombuffer(data, "<f8", d, 8 * d)
                yield first, low, step, np.frombuffer(data, np.uint8, n * d, 16 * d).reshape(n, d)
            at = grid + 16 * d + n * d + 9 * n + n * d * np.dtype(h["kind"]).itemsize
            first += n

    def rows(self, wanted: np.ndarray) -> tuple[list, np.ndarray]:
        """Ids and exact vectors of the ascending row numbers ``wanted``."""
        ids, vectors = [], []
        firsts = np.array([h[0] for h in self.heads])
        of = np.searchsorted(firsts, wanted, side="right") - 1
        for b in np.unique(of):
            first, n, d, kind, grid = self.heads[b]
            inside = wanted[of == b] - first
            at = grid + 16 * d + n * d
            meta = self._at(at, 9 * n)
            known, names = np.frombuffer(meta, "u1", n), np.frombuffer(meta, "<i8", n, n)
            ids += [int(names[i]) if known[i] else None for i in inside]
            width = d * np.dtype(kind).itemsize
            # Rows that lie close together share a read.
            cuts = np.flatnonzero(np.diff(inside) * width > READ_GAP) + 1
            for run in np.split(inside, cuts):
                data = self._at(at + 9 * n + int(run[0]) * width, int(run[-1] - run[0] + 1) * width)
                vectors.append(np.frombuffer(data, kind).reshape(int(run[-1] - run[0] + 1), d)[run - run[0]])
        return ids, np.concatenate(vectors).astype(np.int64)


def write_files(
    vectors: DataFrame, folder: str, is_query: Column, vec_id: str = "vec_id", vector: str = "embedding", scale: int = SCALE
) -> tuple[DataFrame, list[str]]:
    """Write the vector-approximation files; returns the queries (with their
    own row's place) and the names of the files, one per task."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = filesystem(folder)
        out, rows = None, 0
        for batch in batches:
            ids, wanted = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            for good, v in integer_vectors(batch.column(1), scale).values():
                for k in range(0, len(good), BLOCK):
                    part, x = good[k : k + BLOCK], v[k : k + BLOCK]
                    if out is None:
                        fs.create_dir(path, recursive=True)
                        name = f"{uuid.uuid4().hex}.va"
                        out = fs.open_output_stream(f"{path}/{name}", compression=None)
                    out.write(block_bytes([ids[i] for i in part], x))
                    asked = [j for j, i in enumerate(part) if wanted[i]]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([None] + [ids[part[j]] for j in asked], pa.int64()),
                            pa.array([name] * (len(asked) + 1), pa.string()),
                            pa.array([None] + [rows + j for j in asked], pa.int64()),
                            pa.array([None] + [x[j].tobytes() for j in asked], pa.binary()),
                        ],
                        ["vec_id", "file", "row", "vector"],
                    )
                    rows += len(part)
        if out is not None:
            out.close()

    done = f"{folder}/rows"
    source = vectors.select(F.col(vec_id).cast("long").alias("i"), F.col(vector).alias("v"), F.coalesce(is_query, F.lit(False)).alias("q"))
    source.mapInArrow(write, QUERY).write.parquet(done)
    rows = vectors.sparkSession.read.schema(QUERY).parquet(done)
    names = sorted(r[0] for r in rows.select("file").distinct().collect())
    return rows.filter("row is not null"), names


def search_block(files: dict[str, Blocks], queries: list[dict], dim: int, k: int) -> Iterator[dict]:
    """Top k of up to QUERY_BLOCK queries of one length."""
    q = np.stack([np.frombuffer(r["vector"], "<i8") for r in queries])
    qf = q.astype(np.float64)
    size, m = np.abs(qf), len(queries)
    names = list(files)
    own = {(names.index(r["file"]), r["row"]): i for i, r in enumerate(queries)}
    lows = np.full((m, k), -np.inf)
    held: list[tuple[np.ndarray, ...]] = []
    for f, name in enumerate(names):
        mine = np.array([[row, i] for (g, row), i in own.items() if g == f], np.int64).reshape(-1, 2)
        for first, low, step, cells in files[name].scan(dim):
            centre = low + (cells + 0.5) * step
            mid = qf @ centre.T
            half = (size @ (step / 2))[:, None]
            # Room for the rounding of the sums.
            room = half + 1e-9 * (size @ np.maximum(np.abs(low), np.abs(low + CELLS * step)))[:, None] + 1e-6
            here = mine[(mine[:, 0] >= first) & (mine[:, 0] < first + len(cells))]
            mid[here[:, 1], here[:, 0] - first] = -np.inf
            least = np.concatenate([lows, mid - room], axis=1)
            lows = -np.partition(-least, k - 1, axis=1)[:, :k]
            i, j = np.nonzero((mid + room >= lows.min(axis=1)[:, None]) & (mid > -np.inf))
            held.append((i, np.full(len(i), f), first + j, (mid + room)[i, j]))
    i, f, row, bound = (np.concatenate(x) for x in zip(*held, strict=True)) if held else (np.zeros(0, np.int64),) * 4
    keep = bound >= lows.min(axis=1)[i]
    i, f, row, bound = i[keep], f[keep], row[keep], bound[keep]
    order = np.lexsort((row, f, -bound, i))
    i, f, row, bound = i[order], f[order], row[order], bound[order]
    start, stop = np.searchsorted(i, np.arange(m)), np.searchsorted(i, np.arange(m), side="right")
    best: list[list[tuple]] = [[] for _ in range(m)]
    at, take = start.copy(), FIRST_READ
    while True:
        due = [
            x for x in range(m)
            if at[x] < stop[x] and (len(best[x]) < k or bound[at[x]] >= best[x][k - 1][4])
        ]
        if not due:
            break
        parts = np.concatenate([np.arange(at[x], min(stop[x], at[x] + take)) for x in due])
        for g in np.unique(f[parts]):
            mine = parts[f[parts] == g]
            rows, back = np.unique(row[mine], return_inverse=True)
            ids, v = files[names[g]].rows(rows)
            scores = (q[i[mine]] * v[back]).sum(axis=1)
            for p, b, s in zip(mine, back, scores.tolist(), strict=True):
                name = ids[b]
                best[i[p]].append((-s, name is None, name or 0, (g, row[p]), s))
        for x in due:
            best[x] = sorted(best[x])[:k]
            at[x] = min(stop[x], at[x] + take)
        take *= 2
    for r, top in zip(queries, best, strict=True):
        for n, (_, none, name, _, s) in enumerate(top):
            yield {"query_id": r["vec_id"], "rank": n + 1, "vec_id": None if none else name, "score": s}


def search(queries: DataFrame, names: list[str], folder: str, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score) of each query's k best rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = filesystem(folder)
        files = None
        schema = pa.schema([("query_id", pa.int64()), ("rank", pa.int32()), ("vec_id", pa.int64()), ("score", pa.int64())])
        for batch in batches:
            rows = batch.to_pylist()
            files = files or {n: Blocks(fs, f"{path}/{n}") for n in names}
            for dim in sorted({len(r["vector"]) // 8 for r in rows}):
                same = [r for r in rows if len(r["vector"]) // 8 == dim]
                for x in range(0, len(same), QUERY_BLOCK):
                    yield pa.RecordBatch.from_pylist(list(search_block(files, same[x : x + QUERY_BLOCK], dim, k)), schema=schema)

    parts = max(1, math.ceil(queries.count() / QUERY_BLOCK))
    return queries.repartition(parts, F.xxhash64("file", "row")).mapInArrow(run, RESULT)


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, vec_id: str = "vec_id", vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    folder = scratch_dir(vectors.sparkSession, "va-files")
    queries, names = write_files(vectors, folder, is_query, vec_id, vector, scale)
    return search(queries, names, folder, k)


@ship
def op4_vafile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best rows of every query (vec_id divisible by 20) of ``embeddings``."""
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


TOP_K_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS rid, vec_id,
         list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.rid, q.vec_id AS query_id, c.vec_id,
         CAST(coalesce(list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * c.e[i])), 0) AS BIGINT) AS score
  FROM v q JOIN v c ON q.rid <> c.rid AND len(q.e) = len(c.e)
  WHERE q.vec_id % 20 = 0),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id NULLS LAST) AS rank FROM scored)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 20"""

QUERIES = {"op4_vafile": op4_vafile}
SQL = {"op4_vafile": TOP_K_SQL}
