"""Benchmark decontamination: CGK embedding, bit-sampling LSH, exact edits.

Texts are normalised (ASCII case, runs of white space); lengths and edits
are counted in bytes of the normalised UTF-8. An item of n bytes is found in
a document that holds a stretch within k = ``EDITS`` n edits of it.

1. Windows. By the q-gram lemma such a stretch keeps at least
   n - q + 1 - k q of the item's q-grams, on diagonals at most 2 k apart.
   This loses no occurrence and leaves the few places where item-sized
   windows are needed; they start at every word there, and on the densest
   diagonal.
2. Candidates. Every window of the item's length goes through the CGK random
   walk (3 n steps; the current byte is put out, and a random bit for step
   and byte says whether to move on), which turns edits into mismatches.
   ``REPEATS`` walks each sample ``SAMPLES`` positions; a window and an item
   that agree on a whole sample are a candidate. REPEATS follows from the
   target recall at the mismatch rate ``MISMATCH``. For items over ``LONG``
   bytes the walk would cost more than verification: every place that step 1
   leaves is verified.
3. Verification. The exact least number of edits between the item and any
   stretch around the window (bit-parallel dynamic programming).

Items are embedded in the executors and handled in blocks of about
``ITEM_BYTES`` and ``ITEM_BLOCK`` items, which a worker loads in turn, so
what the driver and the tasks hold is bounded by these and the longest item.
Grams that many items share are taken some items at a time (``POSTINGS``
entries), and windows of items of one length are folded at once.
Every whole text is scanned.

Defined cases: a null text holds nothing; items that are null or shorter than
``GRAM`` normalised bytes are too short to tell and match nothing; items with
equal texts are all reported; repeated rows are reported each; an empty table
of either kind gives no row; extra columns pass through ``decontaminate``.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import filesystem, scratch_dir, ship, stage, table, tidy
from .op6_langid import text_bytes
from .shingles import mix

GRAM = 8
EDITS = 0.1
SAMPLES = 6
MISMATCH = 0.35
RECALL = 0.95
REPEATS = math.ceil(math.log(1 - RECALL) / math.log(1 - (1 - MISMATCH) ** SAMPLES))
ITEM_BLOCK = 20_000
ITEM_BYTES = 4 << 20
LONG = 4096
WINDOW_BYTES = 1 << 19
SLICE = 64
CHUNK = 512 << 10
POSTINGS = 500_000
FILTER_BITS = 22
SEED = 20

_U = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_FLAT = np.arange(256, dtype=np.uint8)
_FLAT[65:91] += 32
_FLAT[_SPACE] = 32


def normalise(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, start of each text), every text followed by a zero byte."""
    sizes = ends - starts
    out = np.zeros(int(sizes.sum()) + len(sizes), np.uint8)
    begin = np.concatenate([[0], np.cumsum(sizes + 1)])
    if len(sizes):
        low = int(starts[0])
        keep = np.ones(len(out), bool)
        keep[begin[1:] - 1] = False
        out[keep] = _FLAT[data[low : low + int(sizes.sum())]]
    space = out == 32
    extra = space.copy()
    extra[1:] &= space[:-1]
    extra[:1] = False
    before = np.concatenate([[0], np.cumsum(extra)])
    return out[~extra], begin[:-1] - before[begin[:-1]]


def clean(text: str) -> bytes:
    raw = np.frombuffer((text or "").encode(), np.uint8)
    out, _ = normalise(raw, np.array([0]), np.array([len(raw)]))
    return out[:-1].tobytes().strip(b" ")


def allowed(n: int) -> int:
    """Edits allowed for an item of n bytes (few enough for the lemma)."""
    return max(0, min(int(EDITS * n), (n - GRAM) // GRAM))


def grams(data: np.ndarray) -> np.ndarray:
    n = len(data) - GRAM + 1
    if n <= 0:
        return np.zeros(0, _U)
    out = np.empty(n, _U)
    raw = data.tobytes()
    for o in range(min(GRAM, n)):
        out[o::GRAM] = np.frombuffer(raw, "<u8", (n - o + GRAM - 1) // GRAM, o)
    return out


def least_edits(item: bytes, text: bytes) -> tuple[int, int]:
    """(edits, end): least edits between the item and any stretch of the text."""
    mask: dict[int, int] = {}
    for i, b in enumerate(item):
        mask[b] = mask.get(b, 0) | 1 << i
    n = len(item)
    full, top = (1 << n) - 1, 1 << (n - 1)
    up, down, score, best, at = full, 0, n, n, 0
    for j, b in enumerate(text):
        eq = mask.get(b, 0)
        across = (((eq & up) + up) ^ up) | eq | down
        plus, minus = down | (full & ~(across | up)), up & across
        score += 1 if plus & top else -1 if minus & top else 0
        if score < best:
            best, at = score, j + 1
        plus, minus = (plus << 1) & full, (minus << 1) & full
        eq |= down
        up, down = minus | (full & ~(eq | plus)), plus & eq
    return best, at


@lru_cache(maxsize=64)
def _moves(part: int) -> np.ndarray:
    """A row per step of a slice: for repeat and byte, whether to move on."""
    h = mix(np.arange(part * SLICE * 256, (part + 1) * SLICE * 256, dtype=_U) + (_U(SEED) << _U(40))).reshape(SLICE, 1, 256)
    more = [mix(h + _U(k)) for k in range(1, -(-REPEATS // 64))]
    words = np.concatenate([h, *more], axis=1)  # 64 repeats a word
    r = np.arange(REPEATS)
    moves = (words[:, r // 64] >> (r % 64).astype(_U)[None, :, None] & _U(1)).astype(np.uint8)
    moves[:, :, 0] = 0  # the walk stops at the window's end
    return moves.reshape(SLICE, -1)


def samples(windows: np.ndarray, n: np.ndarray) -> np.ndarray:
    """One key per repeat and window: the walk's bytes at sampled steps.
    Row i of ``windows`` has n[i] bytes and zeros behind them."""
    wide, count = windows.shape[1], len(windows)
    where = np.random.default_rng(SEED).random((REPEATS, SAMPLES))
    steps = (where[:, :, None] * (3 * n)[None, None, :]).astype(np.uint16)  # repeat, sample, window
    lane = np.broadcast_to(np.arange(REPEATS * count).reshape(REPEATS, 1, count), steps.shape).reshape(-1)
    # What is looked at, by step; nothing else of the walk is kept.
    order = np.argsort(steps.reshape(-1), kind="stable")
    until = np.cumsum(np.bincount(steps.reshape(-1)))
    lane, seen = lane[order], np.empty(steps.size, np.uint8)
    flat = np.ascontiguousarray(windows).reshape(-1)
    at = np.tile(np.arange(count) * wide, REPEATS)
    rep = np.repeat(np.arange(REPEATS) * 256, count)
    step, move, now, done = np.empty_like(rep), np.empty(len(rep), np.uint8), np.empty(len(rep), np.uint8), 0
    for j, end in enumerate(until.tolist()):
        flat.take(at, out=now, mode="clip")
        if end > done:
            now.take(lane[done:end], out=seen[done:end], mode="clip")
            done = end
        np.add(rep, now, out=step)
        _moves(j // SLICE)[j % SLICE].take(step, out=move, mode="clip")
        at += move
    found = np.empty_like(seen)
    found[order] = seen
    found, out = found.reshape(steps.shape), np.zeros((REPEATS, count), _U)
    for s in range(SAMPLES):
        out ^= mix(found[:, s, :].astype(_U) + _U(256 * (s + 1)))
    return out


def lsh_keys(windows: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Per repeat and window: its samples, length and repeat as one value."""
    of = mix((np.arange(REPEATS, dtype=_U)[:, None] << _U(32)) + n.astype(_U)[None, :])
    return mix(samples(windows, n) + of)


def stretches(n: np.ndarray) -> Iterator[slice]:
    """Runs of windows, of lengths n in order, that take about WINDOW_BYTES
    when padded to the longest of the run."""
    a = 0
    while a < len(n):
        b = min(len(n), a + 1000)
        while b - a > 1 and int(n[b - 1]) * (b - a) > WINDOW_BYTES:
            b = a + (b - a) // 2
        yield slice(a, b)
        a = b


def embed(texts: list[bytes]) -> np.ndarray:
    """LSH keys per clean text and repeat; texts over LONG bytes have none (0)."""
    out, n = np.zeros((len(texts), REPEATS), _U), np.array([len(t) for t in texts], np.int64)
    order = np.argsort(n, kind="stable")
    order = order[n[order] <= LONG]
    for x in stretches(n[order]):
        wide = int(n[order[x]].max()) + 1
        rows = b"".join(texts[i].ljust(wide, b"\0") for i in order[x])
        out[order[x]] = lsh_keys(np.frombuffer(rows, np.uint8).reshape(-1, wide), n[order[x]]).T
    return out


class Items:
    """One block of items with its q-gram table and LSH keys."""

    def __init__(self, ids: list, texts: list, codes: np.ndarray | None = None):
        """With ``codes`` (see ``embed``) the texts are clean and long enough."""
        if codes is None:
            found = [(i, c) for i, c in zip(ids, map(clean, texts), strict=True) if len(c) >= GRAM]
            ids, texts = [i for i, _ in found], [c for _, c in found]
            codes = embed(texts)
        # By length: items whose windows are the same lie side by side.
        order = sorted(range(len(texts)), key=lambda x: len(texts[x]))
        self.ids, self.texts, codes = [ids[x] for x in order], [texts[x] for x in order], codes[order]
        self.kind = None
        self.n = np.array([len(c) for c in self.texts], np.int64)
        self.k = np.array([allowed(len(c)) for c in self.texts], np.int64)
        self.need = np.maximum(1, self.n - GRAM + 1 - self.k * GRAM)
        keys = [grams(np.frombuffer(c, np.uint8)) for c in self.texts] or [np.zeros(0, _U)]
        flat = np.concatenate(keys)
        item = np.repeat(np.arange(len(self.texts)), [len(x) for x in keys][: len(self.texts)])
        place = np.concatenate([np.arange(len(x)) for x in keys])
        order = np.argsort(flat, kind="stable")
        self.item, self.place = item[order], place[order]
        self.keys, first = np.unique(flat[order], return_index=True)
        # Postings by gram and item, as one value.
        self.posting = np.repeat(np.arange(len(self.keys)), np.diff(np.append(first, len(flat)))) * len(self.texts) + self.item
        self._set_filter()
        # LSH keys of all items and repeats, sorted, with their items.
        short = np.flatnonzero(self.n <= LONG)
        codes = codes[short].T.reshape(-1)
        order = np.argsort(codes, kind="stable")
        self.codes, self.coded = codes[order], np.tile(short, REPEATS)[order]

    def _set_filter(self) -> None:
        self.filter = np.zeros(1 << FILTER_BITS, bool)
        self.filter[self._slot(self.keys)] = True

    def __getstate__(self) -> dict:
        # The filter is far larger than the rest of a small block and made anew.
        return {k: v for k, v in self.__dict__.items() if k != "filter"}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self._set_filter()

    @staticmethod
    def _slot(keys: np.ndarray) -> np.ndarray:
        return (keys * _U(0x9E3779B97F4A7C15)) >> _U(64 - FILTER_BITS)

    def windows(self, data: np.ndarray, starts: np.ndarray) -> tuple[tuple[np.ndarray, ...], tuple[np.ndarray, ...]]:
        """(text, start, n) of the item-sized windows to embed; (text, item,
        first start, last start) of the places of items over LONG bytes."""
        g = grams(data)
        pos = np.flatnonzero(self.filter[self._slot(g)])
        at = np.searchsorted(self.keys, g[pos])
        good = at < len(self.keys)
        good[good] = self.keys[at[good]] == g[pos[good]]
        pos, at = pos[good], at[good]
        texts, span = len(starts), len(data) + 1
        ranges, places = [], []
        todo = [(0, len(self.n))]
        while todo:  # items a to b, fewer where they share the document's grams
            a, b = todo.pop()
            low, high = (np.searchsorted(self.posting, at * len(self.n) + x) for x in (a, b))
            if b - a > 1 and int((high - low).sum()) > POSTINGS:
                todo += [((a + b) // 2, b), (a, (a + b) // 2)]
                continue
            text, item, first, last = self._votes(pos, low, high, starts, a, b)
            far = self.n[item] > LONG
            places.append(np.stack([text[far], item[far], last[far] - self.k[item[far]], first[far] + self.k[item[far]]]))
            text, item, first, last = (v[~far] for v in (text, item, first, last))
            # Equal ranges of items of one length are one.
            ranges.append(np.unique(np.stack([self.n[item] * texts + text, last - self.k[item], first + self.k[item], first]), axis=1))
        group, low, high, diagonal = np.concatenate(ranges, axis=1)
        # Word starts in any of the ranges, and the diagonals themselves.
        order = np.lexsort((low, group))
        g, low, high = group[order], low[order], high[order]
        wide = span + 4 * LONG
        until = np.maximum.accumulate(g * wide + high + 2 * LONG)
        fresh = np.flatnonzero(np.concatenate([[True], g[1:] * wide + low[1:] + 2 * LONG > until[:-1]])[: len(g)])
        g, low, high = g[fresh], low[fresh], until[np.append(fresh[1:], len(until)) - 1] - g[fresh] * wide - 2 * LONG if len(g) else high
        space = np.flatnonzero(_SPACE[data] | (data == 0)) + 1
        space = np.concatenate([[0], space])
        a, b = np.searchsorted(space, low), np.searchsorted(space, high, side="right")
        times = b - a
        pick = np.repeat(a - np.concatenate([[0], np.cumsum(times)])[: len(a)], times) + np.arange(int(times.sum()))
        start, group = np.concatenate([space[pick], diagonal]), np.concatenate([np.repeat(g, times), group])
        start = np.maximum(start, starts[group % texts])
        inside = start < (np.append(starts[1:], len(data)) - 1)[group % texts]
        # Windows of like length side by side: they walk together.
        found = np.unique(group[inside] * span + start[inside])
        group = found // span
        return (group % texts, found % span, group // texts), tuple(np.concatenate(places, axis=1))

    def _votes(self, pos, low, high, starts, a, b):
        """(text, item, first diagonal, last diagonal) where ``need`` grams of
        one of the items a to b lie near each other; postings low to high of
        every position."""
        times = high - low
        entry = np.repeat(low - np.concatenate([[0], np.cumsum(times)])[: len(low)], times) + np.arange(int(times.sum()))
        item, diagonal = self.item[entry], np.repeat(pos, times) - self.place[entry]
        text = np.repeat(np.searchsorted(starts, pos, side="right") - 1, times)
        # Diagonals of one text and item side by side.
        most = int(self.n[a:b].max())
        span = int(pos.max()) + 1 + most if len(pos) else 1
        code = (text * (b - a) + item - a) * span + diagonal + most
        code.sort()
        group, diagonal = code // span, code % span - most
        item = group % (b - a) + a
        ahead = np.arange(len(code)) + self.need[item] - 1
        x = np.flatnonzero(ahead < len(code))
        y = ahead[x]
        same = (group[y] == group[x]) & (diagonal[y] - diagonal[x] <= 2 * self.k[item[x]])
        x, y = x[same], y[same]
        return group[x] // (b - a), item[x], diagonal[x], diagonal[y]

    def find(self, column: pa.Array) -> dict[tuple[int, int], int]:
        """{(row, item's index): least edits} of a column of texts."""
        out: dict[tuple[int, int], int] = {}
        data, starts, ends = text_bytes(column)
        first = 0
        while first < len(starts) and len(self.texts):
            stop = max(first + 1, int(np.searchsorted(ends, starts[first] + CHUNK)))
            flat, begin = normalise(data, starts[first:stop], ends[first:stop])
            (text, start, n), places = self.windows(flat, begin)
            ends_of = np.append(begin[1:], len(flat)) - 1
            for x in stretches(n):
                self._check(flat, begin, ends_of, text[x], start[x], n[x], first, out)
            self._verify(flat, begin, ends_of, zip(*(v.tolist() for v in places), strict=True), first, out)
            first = stop
        return out

    def _check(self, flat, begin, ends, text, start, n, first, out) -> None:
        wide = int(n.max()) + 1
        at = start[:, None] + np.arange(wide)
        inside = (at < ends[text][:, None]) & (np.arange(wide) < n[:, None])
        windows = np.where(inside, flat[np.minimum(at, len(flat) - 1)], 0).astype(np.uint8)
        codes = lsh_keys(windows, n).reshape(-1)
        low, high = (np.searchsorted(self.codes, codes, side=side) for side in ("left", "right"))
        hits = np.flatnonzero(high > low)
        pairs = {(int(h) % len(n), int(x)) for h in hits for x in self.coded[low[h] : high[h]]}
        places = ((int(text[w]), x, int(start[w]), int(start[w])) for w, x in pairs if n[w] == self.n[x])
        self._verify(flat, begin, ends, places, first, out)

    def _verify(self, flat, begin, ends, places, first, out) -> None:
        # Windows of one text and item that overlap are verified as one stretch.
        spans: dict[tuple[int, int], list[list[int]]] = {}
        for t, x, low, high in sorted(places, key=lambda p: p[2]):
            k = int(self.k[x])
            a, b = max(int(begin[t]), low - k), min(int(ends[t]), high + int(self.n[x]) + k)
            mine = spans.setdefault((t, x), [])
            if mine and a <= mine[-1][1]:
                mine[-1][1] = max(b, mine[-1][1])
            else:
                mine.append([a, b])
        for (t, x), mine in spans.items():
            key, k = (first + t, x), int(self.k[x])
            for a, b in mine:
                near = flat[a:b].tobytes()
                edits = 0 if self.texts[x] in near else least_edits(self.texts[x], near)[0]
                if edits <= k and edits < out.get(key, k + 1):
                    out[key] = edits


def item_blocks(items: DataFrame, item_id: str = "item_id", text: str = "text") -> Iterator[Items]:
    rows = items.select(F.col(item_id).alias("i"), F.col(text).alias("t")).filter("t is not null")
    kind = rows.schema["i"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, len(batch), 1000):
                part = batch.slice(a, 1000)
                texts = [clean(t) for t in part.column(1).to_pylist()]
                stays = pa.array([len(c) >= GRAM for c in texts], pa.bool_())
                codes = pa.array([c.astype("<u8").tobytes() for c in embed(texts)], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.binary()), codes], ["i", "t", "codes"]).filter(stays)

    found = stage(rows.mapInArrow(tidy(run), f"i {kind}, t binary, codes binary"), "benchmark-items")
    size = found.agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("t")).alias("bytes")).first()
    blocks = max(math.ceil(size["n"] / ITEM_BLOCK), math.ceil((size["bytes"] or 0) / ITEM_BYTES))
    for b in range(blocks):
        part = found.filter(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == b) if blocks > 1 else found
        held = part.toArrow()
        ids, texts, codes = (held.column(c).to_pylist() for c in ("i", "t", "codes"))
        block = Items(ids, texts, np.frombuffer(b"".join(codes), "<u8").astype(_U).reshape(-1, REPEATS))
        block.kind = held.schema.field("i").type
        yield block


class Stored:
    """Item blocks in files of the shared folder; a worker holds one of them
    at a time, however many there are."""

    def __init__(self, blocks: Iterator[Items], folder: str):
        fs, path = filesystem(folder)
        fs.create_dir(path, recursive=True)
        self.files: list[str] = []
        for block in blocks:
            name = f"{len(self.files)}.items"
            with fs.open_output_stream(f"{path}/{name}", compression=None) as out:
                out.write(pickle.dumps(block))
            self.files.append(f"{folder}/{name}")
        self.held: tuple[str, Items] | None = None

    def __iter__(self) -> Iterator[Items]:
        for uri in self.files:
            if self.held is None or self.held[0] != uri:
                self.held = None
                fs, path = filesystem(uri)
                with fs.open_input_stream(path, compression=None) as file:
                    self.held = uri, pickle.loads(file.read())
            yield self.held[1]


def leaks(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id") -> DataFrame:
    """(doc_id, item_id, edits) of every document row and item found in it."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("binary").alias("text"))
    kinds = [t.simpleString() for t in (rows.schema["doc_id"].dataType, items.schema[item_id].dataType)]
    blocks = Stored(item_blocks(items, item_id), scratch_dir(docs.sparkSession, "item-blocks"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks:
                found = sorted(block.find(batch.column(1)).items())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array([r for (r, _), _ in found], pa.int64())),
                        pa.array([block.ids[x] for (_, x), _ in found], block.kind),
                        pa.array([e for _, e in found], pa.int32()),
                    ],
                    ["doc_id", "item_id", "edits"],
                )

    return rows.mapInArrow(tidy(run), f"doc_id {kinds[0]}, item_id {kinds[1]}, edits int")


def decontaminate(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id") -> DataFrame:
    """The rows of ``docs`` that hold no item, with their columns."""
    from pyspark.sql import types as T

    names = docs.columns
    rows = docs.toDF(*[f"c{k}" for k in range(len(names))])
    schema = T.StructType([T.StructField(f"c{k}", f.dataType) for k, f in enumerate(rows.schema.fields)])
    at = names.index(text)
    blocks = Stored(item_blocks(items, item_id), scratch_dir(docs.sparkSession, "item-blocks"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks:
                stays = np.ones(len(batch), bool)
                stays[[r for r, _ in block.find(batch.column(at))]] = False
                batch = batch.filter(pa.array(stays))
            yield batch

    return rows.mapInArrow(tidy(run), schema).toDF(*names)


@ship
def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items found in the whole texts of ``documents``."""
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {"op10_decontaminate": op10_decontaminate}
SQL: dict[str, str] = {}
