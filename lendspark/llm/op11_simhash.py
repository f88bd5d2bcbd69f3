"""SimHash near-duplicates by tables of distances to pivots.

A document's fingerprint has 64 bits: a bit is set where it is set in over half
of the hashes of its 3-word shingles, repeats counted. Two fingerprints link
when they differ in at most ``near`` (3) bits.

1. Equal fingerprints fold to one before anything is compared.
2. Reference fingerprints (pivots) are picked from a bounded sample, each far
   from those before it. The Hamming distances of two linked fingerprints to
   any pivot differ by at most ``near``: the pair is discarded when the largest
   difference over the pivots is greater, and verified otherwise.
3. A tree of (pivot, cut) planned on the sample deals the fingerprints out:
   those within the cut go left, the others right, and those that a linked
   one across the cut could have go right as well. So any linked pair meets in
   a cell, whatever the plan; the sample decides on cost only.
4. Cells are counted. One far over ``CELL`` fingerprints is dealt by hash
   into g parts whose g * (g + 1) / 2 pairs are tasks of their own: no cell is
   too large, and no pair is left out.
5. In a task, rows are sorted by the distance to the pivot that spreads them
   most, so only a window of it is compared; the table of the other distances
   discards, and the survivors' bits are counted. Pairs already connected
   are not counted again; a task reports one link for each connected member.
6. Components of the links give the smallest id reachable.

Defined cases: a null or empty text and one without words has fingerprint zero
and links like any other; fewer than three words are one shingle; repeated
rows have equal fingerprints and link; a null id is nobody's component id
unless there is no other; very long texts are read in blocks; an empty table
gives no row; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import heavy_keys, lookup_join
from .common import ship, stage, table

WIDTH, SEED, NEAR = 3, 42, 3
SAMPLE = 16_384  # fingerprints that the plan is made on, about
PIVOTS = 64
CELL = 32_000
DENSE, LATER = 6, 8  # pivots compared for whole blocks, then for survivors
BLOCK_PAIRS = 2_000_000
TEXT_BLOCK = 1 << 20
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


# --- fingerprints -----------------------------------------------------------------


def word_blocks(text: bytes) -> Iterator[list[bytes]]:
    """Lower-case words, about TEXT_BLOCK bytes of text at a time."""
    at = 0
    while at < len(text):
        cut = _SPACE.search(text, at + TEXT_BLOCK)
        end = cut.start() if cut else len(text)
        yield text[at:end].lower().split()
        at = end + 1


def fingerprint(text: bytes | None, width: int = WIDTH) -> int:
    """64-bit SimHash of the ``width``-word shingles."""
    ones, total, kept, hash_of = np.zeros(64, np.int64), 0, [], xxhash.xxh64_intdigest
    for words in word_blocks(text or b""):
        words = kept + words
        grams = list(map(b" ".join, zip(*(words[k:] for k in range(width)), strict=False)))
        if grams:
            h = np.array([hash_of(g, SEED) for g in grams], "<u8")
            ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
            total += len(grams)
        kept = words[-(width - 1) :]
    if not total:
        return hash_of(b" ".join(kept), SEED) if kept else 0
    return int(np.packbits(2 * ones > total, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH) -> DataFrame:
    """(doc_id, fp) with the fingerprint as a signed long."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("binary").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = np.array([fingerprint(t.as_py(), width) for t in batch.column(1)], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp.view(np.int64))], ["doc_id", "fp"])

    return rows.mapInArrow(run, f"doc_id {kind}, fp long")


# --- the plan ---------------------------------------------------------------------


def distances(fp: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Hamming distances, one row per fingerprint and one column per pivot."""
    return np.bitwise_count(fp[:, None] ^ pivots[None, :]).astype(np.int8)


def pick_pivots(sample: np.ndarray, n: int = PIVOTS) -> np.ndarray:
    """Fingerprints of the sample, each as far as possible from those before."""
    if not len(sample):
        return np.zeros(1, np.uint64)
    out, far = [sample[0]], np.full(len(sample), 65)
    while len(out) < min(n, len(sample)):
        far = np.minimum(far, np.bitwise_count(sample ^ out[-1]))
        out.append(sample[far.argmax()])
    return np.array(out, np.uint64)


class Plan:
    """The tree: a node is (pivot, cut, left, right), a cell ~number."""

    def __init__(self, sample: np.ndarray, total: int, near: int = NEAR, cell: int = CELL):
        self.pivots, self.near = pick_pivots(sample), near
        self.nodes: list[list[int]] = []
        self.cells = 0
        table_ = distances(sample, self.pivots)
        share = total / max(1, len(sample))
        todo = [(None, 0, np.arange(len(sample)))]
        while todo:
            above, side, rows = todo.pop()
            split = self.split(table_[rows]) if len(rows) * share > cell and len(rows) >= 32 else None
            if split is None:
                number = ~self.cells
                self.cells += 1
            else:
                number = len(self.nodes)
                self.nodes.append([*split, 0, 0])
                d = table_[rows, split[0]]
                todo += [(number, 2, rows[d <= split[1]]), (number, 3, rows[d > split[1] - near])]
            if above is not None:
                self.nodes[above][side] = number
        self.root = 0 if self.nodes else -1

    def split(self, d: np.ndarray) -> tuple[int, int] | None:
        """The pivot and cut that leave the fewest pairs, with those that go both
        ways counted twice; None where no cut saves any."""
        n, k = d.shape
        seen = np.bincount((d.astype(np.int64) + 65 * np.arange(k)).ravel(), minlength=65 * k).reshape(k, 65)
        upto = seen.cumsum(axis=1)
        left = upto.astype(float)
        right = n - np.concatenate([np.zeros((k, self.near)), upto[:, : 65 - self.near]], axis=1)
        # The right side has d > cut - near, so what is counted ends at cut - near.
        work = left**2 + right**2
        pivot, cut = np.unravel_index(work.argmin(), work.shape)
        return (int(pivot), int(cut)) if work[pivot, cut] < 0.97 * n**2 else None

    def deal(self, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, cell): every cell that each fingerprint goes to."""
        d = distances(fp, self.pivots)
        rows, cells = [], []
        stack = [(self.root, np.arange(len(fp)))]
        while stack:
            node, r = stack.pop()
            if not len(r):
                continue
            if node < 0:
                rows.append(r)
                cells.append(np.full(len(r), ~node))
                continue
            pivot, cut, left, right = self.nodes[node]
            at = d[r, pivot]
            stack += [(left, r[at <= cut]), (right, r[at > cut - self.near])]
        return np.concatenate(rows), np.concatenate(cells)


# --- one task ------------------------------------------------------------------------


class Connected:
    """Components of places 0 to n - 1 as an array of their smallest member."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def join(self, x: np.ndarray, y: np.ndarray) -> None:
        a, b = self.label[x], self.label[y]
        codes = np.unique(np.minimum(a, b) * len(self.label) + np.maximum(a, b))
        up: dict[int, int] = {}

        def top(v: int) -> int:
            while up.get(v, v) != v:
                v = up[v]
            return v

        for code in codes.tolist():
            p, q = top(code // len(self.label)), top(code % len(self.label))
            if p != q:
                up[max(p, q)] = min(p, q)
        if up:
            now = np.arange(len(self.label))
            for v in up:
                now[v] = top(v)
            self.label = now[self.label]


def connect(fp: np.ndarray, side: np.ndarray | None, pivots: np.ndarray, near: int = NEAR) -> np.ndarray:
    """Label of every fingerprint under the links among them (those between the
    two sides only, where ``side`` is given)."""
    n, found = len(fp), Connected(len(fp))
    d = distances(fp, pivots)
    best = np.argsort(-d.std(axis=0), kind="stable")[: DENSE + LATER]
    order = np.argsort(d[:, best[0]], kind="stable")
    d = np.ascontiguousarray(d[order][:, best].T)
    a = np.arange(n) if side is None else np.flatnonzero(~side[order])
    b = np.arange(n) if side is None else np.flatnonzero(side[order])
    if not len(a) or not len(b):
        return found.label
    bits, first = fp[order], d[0]
    lead = first[b]
    low = np.searchsorted(lead, first[a] - near, side="left")
    high = np.searchsorted(lead, first[a] + near, side="right")
    k = 0
    while k < len(a):
        # The window grows along the block: as many rows as fit with the last one's.
        step = len(a) - k
        while step > 1 and step * int(high[k + step - 1] - low[k]) > BLOCK_PAIRS:
            step = (step + 1) // 2
        x = a[k : k + step]
        y = b[low[k] : high[min(k + step, len(a)) - 1]]
        k += step
        if not len(y):
            continue
        gap = np.abs(first[x][:, None] - first[y][None, :])
        for t in range(1, min(DENSE, len(d))):
            np.maximum(gap, np.abs(d[t, x][:, None] - d[t, y][None, :]), out=gap)
        i, j = np.nonzero(gap <= near)
        i, j = x[i], y[j]
        # Places are numbers in sorted order here; a pair counts once.
        keep = found.label[i] != found.label[j]
        if side is None:
            keep &= i < j
        i, j = i[keep], j[keep]
        for t in range(DENSE, len(d)):
            keep = np.abs(d[t, i] - d[t, j]) <= near
            i, j = i[keep], j[keep]
        keep = np.bitwise_count(bits[i] ^ bits[j]) <= near
        if keep.any():
            found.join(i[keep], j[keep])
    out = np.empty(n, np.int64)
    out[order] = order[found.label]
    return out


# --- the join -----------------------------------------------------------------------


def links(prints: DataFrame, near: int = NEAR, cell: int = CELL, sample: int = SAMPLE) -> DataFrame:
    """(a, b) fingerprints whose components are those of all links; ``prints``
    has one row per fingerprint ``fp``."""
    spark = prints.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    total = prints.count()
    # About ``sample`` rows by hash, whatever the number of fingerprints.
    every = max(1, total // sample)
    rows = prints.filter(F.pmod(F.xxhash64("fp"), F.lit(every)) == 0).select("fp").collect()
    plan = Plan(np.sort(np.array([r["fp"] for r in rows], np.int64)).view(np.uint64), total, near, cell)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                row, at = plan.deal(batch.column(0).to_numpy().view(np.uint64))
                yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), batch.column(0).take(pa.array(row))], ["cell", "fp"])

    dealt = stage(prints.select("fp").mapInArrow(deal, "cell int, fp long"), "simhash-cells")
    sizes = {r["cell"]: r["n"] for r in dealt.groupBy("cell").agg(F.count("*").alias("n")).collect()}  # one row a cell
    # The plan's sizes are estimates: cells half as large again stay whole.
    parted = {c: -(-n // cell) for c, n in sizes.items() if 2 * n > 3 * cell}

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            at, fp = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            g = np.array([parted.get(c, 1) for c in at.tolist()])
            mine = mixed(fp.view(np.uint64)) % g.astype(np.uint64)
            row = np.repeat(np.arange(len(at)), g)
            other = np.arange(len(row)) - np.repeat(np.cumsum(g) - g, g)
            mine = mine[row].astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(at[row]), pa.array(np.minimum(mine, other), pa.int32()), pa.array(np.maximum(mine, other), pa.int32()),
                    pa.array(mine > other), pa.array(fp[row]),
                ],
                ["cell", "i", "j", "side", "fp"],
            )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def settle() -> pa.RecordBatch:
            whole = pa.Table.from_batches(held)
            fp = whole.column(4).to_numpy().view(np.uint64)
            two = held[0].column(1)[0].as_py() != held[0].column(2)[0].as_py()
            label = connect(fp, whole.column(3).to_numpy() if two else None, plan.pivots, near)
            member = np.flatnonzero(label != np.arange(len(label)))
            pair = [fp[label[member]].view(np.int64), fp[member].view(np.int64)]
            return pa.RecordBatch.from_arrays([pa.array(p) for p in pair], ["a", "b"])

        key = None
        for batch in batches:
            k = np.stack([batch.column(c).to_numpy() for c in range(3)])
            cuts = (np.flatnonzero((k[:, 1:] != k[:, :-1]).any(axis=0)) + 1).tolist()
            for p, q in zip([0, *cuts], [*cuts, len(batch)], strict=True):
                if p == q:
                    continue
                now = tuple(k[:, p].tolist())
                if held and now != key:
                    yield settle()
                    held = []
                key = now
                held.append(batch.slice(p, q - p))
        if held:
            yield settle()

    tasks = dealt.mapInArrow(spread, "cell int, i int, j int, side boolean, fp long")
    tasks = tasks.repartition(parts, "cell", "i", "j").sortWithinPartitions("cell", "i", "j")
    return tasks.mapInArrow(compare, "a long, b long")


def mixed(x: np.ndarray) -> np.ndarray:
    """Scrambled bits, so that parts of a cell are equal in size."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
        return x ^ (x >> np.uint64(29))


def labelled(pairs: DataFrame) -> DataFrame:
    """(fp, label) of every fingerprint in a pair: the smallest reachable.
    Labels take the least of their neighbours' and then that label's own, so
    chains halve; heavy nodes and labels are joined apart."""
    both = pairs.select("a", "b").union(pairs.select("b", "a")).distinct()
    both = stage(both, "simhash-links")
    heavy = stage(heavy_keys(both, "b"), "simhash-hubs")
    labels = stage(both.groupBy(F.col("a").alias("fp")).agg(F.least("a", F.min("b")).alias("label")), "simhash-labels")
    while True:
        near = lookup_join(both, labels.select(F.col("fp").alias("b"), "label"), "b", heavy)
        near = near.groupBy(F.col("a").alias("fp")).agg(F.min("label").alias("near"))
        step = labels.join(near, "fp", "left").select("fp", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        step = stage(step, "simhash-labels")
        further = step.select(F.col("fp").alias("label"), F.col("label").alias("further")).filter("label <> further")
        step = lookup_join(step, further, "label")
        step = stage(step.select("fp", "old", F.coalesce("further", "label").alias("label")), "simhash-labels")
        labels = step.select("fp", "label")
        if step.filter("old <> label").isEmpty():
            return labels


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH, near: int = NEAR) -> DataFrame:
    """(doc_id, fp, component_id), one row per row of ``docs``."""
    rows = stage(fingerprints(docs, doc_id, text, width), "fingerprints")
    prints = stage(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "fingerprints")
    labels = labelled(stage(links(prints, near), "simhash-pairs"))
    # Fingerprints without a link keep their own least id.
    named = stage(prints.join(labels, "fp").select("fp", "label", "least"), "simhash-named")
    groups = named.groupBy("label").agg(F.min("least").alias("component"))
    linked = lookup_join(named.select("fp", "label"), groups, "label").select("fp", "component")
    ids = prints.join(linked, "fp", "left").select("fp", F.coalesce("component", "least").alias("component"))
    out = lookup_join(rows, stage(ids, "simhash-ids"), "fp")
    return out.select("doc_id", "fp", F.coalesce("component", "doc_id").alias("component_id"))


@ship
def op11_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document of ``documents``."""
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


QUERIES = {"op11_simhash": op11_simhash}
SQL: dict[str, str] = {}
