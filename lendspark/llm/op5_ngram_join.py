"""N-gram Jaccard join by token-combination prefixes.

Documents are sets of word shingles; two link when their Jaccard similarity
reaches a threshold given as a whole fraction (80 / 100).

1. Equal sets are one class from the start (a 128-bit digest of the sorted
   set), so copies never meet as pairs.
2. One text of every class is kept, in blocks. The blocks ask hash buckets
   for the number of classes of each of their distinct shingles. A shingle of
   one class cannot be shared; only repeated shingles go on.
3. Shingles are ordered by (count, hash), the rarest first (counts from 128
   in steps of a sixteenth of a doubling). Linked sets share
   at least o = ceil(0.8 n) shingles, so their prefixes of n - o + K shingles
   share K of them (K = 2). A class whose unique shingles leave fewer than K
   places in its prefix has no link. The others are indexed: a rare prefix
   shingle by itself, frequent ones (``FREQUENT`` classes or more) in
   combinations of K. Sets over ``LONG`` shingles would have too many
   combinations; they index single shingles of the plain prefix for links
   among themselves, and those near the border do both.
4. Classes under one key are compared with the smallest of them (their hub).
   Those that do not link to the hub are compared with every member of the
   hub's group, in blocks of ``BLOCK`` classes spread over the tasks. So all
   pairs that share a key are decided, but a group whose members link to the
   hub costs one comparison each.
5. Components of the verified links give the smallest id reachable.

No pair list of a group is ever emitted: a block reports a spanning forest
of its links. Overlaps are counted on the repeated shingles only, which hold
every shared one.

Defined cases: a null text, an empty one, and one without words have an empty
set, link with nothing and are their own component; fewer words than the
width count as one shingle of the whole sequence; repeated rows are equal
sets and so linked; a null id never becomes a component's id unless there is
no other; an empty table gives no row. Extra columns are ignored.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import lookup_join
from .common import ship, stage, table, tidy
from .components import components
from .op6_langid import text_bytes
from .shingles import mix, shingles

WIDTH = 5
NEAR, OF = 80, 100
K = 2
FREQUENT = 64
LONG = 310
BLOCK = 128
TEXTS = 100
BLOCK_BYTES = 4_000_000
BUCKET_SHINGLES = 2_000_000


def overlap_least(n: int) -> int:
    """Shingles that a set of n shares with any set it links to, at least."""
    return -(-NEAR * n // OF)


def linked(shared, n, m):
    return OF * shared >= NEAR * (n + m - shared)


def digest(s: np.ndarray) -> bytes:
    """16 bytes that stand for a sorted set."""
    with np.errstate(over="ignore"):
        a, b = mix(s).sum(dtype=np.uint64), mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)
    return int(a).to_bytes(8, "little") + (int(b) ^ len(s)).to_bytes(8, "little")


def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH) -> DataFrame:
    """(doc_id, n_shingles, c): the size and class of every document's set;
    c is null for an empty set."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("binary").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, len(batch), TEXTS):
                part = batch.slice(k, TEXTS)
                sets = shingles(*text_bytes(part.column(1)), width)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([digest(s) if len(s) else None for s in sets], pa.binary()),
                    ],
                    ["doc_id", "n_shingles", "c"],
                )

    return rows.mapInArrow(tidy(run), f"doc_id {kind}, n_shingles long, c binary")


def _groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, list[dict]]]:
    """Rows by runs of equal values in the first ``keys`` columns."""
    key, held = None, []
    for batch in batches:
        # Python copies of a few rows at a time: a batch may hold thousands of blobs.
        for r in (r for k in range(0, len(batch), 64) for r in batch.slice(k, 64).to_pylist()):
            now = tuple(list(r.values())[:keys])
            if now != key:
                if held:
                    yield key, held
                key, held = now, []
            held.append(r)
    if held:
        yield key, held


def count_codes(n: np.ndarray) -> np.ndarray:
    """A byte for a number of classes that never falls as the number grows:
    exact below 128, sixteen steps to a doubling above, 255 at the end."""
    return np.where(n < 128, n, np.minimum(255, 128 + 16 * np.log2(np.maximum(n, 128) / 128))).astype(np.uint8)


def distinct_texts(docs: DataFrame, parts: int, text: str = "text", width: int = WIDTH) -> DataFrame:
    """(ref, ends, body): one text of every class, in blocks of about
    ``BLOCK_BYTES`` (the texts one behind the other, compressed). Written
    as a stage table, so that a block keeps its members when a task is redone."""

    def one_a_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            for k in range(0, len(batch), TEXTS):
                part = batch.column(0).slice(k, TEXTS)
                names = [digest(s) if len(s) else None for s in shingles(*text_bytes(part), width)]
                fresh = [x for x, c in enumerate(names) if c is not None and not (c in seen or seen.add(c))]
                if fresh:
                    yield pa.RecordBatch.from_arrays([pa.array([names[x] for x in fresh], pa.binary()), part.take(pa.array(fresh))], ["c", "text"])

    def block(held: list[bytes]) -> pa.RecordBatch:
        ends = np.cumsum([len(t) for t in held]).astype("<i8").tobytes()
        row = [uuid.uuid4().bytes], [ends], [zstandard.ZstdCompressor(level=1).compress(b"".join(held))]
        return pa.RecordBatch.from_arrays([pa.array(x, pa.binary()) for x in row], ["ref", "ends", "body"])

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        held, size = [], 0
        for batch in batches:
            for c, t in zip(batch.column(0), batch.column(1), strict=True):
                c = c.as_py()
                if c in seen:
                    continue
                seen.add(c)
                held.append(t.as_py())
                size += len(held[-1])
                if size >= BLOCK_BYTES:
                    yield block(held)
                    held, size = [], 0
        if held:
            yield block(held)

    sent = docs.select(F.col(text).cast("binary").alias("text")).mapInArrow(tidy(one_a_task), "c binary, text binary")
    return stage(sent.repartition(parts, "c").mapInArrow(tidy(blocks), "ref binary, ends binary, body binary"), "class-texts")


def block_sets(ends: bytes, body: bytes, width: int) -> list[np.ndarray]:
    """The shingle sets of a block's texts."""
    cuts = np.concatenate([[0], np.frombuffer(ends, "<i8")])
    data = np.frombuffer(zstandard.ZstdDecompressor().decompress(body), np.uint8)
    # Hashing takes eight bytes and more a byte of text: few texts at a time.
    return [s for k in range(0, len(cuts) - 1, TEXTS) for s in shingles(data, cuts[k:-1][:TEXTS], cuts[k + 1 :][:TEXTS], width)]


def repeated_shingles(docs: DataFrame, total: int, text: str = "text", width: int = WIDTH) -> DataFrame:
    """(c, n, rare, shingles) of the classes that may link: n the set's size,
    shingles its repeated ones in global order (8 bytes each), of which the
    first ``rare`` belong to fewer than FREQUENT classes.

    A block asks every bucket for the counts of its distinct hashes (sorted,
    four bytes each) and gets a byte for each back, in their order: no names
    travel. Two hashes of a bucket that agree in these bytes (one in a
    thousand) are counted as one, which can only make a shingle more frequent.
    """
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(parts, math.ceil(total / BUCKET_SHINGLES))
    texts = distinct_texts(docs, buckets, text, width)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(len(batch)):
                ref, ends, body = (batch.column(x)[k].as_py() for x in range(3))
                h, n = np.unique(np.concatenate(block_sets(ends, body, width)), return_counts=True)
                # Buckets are ranges of the hash, so that sorted hashes lie bucket by bucket.
                at = ((h >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
                full, first = np.unique(at, return_index=True)
                cuts = np.append(first, len(h)).tolist()
                h, n = (h & np.uint64(0xFFFFFFFF)).astype("<u4"), n.astype("<u4")
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(full.astype(np.int32)),
                        pa.array([ref] * len(full), pa.binary()),
                        pa.array([h[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary()),
                        pa.array([n[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary()),
                    ],
                    ["bucket", "ref", "hashes", "counts"],
                )

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (bucket,), rows in _groups(batches, 1):
            cuts = np.cumsum([0] + [len(r["hashes"]) // 4 for r in rows]).tolist()
            h = np.frombuffer(b"".join(r["hashes"] for r in rows), "<u4")
            n = np.frombuffer(b"".join(r["counts"] for r in rows), "<u4")
            refs = [r["ref"] for r in rows]
            rows.clear()
            order = np.argsort(h, kind="stable")
            s = h[order]
            first = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]]))
            df = np.add.reduceat(n[order], first, dtype=np.int64)
            codes = np.empty(len(h), np.uint8)
            codes[order] = np.repeat(count_codes(df), np.diff(np.append(first, len(h))))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(refs, pa.binary()),
                    pa.array([bucket] * len(refs), pa.int32()),
                    pa.array([codes[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary()),
                ],
                ["ref", "bucket", "codes"],
            )

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, (head, *rest) in _groups(batches, 1):
            sets = block_sets(head["ends"], head["body"], width)
            codes = np.frombuffer(b"".join(r["codes"] for r in rest), np.uint8)
            cuts = np.cumsum([0] + [len(s) for s in sets])
            flat = np.concatenate(sets)
            order = np.argsort(flat, kind="stable")
            rank = np.cumsum(np.concatenate([[False], flat[order[1:]] != flat[order[:-1]]]))
            df = np.empty(len(flat), np.uint8)
            df[order] = codes[rank]
            shared = np.add.reduceat(df > 1, cuts[:-1], dtype=np.int64).tolist()
            out = []
            for x, s in enumerate(sets):
                if prefix(len(s), shared[x]) < K:
                    continue
                mine = df[cuts[x] : cuts[x + 1]]
                order = np.argsort(mine, kind="stable")[len(s) - shared[x] :]  # s is sorted, so equal counts stay by hash
                rare = int(np.searchsorted(mine[order], FREQUENT))
                out.append({"c": digest(s), "n": len(s), "rare": rare, "shingles": s[order].astype("<u8").tobytes()})
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema([("c", pa.binary()), ("n", pa.int64()), ("rare", pa.int64()), ("shingles", pa.binary())]))

    asked = texts.mapInArrow(tidy(ask), "bucket int, ref binary, hashes binary, counts binary")
    answers = asked.repartitionById(buckets, F.col("bucket")).sortWithinPartitions("bucket").mapInArrow(tidy(answer), "ref binary, bucket int, codes binary")
    nothing = F.lit(None).cast("binary")
    both = texts.select("ref", F.lit(-1).alias("bucket"), nothing.alias("codes"), "ends", "body").union(
        answers.select("ref", "bucket", "codes", nothing.alias("ends"), nothing.alias("body"))
    )
    dealt = both.repartition(max(parts, math.ceil(texts.count() / 8)), "ref").sortWithinPartitions("ref", "bucket")
    return dealt.mapInArrow(tidy(finish), "c binary, n long, rare long, shingles binary")


def prefix(n: int, repeated: int) -> int:
    """How many repeated shingles lie in the extended prefix of a set of n;
    the unique ones come first in the order."""
    return min(n, n - overlap_least(n) + K) - (n - repeated)


def index_keys(n: int, rare: int, s: np.ndarray) -> np.ndarray:
    """Keys of one class from its repeated shingles in order."""
    p = prefix(n, len(s))
    keys = []
    if n <= LONG * OF // NEAR + 1:
        singles, often = s[: min(p, rare)], s[min(p, rare) : p]
        a, b = np.triu_indices(len(often), 1)
        with np.errstate(over="ignore"):
            keys += [singles, mix(often[a] + mix(often[b]))]
    if n > LONG:
        keys.append(mix(s[: p - K + 1] ^ np.uint64(0xA5A5A5A5)))
    return np.concatenate(keys)


def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of every left with every right set."""
    flat = np.concatenate(left + right)
    own = np.repeat(np.arange(len(left) + len(right)), [len(s) for s in left + right])
    _, token, n = np.unique(flat, return_inverse=True, return_counts=True)
    keep = n[token] > 1
    _, token = np.unique(token[keep], return_inverse=True)
    own, out = own[keep], np.zeros((len(left), len(right)), np.float32)
    width = 1 << 14
    for a in range(0, int(token.max()) + 1 if len(token) else 0, width):
        here = (token >= a) & (token < a + width)
        grid = np.zeros((len(left) + len(right), width), np.float32)
        grid[own[here], token[here] - a] = 1
        out += grid[: len(left)] @ grid[len(left) :].T
    return out.astype(np.int64)


def forest(pairs: Iterator[tuple[bytes, bytes]]) -> list[tuple[bytes, bytes]]:
    """Star-shaped spanning forest of the given links."""
    up: dict[bytes, bytes] = {}

    def top(x: bytes) -> bytes:
        while up.setdefault(x, x) != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in pairs:
        a, b = top(a), top(b)
        if a != b:
            up[max(a, b)] = min(a, b)
    return [(top(x), x) for x in list(up) if top(x) != x]


def links(alive: DataFrame) -> DataFrame:
    """(a, b) class pairs whose components are those of all links."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                k = index_keys(r["n"], r["rare"], np.frombuffer(r["shingles"], "<u8"))
                yield pa.RecordBatch.from_arrays([pa.array(k.view(np.int64)), pa.array([r["c"]] * len(k), pa.binary())], ["key", "c"])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yes = []
            for k in range(len(batch)):
                n, s, m, t = (batch.column(x)[k].as_py() for x in (2, 3, 4, 5))
                shared = len(np.intersect1d(np.frombuffer(s, "<u8"), np.frombuffer(t, "<u8"), assume_unique=True))
                yes.append(bool(linked(shared, n, m)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(yes)], ["hub", "c", "yes"])

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _groups(batches, 3):
            left, right = [r for r in rows if r["open"]], [r for r in rows if not r["open"]]
            if not left or not right:
                continue
            shared = overlaps(*([np.frombuffer(r["s"], "<u8") for r in side] for side in (left, right)))
            n, m = np.array([r["n"] for r in left]), np.array([r["n"] for r in right])
            x, y = np.nonzero(linked(shared, n[:, None], m[None, :]))
            edges = forest((left[i]["c"], right[j]["c"]) for i, j in zip(x.tolist(), y.tolist(), strict=True))
            if edges:
                yield pa.RecordBatch.from_arrays([pa.array([e[k] for e in edges], pa.binary()) for k in (0, 1)], ["a", "b"])

    keyed = alive.mapInArrow(tidy(keys), "key long, c binary")
    hubs = keyed.groupBy("key").agg(F.min("c").alias("hub"), F.max("c").alias("last")).filter("hub <> last").select("key", "hub")
    pairs = stage(keyed.join(hubs, "key").filter("c <> hub").select("hub", "c").distinct(), "hub-pairs")
    sets = alive.select("c", F.col("n"), F.col("shingles").alias("s"))
    hub_sets = alive.select(F.col("c").alias("hub"), F.col("n").alias("m"), F.col("shingles").alias("t"))
    checked = pairs.join(sets, "c").join(hub_sets, "hub").select("hub", "c", "n", "s", "m", "t")
    checked = stage(checked.mapInArrow(tidy(verify), "hub binary, c binary, yes boolean"), "hub-links")
    sizes = (
        checked.groupBy("hub").agg(F.count("*").alias("members"), F.sum((~F.col("yes")).cast("long")).alias("opens"))
        .filter("opens > 0 and members > 1")
        .select("hub", "members", F.ceil(F.col("opens") / BLOCK).alias("left"), F.ceil(F.col("members") / BLOCK).alias("right"))
    )
    # One hub may have a third of all classes.
    grouped = lookup_join(checked, sizes, "hub", weight="members", row_key="c").filter("members is not null").withColumn("h", F.xxhash64("c"))
    at = lambda side: F.pmod("h", F.col(side))
    every = lambda side: F.explode(F.sequence(F.lit(0).cast("long"), F.col(side) - 1))
    open_rows = grouped.filter("not yes").select("hub", at("left").alias("i"), every("right").alias("j"), F.lit(True).alias("open"), "c")
    all_rows = grouped.select("hub", every("left").alias("i"), at("right").alias("j"), F.lit(False).alias("open"), "c")
    dealt = open_rows.union(all_rows).join(sets, "c").select("hub", "i", "j", "open", "c", "n", "s")
    found = dealt.repartition("hub", "i", "j").sortWithinPartitions("hub", "i", "j").mapInArrow(tidy(blocks), "a binary, b binary")
    return checked.filter("yes").select(F.col("hub").alias("a"), F.col("c").alias("b")).union(found)


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH) -> DataFrame:
    """(doc_id, n_shingles, c, label, component_id), one row per row of
    ``docs``; c is the set's class, label its component's smallest class."""
    rows = stage(classes(docs, doc_id, text, width), "classes")
    total = rows.agg(F.sum("n_shingles")).first()[0] or 0
    alive = stage(repeated_shingles(docs, total, text, width), "alive")
    labels = components(links(alive)).withColumnRenamed("node", "c")
    named = rows.filter("c is not null").groupBy("c").agg(F.min("doc_id").alias("id"), F.count(F.lit(1)).alias("copies"))
    named = stage(named.join(labels, "c", "left").withColumn("label", F.coalesce("label", "c")), "labels-of-classes")
    least = named.groupBy("label").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("members"))
    # One component may hold a third of all classes, one class a third of all rows.
    named = stage(lookup_join(named, least, "label", weight="members", row_key="c"), "least-of-classes")
    out = lookup_join(rows, named.select("c", "label", "least", "copies"), "c", weight="copies")
    return out.select("doc_id", "n_shingles", "c", "label", F.coalesce("least", "doc_id").alias("component_id"))


def drop_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH) -> DataFrame:
    """``docs`` with one row of every component: that of the smallest id
    (of its equal rows one; of linked rows with that id and different sets the
    one with the smallest digest). Documents without words all stay."""
    found = stage(near_duplicates(docs, doc_id, text, width), "near-duplicates")
    first = F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "c")
    kept = found.filter("label is not null").groupBy("label").agg(F.min(first).alias("kept"))
    marked = found.join(kept, "label", "left").withColumn(
        "stays", F.col("label").isNull() | (F.col("doc_id").eqNullSafe(F.col("kept.doc_id")) & (F.col("c") == F.col("kept.c")))
    ).select("doc_id", "c", "stays")
    marked = stage(marked, "kept-rows")
    by_id = marked.groupBy("doc_id").agg(
        F.count("*").alias("rows"), F.sum(F.col("stays").cast("long")).alias("stay"), F.count("c").alias("worded")
    )
    by_id = stage(by_id.filter("stay = 0 or (rows > 1 and worded > 0)"), "ids")
    gone = by_id.select(F.col("doc_id").alias("__nd_gone"))
    out = docs.join(gone, F.col(doc_id).eqNullSafe(F.col("__nd_gone")), "left_anti")
    # Ids on several rows, rarely any: their rows are told apart by text.
    mixed = by_id.filter("stay > 0").select(F.col("doc_id").alias("__nd_id"))
    if mixed.isEmpty():
        return out
    several = docs.join(mixed, F.col(doc_id).eqNullSafe(F.col("__nd_id")), "left_semi")
    texts = several.select(F.xxhash64(text).alias("__nd_hash"), F.col(text).alias("__nd_text"))
    named = classes(texts, "__nd_hash", "__nd_text", width).select(F.col("doc_id").alias("__nd_hash"), F.col("c").alias("__nd_c")).distinct()
    rows = several.join(named, F.xxhash64(text) == F.col("__nd_hash"))
    stay = marked.filter("stays and c is not null").select(F.col("doc_id").alias("__nd_id"), F.col("c").alias("__nd_kept")).distinct()
    worded = rows.join(stay, F.col(doc_id).eqNullSafe(F.col("__nd_id")) & (F.col("__nd_c") == F.col("__nd_kept")))
    one = worded.dropDuplicates([doc_id, "__nd_c"]).select(*docs.columns)
    return out.unionByName(rows.filter("__nd_c is null").select(*docs.columns)).unionByName(one)


@ship
def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document of ``documents`` under 5-word shingles."""
    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


QUERIES = {"op5_ngram_join": op5_ngram_join}
SQL: dict[str, str] = {}
