"""Prefix trie of conversations by sparse tables over sorted prefix lengths.

A conversation is its turns in order; every distinct sequence of first turns is
a node of the trie, the empty sequence its root.

1. A turn becomes a unit of 20 bytes (128-bit digest of role and text, and the
   text's code points), so texts are not shuffled, and a conversation one
   binary key. Equal keys are one class: copies fold before anything is
   compared. The ids of a class are joined in packs by ranges, and each
   class's packs hashed as a stream, so no list of ids is ever held.
2. Classes are dealt by ranges of their key and sorted. In every range the
   common prefix of neighbours (LCP) is taken, with a sparse table for the
   least LCP between any two places. Every candidate prefix (class, depth)
   searches its left and its right extent in that table by halving steps, each
   by itself; the candidate at its left extent stands for the node. Nodes in
   order of (class, depth) are the trie in preorder, so a subtree is a run of
   nodes: members, leaves and savings are differences of running sums.
3. Nodes that touch the border of a range may go on in the next one. They are
   prefixes of the range's first or last key, so each range hands over those
   two keys with one partial sum a depth. The same search over all first and
   last keys (two a range, whatever the input) gives their totals.

Defined cases: a null conversation id is no conversation and its rows are left
out; null turns come first; equal turns are ordered by the digest of role
and text, repeated rows are kept; a null role or text is empty; a
conversation without turns is a member of the root only; an empty table has no
node; a conversation's units (20 bytes a turn) are held by one task, its texts
never are; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ship, stage, table

UNIT = 20
PACK = 512  # ids in one pack
RANGE_BYTES = 8_000_000  # of keys in one range, about
CANDIDATES = 500_000  # searched at a time
NO_END = hashlib.sha256(b"").hexdigest()

NODE_FIELDS = [
    ("conv_id", pa.int64()), ("depth", pa.int64()), ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()),
    ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("ends", pa.string()),
    ("part", pa.int64()), ("up", pa.int64()), ("edge", pa.binary()),
]
NODE_SCHEMA = pa.schema(NODE_FIELDS)
NODE_DDL = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long,"
    " saved_tokens long, ends string, part long, up long, edge binary"
)


# --- conversations as keys -----------------------------------------------------


def turn_units(conversations: DataFrame) -> DataFrame:
    """(conv_id, units): the turns of each conversation in order, UNIT bytes each."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    named = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    unit = F.concat(F.md5(named.cast("binary")), F.lpad(F.hex(F.length(text)), 8, "0"))
    rows = conversations.filter("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", unit.alias("unit"))
    turns = F.sort_array(F.collect_list(F.struct("turn", "unit")))
    return rows.groupBy("conv_id").agg(F.unhex(F.array_join(turns["unit"], "")).alias("units"))


def rebuilt(turns: DataFrame) -> DataFrame:
    """(conv_id, key): every conversation c with its first crc32(c) % 6 turns
    replaced by those of conversation c - c % 100."""
    taken = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6).cast("int") * UNIT
    heads = turns.filter("conv_id % 100 = 0").select(F.col("conv_id").alias("base"), F.expr(f"substring(units, 1, {5 * UNIT})").alias("head"))
    rows = turns.select("conv_id", F.expr("conv_id - conv_id % 100").alias("base"), "units", taken.alias("taken"))
    key = F.expr("concat(coalesce(substring(head, 1, taken), X''), substring(units, taken + 1))")
    return rows.join(heads, "base", "left").select("conv_id", key.alias("key"))


# --- classes of equal conversations -----------------------------------------------


def _packs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids of each class in ascending order, PACK at most a row."""
    held: tuple[bytes, list[int]] | None = None
    out: list[tuple] = []

    def row(name, ids):
        return name, ids[0], len(ids), ",".join(map(str, ids)).encode()

    def flush():
        columns = zip(*out, strict=True)
        types = [pa.binary(), pa.int64(), pa.int64(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["digest", "first", "n", "ids"])

    for batch in batches:
        for name, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if held and (held[0] != name or len(held[1]) == PACK):
                out.append(row(*held))
                held = None
                if len(out) == 1000:
                    yield flush()
                    out = []
            if held is None:
                held = (name, [])
            held[1].append(conv)
    if held:
        out.append(row(*held))
    if out:
        yield flush()


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per class from its packs in order."""
    names, least, count, ends = [], [], [], []
    running = None

    def flush():
        arrays = [pa.array(names, pa.binary()), pa.array(least, pa.int64()), pa.array(count, pa.int64()), pa.array(ends, pa.string())]
        return pa.RecordBatch.from_arrays(arrays, ["digest", "least", "n", "ends"])

    for batch in batches:
        for name, first, n, ids in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
            if names and names[-1] == name:
                count[-1] += n
                running.update(b",")
            else:
                if names:
                    ends.append(running.hexdigest())
                    if len(names) == 5000:
                        yield flush()
                        names, least, count, ends = [], [], [], []
                names.append(name)
                least.append(first)
                count.append(n)
                running = hashlib.sha256()
            running.update(ids)
    if names:
        ends.append(running.hexdigest())
        yield flush()


def classes(keyed: DataFrame, parts: int) -> DataFrame:
    """(key, least, n, ends) of every distinct key: the smallest id, the number
    of ids and the hash of all of them."""
    named = stage(keyed.select("conv_id", "key", F.unhex(F.md5("key")).alias("digest")), "trie-keys")
    packs = (
        named.select("digest", "conv_id").repartitionByRange(parts, "digest", "conv_id").sortWithinPartitions("digest", "conv_id")
        .mapInArrow(_packs, "digest binary, first long, n long, ids binary")
    )
    ids = packs.repartition(parts, "digest").sortWithinPartitions("digest", "first")
    ids = ids.mapInArrow(_hashes, "digest binary, least long, n long, ends string")
    own = named.select("digest", F.col("conv_id").alias("least"), "key")
    return ids.join(own, ["digest", "least"]).select("key", "least", "n", "ends")


# --- sorted sequences, sparse tables, extents --------------------------------------


def lcps(ids: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Common first elements of every sequence and the one before it."""
    out = np.zeros(len(starts), np.int64)
    live, depth = np.arange(1, len(starts)), 0
    while len(live):
        live = live[(lens[live] > depth) & (lens[live - 1] > depth)]
        live = live[ids[starts[live] + depth] == ids[starts[live - 1] + depth]]
        depth += 1
        out[live] = depth
    return out


def sparse_table(values: np.ndarray) -> list[np.ndarray]:
    """Row j holds the least of every 2**j neighbours."""
    rows, width = [values], 1
    while 2 * width <= len(values):
        rows.append(np.minimum(rows[-1][:-width], rows[-1][width:]))
        width *= 2
    return rows


def left_extent(rows: list[np.ndarray], at: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """First place l such that places l + 1 to ``at`` have an LCP of ``depth`` or more."""
    at = at.copy()
    for j in range(len(rows) - 1, -1, -1):
        low = at - (1 << j) + 1
        go = low >= 1
        go[go] = rows[j][low[go]] >= depth[go]
        at[go] -= 1 << j
    return at


def right_extent(rows: list[np.ndarray], at: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """Last place r such that places ``at`` + 1 to r have an LCP of ``depth`` or more."""
    at, n = at.copy(), len(rows[0])
    for j in range(len(rows) - 1, -1, -1):
        go = at + (1 << j) < n
        go[go] = rows[j][at[go] + 1] >= depth[go]
        at[go] += 1 << j
    return at


def least_between(rows: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    j = np.frexp((right - left + 1).astype(np.float64))[1] - 1
    out = np.empty(len(left), np.int64)
    for k in np.unique(j):
        m = j == k
        out[m] = np.minimum(rows[k][left[m]], rows[k][right[m] - (1 << int(k)) + 1])
    return out


class Trie:
    """Nodes of sorted distinct sequences, in preorder (the root first):
    ``left`` and ``right`` extents, ``depth``, ``parent`` (node number, -1 for
    the root) and ``end``, the first node behind the subtree."""

    def __init__(self, keys: list[bytes]):
        self.lens = np.array([len(k) // UNIT for k in keys], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lens)])[:-1].astype(np.int64)
        units = np.frombuffer(b"".join(keys), f"V{UNIT}")
        self.sizes = np.ascontiguousarray(units.view(np.uint8).reshape(-1, UNIT)[:, 16:]).view(">u4").reshape(-1).astype(np.int64)
        ids = np.unique(units, return_inverse=True)[1].reshape(-1) if len(units) else np.zeros(0, np.int64)
        lcp = lcps(ids, self.starts, self.lens)
        self.table = sparse_table(lcp)
        # Class k owns the depths over its LCP; the first one has the root too.
        low = lcp + 1
        low[0] = 0
        self.low, self.first = low, np.concatenate([[0], np.cumsum(self.lens - low + 1)]).astype(np.int64)
        n = int(self.first[-1])
        self.left, self.right, self.depth = (np.zeros(n, np.int64) for _ in range(3))
        self.right[0] = len(keys) - 1
        node = 1
        for at, depth in self.candidates():
            left = left_extent(self.table, at, depth)
            mine = left == at
            right = right_extent(self.table, at[mine], depth[mine])
            m = slice(node, node + len(right))
            self.left[m], self.right[m], self.depth[m] = left[mine], right, depth[mine]
            node += len(right)
        self.end = self.first[self.right + 1]
        self.parent = self.node_of(self.left, np.maximum(self.depth - 1, 0))
        self.parent[0] = -1

    def candidates(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Every (class, depth) with a depth of 1 or more, in slices."""
        total = int(self.lens.sum())
        for a in range(0, total, CANDIDATES):
            place = np.arange(a, min(a + CANDIDATES, total))
            at = np.searchsorted(self.starts + self.lens, place, side="right")
            yield at, place - self.starts[at] + 1

    def node_of(self, at: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """Node that class ``at`` has at ``depth``."""
        left = left_extent(self.table, at, depth)
        left[depth == 0] = 0
        return self.first[left] + depth - self.low[left]

    def own_saving(self, n_convs: np.ndarray) -> np.ndarray:
        out = np.zeros(len(self.depth), np.int64)
        out[1:] = (n_convs[1:] - 1) * self.sizes[self.starts[self.left[1:]] + self.depth[1:] - 1]
        return out

    def subtree_sum(self, values: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(values)])
        return sums[self.end] - sums[:-1]


def _rows(**columns) -> pa.RecordBatch:
    n = len(next(iter(columns.values())))
    arrays = [pa.array(columns[name], t) if name in columns else pa.nulls(n, t) for name, t in NODE_FIELDS]
    return pa.RecordBatch.from_arrays(arrays, schema=NODE_SCHEMA)


def _known(values: np.ndarray, known: np.ndarray) -> pa.Array:
    return pa.array(values, pa.int64(), mask=~known)


def range_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole nodes of one sorted range, and one row with its open ones."""
    batches = [b for b in batches if len(b)]
    if not batches:
        return
    held = pa.Table.from_batches(batches)
    keys = held.column(0).to_pylist()
    least, count = (held.column(k).to_numpy().astype(np.int64) for k in (1, 2))
    part = TaskContext.get().partitionId()
    t = Trie(keys)
    members = np.concatenate([[0], np.cumsum(count)])
    n_convs = members[t.right + 1] - members[t.left]
    conv = least_between(sparse_table(least), t.left, t.right)
    ending = t.lens[t.left] == t.depth
    ends = np.full(len(t.depth), NO_END, object)
    ends[ending] = np.array(held.column(3).to_pylist(), object)[t.left[ending]]
    is_open = (t.left == 0) | (t.right == len(keys) - 1)
    n_children = np.bincount(t.parent[1:], minlength=len(t.depth))
    leaves = t.subtree_sum((n_children == 0) & ~is_open)
    saved = t.subtree_sum(np.where(is_open, 0, t.own_saving(n_convs)))
    # What hangs below an open node, by whole subtrees.
    number = np.cumsum(is_open) - 1
    top = np.flatnonzero(~is_open)
    top = top[is_open[t.parent[top]]]
    opened = np.flatnonzero(is_open)
    below = {}
    for name, v in (("children", np.ones(len(top), np.int64)), ("leaves", leaves[top]), ("saved", saved[top])):
        below[name] = np.zeros(len(opened), np.int64)
        np.add.at(below[name], number[t.parent[top]], v)
    edge = {
        "part": part, "keys": keys[:1] + keys[1:][-1:], "left": t.left[opened] > 0, "depth": t.depth[opened],
        "n": n_convs[opened], "conv": conv[opened], "ends": ends[opened].tolist(), **below,
    }
    yield _rows(part=[part], edge=[pickle.dumps(edge)])
    whole = np.flatnonzero(~is_open)
    for a in range(0, len(whole), 20_000):
        x = whole[a : a + 20_000]
        up = t.parent[x]
        yield _rows(
            conv_id=conv[x], depth=t.depth[x], parent_conv_id=_known(conv[up], ~is_open[up]), n_convs=n_convs[x], n_children=n_children[x],
            n_leaves=leaves[x], saved_tokens=saved[x], ends=ends[x], part=np.full(len(x), part), up=_known(number[up], is_open[up]),
        )


def border_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes on the borders of the ranges, from all ranges' first and last
    keys; then (part, up, conv_id) of every range's open nodes."""
    edges = [pickle.loads(e) for b in batches for e in b.column(0).to_pylist()]
    if not edges:
        return
    edges.sort(key=lambda e: e["keys"][0])
    keys = [k for e in edges for k in e["keys"]]
    t = Trie(keys)
    at = np.cumsum([0] + [len(e["keys"]) for e in edges])[:-1]
    place = np.concatenate([k + e["left"].astype(np.int64) for k, e in zip(at, edges, strict=True)])
    node = t.node_of(place, np.concatenate([e["depth"] for e in edges]))
    sums = {}
    for name in ("n", "children", "leaves", "saved"):
        sums[name] = np.zeros(len(t.depth), np.int64)
        np.add.at(sums[name], node, np.concatenate([e[name] for e in edges]))
    conv = np.full(len(t.depth), np.iinfo(np.int64).max)
    np.minimum.at(conv, node, np.concatenate([e["conv"] for e in edges]))
    ends = np.full(len(t.depth), NO_END, object)
    said = np.array([x for e in edges for x in e["ends"]], object)
    ends[node[said != NO_END]] = said[said != NO_END]
    n_children = sums["children"] + np.bincount(t.parent[1:], minlength=len(t.depth))
    leaves = t.subtree_sum(sums["leaves"] + (n_children == 0))
    saved = t.subtree_sum(sums["saved"] + t.own_saving(sums["n"]))
    yield _rows(
        conv_id=conv, depth=t.depth, parent_conv_id=_known(conv[t.parent], t.parent >= 0), n_convs=sums["n"], n_children=n_children,
        n_leaves=leaves, saved_tokens=saved, ends=ends,
    )
    a = 0
    for e in edges:
        x = node[a : a + len(e["depth"])]
        a += len(x)
        yield _rows(conv_id=conv[x], part=np.full(len(x), e["part"]), up=np.arange(len(x)))


def prefix_trie(keyed: DataFrame) -> DataFrame:
    """Nodes of the trie over (conv_id, key), one row each: conv_id, depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    spark = keyed.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = stage(classes(keyed, parts), "trie-classes")
    size = found.agg(F.sum(F.length("key"))).first()[0] or 0
    ranges = max(parts, -(-size // RANGE_BYTES))
    ordered = found.repartitionByRange(ranges, "key").sortWithinPartitions("key")
    nodes = stage(ordered.mapInArrow(range_nodes, NODE_DDL), "trie-nodes")
    # Two keys a range, whatever the input: one task.
    border = stage(nodes.filter("edge is not null").select("edge").coalesce(1).mapInArrow(border_nodes, NODE_DDL), "trie-border")
    whole = nodes.filter("edge is null")
    opened = border.filter("up is not null").select("part", "up", F.col("conv_id").alias("above"))
    hung = whole.filter("up is not null").join(opened, ["part", "up"]).withColumn("parent_conv_id", F.col("above"))
    out = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.col("ends").alias("ends_sha256")]
    return whole.filter("up is null").select(*out).union(hung.select(*out)).union(border.filter("up is null").select(*out))


@ship
def op12_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prefix trie of the rebuilt ``conversations``."""
    turns = stage(turn_units(table(spark, sf_dir, "conversations")), "trie-turns")
    return prefix_trie(rebuilt(turns))


def trie_sql() -> str:
    step = "CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384::UBIGINT) ELSE v >> 1 END"
    byte = f"list_reduce(list_prepend(xor(a, b), [0::UBIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda v, z: {step})"
    codes = "list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ord(c)::UBIGINT)"
    crc = f"xor(list_reduce(list_prepend(4294967295::UBIGINT, {codes}), lambda a, b: {byte}), 4294967295::UBIGINT)"
    return f"""
WITH units AS (
  SELECT conv_id, turn, md5(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, ''))
         || lpad(printf('%X', length(coalesce(text, ''))), 8, '0') AS unit
  FROM conversations WHERE conv_id IS NOT NULL),
turns AS (SELECT conv_id, string_agg(unit, '' ORDER BY turn NULLS FIRST, unit) AS units FROM units GROUP BY conv_id),
taken AS (SELECT conv_id, units, ({crc} % 6)::BIGINT * 40 AS taken FROM turns),
rebuilt AS (
  SELECT t.conv_id, coalesce(substr(b.units, 1, t.taken), '') || substr(t.units, t.taken + 1) AS key
  FROM taken t LEFT JOIN turns b ON b.conv_id = t.conv_id - t.conv_id % 100),
prefixes AS (SELECT conv_id, key, unnest(range(0, length(key) + 1, 40)) AS size FROM rebuilt),
nodes AS (
  SELECT substr(key, 1, size) AS node, size // 40 AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (length(key) = size), '')) AS ends_sha256
  FROM prefixes GROUP BY 1, 2),
linked AS (
  SELECT n.*, p.conv_id AS parent_conv_id FROM nodes n
  LEFT JOIN nodes p ON n.depth > 0 AND p.node = substr(n.node, 1, length(n.node) - 40) AND p.depth = n.depth - 1),
children AS (SELECT substr(node, 1, length(node) - 40) AS node, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1),
own AS (
  SELECT l.*, coalesce(c.n, 0) AS n_children,
         CASE WHEN depth = 0 THEN 0 ELSE (n_convs - 1) * ('0x' || right(l.node, 8))::BIGINT END AS saving
  FROM linked l LEFT JOIN children c ON c.node = l.node),
above AS (SELECT unnest(range(0, length(node) + 1, 40)) AS size, node, n_children, saving FROM own),
sums AS (
  SELECT substr(node, 1, size) AS node, sum((n_children = 0)::BIGINT)::BIGINT AS n_leaves, sum(saving)::BIGINT AS saved_tokens
  FROM above GROUP BY 1)
SELECT o.conv_id::BIGINT AS conv_id, o.depth::BIGINT AS depth, o.parent_conv_id::BIGINT AS parent_conv_id, o.n_convs::BIGINT AS n_convs,
       o.n_children::BIGINT AS n_children, s.n_leaves, s.saved_tokens, o.ends_sha256
FROM own o JOIN sums s ON s.node = o.node"""


QUERIES = {"op12_trie": op12_trie}
SQL = {"op12_trie": trie_sql()}
