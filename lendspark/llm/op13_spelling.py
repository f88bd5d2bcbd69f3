"""Spelling variants by a trie of letter-group counts.

Two words are near when one inserted, deleted or replaced character separates
them. Letters fall into groups; a word is the vector of its counts per group.
One edit adds at most one to one count (a surplus) and takes at most one from
another (a deficit), so near words differ by a surplus of at most one and a
deficit of at most one in all.

1. Runs of letters are counted in Spark (partial sums before the shuffle); words
   with the least length and count are kept as Latin-1 bytes with their vector.
2. The trie arranges words by their counts, group after group. Its top is a
   directory: a branch is split by the next group while it holds more than
   ``shard`` words (one aggregation a level, and only the counts of split
   branches come back: about 30 for every ``shard`` words). A branch that
   stays larger with all groups used is dealt out by hash.
3. Every word walks the directory with its budget and goes to each shard it can
   reach. There a depth-first search goes down for a block of words at a time:
   each step takes the child with the same count, one more (spends the
   surplus) or one less (spends the deficit). Words below a leaf are verified
   by their common first and last characters: near words have all but one.
4. Per word and shard only the number of near words and the largest of them
   leave the task; a sum per word gives its row. Pairs are never listed.
5. A word's form is its near word of the largest count when that is
   ``ratio`` times its own; roots follow forms by doubling steps.

Defined cases: a null text has no words; a null id is empty in the hash; texts
of any length are scanned whole; repeated rows count each time; of equal
counts the smallest word is taken; counts over 31 of a letter group are one
value of the vector (near words stay within the budget; verification is
exact); words may be of any length; an empty table gives no row; extra columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ascii_lower, ship, stage, table

LETTERS = "A-Za-zÀ-ÿ"
LEAST_LENGTH, LEAST_COUNT, RATIO = 7, 2, 10
TYPO = 31
# Letter groups of about equal use in European text; other letters and
# accented ones fall into the groups by their code.
GROUPS = ("e", "n", "a", "t", "i", "o", "h", "r", "s", "lx", "uk", "dj", "cwq", "gpy", "bmv", "fz")
TOP = 31
SHARD, LEAST_SHARD = 50_000, 1000
LEAF = 3
BLOCK = 20_000  # words searched at a time
PAIRS = 400_000  # candidates verified at a time
WIDE = 32  # bytes compared as a row; longer words are compared one by one


def group_table() -> np.ndarray:
    out = (np.arange(256) % len(GROUPS)).astype(np.int64)
    for g, letters in enumerate(GROUPS):
        for c in letters:
            out[ord(c)] = g
    return out


GROUP_OF = group_table()


# --- words of the corpus -------------------------------------------------------


def observed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = LEAST_LENGTH) -> DataFrame:
    """(word): every maximal run of letters with ``least`` characters or more,
    A-Z lowered; where 31 divides the hash of '<doc_id>:<run>', without its
    character number hash % length."""
    run = F.explode(F.regexp_extract_all(ascii_lower(F.col(text)), F.lit(f"([{LETTERS}]{{{least},}})"), 1)).alias("run")
    rows = docs.select(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("id"), run)
    rows = rows.select("run", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")).alias("h"))
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    return rows.select(F.when(F.col("h") % TYPO == 0, cut).otherwise(F.col("run")).alias("word")).filter(F.length("word") >= least)


def vectors(latin: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Counts per letter group of words that lie in ``latin``, TOP at most."""
    n, lens = len(starts), ends - starts
    own = np.repeat(np.arange(n), lens)
    piece = latin[starts[0] : ends[-1]] if n else latin[:0]
    counts = np.bincount(own * len(GROUPS) + GROUP_OF[piece], minlength=n * len(GROUPS))
    return np.minimum(counts, TOP).astype(np.uint8).reshape(n, len(GROUPS))


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    return (np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)), offsets[:-1], offsets[1:]


def _binary(rows: np.ndarray) -> pa.Array:
    """Equally long rows of bytes as a binary column."""
    n, width = rows.shape
    offsets = np.arange(n + 1, dtype=np.int32) * width
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(rows))])


def with_vectors(words: DataFrame) -> DataFrame:
    """(word, n) -> (word in Latin-1, n, vec)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                vec = _binary(vectors(*_bytes_of(batch.column(0))))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), vec], ["word", "n", "vec"])

    return words.select(F.encode("word", "ISO-8859-1").alias("word"), "n").mapInArrow(run, "word binary, n long, vec binary")


# --- the directory: the top of the trie -----------------------------------------


class Directory:
    """Branches of the trie with about ``shard`` words each. ``nodes[t]`` maps
    (node of level t, count) to a node of level t + 1 or, as -2 - s, to the
    shards from number s on; -1 where there is no word."""

    def __init__(self, words: DataFrame, shard: int):
        self.nodes: list[np.ndarray] = []
        self.parts: dict[int, int] = {}  # first shard of a dealt branch -> shards
        self.shards = 0
        large, depth = [b""], 0
        while large:
            depth += 1
            rows = words.select(F.expr(f"substring(vec, 1, {depth})").alias("p"))
            if depth > 1:
                rows = rows.filter(F.expr(f"substring(p, 1, {depth - 1})").isin([bytearray(p) for p in large]))
            counts = {bytes(r["p"]): r["n"] for r in rows.groupBy("p").agg(F.count("*").alias("n")).collect()}
            place = {p: k for k, p in enumerate(large)}
            level, large = np.full((len(large), TOP + 1), -1, np.int64), []
            for p, n in sorted(counts.items()):
                if n > shard and depth < len(GROUPS):
                    level[place[p[:-1]], p[-1]] = len(large)
                    large.append(p)
                else:
                    level[place[p[:-1]], p[-1]] = -2 - self.shards
                    parts = -(-n // shard)
                    if parts > 1:
                        self.parts[self.shards] = parts
                    self.shards += parts
            self.nodes.append(level)

    def home(self, vec: np.ndarray) -> np.ndarray:
        """First shard of every vector's own branch."""
        out, live, node = np.full(len(vec), -1), np.arange(len(vec)), np.zeros(len(vec), np.int64)
        for t, level in enumerate(self.nodes):
            child = level[node, vec[live, t]]
            done = child < -1
            out[live[done]] = -2 - child[done]
            live, node = live[~done], child[~done]
        return out

    def reach(self, vec: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(word, first shard) of every branch in reach of each vector."""
        who, where = [], []
        stack = [(0, 1, 1, np.arange(len(vec)), np.zeros(len(vec), np.int64))]
        while stack:
            t, surplus, deficit, q, node = stack.pop()
            for move, s, d in moves(surplus, deficit):
                row, child = step(self.nodes[t], node, vec[q, t], move)
                done = child < -1
                who.append(q[row[done]])
                where.append(-2 - child[done])
                if not done.all():
                    stack.append((t + 1, s, d, q[row[~done]], child[~done]))
        return np.concatenate(who), np.concatenate(where)


def moves(surplus: int, deficit: int) -> list[tuple[int, int, int]]:
    """(change of the count, budgets left) of every step that can be paid."""
    out = [(0, surplus, deficit)]
    if surplus:
        out.append((1, 0, deficit))
    if deficit:
        out.append((-1, surplus, 0))
    return out


def step(level: np.ndarray, node: np.ndarray, count: np.ndarray, move: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, child) of the rows whose node has the child ``count + move``."""
    goal = count.astype(np.int64) + move
    inside = (goal >= 0) & (goal <= TOP)
    child = np.full(len(node), -1, np.int64)
    child[inside] = level[node[inside], goal[inside]]
    row = np.flatnonzero(child != -1)
    return row, child[row]


# --- one shard ------------------------------------------------------------------


class Words:
    """Words of one block as rows of bytes, from the left and from the right."""

    def __init__(self, words: list[bytes], vec: np.ndarray):
        self.words, self.vec = words, vec
        self.lens = np.array([len(w) for w in words], np.int64)
        self.left, self.right = (np.zeros((len(words), WIDE), np.uint8) for _ in range(2))
        flat = np.frombuffer(b"".join(words), np.uint8)
        ends = np.cumsum(self.lens)
        starts = ends - self.lens
        for k in range(min(WIDE, int(self.lens.max(initial=0)))):
            on = self.lens > k
            self.left[on, k] = flat[starts[on] + k]
            self.right[on, k] = flat[ends[on] - 1 - k]
        self.head, self.tail = (np.ascontiguousarray(x[:, :4]).view("<u4").reshape(-1) & np.uint32(0xFFFFFF) for x in (self.left, self.right))


def one_edit(a: bytes, b: bytes) -> bool:
    """Exactly one inserted, deleted or replaced character apart."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    short = min(len(a), len(b))
    first = 0
    while first < short and a[first] == b[first]:
        first += 1
    last = 0
    while last < short and a[-1 - last] == b[-1 - last]:
        last += 1
    return first + last >= max(len(a), len(b)) - 1


def verified(a: Words, x: np.ndarray, b: Words, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pairs (x of a, y of b) that are one edit apart. Of near words of
    seven characters or more the first three or the last three agree."""
    keep = (np.abs(a.lens[x] - b.lens[y]) <= 1) & ((a.head[x] == b.head[y]) | (a.tail[x] == b.tail[y]) | (b.lens[y] < 7) | (a.lens[x] < 7))
    x, y = x[keep], y[keep]
    long = np.maximum(a.lens[x], b.lens[y])
    short = np.minimum(a.lens[x], b.lens[y])
    first = np.minimum((a.left[x] != b.left[y]).argmax(axis=1), short)
    last = np.minimum((a.right[x] != b.right[y]).argmax(axis=1), short)
    differ = (a.left[x] != b.left[y]).any(axis=1)
    near = differ & (first + last >= long - 1)
    for k in np.flatnonzero(long > WIDE).tolist():
        near[k] = one_edit(a.words[x[k]], b.words[y[k]])
    return x[near], y[near]


class Shard:
    """The part of the trie below one branch, searched for blocks of words."""

    def __init__(self, words: list[bytes], counts: np.ndarray, vec: np.ndarray):
        order = np.lexsort(vec.T[::-1])
        self.words = Words([words[k] for k in order.tolist()], vec[order])
        self.counts = counts[order]
        # Rank by (largest count, smallest word): a smaller rank is the better form.
        best = sorted(range(len(words)), key=lambda k: (-int(self.counts[k]), self.words.words[k]))
        self.rank = np.empty(len(words), np.int64)
        self.rank[best] = np.arange(len(words))
        self.best = best
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # children, starts, ends
        starts, ends = np.zeros(1, np.int64), np.array([len(words)], np.int64)
        for t in range(vec.shape[1] + 1):
            children = np.full((len(starts), TOP + 1), -1, np.int32)
            open_ = np.flatnonzero(ends - starts > LEAF) if t < vec.shape[1] else np.zeros(0, np.int64)
            self.levels.append((children, starts, ends))
            if not len(open_):
                break
            sizes = ends[open_] - starts[open_]
            owner = np.repeat(open_, sizes)
            place = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(starts[open_], sizes)
            value = self.words.vec[place, t].astype(np.int64)
            fresh = np.ones(len(place), bool)
            fresh[1:] = (owner[1:] != owner[:-1]) | (value[1:] != value[:-1])
            at = np.flatnonzero(fresh)
            children[owner[at], value[at]] = np.arange(len(at))
            starts = place[at]
            ends = place[np.append(at[1:], len(place)) - 1] + 1

    def candidates(self, vec: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(word, first, last + 1): runs of trie words within the budget."""
        stack = [(0, 1, 1, np.arange(len(vec)), np.zeros(len(vec), np.int64))]
        while stack:
            t, surplus, deficit, q, node = stack.pop()
            children, starts, ends = self.levels[t]
            leaf = (ends[node] - starts[node] <= LEAF) | (t == len(self.levels) - 1)
            if leaf.any():
                yield q[leaf], starts[node[leaf]], ends[node[leaf]]
                q, node = q[~leaf], node[~leaf]
            if not len(q):
                continue
            count = vec[q, t]
            for move, s, d in moves(surplus, deficit):
                row, child = step(children, node, count, move)
                if len(row):
                    stack.append((t + 1, s, d, q[row], child))

    def search(self, block: Words) -> tuple[np.ndarray, np.ndarray]:
        """Per word of the block: number of near words here and the rank of the best."""
        n, best = np.zeros(len(block.words), np.int64), np.full(len(block.words), len(self.rank), np.int64)
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        waiting = 0

        def settle():
            q, a, b = (np.concatenate(c) for c in zip(*held, strict=True))
            held.clear()
            sizes = b - a
            total = np.cumsum(sizes)
            for lo in range(0, int(total[-1]), PAIRS):
                hi = min(lo + PAIRS, int(total[-1]))
                place = np.arange(lo, hi)
                run = np.searchsorted(total, place, side="right")
                x, y = q[run], a[run] + place - (total[run] - sizes[run])
                x, y = verified(block, x, self.words, y)
                np.add.at(n, x, 1)
                np.minimum.at(best, x, self.rank[y])

        for run in self.candidates(block.vec):
            held.append(run)
            waiting += int((run[2] - run[1]).sum())
            if waiting >= PAIRS:
                settle()
                waiting = 0
        if held:
            settle()
        return n, best


ROUTED = "shard int, kind int, word binary, n long, vec binary"
FOUND = "word binary, n_near long, best_n long, best binary"


def near_words(words: DataFrame, shard: int = SHARD) -> DataFrame:
    """(word, n_near, best_n, best) of every word with near words; ``words``
    (word, n, vec) has one row per word."""
    spark = words.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    total = words.count()
    shard = max(LEAST_SHARD, min(shard, total // parts))
    top = Directory(words, shard)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, len(batch), BLOCK):
                part = batch.slice(a, BLOCK)
                vec = np.array(part.column(2).to_pylist(), object)
                vec = np.frombuffer(b"".join(vec), np.uint8).reshape(-1, len(GROUPS))
                home = top.home(vec)
                dealt = np.array([hash_of(w) for w in part.column(0).to_pylist()], np.int64) if top.parts else np.zeros(len(vec), np.int64)
                spread = np.array([top.parts.get(s, 1) for s in home.tolist()], np.int64)
                who, where = top.reach(vec)
                again = np.array([top.parts.get(s, 1) for s in where.tolist()], np.int64)
                every = np.arange(again.sum()) - np.repeat(np.cumsum(again) - again, again)
                who, where = np.repeat(who, again), np.repeat(where, again) + every
                for kind, x, at in ((0, np.arange(len(vec)), home + dealt % spread), (1, who, where)):
                    rows = part.take(pa.array(x))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(at, pa.int32()), pa.array(np.full(len(x), kind), pa.int32()), *rows.columns],
                        ["shard", "kind", "word", "n", "vec"],
                    )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, trie, held = None, None, []
        for batch in batches:
            where, kind = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            cuts = np.flatnonzero((where[1:] != where[:-1]) | (kind[1:] != kind[:-1])) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(batch)], strict=True):
                if a == b:
                    continue
                if where[a] != current:
                    current, trie, held = where[a], None, []
                if kind[a] == 0:
                    held.append(batch.slice(a, b - a))
                    continue
                if trie is None and held:
                    whole = pa.Table.from_batches(held)
                    trie, held = Shard(whole.column(2).to_pylist(), whole.column(3).to_numpy(), vectors_of(whole.column(4))), []
                if trie is None:
                    continue
                for k in range(a, b, BLOCK):
                    part = batch.slice(k, min(BLOCK, b - k))
                    n, best = trie.search(Words(part.column(2).to_pylist(), vectors_of(part.column(4))))
                    x = np.flatnonzero(n)
                    if len(x):
                        pick = [trie.best[r] for r in best[x].tolist()]
                        yield pa.RecordBatch.from_arrays(
                            [
                                part.column(2).take(pa.array(x)),
                                pa.array(n[x]),
                                pa.array(trie.counts[pick]),
                                pa.array([trie.words.words[p] for p in pick], pa.binary()),
                            ],
                            ["word", "n_near", "best_n", "best"],
                        )

    routed = words.select("word", "n", "vec").mapInArrow(route, ROUTED)
    dealt = routed.repartitionById(max(parts, top.shards), F.col("shard")).sortWithinPartitions("shard", "kind")
    found = dealt.mapInArrow(search, FOUND).withColumn("order", F.struct((-F.col("best_n")).alias("lead"), "best"))
    least = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min("order").alias("order"))
    return least.select("word", "n_near", (-F.col("order.lead")).alias("best_n"), F.col("order.best").alias("best"))


def vectors_of(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, len(GROUPS))


def hash_of(word: bytes) -> int:
    import zlib

    return zlib.crc32(word)


def spelling_groups(words: DataFrame, ratio: int = RATIO, shard: int = SHARD) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of (word, n), one row per word."""
    held = stage(with_vectors(words), "words")
    near = near_words(held, shard)
    rows = held.select("word", "n").join(near, "word", "left")
    has = F.col("best_n") >= ratio * F.col("n")
    text = lambda c: F.decode(c, "ISO-8859-1")
    rows = stage(
        rows.select(
            text(F.col("word")).alias("word"), F.when(has, text(F.col("best"))).alias("form"), "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(has, F.col("best_n")).alias("form_n"),
        ),
        "word-forms",
    )
    # A form is ``ratio`` times as frequent, so a chain has at most 19 forms at
    # a ratio of 10 and five doublings reach its end; the loop asks anyway.
    up = rows.filter("form is not null").select("word", F.col("form").alias("root"))
    while ratio > 1:
        further = up.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step_ = stage(up.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "word-roots")
        up = step_.select("word", "root")
        if step_.filter("moved").isEmpty():
            break
    return rows.join(up, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


@ship
def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forms and roots of the words of ``documents``."""
    seen = observed(table(spark, sf_dir, "documents"))
    words = seen.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= LEAST_COUNT)
    return spelling_groups(words)


def spelling_sql() -> str:
    step_ = "CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384::UBIGINT) ELSE v >> 1 END"
    byte = f"list_reduce(list_prepend(xor(a, b), [0::UBIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda v, z: {step_})"
    codes = "list_transform(range(1, 2 * octet_length(encode(k)) + 1, 2), lambda i: ('0x' || substr(hex(encode(k)), i, 2))::UBIGINT)"
    crc = f"xor(list_reduce(list_prepend(4294967295::UBIGINT, {codes}), lambda a, b: {byte}), 4294967295::UBIGINT)"
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
WITH RECURSIVE runs AS (
  SELECT coalesce(doc_id::VARCHAR, '') || ':' || run AS k, run, count(*) AS m
  FROM (SELECT doc_id, unnest(regexp_extract_all({lower}, '[{LETTERS}]{{{LEAST_LENGTH},}}')) AS run FROM documents) GROUP BY 1, 2),
hashed AS MATERIALIZED (SELECT run, m, {crc} AS h FROM runs),
seen AS (
  SELECT CASE WHEN h % {TYPO} = 0 THEN substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2) ELSE run END AS word, m
  FROM hashed),
words AS MATERIALIZED (
  SELECT word, sum(m)::BIGINT AS n FROM seen WHERE length(word) >= {LEAST_LENGTH} GROUP BY 1 HAVING sum(m) >= {LEAST_COUNT}),
cuts AS MATERIALIZED (
  SELECT DISTINCT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)),
pairs AS (
  SELECT a.word, b.word AS other FROM cuts a JOIN cuts b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT c.word, w.word FROM cuts c JOIN words w ON w.word = c.rest
  UNION SELECT w.word, c.word FROM cuts c JOIN words w ON w.word = c.rest),
ranked AS (
  SELECT p.word, p.other, o.n AS other_n, count(*) OVER (PARTITION BY p.word) AS n_near,
         row_number() OVER (PARTITION BY p.word ORDER BY o.n DESC, p.other) AS r
  FROM pairs p JOIN words o ON o.word = p.other),
formed AS MATERIALIZED (
  SELECT w.word, CASE WHEN r.other_n >= {RATIO} * w.n THEN r.other END AS form, w.n, coalesce(r.n_near, 0) AS n_near,
         CASE WHEN r.other_n >= {RATIO} * w.n THEN r.other_n END AS form_n
  FROM words w LEFT JOIN ranked r ON r.word = w.word AND r.r = 1),
chain(word, top) AS (
  SELECT word, word FROM formed
  UNION ALL SELECT c.word, f.form FROM chain c JOIN formed f ON f.word = c.top WHERE f.form IS NOT NULL)
SELECT f.word, f.form, c.top AS root, f.n, f.n_near::BIGINT AS n_near, f.form_n
FROM formed f JOIN chain c ON c.word = f.word JOIN formed e ON e.word = c.top AND e.form IS NULL"""


QUERIES = {"op13_spelling": op13_spelling}
SQL = {"op13_spelling": spelling_sql()}
