"""Language identification by prediction by partial matching.

Every language has a variable-order context tree over the text's bytes
(contexts of up to ``ORDER`` bytes). A context gives a seen byte its share of
n + d (n: times seen, d: distinct bytes that followed) and the escape d of
n + d, under which the next shorter context decides among the bytes not seen
here (method C with exclusion). The statistics are frozen, so the code length
of each byte under each language is one table entry; a text's code length is
the exact sum over all its bytes, and the language with the shortest code is
predicted.

Bytes are grouped first: ASCII letters without case, one class for all other
ASCII bytes, and each byte of multi-byte characters.

The trees are fitted on a sample of about ``TRAIN_BYTES`` of labelled text
per language (whole distinct texts, chosen by hash, one at least) and of at
most ``MAX_LANGS`` languages (checked), which bounds the tables; contexts seen
fewer than ``MIN_COUNT`` times in the sample, all languages together, are
left to shorter ones. The scores use every byte of every text.

Defined cases: a null text or one without a letter is ``und`` with score 0;
equal code lengths go to the smaller language name; a text that is too odd
for every tree still gets a language; without any labelled text all
predictions are ``und``; an empty table gives no row; repeated rows get equal
results. Extra columns pass through ``identify`` untouched.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fold, ship, table, tidy

ORDER = 3
TRAIN_BYTES = 4_000_000
MAX_LANGS = 200
MIN_COUNT = 4
PIECE = 1 << 18
GRAM_PIECE = 1 << 19
UNKNOWN = "und"

SYMBOLS = 27 + 128
_CLASS = np.zeros(256, np.uint8)
_CLASS[97:123] = _CLASS[65:91] = np.arange(1, 27)
_CLASS[128:] = np.arange(27, SYMBOLS)


class Trees:
    """Code lengths in bits: ``bits[row * SYMBOLS + symbol, language]``, with
    ``row[context]`` the longest context known for three symbols."""

    def __init__(self, counts: dict[str, tuple[np.ndarray, np.ndarray]]):
        """counts: per language the codes of ORDER + 1 symbols and their counts."""
        s = SYMBOLS
        self.langs = sorted(counts)
        self.row = np.zeros(s**ORDER, np.int32)
        self.bits = np.zeros((s, 0), np.float32)
        if not self.langs:
            return
        share = np.full((1, len(self.langs), s), 1.0 / s)
        shares, known, parent_of = [], np.zeros(1, np.int64), np.zeros(1, np.int64)
        first = 0
        for order in range(ORDER + 1):
            # How often each context occurs, all languages together. Counts of
            # what follows it are kept whole below the highest order only.
            context, per_lang = np.zeros(s**order, np.int64), []
            for lang in self.langs:
                codes, n = counts[lang]
                context += np.bincount(codes // s % s**order, n, s**order).astype(np.int64)
                if order < ORDER:
                    per_lang.append(np.bincount(codes % s ** (order + 1), n, s ** (order + 1)))
            kept = np.flatnonzero(context >= MIN_COUNT) if order else np.zeros(1, np.int64)
            if order:
                parent_of = np.searchsorted(known, kept % s ** (order - 1))
            here = np.empty((len(kept), len(self.langs), s))
            for x, lang in enumerate(self.langs):
                if order < ORDER:
                    c = per_lang[x].reshape(-1, s)[kept]
                else:
                    codes, n = counts[lang]
                    at = np.searchsorted(kept, codes // s)
                    inside = (at < len(kept)) & (kept[np.minimum(at, len(kept) - 1)] == codes // s) if len(kept) else np.zeros(len(codes), bool)
                    c = np.bincount(at[inside] * s + codes[inside] % s, n[inside], len(kept) * s).reshape(-1, s)
                base = share[parent_of, x]
                n, d = c.sum(axis=1, keepdims=True), (c > 0).sum(axis=1, keepdims=True)
                left = np.where(c > 0, 0, base)
                rest = left.sum(axis=1, keepdims=True)
                with np.errstate(divide="ignore", invalid="ignore"):
                    # Nothing left to escape to: the seen bytes have it all.
                    p = np.where(c > 0, c / np.where(rest > 0, n + d, n), d / (n + d) * left / rest)
                here[:, x] = np.where(n > 0, p, base)
            step = s**order
            if order:
                grid = self.row.reshape(-1, step)
                grid[:, kept] = first + np.arange(len(kept), dtype=np.int32)
            first += len(kept)
            shares.append(here)
            share, known = here, kept
        bits = -np.log2(np.maximum(np.concatenate(shares), 1e-30))
        self.bits = np.ascontiguousarray(bits.transpose(0, 2, 1).reshape(-1, len(self.langs)), np.float32)

    def code_lengths(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Bits per text and language; text i is data[starts[i]:ends[i]], and
        texts lie one behind the other."""
        s, out = SYMBOLS, np.zeros((len(starts), len(self.langs)))
        full = np.flatnonzero(ends > starts)
        if not len(full):
            return out
        begin = starts[full]
        low, high = int(begin[0]), int(ends[full[-1]])
        for a in range(low, high, PIECE):
            b = min(high, a + PIECE)
            head = min(ORDER, a)
            sym = _CLASS[data[a - head : b]].astype(np.int32)
            if head < ORDER:
                sym = np.concatenate([np.zeros(ORDER - head, np.int32), sym])
            before = [sym[ORDER - k : len(sym) - k] for k in (3, 2, 1)]
            inside = begin[(begin > a - ORDER) & (begin < b)]
            if len(inside):  # a text starts after white space
                before = [x.copy() for x in before]
                for k, x in zip((3, 2, 1), before, strict=True):
                    for j in range(k):
                        at = inside + j - a
                        x[at[(at >= 0) & (at < b - a)]] = 0
            row = self.row[(before[0] * s + before[1]) * s + before[2]]
            cost = self.bits[row * np.int64(s) + sym[ORDER:]]
            x0 = int(np.searchsorted(begin, a, side="right")) - 1
            cuts = np.concatenate([[a], begin[(begin > a) & (begin < b)]]) - a
            out[full[x0 : x0 + len(cuts)]] += np.add.reduceat(cost, cuts, axis=0, dtype=np.float64)
        return out


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(data, starts, ends) of a binary or string column; nulls are empty."""
    column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_binary(column.type) or pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    o = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8), o[:-1], o[1:]


def _gram_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, gram, n) of about GRAM_PIECE symbols at a time."""
    s = SYMBOLS

    def counted(lang: str, grams: list[np.ndarray]) -> pa.RecordBatch:
        codes, n = np.unique(np.concatenate(grams), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array([lang] * len(codes), pa.string()), pa.array(codes), pa.array(n)], ["lang", "gram", "n"])

    for batch in batches:
        data, starts, ends = text_bytes(batch.column(1))
        langs = np.array(batch.column(0).to_pylist(), object)
        for lang in sorted(set(langs)):
            grams, size = [], 0
            for a, b in zip(starts[langs == lang], ends[langs == lang], strict=True):
                for p in range(a, b, GRAM_PIECE):
                    q, before = min(b, p + GRAM_PIECE), max(a, p - ORDER)
                    sym = np.concatenate([np.zeros(ORDER - (p - before), np.int64), _CLASS[data[before:q]].astype(np.int64)])
                    grams.append(((sym[:-3] * s + sym[1:-2]) * s + sym[2:-1]) * s + sym[3:])
                    size += q - p
                    if size >= GRAM_PIECE:
                        yield counted(lang, grams)
                        grams, size = [], 0
            if grams:
                yield counted(lang, grams)


def sample_texts(labelled: DataFrame, train_bytes: int = TRAIN_BYTES) -> DataFrame:
    """(lang, text): distinct texts of each language, drawn by hash at the rate
    that gives about ``train_bytes``, and its text of the smallest draw
    always, so that no language is left out. Copies count as one text, in the
    sizes and in the sample."""
    rows = labelled.select("lang", F.col("text").cast("binary").alias("text")).dropna()
    rows = rows.withColumn("h", F.xxhash64("text")).withColumn("draw", F.pmod("h", F.lit(1_000_000)) / 1e6)
    distinct = rows.select("lang", "h", "draw", F.length("text").alias("size")).distinct()
    first = F.min(F.struct("draw", "h")).alias("first")
    sizes = distinct.groupBy("lang").agg((F.lit(float(train_bytes)) / F.greatest(F.sum("size"), F.lit(1))).alias("part"), first)
    if sizes.count() > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} values of lang")
    chosen = (F.col("draw") < F.col("part")) | (F.col("h") == F.col("first.h"))
    sample = rows.join(F.broadcast(sizes), "lang").filter(chosen)
    return sample.dropDuplicates(["lang", "h"]).select("lang", "text")


def fit(labelled: DataFrame, train_bytes: int = TRAIN_BYTES) -> Trees:
    """Trees from (lang, text) rows; rows with a null in either are left out."""
    sample = sample_texts(labelled, train_bytes)
    grams = sample.mapInArrow(tidy(_gram_counts), "lang string, gram long, n long")
    # At most one entry per sampled byte, packed into one row per language.
    counted = grams.groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas()
    return Trees({lang: (g.gram.to_numpy(np.int64), g.n.to_numpy(np.float64)) for lang, g in counted.groupby("lang")})


def identify(docs: DataFrame, trees: Trees, text: str = "text", names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``docs`` with two columns more: the predicted language, and its share
    if all languages were equally likely beforehand."""
    from pyspark.sql import types as T

    if not trees.langs:
        return docs.withColumns({names[0]: F.lit(UNKNOWN), names[1]: F.lit(0.0)})
    model = docs.sparkSession.sparkContext.broadcast(trees)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = model.value
        langs = np.array(trees.langs, object)
        for batch in batches:
            bits = trees.code_lengths(*text_bytes(batch.column(batch.num_columns - 2)))
            best = bits.argmin(axis=1)
            score = 1.0 / np.exp2(np.maximum(bits.min(axis=1, keepdims=True) - bits, -1000)).sum(axis=1)
            lettered = np.array(batch.column(batch.num_columns - 1).to_pylist(), bool)
            yield pa.RecordBatch.from_arrays(
                [batch.column(k) for k in range(batch.num_columns - 2)]
                + [pa.array(np.where(lettered, langs[best], UNKNOWN), pa.string()), pa.array(np.where(lettered, score, 0.0))],
                names=[f"c{k}" for k in range(batch.num_columns)],
            )

    # Positional names inside: the table may have columns of any name.
    rows = docs.toDF(*[f"c{k}" for k in range(len(docs.columns))])
    source = rows[f"c{docs.columns.index(text)}"]
    fields = rows.schema.fields + [T.StructField("lang", T.StringType()), T.StructField("score", T.DoubleType())]
    fields = [T.StructField(f"c{k}", f.dataType) for k, f in enumerate(fields)]
    sent = rows.select("*", source.cast("binary").alias("x"), has_letter(source).alias("y"))
    return sent.mapInArrow(tidy(run), T.StructType(fields)).toDF(*docs.columns, *names)


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def fit_documents(docs: DataFrame) -> Trees:
    """Trees from the documents of the training folds."""
    return fit(docs.filter(fold(F.col("doc_id"), 5) != 0).select("lang", "text"))


@ship
def op6_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every whole text of ``documents``."""
    docs = table(spark, sf_dir, "documents")
    found = identify(docs.select("doc_id", "text"), fit_documents(docs))
    return found.select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "lang_pred", "score")


QUERIES = {"op6_langid": op6_langid}
SQL: dict[str, str] = {}
