"""Toxicity by compression distance under two zstandard dictionaries.

An ordinary dictionary is trained on windows of ordinary text. A toxic one
is trained on the stretches of toxic text whose byte n-grams are clearly
commoner in toxic than in ordinary documents. Every window of ``WINDOW``
words is compressed twice: with the ordinary dictionary, and with the
ordinary dictionary followed by the toxic one. The bytes saved by the second
are the window's evidence: how much commoner that saving is in toxic
documents was measured on labelled documents that the dictionaries have not
seen. A logistic step, fitted on the same documents and corrected to the
labels' true rate, turns a document's evidence into a probability.

The model is fitted on at most ``FIT_DOCS`` documents and ``FIT_BYTES`` bytes
per class, taken in hash order; every window of every text is scored.

Defined cases: a null text is empty; an empty text has no window and gets the
score that the logistic step gives to no evidence; if either class has no
labelled text, all scores are 0; a document labelled both ways counts as
toxic; rows without id or label teach nothing; repeated rows get equal
scores; an empty table gives no row. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fold, ship, table

WINDOW = 6
GRAM = 5
ORDINARY_BYTES = 32_768
TOXIC_BYTES = 4_096
LEVEL = 3
FIT_DOCS = 6_000
FIT_BYTES = 8_000_000
ODDS, SURE = 4.0, 6.0  # a telling n-gram: times commoner, standard errors apart
LOW, HIGH = -4, 10  # savings are counted within these bounds
CUT = 0.3


def windows(text: bytes) -> list[bytes]:
    words = text.lower().split()
    return [b" " + b" ".join(words[k : k + WINDOW]) + b" " for k in range(0, len(words), WINDOW)]


def _grams(text: bytes) -> np.ndarray:
    a = np.frombuffer(text, np.uint8).astype(np.int64)
    n = len(a) - GRAM + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    key = a[:n].copy()
    for j in range(1, GRAM):
        key = key * 256 + a[j : n + j]
    return key


def _doc_counts(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(np.concatenate([np.unique(_grams(t)) for t in texts]), return_counts=True)


def telling_stretches(toxic: list[bytes], ordinary: list[bytes]) -> list[bytes]:
    """Stretches of the toxic texts covered by n-grams that tell the classes apart."""
    flat = [b" " + b" ".join(t.lower().split()) + b" " for t in toxic]
    keys, n = _doc_counts(flat)
    other, m = _doc_counts([b" " + b" ".join(t.lower().split()) + b" " for t in ordinary])
    at = np.minimum(np.searchsorted(other, keys), max(0, len(other) - 1))
    o = np.where(other[at] == keys, m[at], 0) if len(other) else np.zeros(len(keys))
    a, b = len(toxic), len(ordinary)
    share, rest = (n + 0.5) / (a + 1), (o + 0.5) / (b + 1)
    both = np.clip((n + o) / (a + b), 1e-9, 1 - 1e-9)
    apart = (share - rest) / np.sqrt(both * (1 - both) * (1 / a + 1 / b))
    hot = keys[(share > ODDS * rest) & (apart > SURE)]
    out = []
    for t in flat:
        hit = np.isin(_grams(t), hot)
        covered = np.zeros(len(t) + 2, np.int8)
        for j in range(GRAM):
            covered[1 + j : 1 + j + len(hit)] |= hit
        edges = np.flatnonzero(np.diff(covered))
        out += [t[x:y] for x, y in zip(edges[::2], edges[1::2], strict=True)]
    return out


def _train(size: int, samples: list[bytes]) -> bytes:
    """A trained dictionary, or where there is too little to train on, the
    samples themselves, the last ones kept."""
    import zstandard

    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(dict.fromkeys(samples))[-size:]


class Model:
    def __init__(self, ordinary: bytes, toxic: bytes):
        self.ordinary, self.toxic = ordinary, toxic
        self.evidence = np.zeros(HIGH - LOW + 1)
        self.weights: np.ndarray | None = None

    def savings(self, texts: Iterator[bytes]) -> Iterator[np.ndarray]:
        """Per text: how many of its windows save LOW, ..., HIGH bytes."""
        import zstandard as z

        made = []
        for d in (self.ordinary, self.ordinary + self.toxic):
            params = z.ZstdCompressionParameters.from_level(
                LEVEL, format=z.FORMAT_ZSTD1_MAGICLESS, write_content_size=False, write_dict_id=False, write_checksum=False
            )
            held = z.ZstdCompressionDict(d)
            held.precompute_compress(compression_params=params)
            made.append(z.ZstdCompressor(dict_data=held, compression_params=params).compress)
        plain, both = made
        for t in texts:
            saved = [len(plain(w)) - len(both(w)) for w in windows(t)]
            yield np.bincount(np.clip(np.array(saved, np.int64), LOW, HIGH) - LOW, minlength=HIGH - LOW + 1)

    def features(self, counts: np.ndarray) -> np.ndarray:
        total = counts @ self.evidence
        n = np.maximum(counts.sum(axis=1), 1)
        telling = counts @ (self.evidence > 1.0)
        top = np.where(counts > 0, self.evidence, -9.0).max(axis=1)
        return np.column_stack(
            [
                np.ones(len(counts)), np.clip(total, -20, 40) / 10, np.log(n), 5 * telling / n, np.minimum(telling, 10) / 5,
                np.clip(total / np.sqrt(n), -4, 8) / 4, np.clip(top, -1, 6) / 3, 3 * counts @ np.maximum(self.evidence, 0) / n,
            ]
        )

    def calibrate(self, counts: np.ndarray, toxic: np.ndarray, rate: float) -> None:
        """Evidence per saving and the logistic step; ``rate`` is the share of
        toxic rows among all labels."""
        t, o = counts[toxic].sum(axis=0) + 1.0, counts[~toxic].sum(axis=0) + 1.0
        self.evidence = np.log(t / t.sum() / (o / o.sum()))
        x, y = self.features(counts), toxic.astype(float)
        w = np.zeros(x.shape[1])
        for _ in range(60):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            hess = (x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(w))
            w += np.linalg.solve(hess, x.T @ (y - p) - 0.1 * w)
        seen = toxic.mean()
        w[0] += np.log(rate / (1 - rate)) - np.log(seen / (1 - seen))
        self.weights = w

    def scores(self, counts: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.features(counts) @ self.weights, -30, 30)))


def fit(docs: DataFrame, labels: DataFrame) -> Model | None:
    """Model from (doc_id, text) and (doc_id, toxic); None if a class is missing.

    Half of the sampled documents of each class train the dictionaries, the
    other half the calibration.
    """
    known = labels.dropna(subset=["doc_id", "toxic"]).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    total = {r["toxic"]: r["n"] for r in known.filter("toxic in (0, 1)").groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(total) < 2:
        return None
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    part = F.when(F.col("toxic") == 1, F.lit(FIT_DOCS / total[1])).otherwise(F.lit(FIT_DOCS / total[0]))
    # About FIT_DOCS ids per class: a bounded table, so its broadcast is too.
    ids = known.filter("toxic in (0, 1)").withColumn("draw", draw).filter(F.col("draw") / float(1 << 30) < part)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    rows = texts.join(F.broadcast(ids), "doc_id").select("draw", "toxic", "text").orderBy("draw", "text").limit(3 * FIT_DOCS)
    sample: dict[int, list[bytes]] = {0: [], 1: []}
    held = {0: 0, 1: 0}
    for r in rows.toLocalIterator():
        if held[r["toxic"]] < FIT_BYTES:
            sample[r["toxic"]].append(bytes(r["text"]))
            held[r["toxic"]] += len(r["text"])
    ordinary, toxic = sample[0], sample[1]
    if len(ordinary) < 2 or len(toxic) < 2:
        return None
    plain = [w for t in ordinary[::2] for w in windows(t)]
    model = Model(_train(ORDINARY_BYTES, plain), _train(TOXIC_BYTES, telling_stretches(toxic[::2], ordinary[::2])))
    counts = np.array(list(model.savings(toxic[1::2] + ordinary[1::2])))
    marks = np.arange(len(counts)) < len(toxic[1::2])
    model.calibrate(counts, marks, total[1] / (total[0] + total[1]))
    return model


def score(docs: DataFrame, model: Model | None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score, windows): a probability for every whole text."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))
    if model is None:
        return rows.select("doc_id", F.lit(0.0).alias("score"), F.lit(0).cast("long").alias("windows"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = np.array(list(model.savings(x.as_py() for x in batch.column(1))), np.int64).reshape(-1, HIGH - LOW + 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(model.scores(counts)), pa.array(counts.sum(axis=1), pa.int64())],
                ["doc_id", "score", "windows"],
            )

    return rows.mapInArrow(run, f"doc_id {kind}, score double, windows long")


@ship
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every whole text of ``documents``."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = fit(docs, labels.filter(fold(F.col("doc_id"), 4) != 2).select("doc_id", "toxic"))
    return score(docs, model).select(
        "doc_id", (fold(F.col("doc_id"), 4) == 2).alias("held_out"), "score",
        (F.col("score") >= CUT).cast("int").alias("predicted"),
    )


QUERIES = {"op1_toxicity": op1_toxicity}
SQL: dict[str, str] = {}
