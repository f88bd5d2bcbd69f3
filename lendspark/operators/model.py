"""Logistic PD models (M1-M6), fitted by Newton steps shared by all models.

A pass over the rows gives, for every model still moving, its loss, gradient
and second derivatives (``X'WX`` and ``X'r``): numpy sums over Arrow batches in
the tasks, one row a task and model, added up on the way. The driver holds
these sums only (features squared) and solves for the next step. All folds and
all penalties of a grid search share the passes, some ten in all.

The scaler is the population-std scaler of :mod:`.encode` (E8). The loss is the
weighted sum of log losses plus ``|b|^2 / (2 C)`` (L2) or ``|b| / C`` (L1) over
the scaled coefficients, the intercept free.
"""

from __future__ import annotations

import math
import operator
import os
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.stages import stage
from . import encode, split
from .curves import auc_ks_of_counts, score_counts

DIRECT = 64  # tasks whose sums the driver adds up itself


@dataclass
class PDModel:
    """Fitted scaler, coefficients (on scaled features) and intercept."""

    feature_cols: list
    scaler: encode.ScalerParams
    coefficients: list
    intercept: float
    C: float

    # --- IO6 persistence ---------------------------------------------------------
    def save(self, spark: SparkSession, path: str) -> None:
        rows = [
            (i, c, float(self.scaler.means[c]), float(self.scaler.scales[c]), float(self.coefficients[i]), float(self.intercept), float(self.C))
            for i, c in enumerate(self.feature_cols)
        ]
        spark.createDataFrame(
            rows, "position int, column string, mean double, scale double, coefficient double, intercept double, C double"
        ).coalesce(1).write.mode("overwrite").parquet(os.path.join(path, "logistic"))

    @staticmethod
    def load(spark: SparkSession, path: str) -> PDModel:
        rows = spark.read.parquet(os.path.join(path, "logistic")).orderBy("position").collect()
        if not rows:
            raise ValueError(f"no model in {path}")
        sc = encode.ScalerParams({r["column"]: r["mean"] for r in rows}, {r["column"]: r["scale"] for r in rows})
        return PDModel([r["column"] for r in rows], sc, [r["coefficient"] for r in rows], rows[0]["intercept"], rows[0]["C"])


# --- training sets ----------------------------------------------------------------


@dataclass
class Moments:
    """Rows per class, and count, mean and sum of squared deviations of every
    feature; two of them add up to those of the rows together."""

    classes: np.ndarray
    n: np.ndarray
    mean: np.ndarray
    squares: np.ndarray

    def __add__(self, other: Moments) -> Moments:
        n = self.n + other.n
        share = np.divide(other.n, n, out=np.zeros_like(n), where=n > 0)
        gap = other.mean - self.mean
        return Moments(self.classes + other.classes, n, self.mean + gap * share, self.squares + other.squares + gap * gap * self.n * share)

    def scaler(self, cols: Sequence[str]) -> encode.ScalerParams:
        std = np.sqrt(np.divide(self.squares, self.n, out=np.zeros_like(self.n), where=self.n > 0))
        return encode.ScalerParams(dict(zip(cols, self.mean.tolist(), strict=True)), {c: s or 1.0 for c, s in zip(cols, std.tolist(), strict=True)})


@dataclass
class TrainingSet:
    """Staged rows ``f0, f1, ..., _label, _fold`` and their moments by fold."""

    data: DataFrame
    feature_cols: list
    moments: dict  # fold -> Moments
    parts: int = field(default=0)

    def __post_init__(self):
        self.parts = self.data.rdd.getNumPartitions()

    def moments_without(self, fold: int | None) -> Moments:
        return reduce(operator.add, [m for k, m in self.moments.items() if k != fold])


def training_set(df: DataFrame, feature_cols: Sequence[str], label: str = "default", fold: Column | None = None) -> TrainingSet:
    """The features, label and fold of ``df`` as a stage table of doubles, and
    one aggregate over it. Rows without a label are left out."""
    cols = [F.col(f"`{c}`").cast("double").alias(f"f{i}") for i, c in enumerate(feature_cols)]
    fold = (F.lit(0) if fold is None else fold).cast("int").alias("_fold")
    rows = df.select(*cols, F.col(label).cast("int").alias("_label"), fold).where(F.col("_label").isNotNull())
    data = stage(rows, "training-rows")
    d = len(feature_cols)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        for batch in batches:
            label, folds = (batch.column(d + i).to_numpy(zero_copy_only=False) for i in range(2))
            rows = {k: np.flatnonzero(folds == k) for k in np.unique(folds)}
            for k, at in rows.items():
                held.setdefault(int(k), np.zeros((2 + 3 * d)))[:2] += np.bincount(label[at].clip(0, 2), minlength=3)[:2] * 1.0
            for i in range(d):
                x = batch.column(i).to_numpy(zero_copy_only=False).astype(float)
                for k, at in rows.items():
                    v = x[at]
                    v = v[~np.isnan(v)]
                    if len(v):
                        n, mean, squares = held[k][2 + i :: d]
                        m, all_ = v.mean(), n + len(v)
                        gap = m - mean
                        held[k][2 + i :: d] = all_, mean + gap * len(v) / all_, squares + ((v - m) ** 2).sum() + gap * gap * n * len(v) / all_
        folds = pa.array(list(held), pa.int32())
        yield pa.RecordBatch.from_arrays([folds, pa.array([x.tobytes() for x in held.values()], pa.binary())], ["fold", "sums"])

    moments: dict = {}
    for r in data.mapInArrow(sums, "fold int, sums binary").toLocalIterator():
        x = np.frombuffer(r["sums"])
        one = Moments(x[:2].copy(), *x[2:].reshape(3, d).copy())
        moments[r["fold"]] = moments[r["fold"]] + one if r["fold"] in moments else one
    if not moments:
        raise ValueError("no labelled rows to train on")
    return TrainingSet(data, list(feature_cols), moments)


def class_weights(counts: dict, class_weight: str | dict | None) -> dict:
    if class_weight == "balanced":
        present = {c: m for c, m in counts.items() if m > 0}
        n = sum(counts.values())
        return {c: n / (len(present) * m) for c, m in present.items()}
    return class_weight if isinstance(class_weight, dict) else {0: 1.0, 1: 1.0}


# --- Newton steps -----------------------------------------------------------------


class _Fit:
    """One model on its way: what it leaves out, its penalty, where it is."""

    def __init__(self, ts: TrainingSet, base: encode.ScalerParams, C: float, penalty: str, class_weight, without: int | None):
        cols, moments = ts.feature_cols, ts.moments_without(without)
        self.without, self.C, self.penalty = -1 if without is None else without, C, penalty
        self.scaler = moments.scaler(cols)
        w = class_weights({0: moments.classes[0], 1: moments.classes[1]}, class_weight)
        self.weights = (float(w.get(0, 0.0)), float(w.get(1, 0.0)))
        # Rows come scaled by ``base``: a linear change from this model's scaler.
        of = lambda d: np.array([d[c] for c in cols])
        self.change = np.eye(len(cols) + 1)
        self.change[0, 1:] = (of(base.means) - of(self.scaler.means)) / of(self.scaler.scales)
        self.change[np.arange(1, len(cols) + 1), np.arange(1, len(cols) + 1)] = of(base.scales) / of(self.scaler.scales)
        self.at, self.step = np.zeros(len(cols) + 1), np.zeros(len(cols) + 1)
        self.loss, self.halvings, self.done = math.inf, 0, False

    def candidate(self) -> np.ndarray:
        return self.at + self.step

    def move(self, loss: float, gradient: np.ndarray, second: np.ndarray, tol: float) -> None:
        """Accept the candidate and take the next step, or halve the step."""
        if not (math.isfinite(loss) and np.isfinite(second).all()):
            raise ValueError("a feature is missing or not finite in the training rows")
        here = self.candidate()
        b = here[1:]
        loss += (np.abs(b).sum() if self.penalty == "l1" else b @ b / 2) / self.C
        if loss > self.loss * (1 + 1e-12) and self.halvings < 40:
            self.step, self.halvings = self.step / 2, self.halvings + 1
            self.done = np.abs(self.step).max() <= tol * max(1.0, np.abs(self.at).max())
            return
        self.at, self.loss, self.halvings = here, loss, 0
        gradient, second = self.change.T @ gradient, self.change.T @ second @ self.change
        if self.penalty == "l1":
            self.step = _l1_step(here, gradient, second, 1.0 / self.C)
        else:
            second[np.arange(1, len(here)), np.arange(1, len(here))] += 1.0 / self.C
            gradient[1:] += b / self.C
            self.step = -np.linalg.lstsq(second, gradient, rcond=None)[0]
        self.done = np.abs(self.step).max() <= tol * max(1.0, np.abs(here).max())

    def model(self, cols: list) -> PDModel:
        # The last step is below the tolerance; taking it costs no pass.
        b = self.candidate()
        return PDModel(cols, self.scaler, b[1:].tolist(), float(b[0]), self.C)


def _l1_step(at: np.ndarray, gradient: np.ndarray, second: np.ndarray, penalty: float) -> np.ndarray:
    """Least value of the quadratic model plus ``penalty * |b|``, coordinate by
    coordinate."""
    b, slope = at.copy(), gradient.copy()
    for _ in range(10_000):
        largest = 0.0
        for j in range(len(b)):
            h = second[j, j]
            if h <= 0:
                continue
            goal = b[j] - slope[j] / h
            if j:
                goal = math.copysign(max(0.0, abs(goal) - penalty / h), goal)
            if goal != b[j]:
                slope += second[:, j] * (goal - b[j])
                largest = max(largest, abs(goal - b[j]))
                b[j] = goal
        if largest < 1e-13:
            break
    return b - at


def _pass_sums(ts: TrainingSet, base: encode.ScalerParams, fits: list[_Fit]) -> np.ndarray:
    """(models, 1 + k + k * k): loss, gradient and second derivatives of every
    model at its candidate, in the coordinates of ``base``."""
    d, k, m = len(ts.feature_cols), len(ts.feature_cols) + 1, len(fits)
    mean, scale = (np.array([v[c] for c in ts.feature_cols]) for v in (base.means, base.scales))
    betas = np.stack([f.change @ f.candidate() for f in fits], axis=1)
    weights = np.array([f.weights for f in fits])
    without = np.array([f.without for f in fits])

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((m, 1 + k + k * k))
        for batch in batches:
            x = np.ones((len(batch), k))
            for i in range(d):
                x[:, i + 1] = batch.column(i).to_numpy(zero_copy_only=False)
            x[:, 1:] = (x[:, 1:] - mean) / scale
            y = batch.column(d).to_numpy(zero_copy_only=False)
            held = batch.column(d + 1).to_numpy(zero_copy_only=False)
            z = x @ betas
            p = 1.0 / (1.0 + np.exp(-np.clip(z, -700, 700)))
            w = weights.T[y] * (held[:, None] != without[None, :])
            total[:, 0] += (w * (np.logaddexp(0.0, z) - y[:, None] * z)).sum(axis=0)
            total[:, 1 : 1 + k] += (x.T @ (w * (p - y[:, None]))).T
            curve = w * p * (1 - p)
            for j in range(m):
                total[j, 1 + k :] += ((x * curve[:, j : j + 1]).T @ x).ravel()
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(m * (1 + k + k * k))
        for batch in batches:
            for s in batch.column(0).to_pylist():
                total += np.frombuffer(s)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])

    partial = ts.data.mapInArrow(sums, "sums binary")
    if ts.parts > DIRECT:
        partial = partial.coalesce(DIRECT) if ts.parts <= DIRECT * DIRECT else partial.repartition(math.isqrt(ts.parts))
        partial = partial.mapInArrow(add, "sums binary")
    return np.sum([np.frombuffer(r["sums"]) for r in partial.collect()], axis=0).reshape(m, -1)


def newton_fits(
    ts: TrainingSet, grid: Sequence[tuple[float, int | None]], penalty: str = "l2", class_weight="balanced", max_iter: int = 100, tol: float = 1e-8
) -> list[PDModel]:
    """One model per (C, fold left out), all of them moved by the same passes."""
    base = ts.moments_without(None).scaler(ts.feature_cols)
    fits = [_Fit(ts, base, C, penalty, class_weight, without) for C, without in grid]
    k = len(ts.feature_cols) + 1
    for _ in range(max_iter):
        moving = [f for f in fits if not f.done]
        if not moving:
            break
        for f, s in zip(moving, _pass_sums(ts, base, moving), strict=True):
            f.move(float(s[0]), s[1 : 1 + k].copy(), s[1 + k :].reshape(k, k).copy(), tol)
    return [f.model(list(ts.feature_cols)) for f in fits]


def train_logistic(
    df: DataFrame,
    feature_cols: Sequence[str],
    label: str = "default",
    C: float = 1.0,
    penalty: str = "l2",
    class_weight: str | dict | None = "balanced",
    max_iter: int = 100,
    tol: float = 1e-8,
) -> PDModel:
    """M1: scale (population std, fitted here), then weighted logistic
    regression with an L1 or L2 penalty of strength ``C`` (sum-loss scale)."""
    return newton_fits(training_set(df, feature_cols, label), [(C, None)], penalty, class_weight, max_iter, tol)[0]


def score(model: PDModel, df: DataFrame, out: str = "pd_hat") -> DataFrame:
    """M5: add ``pd_hat`` = P(class 1), a column expression; every input
    column is kept. A missing feature is an error."""
    s = model.scaler
    # NaN for missing: terms without null checks, and one check of their sum.
    terms = [(F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(math.nan)) - F.lit(float(s.means[c]))) * F.lit(float(b) / float(s.scales[c]))
             for c, b in zip(model.feature_cols, model.coefficients, strict=True)]
    z = F.col("_z")
    fail = F.raise_error(F.lit("a feature of the model is missing or not a number")).cast("double")
    p = F.when(F.isnan(z), fail).otherwise(F.lit(1.0) / (F.lit(1.0) + F.exp(-z)))
    rows = df.withColumn("_z", reduce(operator.add, terms, F.lit(float(model.intercept))))
    return rows.withColumn(out, p).drop("_z")


def cross_validated_auc(
    df: DataFrame,
    feature_cols: Sequence[str],
    label: str = "default",
    Cs: Sequence[float] = (0.1, 1.0, 10.0),
    folds: int = 3,
    seed: int = 42,
    penalty: str = "l2",
) -> list[tuple[float, float]]:
    """M2: mean held-out ROC AUC per ``C`` over stratified folds. Scaler and
    balanced weights are those of each training part. All folds and all ``C``
    are fitted together, and one pass over the held-out rows scores them all."""
    with_folds = split.stratified_folds(df, label, folds, seed, out="_fold")
    ts = training_set(with_folds, feature_cols, label, F.col("_fold"))
    grid = [(C, k) for C in Cs for k in range(folds)]
    models = newton_fits(ts, grid, penalty)
    long = held_out_scores(ts, grid, models)
    counts = stage(score_counts(long, "_p", "_label", ["_model"]), "score-counts")
    aucs = {r["_model"]: r["auc"] for r in auc_ks_of_counts(counts, ["_model"]).collect()}
    of = lambda m: math.nan if aucs.get(m) is None else aucs[m]
    return [(C, sum(of(m) for m, g in enumerate(grid) if g[0] == C) / folds) for C in Cs]


def held_out_scores(ts: TrainingSet, grid: Sequence[tuple[float, int]], models: list[PDModel]) -> DataFrame:
    """(_model, _label, _p): every row's score under the models (by their place
    in ``grid``) that left its fold out."""
    d = len(ts.feature_cols)
    mean, scale, beta = (
        np.array([[of[c] for c in ts.feature_cols] for of in side]).T
        for side in ([m.scaler.means for m in models], [m.scaler.scales for m in models], [dict(zip(m.feature_cols, m.coefficients, strict=True)) for m in models])
    )
    start = np.array([m.intercept for m in models])
    folds = np.array([k for _, k in grid])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(d)], axis=1)
            z = x @ (beta / scale) + start - (mean / scale * beta).sum(axis=0)
            row, model = np.nonzero(batch.column(d + 1).to_numpy()[:, None] == folds[None, :])
            p = 1.0 / (1.0 + np.exp(-np.clip(z[row, model], -700, 700)))
            label = batch.column(d).to_numpy()[row]
            yield pa.RecordBatch.from_arrays([pa.array(model, pa.int32()), pa.array(label, pa.int32()), pa.array(p)], ["_model", "_label", "_p"])

    return ts.data.mapInArrow(run, "_model int, _label int, _p double")


def best_of_grid(grid: Sequence[tuple[float, float]]) -> float:
    """The ``C`` of the highest mean AUC (first best wins on ties). A ``C``
    whose AUC is undefined in a fold cannot win; if all are, that is an error."""
    known = [(C, a) for C, a in grid if not math.isnan(a)]
    if not known:
        raise ValueError("no grid value has an AUC in every fold: a fold holds a single class")
    top = max(a for _, a in known)
    return next(C for C, a in known if a == top)


def tune_logistic(
    df: DataFrame,
    feature_cols: Sequence[str],
    label: str = "default",
    Cs: Sequence[float] = (0.01, 0.1, 1.0, 10.0),
    folds: int = 5,
    seed: int = 42,
) -> tuple[float, list[tuple[float, float]]]:
    """M2: best ``C`` by mean held-out AUC (first best wins on ties)."""
    res = cross_validated_auc(df, feature_cols, label, Cs, folds, seed)
    return best_of_grid(res), res


def tune_on_sample(
    train: DataFrame,
    feature_cols: Sequence[str],
    label: str = "default",
    frac: float = 0.15,
    Cs: Sequence[float] = (0.1, 1.0, 10.0),
    folds: int = 3,
    seed: int = 42,
) -> tuple[PDModel, float, list]:
    """M3: stratified subsample -> grid search -> refit on all training rows."""
    sub = split.stratified_subsample(train, label, frac, seed)
    best_c, grid = tune_logistic(sub, feature_cols, label, list(Cs), folds, seed)
    return train_logistic(train, feature_cols, label, best_c), best_c, grid


# Selection rule (minimum AUC gain to prefer the tuned model).
MIN_AUC_GAIN = 0.005


def select_model(spark: SparkSession, baseline_auc: float | None, tuned_auc: float | None) -> DataFrame:
    """M4: one-row decision ``baseline_auc, tuned_auc, delta, selected``."""
    if baseline_auc is None or tuned_auc is None:
        sel, delta = None, None
    else:
        delta = tuned_auc - baseline_auc
        sel = "baseline" if delta < MIN_AUC_GAIN else "tuned"
    return spark.createDataFrame(
        [(baseline_auc, tuned_auc, delta, sel)],
        "baseline_auc double, tuned_auc double, delta double, selected string",
    )


# --- M6 Platt recalibration -----------------------------------------------------------

@dataclass
class Calibrator:
    a: float
    b: float

    def apply(self, df: DataFrame, score_col: str = "pd_hat", out: str = "pd_hat_recal") -> DataFrame:
        z = F.lit(self.a) * F.col(score_col) + F.lit(self.b)
        return df.withColumn(out, F.lit(1.0) / (F.lit(1.0) + F.exp(-z)))


def fit_platt(
    df: DataFrame, score_col: str = "pd_hat", label: str = "default", cal_share: float = 0.2, seed: int = 42,
    order: Sequence[str] | None = None, max_iter: int = 100,
) -> Calibrator:
    """M6 fit: stratified ``cal_share`` of the rows; a sigmoid of an affine
    function of the score with smoothed targets ``(n+ + 1) / (n+ + 2)`` and
    ``1 / (n- + 2)``. Rows fold to (score, positives, negatives) counts; Newton
    steps in the two parameters need six sums over these, with steps halved
    while the loss rises. Missing scores and labels are left out."""
    labelled = split.stratified_split(df, label, 1.0 - cal_share, seed, order=order, out="_part")
    cal = labelled.where(F.col("_part") == "train")
    counts = score_counts(cal, score_col, label).where(F.col("_v").isNotNull() & (F.col("labelled") > 0))
    counts = stage(counts.select(F.col("_v").cast("double").alias("x"), "pos", (F.col("labelled") - F.col("pos")).alias("neg")), "platt-counts")
    total = counts.agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")).first()
    n_pos, n_neg = float(total["pos"] or 0), float(total["neg"] or 0)
    if not n_pos + n_neg:
        raise ValueError("no scored and labelled rows to calibrate on")
    hit, miss = (n_pos + 1.0) / (n_pos + 2.0), 1.0 / (n_neg + 2.0)
    x, n = F.col("x"), F.col("pos") + F.col("neg")
    wanted = F.col("pos") * hit + F.col("neg") * miss
    at, step, loss = np.zeros(2), np.zeros(2), math.inf
    at[1] = math.log((n_pos * hit + n_neg * miss) / (n_pos * (1 - hit) + n_neg * (1 - miss)))
    for _ in range(max_iter):
        a, b = (at + step).tolist()
        z = F.lit(a) * x + F.lit(b)
        p = F.lit(1.0) / (F.lit(1.0) + F.exp(-z))
        softplus = F.greatest(z, F.lit(0.0)) + F.log1p(F.exp(-F.abs(z)))
        r, w = n * p - wanted, n * p * (1 - p)
        terms = {"loss": n * softplus - wanted * z, "ga": r * x, "gb": r, "haa": w * x * x, "hab": w * x, "hbb": w}
        s = counts.agg(*[F.sum(c).alias(name) for name, c in terms.items()]).first()
        if s["loss"] > loss + 1e-12 * abs(loss):
            step = step / 2
        else:
            at, loss = at + step, s["loss"]
            step = -np.linalg.lstsq(np.array([[s["haa"], s["hab"]], [s["hab"], s["hbb"]]]), np.array([s["ga"], s["gb"]]), rcond=None)[0]
        if np.abs(step).max() <= 1e-9 * max(1.0, np.abs(at).max()):
            break
    return Calibrator(*(at + step).tolist())


def recalibrate(
    df: DataFrame, score_col: str = "pd_hat", label: str = "default", seed: int = 42, order: Sequence[str] | None = None
) -> DataFrame:
    """M6: fit on a 20% stratified part, apply to all rows -> ``pd_hat_recal``."""
    return fit_platt(df, score_col, label, 0.2, seed, order).apply(df, score_col)
