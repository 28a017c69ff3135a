"""Kernel SVMs on landmarks, many at once: one pass over the rows is a Newton step of every model.

The kernel exp(-gamma |x-y|^2) is approximated by its values at `landmarks` points (Nystroem, 2001): with K the
kernel between landmarks, K = U S U', the map z(x) = S^(-1/2) U' k(x) has z(x) z(y) close to the kernel. A model
is a linear SVM with squared hinge on z,

    |w|^2 / 2 + C sum max(0, 1 - y (w z(x) + b))^2,

whose loss is a quadratic between changes of the active rows, so Newton steps end after a few passes. Models that differ in
gamma, cost, class or fold share every pass: a task keeps loss, gradient and second derivatives of each model over
its rows and hands on one row a model. These are summed in Spark before the driver solves systems
of at most `landmarks` + 1 unknowns. A model stops by itself.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.cleaning import q

LANDMARKS = 64
# Rows that the landmarks are the centres of.
LANDMARK_ROWS = 4096
# Part of the loss and of the gradient below which a model stops, and most passes.
TOLERANCE = 1e-4
PASSES = 60
# Shorter steps that a pass also tries.
SHORTER = 0.5 ** np.arange(1, 13)
# Rows with sums of one model that reach the driver.
SUM_BUCKETS = 16
# Eigenvalues of the landmarks' kernel below this part of the largest are noise.
NOISE = 1e-9


def choose_landmarks(df: DataFrame, names: Sequence[str], count: int = LANDMARKS, rows: int = LANDMARK_ROWS, seed: int = 42) -> np.ndarray:
    """At most `count` centres (k-means) of a sample of `rows` rows, chosen by a hash of the inputs."""
    cells = [q(c).cast("double") for c in names]
    order = F.xxhash64(*cells, F.lit(seed))
    sample = np.array([list(r) for r in df.select(*cells).distinct().orderBy(order, *cells).limit(rows).collect()], float)
    if len(sample) <= count:
        return sample
    draw = np.random.default_rng(seed)
    centres = sample[draw.choice(len(sample), count, replace=False)]
    for _ in range(20):
        nearest = ((sample[:, None, :] - centres[None]) ** 2).sum(axis=2).argmin(axis=1)
        sizes = np.bincount(nearest, minlength=count)
        means = np.stack([np.bincount(nearest, sample[:, k], count) for k in range(sample.shape[1])], axis=1)
        moved = np.where(sizes[:, None] > 0, means / np.maximum(sizes, 1)[:, None], centres)
        if np.allclose(moved, centres):
            break
        centres = moved
    return centres


def _kernel(x: np.ndarray, points: np.ndarray, gamma: float) -> np.ndarray:
    gaps = (x * x).sum(axis=1)[:, None] + (points * points).sum(axis=1)[None] - 2 * x @ points.T
    return np.exp(-gamma * np.maximum(gaps, 0.0))


@dataclass
class KernelMap:
    """z(x) and a constant 1, from the kernel with the landmarks."""

    points: np.ndarray
    gamma: float
    turn: np.ndarray = field(init=False)

    def __post_init__(self):
        values, vectors = np.linalg.eigh(_kernel(self.points, self.points, self.gamma))
        keep = values > NOISE * values.max()
        self.turn = vectors[:, keep] / np.sqrt(values[keep])

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return np.concatenate([_kernel(x, self.points, self.gamma) @ self.turn, np.ones((len(x), 1))], axis=1)

    @property
    def size(self) -> int:
        return self.turn.shape[1] + 1


@dataclass
class Fit:
    """One model: which map, cost, class and fold (-1: learns from all rows), and what it has come to."""

    kernel: int
    cost: float
    label: float
    fold: int = -1
    weights: np.ndarray | None = None
    loss: float = np.inf
    right: float = 0.0
    tested: float = 0.0
    done: bool = False
    step: np.ndarray | None = None


def _pass(rows: DataFrame, n_inputs: int, maps: list[KernelMap], fits: list[Fit], of: list[int]) -> dict[int, np.ndarray]:
    """For each fit numbered in `of`, after its step: loss, right and tested rows of its fold, losses of the shorter steps,
    gradient and second derivatives."""
    plan = rows.sparkSession.sparkContext.broadcast(
        (maps, [(i, fits[i].kernel, fits[i].label, fits[i].fold, fits[i].weights, fits[i].step) for i in of]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_maps, own = plan.value
        head = 3 + len(SHORTER)
        sums = {i: np.zeros(head + len(w) + len(w) ** 2) for i, *_, w, _ in own}
        for batch in batches:
            cells = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(n_inputs + 2)]
            x, label, fold = np.stack(cells[:n_inputs], axis=1).astype(float), cells[-2], cells[-1]
            for kernel in sorted({k for _, k, *_ in own}):
                z = own_maps[kernel](x)
                for i, k, positive, part, w, step in own:
                    if k != kernel:
                        continue
                    y = np.where(label == positive, 1.0, -1.0)
                    before, change = y * (z @ w), y * (z @ step)
                    test, margin = fold == part, before + change
                    learns = ~test
                    active = learns & (margin < 1)
                    za, short = z[active], 1 - margin[active]
                    size, total = len(w), sums[i]
                    total[0] += (short * short).sum()
                    total[1] += (margin[test] > 0).sum()
                    total[2] += test.sum()
                    for at, part_of in enumerate(SHORTER):
                        total[3 + at] += (np.maximum(1 - before[learns] - part_of * change[learns], 0) ** 2).sum()
                    total[head:head + size] -= za.T @ (y[active] * short)
                    total[head + size:] += (za.T @ za).ravel()
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int32()), pa.array([s.tolist() for s in sums.values()], pa.list_(pa.float64()))], names=["fit", "sums"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, values in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                found = values.values.to_numpy()
                total[i] = total[i] + found if i in total else found
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.int32()), pa.array([s.tolist() for s in total.values()], pa.list_(pa.float64()))], names=["fit", "sums"])

    schema = "fit int, sums array<double>"
    summed = rows.mapInArrow(run, schema).repartition(SUM_BUCKETS, "fit", F.spark_partition_id() % SUM_BUCKETS).mapInArrow(add, schema)
    out: dict[int, np.ndarray] = {}
    for row in summed.collect():  # at most SUM_BUCKETS rows for each fit
        out[row["fit"]] = out[row["fit"]] + np.array(row["sums"]) if row["fit"] in out else np.array(row["sums"])
    return out


def solve(rows: DataFrame, names: Sequence[str], label: str, fold: str | None, maps: list[KernelMap], fits: list[Fit]) -> int:
    """Newton steps for all fits at once until each has its least loss; returns the number of passes.

    A fit leaves out the rows of its fold and counts the rows among them that it puts on the right side.
    """
    numbered = q(fold).cast("int") if fold else F.lit(-2)
    narrow = rows.select(*[q(c).cast("double").alias(f"_x{i}") for i, c in enumerate(names)],
                         q(label).cast("double").alias("_label"), numbered.alias("_fold")).persist()
    try:
        for fit in fits:
            fit.weights, fit.step = np.zeros(maps[fit.kernel].size), np.zeros(maps[fit.kernel].size)
        for passes in range(1, PASSES + 1):
            found = _pass(narrow, len(names), maps, fits, [i for i, f in enumerate(fits) if not f.done])
            for i, sums in found.items():
                _step(fits[i], sums)
            if all(fit.done for fit in fits) or not found:
                return passes
        return PASSES
    finally:
        narrow.unpersist()


def _step(fit: Fit, sums: np.ndarray) -> None:
    """Take the step that was tried and find the next Newton step, or go back and try a shorter one."""
    size, head = len(fit.weights), 3 + len(SHORTER)

    def loss_at(part: float, rows: float) -> float:
        inner = (fit.weights + part * fit.step)[:-1]  # the constant is free
        return inner @ inner / 2 + fit.cost * rows

    loss = loss_at(1.0, sums[0])
    shorter = [loss_at(part, rows) for part, rows in zip(SHORTER, sums[3:head], strict=True)]
    least = min(shorter)
    if np.isfinite(fit.loss) and least < fit.loss and fit.loss - least > 2 * (fit.loss - loss):
        fit.step = fit.step * SHORTER[int(np.argmin(shorter))]
        return
    if not loss < fit.loss:
        fit.done = True  # no step of this direction is better
        return
    gained, fit.loss, fit.right, fit.tested = fit.loss - loss, loss, sums[1], sums[2]
    fit.weights = fit.weights + fit.step
    gradient = 2 * fit.cost * sums[head:head + size]
    gradient[:-1] += fit.weights[:-1]
    second = 2 * fit.cost * sums[head + size:].reshape(size, size) + np.diag([*np.ones(size - 1), 1e-9])
    fit.step = -np.linalg.solve(second, gradient)
    # what was gained, and what the quadratic still promises
    if gained <= TOLERANCE * loss or -gradient @ fit.step <= TOLERANCE * loss:
        fit.done = True


# ------------------------------------------------------------------ models


def _name(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def model_of(names: Sequence[str], kernel: KernelMap, fits: list[Fit]) -> PipelineModel:
    """The fits of one map as stages that add svm_margin (of the predicted class) and prediction.

    One fit is a model of two classes, 0 and its label; more are one against the rest, each for its label.
    """
    gaps = [" + ".join(f"POWER(CAST({_name(c)} AS DOUBLE) - {float(p[i])!r}D, 2)" for i, c in enumerate(names)) for p in kernel.points]
    cells = ", ".join(f"EXP({-kernel.gamma!r}D * ({gap}))" for gap in gaps)
    margins = []
    for fit in fits:
        own = kernel.turn @ fit.weights[:-1]
        margins.append(f"AGGREGATE(ZIP_WITH(_near, ARRAY({', '.join(f'{v!r}D' for v in own.tolist())}), (k, v) -> k * v), "
                       f"{float(fit.weights[-1])!r}D, (s, x) -> s + x)")
    near = SQLTransformer(statement=f"SELECT *, ARRAY({cells}) AS _near FROM __THIS__")
    all_ = SQLTransformer(statement=f"SELECT *, ARRAY({', '.join(margins)}) AS _margins FROM __THIS__")
    if len(fits) == 1:
        best = f"_margins[0] AS svm_margin, CASE WHEN _margins[0] > 0 THEN {float(fits[0].label)!r}D ELSE 0.0D END AS prediction"
    else:
        labels = ", ".join(f"{float(f.label)!r}D" for f in fits)
        best = ("ARRAY_MAX(_margins) AS svm_margin, "
                f"ELEMENT_AT(ARRAY({labels}), CAST(ARRAY_POSITION(_margins, ARRAY_MAX(_margins)) AS INT)) AS prediction")
    return PipelineModel([near, all_, SQLTransformer(statement=f"SELECT *, {best} FROM __THIS__")])


@dataclass(frozen=True)
class Search:
    """Candidates (cost, gamma) with their mean accuracy over the folds, the best of them, and its model of all rows."""

    candidates: list[tuple[float, str | float]]
    avgMetrics: list[float]
    best: int
    bestModel: PipelineModel
    passes: int


def _labels(n_classes: int) -> list[float]:
    return [1.0] if n_classes == 2 else [float(c) for c in range(n_classes)]


def search(
    folded: DataFrame, names: Sequence[str], label: str, fold: str, costs: Sequence[float], gammas: Sequence[tuple[str | float, float]],
    folds: int, n_classes: int = 2, landmarks: int = LANDMARKS, seed: int = 42,
) -> Search:
    """k-fold search over costs and gammas (name, value) by accuracy; of equal candidates the first wins.

    The best candidate's model of all rows comes out of the same passes. More than two classes are
    judged by the mean of the classes' accuracies of one against the rest.
    """
    points = choose_landmarks(folded, names, landmarks, seed=seed)
    maps = [KernelMap(points, value) for _, value in gammas]
    candidates = [(cost, name, k) for k, (name, _) in enumerate(gammas) for cost in costs]
    fits = {(i, c, f): Fit(k, cost, c, f) for i, (cost, _, k) in enumerate(candidates) for c in _labels(n_classes) for f in (-1, *range(folds))}
    passes = solve(folded, names, label, fold, maps, list(fits.values()))
    means = []
    for i in range(len(candidates)):
        shares = [x.right / x.tested for f in range(folds) if (own := [fits[i, c, f] for c in _labels(n_classes)]) for x in own if x.tested]
        means.append(float(np.mean(shares)) if shares else 0.0)
    best = int(np.argmax(means))
    model = model_of(names, maps[candidates[best][2]], [fits[best, c, -1] for c in _labels(n_classes)])
    return Search([(cost, name) for cost, name, _ in candidates], means, best, model, passes)


def train(df: DataFrame, names: Sequence[str], label: str, cost: float, gamma: float, n_classes: int = 2,
          landmarks: int = LANDMARKS, seed: int = 42) -> tuple[PipelineModel, list[Fit]]:
    """One kernel SVM from all rows, and its fits."""
    kernel = KernelMap(choose_landmarks(df, names, landmarks, seed=seed), gamma)
    fits = [Fit(0, cost, c) for c in _labels(n_classes)]
    solve(df, names, label, None, [kernel], fits)
    return model_of(names, kernel, fits), fits
