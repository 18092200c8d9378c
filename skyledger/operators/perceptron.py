"""Multilayer perceptrons on written blocks of rows (M6, M7).

Objective, layers, start, search and stopping rules are MLlib's: sigmoid
layers, softmax with cross entropy over mean of the rows, limited-memory BFGS
with a strong Wolfe search. Each evaluation is one job: a task multiplies its
blocks with the weights as matrices and sums loss and gradient, which meet
stretch by stretch; only one gradient reaches the driver. (MLlib takes the mean
of blocks' means, so its last block of a partition weighs more; here every row
weighs the same, however rows are partitioned.)
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import MultilayerPerceptronClassificationModel, MultilayerPerceptronClassifier
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame

from ..session import discard, spread
from .logistic import _unpacked, pack

MEMORY = 10              # steps that L-BFGS remembers
HISTORY = 20             # values that a step's gain is measured against
STRETCH = 8192           # weights of one row of sums


class SearchError(ArithmeticError):
    """The line search found no step."""


def _layers(weights: np.ndarray, sizes: list[int]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Matrix (inputs x outputs) and intercepts of each layer, in MLlib's order of weights."""
    out, at = [], 0
    for a, b in zip(sizes, sizes[1:]):
        out.append((weights[at:at + a * b].reshape(a, b), weights[at + a * b:at + a * b + b]))
        at += a * b + b
    return out


def loss_and_gradient(weights: np.ndarray, sizes: list[int], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Rows, their summed loss and its gradient, one after the other."""
    layers = _layers(weights, sizes)
    seen = [x]
    with np.errstate(over="ignore"):
        for w, b in layers[:-1]:
            z = seen[-1] @ w + b
            seen.append(1 / (1 + np.exp(-z)))
    z = seen[-1] @ layers[-1][0] + layers[-1][1]
    z -= z.max(1, keepdims=True)
    e = np.exp(z)
    total = e.sum(1, keepdims=True)
    k = y.astype(np.int64)
    rows = np.arange(len(y))
    loss = (np.log(total[:, 0]) - z[rows, k]).sum()
    delta = e / total
    delta[rows, k] -= 1
    parts = []
    for i in range(len(layers) - 1, -1, -1):
        parts += [delta.sum(0), (seen[i].T @ delta).ravel()]
        if i:
            delta = (delta @ layers[i][0].T) * (seen[i] * (1 - seen[i]))
    return np.concatenate([[len(y), loss], *parts[::-1]])


def _summed(blocks: DataFrame, weights: np.ndarray, sizes: list[int]) -> tuple[float, np.ndarray]:
    """Mean loss and gradient over all rows: one job."""
    size = 2 + len(weights)

    def run(batches):
        total = np.zeros(size)
        for _c, x, y in _unpacked(batches):
            if not ((y >= 0) & (y < sizes[-1]) & (y == np.floor(y))).all():
                raise ValueError(f"labels must be whole numbers from 0 to {sizes[-1] - 1}")
            if not np.isfinite(x).all():
                raise ValueError("features must be finite numbers")
            total += loss_and_gradient(weights, sizes, x, y)
        if total[0]:
            at = np.arange(0, size, STRETCH)
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array([total[i:i + STRETCH].tobytes() for i in at], pa.binary())],
                                             ["at", "sums"])

    def meet(batches):
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for at, raw in zip(b.column("at").to_pylist(), b.column("sums").to_pylist()):
                part = np.frombuffer(raw)
                total[at] = total[at] + part if at in total else part
        if total:
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()), pa.array([v.tobytes() for v in total.values()], pa.binary())],
                                             ["at", "sums"])
    kind = "at long, sums binary"
    out = np.zeros(size)
    for r in blocks.mapInArrow(run, kind).repartition("at").mapInArrow(meet, kind).collect():
        part = np.frombuffer(bytes(r["sums"]))
        out[r["at"]:r["at"] + len(part)] = part
    if not out[0]:
        raise ValueError("no rows to fit on")
    return out[1] / out[0], out[2:] / out[0]


def _between(left: tuple, right: tuple) -> float:
    """Minimum of the cubic through two (step, slope, value), at least a tenth of the way from either."""
    (a, da, fa), (b, db, fb) = left, right
    d1 = da + db - 3 * (fa - fb) / (a - b)
    with np.errstate(invalid="ignore", divide="ignore"):
        d2 = np.sqrt(np.float64(d1 * d1 - da * db))
        t = b - (b - a) * (db + d2 - d1) / np.float64(db - da + 2 * d2)
    low, high = a + 0.1 * (b - a), a + 0.9 * (b - a)
    return low if t < low else high if t > high else float(t)


def _step(phi, start: float, most: int = 10) -> float:
    """A step that meets the strong Wolfe conditions; ``phi(t)``: (t, slope, value)."""
    low = phi(0.0)
    _, slope, value = low
    if slope > 0:
        raise SearchError("not a direction of descent")

    def zoom(low, high):
        for _ in range(most):
            c = phi(_between(high, low) if low[0] > high[0] else _between(low, high))
            if c[2] > value + 1e-4 * c[0] * slope or c[2] >= low[2]:
                high = c
                continue
            if abs(c[1]) <= 0.9 * abs(slope):
                return c[0]
            if c[1] * (high[0] - low[0]) >= 0:
                high = low
            low = c
        raise SearchError("no step between the bounds")

    t = start
    for i in range(most):
        c = phi(t)
        if not np.isfinite(c[2]):
            t /= 2
            continue
        if c[2] > value + 1e-4 * t * slope or (c[2] >= low[2] and i > 0):
            return zoom(low, c)
        if abs(c[1]) <= 0.9 * abs(slope):
            return t
        if c[1] >= 0:
            return zoom(c, low)
        low, t = c, 1.5 * t
    raise SearchError("no step")


def _direction(g: np.ndarray, steps: list, turns: list) -> np.ndarray:
    """Minus the inverse curvature, as the remembered steps show it, times the gradient."""
    d, alphas = g.copy(), []
    for s, y in zip(steps[::-1], turns[::-1], strict=True):
        alphas.append((s @ d) / (s @ y))
        d -= alphas[-1] * y
    if steps:
        scale = (steps[-1] @ turns[-1]) / (turns[-1] @ turns[-1])
        d *= scale if np.isfinite(scale) and scale >= 0 else 1.0
    for s, y, a in zip(steps, turns, alphas[::-1], strict=True):
        d += (a - (y @ d) / (s @ y)) * s
    return -d


def minimise(calculate, start: np.ndarray, max_iter: int, tol: float) -> tuple[np.ndarray, int]:
    """L-BFGS from ``start`` by ``calculate(x) -> (value, gradient)``; the place and the steps taken."""
    known: dict[bytes, tuple] = {}

    def at(x):
        key = x.tobytes()
        if key not in known:
            known.clear()                            # the last place is asked for again
            known[key] = calculate(x)
        return known[key]

    x = np.asarray(start, np.float64)
    value, g = at(x)
    steps, turns, values, taken, failed = [], [], [np.inf], 0, False
    first = value
    while taken < max_iter and np.linalg.norm(g) > max(tol * abs(value), 1e-8):
        d = _direction(g, steps, turns)
        here = value, g

        def phi(t, x=x, d=d, here=here):
            v, s = at(x + t * d) if t else here
            return t, float(s @ d), v
        try:
            t = _step(phi, 1.0 if taken else 1 / np.linalg.norm(d))
            if t * np.linalg.norm(g) < 1e-10:
                raise SearchError("steps vanish")
        except SearchError:
            if failed or not steps:                  # without memory the same search would fail again
                break
            steps, turns, failed = [], [], True
            continue
        new = x + t * d
        value, g_new = at(new)
        steps, turns = [*steps, new - x][-MEMORY:], [*turns, g_new - g][-MEMORY:]
        x, g, taken, failed = new, g_new, taken + 1, False
        values = [*values, value][-HISTORY:]
        if abs(value - max(values)) <= tol * abs(first):
            break
    return x, taken


def fit(estimator: MultilayerPerceptronClassifier, train: DataFrame) -> MultilayerPerceptronClassificationModel:
    """The model that ``estimator`` (L-BFGS) describes, fitted on ``train``.

    Null or other labels and features that aren't finite raise an error, as in MLlib.
    """
    spark, sizes = train.sparkSession, list(estimator.getLayers())
    if estimator.getSolver() != "l-bfgs":
        raise ValueError("only L-BFGS is known")
    label, features = estimator.getLabelCol(), estimator.getFeaturesCol()
    # MLlib makes the first weights and the model: from a table of one row, without iterations.
    one = spark.createDataFrame([(0.0, Vectors.sparse(sizes[0], {}))], [label, features])
    start = estimator.copy({estimator.maxIter: 0}).fit(one).weights.toArray()
    blocks = spread(pack(train, features, label), drop=True)
    weights, _ = minimise(lambda w: _summed(blocks, w, sizes), start, estimator.getMaxIter(), estimator.getTol())
    discard(blocks)
    model = estimator.copy({estimator.maxIter: 0, estimator.initialWeights: Vectors.dense(weights)}).fit(one)
    return model.copy({model.maxIter: estimator.getMaxIter()})
