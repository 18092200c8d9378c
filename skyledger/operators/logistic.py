"""Many elastic-net logistic regressions at once.

A grid of settings over several folds shares its data. Rows are packed once
into written blocks of dense matrices; from then on one job per iteration
multiplies every block with the matrix of all unfinished models' coefficients
and sums the gradients of all of them, so a grid costs as many passes as its
slowest member. What reaches the driver is one gradient per model.

Each step minimises a bound of the loss: logistic loss curves at most like a
quarter of the features' covariance, which one first pass sums per chunk of
rows. With that matrix the penalised step is a small local problem and no step
sizes are searched; momentum, started anew where it points uphill, spares
iterations. Objective, standardisation and the
unpenalised intercept are MLlib's, so both end at the same coefficients.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise

BLOCK_BYTES = 4096       # of a written block's features: readers hold thousands of blocks at once
ROWS = 4096              # rows that a task multiplies at once
PACKED = "chunk int, rows int, kinds binary, x binary, y binary"
RANKED = 1 << 16         # rows whose scores a task puts in order at once
BUCKET = 1 << 18         # scores of a model that one task counts at once, about
BUCKETS = 4096           # such buckets of a model at most


def _binary(values: np.ndarray, starts: np.ndarray) -> pa.Array:
    """The rows of ``values`` as bytes, cut where ``starts`` say."""
    row = values.itemsize * values[:1].size
    return pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer((np.append(starts, len(values)) * row).astype(np.int32)),
                                                            pa.py_buffer(np.ascontiguousarray(values))])


def _bytes(column: pa.Array) -> np.ndarray:
    """The bytes of successive blocks."""
    wide = column.cast(pa.large_binary())
    _, at, data = wide.buffers()
    at = np.frombuffer(at, np.int64)[wide.offset:wide.offset + len(wide) + 1]
    return np.frombuffer(data, np.uint8, at[-1] - at[0], at[0])


def _packed(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Kind of each column (1: nothing but 0 and 1) and the rows as bytes: the other columns' doubles, then a bit per column of kind 1."""
    raw = np.ascontiguousarray(x, np.float64).view(np.int64)
    kinds = ((raw == 0) | (raw == np.float64(1).view(np.int64))).all(0)
    doubles = np.ascontiguousarray(x[:, ~kinds], np.float64).view(np.uint8).reshape(len(x), -1)
    return kinds.astype(np.uint8), np.concatenate([doubles, np.packbits(x[:, kinds] != 0, axis=1)], 1)


def _rows_of(raw: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """What :func:`_packed` made bytes of."""
    bits = kinds.astype(bool)
    wide = 8 * int((~bits).sum())
    x = np.empty((len(raw), len(bits)))
    x[:, ~bits] = np.ascontiguousarray(raw[:, :wide]).view(np.float64)
    x[:, bits] = np.unpackbits(raw[:, wide:], axis=1, count=int(bits.sum()))
    return x


def pack(df: DataFrame, features: str, label: str, chunk: str | None = None) -> DataFrame:
    """Blocks of rows of one chunk (``chunk``: integers from 0; one chunk if None), written.

    A block has at most :data:`BLOCK_BYTES` of features (one row at least): readers of any
    kind, Parquet's and Arrow's, hold blocks by their number, not by their size. Columns of
    nothing but 0 and 1 (in the rows packed together) take a bit a row.
    """
    def run(batches):
        for b in batches:
            n = b.num_rows
            if not n:
                continue
            x = b.column("x").flatten().to_numpy(zero_copy_only=False).reshape(n, -1)
            y = b.column("y").to_numpy(zero_copy_only=False).astype(np.float64)
            part = b.column("chunk").to_numpy(zero_copy_only=False)
            kinds, raw = _packed(x)
            step = max(1, BLOCK_BYTES // max(1, raw.shape[1]))
            for c in np.unique(part):
                at = np.flatnonzero(part == c)
                starts = np.arange(0, len(at), step)
                rows = np.diff(np.append(starts, len(at))).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(starts), c), pa.int32()), pa.array(rows),
                                                  pa.array([kinds.tobytes()] * len(starts), pa.binary()), _binary(raw[at], starts),
                                                  _binary(y[at], starts)], ["chunk", "rows", "kinds", "x", "y"])
    kind = dict(df.dtypes)[features]
    values = F.col(features) if kind.startswith("array") else vector_to_array(features)
    rows = df.select((F.col(chunk) if chunk else F.lit(0)).cast("int").alias("chunk"), values.alias("x"), F.col(label).cast("double").alias("y"))
    return materialise(rows.mapInArrow(run, PACKED))


def _unpacked(batches):
    """``chunk, x, y`` of successive blocks put together, at most :data:`ROWS` rows at a time."""
    for b in batches:
        if not b.num_rows:
            continue
        n, chunk, kinds = b.column("rows").to_numpy(), b.column("chunk").to_numpy(), b.column("kinds").dictionary_encode()
        of = kinds.indices.to_numpy()
        cut = np.flatnonzero((np.diff(chunk) != 0) | (np.diff(of) != 0)) + 1   # blocks of a chunk and of one layout come one after the other
        for lo, hi in zip(np.r_[0, cut], np.r_[cut, len(n)]):
            rows, layout = int(n[lo:hi].sum()), np.frombuffer(kinds.dictionary[of[lo]].as_py(), np.uint8)
            raw, y = _bytes(b.column("x").slice(lo, hi - lo)).reshape(rows, -1), _bytes(b.column("y").slice(lo, hi - lo))
            for k in range(0, rows, ROWS):
                at = slice(k, min(k + ROWS, rows))
                yield int(chunk[lo]), _rows_of(raw[at], layout), y[8 * at.start:8 * at.stop].copy().view(np.float64)


def _summed(blocks: DataFrame, part, size: int) -> np.ndarray:
    """Sum over all blocks of the vectors ``part(chunk, x, y)``: within tasks, then element by element on the cluster."""
    def run(batches):
        total = np.zeros(size)
        for c, x, y in _unpacked(batches):
            total += part(c, x, y)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.float64())], ["at", "value"])
    rows = blocks.mapInArrow(run, "at long, value double").groupBy("at").agg(F.sum("value").alias("value")).collect()
    out = np.zeros(size)
    for r in rows:
        out[r["at"]] = r["value"]
    return out


@dataclass
class Fits:
    """Fitted models: ``coefficients[fold, setting]`` (intercept last, on raw features) and the iterations each took."""

    coefficients: np.ndarray
    iterations: np.ndarray
    converged: np.ndarray


def moments_of(blocks: DataFrame, chunks: int) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """Features' number and, per chunk, rows, sums and sums of products."""
    first = blocks.select(F.octet_length("kinds").alias("features")).head()
    if first is None:
        raise ValueError("no rows to fit on")
    d = first["features"]
    size = 1 + d + d * d

    def part(c, x, _y):
        out = np.zeros((chunks, size))
        if c < chunks:
            out[c] = np.r_[len(x), x.sum(0), (x.T @ x).ravel()]
        return out.ravel()
    total = _summed(blocks, part, chunks * size).reshape(chunks, size)
    return d, total[:, 0], total[:, 1:1 + d], total[:, 1 + d:].reshape(chunks, d, d)


def _bounded_step(w, g, h, top, l1, l2, rounds: int = 500, tol: float = 1e-9):
    """Per row of ``w``: the minimum of g (v - w) + (v - w) h (v - w) / 2 + l1 |v| + l2 |v|^2 / 2 over v.

    Accelerated proximal steps for all rows at once; ``top``: largest eigenvalue of ``h``.
    """
    step = 1 / (top + l2)[:, None]
    v = at = w
    t = 1.0
    for _ in range(rounds):
        z = at - step * (g + (at - w) @ h + l2[:, None] * at)
        new = np.sign(z) * np.maximum(np.abs(z) - step * l1[:, None], 0)
        if ((at - new) * (new - v)).sum() > 0:      # momentum points uphill: start it anew
            t = 1.0
        t, before = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        at = new + (before - 1) / t * (new - v)
        moved = np.abs(new - v).max(initial=0)
        v = new
        if moved < tol:
            break
    return v


def fit_many(blocks: DataFrame, settings: list[tuple[float, float]], trains: list[list[int]] = ((0,),),
             max_iter: int = 300, tol: float = 1e-6, moments=None) -> Fits:
    """Fit every (regParam, elasticNetParam) of ``settings`` on every fold's chunks ``trains``.

    Each iteration is one job over ``blocks``. A model stops when no
    standardised coefficient moves by more than ``tol``, or at ``max_iter``.
    Constant features get no weight; folds without rows raise ValueError.
    ``moments``: those of the same blocks, if known (:func:`moments_of`).
    """
    return fit_capped(blocks, settings, [max_iter], trains, tol, moments)[max_iter]


def fit_capped(blocks: DataFrame, settings: list[tuple[float, float]], caps: list[int], trains: list[list[int]] = ((0,),),
               tol: float = 1e-6, moments=None) -> dict[int, Fits]:
    """:func:`fit_many` for every ``max_iter`` of ``caps``: one run, which passes the smaller caps on its way to the largest.

    Settings of the same penalties (no penalty, whatever its kind) are fitted once.
    """
    penalties = [(r * a, r * (1 - a)) for r, a in settings]
    once = sorted(set(penalties))
    where = [once.index(p) for p in penalties]
    return {cap: Fits(f.coefficients[:, where], f.iterations[:, where], f.converged[:, where])
            for cap, f in _fit_capped(blocks, once, caps, trains, tol, moments).items()}


def _fit_capped(blocks, penalties, caps, trains, tol, moments) -> dict[int, Fits]:
    chunks = 1 + max(c for t in trains for c in t)
    d, n, sums, products = moments or moments_of(blocks, chunks)
    folds, size = len(trains), len(penalties)
    l1, l2 = np.array(penalties).reshape(size, 2).T
    rows, mean, scale, bound = np.zeros(folds), np.zeros((folds, d)), np.zeros((folds, d)), np.zeros((folds, d, d))
    for f, t in enumerate(trains):
        rows[f] = n[list(t)].sum()
        if rows[f] == 0:
            raise ValueError(f"fold {f} has no rows to fit on")
        mean[f] = sums[list(t)].sum(0) / rows[f]
        cov = products[list(t)].sum(0) / rows[f] - np.outer(mean[f], mean[f])
        var = np.maximum(np.diag(cov), 0) * rows[f] / max(rows[f] - 1, 1)
        varies = var > 1e-20 * (1 + mean[f] ** 2)
        scale[f] = np.where(varies, 1 / np.sqrt(np.where(varies, var, 1)), 0)
        bound[f] = 0.25 * cov * np.outer(scale[f], scale[f])
    top = np.array([max(np.linalg.eigvalsh(h)[-1], 1e-12) for h in bound])
    w, taken, open_ = np.zeros((folds, size, d + 1)), np.zeros((folds, size), int), np.ones((folds, size), bool)
    ahead, t = w.copy(), np.ones((folds, size))     # where gradients are taken: a momentum step ahead of w
    found: dict[int, Fits] = {}

    def reached(cap: int) -> bool:
        """Keeps the fits as they stand at ``cap``, if they do."""
        if not open_.any() or taken.max(initial=0) >= cap:
            raw = w[:, :, :d] * scale[:, None, :]
            found[cap] = Fits(np.concatenate([raw, w[:, :, d:] - (raw * mean[:, None, :]).sum(2)[:, :, None]], 2), taken.copy(), ~open_)
        return cap in found
    while not all([reached(cap) for cap in caps if cap not in found]):
        at = np.argwhere(open_)
        raw = ahead[open_][:, :d] * scale[at[:, 0]]
        shift = ahead[open_][:, d] - (raw * mean[at[:, 0]]).sum(1)
        uses = [[k for k, (f, _) in enumerate(at) if c in trains[f]] for c in range(chunks)]

        def part(c, x, y, raw=raw, shift=shift, uses=uses, count=len(at)):
            out = np.zeros((count, d + 1))
            k = uses[c] if c < len(uses) else []
            if k:
                z = np.clip(x @ raw[k].T + shift[k], -500, 500)
                rest = 1 / (1 + np.exp(-z)) - y[:, None]
                out[k] = np.c_[rest.T @ x, rest.sum(0)]
            return out.ravel()
        grads = _summed(blocks, part, len(at) * (d + 1)).reshape(len(at), d + 1)
        for f in range(folds):
            mine = np.flatnonzero(at[:, 0] == f)
            if not len(mine):
                continue
            s = at[mine, 1]
            from_, old = ahead[f, s], w[f, s]
            g0 = grads[mine, d] / rows[f]
            g = (grads[mine, :d] / rows[f] - mean[f] * g0[:, None]) * scale[f]
            new = np.c_[_bounded_step(from_[:, :d], g, bound[f], top[f], l1[s], l2[s]), from_[:, d] - 4 * g0]
            moved = np.abs(new - from_).max(1)
            uphill = ((from_ - new) * (new - old)).sum(1) > 0
            before = np.where(uphill, 1.0, t[f, s])
            t[f, s] = (1 + np.sqrt(1 + 4 * before * before)) / 2
            w[f, s], ahead[f, s] = new, new + ((before - 1) / t[f, s])[:, None] * (new - old)
            taken[f, s] += 1
            open_[f, s] = moved > tol
    return found


def margins(blocks: DataFrame, coefficients: np.ndarray, tests: list[list[int]] = ((0,),)) -> DataFrame:
    """``fold, setting, label, score``: every fold's test chunks scored by all of its models in one scan."""
    def run(batches):
        for c, x, y in _unpacked(batches):
            for f, t in enumerate(tests):
                if c not in t:
                    continue
                z = x @ coefficients[f, :, :-1].T + coefficients[f, :, -1]
                for s in range(z.shape[1]):
                    n = len(y)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(n, f), pa.int32()), pa.array(np.full(n, s), pa.int32()),
                                                      pa.array(y), pa.array(z[:, s])], ["fold", "setting", "label", "score"])
    return blocks.mapInArrow(run, "fold int, setting int, label double, score double")


def aucs(blocks: DataFrame, coefficients: np.ndarray, tests: list[list[int]] = ((0,),)) -> np.ndarray:
    """``[fold, setting]``: exact area under the ROC curve of every model on its fold's test chunks; NaN without both classes.

    Scores move as bytes, a model's in buckets that a task puts in order by itself. Their bounds come
    from a look at every 64th row and only set the buckets' sizes; every score is counted.
    """
    folds, size = coefficients.shape[:2]

    def scores(batches):
        for c, x, y in _unpacked(batches):
            for f, t in enumerate(tests):
                if c in t:
                    yield f, x, y

    def look(batches):
        rows, seen = np.zeros(folds), [[np.empty((0, size))] for _ in range(folds)]
        for f, x, _y in scores(batches):
            rows[f] += len(x)
            seen[f].append(x[::64] @ coefficients[f, :, :-1].T + coefficients[f, :, -1])
            if len(seen[f]) > 512:
                seen[f] = [np.sort(np.concatenate(seen[f]), 0)[::2]]
        for f in np.flatnonzero(rows):
            some = np.sort(np.concatenate(seen[f]), 0)
            some = some[np.linspace(0, len(some) - 1, min(len(some), 256)).astype(int)]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(size, f), pa.int32()), pa.array(np.arange(size), pa.int32()), pa.array(np.full(size, rows[f])),
                                              pa.array([v.tobytes() for v in some.T], pa.binary())], ["fold", "setting", "rows", "some"])

    def bounds(batches):
        rows, some = {}, {}
        for b in batches:
            for f, s, n, v in zip(*(b.column(k).to_pylist() for k in ("fold", "setting", "rows", "some"))):
                rows[f, s] = rows.get((f, s), 0) + n
                some.setdefault((f, s), []).append((n, np.frombuffer(v)))
        for (f, s), parts in some.items():
            value = np.concatenate([v for _, v in parts])
            weight = np.concatenate([np.full(len(v), n / len(v)) for n, v in parts])
            order = np.argsort(value)
            count = int(min(BUCKETS, -(-rows[f, s] // BUCKET)))
            upto = np.cumsum(weight[order])
            edges = np.unique(value[order][np.searchsorted(upto, np.arange(1, count) / count * upto[-1])])
            yield pa.RecordBatch.from_arrays([pa.array([f], pa.int32()), pa.array([s], pa.int32()), pa.array([edges.tobytes()], pa.binary())],
                                             ["fold", "setting", "edges"])
    kind = "fold int, setting int, rows double, some binary"
    met = blocks.mapInArrow(look, kind).repartition("fold", "setting").mapInArrow(bounds, "fold int, setting int, edges binary")
    edges = {(r["fold"], r["setting"]): np.frombuffer(bytes(r["edges"])) for r in met.collect()}

    def deal(batches):
        def flush(f, held):
            x, positive = np.concatenate([z for z, _ in held]), np.concatenate([y for _, y in held])
            for s in range(size):
                for side in (True, False):
                    z = np.sort(x[positive == side, s])
                    cut = np.r_[0, np.searchsorted(z, edges[f, s]), len(z)]
                    starts = np.concatenate([np.arange(lo, hi, BLOCK_BYTES // 8) for lo, hi in zip(cut, cut[1:])])
                    if len(starts):
                        bucket = np.searchsorted(cut, starts, "right") - 1
                        n = len(starts)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(n, f), pa.int32()), pa.array(np.full(n, s), pa.int32()), pa.array(bucket, pa.int32()),
                             pa.array(np.full(n, side)), _binary(z, starts.astype(np.int64))], ["fold", "setting", "bucket", "positive", "scores"])
        held = [[] for _ in range(folds)]
        for f, x, y in scores(batches):
            held[f].append((x @ coefficients[f, :, :-1].T + coefficients[f, :, -1], y == 1.0))
            if sum(len(y) for _, y in held[f]) >= RANKED:
                yield from flush(f, held[f])
                held[f] = []
        for f, rest in enumerate(held):
            if rest:
                yield from flush(f, rest)

    def counted(key, parts):
        p, q = (np.sort(np.concatenate([np.empty(0), *parts[side]])) for side in (True, False))
        below = float(np.searchsorted(q, p).sum() + np.searchsorted(q, p, "right").sum()) / 2
        return pa.RecordBatch.from_arrays([pa.array([v], pa.int32()) for v in key] + [pa.array([float(v)]) for v in (len(p), len(q), below)],
                                          ["fold", "setting", "bucket", "p", "q", "below"])

    def count(batches):
        key, parts = None, {}
        for b in batches:
            for *new, side, raw in zip(*(b.column(k).to_pylist() for k in ("fold", "setting", "bucket", "positive", "scores"))):
                if new != key:
                    if key:
                        yield counted(key, parts)
                    key, parts = new, {True: [], False: []}
                parts[side].append(np.frombuffer(raw))
        if key:
            yield counted(key, parts)
    by = ["fold", "setting", "bucket"]
    dealt = blocks.mapInArrow(deal, "fold int, setting int, bucket int, positive boolean, scores binary").repartition(*by).sortWithinPartitions(*by)
    out = np.full((folds, size), np.nan)
    of: dict[tuple, list] = {}
    for r in dealt.mapInArrow(count, "fold int, setting int, bucket int, p double, q double, below double").collect():
        of.setdefault((r["fold"], r["setting"]), []).append(r)
    for at, rows in of.items():
        rows.sort(key=lambda r: r["bucket"])
        p, q, below = (np.array([r[k] for r in rows]) for k in ("p", "q", "below"))
        if p.sum() and q.sum():
            out[at] = (below + p * (np.cumsum(q) - q)).sum() / (p.sum() * q.sum())
    return out
