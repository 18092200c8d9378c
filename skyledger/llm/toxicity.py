"""Toxicity: a bidirectional GRU with attention pooling over character and word inputs, in numpy.

A word enters as what training documents say about it: the log odds of the
word itself and the strongest and mean log odds of its character 3- to
5-grams (so inflected forms of a known stem count). The network reads every
overlapping window of a text in both directions, pools with attention, and the
text scores as its strongest window. Training sees a bounded sample of
labelled rows: one part counts log odds, the other trains the network by
back-propagation, so the network learns how far to trust them.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm import text as tx

WINDOW, STEP = 64, 48
HIDDEN, FEATURES = 8, 4
BUCKET_BITS = 18
SAMPLE = 1_500          # labelled rows of each class that training reads at most
SAMPLE_CHARS = 20_000   # training rows are texts up to this length; scoring has no such bound
LEAST_DOCS = 3          # documents that must have a word or n-gram for it to count
EPOCHS, BATCH, RATE = 12, 128, 0.02
WORDS_AT_ONCE = 100_000  # words that a task holds as windows; a longer text is held whole
ROWS_AT_ONCE = 500       # rows of an Arrow batch that a task holds as Python texts

_P = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]


def gram_buckets(words: list[bytes], block: int = 20_000) -> tuple[np.ndarray, np.ndarray]:
    """Hashed 3- to 5-grams of ``^word$`` (long words whole): buckets, word after word, and each word's number of them."""
    parts = [_gram_block(words[k:k + block]) for k in range(0, len(words), block)]
    if not parts:
        return np.zeros(0, np.int32), np.zeros(0, np.int64)
    return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])


def _gram_block(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(b"".join(b"^" + w + b"$\n" for w in words), np.uint8)
    owner = np.repeat(np.arange(len(words), dtype=np.int32), np.fromiter((len(w) + 3 for w in words), np.int64, len(words)))
    end = raw == 10
    b = raw.astype(np.uint64) + np.uint64(1)
    out, who = [], []
    h, crossed = b * _P[0], end.copy()
    for n in range(2, 6):
        m = len(raw) - n + 1
        if m <= 0:
            break
        h, crossed = h[:m] + b[n - 1:n - 1 + m] * _P[n - 1], crossed[:m] | end[n - 1:n - 1 + m]
        if n >= 3:
            ok = ~crossed
            out.append((tx.finish(h[ok] * np.uint64(2 * n + 1)) >> np.uint64(64 - BUCKET_BITS)).astype(np.int32))
            who.append(owner[:m][ok])
    bucket, word = np.concatenate(out), np.concatenate(who)  # every word has a gram: ^w$ is three bytes at least
    return bucket[np.argsort(word, kind="stable")], np.bincount(word, minlength=len(words))


def _sigmoid(x):
    return 0.5 * np.tanh(0.5 * x) + 0.5


@dataclass
class Model:
    """Log odds by hashed word and n-gram, and the network's weights."""

    word_odds: np.ndarray
    gram_odds: np.ndarray
    net: dict = field(default_factory=dict)
    scale: float = 1.0
    shift: float = 0.0

    def features(self, words: list[bytes], block: int = 20_000) -> np.ndarray:
        x = np.ones((len(words), FEATURES), np.float32)
        for k in range(0, len(words), block):
            part = x[k:k + block]
            bucket, n = gram_buckets(words[k:k + block])
            odds, first = self.gram_odds[bucket], np.cumsum(n) - n
            part[:, 0] = self.word_odds[word_buckets(words[k:k + block])]
            part[:, 1] = np.maximum.reduceat(odds, first)
            part[:, 2] = np.add.reduceat(odds, first) / n
        return x


def word_buckets(words: list[bytes]) -> np.ndarray:
    h = tx.WordHash(len(words) + 1).array(words)
    return (h >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


class Reader:
    """Numbers words and keeps their features and gate inputs; emptied when it holds many words."""

    def __init__(self, model: Model, limit: int = 400_000):
        self.model, self.limit = model, limit
        self.clear()

    def clear(self):
        self.ids: dict[bytes, int] = {}
        self.x = np.zeros((1, FEATURES), np.float32)  # word 0 pads

    def number(self, docs: list[list[bytes]]) -> list[np.ndarray]:
        if len(self.ids) > self.limit:
            self.clear()
        new = sorted({w for d in docs for w in d} - self.ids.keys())
        if new:
            self.ids.update(zip(new, range(len(self.x), len(self.x) + len(new))))
            self.x = np.concatenate([self.x, self.model.features(new)])
        get = self.ids.__getitem__
        return [np.fromiter(map(get, d), np.int32, len(d)) for d in docs]


def windows(docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """All overlapping windows (rows of word numbers, 0 pads) and their documents; empty texts have none."""
    starts = [np.arange(0, max(1, len(d) - WINDOW + STEP), STEP) if len(d) else np.zeros(0, np.int64) for d in docs]
    owner = np.repeat(np.arange(len(docs)), [len(s) for s in starts])
    flat = np.concatenate([*docs, np.zeros(WINDOW, np.int32)])
    offset = np.cumsum([0, *map(len, docs)])
    at = (np.concatenate([*starts, np.zeros(0, np.int64)]) + offset[:-1][owner]).astype(np.int64)
    index = at[:, None] + np.arange(WINDOW)
    inside = index < offset[1:][owner][:, None]
    return np.where(inside, flat[np.minimum(index, len(flat) - 1)], 0), owner


def start_net(rng: np.random.Generator) -> dict:
    net = {}
    for s in "fb":
        net["W" + s] = rng.normal(0, 0.3, (FEATURES, 3 * HIDDEN))
        net["U" + s] = rng.normal(0, 0.3, (HIDDEN, 3 * HIDDEN))
        net["v" + s], net["o" + s] = rng.normal(0, 0.3, HIDDEN), rng.normal(0, 0.3, HIDDEN)
    net["c"] = np.zeros(1)
    return net


def _steps(side: str):
    return range(WINDOW) if side == "f" else range(WINDOW - 1, -1, -1)


def forward(net: dict, gates: dict, ids: np.ndarray, keep: bool = False):
    """Logit of each window; ``gates``: gate inputs of every word by direction."""
    pad = ids == 0
    n, z = len(ids), slice(0, HIDDEN)
    r, c = slice(HIDDEN, 2 * HIDDEN), slice(2 * HIDDEN, 3 * HIDDEN)
    attend, worth, tape = np.zeros(ids.shape, net["c"].dtype), np.zeros(ids.shape, net["c"].dtype), {}
    for s in "fb":
        h, u = np.zeros((n, HIDDEN), net["U" + s].dtype), net["U" + s]
        steps = []
        for t in _steps(s):
            g, q = gates[s][ids[:, t]], h @ u
            zr = _sigmoid(g[:, :2 * HIDDEN] + q[:, :2 * HIDDEN])
            new = np.tanh(g[:, c] + zr[:, r] * q[:, c])
            after = new + zr[:, z] * (h - new)
            if keep:
                steps.append((t, h, zr, new, q[:, c], after))
            h = after
            attend[:, t] += h @ net["v" + s]
            worth[:, t] += h @ net["o" + s]
        tape[s] = steps
    attend[pad] = -1e9
    a = np.exp(attend - attend.max(1, keepdims=True))
    a /= a.sum(1, keepdims=True)
    logit = (a * worth).sum(1) + net["c"][0]
    return (logit, a, worth, tape) if keep else logit


def gate_inputs(net: dict, x: np.ndarray) -> dict:
    """Gate inputs per word; a padding word (row 0) keeps the state as it is."""
    out = {}
    for s in "fb":
        g = x @ net["W" + s]
        g[0] = 0
        g[0, :HIDDEN] = 30.0
        out[s] = g
    return out


def gradients(net: dict, x: np.ndarray, ids: np.ndarray, y: np.ndarray) -> tuple[float, dict]:
    """Mean log loss of windows and its gradient, by back-propagation through time."""
    gates = gate_inputs(net, x)
    logit, a, worth, tape = forward(net, gates, ids, keep=True)
    p = _sigmoid(logit)
    d = (p - y) / len(y)
    grad = {k: np.zeros_like(v) for k, v in net.items()}
    grad["c"][0] = d.sum()
    mean = (a * worth).sum(1, keepdims=True)
    d_worth, d_attend = d[:, None] * a, d[:, None] * a * (worth - mean)
    z, r, c = slice(0, HIDDEN), slice(HIDDEN, 2 * HIDDEN), slice(2 * HIDDEN, 3 * HIDDEN)
    for s in "fb":
        u, back = net["U" + s], np.zeros((len(ids), HIDDEN))
        for t, h, zr, new, qc, after in reversed(tape[s]):
            grad["v" + s] += after.T @ d_attend[:, t]
            grad["o" + s] += after.T @ d_worth[:, t]
            dh = back + np.outer(d_attend[:, t], net["v" + s]) + np.outer(d_worth[:, t], net["o" + s])
            dn = dh * (1 - zr[:, z]) * (1 - new ** 2)
            dz = dh * (h - new) * zr[:, z] * (1 - zr[:, z])
            dr = dn * qc * zr[:, r] * (1 - zr[:, r])
            dq = np.concatenate([dz, dr, dn * zr[:, r]], 1)
            dg = np.concatenate([dz, dr, dn], 1)
            dg[ids[:, t] == 0] = 0
            grad["W" + s] += x[ids[:, t]].T @ dg
            grad["U" + s] += h.T @ dq
            back = dh * zr[:, z] + dq @ u.T
    loss = float(np.mean(np.logaddexp(0, logit) - y * logit))
    return loss, grad


def log_odds(bucket_sets: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    """Shrunk log odds of label 1 by bucket, from the documents that have it."""
    size = 1 << BUCKET_BITS
    pos = np.bincount(np.concatenate([b for b, v in zip(bucket_sets, y) if v] or [np.zeros(0, np.int64)]), minlength=size)
    neg = np.bincount(np.concatenate([b for b, v in zip(bucket_sets, y) if not v] or [np.zeros(0, np.int64)]), minlength=size)
    odds = np.log((pos + 0.5) / (y.sum() + 1)) - np.log((neg + 0.5) / ((1 - y).sum() + 1))
    seen = pos + neg
    return np.where(seen >= LEAST_DOCS, odds * seen / (seen + 4.0), 0.0).astype(np.float32)


def train(texts: list[str], labels: list[int], seed: int = 5) -> Model:
    """Fit on labelled texts; without both classes the model scores every text 0.5 or its only class."""
    y = np.array(labels, float)
    empty = np.zeros(1 << BUCKET_BITS, np.float32)
    if not len(y) or y.min() == y.max():
        return Model(empty, empty, {}, 0.0, 0.0 if not len(y) else (4.0 if y[0] else -4.0))
    rng = np.random.default_rng(seed)
    number: dict[bytes, int] = {}  # documents as word numbers: far smaller than lists of words
    docs = [np.fromiter((number.setdefault(w, len(number)) for w in tx.label_words(t)), np.int32) for t in texts]
    vocabulary = list(number)
    del number
    counting = np.arange(len(docs)) % 3 != 2  # the others train the network
    wb = word_buckets(vocabulary).astype(np.int32)
    gb, n = gram_buckets(vocabulary)
    first = np.cumsum(n) - n
    word_sets, gram_sets = [], []
    for d in docs:
        own = np.unique(d)
        word_sets.append(np.unique(wb[own]))
        gram_sets.append(np.unique(np.concatenate([gb[first[i]:first[i] + n[i]] for i in own] or [gb[:0]])))
    del gb
    pick = lambda sets, at: [sets[i] for i in np.flatnonzero(at)]
    model = Model(log_odds(pick(word_sets, counting), y[counting]), log_odds(pick(gram_sets, counting), y[counting]))
    own = np.flatnonzero(~counting)
    ids, owner = windows([docs[i] + 1 for i in own])  # 0 pads
    if not len(ids):
        return Model(empty, empty, {}, 0.0, float(np.log(y.mean() / (1 - y.mean()))))
    used, dense = np.unique(np.append(ids, 0), return_inverse=True)
    ids = dense[:-1].reshape(ids.shape).astype(np.int32)
    x = np.concatenate([np.zeros((1, FEATURES)), model.features([vocabulary[i - 1] for i in used[1:]])])
    target = y[own][owner]
    strength = x[ids, :2].sum(2)
    strength[ids == 0] = -9
    strength = np.sort(strength, 1)[:, -2:].sum(1)
    net = start_net(rng)
    moment = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in net.items()}
    step = 0
    for epoch in range(EPOCHS):
        if epoch >= 2:  # a document's label speaks for its strongest window, by now as the network sees it
            strength = forward(net, gate_inputs(net, x), ids)
        best = np.full(len(own), -np.inf)
        np.maximum.at(best, owner, strength)
        top = strength >= best[owner]
        positive = np.flatnonzero(top & (target == 1))
        hard = np.flatnonzero(top & (target == 0))
        rest = np.flatnonzero(~top & (target == 0))
        chosen = np.concatenate([positive, hard, rng.choice(rest, min(len(rest), len(hard)), replace=False)])
        rng.shuffle(chosen)
        for part in np.array_split(chosen, max(1, len(chosen) // BATCH)):
            _, grad = gradients(net, x, ids[part], target[part])
            step += 1
            for k, g in grad.items():
                m, v = moment[k]
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                net[k] -= RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    # The logit of a text's strongest window, calibrated.
    logit = np.full(len(own), -np.inf)
    np.maximum.at(logit, owner, forward(net, gate_inputs(net, x), ids))
    seen = np.isfinite(logit)
    model.net = {k: v.astype(np.float32) for k, v in net.items()}
    model.scale, model.shift = calibrate(logit[seen], y[own][seen])
    # Scoring uses the log odds of all training rows.
    model.word_odds, model.gram_odds = log_odds(word_sets, y), log_odds(gram_sets, y)
    return model


def calibrate(logit: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Logistic fit of labels on logits (Newton, slightly regularised)."""
    a, b = 1.0, 0.0
    for _ in range(30):
        p = _sigmoid(a * logit + b)
        w = p * (1 - p) + 1e-6
        g = np.array([((p - y) * logit).sum() + 0.1 * (a - 1), (p - y).sum() + 0.1 * b])
        h = np.array([[(w * logit ** 2).sum() + 0.1, (w * logit).sum()], [(w * logit).sum(), w.sum() + 0.1]])
        step = np.linalg.solve(h, g)
        a, b = a - step[0], b - step[1]
    return float(max(a, 0.05)), float(b)


def score_texts(model: Model, texts, reader: Reader | None = None) -> np.ndarray:
    """Score of each whole text from all its windows; a text without words has the prior's score."""
    reader = reader or Reader(model)
    out, docs, held, size = [], [], 0, 0

    def flush():
        ids, owner = windows(reader.number(docs))
        logit = np.full(len(docs), -np.inf, np.float64)
        if model.net and len(ids):
            used, dense = np.unique(ids, return_inverse=True)
            x = reader.x[used]
            if used[0] != 0:  # the padding word is always word 0
                x, dense = np.concatenate([reader.x[:1], x]), dense + 1
            gates, dense = gate_inputs(model.net, x), dense.reshape(ids.shape)
            for k in range(0, len(ids), 4096):
                np.maximum.at(logit, owner[k:k + 4096], forward(model.net, gates, dense[k:k + 4096]))
        logit[~np.isfinite(logit)] = 0.0 if not model.net else -8.0
        out.append(_sigmoid(model.scale * logit + model.shift))

    for t in texts:
        docs.append(tx.label_words(t))
        size += len(docs[-1])
        if size >= WORDS_AT_ONCE:
            flush()
            docs, size = [], 0
    if docs:
        flush()
    return np.concatenate(out) if out else np.zeros(0)


def score_column(model: Model, column: pa.Array, reader: Reader) -> np.ndarray:
    """Scores of an Arrow column of texts, of which few become Python texts at once."""
    parts = [score_texts(model, column.slice(k, ROWS_AT_ONCE).to_pylist(), reader) for k in range(0, len(column), ROWS_AT_ONCE)]
    return np.concatenate(parts) if parts else np.zeros(0)


def held_out(id_col: str = "doc_id"):
    """Rows whose labels are never learnt."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int = SAMPLE, longest: int = SAMPLE_CHARS,
                    id_col: str = "doc_id", text_col: str = "text") -> list[tuple[str, int]]:
    """At most ``per_class`` texts of each class from rows that may be learnt, chosen by hash of the id."""
    known = (labels.select(F.col(id_col).cast("long").alias("i"), F.col(label).cast("int").alias("y"))
             .filter("y in (0, 1) and i is not null").filter(~held_out("i")))
    both = [known.filter(F.col("y") == v).orderBy(F.xxhash64("i"), "i").limit(per_class) for v in (0, 1)]
    chosen = both[0].unionByName(both[1]).groupBy("i").agg(F.max("y").alias("y"))
    texts = docs.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).alias("t")).filter(F.length("t") <= longest)
    rows = texts.join(F.broadcast(chosen), "i").dropDuplicates(["i"]).collect()  # 2 * per_class rows at most
    return sorted(((r["i"], r["t"], r["y"]) for r in rows), key=lambda r: (hash((r[0], 17)), r[0]))


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", **names) -> Model:
    """Train on the bounded labelled sample; ``names``: see :func:`labelled_sample`."""
    rows = labelled_sample(docs, labels, label, **names)
    return train([t for _, t, _ in rows], [y for _, _, y in rows])


def toxicity(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``.

    Every overlapping window of the whole text is scored. Null, empty or
    wordless texts get a low constant score (0.5 if nothing could be learnt).
    Null ids are kept and count as not held out; repeated rows score alike;
    other columns are ignored; an empty table gives an empty result.
    """
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(id_col).alias("held_out"),
                       F.col(text_col).alias("text"))

    def run(batches):
        reader = Reader(model)
        for b in batches:
            score = score_column(model, b.column("text"), reader)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("held_out"), pa.array(score, pa.float64()),
                 pa.array((score >= 0.5).astype(np.int32), pa.int32())], ["doc_id", "held_out", "score", "predicted"])
    return base.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def keep_civil(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that aren't predicted toxic, with all their columns; nothing moves between tasks.

    A model that no labels have trained (it scores all texts 0.5) rejects nothing.
    """
    if not model.net and not model.shift:
        return docs

    def run(batches):
        reader = Reader(model)
        for b in batches:
            score = score_column(model, b.column(text_col), reader)
            yield b.filter(pa.array(score < 0.5))
    return docs.mapInArrow(run, docs.schema)
