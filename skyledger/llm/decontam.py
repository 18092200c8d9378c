"""Benchmark decontamination by latent semantic retrieval.

Overlapping passages of all benchmark items and documents are TF-IDF vectors
over the benchmark's vocabulary (other words only lengthen a passage's vector).
The latent space is the items' own span, which loses nothing of an item, beside
the leading directions of a distributed randomised SVD: tasks sum the products of all words
of all documents' passages (of a large vocabulary: their products with the basis), the driver holds matrices of vocabulary x rank.
In the items' span the latent product is the plain one, so it is summed from
postings (word -> items); in the SVD's space both vectors are scaled to length 1.
Passages whose share of benchmark words can't reach the cosine asked for (by
Cauchy-Schwarz) are skipped, unless they have a run of benchmark words as a
copy has: rare words around a copy lower every cosine, so there the share of the
item's words counts. Candidates are checked on the words: longest common subsequence
of the whole item and the words around the passage, and whether the item's
answer (its last words) is there.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm import text as tx
from skyledger.llm.store import discard, save

WINDOW, STEP = 32, 16        # words of a passage, and between passages
RANK, OVERSAMPLE = 256, 16   # of the randomised SVD
PASSAGES = 4_096             # passages whose products a task takes at once
PAIRED = 256                 # passages whose word pairs a task lists at once
SQUARE = 4_096               # words of a vocabulary up to which a task sums a square of it (67 MB)
ROWS = 64                    # rows of the square that are summed together
STRETCH = 512                # words of the vocabulary that one group sums
ITEMS_PER_PASS = 2_000       # items that tasks hold at once; more items take more passes
BYTES_PER_PASS = 1_000_000   # of item text, and so of vocabulary; a longer item has a pass of its own
LEAST_COSINE = 0.4
LEAST_SHARE = 0.5            # of an item's words in one passage; a copy cut by passages leaves more in one of them
TOGETHER = 50_000            # words of several texts whose passages a task searches at once
CELLS = 100_000              # passages x items' passages that a task scores at once
LCS_ALONE, LCS_WITH_ANSWER, ANSWER_WORDS = 0.7, 0.5, 5
HITS = "doc_id string, item_id long, cosine double, lcs int, lcs_ratio double, answer boolean, at_word long"


def lcs_length(item: list, passage: list) -> int:
    """Longest common subsequence, one bit per item word."""
    where: dict = {}
    for i, w in enumerate(item):
        where[w] = where.get(w, 0) | 1 << i
    full = (1 << len(item)) - 1
    row = full
    for w in passage:
        hit = row & where.get(w, 0)
        row = (row + hit | row - hit) & full
    return len(item) - row.bit_count()


class Space:
    """What tasks need of a block of items: vocabulary, weights, latent basis and item vectors."""

    def __init__(self, items: list[tuple[int, list[bytes]]]):
        self.items = items
        #: Passages of the items (item, words), cut as documents are; the vectors below are theirs.
        self.parts = [(i, ws[s:s + WINDOW]) for i, (_, ws) in enumerate(items) for s in _windows(len(ws))]
        self.vocab = {w: i for i, w in enumerate(sorted({w for _, ws in items for w in ws}))}
        self.idf = np.zeros(len(self.vocab))
        self.rare = 1.0
        self.basis = self.vectors = self.post = None
        # A copy has at least this run of benchmark words in one passage; shorter items are found by cosine alone.
        self.run = min((min(len(ws), WINDOW) for _, ws in items if len(ws) >= ANSWER_WORDS), default=0) // 2

    def ids(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.vocab.get, words, repeat(-1)), np.int32, len(words))

    def weigh(self, df: np.ndarray, docs: int) -> None:
        self.idf = np.log((docs + 1) / (df + 1)) + 0.05
        self.rare = float(np.log(docs + 1) + 0.05)

    def rows(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """TF-IDF of one passage (a word counts once): its words and their weights, scaled by its whole length."""
        at = np.unique(ids[ids >= 0])
        v = self.idf[at]
        norm = np.sqrt((v @ v) + np.count_nonzero(ids < 0) * self.rare ** 2)
        return at, v / norm if norm else v

    def index(self, own: list[tuple[np.ndarray, np.ndarray]]) -> None:
        """Postings by word: item's passage, weight, and the share of the passage's places that the word fills."""
        word = np.concatenate([at for at, _ in own])
        order = np.argsort(word, kind="stable")
        part = np.repeat(np.arange(len(own)), [len(at) for at, _ in own])
        share = [np.unique(self.ids(ws), return_counts=True)[1] / len(ws) if len(ws) >= ANSWER_WORDS else np.zeros(len(at))
                 for (_, ws), (at, _) in zip(self.parts, own, strict=True)]
        self.post = (np.searchsorted(word[order], np.arange(len(self.vocab) + 1)), part[order],
                     np.concatenate([v for _, v in own])[order], np.concatenate(share)[order])

    def score(self, ids: np.ndarray, starts: np.ndarray, ends: np.ndarray, least: float):
        """Candidates among these passages of one text and all items' passages: passage, item's passage, cosine."""
        ptr, parts, weights, shares = self.post
        place = starts[:, None] + np.arange(WINDOW)
        there = place < ends[:, None]
        words = np.where(there, ids[np.minimum(place, len(ids) - 1)], -1)
        k, m, size = len(starts), len(self.parts), len(self.vocab)
        key = np.unique((np.arange(k)[:, None] * size + words)[words >= 0])
        row, word = key // size, key % size
        idf = self.idf[word]
        inner = np.bincount(row, idf ** 2, minlength=k)
        norm = np.sqrt(inner + np.count_nonzero(there & (words < 0), axis=1) * self.rare ** 2)
        val = idf / norm[row]
        n = ptr[word + 1] - ptr[word]
        at = np.repeat(ptr[word] - np.cumsum(n) + n, n) + np.arange(n.sum())
        cell = np.repeat(row, n) * m + parts[at]
        cos = np.bincount(cell, np.repeat(val, n) * weights[at], minlength=k * m).reshape(k, m)
        share = np.bincount(cell, shares[at], minlength=k * m).reshape(k, m)
        near = np.flatnonzero(inner >= (least * norm) ** 2)
        if len(near):
            first = np.searchsorted(row, near)
            last = np.searchsorted(row, near, side="right")
            z = np.stack([val[a:b].astype(np.float32) @ self.basis[word[a:b]] for a, b in zip(first, last, strict=True)])
            z /= np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-9)
            cos[near] = np.maximum(cos[near], z @ self.vectors.T)
        hit = np.nonzero((cos >= least) | (share >= LEAST_SHARE))
        return *hit, cos[hit]


def _windows(n: int) -> np.ndarray:
    return np.arange(0, max(1, n - WINDOW + STEP), STEP)


def _numbered(space: Space):
    """Every text as its words' numbers in the vocabulary (-1: outside); later passes read these instead of texts."""
    def run(batches):
        for b in batches:
            yield pd.DataFrame({"doc_id": b["doc_id"], "ids": [space.ids(tx.label_words(t)).tobytes() for t in b["text"]]})
    return run


def _document_frequency(space: Space):
    def run(batches):
        n, df = 0, np.zeros(len(space.vocab), np.int64)
        for b in batches:
            for x in b["ids"]:
                ids = np.unique(np.frombuffer(x, np.int32))
                df[ids[ids >= 0]] += 1
                n += 1
        at = np.flatnonzero(df)
        yield pd.DataFrame({"i": np.r_[-1, at], "n": np.r_[n, df[at]]})
    return run


def _passages(texts: list[np.ndarray]):
    """At most ``PASSAGES`` passages at a time of these texts' numbers: a row of sorted words each, -2 past a text's end."""
    for ids in texts:
        starts = _windows(len(ids))
        for k in range(0, len(starts), PASSAGES):
            place = starts[k:k + PASSAGES, None] + np.arange(WINDOW)
            words = np.where(place < len(ids), ids[np.minimum(place, len(ids) - 1)], -2) if len(ids) else np.full(place.shape, -2, np.int32)
            yield np.sort(words, axis=1)


def _joined(parts):
    """Rows of several texts put together until there are ``PASSAGES`` of them."""
    held, n = [], 0
    for p in parts:
        held.append(p)
        n += len(p)
        if n >= PASSAGES:
            yield np.concatenate(held)
            held, n = [], 0
    if held:
        yield np.concatenate(held)


def _weighed(space: Space, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of :func:`_passages` as TF-IDF vectors: passage, word and weight of what isn't 0."""
    there = words >= 0
    there[:, 1:] &= words[:, 1:] != words[:, :-1]
    row, _ = np.nonzero(there)
    word = words[there]
    idf = space.idf[word]
    norm = np.sqrt(np.bincount(row, idf ** 2, minlength=len(words)) + np.count_nonzero(words == -1, axis=1) * space.rare ** 2)
    return row, word, idf / norm[row]


class _Square:
    """A'A summed over passages A: the upper triangle, row after row. Both power iterations read it."""

    def __init__(self, space: Space):
        self.space, self.size = space, len(space.vocab)
        #: Word pair (a, b), a <= b, stands at ``row[a] + b``.
        self.row = _row_starts(self.size)[:-1] - np.arange(self.size)
        self.sums = np.zeros(self.size * (self.size + 1) // 2)

    def add(self, words: np.ndarray) -> None:
        for k in range(0, len(words), PAIRED):
            row, word, val = _weighed(self.space, words[k:k + PAIRED])
            # Pairs of a passage's words in order: each word with itself and those after it.
            n = np.cumsum(np.bincount(row))[row] - np.arange(len(row))
            a = np.repeat(np.arange(len(row)), n)
            b = np.arange(len(a)) - np.repeat(np.cumsum(n) - n - np.arange(len(row)), n)
            # The view has numpy's own float64; arrays pickled into a task carry a copy of it, with which add.at is ten times slower.
            np.add.at(self.sums, self.row[word[a]] + word[b], (val[a] * val[b]).view(np.float64))

    def parts(self):
        """First word of ``ROWS`` rows, and their sums."""
        for k in range(0, self.size, ROWS):
            lo, hi = _row_starts(self.size)[[k, min(k + ROWS, self.size)]]
            yield k, self.sums[lo:hi]


def _row_starts(size: int) -> np.ndarray:
    """Where each row of an upper triangle starts, and its end."""
    at = np.arange(size + 1)
    return at * size - at * (at - 1) // 2


def _times(k: int, sums: np.ndarray, right: np.ndarray, out: np.ndarray) -> None:
    """Adds to ``out`` what the triangle's rows from ``k`` on (:meth:`_Square.parts`), and their mirror image, give times ``right``."""
    size = len(right)
    m = np.zeros((min(ROWS, size - k), size - k), np.float32)
    done = 0
    for i in range(len(m)):
        m[i, i:] = sums[done:done + size - k - i]
        done += size - k - i
    out[k:k + len(m)] += m @ right[k:]
    np.fill_diagonal(m, 0)
    out[k:] += m.T @ right[k:k + len(m)]


class _Products:
    """A'(A right) summed over passages A. Up to ``SQUARE`` words A'A is summed and multiplied last; else each part is multiplied."""

    def __init__(self, space: Space, right: np.ndarray):
        self.space, self.right, self.out = space, right.astype(np.float32), np.zeros(right.shape)
        self.square = _Square(space) if len(space.vocab) <= SQUARE else None

    def add(self, words: np.ndarray) -> None:
        """``words``: rows of :func:`_passages`."""
        if self.square is not None:
            self.square.add(words)
            return
        row, word, val = _weighed(self.space, words)
        for k in range(0, len(words), 64):      # few passages, few words: a small full matrix
            lo, hi = np.searchsorted(row, (k, k + 64))
            at, col = np.unique(word[lo:hi], return_inverse=True)
            m = np.zeros((64, len(at)), np.float32)
            m[row[lo:hi] - k, col] = val[lo:hi]
            self.out[at] += m.T @ (m @ self.right[at])

    def total(self) -> np.ndarray:
        if self.square is not None:
            for k, sums in self.square.parts():
                _times(k, sums, self.right, self.out)
        return self.out


def _squares(space: Space):
    """A partition's A'A in parts of ``ROWS`` rows: places in the part and sums."""
    def run(batches):
        square = _Square(space)
        for words in _joined(_passages(np.frombuffer(x, np.int32) for b in batches for x in b["ids"])):
            square.add(words)
        task = TaskContext.get().partitionId()
        for k, sums in square.parts():
            place = np.flatnonzero(sums).astype(np.int32)
            if len(place):
                yield pd.DataFrame({"at": [k], "task": [task], "place": [place.tobytes()], "part": [sums[place].astype(np.float32).tobytes()]})
    return run


def _sum_squares(size: int):
    """All tasks' sums of each part, added in the tasks' order; rows come sorted by part and task."""
    starts = _row_starts(size)

    def run(batches):
        at, total = None, None
        for b in batches:
            for k, place, part in zip(b["at"], b["place"], b["part"], strict=True):
                if k != at:
                    if at is not None:
                        yield pd.DataFrame({"at": [at], "part": [total.astype(np.float32).tobytes()]})
                    at, total = k, np.zeros(starts[min(k + ROWS, size)] - starts[k])
                total[np.frombuffer(place, np.int32)] += np.frombuffer(part, np.float32)
        if at is not None:
            yield pd.DataFrame({"at": [at], "part": [total.astype(np.float32).tobytes()]})
    return run


def _in_stretches(out: np.ndarray):
    task = TaskContext.get().partitionId()
    for k in range(0, len(out), STRETCH):
        yield pd.DataFrame({"at": [k], "task": [task], "part": [out[k:k + STRETCH].astype(np.float32).tobytes()]})


def _square_product(right: np.ndarray):
    """Partial products (A'A) right from parts of the summed square."""
    def run(batches):
        out, narrow = np.zeros(right.shape), right.astype(np.float32)
        for b in batches:
            for k, x in zip(b["at"], b["part"], strict=True):
                _times(k, np.frombuffer(x, np.float32), narrow, out)
        yield from _in_stretches(out)
    return run


def _product(space: Space, right: np.ndarray):
    """Partial products A'(A right) of a partition's passages, in stretches of the vocabulary."""
    def run(batches):
        sums = _Products(space, right)
        for words in _joined(_passages(np.frombuffer(x, np.int32) for b in batches for x in b["ids"])):
            sums.add(words)
        yield from _in_stretches(sums.total())
    return run


def _sum_stretch(width: int):
    """The sum of all tasks' parts of a stretch, added in the tasks' order."""
    def run(key, parts: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros((STRETCH, width))
        for x in parts.sort_values("task")["part"]:
            rows = np.frombuffer(x, np.float32).reshape(-1, width)
            total[:len(rows)] += rows
        return pd.DataFrame({"at": [key[0]], "part": [total[:len(rows)].astype(np.float32).tobytes()]})
    return run


def fit_space(space: Space, numbered: DataFrame, rank: int = RANK, seed: int = 11) -> Space:
    """Weights and latent basis from all items and the passages of all documents, given as (doc_id, ids) of :func:`_numbered`."""
    counts = (numbered.select("ids").mapInPandas(_document_frequency(space), "i int, n long")
              .groupBy("i").agg(F.sum("n").alias("n")).collect())  # one row per word of the benchmark block
    df, n = np.zeros(len(space.vocab)), 0
    for i, c in counts:
        if i < 0:
            n = c
        else:
            df[i] = c
    space.weigh(df, n)
    own = [space.rows(space.ids(ws)) for _, ws in space.parts]
    space.index(own)
    width = min(len(space.vocab), rank + OVERSAMPLE)
    basis = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(space.vocab), width)))[0]
    square = None
    if len(space.vocab) <= SQUARE:  # one pass over the passages serves both iterations
        parts = numbered.select("ids").mapInPandas(_squares(space), "at int, task int, place binary, part binary")
        square = save(parts.repartition("at").sortWithinPartitions("at", "task")
                      .mapInPandas(_sum_squares(len(space.vocab)), "at int, part binary"), "square", "zstd")
    for _ in range(2):  # power iterations
        if square is not None:
            parts = square.mapInPandas(_square_product(basis), "at int, task int, part binary")
        else:
            parts = numbered.select("ids").mapInPandas(_product(space, basis), "at int, task int, part binary")
        total = parts.groupBy("at").applyInPandas(_sum_stretch(width), "at int, part binary").collect()  # vocabulary x rank
        y = np.zeros(basis.shape)
        for at, v in own:
            y[at] += np.outer(v, v @ basis[at])
        for k, x in total:
            rows = np.frombuffer(x, np.float32).reshape(-1, width)
            y[k:k + len(rows)] += rows
        left, _, _ = np.linalg.svd(y, full_matrices=False)
        basis = left
    if square is not None:
        discard(square)
    space.basis = np.ascontiguousarray(basis[:, :min(rank, width)], dtype=np.float32)
    vectors = np.stack([v.astype(np.float32) @ space.basis[at] for at, v in own])
    space.vectors = vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
    return space


def _before(x: np.ndarray) -> np.ndarray:
    """Sums of all values before each place, and of all."""
    out = np.zeros(len(x) + 1, np.int64 if x.dtype == bool else np.float64)
    np.cumsum(x, out=out[1:])
    return out


def _search(space: Space, least: float):
    # All words of items are in the vocabulary, so words and their numbers match alike.
    wanted = [space.ids(ws).tolist() for _, ws in space.items]
    answers = [ws[-ANSWER_WORDS:] for ws in wanted]

    energy = space.idf ** 2

    def check(ids, first, last, item):
        """The whole item against the words around the passages from ``first`` to ``last``."""
        ws = wanted[item]
        near = ids[max(0, first - len(ws)):last + WINDOW + len(ws)].tolist()
        lcs = lcs_length(ws, near)
        ratio = lcs / len(ws)
        tail = answers[item]
        there = any(near[k:k + len(tail)] == tail for k in range(len(near) - len(tail) + 1))
        return lcs, ratio, there

    def candidates(ids, starts, ends):
        """(passage, item) -> cosine for the passages of these texts, whose words stand one text after the other."""
        inside = ids >= 0
        own, other = _before(np.where(inside, energy[ids], 0.0)), _before(~inside)
        outside = (other[ends] - other[starts]) * space.rare ** 2
        inner = own[ends] - own[starts]
        score = inner * (1 - least ** 2) >= least ** 2 * outside
        if space.run:
            upto = np.zeros(len(ids) + 1, np.int64)  # runs of benchmark words that end before a place
            upto[space.run:] = np.cumsum(other[space.run:] == other[:-space.run])
            score |= upto[ends] > upto[np.minimum(starts + space.run - 1, ends)]
        score = np.flatnonzero(score & (ends > starts))
        step = max(1, CELLS // len(space.parts))
        out: dict[tuple[int, int], float] = {}
        for s in range(0, len(score), step):
            sel = score[s:s + step]
            for k, part, cos in zip(*space.score(ids, starts[sel], ends[sel], least), strict=True):
                at = int(sel[k]), space.parts[part][0]
                out[at] = max(out.get(at, -1.0), float(cos))
        return out

    def run(batches):
        for b in batches:
            found: dict[tuple, tuple] = {}
            for rows, texts in _several(b["ids"]):
                size = np.array([len(x) for x in texts])
                base = np.cumsum(size) - size
                own = [_windows(n) for n in size.tolist()]
                of = np.repeat(np.arange(len(texts)), [len(w) for w in own])
                place = np.concatenate(own)
                starts = place + base[of]
                ends = np.minimum(starts + WINDOW, (base + size)[of])
                near: dict[tuple[int, int], dict[int, float]] = {}  # text, item -> place of a passage -> cosine
                for (k, item), cos in candidates(np.concatenate(texts), starts, ends).items():
                    near.setdefault((int(of[k]), item), {})[int(place[k])] = cos
                for (text, item), places in near.items():
                    # One check for passages that lie closer together than a quarter of the item.
                    reach, groups = len(space.items[item][1]) // 4, []
                    for start in sorted(places):
                        if groups and start - groups[-1][0] <= reach:
                            groups[-1].append(start)
                        else:
                            groups.append([start])
                    for g in groups:
                        lcs, ratio, there = check(texts[text], g[0], g[-1], item)
                        if ratio >= LCS_ALONE or (there and ratio >= LCS_WITH_ANSWER):
                            start = max(g, key=places.get)
                            new = (places[start], lcs, ratio, there, start)
                            old = found.get((rows + text, item))
                            if old is None or (new[1], new[0]) > (old[1], old[0]):
                                found[rows + text, item] = new
            yield pd.DataFrame([(b["doc_id"].iloc[r], space.items[i][0], *v) for (r, i), v in found.items()],
                               columns=["doc_id", "item_id", "cosine", "lcs", "lcs_ratio", "answer", "at_word"]).astype({"item_id": "Int64"})
    return run


def _several(column):
    """Successive texts' numbers, of at least ``TOGETHER`` words: the first one's row, and all of them."""
    held, row, n = [], 0, 0
    for x in column:
        held.append(np.frombuffer(x, np.int32))
        n += len(held[-1])
        if n >= TOGETHER:
            yield row, held
            held, row, n = [], row + len(held), 0
    if held:
        yield row, held


def contaminated(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text: str = "text", least_cosine: float = LEAST_COSINE) -> DataFrame:
    """One row per document and benchmark item found in it:
    ``doc_id, item_id, cosine, lcs, lcs_ratio, answer, at_word``.

    Items are searched by passages of ``WINDOW`` words, as documents are. An item
    counts as found if, near a passage whose latent cosine with one of the item's
    is at least ``least_cosine`` or that holds half of its words (where these are five
    or more), the longest common subsequence covers 0.7 of the whole item's words, or
    0.5 of them and its last five words stand there. So an item of five words and
    more that stands in a document word for word is always found. Items are taken in
    blocks of at most ``ITEMS_PER_PASS`` items and ``BYTES_PER_PASS`` of text by
    id, so what the driver and tasks hold doesn't grow with the benchmark.
    Null or empty texts and items match nothing; documents and items with null ids
    are reported with a null id; repeated rows give repeated rows. Other columns are
    ignored; an empty table of either kind gives an empty result.
    """
    base = docs.select(F.col(id_col).cast("long").cast("string").alias("doc_id"), F.col(text_col).alias("text"))
    found = _found(base, bench, item_col, item_text, least_cosine)
    return found.withColumn("doc_id", F.col("doc_id").cast("long"))


def _found(base: DataFrame, bench: DataFrame, item_col: str = "item_id", item_text: str = "text",
           least_cosine: float = LEAST_COSINE) -> DataFrame:
    """The rows of :func:`contaminated` for (doc_id, text), ``doc_id`` being any string."""
    items = bench.select(F.col(item_col).cast("long").alias("i"), F.col(item_text).alias("t")).filter(
        "t is not null").dropDuplicates(["i", "t"]).withColumn("h", F.sha2("t", 256))
    found, rest = None, items
    while True:
        sizes = (rest.select("i", "h", F.octet_length("t").alias("bytes")).orderBy("i", "h")
                 .limit(ITEMS_PER_PASS).collect())
        if not sizes:
            break
        take = max(1, int(np.searchsorted(np.cumsum([r["bytes"] for r in sizes]), BYTES_PER_PASS, side="right")))
        last = F.struct(F.lit(sizes[take - 1]["i"]).cast("long").alias("i"), F.lit(sizes[take - 1]["h"]).alias("h"))
        rows = rest.filter(F.struct("i", "h") <= last).select("i", "t").collect()
        rest = items.filter(F.struct("i", "h") > last)
        words = [(r["i"], tx.label_words(r["t"])) for r in rows]
        words = [x for x in words if x[1]]
        if words:
            space = Space(words)
            numbered = save(base.mapInPandas(_numbered(space), "doc_id string, ids binary"), "numbered", "zstd")
            hits = save(numbered.mapInPandas(_search(fit_space(space, numbered), least_cosine), HITS), "hits")
            discard(numbered)
            found = hits if found is None else found.unionByName(hits)
    return base.sparkSession.createDataFrame([], HITS) if found is None else found


def keep_clean(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` in which no item is found, with all columns; rows with null ids stay.

    Rows that share an id are judged each by its own text.
    """
    key = tx.fresh(docs, "row_key")
    base = docs.select(tx.row_key(id_col, text_col).alias("doc_id"), F.col(text_col).alias("text"))
    drop = _found(base, bench, **options).select(F.col("doc_id").alias(key)).distinct()
    return docs.withColumn(key, tx.row_key(id_col, text_col)).join(drop, key, "left_anti").select(*docs.columns)
