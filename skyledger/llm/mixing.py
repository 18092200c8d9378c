"""Mixing sources to target weights by balanced sampling with the cube method.

Each source's target over its size is the number of copies it takes of every
document: the whole part is taken, the fractional part is an inclusion
probability. The cube method rounds these probabilities to 0 or 1: it moves
them along the null space of the constraints (sum of words, number of
documents), so both totals stay exact until at most two documents of a block
are left in between. What is left of all blocks is dealt into new blocks, and
again, until one block per source remains. A block's worth of documents waits
for that last one: its landing picks the rounding nearest in words, and where
a long text leaves words over, single documents and pairs of the block change
sides until the words fit.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm import text as tx
from skyledger.llm.store import discard, save
from skyledger.operators.ordering import with_global_row_id

BLOCK = 2_000       # documents that one flight moves
MOST_COPIES = 3
ROWS = "doc_id string, source string, size long, m double, p double, salt long, waits boolean"


def n_words(column: str):
    """Number of words between white space; 0 for null."""
    return F.coalesce(F.regexp_count(F.col(column), F.lit(tx.NON_SPACE_SQL)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights=(1, 2, 3), most: float = MOST_COPIES) -> DataFrame:
    """``source, source_size, target`` for rows of (source, size).

    Sources by code point (null last) weigh ``weights`` in turn and share the
    total; a target stops at ``most`` times its source's size and the excess is
    shared again by weight among the others, until none is above.
    """
    totals = save(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), "sources")
    order = totals.select("source", "source_size", F.col("source").isNull().cast("int").alias("last"))
    ranked = with_global_row_id(order, ["last", "source"], "rank")
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), ((F.col("rank") - 1) % len(weights) + 1).cast("int"))
    ranked = save(ranked.select("source", "source_size", w.alias("w"), (most * F.col("source_size")).alias("cap")), "weights")
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    level = 0.0  # target = min(cap, level * w); rises as sources fill up
    while True:
        full = F.col("cap") <= level * F.col("w")
        row = ranked.agg(F.sum(F.when(full, F.col("cap")).otherwise(0.0)), F.sum(F.when(full, 0.0).otherwise(F.col("w")))).first()
        after = (total - (row[0] or 0.0)) / row[1] if row[1] else level
        if after <= level * (1 + 1e-12):
            break
        level = after
    return ranked.select("source", "source_size", F.least("cap", level * F.col("w")).alias("target"))


def flight(size: np.ndarray, p: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Move ``p`` through the null space of (size, 1) until at most two stay inside (0, 1)."""
    p, size = p.astype(float).tolist(), size.astype(float).tolist()
    draws, at = rng.random(len(p) + 8).tolist(), 0
    held: list[int] = []
    following = iter(range(len(p)))
    while True:
        for i in following:
            if 0.0 < p[i] < 1.0:
                held.append(i)
                if len(held) == 3:
                    break
        if len(held) == 3:
            i, j, k = held
            u = [size[j] - size[k], size[k] - size[i], size[i] - size[j]]
            if not any(u):
                u = [1.0, -1.0, 0.0]
        elif len(held) == 2 and size[held[0]] == size[held[1]]:
            u = [1.0, -1.0]
        else:
            return np.array(p)
        up = down = np.inf
        for x, i in zip(u, held, strict=True):
            if x > 0:
                up, down = min(up, (1 - p[i]) / x), min(down, p[i] / x)
            elif x < 0:
                up, down = min(up, -p[i] / x), min(down, (p[i] - 1) / x)
        step = up if draws[at % len(draws)] * (up + down) < down else -down
        at += 1
        for x, i in zip(u, held, strict=True):
            q = p[i] + step * x
            p[i] = 0.0 if q < 1e-9 else 1.0 if q > 1 - 1e-9 else q
        held = [i for i in held if 0.0 < p[i] < 1.0]


def landing(size: np.ndarray, p: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Round the few probabilities left: the rounding nearest in words, ties in documents."""
    inside = np.flatnonzero((p > 0) & (p < 1))
    best = min(range(1 << len(inside)), key=lambda m: (
        abs(sum(((m >> b & 1) - p[i]) * size[i] for b, i in enumerate(inside))),
        abs(sum((m >> b & 1) - p[i] for b, i in enumerate(inside)))))
    out = p.copy()
    for b, i in enumerate(inside):
        out[i] = best >> b & 1
    return out


def settle(size: np.ndarray, p: np.ndarray, short: float, rounds: int = 1_000) -> np.ndarray:
    """Let documents of a landed block change sides until its words are nearest to ``short`` more than now.

    Each round makes the one change, of a single document or of one taken for
    one left, that fits best; ties go to the first. Ends when none helps.
    """
    p = p.copy()
    for _ in range(rounds):
        inside, outside = np.flatnonzero(p == 1), np.flatnonzero(p == 0)
        if short == 0:
            break
        change = np.r_[size[outside], -size[inside]]
        if not len(change):
            break
        one = int(np.argmin(np.abs(short - change)))
        best, swap = [int(np.r_[outside, inside][one])], abs(short - change[one])
        if len(inside) and len(outside):
            held = inside[np.argsort(size[inside], kind="stable")]
            at = np.searchsorted(size[held], size[outside] - short)
            for near in (np.clip(at - 1, 0, len(held) - 1), np.clip(at, 0, len(held) - 1)):
                left = np.abs(short - (size[outside] - size[held[near]]))
                k = int(np.argmin(left))
                if left[k] < swap:
                    best, swap = [int(outside[k]), int(held[near[k]])], left[k]
        if swap >= abs(short) - 1e-6:
            break
        for i in best:
            short -= size[i] if p[i] == 0 else -size[i]
            p[i] = 1 - p[i]
    return p


def numbered_copies(rows: DataFrame, at_once: int = 100_000) -> DataFrame:
    """``rows`` with ``copy``: 0, 1, .. among rows that are alike in all columns.

    Copies combine before the shuffle and unfold in stretches of ``at_once``,
    so no group of copies is gathered.
    """
    some = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("copies"))
    begin = some.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(at_once).cast("long"))).alias("begin"))
    end = F.least(F.col("begin") + at_once, "copies") - 1
    return begin.select(*rows.columns, F.explode(F.sequence("begin", end, F.lit(1).cast("long"))).alias("copy"))


def _round(seed: int, final: bool):
    def run(key, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["salt", "size", "doc_id"], kind="stable").reset_index(drop=True)
        rng = np.random.default_rng([seed, len(rows), int(rows["salt"].iloc[0]) & 0xFFFFFFFF])
        size, before = rows["size"].to_numpy(float), rows["p"].to_numpy(float)
        p = flight(size, before, rng)
        if final:
            p = landing(size, p, rng)
            p = settle(size, p, float(size @ (before - p)))
        rows["p"] = p
        return rows[["doc_id", "source", "size", "m", "p", "salt", "waits"]]
    return run


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights=(1, 2, 3), most: float = MOST_COPIES, seed: int = 7, block: int = BLOCK) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, source, size, source_size, target, taken``.

    ``size`` counts words between white space (null: 0); ``taken`` is size
    times the copies the mix takes, 0 to ``most``. A source without words
    takes nothing. Null ids and sources are values like any other; repeated
    rows are documents of their own. Equal inputs and seeds give equal mixes,
    however the rows are partitioned. Other columns are ignored; an empty
    table gives an empty result.
    """
    rows = docs.select(F.col(id_col).cast("long").cast("string").alias("doc_id"), F.col(source_col).cast("string").alias("source"),
                       n_words(text_col).alias("size"))
    rows = save(numbered_copies(rows), "sizes")  # numbers part repeated rows, which else would all fly in one block
    targets = save(source_targets(rows, weights, most), "targets")
    same = rows["source"].eqNullSafe(targets["source"])
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    # The table of sources is one row per source; Spark broadcasts it only if its measured size allows.
    todo = rows.join(targets, same, "left").select(
        "doc_id", rows["source"], "size", ratio.alias("m"),
        F.when(F.col("size") > 0, ratio - F.floor(ratio)).otherwise(0.0).alias("p"),
        F.xxhash64(F.lit(seed), "doc_id", "size", "copy").alias("salt"))
    open_ = F.col("p").between(1e-12, 1 - 1e-12)
    todo = save(todo, "flight")
    done = [todo.filter(~open_)]

    def dealt(rows, level):
        """Rows with the number of their source's blocks and their own."""
        counts = rows.groupBy("source").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
        counts = counts.withColumnRenamed("source", "s")
        at = F.pmod(F.xxhash64("salt", F.lit(level)), F.col("blocks")).cast("int")
        return rows.join(counts, rows["source"].eqNullSafe(counts["s"])).drop("s").withColumn("block", at)
    # One block of every source waits for the last round.
    todo = save(dealt(todo.filter(open_), 0).select(*[c for c in todo.columns], (F.col("block") == 0).alias("waits")), "flight")
    level = 1
    while True:
        cut = dealt(todo.filter(~F.col("waits")), level)
        if cut.filter("blocks > 1").isEmpty():
            break
        moved = cut.filter("blocks > 1").groupBy("source", "block").applyInPandas(_round(seed + level, False), ROWS)
        after = save(moved.unionByName(cut.filter("blocks = 1").select(*moved.columns))
                     .unionByName(todo.filter("waits").select(*moved.columns)), "flight")
        done.append(after.filter(~open_).drop("waits"))
        todo = after.filter(open_)
        level += 1
    done.append(save(todo.groupBy("source").applyInPandas(_round(seed + level, True), ROWS), "flight").drop("waits"))
    rounded = done[0]
    for more in done[1:]:
        rounded = rounded.unionByName(more)
    copies = F.floor("m") + F.when(F.col("p") > 0.5, 1).otherwise(0)
    out = rounded.select("doc_id", F.col("source").alias("s"), "size", (F.col("size") * copies).cast("long").alias("taken"))
    mixed = save(out.join(targets, out["s"].eqNullSafe(targets["source"]), "left").select(
        F.col("doc_id").cast("long").alias("doc_id"), "source", "size", "source_size", "target", "taken"), "mix")
    discard(rows, targets, *done)
    return mixed
