"""Source divergence audit: how far the term shares of every source lie from its peers' and its language's.

Term counts per (lang, source) form a sparse matrix, one row per group. Pair
values are computed as Gustavson multiplies sparse matrices, a row at a time:
a group walks its terms through a term-major index (for each term, the peers
that have it) and scatters into a dense accumulator with one cell per peer, so
no pair of postings is ever a row. The index holds occurring terms only,
though absent ones have a share above zero as well; three baseline sums
correct for them (see :func:`_tile`).

Work is cut into tiles of two blocks of groups and one bucket of terms, so a
task holds a bounded part of the index whatever the sizes of languages and
sources are.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from skyledger.llm.store import discard, save

#: Fixed value: shares are whole numbers of billionths.
SCALE = 1_000_000_000
#: Bytes of a term: A-Z (lower-cased), a-z and all above ASCII; every other byte separates.
TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
HELD = 150_000           # distinct counts that a task holds before it hands them on
BLOCK = 1024             # groups of a block
POSTINGS = 50_000        # postings of a block that a tile is meant to hold; as many as it has pairs, if that is more
FLAT = 1_000_000         # index entries that a group scatters at once

COUNTS = "lang string, source string, term string, n long, df long"


def term_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """``lang, source, term, n, df``: occurrences and documents of every term in every group.

    Tasks add up what they read before anything is shuffled, a bounded number of terms at a time.
    """
    types = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64()]

    def run(batches):
        def out():
            for (lang, source), (n, df) in held.items():
                terms = list(n)
                for at in range(0, len(terms), 10_000):
                    part = terms[at:at + 10_000]
                    cols = ([lang] * len(part), [source] * len(part), [t.decode("utf-8") for t in part],
                            [n[t] for t in part], [df[t] for t in part])
                    yield pa.RecordBatch.from_arrays(list(map(pa.array, cols, types)), ["lang", "source", "term", "n", "df"])
        held: dict = {}
        size = 0
        for b in batches:
            for lang, source, text in zip(b.column("lang").to_pylist(), b.column("source").to_pylist(), b.column("text")):
                words = text.as_py().encode("utf-8", "replace").translate(TERM_BYTES).split()
                n, df = held.setdefault((lang, source), (Counter(), Counter()))
                before = len(n)
                n.update(words)
                df.update(set(words))
                size += len(n) - before
                if size > HELD:
                    yield from out()
                    held.clear()
                    size = 0
        yield from out()
    cols = [F.coalesce(F.col(c), F.lit("")).alias(name) for c, name in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))]
    return (docs.select(*cols).mapInArrow(run, COUNTS)
            .groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("df").alias("df")))


def _f(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """floor((p - q)^2 / (p + q)); shares are at most SCALE + 1, so the square fits 64 bits."""
    d = p - q
    return d * d // (p + q)


def _steps(p: np.ndarray, base: int, peers: np.ndarray) -> np.ndarray:
    """Per peer: sum over the shares ``p`` of f(p, peer's baseline) - f(own baseline, peer's baseline).

    Equal shares (most terms occur a few times) are taken together.
    """
    values, times = np.unique(p, return_counts=True)
    out = np.zeros(len(peers), np.int64)
    step = max(1, FLAT // max(1, len(peers)))
    for at in range(0, len(values), step):
        v, t = values[at:at + step, None], times[at:at + step, None]
        out += (t * _f(v, peers[None, :])).sum(0)
    return out - len(p) * _f(np.int64(base), peers)


def _tile(key, rows: pd.DataFrame) -> pd.DataFrame:
    """Values that one bucket of terms adds to the pairs of two blocks of groups.

    With b a group's share of an absent term, the sum over all V terms of
    f(p_g, p_h) is
      V f(b_g, b_h) + sum over g's terms of f(p_g, b_h) - f(b_g, b_h)
                    + sum over h's terms of f(b_g, p_h) - f(b_g, b_h)
                    + sum over shared terms of f(p_g, p_h) - f(p_g, b_h) - f(b_g, p_h) + f(b_g, b_h),
    where only the last sum goes through the index. A group's own row (null
    term) carries b and V; V's part is added in bucket 0 alone. Sums of a
    tile stay below 2^53, so the float accumulator of ``bincount`` is exact.
    """
    lang, bucket, low, high = key
    own = rows[rows["term"].isnull()]
    rows = rows[rows["term"].notnull()]
    sides = []
    for block in dict.fromkeys((low, high)):
        groups = own[own["block"] == block].sort_values("source")
        part = rows[rows["block"] == block]
        sides.append((groups["source"].to_numpy(), groups["base"].to_numpy(np.int64), groups["v"].to_numpy(np.int64),
                      pd.Index(groups["source"]).get_indexer(part["source"]), part))
    codes, _ = pd.factorize(rows["term"])
    coded = pd.Series(codes, index=rows.index)
    n_terms = int(codes.max()) + 1 if len(codes) else 0
    (g_names, g_base, g_v, g_at, g_rows), (h_names, h_base, _, h_at, h_rows) = sides[0], sides[-1]

    order = np.argsort(coded[h_rows.index].to_numpy(), kind="stable")        # the term-major index of block `high`
    h_term = coded[h_rows.index].to_numpy()[order]
    peer, peer_p = h_at[order], h_rows["p"].to_numpy(np.int64)[order]
    start = np.searchsorted(h_term, np.arange(n_terms + 1))
    by_group = np.argsort(g_at, kind="stable")
    g_term, g_p = coded[g_rows.index].to_numpy()[by_group], g_rows["p"].to_numpy(np.int64)[by_group]
    g_start = np.searchsorted(g_at[by_group], np.arange(len(g_names) + 1))

    total = np.zeros((len(g_names), len(h_names)), np.int64)
    for g in range(len(g_names)):
        terms, p = g_term[g_start[g]:g_start[g + 1]], g_p[g_start[g]:g_start[g + 1]]
        total[g] += _steps(p, g_base[g], h_base)
        length = start[terms + 1] - start[terms]
        ends = np.cumsum(length)
        at = 0
        while at < len(terms):     # as many terms at once as FLAT index entries, one at least
            done = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, done + FLAT, "right")))
            size = length[at:to]
            flat = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(start[terms[at:to]], size)
            h, q, own_p = peer[flat], peer_p[flat], np.repeat(p[at:to], size)
            value = _f(own_p, q) - _f(own_p, h_base[h]) - _f(g_base[g], q) + _f(g_base[g], h_base[h])
            total[g] += np.bincount(h, value, len(h_names)).astype(np.int64)
            at = to
        if bucket == 0:
            total[g] += g_v[g] * _f(g_base[g], h_base)
    h_order = np.argsort(h_at, kind="stable")
    h_p = h_rows["p"].to_numpy(np.int64)[h_order]
    h_start = np.searchsorted(h_at[h_order], np.arange(len(h_names) + 1))
    for h in range(len(h_names)):
        total[:, h] += _steps(h_p[h_start[h]:h_start[h + 1]], h_base[h], g_base)

    a, b, value = np.repeat(g_names, len(h_names)), np.tile(h_names, len(g_names)), total.ravel()
    if low == high:
        keep = a != b
        a, b, value = a[keep], b[keep], value[keep]
    else:       # the value is the same seen from the other side
        a, b, value = np.concatenate([a, b]), np.concatenate([b, a]), np.concatenate([value, value])
    return pd.DataFrame({"lang": lang, "source": a, "item": b, "value": value})


def placed(groups: DataFrame, block: int = BLOCK, per_tile: int = POSTINGS) -> DataFrame:
    """``groups`` (with ``terms``, their numbers of postings) with their ``block`` and their language's ``blocks`` and ``buckets``.

    Both follow from counts, so a source that holds most postings is cut into more buckets of terms.
    """
    shape = (groups.groupBy("lang").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"),
                                        F.max("terms").alias("most"), F.sum("terms").alias("every"), F.count(F.lit(1)).alias("groups"))
             .withColumn("in_block", F.col("groups") / F.col("blocks"))
             .select("lang", "blocks", F.ceil(F.greatest(F.lit(1), "most", F.col("every") / F.col("blocks"))
                                             / F.greatest(F.lit(per_tile), F.col("in_block") * F.col("in_block"))).cast("int").alias("buckets")))
    return groups.join(shape, "lang").withColumn("block", F.pmod(F.xxhash64("source"), "blocks").cast("int"))


def pair_values(groups: DataFrame, postings: DataFrame) -> DataFrame:
    """``lang, source, item, value`` for every ordered pair of sources of a language.

    ``groups``: ``lang, source, v, base`` (V of the language and the share of
    an absent term) as :func:`placed`, ``postings``: ``lang, source, term, p``
    for occurring terms, with their group's place.
    """
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    none = lambda kind: F.lit(None).cast(kind)
    own = (groups.withColumn("bucket", F.explode(F.sequence(F.lit(0), F.col("buckets") - 1)))
           .select("*", other, none("string").alias("term"), none("long").alias("p")))
    held = (postings.withColumn("bucket", F.pmod(F.xxhash64("term"), "buckets").cast("int"))
            .select("*", other, none("long").alias("v"), none("long").alias("base")))
    cols = ["lang", "source", "block", "bucket", "term", "p", "v", "base",
            F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high")]
    return (own.select(*cols).unionByName(held.select(*cols)).groupBy("lang", "bucket", "low", "high")
            .applyInPandas(_tile, "lang string, source string, item string, value long")
            .groupBy("lang", "source", "item").agg(F.sum("value").alias("value")))


def source_divergence(docs: DataFrame, min_docs: int = 10, top: int = 10, text_col: str = "text", lang_col: str = "lang",
                      source_col: str = "source") -> DataFrame:
    """``lang, source, part, item, value, rank`` for every (lang, source) of ``docs``.

    A language keeps the V terms that occur in at least ``min_docs`` of its
    rows. A group gives a kept term the share p = 1 + floor(10^9 (count + 2) /
    (N + 2 V)), N being its occurrences of kept terms; so does the language as
    a whole. Part ``pair``: every other source of the language, by the sum
    over all V terms of f(p, q) = floor((p - q)^2 / (p + q)). Part ``term``:
    the ``top`` terms whose share is above the language's, by f.

    Null text, lang and source count as empty. Groups without kept terms have
    pairs (of value 0 if V is 0) but no terms; a language's only source has no
    pairs. Ties rank by item in UTF-8 order. Repeated rows count as often as
    they stand there; an empty table gives an empty result; other columns are
    ignored. Whole numbers throughout; counts must stay below 10^18.
    """
    counts = save(term_counts(docs, text_col, lang_col, source_col), "terms")
    by_term = counts.groupBy("lang", "term").agg(F.sum("n").alias("all_n"), F.sum("df").alias("df")).filter(F.col("df") >= min_docs)
    kept = save(by_term.select("lang", "term", "all_n"), "kept")
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("all_n").alias("lang_n"))
    held = save(counts.join(kept, ["lang", "term"]).select("lang", "source", "term", "n", "all_n"), "held")
    totals = held.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("terms"))
    every = docs.select(F.coalesce(F.col(lang_col), F.lit("")).alias("lang"), F.coalesce(F.col(source_col), F.lit("")).alias("source")).distinct()

    def shared(count: str, total: str) -> F.Column:
        """The whole-number share; decimals of 38 digits hold the product."""
        return F.expr(f"if(v = 0, 1, 1 + (cast({count} + 2 as decimal(19,0)) * cast({SCALE} as decimal(10,0)))"
                      f" div cast({total} + 2 * v as decimal(19,0)))")
    groups = save(placed(every.join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
                         .na.fill(0, ["total", "terms", "v", "lang_n"]).withColumn("base", shared("0", "total"))), "groups")
    postings = save(held.join(groups, ["lang", "source"]).withColumn("p", shared("n", "total")).withColumn("q", shared("all_n", "lang_n"))
                    .select("lang", "source", "term", "p", "q", "block", "blocks", "buckets"), "postings")

    pairs = pair_values(groups, postings)
    value = F.expr("((p - q) * (p - q)) div (p + q)")
    terms = postings.filter("p > q").select("lang", "source", F.col("term").alias("item"), value.alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = F.row_number().over(order)
    out = (pairs.withColumn("rank", ranked).withColumn("part", F.lit("pair"))
           .unionByName(terms.withColumn("rank", ranked).filter(F.col("rank") <= top).withColumn("part", F.lit("term"))))
    done = save(out.select("lang", "source", "part", "item", "value", "rank"), "divergence")
    discard(counts, kept, held, groups, postings)
    return done
