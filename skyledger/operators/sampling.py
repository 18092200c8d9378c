"""Splits and class re-balancing.

Re-balancing computes class counts once (one small grouped count) and then
replicates or samples every row in a single pass; no per-class filter/union
loop and nothing collected to the driver.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.hashing import draw_md5, uniform_md5
from ..session import materialise


def union_all(dfs: list[DataFrame]) -> DataFrame:
    """Union by column name."""
    return reduce(lambda a, b: a.unionByName(b), dfs)


def shuffle_rows(df: DataFrame, seed: int | None = None) -> DataFrame:
    """O1: random global order (a full sort; only when a consumer needs it)."""
    return df.orderBy(F.rand(seed))


def random_split(df: DataFrame, weights: list[float], seed: int, key: list[str] | None = None) -> list[DataFrame]:
    """Split by weights. With ``key``, membership is an md5 of seed and key:
    repeatable on any partitioning and across re-runs; without it, ``randomSplit``.
    """
    if not key:
        return df.randomSplit(weights, seed)
    labelled = with_random_split(df, weights, seed, key, out="__split")
    return [labelled.filter(F.col("__split") == i).drop("__split") for i in range(len(weights))]


def with_random_split(df: DataFrame, weights: list[float], seed: int, key: list[str], out: str = "split",
                      names: list | None = None) -> DataFrame:
    total = float(sum(weights))
    u = uniform_md5(seed, *key)
    names = names if names is not None else list(range(len(weights)))
    bounds, acc = [], 0.0
    for w in weights[:-1]:
        acc += w / total
        bounds.append(acc)
    expr = None
    for b, name in zip(bounds, names):
        expr = F.when(u < b, F.lit(name)) if expr is None else expr.when(u < b, F.lit(name))
    expr = F.lit(names[-1]) if expr is None else expr.otherwise(F.lit(names[-1]))
    return df.withColumn(out, expr)


def time_split(df: DataFrame, col: str, train_values: list, test_values: list) -> tuple[DataFrame, DataFrame]:
    """R2: train / test by membership of ``col`` (e.g. years); both filters push down to the scan."""
    return df.filter(F.col(col).isin(list(train_values))), df.filter(F.col(col).isin(list(test_values)))


def _class_plan(df: DataFrame, label: str, group: list[str]) -> DataFrame:
    """Rows per (group, class) with the group's largest and smallest class count, written once.

    The table has one row per (group, class). Writing it gives the planner its
    true size: it is broadcast when small (the usual case: a few classes), so
    the fact rows are never shuffled on the label, which has only a handful
    of values and would put whole classes into single tasks; beyond the
    broadcast threshold a sort-merge join with AQE skew splitting is used.
    """
    counts = df.groupBy(*group, label).agg(F.count(F.lit(1)).alias("__n"))
    if group:
        stats = counts.groupBy(*group).agg(F.max("__n").alias("__max"), F.min("__n").alias("__min"))
        plan = counts.join(stats, on=group)
    else:
        stats = counts.agg(F.max("__n").alias("__max"), F.min("__n").alias("__min"))
        plan = counts.select("*", stats.select("__max").scalar().alias("__max"),
                             stats.select("__min").scalar().alias("__min"))
    return materialise(plan)


def upsample(df: DataFrame, label: str, group: list[str] = ()) -> DataFrame:
    """R3 (and R5 with ``group``): replicate every non-majority class ``floor(max/min)`` times.

    The majority class (the largest count; all classes tied at the maximum)
    is untouched. One ratio applies to all minority classes of a group, as in
    the reference pipeline. Replication is an ``explode`` over a short
    sequence, fused into the scan stage.
    """
    group = list(group)
    plan = _class_plan(df, label, group)
    reps = plan.select(*group, label,
                       F.when(F.col("__n") == F.col("__max"), F.lit(1))
                       .otherwise(F.floor(F.col("__max") / F.col("__min")).cast("int")).alias("__rep"))
    joined = df.join(reps, on=group + [label], how="inner")
    return joined.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__rep")))).drop("__rep", "__copy")


#: Leading bits of the draw that a round of :func:`sample_exact` knows, and rows that one task may rank.
DRAW_BITS, RANKED_ROWS = (12, 24, 32), 100_000


def sample_exact(df: DataFrame, sizes: DataFrame, by: list[str], seed: int, key: list[str], size: str = "__k",
                 ranked_rows: int = RANKED_ROWS) -> DataFrame:
    """R4 of exact size, without replacement: per group ``by`` the ``size`` rows of the smallest md5 draws.

    A round counts rows by leading bits of the draw and finds the bin in which
    the last row to take lies; it is refined until no group has more than
    ``ranked_rows`` rows there. Rows below that bin are taken as they are read,
    only its own rows are ranked (by draw, then ``key``). ``sizes`` has one row per
    group (of few groups); groups that it lacks, null groups and sizes below 1
    give no rows, sizes above a group's all of it. ``key`` names a row; rows that
    share it are taken in any order.
    """
    names = df.columns
    drawn = df.withColumn("__draw", draw_md5(seed, *key))
    last = sizes.filter(F.col(size) > 0).select(*by, F.col(size).cast("long").alias("__need"), F.lit(0).cast("long").alias("__bin"))
    known = 0
    for bits in DRAW_BITS:
        rows = drawn.select(*by, "__draw").join(last, by).filter(F.shiftright("__draw", 32 - known) == F.col("__bin"))
        bins = rows.groupBy(*by, "__need", F.shiftright("__draw", 32 - bits).alias("__next")).agg(F.count(F.lit(1)).alias("__n"))
        upto = F.sum("__n").over(Window.partitionBy(*by).orderBy("__next"))   # at most 4096 bins of a group
        total = F.sum("__n").over(Window.partitionBy(*by))
        found = bins.select(*by, "__n", "__next", (upto - F.col("__n")).alias("__before"), upto.alias("__upto"),
                            F.least("__need", total).alias("__need"))
        last = materialise(found.filter((F.col("__before") < F.col("__need")) & (F.col("__need") <= F.col("__upto")))
                           .select(*by, (F.col("__need") - F.col("__before")).alias("__need"), F.col("__next").alias("__bin"), "__n"))
        known = bits
        if (last.agg(F.max("__n")).head()[0] or 0) <= ranked_rows:
            break
        last = last.drop("__n")
    placed = drawn.join(last.select(*by, "__need", "__bin"), by)
    own = F.shiftright("__draw", 32 - known)
    sure = placed.filter(own < F.col("__bin"))
    rank = F.row_number().over(Window.partitionBy(*by).orderBy("__draw", *key))
    edge = placed.filter(own == F.col("__bin")).withColumn("__rank", rank).filter("__rank <= __need")
    return sure.select(*names).unionByName(edge.select(*names))


def downsample(df: DataFrame, label: str, seed: int, key: list[str], group: list[str] = (),
               fraction: float | None = None, exact: bool = False) -> DataFrame:
    """Keep the minority class whole; keep each other row with probability
    ``min / class_count`` (or ``fraction``), drawn from an md5 of seed and key.

    ``exact``: keep exactly ``min`` rows of each other class (or its count
    times ``fraction``, halves rounded up) instead, see :func:`sample_exact`.
    """
    group = list(group)
    plan = _class_plan(df, label, group)
    if exact:
        kept = F.col("__min") if fraction is None else F.floor(F.col("__n") * F.lit(float(fraction)) + 0.5)
        sizes = plan.select(*group, label, F.when(F.col("__n") == F.col("__min"), F.col("__n")).otherwise(kept).alias("__k"))
        return sample_exact(df, sizes, [*group, label], seed, key)
    keep = (F.lit(float(fraction)) if fraction is not None else F.col("__min") / F.col("__n"))
    probs = plan.select(*group, label, F.when(F.col("__n") == F.col("__min"), F.lit(1.0)).otherwise(keep).alias("__p"))
    joined = df.join(probs, on=group + [label], how="inner")
    return joined.filter((F.col("__p") >= 1.0) | (uniform_md5(seed, *key) < F.col("__p"))).drop("__p")


def rebalance_by(df: DataFrame, group: list[str], label: str, method: str = "upsample",
                 seed: int = 541, key: list[str] | None = None, **smote_options) -> DataFrame:
    """Re-balance inside each group (e.g. year) in one pass.

    ``smote`` needs one id column in ``key`` and ``vec_col``, ``minority`` (and
    optionally ``k``, ``multiplier``, ``exact``) among the options; neighbours
    are searched within the group only.
    """
    if method == "upsample":
        return upsample(df, label, group)
    if method in ("downsample", "downsample_exact"):
        return downsample(df, label, seed, key or [], group, exact=method == "downsample_exact")
    if method == "smote":
        from .neighbours import smote
        return smote(df, key[0], label=label, seed=seed, group=group, **smote_options)
    raise ValueError(f"unknown method {method!r}")
