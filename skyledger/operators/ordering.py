"""Global ordering without a single-partition window (W3, T3, prefix sums for E1).

``row_number() over (order by ...)`` with no partition key pulls every row into
one task. Instead the rows are range-partitioned on the order columns (Spark
samples the keys to pick balanced boundaries, so even one date holding a third
of all rows is split across tasks), sorted inside each partition, and numbered
with ``monotonically_increasing_id`` (partition index in the high bits,
position in the low 33 bits). A tiny per-partition count table (one row per
partition) gives each partition its starting offset; it is broadcast. Both uses
of the range-partitioned rows come from one shuffle, which Spark reuses.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise

_POS_BITS = 33


def _range(df: DataFrame, order: list[Column], n: int | None) -> DataFrame:
    """Range-partition on ``order``; without ``n`` AQE picks (and coalesces) the partition count."""
    return df.repartitionByRange(n, *order) if n else df.repartitionByRange(*order)


def _order(cols: list[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def _tagged(df: DataFrame, order: list[Column], num_partitions: int | None) -> DataFrame:
    """Range-partition, sort, tag rows with (partition, position) and materialise.

    The tags must be identical for every consumer (the per-partition totals
    and the rows themselves). A range shuffle samples its boundaries per
    execution and AQE may coalesce its partitions differently per consumer,
    so the tagged rows are written once to the shared checkpoint folder.
    """
    ranged = (_range(df, order, num_partitions)
              .sortWithinPartitions(*order)
              .withColumn("__mid", F.monotonically_increasing_id()))
    ranged = materialise(ranged)
    return ranged.withColumn("__pid", F.shiftright("__mid", _POS_BITS)) \
                 .withColumn("__pos", F.col("__mid").bitwiseAND((1 << _POS_BITS) - 1)).drop("__mid")


def _offsets(tagged: DataFrame, value_cols: dict[str, Column], by: list[str] = ()) -> DataFrame:
    """One row per partition (and group): sums of the values over all earlier partitions (broadcast-sized)."""
    totals = tagged.groupBy("__pid", *by).agg(*[F.sum(expr).alias(f"__t_{name}") for name, expr in value_cols.items()])
    before = Window.partitionBy(*by).orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("__pid", *by, *[F.coalesce(F.sum(f"__t_{name}").over(before), F.lit(0)).alias(f"__o_{name}")
                                    for name in value_cols])


def with_global_row_id(df: DataFrame, order_cols: list[str | Column], out: str = "row_id",
                       num_partitions: int | None = None) -> DataFrame:
    """1-based position of each row in the global order of ``order_cols``.

    Give enough ``order_cols`` to make the order total (Q12); ties otherwise get
    distinct but arbitrary numbers.
    """
    tagged = _tagged(df, _order(order_cols), num_partitions)
    offsets = _offsets(tagged, {"n": F.lit(1)})
    out_df = tagged.join(F.broadcast(offsets), "__pid")
    return out_df.withColumn(out, F.col("__o_n") + F.col("__pos") + 1).drop("__pid", "__pos", "__o_n")


def prefix_sums(df: DataFrame, order_cols: list[str | Column], value_cols: list[str],
                suffix: str = "_before", num_partitions: int | None = None, by: list[str] = ()) -> DataFrame:
    """For each row, the sums of ``value_cols`` over all rows strictly before it in the global order.

    With ``by``, sums restart in every group: one ordering by group and
    ``order_cols`` serves all groups, a large group spans many tasks, and the
    offsets are one row per partition and group that meet (partitions plus
    groups at most).
    """
    by = list(by)
    tagged = _tagged(df, _order([*by, *order_cols]), num_partitions)
    offsets = _offsets(tagged, {v: F.col(v) for v in value_cols}, by)
    within = Window.partitionBy("__pid", *by).orderBy("__pos").rowsBetween(Window.unboundedPreceding, -1)
    out = tagged.join(F.broadcast(offsets), ["__pid", *by])
    for v in value_cols:
        out = out.withColumn(v + suffix, F.col(f"__o_{v}") + F.coalesce(F.sum(v).over(within), F.lit(0)))
    return out.drop("__pid", "__pos", *[f"__o_{v}" for v in value_cols])


def time_chunks(df: DataFrame, order_cols: list[str | Column], chunks: int, out: str = "chunk",
                row_id: str = "row_id") -> DataFrame:
    """Rows in time order cut into ``chunks`` equal chunks of ``floor(n / chunks)`` (numbered from 0); the rest is left out."""
    numbered = with_global_row_id(df, order_cols, out=row_id)
    n = df.select(F.count(F.lit(1))).scalar()
    size = F.floor(n / F.lit(chunks))
    return numbered.withColumn("__size", size).filter(F.col("__size") > 0) \
        .withColumn(out, F.ceil(F.col(row_id) / F.col("__size")).cast("int") - 1).drop("__size").filter(F.col(out) < chunks)


def time_series_folds(df: DataFrame, order_cols: list[str | Column], k: int = 3,
                      row_id: str = "row_id") -> DataFrame:
    """Blocked folds. Rows numbered in time order are cut into chunks of
    ``floor(n / (k + 1))``; fold i trains on chunk i and tests on chunk i + 1
    (one block each, not expanding). Rows past the last full chunk are unused.

    Returns one row per (input row, fold, role): a chunk is the test block of
    one fold and the train block of the next.
    """
    numbered = with_global_row_id(df, order_cols, out=row_id)
    n = df.select(F.count(F.lit(1))).scalar()
    numbered = numbered.withColumn("__chunk", F.floor(n / F.lit(k + 1)))
    numbered = numbered.filter(F.col("__chunk") > 0) \
        .withColumn("__idx", F.ceil(F.col(row_id) / F.col("__chunk")).cast("int"))  # 1-based chunk index
    idx = F.col("__idx")
    roles = F.array(
        F.struct((idx - 1).alias("fold"), F.lit("train").alias("role")),
        F.struct((idx - 2).alias("fold"), F.lit("test").alias("role")),
    )
    out = numbered.withColumn("__r", F.explode(F.filter(roles, lambda r: (r["fold"] >= 0) & (r["fold"] < k))))
    return out.select("*", F.col("__r.fold").alias("fold"), F.col("__r.role").alias("role")) \
        .drop("__r", "__chunk", "__idx")
