"""Cleaning, filtering and simple projections."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def cast_numeric(df: DataFrame, cols: list[str], to: str = "double") -> DataFrame:
    """Lenient cast of ``cols`` in one projection; malformed text becomes null (never raises)."""
    wanted = set(cols)
    return df.select(*[F.col(c).try_cast(to).alias(c) if c in wanted else F.col(c) for c in df.columns])


def drop_incomplete(df: DataFrame, keys: list[str], cols: list[str], exclude: list[str] = ()) -> DataFrame:
    """P10: keep ``keys + cols`` minus ``exclude`` and drop rows holding any null."""
    keep = [c for c in list(keys) + list(cols) if c not in set(exclude)]
    return df.select(*keep).na.drop(how="any")


def filter_equals(df: DataFrame, col: str, value) -> DataFrame:
    """Equality filter (pushed down to the scan when ``col`` is a stored column)."""
    return df.filter(F.col(col) == F.lit(value))


def filter_in(df: DataFrame, col: str, values: list) -> DataFrame:
    """Set-membership filter."""
    return df.filter(F.col(col).isin(list(values)))


def label_balance(df: DataFrame, label: str, positive=1) -> DataFrame:
    """Positives, total and percent positive in one aggregation (one scan)."""
    pos = F.count_if(F.col(label) == F.lit(positive))
    total = F.count(F.lit(1))
    return df.agg(pos.alias("positives"), total.alias("total"),
                  (pos * 100.0 / total).alias("pct_positive"))


def with_rank(df: DataFrame, cols: list[str], out: str = "airport_rank") -> DataFrame:
    """Sum of score columns (null if any is null, as in plain addition)."""
    return df.withColumn(out, reduce(lambda a, b: a + b, [F.col(c) for c in cols]))


def enrich_self(df_sub: DataFrame, df_full: DataFrame, keys: list[str], drop_right: list[str] = ()) -> DataFrame:
    """Left join a (filtered) subset back to the full table on ``keys``.

    Right-side key columns merge into the left ones; ``drop_right`` columns are
    removed from the right side first. Duplicate keys fan out, exactly as a
    relational left join does; when the keys are unique the result equals a
    filter of ``df_full`` (prefer that: it needs no shuffle).
    """
    right = df_full.drop(*[c for c in drop_right if c not in keys])
    return df_sub.join(right, on=list(keys), how="left")
