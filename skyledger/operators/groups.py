"""Volume counts, volume groups and group attachment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .quantile import AIRPORT_GROUPS, CARRIER_GROUPS, quantile_bin


def count_by(df: DataFrame, *cols: str, out: str = "count") -> DataFrame:
    """Rows per value (partial counts before the shuffle)."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias(out))


def volume_groups(df: DataFrame, key: str, out: str, scheme=AIRPORT_GROUPS, materialise: bool = False,
                  method: str = "bracket") -> DataFrame:
    """Rows per ``key`` and a letter from exact quantiles of those counts.

    ``materialise`` writes the count table (one row per key) once, so the
    cut-point subqueries and the binning read it instead of re-counting.
    """
    counts = count_by(df, key)
    if materialise:
        from ..session import materialise as _write
        counts = _write(counts)
    return quantile_bin(counts, "count", out, *scheme, method=method)


def airport_groups(df: DataFrame, key: str = "origin_iata_code", materialise: bool = False) -> DataFrame:
    return volume_groups(df, key, "airport_groups", AIRPORT_GROUPS, materialise)


def carrier_groups(df: DataFrame, key: str = "OP_UNIQUE_CARRIER", materialise: bool = False) -> DataFrame:
    return volume_groups(df, key, "carrier_groups", CARRIER_GROUPS, materialise)


def attach_groups(df: DataFrame, groups: DataFrame, key: str, drop: tuple[str, ...] = ("count",)) -> DataFrame:
    """Left join a one-row-per-key label table (never fans out)."""
    return df.join(groups.drop(*drop), on=[key], how="left")
