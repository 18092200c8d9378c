"""Recency / frequency / monetary scoring per group."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .quantile import F_QUARTILE, M_QUARTILE, R_QUARTILE, quantile_bin


def rfm_table(df: DataFrame, keys: list[str], label: str = "DEP_DEL15", delay: str = "DEP_DELAY",
              recency: str = "RecencyDays", positive=1.0) -> DataFrame:
    """One conditional aggregation per group (one shuffle, map-side partial aggregation).

    * ``Recency``  = min ``recency`` over positive rows
    * ``Monetary`` = mean ``delay`` over positive rows
    * ``Frequency`` = sum(label) / count(label) over all rows (null labels ignored)

    Only groups with at least one positive row and non-null keys are kept
    (the same rows an inner join of the positive-only and all-rows summaries keeps).
    A hot group costs one hash-aggregate entry, not one task: partial
    aggregation runs before the shuffle.
    """
    pos = F.col(label) == F.lit(positive)
    keyed = df.filter(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))
    agg = keyed.groupBy(*keys).agg(
        F.min(F.when(pos, F.col(recency))).alias("Recency"),
        F.avg(F.when(pos, F.col(delay))).alias("Monetary"),
        (F.sum(label) / F.count(label)).alias("Frequency"),
        F.count_if(pos).alias("__positives"),
    )
    return agg.filter(F.col("__positives") > 0).drop("__positives")


def rfm_quartiles(rfm: DataFrame, materialise: bool = False, method: str = "bracket") -> DataFrame:
    """R/F/M letters from exact quartiles of the RFM table itself.

    ``materialise`` writes the RFM table (one row per group) once, so the
    cut-point subqueries read it instead of re-aggregating the facts.
    """
    if materialise:
        from ..session import materialise as _write
        rfm = _write(rfm)
    out = quantile_bin(rfm, "Recency", "R_Quartile", *R_QUARTILE, method=method)
    out = quantile_bin(out, "Frequency", "F_Quartile", *F_QUARTILE, cut_source=rfm, method=method)
    return quantile_bin(out, "Monetary", "M_Quartile", *M_QUARTILE, cut_source=rfm, method=method)


def attach_rfm(df: DataFrame, rfm: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join facts to the RFM table; ``inner`` drops groups never positive.

    The RFM table has one row per group, so the join never fans out. Spark
    (AQE) broadcasts it at runtime when its measured size is small, else
    sort-merge joins on the keys.
    """
    return df.join(rfm, on=list(keys), how=how)
