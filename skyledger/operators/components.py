"""Principal components that can be checked: mergeable covariance sums, a small eigen-solve, fixed signs."""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations_with_replacement

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SUMS = "feature_a string, feature_b string, n long, mean_a double, mean_b double, s double"


def covariance_sums(df: DataFrame, cols: list[str]) -> DataFrame:
    """Per pair of columns (and each with itself) ``feature_a, feature_b, n, mean_a, mean_b, s``; s: sum of centred products.

    Rows with a null in any column are left out; two passes of plain sums
    (means first), combined before they are shuffled. Without rows: n and s are 0, means null.
    """
    data = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).na.drop(how="any")
    means = data.agg(F.struct(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)]).alias("means")).scalar()
    centred = data.select(means.alias("__m"), *cols).select(*[(F.col(c) - F.col(f"__m.m{i}")).alias(c) for i, c in enumerate(cols)])
    pairs = list(combinations_with_replacement(range(len(cols)), 2))
    wide = centred.agg(F.count(F.lit(1)).alias("n"), *[F.coalesce(F.sum(F.col(cols[i]) * F.col(cols[j])), F.lit(0.0)).alias(f"s{i}_{j}")
                                                       for i, j in pairs]).withColumn("__m", means)
    rows = [F.struct(F.lit(cols[i]).alias("feature_a"), F.lit(cols[j]).alias("feature_b"), F.col("n"), F.col(f"__m.m{i}").alias("mean_a"),
                     F.col(f"__m.m{j}").alias("mean_b"), F.col(f"s{i}_{j}").alias("s")) for i, j in pairs]
    return wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def merge_sums(old: DataFrame, new: DataFrame) -> DataFrame:
    """The sums of both tables' rows together, without reading those again."""
    key = ["feature_a", "feature_b"]
    o, w = (t.select(*key, *[F.col(c).alias(f"{c}_{i}") for c in ("n", "mean_a", "mean_b", "s")]) for i, t in enumerate((old, new)))
    n = F.col("n_0") + F.col("n_1")

    def mean(c):
        return F.try_divide(F.coalesce(F.col(f"{c}_0") * F.col("n_0"), F.lit(0.0)) + F.coalesce(F.col(f"{c}_1") * F.col("n_1"), F.lit(0.0)), n)
    apart = (F.col("mean_a_0") - F.col("mean_a_1")) * (F.col("mean_b_0") - F.col("mean_b_1")) * F.try_divide(F.col("n_0") * F.col("n_1"), n)
    return o.join(w, key).select(*key, n.alias("n"), mean("mean_a").alias("mean_a"), mean("mean_b").alias("mean_b"),
                                 (F.col("s_0") + F.col("s_1") + F.coalesce(apart, F.lit(0.0))).alias("s"))


def covariance(sums: DataFrame) -> DataFrame:
    """``feature_a, feature_b, n, covariance`` (of a sample; null below two rows)."""
    return sums.select("feature_a", "feature_b", "n", F.try_divide("s", F.col("n") - 1).alias("covariance"))


@dataclass
class Components:
    """``loadings[column, component]`` of unscaled columns' values divided by ``scale``; ``ratios``: explained variance."""

    cols: list[str]
    scale: np.ndarray
    loadings: np.ndarray
    ratios: np.ndarray

    @classmethod
    def fit(cls, sums: DataFrame, cols: list[str], k: int | None = None, scaled: bool = True) -> Components:
        """Eigenvectors of the covariance of ``cols`` (divided by their deviation if ``scaled``; columns that are
        constant but for rounding noise are 0).

        The driver solves a matrix of columns x columns. A component's largest loading (the first of equals) is positive.
        """
        at, m = {c: i for i, c in enumerate(cols)}, np.zeros((len(cols), len(cols)))
        size = np.zeros(len(cols))
        for r in sums.collect():  # columns x columns
            a, b = at[r["feature_a"]], at[r["feature_b"]]
            m[a, b] = m[b, a] = r["s"] / (r["n"] - 1) if r["n"] > 1 else 0.0
            size[a] = 1 + abs(r["mean_a"] or 0.0)
        dev = np.sqrt(np.diag(m))
        varies = dev > 1e-10 * size
        factor = np.divide(1.0, dev if scaled else 1.0, out=np.zeros(len(cols)), where=varies)
        values, vectors = np.linalg.eigh(m * np.outer(factor, factor))
        values, vectors = np.maximum(values[::-1], 0.0), vectors[:, ::-1]
        lead = np.argmax(np.abs(np.round(vectors, 12)), axis=0)
        vectors = vectors * np.where(vectors[lead, np.arange(len(cols))] < 0, -1.0, 1.0)
        total = values.sum()
        k = len(cols) if k is None else k
        return cls(list(cols), factor, vectors[:, :k], (values / total if total else values)[:k])

    def project(self, df: DataFrame, prefix: str = "pc_") -> DataFrame:
        """``df`` with a column per component: a plain expression of the columns, not centred (as MLlib's)."""
        weights = self.loadings * self.scale[:, None]
        out = [sum((F.col(c) * F.lit(float(w)) for c, w in zip(self.cols, weights[:, j], strict=True)), F.lit(0.0)).alias(f"{prefix}{j}")
               for j in range(weights.shape[1])]
        return df.select("*", *out)
