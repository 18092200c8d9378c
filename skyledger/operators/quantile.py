"""Exact quantile cut points and quantile binning.

Cut points are exact (``percentile_disc``: the smallest value whose cumulative
share reaches p, nulls ignored), computed as scalar subqueries so the plan stays
lazy. Spark merges the subqueries over one input into a single aggregation.
By default a sketch brackets each cut and a second pass counts inside the
brackets, so no task holds all distinct values.
"""

from __future__ import annotations

from fractions import Fraction
from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _p_name(p: float) -> str:
    return "q" + format(round(p * 100, 6), "g").replace(".", "_")


def _disc(col: str, p: float) -> Column:
    return F.expr(f"percentile_disc({float(p)!r}) WITHIN GROUP (ORDER BY `{col}`)")


def quantile_cuts(df: DataFrame, col: str, probs: list[float], method: str = "bracket") -> DataFrame:
    """A5: one row, one column per probability (``q25`` for 0.25), exact discrete quantiles; nulls without values.

    All methods pick the value at position ceil(p * n), at least 1.
    ``bracket`` (default): lazy, two passes; a mergeable sketch brackets every cut, then rows below and
    values inside the brackets are counted. ``disc``: ``percentile_disc``, one pass, but its final merge holds
    one entry per distinct value in a single task. ``rank``: (value, count) with distributed
    prefix sums over all values, eager.
    """
    if method == "rank":
        return _ranked_cuts(df, col, probs)
    if method == "bracket":
        return _bracketed_cuts(df, col, probs)
    return df.agg(*[_disc(col, p).alias(_p_name(p)) for p in probs])


ACCURACY = 10_000    # the sketch's ranks are off by at most 1 / ACCURACY of the rows


def _bracketed_cuts(df: DataFrame, col: str, probs: list[float]) -> DataFrame:
    """Brackets reach three times the sketch's error to both sides, so each holds its cut; an error is raised if one doesn't."""
    x = F.col(col).cast("double")
    values = df.select(x.alias("__x")).filter("__x is not null")
    low, high = [p - 3 / ACCURACY for p in probs], [p + 3 / ACCURACY for p in probs]
    inner = [min(max(p, 0.0), 1.0) for p in (*low, *high)]
    sketch = values.agg(F.struct(F.percentile_approx("__x", inner, ACCURACY).alias("q"), F.count("__x").alias("n")).alias("s"))
    known = sketch.select("s").scalar()
    k = len(probs)
    # Brackets that reach the ends are open there.
    sides = [(F.lit(float("-inf")) if low[i] <= 0 else known["q"][i], F.lit(float("nan")) if high[i] >= 1 else known["q"][k + i])
             for i in range(k)]
    # Per cut: rows below its bracket under a null value, values inside as they are, nothing above.
    met = F.array(*[F.when(F.col("__x") <= hi, F.struct(F.lit(i).alias("i"), F.when(F.col("__x") >= lo, F.col("__x")).alias("x")))
                    for i, (lo, hi) in enumerate(sides)])
    counted = values.select(F.explode(F.array_compact(met)).alias("m")).groupBy("m.i", "m.x").agg(F.count(F.lit(1)).alias("c"))
    upto = F.sum("c").over(Window.partitionBy("i").orderBy(F.col("x").asc_nulls_first())
                           .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    parts = [Fraction(str(p)) for p in probs]
    n = known["n"].cast("decimal(38,0)")
    at = F.element_at(F.array(*[F.greatest(F.lit(1), F.ceil(n * f.numerator / f.denominator)).cast("long") for f in parts]), F.col("i") + 1)
    ranked = counted.withColumn("upto", upto).withColumn("at", at)
    hit = (F.col("upto") >= F.col("at")) & (F.col("upto") - F.col("c") < F.col("at"))
    found = F.when(hit, F.when(F.col("x").isNotNull(), F.col("x")).otherwise(F.raise_error(F.lit("a quantile lies outside its bracket"))))
    row = ranked.agg(*[F.max(F.when(F.col("i") == i, found)).alias(_p_name(p)) for i, p in enumerate(probs)],
                     F.count(F.when(hit, 1)).alias("hits"), F.count(F.lit(1)).alias("any"))
    whole = (F.col("any") == 0) | (F.col("hits") == k)
    return row.select(*[F.when(whole, F.col(_p_name(p))).otherwise(F.raise_error(F.lit("a quantile lies outside its bracket")))
                        .cast("double").alias(_p_name(p)) for p in probs])


def _ranked_cuts(df: DataFrame, col: str, probs: list[float]) -> DataFrame:
    from .ordering import prefix_sums

    # One row per distinct value, so a value that half the rows share is one row.
    values = df.filter(F.col(col).isNotNull()).groupBy(F.col(col).alias("__x")).agg(F.count(F.lit(1)).alias("__n"))
    ranked = prefix_sums(values, ["__x"], ["__n"])
    n = ranked.agg(F.sum("__n")).first()[0] or 0
    # Exact rational arithmetic: 0.7 * 10 must give position 7, not 8.
    positions = {p: max(1, ceil(Fraction(str(p)) * n)) for p in probs}
    before = F.col("__n_before")
    return ranked.agg(*[F.max(F.when((before < pos) & (before + F.col("__n") >= pos), F.col("__x")).cast("double"))
                        .alias(_p_name(p)) for p, pos in positions.items()])


def cut_scalars(df: DataFrame, col: str, probs: list[float], method: str = "bracket") -> list[Column]:
    """The cut points of ``quantile_cuts`` as scalar-subquery columns, in ``probs`` order."""
    cuts = quantile_cuts(df, col, probs, method)
    return [cuts.select(_p_name(p)).scalar() for p in probs]


_OPS = {
    ">=": lambda c, v: c >= v, ">": lambda c, v: c > v,
    "<=": lambda c, v: c <= v, "<": lambda c, v: c < v,
}


def bin_expr(col: str, rules: list[tuple[str, Column, str]], otherwise: str) -> Column:
    """A ``when`` chain: the first rule ``(op, cut, label)`` that holds gives the label."""
    expr = None
    for op, cut, label in rules:
        cond = _OPS[op](F.col(col), cut)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(otherwise)


def quantile_bin(df: DataFrame, col: str, out: str, probs: list[float], ops: list[str],
                 labels: list[str], otherwise: str, cut_source: DataFrame | None = None, method: str = "bracket") -> DataFrame:
    """Letter bins from exact quantiles of ``col`` (computed on ``cut_source`` or ``df``).

    ``probs``, ``ops`` and ``labels`` run in rule order. The five conventions used:

    * B1 ``probs=[.75,.5,.25] ops=['>=']*3 labels=ABC otherwise=D``
    * B2 ``probs=[.75,.5,.25] ops=['>']*3  labels=DCB otherwise=A``
    * B3 ``probs=[.75,.5,.25] ops=['>=']*3 labels=DCB otherwise=A``
    * B4 ``probs=[0,.25,.5,.75] ops=['<','<=','<=','<='] labels=ABCD otherwise=E``
    * B5 ``probs=[0,.25,.5,.75] ops=['<','<','<','<'] labels=ABCD otherwise=E``
    """
    source = cut_source if cut_source is not None else df
    cuts = cut_scalars(source, col, probs, method)
    return df.withColumn(out, bin_expr(col, list(zip(ops, cuts, labels)), otherwise))


# The binning conventions (probabilities, comparisons, labels, fallback).
R_QUARTILE = ([0.75, 0.5, 0.25], [">=", ">=", ">="], ["A", "B", "C"], "D")
F_QUARTILE = ([0.75, 0.5, 0.25], [">", ">", ">"], ["D", "C", "B"], "A")
M_QUARTILE = ([0.75, 0.5, 0.25], [">=", ">=", ">="], ["D", "C", "B"], "A")
AIRPORT_GROUPS = ([0.0, 0.25, 0.5, 0.75], ["<", "<=", "<=", "<="], ["A", "B", "C", "D"], "E")
CARRIER_GROUPS = ([0.0, 0.25, 0.5, 0.75], ["<", "<", "<", "<"], ["A", "B", "C", "D"], "E")
