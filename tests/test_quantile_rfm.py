import math

from pyspark.sql import functions as F

from skyledger.operators import groups, quantile, rfm


def _disc(values, p):
    s = sorted(values)
    return s[max(0, math.ceil(p * len(s)) - 1)]


def test_cuts_are_discrete_quantiles(spark):
    vals = [5, 1, 9, 3, 3, 7, 2, 8, 8, 10, 4]
    df = spark.createDataFrame([(float(v),) for v in vals], "x double")
    row = quantile.quantile_cuts(df, "x", [0.0, 0.25, 0.5, 0.75, 1.0]).head()
    assert [row[c] for c in ["q0", "q25", "q50", "q75", "q100"]] == [_disc(vals, p) for p in [0.0, .25, .5, .75, 1.0]]


def test_bin_conventions_at_boundaries(spark):
    vals = [1.0, 2.0, 3.0, 4.0]  # q0=1, q25=1, q50=2, q75=3
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    b1 = dict(quantile.quantile_bin(df, "v", "b", *quantile.R_QUARTILE).collect())
    b2 = dict(quantile.quantile_bin(df, "v", "b", *quantile.F_QUARTILE).collect())
    b4 = dict(quantile.quantile_bin(df, "v", "b", *quantile.AIRPORT_GROUPS).collect())
    b5 = dict(quantile.quantile_bin(df, "v", "b", *quantile.CARRIER_GROUPS).collect())
    assert b1 == {1.0: "C", 2.0: "B", 3.0: "A", 4.0: "A"}   # >= cut
    assert b2 == {1.0: "A", 2.0: "B", 3.0: "C", 4.0: "D"}   # > cut, reversed letters
    assert b4 == {1.0: "B", 2.0: "C", 3.0: "D", 4.0: "E"}   # [q0,q25] B, (q25,q50] C
    assert b5 == {1.0: "C", 2.0: "D", 3.0: "E", 4.0: "E"}   # [q25,q50) C ...


def test_rfm_groups_nulls_and_no_positive(spark):
    rows = [("a", 1, 1.0, 20.0, 5), ("a", 1, 0.0, -3.0, 1), ("a", 1, None, 7.0, 0),
            ("b", 1, 0.0, 1.0, 2),                     # never delayed -> dropped
            (None, 1, 1.0, 30.0, 0),                    # null key -> dropped
            ("c", 2, 1.0, 16.0, 9), ("c", 2, 1.0, 18.0, 4)]
    df = spark.createDataFrame(rows, "car string, fl int, y double, delay double, rec int")
    out = {(r["car"], r["fl"]): r for r in rfm.rfm_table(df, ["car", "fl"], "y", "delay", "rec").collect()}
    assert set(out) == {("a", 1), ("c", 2)}
    assert out[("a", 1)]["Recency"] == 5 and out[("a", 1)]["Monetary"] == 20.0
    assert out[("a", 1)]["Frequency"] == 0.5                  # null label ignored
    assert out[("c", 2)]["Recency"] == 4 and out[("c", 2)]["Monetary"] == 17.0


def test_label_balance_and_counts(spark):
    from skyledger.operators import clean
    df = spark.createDataFrame([(1,), (0,), (0,), (1,), (None,)], "y int")
    r = clean.label_balance(df, "y", 1).head()
    assert (r["positives"], r["total"]) == (2, 5) and abs(r["pct_positive"] - 40.0) < 1e-12
    assert {(x["y"], x["count"]) for x in groups.count_by(df, "y").collect()} == {(1, 2), (0, 2), (None, 1)}


def test_enrich_self_fans_out_on_duplicate_keys(spark):
    from skyledger.operators import clean
    sub = spark.createDataFrame([(1, 10.0), (2, 20.0)], "k int, x double")
    full = spark.createDataFrame([(1, "p"), (1, "q"), (3, "r")], "k int, extra string")
    out = clean.enrich_self(sub, full, ["k"])
    assert sorted((r["k"], r["extra"]) for r in out.collect()) == [(1, "p"), (1, "q"), (2, None)]


def test_ranked_cuts_equal_percentile_disc(spark):
    import random
    rnd = random.Random(5)
    probs = [0.0, 0.1, 0.25, 0.5, 0.7, 0.75, 0.9, 1.0]
    for n in [1, 2, 5, 6, 10, 11, 97]:
        vals = [float(rnd.randint(0, 30)) for _ in range(n)] + [None]
        df = spark.createDataFrame([(v,) for v in vals], "x double")
        disc = quantile.quantile_cuts(df, "x", probs, method="disc").head().asDict()
        assert quantile.quantile_cuts(df, "x", probs).head().asDict() == disc
        ranked = quantile.quantile_cuts(df, "x", probs, method="rank").head().asDict()
        want = {quantile._p_name(p): _disc([v for v in vals if v is not None], p) for p in probs}
        assert ranked == disc == want, (n, ranked, disc, want)


def test_bracketed_cuts_are_exact_on_many_rows(spark):
    """200,000 rows, far more than the sketch keeps: distinct values, ties at the cuts, one value on a third of the rows, nothing."""
    probs = [0.0, 0.25, 0.5, 0.75, 0.999, 1.0]
    rows = spark.range(0, 200_000, 1, 8)
    for x in (F.xxhash64("id").cast("double"), F.floor(F.rand(3) * 50).cast("double"), F.when(F.col("id") % 3 == 0, 7.5).otherwise(F.rand(4) * 20),
              F.lit(None).cast("double")):
        df = rows.select(x.alias("x")).persist()
        want = quantile.quantile_cuts(df, "x", probs, method="disc").head()
        assert quantile.quantile_cuts(df, "x", probs).head() == want
        df.unpersist()
