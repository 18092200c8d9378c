"""Batched logistic fits against MLlib's, grouped AUC against the rank sum, Parzen search against random search."""

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from skyledger.operators import logistic, metrics, ordering
from skyledger.plans import parzen, tuning


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(3)
    n = 3000
    x = rng.normal(size=(n, 6)) * [1, 5, 0.1, 1, 1, 1] + [0, 30, 0, 0, 0, 0]
    x[:, 3] = (x[:, 3] > 1).astype(float)
    x[:, 4] = 1.0                               # constant
    x[:, 5] = x[:, 0] + 0.01 * x[:, 5]           # nearly the same as the first
    z = 0.8 * x[:, 0] - 0.15 * (x[:, 1] - 30) + 4 * x[:, 2] + 1.2 * x[:, 3] - 1.3
    y = (rng.uniform(size=n) < 1 / (1 + np.exp(-z))).astype(float)
    rows = [(i, [float(v) for v in x[i]], float(y[i])) for i in range(n)]
    df = spark.createDataFrame(rows, "id long, values array<double>, label double").withColumn("features", array_to_vector("values"))
    return df.repartition(5).persist()


SETTINGS = [(0.0, 0.0), (0.01, 0.0), (0.01, 0.5), (0.1, 1.0), (0.3, 0.25), (50.0, 1.0)]


def test_coefficients_are_mllibs(spark, data):
    fits = logistic.fit_many(logistic.pack(data, "features", "label"), SETTINGS, max_iter=2000, tol=1e-9)
    for k, (reg, net) in enumerate(SETTINGS):
        if (reg, net) == (0.0, 0.0):
            continue                              # two features that are nearly the same: compared by AUC below
        m = LogisticRegression(regParam=reg, elasticNetParam=net, maxIter=1000, tol=1e-10).fit(data)
        want = np.r_[m.coefficients.toArray(), m.intercept]
        assert np.abs(fits.coefficients[0, k] - want).max() < 2e-3 * (1 + np.abs(want).max()), (reg, net)


def test_cross_validation_equals_separate_fits(spark, data):
    space = {"maxIter": [100, 200], "regParam": [0.0, 0.05], "elasticNetParam": [0.0, 0.5, 1.0]}
    best, score, table = tuning.logistic_time_series_cv(data, "features", "label", space, ["id"], k=3)
    got = {(r.maxIter, r.regParam, r.elasticNetParam): r.mean_auc for r in table.collect()}
    assert len(got) == 12 and max(got.values()) == score
    _b, _s, other = tuning.time_series_cv(LogisticRegression(featuresCol="features", labelCol="label"),
                                          {"maxIter": [200], "regParam": [0.0, 0.05], "elasticNetParam": [0.0, 0.5]}, data, "label", ["id"])
    for r in other.collect():
        assert abs(got[200.0, r.regParam, r.elasticNetParam] - r.mean_auc) < 1e-4


def test_iteration_caps_cut_off(spark, data):
    blocks = logistic.pack(data, "features", "label")
    _best, _score, table = tuning.logistic_cv(blocks, {"maxIter": [1, 50], "regParam": [0.0], "elasticNetParam": [0.0]}, [[0]], [[0]])
    one, many = table.orderBy("maxIter").collect()
    assert one.iterations == 1 and many.iterations > 1 and one.mean_auc != many.mean_auc


def test_grid_search_scores_the_winner(spark, data):
    best, table = tuning.logistic_grid_search(data, data, "features", "label", {"regParam": [0.0, 5.0], "elasticNetParam": [1.0]}, ["id"])
    rows = table.collect()
    assert best["regParam"] == 0.0 and sum(r.winner_test_auc is not None for r in rows) == 1
    m = LogisticRegression(regParam=0.0, maxIter=200).fit(data)
    assert abs(next(r.winner_test_auc for r in rows if r.winner_test_auc) - m.evaluate(data).areaUnderROC) < 1e-3


def test_no_rows(spark, data):
    with pytest.raises(ValueError):
        logistic.fit_many(logistic.pack(data.limit(0), "features", "label"), [(0.0, 0.0)])


def test_auc_by_equals_one_by_one(spark, data):
    scored = data.select("label", F.round(F.col("values")[0], 1).alias("score"), (F.col("id") % 4).alias("g"))
    scored = scored.unionByName(spark.createDataFrame([(1.0, 0.5, 9)], "label double, score double, g long"))
    got = {r.g: r.auc for r in metrics.auc_by(scored, ["g"], "score").collect()}
    assert got.pop(9) is None
    for g, auc in got.items():
        assert abs(auc - metrics.auc_rank(scored.filter(F.col("g") == g), "score").head()[0]) < 1e-12


def test_prefix_sums_restart_by_group(spark):
    rows = [(g, v, float(v)) for g in range(3) for v in range(50)]
    df = spark.createDataFrame(rows, "g int, v int, x double").repartition(7)
    got = ordering.prefix_sums(df, ["v"], ["x"], num_partitions=4, by=["g"]).collect()
    assert len(got) == 150 and all(r.x_before == r.v * (r.v - 1) / 2 for r in got)


def test_time_chunks(spark, data):
    got = {r.chunk: (r.n, r.lo, r.hi) for r in ordering.time_chunks(data, ["id"], 4).groupBy("chunk").agg(
        F.count("*").alias("n"), F.min("id").alias("lo"), F.max("id").alias("hi")).collect()}
    assert got == {c: (750, 750 * c, 750 * c + 749) for c in range(4)}


SPACE = {"a": ("loguniform", -5.0, 2.0), "b": ("uniform", 0.0, 1.0)}


def surface(t):
    return -abs(np.log(t["a"]) - 1) - abs(t["b"] - 0.8)


def bumps(t):
    return np.exp(-2 * (np.log(t["a"]) + 1) ** 2) + 0.3 * np.sin(6 * t["b"])


@pytest.mark.parametrize("score", [surface, bumps])
def test_parzen_search_beats_random_search(score):
    gains = []
    for seed in range(20):
        tried = parzen.parzen_search(SPACE, lambda ts: [score(t) for t in ts], n=40, patience=40, seed=seed, batch=5)
        assert len(tried) == 40
        gains.append(max(s for _, s in tried) - max(score(t) for t in tuning.draw_trials(SPACE, 40, 1000 + seed)))
    assert np.median(gains) > 0 and np.mean(np.array(gains) > 0) >= 0.6


def test_parzen_search_stops_and_stays_inside():
    assert len(parzen.parzen_search(SPACE, lambda ts: [0.0 for _ in ts], n=40, patience=5, seed=1)) == 6
    tried = parzen.parzen_search(SPACE, lambda ts: [surface(t) for t in ts], n=60, patience=60, seed=1)
    assert all(np.exp(-5) <= t["a"] <= np.exp(2) and 0 <= t["b"] <= 1 for t, _ in tried)
    again = parzen.parzen_search(SPACE, lambda ts: [surface(t) for t in ts], n=60, patience=60, seed=1)
    assert tried == again
