"""Capped fits share one run, areas come from scores dealt as bytes, columns of 0 and 1 take a bit."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyledger.operators import logistic, metrics
from skyledger.plans import tuning


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(8)
    x = np.c_[rng.normal(size=(2400, 3)), rng.integers(0, 2, (2400, 12))]
    y = rng.uniform(size=2400) < 1 / (1 + np.exp(-(x[:, 0] * 2 - x[:, 1] + x[:, 4] - 0.5)))
    return spark.createDataFrame([(i, x[i].tolist(), float(y[i]), i % 3) for i in range(2400)],
                                 "id long, features array<double>, label double, fold int").repartition(3).persist()


def test_caps_are_passed_in_one_run(data, monkeypatch):
    blocks, settings, trains = logistic.pack(data, "features", "label", "fold"), [(0.0, 0.0), (0.0, 1.0), (0.01, 0.5)], [[0, 1], [2]]
    moments = logistic.moments_of(blocks, 3)
    models, whole = [], logistic._summed
    monkeypatch.setattr(logistic, "_summed", lambda b, part, size: models.append(size // 16) or whole(b, part, size))
    found = logistic.fit_capped(blocks, settings, [2, 4, 300], trains, moments=moments)
    assert len(models) == found[300].iterations.max() and models[0] == 4       # two settings without a penalty are one
    for cap in (2, 4, 300):
        alone = logistic.fit_many(blocks, settings, trains, cap, moments=moments)
        assert np.allclose(found[cap].coefficients, alone.coefficients, atol=1e-7) and (found[cap].iterations == alone.iterations).all()
        assert (found[cap].converged == alone.converged).all()


def test_grid_of_caps_takes_the_longest_run(data, monkeypatch):
    blocks = logistic.pack(data, "features", "label", "fold")
    passes, whole = [], logistic._summed
    monkeypatch.setattr(logistic, "_summed", lambda *a: passes.append(1) or whole(*a))
    _best, _score, table = tuning.logistic_cv(blocks, {"maxIter": [1, 2, 3, 4], "regParam": [0.0, 0.01], "elasticNetParam": [0.0]}, [[0], [1]], [[1], [2]])
    assert len(passes) == 1 + 4 and {(r.maxIter, r.iterations) for r in table.collect()} == {(k, k) for k in (1.0, 2.0, 3.0, 4.0)}


@pytest.mark.parametrize("bucket", [40, 1 << 18])
def test_areas_equal_the_rank_sum(data, monkeypatch, bucket):
    monkeypatch.setattr(logistic, "BUCKET", bucket)
    monkeypatch.setattr(logistic, "RANKED", 500)
    odd = data.unionByName(data.select("id", "features", F.lit(1.0).alias("label"), F.lit(3).alias("fold")).limit(50))
    blocks, tests = logistic.pack(odd, "features", "label", "fold"), [[0, 2], [1], [3], [7]]
    w = np.random.default_rng(2).normal(size=(4, 3, 16))
    w[:, 1, :3] = 0                                   # many equal scores
    w[:, 2] = 0                                       # all scores equal
    w = np.round(w, 2)
    got = logistic.aucs(blocks, w, tests)
    want = {(r.fold, r.setting): r.auc for r in metrics.auc_by(logistic.margins(blocks, w, tests), ["fold", "setting"], "score").collect()}
    assert np.isnan(got[2:]).all() and want[2, 0] is None and (3, 0) not in want
    assert all(abs(got[f, s] - want[f, s]) < 1e-12 for f in (0, 1) for s in range(3)) and got[0, 2] == 0.5


def test_columns_of_0_and_1_take_a_bit(spark, data):
    blocks = logistic.pack(data, "features", "label", "fold")
    assert blocks.agg(F.sum(F.octet_length("x"))).head()[0] == 2400 * (3 * 8 + 2)
    seen = np.concatenate([x for _, x, _ in logistic._unpacked(blocks.toArrow().to_batches())])
    want = np.array([r.features for r in data.collect()])
    assert np.array_equal(seen[np.lexsort(seen.T)], want[np.lexsort(want.T)])
    x = np.array([[1.0, 0.0, -0.0, 0.5, np.nan], [0.0, 0.0, 1.0, 1.0, 1.0]])
    kinds, raw = logistic._packed(x)
    assert kinds.tolist() == [1, 1, 0, 0, 0] and logistic._rows_of(raw, kinds).tobytes() == x.tobytes()
    for only in (np.ones((4, 9)), np.full((4, 2), 0.3)):
        kinds, raw = logistic._packed(only)
        assert np.array_equal(logistic._rows_of(raw, kinds), only)
