"""Perceptrons fitted in blocks against MLlib's own fit and finite differences."""

import numpy as np
import pytest
from pyspark.ml.classification import MultilayerPerceptronClassificationModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from skyledger.operators import perceptron
from skyledger.plans import models


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(1024, 5))
    y = (x[:, 0] * x[:, 1] + 0.7 * x[:, 2] + 0.3 * rng.normal(size=1024) > 0.2).astype(float)
    df = spark.createDataFrame([(i, x[i].tolist(), float(y[i])) for i in range(1024)], "id long, v array<double>, label double")
    return df.select("id", array_to_vector("v").alias("features"), "label").coalesce(1).persist()


def test_gradient_equals_differences():
    rng = np.random.default_rng(1)
    sizes = [3, 4, 5, 2]
    w = rng.normal(size=3 * 4 + 4 + 4 * 5 + 5 + 5 * 2 + 2)
    x, y = rng.normal(size=(7, 3)), rng.integers(0, 2, 7).astype(float)
    found = perceptron.loss_and_gradient(w, sizes, x, y)
    for k in range(len(w)):
        h = np.eye(len(w))[k] * 1e-6
        want = (perceptron.loss_and_gradient(w + h, sizes, x, y)[1] - perceptron.loss_and_gradient(w - h, sizes, x, y)[1]) / 2e-6
        assert found[2 + k] == pytest.approx(want, abs=1e-6)


@pytest.mark.parametrize("hidden, steps", [([6], 25), ([8, 5], 15)])
def test_equals_mllib(rows, hidden, steps):
    """One partition of whole blocks, where MLlib's mean of blocks is the mean of rows: the same steps, so the same weights."""
    est = models.classifier("mlp", "features", "label", n_features=5, maxIter=steps).setLayers([5, *hidden, 2])
    want, got = est.fit(rows), perceptron.fit(est, rows.repartition(3))
    assert isinstance(got, MultilayerPerceptronClassificationModel) and got.getMaxIter() == steps and list(got.getLayers()) == [5, *hidden, 2]
    assert np.allclose(got.weights.toArray(), want.weights.toArray(), rtol=1e-5, atol=1e-5)


def test_converges_where_mllib_does(rows):
    est = models.classifier("mlp", "features", "label", n_features=5, maxIter=400, tol=0.05).setLayers([5, 3, 2])
    want, got = est.fit(rows), perceptron.fit(est, rows)
    assert np.allclose(got.weights.toArray(), want.weights.toArray(), rtol=1e-4, atol=1e-4)


def test_queries_fit_in_blocks(rows, monkeypatch):
    asked = []
    whole = perceptron._summed
    monkeypatch.setattr(perceptron, "_summed", lambda *a: asked.append(1) or whole(*a))
    model = models.fit_classifier("mlp_deep", rows, "features", "label", maxIter=3)
    assert len(asked) >= 2 and models.predict(model, rows, keep=["id"]).count() == 1024


def test_odd_rows_are_errors(rows):
    est = models.classifier("mlp", "features", "label", n_features=5, maxIter=2)
    for odd in (rows.withColumn("label", F.when(F.col("id") > 0, F.col("label"))), rows.withColumn("label", F.lit(2.0)),
                rows.withColumn("features", array_to_vector(F.array(*[F.lit(float("nan"))] * 5))), rows.limit(0)):
        with pytest.raises(Exception):
            perceptron.fit(est, odd)
