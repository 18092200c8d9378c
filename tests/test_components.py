"""Principal components from covariance sums against numpy and MLlib."""

import numpy as np
import pytest

from skyledger.operators import components, features

COLS = ["a", "b", "c", "d"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(400, 4)) @ rng.normal(size=(4, 4)) + [0, 5, 1000, -2]
    df = spark.createDataFrame([(i, *map(float, x[i])) for i in range(400)] + [(400, 1.0, None, 2.0, 3.0)],
                               "id long, a double, b double, c double, d double").persist()
    return df, x


def _matrix(sums):
    out = np.zeros((4, 4))
    for r in components.covariance(sums).collect():
        i, j = COLS.index(r["feature_a"]), COLS.index(r["feature_b"])
        out[i, j] = out[j, i] = r["covariance"]
    return out


def test_covariance_and_merge(rows):
    df, x = rows
    whole = components.covariance_sums(df, COLS)
    assert np.allclose(_matrix(whole), np.cov(x.T), rtol=1e-10)
    merged = components.merge_sums(components.covariance_sums(df.filter("id < 150"), COLS), components.covariance_sums(df.filter("id >= 150"), COLS))
    assert np.allclose(_matrix(merged), np.cov(x.T), rtol=1e-9)
    empty = components.covariance_sums(df.limit(0), COLS)
    assert np.allclose(_matrix(components.merge_sums(whole, empty)), np.cov(x.T), rtol=1e-10)
    assert {r["n"] for r in empty.collect()} == {0}


def test_components_equal_mllib_up_to_sign(rows):
    df, _ = rows
    full = df.filter("b is not null")
    own = components.Components.fit(components.covariance_sums(df, COLS), COLS)
    assert np.allclose(own.loadings.T @ own.loadings, np.eye(4), atol=1e-12)
    assert own.ratios.sum() == pytest.approx(1) and (np.diff(own.ratios) <= 0).all()
    assert (own.loadings[np.argmax(np.abs(own.loadings), axis=0), range(4)] > 0).all()
    pipe = features.Pipeline(stages=[features.assemble(COLS, "v"), features.scale("v", "s"), features.pca("s", "p", 4)]).fit(full)
    assert np.allclose(own.ratios, pipe.stages[-1].explainedVariance.toArray(), atol=1e-9)
    theirs = pipe.stages[-1].pc.toArray()
    assert np.allclose(np.abs(own.loadings), np.abs(theirs), atol=1e-8)
    got = own.project(full).orderBy("id").select(*[f"pc_{j}" for j in range(4)]).toPandas().to_numpy()
    want = np.stack([r["p"].toArray() for r in pipe.transform(full).orderBy("id").select("p").collect()])
    assert np.allclose(np.abs(got), np.abs(want), atol=1e-6)
    assert np.allclose(got.var(axis=0, ddof=1), own.ratios * 4, atol=1e-8)  # four columns of variance 1


def test_constant_column_weighs_nothing(spark):
    df = spark.createDataFrame([(float(i), 0.1) for i in range(10)], "a double, b double")
    own = components.Components.fit(components.covariance_sums(df, ["a", "b"]), ["a", "b"], k=1)
    assert own.loadings[:, 0].tolist() == [1.0, 0.0] and own.ratios.tolist() == [1.0]
