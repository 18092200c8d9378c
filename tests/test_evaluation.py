"""All models scored together against each model by itself; the shared log."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from skyledger.operators import metrics
from skyledger.plans import models
from skyledger.session import work_dir
from skyledger.sources import experiment_log


@pytest.fixture(scope="module")
def splits(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(800, 3))
    y = (x[:, 0] + 0.5 * x[:, 1] + rng.normal(size=800) > 0.3).astype(float)
    df = spark.createDataFrame([(i, x[i].tolist(), float(y[i])) for i in range(800)], "id long, v array<double>, label double")
    df = df.withColumn("features", array_to_vector("v")).drop("v").persist()
    return {"train": df.filter("id < 600"), "test": df.filter("id >= 600")}


def test_evaluate_all_equals_one_by_one(splits):
    fitted = {k: models.fit_classifier(k, splits["train"], "features", "label") for k in ("lr", "dt", "mlp")}
    rows = {r["model"]: r for r in models.evaluate_all(fitted, splits, "label").collect()}
    assert set(rows) == set(fitted)
    for kind, model in fitted.items():
        for split, df in splits.items():
            scored = models.predict(model, df, keep=["label"]).persist()
            want = metrics.summary_from_confusion(metrics.confusion(scored, "prediction", "label")).head()
            auc = metrics.auc_rank(scored, "p1", "label").head()[0]
            got = rows[kind]
            assert got[f"{split}_AUC"] == pytest.approx(auc, abs=1e-12)
            for name in ("accuracy", "weighted_precision", "weighted_recall", "weighted_f1", "balanced_accuracy"):
                assert got[f"{split}_{models.METRIC_NAMES[name]}"] == pytest.approx(want[name], abs=1e-12)


def test_models_keep_their_columns(splits):
    """Scoring together leaves the fitted models as they are."""
    model = models.fit_classifier("lr", splits["train"], "features", "label")
    models.evaluate_all({"lr": model}, splits, "label")
    assert "prediction" in model.transform(splits["test"]).columns


def test_logged_runs(spark, splits):
    path = work_dir(spark, "t-runs")
    models.logged_runs(["lr", "dt"], splits["train"], splits["test"], "features", "label", path, dataset="d")
    wide = experiment_log.experiment_table(experiment_log.read_log(spark, path), ["dataset_name", "family"],
                                           ["train_AUC", "test_AUC", "Training Time (s)"]).collect()
    assert {r["run_name"] for r in wide} == {"lr", "dt"} and all(r["dataset_name"] == "d" for r in wide)
    assert all(0.5 < r["test_AUC"] <= 1 and r["Training Time (s)"] > 0 for r in wide)
