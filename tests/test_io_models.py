import pytest
from pyspark.sql import functions as F

from sf_paths import SF_SMALL
from skyledger.session import work_dir
from skyledger.sources import experiment_log, tables


def test_read_table_prunes_and_features_roundtrip(spark):
    df = tables.read_table(spark, SF_SMALL, "lineitem.parquet", columns=["l_orderkey", "l_quantity"])
    assert df.columns == ["l_orderkey", "l_quantity"]
    base = work_dir(spark, "t-features")
    src = df.withColumn("YEAR", (F.col("l_orderkey") % 3).cast("int"))
    tables.write_features(src, base, "x", "train", n_files=2, partition_by=["YEAR"])
    back = tables.read_features(spark, base, "x", "train")
    assert back.filter("YEAR = 1").count() == src.filter("YEAR = 1").count()
    plan = back.filter("YEAR = 1")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(YEAR" in plan


def test_read_experiments_csv_with_inference(spark):
    rows = [("lr", 12.5, "flights_60M", "majority class", 0.6), ("dt", 3.0, "flights_60M", "tree", 0.55)]
    df = spark.createDataFrame(rows, "Name string, `Training Time (s)` double, dataset_name string, family string, test_AUC double")
    path = tables.write_csv(df, work_dir(spark, "t-csv"))
    back = tables.read_experiments(spark, path)
    assert back.columns == ["Name", "Training Time (s)", "dataset_name", "family", "test_AUC"]
    assert dict(back.select("Name", "test_AUC").collect()) == {"lr": 0.6, "dt": 0.55}


def test_log_run_and_wide_view(spark):
    path = work_dir(spark, "t-log")
    m = spark.createDataFrame([(0.7, 0.8)], "test_AUC double, test_accuracy double")
    rid1 = experiment_log.log_run(spark, path, "lr", {"dataset_name": "A", "family": "logistic"}, m)
    rid2 = experiment_log.log_run(spark, path, "dt", {"dataset_name": "A"}, {"test_AUC": 0.6})
    wide = experiment_log.experiment_table(experiment_log.read_log(spark, path), ["dataset_name", "family"],
                                           ["test_AUC", "test_accuracy"])
    got = {r["run_id"]: r for r in wide.collect()}
    assert got[rid1]["test_accuracy"] == 0.8 and got[rid1]["family"] == "logistic"
    assert got[rid2]["test_AUC"] == 0.6 and got[rid2]["test_accuracy"] is None


def test_persist_step(spark):
    df = tables.persist_step(spark.range(10))
    assert df.is_cached and df.count() == 10
    tables.unpersist(df)


def test_classifier_beats_baseline(spark):
    from pyspark.ml.feature import VectorAssembler

    from skyledger.operators import metrics
    from skyledger.plans import catalog, models
    fl = catalog.flights(spark, SF_SMALL).select("FLIGHT_ID", "YEAR", "DEP_DEL15", "DEP_DELAY", "HourlyDryBulbTemperature")
    va = VectorAssembler(inputCols=["DEP_DELAY", "HourlyDryBulbTemperature"], outputCol="f").transform(fl)
    train, test = va.filter("YEAR < 2001"), va.filter("YEAR = 2001")
    model = models.fit_classifier("lr", train, "f", "DEP_DEL15")
    pred = models.predict(model, test, keep=["DEP_DEL15"])
    auc = metrics.auc_rank(pred, "p1", "DEP_DEL15").head()["auc"]
    base = models.baseline_predict(test, models.majority_share(fl, "DEP_DEL15"), seed=451, key=["FLIGHT_ID"])
    base_auc = metrics.balanced_accuracy(base, "prediction", "DEP_DEL15").head()["balanced_accuracy"]
    assert auc > 0.99 and base_auc == pytest.approx(0.5, abs=0.05)
