"""Written tables of few files are dealt over the cores, however many splits Spark makes of a file."""

from skyledger.plans import models
from skyledger.session import materialise, spread
from test_blocks import _rows


def test_one_file_of_many_splits_is_dealt(spark):
    cores = spark.sparkContext.defaultParallelism
    whole = materialise(spark.range(0, 3000, 1, 1))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        one = spark.read.schema(whole.schema).parquet(*whole.inputFiles())
        assert one.rdd.getNumPartitions() >= cores
        out = spread(one)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(out.inputFiles()) == cores and spread(out) is out
    assert sorted(r[0] for r in out.collect()) == list(range(3000))
    assert min(len(p) for p in out.rdd.glom().collect()) > 0


def test_perceptron_rows_lie_in_a_file_per_core(spark, monkeypatch):
    rows = materialise(_rows(spark, 4000, 6).coalesce(1))
    asked = []
    monkeypatch.setattr(models, "spread", lambda df: asked.append(df.columns) or spread(df))
    from pyspark.ml.functions import array_to_vector
    models.fit_classifier("mlp", rows.withColumn("features", array_to_vector("features")), "features", "label", maxIter=2)
    assert asked == [["label", "features"]]
