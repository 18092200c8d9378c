from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler

from sf_paths import SF_SMALL
from skyledger.plans import catalog
from skyledger.session import work_dir
from skyledger.streaming import scoring


def test_stream_scoring_equals_batch_scoring(spark):
    fl = catalog.flights(spark, SF_SMALL).select("FLIGHT_ID", "YEAR", "DEP_DEL15", "DEP_DELAY",
                                                 "HourlyDryBulbTemperature")
    train, new = fl.filter("YEAR < 2001"), fl.filter("YEAR = 2001")
    model = Pipeline(stages=[VectorAssembler(inputCols=["DEP_DELAY", "HourlyDryBulbTemperature"], outputCol="f"),
                             LogisticRegression(featuresCol="f", labelCol="DEP_DEL15")]).fit(train)
    landing = work_dir(spark, "t-landing")
    new.repartition(3).write.parquet(landing)
    sink = work_dir(spark, "t-scored")
    stream = scoring.read_stream(spark, landing, new.schema, max_files_per_trigger=1)
    q = scoring.score_stream(stream, lambda df: df, model, ["FLIGHT_ID"], sink)
    q.awaitTermination()
    got = {r["FLIGHT_ID"]: r["prediction"] for r in spark.read.parquet(sink).collect()}
    want = {r["FLIGHT_ID"]: r["prediction"] for r in model.transform(new).select("FLIGHT_ID", "prediction").collect()}
    assert got == want and len(got) == new.count()
