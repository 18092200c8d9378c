"""Scoring new flights as they arrive (M9 on Structured Streaming).

The reference scores a batch of new data with a stored model. The same plan
runs unchanged on a stream: the per-row features (calendar flags, time slot,
season, nearest measurement) are stateless expressions, learned summaries
(RFM scores, centralities, volume groups) are static tables joined to the
stream, and a fitted ``PipelineModel`` transforms streaming DataFrames.
Progress and output commits live under a checkpoint location in the shared
checkpoint folder, so a restarted query resumes exactly where it stopped.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..session import work_dir


def read_stream(spark: SparkSession, path: str, schema, max_files_per_trigger: int | None = None) -> DataFrame:
    """A Parquet folder as a stream of new files (schema given: no inference on a stream)."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def score_stream(stream: DataFrame, prepare: Callable[[DataFrame], DataFrame], model, keep: list[str],
                 sink_path: str, checkpoint: str | None = None, available_now: bool = True) -> StreamingQuery:
    """Apply ``prepare`` (stateless features + stream-static joins) and ``model``; append to Parquet."""
    from pyspark.ml.functions import vector_to_array

    scored = model.transform(prepare(stream))
    out = scored.select(*keep, "prediction", vector_to_array("probability")[1].alias("p1")) \
        if "probability" in scored.columns else scored.select(*keep, "prediction")
    location = checkpoint or work_dir(stream.sparkSession, "stream-ckpt")
    writer = out.writeStream.format("parquet").option("path", sink_path) \
        .option("checkpointLocation", location).outputMode("append")
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
