"""Written tables in the cluster's shared folder: how the operators cut lineage."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from skyledger.session import checkpoint_dir


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir`` (a private one only in local tests)."""
    return f"{checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"


def save(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and continue from the written table.

    A lost executor re-reads files instead of repeating the plan upstream, and
    every consumer sees the same rows. ``compression``: the session's if not given.
    """
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete tables written by :func:`save` that no later plan reads."""
    for df in tables:
        spark = df.sparkSession
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            remove(spark, folder)


def remove(spark: SparkSession, folder: str) -> None:
    """Delete a folder of :func:`shared_path`."""
    if "/llm-" in folder:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
