"""Sources, sinks and persistence."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Feature-set variants (file-name suffixes) of the reference pipeline.
VARIANTS = {
    "train": "_train_VA",
    "train_resample": "_train_VA_resample",
    "train_yearly_resample": "_train_VA_yearly_resample",
    "train_smote": "_train_VA_SMOTE_resample",
    "train_smote_yearly": "_train_VA_SMOTE_yearly_resample",
    "test": "_test_VA",
    "new_data": "_new_data_VA",
}

# Columns of the experiment export.
EXPERIMENT_COLUMNS = ["Name", "Training Time (s)", "dataset_name", "family", "featuresCol_1", "featuresCol_2",
                      "test_AUC", "test_accuracy", "test_precision", "test_recall"]


def read_table(spark: SparkSession, base: str, name: str, schema: T.StructType | None = None,
               columns: list[str] | None = None, required: list[str] | None = None) -> DataFrame:
    """A Parquet dataset by name; ``columns`` prunes at the scan.

    ``schema`` declares the columns to read; a dataset that lacks a
    ``required`` column raises ``ValueError`` naming what is missing.
    """
    reader = spark.read.schema(schema) if schema is not None else spark.read
    df = reader.parquet(f"{base.rstrip('/')}/{name}")
    missing = [c for c in required or [] if c not in df.columns]
    if missing:
        raise ValueError(f"{name} lacks the columns {missing}")
    return df.select(*columns) if columns else df


def read_experiments(spark: SparkSession, path: str, schema: T.StructType | None = None,
                     columns: list[str] | None = None) -> DataFrame:
    """A CSV export with a header; explicit ``schema`` avoids an inference pass."""
    reader = spark.read.option("header", True)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    df = reader.csv(path)
    wanted = columns if columns is not None else [c for c in EXPERIMENT_COLUMNS if c in df.columns]
    return df.select(*[df[f"`{c}`"] for c in wanted])


def write_features(df: DataFrame, base: str, name: str, variant: str, n_files: int | None = None,
                   partition_by: list[str] | None = None) -> str:
    """S3: overwrite a feature set as Parquet.

    ``partition_by`` (e.g. the year) lets later year filters prune whole
    folders; ``n_files`` repartitions first, otherwise AQE sizes the output.
    """
    path = f"{base.rstrip('/')}/{name}{VARIANTS[variant]}"
    out = df.repartition(n_files) if n_files else df
    writer = out.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def read_features(spark: SparkSession, base: str, name: str, variant: str) -> DataFrame:
    """Reload a feature set by variant."""
    return spark.read.parquet(f"{base.rstrip('/')}/{name}{VARIANTS[variant]}")


def write_csv(df: DataFrame, path: str) -> str:
    """Export with a header row (the experiment table's format)."""
    df.write.mode("overwrite").option("header", True).csv(path)
    return path


def persist_step(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> DataFrame:
    """Keep a DataFrame that feeds two or more actions (memory, spilling to disk)."""
    return df.persist(level)


def unpersist(df: DataFrame) -> DataFrame:
    return df.unpersist()
