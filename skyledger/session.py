"""Session construction and shared-storage helpers."""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager, nullcontext

from pyspark.sql import SparkSession

# Settings every query relies on: UTC wall clock, ANSI semantics, adaptive
# execution (partition coalescing, skew-join splitting, runtime broadcast).
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Checkpoint files of iterative steps are deleted once nothing references them.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str | None = None, app_name: str = "skyledger",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or fetch) a SparkSession with the engine's defaults.

    ``master`` is only set when given: on a cluster the launcher decides.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            # Local mode: the driver JVM is the only executor; plans and tasks share its heap.
            builder = builder.config("spark.ui.enabled", "false").config("spark.driver.memory", "8g")
    conf = dict(SESSION_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    apply_runtime_defaults(spark)
    return spark


def apply_runtime_defaults(spark: SparkSession) -> None:
    """Set the runtime (per-session) settings on an existing session."""
    for key in ("spark.sql.session.timeZone", "spark.sql.ansi.enabled"):
        spark.conf.set(key, SESSION_DEFAULTS[key])


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names a shared (distributed) folder there; it is read from the
    session and never replaced. Only a local-mode session without one (tests)
    gets a private folder under the system temp directory.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    local = tempfile.mkdtemp(prefix="skyledger-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


@contextmanager
def plain_constraints(spark: SparkSession):
    """Plan without inferring filters from constraints, for plans that stack many computed columns.

    One predicate over k computed columns becomes 2^k inferred constraints once
    the columns are aliased above it. Only plans executed inside are affected.
    """
    key = "spark.sql.constraintPropagation.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def materialise(df, wide: bool = False):
    """Write ``df`` as Parquet in the shared checkpoint folder and continue from the written table.

    Used at stage boundaries and for learned tables that several plans read:
    they are computed once, a lost executor re-reads files, and later scans
    prune columns and push filters down. ``wide``: see :func:`plain_constraints`.
    """
    spark = df.sparkSession
    path = work_dir(spark, "table")
    with plain_constraints(spark) if wide else nullcontext():
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for written intermediates."""
    return f"{checkpoint_dir(spark).rstrip('/')}/skyledger-{name}-{uuid.uuid4().hex}"


def spread(table, drop: bool = False):
    """``table``, written anew with a file per core if it lies in fewer files; ``drop``: delete the old one.

    Splits of a file don't count: its only row group is read by one task, the others find nothing.
    """
    cores = table.sparkSession.sparkContext.defaultParallelism
    if len(table.inputFiles()) >= cores:
        return table
    out = materialise(table.repartition(cores))
    if drop:
        discard(table)
    return out


def discard(*tables) -> None:
    """Delete written intermediates (``materialise``) that no later plan reads."""
    for df in tables:
        spark = df.sparkSession
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            if "/skyledger-table-" in folder:
                delete(spark, folder)


def delete(spark: SparkSession, folder: str) -> None:
    """Delete a folder that :func:`work_dir` named, or one inside."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
