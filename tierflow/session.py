"""Session settings and the shared folder for data that must outlive an executor."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings the plans rely on; they can change on a running session.
RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot key even when the split costs one more exchange further up the plan.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # The JVM does not compile longer methods, so stages of many expressions run faster operator by operator.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

SETTINGS = {
    **RUNTIME_SETTINGS,
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.files.maxPartitionBytes": "256m",
    # Plans of many expressions are built faster without a Python stack per expression.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # Checkpoint files go when nothing refers to them any more.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


# Many small partitions to start from; adaptive execution joins them to its target size. Spark's own default of 200 would
# give partitions of hundreds of GB on large tables.
CLUSTER_SETTINGS = {"spark.sql.adaptive.coalescePartitions.initialPartitionNum": "20000"}


@contextmanager
def tuned(spark: SparkSession) -> Iterator[SparkSession]:
    """The runtime settings on a session made elsewhere, put back at the end."""
    before = {key: spark.conf.get(key, None) for key in RUNTIME_SETTINGS}
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    try:
        yield spark
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def build_session(app: str = "tierflow", master: str | None = None, **settings) -> SparkSession:
    """A session with adaptive execution on; pass `master` only for local runs, the cluster's own is for large tables."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **({} if master else CLUSTER_SETTINGS), **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in `spark.checkpoint.dir`.

    Only a local session may fall back to a folder of its own: there all executors share the machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="tierflow-"))
    return context.getCheckpointDir()


def _scratch_folder(spark: SparkSession) -> str:
    """This application's folder below the shared one; it goes when the application ends."""
    context = spark.sparkContext
    folder = f"{shared_dir(spark).rstrip('/')}/scratch-{context.applicationId}"
    path = context._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(context._jsc.hadoopConfiguration())
    files.mkdirs(path)
    files.deleteOnExit(path)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path of its own for one run below the shared folder."""
    return f"{_scratch_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stable(df: DataFrame) -> DataFrame:
    """Freeze values that a recomputation could change (row positions), safe against lost executors."""
    spark = df.sparkSession
    folder = shared_dir(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint()
