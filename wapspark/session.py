"""Session construction and the shared checkpoint folder.

On a cluster the checkpoint folder is the shared path the cluster names in
``spark.checkpoint.dir``; it is read from the session and never replaced.
Only when it is unset (local tests, the bench) do we point it at a fresh
scratch folder.
"""

from __future__ import annotations

import gc
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Session settings the library relies on. AQE gives runtime coalescing,
# broadcast conversion of small shuffled sides, and skew-join splitting of
# hot keys (NULL / repaired ``user_id = 0``).
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Remove RDD checkpoint files once nothing references them.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # A long pipeline session runs many small jobs: cap the job / stage / SQL
    # history the driver keeps in memory.
    "spark.ui.retainedJobs": "200",
    "spark.ui.retainedStages": "200",
    "spark.sql.ui.retainedExecutions": "50",
}


def build_session(master: str | None = None, app: str = "wapspark",
                  shuffle_partitions: int | None = None,
                  extra_conf: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting a scratch one only if
    the session has none (local runs). Never overrides a cluster setting."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is unset; a cluster run needs a shared folder")
    scratch = tempfile.mkdtemp(prefix="wapspark-ckpt-")
    sc.setCheckpointDir(scratch)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-path of the shared checkpoint folder for written tables.
    All of an application's lie in one folder, which goes when it ends."""
    parent = (f"{ensure_checkpoint_dir(spark).rstrip('/')}/"
              f"scratch-{spark.sparkContext.applicationId}")
    target = spark._jvm.org.apache.hadoop.fs.Path(parent)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(target):
        fs.mkdirs(target)
        fs.deleteOnExit(target)
    return f"{parent}/{name}-{uuid.uuid4().hex}"


@contextmanager
def releasing(spark: SparkSession):
    """Shuffle files of frames that are made and run inside go when their job has
    ended, not only once the driver's collector finds the frames gone. A frame
    that is run again later computes them anew."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def pinned(df: DataFrame) -> DataFrame:
    """An eager checkpoint that leaves no shuffle files behind."""
    with releasing(df.sparkSession):
        return df.select("*").checkpoint(eager=True)


def drop_unused(spark: SparkSession) -> None:
    """Let the driver's collector find the frames that nothing refers to any more:
    their shuffle files go with them (a stream's are in no job of ``releasing``)."""
    gc.collect()
    spark._jvm.System.gc()


def path_bytes(spark: SparkSession, path: str) -> int:
    """Size of a file, or of all files below a folder."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(target).getLength()


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder written under the shared checkpoint folder."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
