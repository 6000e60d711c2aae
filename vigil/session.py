"""Session settings and the shared scratch location.

Every job runs with the session time zone pinned to UTC (event times are
``timestamp_ntz`` and must not shift), ANSI mode on, and adaptive query
execution on so that join strategies, partition counts and skewed join
partitions are decided from runtime statistics.
"""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from py4j.protocol import Py4JError
from pyspark import SparkContext
from pyspark.sql import SparkSession

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str | None = None, app: str = "vigil",
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the library relies on."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SESSION_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    # settings that may be changed on a running session
    for key in ("spark.sql.session.timeZone", "spark.sql.ansi.enabled",
                "spark.sql.sources.partitionOverwriteMode"):
        spark.conf.set(key, SESSION_CONF[key])
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set by the deployment (a shared file system).
    Only a local-mode session without the setting gets a private folder, as
    tests do.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        root = tempfile.mkdtemp(prefix="vigil-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root


def reliable_checkpoint(df):
    """``df.checkpoint()`` into the shared checkpoint folder (never a local
    checkpoint): the data is materialised on reliable storage and lineage is
    cut, so a lost executor does not force recomputation of the inputs."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


_OWN: set[str] = set()


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for written tables. The folders of
    an application are deleted when its driver ends."""
    own = os.path.join(checkpoint_root(spark), "vigil", spark.sparkContext.applicationId)
    if own not in _OWN:
        _OWN.add(own)
        atexit.register(_delete, own)
    return os.path.join(own, f"{purpose}-{uuid.uuid4().hex}")


def _delete(path: str) -> None:
    jvm = SparkContext._jvm
    if jvm is None:
        return
    folder = jvm.org.apache.hadoop.fs.Path(path)
    try:
        folder.getFileSystem(jvm.org.apache.hadoop.conf.Configuration()).delete(folder, True)
    except (Py4JError, OSError):  # the JVM has ended before; the folder stays
        pass


def written(df):
    """``df`` written as Parquet into the shared scratch folder and read again: lineage is cut,
    and later plans start from the table's true size in bytes, so joins broadcast it only
    below Spark's own size limit."""
    path = scratch_dir(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
