"""Session construction and shared-folder helpers."""

from __future__ import annotations

import io
import os
import re
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

# Settings that matter at scale; all are ordinary Spark SQL configuration.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Zone-less wall-clock timestamps are interpreted as UTC in streams.
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Merge a user's session windows inside each input partition before the
    # shuffle, so a busy user reaches the state store as a few sessions.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


# Starting points for a large cluster (hundreds of executors, ~100 TB input).
# The initial shuffle width is deliberately large: AQE coalesces it down to
# ``advisoryPartitionSizeInBytes`` per task at run time, so partitions stay
# small enough not to spill at any data size, and splits skewed ones.
CLUSTER_CONF = {
    **RECOMMENDED_CONF,
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    # Runtime broadcast only under this measured size; larger sides stay shuffled.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
}


def build_session(master: str | None = "local[*]", app: str = "ledgerguard",
                  shuffle_partitions: int | None = 8, extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(RECOMMENDED_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    On a cluster this setting points at shared storage. Only when it is unset
    (local tests) do we create one, and we also register it with the context;
    on any other master that is an error, as executors do not share a disk.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = spark.sparkContext.getCheckpointDir()
    if not path:
        master = spark.sparkContext.master
        if not re.match(r"local(\[|$)", master):
            raise RuntimeError(f"spark.checkpoint.dir must name a shared folder on {master}")
        path = tempfile.mkdtemp(prefix="ledgerguard-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/")


def fresh_path(spark: SparkSession, kind: str) -> str:
    """A new, unique sub-folder of the shared folder."""
    return f"{shared_dir(spark)}/ledgerguard/{kind}-{uuid.uuid4().hex}"


def ship_code(spark: SparkSession) -> None:
    """Give the executors this package's code, once per application, as ``--py-files`` would.

    Only operators that run Python in tasks need it. The archive lies in the
    shared folder.
    """
    context = spark.sparkContext
    if getattr(context, "_ledgerguard_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    archive = io.BytesIO()
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.relpath(full, os.path.dirname(root)))
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{fresh_path(spark, 'code')}/ledgerguard-code.zip")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    stream = fs.create(path)
    stream.write(archive.getvalue())
    stream.close()
    context.addPyFile(fs.makeQualified(path).toString())
    context._ledgerguard_shipped = True


def delete_path(spark: SparkSession, pattern: str) -> None:
    """Delete the files and folders that match ``pattern``, if any."""
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(pattern)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for status in fs.globStatus(jpath) or []:
        fs.delete(status.getPath(), True)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the Hadoop file system (works for any scheme)."""
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(jpath))


def glob_exists(spark: SparkSession, pattern: str) -> bool:
    """Whether any file or folder matches ``pattern``."""
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.globStatus(jpath))


__all__ = ["build_session", "shared_dir", "fresh_path", "path_exists", "glob_exists", "delete_path", "ship_code", "RECOMMENDED_CONF",
           "CLUSTER_CONF"]
