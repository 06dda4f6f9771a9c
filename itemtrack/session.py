"""Session construction and the shared scratch / checkpoint location."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that every job relies on: UTC day arithmetic (file discovery, run dates),
# adaptive execution for runtime broadcast conversion, partition coalescing and
# skew-join splitting.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "itemtrack", extra: dict | None = None) -> SparkSession:
    """Session for tests and the bench.  On a cluster, use the cluster's session."""
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    ``spark.checkpoint.dir`` is read from the session.  Only in a local session
    (one process: tests, the bench) is a private folder created when it is unset;
    on a cluster a machine-local folder would be lost to the other machines, so
    there it is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="itemtrack-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint location."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/itemtrack-{name}-{uuid.uuid4().hex[:12]}"


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder that this job wrote, on whatever file system it is."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def path_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of the files under a folder."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(where).getLength()


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme for python-side file helpers used in tests."""
    if path.startswith("file:"):
        path = path[len("file:"):]
        while path.startswith("//"):
            path = path[1:]
    return os.path.abspath(path)


def cluster_conf(input_bytes: int, executor_cores_total: int) -> dict:
    """Settings for a large run, sized from the input volume.

    Shuffle partitions start at ~256 MiB of input each (at least 2x the cores) and
    AQE coalesces small ones and splits skewed ones at run time; scan splits are
    256 MiB; broadcasts stay at the default threshold (config-sized tables only).
    """
    mib = 1 << 20
    partitions = max(2 * executor_cores_total, input_bytes // (256 * mib))
    return {
        **BASE_CONF,
        "spark.sql.shuffle.partitions": str(int(partitions)),
        "spark.sql.files.maxPartitionBytes": str(256 * mib),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * mib),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 * mib),
        "spark.sql.autoBroadcastJoinThreshold": str(64 * mib),
    }
