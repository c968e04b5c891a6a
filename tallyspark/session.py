"""Session construction and the shared work folder.

Cluster jobs must not write to a machine-local temporary folder: every file the
library writes (staged CSV drops, checkpoints, exports) goes below the folder
named by ``spark.checkpoint.dir`` (or ``tallyspark.work.dir`` when set), which
on a cluster is a shared file system.  Only when neither is set (local tests) do
we create one under the system temp folder.
"""

from __future__ import annotations

import contextlib
import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter at scale.  Local tests override the partition count.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot join key even when that costs an extra shuffle downstream
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # Broadcast is decided by Spark from plan statistics and, under AQE, from
    # the runtime size of the finished shuffle stage: a checked size bound with
    # sort-merge join as the fall-back.
    "spark.sql.autoBroadcastJoinThreshold": "32m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32m",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    # sort-merge → shuffled hash join only when every partition's build side
    # is below this size (checked at run time by AQE): no sort, bounded memory
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "tallyspark", extra: dict | None = None) -> SparkSession:
    """Session for local runs and tests (cluster jobs receive theirs)."""
    b = SparkSession.builder.master(master).appName(app_name)
    conf = dict(SCALE_CONF)
    conf.update({
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    })
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder, creating a local one only when unset."""
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        spark.sparkContext.setCheckpointDir(conf_dir)
        return spark.sparkContext.getCheckpointDir()
    if not re.match(r"local(\[|$)", spark.sparkContext.master):  # local-cluster has executors of its own
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    local = tempfile.mkdtemp(prefix="tallyspark-ckpt-")
    spark.sparkContext.setCheckpointDir(local)
    return spark.sparkContext.getCheckpointDir()


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def shuffles_removed(spark: SparkSession):
    """Inside, the shuffle files of a query are removed when it ends; else they lie on disk until the driver happens to collect its
    garbage, and those of a long run add up."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP) if before is None else spark.conf.set(SHUFFLE_CLEANUP, before)


def local_path(path: str) -> str:
    """Plain file-system path of a ``file:`` URI (for tests that write files by hand)."""
    return path[len("file:"):] if path.startswith("file:") else path


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for one run's files, under the shared work root."""
    root = spark.conf.get("tallyspark.work.dir", None)
    if not root:
        ckpt = ensure_checkpoint_dir(spark)
        # the checkpoint dir is a per-application sub folder; use its parent
        root = ckpt.rstrip("/").rsplit("/", 1)[0] + "/tallyspark-work"
    path = f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
    if path.startswith("file:"):
        os.makedirs(path[len("file:"):], exist_ok=True)
    elif "://" not in path:
        os.makedirs(path, exist_ok=True)
    return path
