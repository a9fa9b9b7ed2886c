"""Session construction and shared-folder helpers.

Cluster jobs get their settings from the deployment; ``get_session`` only fills
gaps so that local runs (tests, bench) behave like a sized cluster: AQE on,
UI off, UTC session time zone, and a checkpoint folder when none is configured.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # 128 MiB input splits keep scan tasks small enough to fit an executor core.
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
}


def get_session(master: str | None = None, app: str = "sparkprep",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Return the active session, or build one with the defaults above.

    Settings already present in the environment win over the defaults.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in _DEFAULTS.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the deployment sets it to a shared file system; a cluster
    session without it is refused. Only a local session (tests, bench) gets a
    private temporary folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() if hasattr(sc, "getCheckpointDir") else None
    if current:
        return current
    configured = (spark.conf.get("spark.checkpoint.dir", None)
                  or sc.getConf().get("spark.checkpoint.dir", None))
    if not configured:
        if not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("spark.checkpoint.dir is not set: name a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="sparkprep-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder (for written tables)."""
    base = ensure_checkpoint_dir(spark)
    if base.startswith("file:"):
        base = base[len("file:"):]
    return os.path.join(base, f"{name}-{uuid.uuid4().hex}")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def materialize(df):
    """Cut lineage with a reliable checkpoint in the shared checkpoint folder
    (survives executor loss, unlike a local checkpoint). Used before
    iterative fits so each iteration does not replay the feature plan. The
    partitions stay as they are."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
