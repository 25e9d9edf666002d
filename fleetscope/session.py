"""Session defaults and the shared scratch folder.

On a cluster the job is submitted with its own configuration; ``get_session``
only fills in what neither the submission nor a running session has set.
``scratch_root`` is where written tables go: the folder the cluster names in
``spark.checkpoint.dir`` (shared storage that survives executor loss).  Only when that
is unset and the master is known to be local, as in tests, a fresh local folder is
created and registered as the checkpoint directory.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark import SparkConf, SparkContext
from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Post-rollup shuffles are small in bytes but not in work (joins to
    # membership, merges); let AQE keep them spread over more tasks instead of
    # coalescing everything under 1 MB into one.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "fleetscope", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    given = _given()
    for k, v in conf.items():
        if k not in given or k in (extra or {}):
            builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _given() -> set[str]:
    """Settings of the running session, or else of the submission."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return set(active.conf.getAll)
    SparkContext._ensure_initialized()  # what was submitted is known to the JVM only
    return {k for k, _ in SparkConf().getAll()}


def _local_fallback(master: str | None) -> str:
    """A fresh local folder, allowed only when the whole job is known to run on this machine."""
    if not master or not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set: written intermediate tables need a folder on "
            "shared storage that every executor and the driver can reach")
    return tempfile.mkdtemp(prefix="fleetscope-scratch-")


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for written tables (``spark.checkpoint.dir``).

    When it is unset and the master is local (tests, single-machine runs) a
    fresh local folder is used and registered; on a cluster an unset folder is
    an error rather than a silent machine-local path.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no SparkContext on the client
        sc = None
    if sc is None:
        return spark.conf.get("spark.checkpoint.dir", None) or _local_fallback(None)
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    sc.setCheckpointDir(configured or _local_fallback(sc.master))
    return sc._jsc.sc().getCheckpointDir().get()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique location below the scratch root."""
    root = scratch_root(spark).rstrip("/")
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"
