"""Session construction and the shared scratch folder.

On a cluster the session is built by the platform; ``get_spark`` returns the
active one, or builds one with defaults for settings that nobody has set:
values from ``spark-submit --conf``, ``spark-defaults.conf`` or
``PYSPARK_SUBMIT_ARGS`` stay. Scratch tables (round trips, lineage cuts) live
under the checkpoint directory the cluster names in ``spark.checkpoint.dir``.
Only a single-process local session may go without: it gets a private
temporary folder, any other master is an error.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark import SparkConf, SparkContext
from pyspark.sql import SparkSession

# Settings applied only when the session does not already define them.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Remove checkpoint files once no DataFrame references them.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def unset_defaults(known: SparkConf, shuffle_partitions: int | None = None) -> dict[str, str]:
    """The defaults that ``known`` does not define."""
    wanted = dict(_DEFAULTS)
    if shuffle_partitions:
        wanted["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    return {k: v for k, v in wanted.items() if not known.contains(k)}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "basketry", driver_memory: str | None = None) -> SparkSession:
    """Return the active session, or build one; settings that are already made win.

    ``master`` and ``driver_memory`` are the caller's own choice.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    launch = SparkConf()
    if driver_memory:  # only has an effect before the JVM starts
        launch.set("spark.driver.memory", driver_memory)
    SparkContext._ensure_initialized(conf=launch)
    known = SparkConf()
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in unset_defaults(known, shuffle_partitions).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder; a private one only on a local master."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not is_local(sc.master):
            raise RuntimeError(
                f"spark.checkpoint.dir is unset on master {sc.master!r}: name a folder that "
                "the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="basketry-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def is_local(master: str) -> bool:
    """True for ``local`` and ``local[...]``: driver and executor are one process."""
    return re.fullmatch(r"local(\[.*\])?", master) is not None


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/basketry/{name}-{uuid.uuid4().hex[:12]}"
