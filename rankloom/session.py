"""Session construction and shared scratch space.

``build_session`` keeps what the launcher set and fills in local defaults (tests, bench).  Scratch data (round-trip files, lineage cuts) goes under
``spark.checkpoint.dir`` — the shared folder the cluster names — and a local temporary
folder is created only when that setting is absent, as in tests.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark import SparkConf, SparkContext
from pyspark.sql import SparkSession


def _launcher_settings() -> dict[str, str]:
    """What a launcher (spark-submit, or PYSPARK_SUBMIT_ARGS) has set for this process."""
    if not os.environ.keys() & {"PYSPARK_GATEWAY_PORT", "PYSPARK_SUBMIT_ARGS"}:
        return {}
    SparkContext._ensure_initialized()  # the launcher's settings are in its JVM
    return dict(SparkConf().getAll())


def build_session(master: str | None = None, app: str = "rankloom",
                  shuffle_partitions: int | None = None, driver_memory: str = "16g",
                  extra: dict | None = None) -> SparkSession:
    """A session for this process.  Arguments and local defaults (master, memory, shuffle
    width, ...) fill in only what the launcher left open; ``extra`` always holds."""
    given = _launcher_settings()
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    defaults = {
        "spark.master": master or f"local[{cpus}]",
        "spark.app.name": app,
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": driver_memory,
        "spark.sql.session.timeZone": "UTC",
        # Initial shuffle width; AQE coalesces small partitions and splits skewed ones
        # at runtime from the measured map-output sizes.
        "spark.sql.shuffle.partitions": str(shuffle_partitions or max(8, 2 * cpus)),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64m",
        # Checkpointed intermediates (checked-broadcast dimensions, ALS lineage cuts)
        # are deleted once their data is no longer referenced.
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.execution.arrow.maxRecordsPerBatch": "10000",
    }
    if given.get("spark.master") and not given["spark.master"].startswith("local"):
        # Widths that fit one machine are left to a cluster's own defaults.
        for name in ("spark.sql.shuffle.partitions", "spark.driver.memory"):
            defaults.pop(name)
    b = SparkSession.builder
    for k, v in {**{k: v for k, v in defaults.items() if k not in given}, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The session's shared checkpoint folder; a local one only when none is configured
    and the master is local (tests).  On a cluster a machine-local folder would leave
    "reliable" checkpoints on executor disks, so that is refused."""
    sc = spark.sparkContext
    root = sc.getCheckpointDir()
    if not root:
        root = spark.conf.get("spark.checkpoint.dir", None)
        if not root:
            if not sc.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster "
                                   "(checkpoints and scratch tables are written there)")
            root = tempfile.mkdtemp(prefix="rankloom-ckpt-")
        sc.setCheckpointDir(root)
        root = sc.getCheckpointDir() or root
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a scratch path through the file system it is in."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
