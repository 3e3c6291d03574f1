"""Session helpers: building a local session for tests and finding shared scratch space.

On a cluster the session comes from the launcher; the library only reads settings from it. The one setting it
needs is ``spark.checkpoint.dir``, the shared folder where lineage is cut and where the round-trip helpers write.
Only when that setting is absent (unit tests, a laptop) does the library pick a private temporary folder.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"
_FREED_KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "tillgrid") -> SparkSession:
    """A local session configured like the cluster profile (AQE on, UTC, UI off)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's shared checkpoint folder; set a private one only when none is configured."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get(_CHECKPOINT_KEY, None) or sc.getConf().get(_CHECKPOINT_KEY, None)
    if not configured:
        # Unset: a test or single-machine run. On a cluster no folder of this machine would do.
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError(f"set {_CHECKPOINT_KEY} to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="tillgrid-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused folder for one write (under the shared checkpoint folder)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tillgrid/{name}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of every write and action inside go when it has ended, not when the driver happens to collect garbage.

    For steps that each start from files, so that none needs an earlier one's shuffle. Spark before 4.1 does not know the
    setting and keeps the files longer."""
    before = spark.conf.get(_FREED_KEY, None)
    spark.conf.set(_FREED_KEY, "true")
    try:
        yield
    finally:
        spark.conf.unset(_FREED_KEY) if before is None else spark.conf.set(_FREED_KEY, before)
