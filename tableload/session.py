"""Session helpers: building a local session for tests and finding shared scratch space.

Library code never invents a machine-local scratch folder on a cluster.  Intermediate
tables (staging copies, lineage cuts) go below ``spark.checkpoint.dir``; only a
local-mode session without that setting gets a private folder under the system
temp directory, and the setting is then recorded on the session.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "tableload",
                  extra: dict[str, str] | None = None) -> SparkSession:
    """A local-mode session configured the way the tests and the bench expect
    (``extra``: further settings, e.g. an event log for stage timings)."""
    builder = SparkSession.builder
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = (
        builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # coalesce post-shuffle partitions to the advisory size, not to the core count
        .config("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("TABLELOAD_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster the setting must exist (it names storage every executor can reach).
    Only a local-mode session may fall back to a fresh private folder, which is then
    registered on the session so that ``DataFrame.checkpoint()`` uses it too.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at storage shared by all executors"
        )
    root = tempfile.mkdtemp(prefix="tableload-ckpt-")
    sc.setCheckpointDir(root)           # what DataFrame.checkpoint() uses; read back above
    try:
        spark.conf.set("spark.checkpoint.dir", root)
    except Exception:  # noqa: BLE001 - some deployments refuse runtime changes of core settings
        pass
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, unique path below the checkpoint root for one intermediate table."""
    return f"{checkpoint_root(spark)}/tableload-{label}-{uuid.uuid4().hex[:12]}"


def target_partitions(spark: SparkSession) -> int:
    """Partition count for an exchange that needs a fixed count.

    Follows the cluster's sizing: the adaptive initial partition number when it is set
    (the count a large job starts from before coalescing), else the shuffle setting.
    """
    initial = spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
    return max(1, int(initial or spark.conf.get("spark.sql.shuffle.partitions", "200")))

