import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

from pyspark.sql import SparkSession  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[*]")
        .appName("tableload-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("FATAL")
    # tests own their checkpoint folder (only set because the session has none)
    if not session.conf.get("spark.checkpoint.dir", None):
        ckpt = tempfile.mkdtemp(prefix="tableload-test-ckpt-")
        session.conf.set("spark.checkpoint.dir", ckpt)
        session.sparkContext.setCheckpointDir(ckpt)
    yield session
    session.stop()


@pytest.fixture()
def tmp_target(tmp_path):
    """A path that does not exist yet (targets must not exist before a load)."""
    return str(tmp_path / "target")


def rows(df, *cols):
    """Sorted list of tuples, for order-insensitive comparisons."""
    sel = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in sel.collect()), key=lambda t: tuple((x is None, x) for x in t))
