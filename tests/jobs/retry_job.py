"""Run operators while tasks fail on their first attempt; print one JSON line of checks.

Started by tests/test_retries.py in its own process: the master ``local[4,3]`` lets a
task fail up to three times, which the shared test session does not.
"""

import json
import sys
import tempfile

sys.path.insert(0, sys.argv[1])

from pyspark import TaskContext  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from tableload.operators import sequences  # noqa: E402
from tableload.plans import materialize as mat  # noqa: E402
from tableload.specs import Partition, PartitionLevel, SequenceSpec  # noqa: E402

spark = (SparkSession.builder.master("local[4,3]").config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false").config("spark.sql.shuffle.partitions", "6")
         .getOrCreate())
spark.sparkContext.setLogLevel("FATAL")
root = tempfile.mkdtemp(prefix="tableload-retry-")
spark.sparkContext.setCheckpointDir(root)


@F.udf("bigint")
def fail_first_attempt(v):
    ctx = TaskContext.get()
    if ctx.attemptNumber() == 0 and ctx.partitionId() % 2 == 1:
        raise RuntimeError("injected task failure")
    return v


N = 40_000
src = spark.range(N).select((F.col("id") % 7).alias("k"), F.col("id").alias("v")).repartition(5)
flaky = src.withColumn("v", fail_first_attempt("v"))            # fails before the shuffles

seq = sequences.assign_sequence(flaky, ["k", "v"], SequenceSpec("s", 1, last_value=0), num_partitions=6)
seq = seq.withColumn("id", fail_first_attempt("id"))           # fails after them, too
ids = [r["id"] for r in seq.orderBy("k", "v").collect()]

clustered = mat.clustered_copy(flaky, ["k"], f"{root}/clustered", num_partitions=6)
back = spark.read.parquet(clustered)
lvl = PartitionLevel("LIST", "k", (Partition("zero", ("0",)), Partition("rest", None, True)))
parted = spark.read.parquet(mat.materialize_partitioned(flaky, lvl, f"{root}/parted"))

print(json.dumps({
    "dense_in_order": ids == list(range(1, N + 1)),
    "clustered_rows": back.count(), "clustered_distinct": back.select("v").distinct().count(),
    "parted_rows": parted.count(), "parted_distinct": parted.select("v").distinct().count(),
    "n": N,
}))
spark.stop()
