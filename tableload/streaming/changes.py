"""Incremental loads with Structured Streaming.

The batch operators carry over to a stream of incoming rows without new semantics:

* row rewriting (T1) is a stateless projection and filter, so it runs on a streaming
  DataFrame as is (:func:`rewrite_stream`);
* a partitioned load (S4) becomes a file-sink query: every micro-batch is routed, a row
  fitting no partition fails the batch, and the sink's commit log makes each batch
  all-or-nothing and exactly-once across restarts (:func:`load_stream`);
* statement-level results (T3) are computed per micro-batch -- a micro-batch is the
  statement -- and written to ``batch=<id>`` with overwrite, so a replayed batch
  rewrites the same directory instead of duplicating it (:func:`statement_results_stream`).

Checkpoints go below ``spark.checkpoint.dir`` unless a location is given.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.rewrite import after_statement, apply_trigger
from ..operators.routing import HashFn, route, xxhash_keys
from ..plans.materialize import assert_routed
from ..session import scratch_path
from ..specs import PartitionLevel, PartitionScheme, TriggerSpec


def rewrite_stream(stream: DataFrame, triggers: Sequence[TriggerSpec], op: str = "op") -> DataFrame:
    """Apply BEFORE ... FOR EACH ROW triggers, in order, to a streaming change set."""
    out = stream
    for t in triggers:
        out = apply_trigger(out, t, op)
    return out


def load_stream(stream: DataFrame, scheme: PartitionScheme | PartitionLevel, path: str,
                checkpoint: str | None = None, hash_fn: HashFn = xxhash_keys, available_now: bool = True,
                part: str = "part", subpart: str = "subpart") -> StreamingQuery:
    """Route each micro-batch into partitions and append it to a partitioned Parquet table."""
    if isinstance(scheme, PartitionLevel):
        scheme = PartitionScheme(scheme)
    spark = stream.sparkSession
    routed = assert_routed(route(stream, scheme, part, subpart, hash_fn), scheme, part, subpart)
    cols = [part, subpart] if any(lvl.partitions for lvl in scheme.sub.values()) else [part]
    writer = (routed.writeStream.format("parquet").partitionBy(*cols).outputMode("append")
              .option("checkpointLocation", checkpoint or scratch_path(spark, "load-stream-ckpt")))
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start(path)


def statement_results_stream(stream: DataFrame, events: Sequence[str], aggregates: dict[str, Column],
                             path: str, checkpoint: str | None = None, op: str = "op",
                             available_now: bool = True) -> StreamingQuery:
    """One result row per (micro-batch, event), also for events absent from a batch."""
    spark = stream.sparkSession

    def per_batch(batch: DataFrame, epoch_id: int) -> None:
        changes = batch.withColumn("batch", F.lit(epoch_id).cast("bigint"))
        batches = changes.sparkSession.range(1).select(F.lit(epoch_id).cast("bigint").alias("batch"))
        result = after_statement(changes, batches, events, aggregates, batch="batch", op=op)
        result.drop("batch").write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch={epoch_id}")

    writer = (stream.writeStream.foreachBatch(per_batch)
              .option("checkpointLocation", checkpoint or scratch_path(spark, "statement-stream-ckpt")))
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start()
