"""Queries for the Structured Streaming variants."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...session import scratch_path
from .base import query, table
from .placement import PRICE_RANGES


# =========================================================================== streaming

def _stream_of(spark, d, name):
    """A file-source stream over one driver table (its directory, filtered to the file)."""
    schema = table(spark, d, name).schema
    return (spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet")
            .option("maxFilesPerTrigger", 1).parquet(d))


@query("stream_load", """
SELECT CASE WHEN o_totalprice < 50000 THEN 'r_low' WHEN o_totalprice < 150000 THEN 'r_mid'
            WHEN o_totalprice < 300000 THEN 'r_high' ELSE 'r_rest' END AS part,
       CAST(count(*) AS BIGINT) AS rows
FROM orders GROUP BY 1""")
def q_stream_load(spark, d):
    from ...streaming import load_stream
    path = scratch_path(spark, "stream-load")
    load_stream(_stream_of(spark, d, "orders"), PRICE_RANGES, path).awaitTermination()
    return spark.read.parquet(path).groupBy("part").agg(F.count(F.lit(1)).alias("rows"))


@query("stream_statement_results", """
WITH ch AS (SELECT CASE event_type WHEN 'signup' THEN 'INSERT' WHEN 'purchase' THEN 'UPDATE' ELSE 'OTHER' END AS op,
                   CAST(round(value * 100) AS BIGINT) AS cents FROM events),
e(op) AS (VALUES ('INSERT'), ('UPDATE'), ('DELETE'))
SELECT CAST(0 AS BIGINT) AS batch, e.op, CAST(count(ch.op) AS BIGINT) AS n_rows,
       CAST(coalesce(sum(ch.cents), 0) AS BIGINT) AS cents
FROM e LEFT JOIN ch ON ch.op = e.op GROUP BY e.op""")
def q_stream_statement_results(spark, d):
    from ...streaming import statement_results_stream
    changes = _stream_of(spark, d, "events").selectExpr(
        "CASE event_type WHEN 'signup' THEN 'INSERT' WHEN 'purchase' THEN 'UPDATE' ELSE 'OTHER' END AS op",
        "CAST(round(value * 100) AS BIGINT) AS cents")
    path = scratch_path(spark, "stream-statements")
    statement_results_stream(changes, ["INSERT", "UPDATE", "DELETE"],
                             {"n_rows": F.count(F.lit(1)), "cents": F.sum("cents")}, path).awaitTermination()
    out = spark.read.parquet(path)
    return out.select(F.col("batch").cast("bigint").alias("batch"), "op",
                      F.coalesce("n_rows", F.lit(0)).cast("bigint").alias("n_rows"),
                      F.coalesce("cents", F.lit(0)).cast("bigint").alias("cents"))
