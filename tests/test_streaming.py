"""Streaming variants: micro-batches of a change set flowing into a partitioned table."""

import os

import pytest
from pyspark.sql import functions as F

from tableload.operators import routing
from tableload.specs import Partition, PartitionLevel, TriggerSpec
from tableload.streaming import load_stream, rewrite_stream, statement_results_stream

from .conftest import SF_SMALL, rows

LEVEL = PartitionLevel("RANGE", "o_totalprice", (Partition("lo", ("MINVALUE", "100000")),
                                                 Partition("hi", ("100000", "MAXVALUE"))))


def _source(spark, tmp_path):
    src = str(tmp_path / "incoming")
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet").selectExpr(
        "o_orderkey", "o_totalprice", "o_orderpriority",
        "CASE o_orderstatus WHEN 'F' THEN 'INSERT' ELSE 'UPDATE' END AS op")
    orders.repartition(3).write.parquet(src)
    return orders, spark.readStream.schema(orders.schema).option("maxFilesPerTrigger", 1).parquet(src)


def test_load_stream_routes_every_batch(spark, tmp_path):
    orders, stream = _source(spark, tmp_path)
    out = str(tmp_path / "table")
    q = load_stream(stream, LEVEL, out, checkpoint=str(tmp_path / "ckpt"))
    q.awaitTermination(120)
    back = spark.read.parquet(out)
    assert rows(back.groupBy("part").count()) == rows(routing.route(orders, LEVEL).groupBy("part").count())


def test_rewrite_and_statement_results_stream(spark, tmp_path):
    orders, stream = _source(spark, tmp_path)
    trg = TriggerSpec("big", "BEFORE", ("INSERT",), when="o_totalprice > 100000",
                      assignments=(("o_orderpriority", "'BIG'"),))
    rewritten = rewrite_stream(stream, [trg])
    out = str(tmp_path / "per_batch")
    q = statement_results_stream(rewritten, ["INSERT", "DELETE"],
                                 {"n": F.count(F.lit(1)), "big": F.count_if(F.col("o_orderpriority") == "BIG")},
                                 out, checkpoint=str(tmp_path / "ckpt2"))
    q.awaitTermination(120)
    res = spark.read.parquet(out)
    batches = {r["batch"] for r in res.select("batch").collect()}
    assert len(batches) == 3                                  # one file per trigger
    assert res.filter("op = 'DELETE'").filter("n IS NOT NULL").count() == 0   # fired, zero rows
    ins = orders.filter("op = 'INSERT'")
    assert res.filter("op = 'INSERT'").agg(F.sum("n")).first()[0] == ins.count()
    assert res.agg(F.sum("big")).first()[0] == ins.filter("o_totalprice > 100000").count()


def test_load_stream_batch_with_reject_commits_nothing(spark, tmp_path):
    src = str(tmp_path / "incoming")
    spark.createDataFrame([(1, 5.0), (2, 500000.0)], "o_orderkey bigint, o_totalprice double").write.parquet(src)
    stream = spark.readStream.schema("o_orderkey bigint, o_totalprice double").parquet(src)
    only_low = PartitionLevel("RANGE", "o_totalprice", (Partition("lo", ("MINVALUE", "100000")),))
    out = str(tmp_path / "table")
    q = load_stream(stream, only_low, out, checkpoint=str(tmp_path / "ckpt"))
    with pytest.raises(Exception):
        q.awaitTermination(120)
    committed = os.path.join(out, "_spark_metadata")
    assert not os.path.exists(committed) or not [f for f in os.listdir(committed) if not f.startswith(".")]
