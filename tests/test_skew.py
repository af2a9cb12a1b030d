"""A third of all rows on one key: results stay whole and the hot key's work is spread."""

import pytest
from pyspark.sql import functions as F

from tableload.operators import integrity, relops, routing, sequences, upsert
from tableload.plans import materialize as mat
from tableload.specs import Partition, PartitionLevel, SequenceSpec

N = 90_000


@pytest.fixture(scope="module")
def hot(spark):
    # key 0 holds every third row; the other keys are unique
    return spark.range(N).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
                                 F.col("id").alias("v"))


@pytest.fixture()
def small_advisory(spark):
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    yield
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)


def _files_with(spark, path, cond):
    return spark.read.parquet(path).filter(cond).select(F.input_file_name()).distinct().count()


def test_key_checks_aggregate_hot_key(hot):
    pk = integrity.primary_key_violations(hot, ["k"]).collect()
    assert [(r["k"], r["rows"]) for r in pk] == [(0, N // 3)]
    sib = relops.sibling_count(hot, ["k"]).filter("k = 0").agg(F.min("siblings"), F.count(F.lit(1))).first()
    assert tuple(sib) == (N // 3, N // 3)


def test_fk_check_with_hot_orphan(spark, hot):
    parent = spark.range(1, N).toDF("pk")            # key 0 has no parent
    got = integrity.foreign_key_violations(hot, ["k"], parent, ["pk"]).collect()
    assert [(r["k"], r["rows"]) for r in got] == [(0, N // 3)]


def test_upsert_dedup_of_hot_source_key(spark, hot):
    target = spark.createDataFrame([(1, 1)], "k bigint, v bigint")
    out = upsert.upsert_ignore(target, hot, ["k"])
    assert out.count() == 1 + (N - N // 3)            # one row per distinct key
    assert out.filter("k = 0").first()["v"] == 0     # smallest row kept for the hot key


def test_clustered_copy_splits_hot_key(spark, hot, tmp_target, small_advisory):
    path = mat.clustered_copy(hot, ["k"], tmp_target, num_partitions=8)
    assert spark.read.parquet(path).count() == N
    assert _files_with(spark, path, "k = 0") > 1


def test_partitioned_write_splits_hot_partition(spark, hot, tmp_target, small_advisory):
    lvl = PartitionLevel("LIST", "k", (Partition("hot", ("0",)), Partition("rest", None, True)))
    path = mat.materialize_partitioned(hot, lvl, tmp_target)
    back = spark.read.parquet(path)
    assert back.count() == N
    assert _files_with(spark, path, "part = 'hot'") > 1


def test_dense_ordinal_spreads_hot_key(spark, hot):
    out = sequences.assign_sequence(hot, ["k"], SequenceSpec("s", 1, last_value=0), num_partitions=6)
    ids = out.select("id")
    assert ids.distinct().count() == N and ids.agg(F.min("id"), F.max("id")).first() == (1, N)
    per_task = out.filter("k = 0").groupBy(F.spark_partition_id()).count().count()
    assert per_task > 1
    hot_ids = out.filter("k = 0").agg(F.max("id")).first()[0]
    assert hot_ids == N // 3                          # key 0 sorts first: ids 1 .. N/3


def test_hash_routing_hot_key_single_bucket(hot):
    lvl = PartitionLevel("HASH", "k", tuple(Partition(f"h{i}", (str(i),)) for i in range(4)))
    r = routing.route(hot, lvl)
    assert r.filter("k = 0").select("part").distinct().count() == 1
    assert r.count() == N
