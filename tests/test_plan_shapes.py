"""The physical-plan properties the design relies on (see PLANS.md), checked on final plans."""

from pyspark.sql import functions as F

from tableload.operators import integrity, relops, routing, sequences, upsert
from tableload.plans import registered as R
from tableload.plans.materialize import assert_routed
from tableload.specs import SequenceSpec

from .conftest import SF_SMALL


def final_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_fk_check_aggregates_before_the_exchange(spark):
    child = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    parent = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    plan = final_plan(integrity.foreign_key_violations(child, ["l_orderkey"], parent, ["o_orderkey"]))
    assert "partial_count" in plan                   # map-side pre-aggregation of the child keys
    assert "LeftAnti" not in plan                    # the lookup was not pushed below the aggregate


def test_sequence_numbering_has_no_window_over_the_data(spark):
    df = spark.read.parquet(f"{SF_SMALL}/customer.parquet").select("c_custkey")
    plan = final_plan(sequences.assign_sequence(df, ["c_custkey"], SequenceSpec("s", 1, last_value=0)))
    assert "rangepartitioning" not in plan                      # positions are read back, not computed twice
    assert "Window" not in plan.split("BroadcastExchange")[0]


def test_partitioned_write_rebalances(spark):
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    routed = assert_routed(routing.route(orders, R.ORDERS_SCHEME), R.ORDERS_SCHEME).hint("rebalance", "part",
                                                                                         "subpart")
    plan = routed._jdf.queryExecution().executedPlan().toString()
    assert "REBALANCE_PARTITIONS_BY_COL" in plan
    assert plan.count("Exchange") == 1


def test_routing_needs_no_exchange(spark):
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    for level in (R.MANY_RANGES, R.COMPOSITE_RANGES, R.PRIORITY_LIST.__class__("LIST", "o_orderpriority",
                                                                                R.PRIORITY_LIST.partitions)):
        plan = final_plan(routing.route(orders, level).select("o_orderkey", "part"))
        assert "Exchange" not in plan and "Join" not in plan


def test_sibling_count_has_no_window(spark):
    part = spark.read.parquet(f"{SF_SMALL}/part.parquet").select("p_partkey", "p_brand")
    plan = final_plan(relops.sibling_count(part, ["p_brand"]))
    assert "Window" not in plan and "partial_count" in plan


def test_small_source_upsert_broadcasts_its_keys(spark):
    target = spark.read.parquet(f"{SF_SMALL}/customer.parquet").select("c_custkey", "c_name")
    source = target.filter(F.col("c_custkey") < 20).select("c_custkey", F.upper("c_name").alias("c_name"))
    plan = final_plan(upsert.upsert_update(target, source, ["c_custkey"], ["c_name"]))
    assert "LeftOuter" in plan and "LeftAnti" in plan and "BroadcastExchange" in plan


def test_declared_scan_prunes_and_pushes(spark):
    df = R.QUERIES["scan_declared"](spark, SF_SMALL).filter("total > 1000").select("order_id")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in plan
    assert "GreaterThan(o_totalprice,1000.0)" in plan
