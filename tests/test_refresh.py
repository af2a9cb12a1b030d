"""Catalog snapshot refresh: user edits survive, new objects arrive, clashes raise."""

import pytest
from pyspark.sql import functions as F

from tableload.plans.refresh import catalog_from_tables, refresh_snapshot, refresh_table

from .conftest import rows


def _remote(spark, with_extra_column=False):
    t1 = spark.createDataFrame([(1, "a")], "c1 int, name string")
    if with_extra_column:
        t1 = t1.withColumn("added", F.lit(1.5).cast("decimal(6,2)"))
    return catalog_from_tables(spark, {"t1": t1, "t2": spark.createDataFrame([(None,)], "x bigint")}, "Sch")


def test_initial_snapshot_and_refresh_keeps_edits(spark):
    snap = refresh_snapshot(None, _remote(spark), translate_identifier=F.lower)
    assert rows(snap["schemas"]) == [("sch", "Sch")]
    assert rows(snap["tables"], "schema", "table_name", "migrate") == [("sch", "t1", True), ("sch", "t2", True)]
    cols = {r["column_name"]: r for r in snap["columns"].collect()}
    assert cols["name"]["type_name"] == "string(1)" and cols["name"]["orig_type"] == "string"
    assert cols["x"]["nullable"] is True and cols["c1"]["options"] == "{}"

    # user edits: skip t2, change a type and a nullable flag
    edited = dict(snap)
    edited["tables"] = snap["tables"].withColumn("migrate", F.col("table_name") != "t2")
    edited["columns"] = snap["columns"].withColumn(
        "type_name", F.when(F.col("column_name") == "name", F.lit("text")).otherwise(F.col("type_name")))
    new = refresh_snapshot(edited, _remote(spark, with_extra_column=True), translate_identifier=F.lower)
    assert rows(new["tables"], "table_name", "migrate") == [("t1", True), ("t2", False)]
    cols = {r["column_name"]: r for r in new["columns"].collect()}
    assert cols["name"]["type_name"] == "text"                 # edit kept
    assert cols["added"]["type_name"] == "decimal(6,2)"        # new column arrives
    assert cols["added"]["position"] == 3 and cols["added"]["options"] == "{}"


def test_renamed_remote_column_clashes_on_position(spark):
    snap = refresh_snapshot(None, _remote(spark))
    renamed = spark.createDataFrame([(1, "z")], "c1 int, other string")
    remote = catalog_from_tables(spark, {"t1": renamed}, "Sch")
    with pytest.raises(ValueError, match="position"):
        refresh_table("columns", snap["columns"], remote["columns"]).collect()


def test_checks_sequences_partitions_and_schema_filter(spark):
    checks = spark.createDataFrame(
        [("s", "t", "ck1", False, False, "c > 0"), ("s", "t", "ck2", False, False, "c IS NOT NULL"),
         ("s", "t", "ck3", False, False, '"Odd Name" is not null'), ("s", "t", "ck4", False, False, "(c IS NOT NULL)"),
         ("other", "t", "ck5", False, False, "c > 1"), ("s", "t", "ck6", False, False, None),
         ("s", "t", "ck7", False, False, "c IS NOT NULL\n")],
        "schema string, table_name string, constraint_name string, deferrable boolean, deferred boolean, "
        "condition string")
    got = refresh_table("checks", None, checks, only_schemas=["s"])
    assert rows(got, "constraint_name", "migrate") == [("ck1", True), ("ck4", True), ("ck7", True)]

    seqs = spark.createDataFrame([("s", "q", "-1e30", "1e30", "1", True, 0, "41.5")],
                                 "schema string, sequence_name string, min_value string, max_value string, "
                                 "increment_by string, cyclical boolean, cache_size int, last_value string")
    seqs = seqs.select("schema", "sequence_name", *[F.col(c).cast("decimal(38,1)").alias(c)
                                                    for c in ("min_value", "max_value", "increment_by")],
                       "cyclical", "cache_size", F.col("last_value").cast("decimal(38,1)").alias("last_value"))
    r = refresh_table("sequences", None, seqs).first()
    assert (r["min_value"], r["max_value"], r["cache_size"], r["last_value"], r["orig_value"]) == \
        (-(2 ** 63), 2 ** 63 - 1, 1, 42, 42)

    parts = spark.createDataFrame([("s", "t", "p1", "LIST", "C1", False, ["'A'", "'B'"]),
                                   ("s", "t", "pdef", "LIST", "C1", True, None)],
                                  "schema string, table_name string, partition_name string, type string, "
                                  "key string, is_default boolean, values array<string>")
    got = refresh_table("partitions", None, parts, translate_expression=F.lower)
    assert rows(got, "partition_name", "key", "values") == [("p1", "c1", ["'a'", "'b'"]), ("pdef", "c1", None)]


def test_refresh_update_rules_for_keys(spark):
    remote = spark.createDataFrame([("s", "t", "pk", 1, False, False, "c1", True)],
                                   "schema string, table_name string, constraint_name string, position int, "
                                   "deferrable boolean, deferred boolean, column_name string, is_primary boolean")
    snap = refresh_table("keys", None, remote).withColumn("migrate", F.lit(False))
    changed = remote.withColumn("deferrable", F.lit(True))
    again = refresh_table("keys", snap, changed).first()
    assert again["deferrable"] is True and again["migrate"] is False


def test_repeated_refresh_with_lineage_cut(spark):
    snap = refresh_snapshot(None, _remote(spark), cut_lineage=True)
    for _ in range(3):
        snap = refresh_snapshot(snap, _remote(spark, with_extra_column=True), cut_lineage=True)
    assert snap["columns"].count() == 4
    assert "LogicalRDD" in snap["columns"]._jdf.queryExecution().optimizedPlan().toString()
