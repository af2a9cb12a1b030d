"""Numbers in blocks, working columns that clash, bucketed tables, changes through a view, index expressions."""

import pytest
from pyspark.sql import functions as F

from tableload.operators import integrity, relops, rewrite, routing, sequences
from tableload.plans import materialize as mat
from tableload.plans.migrate import plan_from_snapshot
from tableload.specs import KeySpec, Partition, PartitionLevel, SequenceSpec

from .conftest import rows


# --------------------------------------------------------------------------- sequences

@pytest.mark.parametrize("cache, parts", [(1, 5), (7, 3), (1000, 4), (3, 1)])
def test_blocks_are_unique_and_need_no_exchange(spark, cache, parts):
    df = spark.range(0, 500, 1, parts)
    seq = SequenceSpec("s", increment_by=-2, last_value=1, min_value=-10 ** 6, max_value=100, cache_size=cache)
    out = sequences.assign_sequence_blocks(df, seq, "n")
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    numbers = [r["id2"] for r in sequences.assign_sequence_blocks(df, seq, "id2").collect()]
    assert len(set(numbers)) == 500 and all(n <= -1 and n % 2 == 1 for n in numbers)
    # within a task: runs of cache numbers
    first = [r["id2"] for r in sequences.assign_sequence_blocks(df, seq, "id2").filter(F.spark_partition_id() == 0).collect()]
    assert first[:min(cache, 100)] == [-1 - 2 * i for i in range(min(cache, len(first), 100))]


def test_blocks_refuse_what_cannot_be_unique(spark):
    df = spark.range(0, 100, 1, 4).toDF("k")
    with pytest.raises(ValueError, match="cycles"):
        sequences.assign_sequence_blocks(df, SequenceSpec("s", cyclical=True))
    with pytest.raises(ValueError, match="CACHE"):
        sequences.assign_sequence_blocks(df, SequenceSpec("s", cache_size=0))
    with pytest.raises(Exception, match="reached the end"):
        sequences.assign_sequence_blocks(df, SequenceSpec("s", max_value=90, cache_size=10)).collect()
    with pytest.raises(Exception, match="more than 2 tasks"):
        sequences.assign_sequence_blocks(df, SequenceSpec("s"), writers=2).collect()
    assert sequences.assign_sequence_blocks(df.limit(0), SequenceSpec("s")).count() == 0


def test_numbering_survives_columns_with_working_names(spark):
    names = ["k", "_pid", "_pos", "_mid", "_all", "_cnt", "_off", "_g0", "_first", "_seq_ord"]
    df = spark.createDataFrame([tuple([i] + [i * 10] * 9) for i in range(20)], ", ".join(f"{n} int" for n in names))
    out = sequences.assign_sequence(df, [("k", True)], SequenceSpec("s", last_value=5))
    assert out.columns == [*names, "id"] and rows(out, "k", "id", "_pid") == [(i, 25 - i, i * 10) for i in range(20)]
    grouped = sequences.ordered_group_rows(df.withColumn("k", F.col("k") % 3), ["k"], ["_pos"])
    assert grouped.columns == [*names, "ordinal"]
    assert rows(grouped, "_all", "ordinal") == [(i * 10, i // 3) for i in range(20)]
    with pytest.raises(ValueError, match="already"):
        sequences.assign_sequence_blocks(df, SequenceSpec("s"), "_pid")


# --------------------------------------------------------------------------- buckets

def test_joins_and_groups_of_bucketed_tables_need_no_exchange(spark, tmp_path):
    left = spark.range(0, 300).selectExpr("id AS a", "id % 7 AS v")
    right = spark.range(0, 900).selectExpr("id % 300 AS b", "id AS w")
    mat.materialize_bucketed(left, ["a"], 4, f"{tmp_path}/l", "tl_bucket_left")
    mat.materialize_bucketed(right, ["b"], 4, f"{tmp_path}/r", "tl_bucket_right")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.table("tl_bucket_left").join(spark.table("tl_bucket_right"), F.col("a") == F.col("b"))
        counted = joined.groupBy("a").agg(F.sum("w").alias("s"))
        plan = counted._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Join" in plan
        assert counted.count() == 300
        # the bucket file of a row is the one that bucket_hash names
        level = PartitionLevel("HASH", "a", tuple(Partition(f"p{i}", (str(i),)) for i in range(4)))
        placed = routing.route(spark.table("tl_bucket_left"), level, hash_fn=routing.bucket_hash).select(
            "part", F.regexp_extract(F.input_file_name(), r"_(\d{5})\.", 1).cast("int").alias("bucket")).distinct()
        assert rows(placed) == [(f"p{i}", i) for i in range(4)]
        with pytest.raises(FileExistsError):
            mat.materialize_bucketed(left, ["a"], 4, f"{tmp_path}/other", "tl_bucket_left")
        with pytest.raises(Exception):
            mat.materialize_bucketed(left.withColumn("x", F.raise_error(F.lit("stop"))), ["a"], 4, f"{tmp_path}/bad", "tl_bucket_bad")
        assert not spark.catalog.tableExists("tl_bucket_bad") and not mat.path_exists(spark, f"{tmp_path}/bad")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        for t in ("tl_bucket_left", "tl_bucket_right"):
            spark.sql(f"DROP TABLE IF EXISTS {t}")


# --------------------------------------------------------------------------- views

def test_changes_through_a_view(spark):
    base = spark.createDataFrame([(1, "a", 7), (2, "b", 8), (3, None, 9), (None, "n", 1)], "c1 int, c2 string, c3 int")
    changes = spark.createDataFrame([("UPDATE", 10, 60, "x"), ("DELETE", 20, None, None), ("INSERT", None, 50, "new"),
                                     ("UPDATE", 990, 10, "none"), ("DELETE", None, None, None)],
                                    "op string, was int, v int, t string")
    run = lambda ch, **more: rows(rewrite.instead_of_changes(
        ch, {"c1": "v div 10", "c2": "t"}, base, ["c1"], old_keys={"c1": "was div 10"}, **more))
    assert run(changes, defaults={"c3": "0"}) == [(3, None, 9), (5, "new", 0), (6, "x", 7), (None, "n", 1)]
    assert run(changes, events=["DELETE"]) == [(1, "a", 7), (3, None, 9), (None, "n", 1)]
    assert run(changes.limit(0)) == rows(base)
    with pytest.raises(Exception, match="twice"):
        run(changes.unionByName(changes.filter("was = 10")))


# --------------------------------------------------------------------------- index expressions

def test_index_columns_say_whether_they_are_expressions(spark):
    schema = "schema string, table_name string"
    snapshot = {
        "tables": spark.createDataFrame([("s", "t", "t", True)], schema + ", orig_table string, migrate boolean"),
        "columns": spark.createDataFrame([("s", "t", "k", 1, "int", "k", True, None), ("s", "t", "upper(v)", 2, "string", "v", True, None)],
                                         schema + ", column_name string, position int, type_name string, orig_column string, "
                                         "nullable boolean, default_value string"),
        "indexes": spark.createDataFrame([("s", "t", "u1", True, None, True), ("s", "t", "u2", True, None, True), ("s", "t", "n1", False, None, True)],
                                         schema + ", index_name string, uniqueness boolean, where_clause string, migrate boolean"),
        "index_columns": spark.createDataFrame(
            [("s", "t", "u1", 1, False, True, "k % 10"), ("s", "t", "u2", 1, False, False, "upper(v)"), ("s", "t", "n1", 1, True, True, "k % 7"),
             ("s", "t", "n1", 2, False, False, "upper(v)")],
            schema + ", index_name string, position int, descend boolean, is_expression boolean, column_name string")}
    (plan,) = plan_from_snapshot(snapshot)
    keys = {k.name: k for k in plan.keys}
    assert keys["u1"].expressions == (True,) and keys["u2"].expressions == (False,)
    df = spark.createDataFrame([(i, f"v{i % 4}") for i in range(13)], "k int, `upper(v)` string")
    got = {r["constraint_name"]: r["violations"] for r in integrity.constraint_report(
        spark, [integrity.TableRules("t", df, keys=tuple(plan.keys))]).collect()}
    assert got == {"u1": 6, "u2": 13}                    # the column of that odd name, not a function of v
    ((_, order, _),) = plan.clusterings
    listed = df.orderBy(*relops.sort_columns(order, df)).collect()
    assert [r["k"] % 7 for r in listed] == sorted((i % 7 for i in range(13)), reverse=True)


def test_key_spec_without_flags_still_reads_text_by_name(spark):
    df = spark.createDataFrame([("a",), ("A",)], "v string")
    rules = integrity.TableRules("t", df, keys=(KeySpec("u", ("lower(v)",)), KeySpec("w", ("v",))))
    assert {r["constraint_name"]: r["violations"] for r in integrity.constraint_report(spark, [rules]).collect()} == {"u": 2, "w": 0}
