"""The expectations of the source project's own test suite, on its tiny fixtures.

The fixture rows are stated here as text in the source's COPY text format and loaded
through ``scan_delimited``; the staging specs are the ones its setup declares.
"""

import os

import pytest
from pyspark.sql import functions as F

from tableload.functions.sqlfuncs import FunctionSpec, register_functions
from tableload.operators import filters, integrity, relops, rewrite, routing, sequences
from tableload.plans import materialize as mat
from tableload.sources import scan_delimited
from tableload.specs import (CheckSpec, ColumnSpec, ForeignKeySpec, KeySpec, Partition, PartitionLevel,
                             PartitionScheme, SequenceSpec)

from .conftest import rows

# The fixture data files (tab separated, one row per line).
T1_DAT = "1\n2\n3\n4\n5\n"
PT1_DAT = "0\n1\n2\n"
PT2_DAT = ("1\tLorem ipsum dolor.\n1\tSed rutrum suscipit.\n50\tIn hac habitasse.\n"
           "50\tOrci varius natoque.\n100\tAliquam non nibh.\n100\tAenean efficitur congue.\n")

PT1 = PartitionLevel("LIST", "c1", (Partition("pt1_1", ("1",)), Partition("pt1_def", None, True)))
PT2 = PartitionScheme(
    PartitionLevel("RANGE", "r1", (Partition("pt2_a", ("MINVALUE", "10")),
                                   Partition("pt2_b", ("10", "100")),
                                   Partition("pt2_c", ("100", "MAXVALUE")))),
    {p: PartitionLevel("HASH", "h1", tuple(Partition(f"{p}_{i + 1}", (str(i),)) for i in range(3)))
     for p in ("pt2_a", "pt2_b", "pt2_c")})


def _load(spark, tmp_path, name, text, cols):
    path = os.path.join(str(tmp_path), f"{name}.dat")
    with open(path, "w") as f:
        f.write(text)
    return scan_delimited(spark, path, cols)


@pytest.fixture()
def t1(spark, tmp_path):
    return _load(spark, tmp_path, "t1", T1_DAT, [ColumnSpec("c1", "int", 1)])


@pytest.fixture()
def pt1(spark, tmp_path):
    return _load(spark, tmp_path, "pt1", PT1_DAT, [ColumnSpec("c1", "int", 1, nullable=False)])


@pytest.fixture()
def pt2(spark, tmp_path):
    return _load(spark, tmp_path, "pt2", PT2_DAT,
                 [ColumnSpec("r1", "int", 1), ColumnSpec("h1", "varchar(100)", 2)])


def test_row_copy(spark, t1, tmp_target):
    path = mat.materialize_table(t1, tmp_target)
    assert rows(spark.read.parquet(path)) == [(1,), (2,), (3,), (4,), (5,)]


def test_list_routing(pt1):
    r = routing.route(pt1, PT1)
    assert rows(r.filter("part = 'pt1_1'"), "c1") == [(1,)]
    assert rows(r.filter("part = 'pt1_def'"), "c1") == [(0,), (2,)]


def test_range_routing_lower_bound_inclusive(pt2):
    r = routing.route(pt2, PT2)
    assert rows(r.select("r1", "part").distinct()) == [(1, "pt2_a"), (50, "pt2_b"), (100, "pt2_c")]


def test_hash_routing_one_bucket_per_key(pt2):
    r = routing.route(pt2, PT2)
    per_key = r.groupBy("h1").agg(F.countDistinct("subpart").alias("n")).collect()
    assert all(x["n"] == 1 for x in per_key)
    assert r.count() == 6
    assert all(s.startswith(p) for p, s in r.select("part", "subpart").collect())


def test_partitioned_load_and_counts(spark, pt2, tmp_target):
    path = mat.materialize_partitioned(pt2, PT2, tmp_target)
    back = spark.read.parquet(path)
    assert back.count() == 6
    counts = routing.partition_counts(routing.route(pt2, PT2), PT2)
    assert counts.count() == 9                         # every declared subpartition, empty ones too
    assert counts.agg(F.sum("rows")).first()[0] == 6


def test_key_columns_in_position_order(spark):
    keys = spark.createDataFrame(
        [("sch1", "t1", "t1_pk", "c1", 1, True, True), ("sch1", "t2", "t2_pk_ignored", "c1", 1, True, False),
         ("sch1", "t2", "t2_uk", "c1", 1, False, True), ("part1", "pt1", "pt1_pk", "c1", 1, True, True),
         ("part1", "pt2", "pt2_pk", "h1", 2, True, True), ("part1", "pt2", "pt2_pk", "r1", 1, True, True)],
        "schema string, table_name string, constraint_name string, column_name string, position int, "
        "is_primary boolean, migrate boolean")
    flagged = keys.filter("migrate")
    g = relops.ordered_group_collect(flagged, ["schema", "table_name", "constraint_name"], ["position"],
                                     ["column_name"])
    got = {r["constraint_name"]: r["column_name"] for r in g.collect()}
    assert got["pt2_pk"] == ["r1", "h1"]
    assert "t2_pk_ignored" not in got


def test_unflagged_index_ignored(spark):
    tables = spark.createDataFrame([("sch1", "t1", True), ("sch1", "t2", True)],
                                   "schema string, table_name string, migrate boolean")
    indexes = spark.createDataFrame(
        [("sch1", "t1", "t1_idx1_nonunique", False, None, True), ("sch1", "t1", "t1_idx2_unique", True, None, True),
         ("sch1", "t1", "t1_idx3_ignored", False, None, False), ("sch1", "t2", "t2_idx1_filtered", False, "(c1 = 1)", True)],
        "schema string, table_name string, index_name string, uniqueness boolean, where_clause string, migrate boolean")
    kept = filters.flagged_only(indexes, tables, ["schema", "table_name"], own_flag="migrate")
    names = {r["index_name"] for r in kept.collect()}
    assert names == {"t1_idx1_nonunique", "t1_idx2_unique", "t2_idx1_filtered"}


def test_constraints_on_fixture_tables(spark, t1):
    t2 = spark.createDataFrame([], "c1 int, t1_c1 int")          # no data file: loads empty
    report = integrity.constraint_report(spark, [
        integrity.TableRules("t1", t1, keys=(KeySpec("t1_pk", ("c1",), primary=True),)),
        integrity.TableRules(
            "t2", t2, not_null=("c1",),
            keys=(KeySpec("t2_pk_ignored", ("c1",), primary=True, migrate=False), KeySpec("t2_uk", ("c1",))),
            foreign_keys=(ForeignKeySpec("t2_fk", ("t1_c1",), "t1", ("c1",)),),
            checks=(CheckSpec("t2_ck", "(c1 BETWEEN 1 AND 100)"),), parents={"t1": t1}),
    ])
    got = {r["constraint_name"]: (r["constraint_type"], r["violations"]) for r in report.collect()}
    assert got == {"t1_pk": ("PRIMARY KEY", 0), "t2_uk": ("UNIQUE", 0), "t2_fk": ("FOREIGN KEY", 0),
                   "c1_not_null": ("NOT NULL", 0), "t2_ck": ("CHECK", 0)}


def test_default_applies_to_absent_column(spark):
    from tableload.operators.project import apply_column_defaults
    rows_in = spark.createDataFrame([(7,)], "t1_c1 int")
    out = apply_column_defaults(rows_in, [ColumnSpec("c1", "int", 1, default="1"), ColumnSpec("t1_c1", "int", 2)])
    assert out.collect()[0].asDict() == {"c1": 1, "t1_c1": 7}


def test_functions_view_and_instead_of_trigger(spark, t1):
    register_functions(spark, [
        FunctionSpec("multiply", (("a", "int"), ("b", "int")), "int", "a * b", migrate=True),
        FunctionSpec("divide", (("a", "int"), ("b", "int")), "int", "a div b", migrate=True)])
    t1.createOrReplaceTempView("sch1_t1")
    v1 = rewrite.define_view(spark, "sch1_v1", "SELECT multiply(c1, 10) FROM sch1_t1", ["c1"])
    assert rows(v1) == [(10,), (20,), (30,), (40,), (50,)]
    inserted = spark.createDataFrame([(60,)], "c1 int")
    base = rewrite.instead_of_insert(inserted, {"c1": "divide(c1, 10)"}, t1)
    assert 6 in [r[0] for r in base.collect()]
    base.createOrReplaceTempView("sch1_t1")
    top = spark.sql("SELECT c1 FROM sch1_v1 ORDER BY c1 DESC LIMIT 1").collect()[0][0]
    assert top == 60


def test_sequence_starts_after_last_value(spark):
    df = spark.range(3).toDF("k")
    s1 = sequences.assign_sequence(df, ["k"], SequenceSpec("seq1", 1, last_value=1, min_value=1, max_value=100))
    s2 = sequences.assign_sequence(df, ["k"], SequenceSpec("seq2", 10, last_value=10, min_value=1, max_value=100))
    assert [r["id"] for r in s1.orderBy("k").collect()] == [2, 3, 4]
    assert [r["id"] for r in s2.orderBy("k").collect()] == [20, 30, 40]
