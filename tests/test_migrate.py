"""The one-shot run over the source suite's fixtures: snapshot in, tables, views and a
constraint report out."""

import os

import pytest
from pyspark.sql import functions as F

from tableload.functions.sqlfuncs import FunctionSpec
from tableload.plans.migrate import migrate, plan_from_snapshot, sequences_from_snapshot
from tableload.operators.sequences import assign_sequence
from tableload.sources import scan_delimited

from .conftest import rows
from .test_reference_fixtures import PT1_DAT, PT2_DAT, T1_DAT

FILES = {("sch1", "t1"): T1_DAT, ("part1", "pt1"): PT1_DAT, ("part1", "pt2"): PT2_DAT}


def snapshot(spark, t2_check="(c1 BETWEEN 1 AND 100)"):
    def df(rows_, schema):
        return spark.createDataFrame(rows_, schema)
    return {
        "tables": df([("sch1", "t1", "t1", True), ("sch1", "t2", "t2", True), ("part1", "pt1", "pt1", True),
                      ("part1", "pt2", "pt2", True)], "schema string, table_name string, orig_table string, migrate boolean"),
        "columns": df([("sch1", "t1", "c1", "c1", 1, "int", True, None), ("sch1", "t2", "c1", "c1", 1, "int", False, "1"),
                       ("sch1", "t2", "t1_c1", "t1_c1", 2, "int", True, None),
                       ("sch1", "v1", "c1", "c1", 1, "int", False, None),
                       ("part1", "pt1", "c1", "c1", 1, "int", False, None),
                       ("part1", "pt2", "r1", "r1", 1, "int", False, None),
                       ("part1", "pt2", "h1", "h1", 2, "varchar(100)", False, None)],
                      "schema string, table_name string, column_name string, orig_column string, position int, "
                      "type_name string, nullable boolean, default_value string"),
        "partitions": df([("part1", "pt1", "pt1_1", "LIST", "c1", False, ["1"]),
                          ("part1", "pt1", "pt1_def", "LIST", "c1", True, None),
                          ("part1", "pt2", "pt2_a", "RANGE", "r1", False, ["MINVALUE", "10"]),
                          ("part1", "pt2", "pt2_b", "RANGE", "r1", False, ["10", "100"]),
                          ("part1", "pt2", "pt2_c", "RANGE", "r1", False, ["100", "MAXVALUE"])],
                         "schema string, table_name string, partition_name string, type string, key string, "
                         "is_default boolean, values array<string>"),
        "subpartitions": df([("part1", "pt2", p, f"{p}_{i + 1}", "HASH", "h1", False, [str(i)])
                             for p in ("pt2_a", "pt2_b", "pt2_c") for i in range(3)],
                            "schema string, table_name string, partition_name string, subpartition_name string, "
                            "type string, key string, is_default boolean, values array<string>"),
        "keys": df([("sch1", "t1", "t1_pk", False, False, "c1", 1, True, True),
                    ("sch1", "t2", "t2_pk_ignored", False, False, "c1", 1, True, False),
                    ("sch1", "t2", "t2_uk", False, False, "c1", 1, False, True),
                    ("part1", "pt1", "pt1_pk", False, False, "c1", 1, True, True),
                    ("part1", "pt2", "pt2_pk", False, False, "r1", 1, True, True),
                    ("part1", "pt2", "pt2_pk", False, False, "h1", 2, True, True)],
                   "schema string, table_name string, constraint_name string, deferrable boolean, deferred boolean, "
                   "column_name string, position int, is_primary boolean, migrate boolean"),
        "foreign_keys": df([("sch1", "t2", "t2_fk", False, False, "NO ACTION", "t1_c1", 1, "sch1", "t1", "c1", True)],
                           "schema string, table_name string, constraint_name string, deferrable boolean, "
                           "deferred boolean, delete_rule string, column_name string, position int, "
                           "remote_schema string, remote_table string, remote_column string, migrate boolean"),
        "checks": df([("sch1", "t2", "t2_ck", False, False, t2_check, True)],
                     "schema string, table_name string, constraint_name string, deferrable boolean, "
                     "deferred boolean, condition string, migrate boolean"),
        "indexes": df([("sch1", "t1", "t1_idx1_nonunique", False, None, True),
                       ("sch1", "t1", "t1_idx2_unique", True, None, True),
                       ("sch1", "t1", "t1_idx3_ignored", False, None, False),
                       ("sch1", "t2", "t2_idx1_filtered", False, "(c1 = 1)", True)],
                      "schema string, table_name string, index_name string, uniqueness boolean, "
                      "where_clause string, migrate boolean"),
        "index_columns": df([("sch1", "t1", i, 1, False, False, "c1") for i in
                             ("t1_idx1_nonunique", "t1_idx2_unique", "t1_idx3_ignored")]
                            + [("sch1", "t2", "t2_idx1_filtered", 1, False, False, "c1")],
                            "schema string, table_name string, index_name string, position int, descend boolean, "
                            "is_expression boolean, column_name string"),
        "views": df([("sch1", "v1", "SELECT multiply(c1, 10) FROM t1", True)],
                    "schema string, view_name string, definition string, migrate boolean"),
    }


FUNCTIONS = [FunctionSpec("multiply", (("a", "int"), ("b", "int")), "int", "a * b", migrate=True),
             FunctionSpec("divide", (("a", "int"), ("b", "int")), "int", "a div b", migrate=True)]


@pytest.fixture()
def read_table(spark, tmp_path):
    def read(schema, table, columns):
        text = FILES.get((schema, table))
        if text is None:                       # no data file: the table loads empty
            return spark.createDataFrame([], ", ".join(f"{c.name} {c.type_name}" for c in columns))
        path = os.path.join(str(tmp_path), f"{schema}.{table}.dat")
        with open(path, "w") as f:
            f.write(text)
        return scan_delimited(spark, path, columns)
    return read


def test_plan_from_snapshot(spark):
    plans = {p.qualified: p for p in plan_from_snapshot(snapshot(spark))}
    assert set(plans) == {"sch1.t1", "sch1.t2", "part1.pt1", "part1.pt2"}
    pt2 = plans["part1.pt2"]
    assert [c.name for c in pt2.columns] == ["r1", "h1"]
    assert [k.columns for k in pt2.keys] == [("r1", "h1")]
    assert set(pt2.scheme.sub) == {"pt2_a", "pt2_b", "pt2_c"}
    assert {k.name for k in plans["sch1.t1"].keys} == {"t1_pk", "t1_idx2_unique"}
    assert {k.name for k in plans["sch1.t2"].keys} == {"t2_uk"}
    assert plans["sch1.t1"].clusterings == [("t1_idx1_nonunique", [("c1", False)], None)]
    assert plans["sch1.t2"].clusterings == [("t2_idx1_filtered", [("c1", False)], "(c1 = 1)")]


def test_migrate_fixture_run(spark, tmp_path, read_table):
    failures, log, report = migrate(spark, snapshot(spark), read_table, str(tmp_path / "db"), parallelism=2,
                                    functions=FUNCTIONS)
    assert failures == 0 and log.count() == 0
    assert rows(report.select("constraint_name", "violations")) == sorted(
        [("t1_pk", 0), ("t1_idx2_unique", 0), ("t2_uk", 0), ("t2_fk", 0), ("c1_not_null", 0), ("t2_ck", 0),
         ("pt1_pk", 0), ("c1_not_null", 0), ("pt2_pk", 0), ("r1_not_null", 0), ("h1_not_null", 0)])
    assert rows(spark.table("v1")) == [(10,), (20,), (30,), (40,), (50,)]
    assert not os.path.exists(tmp_path / "idx")          # clustered copies are opt-in


def test_migrate_writes_clustered_index_copies(spark, tmp_path, read_table):
    failures, log, _ = migrate(spark, snapshot(spark), read_table, str(tmp_path / "db"), functions=FUNCTIONS,
                               cluster_root=str(tmp_path / "idx"))
    assert failures == 0
    assert rows(spark.read.parquet(str(tmp_path / "idx" / "sch1" / "t1_idx1_nonunique"))) == [(i,) for i in range(1, 6)]
    assert spark.read.parquet(str(tmp_path / "idx" / "sch1" / "t2_idx1_filtered")).count() == 0
    assert not os.path.exists(tmp_path / "idx" / "sch1" / "t1_idx3_ignored")
    pt1 = spark.read.parquet(str(tmp_path / "db" / "part1" / "pt1"))
    assert rows(pt1.select("part", "c1")) == [("pt1_1", 1), ("pt1_def", 0), ("pt1_def", 2)]


def test_migrate_logs_failures_and_goes_on(spark, tmp_path, read_table):
    snap = snapshot(spark, t2_check="c1 > 1")
    snap["views"] = spark.createDataFrame([("sch1", "broken", "SELECT nope FROM t1", True)],
                                          "schema string, view_name string, definition string, migrate boolean")
    snap["tables"] = snap["tables"].unionByName(spark.createDataFrame(
        [("sch1", "t3", "t3", True)], "schema string, table_name string, orig_table string, migrate boolean"))
    snap["columns"] = snap["columns"].unionByName(spark.createDataFrame(
        [("sch1", "t3", "c1", "c1", 1, "int", True, None)], snap["columns"].schema))

    def read(schema, table, columns):
        if table == "t3":
            return spark.createDataFrame([("x",)], "c1 string").select(F.col("c1").cast("int"))
        return read_table(schema, table, columns)
    failures, log, _ = migrate(spark, snap, read, str(tmp_path / "db2"), functions=FUNCTIONS)
    ops = sorted(r["operation"] for r in log.collect())
    assert failures == 2 and ops == ["define view", "materialize table"]
    assert os.path.exists(tmp_path / "db2" / "sch1" / "t1")
    assert not os.path.exists(tmp_path / "db2" / "sch1" / "t3")


def test_sequences_from_snapshot(spark):
    seqs = spark.createDataFrame(
        [("sch1", "seq1", 1, 100, 1, False, 10, 1, 1), ("sch1", "seq2", 1, 100, 10, False, 1, 10, 10)],
        "schema string, sequence_name string, min_value bigint, max_value bigint, increment_by bigint, "
        "cyclical boolean, cache_size int, last_value bigint, orig_value bigint")
    specs = sequences_from_snapshot({"sequences": seqs})
    rows_ = spark.range(3).toDF("k")
    assert [r["id"] for r in assign_sequence(rows_, ["k"], specs["sch1.seq1"]).orderBy("k").collect()] == [2, 3, 4]
    assert [r["id"] for r in assign_sequence(rows_, ["k"], specs["sch1.seq2"]).orderBy("k").collect()] == [20, 30, 40]


def test_run_migration_script(spark, tmp_path):
    import importlib.util
    snap_dir = tmp_path / "snapshot"
    for name, df in snapshot(spark).items():
        df.write.parquet(str(snap_dir / name))
    src = tmp_path / "src"
    for (schema, table), text in FILES.items():
        os.makedirs(src / schema, exist_ok=True)
        (src / schema / f"{table}.dat").write_text(text)
    (src / "sch1" / "t2.dat").write_text("1\t1\n2\t\\N\n")          # t2 gets rows this time
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts", "run_migration.py")
    mod_spec = importlib.util.spec_from_file_location("run_migration", path)
    mod = importlib.util.module_from_spec(mod_spec)
    mod_spec.loader.exec_module(mod)
    for f in ("multiply", "divide"):                 # other tests may have created them
        spark.sql(f"DROP TEMPORARY FUNCTION IF EXISTS {f}")
    target = tmp_path / "target"
    status = mod.main(["--snapshot", str(snap_dir), "--source", str(src) + "/{schema}/{table}.dat",
                       "--format", "copy", "--target", str(target), "--parallelism", "2"])
    # views name functions the script does not create: the view step fails and is logged
    assert status == 1
    log = spark.read.parquet(str(target / "_log"))
    assert [r["operation"] for r in log.collect()] == ["define view"]
    report = {r["constraint_name"]: r["violations"] for r in spark.read.parquet(str(target / "_report")).collect()}
    assert report["t2_fk"] == 0 and report["t2_uk"] == 0
    assert rows(spark.read.parquet(str(target / "sch1" / "t2"))) == [(1, 1), (2, None)]
    # with the functions supplied the whole flow succeeds
    fn_file = tmp_path / "functions.json"
    fn_file.write_text('[{"name": "multiply", "args": [["a", "int"], ["b", "int"]], "returns": "int", '
                       '"body": "a * b"}]')
    status = mod.main(["--snapshot", str(snap_dir), "--source", str(src) + "/{schema}/{table}.dat",
                       "--format", "copy", "--target", str(tmp_path / "target2"), "--functions", str(fn_file)])
    assert status == 0 and rows(spark.table("v1")) == [(10,), (20,), (30,), (40,), (50,)]
