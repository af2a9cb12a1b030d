"""Cases off the easy path of the operators: spellings, types, empty tables, clashing names."""

import pytest
from pyspark.sql import functions as F

from tableload.operators import integrity, project, relops, rewrite, routing, sequences, upsert
from tableload.plans import materialize as mat
from tableload.plans.migrate import migrate
from tableload.plans.refresh import refresh_table
from tableload.plans.runlog import Step, run_logged
from tableload.sources import scan_declared, scan_delimited
from tableload.specs import ColumnSpec, KeySpec, Partition, PartitionLevel, SequenceSpec

from .conftest import rows


def ranges(key, points, spell=str):
    return PartitionLevel("RANGE", key, tuple(Partition(f"p{i}", (spell(a), spell(b)))
                                              for i, (a, b) in enumerate(zip(points, points[1:]))))


@pytest.mark.parametrize("n", [3, 11])
def test_quoted_bounds_compare_as_the_key_does(spark, n):
    df = spark.createDataFrame([(k,) for k in (5, 99, 100, 950, 1000, 5000)], "k int")
    level = ranges("k", [0, 100, 1000] + [10_000 * i for i in range(1, n)], lambda x: f"'{x}'")
    assert dict(rows(routing.route(df, level))) == {5: "p0", 99: "p0", 100: "p1", 950: "p1", 1000: "p2", 5000: "p2"}


def test_more_partitions_move_no_row_of_the_others(spark):
    df = spark.range(0, 3000, 7).toDF("k")
    few = dict(rows(routing.route(df, ranges("k", [0, 500, 900]))))
    many = dict(rows(routing.route(df, ranges("k", [0, 500, 900] + list(range(1000, 3001, 100))))))
    assert all(many[k] == p for k, p in few.items() if p is not None)


@pytest.mark.parametrize("key, a, b", [
    ("d", ("DATE '2020-01-01'", "DATE '2020-06-01'"), ("'2020-05-01'", "'2020-07-01'")),
    ("k", ("'1'", "'100'"), ("'99'", "'200'")),
    ("k, s", ("(1, 'a')", "(2, 'b')"), ("(2, 'a')", "MAXVALUE")),
    ("k", ("5", "5"), ("7", "8"))])
def test_overlapping_and_empty_ranges_are_errors(spark, key, a, b):
    df = spark.createDataFrame([], "k int, s string, d date")
    with pytest.raises(ValueError, match="overlap|empty range"):
        routing.route(df, PartitionLevel("RANGE", key, (Partition("a", a), Partition("b", b))))


def test_routing_refuses_to_overwrite_a_column(spark, tmp_target):
    df = spark.createDataFrame([(1, "mine")], "k int, part string")
    with pytest.raises(ValueError, match="part"):
        mat.materialize_partitioned(df, ranges("k", [0, 10]), tmp_target)


def test_sequence_numbers_are_dense_with_maps_and_without_exchange_reuse(spark):
    df = spark.range(20_000).select(F.lit(1).alias("k"), F.create_map(F.lit("a"), F.col("id")).alias("m"))
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        ids = sequences.assign_sequence(df, ["k"], SequenceSpec("s", 1, last_value=0))
        assert ids.agg(F.count_distinct("id"), F.min("id"), F.max("id")).first() == (20_000, 1, 20_000)
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")


def test_group_rows_number_every_group(spark):
    df = spark.createDataFrame([("a", 3), ("a", 1), (None, 9), ("b", 2), ("a", 2), (None, 8)], "g string, v int")
    got = rows(sequences.ordered_group_rows(df, ["g"], ["v"]), "g", "v", "ordinal")
    assert got == [("a", 1, 0), ("a", 2, 1), ("a", 3, 2), ("b", 2, 0), (None, 8, 0), (None, 9, 1)]


def test_all_escapes_of_the_text_format(spark, tmp_path):
    path = str(tmp_path / "t.dat")
    raw = [r"\x41\101", r"\xc3\xa4\303\244", r"\\x41", r"a\tb\x9", r"\q\7z", r"\N", r"tail\\"]
    with open(path, "w") as f:
        f.write("".join(f"{i}\t{x}\n" for i, x in enumerate(raw)) + "\\.\n")
    cols = [ColumnSpec("i", "int", 1), ColumnSpec("s", "text", 2)]
    got = dict(rows(scan_delimited(spark, path, cols)))
    assert got == {0: "AA", 1: "ää", 2: r"\x41", 3: "a\tb\t", 4: "q\x07z", 5: None, 6: "tail\\"}
    with open(path, "w") as f:
        f.write("1\t\\xff\n")
    with pytest.raises(Exception, match="UTF"):
        scan_delimited(spark, path, cols).collect()


def test_fractions_round_on_the_way_to_integers(spark):
    df = spark.sql("SELECT 2.7D AS d, CAST(2.5 AS DECIMAL(3,1)) AS n, CAST(-2.5 AS DECIMAL(3,1)) AS m")
    specs = [(c, "int") for c in df.columns]
    assert rows(project.cast_checked(df, specs)) == [(3, 3, -3)]
    good, bad = project.cast_checked(df, specs, on_error="quarantine")
    assert rows(good) == [(3, 3, -3)] and bad.count() == 0
    with pytest.raises(Exception, match="invalid input"):
        project.cast_checked(spark.sql("SELECT 3e10D AS d"), [("d", "int")]).collect()


def test_csv_scan_checks_target_names(spark, tmp_path):
    path = str(tmp_path / "c.csv")
    with open(path, "w") as f:
        f.write("1,2\n")
    with pytest.raises(ValueError, match="same target"):
        scan_declared(spark, "csv", path, [ColumnSpec("z", "int", 1, "a"), ColumnSpec("z", "int", 2, "b")])
    long = scan_declared(spark, "csv", path, [ColumnSpec("x" * 70, "int", 1, "a"), ColumnSpec("y", "int", 2, "b")])
    assert long.columns == ["x" * 63, "y"]


def test_key_names_are_columns_before_they_are_sql(spark):
    df = spark.createDataFrame([(2, 1), (1, 1), (1, 2)], "`order id` int, `a+b` int")
    assert rows(integrity.unique_violations(df, ["order id"])) == [(1, 2)]
    report = integrity.constraint_report(spark, [integrity.TableRules("t", df, keys=(KeySpec("u", ("a+b",)),))])
    assert report.first()["violations"] == 2 and report.first()["error"] is None
    assert [r[0] for r in relops.ordered_listing(df, [("order id", True)]).collect()] == [2, 1, 1]


def test_null_keys_never_conflict_in_an_update(spark):
    t = spark.createDataFrame([(1, "a"), (None, "t")], "k int, v string")
    s = spark.createDataFrame([(None, "x"), (None, "y"), (1, "z")], "k int, v string")
    for how in ("eager", "in_job", False):
        got = rows(upsert.upsert_update(t, s, ["k"], ["v"], validate=how))
        assert got == [(1, "z"), (None, "t"), (None, "x"), (None, "y")]
    with pytest.raises(ValueError, match="duplicate"):
        upsert.require_unique_source(s.unionByName(s), ["k"])


def test_view_inserts_take_base_defaults(spark):
    base = spark.createDataFrame([(1, "old")], "c1 int, note string")
    new = rewrite.instead_of_insert(spark.createDataFrame([(20,)], "c1 int"), {"c1": "c1 div 10"}, base, {"note": "'new'"})
    assert rows(new) == [(1, "old"), (2, "new")]


def test_refresh_keeps_foreign_keys_with_both_ends(spark):
    fks = spark.createDataFrame(
        [("s1", "t", f"fk{i}", False, False, "NO ACTION", "c", 1, other, "p", "c") for i, other in enumerate(["s1", "s2"])],
        "schema string, table_name string, constraint_name string, deferrable boolean, deferred boolean, delete_rule string, "
        "column_name string, position int, remote_schema string, remote_table string, remote_column string")
    assert rows(refresh_table("foreign_keys", None, fks, only_schemas=["s1"]), "constraint_name") == [("fk0",)]


def test_steps_of_one_name_in_two_schemas(spark):
    done, log = run_logged(spark, [Step("load", "t", lambda: 1, "a"), Step("load", "t", lambda: 2, "b"),
                                   Step("load", "u", lambda: 3, "b")])
    assert done == {("a", "t"): 1, ("b", "t"): 2, "u": 3} and log.count() == 0
    _, log = run_logged(spark, [Step("load", "t", lambda: (_ for _ in ()).throw(ValueError("one\ntwo")), "a")])
    assert log.first()["error_message"] == "one\ntwo: ValueError"


def _two_schemas(spark):
    flags = "schema string, table_name string, orig_table string, migrate boolean"
    return {
        "tables": spark.createDataFrame([("a", "t", "t", True), ("b", "t", "t", True), ("b", "off", "off", False)], flags),
        "columns": spark.createDataFrame(
            [("a", "t", "k", "k", 1, "int", True, None), ("b", "t", "k", "k", 1, "int", True, None),
             ("a", "v", "shown", "shown", 1, "int", True, None), ("b", "off", "k", "k", 1, "int", True, None)],
            "schema string, table_name string, column_name string, orig_column string, position int, type_name string, "
            "nullable boolean, default_value string"),
        "partitions": spark.createDataFrame(
            [("b", "t", "p0", "RANGE", "k", False, ["0", "100"])],
            "schema string, table_name string, partition_name string, type string, key string, is_default boolean, "
            "values array<string>"),
        "foreign_keys": spark.createDataFrame(
            [("a", "t", "to_unflagged", False, False, "NO ACTION", "k", 1, "b", "off", "k", True)],
            "schema string, table_name string, constraint_name string, deferrable boolean, deferred boolean, "
            "delete_rule string, column_name string, position int, remote_schema string, remote_table string, "
            "remote_column string, migrate boolean"),
        "views": spark.createDataFrame([("a", "v", "SELECT * FROM t", True), ("b", "w", "SELECT * FROM t", True)],
                                       "schema string, view_name string, definition string, migrate boolean")}


@pytest.mark.parametrize("with_data", [True, False])
def test_one_shot_run_of_two_schemas_with_one_table_name(spark, tmp_path, with_data):
    def read(schema, table, columns):
        return spark.createDataFrame([(1 if schema == "a" else 2,)], "k int")
    failures, log, report = migrate(spark, _two_schemas(spark), read, str(tmp_path / "db"), with_data=with_data)
    assert failures == 0 and log.count() == 0 and report.count() == 0
    assert spark.table("v").columns == ["shown"] and spark.table("w").columns == ["k"]
    assert (rows(spark.table("v")), rows(spark.table("w"))) == (([(1,)], [(2,)]) if with_data else ([], []))


# --------------------------------------------------------------------------- list values and large specs

def test_list_values_are_compared_in_the_keys_type(spark):
    numbers = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    with pytest.raises(ValueError, match="listed in a and b"):
        routing.route(numbers, PartitionLevel("LIST", "k", (Partition("a", ("1",)), Partition("b", ("'1'",)))))
    with pytest.raises(ValueError, match="no value"):
        routing.route(numbers, PartitionLevel("LIST", "k", (Partition("a", ("'abc'",)),)))
    with pytest.raises(ValueError, match="NULL"):
        routing.route(numbers, PartitionLevel("LIST", "k", (Partition("a", ("NULL",)), Partition("b", ("null",)))))
    texts = spark.createDataFrame([("1",), ("abc",), ("it's",), ("a,b",), (None,)], "k string")
    level = PartitionLevel("LIST", "k", (Partition("one", ("1",)), Partition("quote", ("'it\\'s'", "'a,b'")),
                                         Partition("none", ("NULL",))))
    assert dict(rows(routing.route(texts, level))) == {"1": "one", "abc": None, "it's": "quote", "a,b": "quote", None: "none"}


@pytest.mark.parametrize("kind, spell", [
    ("int", str), ("bigint", lambda i: f"'{i}'"), ("decimal(12,2)", lambda i: f"{i}.50"), ("double", lambda i: f"{i}.25"),
    ("string", lambda i: f"'{i:03d}'"), ("date", lambda i: f"'2020-01-01'::date + {i}"),
    ("timestamp_ntz", lambda i: f"TIMESTAMP_NTZ'2020-01-01 00:00:{i % 60:02d}' + INTERVAL {i} DAYS")])
def test_array_search_and_comparisons_route_alike(spark, monkeypatch, kind, spell):
    base = {"string": "lpad(cast(id as string), 3, '0')", "date": "date_add(DATE'2020-01-01', cast(id as int))",
            "timestamp_ntz": "TIMESTAMP_NTZ'2020-01-01 00:00:00' + make_dt_interval(cast(id as int), 0, 0, id % 60)"}
    df = spark.range(0, 200).selectExpr(f"CASE WHEN id % 50 = 7 THEN NULL ELSE CAST({base.get(kind, 'id')} AS {kind}) END AS k", "id")
    level = PartitionLevel("RANGE", "k", (Partition("low", ("MINVALUE", spell(10))),) + tuple(
        Partition(f"r{i}", (spell(i), spell(i + 5))) for i in range(20, 120, 10)) + (Partition("high", (spell(150), "MAXVALUE")),))
    listed = PartitionLevel("LIST", "k", tuple(Partition(f"v{i}", (spell(i), spell(i + 1))) for i in range(0, 60, 4))
                            + (Partition("none", ("NULL",)), Partition("rest", None, True)))
    for spec in (level, listed):
        by_tests = rows(routing.route(df, spec), "id", "part")
        monkeypatch.setattr(routing, "TREE_POINTS", 1)
        assert rows(routing.route(df, spec), "id", "part") == by_tests
        monkeypatch.undo()
        assert len({p for _, p in by_tests}) > 5 or kind in ("double", "decimal(12,2)")


def test_composite_array_search_routes_like_comparisons(spark, monkeypatch):
    df = spark.range(0, 400).selectExpr("CASE WHEN id = 3 THEN NULL ELSE CAST(id DIV 20 AS int) END AS a",
                                        "concat('x', lpad(cast(id % 20 as string), 2, '0')) AS b", "id")
    level = PartitionLevel("RANGE", "a, b", (Partition("start", ("(MINVALUE, MINVALUE)", "(0, 'x05')")),) + tuple(
        Partition(f"p{i}", (f"({i}, 'x05')", f"({i + 1}, 'x02')")) for i in range(0, 15)) + (
        Partition("end", ("(17, MINVALUE)", "(MAXVALUE, 'x00')")), Partition("rest", None, True)))
    by_tests = rows(routing.route(df, level), "id", "part")
    monkeypatch.setattr(routing, "TREE_POINTS", 1)
    assert rows(routing.route(df, level), "id", "part") == by_tests and len({p for _, p in by_tests}) == 18


def test_plan_of_a_large_spec_has_constant_size(spark):
    def size(n):
        level = PartitionLevel("RANGE", "id", tuple(Partition(f"p{i}", (str(i), str(i + 1))) for i in range(n)))
        plan = routing.route(spark.range(10), level)._jdf.queryExecution().optimizedPlan()
        return plan.expressions().mkString().count("when") + plan.expressions().mkString().count("CASE")
    assert size(100) == size(5000)
