"""Partitioned upserts in place, one-pass loads, records over several lines, trailing spaces."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from tableload.operators import project, upsert
from tableload.plans import materialize as mat
from tableload.plans.incremental import load_checked, load_delimited, read_partitioned, upsert_partitioned
from tableload.sources import scan_delimited
from tableload.specs import ColumnSpec, Partition, PartitionLevel, PartitionScheme

from .conftest import rows

RANGES = PartitionLevel("RANGE", "k", (Partition("1", ("MINVALUE", "10")), Partition("2", ("10", "20")),
                                       Partition("3", ("20", "30"))))


def files(path):
    return {os.path.relpath(f, path) for f in glob.glob(f"{path}/**/*.parquet", recursive=True)}


@pytest.mark.parametrize("update", [None, ["v"]])
def test_upsert_rewrites_only_touched_partitions(spark, tmp_target, update):
    table = spark.range(30).selectExpr("cast(id as int) k", "concat('old', id) v", "id % 3 w")
    mat.materialize_partitioned(table, RANGES, tmp_target)
    source = spark.createDataFrame([(3, "new"), (25, "new"), (-4, "new")], "k int, v string")
    before = files(tmp_target)
    assert upsert_partitioned(spark, tmp_target, source, ["k"], RANGES, update, {"w": "7"}) == [("1",), ("3",)]
    after = files(tmp_target)
    second = {f for f in before if f.startswith("part=2")}
    assert second and second <= after and not (before - second) & after
    want = upsert.upsert_ignore(table, source, ["k"], {"w": "7"}) if update is None else \
        upsert.upsert_update(table, source, ["k"], update, {"w": "7"})
    got = read_partitioned(spark, tmp_target, ["part"])
    assert rows(got, "k", "v", "w") == rows(want) and dict(got.dtypes)["part"] == "string"


def test_partitioned_upsert_of_two_levels_and_refusals(spark, tmp_target):
    scheme = PartitionScheme(RANGES, {"1": PartitionLevel("LIST", "s", (Partition("a", ("'a'",)), Partition("rest", None, True)))})
    table = spark.range(30).selectExpr("cast(id as int) k", "if(id % 2 = 0, 'a', 'b') s", "id v")
    mat.materialize_partitioned(table, scheme, tmp_target)
    before = files(tmp_target)
    source = spark.createDataFrame([(4, "a", 99), (15, "b", 99)], "k int, s string, v long")
    assert upsert_partitioned(spark, tmp_target, source, ["k", "s"], scheme, ["v"]) == [("1", "a"), ("2", None)]
    kept = {f for f in before if "subpart=rest" in f or f.startswith("part=3")}
    assert kept and kept <= files(tmp_target)
    assert rows(spark.read.parquet(tmp_target).filter("v = 99"), "k") == [(4,), (15,)]
    assert spark.read.parquet(tmp_target).count() == 30
    with pytest.raises(ValueError, match="key columns"):
        upsert_partitioned(spark, tmp_target, source, ["s"], scheme, ["v"])
    with pytest.raises(Exception, match="fits no partition"):
        upsert_partitioned(spark, tmp_target, spark.createDataFrame([(77, "a", 1)], source.schema), ["k", "s"], scheme, ["v"])
    with pytest.raises(ValueError, match="duplicate"):
        upsert_partitioned(spark, tmp_target, source.unionByName(source), ["k", "s"], scheme, ["v"])
    assert upsert_partitioned(spark, tmp_target, source.limit(0), ["k", "s"], scheme, ["v"]) == []
    assert spark.read.parquet(tmp_target).count() == 30


def test_load_checked_reads_its_input_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def watched(x):
        seen.add(1)
        return x

    text = F.when(F.col("id") % 10 == 3, F.lit("x")).otherwise(F.col("id").cast("string"))
    df = spark.range(40).select(watched(text).alias("k"), "id")
    level = PartitionLevel("RANGE", "k", (Partition("low", ("0", "20")), Partition("high", ("20", "35"))))
    done = load_checked(df, [("k", "int")], f"{tmp_path}/good", f"{tmp_path}/bad", level)
    assert seen.value == 40
    assert done.counts == {"good_rows": 31, "rejected_rows": 9, "errors": 9}
    assert rows(done.good.groupBy("part").count()) == [("high", 13), ("low", 18)]
    bad = rows(done.rejected, "id", "k", "error_column", "error_value")
    assert [r[0] for r in bad] == [3, 13, 23, 33, 35, 36, 37, 38, 39]
    assert bad[0] == (3, "x", "k", "x") and bad[-1][2] == "<partition>"
    assert done.good.columns == ["k", "id", "part"] and dict(done.good.dtypes)["k"] == "int"
    with pytest.raises(FileExistsError):
        load_checked(df, [("k", "int")], f"{tmp_path}/good", f"{tmp_path}/other")
    assert not os.path.exists(f"{tmp_path}/other")


def test_load_checked_without_good_or_bad_rows(spark, tmp_path):
    df = spark.createDataFrame([("1",), ("2",)], "k string")
    done = load_checked(df, [("k", "int")], f"{tmp_path}/g1", f"{tmp_path}/b1")
    assert rows(done.good) == [(1,), (2,)] and done.rejected.count() == 0
    done = load_checked(df, [("k", "date")], f"{tmp_path}/g2", f"{tmp_path}/b2")
    assert done.good.count() == 0 and done.rejected.count() == 2 and done.counts["errors"] == 2
    done = load_checked(df.limit(0), [("k", "int")], f"{tmp_path}/g3", f"{tmp_path}/b3")
    assert done.good.count() == 0 and done.counts == {"good_rows": 0, "rejected_rows": 0, "errors": 0}


# --------------------------------------------------------------------------- text format

COLS = [ColumnSpec("k", "int", 1), ColumnSpec("a", "text", 2), ColumnSpec("b", "text", 3)]


@pytest.mark.parametrize("split", [None, 64, 7])
def test_records_over_lines_and_splits(spark, tmp_path, split):
    want, data = [], b""
    for i in range(60):
        text = "\n".join(f"line {j} of {i} \\ end\\" for j in range(i % 5))       # breaks and backslashes
        want.append((i, text, None if i % 7 == 0 else "é"))
        field = text.replace("\\", "\\\\").replace("\n", "\\\n")
        data += f"{i}\t{field}\t{chr(92) + 'N' if i % 7 == 0 else 'é'}\n".encode()
    (tmp_path / "one.txt").write_bytes(data + b"\\.\nnot a row\n\\.\nmore\\\nrubbish\n")
    (tmp_path / "two.txt").write_bytes(b"100\tx\ty\n\\.\n")
    if split:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        got = rows(scan_delimited(spark, str(tmp_path), COLS))
        good, bad = scan_delimited(spark, str(tmp_path), COLS, on_error="quarantine")
        assert got == sorted(want + [(100, "x", "y")]) == rows(good) and bad.count() == 0
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_one_record_over_many_splits(spark, tmp_path):
    (tmp_path / "f.txt").write_bytes(b"1\t" + b"\\\n".join(b"part%d" % i for i in range(50)) + b"\tz\n2\ta\tb\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        got = rows(scan_delimited(spark, str(tmp_path), COLS))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == [(1, "\n".join(f"part{i}" for i in range(50)), "z"), (2, "a", "b")]


def test_plain_files_can_be_declared(spark, tmp_path):
    (tmp_path / "f.txt").write_bytes(b"1\ta\tb\n2\t\\N\t\n\\.\n")
    for plain in (True, False):
        assert rows(scan_delimited(spark, str(tmp_path), COLS, plain=plain)) == [(1, "a", "b"), (2, None, "")]


def test_load_delimited_parts_lines_in_one_pass(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "f.txt").write_bytes(b"1\ta\tb\nx\ta\\\nb\tc\n3\tonly two\n4\tc\td\n")
    done = load_delimited(spark, str(tmp_path / "in"), COLS, f"{tmp_path}/good", f"{tmp_path}/bad")
    assert rows(done.good) == [(1, "a", "b"), (4, "c", "d")]
    assert rows(done.rejected, "error_column", "error_value") == [("<line>", "3\tonly two"), ("k", "x")]
    assert done.counts == {"good_rows": 2, "rejected_rows": 2, "errors": 2}


# --------------------------------------------------------------------------- character types

def test_excess_spaces_are_cut_and_nothing_else(spark):
    df = spark.createDataFrame([("ab    ",), ("abc",), ("ab \t",), ("  c  ",), (None,), ("äöü   ",)], "v string")
    good, bad = project.cast_checked(df, [("v", "varchar(3)")], on_error="quarantine")
    assert rows(good) == [("  c",), ("ab ",), ("abc",), ("äöü",), (None,)]
    assert rows(bad, "error_value") == [("ab \t",)]
    fine = project.cast_checked(df.filter("v IS NULL OR v NOT LIKE '%\t%'"), [("v", "char(3)")])
    assert rows(fine) == rows(good)
    with pytest.raises(Exception, match="invalid input"):
        project.cast_checked(df, [("v", "varchar(3)")]).collect()


def test_unbounded_numerics_are_sized_by_the_data(spark):
    texts = ["123456789012345678901234567890", "-0.00000001", "1e3", "12.5e-3", None, "+007", ".5", "5."]
    df = spark.createDataFrame([(t, "x") for t in texts], "v string, w string")
    sized = project.sized_numerics(df, [("v", "numeric"), ("w", "text")])
    assert sized == [("v", "numeric(38,8)"), ("w", "text")]
    got = [r["v"] for r in project.cast_checked(df, sized).collect()]
    assert [None if x is None else format(x, "f").rstrip("0").rstrip(".") for x in got] == \
        ["123456789012345678901234567890", "-0.00000001", "1000", "0.0125", None, "7", "0.5", "5"]
    with pytest.raises(Exception, match="invalid input"):
        project.cast_checked(df, [("v", "numeric")]).collect()
    assert project.sized_numerics(df.limit(0), [("v", "numeric")]) == [("v", "numeric(1,0)")]
    good, bad = project.cast_checked(df, project.sized_numerics(df, [("w", "numeric")]), on_error="quarantine")
    assert good.count() == 0 and bad.count() == len(texts)
    with pytest.raises(ValueError, match="31 digits before and 8"):
        project.sized_numerics(df.unionByName(df.selectExpr("concat('1', v) AS v", "w").filter("length(v) > 20")), [("v", "numeric")])
