"""Invariants checked over generated specs (few examples each: every example runs Spark jobs)."""

import bisect

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tableload.operators import routing, sequences
from tableload.sources import scan_declared
from tableload.specs import ColumnSpec, Partition, PartitionLevel, PartitionScheme, SequenceSpec

from .conftest import SF_SMALL, rows

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(bounds=st.lists(st.integers(min_value=0, max_value=500_000), min_size=1, max_size=6, unique=True),
       with_default=st.booleans(), sub_n=st.integers(min_value=1, max_value=4))
def test_routing_places_each_row_once(spark, bounds, with_default, sub_n):
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet").select("o_orderkey", "o_totalprice")
    cuts = ["MINVALUE"] + [str(b) for b in sorted(bounds)] + ["MAXVALUE"]
    parts = [Partition(f"p{i}", (lo, hi)) for i, (lo, hi) in enumerate(zip(cuts, cuts[1:]))]
    if with_default:               # drop the middle range and let a default catch it
        parts = parts[:1] + parts[2:] + [Partition("dflt", None, True)]
    scheme = PartitionScheme(
        PartitionLevel("RANGE", "o_totalprice", tuple(parts)),
        {parts[0].name: PartitionLevel("HASH", "o_orderkey",
                                       tuple(Partition(f"h{i}", (str(i),)) for i in range(sub_n)))})
    routed, rejected = routing.route_or_reject(orders, scheme)
    total = orders.count()
    assert rejected.count() == 0
    assert routed.count() == total
    counts = routing.partition_counts(routing.route(orders, scheme), scheme)
    assert counts.agg(F.sum("rows")).first()[0] == total
    assert counts.count() == len(scheme.leaves())


@SETTINGS
@given(inc=st.integers(min_value=-50, max_value=50).filter(lambda x: x != 0),
       last=st.integers(min_value=-10_000, max_value=10_000), n_parts=st.integers(min_value=1, max_value=9))
def test_sequence_without_cycle_is_dense(spark, inc, last, n_parts):
    df = spark.read.parquet(f"{SF_SMALL}/customer.parquet").select("c_custkey", "c_nationkey")
    seq = SequenceSpec("s", inc, last_value=last, min_value=-10 ** 12, max_value=10 ** 12)
    got = sequences.assign_sequence(df, ["c_nationkey", "c_custkey"], seq, num_partitions=n_parts)
    ordered = [r["id"] for r in got.orderBy("c_nationkey", "c_custkey").collect()]
    assert ordered == [last + inc * (i + 1) for i in range(len(ordered))]


def test_declared_scan_of_orc_and_json(spark, tmp_path):
    src = spark.read.parquet(f"{SF_SMALL}/nation.parquet")
    cols = [ColumnSpec("name", "text", 2, "n_name"), ColumnSpec("key", "bigint", 1, "n_nationkey")]
    for fmt in ("orc", "json"):
        path = str(tmp_path / fmt)
        src.write.format(fmt).save(path)
        got = scan_declared(spark, fmt, path, cols)
        assert got.columns == ["key", "name"]
        assert rows(got) == rows(src.select(F.col("n_nationkey").cast("bigint"), "n_name"))
    bad = str(tmp_path / "bad.json")
    with open(bad, "w") as f:
        f.write('{"n_nationkey": 1, "n_name": "x"}\n{not json\n')
    with pytest.raises(Exception):
        scan_declared(spark, "json", bad, cols).collect()


@SETTINGS
@given(cuts=st.lists(st.integers(min_value=1_000, max_value=500_000), min_size=9, max_size=40, unique=True),
       drop=st.integers(min_value=0, max_value=8), with_default=st.booleans())
def test_range_tree_against_bisection(spark, cuts, drop, with_default):
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet").select("o_orderkey", "o_totalprice")
    bounds = ["MINVALUE"] + [str(c) for c in sorted(cuts)] + ["MAXVALUE"]
    parts = [Partition(f"p{i}", (lo, hi)) for i, (lo, hi) in enumerate(zip(bounds, bounds[1:]))]
    del parts[drop]                                     # a gap: default or reject
    if with_default:
        parts.append(Partition("dflt", None, True))
    lvl = PartitionLevel("RANGE", "o_totalprice", tuple(parts))
    at = [float("-inf")] + sorted(cuts) + [float("inf")]
    for r in routing.route(orders, lvl).collect():
        i = bisect.bisect_right(at, r["o_totalprice"]) - 1
        assert r["part"] == (f"p{i}" if i != drop else "dflt" if with_default else None)


def test_declared_csv_enforces_length(spark, tmp_path):
    path = str(tmp_path / "c.csv")
    with open(path, "w") as f:
        f.write("1,ok\n2,too long\n")
    cols = [ColumnSpec("k", "int", 1), ColumnSpec("s", "varchar(3)", 2)]
    with pytest.raises(Exception):
        scan_declared(spark, "csv", path, cols).collect()
    assert scan_declared(spark, "csv", path, [cols[0], ColumnSpec("s", "varchar(10)", 2)]).count() == 2


@SETTINGS
@given(cuts=st.lists(st.tuples(st.sampled_from(["F", "O", "P"]), st.integers(min_value=0, max_value=500_000)),
                     min_size=9, max_size=30, unique=True),
       with_default=st.booleans(), drop=st.integers(min_value=0, max_value=8))
def test_composite_range_tree_against_bisection(spark, cuts, with_default, drop):
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet").select("o_orderkey", "o_orderstatus", "o_totalprice")
    pts = ["MINVALUE"] + [f"('{s}', {v})" for s, v in sorted(cuts)] + ["MAXVALUE"]
    parts = [Partition(f"p{i}", (lo, hi)) for i, (lo, hi) in enumerate(zip(pts, pts[1:]))]
    del parts[drop]
    if with_default:
        parts.append(Partition("dflt", None, True))
    lvl = PartitionLevel("RANGE", "o_orderstatus, o_totalprice", tuple(parts))
    at = sorted(cuts)
    for r in routing.route(orders, lvl).collect():
        i = bisect.bisect_right(at, (r["o_orderstatus"], r["o_totalprice"]))
        assert r["part"] == (f"p{i}" if i != drop else "dflt" if with_default else None)
