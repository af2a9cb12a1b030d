"""Queries for partition routing, clustered layout and sequences (R*, X1, Q1)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...operators import routing, sequences
from ...session import scratch_path
from ...specs import Partition, PartitionLevel, PartitionScheme, SequenceSpec
from .. import materialize as mat
from .base import query, table


# =========================================================================== routing

PRIORITY_LIST = PartitionLevel("LIST", "prio", (
    Partition("p_hi", ("'1-URGENT'", "'2-HIGH'")), Partition("p_mid", ("'3-MEDIUM'",)),
    Partition("p_low", ("NULL", "'4-NOT SPECIFIED'")), Partition("p_other", None, True)))


@query("route_list", """
SELECT o_orderkey, CASE WHEN prio IN ('1-URGENT', '2-HIGH') THEN 'p_hi' WHEN prio = '3-MEDIUM' THEN 'p_mid'
                        WHEN prio IS NULL OR prio = '4-NOT SPECIFIED' THEN 'p_low' ELSE 'p_other' END AS part
FROM (SELECT o_orderkey, nullif(o_orderpriority, '5-LOW') AS prio FROM orders)""")
def q_route_list(spark, d):
    o = table(spark, d, "orders").selectExpr("o_orderkey", "nullif(o_orderpriority, '5-LOW') AS prio")
    return routing.route(o, PRIORITY_LIST).select("o_orderkey", "part")


PRICE_RANGES = PartitionLevel("RANGE", "o_totalprice", (
    Partition("r_low", ("MINVALUE", "50000")), Partition("r_mid", ("50000", "150000")),
    Partition("r_high", ("150000", "300000")), Partition("r_rest", None, True)))


@query("route_range", """
SELECT o_orderkey, CASE WHEN o_totalprice < 50000 THEN 'r_low' WHEN o_totalprice < 150000 THEN 'r_mid'
                        WHEN o_totalprice < 300000 THEN 'r_high' ELSE 'r_rest' END AS part FROM orders""")
def q_route_range(spark, d):
    return routing.route(table(spark, d, "orders"), PRICE_RANGES).select("o_orderkey", "part")


MANY_RANGES = PartitionLevel("RANGE", "o_totalprice", tuple(
    Partition(f"b_{i:02d}", ("MINVALUE" if i == 0 else str(i * 12500), str((i + 1) * 12500)))
    for i in range(40)) + (Partition("b_rest", None, True),))


@query("route_range_many", """
SELECT o_orderkey,
       CASE WHEN o_totalprice >= 500000 THEN 'b_rest'
            WHEN o_totalprice < 12500 THEN 'b_00'
            ELSE 'b_' || lpad(CAST(CAST(floor(o_totalprice / 12500) AS BIGINT) AS VARCHAR), 2, '0') END AS part
FROM orders""")
def q_route_range_many(spark, d):
    # 40 ranges: routed by a binary decision tree (about 6 comparisons per row)
    return routing.route(table(spark, d, "orders"), MANY_RANGES).select("o_orderkey", "part")


# Boundary points of the composite ranges (status, total price).
COMPOSITE_POINTS = [("F", 100000), ("F", 200000), ("F", 300000), ("O", 100000), ("O", 200000),
                    ("O", 300000), ("P", 100000), ("P", 200000), ("P", 300000)]
_CP = ["MINVALUE"] + [f"('{a}', {b})" for a, b in COMPOSITE_POINTS] + ["MAXVALUE"]
COMPOSITE_RANGES = PartitionLevel("RANGE", "o_orderstatus, o_totalprice", tuple(
    Partition(f"c_{i:02d}", (lo, hi)) for i, (lo, hi) in enumerate(zip(_CP, _CP[1:]))))
_COMPOSITE_SQL = "CASE " + " ".join(
    f"WHEN o_orderstatus < '{a}' OR (o_orderstatus = '{a}' AND o_totalprice < {b}) THEN 'c_{i:02d}'"
    for i, (a, b) in enumerate(COMPOSITE_POINTS)) + f" ELSE 'c_{len(COMPOSITE_POINTS):02d}' END"


@query("route_range_composite", f"SELECT o_orderkey, {_COMPOSITE_SQL} AS part FROM orders")
def q_route_range_composite(spark, d):
    # ten ranges on two columns: a decision tree of lexicographic tests
    return routing.route(table(spark, d, "orders"), COMPOSITE_RANGES).select("o_orderkey", "part")


HASH4 = PartitionLevel("HASH", "o_orderkey", tuple(Partition(f"h_{i}", (str(i),)) for i in range(4)))


@query("route_hash", "SELECT o_orderkey, 'h_' || CAST(o_orderkey % 4 AS VARCHAR) AS part FROM orders")
def q_route_hash(spark, d):
    return routing.route(table(spark, d, "orders"), HASH4, hash_fn=routing.identity_hash).select("o_orderkey", "part")


QUOTED_RANGES = PartitionLevel("RANGE", "o_orderkey", tuple(
    Partition(f"q_{i:02d}", (f"'{i * 700}'", f"'{(i + 1) * 700}'")) for i in range(12)) + (Partition("q_rest", None, True),))


@query("route_range_quoted", """
SELECT o_orderkey, CASE WHEN o_orderkey >= 0 AND o_orderkey < 8400
       THEN 'q_' || lpad(CAST(o_orderkey // 700 AS VARCHAR), 2, '0') ELSE 'q_rest' END AS part FROM orders""")
def q_route_range_quoted(spark, d):
    # an integer key with quoted bounds: ordered as integers
    return routing.route(table(spark, d, "orders"), QUOTED_RANGES).select("o_orderkey", "part")


DATE_RANGES = PartitionLevel("RANGE", "o_orderdate", tuple(
    Partition(f"y_{y}", (f"DATE '{y}-01-01'", f"DATE '{y + 1}-01-01'")) for y in range(1988, 2000)))


@query("route_range_dates", """
SELECT o_orderkey, CASE WHEN year(o_orderdate) BETWEEN 1988 AND 1999
       THEN 'y_' || CAST(year(o_orderdate) AS VARCHAR) END AS part FROM orders""")
def q_route_range_dates(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("o_orderdate"))
    return routing.route(o, DATE_RANGES).select("o_orderkey", "part")


TWO_LEVEL = PartitionScheme(
    PartitionLevel("RANGE", "o_orderstatus, o_totalprice", (
        Partition("a", ("MINVALUE", "('F', 100000)")),
        Partition("b", ("('F', 100000)", "('O', 0)")),
        Partition("c", ("('O', 0)", "MAXVALUE")))),
    {"a": PartitionLevel("HASH", "o_orderkey", (Partition("a_0", ("0",)), Partition("a_1", ("1",)))),
     "b": PartitionLevel("LIST", "o_orderpriority", (Partition("b_urgent", ("'1-URGENT'",)),
                                                     Partition("b_other", None, True)))})

_TWO_LEVEL_SQL = """
SELECT o_orderkey,
  CASE WHEN o_orderstatus < 'F' OR (o_orderstatus = 'F' AND o_totalprice < 100000) THEN 'a'
       WHEN o_orderstatus < 'O' OR (o_orderstatus = 'O' AND o_totalprice < 0) THEN 'b' ELSE 'c' END AS part,
  CASE WHEN o_orderstatus < 'F' OR (o_orderstatus = 'F' AND o_totalprice < 100000)
         THEN 'a_' || CAST(o_orderkey % 2 AS VARCHAR)
       WHEN o_orderstatus < 'O' OR (o_orderstatus = 'O' AND o_totalprice < 0)
         THEN CASE WHEN o_orderpriority = '1-URGENT' THEN 'b_urgent' ELSE 'b_other' END END AS subpart
FROM orders"""


@query("route_two_level", _TWO_LEVEL_SQL)
def q_route_two_level(spark, d):
    return routing.route(table(spark, d, "orders"), TWO_LEVEL, hash_fn=routing.identity_hash).select(
        "o_orderkey", "part", "subpart")


GAPPED = PartitionLevel("RANGE", "o_totalprice", (
    Partition("g_low", ("MINVALUE", "50000")), Partition("g_high", ("100000", "MAXVALUE"))))


@query("route_reject", """
SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice >= 50000 AND o_totalprice < 100000""")
def q_route_reject(spark, d):
    _, rejected = routing.route_or_reject(table(spark, d, "orders"), GAPPED)
    return rejected.select("o_orderkey", "o_totalprice")


COUNTED = PartitionScheme(
    PartitionLevel("RANGE", "o_totalprice", (
        Partition("k_low", ("MINVALUE", "100000")), Partition("k_high", ("100000", "600000")),
        Partition("k_huge", ("600000", "MAXVALUE")))),
    {"k_low": PartitionLevel("HASH", "o_orderkey", tuple(Partition(f"k_low_{i}", (str(i),)) for i in range(3)))})


@query("partition_counts", """
WITH leaves(part, subpart) AS (VALUES ('k_low', 'k_low_0'), ('k_low', 'k_low_1'), ('k_low', 'k_low_2'),
                                      ('k_high', NULL), ('k_huge', NULL)),
r AS (SELECT CASE WHEN o_totalprice < 100000 THEN 'k_low' WHEN o_totalprice < 600000 THEN 'k_high'
                  ELSE 'k_huge' END AS part,
             CASE WHEN o_totalprice < 100000 THEN 'k_low_' || CAST(o_orderkey % 3 AS VARCHAR) END AS subpart
      FROM orders)
SELECT l.part, l.subpart, CAST(count(r.part) AS BIGINT) AS rows
FROM leaves l LEFT JOIN r ON l.part = r.part AND l.subpart IS NOT DISTINCT FROM r.subpart
GROUP BY l.part, l.subpart""")
def q_partition_counts(spark, d):
    routed = routing.route(table(spark, d, "orders"), COUNTED, hash_fn=routing.identity_hash)
    return routing.partition_counts(routed, COUNTED)


# =========================================================================== layout

@query("clustered_copy", "SELECT * FROM lineitem WHERE l_returnflag = 'R'")
def q_clustered_copy(spark, d):
    path = mat.clustered_copy(table(spark, d, "lineitem"), [("l_shipdate", True), "l_orderkey"],
                              scratch_path(spark, "x1"), where="l_returnflag = 'R'")
    return spark.read.parquet(path)


# =========================================================================== sequences

@query("assign_sequence", """
SELECT c_custkey, 1000 + row_number() OVER (ORDER BY c_custkey) AS id FROM customer""")
def q_assign_sequence(spark, d):
    seq = SequenceSpec("cust_seq", increment_by=1, last_value=1000)
    return sequences.assign_sequence(table(spark, d, "customer").select("c_custkey"), ["c_custkey"], seq)


@query("assign_sequence_cycle", """
SELECT o_orderkey, CASE WHEN rn < 1 THEN 97 + rn * 7 ELSE 1 + ((rn - 1) % 15) * 7 END AS id
FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS rn FROM orders)""")
def q_assign_sequence_cycle(spark, d):
    seq = SequenceSpec("cyc", increment_by=7, last_value=90, min_value=1, max_value=100, cyclical=True)
    return sequences.assign_sequence(table(spark, d, "orders").select("o_orderkey"), ["o_orderkey"], seq)


@query("assign_sequence_desc", """
SELECT o_orderkey, CASE WHEN rn < 333 THEN -4 - rn * 3 ELSE -1 - ((rn - 333) % 334) * 3 END AS id
FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate DESC, o_orderkey) - 1 AS rn FROM orders)""")
def q_assign_sequence_desc(spark, d):
    seq = SequenceSpec("desc", increment_by=-3, last_value=-1, min_value=-1000, max_value=-1, cyclical=True)
    return sequences.assign_sequence(table(spark, d, "orders").select("o_orderkey", "o_orderdate"),
                                     [("o_orderdate", True), "o_orderkey"], seq).select("o_orderkey", "id")


# --- specs of many thousand partitions: one array literal each, whatever their number

_MANY = 10_000


@query("route_range_large", f"""
SELECT o_orderkey, CASE WHEN o_orderkey < {13 * _MANY} THEN 'p' || (o_orderkey // 13) ELSE 'rest' END AS part
FROM orders""")
def q_route_range_large(spark, d):
    level = PartitionLevel("RANGE", "o_orderkey", tuple(
        Partition(f"p{i}", (str(13 * i), f"'{13 * i + 13}'")) for i in range(_MANY)) + (Partition("rest", None, True),))
    return routing.route(table(spark, d, "orders").select("o_orderkey"), level)


@query("route_list_large", f"""
SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 AND o_orderkey < {7 * _MANY} THEN 'l' || ((o_orderkey // 7) % 50)
                        ELSE 'other' END AS part
FROM orders""")
def q_route_list_large(spark, d):
    level = PartitionLevel("LIST", "o_orderkey", tuple(
        Partition(f"l{i}", tuple(str(7 * v) if v % 2 else f"'{7 * v}'" for v in range(i, _MANY, 50))) for i in range(50))
        + (Partition("other", None, True),))
    return routing.route(table(spark, d, "orders").select("o_orderkey"), level)


@query("route_list_typed", """
SELECT l_orderkey, l_linenumber, CASE l_linenumber WHEN 1 THEN 'first' WHEN 2 THEN 'first' WHEN 3 THEN 'third' ELSE 'rest' END AS part
FROM lineitem""")
def q_route_list_typed(spark, d):
    level = PartitionLevel("LIST", "l_linenumber", (Partition("first", ("1", "'2'")), Partition("third", ("3.0",)),
                                                    Partition("rest", None, True)))
    return routing.route(table(spark, d, "lineitem").select("l_orderkey", "l_linenumber"), level)


@query("route_hash_default", """
SELECT l_orderkey, CAST(count(*) AS BIGINT) AS rows, CAST(1 AS BIGINT) AS buckets, true AS declared
FROM lineitem GROUP BY l_orderkey""")
def q_route_hash_default(spark, d):
    # the default hash places keys its own way: every key in one bucket, and none lost
    level = PartitionLevel("HASH", "l_orderkey", tuple(Partition(f"h_{i}", (str(i),)) for i in range(16)))
    return routing.route(table(spark, d, "lineitem"), level).groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("part").alias("buckets"),
        F.every(F.col("part").isin(level.names)).alias("declared"))


# =========================================================================== buckets, numbers in blocks

@query("bucketed_join", """
SELECT o_custkey, CAST(count(*) AS BIGINT) AS lines, CAST(sum(l_quantity) AS BIGINT) AS quantity
FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_custkey""")
def q_bucketed_join(spark, d):
    orders, lines = _bucketed(spark, d)
    joined = spark.table(orders).join(spark.table(lines), F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("lines"), F.sum("l_quantity").cast("bigint").alias("quantity"))


def _bucketed(spark, d, buckets=16):
    """Both tables in equal buckets of the order key, in the shared folder."""
    out = []
    for name, key in (("orders", "o_orderkey"), ("lineitem", "l_orderkey")):
        path = scratch_path(spark, name)
        out.append(mat.materialize_bucketed(table(spark, d, name), [key], buckets, path, path.rsplit("/", 1)[1].replace("-", "_")))
    return out


@query("sequence_blocks", """
SELECT CAST(count(*) AS BIGINT) AS rows, CAST(count(*) AS BIGINT) AS numbers, true AS in_range,
       CAST(sum(l_orderkey) AS BIGINT) AS order_keys FROM lineitem""")
def q_sequence_blocks(spark, d):
    # no order and no dense run to compare: every row has its own number, on the sequence's steps
    seq = SequenceSpec("line_seq", increment_by=5, last_value=100, cache_size=32)
    numbered = sequences.assign_sequence_blocks(table(spark, d, "lineitem").select("l_orderkey"), seq)
    return numbered.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("id").alias("numbers"),
                        F.every((F.col("id") >= 105) & (F.col("id") % 5 == 0)).alias("in_range"),
                        F.sum("l_orderkey").alias("order_keys"))
