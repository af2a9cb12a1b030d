"""Queries for filters, joins, aggregations and ordering (F*, J*, A*, L1)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...operators import filters, relops, sequences
from .base import query, table


# =========================================================================== filters

@query("keep_members", """
SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')""")
def q_keep_members(spark, d):
    c = table(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return filters.keep_members(c, "c_mktsegment", ["BUILDING", "MACHINERY"])


@query("keep_members_long", """
SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT range FROM range(1, 3000, 7))""")
def q_keep_members_long(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    return filters.keep_members(o, "o_custkey", list(range(1, 3000, 7)))


@query("keep_members_table", """
SELECT o_orderkey, o_custkey FROM orders
WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""")
def q_keep_members_table(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    members = table(spark, d, "customer").filter(F.col("c_mktsegment") == "BUILDING").select("c_custkey")
    return filters.keep_members(o, "o_custkey", members)


_LINE_NATIONS = """
SELECT l.l_orderkey, l.l_linenumber, c.c_nationkey AS cust_nationkey, s.s_nationkey AS supp_nationkey
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey JOIN supplier s ON l.l_suppkey = s.s_suppkey"""


def _line_nations(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"),
                                            F.col("c_nationkey").alias("cust_nationkey"))
    s = table(spark, d, "supplier").select(F.col("s_suppkey").alias("l_suppkey"),
                                            F.col("s_nationkey").alias("supp_nationkey"))
    rel = relops.join_using(relops.join_using(relops.join_using(li, o, ["l_orderkey"]), c, ["o_custkey"]),
                            s, ["l_suppkey"])
    return rel.select("l_orderkey", "l_linenumber", "cust_nationkey", "supp_nationkey")


@query("keep_both_ends", f"""
SELECT * FROM ({_LINE_NATIONS}) WHERE cust_nationkey IN (0,1,2,3,4,5,6,7,8,9)
  AND supp_nationkey IN (0,1,2,3,4,5,6,7,8,9)""")
def q_keep_both_ends(spark, d):
    return filters.keep_both_ends(_line_nations(spark, d), "cust_nationkey", "supp_nationkey", list(range(10)))


@query("flagged_only", """
SELECT c_custkey, c_nationkey FROM customer
WHERE c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey <> 2) AND c_acctbal > 0""")
def q_flagged_only(spark, d):
    control = table(spark, d, "nation").select("n_nationkey", (F.col("n_regionkey") != 2).alias("migrate"))
    c = table(spark, d, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    return filters.flagged_only(c, control, {"c_nationkey": "n_nationkey"},
                                own_flag=F.col("c_acctbal") > 0).select("c_custkey", "c_nationkey")


@query("partial_filter", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'")
def q_partial_filter(spark, d):
    o = table(spark, d, "orders")
    return filters.partial_filter(o, "o_orderstatus = 'F'").select("o_orderkey", "o_totalprice")


# =========================================================================== joins

@query("join_using", """
SELECT o.o_orderkey, o.o_custkey AS custkey, c.c_name, n.n_name
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey""")
def q_join_using(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("custkey"))
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("custkey"), "c_name",
                                            F.col("c_nationkey").alias("nationkey"))
    n = table(spark, d, "nation").select(F.col("n_nationkey").alias("nationkey"), "n_name")
    return relops.join_using(relops.join_using(o, c, ["custkey"]), n, ["nationkey"]).select(
        "o_orderkey", "custkey", "c_name", "n_name")


@query("join_two_sided", f"""
SELECT x.l_orderkey, x.l_linenumber, cn.n_name AS cust_nation, sn.n_name AS supp_nation
FROM ({_LINE_NATIONS}) x JOIN nation cn ON x.cust_nationkey = cn.n_nationkey
JOIN nation sn ON x.supp_nationkey = sn.n_nationkey""")
def q_join_two_sided(spark, d):
    out = relops.join_two_sided(_line_nations(spark, d), table(spark, d, "nation"), "n_nationkey",
                                "cust_nationkey", "supp_nationkey", {"n_name": "cust_nation"},
                                {"n_name": "supp_nation"})
    return out.select("l_orderkey", "l_linenumber", "cust_nation", "supp_nation")


@query("explode_position", """
SELECT p_partkey, CAST(generate_subscripts(string_split(p_name, ' '), 1) AS BIGINT) AS pos,
       unnest(string_split(p_name, ' ')) AS word FROM part""")
def q_explode_position(spark, d):
    p = table(spark, d, "part").select("p_partkey", F.split("p_name", " ").alias("words"))
    return relops.explode_with_position(p, "words", "pos", "word")


@query("orphan_rows", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)""")
def q_orphan_rows(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return relops.orphans(o, ["o_orderkey"], table(spark, d, "lineitem"), ["l_orderkey"])


@query("matched_rows", """
SELECT c_custkey, c_name FROM customer c
WHERE EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderpriority = '1-URGENT')""")
def q_matched_rows(spark, d):
    c = table(spark, d, "customer").select("c_custkey", "c_name")
    o = table(spark, d, "orders").filter(F.col("o_orderpriority") == "1-URGENT")
    return relops.matched(c, ["c_custkey"], o, ["o_custkey"])


# =========================================================================== aggregations

@query("ordered_collect", """
SELECT conv_id,
       string_agg(CAST(turn AS VARCHAR), ',' ORDER BY turn) AS turns,
       string_agg(coalesce(nullif(role, 'system'), '~'), ',' ORDER BY turn) AS roles,
       string_agg(text, '|' ORDER BY turn) AS texts
FROM conversations GROUP BY conv_id""")
def q_ordered_collect(spark, d):
    cv = table(spark, d, "conversations").select("conv_id", "turn", F.expr("nullif(role, 'system')").alias("role"),
                                                  "text")
    g = relops.ordered_group_collect(cv, ["conv_id"], ["turn"], ["turn", "role", "text"])
    return g.select("conv_id",
                    F.array_join(F.transform("turn", lambda x: x.cast("string")), ",").alias("turns"),
                    F.array_join("role", ",", "~").alias("roles"),
                    F.array_join("text", "|").alias("texts"))


@query("ordered_group_rows", """
SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS ordinal
FROM orders""")
def q_ordered_group_rows(spark, d):
    o = table(spark, d, "orders").select("o_custkey", "o_orderkey")
    return sequences.ordered_group_rows(o, ["o_custkey"], ["o_orderkey"])


@query("array_map", """
SELECT p_partkey, array_to_string(list_transform(string_split(p_name, ' '), lambda x: upper(x)), ' ') AS upper_name
FROM part""")
def q_array_map(spark, d):
    p = table(spark, d, "part").select("p_partkey", F.split("p_name", " ").alias("words"))
    m = relops.array_map_ordered(p, "words", F.upper)
    return m.select("p_partkey", F.array_join("words", " ").alias("upper_name"))


@query("distinct_rows", """
SELECT DISTINCT o_orderstatus, nullif(o_orderpriority, '5-LOW') AS priority FROM orders""")
def q_distinct_rows(spark, d):
    o = table(spark, d, "orders").select("o_orderstatus", F.expr("nullif(o_orderpriority, '5-LOW')").alias("priority"))
    return relops.distinct_rows(o)


@query("sibling_count", """
SELECT p_partkey, p_brand, count(*) OVER (PARTITION BY p_brand) AS siblings FROM part""")
def q_sibling_count(spark, d):
    return relops.sibling_count(table(spark, d, "part").select("p_partkey", "p_brand"), ["p_brand"])


@query("ordered_listing", """
SELECT o_orderkey, nullif(o_orderpriority, '5-LOW') AS priority, o_totalprice FROM orders
ORDER BY priority DESC NULLS FIRST, o_totalprice ASC NULLS LAST, o_orderkey""")
def q_ordered_listing(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", F.expr("nullif(o_orderpriority, '5-LOW')").alias("priority"),
                                         "o_totalprice")
    return relops.ordered_listing(o, [("priority", True), "o_totalprice", "o_orderkey"])
