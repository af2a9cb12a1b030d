"""Queries for upserts and integrity validation (U*, I*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...operators import cascade, integrity, upsert
from ...specs import CheckSpec, ForeignKeySpec, KeySpec
from .base import as_text, query, table


# =========================================================================== upserts

_TARGET = "SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer WHERE c_acctbal >= 1000"
_SOURCE = ("SELECT c_custkey, upper(c_name) AS c_name, c_acctbal + 1 AS c_acctbal FROM customer "
           "WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')")


def _upsert_sides(spark, d):
    c = table(spark, d, "customer")
    target = c.filter(F.col("c_acctbal") >= 1000).select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    source = c.filter(F.col("c_mktsegment").isin("BUILDING", "MACHINERY")).select(
        "c_custkey", F.upper("c_name").alias("c_name"), (F.col("c_acctbal") + 1).alias("c_acctbal"))
    return target, source


@query("upsert_ignore", f"""
SELECT * FROM ({_TARGET})
UNION ALL
SELECT s.c_custkey, s.c_name, s.c_acctbal, 'NEW' AS c_mktsegment FROM ({_SOURCE}) s
WHERE NOT EXISTS (SELECT 1 FROM ({_TARGET}) t WHERE t.c_custkey = s.c_custkey)""")
def q_upsert_ignore(spark, d):
    target, source = _upsert_sides(spark, d)
    return upsert.upsert_ignore(target, source, ["c_custkey"], insert_defaults={"c_mktsegment": "'NEW'"})


@query("upsert_update", f"""
SELECT CASE WHEN t.c_custkey IS NOT NULL THEN t.c_custkey ELSE s.c_custkey END AS c_custkey,
       CASE WHEN s.c_custkey IS NOT NULL THEN s.c_name ELSE t.c_name END AS c_name,
       CASE WHEN t.c_custkey IS NOT NULL THEN t.c_acctbal ELSE s.c_acctbal END AS c_acctbal,
       CASE WHEN t.c_custkey IS NOT NULL THEN t.c_mktsegment ELSE 'NEW' END AS c_mktsegment
FROM ({_TARGET}) t FULL OUTER JOIN ({_SOURCE}) s ON t.c_custkey = s.c_custkey""")
def q_upsert_update(spark, d):
    target, source = _upsert_sides(spark, d)
    return upsert.upsert_update(target, source, ["c_custkey"], ["c_name"],
                                insert_defaults={"c_mktsegment": "'NEW'"})


@query("dup_source", """
SELECT o_custkey, CAST(count(*) AS BIGINT) AS rows FROM orders GROUP BY o_custkey HAVING count(*) > 1""")
def q_dup_source(spark, d):
    return upsert.duplicate_keys(table(spark, d, "orders"), ["o_custkey"])


# =========================================================================== integrity

_NN_ORDERS = ("SELECT o_orderkey, nullif(o_orderstatus, 'P') AS o_orderstatus, o_totalprice, "
              "nullif(o_orderpriority, '1-URGENT') AS o_orderpriority FROM orders")


@query("check_not_null", f"""
WITH o AS ({_NN_ORDERS})
SELECT 'o_orderkey' AS column_name, count(*) - count(o_orderkey) AS nulls FROM o
UNION ALL SELECT 'o_orderstatus', count(*) - count(o_orderstatus) FROM o
UNION ALL SELECT 'o_totalprice', count(*) - count(o_totalprice) FROM o
UNION ALL SELECT 'o_orderpriority', count(*) - count(o_orderpriority) FROM o""")
def q_check_not_null(spark, d):
    o = table(spark, d, "orders").selectExpr(
        "o_orderkey", "nullif(o_orderstatus, 'P') AS o_orderstatus", "o_totalprice",
        "nullif(o_orderpriority, '1-URGENT') AS o_orderpriority")
    return integrity.not_null_report(o, ["o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority"])


@query("check_pk", """
SELECT l_orderkey, l_linenumber, CAST(count(*) AS BIGINT) AS rows,
       CASE WHEN l_orderkey IS NULL OR l_linenumber IS NULL THEN 'null key' ELSE 'duplicate' END AS reason
FROM lineitem GROUP BY l_orderkey, l_linenumber
HAVING count(*) > 1 OR l_orderkey IS NULL OR l_linenumber IS NULL""")
def q_check_pk(spark, d):
    return integrity.primary_key_violations(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


_EVENTS_NULLED = "SELECT user_id, nullif(event_type, 'error') AS event_type, value FROM events"


def _events_nulled(spark, d):
    return table(spark, d, "events").selectExpr("user_id", "nullif(event_type, 'error') AS event_type", "value")


@query("check_unique", f"""
SELECT user_id, event_type, CAST(count(*) AS BIGINT) AS rows FROM ({_EVENTS_NULLED})
WHERE user_id IS NOT NULL AND event_type IS NOT NULL GROUP BY user_id, event_type HAVING count(*) > 1""")
def q_check_unique(spark, d):
    return integrity.unique_violations(_events_nulled(spark, d), ["user_id", "event_type"])


@query("check_unique_partial", f"""
SELECT user_id, upper(event_type) AS etype, CAST(count(*) AS BIGINT) AS rows FROM ({_EVENTS_NULLED})
WHERE value > 50 AND user_id IS NOT NULL AND upper(event_type) IS NOT NULL
GROUP BY user_id, upper(event_type) HAVING count(*) > 1""")
def q_check_unique_partial(spark, d):
    return integrity.unique_violations(_events_nulled(spark, d), {"user_id": "user_id", "etype": "upper(event_type)"},
                                       where="value > 50")


@query("check_fk", """
SELECT o_orderkey, CAST(count(*) AS BIGINT) AS rows FROM orders o
WHERE o_orderkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)
GROUP BY o_orderkey""")
def q_check_fk(spark, d):
    return integrity.foreign_key_violations(table(spark, d, "orders"), ["o_orderkey"],
                                            table(spark, d, "lineitem"), ["l_orderkey"])


_BROKEN_KEY = ("CASE WHEN l_discount = 0 THEN NULL WHEN l_quantity >= 50 THEN -l_orderkey "
               "ELSE l_orderkey END")


@query("check_fk_nulls", f"""
SELECT child_key, CAST(count(*) AS BIGINT) AS rows FROM (SELECT {_BROKEN_KEY} AS child_key FROM lineitem) c
WHERE child_key IS NOT NULL AND NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = c.child_key)
GROUP BY child_key""")
def q_check_fk_nulls(spark, d):
    child = table(spark, d, "lineitem").select(F.expr(_BROKEN_KEY).alias("child_key"))
    return integrity.foreign_key_violations(child, ["child_key"], table(spark, d, "orders"), ["o_orderkey"])


@query("check_condition", """
SELECT c_custkey, c_acctbal, c_mktsegment FROM (
  SELECT c_custkey, c_acctbal, nullif(c_mktsegment, 'BUILDING') AS c_mktsegment FROM customer)
WHERE NOT (c_acctbal >= 0 OR c_mktsegment = 'MACHINERY')""")
def q_check_condition(spark, d):
    c = table(spark, d, "customer").selectExpr("c_custkey", "c_acctbal",
                                               "nullif(c_mktsegment, 'BUILDING') AS c_mktsegment")
    return integrity.check_violations(c, "c_acctbal >= 0 OR c_mktsegment = 'MACHINERY'")


_DELETED = "SELECT c_custkey FROM customer WHERE c_mktsegment = 'AUTOMOBILE'"


def _deleted(spark, d):
    return table(spark, d, "customer").filter(F.col("c_mktsegment") == "AUTOMOBILE").select("c_custkey")


@query("delete_cascade", f"""
SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN ({_DELETED})""")
def q_delete_cascade(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    return integrity.apply_delete_rule(o, ["o_custkey"], _deleted(spark, d), ["c_custkey"], "CASCADE")


@query("delete_set_null", f"""
SELECT o_orderkey, CAST(CASE WHEN o_custkey IN ({_DELETED}) THEN NULL ELSE o_custkey END AS VARCHAR) AS o_custkey
FROM orders""")
def q_delete_set_null(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    return as_text(integrity.apply_delete_rule(o, ["o_custkey"], _deleted(spark, d), ["c_custkey"], "SET NULL"),
                   "o_custkey")


@query("delete_set_default", f"""
SELECT o_orderkey, CASE WHEN o_custkey IN ({_DELETED}) THEN CAST(0 AS BIGINT) ELSE o_custkey END AS o_custkey
FROM orders""")
def q_delete_set_default(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    return integrity.apply_delete_rule(o, ["o_custkey"], _deleted(spark, d), ["c_custkey"], "SET DEFAULT",
                                       defaults={"o_custkey": "0"})


@query("delete_blocked", f"""
SELECT o_custkey, CAST(count(*) AS BIGINT) AS children FROM orders WHERE o_custkey IN ({_DELETED})
GROUP BY o_custkey""")
def q_delete_blocked(spark, d):
    return integrity.delete_blocked(table(spark, d, "orders"), ["o_custkey"], _deleted(spark, d), ["c_custkey"])


_CASCADE_KEYS = [
    ("nation", ForeignKeySpec("nation_region_fk", ("n_regionkey",), "region", ("r_regionkey",), "CASCADE")),
    ("customer", ForeignKeySpec("customer_nation_fk", ("c_nationkey",), "nation", ("n_nationkey",), "CASCADE")),
    ("supplier", ForeignKeySpec("supplier_nation_fk", ("s_nationkey",), "nation", ("n_nationkey",), "SET NULL")),
    ("orders", ForeignKeySpec("orders_customer_fk", ("o_custkey",), "customer", ("c_custkey",), "CASCADE")),
    ("lineitem", ForeignKeySpec("lineitem_order_fk", ("l_orderkey",), "orders", ("o_orderkey",), "CASCADE")),
    ("lineitem", ForeignKeySpec("lineitem_supplier_fk", ("l_suppkey",), "supplier", ("s_suppkey",), "NO ACTION"))]

_CASCADE_LEFT = {
    "region": ("r_regionkey", "r_name"), "nation": ("n_nationkey", "n_regionkey"), "customer": ("c_custkey", "c_nationkey"),
    "supplier": ("s_suppkey", "s_nationkey"), "orders": ("o_orderkey", "o_custkey"), "lineitem": ("l_orderkey", "l_linenumber")}

_CASCADE_SQL = """
WITH region_ AS (SELECT * FROM region WHERE NOT (r_name = 'ASIA')),
nation_ AS (SELECT * FROM nation WHERE n_regionkey IN (SELECT r_regionkey FROM region_)),
customer_ AS (SELECT * FROM customer WHERE c_nationkey IN (SELECT n_nationkey FROM nation_)),
supplier_ AS (SELECT s_suppkey, CASE WHEN s_nationkey IN (SELECT n_nationkey FROM nation_) THEN s_nationkey END AS s_nationkey
              FROM supplier),
orders_ AS (SELECT * FROM orders WHERE NOT (o_totalprice > 300000) AND o_custkey IN (SELECT c_custkey FROM customer_)),
lineitem_ AS (SELECT * FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders_))
"""


def _cascade(spark, d) -> cascade.CascadeResult:
    return cascade.cascade_delete({t: table(spark, d, t) for t in _CASCADE_LEFT}, _CASCADE_KEYS,
                                  {"region": "r_name = 'ASIA'", "orders": "o_totalprice > 300000"})


@query("delete_graph", _CASCADE_SQL + " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, CAST({a} AS VARCHAR) AS own_key, CAST({b} AS VARCHAR) AS other FROM {t}_"
    for t, (a, b) in _CASCADE_LEFT.items()))
def q_delete_graph(spark, d):
    left = _cascade(spark, d).tables
    out = None
    for t, (a, b) in _CASCADE_LEFT.items():
        part = left[t].select(F.lit(t).alias("table_name"), F.col(a).cast("string").alias("own_key"),
                              F.col(b).cast("string").alias("other"))
        out = part if out is None else out.unionByName(part)
    return out


@query("delete_graph_report", _CASCADE_SQL + """
SELECT 'region' AS table_name, CAST(NULL AS VARCHAR) AS foreign_key, 'DELETE' AS action,
       (SELECT count(*) FROM region WHERE r_name = 'ASIA') AS rows
UNION ALL SELECT 'orders', NULL, 'DELETE', (SELECT count(*) FROM orders WHERE o_totalprice > 300000)
UNION ALL SELECT 'nation', 'nation_region_fk', 'CASCADE', (SELECT count(*) FROM nation) - (SELECT count(*) FROM nation_)
UNION ALL SELECT 'customer', 'customer_nation_fk', 'CASCADE', (SELECT count(*) FROM customer) - (SELECT count(*) FROM customer_)
UNION ALL SELECT 'supplier', 'supplier_nation_fk', 'SET NULL', (SELECT count(*) FROM supplier_ WHERE s_nationkey IS NULL)
UNION ALL SELECT 'orders', 'orders_customer_fk', 'CASCADE',
       (SELECT count(*) FROM orders WHERE NOT (o_totalprice > 300000) AND o_custkey NOT IN (SELECT c_custkey FROM customer_))
UNION ALL SELECT 'lineitem', 'lineitem_order_fk', 'CASCADE', (SELECT count(*) FROM lineitem) - (SELECT count(*) FROM lineitem_)""")
def q_delete_graph_report(spark, d):
    return _cascade(spark, d).report


def report_rules(spark, d) -> list[integrity.TableRules]:
    orders, lineitem = table(spark, d, "orders"), table(spark, d, "lineitem")
    customer, part = table(spark, d, "customer"), table(spark, d, "part")
    return [
        integrity.TableRules(
            "orders", orders, not_null=("o_orderpriority",),
            keys=(KeySpec("orders_pk", ("o_orderkey",), primary=True),),
            foreign_keys=(ForeignKeySpec("orders_cust_fk", ("o_custkey",), "customer", ("c_custkey",)),),
            checks=(CheckSpec("orders_total_ck", "o_totalprice > 100000"),
                    CheckSpec("orders_status_nn", "o_orderstatus IS NOT NULL"),
                    CheckSpec("orders_ignored_ck", "o_totalprice < 0", migrate=False)),
            parents={"customer": customer}),
        integrity.TableRules(
            "lineitem", lineitem,
            keys=(KeySpec("lineitem_pk", ("l_orderkey", "l_linenumber"), primary=True),
                  KeySpec("lineitem_r_uk", ("l_orderkey", "l_linenumber"), where="l_returnflag = 'R'",
                          deferrable=True, deferred=True)),
            foreign_keys=(ForeignKeySpec("lineitem_order_fk", ("l_orderkey",), "orders", ("o_orderkey",)),
                          ForeignKeySpec("lineitem_part_fk", ("l_partkey",), "part", ("p_partkey",),
                                         deferrable=True, deferred=True)),
            checks=(CheckSpec("lineitem_discount_ck", "l_discount <= 0.05"),),
            parents={"orders": orders, "part": part}),
        integrity.TableRules(
            "customer", customer, keys=(KeySpec("customer_pk", ("c_custkey",), primary=True),
                                        KeySpec("customer_name_uk", ("c_name",))),
            checks=(CheckSpec("customer_bal_ck", "c_acctbal >= 0"),)),
    ]


@query("constraint_report", """
SELECT 'orders' AS table_name, 'orders_pk' AS constraint_name, 'PRIMARY KEY' AS constraint_type,
       'immediate' AS timing, CAST(coalesce(sum(n), 0) AS BIGINT) AS violations, CAST(NULL AS VARCHAR) AS error
FROM (SELECT count(*) AS n FROM orders GROUP BY o_orderkey HAVING count(*) > 1 OR o_orderkey IS NULL)
UNION ALL SELECT 'orders', 'orders_cust_fk', 'FOREIGN KEY', 'immediate',
       (SELECT count(*) FROM orders o WHERE o_custkey IS NOT NULL
          AND NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = o.o_custkey)), NULL
UNION ALL SELECT 'orders', 'o_orderpriority_not_null', 'NOT NULL', 'immediate',
       (SELECT count(*) - count(o_orderpriority) FROM orders), NULL
UNION ALL SELECT 'orders', 'o_orderstatus_not_null', 'NOT NULL', 'immediate',
       (SELECT count(*) - count(o_orderstatus) FROM orders), NULL
UNION ALL SELECT 'orders', 'orders_total_ck', 'CHECK', 'immediate',
       (SELECT count(*) FROM orders WHERE NOT (o_totalprice > 100000)), NULL
UNION ALL SELECT 'lineitem', 'lineitem_pk', 'PRIMARY KEY', 'immediate',
       (SELECT CAST(coalesce(sum(n), 0) AS BIGINT) FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber
        HAVING count(*) > 1 OR l_orderkey IS NULL OR l_linenumber IS NULL)), NULL
UNION ALL SELECT 'lineitem', 'lineitem_r_uk', 'UNIQUE', 'deferred',
       (SELECT CAST(coalesce(sum(n), 0) AS BIGINT) FROM (SELECT count(*) AS n FROM lineitem WHERE l_returnflag = 'R'
        AND l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL GROUP BY l_orderkey, l_linenumber
        HAVING count(*) > 1)), NULL
UNION ALL SELECT 'lineitem', 'lineitem_order_fk', 'FOREIGN KEY', 'immediate',
       (SELECT count(*) FROM lineitem l WHERE l_orderkey IS NOT NULL
          AND NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey)), NULL
UNION ALL SELECT 'lineitem', 'lineitem_part_fk', 'FOREIGN KEY', 'deferred',
       (SELECT count(*) FROM lineitem l WHERE l_partkey IS NOT NULL
          AND NOT EXISTS (SELECT 1 FROM part p WHERE p.p_partkey = l.l_partkey)), NULL
UNION ALL SELECT 'lineitem', 'lineitem_discount_ck', 'CHECK', 'immediate',
       (SELECT count(*) FROM lineitem WHERE NOT (l_discount <= 0.05)), NULL
UNION ALL SELECT 'customer', 'customer_pk', 'PRIMARY KEY', 'immediate',
       (SELECT CAST(coalesce(sum(n), 0) AS BIGINT) FROM (SELECT count(*) AS n FROM customer GROUP BY c_custkey
        HAVING count(*) > 1 OR c_custkey IS NULL)), NULL
UNION ALL SELECT 'customer', 'customer_name_uk', 'UNIQUE', 'immediate',
       (SELECT CAST(coalesce(sum(n), 0) AS BIGINT) FROM (SELECT count(*) AS n FROM customer WHERE c_name IS NOT NULL
        GROUP BY c_name HAVING count(*) > 1)), NULL
UNION ALL SELECT 'customer', 'customer_bal_ck', 'CHECK', 'immediate',
       (SELECT count(*) FROM customer WHERE NOT (c_acctbal >= 0)), NULL""")
def q_constraint_report(spark, d):
    return integrity.constraint_report(spark, report_rules(spark, d), mode="all", parallelism=4)
