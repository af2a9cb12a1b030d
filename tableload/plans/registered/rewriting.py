"""Queries for views, SQL functions and change-set rewriting (V1, UF1, T*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...functions.sqlfuncs import register_sql_function
from ...operators import rewrite
from .base import query, table


# =========================================================================== views, functions, triggers

@query("define_view", """
SELECT l_orderkey AS order_key, l_linenumber AS line, l_quantity AS qty FROM lineitem WHERE l_returnflag = 'A'""")
def q_define_view(spark, d):
    table(spark, d, "lineitem").createOrReplaceTempView("tl_lineitem")
    return rewrite.define_view(
        spark, "tl_lineitem_v", "SELECT l_orderkey, l_linenumber, l_quantity FROM tl_lineitem WHERE l_returnflag = 'A'",
        ["order_key", "line", "qty"])


@query("sql_function", """
SELECT l_orderkey, l_linenumber, (CAST(l_quantity AS BIGINT) * -7) // 3 AS v FROM lineitem""")
def q_sql_function(spark, d):
    register_sql_function(spark, "tl_multiply", [("a", "bigint"), ("b", "bigint")], "bigint", "a * b")
    register_sql_function(spark, "tl_divide", [("a", "bigint"), ("b", "bigint")], "bigint", "a div b")
    table(spark, d, "lineitem").createOrReplaceTempView("tl_lineitem")
    return spark.sql("SELECT l_orderkey, l_linenumber, "
                     "tl_divide(tl_multiply(CAST(l_quantity AS BIGINT), -7), 3) AS v FROM tl_lineitem")


_CHANGES = """
SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'INSERT' WHEN 'O' THEN 'UPDATE' ELSE 'DELETE' END AS op,
       o_totalprice, o_orderpriority, 'none' AS tag FROM orders"""


def _changes(spark, d):
    return table(spark, d, "orders").selectExpr(
        "o_orderkey", "CASE o_orderstatus WHEN 'F' THEN 'INSERT' WHEN 'O' THEN 'UPDATE' ELSE 'DELETE' END AS op",
        "o_totalprice", "o_orderpriority", "'none' AS tag")


@query("before_row", f"""
SELECT o_orderkey, op,
       CASE WHEN act THEN 'BIG-' || o_orderpriority ELSE o_orderpriority END AS o_orderpriority,
       CASE WHEN act THEN substr('BIG-' || o_orderpriority, 1, 5) ELSE tag END AS tag
FROM (SELECT *, op IN ('INSERT', 'UPDATE') AND coalesce(o_totalprice > 100000, false) AS act FROM ({_CHANGES}))
WHERE NOT (act AND coalesce('BIG-' || o_orderpriority = 'BIG-5-LOW', false))""")
def q_before_row(spark, d):
    out = rewrite.before_row(_changes(spark, d), ["INSERT", "UPDATE"],
                             [("o_orderpriority", "concat('BIG-', o_orderpriority)"),
                              ("tag", "substr(o_orderpriority, 1, 5)")],
                             when="o_totalprice > 100000", drop_if="o_orderpriority = 'BIG-5-LOW'")
    return out.select("o_orderkey", "op", "o_orderpriority", "tag")


@query("instead_of_insert", """
SELECT s_suppkey * 10 AS c1 FROM supplier
UNION ALL SELECT ((CAST(l_quantity AS BIGINT) * 10) // 10) * 10 FROM lineitem""")
def q_instead_of_insert(spark, d):
    base = table(spark, d, "supplier").select(F.col("s_suppkey").alias("c1"))
    inserted = table(spark, d, "lineitem").select((F.col("l_quantity").cast("bigint") * 10).alias("c1"))
    new_base = rewrite.instead_of_insert(inserted, {"c1": "c1 div 10"}, base)
    new_base.createOrReplaceTempView("tl_t1")
    return rewrite.define_view(spark, "tl_v1", "SELECT c1 * 10 FROM tl_t1", ["c1"])


@query("instead_of_changes", """
WITH ch AS (SELECT o_custkey AS k, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS n FROM orders),
c AS (SELECT k, CASE WHEN o_orderkey % 3 = 0 THEN 'DELETE' ELSE 'UPDATE' END AS op, o_orderkey FROM ch WHERE n = 1)
SELECT c_custkey, CASE WHEN op = 'UPDATE' THEN 'order ' || o_orderkey ELSE c_name END AS c_name, c_mktsegment
FROM customer LEFT JOIN c ON k = c_custkey WHERE op IS NULL OR op <> 'DELETE'
UNION ALL
SELECT p_partkey + 10000000, p_name, 'PART' FROM part""")
def q_instead_of_changes(spark, d):
    # a view shows the customers with their key times ten; changes to the view reach the table
    base = table(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment")
    first = table(spark, d, "orders").groupBy("o_custkey").agg(F.min("o_orderkey").alias("o"))
    edits = first.selectExpr("o_custkey * 10 AS key10", "concat('order ', o) AS name",
                             "CASE WHEN o % 3 = 0 THEN 'DELETE' ELSE 'UPDATE' END AS op")
    added = table(spark, d, "part").selectExpr("(p_partkey + 10000000) * 10 AS key10", "p_name AS name", "'INSERT' AS op")
    return rewrite.instead_of_changes(edits.unionByName(added), {"c_custkey": "key10 div 10", "c_name": "name"}, base,
                                      ["c_custkey"], defaults={"c_mktsegment": "'PART'"})


@query("after_statement", """
WITH ch AS (SELECT strftime(ts, '%Y-%m-%d %H') AS batch,
                   CASE event_type WHEN 'signup' THEN 'INSERT' WHEN 'purchase' THEN 'UPDATE' ELSE 'OTHER' END AS op,
                   CAST(round(value * 100) AS BIGINT) AS cents FROM events),
b AS (SELECT DISTINCT batch FROM ch),
s AS (SELECT b.batch, e.op FROM b CROSS JOIN (VALUES ('INSERT'), ('UPDATE')) e(op)),
a AS (SELECT batch, op, count(*) AS n_rows, sum(cents) AS cents FROM ch WHERE op IN ('INSERT', 'UPDATE')
      GROUP BY batch, op)
SELECT s.batch, s.op, CAST(coalesce(a.n_rows, 0) AS BIGINT) AS n_rows, CAST(coalesce(a.cents, 0) AS BIGINT) AS cents
FROM s LEFT JOIN a ON s.batch = a.batch AND s.op = a.op""")
def q_after_statement(spark, d):
    ch = table(spark, d, "events").selectExpr(
        "date_format(ts, 'yyyy-MM-dd HH') AS batch",
        "CASE event_type WHEN 'signup' THEN 'INSERT' WHEN 'purchase' THEN 'UPDATE' ELSE 'OTHER' END AS op",
        "CAST(round(value * 100) AS BIGINT) AS cents")
    batches = ch.select("batch").distinct()
    out = rewrite.after_statement(ch, batches, ["INSERT", "UPDATE"],
                                  {"n_rows": F.count(F.lit(1)), "cents": F.sum("cents")})
    return out.select("batch", "op", F.coalesce("n_rows", F.lit(0)).cast("bigint").alias("n_rows"),
                      F.coalesce("cents", F.lit(0)).cast("bigint").alias("cents"))
