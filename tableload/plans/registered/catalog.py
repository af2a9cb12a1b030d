"""Queries for the catalog snapshot refresh and the one-shot run."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...operators import project
from ...session import scratch_path
from ...sources import scan_declared
from .base import as_text, query, table


# =========================================================================== catalog refresh

@query("refresh_columns", """
WITH prof AS (
  SELECT 'customer' AS table_name, 'c_custkey' AS column_name, 1 AS position, 'bigint' AS base,
         'bigint' AS label, count(*) > count(c_custkey) AS nullable FROM customer
  UNION ALL SELECT 'customer', 'c_name', 2, 'string', 'string(' || CAST(max(length(c_name)) AS VARCHAR) || ')',
         count(*) > count(c_name) FROM customer
  UNION ALL SELECT 'customer', 'c_nationkey', 3, 'int', 'int', count(*) > count(c_nationkey) FROM customer
  UNION ALL SELECT 'customer', 'c_acctbal', 4, 'double', 'double', count(*) > count(c_acctbal) FROM customer
  UNION ALL SELECT 'customer', 'c_mktsegment', 5, 'string',
         'string(' || CAST(max(length(c_mktsegment)) AS VARCHAR) || ')', count(*) > count(c_mktsegment) FROM customer
  UNION ALL SELECT 'nation', 'n_nationkey', 1, 'int', 'int', count(*) > count(n_nationkey) FROM nation
  UNION ALL SELECT 'nation', 'n_name', 2, 'string', 'string(' || CAST(max(length(n_name)) AS VARCHAR) || ')',
         count(*) > count(n_name) FROM nation
  UNION ALL SELECT 'nation', 'n_regionkey', 3, 'int', 'int', count(*) > count(n_regionkey) FROM nation)
SELECT 'tpch' AS schema, table_name, column_name, position,
       CASE WHEN column_name = 'c_name' THEN 'text' ELSE label END AS type_name,
       CASE WHEN column_name = 'c_acctbal' THEN false ELSE nullable END AS nullable,
       CAST(NULL AS VARCHAR) AS default_value, column_name AS orig_column, base AS orig_type, '{}' AS options
FROM prof""")
def q_refresh_columns(spark, d):
    from ..refresh import catalog_from_tables, refresh_snapshot, refresh_table
    customer, nation = table(spark, d, "customer"), table(spark, d, "nation")
    before = catalog_from_tables(spark, {"customer": customer.drop("c_mktsegment")}, "tpch")
    snap = refresh_snapshot(None, before)["columns"]
    edited = snap.withColumn(   # user edits between two refreshes
        "type_name", F.when(F.col("column_name") == "c_name", F.lit("text")).otherwise(F.col("type_name"))
    ).withColumn("nullable", F.when(F.col("column_name") == "c_acctbal", F.lit(False)).otherwise(F.col("nullable")))
    now = catalog_from_tables(spark, {"customer": customer, "nation": nation}, "tpch")
    return refresh_table("columns", edited, now["columns"]).select(
        "schema", "table_name", "column_name", "position", "type_name", "nullable", "default_value",
        "orig_column", "orig_type", "options")


@query("profile_documents", """
SELECT CAST(1 AS BIGINT) AS position, 'doc_id' AS column_name, 'bigint' AS type_name, CAST(0 AS BIGINT) AS length,
       CAST(NULL AS VARCHAR) AS precision, CAST(NULL AS VARCHAR) AS scale, count(*) > count(doc_id) AS nullable,
       'bigint' AS type_label FROM documents
UNION ALL SELECT 2, 'text', 'string', max(length(text)), NULL, NULL, count(*) > count(text),
       'string(' || CAST(max(length(text)) AS VARCHAR) || ')' FROM documents
UNION ALL SELECT 3, 'lang', 'string', max(length(lang)), NULL, NULL, count(*) > count(lang),
       'string(' || CAST(max(length(lang)) AS VARCHAR) || ')' FROM documents
UNION ALL SELECT 4, 'source', 'string', max(length(source)), NULL, NULL, count(*) > count(source),
       'string(' || CAST(max(length(source)) AS VARCHAR) || ')' FROM documents
UNION ALL SELECT 5, 'n_chars', 'bigint', 0, NULL, NULL, count(*) > count(n_chars), 'bigint' FROM documents""")
def q_profile_documents(spark, d):
    return as_text(project.profile_columns(table(spark, d, "documents")), "precision", "scale")


# =========================================================================== one-shot run

def _migration_snapshot(spark, d):
    from ..refresh import catalog_from_tables, refresh_snapshot
    tabs = {t: table(spark, d, t) for t in ("orders", "customer", "nation")}
    snap = refresh_snapshot(None, catalog_from_tables(spark, tabs, "tpch"))
    # user edits: only the key columns are declared NOT NULL
    snap["columns"] = snap["columns"].withColumn(
        "nullable", ~F.col("column_name").isin("o_orderkey", "c_custkey", "n_nationkey"))
    snap["partitions"] = spark.createDataFrame(
        [("tpch", "orders", "o_low", "RANGE", "o_totalprice", False, ["MINVALUE", "100000"]),
         ("tpch", "orders", "o_high", "RANGE", "o_totalprice", False, ["100000", "MAXVALUE"])],
        "schema string, table_name string, partition_name string, type string, key string, is_default boolean, "
        "values array<string>")
    snap["subpartitions"] = spark.createDataFrame(
        [("tpch", "orders", "o_low", f"o_low_{i}", "HASH", "o_orderkey", False, [str(i)]) for i in range(2)],
        "schema string, table_name string, partition_name string, subpartition_name string, type string, "
        "key string, is_default boolean, values array<string>")
    snap["keys"] = spark.createDataFrame(
        [("tpch", "orders", "orders_pk", False, False, "o_orderkey", 1, True, True),
         ("tpch", "customer", "customer_pk", False, False, "c_custkey", 1, True, True),
         ("tpch", "nation", "nation_pk", False, False, "n_nationkey", 1, True, True)],
        "schema string, table_name string, constraint_name string, deferrable boolean, deferred boolean, "
        "column_name string, position int, is_primary boolean, migrate boolean")
    snap["foreign_keys"] = spark.createDataFrame(
        [("tpch", "orders", "orders_cust_fk", False, False, "NO ACTION", "o_custkey", 1, "tpch", "customer",
          "c_custkey", True),
         ("tpch", "customer", "customer_nation_fk", True, True, "CASCADE", "c_nationkey", 1, "tpch", "nation",
          "n_nationkey", True)],
        "schema string, table_name string, constraint_name string, deferrable boolean, deferred boolean, "
        "delete_rule string, column_name string, position int, remote_schema string, remote_table string, "
        "remote_column string, migrate boolean")
    snap["checks"] = spark.createDataFrame(
        [("tpch", "orders", "orders_total_ck", False, False, "o_totalprice > 1000", True),
         ("tpch", "customer", "customer_bal_ck", False, False, "c_acctbal >= 0", True)],
        "schema string, table_name string, constraint_name string, deferrable boolean, deferred boolean, "
        "condition string, migrate boolean")
    snap["indexes"] = spark.createDataFrame(
        [("tpch", "customer", "customer_name_idx", True, None, True)],
        "schema string, table_name string, index_name string, uniqueness boolean, where_clause string, "
        "migrate boolean")
    snap["index_columns"] = spark.createDataFrame(
        [("tpch", "customer", "customer_name_idx", 1, False, False, "c_name")],
        "schema string, table_name string, index_name string, position int, descend boolean, "
        "is_expression boolean, column_name string")
    return snap


@query("migrate_run", """
SELECT 'tpch.orders' AS table_name, 'orders_pk' AS constraint_name, 'PRIMARY KEY' AS constraint_type,
       'immediate' AS timing,
       CAST((SELECT coalesce(sum(n), 0) FROM (SELECT count(*) AS n FROM orders GROUP BY o_orderkey
             HAVING count(*) > 1 OR o_orderkey IS NULL)) AS BIGINT) AS violations, CAST(NULL AS VARCHAR) AS error
UNION ALL SELECT 'tpch.orders', 'orders_cust_fk', 'FOREIGN KEY', 'immediate',
       (SELECT count(*) FROM orders o WHERE o_custkey IS NOT NULL
          AND NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = o.o_custkey)), NULL
UNION ALL SELECT 'tpch.orders', 'o_orderkey_not_null', 'NOT NULL', 'immediate',
       (SELECT count(*) - count(o_orderkey) FROM orders), NULL
UNION ALL SELECT 'tpch.orders', 'orders_total_ck', 'CHECK', 'immediate',
       (SELECT count(*) FROM orders WHERE NOT (o_totalprice > 1000)), NULL
UNION ALL SELECT 'tpch.customer', 'customer_pk', 'PRIMARY KEY', 'immediate',
       CAST((SELECT coalesce(sum(n), 0) FROM (SELECT count(*) AS n FROM customer GROUP BY c_custkey
             HAVING count(*) > 1 OR c_custkey IS NULL)) AS BIGINT), NULL
UNION ALL SELECT 'tpch.customer', 'customer_name_idx', 'UNIQUE', 'immediate',
       CAST((SELECT coalesce(sum(n), 0) FROM (SELECT count(*) AS n FROM customer WHERE c_name IS NOT NULL
             GROUP BY c_name HAVING count(*) > 1)) AS BIGINT), NULL
UNION ALL SELECT 'tpch.customer', 'customer_nation_fk', 'FOREIGN KEY', 'deferred',
       (SELECT count(*) FROM customer c WHERE c_nationkey IS NOT NULL
          AND NOT EXISTS (SELECT 1 FROM nation n WHERE n.n_nationkey = c.c_nationkey)), NULL
UNION ALL SELECT 'tpch.customer', 'c_custkey_not_null', 'NOT NULL', 'immediate',
       (SELECT count(*) - count(c_custkey) FROM customer), NULL
UNION ALL SELECT 'tpch.customer', 'customer_bal_ck', 'CHECK', 'immediate',
       (SELECT count(*) FROM customer WHERE NOT (c_acctbal >= 0)), NULL
UNION ALL SELECT 'tpch.nation', 'nation_pk', 'PRIMARY KEY', 'immediate',
       CAST((SELECT coalesce(sum(n), 0) FROM (SELECT count(*) AS n FROM nation GROUP BY n_nationkey
             HAVING count(*) > 1 OR n_nationkey IS NULL)) AS BIGINT), NULL
UNION ALL SELECT 'tpch.nation', 'n_nationkey_not_null', 'NOT NULL', 'immediate',
       (SELECT count(*) - count(n_nationkey) FROM nation), NULL""")
def q_migrate_run(spark, d):
    from ..migrate import migrate

    def read(schema, source, columns):
        return scan_declared(spark, "parquet", f"{d}/{source}.parquet", columns)
    _, _, report = migrate(spark, _migration_snapshot(spark, d), read, scratch_path(spark, "migrate"), parallelism=4)
    return report


@query("migrate_rows", """
SELECT 'orders' AS table_name, CAST(o_orderkey AS VARCHAR) AS own_key, CAST(o_custkey AS VARCHAR) AS other,
       CASE WHEN o_totalprice < 100000 THEN 'o_low' ELSE 'o_high' END AS part FROM orders
UNION ALL SELECT 'customer', CAST(c_custkey AS VARCHAR), CAST(c_nationkey AS VARCHAR), NULL FROM customer
UNION ALL SELECT 'nation', CAST(n_nationkey AS VARCHAR), n_name, NULL FROM nation""")
def q_migrate_rows(spark, d):
    from ..migrate import migrate
    root = scratch_path(spark, "migrated")
    migrate(spark, _migration_snapshot(spark, d),
            lambda schema, source, columns: scan_declared(spark, "parquet", f"{d}/{source}.parquet", columns), root, parallelism=4)
    out = None
    for name, key, other, part in (("orders", "o_orderkey", "o_custkey", F.col("part")), ("customer", "c_custkey", "c_nationkey", None),
                                   ("nation", "n_nationkey", "n_name", None)):
        rows = spark.read.parquet(f"{root}/tpch/{name}").select(
            F.lit(name).alias("table_name"), F.col(key).cast("string").alias("own_key"), F.col(other).cast("string").alias("other"),
            (F.lit(None) if part is None else part).cast("string").alias("part"))
        out = rows if out is None else out.unionByName(rows)
    return out


# =========================================================================== refresh of the other snapshot tables
#
# A catalog of many objects is derived from a table: the objects known before (keys not divisible
# by 3) are edited by the user, then refreshed from the objects that exist now (not divisible by 5).

_OLD, _NEW = "{k} % 3 <> 0", "{k} % 5 <> 0"


def _refreshed(name, objects, key, before, now, edits):
    """Snapshot table ``name``: built from ``before``, edited, refreshed from ``now`` (SQL per column)."""
    from ..refresh import refresh_table

    def catalog(columns, which):
        return objects.filter(which.format(k=key)).selectExpr(*[f"{e} AS `{c}`" for c, e in columns.items()])
    edited = refresh_table(name, None, catalog(before, _OLD))
    for column, expression in edits.items():
        edited = edited.withColumn(column, F.expr(expression))
    return refresh_table(name, edited, catalog(now, _NEW))


def _merged_sql(table_name, key, columns):
    """Rows known before or now; in the column texts {old} and {new} say where a row comes from."""
    return f"WITH b AS (SELECT *, {_OLD.format(k=key)} AS old, {_NEW.format(k=key)} AS new FROM {table_name}) SELECT " + \
        ", ".join(f"{e} AS {c}" for c, e in columns.items()) + " FROM b WHERE (old OR new)"


@query("refresh_tables", _merged_sql("customer", "c_custkey", {
    "schema": "c_mktsegment", "table_name": "c_name", "orig_table": "c_name",
    "migrate": "CASE WHEN old THEN c_acctbal > 0 ELSE true END"}))
def q_refresh_tables(spark, d):
    from ..refresh import refresh_table
    customer = table(spark, d, "customer")

    def listed(which):
        return customer.filter(which.format(k="c_custkey")).selectExpr("c_mktsegment AS schema", "c_name AS table_name")
    old = refresh_table("tables", None, listed(_OLD))
    # the user unflags tables by a list of names
    poor = customer.filter("c_acctbal <= 0").selectExpr("c_name AS table_name", "true AS poor")
    edited = old.join(poor, "table_name", "left").withColumn("migrate", F.col("poor").isNull()).select(*old.columns)
    return refresh_table("tables", edited, listed(_NEW)).select("schema", "table_name", "orig_table", "migrate")


@query("refresh_checks", _merged_sql("orders", "o_orderkey", {
    "schema": "'s'", "table_name": "'t' || (o_custkey % 50)", "constraint_name": "'ck' || o_orderkey",
    "deferrable": "CASE WHEN new THEN o_orderkey % 2 = 0 ELSE false END", "deferred": "false",
    "condition": "CASE WHEN new THEN 'total < ' || o_custkey ELSE 'total > ' || o_custkey END",
    "orig_name": "'ck' || o_orderkey", "migrate": "CASE WHEN old THEN false ELSE true END"})
    + " AND NOT (o_orderkey % 7 = 0)")
def q_refresh_checks(spark, d):
    def columns(condition, deferrable):
        # every seventh condition only says that a column is not null, which the catalog leaves to the columns
        return {"schema": "'s'", "table_name": "concat('t', o_custkey % 50)", "constraint_name": "concat('ck', o_orderkey)",
                "deferrable": deferrable, "deferred": "false",
                "condition": f"CASE WHEN o_orderkey % 7 = 0 THEN 'Total IS NOT NULL' ELSE concat('{condition} ', o_custkey) END"}
    return _refreshed("checks", table(spark, d, "orders"), "o_orderkey", columns("total >", "false"),
                      columns("total <", "o_orderkey % 2 = 0"), {"migrate": "false"})


@query("refresh_foreign_keys", _merged_sql("orders", "o_orderkey", {
    "schema": "'s'", "table_name": "'t'", "constraint_name": "'fk' || o_orderkey", "position": "1",
    "deferrable": "CASE WHEN new THEN true ELSE false END", "deferred": "false",
    "delete_rule": "CASE WHEN new THEN 'CASCADE' ELSE 'NO ACTION' END", "column_name": "'c' || o_custkey",
    "remote_schema": "'s'", "remote_table": "'r'", "remote_column": "'id'", "orig_name": "'fk' || o_orderkey",
    "migrate": "CASE WHEN old THEN false ELSE true END"}))
def q_refresh_foreign_keys(spark, d):
    def columns(deferrable, rule):
        return {"schema": "'s'", "table_name": "'t'", "constraint_name": "concat('fk', o_orderkey)", "position": "1",
                "deferrable": deferrable, "deferred": "false", "delete_rule": f"'{rule}'", "column_name": "concat('c', o_custkey)",
                "remote_schema": "'s'", "remote_table": "'r'", "remote_column": "'id'"}
    return _refreshed("foreign_keys", table(spark, d, "orders"), "o_orderkey", columns("false", "NO ACTION"),
                      columns("true", "CASCADE"), {"migrate": "false"})


@query("refresh_sequences", _merged_sql("part", "p_partkey", {
    "schema": "'s'", "sequence_name": "'seq' || p_partkey", "min_value": "CAST(CASE WHEN p_size % 2 = 0 THEN 1 ELSE -9223372036854775808 END AS BIGINT)",
    "max_value": "CAST(9223372036854775807 AS BIGINT)", "increment_by": "CAST(CASE WHEN new THEN p_size ELSE 1 END AS BIGINT)",
    "cyclical": "false", "cache_size": "CASE WHEN new THEN greatest(p_size - 20, 1) ELSE 1 END",
    "last_value": "CAST(CASE WHEN old THEN 77 ELSE p_size END AS BIGINT)", "orig_value": "CAST(p_size AS BIGINT)"}))
def q_refresh_sequences(spark, d):
    def columns(increment, cache):
        # bounds of another system, far beyond bigint
        return {"schema": "'s'", "sequence_name": "concat('seq', p_partkey)",
                "min_value": "CAST(CASE WHEN p_size % 2 = 0 THEN 1 ELSE -1e30 END AS decimal(38,0))",
                "max_value": "CAST(9999999999999999999999999999 AS decimal(38,0))", "increment_by": f"CAST({increment} AS decimal(38,0))",
                "cyclical": "false", "cache_size": cache, "last_value": "CAST(p_size AS decimal(38,0))"}
    return _refreshed("sequences", table(spark, d, "part"), "p_partkey", columns("1", "0"), columns("p_size", "p_size - 20"),
                      {"last_value": "CAST(77 AS bigint)"})


@query("refresh_indexes", _merged_sql("part", "p_partkey", {
    "schema": "'s'", "table_name": "p_brand", "index_name": "'ix' || p_partkey", "uniqueness": "CASE WHEN new THEN true ELSE false END",
    "where_clause": "CASE WHEN old THEN 'size > 1' ELSE 'size > ' || p_size END", "orig_name": "'ix' || p_partkey",
    "migrate": "true"}))
def q_refresh_indexes(spark, d):
    part = table(spark, d, "part")

    def columns(unique):
        return {"schema": "'s'", "table_name": "p_brand", "index_name": "concat('ix', p_partkey)", "uniqueness": unique,
                "where_clause": "concat('size > ', p_size)"}
    # a catalog may list an index once per column: equal rows count once
    return _refreshed("indexes", part.unionByName(part), "p_partkey", columns("false"), columns("true"),
                      {"where_clause": "'size > 1'"})


@query("refresh_partitions", _merged_sql("part", "p_partkey", {
    "schema": "'s'", "table_name": "p_brand", "partition_name": "'p' || p_partkey", "type": "CASE WHEN new THEN 'LIST' ELSE 'RANGE' END",
    "key": "'size'", "is_default": "p_size = 1",
    "listed": "CASE WHEN p_size = 1 THEN NULL WHEN new THEN '1,' || p_size ELSE '0,' || p_size END", "orig_name": "'p' || p_partkey"}))
def q_refresh_partitions(spark, d):
    def columns(kind, first):
        # a default partition has no values and must survive the refresh
        return {"schema": "'s'", "table_name": "p_brand", "partition_name": "concat('p', p_partkey)", "type": f"'{kind}'", "key": "'size'",
                "is_default": "p_size = 1",
                "values": f"CASE WHEN p_size <> 1 THEN array('{first}', CAST(p_size AS string)) END"}
    out = _refreshed("partitions", table(spark, d, "part"), "p_partkey", columns("RANGE", "0"), columns("LIST", "1"), {})
    return out.withColumn("listed", F.array_join("values", ",")).drop("values")
