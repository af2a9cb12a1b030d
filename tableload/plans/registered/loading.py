"""Queries for scans, the text format, materialization and projections (S*, P*)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ...functions.scalars import at_least, clamp_to_bigint
from ...operators import project, routing
from ...session import scratch_path
from ...sources import scan_declared, scan_delimited, to_text_lines
from ...sources.delimited import encode_text_field
from ...specs import ColumnSpec, Partition, PartitionLevel, PartitionScheme
from .. import materialize as mat
from ..incremental import load_checked, load_delimited, upsert_partitioned
from ..runlog import Step, failure_tally, run_logged
from .base import as_text, query, table


# =========================================================================== sources

ORDER_COLUMNS = [  # listed out of order on purpose: position decides
    ColumnSpec("total", "double precision", 4, "o_totalprice"),
    ColumnSpec("order_id", "bigint", 1, "o_orderkey"),
    ColumnSpec("priority", "text", 6, "o_orderpriority"),
    ColumnSpec("customer_id", "int8", 2, "o_custkey"),
    ColumnSpec("ordered_at", "timestamp", 5, "o_orderdate"),
    ColumnSpec("status", "varchar(1)", 3, "o_orderstatus"),
]


@query("scan_declared", """
SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS status,
       o_totalprice AS total, o_orderdate AS ordered_at, o_orderpriority AS priority
FROM orders""")
def q_scan_declared(spark, d):
    return scan_declared(spark, "parquet", f"{d}/orders.parquet", ORDER_COLUMNS)


SUPPLIER_COLUMNS = [ColumnSpec("s_suppkey", "bigint", 1), ColumnSpec("s_name", "text", 2),
                    ColumnSpec("s_nationkey", "int", 3), ColumnSpec("s_acctbal", "double precision", 4)]


@query("scan_declared_csv", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def q_scan_declared_csv(spark, d):
    path = scratch_path(spark, "csv")
    table(spark, d, "supplier").write.csv(path)
    return scan_declared(spark, "csv", path, SUPPLIER_COLUMNS)


DOC_COLUMNS = [ColumnSpec("doc_id", "bigint", 1), ColumnSpec("text", "text", 2),
               ColumnSpec("lang", "varchar(2)", 3), ColumnSpec("source", "text", 4),
               ColumnSpec("n_chars", "bigint", 5)]


@query("scan_delimited", """
SELECT doc_id, text, nullif(lang, 'en') AS lang, source, n_chars FROM documents""")
def q_scan_delimited(spark, d):
    docs = table(spark, d, "documents").select(
        "doc_id", "text", F.expr("nullif(lang, 'en')").alias("lang"), "source", "n_chars")
    path = scratch_path(spark, "copytext")
    to_text_lines(docs).write.text(path)                 # escapes line breaks and writes no end marker
    return scan_delimited(spark, path, DOC_COLUMNS, plain=True)


def _text_with_breaks(spark, d) -> str:
    """The documents in the text format, line breaks of a text written as backslash and line break."""
    whole = F.array_join(F.transform(F.split(F.coalesce("text", F.lit("")), "\n", -1), encode_text_field), "\\\n")
    docs = table(spark, d, "documents")
    path = scratch_path(spark, "copylines")
    docs.select(F.concat_ws("\t", F.col("doc_id").cast("string"), whole, encode_text_field(F.expr("nullif(lang, 'en')")),
                            encode_text_field(F.col("source")), F.col("n_chars").cast("string"))).write.text(path)
    return path


@query("scan_delimited_lines", """
SELECT doc_id, text, nullif(lang, 'en') AS lang, source, n_chars FROM documents""")
def q_scan_delimited_lines(spark, d):
    return scan_delimited(spark, _text_with_breaks(spark, d), DOC_COLUMNS)


@query("load_delimited", """
SELECT 'good' AS outcome, doc_id, length(text) AS n, CAST(NULL AS VARCHAR) AS error FROM documents WHERE length(text) <= 2000
UNION ALL
SELECT 'rejected', doc_id, length(text), 'text: varchar(2000)' FROM documents WHERE length(text) > 2000""")
def q_load_delimited(spark, d):
    columns = [ColumnSpec(c.name, "varchar(2000)" if c.name == "text" else c.type_name, c.position) for c in DOC_COLUMNS]
    done = load_delimited(spark, _text_with_breaks(spark, d), columns, scratch_path(spark, "s2good"), scratch_path(spark, "s2bad"))
    good = done.good.select(F.lit("good").alias("outcome"), "doc_id", F.length("text").cast("bigint").alias("n"),
                            F.lit(None).cast("string").alias("error"))
    return good.unionByName(done.rejected.select(
        F.lit("rejected").alias("outcome"), F.col("doc_id").cast("bigint").alias("doc_id"),
        F.length("text").cast("bigint").alias("n"), F.concat_ws(": ", "error_column", "error_type").alias("error")))


# =========================================================================== materialization

@query("materialize_table", "SELECT * FROM supplier")
def q_materialize_table(spark, d):
    path = mat.materialize_table(table(spark, d, "supplier"), scratch_path(spark, "s3"))
    return spark.read.parquet(path)


@query("materialize_shape", "SELECT * FROM supplier WHERE false")
def q_materialize_shape(spark, d):
    path = mat.materialize_table(table(spark, d, "supplier"), scratch_path(spark, "s3shape"), with_data=False)
    return spark.read.parquet(path)


ORDERS_SCHEME = PartitionScheme(
    PartitionLevel("RANGE", "o_totalprice", (
        Partition("low", ("MINVALUE", "50000")),
        Partition("mid", ("50000", "150000")),
        Partition("high", ("150000", "MAXVALUE")))),
    {"low": PartitionLevel("HASH", "o_orderkey", tuple(Partition(f"low_{i}", (str(i),)) for i in range(3))),
     "mid": PartitionLevel("LIST", "o_orderstatus", (
         Partition("mid_f", ("'F'",)), Partition("mid_o", ("'O'",)), Partition("mid_rest", None, True)))})


@query("materialize_partitioned", """
SELECT part, subpart, CAST(count(*) AS BIGINT) AS rows FROM (
  SELECT CASE WHEN o_totalprice < 50000 THEN 'low' WHEN o_totalprice < 150000 THEN 'mid' ELSE 'high' END AS part,
         CASE WHEN o_totalprice < 50000 THEN 'low_' || CAST(o_orderkey % 3 AS VARCHAR)
              WHEN o_totalprice < 150000 THEN CASE o_orderstatus WHEN 'F' THEN 'mid_f' WHEN 'O' THEN 'mid_o'
                                                                 ELSE 'mid_rest' END END AS subpart
  FROM orders) GROUP BY part, subpart""")
def q_materialize_partitioned(spark, d):
    path = mat.materialize_partitioned(table(spark, d, "orders"), ORDERS_SCHEME, scratch_path(spark, "s4"),
                                       hash_fn=routing.identity_hash)
    return (spark.read.parquet(path).groupBy("part", "subpart")
            .agg(F.count(F.lit(1)).alias("rows")))


@query("materialize_partitioned_rows", """
SELECT o_orderkey, o_custkey, o_totalprice,
       CASE WHEN o_totalprice < 50000 THEN 'low' WHEN o_totalprice < 150000 THEN 'mid' ELSE 'high' END AS part,
       CASE WHEN o_totalprice < 50000 THEN 'low_' || CAST(o_orderkey % 3 AS VARCHAR)
            WHEN o_totalprice < 150000 THEN CASE o_orderstatus WHEN 'F' THEN 'mid_f' WHEN 'O' THEN 'mid_o'
                                                               ELSE 'mid_rest' END END AS subpart
FROM orders""")
def q_materialize_partitioned_rows(spark, d):
    path = mat.materialize_partitioned(table(spark, d, "orders"), ORDERS_SCHEME, scratch_path(spark, "s4rows"),
                                       hash_fn=routing.identity_hash)
    return spark.read.parquet(path).select("o_orderkey", "o_custkey", "o_totalprice", "part", "subpart")


BY_KEY = PartitionLevel("RANGE", "o_orderkey", tuple(
    Partition(f"k{i:02d}", (str(i * 10000), str(i * 10000 + 10000))) for i in range(100)) + (Partition("k_rest", None, True),))


def _orders_part(spark, d):
    path = mat.materialize_partitioned(table(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus"),
                                       BY_KEY, scratch_path(spark, "orders-by-key"))
    # changed prices of two key ranges, and keys that the table does not have yet
    some = table(spark, d, "orders").filter("o_orderkey < 700 AND o_orderkey % 5 = 0")
    return path, some.select("o_orderkey", (F.col("o_totalprice") + 1).alias("o_totalprice")).unionByName(
        some.select((F.col("o_orderkey") + 2000000).alias("o_orderkey"), "o_totalprice"))


_PART_OF_KEY = """CASE WHEN o_orderkey < 1000000 THEN 'k' || lpad(CAST(o_orderkey // 10000 AS VARCHAR), 2, '0') ELSE 'k_rest' END AS part"""


@query("upsert_partitions_update", f"""
SELECT o_orderkey, CASE WHEN o_orderkey < 700 AND o_orderkey % 5 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
       o_orderstatus, {_PART_OF_KEY} FROM orders
UNION ALL
SELECT o_orderkey + 2000000, o_totalprice, 'N', 'k_rest' FROM orders WHERE o_orderkey < 700 AND o_orderkey % 5 = 0""")
def q_upsert_partitions_update(spark, d):
    path, source = _orders_part(spark, d)
    upsert_partitioned(spark, path, source, ["o_orderkey"], BY_KEY, ["o_totalprice"], {"o_orderstatus": "'N'"})
    return spark.read.parquet(path)


@query("upsert_partitions_ignore", f"""
SELECT o_orderkey, o_totalprice, o_orderstatus, {_PART_OF_KEY} FROM orders
UNION ALL
SELECT o_orderkey + 2000000, o_totalprice, 'N', 'k_rest' FROM orders WHERE o_orderkey < 700 AND o_orderkey % 5 = 0""")
def q_upsert_partitions_ignore(spark, d):
    path, source = _orders_part(spark, d)
    upsert_partitioned(spark, path, source, ["o_orderkey"], BY_KEY, None, {"o_orderstatus": "'N'"})
    return spark.read.parquet(path)


@query("run_log", """
SELECT CAST(row_number() OVER (ORDER BY r_regionkey) AS INTEGER) AS place, 'check balances' AS operation,
       'sales' AS schema_name, r_name AS object_name, 'customers of region ' || r_regionkey AS failed_sql,
       r_name || ': ' || n || ' customers below zero' AS error, true AS timed, CAST(1 AS BIGINT) AS runs
FROM (SELECT r_regionkey, r_name, count(*) FILTER (WHERE c_acctbal < 0) AS n, count(*) AS all_of_it
      FROM region JOIN nation ON n_regionkey = r_regionkey JOIN customer ON c_nationkey = n_nationkey
      GROUP BY r_regionkey, r_name)
WHERE 11 * n > all_of_it""")
def q_run_log(spark, d):
    log = _balance_log(spark, d)
    order = Window.orderBy("ordinal")                                # the log: one row per failed step
    runs = log.select("run_id").distinct().agg(F.count(F.lit(1)).alias("runs"))
    return log.select(F.row_number().over(order).alias("place"), "operation", "schema_name", "object_name", "failed_sql",
                      F.regexp_extract("error_message", r"[A-Z][A-Z ]+: \d+ customers below zero", 0).alias("error"),
                      F.col("log_time").isNotNull().alias("timed")).join(F.broadcast(runs), F.lit(True))


def _balance_log(spark, d):
    """Log of one step per region; those with more than one customer in eleven below zero fail."""
    nations, customers = table(spark, d, "nation"), table(spark, d, "customer")

    def step(r):
        def run():
            rows = nations.filter(F.col("n_regionkey") == r["r_regionkey"]).join(customers, F.col("c_nationkey") == F.col("n_nationkey"))
            seen = rows.agg(F.count_if(F.col("c_acctbal") < 0).alias("n"), F.count(F.lit(1)).alias("m"))
            text = F.concat(F.lit(r["r_name"] + ": "), F.col("n").cast("string"), F.lit(" customers below zero"))
            return seen.select(F.when(11 * F.col("n") > F.col("m"), F.raise_error(text)).otherwise(F.lit("fine"))).first()
        return Step("check balances", r["r_name"], run, "sales", f"customers of region {r['r_regionkey']}")

    regions = table(spark, d, "region").orderBy("r_regionkey").collect()
    return run_logged(spark, [step(r) for r in regions])[1]


BAD_PART_COLUMNS = [ColumnSpec("p_partkey", "bigint", 1), ColumnSpec("p_brand", "int", 2)]


def _many(spark, d):
    loads = [
        mat.TableLoad("orders", lambda: scan_declared(spark, "parquet", f"{d}/orders.parquet", ORDER_COLUMNS),
                      scratch_path(spark, "s5-orders")),
        mat.TableLoad("part", lambda: scan_declared(spark, "parquet", f"{d}/part.parquet", BAD_PART_COLUMNS),
                      scratch_path(spark, "s5-part")),
        mat.TableLoad("lineitem", lambda: table(spark, d, "lineitem"), scratch_path(spark, "s5-skip"),
                      migrate=False),
    ]
    failures, written, log = mat.materialize_many(spark, loads, parallelism=2)
    return loads, written, log


@query("materialize_many", """
SELECT 'orders' AS table_name, true AS loaded, CAST(count(*) AS BIGINT) AS rows FROM orders
UNION ALL SELECT 'part', false, CAST(0 AS BIGINT)""")
def q_materialize_many(spark, d):
    loads, written, _ = _many(spark, d)
    parts = []
    for t in loads:
        if not t.migrate:
            continue
        if t.name in written:
            parts.append(spark.read.parquet(written[t.name]).agg(F.count(F.lit(1)).alias("rows"))
                         .select(F.lit(t.name).alias("table_name"), F.lit(True).alias("loaded"), "rows"))
        else:
            parts.append(spark.createDataFrame([(t.name, False, 0)], "table_name string, loaded boolean, rows bigint"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("failure_tally_regions", """
SELECT 'check balances' AS operation, CAST(count(*) AS BIGINT) AS failures FROM (
  SELECT r_regionkey FROM region JOIN nation ON n_regionkey = r_regionkey JOIN customer ON c_nationkey = n_nationkey
  GROUP BY r_regionkey HAVING 11 * count(*) FILTER (WHERE c_acctbal < 0) > count(*)) HAVING count(*) > 0
UNION ALL
SELECT 'total', CAST(count(*) AS BIGINT) FROM (
  SELECT r_regionkey FROM region JOIN nation ON n_regionkey = r_regionkey JOIN customer ON c_nationkey = n_nationkey
  GROUP BY r_regionkey HAVING 11 * count(*) FILTER (WHERE c_acctbal < 0) > count(*))""")
def q_failure_tally_regions(spark, d):
    return failure_tally(_balance_log(spark, d))


@query("failure_tally", """
SELECT 'materialize table' AS operation, CAST(1 AS BIGINT) AS failures
UNION ALL SELECT 'total', CAST(1 AS BIGINT)""")
def q_failure_tally(spark, d):
    _, _, log = _many(spark, d)
    return failure_tally(log)


# =========================================================================== projections

@query("project_rounded", """
SELECT l_orderkey, l_linenumber, CAST(l_extendedprice AS BIGINT) AS price FROM lineitem""")
def q_project_rounded(spark, d):
    return project.project_mapped(table(spark, d, "lineitem"), [
        ColumnSpec("l_orderkey", "bigint", 1), ColumnSpec("l_linenumber", "int", 2),
        ColumnSpec("price", "bigint", 3, "l_extendedprice")])


_PART_TEXT = """
SELECT p_partkey,
       CASE WHEN p_size > 40 THEN CAST(p_size AS VARCHAR) || 'x' ELSE CAST(p_size AS VARCHAR) END AS size_txt,
       substr(p_brand, 7) AS brand_no, p_name AS name, p_retailprice
FROM part"""


def _part_text(spark, d):
    return table(spark, d, "part").select(
        "p_partkey",
        F.when(F.col("p_size") > 40, F.concat(F.col("p_size").cast("string"), F.lit("x")))
        .otherwise(F.col("p_size").cast("string")).alias("size_txt"),
        F.expr("substr(p_brand, 7)").alias("brand_no"), F.col("p_name").alias("name"), "p_retailprice")


PART_CASTS = [("size_txt", "int"), ("brand_no", "integer"), ("name", "varchar(10)")]


@query("cast_sized_numeric", """
SELECT l_orderkey, l_linenumber, CAST(CAST(CAST(l_orderkey AS VARCHAR) || repeat('7', 24) AS DECIMAL(38,0)) AS VARCHAR) AS wide,
       CAST(CAST('-0.' || l_linenumber || repeat('0', 24) || '5' AS DECIMAL(38,26)) AS VARCHAR) AS fine
FROM lineitem""")
def q_cast_sized_numeric(spark, d):
    # numbers that the default split of an unbounded numeric cannot hold
    raw = table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", F.concat(F.col("l_orderkey").cast("string"), F.repeat(F.lit("7"), 24)).alias("wide"),
        F.concat(F.lit("-0."), F.col("l_linenumber").cast("string"), F.lit("0" * 24 + "5")).alias("fine"))
    sized = project.sized_numerics(raw, [("wide", "numeric"), ("fine", "decimal")])
    done = project.cast_checked(raw, sized)
    return done.select("l_orderkey", "l_linenumber", F.col("wide").cast("string").alias("wide"),
                       F.col("fine").cast("string").alias("fine"))


@query("cast_fail_mode", """
SELECT p_partkey, p_brand AS brand, CAST(p_size AS INTEGER) AS size, CAST(round(p_retailprice, 1) AS DOUBLE) AS price FROM part""")
def q_cast_fail_mode(spark, d):
    # spaces beyond the declared length are cut, anything else there would fail the job
    raw = table(spark, d, "part").select(
        "p_partkey", F.rpad(F.concat("p_brand", F.lit(" ")), 30, " ").alias("brand"),
        F.col("p_size").cast("string").alias("size"), F.round("p_retailprice", 1).cast("string").alias("price"))
    longest = raw.agg(F.max(F.length(F.rtrim("brand")))).first()[0] or 1
    done = project.cast_checked(raw, [("brand", f"varchar({longest})"), ("size", "integer"), ("price", "double precision")])
    return done.withColumn("brand", F.rtrim("brand"))


@query("load_checked", f"""
WITH p AS ({_PART_TEXT}),
good AS (SELECT p_partkey, TRY_CAST(size_txt AS INTEGER) AS size FROM p
         WHERE TRY_CAST(size_txt AS INTEGER) IS NOT NULL AND TRY_CAST(brand_no AS INTEGER) IS NOT NULL AND length(name) <= 10)
SELECT p_partkey, CASE WHEN size < 20 THEN 'small' ELSE 'large' END AS part, CAST(NULL AS VARCHAR) AS error_column FROM good WHERE size >= 5
UNION ALL SELECT p_partkey, NULL, '<partition>' FROM good WHERE size < 5
UNION ALL SELECT p_partkey, NULL, 'size_txt' FROM p WHERE TRY_CAST(size_txt AS INTEGER) IS NULL
UNION ALL SELECT p_partkey, NULL, 'brand_no' FROM p WHERE TRY_CAST(brand_no AS INTEGER) IS NULL
UNION ALL SELECT p_partkey, NULL, 'name' FROM p WHERE length(name) > 10""")
def q_load_checked(spark, d):
    sizes = PartitionLevel("RANGE", "size_txt", (Partition("small", ("5", "20")), Partition("large", ("20", "MAXVALUE"))))
    done = load_checked(_part_text(spark, d), PART_CASTS, scratch_path(spark, "good"), scratch_path(spark, "bad"), sizes)
    return done.good.select("p_partkey", "part", F.lit(None).cast("string").alias("error_column")).unionByName(
        done.rejected.select("p_partkey", F.lit(None).cast("string").alias("part"), "error_column"))


@query("cast_quarantine", f"""
WITH p AS ({_PART_TEXT})
SELECT p_partkey, 'size_txt' AS error_column, size_txt AS error_value, 'int' AS error_type
FROM p WHERE size_txt IS NOT NULL AND TRY_CAST(size_txt AS INTEGER) IS NULL
UNION ALL
SELECT p_partkey, 'brand_no', brand_no, 'integer' FROM p WHERE brand_no IS NOT NULL AND TRY_CAST(brand_no AS INTEGER) IS NULL
UNION ALL
SELECT p_partkey, 'name', name, 'varchar(10)' FROM p WHERE length(name) > 10""")
def q_cast_quarantine(spark, d):
    _, rejected = project.cast_checked(_part_text(spark, d), PART_CASTS, on_error="quarantine")
    return rejected.select("p_partkey", "error_column", "error_value", "error_type")


@query("cast_good", f"""
WITH p AS ({_PART_TEXT})
SELECT p_partkey, CAST(size_txt AS INTEGER) AS size_txt, CAST(brand_no AS INTEGER) AS brand_no, name, p_retailprice
FROM p WHERE TRY_CAST(size_txt AS INTEGER) IS NOT NULL AND TRY_CAST(brand_no AS INTEGER) IS NOT NULL
  AND length(name) <= 10""")
def q_cast_good(spark, d):
    good, _ = project.cast_checked(_part_text(spark, d), PART_CASTS, on_error="quarantine")
    return good


_BIG = ("CASE WHEN o_orderstatus = 'F' THEN -1 ELSE 1 END * CAST(o_totalprice AS DECIMAL(20,2)) "
        "* CAST(100000000000000 AS DECIMAL(15,0))")
_SMALL = ("CASE WHEN o_orderpriority = '5-LOW' THEN NULL WHEN o_orderstatus = 'O' "
          "THEN -CAST(o_totalprice AS DECIMAL(20,2)) ELSE CAST(o_totalprice AS DECIMAL(20,2)) END")


@query("clamp_bigint", f"""
SELECT o_orderkey,
  CASE WHEN big < -9223372036854775808 THEN CAST(-9223372036854775808 AS BIGINT)
       WHEN big > 9223372036854775807 THEN CAST(9223372036854775807 AS BIGINT)
       ELSE CAST(round(big) AS BIGINT) END AS clamped_big,
  CAST(CAST(round(small) AS BIGINT) AS VARCHAR) AS clamped_small
FROM (SELECT o_orderkey, {_BIG} AS big, {_SMALL} AS small FROM orders)""")
def q_clamp_bigint(spark, d):
    o = table(spark, d, "orders")
    return o.select("o_orderkey", clamp_to_bigint(F.expr(_BIG)).alias("clamped_big"),
                    clamp_to_bigint(F.expr(_SMALL)).cast("string").alias("clamped_small"))


DEFAULTS_TARGET = [ColumnSpec("order_id", "bigint", 1), ColumnSpec("priority", "text", 2),
                   ColumnSpec("note", "text", 3, default="'N/A'"), ColumnSpec("qty", "int", 4, default="0"),
                   ColumnSpec("flag", "boolean", 5, default="true")]


@query("apply_defaults", """
SELECT o_orderkey AS order_id, nullif(o_orderpriority, '1-URGENT') AS priority,
       'N/A' AS note, 0 AS qty, true AS flag FROM orders""")
def q_apply_defaults(spark, d):
    rows = table(spark, d, "orders").select(F.col("o_orderkey").alias("order_id"),
                                             F.expr("nullif(o_orderpriority, '1-URGENT')").alias("priority"))
    return project.apply_column_defaults(rows, DEFAULTS_TARGET)


@query("profile_columns", """
WITH c AS (SELECT c_custkey, c_name, c_nationkey, CAST(c_acctbal AS DECIMAL(12,2)) AS c_acctbal,
                  nullif(c_mktsegment, 'BUILDING') AS c_mktsegment FROM customer)
SELECT CAST(1 AS BIGINT) AS position, 'c_custkey' AS column_name, 'bigint' AS type_name, CAST(0 AS BIGINT) AS length,
       CAST(NULL AS VARCHAR) AS precision, CAST(NULL AS VARCHAR) AS scale, count(*) > count(c_custkey) AS nullable,
       'bigint' AS type_label FROM c
UNION ALL SELECT 2, 'c_name', 'string', max(length(c_name)), NULL, NULL, count(*) > count(c_name),
       'string(' || CAST(max(length(c_name)) AS VARCHAR) || ')' FROM c
UNION ALL SELECT 3, 'c_nationkey', 'int', 0, NULL, NULL, count(*) > count(c_nationkey), 'int' FROM c
UNION ALL SELECT 4, 'c_acctbal', 'decimal', 0, '12', '2', count(*) > count(c_acctbal), 'decimal(12,2)' FROM c
UNION ALL SELECT 5, 'c_mktsegment', 'string', max(length(c_mktsegment)), NULL, NULL,
       count(*) > count(c_mktsegment), 'string(' || CAST(max(length(c_mktsegment)) AS VARCHAR) || ')' FROM c""")
def q_profile_columns(spark, d):
    c = table(spark, d, "customer").select(
        "c_custkey", "c_name", "c_nationkey", F.col("c_acctbal").cast("decimal(12,2)").alias("c_acctbal"),
        F.expr("nullif(c_mktsegment, 'BUILDING')").alias("c_mktsegment"))
    return as_text(project.profile_columns(c), "precision", "scale")


@query("at_least", "SELECT p_partkey, coalesce(greatest(nullif(p_size, 1), 10), 10) AS size_floor FROM part")
def q_at_least(spark, d):
    p = table(spark, d, "part")
    return p.select("p_partkey", at_least(F.expr("nullif(p_size, 1)"), 10).alias("size_floor"))


@query("project_mapped", """
SELECT l_orderkey AS order_key, l_linenumber AS line_no, CAST(l_quantity AS BIGINT) AS quantity,
       l_returnflag AS return_flag FROM lineitem""")
def q_project_mapped(spark, d):
    cols = [ColumnSpec("return_flag", "char(1)", 4, "l_returnflag"), ColumnSpec("order_key", "bigint", 1, "l_orderkey"),
            ColumnSpec("quantity", "bigint", 3, "l_quantity"), ColumnSpec("line_no", "integer", 2, "l_linenumber")]
    return project.project_mapped(table(spark, d, "lineitem"), cols)
