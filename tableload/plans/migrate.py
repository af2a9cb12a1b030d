"""One-shot load driven by the catalog snapshot.

The snapshot tables (tables, columns, partitions, keys, foreign keys, checks, indexes,
views) describe what to load and which rules must hold.  They are metadata -- one row per
table, column or constraint -- so they are turned into driver-side specs (key columns are
put in order with ``ordered_group_collect`` first).  The run then

1. loads every flagged table from its source through the declared columns, routed into
   its partitions when it has any, all-or-nothing per table (S5);
2. creates the given SQL functions (UF1), defines the flagged views (V1), whose
   definitions are Spark SQL over the loaded tables of their schema (registered as temp
   views under their table names before each definition, which is resolved at once), and optionally writes a clustered
   copy per plain index (X1);
3. validates keys, unique indexes (also partial ones), foreign keys, not-null rules and
   checks on the loaded tables (I7).

A table that fails to load, a view that fails to define and a rule that fails or finds
violations each become a row of the run log; the run goes on.  Returns the number of
failures, the log and the constraint report.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.sqlfuncs import FunctionSpec, register_sql_function
from ..operators.integrity import RulesOnLoad, TableRules, load_order
from ..operators.relops import ordered_group_collect
from ..operators.rewrite import define_view
from ..specs import (CheckSpec, ColumnSpec, ForeignKeySpec, KeySpec, Partition, PartitionLevel, PartitionScheme,
                     SequenceSpec, ordered)
from .materialize import TableLoad, clustered_copy, materialize_many
from .runlog import LOG_SCHEMA, Step, run_logged

ReadTable = Callable[[str, str, list[ColumnSpec]], DataFrame]   # (schema, source table, columns) -> rows


@dataclass
class TablePlan:
    schema: str
    name: str
    source: str
    columns: list[ColumnSpec]
    scheme: PartitionScheme | None = None
    keys: list[KeySpec] = field(default_factory=list)
    foreign_keys: list[ForeignKeySpec] = field(default_factory=list)
    checks: list[CheckSpec] = field(default_factory=list)
    # non-unique indexes: (name, [(column or expression, descending)], where clause)
    clusterings: list[tuple[str, list[tuple[str, bool]], str | None]] = field(default_factory=list)

    @property
    def qualified(self) -> str:
        return f"{self.schema}.{self.name}"


def _flagged(df: DataFrame | None) -> DataFrame | None:
    return None if df is None else (df.filter(F.col("migrate")) if "migrate" in df.columns else df)


def plan_from_snapshot(snapshot: dict[str, DataFrame]) -> list[TablePlan]:
    """Driver-side specs for every flagged table (the snapshot is catalog-sized).

    Key, index and foreign-key columns are put in order by ``ordered_group_collect``:
    a group is the column list of one constraint.
    """
    flagged = _flagged(snapshot["tables"])
    tables = flagged.select("schema", "table_name", "orig_table").collect()

    def of_tables(df: DataFrame) -> DataFrame:
        return df.join(flagged.select("schema", "table_name"), ["schema", "table_name"], "left_semi")
    plans = {(r["schema"], r["table_name"]): TablePlan(r["schema"], r["table_name"], r["orig_table"], [])
             for r in tables}

    for r in of_tables(snapshot["columns"]).collect():
        p = plans.get((r["schema"], r["table_name"]))
        if p is not None:
            p.columns.append(ColumnSpec(r["column_name"], r["type_name"], r["position"], r["orig_column"],
                                        bool(r["nullable"]), r["default_value"]))
    for p in plans.values():
        p.columns = ordered(p.columns)

    parts = snapshot.get("partitions")
    subs = snapshot.get("subpartitions")
    if parts is not None:
        sub_levels: dict[tuple, list] = {}
        if subs is not None:
            for r in of_tables(subs).collect():
                sub_levels.setdefault((r["schema"], r["table_name"], r["partition_name"]), []).append(r)
        top: dict[tuple, list] = {}
        for r in of_tables(parts).collect():
            top.setdefault((r["schema"], r["table_name"]), []).append(r)
        for key, rows in top.items():
            if key not in plans:
                continue

            def level(rs) -> PartitionLevel:
                return PartitionLevel(rs[0]["type"], rs[0]["key"], tuple(
                    Partition(x["partition_name"] if "subpartition_name" not in x else x["subpartition_name"],
                              tuple(x["values"]) if x["values"] is not None else None, bool(x["is_default"]))
                    for x in rs))
            sub = {r["partition_name"]: level([x.asDict() for x in sub_levels[(*key, r["partition_name"])]])
                   for r in rows if (*key, r["partition_name"]) in sub_levels}
            plans[key].scheme = PartitionScheme(level([x.asDict() for x in rows]), sub)

    if snapshot.get("keys") is not None:
        keys = ordered_group_collect(
            _flagged(snapshot["keys"]), ["schema", "table_name", "constraint_name", "is_primary", "deferrable",
                                        "deferred"], ["position"], ["column_name"])
        for r in keys.collect():
            p = plans.get((r["schema"], r["table_name"]))
            if p is not None:
                p.keys.append(KeySpec(r["constraint_name"], tuple(r["column_name"]), bool(r["is_primary"]),
                                      deferrable=bool(r["deferrable"]), deferred=bool(r["deferred"])))

    if snapshot.get("indexes") is not None and snapshot.get("index_columns") is not None:
        idx = _flagged(snapshot["indexes"])
        cols = snapshot["index_columns"].join(
            idx.select("schema", "index_name", "table_name", "where_clause", "uniqueness"),
            ["schema", "index_name", "table_name"], "inner")
        grouped = ordered_group_collect(cols, ["schema", "table_name", "index_name", "where_clause", "uniqueness"],
                                        ["position"], ["column_name", "descend", "is_expression"])
        for r in grouped.collect():
            p = plans.get((r["schema"], r["table_name"]))
            if p is None:
                continue
            where = r["where_clause"] if r["where_clause"] and r["where_clause"].strip() else None
            if r["uniqueness"]:          # a unique index is a uniqueness rule (I3)
                p.keys.append(KeySpec(r["index_name"], tuple(r["column_name"]), False, where=where,
                                      expressions=tuple(bool(x) for x in r["is_expression"])))
            else:                        # a plain index becomes a clustered copy (X1)
                # in parentheses an expression is no column's name
                p.clusterings.append((r["index_name"], [
                    (f"({c})" if text else c, bool(d))
                    for c, d, text in zip(r["column_name"], r["descend"], r["is_expression"])], where))

    if snapshot.get("foreign_keys") is not None:
        fks = ordered_group_collect(
            _flagged(snapshot["foreign_keys"]),
            ["schema", "table_name", "constraint_name", "remote_schema", "remote_table", "delete_rule", "deferrable",
             "deferred"], ["position"], ["column_name", "remote_column"])
        for r in fks.collect():
            p = plans.get((r["schema"], r["table_name"]))
            if p is not None and (r["remote_schema"], r["remote_table"]) in plans:    # both ends are flagged
                p.foreign_keys.append(ForeignKeySpec(
                    r["constraint_name"], tuple(r["column_name"]), f"{r['remote_schema']}.{r['remote_table']}",
                    tuple(r["remote_column"]), r["delete_rule"], bool(r["deferrable"]), bool(r["deferred"])))

    if snapshot.get("checks") is not None:
        for r in _flagged(snapshot["checks"]).collect():
            p = plans.get((r["schema"], r["table_name"]))
            if p is not None:
                p.checks.append(CheckSpec(r["constraint_name"], r["condition"]))
    return list(plans.values())


def sequences_from_snapshot(snapshot: dict[str, DataFrame]) -> dict[str, SequenceSpec]:
    """``schema.sequence_name`` -> :class:`SequenceSpec` for every sequence of the snapshot.

    Sequences have no flag: all are returned.  Use them with
    :func:`tableload.operators.sequences.assign_sequence`; numbering resumes after the
    catalogued last value.
    """
    seqs = snapshot.get("sequences")
    if seqs is None:
        return {}
    return {f"{r['schema']}.{r['sequence_name']}": SequenceSpec(
                r["sequence_name"], int(r["increment_by"]), int(r["last_value"]),
                r["min_value"], r["max_value"], bool(r["cyclical"]))
            for r in seqs.collect()}


def migrate(spark: SparkSession, snapshot: dict[str, DataFrame], read_table: ReadTable, target_root: str,
            parallelism: int = 1, with_data: bool = True, functions: list[FunctionSpec] | None = None,
            cluster_root: str | None = None):
    """Run the whole load; returns ``(failures, log DataFrame, constraint report)``.

    Tables load parents first, side by side up to ``parallelism``; a table's immediate rules
    are checked right after its load (a foreign key once both of its tables are there), the
    deferred ones after all loads.  Views that share a name are registered as
    ```schema.name```.

    With ``cluster_root`` every flagged non-unique index of a loaded table is written as
    a clustered copy below it (``<cluster_root>/<schema>/<index name>``); each copy is a
    full rewrite of the table, so this is opt-in.
    """
    plans = plan_from_snapshot(snapshot)
    root = target_root.rstrip("/")
    shapes: dict[str, StructType] = {}

    def build(p: TablePlan) -> DataFrame:
        df = read_table(p.schema, p.source, p.columns)
        shapes[p.qualified] = df.schema
        return df

    def read_back(name: str, path: str) -> DataFrame:
        # with the known schema, as an empty table has no file to infer one from; the
        # columns that partitions are routed by are not the table's own
        return spark.read.schema(shapes[name]).parquet(path).select(*[F.col(f"`{c}`") for c in shapes[name].names])
    logs = []
    failures = 0
    # functions first: checks and views may use them
    steps = [Step("create function", f.name, (lambda f=f: register_sql_function(spark, f.name, f.args, f.returns,
                                                                                 f.body) or True), None, f.body)
             for f in functions or () if f.migrate]
    if steps:
        done, step_log = run_logged(spark, steps)
        failures += len(steps) - len(done)
        logs.append(step_log)

    loaded: dict[str, DataFrame] = {}
    rules = RulesOnLoad([TableRules(p.qualified, (lambda p=p: loaded[p.qualified]),
                                    not_null=tuple(c.name for c in p.columns if not c.nullable),
                                    keys=tuple(p.keys), foreign_keys=tuple(p.foreign_keys), checks=tuple(p.checks),
                                    parents=loaded) for p in plans])

    def arrived(p: TablePlan, path: str) -> None:
        loaded[p.qualified] = read_back(p.qualified, path)
        rules.loaded(p.qualified)
    by_name = {p.qualified: p for p in plans}
    order = load_order(list(by_name), [(p.qualified, fk.parent) for p in plans for fk in p.foreign_keys])
    loads = [TableLoad(p.qualified, (lambda p=p: build(p)), f"{root}/{p.schema}/{p.name}", p.scheme, True, with_data,
                       p.schema, (lambda path, p=p: arrived(p, path))) for p in (by_name[n] for n in order)]
    missed, _, load_log = materialize_many(spark, loads, parallelism)
    failures += missed
    logs.append(load_log)
    views = _flagged(snapshot.get("views"))
    view_rows = views.collect() if views is not None else []
    view_names = [r["view_name"] for r in view_rows]
    view_columns: dict[tuple, list[str]] = {}
    if view_rows:
        listed = snapshot["columns"].join(views.select("schema", F.col("view_name").alias("table_name")),
                                          ["schema", "table_name"], "left_semi")
        for r in sorted(listed.collect(), key=lambda r: r["position"]):
            view_columns.setdefault((r["schema"], r["table_name"]), []).append(r["column_name"])

    def view(r) -> DataFrame:
        for p in plans:                # the names of the view's own schema
            if p.schema == r["schema"] and p.qualified in loaded:
                loaded[p.qualified].createOrReplaceTempView(p.name)
        name = r["view_name"]
        if view_names.count(name) > 1:          # one name in several schemas: each keeps its own
            name = f"`{r['schema']}.{name}`"
        return define_view(spark, name, spark.sql(r["definition"]), view_columns.get((r["schema"], r["view_name"])))
    steps = [Step("define view", f"{r['schema']}.{r['view_name']}",
                   (lambda r=r: view(r)), r["schema"], r["definition"])
              for r in view_rows]
    if steps:
        done, step_log = run_logged(spark, steps)
        failures += len(steps) - len(done)
        logs.append(step_log)
    if cluster_root:          # independent table rewrites: submitted side by side
        croot = cluster_root.rstrip("/")
        copies = [Step("create index", f"{p.schema}.{name}",
                       (lambda p=p, name=name, keys=keys, where=where: clustered_copy(
                           loaded[p.qualified], keys, f"{croot}/{p.schema}/{name}", where=where)),
                       p.schema, f"cluster {p.qualified} on {keys}" + (f" where {where}" if where else ""))
                  for p in plans if p.qualified in loaded for name, keys, where in p.clusterings]
        if copies:
            done, copy_log = run_logged(spark, copies, parallelism)
            failures += len(copies) - len(done)
            logs.append(copy_log)

    report = rules.finish(spark, parallelism)
    bad = report.filter(F.col("error").isNotNull() | (F.col("violations") > 0)).collect()
    failures += len(bad)
    rule_rows = [(None, i, None, "validate constraint", r["table_name"].split(".")[0], r["table_name"],
                  f"{r['constraint_type']} {r['constraint_name']}",
                  r["error"] or f"{r['violations']} violating rows: {r['constraint_type']}")
                 for i, r in enumerate(bad)]
    rule_log = spark.createDataFrame(rule_rows, LOG_SCHEMA).withColumn("log_time", F.current_timestamp())
    log = logs[0]
    for extra in logs[1:] + [rule_log]:
        log = log.unionByName(extra)
    return failures, log, report
