"""Catalog snapshot refresh: re-read a remote catalog and merge it into the editable
snapshot, keeping the user's edits.

The snapshot is a set of small tables (schemas, tables, columns, checks, keys, ...).
Refreshing one table is a keyed upsert (U1 or U2) of the remote rows, after they were
shaped into the snapshot's form:

* identifier columns go through ``translate_identifier`` (the remote spelling is kept in
  the table's ``orig_*`` column), SQL expression columns through ``translate_expression``
  and catalogued types through ``translate_type``; all three default to identity and take
  a Column, so translation stays a JVM-side expression;
* schemas outside ``only_schemas`` are left out (matched on the remote spelling);
* check conditions that only say ``x IS NOT NULL`` are left to the column's ``nullable``;
* sequence bounds are clamped into bigint range and the cache size floored at 1;
* index rows are de-duplicated; partition bound arrays are translated element by element
  (NULL arrays of default partitions are kept);
* column types are labelled ``t``, ``t(len)``, ``t(p)`` or ``t(p,s)``.

On a key that already exists only the columns listed in ``update`` change; every other
column keeps its snapshot value; new keys take the listed defaults.  For ``columns`` and
``indexes`` a second unique key is checked afterwards (a renamed remote column would
otherwise produce two rows for one position).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import at_least, clamp_to_bigint, type_label
from ..operators.filters import keep_both_ends, keep_members
from ..operators.integrity import unique_violations
from ..operators.project import profile_columns
from ..operators.upsert import upsert_ignore, upsert_update
from ..session import checkpoint_root

Translate = Callable[[Column], Column]


@dataclass(frozen=True)
class SnapshotTable:
    keys: tuple[str, ...]
    update: tuple[str, ...] | None              # None: existing rows never change (insert or ignore)
    identifiers: tuple[str, ...] = ()           # translated as identifiers
    originals: tuple[tuple[str, str], ...] = ()  # (orig_* column, remote column it keeps)
    expressions: tuple[str, ...] = ()           # translated as SQL expressions
    defaults: tuple[tuple[str, str], ...] = ()  # (column, SQL default) for new rows
    unique: tuple[str, ...] | None = None       # second unique key checked after the merge


# Keys of the snapshot tables, the columns a refresh overwrites, the
# identifier and expression columns, and the defaults of newly added rows.
SNAPSHOT_TABLES: dict[str, SnapshotTable] = {
    "schemas": SnapshotTable(("schema",), None, ("schema",), (("orig_schema", "schema"),)),
    "tables": SnapshotTable(("schema", "table_name"), None, ("schema", "table_name"),
                            (("orig_table", "table_name"),), defaults=(("migrate", "true"),)),
    "columns": SnapshotTable(("schema", "table_name", "column_name"), ("orig_column", "orig_type"),
                             ("schema", "table_name", "column_name"),
                             (("orig_column", "column_name"), ("orig_type", "type_name")),
                             ("default_value",), (("options", "'{}'"),),
                             unique=("schema", "table_name", "position")),
    "checks": SnapshotTable(("schema", "table_name", "constraint_name"), ("deferrable", "deferred", "condition"),
                            ("schema", "table_name", "constraint_name"), (("orig_name", "constraint_name"),),
                            ("condition",), (("migrate", "true"),)),
    "foreign_keys": SnapshotTable(
        ("schema", "table_name", "constraint_name", "position"),
        ("deferrable", "deferred", "delete_rule", "column_name", "remote_schema", "remote_table", "remote_column"),
        ("schema", "table_name", "constraint_name", "column_name", "remote_schema", "remote_table", "remote_column"),
        (("orig_name", "constraint_name"),), (), (("migrate", "true"),)),
    "keys": SnapshotTable(("schema", "table_name", "constraint_name", "position"),
                          ("deferrable", "deferred", "column_name", "is_primary"),
                          ("schema", "table_name", "constraint_name", "column_name"),
                          (("orig_name", "constraint_name"),), (), (("migrate", "true"),)),
    "views": SnapshotTable(("schema", "view_name"), ("orig_def",), ("schema", "view_name"),
                           (("orig_def", "definition"),), (), (("migrate", "true"), ("verified", "false"))),
    "functions": SnapshotTable(("schema", "function_name"), ("is_procedure", "orig_source"),
                               ("schema", "function_name"), (("orig_source", "source"),), (),
                               (("migrate", "false"), ("verified", "false"))),
    "sequences": SnapshotTable(("schema", "sequence_name"),
                               ("min_value", "max_value", "increment_by", "cyclical", "cache_size", "orig_value"),
                               ("schema", "sequence_name"), (("orig_value", "last_value"),)),
    "indexes": SnapshotTable(("schema", "index_name"), ("uniqueness",), ("schema", "table_name", "index_name"),
                             (("orig_name", "index_name"),), ("where_clause",), (("migrate", "true"),),
                             unique=("schema", "table_name", "index_name")),
    "index_columns": SnapshotTable(("schema", "index_name", "position"),
                                   ("table_name", "descend", "is_expression", "column_name"),
                                   ("schema", "table_name", "index_name")),
    "partitions": SnapshotTable(("schema", "table_name", "partition_name"), ("type", "key", "is_default", "values"),
                                ("schema", "table_name", "partition_name"), (("orig_name", "partition_name"),),
                                ("key",)),
    "subpartitions": SnapshotTable(("schema", "table_name", "partition_name", "subpartition_name"),
                                   ("type", "key", "is_default", "values"),
                                   ("schema", "table_name", "partition_name", "subpartition_name"),
                                   (("orig_name", "subpartition_name"),), ("key",)),
    "triggers": SnapshotTable(("schema", "table_name", "trigger_name"),
                              ("trigger_type", "triggering_event", "for_each_row", "when_clause", "orig_source"),
                              ("schema", "table_name", "trigger_name"), (("orig_source", "trigger_body"),),
                              ("when_clause",), (("migrate", "false"), ("verified", "false"))),
    "table_privs": SnapshotTable(("schema", "table_name", "grantee", "privilege", "grantor"),
                                 ("grantor", "grantable"), ("schema", "table_name")),
    "column_privs": SnapshotTable(("schema", "table_name", "column_name", "grantee", "privilege"),
                                  ("grantor", "grantable"), ("schema", "table_name", "column_name")),
}


def _ident(c: Column) -> Column:
    return c


def shape_remote(name: str, remote: DataFrame, translate_identifier: Translate = _ident,
                 translate_expression: Translate = _ident, translate_type: Translate = _ident) -> DataFrame:
    """Remote catalog rows in the snapshot's form (translated, originals kept)."""
    rule = SNAPSHOT_TABLES[name]
    df = remote
    if name == "checks":
        # Java's ``$`` would also accept a trailing newline: anchor with \z, as the rule does
        rx = "(?iU)^([\\p{Alnum}_]*|\"[^\"]*\") IS NOT NULL\\z"
        df = df.filter(~F.col("condition").rlike(rx))       # a NULL condition is dropped too
    if name == "indexes":
        df = df.distinct()
    out: dict[str, Column] = {c: F.col(f"`{c}`") for c in df.columns}
    for orig, src in rule.originals:
        out[orig] = F.col(f"`{src}`")
    for c in rule.identifiers:
        out[c] = translate_identifier(F.col(f"`{c}`"))
    for c in rule.expressions:
        out[c] = translate_expression(F.col(f"`{c}`"))
    if name == "columns":
        out["type_name"] = type_label(translate_type(F.col("type_name")), "length", "precision", "scale")
        for c in ("length", "precision", "scale"):
            out.pop(c, None)
    elif name == "index_columns":
        out["column_name"] = F.when(F.col("is_expression"), translate_expression(F.col("column_name"))) \
            .otherwise(translate_identifier(F.col("column_name")))
    elif name in ("partitions", "subpartitions"):
        out["values"] = F.transform("values", lambda v: translate_expression(v))
    elif name == "sequences":
        for c in ("min_value", "max_value", "increment_by", "last_value", "orig_value"):
            out[c] = clamp_to_bigint(F.col("last_value" if c == "orig_value" else c))
        out["cache_size"] = at_least("cache_size", 1)
    return df.select(*[v.alias(k) for k, v in out.items()])


def refresh_table(name: str, current: DataFrame | None, remote: DataFrame,
                  only_schemas: Sequence[str] | None = None, translate_identifier: Translate = _ident,
                  translate_expression: Translate = _ident, translate_type: Translate = _ident) -> DataFrame:
    """Refresh one snapshot table; ``current=None`` builds it from scratch."""
    rule = SNAPSHOT_TABLES[name]
    remote = keep_both_ends(remote, "schema", "remote_schema", only_schemas) if name == "foreign_keys" \
        else keep_members(remote, "schema", only_schemas)
    shaped = shape_remote(name, remote, translate_identifier, translate_expression, translate_type)
    defaults = dict(rule.defaults)
    if current is None:
        extra = [F.expr(e).alias(c) for c, e in rule.defaults if c not in shaped.columns]
        return shaped.select("*", *extra)
    # catalog-sized, but perhaps a profile of whole tables, and read several times below
    checkpoint_root(shaped.sparkSession)
    shaped = shaped.checkpoint()
    if rule.update is None:
        merged = upsert_ignore(current, shaped, rule.keys, insert_defaults=defaults)
    else:
        merged = upsert_update(current, shaped, rule.keys, rule.update, insert_defaults=defaults)
    if rule.unique is not None:
        clash = unique_violations(merged, list(rule.unique)).limit(5).collect()
        if clash:
            raise ValueError(f"refresh of {name} breaks unique key {rule.unique}: "
                             + ", ".join(str(tuple(r)[:-1]) for r in clash))
    return merged


def refresh_snapshot(current: dict[str, DataFrame] | None, remote: dict[str, DataFrame],
                     only_schemas: Sequence[str] | None = None, cut_lineage: bool = False,
                     **translators) -> dict[str, DataFrame]:
    """Refresh every snapshot table present in ``remote`` (tables absent there stay as they are).

    Each refresh stacks an upsert on the previous snapshot; ``cut_lineage`` checkpoints
    the refreshed tables (into ``spark.checkpoint.dir``) so that repeated refreshes do
    not grow an ever longer plan.
    """
    current = dict(current or {})
    out = dict(current)
    for name, rdf in remote.items():
        new = refresh_table(name, current.get(name), rdf, only_schemas, **translators)
        if cut_lineage:
            checkpoint_root(new.sparkSession)       # make sure the checkpoint folder is known
            new = new.checkpoint(eager=True)
        out[name] = new
    return out


def catalog_from_tables(spark: SparkSession, tables: dict[str, DataFrame], schema: str) -> dict[str, DataFrame]:
    """A remote catalog (schemas, tables, columns) read off loaded DataFrames.

    The columns entry is P5's profile of every table (one aggregation pass per table),
    with ``default_value`` NULL, as a source catalog would list them.
    """
    cols = None
    for tname, df in tables.items():
        prof = profile_columns(df).select(
            F.lit(schema).alias("schema"), F.lit(tname).alias("table_name"), "column_name",
            F.col("position").cast("int").alias("position"), "type_name",
            F.col("length").cast("int").alias("length"), F.col("precision").cast("int").alias("precision"),
            F.col("scale").cast("int").alias("scale"), "nullable",
            F.lit(None).cast("string").alias("default_value"))
        cols = prof if cols is None else cols.unionByName(prof)
    return {
        "schemas": spark.createDataFrame([(schema,)], "schema string"),
        "tables": spark.createDataFrame([(schema, t) for t in tables], "schema string, table_name string"),
        "columns": cols,
    }
