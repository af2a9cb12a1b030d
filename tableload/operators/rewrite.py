"""Views (V1) and change-set rewriting in place of triggers.

A change set is a DataFrame of incoming rows with an operation column (``op``:
INSERT/UPDATE/DELETE) and, for statement-level rules, a batch column.  A trigger body
becomes column expressions applied to that DataFrame -- evaluated per row inside the
scan stage, no Python in the data path.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..specs import TRIGGER_EVENTS, TriggerSpec


def define_view(spark: SparkSession, name: str, query: str | DataFrame,
                columns: Sequence[str] | None = None) -> DataFrame:
    """V1: register ``query`` as temp view ``name`` with columns renamed by position.

    A SQL definition is stored as text and resolved again on every use, so the view
    follows later changes of the tables and views it names (as a database view does).
    A DataFrame definition is fixed to that DataFrame.  A column list of the wrong
    length raises (as ``CREATE VIEW v (a, b)`` does).
    """
    if isinstance(query, str):
        cols = f" ({', '.join(f'`{c}`' for c in columns)})" if columns is not None else ""
        spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW `{name}`{cols} AS {query}")
        return spark.table(name)
    df = query
    if columns is not None:
        if len(columns) != len(df.columns):
            raise ValueError(f"view {name}: {len(columns)} column names for {len(df.columns)} columns")
        df = df.toDF(*columns)
    df.createOrReplaceTempView(name)
    return spark.table(name)


def _events(events: Sequence[str]) -> list[str]:
    out = [e.strip().upper() for e in events]
    bad = [e for e in out if e not in TRIGGER_EVENTS]
    if bad:
        raise ValueError(f"unknown trigger events {bad}")
    return out


def parse_events(text: str) -> list[str]:
    """``'INSERT OR UPDATE'`` -> ``['INSERT', 'UPDATE']``."""
    return _events([p for p in text.replace(",", " OR ").split(" OR ") if p.strip()])


def before_row(changes: DataFrame, events: Sequence[str], assignments: Sequence[tuple[str, str]] = (),
               when: str | None = None, drop_if: str | None = None, op: str = "op") -> DataFrame:
    """Rewrite (or drop) incoming rows the way a BEFORE ... FOR EACH ROW trigger does.

    Only rows whose ``op`` is one of ``events`` and whose ``when`` condition is TRUE are
    touched.  ``assignments`` are applied in order, each seeing the previous ones (as
    ``NEW.a := ...; NEW.b := f(NEW.a)`` would); a NULL ``when`` result leaves the row
    unchanged.  ``drop_if`` TRUE drops the row (the trigger returned NULL).  Conditions
    and assignments may use any column of the change set, so an UPDATE change set that
    carries the previous values in extra columns (say ``old_c1``) supports rules such as
    ``when="c1 <> old_c1"``.
    """
    evs = _events(events)
    active_col = "_trg_active"
    cond = F.col(op).isin(evs)
    if when:
        cond = cond & F.coalesce(F.expr(when), F.lit(False))
    out = changes.withColumn(active_col, cond)
    for column, expression in assignments:
        out = out.withColumn(column, F.when(F.col(active_col), F.expr(expression)).otherwise(F.col(f"`{column}`")))
    if drop_if:
        out = out.filter(~(F.col(active_col) & F.coalesce(F.expr(drop_if), F.lit(False))))
    return out.drop(active_col)


def apply_trigger(changes: DataFrame, trigger: TriggerSpec, op: str = "op") -> DataFrame:
    """T1 driven by a :class:`TriggerSpec` (row level, BEFORE)."""
    if not trigger.migrate:
        return changes
    if trigger.timing.upper() != "BEFORE" or not trigger.for_each_row:
        raise ValueError("apply_trigger handles BEFORE ... FOR EACH ROW triggers")
    return before_row(changes, trigger.events, trigger.assignments, trigger.when, trigger.drop_if, op)


def instead_of_insert(rows: DataFrame, mapping: dict[str, str | Column], base: DataFrame,
                      defaults: dict[str, str] | None = None) -> DataFrame:
    """Inserts aimed at a view become base-table rows.

    ``mapping`` gives each base column as an expression over the inserted view row
    (e.g. ``{"c1": "c1 div 10"}`` for a view that shows ``c1 * 10``).  A base column without one
    takes its default (``defaults``: SQL text by column), else NULL.  Returns the base
    table with the new rows appended.
    """
    mapping = mapping | {c: e for c, e in (defaults or {}).items() if c not in mapping}
    new = rows.select(*[(F.expr(e) if isinstance(e, str) else e).cast(base.schema[c].dataType).alias(c)
                        for c, e in mapping.items()])
    return base.unionByName(new, allowMissingColumns=True)


def instead_of_changes(changes: DataFrame, mapping: dict[str, str | Column], base: DataFrame, keys: Sequence[str],
                       old_keys: dict[str, str] | None = None, events: Sequence[str] = TRIGGER_EVENTS,
                       defaults: dict[str, str] | None = None, op: str = "op") -> DataFrame:
    """T2 for every event: changes aimed at a view act on its base table.

    ``mapping`` gives base columns as expressions over a row of the view, ``keys`` the base
    columns that identify a row.  An UPDATE or DELETE finds its base row by ``old_keys`` (SQL
    text per key column over the change row; default: the mapped keys): UPDATE sets the
    mapped columns, keys included, DELETE removes the row; one that finds no row does nothing.
    INSERT appends as :func:`instead_of_insert` does.  Events not listed are ignored.

    A change set is one statement: every change sees the base as it was, and a base row that
    two changes hit is an error.  The base is streamed past the changes, never sorted for them.
    """
    evs = _events(events)
    acting = changes.filter(F.col(op).isin(evs))
    value = {c: F.expr(e) if isinstance(e, str) else e for c, e in mapping.items()}
    found = {k: F.expr((old_keys or {})[k]) if k in (old_keys or {}) else value[k] for k in keys}
    edits = acting.filter(F.col(op) != "INSERT").select(
        *[found[k].cast(base.schema[k].dataType).alias(f"_k{i}") for i, k in enumerate(keys)], F.col(op).alias("_op"),
        F.struct(*[v.cast(base.schema[c].dataType).alias(c) for c, v in value.items()]).alias("_new"))
    # one change per base row: partial aggregates, so that a repeated key fails without being gathered
    edits = edits.groupBy(*[f"_k{i}" for i in range(len(keys))]).agg(
        F.count(F.lit(1)).alias("_n"), F.first("_op").alias("_op"), F.first("_new").alias("_new"))
    hit = base.join(edits, [F.col(f"`{k}`") == F.col(f"_k{i}") for i, k in enumerate(keys)], "left")
    twice = F.when(F.col("_n") > 1, F.raise_error(F.lit("a base row is changed twice by one statement"))).otherwise(F.lit(True))
    left = hit.filter(twice & (F.col("_op").isNull() | (F.col("_op") != "DELETE"))).select(*[
        (F.when(F.col("_op") == "UPDATE", F.col("_new")[c]).otherwise(F.col(f"`{c}`")) if c in value else F.col(f"`{c}`")).alias(c)
        for c in base.columns])
    return instead_of_insert(acting.filter(F.col(op) == "INSERT"), mapping, left, defaults)


def after_statement(changes: DataFrame, batches: DataFrame, events: Sequence[str],
                    aggregates: dict[str, Column], batch: str = "batch", op: str = "op") -> DataFrame:
    """One result per (batch, event) -- also for a batch with no such rows.

    ``batches`` lists the statements (one row per batch id); each is crossed with the
    handled events by exploding a literal array (no join), then the per-(batch, op)
    aggregates of the change set (a partial aggregation) are left-joined on.  Count-like
    aggregates of missing pairs come out NULL; wrap them in ``coalesce`` if needed.
    """
    evs = _events(events)
    slots = batches.select(F.col(batch), F.explode(F.array(*[F.lit(e) for e in evs])).alias(op))
    agg = (changes.filter(F.col(op).isin(evs)).groupBy(batch, op)
           .agg(*[e.alias(n) for n, e in aggregates.items()]))
    return slots.join(agg, [batch, op], "left")
