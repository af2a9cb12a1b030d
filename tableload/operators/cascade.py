"""Deletes that run through a graph of foreign keys (I6 beyond one level).

Deleting rows of some tables acts on the tables that reference them, by the delete rule of
each foreign key, and a CASCADE acts again on the tables that reference the rows it removes.
The graph may have several paths between two tables, self references and cycles.

The rows themselves never move while the graph is followed.  Per table only the deleted
values of its referenced columns are kept; each round looks up the last round's new values
in the referencing tables (semi joins) and keeps those not seen before, until none are new.
The rounds are as many as the longest chain of references, whatever the tables' sizes.  The
tables after the delete are then plain joins with the final key sets.

Rules, as the source database has them:

* CASCADE removes the referencing rows; SET NULL and SET DEFAULT overwrite their key
  columns (a default must exist in what is left of the parent, unless it has a NULL part);
* RESTRICT refuses as soon as a key is deleted to which a row refers that is not yet deleted
  itself, also if a later round would delete that row;
* NO ACTION is checked at the end: rows that were deleted on the way do not block;
* a row with a NULL key part refers to nothing;
* a row that one key would remove and another would overwrite is removed;
* overwriting a column that other tables refer to must not leave them without a parent.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from ..specs import DELETE_RULES, ForeignKeySpec
from .integrity import _all_set, _q

_SHOWN = 10
_MERGE_ROUNDS = 8


class DeleteBlocked(ValueError):
    """A delete refused by a RESTRICT or NO ACTION rule, or by a dangling overwritten key."""


@dataclass(frozen=True)
class CascadeResult:
    """``tables`` after the delete, and ``report``: one row per table and effect on it
    (table_name, foreign_key or NULL for the rows named in the delete, action, rows)."""

    tables: dict[str, DataFrame]
    report: DataFrame


def _stored(df: DataFrame, label: str) -> DataFrame:
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _matching(df: DataFrame, columns: Sequence[str], keys: DataFrame, key_columns: Sequence[str], how: str) -> DataFrame:
    """``df`` joined by ``how`` to the deleted ``keys``; NULL parts match nothing."""
    side = keys.select(*[_q(c).alias(f"_d{i}") for i, c in enumerate(key_columns)])
    return df.join(side, [_q(c) == F.col(f"_d{i}") for i, c in enumerate(columns)], how)


def _blocked(rows: DataFrame, columns: Sequence[str], rule: str, name: str, child: str) -> None:
    found = rows.select(*[_q(c) for c in columns]).distinct().limit(_SHOWN).collect()
    if found:
        raise DeleteBlocked(f"delete blocked ({rule}) by {name} of {child}: keys still referenced: "
                            + ", ".join(str(tuple(r)) for r in found))


class _Graph:
    def __init__(self, tables: dict[str, DataFrame], foreign_keys: Sequence[tuple[str, ForeignKeySpec]],
                 delete: dict[str, str], defaults: dict[tuple[str, str], str]):
        self.tables, self.defaults = tables, defaults
        self.keys = [(child, fk, fk.delete_rule.upper().strip()) for child, fk in foreign_keys if fk.migrate]
        for child, fk, rule in self.keys:
            if rule not in DELETE_RULES:
                raise ValueError(f"unknown delete rule {rule!r}")
            missing = {child, fk.parent} - set(tables)
            if missing:
                raise ValueError(f"foreign key {fk.name}: no table {sorted(missing)}")
            if len(fk.columns) != len(fk.parent_columns):
                raise ValueError(f"foreign key {fk.name}: {len(fk.columns)} columns for {len(fk.parent_columns)}")
        unknown = set(delete) - set(tables)
        if unknown:
            raise ValueError(f"no table {sorted(unknown)}")
        self.named = {t: F.coalesce(F.expr(c).cast("boolean"), F.lit(False)) for t, c in delete.items()}
        # columns of a table that others refer to: all that a round has to carry
        self.referred: dict[str, list[str]] = {}
        for _, fk, _ in self.keys:
            self.referred.setdefault(fk.parent, [])
            self.referred[fk.parent] += [c for c in fk.parent_columns if c not in self.referred[fk.parent]]
        self.deleted: dict[str, DataFrame] = {}

    def of_rule(self, *rules: str):
        return [(child, fk, rule) for child, fk, rule in self.keys if rule in rules]

    def left(self, table: str, deleted: dict[str, DataFrame]) -> DataFrame:
        """The rows of a table that are neither named in the delete nor removed by ``deleted``."""
        df = self.tables[table]
        if table in self.named:
            df = df.filter(~self.named[table])
        for child, fk, _ in self.of_rule("CASCADE"):
            if child == table and fk.parent in deleted:
                df = _matching(df, fk.columns, deleted[fk.parent], fk.parent_columns, "left_anti")
        return df

    def follow(self) -> None:
        """Collect the deleted values of all referenced columns, round by round."""
        new = {t: _stored(self.tables[t].filter(c).select(*[_q(k) for k in self.referred[t]]).distinct(), "cascade")
               for t, c in self.named.items() if t in self.referred}
        rounds = 0
        while new:
            rounds += 1
            before = dict(self.deleted)
            for t, keys in new.items():
                keys = keys if t not in before else before[t].unionByName(keys)
                # long chains: one table again, so that plans do not grow with the rounds
                self.deleted[t] = keys if rounds % _MERGE_ROUNDS else _stored(keys, "cascade")
            for child, fk, rule in self.of_rule("RESTRICT"):
                if fk.parent in new:
                    rows = _matching(self.left(child, before), fk.columns, new[fk.parent], fk.parent_columns, "left_semi")
                    _blocked(rows, fk.columns, rule, fk.name, child)
            found: dict[str, DataFrame] = {}
            for child, fk, _ in self.of_rule("CASCADE"):
                if fk.parent in new and child in self.referred:
                    hit = _matching(self.tables[child], fk.columns, new[fk.parent], fk.parent_columns, "left_semi") \
                        .select(*[_q(c) for c in self.referred[child]])
                    found[child] = hit if child not in found else found[child].unionByName(hit)
            new = {}
            for t, hit in found.items():
                if t in self.deleted:
                    seen = self.deleted[t].select(*[_q(c).alias(f"_s{i}") for i, c in enumerate(self.referred[t])])
                    hit = hit.join(seen, [_q(c).eqNullSafe(F.col(f"_s{i}")) for i, c in enumerate(self.referred[t])],
                                   "left_anti")
                keys = _stored(hit.distinct(), "cascade")
                if not keys.isEmpty():
                    new[t] = keys

    def overwritten(self, table: str, df: DataFrame) -> tuple[DataFrame, list[tuple[ForeignKeySpec, str, Column]]]:
        """``df`` with a flag per SET NULL / SET DEFAULT key that acts on it."""
        flags = []
        for child, fk, rule in self.of_rule("SET NULL", "SET DEFAULT"):
            if child == table and fk.parent in self.deleted:
                flag = f"_hit{len(flags)}"
                keys = self.deleted[fk.parent].select(*[_q(c) for c in fk.parent_columns]).distinct()
                side = keys.select(*[_q(c).alias(f"{flag}_{i}") for i, c in enumerate(fk.parent_columns)],
                                   F.lit(True).alias(flag))
                df = df.join(side, [_q(c) == F.col(f"{flag}_{i}") for i, c in enumerate(fk.columns)], "left")
                flags.append((fk, rule, F.coalesce(F.col(flag), F.lit(False))))
        return df, flags

    def after(self, table: str) -> DataFrame:
        df, flags = self.overwritten(table, self.left(table, self.deleted))
        columns = []
        for f in self.tables[table].schema.fields:
            c = _q(f.name)
            for fk, rule, hit in flags:
                if f.name in fk.columns:
                    text = "NULL" if rule == "SET NULL" else self.defaults.get((table, f.name), "NULL")
                    c = F.when(hit, F.expr(text).cast(f.dataType)).otherwise(c)
            columns.append(c.alias(f.name))
        return df.select(*columns)

    def check(self, result: dict[str, DataFrame]) -> None:
        for child, fk, rule in self.of_rule("NO ACTION"):
            if fk.parent in self.deleted:
                rows = _matching(result[child], fk.columns, self.deleted[fk.parent], fk.parent_columns, "left_semi")
                _blocked(rows, fk.columns, rule, fk.name, child)
        rewritten = {(child, c) for child, fk, _ in self.of_rule("SET NULL", "SET DEFAULT")
                     if fk.parent in self.deleted for c in fk.columns}
        for child, fk, rule in self.keys:
            given = rule == "SET DEFAULT" and fk.parent in self.deleted
            moved = any((fk.parent, c) in rewritten for c in fk.parent_columns)
            if given or moved:                     # keys that an overwrite made or took away
                rows = _matching(result[child].filter(_all_set(fk.columns)), fk.columns, result[fk.parent],
                                 fk.parent_columns, "left_anti")
                _blocked(rows, fk.columns, "overwritten key", fk.name, child)

    def report(self) -> list[tuple[str, str | None, str, DataFrame]]:
        effects = [(t, None, "DELETE", self.tables[t].filter(c)) for t, c in self.named.items()]
        for child, fk, rule in self.keys:
            if fk.parent not in self.deleted or rule in ("NO ACTION", "RESTRICT"):
                continue
            rows = self.tables[child] if rule == "CASCADE" else self.left(child, self.deleted)
            if rule == "CASCADE" and child in self.named:
                rows = rows.filter(~self.named[child])
            keys = self.deleted[fk.parent]
            effects.append((child, fk.name, rule, _matching(rows, fk.columns, keys, fk.parent_columns, "left_semi")))
        return effects


def cascade_delete(tables: dict[str, DataFrame], foreign_keys: Sequence[tuple[str, ForeignKeySpec]],
                   delete: dict[str, str], defaults: dict[tuple[str, str], str] | None = None) -> CascadeResult:
    """I6 over a whole graph: ``DELETE FROM t WHERE condition`` for every table in ``delete``.

    ``foreign_keys`` are (referencing table, key) pairs between ``tables``; ``defaults`` maps
    (table, column) to SQL text for SET DEFAULT (NULL where absent).  Raises
    :class:`DeleteBlocked` if a rule refuses the delete; nothing is written then.

    In the report a row that several keys remove is counted under each of them.
    """
    graph = _Graph(tables, foreign_keys, delete, defaults or {})
    graph.follow()
    touched = {t for t in tables if t in graph.named} | {child for child, fk, rule in graph.keys
                                                         if fk.parent in graph.deleted and rule not in ("NO ACTION", "RESTRICT")}
    result = {t: graph.after(t) if t in touched else df for t, df in tables.items()}
    graph.check(result)
    spark = next(iter(tables.values())).sparkSession
    report = None
    for table, name, action, rows in graph.report():
        line = rows.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(table).alias("table_name"), F.lit(name).cast("string").alias("foreign_key"),
            F.lit(action).alias("action"), "rows")
        report = line if report is None else report.unionByName(line)
    if report is None:
        report = spark.createDataFrame([], "table_name string, foreign_key string, action string, rows bigint")
    return CascadeResult(result, report)
