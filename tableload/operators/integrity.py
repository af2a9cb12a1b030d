"""Integrity validation at full table size: not null (I1), primary key (I2), unique (I3),
foreign key (I4), check (I5), delete rules (I6) and the constraint report (I7).

Every check returns the *violations* (rows or keys with counts) as a DataFrame; nothing
is enforced on later writes.  Key checks are partial aggregations: each task reduces its
rows to one row per key before the shuffle, so a key holding a third of the table costs
one shuffled row per task, not a third of the table in one task.
"""

from __future__ import annotations

import re
import threading
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import not_null_column
from ..specs import CheckSpec, ForeignKeySpec, KeySpec
from .filters import partial_filter

_IDENT = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*$")


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def _any_null(cols: Sequence[str]) -> Column:
    cond = F.lit(False)
    for c in cols:
        cond = cond | _q(c).isNull()
    return cond


def _all_set(cols: Sequence[str]) -> Column:
    cond = F.lit(True)
    for c in cols:
        cond = cond & _q(c).isNotNull()
    return cond


# --------------------------------------------------------------------------- I1

def not_null_report(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """NULL count of every listed column, all computed in one scan."""
    if not cols:
        return df.sparkSession.createDataFrame([], "column_name string, nulls bigint")
    wide = df.agg(*[F.count_if(_q(c).isNull()).cast("bigint").alias(f"n{i}") for i, c in enumerate(cols)])
    pairs = ", ".join("'{}', n{}".format(c.replace("\\", "\\\\").replace("'", "\\'"), i)
                      for i, c in enumerate(cols))
    return wide.selectExpr(f"stack({len(cols)}, {pairs}) AS (column_name, nulls)")


def not_null_violations(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows with a NULL in any listed column."""
    return df.filter(_any_null(cols))


# --------------------------------------------------------------------------- I2 / I3

def primary_key_violations(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, and keys with a NULL part.

    Output: the key columns, ``rows`` (how often the key occurs) and ``reason``
    (``'null key'`` or ``'duplicate'``).  One aggregation finds both kinds.
    """
    g = df.groupBy(*[_q(c) for c in cols]).agg(F.count(F.lit(1)).alias("rows"))
    nul = _any_null(cols)
    return (g.filter(nul | (F.col("rows") > 1))
            .withColumn("reason", F.when(nul, F.lit("null key")).otherwise(F.lit("duplicate"))))


def _key_columns(key_exprs: Sequence[str] | dict[str, str], columns: Sequence[str]) -> list[Column]:
    """The name of a column is that column, whatever characters it has; else SQL text."""
    if isinstance(key_exprs, dict):
        return [F.expr(e).alias(n) for n, e in key_exprs.items()]
    return [_q(e) if e in columns or _IDENT.match(e) else F.expr(e).alias(f"key{i + 1}") for i, e in enumerate(key_exprs)]


def unique_violations(df: DataFrame, key_exprs: Sequence[str] | dict[str, str],
                      where: str | None = None) -> DataFrame:
    """Duplicate keys among the covered rows; a NULL key part exempts the row.

    Keys may be expressions (``{"name": "lower(c)"}``); ``where`` restricts the check
    to the rows of a partial rule (only TRUE counts).
    """
    keys = (df if where is None else partial_filter(df, where)).select(*_key_columns(key_exprs, df.columns))
    names = keys.columns
    return (keys.filter(_all_set(names)).groupBy(*[_q(c) for c in names])
            .agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > 1))


# --------------------------------------------------------------------------- I4

def foreign_key_violations(child: DataFrame, child_cols: Sequence[str], parent: DataFrame,
                           parent_cols: Sequence[str], reduce_parent: bool = False) -> DataFrame:
    """I4: child keys without a parent row, with how many child rows carry them.

    MATCH SIMPLE: a child row with any NULL key part is exempt.  Columns are paired by
    position.  The child side is aggregated to distinct keys first (partial aggregation,
    so a hot key shrinks to one row per task before anything is shuffled), then looked
    up in the parent keys with a left outer join keeping the misses (an anti join here
    would be pushed below the aggregation by the optimizer, shuffling every child row
    again).  AQE broadcasts the parent keys when they turn out small.

    ``reduce_parent=True`` is for checking a small set of child rows (an incremental
    batch) against a huge parent: the parent is first reduced to the keys the child uses
    by a semi join with the parent streamed, so the small child keys are broadcast and
    the parent's key column is scanned instead of shuffled.  For whole-table checks it
    only adds stages, so it is off by default.
    """
    keys = (child.filter(_all_set(child_cols)).groupBy(*[_q(c) for c in child_cols])
            .agg(F.count(F.lit(1)).alias("rows")))
    p = parent.select(*[_q(c).alias(f"_p{i}") for i, c in enumerate(parent_cols)])
    if reduce_parent:
        # the always-true count test keeps this aggregate identical to the one used for the
        # lookup, so both read the same exchange instead of aggregating the child twice
        used = keys.select(*[_q(c).alias(f"_u{i}") for i, c in enumerate(child_cols)],
                           F.col("rows").alias("_urows"))
        on = [F.col(f"_p{i}") == F.col(f"_u{i}") for i in range(len(child_cols))] + [F.col("_urows") > 0]
        p = p.join(used, on, "left_semi")
    cond = [_q(c) == F.col(f"_p{i}") for i, c in enumerate(child_cols)]
    hits = keys.join(p, cond, "left")
    return hits.filter(F.col("_p0").isNull()).select(*[_q(c) for c in child_cols], "rows")


# --------------------------------------------------------------------------- I5

def check_violations(df: DataFrame, predicate: str) -> DataFrame:
    """Rows for which the condition is FALSE (NULL passes, as in SQL CHECK)."""
    return df.filter(~F.expr(predicate))


# --------------------------------------------------------------------------- I6

def _deleted_keys(deleted: DataFrame, parent_cols: Sequence[str], distinct: bool = False) -> DataFrame:
    """Deleted parent keys; ``distinct`` only where a left join must not multiply rows
    (semi and anti joins do not need it, which saves an aggregation)."""
    d = deleted.select(*[_q(c).alias(f"_d{i}") for i, c in enumerate(parent_cols)])
    return d.distinct() if distinct else d


def delete_blocked(child: DataFrame, child_cols: Sequence[str], deleted: DataFrame,
                   parent_cols: Sequence[str]) -> DataFrame:
    """I6 (NO ACTION / RESTRICT): deleted parent keys still referenced, with child counts."""
    d = _deleted_keys(deleted, parent_cols)
    cond = [_q(c) == F.col(f"_d{i}") for i, c in enumerate(child_cols)]
    return (child.join(d, cond, "left_semi").groupBy(*[_q(c) for c in child_cols])
            .agg(F.count(F.lit(1)).alias("children")))


def apply_delete_rule(child: DataFrame, child_cols: Sequence[str], deleted: DataFrame,
                      parent_cols: Sequence[str], rule: str,
                      defaults: dict[str, str] | None = None) -> DataFrame:
    """The child table after its parents in ``deleted`` are removed.

    CASCADE drops the referencing rows; SET NULL / SET DEFAULT overwrite the referencing
    key columns; NO ACTION / RESTRICT raise, naming some blocked keys, when a deleted
    key is still referenced (and otherwise return the child unchanged).  Child rows with
    a NULL key part never reference anything.
    """
    rule = rule.upper().strip()
    d = _deleted_keys(deleted, parent_cols, distinct=rule in ("SET NULL", "SET DEFAULT"))
    cond = [_q(c) == F.col(f"_d{i}") for i, c in enumerate(child_cols)]
    if rule == "CASCADE":
        return child.join(d, cond, "left_anti")
    if rule in ("SET NULL", "SET DEFAULT"):
        marked = child.join(d.withColumn("_hit", F.lit(True)), cond, "left")
        out = []
        for f in child.schema.fields:
            c = f.name
            if c in child_cols:
                new = F.lit(None) if rule == "SET NULL" else F.expr((defaults or {}).get(c, "NULL"))
                out.append(F.when(F.col("_hit"), new.cast(f.dataType)).otherwise(_q(c)).alias(c))
            else:
                out.append(_q(c))
        return marked.select(*out)
    if rule in ("NO ACTION", "RESTRICT"):
        sample = delete_blocked(child, child_cols, deleted, parent_cols).limit(10).collect()
        if sample:
            raise ValueError(f"delete blocked ({rule}): keys still referenced: "
                             + ", ".join(str(tuple(r)[:-1]) for r in sample))
        return child
    raise ValueError(f"unknown delete rule {rule!r}")


# --------------------------------------------------------------------------- I7

@dataclass
class TableRules:
    """The constraints declared for one table; ``df`` may be a function that returns it, for a
    table that is not loaded yet."""

    name: str
    df: DataFrame | Callable[[], DataFrame]
    not_null: tuple[str, ...] = ()
    keys: tuple[KeySpec, ...] = ()
    foreign_keys: tuple[ForeignKeySpec, ...] = ()
    checks: tuple[CheckSpec, ...] = ()
    parents: dict[str, DataFrame] = field(default_factory=dict)

    def frame(self) -> DataFrame:
        return self.df if isinstance(self.df, DataFrame) else self.df()


REPORT_SCHEMA = ("table_name string, constraint_name string, constraint_type string, timing string, "
                 "violations bigint, error string")


def _timing(deferrable: bool, deferred: bool) -> str:
    return "deferred" if deferrable and deferred else "immediate"


@dataclass(frozen=True)
class ConstraintJob:
    """Rules checked by one Spark job: ``rules`` are (name, type, timing), ``run`` returns one
    count (or exception) each.  It can run once the tables it ``needs`` are loaded."""

    table: str
    needs: frozenset[str]
    rules: tuple[tuple[str, str, str], ...]
    run: Callable[[], list]

    def rows(self) -> list[tuple]:
        """The report rows of the job; a failure becomes the error of its rules."""
        try:
            values = self.run()
        except Exception as exc:  # noqa: BLE001 - one failure must not stop the report
            values = [exc] * len(self.rules)
        return [(self.table, n, kind, timing, None, str(v).strip() or v.__class__.__name__) if isinstance(v, Exception)
                else (self.table, n, kind, timing, int(v), None)
                for (n, kind, timing), v in zip(self.rules, values)]


def _one_by_one(together: Callable[[], list], alone: Sequence[Callable[[], object]]) -> list:
    """The values of one job for all rules, or if it fails of one job each, so that only the
    rules at fault fail."""
    try:
        return together()
    except Exception:  # noqa: BLE001
        out = []
        for fn in alone:
            try:
                out.append(fn())
            except Exception as exc:  # noqa: BLE001
                out.append(exc)
        return out


def _key_counts(df: DataFrame, keys: Sequence[KeySpec]) -> list:
    """Violating rows of several key rules on the same columns: the rows are grouped once."""
    names = [f"_k{i}" for i in range(len(keys[0].columns))]
    first = keys[0]
    if first.expressions:
        columns = [F.expr(c) if text else _q(c) for c, text in zip(first.columns, first.expressions)]
    else:
        columns = [_q(c) for c in first.columns] if all(k.primary for k in keys) else _key_columns(first.columns, df.columns)
    covered = [F.lit(True) if k.where is None or not k.where.strip() else F.coalesce(F.expr(k.where), F.lit(False)) for k in keys]
    rows = df.select(*[c.alias(n) for c, n in zip(columns, names)], *[c.alias(f"_w{i}") for i, c in enumerate(covered)])
    groups = rows.groupBy(*names).agg(*[F.count_if(F.col(f"_w{i}")).alias(f"_n{i}") for i in range(len(keys))])
    nul = _any_null(names)
    sums = []
    for i, k in enumerate(keys):
        bad = nul | (F.col(f"_n{i}") > 1) if k.primary else ~nul & (F.col(f"_n{i}") > 1)
        sums.append(F.coalesce(F.sum(F.when(bad, F.col(f"_n{i}"))), F.lit(0)).alias(f"v{i}"))
    return list(groups.agg(*sums).first())


def constraint_jobs(tables: Sequence[TableRules], mode: str = "all") -> list[ConstraintJob]:
    """The jobs that check the rules of ``tables``: one per set of key columns (PRIMARY KEY,
    UNIQUE and partial rules on it together), one per foreign key, and one per table for
    its not-null rules and checks.  With ``mode="timed"`` a job holds rules of one timing."""
    if mode not in ("all", "timed", "immediate", "deferred"):
        raise ValueError("mode must be all, timed, immediate or deferred")
    want = (lambda t: t == mode) if mode in ("immediate", "deferred") else (lambda t: True)
    # declared unique column sets per reported table: a foreign key must reference one
    unique_sets = {t.name: {frozenset(k.columns) for k in t.keys if k.migrate and k.where is None}
                   for t in tables}
    jobs: list[ConstraintJob] = []

    def total(df: DataFrame) -> int:
        return df.agg(F.sum("rows")).first()[0] or 0

    for t in tables:
        own = frozenset([t.name])
        by_columns: dict[tuple, list[KeySpec]] = {}
        for k in t.keys:
            timing = _timing(k.deferrable, k.deferred)
            if k.migrate and want(timing):
                by_columns.setdefault((k.columns, k.expressions, timing if mode == "timed" else None), []).append(k)
        for group in by_columns.values():
            jobs.append(ConstraintJob(
                t.name, own, tuple((k.name, "PRIMARY KEY" if k.primary else "UNIQUE", _timing(k.deferrable, k.deferred))
                                   for k in group),
                lambda t=t, group=group: _one_by_one(
                    lambda: _key_counts(t.frame(), group), [lambda k=k: _key_counts(t.frame(), [k])[0] for k in group])))
        for fk in t.foreign_keys:
            timing = _timing(fk.deferrable, fk.deferred)
            if not fk.migrate or not want(timing):
                continue

            def fk_count(t=t, fk=fk):
                if fk.parent in unique_sets and frozenset(fk.parent_columns) not in unique_sets[fk.parent]:
                    raise ValueError(f'there is no unique constraint matching given keys for referenced '
                                     f'table "{fk.parent}"')
                if fk.parent not in t.parents:
                    raise ValueError(f'referenced table "{fk.parent}" was not loaded')
                return [total(foreign_key_violations(t.frame(), fk.columns, t.parents[fk.parent], fk.parent_columns,
                                                     reduce_parent=fk.reduce_parent))]
            jobs.append(ConstraintJob(t.name, own | {fk.parent}, ((fk.name, "FOREIGN KEY", timing),), fk_count))

        # not-null rules and checks: one scan for the whole table
        nn = list(t.not_null)
        checks = []
        for ck in t.checks:
            if not ck.migrate or ck.condition is None:
                continue
            col = not_null_column(ck.condition)
            if col is not None:
                nn.append(col)
            else:
                checks.append(ck)
        if not want("immediate") or not (nn or checks):
            continue
        items = [(f"{c}_not_null", "NOT NULL", c, None) for c in dict.fromkeys(nn)]
        items += [(ck.name, "CHECK", None, ck.condition) for ck in checks]

        def count_expr(c, cond):
            return F.count_if(_q(c).isNull()) if c is not None else F.count_if(~F.expr(cond))

        jobs.append(ConstraintJob(
            t.name, own, tuple((n, kind, "immediate") for n, kind, _, _ in items),
            lambda t=t, items=items: _one_by_one(
                lambda: list(t.frame().agg(*[count_expr(c, cond).alias(f"v{i}")
                                             for i, (_, _, c, cond) in enumerate(items)]).first()),
                [lambda c=c, cond=cond: t.frame().agg(count_expr(c, cond)).first()[0] for _, _, c, cond in items])))
    return jobs


def constraint_report(spark: SparkSession, tables: Sequence[TableRules], mode: str = "all",
                      parallelism: int = 1) -> DataFrame:
    """Run many constraints; one report row each.

    Order: keys, foreign keys, then not-null rules and checks.  A check whose condition
    only says ``x IS NOT NULL`` is treated as a not-null rule on ``x``.  Not-null rules
    and checks of one table are evaluated together in one scan, and so are key rules on the
    same columns.  ``mode`` selects ``"immediate"`` or ``"deferred"`` constraints (checks and
    not-null rules are always immediate; deferrable-but-not-deferred keys are immediate) or
    ``"all"``.  A failing
    constraint (bad expression, missing parent, runtime error) becomes a row with its
    ``error`` and does not stop the others.  Each constraint's result is one small row.
    A foreign key whose parent table is part of the report must reference columns that
    carry a declared primary key or (non-partial) unique key there, else it is an error
    -- a metadata check, no data is read for it.
    ``parallelism > 1`` submits the independent jobs from driver threads so that Spark
    runs them side by side.
    """
    jobs = constraint_jobs(tables, mode)
    rows = [r for res in _map(ConstraintJob.rows, jobs, parallelism) for r in res]
    return spark.createDataFrame(rows, REPORT_SCHEMA)


def load_order(tables: Sequence[str], foreign_keys: Sequence[tuple[str, str]]) -> list[str]:
    """Tables with referenced ones (``(table, parent)`` pairs) before those that refer to them,
    else as given; the tables of a cycle, and what hangs on it, come last."""
    parents = {t: {p for c, p in foreign_keys if c == t and p != t and p in set(tables)} for t in tables}
    out: list[str] = []
    while len(out) < len(parents):
        ready = [t for t in parents if t not in out and parents[t] <= set(out)]
        if not ready:
            return out + [t for t in parents if t not in out]
        out += ready
    return out


class RulesOnLoad:
    """Checks rules as their tables arrive: immediate ones as soon as all tables they need
    are loaded, deferred ones (and those whose tables never came) at the end.

    ``loaded(name)`` may be called from several load threads; it runs the jobs that became
    ready in the caller's thread, each job once."""

    def __init__(self, tables: Sequence[TableRules]):
        self._waiting = constraint_jobs(tables, "timed")
        self._order = {id(j): i for i, j in enumerate(self._waiting)}
        self._seen: set[str] = set()
        self._rows: list[tuple[int, list[tuple]]] = []
        self._lock = threading.Lock()

    def _run(self, jobs: list[ConstraintJob]) -> None:
        for job in jobs:
            rows = job.rows()
            with self._lock:
                self._rows.append((self._order[id(job)], rows))

    def loaded(self, name: str) -> None:
        with self._lock:
            self._seen.add(name)
            ready = [j for j in self._waiting if j.needs <= self._seen and j.rules[0][2] == "immediate"]
            self._waiting = [j for j in self._waiting if j not in ready]
        self._run(ready)

    def finish(self, spark: SparkSession, parallelism: int = 1) -> DataFrame:
        """Run what is left of the loaded tables; the whole report in declaration order."""
        rest, self._waiting = [j for j in self._waiting if j.table in self._seen], []
        _map(lambda j: self._run([j]), rest, parallelism)
        return spark.createDataFrame([r for _, rows in sorted(self._rows, key=lambda x: x[0]) for r in rows], REPORT_SCHEMA)


def _map(fn, items: list, parallelism: int) -> list:
    if parallelism <= 1 or len(items) <= 1:
        return [fn(x) for x in items]
    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        return list(pool.map(fn, items))
