"""Filters: membership (F1), both-ends membership (F2), control flags (F3), partial rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def keep_members(df: DataFrame, col: str, values: Sequence | DataFrame | None = None) -> DataFrame:
    """keep rows whose ``col`` is one of ``values``.

    ``None`` keeps everything, an empty list keeps nothing, NULL never matches.
    A list of any length is an ``IN`` predicate, compared in the column's type; a DataFrame
    of values is a semi join whose strategy AQE picks from the measured size (no forced
    broadcast of data of unknown size).
    """
    if values is None:
        return df
    if isinstance(values, DataFrame):
        (vcol,) = values.columns
        # a semi join never multiplies rows, so the values need no distinct (no extra shuffle)
        return df.join(values.select(F.col(vcol).alias("_member")), _c(col) == F.col("_member"), "left_semi")
    values = list(values)
    if not values:
        return df.filter(F.lit(False))
    return df.filter(_c(col).isin(values))


def keep_both_ends(df: DataFrame, a: str, b: str, values: Sequence | None = None) -> DataFrame:
    """keep relation rows whose two ends are both selected (``None`` keeps all)."""
    if values is None:
        return df
    values = list(values)
    return df.filter(_c(a).isin(values) & _c(b).isin(values))


def flagged_only(df: DataFrame, control: DataFrame, keys: Sequence[str] | dict[str, str],
                 flag: str = "migrate", own_flag: str | Column | None = None) -> DataFrame:
    """keep rows whose control row exists and has ``flag`` true (and their own flag).

    ``keys`` maps the data's columns to the control table's (a list means same names).
    A missing control row drops the row.  The control table is filtered and reduced to
    its key columns before the semi join, so only keys are shuffled or broadcast.
    """
    pairs = dict(keys) if isinstance(keys, dict) else {k: k for k in keys}
    ctl = control.filter(F.col(flag)).select(*[F.col(r).alias(f"_k{i}") for i, r in enumerate(pairs.values())])
    cond = [_c(l) == F.col(f"_k{i}") for i, l in enumerate(pairs)]
    out = df.join(ctl, cond, "left_semi")
    if own_flag is not None:
        out = out.filter(_c(own_flag) if isinstance(own_flag, str) else own_flag)
    return out


def partial_filter(df: DataFrame, where: str | None) -> DataFrame:
    """rows covered by a partial rule; NULL or blank means all rows, only TRUE counts."""
    if where is None or not where.strip():
        return df
    return df.filter(F.expr(where))
