"""Joins (J1-J4), aggregations (A1-A4) and ordered listing (L1)."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


# --------------------------------------------------------------------------- joins

def join_using(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi join on same-named keys, key columns output once; NULL keys never match.

    The strategy (broadcast hash, shuffled hash, sort-merge) is left to Catalyst/AQE,
    which broadcast a side only after measuring it.
    """
    return left.join(right, list(keys), how)


def join_two_sided(rel: DataFrame, dim: DataFrame, dim_key: str,
                   owner_key: str, ref_key: str,
                   owner_cols: dict[str, str], ref_cols: dict[str, str]) -> DataFrame:
    """Join one dimension twice: once for the owning end, once for the referenced end.

    ``owner_cols``/``ref_cols`` map dimension columns to output names.  Both ends must
    exist (inner joins).  The dimension is read once per side, pruned to the needed
    columns, so each join only moves the key plus those columns.
    """
    tl = dim.select(_q(dim_key).alias("_tl_key"), *[_q(c).alias(n) for c, n in owner_cols.items()])
    tf = dim.select(_q(dim_key).alias("_tf_key"), *[_q(c).alias(n) for c, n in ref_cols.items()])
    out = rel.join(tl, _q(owner_key) == F.col("_tl_key"), "inner")
    out = out.join(tf, _q(ref_key) == F.col("_tf_key"), "inner")
    return out.drop("_tl_key", "_tf_key")


def explode_with_position(df: DataFrame, arr: str | Column, pos: str = "pos", value: str = "value",
                          outer: bool = False) -> DataFrame:
    """Lateral unnest with a 1-based ordinal.

    Inner by default (NULL and empty arrays vanish, as with a lateral ``unnest``);
    ``outer=True`` keeps such rows with NULL ordinal and value.
    """
    a = _q(arr) if isinstance(arr, str) else arr
    gen = F.posexplode_outer(a) if outer else F.posexplode(a)
    keep = [c for c in df.columns if not (isinstance(arr, str) and c == arr)]
    out = df.select(*[_q(c) for c in keep], gen.alias("_p", value))
    return out.select(*[_q(c) for c in keep], (F.col("_p") + 1).cast("bigint").alias(pos), _q(value))


def orphans(child: DataFrame, child_cols: Sequence[str], parent: DataFrame,
            parent_cols: Sequence[str]) -> DataFrame:
    """Child rows with no parent (anti join).  Rows with any NULL key part are not
    orphans (a bare anti join would report them).  AQE broadcasts the parent keys when
    they are small; for a count of orphans per key, ``foreign_key_violations`` also
    avoids shuffling a huge parent for a small child."""
    c = child.filter(F.expr(" AND ".join(f"`{k}` IS NOT NULL" for k in child_cols)))
    p = parent.select(*[_q(k).alias(f"_p{i}") for i, k in enumerate(parent_cols)])
    cond = [_q(k) == F.col(f"_p{i}") for i, k in enumerate(child_cols)]
    return c.join(p, cond, "left_anti")


def matched(child: DataFrame, child_cols: Sequence[str], parent: DataFrame,
            parent_cols: Sequence[str]) -> DataFrame:
    """Child rows that have a parent (semi join)."""
    p = parent.select(*[_q(k).alias(f"_p{i}") for i, k in enumerate(parent_cols)])
    cond = [_q(k) == F.col(f"_p{i}") for i, k in enumerate(child_cols)]
    return child.join(p, cond, "left_semi")


# --------------------------------------------------------------------------- aggregations

def ordered_group_collect(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                          cols: Sequence[str]) -> DataFrame:
    """A1: several arrays per group, all in the same order, NULL elements kept.

    ``collect_list`` of a struct keeps rows whose value is NULL (a bare ``collect_list``
    drops them); sorting the structs by the order columns first aligns every array.
    An array is one value of one row, so this is for groups bounded by what they are
    (columns of a table, key parts of a constraint, turns of a conversation); for groups
    that grow with the data use :func:`tableload.operators.sequences.ordered_group_rows`.
    """
    packed = F.struct(*[_q(o).alias(f"_o{i}") for i, o in enumerate(order)],
                      *[_q(c).alias(c) for c in cols])
    g = df.groupBy(*keys).agg(F.array_sort(F.collect_list(packed)).alias("_items"))

    def field(name: str):
        # one-argument lambda: ``transform`` passes the index as a second argument otherwise
        return lambda e: e.getField(name)
    return g.select(*[_q(k) for k in keys], *[F.transform("_items", field(c)).alias(c) for c in cols])


def array_map_ordered(df: DataFrame, arr: str, fn: Callable[[Column], Column], out: str | None = None) -> DataFrame:
    """A2: transform every element of an array, keeping order; no unnest, no shuffle.

    NULL and empty arrays are kept (NULL stays NULL, empty stays empty)."""
    return df.withColumn(out or arr, F.transform(_q(arr), fn))


def distinct_rows(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """A3: whole-row distinct; NULLs compare equal.  Partial aggregation runs map-side."""
    return (df.select(*[_q(c) for c in cols]) if cols else df).distinct()


def sibling_count(df: DataFrame, keys: Sequence[str], out: str = "siblings") -> DataFrame:
    """A4: number of rows sharing the row's parent key (NULL keys form one group).

    Counting is a partial aggregation (one row per key and task crosses the shuffle),
    then the counts are joined back on a null-safe key.  Unlike a window over the keys,
    a hot key never has to be sorted and buffered inside one task; AQE may broadcast the
    count side once its size is measured.
    """
    counts = df.groupBy(*[_q(k).alias(f"_s{i}") for i, k in enumerate(keys)]).agg(
        F.count(F.lit(1)).alias(out))
    cond = [_q(k).eqNullSafe(F.col(f"_s{i}")) for i, k in enumerate(keys)]
    return df.join(counts, cond, "inner").drop(*[f"_s{i}" for i in range(len(keys))])


# --------------------------------------------------------------------------- ordering

def row_hash(df: DataFrame) -> Column:
    """Deterministic 64-bit hash of a whole row (map columns, which Spark cannot hash, are
    left out).  Used as the last range key so that equal sort keys can span partitions."""
    from pyspark.sql import types as T

    def hashable(t: T.DataType) -> bool:
        if isinstance(t, T.MapType):
            return False
        if isinstance(t, T.ArrayType):
            return hashable(t.elementType)
        if isinstance(t, T.StructType):
            return all(hashable(f.dataType) for f in t.fields)
        return True
    cols = [_q(f.name) for f in df.schema.fields if hashable(f.dataType)]
    return F.xxhash64(*cols) if cols else F.lit(0).cast("bigint")


def sort_columns(keys: Sequence[str | tuple[str, bool] | Column], df: DataFrame | None = None) -> list[Column]:
    """Sort expressions with the SQL-standard null placement of the source database:
    NULLs last when ascending, first when descending.  ``(name, True)`` means DESC.  A key that is the name of a column of
    ``df`` is that column, whatever characters it has; others are SQL expressions."""
    out = []
    for k in keys:
        if isinstance(k, Column):
            out.append(k)
            continue
        name, desc = (k, False) if isinstance(k, str) else k
        c = _q(name) if df is not None and name in df.columns else F.expr(name)
        out.append(c.desc_nulls_first() if desc else c.asc_nulls_last())
    return out


def ordered_listing(df: DataFrame, keys: Sequence[str | tuple[str, bool]], limit: int | None = None) -> DataFrame:
    """L1: global order with source null placement; with ``limit`` a top-k (per-task
    top-k then merge, no full sort)."""
    out = df.orderBy(*sort_columns(keys, df))
    return out.limit(limit) if limit is not None else out
