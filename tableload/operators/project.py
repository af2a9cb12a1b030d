"""Projections: mapped select (P1), checked casts (P2), column defaults (P4), profiling (P5)."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import truncate_identifier, type_label
from ..specs import ColumnSpec, ordered

# Catalog type names and the Spark types that hold them.
TYPE_ALIASES = {
    "int": "int", "integer": "int", "int4": "int", "smallint": "smallint", "int2": "smallint",
    "bigint": "bigint", "int8": "bigint", "text": "string", "string": "string",
    "boolean": "boolean", "bool": "boolean", "real": "float", "float4": "float",
    "double precision": "double", "double": "double", "float8": "double", "float": "double",
    "date": "date", "timestamp": "timestamp_ntz", "timestamp without time zone": "timestamp_ntz",
    "timestamptz": "timestamp", "timestamp with time zone": "timestamp", "bytea": "binary",
    "binary": "binary", "numeric": "decimal(38,18)", "decimal": "decimal(38,18)",
    "varchar": "string", "character varying": "string", "char": "string", "character": "string",
    "bpchar": "string", "name": "string", "uuid": "string", "json": "string", "jsonb": "string", "time": "string",
    "time without time zone": "string",
    "timestamp_ntz": "timestamp_ntz", "tinyint": "tinyint", "long": "bigint",
}

_VARCHAR = re.compile(r"^\s*(?:varchar|character varying|char|character|bpchar|string)\s*\(\s*(\d+)\s*\)\s*$",
                      re.I)
_NUMERIC = re.compile(r"^\s*(?:numeric|decimal)\s*\(\s*(\d+)\s*(?:,\s*(\d+)\s*)?\)\s*$", re.I)


def spark_type(type_name: str) -> str:
    """Spark DDL type for a catalogued type name (unknown names are passed through)."""
    t = type_name.strip()
    if _VARCHAR.match(t):
        return "string"
    m = _NUMERIC.match(t)
    if m:
        return f"decimal({m.group(1)},{m.group(2) or 0})"
    return TYPE_ALIASES.get(t.lower(), t)


def max_length(type_name: str) -> int | None:
    """Declared length limit of a character type, if any."""
    m = _VARCHAR.match(type_name)
    return int(m.group(1)) if m else None


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def _rounded(c: Column, source: T.DataType | None, target_ddl: str) -> Column:
    """A number on its way to an integer type rounds, as assignments in the source database
    do: decimals half away from zero, floats half to even."""
    if target_ddl in _INTEGRAL_RANK and isinstance(source, T.DecimalType):
        return F.round(c, 0)
    if target_ddl in _INTEGRAL_RANK and isinstance(source, (T.FloatType, T.DoubleType)):
        return F.rint(c)
    return c


def strict_cast(c: Column, type_name: str, label: str | None = None, source: T.DataType | None = None) -> Column:
    """Cast that fails the job on a value that does not convert (NULL stays NULL).

    The check is explicit, so it holds whether or not the session runs in ANSI mode; a
    ``varchar(n)``/``char(n)`` target also fails on values longer than ``n``, unless all that is
    too much are spaces, which are cut.  Fractions round for an integer type when the
    ``source`` type is known to be a number's.
    """
    return F.when(does_not_fit(c, source, type_name), F.raise_error(
        F.concat(F.lit(f"invalid input for type {label or type_name}: "), c.cast("string")))) \
        .otherwise(converted_column(c, source, type_name))


def converted_column(c: Column, source: T.DataType | None, type_name: str) -> Column:
    """``c`` in the declared type, NULL where it does not convert; excess trailing spaces of a
    ``varchar(n)``/``char(n)`` are cut."""
    t, n = spark_type(type_name), max_length(type_name)
    if n is None:
        return _rounded(c, source, t).try_cast(t)
    text = c.cast("string")
    return F.when(F.length(text) > n, F.substring(text, 1, n)).otherwise(text)


def does_not_fit(c: Column, source: T.DataType | None, type_name: str) -> Column:
    """TRUE for a value that the declared type cannot hold (never for NULL)."""
    n = max_length(type_name)
    if n is None:
        return c.isNotNull() & converted_column(c, source, type_name).isNull()
    text = c.cast("string")
    # the text after the limit holds something else than spaces
    return F.coalesce((F.length(text) > n) & (F.length(F.rtrim(text)) > n), F.lit(False))


_INTEGRAL_RANK = {"tinyint": 1, "smallint": 2, "int": 3, "bigint": 4}


def cast_cannot_fail(source: T.DataType, target_ddl: str) -> bool:
    """True when every value of ``source`` converts to ``target_ddl``: the same type, a
    widening of integers or floats, or any type to string."""
    src = source.simpleString()
    if src == target_ddl or target_ddl == "string":
        return True
    if src in _INTEGRAL_RANK and target_ddl in _INTEGRAL_RANK:
        return _INTEGRAL_RANK[src] <= _INTEGRAL_RANK[target_ddl]
    return (src, target_ddl) in {("float", "double"), ("tinyint", "double"), ("smallint", "double"),
                                 ("int", "double"), ("date", "timestamp_ntz"), ("date", "timestamp")}


def checked_column(c: Column, source: T.DataType | None, type_name: str) -> Column:
    """``c`` in the declared type: a plain reference or cast where nothing can fail (so
    filters on it still reach the scan), else :func:`strict_cast`."""
    t = spark_type(type_name)
    if source is not None and max_length(type_name) is None and cast_cannot_fail(source, t):
        return c if source.simpleString() == t else c.cast(t)
    return strict_cast(c, type_name, source=source)


def target_names(columns: list[ColumnSpec], truncate: bool = True) -> list[str]:
    """Target names by position, cut to 63 bytes; two columns with one target name raise."""
    names = [truncate_identifier(c.name) if truncate else c.name for c in ordered(columns)]
    dup = {n for n in names if names.count(n) > 1}
    if dup:
        raise ValueError(f"columns map to the same target name: {sorted(dup)}")
    return names


def project_mapped(df: DataFrame, columns: list[ColumnSpec], truncate: bool = True) -> DataFrame:
    """Select, reorder by position, rename and cast by a column spec.

    Target names are cut to 63 bytes (on a character boundary); two columns collapsing
    to one target name raise, as a duplicate catalog key would.
    """
    cols = ordered(columns)
    names = target_names(columns, truncate)
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.select(*[checked_column(_q(c.source), types.get(c.source), c.type_name).alias(n)
                       for c, n in zip(cols, names)])


_UNBOUNDED = ("numeric", "decimal")
_MAX_DIGITS = 38


def sized_numerics(df: DataFrame, columns: Sequence[tuple[str, str]]) -> list[tuple[str, str]]:
    """``columns`` (name, declared type) with every unbounded ``numeric`` sized by the data:
    ``numeric(p,s)`` with the digits that its longest values need before and after the point.

    The source database holds any number of digits; a Spark decimal holds 38, split once for
    the whole column, and the default split (20 and 18) fails on longer integers.  One pass
    finds the sizes of all columns.  Values that are no numbers do not count (the cast reports
    them).  A column that needs more than 38 digits in all raises: declare it as ``text``.
    """
    wide = [c for c, t in columns if t.strip().lower() in _UNBOUNDED]
    if not wide:
        return list(columns)
    sizes = []
    for i, c in enumerate(wide):
        text = _q(c).cast("string")
        number = F.abs(text.try_cast("double")) < float("inf")
        digits = F.lower(F.ltrim(F.trim(text), F.lit("+-0")))           # sign and leading zeros need no digit
        power_at = F.instr(digits, "e")
        power = F.when(power_at > 0, F.coalesce(F.substring(digits, power_at + 1, F.length(digits)).try_cast("int"), F.lit(0))) \
            .otherwise(0)
        mantissa = F.when(power_at > 0, F.substring(digits, F.lit(1), power_at - 1)).otherwise(digits)
        point = F.instr(mantissa, ".")
        before = F.when(point > 0, point - 1).otherwise(F.length(mantissa))
        after = F.when(point > 0, F.length(mantissa) - point).otherwise(0)
        sizes += [F.max(F.when(number, F.greatest(before + power, F.lit(0)))).alias(f"b{i}"),
                  F.max(F.when(number, F.greatest(after - power, F.lit(0)))).alias(f"a{i}")]
    found = df.agg(*sizes).first()
    out = dict(columns)
    for i, c in enumerate(wide):
        before, after = found[f"b{i}"] or 0, found[f"a{i}"] or 0
        if before + after > _MAX_DIGITS:
            raise ValueError(f"column {c} needs {before} digits before and {after} after the point, a decimal holds "
                             f"{_MAX_DIGITS}; declare it as text")
        out[c] = f"numeric({max(before + after, 1)},{after})"
    return [(c, out[c]) for c, _ in columns]


def cast_problems(df: DataFrame, columns: Sequence[tuple[str, str]]) -> Column:
    """Array of (error_column, error_value, error_type) of the values that do not fit the
    declared types of ``columns`` (name, type); empty for a good row."""
    types = {f.name: f.dataType for f in df.schema.fields}
    found = F.array(*[
        F.when(does_not_fit(_q(c), types[c], t), F.struct(
            F.lit(c).alias("error_column"), _q(c).cast("string").alias("error_value"), F.lit(t).alias("error_type")))
        for c, t in columns])
    return F.filter(found, lambda x: x.isNotNull())


def cast_checked(df: DataFrame, columns: list[tuple[str, str]], on_error: str = "fail"):
    """Convert string (or any) columns to declared types.

    ``on_error="fail"``: one bad value fails the job (:func:`strict_cast`, independent of
    ANSI mode), including values longer than a ``varchar(n)``/``char(n)`` limit (a plain
    cast neither truncates nor fails).
    ``on_error="quarantine"``: returns ``(good, rejected)``.  ``good`` holds rows whose
    every value converted, cast to the declared types.  ``rejected`` holds one row per
    bad cell: the row's raw columns plus ``error_column``, ``error_value``, ``error_type``.
    A NULL input is never an error.  Columns not listed pass through unchanged.
    ``good`` and ``rejected`` are two plans over the same input; to load both in one pass use
    ``plans.incremental.load_checked``.
    """
    listed = dict(columns)
    if on_error not in ("fail", "quarantine"):
        raise ValueError("on_error must be 'fail' or 'quarantine'")
    types = {f.name: f.dataType for f in df.schema.fields}
    if on_error == "fail":
        return df.select(*[(checked_column(_q(c), types[c], listed[c]) if c in listed else _q(c)).alias(c)
                           for c in df.columns])

    flagged = df.withColumn("_problems", cast_problems(df, columns))
    good = flagged.filter(F.size("_problems") == 0).select(*[
        (converted_column(_q(c), types[c], listed[c]) if c in listed else _q(c)).alias(c) for c in df.columns])
    rejected = (flagged.filter(F.size("_problems") > 0)
                .select(*[_q(c) for c in df.columns], F.explode("_problems").alias("_p"))
                .select(*[_q(c) for c in df.columns], "_p.error_column", "_p.error_value", "_p.error_type"))
    return good, rejected


def apply_column_defaults(df: DataFrame, target: list[ColumnSpec]) -> DataFrame:
    """Shape appended rows like the target table.

    Only columns *absent* from ``df`` take their default expression (or NULL when there
    is none); a column that is present keeps its values, explicit NULLs included.
    """
    out = []
    for c in ordered(target):
        if c.name in df.columns:
            out.append(_q(c.name).cast(spark_type(c.type_name)).alias(c.name))
        elif c.default is not None:
            out.append(F.expr(c.default).cast(spark_type(c.type_name)).alias(c.name))
        else:
            out.append(F.lit(None).cast(spark_type(c.type_name)).alias(c.name))
    return df.select(*out)


def _base_type_name(dt: T.DataType) -> str:
    return "decimal" if isinstance(dt, T.DecimalType) else dt.simpleString()


def profile_columns(df: DataFrame) -> DataFrame:
    """P5: the per-column facts a source catalog supplies, computed in one pass.

    One row per column: ``position`` (1-based), ``column_name``, ``type_name``,
    ``length`` (longest string in characters, 0 for other types), ``precision`` and
    ``scale`` (decimals only), ``nullable`` (the column holds a NULL) and ``type_label``.
    A single aggregation computes every column's maximum length and NULL count
    (partial aggregation map-side, one row shuffled per task), then ``stack`` turns the
    one wide row into one row per column.
    """
    fields = df.schema.fields
    aggs = []
    for i, f in enumerate(fields):
        is_text = isinstance(f.dataType, (T.StringType, T.VarcharType, T.CharType))
        length = F.max(F.length(_q(f.name))) if is_text else F.lit(0)
        aggs.append(F.coalesce(length, F.lit(0)).cast("bigint").alias(f"l{i}"))
        aggs.append(F.count_if(_q(f.name).isNull()).cast("bigint").alias(f"n{i}"))
    wide = df.agg(*aggs)
    rows = []
    for i, f in enumerate(fields):
        prec = f"{f.dataType.precision}L" if isinstance(f.dataType, T.DecimalType) else "CAST(NULL AS BIGINT)"
        scale = f"{f.dataType.scale}L" if isinstance(f.dataType, T.DecimalType) else "CAST(NULL AS BIGINT)"
        name = f.name.replace("\\", "\\\\").replace("'", "\\'")
        rows.append(f"{i + 1}L, '{name}', '{_base_type_name(f.dataType)}', l{i}, {prec}, {scale}, n{i}")
    stacked = wide.selectExpr(
        f"stack({len(fields)}, {', '.join(rows)}) "
        "AS (position, column_name, type_name, length, precision, scale, nulls)")
    return stacked.select(
        "position", "column_name", "type_name", "length", "precision", "scale",
        (F.col("nulls") > 0).alias("nullable"),
        type_label("type_name", "length", "precision", "scale").alias("type_label"),
    )
