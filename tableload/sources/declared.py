"""Scan a source through a declared column list.

The column list is the contract: columns come out in ``position`` order, under their
target names, with their declared types.  Nothing is inferred.  For columnar sources
the projection is a plain ``select`` over the file schema, so Catalyst prunes unread
columns and pushes filters that are applied later down to the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..specs import ColumnSpec, ordered
from ..operators.project import checked_column, project_mapped, spark_type, target_names

_SELF_DESCRIBING = {"parquet", "orc", "delta", "avro"}


def declared_schema(columns: list[ColumnSpec], source_names: bool = True) -> str:
    """DDL schema of a column list (source spelling by default, as a reader needs it)."""
    return ", ".join(
        f"`{c.source if source_names else c.name}` {spark_type(c.type_name)}" for c in ordered(columns))


def scan_declared(spark: SparkSession, fmt: str, path: str | list[str] | None,
                  columns: list[ColumnSpec], options: dict[str, str] | None = None,
                  on_error: str = "fail") -> DataFrame:
    """Read ``path`` as ``fmt`` and return exactly the declared columns.

    * parquet/orc: the file schema is read, then the declared columns are selected by
      their source names and cast (ANSI cast: a bad value fails the load);
    * csv/json/text formats: the declared schema is handed to the reader, so the file is
      parsed straight into the declared types (``mode=FAILFAST`` unless overridden);
    * jdbc: pass the connection in ``options`` (``url``, ``dbtable``, and for a parallel
      read ``partitionColumn``/``lowerBound``/``upperBound``/``numPartitions``).

    ``on_error="quarantine"`` is available through :func:`tableload.operators.project.cast_checked`
    on a string-typed scan; here a failure always fails the scan.
    """
    options = dict(options or {})
    fmt = fmt.lower()
    reader = spark.read.options(**options)
    if fmt in _SELF_DESCRIBING or fmt == "jdbc":
        df = reader.format(fmt).load(path) if path is not None else reader.format(fmt).load()
        return project_mapped(df, columns)
    if fmt in ("csv", "json"):
        target_names(columns)
        # a malformed record fails the scan (the readers' default would turn it into NULLs)
        reader = reader.option("mode", options.get("mode", "FAILFAST"))
        df = reader.schema(declared_schema(columns)).format(fmt).load(path)
        # parsed into the declared types already; only length limits still need a check
        types = {f.name: f.dataType for f in df.schema.fields}
        return df.select(*[checked_column(F.col(f"`{c.source}`"), types[c.source], c.type_name).alias(name)
                           for c, name in zip(ordered(columns), target_names(columns))])
    raise ValueError(f"unsupported source format {fmt!r}")
