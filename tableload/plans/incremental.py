"""Loads that touch their data once: partitioned upserts in place (U1, U2) and loads that
part good rows from rejected ones in a single pass (P2, S2, R5)."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.project import cast_problems, converted_column
from ..operators.routing import HashFn, reject_condition, route, xxhash_keys
from ..operators.upsert import upsert_ignore, upsert_update
from ..sources.delimited import text_records
from ..specs import ColumnSpec, PartitionLevel, PartitionScheme, ordered
from .materialize import _discard, _fs, assert_routed, path_exists


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def _scheme(scheme: PartitionScheme | PartitionLevel) -> PartitionScheme:
    return PartitionScheme(scheme) if isinstance(scheme, PartitionLevel) else scheme


def _partition_columns(scheme: PartitionScheme, part: str, subpart: str) -> list[str]:
    return [part, subpart] if any(level.partitions for level in scheme.sub.values()) else [part]


# --------------------------------------------------------------------------- partitioned upsert

def read_partitioned(spark: SparkSession, path: str, partition_columns: Sequence[str]) -> DataFrame:
    """A partitioned table with its partition names as text, whatever they look like."""
    found = spark.read.parquet(path).schema
    fields = [T.StructField(f.name, T.StringType()) if f.name in partition_columns else f for f in found.fields]
    return spark.read.schema(T.StructType(fields)).parquet(path)


def _in_partitions(touched: Sequence, columns: Sequence[str]) -> Column:
    """Condition on the partition columns only, which prunes directories at planning time."""
    top, rest = columns[0], columns[1:]
    if not rest:
        return _q(top).isin([t[0] for t in touched])
    cond = F.lit(False)
    for name in sorted({t[0] for t in touched}):
        subs = [t[1] for t in touched if t[0] == name]
        below = _q(rest[0]).isin([s for s in subs if s is not None])
        if None in subs:
            below = below | _q(rest[0]).isNull()
        cond = cond | ((_q(top) == name) & below)
    return cond


def upsert_partitioned(spark: SparkSession, path: str, source: DataFrame, keys: Sequence[str],
                       scheme: PartitionScheme | PartitionLevel, update_cols: Sequence[str] | None = None,
                       insert_defaults: dict[str, str] | None = None, hash_fn: HashFn = xxhash_keys,
                       part: str = "part", subpart: str = "subpart") -> list[tuple]:
    """U1 (``update_cols=None``) or U2 on a table written by ``materialize_partitioned``:
    only the partitions that the source's keys fall into are read and written again.

    The source is routed by the table's own scheme, so its partitions are known before the
    target is opened (a list no longer than the declared partitions).  The target scan is
    pruned to them, and dynamic partition overwrite replaces just their directories; the
    files of all others stay as they are.  As in the source database, the partition key must
    be made of key columns -- otherwise an equal key could stand in another partition.

    A source row that fits no partition, or a duplicated source key (U2), fails the job before
    anything is replaced.  Each partition's directory is replaced as a whole when the job
    commits; the swap of several directories is not one atomic step.  Returns the partitions
    that were written.
    """
    scheme = _scheme(scheme)
    columns = _partition_columns(scheme, part, subpart)
    key_only = source.select(*[_q(k) for k in keys]).limit(0)
    for level in (scheme.top, *scheme.sub.values()):
        try:
            key_only.selectExpr(f"struct({level.key})")
        except AnalysisException as exc:
            raise ValueError(f"partition key {level.key} must be made of the key columns {list(keys)}") from exc
    target = read_partitioned(spark, path, columns)
    routed = assert_routed(route(source, scheme, part, subpart, hash_fn), scheme, part, subpart)
    touched = [tuple(r) for r in routed.select(*columns).distinct().collect()]
    if not touched:
        return []
    old = target.filter(_in_partitions(touched, columns))
    if update_cols is None:
        merged = upsert_ignore(old, routed, keys, insert_defaults)
    else:
        moved = set(update_cols) & set(keys)
        if moved:
            raise ValueError(f"key columns cannot be updated: {sorted(moved)}")
        merged = upsert_update(old, routed, keys, list(update_cols), insert_defaults)
    merged.hint("rebalance", *columns).write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
        .partitionBy(*columns).parquet(path)
    return sorted(touched, key=lambda t: tuple((x is not None, x) for x in t))


# --------------------------------------------------------------------------- one-pass load

#: an error of a row: the column, its raw value and the type it does not fit
ERRORS = "array<struct<error_column:string,error_value:string,error_type:string>>"
_OUTCOME, _RAW, _ERRORS = "_outcome", "_raw", "_errors"


@dataclass(frozen=True)
class CheckedLoad:
    """``good`` rows (typed, partitioned if asked for), ``rejected`` rows (raw columns and one
    row per error) and the counts of the load: good_rows, rejected_rows, errors."""

    good: DataFrame
    rejected: DataFrame
    counts: dict[str, int]


def load_checked(df: DataFrame, columns: Sequence[tuple[str, str]], path: str, rejects_path: str,
                 scheme: PartitionScheme | PartitionLevel | None = None, hash_fn: HashFn = xxhash_keys,
                 part: str = "part", subpart: str = "subpart", problems: Column | None = None) -> CheckedLoad:
    """Cast ``columns`` (name, declared type) and load the good rows to ``path`` and the others,
    with every error, to ``rejects_path`` -- in one pass over the input.

    One job writes both sides: the outcome is the first partition directory of its output,
    and the two directories are then renamed to their places, so neither appears if the job
    fails.  Counts are observed by that job.  With a ``scheme``, good rows are routed, and a
    row that fits no partition is rejected with error column ``<partition>``.  ``problems`` adds
    errors of the caller's own (an array as in ``ERRORS``).  Columns not listed pass through.

    The files of the good side also hold the two columns of the rejected side, always NULL;
    ``CheckedLoad.good`` leaves them out.
    """
    spark = df.sparkSession
    listed = dict(columns)
    clash = {_OUTCOME, _RAW, _ERRORS} & set(df.columns)
    if clash:
        raise ValueError(f"columns {sorted(clash)} have names that the load uses")
    for place in (path, rejects_path):
        if path_exists(spark, place):
            raise FileExistsError(f"target {place} already exists")
    types = {f.name: f.dataType for f in df.schema.fields}
    typed = [(converted_column(_q(c), types[c], listed[c]) if c in listed else _q(c)).alias(c) for c in df.columns]
    errors = cast_problems(df, columns)
    if problems is not None:
        errors = F.concat(problems, errors)
    out = df.select(*typed, F.struct(*[_q(c) for c in df.columns]).alias(_RAW), errors.cast(ERRORS).alias(_ERRORS))
    names, partitions = list(df.columns), []
    if scheme is not None:
        scheme = _scheme(scheme)
        partitions = _partition_columns(scheme, part, subpart)
        out = route(out, scheme, part, subpart, hash_fn)
        lost = F.array(F.struct(F.lit("<partition>").alias("error_column"), F.lit(None).cast("string").alias("error_value"),
                                F.lit("no partition fits").alias("error_type"))).cast(ERRORS)
        out = out.withColumn(_ERRORS, F.when((F.size(_ERRORS) == 0) & reject_condition(scheme, part, subpart), lost)
                             .otherwise(F.col(_ERRORS)))
    good = F.size(_ERRORS) == 0
    watch = Observation(f"load-{uuid.uuid4().hex[:8]}")
    out = out.withColumn(_OUTCOME, F.when(good, F.lit("good")).otherwise(F.lit("rejected"))).observe(
        watch, F.count_if(good).alias("good_rows"), F.count_if(~good).alias("rejected_rows"),
        F.coalesce(F.sum(F.size(_ERRORS)), F.lit(0)).alias("errors"))
    out = out.select(*[F.when(good, _q(c)).alias(c) for c in [*names, *partitions]],
                     *[F.when(~good, F.col(c)).alias(c) for c in (_RAW, _ERRORS)], _OUTCOME)
    schema = out.schema
    if partitions:
        out = out.hint("rebalance", _OUTCOME, *partitions)
    staging = f"{path.rstrip('/')}._staging-{uuid.uuid4().hex[:12]}"
    published = []
    try:
        out.write.partitionBy(_OUTCOME, *partitions).parquet(staging)
        for outcome, place in (("rejected", rejects_path), ("good", path)):
            fs, side = _fs(spark, f"{staging}/{_OUTCOME}={outcome}")
            _, target = _fs(spark, place)
            if not fs.exists(side):                                  # no row of this kind: an empty table
                bare = T.StructType([f for f in schema.fields if f.name not in (_OUTCOME, *partitions)])
                spark.createDataFrame([], bare).write.parquet(f"{staging}/{outcome}-empty")
                _, side = _fs(spark, f"{staging}/{outcome}-empty")
            if target.getParent() is not None and not fs.exists(target.getParent()):
                fs.mkdirs(target.getParent())
            if not fs.rename(side, target):
                raise OSError(f"could not publish {place}")
            published.append(place)
    except BaseException:
        for place in published:
            _discard(spark, place)
        raise
    finally:
        _discard(spark, staging)
    fields = {f.name: f for f in schema.fields}
    kept = T.StructType([fields[c] for c in [*names, *partitions]])
    bad = spark.read.schema(T.StructType([fields[_RAW], fields[_ERRORS]])).parquet(rejects_path) \
        .select(_RAW, F.explode(_ERRORS).alias("e"))
    counts = watch.get
    return CheckedLoad(spark.read.schema(kept).parquet(path),
                       bad.select(*[F.col(f"{_RAW}.`{c}`").alias(c) for c in names], "e.error_column", "e.error_value", "e.error_type"),
                       {k: int(counts[k]) for k in ("good_rows", "rejected_rows", "errors")})


def load_delimited(spark: SparkSession, source: str | list[str], columns: list[ColumnSpec], path: str, rejects_path: str,
                   **options) -> CheckedLoad:
    """S2 in one pass: text-format files into ``path``, lines with a wrong number of fields
    (error column ``<line>``) or values that do not convert into ``rejects_path``."""
    cols = ordered(columns)
    records, width_ok, line = text_records(spark, source, [c.name for c in cols])
    wrong = F.when(~width_ok, F.array(F.struct(
        F.lit("<line>").alias("error_column"), line.alias("error_value"), F.lit(f"{len(cols)} fields").alias("error_type")))) \
        .otherwise(F.array().cast(ERRORS))
    raw = records.select(*[F.when(width_ok, _q(c.name)).alias(c.name) for c in cols], wrong.alias("_wrong"))
    loaded = load_checked(raw, [(c.name, c.type_name) for c in cols], path, rejects_path, problems=F.col("_wrong"), **options)
    return CheckedLoad(loaded.good.drop("_wrong"), loaded.rejected.drop("_wrong"), loaded.counts)
