"""Table materialization: plain (S3), partitioned (S4), many tables (S5), clustered.

All writes are all-or-nothing: the job writes into a fresh staging directory next to
the target and the staging directory is renamed onto the target only after the job
committed.  A failed job (bad value, row fitting no partition, lost executors beyond
the retry budget) leaves no target behind.  The target must not exist beforehand.
The rename is atomic on HDFS-like file systems; on object stores it is a copy, so there
a reader can see the target appear gradually (a table format with atomic commits avoids
that).  Tables are written as Parquet unless another file format is given.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.relops import row_hash, sort_columns
from ..operators.routing import HashFn, reject_condition, route, xxhash_keys
from ..operators.filters import partial_filter
from ..specs import PartitionLevel, PartitionScheme
from .runlog import Step, run_logged


# --------------------------------------------------------------------------- file system

def _fs(spark: SparkSession, path: str):
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(sc._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def _discard(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def _publish(spark: SparkSession, write: Callable[[str], None], path: str) -> str:
    """Run ``write(staging)`` and rename the staging directory onto ``path``."""
    if path_exists(spark, path):
        raise FileExistsError(f"target {path} already exists")
    staging = f"{path.rstrip('/')}._staging-{uuid.uuid4().hex[:12]}"
    try:
        write(staging)
        fs, src = _fs(spark, staging)
        _, dst = _fs(spark, path)
        parent = dst.getParent()
        if parent is not None and not fs.exists(parent):
            fs.mkdirs(parent)
        if not fs.rename(src, dst):
            raise OSError(f"could not publish {staging} as {path}")
    except BaseException:
        _discard(spark, staging)
        raise
    return path


# --------------------------------------------------------------------------- S3

def materialize_table(df: DataFrame, path: str, with_data: bool = True, fmt: str = "parquet") -> str:
    """S3: copy a whole table to ``path`` (or only its shape, ``with_data=False``)."""
    src = df if with_data else df.limit(0)
    return _publish(df.sparkSession, lambda p: src.write.format(fmt).save(p), path)


# --------------------------------------------------------------------------- S4

def assert_routed(routed: DataFrame, scheme: PartitionScheme, part: str = "part",
                  subpart: str = "subpart") -> DataFrame:
    """Fail the job on the first row that fits no partition.

    Written as a filter so that it cannot be pruned; it costs no extra pass: the check
    runs in the same stage as the write.
    """
    bad = reject_condition(scheme, part, subpart)
    return routed.filter(F.when(bad, F.raise_error(F.lit("row fits no partition of the table")))
                         .otherwise(F.lit(True)))


def materialize_partitioned(df: DataFrame, scheme: PartitionScheme | PartitionLevel, path: str,
                            with_data: bool = True, hash_fn: HashFn = xxhash_keys,
                            part: str = "part", subpart: str = "subpart", fmt: str = "parquet") -> str:
    """Route rows to partitions and write them as ``part=/subpart=`` directories.

    A single row that fits nowhere fails the whole table.  The ``REBALANCE`` hint lets
    AQE shuffle rows by partition while splitting a partition that holds a large share
    of the rows over several tasks (and files) and merging tiny ones, so neither a hot
    partition nor many small partitions turn into one huge or many tiny files.
    """
    if isinstance(scheme, PartitionLevel):
        scheme = PartitionScheme(scheme)
    routed = assert_routed(route(df, scheme, part, subpart, hash_fn), scheme, part, subpart)
    two = any(lvl.partitions for lvl in scheme.sub.values())
    cols = [part, subpart] if two else [part]
    src = routed if with_data else routed.limit(0)
    out = src.hint("rebalance", *cols)
    return _publish(df.sparkSession, lambda p: out.write.partitionBy(*cols).format(fmt).save(p), path)


# --------------------------------------------------------------------------- R3 as buckets

def materialize_bucketed(df: DataFrame, keys: Sequence[str], buckets: int, path: str, table: str) -> str:
    """Hash partitions as the buckets of a catalogued table: joins and aggregates on the
    keys of tables with equal bucket counts need no exchange.

    Rows are shuffled once, here, so that every bucket is one sorted file.  A bucket is one
    task wherever the table is read by key: choose ``buckets`` so that one fits a task (bytes
    / 256 MB, say), and do not bucket on a key of which one value holds a large share.  The
    table is external: dropping it leaves the files.  If the write fails, nothing of the table
    is left.  A row's bucket is ``bucket_hash`` of its keys.
    """
    spark = df.sparkSession
    if path_exists(spark, path):
        raise FileExistsError(f"target {path} already exists")
    if spark.catalog.tableExists(table):
        raise FileExistsError(f"table {table} already exists")
    placed = df.repartition(buckets, *[F.col(f"`{k}`") for k in keys])
    try:
        placed.write.format("parquet").option("path", path).bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table)
    except BaseException:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        _discard(spark, path)
        raise
    return table


# --------------------------------------------------------------------------- X1

def clustered_copy(df: DataFrame, keys: Sequence[str | tuple[str, bool]], path: str,
                   where: str | None = None, num_partitions: int | None = None, fmt: str = "parquet") -> str:
    """A copy range-clustered and sorted on ``keys`` (Parquet min/max stats then
    skip row groups on selective reads).  ``where`` keeps only the covered rows.

    Equal keys may span several partitions: a hash of the whole row is the last range
    key, so a key holding a large share of the rows is split over many tasks and files
    instead of landing in one.  The hash is deterministic, so retried tasks route rows
    exactly as the first attempt did.
    """
    spark = df.sparkSession
    src = partial_filter(df, where)
    order = sort_columns(keys, src)
    tiebreak = row_hash(src)
    # without an explicit count the range exchange starts from the adaptive initial
    # partition number and AQE merges neighbouring ranges up to the advisory size, so the
    # file count follows the data while the global order is kept
    ranged = src.repartitionByRange(num_partitions, *order, tiebreak) if num_partitions \
        else src.repartitionByRange(*order, tiebreak)
    out = ranged.sortWithinPartitions(*order)
    return _publish(spark, lambda p: out.write.format(fmt).save(p), path)


# --------------------------------------------------------------------------- S5

@dataclass
class TableLoad:
    """One table of a multi-table load."""

    name: str
    build: Callable[[], DataFrame]      # lazily builds the source DataFrame (scan + casts)
    path: str
    scheme: PartitionScheme | PartitionLevel | None = None
    migrate: bool = True
    with_data: bool = True
    schema_name: str | None = None
    after: Callable[[str], None] | None = None      # called with the path once the table is there


def materialize_many(spark: SparkSession, tables: Sequence[TableLoad], parallelism: int = 1):
    """Load every flagged table; a failing table leaves no target and is logged.

    What a table's ``after`` does follows its load at once, in the same thread; if it raises,
    the step counts as failed, but the table stays.

    Returns ``(failures, written paths by table, log DataFrame)``.
    """

    def action(t: TableLoad):
        def run():
            df = t.build()
            if t.scheme is None:
                path = materialize_table(df, t.path, t.with_data)
            else:
                path = materialize_partitioned(df, t.scheme, t.path, t.with_data)
            if t.after is not None:
                t.after(path)
            return path
        return run

    steps = [Step("materialize table", t.name, action(t), t.schema_name, f"load {t.name} into {t.path}")
             for t in tables if t.migrate]
    results, log = run_logged(spark, steps, parallelism)
    return len(steps) - len(results), results, log
