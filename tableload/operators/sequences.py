"""Sequences (Q1): number the rows of a table from a catalogued sequence.

The first value resumes after the remote sequence's last value
(``start = last_value + increment_by``, computed with Python integers, so it never wraps
around).  Values then step by ``increment_by``; at the end of the range a cyclical
sequence restarts at ``min_value`` (at ``max_value`` when descending), a non-cyclical one
fails.  Bounds are clamped into bigint range; a missing bound is the default of the
direction (1 .. 2^63-1 ascending, -2^63 .. -1 descending).

The dense 0-based ordinal of every row is computed without a global window (which would
pull all rows into one task):

1. range-partition the rows on the order keys into a fixed number of partitions (a hash
   of the whole row is the last range key, so a hot key still spreads out) and sort
   each partition;
2. ``monotonically_increasing_id`` gives (partition index, position in partition);
3. the rows with those positions are written once to the shared scratch folder
   (``spark.checkpoint.dir``): the bounds of a range exchange are sampled, so counting and
   numbering must read one and the same outcome of it, not two runs of the plan;
4. rows per partition are counted -- a result with one row per partition -- and turned
   into prefix offsets on that tiny table, which is broadcast back (its size is bounded
   by the partition count).

The range exchange uses an explicit partition number, so adaptive execution neither
coalesces nor splits it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import clamp_to_bigint_py
from ..session import scratch_path, target_partitions
from ..specs import BIGINT_MAX, BIGINT_MIN, SequenceSpec
from .relops import row_hash, sort_columns

_POS_BITS = 33   # monotonically_increasing_id puts the partition index above bit 33


def _fresh(df: DataFrame, *names: str) -> list[str]:
    """Names for working columns that ``df`` does not have (in any case)."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name in taken:
            name += "_"
        taken.add(name)
        out.append(name)
    return out


def dense_ordinal(df: DataFrame, order: Sequence[str | tuple[str, bool] | Column], out: str = "_ord",
                  num_partitions: int | None = None) -> DataFrame:
    """Add ``out``: 0, 1, 2, ... in the given order (ties broken arbitrarily but densely).

    The written copy stays below ``spark.checkpoint.dir``, where the result reads it."""
    n = num_partitions or target_partitions(df.sparkSession)
    keys = sort_columns(order, df)
    tiebreak = row_hash(df)
    ranged = df.repartitionByRange(n, *keys, tiebreak).sortWithinPartitions(*keys, tiebreak)
    if out in df.columns:
        raise ValueError(f"the table already has a column {out}")
    pid, pos, at, cnt, off = _fresh(df, "_pid", "_pos", "_mid", "_cnt", "_off")
    tagged = ranged.withColumn(at, F.monotonically_increasing_id()).select(
        *[F.col(f"`{c}`") for c in df.columns], F.shiftright(at, _POS_BITS).alias(pid),
        F.col(at).bitwiseAND(F.lit((1 << _POS_BITS) - 1)).alias(pos))
    path = scratch_path(df.sparkSession, "ordinal")
    tagged.write.parquet(path)
    tagged = df.sparkSession.read.schema(tagged.schema).parquet(path)
    counts = tagged.groupBy(pid).agg(F.count(F.lit(1)).alias(cnt))
    offsets = counts.select(
        pid, F.coalesce(F.sum(cnt).over(Window.orderBy(pid).rowsBetween(Window.unboundedPreceding, -1)),
                        F.lit(0)).alias(off))
    return tagged.join(F.broadcast(offsets), pid).select(
        *[F.col(f"`{c}`") for c in df.columns], (F.col(off) + F.col(pos)).alias(out))


def ordered_group_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str | tuple[str, bool] | Column],
                       out: str = "ordinal", num_partitions: int | None = None) -> DataFrame:
    """A1 for groups of any size: every row with its 0-based place ``out`` in its group.

    No group is gathered: rows are numbered over the whole table by (keys, order), and each
    group's first number, a partial aggregate, is taken off again.  NULL keys form a group.
    """
    if out in df.columns:
        raise ValueError(f"the table already has a column {out}")
    whole, first, *group = _fresh(df, "_all", "_first", *[f"_g{i}" for i in range(len(keys))])
    ranked = dense_ordinal(df, [*keys, *order], whole, num_partitions)
    starts = ranked.groupBy(*[F.col(f"`{k}`").alias(g) for k, g in zip(keys, group)]).agg(F.min(whole).alias(first))
    same = [F.col(f"`{k}`").eqNullSafe(F.col(g)) for k, g in zip(keys, group)]
    return ranked.join(starts, same).select(*[F.col(f"`{c}`") for c in df.columns],
                                            (F.col(whole) - F.col(first)).alias(out))


def sequence_bounds(seq: SequenceSpec) -> tuple[int, int, int, int]:
    """``(start, min, max, increment)`` after clamping and defaults; raises on bad specs."""
    inc = int(seq.increment_by)
    if inc == 0:
        raise ValueError("increment_by must not be zero")
    lo = clamp_to_bigint_py(seq.min_value)
    hi = clamp_to_bigint_py(seq.max_value)
    if lo is None:
        lo = 1 if inc > 0 else BIGINT_MIN
    if hi is None:
        hi = BIGINT_MAX if inc > 0 else -1
    if lo >= hi:
        raise ValueError(f"sequence {seq.name}: MINVALUE ({lo}) must be less than MAXVALUE ({hi})")
    start = int(seq.last_value) + inc
    if start > hi:
        raise ValueError(f"sequence {seq.name}: START value ({start}) cannot be greater than MAXVALUE ({hi})")
    if start < lo:
        raise ValueError(f"sequence {seq.name}: START value ({start}) cannot be less than MINVALUE ({lo})")
    return start, lo, hi, inc


def _dec(x: int) -> Column:
    """An exact decimal(38,0) literal (spans like max - min may exceed bigint)."""
    return F.expr(f"CAST('{int(x)}' AS DECIMAL(38,0))")


def sequence_value(ordinal: Column, seq: SequenceSpec) -> Column:
    """The sequence value handed out to the row with this 0-based ordinal."""
    start, lo, hi, inc = sequence_bounds(seq)
    dec = "decimal(38,0)"
    if inc > 0:
        first_run = (hi - start) // inc + 1          # values before the first wrap
        cycle = (hi - lo) // inc + 1
        restart = lo
    else:
        first_run = (start - lo) // (-inc) + 1
        cycle = (hi - lo) // (-inc) + 1
        restart = hi
    i = ordinal.cast(dec)
    in_run = _dec(start) + i * _dec(inc)
    if seq.cyclical:
        after = _dec(restart) + F.pmod(i - _dec(first_run), _dec(cycle)).cast(dec) * _dec(inc)
    else:
        after = F.raise_error(F.lit(f"nextval: reached the end of sequence {seq.name}")).cast(dec)
    return F.when(i < _dec(first_run), in_run.cast(dec)).otherwise(after).cast("bigint")


def assign_sequence(df: DataFrame, order: Sequence[str | tuple[str, bool] | Column], seq: SequenceSpec,
                    out: str = "id", num_partitions: int | None = None) -> DataFrame:
    """Q1: add column ``out`` with the sequence values, handed out in ``order``."""
    sequence_bounds(seq)     # fail early on a bad spec
    (at,) = _fresh(df, "_seq_ord")
    ranked = dense_ordinal(df, order, at, num_partitions)
    return ranked.withColumn(out, sequence_value(F.col(at), seq)).drop(at)


def assign_sequence_blocks(df: DataFrame, seq: SequenceSpec, out: str = "id", writers: int | None = None) -> DataFrame:
    """Q1 with ``seq.cache_size``: unique numbers in blocks, as sessions with a cache draw them.

    Every task takes blocks of ``cache_size`` numbers in turn with the other tasks (its k-th
    block is number k * writers + its own place), so no row is moved, sorted or counted first.
    Numbers are unique, rise within a task and lie in the sequence's range; blocks that are
    not used up leave gaps, and nothing is said about the order of the rows.  A task run again
    draws the same numbers.  ``writers`` is the number of tasks that draw; without it one small
    job finds how many there are.  More tasks than that fail the job, as does the end of the
    sequence, which gaps bring nearer; a cyclical sequence would repeat numbers and is refused.
    """
    if seq.cyclical:
        raise ValueError(f"sequence {seq.name} cycles: numbers in blocks would not stay unique")
    sequence_bounds(seq)
    if seq.cache_size < 1:
        raise ValueError(f"sequence {seq.name}: CACHE ({seq.cache_size}) must be greater than zero")
    if out in df.columns:
        raise ValueError(f"the table already has a column {out}")
    if writers is None:
        last = df.select(F.spark_partition_id().alias("p")).agg(F.max("p")).first()[0]
        writers = (0 if last is None else last) + 1
    (at,) = _fresh(df, "_mid")
    tagged = df.withColumn(at, F.monotonically_increasing_id())
    task, place = F.shiftright(at, _POS_BITS), F.col(at).bitwiseAND(F.lit((1 << _POS_BITS) - 1))
    cache = F.lit(seq.cache_size).cast("long")
    block = F.floor(place.cast("decimal(20,0)") / cache).cast("long") * F.lit(writers) + task
    ordinal = F.when(task < writers, block * cache + place % cache).otherwise(
        F.raise_error(F.concat(F.lit(f"sequence {seq.name}: more than {writers} tasks draw numbers, task "),
                               task.cast("string"))).cast("long"))
    return tagged.withColumn(out, sequence_value(ordinal, seq)).drop(at)
