"""Keyed upserts of table snapshots: insert-or-ignore (U1), insert-or-update (U2), and the
duplicate-source check (U3).

Both upserts are set-based joins on the keys, no per-row lookups.  Parquet tables have no
``MERGE``; the result is a new DataFrame to be written as the next snapshot.  Keys are
unique on the target (a primary key) and made unique on the source (U1 picks one row
per key, U2 refuses duplicates), so a key cannot be hot on either side.  The target is
always the streamed side of a join with the source, so a source that AQE measures to be
small is broadcast and the target only scanned.  A NULL key part conflicts with nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import target_partitions


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def _has_key(keys: Sequence[str]) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & _q(k).isNotNull()
    return cond


def duplicate_keys(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys present more than once, with their row count (a partial aggregation).  Keys with
    a NULL part differ from all others."""
    return (source.filter(_has_key(keys)).groupBy(*[_q(k) for k in keys]).agg(F.count(F.lit(1)).alias("rows"))
            .filter(F.col("rows") > 1))


def _may_repeat(source: DataFrame, keys: Sequence[str]) -> bool:
    """Does the 64-bit hash of a key occur more than once?  One long per key, dealt over a fixed
    number of tasks: keys that differ would else all meet in one, as their bytes compress well."""
    if any("collate" in source.select(_q(k)).schema[0].dataType.simpleString() for k in keys):
        return True                           # equal keys may have different bytes
    hashes = source.filter(_has_key(keys)).select(F.xxhash64(*[_q(k) for k in keys]).alias("_hash"))
    repeated = hashes.repartition(target_partitions(source.sparkSession), "_hash").groupBy("_hash").agg(F.count(F.lit(1)).alias("rows")) \
        .filter(F.col("rows") > 1)
    return not repeated.isEmpty()


def require_unique_source(source: DataFrame, keys: Sequence[str], show: int = 20) -> None:
    """Raise when a source key occurs twice (an upsert would change a row twice).

    The message lists up to ``show`` of the keys.  Keys are compared whole only if two rows
    share a hash."""
    if not _may_repeat(source, keys):
        return
    sample = duplicate_keys(source, keys).limit(show).collect()
    if sample:
        listed = ", ".join(str(tuple(r[k] for k in keys)) for r in sample)
        raise ValueError(f"source has duplicate keys {tuple(keys)}: {listed}")


def one_row_per_key(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keep one row per key, deterministically: the smallest remaining column tuple.

    ``min`` over a struct is a partial aggregate, so a key repeated a million times is
    reduced map-side before anything is shuffled.
    """
    others = [c for c in source.columns if c not in keys]
    if not others:
        return source.select(*[_q(k) for k in keys]).distinct()
    packed = F.min(F.struct(*[_q(c) for c in others])).alias("_row")
    return source.groupBy(*[_q(k) for k in keys]).agg(packed).select(
        *[_q(k) for k in keys], *[F.col("_row")[c].alias(c) for c in others])


def _fill(df: DataFrame, columns: Sequence[str], types: dict[str, str],
          defaults: dict[str, str] | None) -> DataFrame:
    defaults = defaults or {}
    out = []
    for c in columns:
        if c in df.columns:
            out.append(_q(c).cast(types[c]).alias(c))
        elif c in defaults:
            out.append(F.expr(defaults[c]).cast(types[c]).alias(c))
        else:
            out.append(F.lit(None).cast(types[c]).alias(c))
    return df.select(*out)


def upsert_ignore(target: DataFrame, source: DataFrame, keys: Sequence[str],
                  insert_defaults: dict[str, str] | None = None) -> DataFrame:
    """``INSERT ... ON CONFLICT DO NOTHING`` for whole tables.

    Existing rows win; source rows with new keys are added (one per key, the smallest
    row); a source row with a NULL key part conflicts with nothing and is added as it
    is; target columns missing from the source take ``insert_defaults`` (SQL text) or
    NULL.  The target keys are first reduced to those the source has, by a semi join with
    the target streamed (a small source is broadcast, the target's key column scanned), and
    the de-duplicated source is anti-joined to what is left.
    """
    types = {f.name: f.dataType.simpleString() for f in target.schema.fields}
    others = [c for c in source.columns if c not in keys]
    has_key = _has_key(keys)
    keyless = source.filter(~has_key)        # a NULL key never conflicts: always inserted
    source = source.filter(has_key)
    if others:
        agg = source.groupBy(*[_q(k) for k in keys]).agg(F.min(F.struct(*[_q(c) for c in others])).alias("_row"))
        src = agg.select(*[_q(k) for k in keys], *[F.col("_row")[c].alias(c) for c in others])
        # referencing the aggregated row keeps this use identical to the
        # one above, so the de-duplication runs once and both read the same exchange
        used = agg.filter(F.col("_row").isNotNull())
    else:
        src = used = source.select(*[_q(k) for k in keys]).distinct()
    taken = target.select(*[_q(k).alias(f"_t{i}") for i, k in enumerate(keys)])
    probe = used.select(*[_q(k).alias(f"_s{i}") for i, k in enumerate(keys)])
    taken = taken.join(probe, [F.col(f"_t{i}") == F.col(f"_s{i}") for i in range(len(keys))], "left_semi")
    fresh = src.join(taken, [_q(k) == F.col(f"_t{i}") for i, k in enumerate(keys)], "left_anti")
    fresh = fresh.unionByName(keyless.select(*src.columns))
    return target.unionByName(_fill(fresh, target.columns, types, insert_defaults))


def fail_on_duplicate_keys(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The source unchanged, but a job reading it fails on the first duplicated key.

    The count runs over a window partitioned by the keys: the same hash partitioning and
    sort a sort-merge join on those keys needs, so inside an upsert it adds no exchange.
    The window holds each key's rows while counting them, so a heavily duplicated key is
    buffered (and spilled) in one task before the job fails; use it for sources that are
    expected to be unique.
    """
    w = Window.partitionBy(*[_q(k) for k in keys])
    key_text = F.concat_ws(", ", *[F.coalesce(_q(k).cast("string"), F.lit("NULL")) for k in keys])
    message = F.concat(F.lit(f"source has duplicate keys {tuple(keys)}: "), key_text)
    return (source.withColumn("_key_rows", F.count(F.lit(1)).over(w))
            .filter(F.when((F.col("_key_rows") > 1) & _has_key(keys), F.raise_error(message)).otherwise(F.lit(True)))
            .drop("_key_rows"))


def upsert_update(target: DataFrame, source: DataFrame, keys: Sequence[str], update_cols: Sequence[str],
                  insert_defaults: dict[str, str] | None = None, validate: bool | str = "eager") -> DataFrame:
    """``INSERT ... ON CONFLICT DO UPDATE SET <update_cols>`` for whole tables.

    * matched key: only ``update_cols`` take the source value, every other column keeps
      the target's (user-edited) value;
    * source-only key: inserted; target columns absent from the source take
      ``insert_defaults`` or NULL;
    * target-only key: kept unchanged (a refresh never deletes).

    A marker column tracks whether a source row was found, so a NULL value is never mistaken
    for a missing row.  The updates are target left join source; the inserts are the source
    anti joined to the target keys it shares.  A duplicated source key is an error.  By default
    (``validate="eager"``) U3 runs first, over hashes of the key columns only; it lists up to
    20 offending keys.  A key repeated many times costs one task time, not memory.
    ``validate="in_job"`` checks inside the upsert's own job instead
    (:func:`fail_on_duplicate_keys`: for sources expected to be
    unique); ``validate=False`` trusts the source.
    """
    if validate == "in_job":
        source = fail_on_duplicate_keys(source, keys)
    elif validate:
        require_unique_source(source, keys)
    types = {f.name: f.dataType.simpleString() for f in target.schema.fields}
    n = range(len(keys))
    new = source.filter(_has_key(keys)).select(*[_q(k).alias(f"_s{i}") for i, k in enumerate(keys)],
                                               *[_q(c).alias(f"_new_{c}") for c in update_cols if c in source.columns],
                                               F.lit(True).alias("_found"))
    joined = target.join(new, [_q(k) == F.col(f"_s{i}") for i, k in enumerate(keys)], "left")

    def value(c: str) -> Column:
        if c not in update_cols or c in keys:
            return _q(c)
        given = F.col(f"`_new_{c}`") if c in source.columns else \
            F.expr(insert_defaults[c]) if c in (insert_defaults or {}) else F.lit(None)
        return F.when(F.col("_found"), given.cast(types[c])).otherwise(_q(c)).alias(c)
    merged = joined.select(*[value(c) for c in target.columns])
    probe = source.select(*[_q(k).alias(f"_s{i}") for i, k in enumerate(keys)])
    hit = target.select(*[_q(k).alias(f"_t{i}") for i, k in enumerate(keys)]).join(
        probe, [F.col(f"_t{i}") == F.col(f"_s{i}") for i in n], "left_semi")
    fresh = source.join(hit, [_q(k) == F.col(f"_t{i}") for i, k in enumerate(keys)], "left_anti")
    return merged.unionByName(_fill(fresh, target.columns, types, insert_defaults))
