"""Mixing sources to target weights along a curriculum.

Every source has a weight schedule over training time (0 to 1), given as knots of a
piecewise-linear function.  Its integral is the source's share of the whole mix; its running
integral is the source's cumulative demand.  A document occupies a stretch of its source's
words; inverting the demand at the stretch's start gives its training position.  A source
asked for more than it has starts over, up to ``max_epochs`` times.  Built-in functions only.

The stretch of a document needs a running sum per source.  A source may hold a third of all
rows, so it is summed in two steps: per (source, bucket of the shuffled order), then over the
few buckets, then within each bucket.

The mix is range-sorted by the positions: documents by their first draw, draws each by its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import words_of

#: knots (time, weight) of the schedules dealt to the sources in turn; the integrals are 3, 1, 2
CURRICULUM = (((0.0, 4.5), (1.0, 1.5)),
              ((0.0, 0.5), (1.0, 1.5)),
              ((0.0, 1.0), (0.5, 3.0), (1.0, 1.0)))
MIX_SHARE = 1.5
MAX_EPOCHS = 2
BUCKETS = 4096


def integral(knots) -> float:
    return sum((t1 - t0) * (w0 + w1) / 2 for (t0, w0), (t1, w1) in zip(knots, knots[1:]))


def invert_demand(knots, part: Column) -> Column:
    """Time at which a schedule's running integral reaches ``part`` (0 to 1) of its whole."""
    area = integral(knots)
    done, cases = 0.0, []
    for (t0, w0), (t1, w1) in zip(knots, knots[1:]):
        piece = (t1 - t0) * (w0 + w1) / 2
        need = F.greatest(part * area - done, F.lit(0.0))
        slope = (w1 - w0) / (t1 - t0)
        # w0*x + slope*x^2/2 = need, in the form that is stable for small slopes
        x = 2 * need / (w0 + F.sqrt(F.greatest(F.lit(w0 * w0) + 2 * slope * need, F.lit(1e-300))))
        done += piece
        cases.append((done, F.least(F.lit(t0) + x, F.lit(t1))))
    out = cases[-1][1]
    for end, time in reversed(cases[:-1]):
        out = F.when(part * area <= end, time).otherwise(out)
    return out


def _order(id_col: str, text_col: str) -> Column:
    """Position of a document in its source's shuffled order: 60 bits of a digest of the id."""
    name = F.coalesce(F.col(id_col).cast("string"), F.col(text_col), F.lit(""))
    return F.conv(F.substring(F.md5(name), 1, 15), 16, 10).cast("long")


def targets(sizes: DataFrame, weights: list[float], share: float = MIX_SHARE, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size, kind, target) per source from (source, size) rows.

    Sources are ordered by code point, null last; ``kind`` deals the weights in turn.  All
    sources share ``share`` of all sizes by weight; none gets more than ``max_epochs`` times
    its size, and the excess is shared again by weight until none is above: sources are
    filled in order of size per weight, so the level is found in one pass over them.
    """
    if share > max_epochs:
        raise ValueError("the mix asks for more than max_epochs of everything")
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))) - 1
    kinds = per_source.withColumn("kind", (rank % len(weights)).cast("int"))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.col("kind") + 1)
    filled = kinds.withColumn("w", weight).withColumn("cap", max_epochs * F.col("source_size").cast("double"))
    by_need = Window.orderBy(F.col("cap") / F.col("w"), "kind", F.col("source").isNull(), "source")
    so_far = by_need.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    filled = filled.withColumns({
        "left": share * F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(so_far), F.lit(0.0)),
        "w_left": F.sum("w").over(everything) - F.coalesce(F.sum("w").over(so_far), F.lit(0.0))})
    filled = filled.withColumn("level", F.col("left") / F.col("w_left"))
    # the level is set by the first source that need not be capped; those after it share it
    open_level = F.min(F.when(F.col("cap") >= F.col("w") * F.col("level"), F.struct(F.col("cap") / F.col("w"), F.col("level")))) \
        .over(everything)
    shared = F.col("w") * open_level["level"]
    return filled.withColumn("target", F.coalesce(F.least("cap", shared), F.col("cap"))) \
        .select("source", "source_size", "kind", "target")


def _draws(docs: DataFrame, id_col: str, text_col: str, source_col: str, curriculum, share: float, max_epochs: int,
           buckets: int, keep_rows: bool) -> DataFrame:
    """Every row with ``draws``, an array of (training position, words drawn)."""
    weights = [integral(k) for k in curriculum]
    carried = docs.columns if keep_rows else [id_col]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in carried]).alias("_row"),
                       F.col(source_col).alias("source"),
                       F.size(words_of(F.col(text_col))).cast("long").alias("size"),
                       _order(id_col, text_col).alias("ord"), F.xxhash64(F.col(text_col)).alias("tie"))
    rows = rows.withColumn("bucket", F.expr(f"ord div {(1 << 60) // buckets}").cast("int"))
    small = docs.select(F.col(source_col).alias("source"), F.size(words_of(F.col(text_col))).cast("long").alias("size"),
                        _order(id_col, text_col).alias("ord"))
    sums = small.groupBy("source", F.expr(f"ord div {(1 << 60) // buckets}").cast("int").alias("bucket")) \
        .agg(F.sum("size").alias("size"))
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("source", "bucket", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start"))
    plan = targets(sums, weights, share, max_epochs)
    starts = starts.join(plan, starts["source"].eqNullSafe(plan["source"])).select(
        starts["source"].alias("_source"), F.col("bucket").alias("_bucket"), "start", "source_size", "kind", "target")
    within = Window.partitionBy("source", "bucket").orderBy("ord", "tie").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("offset", F.coalesce(F.sum("size").over(within), F.lit(0)))
    placed = placed.join(starts, F.col("source").eqNullSafe(F.col("_source")) & (F.col("bucket") == F.col("_bucket")))
    demand = F.round("target").cast("long")
    draws = []
    for epoch in range(max_epochs):
        begin = F.col("start") + F.col("offset") + epoch * F.col("source_size")
        part = begin.cast("double") / demand
        time = invert_demand(curriculum[-1], part)
        for k, knots in reversed(list(enumerate(curriculum[:-1]))):
            time = F.when(F.col("kind") == k, invert_demand(knots, part)).otherwise(time)
        words = F.greatest(F.lit(0), F.least(F.col("size"), demand - begin))
        draws.append(F.when(words > 0, F.struct(time.alias("position"), words.cast("long").alias("words"))))
    return placed.select("_row", "size", "source_size", "target", F.filter(F.array(*draws), lambda d: d.isNotNull()).alias("draws"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        curriculum=CURRICULUM, share: float = MIX_SHARE, max_epochs: int = MAX_EPOCHS, buckets: int = BUCKETS,
        keep_rows: bool = True) -> DataFrame:
    """Every row (struct ``_row`` of all its columns, or only its id) with size, source_size,
    target, taken (words drawn, repeats counted) and ``positions`` (training position of each
    draw, in 0 to 1), range-sorted by the first position; rows that are not drawn come last.

    Defined results: null and blank texts have size 0, are never drawn and have no position;
    a null source is a source of its own; documents are drawn in an order fixed by a digest
    of the id, so reruns agree (repeated rows are drawn one after the other); an empty table
    gives an empty result.
    """
    drawn = _draws(docs, id_col, text_col, source_col, curriculum, share, max_epochs, buckets, keep_rows)
    drawn = drawn.orderBy(F.get(F.col("draws"), F.lit(0))["position"].asc_nulls_last(), F.col(f"_row.`{id_col}`"))
    return drawn.select("_row", "size", "source_size", "target",
                        F.aggregate("draws", F.lit(0).cast("long"), lambda sum_, d: sum_ + d["words"]).alias("taken"),
                        F.col("draws.position").alias("positions"))


def training_order(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                   curriculum=CURRICULUM, share: float = MIX_SHARE, max_epochs: int = MAX_EPOCHS, buckets: int = BUCKETS,
                   keep_rows: bool = True) -> DataFrame:
    """The mix itself: one row per draw (all columns of ``docs``), range-sorted by training
    position.  Documents that are not drawn are absent; one drawn twice appears twice.

    Rows are whole documents: a source passes its target by the rest of its last document,
    of which ``taken`` counts only the words within the target."""
    drawn = _draws(docs, id_col, text_col, source_col, curriculum, share, max_epochs, buckets, keep_rows)
    drawn = drawn.select("_row", F.explode("draws.position").alias("_position"))
    return drawn.orderBy("_position", F.col(f"_row.`{id_col}`")).select("_row.*")
