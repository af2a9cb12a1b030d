"""Hard negatives by threshold joins over an inverted index with norm bounds.

Rows become integer vectors with their dimensions in one order, largest first, and are dealt
over shards.  A join finds, for a set of queries with a threshold each, all rows scoring at
least that much: in a shard's index a row's trailing dimensions are left out as long as the
norm of that suffix stays below the threshold (such a rest alone cannot reach it), scores
are accumulated over the index dimension by dimension, and rows are dropped once their
partial score plus the product of the remaining norms is below the threshold; what is left
is scored exactly.  Queries whose windows do not fill come again with lower thresholds.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut_lineage

#: rows of a shard, about; a task holds one shard at a time
SHARD_ROWS = 16384
#: queries joined with a shard at a time
QUERY_BLOCK = 256
#: dimensions accumulated between two prunings
STEP = 16
#: a round of thresholds aims at this many times the rows still wanted, then at SPREAD times more
AIM, SPREAD = 12, 8

PAIRS = "query_id bigint, window_id bigint, id bigint, score bigint"


def usable(vectors: DataFrame, id_col: str, vector_col: str, label: Column, scale: float) -> DataFrame:
    """(id, label, v): one row per id with floor(scale * component), the unusable rows left out."""
    v = F.col(vector_col)
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"), v.alias("v")).where(
        "id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL") \
        .where(~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf"))))
    rows = rows.select("id", F.struct("label", F.transform(
        "v", lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long")).alias("v")).alias("r"))
    return rows.groupBy("id").agg(F.min("r").alias("r")).select("id", "r.label", "r.v")


def _packed(order: list[int], dim: int, kind: str):
    """id, label, and the components in the order of the index as bytes of the least width."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for values in batch.column(2).to_pylist():
                row = np.zeros(dim, np.int64)
                row[:len(values)] = values
                out.append(row[order].astype(kind).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.binary())],
                                             ["id", "label", "v"])
    return run


def build_index(rows: DataFrame, shard_rows: int = SHARD_ROWS) -> tuple[DataFrame, dict]:
    """(index, parameters) of usable rows (id, label, v): index has id, label, v (bytes) and the
    shard of every row; parameters hold the dimensions' order, the first and second moments
    of a score and the number of shards.  Vectors shorter than the longest are filled with zeros."""
    rows = cut_lineage(rows)
    per = {r["i"]: r for r in rows.select(F.posexplode("v").alias("i", "x")).groupBy("i").agg(
        F.sum(F.col("x").cast("double")).alias("s"), F.sum(F.col("x").cast("double") ** 2).alias("q"),
        F.max(F.abs("x")).alias("most")).collect()}                  # one row per dimension
    n = rows.count()
    dim = len(per)
    order = sorted(per, key=lambda i: (-per[i]["q"], i))
    most = max([per[i]["most"] for i in order], default=0)
    kind = "<i2" if most < 1 << 15 else "<i4" if most < 1 << 31 else "<i8"
    shards = max(1, math.ceil(n / shard_rows))
    packed = rows.mapInArrow(_packed(order, dim, kind), "id bigint, label bigint, v binary")
    index = cut_lineage(packed.withColumn("shard", F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int")))
    return index, {"rows": n, "dim": dim, "kind": kind, "shards": shards, "exact": most * most * max(dim, 1) < 1 << 53,
                   "mean": [per[i]["s"] / n for i in order], "square": [per[i]["q"] / n for i in order]}


def _vectors(column: pa.Array, parameters: dict) -> np.ndarray:
    if not parameters["dim"]:
        return np.zeros((len(column), 0), np.int64)
    return np.frombuffer(b"".join(column.to_pylist()), parameters["kind"]).reshape(len(column), parameters["dim"])


def _suffix_norms(x: np.ndarray) -> np.ndarray:
    """Norm of the components from j on, for j = 0 .. dim."""
    tail = np.cumsum((x * x)[:, ::-1], axis=1)[:, ::-1]
    return np.sqrt(np.concatenate([tail, np.zeros((len(x), 1))], axis=1))


class _Shard:
    def __init__(self, ids: np.ndarray, labels: np.ndarray, ints: np.ndarray, exact: bool):
        self.ids, self.labels, self.ints, self.exact = ids, labels, ints, exact
        self.x = ints.astype(np.float64)
        self.norms = _suffix_norms(self.x)

    def inverted(self, least: float):
        """(rows, ends): the rows that can score ``least`` with a query of norm one, longest
        indexed part first, and where each one's indexed part ends.  A list of dimension j
        then holds the first rows, those with an end beyond j."""
        ends = (self.norms[:, :-1] >= least * (1 - 1e-12)).sum(axis=1)       # norms fall with j
        ends = np.minimum(-(-ends // STEP) * STEP, self.x.shape[1])
        rows = np.argsort(-ends, kind="stable")
        return rows[:np.count_nonzero(ends)], ends

    def join(self, q: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query, row) pairs that may score at least ``least`` of the query, none such missing."""
        dim = self.x.shape[1]
        q_norms = _suffix_norms(q)
        unit = np.divide(least, q_norms[:, 0], out=np.full(len(q), -np.inf), where=q_norms[:, 0] > 0)
        if (least <= 0).any() or not dim:                             # nothing can be left out
            rows, ends = np.arange(len(self.ids)), np.full(len(self.ids), dim)
        else:
            rows, ends = self.inverted(unit.min())
        # float sums differ from exact ones by far less than this
        slack = least - 1e-9 * (1 + q_norms[:, 0] * (self.norms[:, 0].max() if len(self.ids) else 0))
        score = np.zeros((len(q), len(rows)))
        for at in range(0, dim, STEP):
            n = np.count_nonzero(ends[rows] > at)                     # the rows listed for these dimensions
            if not n:
                break
            to = min(at + STEP, dim)
            score[:, :n] += q[:, at:to] @ self.x[rows[:n], at:to].T
            stop = np.minimum(ends[rows], to)
            rest = self.norms[rows, stop] * q_norms[:, stop]
            alive = (score + rest >= slack[:, None]).any(axis=0)
            if np.count_nonzero(alive) < len(rows):
                rows, score = rows[alive], score[:, alive]
        stop = ends[rows]
        near = score + self.norms[rows, stop] * q_norms[:, stop] >= slack[:, None]
        query, at = np.nonzero(near)
        return query, rows[at]

    def scores(self, q: np.ndarray, query: np.ndarray, rows: np.ndarray) -> np.ndarray:
        if self.exact:
            return np.einsum("ij,ij->i", q[query].astype(np.float64), self.x[rows]).astype(np.int64)
        found = (q[query].astype(object) * self.ints[rows].astype(object)).sum(axis=1) if len(rows) else []
        if any(abs(s) >= 1 << 63 for s in found):
            raise ValueError("a score does not fit into a long")
        return np.array(found, np.int64)


def _block_pairs(shard: _Shard, q_ids, q_labels, q, windows, same: bool, k: int):
    """The shard's first ``k`` rows of every window of a block of queries."""
    least = np.array([min(w["low"] for w in ws) for ws in windows], np.float64)
    query, rows = shard.join(q.astype(np.float64), least)
    keep = ((q_labels[query] == shard.labels[rows]) == same) & (q_ids[query] != shard.ids[rows])
    query, rows = query[keep], rows[keep]
    score = shard.scores(q, query, rows)
    order = np.lexsort((shard.ids[rows], -score, query))
    query, names, score = query[order], shard.ids[rows[order]], score[order]
    starts = np.searchsorted(query, np.arange(len(q_ids) + 1))
    for i, ws in enumerate(windows):
        own_names, own = names[starts[i]:starts[i + 1]], score[starts[i]:starts[i + 1]]     # best first
        for w in ws:
            a = np.searchsorted(-own, -w["high"], "left")
            b = min(np.searchsorted(-own, -w["low"], "right"), a + k)
            for name, s in zip(own_names[a:b].tolist(), own[a:b].tolist()):
                yield int(q_ids[i]), w["window_id"], name, s


def _join_shards(parameters: dict, same: bool, k: int):
    """Batches come sorted: a shard's rows (role 0), then the queries that meet it (role 1)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, shard, at = [], None, None
        for batch in batches:
            number, role = np.array(batch.column(0)), np.array(batch.column(1))
            edges = np.flatnonzero((np.diff(number) != 0) | (np.diff(role) != 0)) + 1
            for a, b in zip([0, *edges], [*edges, batch.num_rows]):
                piece = batch.slice(a, b - a)
                if not piece.num_rows:
                    continue
                if number[a] != at:
                    parts, shard, at = [], None, number[a]
                ids, labels, v = (piece.column(i) for i in (2, 3, 4))
                if role[a] == 0:
                    parts.append((np.array(ids), np.array(labels), _vectors(v, parameters)))
                    continue
                if not parts:
                    continue                                          # a shard without rows
                if shard is None:
                    shard = _Shard(*(np.concatenate(c) for c in zip(*parts)), parameters["exact"])
                q, windows = _vectors(v, parameters), piece.column(5).to_pylist()
                for i in range(0, len(q), QUERY_BLOCK):
                    block = slice(i, i + QUERY_BLOCK)
                    rows = list(_block_pairs(shard, np.array(ids)[block], np.array(labels)[block], q[block],
                                             windows[block], same, k))
                    if rows:
                        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)],
                                                         ["query_id", "window_id", "id", "score"])
    return run


def threshold_join(index: DataFrame, parameters: dict, queries: DataFrame, windows: DataFrame, same: bool,
                   k: int) -> DataFrame:
    """(query_id, window_id, id, score, rank): the first ``k`` rows of each window, that is
    other rows of the index with an equal (``same``) or another label and
    low <= score <= high, higher scores first, ties to the smaller id.

    ``queries`` (id, label, v as in the index) are a stated set, ``windows`` (query_id,
    window_id, low, high) what they seek.  Every query goes to every shard; rows do not.
    """
    asked = windows.groupBy("query_id").agg(F.collect_list(F.struct("window_id", "low", "high")).alias("windows"))
    asked = queries.join(asked, F.col("id") == F.col("query_id")).select(
        F.explode(F.sequence(F.lit(0), F.lit(parameters["shards"] - 1))).alias("shard"), F.lit(1).alias("role"),
        "id", "label", "v", "windows")
    both = index.select("shard", F.lit(0).alias("role"), "id", "label", "v",
                        F.lit(None).cast(asked.schema["windows"].dataType).alias("windows")).unionByName(asked)
    found = both.repartition("shard").sortWithinPartitions("shard", "role") \
        .mapInArrow(_join_shards(parameters, same, k), PAIRS)
    best = Window.partitionBy("query_id", "window_id").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def _expected(parameters: dict, queries: DataFrame) -> DataFrame:
    """(query_id, mean, deviation) of the scores of a query, were the dimensions independent.
    Only the first thresholds depend on it, never a result."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mean, square = np.array(parameters["mean"]), np.array(parameters["square"])
        for batch in batches:
            q = _vectors(batch.column(1), parameters).astype(np.float64)
            spread = np.sqrt(np.maximum((q * q) @ (square - mean * mean), 0)) + 1
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(q @ mean), pa.array(spread)],
                                             ["query_id", "mean", "deviation"])
    return queries.select("id", "v").mapInArrow(run, "query_id bigint, mean double, deviation double")


def _tail(z: Column) -> Column:
    """About the share of a normal distribution above ``z`` (in deviations)."""
    up = F.greatest(z, F.lit(0.0))
    return 0.5 * F.exp(-0.717 * up - 0.416 * up * up)


def _above(share: Column) -> Column:
    """The inverse of ``_tail``."""
    depth = F.greatest(-F.log(F.least(2 * share, F.lit(1.0))), F.lit(0.0))
    return (F.sqrt(0.514 + 1.664 * depth) - 0.717) / 0.832


def fill_windows(index: DataFrame, parameters: dict, queries: DataFrame, windows: DataFrame, same: bool,
                 k: int) -> DataFrame:
    """``threshold_join`` with thresholds that fall, round by round, until every window
    (query_id, window_id, floor, high, pool) holds ``k`` rows or its threshold is its floor.

    A window that holds ``k`` rows above a threshold holds its first ``k`` rows, so its result
    is final.  ``pool``, the rows of a fitting label, only guides the thresholds.  Only whether
    windows are open reaches the driver.
    """
    open_ = cut_lineage(windows.join(cut_lineage(_expected(parameters, queries)), "query_id"))
    done, aim = None, AIM * k
    while True:
        wanted = F.lit(float(aim)) / F.greatest(F.col("pool"), F.lit(1))
        share = F.least(_tail((F.col("high") - F.col("mean")) / F.col("deviation")) + wanted, F.lit(1.0))
        guess = F.floor(F.col("mean") + F.col("deviation") * _above(share))
        low = F.when(share < 0.5, F.least(guess, F.col("high")))
        asked = cut_lineage(open_.withColumn("low", F.greatest(F.col("floor"), F.coalesce(low, F.col("floor")))))
        found = cut_lineage(threshold_join(index, parameters, queries, asked, same, k))
        full = found.groupBy("query_id", "window_id").agg(F.count(F.lit(1)).alias("n"))
        state = cut_lineage(asked.join(full, ["query_id", "window_id"], "left").withColumn(
            "ended", (F.coalesce("n", F.lit(0)) >= k) | (F.col("low") <= F.col("floor"))))
        final = found.join(state.where("ended").select("query_id", "window_id"), ["query_id", "window_id"], "left_semi")
        done = final if done is None else done.unionByName(final)
        open_ = state.where("NOT ended").drop("low", "n", "ended")
        if open_.isEmpty():
            return done
        aim *= SPREAD


def _percent(score: Column, percent: int, rounding: int) -> Column:
    """``percent`` of a score from zero on, down (0) or up (99) to a whole number, without overflow."""
    # a decimal quotient is exact where a double would round beyond 2^53
    whole, rest = ((score - score % 100).cast("decimal(20,0)") / 100).cast("long"), score % 100
    return whole * percent + F.floor((rest * percent + rounding) / 100).cast("long")


def mine(vectors: DataFrame, is_query: Column | None = None, label: Column | None = None, id_col: str = "vec_id",
         vector_col: str = "embedding", scale: float = 256, positives: int = 5, negatives: int = 10,
         low_percent: int = 30, high_percent: int = 90, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    An anchor's positives are its first ``positives`` other rows of its label, its negatives
    for a positive the first ``negatives`` rows of another label that score between
    ``low_percent`` and ``high_percent`` of the positive's score.  ``is_query`` (default
    ``id % 100 = 0``) is a condition on ``id``, ``label`` an expression over the input.

    Defined results: rows with a null id, label or vector or a null or non-finite component
    take no part; rows that repeat an id count once, the one of the smallest label, then
    vector; missing trailing components are zeros; ties go to the smaller id; positives
    that score below zero have no negatives, as their window is empty; zero vectors score
    zero with all; an empty table gives an empty result; a score beyond a long raises.
    Other columns are not read.
    """
    rows = usable(vectors, id_col, vector_col, F.col("label") if label is None else label, scale)
    index, parameters = build_index(rows, shard_rows)
    chosen = F.col("id") % 100 == 0 if is_query is None else is_query
    queries = cut_lineage(index.where(chosen).select("id", "label", "v"))
    sizes = index.groupBy(F.col("label").alias("_label")).agg(F.count(F.lit(1)).alias("alike"))
    pools = cut_lineage(queries.join(sizes, F.col("label") == F.col("_label")).select(F.col("id").alias("query_id"), "alike"))
    limit = (1 << 63) - 1
    same = fill_windows(index, parameters, queries, pools.select(
        "query_id", F.lit(0).cast("long").alias("window_id"), F.lit(0).cast("long").alias("floor"),
        F.lit(limit).alias("high"), F.col("alike").alias("pool")), True, positives)
    pairs = cut_lineage(same.select("query_id", F.col("id").alias("window_id"), F.col("score").alias("positive_score")))
    windows = pairs.join(pools, "query_id").select(
        "query_id", "window_id", _percent(F.col("positive_score"), low_percent, 99).alias("floor"),
        _percent(F.col("positive_score"), high_percent, 0).alias("high"), (F.lit(parameters["rows"]) - F.col("alike")).alias("pool"))
    found = fill_windows(index, parameters, queries, windows, False, negatives)
    return found.join(pairs, ["query_id", "window_id"]).select(
        F.col("query_id").alias("anchor_id"), F.col("window_id").alias("positive_id"), "rank",
        F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
