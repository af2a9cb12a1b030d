"""Nearest neighbours over randomly rotated one-bit codes.

Indexing: vectors are centred on the mean of all rows, scaled to unit length, rotated by a
random orthogonal matrix (from a seed) and reduced to the sign of each component, packed to
bits.  With a vector go two scalars: its distance to the centre and the inner product of its
unit vector with its own code.  Searching: the inner product of a query with a vector is
estimated from the packed bits and the scalars; the estimate's error bound tells which
vectors can still be among the nearest, and only those are reranked on the original values
in double precision.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SEED = 7
#: error bounds hold for a vector with a chance of about 1 - 2 exp(-EPSILON^2 / 2)
EPSILON = 4.0
#: queries handed to the tasks at a time (at most this many, whatever their number)
QUERY_BLOCK = 4096
#: code rows compared at a time
CODE_BLOCK = 8192


def rotation(dim: int, seed: int = SEED) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def _usable(vector: str, dim: int | None = None):
    v = F.col(vector)
    ok = v.isNotNull() & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) \
        & F.exists(v, lambda x: x != 0)
    return ok if dim is None else ok & (F.size(v) == dim)


def build_index(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", seed: int = SEED):
    """(index, parameters): index has vec_id, vector (double), code (packed bits), radius and
    cosine of every usable row; parameters are the centre, rotation seed and dimension.

    Vectors null, zero, or holding a null or non-finite component are left out.  All others
    must have one dimension.  Repeated ids and repeated vectors stay; an empty table gives an
    empty index.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"),
                          F.transform(F.col(vector_col), lambda x: x.cast("double")).alias("vector")) \
        .where(_usable("vector"))
    stats = rows.select(F.posexplode("vector").alias("i", "x")).groupBy("i").agg(F.avg("x").alias("m"), F.count("x").alias("n")) \
        .orderBy("i").collect()                                  # one row per dimension
    if len({r["n"] for r in stats}) > 1:
        raise ValueError("vectors of different dimensions")
    centre = np.array([r["m"] for r in stats])
    dim = len(centre)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = rotation(dim, seed) if dim else None
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.array(batch.column(1).values).reshape(-1, dim)[batch.column(1).offset:][:batch.num_rows]
            rest = x - centre
            radius = np.linalg.norm(rest, axis=1)
            unit = (rest / np.where(radius > 0, radius, 1)[:, None]) @ turn
            code = np.packbits(unit > 0, axis=1)
            cosine = np.abs(unit).sum(axis=1) / np.sqrt(dim)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([c.tobytes() for c in code], pa.binary()),
                 pa.array(radius), pa.array(cosine)], ["vec_id", "vector", "code", "radius", "cosine"])

    index = rows.mapInArrow(run, "vec_id bigint, vector array<double>, code binary, radius double, cosine double")
    return index, {"centre": centre, "dim": dim, "seed": seed}


def _nearest(queries: list[tuple[int, list[float]]], parameters: dict, k: int, epsilon: float):
    ids = np.array([q for q, _ in queries], np.int64)
    vectors = np.array([v for _, v in queries], np.float64).reshape(len(queries), -1)
    dim = parameters["dim"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = vectors - parameters["centre"]
        radius = np.linalg.norm(rest, axis=1)
        unit = (rest / np.where(radius > 0, radius, 1)[:, None]) @ rotation(dim, parameters["seed"])
        best_id = np.full((len(ids), k), np.iinfo(np.int64).max)
        best = np.full((len(ids), k), np.inf)
        for batch in batches:
            for at in range(0, batch.num_rows, CODE_BLOCK):
                block = batch.slice(at, CODE_BLOCK)
                own = np.array(block.column(0))
                lists = block.column(1)
                x = np.array(lists.flatten()).reshape(-1, dim)
                packed = np.frombuffer(b"".join(block.column(2).to_pylist()), np.uint8).reshape(len(own), -1)
                signs = np.unpackbits(packed, axis=1, count=dim).astype(np.float32) * 2 - 1
                r, cosine = np.array(block.column(3)), np.array(block.column(4))
                safe = np.where(cosine > 0, cosine, 1)
                estimate = (unit.astype(np.float32) @ signs.T) / np.sqrt(dim) / safe
                slack = np.where(cosine > 0, np.sqrt(np.maximum(1 - safe ** 2, 0)) / safe, 1) * epsilon / np.sqrt(max(dim - 1, 1)) + 1e-5
                spread = 2 * radius[:, None] * r
                square = radius[:, None] ** 2 + r ** 2
                least = square - spread * np.minimum(estimate + slack, 1)
                most = square - spread * np.maximum(estimate - slack, -1)
                for q in range(len(ids)):
                    other = own != ids[q]
                    bound = best[q, -1] ** 2
                    if other.sum() >= k:
                        bound = min(bound, np.partition(most[q][other], k - 1)[k - 1])
                    near = np.flatnonzero(other & (least[q] <= bound * (1 + 1e-9) + 1e-9))
                    if not len(near):
                        continue
                    gap = x[near] - vectors[q]
                    # sums run over the components in order
                    exact = np.sqrt(np.add.accumulate(gap * gap, axis=1)[:, -1])
                    names, far = np.append(best_id[q], own[near]), np.append(best[q], exact)
                    order = np.lexsort((names, far))[:k]
                    best_id[q], best[q] = names[order], far[order]
        q, slot = np.nonzero(np.isfinite(best))
        yield pa.RecordBatch.from_arrays([pa.array(ids[q]), pa.array(best_id[q, slot]), pa.array(best[q, slot])],
                                         ["query_id", "vec_id", "score"])
    return run


def search(index: DataFrame, parameters: dict, queries: DataFrame, k: int = 10, epsilon: float = EPSILON,
           query_block: int = QUERY_BLOCK) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the ``k`` nearest rows of the index other than
    the query's own id, nearest first, ties to the smaller id (all of them if there are fewer).

    ``queries`` has vec_id and vector; of rows that repeat an id the smallest vector counts, so
    that every query has one list.  They are a stated set: blocks of at most
    ``query_block`` of them are handed to the tasks, and every index row is compared with
    every block.  A task returns its k best per query; equal (id, distance) rows that repeat
    in the index count as one candidate each.  No queries or no rows give an empty result.
    """
    spark = index.sparkSession
    names = queries.groupBy("vec_id").agg(F.min("vector").alias("vector")).orderBy("vec_id")
    parts, block = [], []
    for row in names.toLocalIterator():
        block.append((row["vec_id"], row["vector"]))
        if len(block) == query_block:
            parts.append(index.mapInArrow(_nearest(block, parameters, k, epsilon), "query_id bigint, vec_id bigint, score double"))
            block = []
    if block:
        parts.append(index.mapInArrow(_nearest(block, parameters, k, epsilon), "query_id bigint, vec_id bigint, score double"))
    if not parts:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")
