"""Quality classifier on random-indexing word vectors.

Random indexing: every word (hashed to one of ``BUCKETS``) has a fixed sparse random index
vector; its word vector is the sum of the index vectors of its neighbours over the whole
corpus, so words used alike get alike vectors.  A second, small space does the same for word
shapes.  A document pools the vectors of all its words (weighted down for frequent words) and
of its neighbouring pairs.  A two-layer network in numpy is trained on a bounded sample of
labelled documents; a temperature fitted on labelled documents kept out of training turns its
output into calibrated probabilities.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import target_partitions
from .common import cut_lineage

BUCKETS = 1 << 14
DIM = 32
NONZERO = 4
SLABS = 64
SEED = 11
#: labelled documents used to train and to calibrate, at most (smallest hashes of the id)
TRAIN_ROWS, CALIBRATE_ROWS = 20_000, 5_000
HIDDEN, EPOCHS, BATCH, RATE = 32, 30, 256, 0.01
#: words whose bucket a task remembers
MAX_KNOWN = 300_000

_MASK = BUCKETS - 1
_CLASSES = ((re.compile(r"[^\W\d_]+"), None), (re.compile(r"\d+"), "9"))


def shape(word: str) -> str:
    """Shape of a word: letters as their case, digits as 9, other characters as they are,
    with the number of letters up to 12."""
    letters = _CLASSES[0][0].sub(lambda m: ("A" if m[0].isupper() and len(m[0]) > 1 else "Aa" if m[0][0].isupper() else "a")
                                 + str(min(len(m[0]), 12)), word)
    return _CLASSES[1][0].sub("9", letters)[:24]


def _hash(word: str) -> int:
    h = zlib.crc32(word.encode())
    return (h ^ h >> 15) & _MASK


class _Known(dict):
    """Bucket and shape bucket of words, packed into one number, made when first asked for."""

    def __missing__(self, word: str) -> int:
        code = self[word] = _hash(word) * BUCKETS + _hash("\x00" + shape(word))
        return code


class Space:
    """Index vectors, and word numbers of texts."""

    def __init__(self, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.at = rng.integers(0, DIM, (BUCKETS, NONZERO)).astype(np.int64)
        self.sign = rng.choice([-1.0, 1.0], (BUCKETS, NONZERO))
        self.index = np.zeros((BUCKETS, DIM), np.float32)
        for k in range(NONZERO):
            np.add.at(self.index, (np.arange(BUCKETS), self.at[:, k]), self.sign[:, k])
        self.known = _Known()

    def numbers(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Bucket and shape bucket of every word of a text."""
        known = self.known
        if len(known) > MAX_KNOWN:
            known.clear()
        words = (text or "").split()
        codes = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
        return codes // BUCKETS, codes % BUCKETS

    def add_neighbours(self, sums: np.ndarray, words: np.ndarray) -> None:
        """Add to each word's row the index vectors of the words before and after it."""
        flat = sums.reshape(-1)
        for own, near in ((words[1:], words[:-1]), (words[:-1], words[1:])):
            for k in range(NONZERO):
                flat += np.bincount(own * DIM + self.at[near, k], weights=self.sign[near, k], minlength=len(flat))


def corpus_vectors(docs: DataFrame, text_col: str = "text", seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """Word vectors (BUCKETS x DIM) and word counts (BUCKETS) over all documents.  Every task
    sends one partial sum per slab of buckets; sums meet slab by slab; what reaches the
    driver has a fixed size."""
    per_slab = BUCKETS // SLABS
    source = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space = Space(seed)
        sums, counts, pending, held = np.zeros((BUCKETS, DIM)), np.zeros(BUCKETS), [], 0
        for batch in batches:
            for text in batch.column(0):
                words, _ = space.numbers(text.as_py())
                counts += 0 if not len(words) else np.bincount(words, minlength=BUCKETS)
                if len(words) > 1:
                    pending.append(words)
                    held += len(words)
                if held > 1_000_000:
                    _flush(space, sums, pending)
                    pending, held = [], 0
        _flush(space, sums, pending)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(SLABS), pa.int32()),
             pa.array([np.concatenate((sums[s * per_slab:(s + 1) * per_slab].ravel(), counts[s * per_slab:(s + 1) * per_slab]))
                       .astype(np.float32).tobytes() for s in range(SLABS)], pa.binary())], ["slab", "sums"])

    def _flush(space, sums, pending):
        # documents side by side, with the pairs across their borders taken out again
        if pending:
            words = np.concatenate(pending)
            space.add_neighbours(sums, words)
            ends = np.cumsum([len(w) for w in pending])[:-1]
            for a, b in ((ends - 1, ends), (ends, ends - 1)):
                np.subtract.at(sums, words[a], space.index[words[b]])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for slab, sums in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                part = np.frombuffer(sums, np.float32).astype(np.float64)
                total[slab] = total[slab] + part if slab in total else part
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([x.tobytes() for x in total.values()], pa.binary())],
                                         ["slab", "sums"])
    parts = source.mapInArrow(gather, "slab int, sums binary")
    sums = parts.repartition(min(SLABS, target_partitions(docs.sparkSession)), "slab").mapInArrow(add, "slab int, sums binary")
    vectors, counts = np.zeros((BUCKETS, DIM)), np.zeros(BUCKETS)
    for row in sums.collect():                                   # SLABS rows of a fixed size
        x = np.frombuffer(row["sums"], np.float64)
        at = slice(row["slab"] * per_slab, (row["slab"] + 1) * per_slab)
        vectors[at] += x[:per_slab * DIM].reshape(per_slab, DIM)
        counts[at] += x[per_slab * DIM:]
    length = np.linalg.norm(vectors, axis=1, keepdims=True)
    return np.divide(vectors, length, out=np.zeros_like(vectors), where=length > 0).astype(np.float32), counts


def pool(space: Space, vectors: np.ndarray, weight: np.ndarray, text: str | None) -> np.ndarray:
    """Document vector: pooled word vectors, index vectors, shape vectors and pair products."""
    words, shapes = space.numbers(text)
    n = len(words)
    if not n:
        return np.zeros(4 * DIM + 4, np.float32)
    w = weight[words]
    share = w / w.sum()
    times = np.bincount(words, weights=share, minlength=0)
    own = np.flatnonzero(times)
    kinds = np.bincount(shapes)
    used = np.flatnonzero(kinds)
    looks = kinds[used].astype(np.float32) / n
    index = space.index[own]
    mean = times[own].astype(np.float32) @ index
    pairs = np.zeros(DIM, np.float32)
    if n > 1:
        code, many = np.unique(words[:-1] * BUCKETS + words[1:], return_counts=True)
        # a pair found k times counts k^2: repetition stands out
        strength = (many.astype(np.float32) ** 2 - many) / (n - 1)
        again = strength > 0
        pairs = strength[again] @ np.abs(space.index[code[again] // BUCKETS]) if again.any() else pairs
    return np.concatenate((times[own].astype(np.float32) @ vectors[own], mean, looks @ space.index[used], np.log1p(pairs),
                           [np.log1p(n) / 5, np.linalg.norm(mean), len(own) / n, float(looks @ looks)])).astype(np.float32)


def features(docs: DataFrame, vectors: np.ndarray, counts: np.ndarray, id_col: str = "doc_id", text_col: str = "text",
             seed: int = SEED) -> DataFrame:
    """Per input row: ``id`` and ``vector`` (packed 32-bit floats) of its whole text."""
    source = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rate = counts / max(counts.sum(), 1)
    weight = 1e-3 / (1e-3 + rate)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space = Space(seed)
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([pool(space, vectors, weight, t.as_py()).tobytes() for t in batch.column(1)], pa.binary())],
                ["id", "vector"])
    schema = T.StructType([source.schema["id"], T.StructField("vector", T.BinaryType())])
    return source.mapInArrow(run, schema)


class Network:
    """Two layers, tanh between, one logit; inputs standardised; Adam on the log loss."""

    def __init__(self, x: np.ndarray, y: np.ndarray, seed: int = SEED, hidden: int = HIDDEN, epochs: int = EPOCHS):
        rng = np.random.default_rng(seed)
        self.mean, self.scale = x.mean(0), x.std(0) + 1e-3
        x = self._scaled(x)
        sizes = (x.shape[1], hidden), (hidden,), (hidden, 1), (1,)
        self.p = [rng.standard_normal(s) / np.sqrt(s[0]) if len(s) == 2 else np.zeros(s) for s in sizes]
        m, v, step = [np.zeros(s) for s in sizes], [np.zeros(s) for s in sizes], 0
        for epoch in range(epochs):
            rate = RATE * 0.5 * (1 + np.cos(np.pi * epoch / epochs))
            for at in np.array_split(rng.permutation(len(x)), max(1, len(x) // BATCH)):
                step += 1
                a, b = x[at], y[at][:, None]
                h = np.tanh(a @ self.p[0] + self.p[1])
                d = (1 / (1 + np.exp(-(h @ self.p[2] + self.p[3]))) - b) / len(at)
                dh = d @ self.p[2].T * (1 - h * h)
                grads = a.T @ dh + 1e-4 * self.p[0], dh.sum(0), h.T @ d + 1e-4 * self.p[2], d.sum(0)
                for i, g in enumerate(grads):
                    m[i] = 0.9 * m[i] + 0.1 * g
                    v[i] = 0.999 * v[i] + 0.001 * g * g
                    self.p[i] = self.p[i] - rate * (m[i] / (1 - 0.9 ** step)) / (np.sqrt(v[i] / (1 - 0.999 ** step)) + 1e-8)
        self.temperature = 1.0

    def _scaled(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -8, 8)

    def logit(self, x: np.ndarray) -> np.ndarray:
        return (np.tanh(self._scaled(x) @ self.p[0] + self.p[1]) @ self.p[2] + self.p[3])[:, 0]

    def calibrate(self, x: np.ndarray, y: np.ndarray) -> None:
        """Temperature with the least log loss on documents not trained on."""
        z = self.logit(x)
        grid = np.exp(np.linspace(np.log(0.25), np.log(8), 121))
        loss = [np.mean(np.logaddexp(0, -np.where(y > 0, z, -z) / t)) for t in grid]
        self.temperature = float(grid[int(np.argmin(loss))])

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(x) / self.temperature, -40, 40)))


def fold_of(id_column: Column) -> Column:
    """crc32 of the id as text, modulo 5 (null ids count as empty)."""
    return F.crc32(F.coalesce(id_column.cast("string"), F.lit("")).cast("binary")) % 5


def _sample(rows: DataFrame, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``limit`` rows of the smallest hashes of the id.  A bound on the hash is found by
    counting first, so that the tasks do not send ``limit`` rows each."""
    total, share = rows.count(), 1.0
    if total > limit:
        share = 1.1 * limit / total
        below = lambda s: rows.where(F.xxhash64("id") < F.lit(-(1 << 63) + int(s * (1 << 64))))
        while share < 1 and below(share).count() < limit:
            share *= 2
        rows = below(share) if share < 1 else rows
    got = rows.orderBy(F.xxhash64("id"), "id", "vector").limit(limit).select("vector", "label").collect()
    x = np.array([np.frombuffer(r["vector"], np.float32) for r in got], np.float64).reshape(len(got), 4 * DIM + 4)
    return x, np.array([r["label"] for r in got], np.float64)


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
          train_rows: int = TRAIN_ROWS, calibrate_rows: int = CALIBRATE_ROWS, threshold: float = 0.3,
          seed: int = SEED) -> DataFrame:
    """Per input row: id, ``held_out`` (fold 0), ``score`` (chance of label 1) and ``predicted``.

    Only labels of folds 1 to 4 are read; folds 2 to 4 train, fold 1 sets the temperature.
    Null labels are no labels; conflicting labels of one id count as their maximum.  Null and
    empty texts are scored like any other.  Without labels of both classes the score is the
    share of label 1 (0.5 without any).  Repeated rows stay; an empty table gives an empty
    result; other columns are not read.
    """
    vectors, counts = corpus_vectors(docs, text_col, seed)
    vectored = cut_lineage(features(docs, vectors, counts, id_col, text_col, seed))
    known = labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("double").alias("label")) \
        .where("label IS NOT NULL").groupBy("_id").agg(F.max("label").alias("label"))
    labelled = vectored.join(known, F.col("id") == F.col("_id")).where(fold_of(F.col("id")) != 0)
    x, y = _sample(labelled.where(fold_of(F.col("id")) != 1), train_rows)
    cx, cy = _sample(labelled.where(fold_of(F.col("id")) == 1), calibrate_rows)
    network = None
    if len(set(y.tolist())) > 1:
        network = Network(x, y, seed)
        if len(cy):
            network.calibrate(cx, cy)
    flat = float(y.mean()) if len(y) else 0.5
    schema = T.StructType([vectored.schema["id"], T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.float32).reshape(batch.num_rows, -1)
            p = network.probability(x) if network is not None else np.full(batch.num_rows, flat)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p, pa.float64())], ["id", "score"])
    return vectored.mapInArrow(run, schema).select(
        F.col("id").alias(id_col), (fold_of(F.col("id")) == 0).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))
