"""SimHash near-duplicate detection over a byte-position inverted index.

A fingerprint has eight bytes.  Two fingerprints that differ in at most d bits agree in at
least 8 - d positional bytes (the guaranteed minimum), so they meet under at least one
combination of 8 - d byte positions.  The inverted index lists, for every such combination
and its bytes, the fingerprints holding them.  Pairs that meet are tallied: the number of
shared combinations tells the number of shared positional bytes; pairs reaching the minimum
are kept and verified bit by bit.  Postings of single bytes would list N/256 fingerprints
each, which no cluster can pair up; postings of 8 - d bytes are almost free of strangers.

Copies cost nothing: equal fingerprints are collapsed before the index is built, so a group
of a third of all rows is one entry.  Pairs are verified links between different
fingerprints, each of which can have at most 2,080 partners at d = 2, whatever the input.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut_lineage
from .components import components

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def simhash64(text: bytes | None, shingle: int = 3) -> int:
    """64-bit SimHash of a text: A-Z lower-cased, words split at ASCII white space, shingles
    of ``shingle`` words hashed by XXH64 (seed 42); a bit is set if over half the hashes set it.
    Fewer words than a shingle hash as one sequence; a text without words gives 0."""
    words = (text or b"").translate(_LOWER).split()
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), 42)
    hashes = np.fromiter((xxhash.xxh64_intdigest(b" ".join(s), 42)
                          for s in zip(*[words[i:] for i in range(shingle)])), np.uint64,
                         len(words) - shingle + 1)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65536):
        block = hashes[at:at + 65536]
        bits = np.unpackbits(block.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.uint32)
    return int.from_bytes(np.packbits(2 * ones > len(hashes), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """One row per input row: id, ``text_hash`` (64 bits, tells rows of one id apart) and
    ``fp`` (the fingerprint as a signed long).  Null texts count as empty."""
    source = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("text_hash"),
                         F.col(text_col).cast("binary").alias("text"))
    schema = T.StructType([source.schema["id"], T.StructField("text_hash", T.LongType()),
                           T.StructField("fp", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.fromiter((simhash64(t.as_py(), shingle) for t in batch.column(2)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fps.view(np.int64))],
                                             ["id", "text_hash", "fp"])

    return source.mapInArrow(run, schema)


def _masks(keep: int) -> list[int]:
    masks = [sum(0xFF << 8 * p for p in positions) for positions in combinations(range(8), keep)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def links(fps: DataFrame, max_distance: int = 2) -> DataFrame:
    """Pairs (a < b) of different fingerprints that differ in at most ``max_distance`` bits."""
    if not 0 < max_distance < 8:
        raise ValueError("max_distance must be 1 to 7")
    least = 8 - max_distance                                     # the guaranteed minimum of shared bytes
    postings = fps.select("fp", F.posexplode(F.array(
        *[F.col("fp").bitwiseAND(F.lit(m)) for m in _masks(least)])).alias("combo", "bytes"))
    a = postings.select(F.col("fp").alias("a"), "combo", "bytes")
    b = postings.select(F.col("fp").alias("b"), "combo", "bytes")
    tally = a.join(b, ["combo", "bytes"]).where("a < b").groupBy("a", "b").agg(F.count(F.lit(1)).alias("met"))
    # m shared bytes meet under comb(m, least) combinations
    shared = F.lit(0)
    for m in range(least, 9):
        shared = F.when(F.col("met") >= comb(m, least), m).otherwise(shared)
    return tally.where(shared >= least).where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_distance) \
        .select("a", "b")


def groups(fps: DataFrame, max_distance: int = 2) -> DataFrame:
    """One row per different fingerprint: ``fp``, ``root`` (names its group) and the group's
    smallest id and text hash (``component_id``, ``keep_hash``)."""
    distinct = fps.groupBy("fp").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "text_hash")).alias("least"))
    distinct = cut_lineage(distinct)
    roots = cut_lineage(components(links(distinct, max_distance)))
    rooted = distinct.join(roots, distinct["fp"] == roots["node"], "left") \
        .select("fp", F.coalesce("root", "fp").alias("root"), "least")
    best = rooted.groupBy("root").agg(F.min("least").alias("least"))
    return rooted.select("fp", "root").join(best, "root") \
        .select("fp", "root", F.col("least.id").alias("component_id"), F.col("least.text_hash").alias("keep_hash"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                    max_distance: int = 2) -> DataFrame:
    """Per input row: id, ``text_hash``, ``fp``, ``root`` and ``component_id`` (smallest id
    reachable over links, itself included).

    Texts without words have fingerprint 0 and are linked like any other.  Null ids take
    part but never name a component unless it has no other id.  Repeated rows stay repeated;
    an empty table gives an empty result; other columns are not read.
    """
    fps = cut_lineage(fingerprints(docs, id_col, text_col, shingle))
    return fps.join(groups(fps, max_distance), "fp") \
        .select(F.col("id").alias(id_col), "text_hash", "fp", "root", "component_id")


def fingerprint_hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                     max_distance: int = 2) -> DataFrame:
    """``docs`` with one row of each near-duplicate group: the smallest id (nulls last), then
    the smallest text hash, then any one of equal rows.  All columns are kept."""
    fps = cut_lineage(fingerprints(docs, id_col, text_col, shingle))
    chosen = groups(fps, max_distance).select(F.col("component_id").alias("_id"), F.col("keep_hash").alias("_hash")) \
        .distinct()
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col(id_col).alias("_id"),
                      F.xxhash64(F.col(text_col)).alias("_hash"))
    kept = row.join(chosen.select(F.col("_id").alias("_cid"), F.col("_hash").alias("_chash")),
                    F.col("_id").eqNullSafe(F.col("_cid")) & (F.col("_hash") == F.col("_chash")), "left_semi")
    return kept.dropDuplicates(["_id", "_hash"]).select("_row.*")
