"""SentencePiece encoding as a relational lattice, and decoding.

Encoding.  Documents are read in blocks; a block lists its distinct units (words with the
spaces before them, cut further where no piece can span).  Units of all blocks are made
distinct, and each is encoded once:

* every substring up to the longest piece's length is exploded with its place,
* an equi-join with the piece table keeps the substrings that are pieces: the lattice's edges,
* edges are grouped by unit,
* a higher-order aggregate folds them.  For a unigram model the fold is Viterbi: the best
  score of every prefix, then the path back.  For a BPE model the sum of scores does not give
  the model's segmentation, so the fold joins the best-scored edge that bridges two
  neighbouring symbols, leftmost first, until there is none.  Edges come in the order of score
  and place; unless a piece of the unit is merged from worse-scored ones, one walk does it.

A unit carries its places (block and number) along; its ids go back to them packed, one row
per block and task, and the documents are put together there.  Characters without a piece
become byte pieces.

A document's words never travel one by one: a block's documents are word numbers, packed,
and its units are rows.  Both passes over the documents must see the same blocks, so the
input has to be a stored table (or checkpointed); a block whose halves differ is an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import target_partitions
from .pieces import Pieces, bigram_codes, cut_array, plain, pre_tokens, spaces_inside, unordered
from .token_counts import PrefixCounter

#: UTF-8 bytes of text in a block
BLOCK_BYTES = 8 << 20
#: words of a block that are cut into units at a time
WORDS_CUT = 20_000
#: places of units whose ids are packed at a time
PLACES_PACKED = 100_000
#: units in an outgoing batch
UNITS_OUT = 20_000
#: documents in an outgoing batch
DOCUMENTS_OUT = 256
#: the folds grow with the square of a unit's length (and more); longer units, hardly ever met,
#: are encoded by the linear forward pass of ``token_counts``, which gives the same ids
LONG_UNIT = 64
_WIDE = 1 << 24                                      # key of an edge: start * _WIDE + end


class _Blocks:
    """Splits a task's documents into blocks; both passes use it, so they number alike."""

    def __init__(self, pieces: Pieces):
        self.bigrams, self.seq = bigram_codes(pieces), 0
        self.base = TaskContext.get().partitionId() << 24
        self.clear()

    def clear(self):
        self.ids, self.texts, self.held = [], [], 0

    def add(self, doc_id, text: str):
        self.ids.append(doc_id)
        # split at spaces, this gives the text's words; null has none
        self.texts.append(None if not text else text if plain(text) else " ".join(pre_tokens(text)))
        self.held += len(text) + 16

    def close(self):
        """(block, distinct units in order, units of all words, units per word); ``codes`` are the
        words of the documents, numbered as they come, and ``sizes`` their counts"""
        block, self.seq = self.base | self.seq, self.seq + 1
        texts, self.texts = pa.array(self.texts, pa.string()), []
        split = pc.split_pattern(texts, " ")
        self.sizes = pc.fill_null(pc.list_value_length(split), 0).to_pylist()
        words = pc.list_flatten(split)
        del texts, split                                 # a block's copies are the task's memory
        words = words.dictionary_encode()
        self.codes, words = words.indices.to_numpy(), words.dictionary
        cut = [cut_array(words.slice(at, WORDS_CUT), self.bigrams) for at in range(0, len(words), WORDS_CUT)]
        units = pa.concat_arrays([flat for flat, _ in cut] or [words]).dictionary_encode()
        return block, units.dictionary, units.indices.to_numpy(), np.concatenate([n for _, n in cut] or [self.codes])

    def run(self, batches: Iterator[pa.RecordBatch], emit):
        for batch in batches:
            doc_id = text = None
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                self.add(doc_id, text.as_py())
                if self.held >= BLOCK_BYTES:
                    yield from emit(*self.close())
                    self.clear()
                    pa.default_memory_pool().release_unused()
            del batch, doc_id, text                      # or they stay while the next batch is read
        if self.ids:
            yield from emit(*self.close())


def edges(distinct_units: DataFrame, piece_table: DataFrame, longest: int, edge: Column) -> DataFrame:
    """The units' rows with ``found``, the list of ``edge`` (of s, the start, size and the piece's
    columns) over all substrings of the unit that are pieces, and ``odd``: is one of them odd?
    The piece table has a row for the empty string, which brings the unit's other columns."""
    unit, others = "unit", [c for c in distinct_units.columns if c != "unit"]
    n = F.char_length(unit)
    places = F.when(n <= LONG_UNIT, F.sequence(F.lit(0), n)).otherwise(F.array(n))
    starts = distinct_units.select("*", F.xxhash64(unit).alias("_hash"), F.explode(places).alias("s"))
    windows = starts.select("*", F.substring(unit, F.col("s") + 1, F.lit(longest)).alias("w"))
    exploded = windows.select("*", F.explode(F.sequence(F.lit(1), F.greatest(F.char_length("w"), F.lit(1)))).alias("size"))
    exploded = exploded.select(unit, *others, "_hash", "s", "size", F.substring("w", F.lit(1), F.col("size")).alias("piece"))
    found = exploded.join(F.broadcast(piece_table), "piece")       # bounded by the model's size
    at_end = F.col("piece") == ""
    # the other columns in one row of a unit only
    found = found.select("_hash", unit, *[F.when(at_end, F.col(c)).alias(c) for c in others],
                         F.when(~at_end, edge).alias("edge"), "odd")
    # by hash first: rows come in this order, and whole strings are hardly compared
    return found.groupBy("_hash", unit).agg(
        *[F.first(c, ignorenulls=True).alias(c) for c in others],
        F.collect_list("edge").alias("found"), F.max("odd").alias("odd"))


def _edge(start: Column, end: Column) -> Column:
    return F.try_element_at(F.col("edges"), start.cast("long") * _WIDE + end)


def _single(start: Column) -> Column:
    return F.try_element_at(F.col("singles"), start.cast("int"))


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _bits(low: Column, size: Column) -> Column:
    """A long with ``size`` bits from bit ``low`` on; bit 64 is bit 0."""
    one = lambda by: F.call_function("shiftleft", F.lit(1).cast("long"), by.cast("int"))
    return F.call_function("shiftleft", one(size) - 1, low.cast("int"))


class _Merge:
    """A BPE edge, packed into a long that sorts by rank (of the score), then start: 20 bits of
    rank, 6 of start, 6 of the size less one, 20 of the id.  ``gone`` has a bit for every place
    between characters (from 1 on) that lies inside a symbol."""

    def __init__(self, code: Column):
        self.start, more = _field(code, 26, 63), _field(code, 20, 63)
        self.id = _field(code, 0, (1 << 20) - 1)
        self.inside, self.more = _bits(self.start + 1, more), more
        self.ends = _bits(self.start, F.lit(1)).bitwiseOR(_bits(self.start + more + 1, F.lit(1)))

    @staticmethod
    def packed() -> Column:
        s, more = F.col("s").cast("long"), F.col("size").cast("long") - 1
        return F.col("rank") * (1 << 32) + s * (1 << 26) + more * (1 << 20) + F.col("id")

    def bridges(self, gone: Column) -> Column:
        return (gone.bitwiseAND(self.ends) == 0) & (F.bit_count(gone.bitwiseAND(self.inside)) == self.more - 1)

    def stands(self, gone: Column) -> Column:
        return (gone.bitwiseAND(self.ends) == 0) & (gone.bitwiseAND(self.inside) == self.inside)


def _field(code: Column, at: int, mask: int) -> Column:
    return (F.shiftright(code, at) if at else code).bitwiseAND(F.lit(mask).cast("long"))


def fold_merges(n: Column) -> Column:
    """BPE: the places that are gone when no edge bridges two neighbouring symbols any more."""
    none = F.lit(0).cast("long")

    def walk(gone: Column, code: Column) -> Column:
        edge = _Merge(code)
        return F.when(edge.bridges(gone), gone.bitwiseOR(edge.inside)).otherwise(gone)

    def best(gone: Column, _: Column) -> Column:
        first = F.get(F.filter("found", lambda code: _Merge(code).bridges(gone)), F.lit(0))
        return F.coalesce(_let(first, lambda code: gone.bitwiseOR(_Merge(code).inside)), gone)
    return F.when(F.col("odd"), F.aggregate(F.sequence(F.lit(1), n), none, best)) \
        .otherwise(F.aggregate("found", none, walk))


def merged_ids(n: Column, as_bytes) -> Column:
    """BPE: ids of the symbols that ``gone`` leaves."""
    symbols = F.filter("found", lambda code: _Merge(code).stands(F.col("gone")))
    symbols = F.array_sort(F.transform(symbols, lambda code: _field(code, 0, (1 << 32) - 1)))
    ids = lambda codes: F.transform(codes, lambda code: _Merge(code).id.cast("int"))

    def at(i: Column, codes: Column) -> Column:
        own = ids(F.filter(codes, lambda code: _Merge(code).start == i))
        return F.when(F.col("gone").bitwiseAND(_bits(i, F.lit(1))) != 0, F.array().cast("array<int>")) \
            .when(F.size(own) > 0, own).otherwise(as_bytes(i, F.lit(1)))
    return _let(symbols, lambda codes: F.when(F.size(codes) == n - F.bit_count("gone"), ids(codes))
                .otherwise(F.flatten(F.transform(F.sequence(F.lit(0), n - 1), lambda i: at(i, codes)))))


def fold_viterbi(n: Column, longest: int, unknown: float) -> Column:
    """Unigram: best (score, start of the last piece) of every prefix, then the bounds of the
    best path.  A character without a piece scores ``unknown``."""
    kind = "array<struct<score:double,start:int>>"
    first = F.array(F.struct(F.lit(0.0).alias("score"), F.lit(0).alias("start"))).cast(kind)

    def step(best: Column, end: Column) -> Column:
        ways = F.transform(F.sequence(F.greatest(end - longest, F.lit(0)), end - 1), lambda start: F.struct(
            (F.get(best, start)["score"] + F.coalesce(
                F.when(start == end - 1, F.coalesce(_single(start)["score"], F.lit(unknown))),
                _edge(start, end)["score"])).alias("score"), start.cast("int").alias("start")))
        return F.concat(best, F.array(F.array_max(ways)).cast(kind))
    table = F.aggregate(F.sequence(F.lit(1), n), first, step)
    # from the end back to 0, one piece at a time
    path = F.aggregate(F.sequence(F.lit(1), n), F.struct(F.array(n).alias("bounds"), table.alias("table")),
                       lambda acc, _: F.struct(
                           F.when(F.get(acc["bounds"], F.lit(0)) > 0, F.concat(
                               F.array(F.get(acc["table"], F.get(acc["bounds"], F.lit(0)))["start"]), acc["bounds"]))
                           .otherwise(acc["bounds"]).alias("bounds"), acc["table"].alias("table")),
                       lambda acc: acc["bounds"])
    return path


def encode_units(distinct_units: DataFrame, pieces: Pieces) -> DataFrame:
    """``distinct_units`` (non-empty, one row each) with ``ids``: the lattice, folded; null for
    units beyond ``LONG_UNIT`` characters."""
    spark = distinct_units.sparkSession
    zero = pieces.bytes_at[0]
    if any(pieces.bytes_at[b] != zero + b for b in range(256)):
        raise ValueError("byte pieces must have consecutive ids")
    bpe = pieces.kind == "bpe"
    odd = unordered(pieces.scores) if bpe else set()
    ranks = {score: i for i, score in enumerate(sorted({s for p, s in pieces.scores.items() if len(p) > 1}, reverse=True))}
    rank = lambda p: ranks[pieces.scores[p]] if len(p) > 1 else len(ranks)
    table = spark.createDataFrame([("", None, None, None, None)] + [(p, float(pieces.scores[p]), i, rank(p), p in odd)
                                                                    for p, i in pieces.ids.items() if p],
                                  "piece string, score double, id int, rank long, odd boolean")
    n = F.char_length("unit")

    def as_bytes(start: Column, size: Column) -> Column:
        code = F.hex(F.encode(F.substring("unit", start + 1, size), "UTF-8"))
        return F.transform(F.sequence(F.lit(1), F.length(code), F.lit(2)),
                           lambda at: (F.conv(F.substring(code, at, F.lit(2)), 16, 10).cast("int") + zero))
    short = n <= LONG_UNIT
    if bpe:
        found = edges(distinct_units, table, pieces.longest, _Merge.packed()) \
            .withColumns({"found": F.sort_array("found"), "odd": F.coalesce("odd", F.lit(False))}) \
            .withColumn("gone", F.when(short, fold_merges(n)))
        return found.select(*distinct_units.columns, F.when(F.col("gone").isNotNull(), merged_ids(n, as_bytes)).alias("ids"))
    place = F.col("s").cast("long") * _WIDE + F.col("s") + F.col("size")
    listed = edges(distinct_units, table, pieces.longest, F.struct(place.alias("place"), "s", "size", "score", "id"))

    def table_of(where, key: str) -> Column:
        return F.map_from_entries(F.transform(F.filter("found", where), lambda e: F.struct(
            e[key].alias("key"), F.struct(e["score"].alias("score"), e["id"].alias("id")).alias("edge"))))
    folded = listed.withColumns({"edges": table_of(lambda e: e["size"] > 1, "place"), "singles": table_of(lambda e: e["size"] == 1, "s")}) \
        .withColumn("bounds", F.when(short, fold_viterbi(n, pieces.longest, min(pieces.scores.values(), default=0.0) - 10.0)))

    def piece_ids(i: Column) -> Column:
        start, end = F.get(F.col("bounds"), i), F.get(F.col("bounds"), i + 1)
        known = F.when(end == start + 1, _single(start)["id"]).otherwise(_edge(start, end)["id"])
        return F.when(known.isNotNull(), F.array(known)).otherwise(as_bytes(start, end - start))
    return folded.select(*distinct_units.columns, F.when(F.col("bounds").isNotNull(), F.flatten(F.transform(
        F.sequence(F.lit(0), F.size("bounds") - 2), piece_ids))).alias("ids"))


def _ragged(lengths: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Indexes starts[i], starts[i] + 1, ... for each i, one after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


def _first_seen(numbers: np.ndarray) -> np.ndarray:
    """Numbers given in the order of first sight, with 0 for a new one."""
    numbers = numbers.astype(np.int64)
    before = np.maximum.accumulate(np.concatenate(([-1], numbers)))[:-1]
    return np.where(numbers > before, 0, numbers + 1)


def _seen_first(coded: np.ndarray) -> np.ndarray:
    new = coded == 0
    return np.where(new, np.cumsum(new) - 1, coded - 1).astype(np.int32)


def _pack(numbers: np.ndarray) -> bytes:
    """Compressed, byte by byte: the upper ones are mostly zero."""
    planes = np.asarray(numbers, np.int32).view(np.uint8).reshape(-1, 4).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _unpack(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, -1).T).view(np.int32).ravel()


def _pack_ids(pieces: Pieces):
    """Rows of units with their places and ids -> a row per block: how many units, their numbers
    (differences), how many ids each has, and the ids, packed."""
    def out(blocks, numbers, lens, starts, flat):
        order = np.lexsort((numbers, blocks))
        blocks, numbers, lens, starts = blocks[order], numbers[order], lens[order], starts[order]
        heads = np.flatnonzero(np.concatenate(([True], blocks[1:] != blocks[:-1])))
        packed = []
        for a, b in zip(heads.tolist(), np.append(heads[1:], len(blocks)).tolist()):
            ids = flat[_ragged(lens[a:b], starts[a:b])]
            packed.append(_pack(np.concatenate(([b - a], np.diff(numbers[a:b], prepend=0), lens[a:b], ids))))
        return pa.RecordBatch.from_arrays([pa.array(blocks[heads], pa.int64()), pa.array(packed, pa.binary())], ["block", "units"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter, held, n_held, n_ids = PrefixCounter(pieces), [], 0, 0
        for batch in batches:
            lists = batch.column(1)
            if lists.null_count:
                lists = pa.array([counter.ids(u.as_py()) if u.is_valid else own.as_py()
                                  for own, u in zip(lists, batch.column(2))], pa.list_(pa.int32()))
            offsets, places = lists.offsets.to_numpy(), batch.column(0)
            times = np.diff(places.offsets.to_numpy())
            where = places.flatten()
            held.append((where.field(0).to_numpy(), where.field(1).to_numpy(), np.repeat(np.diff(offsets), times).astype(np.int64),
                         np.repeat(offsets[:-1] + n_ids, times).astype(np.int64), lists.values.to_numpy()))
            n_held, n_ids = n_held + len(where), n_ids + len(lists.values)
            if n_held >= PLACES_PACKED:
                yield out(*map(np.concatenate, zip(*held)))
                held, n_held, n_ids = [], 0, 0
        if n_held:
            yield out(*map(np.concatenate, zip(*held)))
    return run


def _put_together(kind: pa.DataType, pieces: Pieces):
    def expand(head, packed: list):
        ids, codes, sizes, of_word, word_sizes, n_units = head
        lens, starts, flat, at = np.full(n_units, -1, np.int64), np.zeros(n_units, np.int64), [np.empty(0, np.int32)], 0
        n_found = 0
        for units in map(_unpack, packed):
            n = int(units[0])
            numbers, own = np.cumsum(units[1:n + 1]), units[n + 1:2 * n + 1].astype(np.int64)
            n_found += n
            if n_found > n_units or n and numbers[-1] >= n_units:
                break
            lens[numbers], starts[numbers] = own, np.cumsum(own) - own + at
            flat.append(units[2 * n + 1:])
            at += len(flat[-1])
        if n_found != n_units or (lens < 0).any():
            raise RuntimeError("the two passes over a block differ; encode a stored or checkpointed table")
        flat = np.concatenate(flat)
        of_word, word_sizes = _seen_first(_unpack(of_word)), _unpack(word_sizes).astype(np.int64)
        word_flat = flat[_ragged(lens[of_word], starts[of_word])]
        word_ends = np.concatenate(([0], np.cumsum(lens[of_word])))
        cuts = np.concatenate(([0], np.cumsum(word_sizes)))
        word_starts, word_lens = word_ends[cuts[:-1]], np.diff(word_ends[cuts])
        codes, sizes = _seen_first(_unpack(codes)), np.array(sizes, np.int64)
        at = 0
        for i in range(0, len(sizes), DOCUMENTS_OUT):
            n = int(sizes[i:i + DOCUMENTS_OUT].sum())
            own = codes[at:at + n]
            at += n
            tokens = word_flat[_ragged(word_lens[own], word_starts[own])]
            per_word = np.concatenate(([0], np.cumsum(word_lens[own])))
            offsets = per_word[np.concatenate(([0], np.cumsum(sizes[i:i + DOCUMENTS_OUT])))]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[i:i + DOCUMENTS_OUT], kind), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(tokens, pa.int32()))],
                ["id", "ids"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, head, found = None, None, []
        for batch in batches:
            for at, units, x in zip(batch.column(0).to_pylist(), batch.column(2), batch.column(3)):
                if x.is_valid:
                    if head is not None:
                        yield from expand(head, found)
                    x = x.as_py()
                    head = (x["ids"], x["codes"], x["sizes"], x["of_word"], x["word_sizes"], x["n_units"])
                    block, found = at, []
                elif at != block:
                    raise RuntimeError("the two passes over a block differ; encode a stored or checkpointed table")
                else:
                    found.append(units.as_py())
        if head is not None:
            yield from expand(head, found)
    return run


def encode(docs: DataFrame, pieces: Pieces, id_col: str = "doc_id", text_col: str = "text",
           decoded_col: str | None = None) -> DataFrame:
    """One row per input row: its id and ``ids``, the token ids of the whole text.

    Null and empty texts have no tokens; repeated rows stay; an empty table gives an empty
    result; other columns are not read.  Equal to the SentencePiece library's encoding.
    ``decoded_col`` names a further column, the text those ids decode to: the same as
    :func:`decode` on the result, but in the worker that holds the ids already, so that a
    task keeps one Python process instead of two.
    """
    if spaces_inside(pieces):
        raise ValueError("a piece holds a space after another character; words cannot be encoded one by one")
    source = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    id_type = source.schema["id"].dataType

    def list_units(batches):
        def emit(block, names, of_word, word_sizes):
            for at in range(0, len(names), UNITS_OUT):
                part = names.slice(at, UNITS_OUT)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(part), block)), pa.array(np.arange(at, at + len(part), dtype=np.int32)), part],
                    ["block", "number", "unit"])
        yield from _Blocks(pieces).run(batches, emit)

    head = T.StructType([
        T.StructField("ids", T.ArrayType(id_type)), T.StructField("codes", T.BinaryType()),
        T.StructField("sizes", T.ArrayType(T.IntegerType())), T.StructField("of_word", T.BinaryType()),
        T.StructField("word_sizes", T.BinaryType()), T.StructField("n_units", T.IntegerType())])
    head_schema = T.StructType([T.StructField("block", T.LongType()), T.StructField("number", T.IntegerType()),
                                T.StructField("units", T.BinaryType()), T.StructField("head", head)])

    def list_documents(batches):
        state = _Blocks(pieces)

        def emit(block, names, of_word, word_sizes):
            row = {"block": block, "number": -1, "units": None, "head": {
                "ids": [i.as_py() for i in state.ids], "codes": _pack(_first_seen(state.codes)),
                "sizes": state.sizes, "of_word": _pack(_first_seen(of_word)), "word_sizes": _pack(word_sizes), "n_units": len(names)}}
            yield pa.RecordBatch.from_pylist([row], schema=arrow_head)
        yield from state.run(batches, emit)

    from pyspark.sql.pandas.types import to_arrow_schema, to_arrow_type
    arrow_head = to_arrow_schema(head_schema)
    unit_schema = T.StructType([T.StructField("block", T.LongType(), False), T.StructField("number", T.IntegerType(), False),
                                T.StructField("unit", T.StringType(), False)])
    listed = source.mapInArrow(list_units, unit_schema).repartition(target_partitions(docs.sparkSession), "unit")
    distinct = listed.groupBy(F.xxhash64("unit").alias("_hash"), "unit") \
        .agg(F.collect_list(F.struct("block", "number")).alias("places")).select("unit", "places")
    coded = encode_units(distinct, pieces)
    entries = coded.select("places", "ids", F.when(F.col("ids").isNull(), F.col("unit")).alias("long")) \
        .mapInArrow(_pack_ids(pieces), "block bigint, units binary") \
        .select("block", F.lit(0).alias("number"), "units", F.lit(None).cast(head).alias("head"))
    heads = source.mapInArrow(list_documents, head_schema)
    out = T.StructType([source.schema["id"], T.StructField("ids", T.ArrayType(T.IntegerType()))])
    put_together = _put_together(to_arrow_type(id_type), pieces)
    if decoded_col is not None:
        out = out.add(decoded_col, T.StringType())
        encoded, back = put_together, _decoder(pieces, 1, decoded_col)
        put_together = lambda batches: back(encoded(batches))
    return heads.unionByName(entries).repartition(target_partitions(docs.sparkSession), "block").sortWithinPartitions("block", "number") \
        .mapInArrow(put_together, out).withColumnRenamed("id", id_col)


def decode_ids(ids: list[int], pieces: Pieces) -> str:
    text = b"".join(map(pieces.surface.__getitem__, ids)).decode("utf-8", "replace")
    return text[1:] if text.startswith(" ") else text


def _decoder(pieces: Pieces, at: int, text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(at)
            flat, ends = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
            none = lists.is_null().to_pylist()
            texts = [None if none[i] else decode_ids(flat[ends[i]:ends[i + 1]].tolist(), pieces) for i in range(len(lists))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())],
                                             [*batch.schema.names, text_col])
    return run


def decode(encoded: DataFrame, pieces: Pieces, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """All columns and ``text_col``, the text of the token ids (null for null ids)."""
    schema = T.StructType([*encoded.schema.fields, T.StructField(text_col, T.StringType())])
    return encoded.mapInArrow(_decoder(pieces, encoded.columns.index(ids_col), text_col), schema)
