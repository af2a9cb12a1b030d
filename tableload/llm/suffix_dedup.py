"""Removal of long repeated byte strings with suffix arrays over shards.

A string of ``length`` bytes that starts at two places is found as follows.

1. Every window of ``length`` bytes is filed under the smallest hash of the 64-byte strings
   inside it.  Equal windows have equal keys, wherever they stand; a stretch of consecutive
   windows with one key is a segment of text.
2. Keys that occur once (and whose smallest string stands once in its stretch) cannot hold a
   repeat.  The segments of all other keys are dealt to shards by key.
3. Each shard sorts the suffixes of its segments (Larsson-Sadakane refinement of equal
   prefixes in numpy), takes the common prefixes of neighbours (Kasai's rule that the value
   at i + 1 is the value at i less one unless the neighbour changes or the value at i is 0), and
   marks windows that
   agree with another over ``length`` bytes.  The texts of a large key are dealt over several
   shards, each sorted in a task of its own.
4. Of a large key's shard the windows that stand once in it, and one of each that stands
   there more often, leave as MD5 digests, packed by bucket.  Equal windows of different
   shards meet in their bucket, where those not marked yet are.
5. Marked windows go back to their texts, where overlapping ones are joined.

Whole texts that occur more than once are collapsed first and weighted by their number, and
equal segments are collapsed before they are dealt out, so a group of copies of any size is
one entry per task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import target_partitions

LENGTH = 400
GRAM = 64
SHARD_BYTES = 1 << 20
BLOCK_BYTES = 1 << 19
#: a large key has up to so many buckets, so that its shards send so many packs at most
BUCKETS = 1024

_MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)


def gram_hashes(data: bytes) -> np.ndarray:
    """Hash of the 64-byte string at every position (doubling from 8 bytes)."""
    if len(data) < GRAM:
        return np.empty(0, np.uint64)
    with np.errstate(over="ignore"):
        h = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,)) * _MIX[0]
        h ^= h >> np.uint64(29)
        span = 8
        while span < GRAM:
            h = (h[:-span] * _MIX[1]) ^ ((h[span:] ^ (h[span:] >> np.uint64(31))) * _MIX[2])
            h ^= h >> np.uint64(32)
            span *= 2
    return h


def window_minima(values: np.ndarray, width: int) -> np.ndarray:
    span, low = 1, values
    while span * 2 <= width:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    rest = width - span
    return np.minimum(low[:len(low) - rest], low[rest:]) if rest else low


def stretches(text: bytes, length: int = LENGTH) -> list[tuple[int, int, int, bool]]:
    """(key, first start, last start, may repeat inside) of the stretches of windows of a text."""
    if len(text) < length:
        return []
    grams = gram_hashes(text)
    width = length - GRAM + 1
    low = window_minima(grams, width)
    heads = np.flatnonzero(np.concatenate(([True], low[1:] != low[:-1])))
    ends = np.append(heads[1:], len(low)) - 1
    keys = low[heads]
    out = []
    for key, a, b in zip(keys.view(np.int64).tolist(), heads.tolist(), ends.tolist()):
        twice = b - a >= width or np.count_nonzero(grams[a:b + width] == low[a]) > 1
        out.append((key, a, b, bool(twice)))
    return out


def suffix_array(data: np.ndarray, depth: int) -> np.ndarray:
    """Positions of ``data`` (bytes) in the order of the ``depth`` bytes that follow them."""
    n = len(data)
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    first = np.ndarray((n,), ">u8", padded.tobytes(), strides=(1,)).astype(np.uint64)
    order = np.argsort(first, kind="stable")
    same = first[order]
    head = np.empty(n + 1, bool)
    head[0] = head[n] = True
    head[1:n] = same[1:] != same[:-1]
    rank = np.empty(n, np.int64)
    at = np.arange(n)
    rank[order] = np.maximum.accumulate(np.where(head[:n], at, 0))
    h = 8
    while h < depth:
        step = min(h, depth - h)
        loose = np.flatnonzero(~(head[:n] & head[1:]))          # members of groups of two or more
        if not len(loose):
            break
        places = order[loose]
        nxt = places + step
        second = np.where(nxt < n, rank[np.minimum(nxt, n - 1)] + 1, 0)
        both = (rank[places] << 32) | second
        perm = np.argsort(both, kind="stable")
        places, both = places[perm], both[perm]
        order[loose] = places
        head[loose[1:]] |= both[1:] != both[:-1]
        rank[places] = np.maximum.accumulate(np.where(head[loose], loose, 0))
        h += step
    return order


def common_prefixes(data: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Length of the common prefix of each suffix with the one before it in ``order``."""
    n = len(data)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    anew = np.empty(n, bool)
    anew[0] = True
    # a neighbour that shares no byte says nothing about the suffix after it
    anew[1:] = (before[1:] != before[:-1] + 1) | (before[:-1] < 0) | (data[:-1] != data[before[:-1]])
    padded = np.concatenate((data, np.zeros(8, np.uint8))).tobytes()
    eight = np.ndarray((n,), "<u8", padded, strides=(1,))
    lcp = np.zeros(n, np.int64)
    i = np.flatnonzero(anew & (before >= 0))
    j = before[i]
    live, length = np.arange(len(i)), np.zeros(len(i), np.int64)
    while len(live):
        x, y = i[live] + length[live], j[live] + length[live]
        inside = (x < n) & (y < n)
        live, x, y = live[inside], x[inside], y[inside]
        differ = eight[x] ^ eight[y]
        whole = differ == 0
        short = live[~whole]
        low = differ[~whole]
        length[short] += np.log2((low & (~low + np.uint64(1))).astype(np.float64)).astype(np.int64) // 8
        length[live[whole]] += 8
        live = live[whole]
    lcp[i] = np.minimum(length, n - np.maximum(i, j))
    # a suffix whose neighbour moves along with it has one byte less in common
    at = np.arange(n)
    start = np.maximum.accumulate(np.where(anew, at, 0))
    lcp = np.where(anew, lcp, np.maximum(lcp[start] - (at - start), 0))
    return lcp[order]


class Shard:
    """Suffix array of some segments; ``starts`` are the windows, ``weight`` counts copies."""

    def __init__(self, segments: list[tuple[bytes, int]], length: int):
        sizes = np.array([len(s) for s, _ in segments])
        self.offsets = np.concatenate(([0], np.cumsum(sizes)))
        self.data = np.frombuffer(b"".join(s for s, _ in segments), np.uint8)
        self.length = length
        weight = np.zeros(len(self.data), np.int64)
        for (_, n), at, size in zip(segments, self.offsets.tolist(), sizes.tolist()):
            weight[at:at + size - length + 1] = n
        order = suffix_array(self.data, length)
        lcp = common_prefixes(self.data, order)
        group = np.cumsum(lcp < length)
        times = np.bincount(group, weights=weight[order])
        self.repeated = np.zeros(len(self.data), bool)
        self.repeated[order] = times[group] > 1
        self.is_start = weight > 0
        self.repeated &= self.is_start
        self.order, self.group = order, group
        self.sorted_starts = order[self.is_start[order]]

    def find(self, other: "Shard") -> None:
        """Mark the windows that stand in ``other`` too (binary search in its array)."""
        mine = np.flatnonzero(self.is_start & ~self.repeated)
        theirs = other.sorted_starts
        if not len(mine) or not len(theirs):
            return
        low, high = np.zeros(len(mine), np.int64), np.full(len(mine), len(theirs))
        while True:
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                break
            mid = (low[open_] + high[open_]) // 2
            less = _compare(other.data, theirs[mid], self.data, mine[open_], self.length) < 0
            low[open_] = np.where(less, mid + 1, low[open_])
            high[open_] = np.where(less, high[open_], mid)
        inside = low < len(theirs)
        equal = np.zeros(len(mine), bool)
        equal[inside] = _compare(other.data, theirs[low[inside]], self.data, mine[inside], self.length) == 0
        self.repeated[mine[equal]] = True

    def spans(self, k: int) -> list[tuple[int, int]]:
        """Removed runs of segment ``k``, as offsets within it."""
        a, b = int(self.offsets[k]), int(self.offsets[k + 1])
        at = np.flatnonzero(self.repeated[a:b])
        if not len(at):
            return []
        cut = np.flatnonzero(np.diff(at) > self.length)
        lows, highs = at[np.concatenate(([0], cut + 1))], at[np.append(cut, len(at) - 1)] + self.length
        return list(zip(lows.tolist(), highs.tolist()))


    def windows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places, MD5 digests (two 64-bit numbers each) and marks of the windows that others may
        equal: all that are not marked, and one of each that is."""
        marked = self.repeated[self.order]
        _, first = np.unique(self.group[marked], return_index=True)
        at = np.concatenate((np.flatnonzero(self.is_start & ~self.repeated), self.order[marked][first]))
        raw = self.data.tobytes()
        digests = b"".join(hashlib.md5(raw[i:i + self.length]).digest() for i in at.tolist())
        return at, np.frombuffer(digests, "<u8").reshape(-1, 2), self.repeated[at]


def _compare(x: np.ndarray, i: np.ndarray, y: np.ndarray, j: np.ndarray, length: int) -> np.ndarray:
    """-1, 0 or 1: order of the ``length`` bytes of x at i and of y at j."""
    out, live = np.zeros(len(i), np.int64), np.arange(len(i))
    xs = np.ndarray((len(x),), ">u8", np.concatenate((x, np.zeros(8, np.uint8))).tobytes(), strides=(1,))
    ys = np.ndarray((len(y),), ">u8", np.concatenate((y, np.zeros(8, np.uint8))).tobytes(), strides=(1,))
    for at in range(0, length, 8):
        a, b = xs[i[live] + at].astype(np.uint64), ys[j[live] + at].astype(np.uint64)
        if length - at < 8:
            drop = np.uint64(8 * (8 - length + at))
            a, b = a >> drop, b >> drop
        out[live] = np.where(a < b, -1, np.where(a > b, 1, 0))
        live = live[a == b]
        if not len(live):
            break
    return out


_RUNS = "digest binary, key bigint, a int, b int, n bigint, twice boolean"
_SEGMENTS = "key bigint, salt int, salts int, segment binary, n bigint, digests array<binary>, starts array<int>"
_SPANS = "digest binary, lo array<int>, hi array<int>"
_FOUND = _SPANS + ", key bigint, bucket int, windows binary, owners array<binary>, owner binary, starts binary"
_FOUND_TYPES = (pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.int64(), pa.int32(), pa.binary(),
                pa.list_(pa.binary()), pa.binary(), pa.binary())
_FOUND_NAMES = ["digest", "lo", "hi", "key", "bucket", "windows", "owners", "owner", "starts"]
_RESULT = "digest binary, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary"


def _find_runs(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: dict[bytes, list] = {}
            for digest, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                if digest in seen:
                    seen[digest][1] += 1
                else:
                    seen[digest] = [stretches(text.as_py(), length), 1]
            rows = [(d, *r[:3], n, r[3]) for d, (found, n) in seen.items() for r in found]
            columns = list(zip(*rows)) or [[]] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.binary(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.bool_()))],
                ["digest", "key", "a", "b", "n", "twice"])
    return run


def _cut_segments(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(found):
            return pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in found], pa.int64()), pa.array([k[1] for k in found], pa.int32()),
                 pa.array([k[2] for k in found], pa.int32()), pa.array([k[3] for k in found], pa.binary()),
                 pa.array([v[0] for v in found.values()], pa.int64()),
                 pa.array([v[1] for v in found.values()], pa.list_(pa.binary())),
                 pa.array([v[2] for v in found.values()], pa.list_(pa.int32()))],
                ["key", "salt", "salts", "segment", "n", "digests", "starts"])
        found, held = {}, 0
        for batch in batches:
            for digest, text, n, runs in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(),
                                             batch.column(3).to_pylist()):
                text = text.as_py()
                for r in runs:
                    segment = text[r["a"]:r["b"] + length]
                    salt = int.from_bytes(digest[:4], "little") % r["salts"]
                    entry = found.setdefault((r["key"], salt, r["salts"], segment), [0, [], []])
                    entry[0] += n
                    entry[1].append(digest)
                    entry[2].append(r["a"])
                    held += 64 + (len(segment) if len(entry[1]) == 1 else 0)
                if held > 32 << 20:
                    yield out(found)
                    found, held = {}, 0
        if found:
            yield out(found)
    return run


def _sort_shards(length: int, shard_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows_of(rows):
            columns = list(zip(*rows)) or [[]] * len(_FOUND_TYPES)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _FOUND_TYPES)], _FOUND_NAMES)

        def out(shard, places):
            return rows_of([(d, [a + lo for lo, _ in spans], [a + hi for _, hi in spans], *[None] * 6)
                            for k, where in enumerate(places) if (spans := shard.spans(k)) for d, a in where])

        def packs(shard, places, key, buckets):
            """The shard's windows for those of the key's other shards, by bucket."""
            at, digests, marked = shard.windows()
            segment = np.searchsorted(shard.offsets, at, "right") - 1
            bucket = (digests[:, 0] % np.uint64(buckets)).astype(np.int64)
            order = np.lexsort((segment, bucket))
            rows = []
            for part in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1) if len(order) else ():
                free = part[~marked[part]]                 # each stands in one place only
                segments, owner = np.unique(segment[free], return_inverse=True)
                first = [places[k][0] for k in segments.tolist()]
                starts = at[free] - shard.offsets[segment[free]] + np.array([a for _, a in first], np.int64)[owner]
                rows.append((None, None, None, key, int(bucket[part[0]]),
                             digests[np.concatenate((free, part[marked[part]]))].tobytes(), [d for d, _ in first],
                             owner.astype("<i4").tobytes(), starts.astype("<i4").tobytes()))
            return rows_of(rows)

        def finish(keyed):
            """Shards of the given keys' segments; those of a large key's texts have their own."""
            small: list = []
            held = 0
            for key, salts, segments in keyed:
                if salts > 1:
                    yield from large(key, salts, segments)
                    continue
                small.extend(segments.items())
                held += sum(len(s) for s in segments)
                if held >= shard_bytes:
                    yield out(Shard([(s, v[0]) for s, v in small], length), [v[1] for _, v in small])
                    small, held = [], 0
            if small:
                yield out(Shard([(s, v[0]) for s, v in small], length), [v[1] for _, v in small])

        def large(key, salts, segments):
            parts, part, held = [], [], 0
            for item in segments.items():
                part.append(item)
                held += len(item[0])
                if held >= shard_bytes:
                    parts.append(part)
                    part, held = [], 0
            parts += [part] if part else []
            shards = [Shard([(s, v[0]) for s, v in p], length) for p in parts]
            for x in shards:
                for y in shards:
                    if x is not y:
                        x.find(y)
            for shard, p in zip(shards, parts):
                places = [v[1] for _, v in p]
                yield out(shard, places)
                yield packs(shard, places, key, min(16 * salts, BUCKETS))

        def keyed():
            at, segments = None, {}
            for batch in batches:
                for k, salt, salts, segment, n, digests, starts in zip(*(batch.column(c).to_pylist() for c in range(7))):
                    if at is not None and (k, salt, salts) != at:
                        yield at[0], at[2], segments
                        segments = {}
                    at = k, salt, salts
                    entry = segments.setdefault(segment, [0, []])
                    entry[0] += n
                    entry[1].extend(zip(digests, starts))
            if at is not None:
                yield at[0], at[2], segments

        yield from finish(keyed())
    return run


def _merge_shards(length: int):
    """Spans as they are, and those of the windows that a large key's shards have in common."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def common(packs):
            windows = np.frombuffer(b"".join(p[0] for p in packs), "<u8").reshape(-1, 2)
            order = np.lexsort((windows[:, 1], windows[:, 0]))
            same = (windows[order[1:]] == windows[order[:-1]]).all(axis=1)
            twice = np.zeros(len(order), bool)
            twice[order[1:][same]] = twice[order[:-1][same]] = True
            rows, base = [], 0
            for held, owners, owner, starts in packs:
                owner, starts = np.frombuffer(owner, "<i4"), np.frombuffer(starts, "<i4")
                hit = np.flatnonzero(twice[base:base + len(owner)])
                base += len(held) // 16
                for k in np.unique(owner[hit]).tolist():
                    lo = np.sort(starts[hit[owner[hit] == k]])
                    rows.append((owners[k], lo.tolist(), (lo + length).tolist()))
            columns = list(zip(*rows)) or [[]] * 3
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, _FOUND_TYPES)], _FOUND_NAMES[:3])

        at, packs = None, []
        for batch in batches:
            spans = batch.filter(batch.column(0).is_valid())
            if spans.num_rows:
                yield spans.select(_FOUND_NAMES[:3])
            for k, bucket, *pack in zip(*(c.to_pylist() for c in batch.filter(batch.column(0).is_null()).columns[3:])):
                if at is not None and (k, bucket) != at:
                    yield common(packs)
                    packs = []
                at = k, bucket
                packs.append(pack)
        if packs:
            yield common(packs)
    return run


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for digest, text, spans in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
            text, kept, at, n_spans = text.as_py(), [], 0, 0
            end = -1
            for lo, hi in sorted((lo, hi) for s in spans or () for lo, hi in zip(s["lo"], s["hi"])):
                if lo > end:
                    n_spans += 1
                    kept.append(text[at:lo])
                at = end = max(end, hi)
            kept.append(text[at:])
            kept = b"".join(kept)
            rows.append((digest, len(text), len(text) - len(kept), n_spans, kept))
        columns = list(zip(*rows)) or [[]] * 5
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, (pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.binary()))],
            ["digest", "n_bytes", "n_removed", "n_spans", "kept"])


def remove_repeats(docs: DataFrame, text_col: str = "text", length: int = LENGTH,
                   shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """One row per different text: ``digest`` (MD5 of its UTF-8 bytes), n_bytes, n_removed,
    n_spans and ``kept`` (the remaining bytes).  Join on the digest to reach documents.

    Every byte covered by a ``length``-byte string that also starts anywhere else is removed,
    judged on the input.  Null texts count as empty; texts shorter than ``length`` keep all
    their bytes; repeated rows are copies and remove each other; an empty table gives an
    empty result; other columns are not read.
    """
    if length < GRAM:
        raise ValueError(f"length must be at least {GRAM}")
    texts = docs.select(F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text")) \
        .select(F.unhex(F.md5("text")).alias("digest"), "text").where("digest IS NOT NULL")
    runs = texts.mapInArrow(_find_runs(length), _RUNS)
    runs = runs.groupBy("key", "digest", "a", "b").agg(F.sum("n").alias("n"), F.max("twice").alias("twice"))
    part_bytes = max(1, shard_bytes // 4)                    # a key with more is large
    keys = runs.groupBy("key").agg(F.sum("n").alias("copies"), F.max("twice").alias("again"),
                                   F.sum(F.expr(f"b - a + {length}")).alias("bytes")) \
        .where("copies > 1 OR again").select("key", F.ceil(F.expr(f"bytes / {part_bytes}")).cast("int").alias("salts"))
    wanted = runs.join(keys, "key").groupBy("digest") \
        .agg(F.max("n").alias("n"), F.collect_list(F.struct("key", "a", "b", "salts")).alias("runs"))
    distinct = texts.dropDuplicates(["digest"])
    segments = distinct.join(wanted, "digest").select("digest", "text", "n", "runs") \
        .mapInArrow(_cut_segments(length), _SEGMENTS)
    n_parts = target_partitions(docs.sparkSession)
    found = segments.repartition(n_parts, "key", "salt").sortWithinPartitions("key", "salt") \
        .mapInArrow(_sort_shards(length, shard_bytes), _FOUND)
    spans = found.repartition(n_parts, "digest", "key", "bucket").sortWithinPartitions("key", "bucket") \
        .mapInArrow(_merge_shards(length), _SPANS)
    spans = spans.groupBy("digest").agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))
    return distinct.join(spans, "digest", "left").select("digest", "text", "spans").mapInArrow(_remove, _RESULT)

