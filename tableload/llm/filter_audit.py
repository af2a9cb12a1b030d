"""Audit of how quality filters interact, by decision diagrams over their failure masks.

Every document gets a mask of the filters it fails.  Masks are counted per part of the
corpus; a part's counts become a diagram with one level per filter (low edge: passes, high
edge: fails), equal nodes shared and every node weighted with the documents below it.  All
orders of the filters are visited by swapping two neighbouring levels at a time; in each
order the path of low edges from the root tells what every step keeps and removes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: the filters, in bit order of the masks
FILTERS = "ABCDE"
MIN_WORDS = 200
MIN_DISTINCT_PERCENT = 50
MAX_UPPER_PERCENT = 2
SYMBOLS = b"#$%&*|"

_REPORT = ("part string, filter_order string, step int, kept long, removed long, redundant long, "
           "unique_fails long, good_lost long, toxic_lost long, shapley long")


def _byte_sums(hits: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(hits, dtype=np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def _text_masks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    symbols = np.zeros(256, bool)
    symbols[list(SYMBOLS)] = True
    for batch in batches:
        texts = [t or b"" for t in batch.column(2).to_pylist()]
        offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts], dtype=np.int64)])
        flat = np.frombuffer(b"".join(texts), np.uint8)
        upper = _byte_sums((flat >= 65) & (flat <= 90), offsets)
        points = _byte_sums((flat & 0xC0) != 0x80, offsets)
        odd = _byte_sums(symbols[flat], offsets)
        mask = np.zeros(len(texts), np.int32)
        for i, text in enumerate(texts):
            words = text.split()                                 # ASCII white space, as bytes are split
            mask[i] = (len(words) < MIN_WORDS) + 2 * (100 * len(set(words)) < MIN_DISTINCT_PERCENT * len(words))
        mask += 4 * (100 * upper > MAX_UPPER_PERCENT * points) + 8 * (odd > 0)
        keys = pa.array([hashlib.md5(t).digest() for t in texts], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(mask), keys],
                                         ["part", "id", "mask", "key"])


def mask_counts(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                part_col: str = "source", good_col: str = "quality", toxic_col: str = "toxic") -> DataFrame:
    """(part, mask, n, good, toxic): documents per part and set of failed filters.

    The filters: A under 200 words; B under half of the words distinct; C over 2 % of the
    characters in A-Z; D a symbol of ``#$%&*|``; E a text that also stands under a smaller id
    anywhere in the table.  At most 32 rows per part.

    Defined results: a null text is an empty one; a null part is the part named by the empty
    string; a null id is neither smaller nor larger than another, so such a row never fails
    E; repeated rows each count, and rows of one id and text fail E together; of several
    labels of one id the worse-lost counts (good if any says 1, toxic if any says 1); an
    empty table has no rows.  Other columns are not read.
    """
    ident = docs.select(F.col(id_col).alias("id")).schema["id"].dataType.simpleString()
    texts = docs.select(F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), F.col(id_col).alias("id"),
                        F.col(text_col).cast("binary").alias("text"))
    # one row per id, text and part before anything is joined, so that copies do not pile up
    seen = texts.mapInArrow(_text_masks, f"part string, id {ident}, mask int, key binary") \
        .groupBy("id", "key", "part").agg(F.max("mask").alias("mask"), F.count(F.lit(1)).alias("n"))
    marks = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("_id")) \
        .agg(F.max(F.coalesce(F.col(good_col) == 1, F.lit(False))).alias("good"),
             F.max(F.coalesce(F.col(toxic_col) == 1, F.lit(False))).alias("toxic"))
    seen = seen.join(marks, F.col("id") == F.col("_id"), "left") \
        .select("id", "key", "part", "mask", "n", *[F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "toxic")])
    # a text's copies are reduced to one row per part and label before its first id is sought
    text = seen.groupBy("key", "part", "good", "toxic").agg(
        F.max("mask").alias("mask"), F.sum("n").alias("n"),
        F.coalesce(F.sum(F.when(F.col("id").isNull(), F.col("n"))), F.lit(0)).alias("nameless"),
        F.min(F.when(F.col("id").isNotNull(), F.struct("id", "n"))).alias("lead"))
    first = F.min("lead.id").over(Window.partitionBy("key"))
    text = text.select("part", "mask", "n", "good", "toxic", (F.col("nameless") + F.coalesce(
        F.when(F.col("lead.id") == first, F.col("lead.n")), F.lit(0))).alias("unlike"))
    both = text.select("part", "good", "toxic", F.explode(F.array(
        F.struct("mask", F.col("unlike").alias("n")),
        F.struct((F.col("mask") + 16).alias("mask"), (F.col("n") - F.col("unlike")).alias("n")))).alias("x"))
    return both.where("x.n > 0").groupBy("part", F.col("x.mask").alias("mask")).agg(
        F.sum("x.n").alias("n"), *[F.coalesce(F.sum(F.when(F.col(c), F.col("x.n"))), F.lit(0)).alias(c)
                                   for c in ("good", "toxic")])


# --- diagrams: a node is (weight, low, high); None is a branch without documents -------------

def diagram(counts: dict[int, tuple[int, ...]], levels: list[int]):
    """Diagram of mask counts with the filters (bit numbers) in the order of ``levels``."""
    nodes: dict = {}

    def build(masks: list[int], depth: int):
        if not masks:
            return None
        if depth == len(levels):
            return (tuple(sum(c) for c in zip(*(counts[m] for m in masks))), None, None)
        bit = 1 << levels[depth]
        return _node(nodes, build([m for m in masks if not m & bit], depth + 1),
                     build([m for m in masks if m & bit], depth + 1))

    return build(sorted(counts), 0)


def _node(nodes: dict, low, high):
    if low is None and high is None:
        return None
    key = (id(low), id(high))
    if key not in nodes:
        sides = [x[0] for x in (low, high) if x is not None]
        nodes[key] = (tuple(sum(c) for c in zip(*sides)), low, high)
    return nodes[key]


def swap_levels(root, level: int):
    """The same counts with the filters of ``level`` and ``level + 1`` changed about: only the
    nodes at and above these levels are made anew, all below are shared."""
    nodes, seen = {}, {}

    def edges(node):
        return (None, None) if node is None else node[1:]

    def walk(node, depth: int):
        if node is None:
            return None
        if id(node) not in seen:
            low, high = edges(node)
            if depth:
                seen[id(node)] = _node(nodes, walk(low, depth - 1), walk(high, depth - 1))
            else:
                (ll, lh), (hl, hh) = edges(low), edges(high)
                seen[id(node)] = _node(nodes, _node(nodes, ll, hl), _node(nodes, lh, hh))
        return seen[id(node)]

    return walk(root, level)


def neighbour_swaps(n: int) -> Iterator[int]:
    """Levels to swap, one after the other, so that every order of ``n`` filters comes once:
    the last filter runs through the order of the others and back, which step in between."""
    if n < 2:
        return
    down = True
    inner = neighbour_swaps(n - 1)
    while True:
        yield from range(n - 2, -1, -1) if down else range(n - 1)
        step = next(inner, None)
        if step is None:
            return
        yield step + 1 if down else step                          # the last filter stands first or last
        down = not down


def audit_part(counts: dict[int, tuple[int, int, int]], names: str = FILTERS) -> list[tuple]:
    """(order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) of
    every order and step, from mask -> (documents, good, toxic)."""
    order = list(range(len(names)))
    root = diagram(counts, order)
    steps = []
    swaps = neighbour_swaps(len(names))
    while True:
        node = root
        for place, name in enumerate(order):
            low, high = (None, None) if node is None else node[1:]
            gone = high[0] if high is not None else (0, 0, 0)
            steps.append(("".join(names[i] for i in order), place, name, low[0][0] if low is not None else 0, gone))
            node = low
        level = next(swaps, None)
        if level is None:
            break
        root = swap_levels(root, level)
        order[level], order[level + 1] = order[level + 1], order[level]
    fails, alone, total = ({i: 0 for i in order} for _ in range(3))
    for _, place, name, _, gone in steps:
        total[name] += gone[0]
        if place == 0:
            fails[name] = gone[0]                                 # first: all that fail it
        if place == len(names) - 1:
            alone[name] = gone[0]                                 # last: those that fail nothing else
    return [(text, place + 1, kept, gone[0], fails[name] - gone[0], alone[name], gone[1], gone[2], total[name])
            for text, place, name, kept, gone in steps]


def _reports(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [f.split()[0] for f in _REPORT.split(", ")]
    for batch in batches:
        for part, masks in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            rows = audit_part({m["mask"]: (m["n"], m["good"], m["toxic"]) for m in masks})
            columns = list(zip(*[(part, *r) for r in rows]))
            types = [pa.string(), pa.string(), pa.int32()] + [pa.int64()] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)


def audit(counts: DataFrame) -> DataFrame:
    """The report of every part in ``counts`` (see ``mask_counts``): one row per part, order of
    the filters and step.  A part is one group of at most 32 rows.  No parts, no rows."""
    return counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("masks")) \
        .mapInArrow(_reports, _REPORT)
