"""Partition routing: list (R1), range (R2), hash (R3), two levels (R4), rejects (R5), counts.

Routing is a classification of each row by literal bounds taken from a spec, evaluated
in the same stage as the scan; nothing is joined or shuffled to route a row.  Lists are
hash-set ``IN`` tests, ranges a balanced decision tree (log2(n) comparisons per row,
composite keys included), and hash partitions one lookup of the partition name by
remainder.  A spec with more than ``TREE_POINTS`` bounds or values becomes one sorted array
literal that is searched by bisection: a plan of constant size, however many partitions, with
the same result.  Bounds and values are SQL literals, which Spark converts to the key's own
type before they are ordered or compared, so their spelling (``100`` or ``'100'``) is no matter.

Rules kept from the source database:

* LIST: a key equal to a listed value goes to that partition, other keys (and NULL
  unless ``NULL`` is listed) go to the default partition; a value listed twice, in
  whatever spelling, is an error, as is one that is no value of the key's type.
* RANGE: ``[lower, upper)``; ``MINVALUE``/``MAXVALUE`` are open ends; composite keys
  compare lexicographically; a NULL key part only fits the default partition;
  overlapping or empty ranges are an error, whatever the type and the number of keys.  Strings compare by code point (the "C"
  collation); a source column with a linguistic collation may order non-ASCII text
  differently.
* HASH: the modulus is the number of sibling partitions and the remainder is the
  partition's value; there is no default partition.  The default placement uses Spark's
  ``xxhash64`` (JVM-side): every key lands in exactly one bucket, but not in the bucket
  the source database would pick; ``identity_hash`` uses an integer key as its own hash.
* A row that fits no partition is rejected (``part`` is NULL); see :func:`route_or_reject`.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterable, Sequence
from functools import total_ordering

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..specs import MAXVALUE, MINVALUE, Partition, PartitionLevel, PartitionScheme

# A hash function maps the key columns and the modulus to each row's bucket in [0, modulus).
HashFn = Callable[[list[Column], int], Column]


#: specs up to this many points are compiled to comparisons, larger ones searched in an array
TREE_POINTS = 64


def xxhash_keys(keys: list[Column], modulus: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(modulus))


def bucket_hash(keys: list[Column], modulus: int) -> Column:
    """The bucket in which a table bucketed on the keys files a row (``materialize_bucketed``)."""
    return F.pmod(F.hash(*keys), F.lit(modulus))


def identity_hash(keys: list[Column], modulus: int) -> Column:
    """Integer key as its own hash (lets a SQL oracle reproduce the placement)."""
    (k,) = keys
    return F.pmod(k.cast("bigint"), F.lit(modulus))


def split_top_level(text: str) -> list[str]:
    """Split ``a, f(b, c)`` at top-level commas (quotes and parentheses respected)."""
    parts, depth, quote, cur = [], 0, None, []
    for ch in text:
        if quote:
            cur.append(ch)
            if ch == quote:
                quote = None
            continue
        if ch in "'\"":
            quote = ch
        elif ch == "(":
            depth += 1
        elif ch == ")":
            depth -= 1
        elif ch == "," and depth == 0:
            parts.append("".join(cur).strip())
            cur = []
            continue
        cur.append(ch)
    parts.append("".join(cur).strip())
    return [p for p in parts if p]


def key_columns(key: str) -> list[Column]:
    return [F.expr(k) for k in split_top_level(key)]


def _bound_items(bound: str) -> list[str]:
    b = bound.strip()
    if b.startswith("(") and b.endswith(")") and len(split_top_level(b[1:-1])) > 1:
        return split_top_level(b[1:-1])
    return [b]


def _is_open(item: str, which: str) -> bool:
    return item.strip().upper() == which


def _is_null_literal(item: str) -> bool:
    return item.strip().upper() == "NULL"


def _lt(keys: list[Column], bound: Sequence[str], types: Sequence[T.DataType]) -> Column:
    """Lexicographic ``keys < bound``; a MAXVALUE item makes the rest irrelevant."""
    k, b = keys[0], bound[0]
    if _is_open(b, MAXVALUE):
        return F.lit(True)
    if _is_open(b, MINVALUE):
        return F.lit(False)
    lit = F.expr(_typed(b, types[0]))
    if len(keys) == 1:
        return k < lit
    return (k < lit) | ((k == lit) & _lt(keys[1:], bound[1:], types[1:]))


def validate_level(level: PartitionLevel) -> None:
    """Spec errors the source database raises when the partitions are declared."""
    defaults = [p for p in level.partitions if p.is_default]
    if len(defaults) > 1:
        raise ValueError(f"more than one default partition: {[p.name for p in defaults]}")
    if level.method == "HASH":
        if defaults:
            raise ValueError("a hash partitioned table cannot have a default partition")
        rems = [int(p.values[0]) for p in level.partitions if p.values]
        n = len(level.partitions)
        if len(set(rems)) != len(rems) or any(not 0 <= r < n for r in rems):
            raise ValueError(f"hash remainders {rems} do not fit modulus {n}")
    elif level.method == "LIST":
        seen: dict[str, str] = {}                       # other spellings need the key's type
        for p in level.partitions:
            for v in p.values or ():
                same = "NULL" if _is_null_literal(v) else v.strip()
                if same in seen:
                    raise ValueError(f"value {same} is listed in {seen[same]} and {p.name}")
                seen[same] = p.name
    else:
        for p in level.partitions:
            if not p.is_default and (not p.values or len(p.values) != 2):
                raise ValueError(f"range partition {p.name} needs a lower and an upper bound")


def _typed(literal: str, key_type: T.DataType) -> str:
    """A bound as SQL text in the key's type (a fraction rounds for an integer key)."""
    if isinstance(key_type, T.IntegralType):
        literal = f"round(CAST({literal} AS DECIMAL(38,10)))"
    return f"CAST({literal} AS {key_type.simpleString()})"


_NUMBER = re.compile(r"-?(?:0|[1-9]\d{0,17})(?:\.\d+)?")
_QUOTED = re.compile(r"'([^'\\]*)'")


def _plain(literal: str, key_type: T.DataType) -> str | None:
    """The text of a number or a quoted string without escapes, where casting that text to the
    key's type gives what casting the literal gives; else None."""
    quoted = _QUOTED.fullmatch(literal)
    if quoted:
        return quoted.group(1)
    numeric = isinstance(key_type, (T.NumericType, T.StringType))
    return literal if numeric and _NUMBER.fullmatch(literal) else None


def _literal_values(wanted: Iterable[tuple[str, T.DataType]], spark: SparkSession) -> dict[tuple[str, str], object]:
    """Values of SQL literals in the keys' types, keyed by (literal, type name); None where a
    literal is NULL or no value of the type.  Spark evaluates them, plain ones as the rows of a
    table, so that a spec of many thousand bounds is one small job."""
    wanted = {(x, t.simpleString()): t for x, t in wanted}
    out: dict[tuple[str, str], object] = {}
    for name in sorted({n for _, n in wanted}):
        t = next(t for (_, n), t in wanted.items() if n == name)
        texts = [x for x, n in wanted if n == name]
        plain = [(x, _plain(x, t)) for x in texts]
        rows = [(x, p) for x, p in plain if p is not None]
        if rows:
            value = F.round(F.col("p").try_cast("decimal(38,10)")) if isinstance(t, T.IntegralType) else F.col("p")
            found = spark.createDataFrame(rows, "x string, p string").select("x", value.try_cast(t).alias("v")).collect()
            out.update({(r["x"], name): r["v"] for r in found})
        other = [x for x, p in plain if p is None]
        if other:
            row = spark.sql("SELECT " + ", ".join(f"{_typed(x, t)} AS v{i}" for i, x in enumerate(other))).first()
            out.update({(x, name): v for x, v in zip(other, row)})
    return out


@total_ordering
class _Edge:
    """One item of a bound: MINVALUE (-1) and MAXVALUE (1) lie beyond every value (0)."""

    def __init__(self, side: int, value=None):
        self.at = (side, value) if side == 0 else (side,)

    def __eq__(self, other):
        return self.at == other.at

    def __lt__(self, other):
        return self.at < other.at if self.at[0] == other.at[0] == 0 else self.at[0] < other.at[0]

    def __hash__(self):
        return hash(self.at)


def _range_bounds(level: PartitionLevel, types: Sequence[T.DataType], spark: SparkSession) -> dict[str, tuple]:
    """Every bound text of the level as a comparable tuple of values in the keys' types.

    Spark evaluates the literals (spec-sized, one row on the driver).  After an open item the
    rest of a bound is irrelevant, so it is cut there."""
    items: dict[str, list[str]] = {}
    for p in level.partitions:
        for text in p.values or () if not p.is_default else ():
            its = _bound_items(text)
            ends = [i for i, x in enumerate(its) if _is_open(x, MINVALUE) or _is_open(x, MAXVALUE)]
            if len(its) != len(types) and not ends:
                raise ValueError(f"bound {text} needs {len(types)} values")
            items[text] = its[:ends[0] + 1] if ends else its
    wanted = {(x, i) for its in items.values() for i, x in enumerate(its)
              if not (_is_open(x, MINVALUE) or _is_open(x, MAXVALUE))}
    found = _literal_values([(x, types[i]) for x, i in wanted], spark)
    values = {(x, i): found[x, types[i].simpleString()] for x, i in wanted}
    missing = sorted(x for (x, _), v in values.items() if v is None)
    if missing:
        raise ValueError(f"bounds that are NULL or no value of the key's type: {missing}")

    def edge(x: str, i: int) -> _Edge:
        return _Edge(-1) if _is_open(x, MINVALUE) else _Edge(1) if _is_open(x, MAXVALUE) else _Edge(0, values[x, i])
    return {text: tuple(edge(x, i) for i, x in enumerate(its)) for text, its in items.items()}


def _range_tree(level: PartitionLevel, keys: list[Column], types: Sequence[T.DataType], fallback: Column,
                spark: SparkSession) -> Column:
    """Range routing over the sorted bounds: a balanced tree of ``keys < point`` tests, or for
    many bounds a bisection of their array.

    The boundary points cut the key domain into intervals; each interval belongs to at
    most one partition (ranges do not overlap) or to the fallback.  Composite keys compare
    lexicographically.
    """
    at = _range_bounds(level, types, spark)
    parts = sorted((p for p in level.partitions if not p.is_default), key=lambda p: at[p.values[0]])
    for p in parts:
        if not at[p.values[0]] < at[p.values[1]]:
            raise ValueError(f"empty range for partition {p.name}")
    for a, b in zip(parts, parts[1:]):
        if at[b.values[0]] < at[a.values[1]]:
            raise ValueError(f"partitions {a.name} and {b.name} overlap")
    spelled = {at[text]: text for p in parts for text in p.values}       # one text per point
    points = sorted(spelled)
    rank = {point: i + 1 for i, point in enumerate(points)}              # interval i starts at point i-1
    owner: list[str | None] = [None] * (len(points) + 1)
    for p in parts:
        for i in range(rank[at[p.values[0]]], rank[at[p.values[1]]]):
            owner[i] = p.name
    any_null = keys[0].isNull()
    for k in keys[1:]:
        any_null = any_null | k.isNull()
    if len(points) > TREE_POINTS and all(_searchable(t) for t in types):
        name = F.get(_array(owner, T.StringType()), _bisect(keys, points, types))
        return F.when(any_null, fallback).otherwise(F.coalesce(name, fallback))

    def tree(lo: int, hi: int) -> Column:                 # intervals lo .. hi-1
        if hi - lo == 1:
            return fallback if owner[lo] is None else F.lit(owner[lo])
        mid = (lo + hi) // 2
        bound = _bound_items(spelled[points[mid - 1]])
        return F.when(_lt(keys, bound, types), tree(lo, mid)).otherwise(tree(mid, hi))

    return F.when(any_null, fallback).otherwise(tree(0, len(points) + 1))


def _searchable(key_type: T.DataType) -> bool:
    """Types whose values survive the text of an array literal unchanged."""
    return isinstance(key_type, (T.IntegralType, T.DecimalType, T.StringType, T.DateType, T.TimestampNTZType,
                                 T.FloatType, T.DoubleType))


def _text(value) -> str | None:
    return None if value is None else repr(value) if isinstance(value, float) else str(value)


def _array(values: Sequence[str | None], element: T.DataType) -> Column:
    """An array literal of any length as one expression (folded to a constant by the optimizer)."""
    return F.from_json(F.lit(json.dumps(values)), "array<string>").cast(T.ArrayType(element))


def _bisect(keys: list[Column], points: Sequence[tuple], types: Sequence[T.DataType]) -> Column:
    """How many of the sorted points are at most the key, found by halving steps.

    Several keys compare item by item; an open item is told from a value by its side."""
    if len(keys) == 1 and all(p[0].at[0] == 0 for p in points[1:-1]):
        low = 1 if points[0][0].at[0] < 0 else 0                # MINVALUE is at most every key
        high = len(points) - (1 if points[-1][0].at[0] > 0 else 0)
        table, key = _array([_text(p[0].at[1]) for p in points[low:high]], types[0]), keys[0]
    else:
        low, high = 0, len(points)
        entries, key = [], F.struct(*[c.alias(n) for i, k in enumerate(keys)
                                      for n, c in ((f"s{i}", F.lit(0)), (f"v{i}", k))])
        for p in points:                                        # beyond an open item nothing matters
            items = [p[i].at if i < len(p) else (0,) for i in range(len(types))]
            entries.append({n: v for i, x in enumerate(items)
                            for n, v in ((f"s{i}", x[0]), (f"v{i}", _text(x[1]) if len(x) > 1 else None))})
        raw = ", ".join(f"s{i}: int, v{i}: string" for i in range(len(types)))
        fields = ", ".join(f"s{i}: int, v{i}: {t.simpleString()}" for i, t in enumerate(types))
        table = F.from_json(F.lit(json.dumps(entries)), f"array<struct<{raw}>>").cast(f"array<struct<{fields}>>")
    n = high - low
    steps = F.array(*[F.lit(1 << b) for b in range(max(n, 1).bit_length() - 1, -1, -1)])
    found = F.aggregate(steps, F.lit(0), lambda at, step: F.when(
        (at + step <= n) & (F.get(table, at + step - 1) <= key), at + step).otherwise(at))
    return found + low


def _list_lookup(level: PartitionLevel, key: Column, key_type: T.DataType, fallback: Column, spark: SparkSession) -> Column:
    """List routing by the listed values in the key's own type."""
    texts = [(v, p.name) for p in level.partitions if not p.is_default for v in p.values or () if not _is_null_literal(v)]
    found = _literal_values([(v, key_type) for v, _ in texts], spark)
    owner: dict[object, str] = {}
    for v, name in texts:
        value = found[v, key_type.simpleString()]
        if value is None:
            raise ValueError(f"value {v} of partition {name} is no value of the key's type")
        if value in owner:
            raise ValueError(f"value {v} is listed in {owner[value]} and {name}")
        owner[value] = name
    null_part = next((F.lit(p.name) for p in level.partitions for v in p.values or ()
                      if not p.is_default and _is_null_literal(v)), fallback)
    out = F.when(key.isNull(), null_part)
    if len(owner) > TREE_POINTS and _searchable(key_type):
        values = sorted(owner)
        at = _bisect([key], [(_Edge(0, v),) for v in values], [key_type]) - 1
        hit = F.get(_array([_text(v) for v in values], key_type), at) == key
        return out.when(hit, F.get(_array([owner[v] for v in values], T.StringType()), at)).otherwise(fallback)
    spelled = {found[v, key_type.simpleString()]: v for v, _ in texts}
    for p in level.partitions:
        own = [F.expr(_typed(spelled[v], key_type)) for v, name in owner.items() if name == p.name]
        if own:
            out = out.when(key.isin(*own), F.lit(p.name))
    return out.otherwise(fallback)


def level_expr(level: PartitionLevel, df: DataFrame, hash_fn: HashFn = xxhash_keys) -> Column:
    """Partition name of each row of ``df`` for one level (NULL when nothing fits)."""
    validate_level(level)
    keys = key_columns(level.key)
    default = next((p.name for p in level.partitions if p.is_default), None)
    fallback = F.lit(default) if default is not None else F.lit(None).cast("string")
    if level.method == "HASH":
        # one lookup: the partition names indexed by remainder (NULL where none is declared)
        n = len(level.partitions)
        by_remainder: list[str | None] = [None] * n
        for p in level.partitions:
            if p.values:
                by_remainder[int(p.values[0])] = p.name
        return F.get(_array(by_remainder, T.StringType()), hash_fn(keys, n).cast("int"))
    types = [f.dataType for f in df.select(*[k.alias(f"k{i}") for i, k in enumerate(keys)]).schema.fields]
    if level.method == "RANGE":
        return _range_tree(level, keys, types, fallback, df.sparkSession)
    (k,) = keys
    return _list_lookup(level, k, types[0], fallback, df.sparkSession)


def route(df: DataFrame, scheme: PartitionScheme | PartitionLevel, part: str = "part",
          subpart: str = "subpart", hash_fn: HashFn = xxhash_keys) -> DataFrame:
    """Add the partition (and, for two levels, subpartition) of every row.

    The subpartition method and key may differ per partition; a partition without a
    sub level is a leaf and its rows get ``subpart = NULL``.
    """
    if isinstance(scheme, PartitionLevel):
        scheme = PartitionScheme(scheme)
    subs = {name: lvl for name, lvl in scheme.sub.items() if lvl.partitions}
    taken = {c.lower() for c in df.columns} & ({part.lower(), subpart.lower()} if subs else {part.lower()})
    if taken:
        raise ValueError(f"the table has columns named {sorted(taken)}; choose other names for the routing columns")
    out = df.withColumn(part, level_expr(scheme.top, df, hash_fn))
    if not subs:
        return out
    sub = None
    for name, lvl in subs.items():
        e = level_expr(lvl, df, hash_fn)
        sub = F.when(F.col(part) == F.lit(name), e) if sub is None else sub.when(F.col(part) == F.lit(name), e)
    return out.withColumn(subpart, sub.otherwise(F.lit(None).cast("string")))


def route_list(df: DataFrame, key: str, partitions: Sequence[Partition], out: str = "part") -> DataFrame:
    return route(df, PartitionLevel("LIST", key, tuple(partitions)), part=out)


def route_range(df: DataFrame, key: str, partitions: Sequence[Partition], out: str = "part") -> DataFrame:
    return route(df, PartitionLevel("RANGE", key, tuple(partitions)), part=out)


def route_hash(df: DataFrame, key: str, partitions: Sequence[Partition], out: str = "part",
               hash_fn: HashFn = xxhash_keys) -> DataFrame:
    return route(df, PartitionLevel("HASH", key, tuple(partitions)), part=out, hash_fn=hash_fn)


def reject_condition(scheme: PartitionScheme, part: str = "part", subpart: str = "subpart") -> Column:
    """TRUE for rows that fit no partition (or no subpartition of a non-leaf partition)."""
    cond = F.col(part).isNull()
    with_sub = [n for n, lvl in scheme.sub.items() if lvl.partitions]
    if with_sub:
        cond = cond | (F.col(part).isin(with_sub) & F.col(subpart).isNull())
    return cond


def route_or_reject(df: DataFrame, scheme: PartitionScheme | PartitionLevel, part: str = "part",
                    subpart: str = "subpart", hash_fn: HashFn = xxhash_keys) -> tuple[DataFrame, DataFrame]:
    """``(routed, rejected)``; a default partition takes what fits nowhere else.

    The two results are separate plans over the input.  To load and fail on rejects in
    one pass use :func:`tableload.plans.materialize.materialize_partitioned`; to keep
    both sides, checkpoint the input first or accept a second scan.
    """
    if isinstance(scheme, PartitionLevel):
        scheme = PartitionScheme(scheme)
    routed = route(df, scheme, part, subpart, hash_fn)
    bad = reject_condition(scheme, part, subpart)
    return routed.filter(~bad), routed.filter(bad)


def declared_leaves(spark, scheme: PartitionScheme, part: str = "part", subpart: str = "subpart") -> DataFrame:
    """The spec's (partition, subpartition) pairs as a small DataFrame (size = spec size)."""
    return spark.createDataFrame(scheme.leaves(), f"{part} string, {subpart} string")


def partition_counts(routed: DataFrame, scheme: PartitionScheme | PartitionLevel, part: str = "part",
                     subpart: str = "subpart") -> DataFrame:
    """Rows per declared (partition, subpartition), 0 for empty ones.

    The count is a partial aggregation.  Its result has at most one row per declared
    leaf plus one for rejected rows, a bound known from the spec, so it is broadcast to
    the declared list.
    """
    if isinstance(scheme, PartitionLevel):
        scheme = PartitionScheme(scheme)
    if subpart not in routed.columns:
        routed = routed.withColumn(subpart, F.lit(None).cast("string"))
    counts = routed.groupBy(F.col(part).alias("_p"), F.col(subpart).alias("_s")).agg(F.count(F.lit(1)).alias("_n"))
    leaves = declared_leaves(routed.sparkSession, scheme, part, subpart)
    on = (F.col("_p") == F.col(part)) & F.col("_s").eqNullSafe(F.col(subpart))
    joined = leaves.join(F.broadcast(counts), on, "left")
    return joined.select(part, subpart, F.coalesce("_n", F.lit(0)).cast("bigint").alias("rows"))
