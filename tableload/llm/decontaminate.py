"""Benchmark passages in training text, found by winnowing.

Both sides are cut into words; the hashes of five-word grams are winnowed: of every six
neighbouring grams (ten words) the smallest hash is kept.  Equal ten-word windows keep equal
hashes, so joining the kept hashes meets every window that both sides share.  The windows
met are then compared word for word and extended to whole shared spans.  An item of fewer
than ten words is one window of its own length, fingerprinted by the hash of all its words.
Built-in functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut_lineage

WINDOW = 10
GRAM = 5
#: words end at any ASCII character that is no letter or digit
BREAKS = "[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: a table is broadcast only up to this many rows and bytes of content
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 << 20


def _text_key(text: Column) -> Column:
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def raw_words(text: Column) -> Column:
    """The words of a text as written; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BREAKS), "")


def exact_words(words: Column) -> Column:
    """Words with A-Z as a-z and nothing else changed."""
    return F.transform(words, lambda w: F.translate(w, UPPER, LOWER))


def _gram(hashes: Column, at: Column, size: int) -> Column:
    return F.xxhash64(F.lit(size), *[F.get(hashes, at + k) for k in range(size)])


def winnowed(df: DataFrame, words: str, window: int, gram: int, out: str, keep: list[str]) -> DataFrame:
    """``keep`` plus ``out``: for every start of a ``window`` of words, the smallest hash of
    the ``gram``-word grams in it (empty if there are fewer words)."""
    # lower() may change more letters than A-Z: what is equal for the exact words stays equal
    df = df.select(*keep, F.transform(words, lambda w: F.xxhash64(F.lower(w))).alias("_hash"))
    df = df.select(*keep, F.when(F.size("_hash") >= window, F.transform(
        F.sequence(F.lit(0), F.size("_hash") - gram), lambda i: _gram(F.col("_hash"), i, gram)))
        .otherwise(F.array().cast("array<bigint>")).alias("_gram"))
    if window == gram:
        return df.select(*keep, F.col("_gram").alias(out))
    span = window - gram + 1
    return df.select(*keep, F.when(F.size("_gram") > 0, F.transform(
        F.sequence(F.lit(0), F.size("_gram") - span),
        lambda i: F.least(*[F.get(F.col("_gram"), i + k) for k in range(span)])))
        .otherwise(F.array().cast("array<bigint>")).alias(out))


def _sized(df: DataFrame, *wide: str) -> DataFrame:
    """A written table with a broadcast hint if it is small: its rows, and the bytes of its
    ``wide`` columns, are counted first.  Beyond the bound the join shuffles."""
    size = F.lit(0).cast("long")
    for c in wide:
        size = size + F.size(c) * 8 if df.schema[c].dataType.typeName() == "array" else size + F.octet_length(c)
    rows, content = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(size), F.lit(0))).first()
    return F.broadcast(df) if rows <= BROADCAST_ROWS and content <= BROADCAST_BYTES else df


def item_windows(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item, span, length): the different windows of every item, as words joined by spaces."""
    df = items.select(F.col(id_col).cast("string").alias("item"), raw_words(F.col(text_col)).alias("_raw"))
    df = df.select("item", exact_words(F.col("_raw")).alias("_words"))
    at = F.when(F.size("_words") >= WINDOW, F.sequence(F.lit(1), F.size("_words") - (WINDOW - 1))) \
        .when(F.size("_words") > 0, F.array(F.lit(1))).otherwise(F.array().cast("array<int>"))
    length = F.least(F.lit(WINDOW), F.size("_words"))
    spans = df.select("item", length.alias("length"), F.explode_outer(F.transform(
        at, lambda i: F.array_join(F.slice(F.col("_words"), i, length), " "))).alias("span"))
    return spans.where("span IS NOT NULL").select("item", "span", "length").distinct()


def fingerprints(df: DataFrame, words: str, keep: list[str], lengths: list[int], whole: bool = False) -> DataFrame:
    """``keep``, start (from 0), length, print: one row per window of ``WINDOW`` words, and of
    each of the shorter ``lengths`` (``whole``: only of texts that have exactly that length)."""
    # the outer form: for the inner one the optimizer tests the array below all these projections
    out = winnowed(df, words, WINDOW, GRAM, "_prints", keep) \
        .select(*keep, F.lit(WINDOW).alias("length"), F.posexplode_outer("_prints").alias("start", "print"))
    for n in lengths:
        some = df.where(F.size(words) == n) if whole else df
        out = out.unionByName(winnowed(some, words, n, n, "_prints", keep)
                              .select(*keep, F.lit(n).alias("length"), F.posexplode_outer("_prints").alias("start", "print")))
    return out


def shared_spans(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id",
                 item_text: str = "text") -> DataFrame:
    """(key, n_hit, spans, items) of every different text (``key``: its 128-bit digest) that
    holds a window of an item: its words in such windows, the maximal runs of them
    (start word, words) and the ids of the items, sorted as strings."""
    own = cut_lineage(item_windows(items, item_id, item_text))
    lengths = sorted(r[0] for r in own.select("length").distinct().collect() if r[0] < WINDOW)      # at most nine
    worded = items.select(raw_words(F.col(item_text)).alias("_raw"))
    prints = cut_lineage(fingerprints(worded, "_raw", [], lengths, whole=True)
                         .where("print IS NOT NULL").select("length", "print").distinct())
    spans = cut_lineage(own.select("span", "length").distinct())

    key = _text_key(F.col(text_col)).alias("key")
    met = fingerprints(docs.select(key, raw_words(F.col(text_col)).alias("_raw")), "_raw", ["key"], lengths) \
        .join(_sized(prints), ["length", "print"], "left_semi")
    met = cut_lineage(met.groupBy("key").agg(F.collect_set(F.struct("start", "length")).alias("at")))   # by text: bounded
    # each text once, its windows word for word
    texts = docs.select(key, F.col(text_col).alias("_text")).join(_sized(met, "at"), "key").dropDuplicates(["key"])
    texts = texts.select("key", "at", raw_words(F.col("_text")).alias("_raw"))
    texts = texts.select("key", "at", exact_words(F.col("_raw")).alias("_words"))
    window = F.transform("at", lambda a: F.struct(
        a["start"].alias("start"), a["length"].alias("length"),
        F.when(F.size("_words") > 0, F.array_join(F.slice(F.col("_words"), a["start"] + 1, a["length"]), " ")).alias("span")))
    hits = texts.select("key", F.explode_outer(window).alias("w")).select("key", "w.start", "w.length", "w.span") \
        .join(_sized(spans, "span"), ["span", "length"], "left_semi")
    hits = cut_lineage(hits)

    before = Window.partitionBy("key").orderBy("start", "length")
    end = F.max(F.col("start") + F.col("length")).over(before.rowsBetween(Window.unboundedPreceding, -1))
    runs = hits.withColumn("new", F.when(F.col("start") <= end, 0).otherwise(1)) \
        .withColumn("run", F.sum("new").over(before.rowsBetween(Window.unboundedPreceding, 0))) \
        .groupBy("key", "run").agg(F.min("start").alias("start"), F.max(F.col("start") + F.col("length")).alias("end"))
    runs = runs.groupBy("key").agg(
        F.sum(F.col("end") - F.col("start")).cast("long").alias("n_hit"),
        F.sort_array(F.collect_list(F.struct("start", (F.col("end") - F.col("start")).alias("words")))).alias("spans"))
    named = hits.select("key", "span").distinct().join(_sized(own, "item", "span"), "span").where("item IS NOT NULL") \
        .groupBy("key").agg(F.sort_array(F.collect_set("item")).alias("items"))
    return runs.join(named, "key", "left") \
        .select("key", "n_hit", "spans", F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def contamination(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id",
                  item_text: str = "text") -> DataFrame:
    """Each row (struct ``_row``) with n_words, n_hit (words inside a window of an item),
    spans (their runs: start word from 0, words), items (ids of the items met, sorted as
    strings) and contaminated.

    Defined results: null and empty texts have no words and are never hit; an item without
    words has no window; a null item id marks words but is not listed; items that repeat an
    id count as one; repeated documents get equal results; no items or no documents give
    zeros or an empty table; other columns of the documents live in ``_row``, other columns
    of the items are not read.  Work is done once per different text.
    """
    found = cut_lineage(shared_spans(docs, items, text_col, item_id, item_text))
    seen = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
                       _text_key(F.col(text_col)).alias("_key"),
                       F.size(raw_words(F.col(text_col))).cast("long").alias("n_words"))
    none = F.array().cast("array<string>")
    out = seen.join(_sized(found, "spans", "items"), F.col("_key") == F.col("key"), "left")
    return out.select("_row", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                      F.coalesce("spans", F.array().cast("array<struct<start:int,words:int>>")).alias("spans"),
                      F.coalesce("items", none).alias("items"),
                      (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"))


def clean(docs: DataFrame, items: DataFrame, **columns) -> DataFrame:
    """The documents (all columns) that share no window with an item."""
    return contamination(docs, items, **columns).where("NOT contaminated") \
        .select(*[F.col(f"_row.`{c}`").alias(c) for c in docs.columns])
