"""Quality rules with cross-document line frequency.

Within a document: word counts, symbols, repeated lines, repeated eight-word windows.  Across
documents: every line is normalised and hashed, the different texts that hold it are counted
per host, lines above the limit count as boilerplate and are removed, and a document that
loses too much is rejected.  Built-in functions only.

Copies of one text count once in a line's frequency (they are the business of
deduplication), so a clean document is not rejected for having copies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE_RUN, SPACES, cut_lineage, words_of

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
SYMBOLS = "#*$%&|<>"
#: a line is boilerplate if more different texts of its host hold it than the first bound, and
#: than the share of the host's texts or the last bound, whichever is less: the limit of a host
#: never grows beyond the last
MIN_LINE_DOCS = 20
MAX_LINE_SHARE = 0.1
MAX_LINE_DOCS = 1000
#: a document is depleted if fewer words than this share (or MIN_WORDS) are left
MIN_LEFT_SHARE = 0.5


def _has_word(line: Column) -> Column:
    return F.btrim(line, F.lit(SPACES)) != ""


def normalised_line(line: Column) -> Column:
    """Lower case, digits as 0, white space runs as one space, trimmed."""
    return F.btrim(F.regexp_replace(F.regexp_replace(F.lower(line), "[0-9]", "0"), SPACE_RUN, " "))


def line_hash(line: Column) -> Column:
    return F.xxhash64(normalised_line(line))


def text_key(text: Column) -> Column:
    """128-bit key of a text (null counts as empty)."""
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def measures(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` as the struct column ``_row`` plus n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words and base_failed.  Null texts count as empty."""
    df = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
                     F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    df = df.select("_row", "_text", words_of(F.col("_text")).alias("_words"),
                   F.filter(F.split("_text", "\n", -1), _has_word).alias("_lines"))
    # hash of every window of eight words; equal hashes are repeats
    word = lambda i: F.get(F.col("_words"), i)
    df = df.select("_row", "_text", "_words", "_lines", F.when(
        F.size("_words") >= WINDOW,
        F.transform(F.sequence(F.lit(0), F.size("_words") - WINDOW),
                    lambda i: F.xxhash64(*[word(i + k) for k in range(WINDOW)])))
        .otherwise(F.array().cast("array<bigint>")).alias("_grams"))
    df = df.select("_row", "_text", F.size("_words").cast("long").alias("n_words"), "_lines", F.when(
        F.size(F.array_distinct("_grams")) < F.size("_grams"),
        F.sort_array(F.transform("_grams", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
        .otherwise(F.array().cast("array<struct<h:bigint,i:int>>")).alias("_sorted"))
    # in hash order, a window that equals a neighbour is found twice or more
    entry = lambda k: F.get(F.col("_sorted"), k)
    df = df.select("_row", "_text", "n_words", "_lines", F.when(
        F.size("_sorted") > 0,
        F.sort_array(F.transform(
            F.filter(F.sequence(F.lit(0), F.size("_sorted") - 1),
                     lambda k: F.coalesce(entry(k)["h"] == entry(k - 1)["h"], F.lit(False))
                     | F.coalesce(entry(k)["h"] == entry(k + 1)["h"], F.lit(False))),
            lambda k: entry(k)["i"])))
        .otherwise(F.array().cast("array<int>")).alias("_at"))
    covered = F.when(F.size("_at") > 0, F.aggregate(
        F.sequence(F.lit(0), F.size("_at") - 1), F.lit(0).cast("long"),
        lambda acc, k: acc + F.least(F.lit(WINDOW), F.coalesce(
            F.get(F.col("_at"), k + 1) - F.get(F.col("_at"), k), F.lit(WINDOW))))).otherwise(F.lit(0).cast("long"))
    df = df.select(
        "_row", "_text", "n_words",
        F.length(F.translate("_text", SPACES, "")).cast("long").alias("word_chars"),
        (F.length("_text") - F.length(F.translate("_text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        covered.alias("n_repeat_words"))
    return df.withColumn("base_failed", (F.col("n_words") < MIN_WORDS)
                         | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))


def line_counts(docs: DataFrame, text_col: str = "text", host_col: str = "source") -> DataFrame:
    """(host, line, key, times, words): how often each different text (``key``) of a host
    holds a normalised line.  The row with a null line counts the copies of the text."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    line_words = lambda x: F.size(words_of(x)).cast("long")
    found = docs.select(F.col(host_col).alias("host"), text_key(F.col(text_col)).alias("key"),
                        F.transform(F.filter(F.split(text, "\n", -1), _has_word),
                                    lambda x: F.struct(line_hash(x).alias("line"), line_words(x).alias("words")))
                        .alias("lines"))
    copy = F.array(F.struct(F.lit(None).cast("bigint").alias("line"), F.lit(0).cast("long").alias("words")))
    return found.select("host", "key", F.explode(F.concat(copy, "lines")).alias("x")) \
        .groupBy("host", F.col("x.line").alias("line"), "key") \
        .agg(F.count(F.lit(1)).alias("times"), F.max("x.words").alias("words"))


def frequent_lines(counts: DataFrame, min_docs: int = MIN_LINE_DOCS, max_share: float = MAX_LINE_SHARE,
                   max_docs: int = MAX_LINE_DOCS) -> DataFrame:
    """(host, line) of the lines that too many different texts of their host hold."""
    docs_with = counts.groupBy("host", "line").agg(F.count(F.lit(1)).alias("docs"))
    hosts = docs_with.where("line IS NULL").select(F.col("host").alias("_host"), F.col("docs").alias("all_docs"))
    return docs_with.where("line IS NOT NULL").where(F.col("docs") > min_docs) \
        .join(hosts, F.col("host").eqNullSafe(F.col("_host"))) \
        .where(F.col("docs") > F.least(max_share * F.col("all_docs"), F.lit(float(max_docs)))).select("host", "line")


def removed_words(counts: DataFrame, lines: DataFrame) -> DataFrame:
    """(host, key, removed, removed_lines) for the texts that lose at least one line."""
    hit = counts.where("line IS NOT NULL").join(
        lines.select(F.col("host").alias("_host"), F.col("line").alias("_line")),
        F.col("host").eqNullSafe(F.col("_host")) & (F.col("line") == F.col("_line")), "left_semi")
    copies = counts.where("line IS NULL").select(F.col("host").alias("_host"), F.col("key").alias("_key"),
                                                 F.col("times").alias("copies"))
    return hit.groupBy("host", "key").agg(F.sum(F.col("times") * F.col("words")).alias("all_removed"),
                                          F.collect_set("line").alias("removed_lines")) \
        .join(copies, F.col("host").eqNullSafe(F.col("_host")) & (F.col("key") == F.col("_key"))) \
        .select("host", "key", (F.col("all_removed") / F.col("copies")).cast("long").alias("removed"), "removed_lines")


def judge(docs: DataFrame, text_col: str = "text", host_col: str = "source", min_docs: int = MIN_LINE_DOCS,
          max_share: float = MAX_LINE_SHARE, max_docs: int = MAX_LINE_DOCS,
          min_left: float = MIN_LEFT_SHARE) -> DataFrame:
    """Each row (struct ``_row``) with its measures, ``n_removed_words`` (in boilerplate
    lines), ``removed_lines`` (their hashes) and ``kept``.

    Defined results: a null text is an empty one (fails the base rules); a null host is a
    host of its own; repeated rows get equal verdicts; lines of white space only are no
    lines; an empty table gives an empty result; input columns live in ``_row`` and cannot
    clash.
    """
    counts = cut_lineage(line_counts(docs, text_col, host_col))      # read three times
    lost = removed_words(counts, frequent_lines(counts, min_docs, max_share, max_docs))
    seen = measures(docs, text_col).withColumns({
        "_host": F.col(f"_row.`{host_col}`"), "_key": text_key(F.col("_text"))}).drop("_text")
    out = seen.join(lost, F.col("_host").eqNullSafe(F.col("host")) & (F.col("_key") == F.col("key")), "left")
    left = F.col("n_words") - F.coalesce("removed", F.lit(0))
    depleted = (left < MIN_WORDS) | (left < min_left * F.col("n_words"))
    return out.select("_row", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                      F.coalesce("removed", F.lit(0)).cast("long").alias("n_removed_words"), "removed_lines",
                      # one comparison over both sides: a filter on it stays above the join, so that the
                      # measures are not computed again inside the condition
                      (F.least(F.when(F.col("base_failed"), 0).otherwise(1), F.when(depleted, 0).otherwise(1)) == 1)
                      .alias("kept"))


def clean(docs: DataFrame, text_col: str = "text", host_col: str = "source", **limits) -> DataFrame:
    """The kept documents (all columns), their boilerplate lines removed from the text."""
    ok = judge(docs, text_col, host_col, **limits).where("kept")
    text = F.col(f"_row.`{text_col}`")
    rest = F.array_join(F.filter(F.split(text, "\n", -1),
                                 lambda x: ~F.array_contains("removed_lines", line_hash(x)) | ~_has_word(x)), "\n")
    changed = F.when(F.col("removed_lines").isNull(), text).otherwise(rest)
    return ok.select(*[changed.alias(c) if c == text_col else F.col(f"_row.`{c}`").alias(c) for c in docs.columns])
