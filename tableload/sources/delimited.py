"""Read files in the PostgreSQL ``COPY`` text format.

Format: one row per line, fields separated by a tab, ``\\N`` is NULL, an empty field is
an empty string, and a backslash starts an escape (``\\\\``, ``\\t``, ``\\n``, ``\\r``,
``\\b``, ``\\f``, ``\\v``; ``\\101`` and ``\\x41`` are bytes of the UTF-8 text, octal and hex; a
backslash before any other character, a line break included, stands for that character).  The
line ``\\.`` ends a file's data: it is no row, and nothing after it is read.  Spark's CSV
reader cannot be used: it turns empty fields into NULL and leaves escapes undecoded.

A backslash before a line break makes a record span lines, which may lie in different splits
of a file.  Whether a file has such lines, or lines after the end marker, is found by a
first scan (``plain=True`` says that no file has, and saves it); only those files take the
longer way: their lines are joined within each split, and the two ends of every split are
then joined over the file.

The whole decode is a chain of built-in string expressions, evaluated per row inside
whole-stage codegen; files are split across tasks by the text reader as usual.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from ..specs import ColumnSpec, ordered
from ..operators.project import cast_checked

# Escape letters of the text format and the characters they stand for.
ESCAPES = (("t", "\t"), ("n", "\n"), ("r", "\r"), ("b", "\b"), ("f", "\f"), ("v", "\v"))
NULL_MARKER = "\\N"
END_MARKER = "\\."
_HOLD = "\u0000"   # text values cannot contain NUL, so it can stand in for an escaped backslash


_TOKEN = r"(?s)\\x[0-9A-Fa-f]{1,2}|\\[0-7]{1,3}|\\.|\\|[^\\]+"
_BYTE_ESCAPE = r"\\(x[0-9A-Fa-f]|[0-7])"


def _token_bytes(token: Column) -> Column:
    """Hex digits of the bytes one token (an escape, or text without a backslash) stands for."""
    octal = F.conv(F.substring(token, 2, 3), 8, 10).cast("int").bitwiseAND(255)
    out = F.when(~token.startswith("\\") | (token == "\\"), F.hex(token)) \
        .when(token.rlike(r"^\\x[0-9A-Fa-f]"), F.lpad(F.substring(token, 3, 2), 2, "0")) \
        .when(token.rlike(r"^\\[0-7]"), F.lpad(F.hex(octal), 2, "0"))
    for letter, char in ESCAPES:
        out = out.when(token == "\\" + letter, F.lit(f"{ord(char):02X}"))
    return out.otherwise(F.hex(F.substring(token, 2, 2)))


def _decode_bytes(raw: Column) -> Column:
    """Decode a field with byte escapes; bytes that are no UTF-8 text fail the job."""
    tokens = F.regexp_extract_all(raw, F.lit(_TOKEN), F.lit(0))
    return F.validate_utf8(F.unhex(F.array_join(F.transform(tokens, _token_bytes), "")).cast("string"))


def decode_text_field(raw: Column) -> Column:
    """Decode one raw field; ``\\N`` becomes NULL, an empty field stays ``''``.

    Only fields that contain a backslash go through the replacement chain.
    """
    v = F.replace(raw, F.lit("\\\\"), F.lit(_HOLD))
    for letter, char in ESCAPES:
        v = F.replace(v, F.lit("\\" + letter), F.lit(char))
    # any other backslash escapes the next character; after the known escapes this is
    # rare, so the regular expression only runs where a backslash is left
    v = F.when(F.instr(v, "\\") > 0, F.regexp_replace(v, r"(?s)\\(.)", "$1")).otherwise(v)
    v = F.replace(v, F.lit(_HOLD), F.lit("\\"))
    return (F.when(F.instr(raw, "\\") == 0, raw)                 # most fields: no regular expression runs
            .when(raw == F.lit(NULL_MARKER), F.lit(None).cast("string"))
            .when(raw.rlike(_BYTE_ESCAPE), _decode_bytes(raw))
            .otherwise(v))


_SPECIAL = "[\\\\" + "".join(c for _, c in ESCAPES) + "]"


def encode_text_field(value: Column) -> Column:
    """Inverse of :func:`decode_text_field` (used to write the format from Spark).

    Only values that contain a backslash or a control character are rewritten.
    """
    text = value.cast("string")
    v = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for letter, char in ESCAPES:
        v = F.replace(v, F.lit(char), F.lit("\\" + letter))
    return F.coalesce(F.when(text.rlike(_SPECIAL), v).otherwise(text), F.lit(NULL_MARKER))


def to_text_lines(df: DataFrame) -> DataFrame:
    """One ``value`` column holding each row in the text format (for ``write.text``)."""
    return df.select(F.concat_ws("\t", *[encode_text_field(F.col(f"`{c}`")) for c in df.columns]).alias("value"))


def _open(line: Column) -> Column:
    """TRUE for a line that ends in a backslash which no other one escapes."""
    return line.endswith("\\") & (F.length(F.regexp_extract(line, r"(\\+)$", 1)) % 2 == 1)


def _placed_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines with their place: file, start of the split, number within the scan's task."""
    return spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("nr"))


def _joined(lines: DataFrame) -> DataFrame:
    """The records of lines (value, file, block, nr, open), lines joined by line breaks."""
    in_split = Window.partitionBy("file", "block").orderBy("nr")
    ended = F.sum(F.when(F.col("open"), 0).otherwise(1)).over(in_split.rowsBetween(Window.unboundedPreceding, -1))
    numbered = lines.withColumn("rec", F.coalesce(ended, F.lit(0)))
    parts = F.transform(F.sort_array(F.collect_list(F.struct("nr", "value"))), lambda x: x["value"])
    records = numbered.groupBy("file", "block", "rec").agg(
        F.array_join(parts, "\n").alias("value"), F.max(F.when(F.col("open"), 0).otherwise(1)).alias("shut"))
    # a split's first record may go on from the split before, an open one goes on in the next:
    # at most two records of a split
    edge = (F.col("rec") == 0) | (F.col("shut") == 0)
    along = Window.partitionBy("file").orderBy("block", "rec")
    ends = records.filter(edge).withColumn("starts", F.lag("shut", 1, 1).over(along)) \
        .withColumn("chain", F.sum("starts").over(along.rowsBetween(Window.unboundedPreceding, 0))) \
        .groupBy("file", "chain").agg(F.sort_array(F.collect_list(F.struct("block", "rec", "value"))).alias("pieces")) \
        .select(F.array_join(F.transform("pieces", lambda x: x["value"]), "\n").alias("value"))
    return records.filter(~edge).select(F.when(~edge, F.col("value")).alias("value")).unionByName(ends)


def text_lines(spark: SparkSession, path: str | list[str], plain: bool = False) -> DataFrame:
    """The records of text-format files, one ``value`` each, up to every file's end marker."""
    if plain:
        return spark.read.text(path).filter(F.col("value") != END_MARKER)
    lines = _placed_lines(spark, path).withColumn("open", _open(F.col("value")))
    at = F.struct("block", "nr")
    special = lines.groupBy("file").agg(
        F.min(F.when(F.col("value") == END_MARKER, at)).alias("end"), F.max(at).alias("last"),
        F.count_if("open").alias("opened"))
    special = special.filter((F.col("opened") > 0) | (F.col("end") < F.col("last"))).select("file", "end", "opened")
    kept = scratch_path(spark, "textfiles")
    special.write.parquet(kept)                          # one row per file off the plain path
    special = spark.read.schema(special.schema).parquet(kept)
    if special.isEmpty():
        return spark.read.text(path).filter(F.col("value") != END_MARKER)
    found = lines.join(special.withColumnRenamed("file", "_file"), F.col("file") == F.col("_file"), "left") \
        .filter((F.col("value") != END_MARKER) & (F.col("end").isNull() | (at < F.col("end"))))
    joined = _joined(found.filter(F.col("opened") > 0).select("value", "file", "block", "nr", "open"))
    whole = F.coalesce(F.col("opened"), F.lit(0)) == 0
    # a filter of the caller may be evaluated before the ones here: rows of the other branch are
    # NULL to it
    return found.filter(whole).select(F.when(whole, F.col("value")).alias("value")).unionByName(joined)


def text_records(spark: SparkSession, path: str | list[str], names: list[str],
                 plain: bool = False) -> tuple[DataFrame, Column, Column]:
    """(records, width_ok, line): the decoded fields under ``names``, and as columns of
    ``records`` whether a record has that many fields, and its raw text."""
    lines = text_lines(spark, path, plain)
    fields = lines.select(F.col("value").alias("_line"), F.split(F.col("value"), "\t", -1).alias("_f"))
    decoded = [decode_text_field(F.get(F.col("_f"), i)).alias(n) for i, n in enumerate(names)]
    return fields.select("_line", F.size("_f").alias("_width"), *decoded), F.col("_width") == len(names), F.col("_line")


def scan_delimited(spark: SparkSession, path: str | list[str], columns: list[ColumnSpec],
                   on_error: str = "fail", plain: bool = False):
    """Read text-format files into the declared columns.

    ``on_error="fail"``: a record with the wrong number of fields or a value that does not
    convert fails the scan.  ``"quarantine"``: returns ``(good, rejected)`` as
    :func:`cast_checked` does; records with a wrong field count are rejected with
    ``error_column = '<line>'`` (``plans.incremental.load_delimited`` writes both sides in one
    pass).  ``plain=True``: no record spans lines and nothing follows an end marker.
    """
    cols = ordered(columns)
    names = [c.name for c in cols]
    n = len(cols)
    records, width_ok, line = text_records(spark, path, names, plain)
    if on_error == "fail":
        # A filter (unlike a projected flag column) cannot be pruned away by Catalyst.
        raw = records.filter(
            F.when(width_ok | line.isNull(), F.lit(True)).otherwise(
                F.raise_error(F.concat(F.lit(f"expected {n} fields in line: "), line)))
        ).select(*[F.col(f"`{c}`") for c in names])
        return cast_checked(raw, [(c.name, c.type_name) for c in cols], on_error="fail")
    bad_width = records.filter(~width_ok).select(
        *[F.lit(None).cast("string").alias(c) for c in names],
        F.lit("<line>").alias("error_column"), line.alias("error_value"),
        F.lit(f"{n} fields").alias("error_type"))
    raw = records.filter(width_ok).select(*[F.col(f"`{c}`") for c in names])
    good, rejected = cast_checked(raw, [(c.name, c.type_name) for c in cols], on_error="quarantine")
    return good, rejected.unionByName(bad_width)
