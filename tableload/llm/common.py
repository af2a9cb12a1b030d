"""Small helpers shared by the text operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint_root

#: a word is a maximal run of characters other than space and U+0009 to U+000D
SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = "[\\x20\\x09-\\x0D]+"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it from there."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def words_of(text: Column) -> Column:
    """Array of the words of a text; empty for null, empty and blank texts."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE_RUN))


def with_row(df: DataFrame, name: str = "_row") -> DataFrame:
    """The input as one struct column, so that no input column can clash with a computed one."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(name))
