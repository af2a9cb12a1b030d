"""Corpus preparation in stages, each applying one operator of the ``llm`` subpackage.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet
and read back as the next stage's documents.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tableload.llm import lattice, mixing, pieces, pii, quality_rules, simhash
from tableload.session import scratch_path

#: the public tokenizer's model, and the secret of the pseudonyms (a stand-in here)
PIECE_MODEL = os.environ.get("TABLELOAD_PIECE_MODEL", "/opt/tokenizers/piece_bpe_32k.model")
PSEUDONYM_KEY = os.environ.get("TABLELOAD_PSEUDONYM_KEY", "key of the registered pipeline")


def _counted(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in docs.columns else docs


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality rules: rejected documents go, boilerplate lines leave the others."""
    return _counted(quality_rules.clean(docs))


def keep_one_copy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-dedup: one document of each group stays (3-word shingles, 2 bits)."""
    return simhash.keep_one_of_each(docs, shingle=3, max_distance=2)


def hide_private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """PII: numbers, dates, addresses and keys become pseudonyms of the same format."""
    found = pii.pseudonymise(docs, PSEUDONYM_KEY)
    return _counted(found.select(*[F.col("text") if c == "text" else F.col(f"_row.`{c}`").alias(c) for c in docs.columns]))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing to target weights: one row per draw, in training order."""
    return mixing.training_order(docs)


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SentencePiece ids of every draw, and the digest of the text they decode to."""
    model = pieces.read_model(PIECE_MODEL)
    coded = lattice.encode(docs, model, decoded_col="decoded")
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.col("ids").alias("token_ids"),
                        F.md5("decoded").alias("decoded_md5"))


STAGES = [("quality_rules", keep_good), ("simhash_dedup", keep_one_copy), ("pseudonyms", hide_private),
          ("source_mixing", mix_sources), ("sentencepiece", to_tokens)]

#: hashes (XXH64) and keyed digests decide in several stages, which the SQL side cannot compute
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared scratch folder and read back."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
