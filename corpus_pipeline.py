"""From raw documents to token ids: five stages, each one operator of ``tidemark.llm``.

Each stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept; between
stages the documents are written as Parquet and read again.  All but the last return the columns
of ``documents``; extra columns are passed on, and a column that a stage needs must be there.
Nulls, empty and long texts, repeated rows and empty tables are treated as the operators say.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, line_dedup, ngram_join, quality_classifier, source_mix
from tidemark.llm.common import small_batches, stored
from tidemark.session import apply_defaults

TOKENIZER = "byte_bpe_50k.json"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the classifier rejects; it learns from the labelled rows."""
    model = quality_classifier.fit(docs, small_batches(spark).read.parquet(f"{sf_dir}/labels.parquet"))
    return quality_classifier.accepted(docs, model)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes later repeats of three-line windows; ``n_chars`` is that of the new text."""
    shorter = line_dedup.line_dedup(docs).drop("n_lines", "n_removed")
    return shorter.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near duplicates: 0.8 or more of their five-word shingles."""
    small_batches(spark)
    return ngram_join.one_of_each(docs, width=5, similarity=(4, 5))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes each document as often as the target weights of its source ask for."""
    return source_mix.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document of the mix, and the digest of the text they decode to."""
    small_batches(spark)
    path = public_tokenizers.path(TOKENIZER)
    return bpe.encode(docs, path, decoded=True).select("doc_id", "n_tokens", "ids", bpe.digest(F.col("decoded")).alias("decoded_sha256"))


STAGES = [
    ("quality classifier", quality),
    ("line dedup", lines),
    ("n-gram join", near_duplicates),
    ("source mix", mix),
    ("bpe", encode),
]

#: Learned scores and drawn blocks have no SQL; tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = apply_defaults(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
