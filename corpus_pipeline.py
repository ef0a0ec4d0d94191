"""Corpus preparation: five stages from raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; :func:`run` writes each result
and reads it again as the next stage's documents. All stages but the last keep the columns of
``documents``; ``n_chars`` follows the text. The key of the surrogates is CORPUS_KEY.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ventis.llm import language_id, line_dedup, packing, pii, simhash_dedup
from ventis.llm.queries import CORPUS_KEY, WORD_TOKENIZER
from ventis.session import materialize


# A text is rejected if no language has this posterior: it reads like several. Texts of a dozen
# letters or more have a posterior near 1, so clean documents stay.
MIN_POSTERIOR = 0.5


# Rows that travel to a Python worker at once: texts are long, and every task holds a batch twice.
BATCH_ROWS = 1000


def _small_batches(spark: SparkSession) -> None:
    """Bound the session's Arrow batches; a smaller setting stays."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def _with_length(docs: DataFrame) -> DataFrame:
    """``n_chars`` as the length of the text, where both are known."""
    return docs.withColumn("n_chars", F.when(
        F.col("text").isNotNull(), F.length("text").cast("long")).otherwise(F.col("n_chars")))


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told.

    Texts that are null or without a letter go, and those whose best language has a posterior
    below MIN_POSTERIOR. A missing label is filled with the prediction; given labels stay. Where
    no document has a label there is nothing to learn from, and all documents stay as they are.
    """
    _small_batches(spark)
    model = language_id.train(docs)
    if not model.languages:
        return docs
    told = (F.col("lang_pred") != language_id.UNDETERMINED) & (F.col("score") >= MIN_POSTERIOR)
    columns = [F.coalesce("lang", "lang_pred").alias(c) if c == "lang" else F.col(c)
               for c in docs.columns]
    return language_id.predict(docs, model).filter(told).select(*columns)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that a later document keeps; a null text becomes empty."""
    _small_batches(spark)
    return _with_length(line_dedup.dedup_lines(docs)).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each component of near-duplicates: SimHash of
    4-word shingles, linked at up to 4 differing bits. Texts without words are copies of each
    other; rows without an id stay."""
    _small_batches(spark)
    return simhash_dedup.drop_near_duplicates(docs).select(*docs.columns)


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with surrogates for personal data."""
    return _with_length(pii.replace_entities(docs, CORPUS_KEY)).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's pieces with their place in the training sequences."""
    _small_batches(spark)
    return packing.pack_documents(docs, WORD_TOKENIZER)


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", dedup_lines),
    ("simhash_dedup", drop_near_duplicates),
    ("pii", replace_personal_data),
    ("packing", pack_sequences),
]

# Model scores, perfect-hash groups and tokenizer ids cannot be stated in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
