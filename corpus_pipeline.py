"""Training-data pipeline: five stages over ``documents``, each written and read again.

Toxic documents go, recurring template lines go, of each group of near duplicates one document
stays, secrets are replaced, and what is left is packed into sequences. Every stage gets all rows
that the one before kept and returns the columns of ``documents``; the last returns pieces.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.functions.storage import materialise
from shelfwise.llm import line_templates, packing, secret_forest, simhash, toxicity
from shelfwise.llm.queries import TOKENIZER, table


def measured(docs: DataFrame) -> DataFrame:
    """``n_chars``, where the table has it, as the new text's length."""
    if "n_chars" not in docs.columns:
        return docs
    length = F.length("text").cast(docs.schema["n_chars"].dataType)
    return docs.withColumn("n_chars", F.coalesce(length, F.col("n_chars")))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text isn't predicted to be toxic, by the labels in ``sf_dir``."""
    scored = toxicity.score_documents(docs, table(spark, sf_dir, "labels"))
    rejected = materialise(scored.where("predicted = 1").select(
        F.col("text_key").alias("key")).distinct())
    rows = docs.select(F.struct(*docs.columns).alias("row"),
                       F.xxhash64(F.col("text").cast("string")).alias("key"))
    return rows.join(rejected, "key", "left_anti").select(
        *[F.col("row")[c].alias(c) for c in docs.columns])


def drop_template_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, without the lines whose template recurs."""
    return measured(line_templates.drop_template_lines(docs).select(*docs.columns))


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component of near duplicates."""
    return simhash.keep_first(docs)


def replace_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, with a mark in place of each secret."""
    return measured(secret_forest.redact(docs, secret_forest.scan_secrets(docs)))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their places in sequences of 1024 tokens."""
    return packing.pack_documents(docs, TOKENIZER)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_template_lines),
    ("simhash_dedup", keep_one_of_near_duplicates),
    ("secrets", replace_secrets),
    ("packing", pack_sequences),
]

#: SQL can express neither the votes, the fingerprints nor the token ids.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder of tables."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir))
    return docs
