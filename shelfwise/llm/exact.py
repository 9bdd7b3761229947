"""Exact deduplication by sorting content, with DataFrame functions only.

Sampled splitters range-partition the rows by the start of their normalised text and a hash of
all of it: both are short, so the sample that the driver sees stays small, and texts that share a
long beginning don't meet in one partition. Each partition is sorted externally by the whole
normalised text, so equal texts are neighbours, and the window's boundaries compare neighbours in
full. A text with very many copies is dealt into salted groups; one head of each salted group
then meets the others, again by full comparison.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.functions.storage import materialise

WHITE_SPACE = " \t\n\x0b\x0c\r"


def content_sort(docs: DataFrame, hot_rows: int = 1000, hot_share: float = 1e-4,
                 salts: int = 64) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when identical without white space (space, tab to carriage return); null
    counts as empty. Of equal texts the row with the most code points stays, then the one with
    the smallest ``doc_id`` (nulls last); of rows that agree in both, any one. Other columns are
    not read, so extra ones can't clash. An empty table gives no rows.

    Texts with at least ``hot_rows`` copies that are also ``hot_share`` of all rows, at most
    ``1 / hot_share`` texts, are dealt into ``salts`` groups first. The result doesn't depend on it.
    """
    original = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select("doc_id", original.alias("text")).select(
        "doc_id", F.length("text").alias("points"),
        F.translate("text", WHITE_SPACE, "").alias("norm"))
    rows = rows.withColumn("hash", F.xxhash64("norm"))
    least = max(hot_rows, int(docs.count() * hot_share))
    hot = rows.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least).select(
        "hash", F.lit(True).alias("hot"))
    rows = rows.join(F.broadcast(hot), "hash", "left").withColumns({
        "start": F.substring("norm", 1, 16),
        "salt": F.when(F.col("hot"), F.pmod(F.xxhash64("doc_id"), F.lit(salts))).otherwise(0)})
    dealt = rows.repartitionByRange("start", "hash", "salt")
    near = Window.partitionBy("start", "hash", "salt", "norm").orderBy(
        F.desc("points"), F.asc_nulls_last("doc_id"))
    whole = near.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    runs = dealt.select(
        "doc_id", "points", "norm", F.coalesce("hot", F.lit(False)).alias("hot"),
        F.row_number().over(near).alias("place"), F.first("doc_id").over(whole).alias("first_id"),
        F.count(F.lit(1)).over(whole).alias("n"))
    head = F.col("hot") & (F.col("place") == 1)
    runs = materialise(runs.select(
        "doc_id", "points", "hot", "place", "first_id", "n",
        F.sha2(F.col("norm").cast("binary"), 256).alias("text_sha256"),
        F.when(head, F.col("norm")).alias("head")))
    among = Window.partitionBy("head")
    best = among.orderBy(F.desc("points"), F.asc_nulls_last("doc_id"))
    heads = runs.where(head).select(
        "text_sha256", F.row_number().over(best).alias("order"),
        F.first("doc_id").over(best).alias("all_first"), F.sum("n").over(among).alias("all_n"),
    ).where("order = 1").drop("order")
    met = runs.join(F.broadcast(heads), "text_sha256", "left")
    keep_id = F.when(F.col("hot"), F.col("all_first")).otherwise(F.col("first_id"))
    return met.select(
        "doc_id", keep_id.alias("keep_id"),
        F.when(F.col("hot"), F.col("all_n")).otherwise(F.col("n")).alias("group_size"),
        ((F.col("place") == 1) & F.col("doc_id").eqNullSafe(keep_id)).alias("kept"),
        "text_sha256")
