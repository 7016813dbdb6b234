"""Labelled training rows, bounded, as features on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out


def training_ids(docs: DataFrame, labels: DataFrame, target: str, max_rows: int) -> DataFrame:
    """(doc_id, y) of at most max_rows labelled documents outside the held-out third, drawn by a hash of the id.

    Rows without id or label are passed over; of repeated labels of one id the largest counts.
    """
    present = docs.select(F.col("doc_id").cast("long").alias("doc_id"))
    return (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(target).cast("int").alias("y"))
        .where(F.col("doc_id").isNotNull() & F.col("y").isin(0, 1) & ~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.max("y").alias("y"))
        .join(present, "doc_id", "left_semi")
        .orderBy(F.xxhash64("doc_id", F.lit(17)), "doc_id")
        .limit(max_rows)
    )


def training_texts(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(doc_id, y, t): ids is bounded, so it is broadcast and no text moves."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("t"))
    return texts.join(F.broadcast(ids), "doc_id")
