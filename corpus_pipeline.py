"""From raw documents to tokens: five stages, each on all that the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixmill.llm.common import Scratch, without
from helixmill.llm.decontaminate import with_matches
from helixmill.llm.exact_dedup import exact_dedup
from helixmill.llm.quality_knn import quality_classifier
from helixmill.llm.sentencepiece_scan import SPACE, default_model, sp_encode
from helixmill.llm.setsketch import near_duplicates

#: Two models and an iteration: SQL can't express it.
ORACLE_SQL = None


_ROW = "__row"


def _rows_by_number(spark: SparkSession, docs: DataFrame) -> DataFrame | None:
    """docs with a number for each row, where doc_id doesn't name rows: it repeats, or is null somewhere."""
    if docs.groupBy("doc_id").count().where("count > 1 or doc_id is null").isEmpty():
        return None
    return Scratch(spark).table(docs.withColumn(_ROW, F.monotonically_increasing_id()), "rows")


def _without(spark: SparkSession, docs: DataFrame, decided: DataFrame) -> DataFrame:
    """docs without the ids of rows of decided that are not kept."""
    scratch = Scratch(spark)
    return without(docs, scratch.table(decided.where("not kept").select("doc_id").hint("rebalance"), "gone"), "doc_id", scratch, "gone-bits")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops what the classifier rejects."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = quality_classifier(docs, labels, score_col="__quality", predicted_col="__good")
    return scored.where("__good = 1").select(*docs.columns)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row of the largest doc_id stays, of rows that share it too just one; null is the least id."""
    if (rows := _rows_by_number(spark, docs)) is None:
        return _without(spark, docs, exact_dedup(docs))
    decided = exact_dedup(rows.select(F.struct("doc_id", _ROW).alias("id"), "text"), "id").where("kept")
    return rows.join(decided.select(F.col(f"id.{_ROW}").alias(_ROW)), _ROW, "left_semi").select(*docs.columns)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near duplicates the row of the smallest doc_id stays; null is the largest id."""
    if (rows := _rows_by_number(spark, docs)) is None:
        return _without(spark, docs, near_duplicates(docs))
    found = near_duplicates(rows, _ROW).select(_ROW, "component_id").join(rows.select(_ROW, "doc_id"), _ROW)
    first = found.groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", _ROW)).alias("first"))
    return rows.join(first.select(F.col(f"first.{_ROW}").alias(_ROW)), _ROW, "left_semi").select(*docs.columns)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item."""
    found = with_matches(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), out_col="__found")
    return found.where("size(__found) = 0").select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids, and whether they decode to the text (a literal U+2581 counts as a space)."""
    model = default_model()
    plain = docs.select("doc_id", F.replace(F.coalesce("text", F.lit("")), F.lit(SPACE), F.lit(" ")).alias("text"))
    out = sp_encode(plain, model, with_decoded=True)
    same = F.sha2(F.col("decoded").cast("binary"), 256) == F.col("text_sha256")
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", same.alias("round_trip"))


STAGES = [("quality", quality), ("exact_dedup", exact), ("near_dedup", near), ("decontamination", decontaminated), ("tokens", tokens)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on documents; each stage's rows are written to the shared folder and read again."""
    scratch = Scratch(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = scratch.table(stage(spark, docs, sf_dir), f"{k}-{name}")
        if k:
            scratch.drop(f"{k - 1}-{STAGES[k - 1][0]}")
    return docs
