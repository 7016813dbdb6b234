"""Exact duplicates by progressive refinement, in DataFrame operations only.

Length, then a hash of the first characters, then SHA-256 of the whole text: each step
looks only at rows that share all before it with another row. Steps one and two move
(id, length, hash); whole texts are hashed where they are read and never shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, ascii_lower, filter_bits, key_bitmap, with_maybe

PREFIX_CHARS = 128
ROWS_A_FILE = 1_000_000


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    prefix_chars: int = PREFIX_CHARS, digest_all: bool = False,
) -> DataFrame:
    """One row per row of docs: id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are so after A-Z are lower-cased; null counts as empty. Of
    equal texts the largest id stays. Repeated rows of one id count each and share its fate.
    A null id stays only in a group where all ids are null. An empty table gives no rows.
    text_sha256 is null for texts that no step had to hash, unless digest_all is set.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark)
    text = ascii_lower(F.col(text_col))
    base = docs.select(F.col(id_col).alias("id"), text.alias("t"))
    sized = base.select("id", F.octet_length("t").cast("long").alias("len"), F.xxhash64(F.substring("t", 1, prefix_chars)).alias("pre"), "t")
    keys = scratch.table(sized.drop("t").hint("rebalance"), "keys")  # small rows: not a file for each task that reads texts
    few = 1 + keys.count() // ROWS_A_FILE
    lengths = keys.groupBy("len").count().where("count > 1").drop("count")
    alive = keys.join(lengths, "len", "left_semi").groupBy("len", "pre").count().where("count > 1").select(F.xxhash64("len", "pre").alias("key"))
    alive = scratch.table(alive.coalesce(few), "surviving")
    if bits := filter_bits(alive.count()):
        marked = with_maybe(sized.withColumn("key", F.xxhash64("len", "pre")), "key", scratch.table(key_bitmap(alive, "key", bits), "bitmap"), bits, "alive")
    else:  # too many groups survive for a filter of bounded size: every text is hashed
        marked = sized.withColumn("alive", F.lit(True))
    whole = F.sha2(F.col("t").cast("binary"), 256)
    rows = scratch.table(marked.select("id", "len", "alive", (whole if digest_all else F.when(F.col("alive"), whole)).alias("sha")).hint("rebalance"), "rows")
    groups = scratch.table(
        rows.where("alive").groupBy("len", "sha").agg(F.max("id").alias("keep_id"), F.count("*").alias("n")).where("n > 1").coalesce(few), "groups"
    )
    joined = rows.where("alive").join(groups, ["len", "sha"], "left")
    single = F.col("n").isNull()
    out = [
        F.when(single, F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("n", F.lit(1).cast("long")).alias("group_size"),
        (single | F.col("id").eqNullSafe(F.col("keep_id"))).alias("kept"),
        F.col("sha").alias("text_sha256"),
    ]
    alone = rows.where("not alive").select(
        F.col("id").alias(id_col), F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), F.col("sha").alias("text_sha256")
    )
    return joined.select(F.col("id").alias(id_col), *out).unionByName(alone)


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the row that stays in its place."""
    return exact_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"), digest_all=True)


OP5_SQL = """
WITH t AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS h
  FROM documents
)
SELECT doc_id, max(doc_id) OVER (PARTITION BY h) AS keep_id, count(*) OVER (PARTITION BY h) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY h) AS kept, h AS text_sha256
FROM t
"""
