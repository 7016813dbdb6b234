"""The hypothesis universe: pixels that enough samples support, chosen without looking at conditions or q-values."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.coords import primary
from .intervals import blocked_loops

COORDS = ["chrom1", "start1", "end1", "chrom2", "start2", "end2"]


def eligible(calls: DataFrame, mask: DataFrame, min_count: int, lower: int, upper: int) -> DataFrame:
    """Primary cis calls at the right distance, clear of the mask, with enough contacts."""
    kept = calls.where(primary(F.col("chrom1"), F.col("chrom2")) & (F.col("chrom1") == F.col("chrom2")) & (F.col("start2") - F.col("start1")).between(lower, upper) & (F.col("score") >= min_count))
    return blocked_loops(kept, mask).where("not blocked").drop("blocked")


def support(calls: DataFrame, min_samples: int) -> DataFrame:
    return calls.groupBy(*COORDS).agg(F.count("*").alias("support")).where(F.col("support") >= min_samples)


def universe_counts(every: DataFrame, candidates: DataFrame) -> DataFrame:
    """Each candidate with every sample's count; absent ones are zero."""
    samples = every.select("sample").distinct()
    grid = candidates.crossJoin(F.broadcast(samples))  # samples of a study are few
    return grid.join(every.select("sample", *COORDS, "score"), ["sample", *COORDS], "left").withColumn("score", F.coalesce("score", F.lit(0).cast("long")))


def support_table(counts: DataFrame, min_count: int) -> DataFrame:
    """One row per candidate: support, its samples, and all counts as sorted JSON."""
    has = F.col("score") >= min_count
    return counts.groupBy(*COORDS).agg(
        F.count_if(has).alias("support"), F.array_join(F.array_sort(F.collect_set(F.when(has, F.col("sample")))), ",").alias("support_samples"),
        F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct("sample", "score"))))).alias("source_counts"),
    )


def inconsistent(all_rows: DataFrame, eligible_rows: DataFrame) -> DataFrame:
    """Eligible rows that the full table lacks, or has with another score."""
    a = all_rows.select("sample", *COORDS, F.col("score").alias("all_score"))
    return eligible_rows.join(a, ["sample", *COORDS], "left").where("all_score is null or all_score <> score")
