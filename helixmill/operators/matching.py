"""Greedy choices, equal to the sequential ones.

Elements are cut into groups where a gap along an axis is wider than any conflict; each
group is decided in one task by one pass in rank order. The gaps are looked for among the
grid's places, of which a chromosome has a bounded number.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: Independent runs are decided together in so many groups.
GROUPS = 256


def cut_at_gaps(df: DataFrame, by: list[str], column: str, gap: int, name: str) -> DataFrame:
    """df with the number of its row's run: places of column further apart than gap are in different runs."""
    places = df.select(*by, column).distinct()
    along = Window.partitionBy(*by).orderBy(column)
    begins = F.coalesce((F.col(column) - F.lag(column).over(along) > gap).cast("int"), F.lit(1))
    return df.join(places.withColumn("__begins", begins).select(*by, column, F.sum("__begins").over(along).alias(name)), [*by, column])


def tolerant_support(calls: DataFrame, width: int, tol: int) -> DataFrame:
    """For each called place (chrom, start1, start2) the samples with a call within tol bins at both anchors."""
    places = calls.select("sample", "chrom", "start1", "start2").distinct()
    offsets = F.explode(F.sequence(F.lit(-tol), F.lit(tol)))
    near = places.withColumn("i", offsets).withColumn("j", offsets).select("sample", "chrom", (F.col("start1") + F.col("i") * width).alias("start1"), (F.col("start2") + F.col("j") * width).alias("start2"))
    seeds = places.select("chrom", "start1", "start2").distinct()
    return seeds.join(near, ["chrom", "start1", "start2"]).groupBy("chrom", "start1", "start2").agg(F.array_sort(F.collect_set("sample")).alias("samples")).withColumn("support", F.size("samples"))


def _group() -> Column:
    return F.pmod(F.xxhash64("chrom", "__run1", "__run2"), F.lit(GROUPS)).alias("__group")


def spaced_representatives(seeds: DataFrame, width: int, reach: int) -> DataFrame:
    """Seeds (chrom, start1, start2, support) taken greedily by (support descending, start1, start2); no two within reach bins at both anchors.

    A grid cell of reach + 1 bins holds one chosen seed at most, so a seed is held against nine.
    """
    cell = (reach + 1) * width

    def choose(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["support", "start1", "start2"], ascending=[False, True, True], kind="stable")
        taken: dict[tuple[str, int, int], tuple[int, int]] = {}
        keep = []
        for c, x, y in zip(pdf["chrom"].tolist(), pdf["start1"].tolist(), pdf["start2"].tolist(), strict=True):
            i, j = x // cell, y // cell
            near = (taken.get((c, i + a, j + b)) for a in (-1, 0, 1) for b in (-1, 0, 1))
            keep.append(not any(o and abs(o[0] - x) <= reach * width and abs(o[1] - y) <= reach * width for o in near))
            if keep[-1]:
                taken[c, i, j] = (x, y)
        return pdf[keep][names]

    names = seeds.columns
    if not reach:  # places are distinct
        return seeds
    grouped = cut_at_gaps(seeds, ["chrom"], "start1", reach * width, "__run1")
    grouped = cut_at_gaps(grouped, ["chrom", "__run1"], "start2", reach * width, "__run2")
    return grouped.groupBy(_group()).applyInPandas(choose, seeds.schema)


def consensus_loops(calls: DataFrame, width: int, tol: int, min_support: int, sizes: DataFrame) -> DataFrame:
    """Loops that enough samples call within tol bins: one footprint each, votes counted once per sample, footprints clipped to the chromosome."""
    seeds = tolerant_support(calls, width, tol).where(F.col("support") >= min_support)
    chosen = spaced_representatives(seeds, width, 2 * tol).join(F.broadcast(sizes), "chrom")
    low = lambda c: F.greatest(F.col(c) - tol * width, F.lit(0))
    high = lambda c: F.least(F.col(c) + (tol + 1) * width, F.col("size"))
    return chosen.select(F.col("chrom").alias("chrom1"), low("start1").alias("start1"), high("start1").alias("end1"), F.col("chrom").alias("chrom2"), low("start2").alias("start2"), high("start2").alias("end2"), "support", F.array_join("samples", ",").alias("samples"))


def candidate_matches(a: DataFrame, b: DataFrame, width: int, tol: int) -> DataFrame:
    """Pairs of loops (chrom, start1, start2) within tol bins at both anchors, with their distance in bp."""
    off = F.explode(F.sequence(F.lit(-tol), F.lit(tol)))
    x = a.select("chrom", F.col("start1").alias("p1"), F.col("start2").alias("p2")).distinct().withColumn("i", off).withColumn("j", off)
    x = x.select("chrom", "p1", "p2", (F.col("p1") + F.col("i") * width).alias("o1"), (F.col("p2") + F.col("j") * width).alias("o2"))
    y = b.select("chrom", F.col("start1").alias("o1"), F.col("start2").alias("o2")).distinct()
    return x.join(y, ["chrom", "o1", "o2"]).withColumn("distance", F.abs(F.col("p1") - F.col("o1")) + F.abs(F.col("p2") - F.col("o2")))


def greedy_matching(edges: DataFrame) -> DataFrame:
    """One-to-one pairs taken greedily by (distance, primary, other).

    Pairs with an end in common lie within twice the largest distance.
    """
    order, names = ["distance", "p1", "p2", "o1", "o2"], edges.columns

    def choose(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order, kind="stable")
        primary, other, keep = set(), set(), []
        for c, p1, p2, o1, o2 in zip(*(pdf[x].tolist() for x in ["chrom", *order[1:]]), strict=True):
            keep.append((c, p1, p2) not in primary and (c, o1, o2) not in other)
            if keep[-1]:
                primary.add((c, p1, p2))
                other.add((c, o1, o2))
        return pdf[keep][names]

    gap = 2 * (edges.agg(F.max("distance")).first()[0] or 0)
    grouped = cut_at_gaps(edges, ["chrom"], "p1", gap, "__run1")
    grouped = cut_at_gaps(grouped, ["chrom", "__run1"], "p2", gap, "__run2")
    return grouped.groupBy(_group()).applyInPandas(choose, edges.schema)


def concordance_summary(a: DataFrame, b: DataFrame, matched: DataFrame) -> DataFrame:
    """Sizes, matches, Jaccard and directional shares; null where nothing can be divided by."""
    key = ["chrom", "start1", "start2"]
    n = lambda df, name: df.agg(F.count("*").alias(name))
    one = n(a.select(*key).distinct(), "n_primary").crossJoin(n(b.select(*key).distinct(), "n_other")).crossJoin(n(matched, "n_matched"))  # one row each
    share = lambda part, whole: F.when(whole > 0, part / whole)
    m = F.col("n_matched")
    return one.withColumns({"jaccard": share(m, F.col("n_primary") + F.col("n_other") - m), "primary_share": share(m, F.col("n_primary")), "other_share": share(m, F.col("n_other"))})
