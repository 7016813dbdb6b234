"""Interval operators. Columns chrom, s, e; 0-based, half-open; touching is no overlap.

Overlap joins meet on (chrom, bucket of the position), and windows over sorted intervals run within
such buckets and carry totals between them, so chromosomes don't become hot keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from .blocks import BLOCK, by_width, carry, within

BUCKET = 50_000


def _buckets(s: str, e: str, bucket: int) -> Column:
    first = F.floor(F.col(s) / bucket)
    return F.explode(F.sequence(first, F.greatest(first, F.floor((F.col(e) - 1) / bucket))))


def overlap_pairs(left: DataFrame, right: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """Every overlapping pair once: left's columns, and right's with the prefix r_."""
    r = right.select(*(F.col(c).alias(f"r_{c}") for c in right.columns))
    a, b = left.withColumn("__k", _buckets("s", "e", bucket)), r.withColumn("__rk", _buckets("r_s", "r_e", bucket))
    met = a.join(b, (a.chrom == b.r_chrom) & (a["__k"] == b["__rk"]) & (a.s < b.r_e) & (a.e > b.r_s))
    once = F.col("__k") == F.floor(F.greatest("s", "r_s") / bucket)
    return met.where(once).drop("__k", "__rk")


def with_overlap_flag(left: DataFrame, right: DataFrame, key: list[str], flag: str = "hit", bucket: int = BUCKET) -> DataFrame:
    """left with a flag: some interval of right overlaps. key names left's row; equal rows share a flag."""
    hit = overlap_pairs(left.select(*key, "chrom", "s", "e").distinct(), right.select("chrom", "s", "e").distinct(), bucket).select(*key).distinct().withColumn("__hit", F.lit(True))
    return left.join(hit, key, "left").withColumn(flag, F.coalesce("__hit", F.lit(False))).drop("__hit")


def count_overlaps(left: DataFrame, right: DataFrame, key: list[str], name: str = "n", bucket: int = BUCKET) -> DataFrame:
    n = overlap_pairs(left, right, bucket).groupBy(*key).agg(F.count("*").alias(name))
    return left.join(n, key, "left").withColumn(name, F.coalesce(name, F.lit(0).cast("long")))


def weighted_mean(bins: DataFrame, track: DataFrame, key: list[str], bucket: int = BUCKET) -> DataFrame:
    """bins with value: the track's mean weighted by overlap; null where it doesn't reach."""
    ov = F.least("e", "r_e") - F.greatest("s", "r_s")
    v = overlap_pairs(bins, track, bucket).where("r_value is not null").groupBy(*key).agg((F.sum(F.col("r_value") * ov) / F.sum(ov)).alias("value"))
    return bins.join(v, key, "left")


def blocked_loops(loops: DataFrame, mask: DataFrame) -> DataFrame:
    """loops with blocked: either anchor overlaps the mask."""
    sides = [loops.select(F.col(f"chrom{i}").alias("chrom"), F.col(f"start{i}").alias("s"), F.col(f"end{i}").alias("e")) for i in (1, 2)]
    anchors = sides[0].unionByName(sides[1]).distinct()
    hit = overlap_pairs(anchors, mask.select("chrom", "s", "e").distinct()).select("chrom", "s", "e").distinct()
    one, two = hit.toDF("chrom1", "start1", "end1").withColumn("__a", F.lit(True)), hit.toDF("chrom2", "start2", "end2").withColumn("__b", F.lit(True))
    out = loops.join(one, ["chrom1", "start1", "end1"], "left").join(two, ["chrom2", "start2", "end2"], "left")
    return out.withColumn("blocked", F.coalesce("__a", F.lit(False)) | F.coalesce("__b", F.lit(False))).drop("__a", "__b")


def _reach(rows: WindowSpec) -> Column:
    """The largest end of a block's rows so far, or of its group's earlier blocks (__far)."""
    return F.greatest(F.max("e").over(rows), "__far")


def merge_intervals(df: DataFrame, by: list[str], bucket: int = BUCKET) -> DataFrame:
    """Overlapping intervals of each group joined; touching ones stay apart.

    An interval that begins where all before it have ended begins a joined one, which ends
    with the largest end before the next such interval.
    """
    order = within(by).orderBy("s", "e")
    cut = carry(by_width(df, "s", bucket), by, __far=(F.max("e"), F.max, "earlier"), __end=(F.max("e"), F.max, "all"))
    begins = cut.withColumn("__reach", _reach(order.rowsBetween(Window.unboundedPreceding, -1))).where("__reach is null or s >= __reach")
    begins = carry(begins.select(*by, BLOCK, "s", "e", "__reach", "__end"), by, __next=(F.min("__reach"), F.min, "later"))
    return begins.select(*by, "s", F.coalesce(F.lead("__reach").over(order), "__next", "__end").alias("e"))


def _depth(ends: DataFrame, name: str, bucket: int) -> DataFrame:
    """(chrom, s, e, name) between neighbouring places of ends (chrom, p, d), name being the sum of d so far; e is null after the last."""
    steps = by_width(ends.groupBy("chrom", "p").agg(F.sum("d").alias("d")), "p", bucket)
    steps = carry(steps, ["chrom"], __before=(F.sum("d"), F.sum, "earlier"), __next=(F.min("p"), F.min, "later"))
    order = within(["chrom"]).orderBy("p")
    depth = F.sum("d").over(order) + F.coalesce("__before", F.lit(0))
    return steps.select("chrom", F.col("p").alias("s"), F.coalesce(F.lead("p").over(order), "__next").alias("e"), depth.alias(name))


def supported_segments(df: DataFrame, least: int, bucket: int = BUCKET) -> DataFrame:
    """Segments between neighbouring ends where at least so many samples are active; neighbours aren't joined.

    df: sample, chrom, s, e. A sample's own overlaps are merged first, so a running sum of
    starts and ends counts samples.
    """
    merged = merge_intervals(df, ["sample", "chrom"], bucket)
    steps = merged.select("chrom", F.col("s").alias("p"), F.lit(1).alias("d")).unionByName(merged.select("chrom", F.col("e").alias("p"), F.lit(-1).alias("d")))
    return _depth(steps, "support", bucket).where((F.col("support") >= least) & F.col("e").isNotNull())


def nearest(points: DataFrame, features: DataFrame, key: list[str], bucket: int = BUCKET) -> DataFrame:
    """points (chrom, s, e) with the nearest feature (chrom, pos, name): name and distance.

    Distance is 0 inside the interval; of equally near features the smaller position, then
    name. Null where the chromosome has none.
    """
    own = [k for k in key if k not in ("chrom", "s", "e")]
    mid = points.select(*own, "chrom", "s", "e", F.col("s").alias("p"), F.lit(None).cast("long").alias("fp"), F.lit(None).cast("string").alias("fn"))
    first = features.groupBy("chrom", "pos").agg(F.min("name").alias("name"))
    marks = first.select(*(F.lit(None).cast(points.schema[k].dataType).alias(k) for k in own), "chrom", F.lit(None).cast("long").alias("s"), F.lit(None).cast("long").alias("e"), F.col("pos").alias("p"), F.col("pos").alias("fp"), F.col("name").alias("fn"))
    f = F.when(F.col("fp").isNotNull(), F.struct("fp", "fn"))
    both = by_width(mid.unionByName(marks), "p", bucket)
    both = carry(both, ["chrom"], __last=(F.max(f), F.max, "earlier"), __first=(F.min(f), F.min, "later"))
    up = within(["chrom"]).orderBy("p", F.col("fp").isNull()).rowsBetween(Window.unboundedPreceding, -1)
    down = within(["chrom"]).orderBy("p", F.col("fp").isNull().desc()).rowsBetween(1, Window.unboundedFollowing)
    seen = both.withColumn("a", F.coalesce(F.last(f, True).over(up), "__last")).withColumn("b", F.coalesce(F.first(f, True).over(down), "__first")).where("fp is null")
    gap = lambda c: F.when(F.col(f"{c}.fp") < F.col("s"), F.col("s") - F.col(f"{c}.fp")).when(F.col(f"{c}.fp") >= F.col("e"), F.col(f"{c}.fp") - F.col("e") + 1).otherwise(0)
    best = F.when(F.col("b").isNotNull() & (F.col("a").isNull() | (gap("b") < gap("a"))), F.struct(F.col("b.fn").alias("name"), gap("b").alias("distance"))).otherwise(F.struct(F.col("a.fn").alias("name"), gap("a").alias("distance")))
    chosen = F.when(F.col("a").isNull() & F.col("b").isNull(), F.lit(None)).otherwise(best)
    return seen.withColumn("n", chosen).select(*own, "chrom", "s", "e", F.col("n.name").alias("name"), F.col("n.distance").cast("long").alias("distance"))


def coverage_steps(df: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """Depth between neighbouring ends: chrom, s, e, depth."""
    ends = F.explode(F.array(F.struct(F.col("s").alias("p"), F.lit(1).alias("d")), F.struct(F.col("e").alias("p"), F.lit(-1).alias("d"))))
    return _depth(df.select("chrom", ends.alias("x")).select("chrom", "x.*"), "depth", bucket).where("e is not null and depth > 0")


def not_disjoint(df: DataFrame, by: list[str], bucket: int = BUCKET) -> DataFrame:
    """Rows that the next of their group overlaps; empty if all is well."""
    after = carry(by_width(df, "s", bucket), by, __next=(F.min("s"), F.min, "later"))
    return after.withColumn("next_s", F.coalesce(F.lead("s").over(within(by).orderBy("s", "e")), "__next")).drop("__next", BLOCK).where("next_s < e")


def running_reach(df: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """df with reach: the largest end so far of its chromosome, in (s, e) order."""
    cut = carry(by_width(df, "s", bucket), ["chrom"], __far=(F.max("e"), F.max, "earlier"))
    return cut.withColumn("reach", _reach(within(["chrom"]).orderBy("s", "e").rowsBetween(Window.unboundedPreceding, 0))).drop("__far", BLOCK)
