"""Aggregate peak analysis: windows around loops, matched shifted controls, their ratio and its bootstrap."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import numbered
from .reporting import finite


def usable_loops(loops: DataFrame, width: int, win: int, min_dist: int) -> DataFrame:
    """Cis loops far enough apart that the window doesn't meet the diagonal."""
    return loops.where((F.col("chrom1") == F.col("chrom2")) & (F.abs(F.col("start2") - F.col("start1")) >= max(min_dist, (2 * win + 1) * width)))


def windows(loops: DataFrame, contacts: DataFrame, width: int, win: int, bins: DataFrame | None = None) -> DataFrame:
    """(loop_id, dy, dx, value) for every cell of each window; cells without contacts are 0.

    The window's cells are made once per loop and met with contacts on their exact pixel.
    With bins (chrom, s, usable) cells beyond the chromosome are left out, and those of a bin
    that isn't usable, as one without a weight, are null.
    """
    off = lambda: F.explode(F.sequence(F.lit(-win), F.lit(win)))
    cells = loops.select("loop_id", "chrom", "start1", "start2").withColumn("dy", off()).withColumn("dx", off())
    at = cells.select("loop_id", "dy", "dx", "chrom", (F.col("start1") + F.col("dy") * width).alias("start1"), (F.col("start2") + F.col("dx") * width).alias("start2"))
    value = F.coalesce("score", F.lit(0))
    if bins is not None:
        for c, u in (("start1", "u1"), ("start2", "u2")):
            at = at.join(bins.select("chrom", F.col("s").alias(c), F.col("usable").alias(u)), ["chrom", c])
        value = F.when(F.col("u1") & F.col("u2"), value)
    return at.join(contacts.select("chrom", "start1", "start2", "score"), ["chrom", "start1", "start2"], "left").select("loop_id", "dy", "dx", value.alias("value"))


def usable_windows(cells: DataFrame, win: int, share: float = 0.8) -> DataFrame:
    """Cells of windows that are whole, have a value in so large a share of their cells and in the centre."""
    n = (2 * win + 1) ** 2
    known = F.col("value").isNotNull() & ~F.isnan(F.col("value").cast("double"))
    centre = F.max(F.when((F.col("dy") == 0) & (F.col("dx") == 0), known))
    kept = cells.groupBy("loop_id").agg(F.count("*").alias("n"), F.count_if(known).alias("k"), centre.alias("c")).where((F.col("n") == n) & (F.col("k") >= share * n) & F.col("c"))
    return cells.join(kept.select("loop_id"), "loop_id", "left_semi")


def mean_window(cells: DataFrame) -> DataFrame:
    return cells.groupBy("dy", "dx").agg(F.avg("value").alias("mean"), F.count("value").alias("n"))


def centre_ratio(mean: DataFrame, win: int, corner: int = 3) -> DataFrame:
    """Centre over the mean of the upper-left and lower-right corners."""
    edge = win - corner + 1
    upper, lower = (F.col("dy") <= -edge) & (F.col("dx") <= -edge), (F.col("dy") >= edge) & (F.col("dx") >= edge)
    one = mean.agg(F.max(F.when((F.col("dy") == 0) & (F.col("dx") == 0), F.col("mean"))).alias("centre"), F.avg(F.when(upper | lower, F.col("mean"))).alias("background"))
    return one.withColumn("ratio", F.col("centre") / F.greatest("background", F.lit(1e-9)))


def matched_controls(loops: DataFrame, bins: DataFrame, width: int, win: int, log2_tol: float, draws: int = 20, attempts: int = 200, limit: int = 1_000_000, seed: int = 42, first: int = 20, keep: Callable[[DataFrame, str], DataFrame] = lambda df, name: df) -> DataFrame:
    """(chrom, start1, start2, draw, attempt, c1, c2): for each loop and draw the first attempt's shifted copy that fits.

    bins: (chrom, s, total, anchor, blocked, size). A copy fits whose window lies inside the
    chromosome, whose bins are off the blacklist, of the loop's own anchor classes, and within a
    log2 tolerance of its marginals. Loops without an anchor have none. Shifts are an md5 of
    seed, loop, draw and attempt, so they don't depend on the partitioning. Draws without a
    fit among the first attempts go on to the others: the same result with fewer rows. keep
    writes a table that is read several times, under a name.
    """
    bins = keep(bins, "bins")
    lo = (win + 1) * width
    side = lambda c, p: bins.select("chrom", F.col("s").alias(c), *(F.col(x).alias(f"{p}_{x}") for x in ("total", "anchor", "blocked", "size")))
    known = keep(loops.join(side("start1", "r1"), ["chrom", "start1"]).join(side("start2", "r2"), ["chrom", "start2"]).where("r1_anchor or r2_anchor"), "known")
    parts = int(bins.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    todo = known.withColumn("draw", F.explode(F.sequence(F.lit(0), F.lit(draws - 1))))
    key = F.md5(F.concat_ws("|", F.lit(seed), "chrom", "start1", "start2", "draw", "attempt").cast("binary"))
    number = lambda at, n: F.conv(F.substring(key, at, n), 16, 10).cast("long")
    shift = (number(1, 8) % ((limit - lo) // width) * width + lo) * F.when(number(9, 1) < 8, 1).otherwise(-1)
    near = lambda a, b: (F.col(a) > 0) & (F.col(b) > 0) & (F.abs(F.log2(F.col(a) / F.col(b))) <= log2_tol)

    def fits(rows: DataFrame, a: int, b: int) -> DataFrame:
        spread = rows.repartition(parts, F.xxhash64("chrom", "start1", "start2", "draw"))  # few rows become many: tasks by a number, not by bytes, and not those of the join before
        tries = spread.withColumn("attempt", F.explode(F.sequence(F.lit(a), F.lit(b - 1)))).withColumn("shift", F.explode(F.array(shift)))  # generated, so that later filters don't hash again
        tries = tries.withColumns({"c1": F.col("start1") + F.col("shift"), "c2": F.col("start2") + F.col("shift")})
        tries = tries.where((F.least("c1", "c2") >= win * width) & (F.greatest("c1", "c2") + (win + 1) * width <= F.col("r1_size")))
        for c, p in (("c1", "k1"), ("c2", "k2")):
            tries = tries.join(side(c, p), ["chrom", c])
        ok = tries.where("not k1_blocked and not k2_blocked and k1_anchor = r1_anchor and k2_anchor = r2_anchor").where(near("k1_total", "r1_total") & near("k2_total", "r2_total"))
        return ok.groupBy("chrom", "start1", "start2", "draw").agg(F.min(F.struct("attempt", "c1", "c2")).alias("x")).select("chrom", "start1", "start2", "draw", "x.*")

    early = keep(fits(todo, 0, min(first, attempts)), "early")
    if attempts <= first:
        return early
    return early.unionByName(fits(todo.join(early, ["chrom", "start1", "start2", "draw"], "left_anti"), first, attempts))


def matched_values(loops: DataFrame, controls: DataFrame, contacts: DataFrame) -> DataFrame:
    """(chrom, start1, start2, real, control): a loop's contacts and the mean of its controls'; loops without control are left out."""
    key = ["chrom", "start1", "start2"]
    at = lambda df, value: df.join(contacts.select(*key, F.col("score").alias("__v")), key, "left").withColumn(value, F.coalesce("__v", F.lit(0)).cast("double")).drop("__v")
    moved = at(controls.select(F.col("start1").alias("l1"), F.col("start2").alias("l2"), "chrom", F.col("c1").alias("start1"), F.col("c2").alias("start2")), "v")
    mean = moved.groupBy("chrom", F.col("l1").alias("start1"), F.col("l2").alias("start2")).agg(F.avg("v").alias("control"))
    return at(loops.select(*key), "real").join(mean, key)


def bootstrap_ratio(values: DataFrame, resamples: int = 500, seed: int = 42) -> DataFrame:
    """values (chrom, start1, start2, real, control): ratio of means, and its 2.5 and 97.5 percentiles over resamples of all loops.

    Loops are numbered by place; draw j of resample b is the loop md5(seed, b, j) modulo their
    number, whatever the partitioning. values is read several times, so it should be a
    written table. Loops without two finite values don't count.
    """
    known = values.where(finite(F.col("real")) & finite(F.col("control")))
    loops = numbered(known, "chrom", "start1", 1_000_000, ["start1", "start2"], "i").select("i", F.col("real").cast("double").alias("real"), F.col("control").cast("double").alias("control"))
    ratio = F.avg("real") / F.greatest(F.avg("control"), F.lit(1e-9))
    whole = loops.agg(ratio.alias("ratio"), F.count("*").alias("n"))
    key = F.md5(F.concat_ws("|", F.lit(seed), "b", "i").cast("binary"))
    drawn = F.conv(F.substring(key, 1, 15), 16, 10).cast("long") % F.col("n")
    draws = loops.select("i", F.explode(F.sequence(F.lit(0), F.lit(resamples - 1))).alias("b")).crossJoin(F.broadcast(whole.select("n"))).select("b", drawn.alias("i"))  # one row on the right
    each = draws.join(loops, "i").groupBy("b").agg(ratio.alias("r"))
    return whole.crossJoin(each.agg(F.percentile("r", 0.025).alias("low"), F.percentile("r", 0.975).alias("high")))  # one row each
