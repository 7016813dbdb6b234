"""Sparse contact matrices: pixels (bin1, bin2, count) with bin1 <= bin2, and what is read off them."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import rolls
from ..functions.coords import replicate_status


def bin_pairs(pairs: DataFrame, width: int, by: list[str]) -> DataFrame:
    """Pairs counted on the grid, the smaller (chrom, position) first."""
    a, b = (F.struct(F.col(f"chrom{i}").alias("chrom"), (F.floor(F.col(f"pos{i}") / width) * width).cast("long").alias("start")) for i in (1, 2))
    return pairs.select(*by, F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).groupBy(
        *by, F.col("a.chrom").alias("chrom1"), F.col("a.start").alias("start1"), F.col("b.chrom").alias("chrom2"), F.col("b.start").alias("start2")
    ).agg(F.count("*").alias("n"))


def coarsen(pixels: DataFrame, factor_width: int, by: list[str], value: str = "n") -> DataFrame:
    """Starts snapped to a coarser grid, counts added."""
    snap = lambda c: (F.floor(F.col(c) / factor_width) * factor_width).cast("long").alias(c)
    return pixels.withColumns({c: snap(c) for c in ("start1", "start2")}).groupBy(*by, "start1", "start2").agg(F.sum(value).alias(value))


def drop_blocked(pixels: DataFrame, blocked: DataFrame) -> DataFrame:
    """Pixels of which neither bin is blocked. blocked: bin_id."""
    b = blocked.select("bin_id").distinct()
    return pixels.join(b, pixels.bin1 == b.bin_id, "left_anti").join(b, pixels.bin2 == b.bin_id, "left_anti")


def marginals(pixels: DataFrame, by: list[str], value: str = "count") -> DataFrame:
    """Every pixel adds to both of its bins, on the diagonal twice."""
    ends = pixels.select(*by, F.explode(F.array("bin1", "bin2")).alias("bin_id"), value)
    return ends.groupBy(*by, "bin_id").agg(F.sum(value).alias("total"))


def loop_pixels(loops: DataFrame, width: int, lower: int, upper: int, key: list[str]) -> DataFrame:
    """The pixels that each cis loop's anchors span, with the distance in [lower, upper]."""
    span = lambda i: F.explode(F.sequence(F.floor(F.col(f"start{i}") / width), F.floor((F.col(f"end{i}") - 1) / width)))
    out = loops.withColumn("b1", span(1)).withColumn("b2", span(2))
    out = out.where(((F.col("b2") - F.col("b1")) * width).between(lower, upper))
    return out.select(*key, F.col("chrom1").alias("px_chrom"), (F.least("b1", "b2") * width).cast("long").alias("px_start1"), (F.greatest("b1", "b2") * width).cast("long").alias("px_start2"))


def count_loops(loops: DataFrame, contacts: DataFrame, width: int, lower: int, upper: int, key: list[str]) -> DataFrame:
    """Contacts within each loop's pixels for every sample; loops without any get zero."""
    px = loop_pixels(loops, width, lower, upper, key).distinct()
    found = contacts.select("sample", F.col("chrom").alias("px_chrom"), F.col("start1").alias("px_start1"), F.col("start2").alias("px_start2"), "score")
    n = px.join(found, ["px_chrom", "px_start1", "px_start2"]).groupBy(*key, "sample").agg(F.sum("score").alias("n"))
    every = loops.select(*key).distinct().crossJoin(F.broadcast(contacts.select("sample").distinct()))
    return every.join(n, [*key, "sample"], "left").withColumn("n", F.coalesce("n", F.lit(0).cast("long")))


def expected_cis(contacts: DataFrame, sizes: DataFrame, width: int, ignore: int = 1) -> DataFrame:
    """Mean count by diagonal and chromosome; bin pairs without contacts count too."""
    bins = F.ceil(F.col("size") / width)
    diag = contacts.groupBy("sample", "chrom", ((F.col("start2") - F.col("start1")) / width).cast("long").alias("diag")).agg(F.sum("score").alias("total"))
    return diag.where(F.col("diag") >= ignore).join(sizes, "chrom").select("sample", "chrom", "diag", "total", (bins - F.col("diag")).cast("long").alias("n_pairs"), (F.col("total") / (bins - F.col("diag"))).alias("mean"))


def insulation(contacts: DataFrame, width: int, window: int) -> DataFrame:
    """Sum of contacts in the diamond of so many bins on both sides of a bin."""
    b1, b2 = F.floor(F.col("start1") / width), F.floor(F.col("start2") / width)
    # bin k's diamond holds pixels with k - window <= bin1 < k < bin2 <= k + window
    first, last = F.greatest(b1 + 1, b2 - window), F.least(b2 - 1, b1 + window)
    px = contacts.withColumns({"lo": first, "hi": last}).where("lo <= hi")
    return px.select("sample", "chrom", F.explode(F.sequence("lo", "hi")).alias("k"), "score").groupBy("sample", "chrom", (F.col("k") * width).cast("long").alias("start")).agg(F.sum("score").alias("diamond"))


def viewpoint_profile(contacts: DataFrame, bins: DataFrame, chrom: str, pos: int, width: int) -> DataFrame:
    """One row of the matrix: contacts of the viewpoint's bin with every bin of its chromosome."""
    at = pos // width * width
    mine = contacts.where((F.col("chrom") == chrom) & ((F.col("start1") == at) | (F.col("start2") == at)))
    seen = mine.select("sample", F.when(F.col("start1") == at, F.col("start2")).otherwise(F.col("start1")).alias("s"), "score").groupBy("sample", "s").agg(F.sum("score").alias("n"))
    every = bins.where(F.col("chrom") == chrom).select("chrom", "s", "e").crossJoin(F.broadcast(contacts.select("sample").distinct()))
    return every.join(seen, ["sample", "s"], "left").withColumn("n", F.coalesce("n", F.lit(0).cast("long")))


def depth(contacts: DataFrame, lower: int, upper: int) -> DataFrame:
    """Primary off-diagonal contacts, and those at the caller's distances."""
    d = F.col("start2") - F.col("start1")
    return contacts.groupBy("sample").agg(
        F.sum(F.when(d > 0, F.col("score")).otherwise(0)).alias("off_diagonal"), F.sum(F.when((d > 0) & d.between(lower, upper), F.col("score")).otherwise(0)).alias("in_range")
    )


def balance(pixels: DataFrame, ignore_diags: int = 2, min_nnz: int = 10, mad_max: float = 5.0, tol: float = 1e-5, max_iters: int = 200, keep: Callable[[DataFrame, str], DataFrame] | None = None) -> tuple[DataFrame, bool, float]:
    """Iterative correction: weights (bin_id, weight), whether it converged, the last variance.

    Each round is one join and aggregation; keep(df, name) writes a round's weights so that
    lineage stays short. Bins with few pixels or an outlying marginal get no weight.
    """
    w, found = balance_each(pixels.withColumn("__all", F.lit(0)), "__all", ignore_diags, min_nnz, mad_max, tol, max_iters, keep)
    return w.drop("__all"), *found.get(0, (False, float("nan")))


def balance_each(pixels: DataFrame, by: str, ignore_diags: int = 2, min_nnz: int = 10, mad_max: float = 5.0, tol: float = 1e-5, max_iters: int = 200, keep: Callable[[DataFrame, str], DataFrame] | None = None) -> tuple[DataFrame, dict]:
    """balance() of each of a few matrices in the same rounds: weights (by, bin_id, weight), and by matrix whether it converged and its last variance.

    A matrix that converged takes no part in further rounds.
    """
    write, spark = keep or (lambda df, _: df.checkpoint()), pixels.sparkSession

    def keep(df: DataFrame, name: str) -> DataFrame:
        """Rows without the plan's constraints, which a checkpoint retains and which multiply from round to round."""
        kept = write(df, name)._jdf
        return DataFrame(spark._jsparkSession.createDataFrame(kept.toJavaRDD(), kept.schema()), spark)

    px = keep(pixels.where(F.col("bin2") - F.col("bin1") >= ignore_diags).select(by, "bin1", "bin2", F.col("count").cast("double").alias("count")), "pixels")
    ends = px.select(by, F.explode(F.array("bin1", "bin2")).alias("bin_id"), "count").groupBy(by, "bin_id").agg(F.sum("count").alias("m"), F.count("*").alias("nnz")).where(F.col("nnz") >= min_nnz)
    logs = ends.where("m > 0").select(by, "bin_id", F.log("m").alias("l"))
    far = logs.join(F.broadcast(logs.groupBy(by).agg(F.median("l").alias("mid"))), by)
    far = far.join(F.broadcast(far.groupBy(by).agg(F.median(F.abs(F.col("l") - F.col("mid"))).alias("mad"))), by)
    bias = keep(far.where(F.col("l") >= F.col("mid") - mad_max * F.col("mad")).select(by, "bin_id", F.lit(1.0).alias("w")), "w0")
    live = {r[0] for r in bias.select(by).distinct().collect()}
    found, done = dict.fromkeys(live, (False, float("nan"))), []
    for k in range(1, max_iters + 1):
        if not live:
            break
        a, b = bias.toDF(by, "bin1", "w1"), bias.toDF(by, "bin2", "w2")
        scaled = px.join(a, [by, "bin1"]).join(b, [by, "bin2"]).withColumn("v", F.col("count") * F.col("w1") * F.col("w2"))
        both = F.explode(F.array(*(F.struct(F.col(f"bin{n}").alias("bin_id"), F.col(f"w{n}").alias("w")) for n in (1, 2)))).alias("x")
        m = keep(scaled.select(by, both, "v").groupBy(by, "x.bin_id").agg(F.first("x.w").alias("w"), F.sum("v").alias("m")), f"m{k}")
        stats = {r[0]: r for r in m.where("m > 0").groupBy(by).agg(F.avg("m").alias("mean"), F.var_pop("m").alias("var")).collect()}
        now = m.select(by, "bin_id", "w")
        for one in sorted(live):
            if one not in stats or not stats[one]["mean"]:
                done.append(bias.where(F.col(by) == one))
                live.discard(one)
                continue
            mean, var = stats[one]["mean"], stats[one]["var"] / stats[one]["mean"] ** 2
            found[one] = (var < tol, var)
            if var < tol:
                done.append(now.where(F.col(by) == one).withColumn("w", F.col("w") / float(np.sqrt(mean))))
                live.discard(one)
        if live:
            means = F.create_map(*(F.lit(x) for one in sorted(live) for x in (one, float(stats[one]["mean"]))))
            bias = m.where(F.col(by).isin(*live)).select(by, "bin_id", (F.col("w") / F.sqrt(F.col("m") / means[F.col(by)])).alias("w"))
    left = bias.where(F.col(by).isin(*live)) if live else bias.limit(0)
    return reduce(DataFrame.unionByName, done, left).withColumnRenamed("w", "weight"), found


#: Value of a chromosome that can't be scored.
UNSCORED = -2.0


def thinned(pixels: DataFrame, key: Column) -> DataFrame:
    """pixels (..., v, keep) with v the contacts that stay when each does with probability keep / 2^32, by a hash of the pixel's key and the contact; pixels without any are left out.

    A pixel's contacts are hashed in blocks, dealt out by a number of tasks: few pixels can hold most contacts.
    """
    names = [c for c in pixels.columns if c not in ("v", "keep")]
    kind = pixels.select(*names).schema.simpleString().removeprefix("struct<").removesuffix(">")
    parts = int(pixels.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cut = pixels.where((F.col("keep") < 1 << 32) & (F.col("v") > 0)).withColumn("at", F.explode(F.sequence(F.lit(0).cast("long"), "v", F.lit(rolls.ROLLS).cast("long"))))
    cut = cut.select(*names, key.alias("key"), F.greatest("at", F.lit(1)).alias("first"), F.least("v", F.col("at") + (rolls.ROLLS - 1)).alias("last"), F.col("keep").alias("limit"))
    found = cut.repartition(parts, F.xxhash64("key", "first")).mapInArrow(rolls.kept, f"{kind}, v long").groupBy(*names).agg(F.sum("v").alias("v"))
    return pixels.where(F.col("keep") >= 1 << 32).select(*names, "v").unionByName(found).where("v > 0")


def concordance(contacts: DataFrame, pairs: DataFrame, sizes: DataFrame, width: int, h: int, max_dist: int) -> DataFrame:
    """Stratum-adjusted correlation (a, b, chrom, scc) of pairs (a, b) of samples by chromosome; sizes: (chrom, size).

    Of both samples the deeper one is thinned to the other's contacts on the chromosome.
    Matrices are box-smoothed over 2h + 1 bins, diagonals correlated one by one over pixels
    that either has, and averaged with the weight n (1 - 1/n^2) / 12 of n ranks. All of it is
    sums over pixels, none of it a matrix. A chromosome without a diagonal of three pixels
    and of some variance gets UNSCORED.
    """
    pos = contacts.select("sample", "chrom", F.floor(F.col("start1") / width).alias("x"), F.floor(F.col("start2") / width).alias("y"), F.col("score").cast("long").alias("v")).groupBy("sample", "chrom", "x", "y").agg(F.sum("v").alias("v"))
    total = pos.groupBy("sample", "chrom").agg(F.sum("v").alias("total"))
    side = F.explode(F.array(F.struct(F.col("a").alias("sample"), F.col("b").alias("other")), F.struct(F.col("b").alias("sample"), F.col("a").alias("other")))).alias("side")
    depth = pairs.select("a", "b", side).select("a", "b", "side.*").join(total, "sample").join(total.toDF("other", "chrom", "other_total"), ["other", "chrom"])
    limit = F.floor(F.least("total", "other_total") * F.lit(1 << 32).cast("decimal(20,0)") / F.col("total")).cast("long")
    px = pos.join(depth.select("a", "b", "sample", "chrom", limit.alias("keep")), ["sample", "chrom"])
    px = thinned(px.select("a", "b", "sample", "chrom", "x", "y", "v", "keep"), F.concat_ws("|", "a", "b", "chrom", "x", "y"))
    way = lambda x, y: F.struct(F.col(x).alias("x"), F.col(y).alias("y"))
    ways = F.explode(F.when(F.col("x") == F.col("y"), F.array(way("x", "y"))).otherwise(F.array(way("x", "y"), way("y", "x")))).alias("way")  # not a union, which would thin twice
    both = px.select("a", "b", "sample", "chrom", "v", ways).select("a", "b", "sample", "chrom", "way.*", "v")
    off = lambda: F.explode(F.sequence(F.lit(-h), F.lit(h)))
    near = both.withColumn("i", off()).withColumn("j", off()).select("a", "b", "sample", "chrom", (F.col("x") + F.col("i")).alias("x"), (F.col("y") + F.col("j")).alias("y"), "v")
    inside = near.withColumn("d", F.col("y") - F.col("x")).where((F.col("d") >= 1) & (F.col("d") <= max_dist // width) & (F.col("x") >= 0))
    inside = inside.join(F.broadcast(sizes.select("chrom", "size")), "chrom").where(F.col("y") * width < F.col("size"))
    at = lambda s: F.sum(F.when(F.col("sample") == F.col(s), F.col("v")).otherwise(0)).cast("double")
    cell = inside.groupBy("a", "b", "chrom", "x", "d").agg(at("a").alias("p"), at("b").alias("q"))
    sums = cell.groupBy("a", "b", "chrom", "d").agg(F.count("*").alias("n"), F.sum("p").alias("sp"), F.sum("q").alias("sq"), F.sum(F.col("p") * F.col("p")).alias("pp"), F.sum(F.col("q") * F.col("q")).alias("qq"), F.sum(F.col("p") * F.col("q")).alias("pq"))
    vp, vq = F.expr("n * pp - sp * sp"), F.expr("n * qq - sq * sq")
    rho = sums.where((F.col("n") >= 3) & (vp > 0) & (vq > 0)).withColumns({"r": F.expr("n * pq - sp * sq") / F.sqrt(vp) / F.sqrt(vq), "w": F.expr("n * (1 - 1 / (cast(n as double) * n)) / 12")})
    scored = rho.groupBy("a", "b", "chrom").agg((F.sum(F.col("w") * F.col("r")) / F.sum("w")).alias("scc"))
    every = pairs.join(total.select(F.col("sample").alias("a"), "chrom"), "a").select("a", "b", "chrom").union(pairs.join(total.select(F.col("sample").alias("b"), "chrom"), "b").select("a", "b", "chrom")).distinct()
    return every.join(scored, ["a", "b", "chrom"], "left").withColumn("scc", F.coalesce("scc", F.lit(UNSCORED)))


def replicate_report(scc: DataFrame, depth: DataFrame, threshold: float, min_contacts: int) -> DataFrame:
    """A row for each sample of depth (sample, contacts): its pairs' mean, least, median and largest concordance and the status.

    A pair's concordance is the mean over scored chromosomes; pairs with a sample under the floor
    of contacts are confounded by depth and don't count.
    """
    mean = scc.where(F.col("scc") > UNSCORED).where(~F.isnan("scc")).groupBy("a", "b").agg(F.avg("scc").alias("scc"))
    deep = lambda c: depth.select(F.col("sample").alias(c), F.col("contacts").alias(f"{c}_contacts"))
    told = mean.join(deep("a"), "a").join(deep("b"), "b").withColumn("confounded", F.least("a_contacts", "b_contacts") < min_contacts)
    own = told.select(F.explode(F.array("a", "b")).alias("sample"), "scc", "confounded")
    good = F.when(~F.col("confounded"), F.col("scc"))
    stats = own.groupBy("sample").agg(
        F.count(good).alias("n_pairs"), F.count_if("confounded").alias("n_confounded"), F.avg(good).alias("mean"), F.min(good).alias("lo"), F.median(good).alias("mid"), F.max(good).alias("hi"),
        replicate_status(good, threshold).alias("status"),
    )
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    return depth.join(stats, "sample", "left").select("sample", "contacts", zero("n_pairs"), zero("n_confounded"), "mean", "lo", "mid", "hi", F.coalesce("status", F.lit("NOT_ASSESSED")).alias("status"))


def eigenvector(contacts: DataFrame, width: int) -> DataFrame:
    """First eigenvector of each chromosome's observed-over-expected correlation, signed so that its sum with depth is positive."""
    pos = contacts.select("chrom", F.floor(F.col("start1") / width).alias("x"), F.floor(F.col("start2") / width).alias("y"), "score").groupBy("chrom", "x", "y").agg(F.sum("score").alias("v"))

    def e1(pdf: pd.DataFrame) -> pd.DataFrame:
        n = int(pdf[["x", "y"]].to_numpy().max()) + 1
        m = np.zeros((n, n))
        m[pdf.x, pdf.y] = pdf.v
        m = np.maximum(m, m.T)
        cover = m.sum(0)
        for d in range(n):
            i = np.arange(n - d)
            mean = np.diagonal(m, d).mean()
            if mean > 0:
                m[i, i + d] /= mean
                m[i + d, i] = m[i, i + d]
        ok = np.flatnonzero(cover > 0)
        e = np.full(n, np.nan)
        if len(ok) > 2:
            c = m[np.ix_(ok, ok)] - m[np.ix_(ok, ok)].mean()
            w, v = np.linalg.eigh(c)
            e[ok] = v[:, np.abs(w).argmax()]
            e *= np.sign(np.nansum(e * (cover - cover[ok].mean()))) or 1
        return pd.DataFrame({"chrom": pdf["chrom"].iat[0], "start": np.arange(n) * width, "e1": [None if np.isnan(x) else float(x) for x in e]})

    return pos.groupBy("chrom").applyInPandas(e1, "chrom string, start long, e1 double")


def mark_duplicates(pairs: DataFrame, by: list[str], tolerance: int = 3) -> DataFrame:
    """pairs with duplicate: on the same chromosomes and strands another pair stands before it within the tolerance at both ends, in a chain.

    Pairs meet in position buckets of both ends, so nothing but near pairs is compared.
    """
    w = tolerance + 1
    group = [*by, "chrom1", "chrom2", "strand1", "strand2"]
    order = Window.partitionBy(*group).orderBy("pos1", "pos2")
    if not tolerance:
        return pairs.withColumn("duplicate", F.row_number().over(Window.partitionBy(*group, "pos1", "pos2").orderBy(F.lit(1))) > 1)
    spots = pairs.select(*group, "pos1", "pos2").distinct()
    near = lambda c: F.explode(F.expr(f"sequence(floor({c} / {w}) - 1, floor({c} / {w}) + 1)"))
    a = spots.withColumns({"k1": F.floor(F.col("pos1") / w), "k2": F.floor(F.col("pos2") / w)})
    b = spots.withColumn("k1", near("pos1")).withColumn("k2", near("pos2")).withColumnRenamed("pos1", "q1").withColumnRenamed("pos2", "q2")
    met = a.join(b, [*group, "k1", "k2"]).where(f"abs(pos1 - q1) <= {tolerance} and abs(pos2 - q2) <= {tolerance} and (q1 < pos1 or (q1 = pos1 and q2 < pos2))")
    later = met.select(*group, "pos1", "pos2").distinct().withColumn("__late", F.lit(True))
    del order
    same = F.row_number().over(Window.partitionBy(*group, "pos1", "pos2").orderBy(F.lit(1)))
    return pairs.join(later, [*group, "pos1", "pos2"], "left").withColumn("duplicate", F.coalesce("__late", F.lit(False)) | (same > 1)).drop("__late")
