"""Multi-resolution graphs: nodes, loop and neighbour edges, containment, observed masks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import by_width, carry, numbered, within
from .contracts import assert_empty


def node_index(bins: DataFrame) -> DataFrame:
    """bins (chrom, s, e) with a dense index from 0 in (chrom, s) order."""
    return numbered(bins, "chrom", "s", 10_000_000, ["s"], "node")


def loop_edges(loops: DataFrame, nodes: DataFrame, width: int) -> DataFrame:
    """Loops by start bin, joined per unordered node pair: largest score, smallest p and q, distance, number; both directions. Loops within a bin fall away."""
    on = nodes.select("chrom", "s", "node")
    snapped = loops.withColumns({c: (F.floor(F.col(c) / width) * width).cast("long") for c in ("start1", "start2")})
    a, b = on.toDF("chrom1", "start1", "n1"), on.toDF("chrom2", "start2", "n2")
    ends = snapped.join(a, ["chrom1", "start1"]).join(b, ["chrom2", "start2"]).where("n1 <> n2")
    one = ends.groupBy(F.least("n1", "n2").alias("src"), F.greatest("n1", "n2").alias("dst")).agg(
        F.max(F.coalesce("score", F.lit(0))).cast("double").alias("score"), F.min(F.coalesce(F.col("pvalue").cast("double"), F.lit(1.0))).alias("pvalue"), F.min(F.coalesce(F.col("fdr").cast("double"), F.lit(1.0))).alias("fdr"),
        F.max(F.abs(F.col("start2") - F.col("start1"))).alias("distance"), F.count("*").alias("n"),
    )
    return one.unionByName(one.withColumns({"src": F.col("dst"), "dst": F.col("src")}))


def neighbour_edges(nodes: DataFrame) -> DataFrame:
    after = carry(by_width(nodes, "node", 10_000), ["chrom"], __next=(F.min("node"), F.min, "later"))
    nxt = after.select(F.col("node").alias("src"), F.coalesce(F.lead("node").over(within(["chrom"]).orderBy("node")), "__next").alias("dst")).where("dst is not null")
    return nxt.unionByName(nxt.select(F.col("dst").alias("src"), F.col("src").alias("dst")))


def containment(fine: DataFrame, coarse: DataFrame, width: int) -> DataFrame:
    """(child, parent): every fine node's coarse one; a child without parent is an error."""
    p = coarse.select("chrom", F.col("s").alias("ps"), F.col("node").alias("parent"))
    out = fine.withColumn("ps", (F.floor(F.col("s") / width) * width).cast("long")).join(p, ["chrom", "ps"], "left")
    assert_empty(out.where("parent is null").select("chrom", "s"), "a fine bin has no coarse one")
    return out.select(F.col("node").alias("child"), "parent")


def masked_features(nodes: DataFrame, columns: list[str], blocked: str) -> DataFrame:
    """For each feature an observed mask; unobserved cells become 0. Blocked nodes are unobserved in all."""
    seen = {c: ~F.col(blocked) & F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")) for c in columns}
    out = nodes.withColumns({f"{c}_observed": F.coalesce(m, F.lit(False)) for c, m in seen.items()})
    return out.withColumns({c: F.when(F.col(f"{c}_observed"), F.col(c)).otherwise(F.lit(0.0)) for c in columns})


def token_values(tokens: DataFrame, sample_col: str) -> DataFrame:
    """Long form (sample, key, value, observed) of a table of texts. Columns without any number are passed over; numbers mixed with text are an error."""
    keys = [c for c in tokens.columns if c != sample_col]
    long = tokens.select(F.col(sample_col).alias("sample"), F.explode(F.array(*(F.struct(F.lit(k).alias("key"), F.trim(F.coalesce(F.col(k), F.lit(""))).alias("text")) for k in keys))).alias("x")).select("sample", "x.*")
    long = long.withColumn("value", F.col("text").try_cast("double"))
    kinds = long.where("text <> ''").groupBy("key").agg(F.count("value").alias("numbers"), F.count("*").alias("n"))
    assert_empty(kinds.where("numbers > 0 and numbers < n"), "a token column mixes numbers and text")
    return long.join(F.broadcast(kinds.where("numbers > 0").select("key")), "key").select("sample", "key", F.coalesce("value", F.lit(0.0)).alias("value"), F.col("value").isNotNull().alias("observed"))
