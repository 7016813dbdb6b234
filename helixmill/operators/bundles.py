"""Contracts over whole results: differential bundles, support tables, reporting calls, stripes, settings, balance reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .contracts import violations
from .reporting import finite

PLACE = ["chrom1", "start1", "start2"]


def _told(rules: dict[str, DataFrame]) -> DataFrame:
    """(rule, n) of how many rows break each rule; rules without any are left out."""
    counts = [df.agg(F.count("*").alias("n")).select(F.lit(rule).alias("rule"), "n") for rule, df in rules.items()]
    return reduce(DataFrame.unionByName, counts).where("n > 0")


def support_violations(support: DataFrame, counts: DataFrame, min_count: int, min_samples: int) -> DataFrame:
    """(rule, n) of a support table (key, support, support_samples array) against counts (key, sample, score).

    Samples named must be those with enough contacts, once each, and enough of them; both sides hold the same keys.
    """
    real = counts.groupBy("key").agg(F.array_sort(F.collect_list(F.when(F.col("score") >= min_count, F.col("sample")))).alias("real"))
    both = support.join(real, "key", "left")
    return _told({
        "repeated_key": support.groupBy("key").count().where("count > 1"),
        "missing_key": real.join(support, "key", "left_anti"),
        "unknown_key": support.join(real, "key", "left_anti"),
        "samples": both.where(F.array_sort("support_samples") != F.col("real")),
        "support": both.where(F.col("support") != F.size("real")),
        "too_few": support.where(F.col("support") < min_samples),
    })


def bundle_violations(results: DataFrame, paired: DataFrame, subjects: list[str], status: str) -> DataFrame:
    """(rule, n) of differential results (loop_key, place, padj, lfc, lfc_se, status) and paired effects
    (loop_key, pair_id, place, case_n, control_n, ratio, status): every loop has one row for each subject, on the same place."""
    value, loops = F.col, results.select("loop_key", *PLACE)
    per_loop = paired.groupBy("loop_key").agg(F.count("*").alias("n"), F.count_distinct("pair_id").alias("pairs"))
    present = lambda c, ok: value(c).isNotNull() & ~ok
    numbers = [finite(value(c)) for c in ("case_n", "control_n", "ratio")]
    return _told({
        "repeated_loop": results.groupBy("loop_key").count().where("count > 1"),
        "null_key": results.select("loop_key").where("loop_key is null").unionByName(paired.where("loop_key is null or pair_id is null").select("loop_key")),
        "status": results.select("status").unionByName(paired.select("status")).where(~F.col("status").eqNullSafe(status)),
        "padj": results.where(present("padj", finite(value("padj")) & value("padj").between(0, 1))),
        "lfc": results.where(present("lfc", finite(value("lfc")))),
        "lfc_se": results.where(present("lfc_se", finite(value("lfc_se")) & (value("lfc_se") >= 0))),
        "repeated_pair": paired.groupBy("loop_key", "pair_id").count().where("count > 1"),
        "unknown_pair": paired.where(~F.coalesce(F.col("pair_id").isin(*subjects), F.lit(False))),
        "uncovered_loop": results.join(per_loop.where(F.col("pairs") == len(subjects)), "loop_key", "left_anti"),
        "unknown_loop": paired.join(results, "loop_key", "left_anti"),
        "place": _moved(paired, loops),
        "number": paired.where(~F.coalesce(reduce(lambda a, b: a & b, numbers), F.lit(False))),
        "negative": paired.where("case_n < 0 or control_n < 0"),
    })


def _moved(paired: DataFrame, loops: DataFrame) -> DataFrame:
    """Loops of which the paired effects give another place than the results."""
    here = paired.select("loop_key", F.struct(*PLACE).alias("here")).distinct()
    return here.join(loops.select("loop_key", F.struct(*PLACE).alias("there")), "loop_key").where("here <> there")


def call_rules(q_max: float) -> dict[str, Column]:
    """Rules of reporting calls, whose columns s1, e1, s2, e2, cc, p, q are text."""
    n = {c: F.col(c).try_cast("double") for c in ("s1", "e1", "s2", "e2", "cc", "p", "q")}
    whole = reduce(lambda a, b: a & b, (finite(n[c]) & (n[c] == F.floor(n[c])) for c in ("s1", "e1", "s2", "e2", "cc")))
    share = lambda c: finite(n[c]) & n[c].between(0, 1)
    shape = (n["s1"] >= 0) & (n["s2"] >= 0) & (n["e1"] > n["s1"]) & (n["e2"] > n["s2"]) & (n["cc"] > 0)
    return {"integer": whole, "probability": share("p") & share("q"), "geometry": shape, "threshold": n["q"] <= q_max + max(1e-12, abs(q_max) * 1e-9)}


def setting_rules() -> dict[str, Column]:
    """Rules of a run's settings, one row a sample."""
    c = F.col
    return {
        "sample": c("sample_id").rlike(r"^[A-Za-z0-9][A-Za-z0-9_.-]*$"), "resolution": (c("resolution") > 0) & (c("resolution") % 1000 == 0), "distance": (c("lower") >= c("resolution")) & (c("lower") < c("upper")),
        "q": (c("q") > 0) & (c("q") < 1), "min_count": c("min_count") >= 1, "min_samples": (c("min_samples") >= 1) & (c("min_samples") <= c("n_samples")), "tolerance": c("tolerance") >= 0,
        "reads": c("r1").isNotNull() & c("r2").isNotNull() & (c("r1") != c("r2")),
    }


def setting_violations(settings: DataFrame) -> DataFrame:
    """(sample_id, broken): settings that break a rule, and ids that come more than once."""
    broken = violations(settings, setting_rules()).select("sample_id", "broken")
    twice = settings.groupBy("sample_id").agg(F.count("*").alias("n")).where("n > 1").select("sample_id", F.lit("repeated").alias("broken"))
    return broken.unionByName(twice)


def aggregate_status_violations(cells: DataFrame, told: DataFrame) -> DataFrame:
    """(sample, broken): aggregate matrices (sample, dy, dx, value) that aren't an odd square or contradict the told status (sample, status)."""
    n = cells.groupBy("sample").agg(F.count("*").alias("n"), F.count_distinct("dy").alias("h"), F.count_distinct("dx").alias("w"), F.coalesce(F.bool_or(F.col("value") != 0), F.lit(False)).alias("any"))
    both = told.join(n, "sample", "left").na.fill({"n": 0, "h": 0, "w": 0, "any": False})
    known = F.col("status").isin("DESCRIPTIVE", "NOT_ASSESSED")
    rules = {"square": (F.col("h") == F.col("w")) & (F.col("h") % 2 == 1) & (F.col("n") == F.col("h") * F.col("w")), "status": known, "content": ~known | ((F.col("status") == "DESCRIPTIVE") == F.col("any"))}
    return violations(both, rules).select("sample", "broken")


def balance_report(weights: DataFrame, wanted: DataFrame) -> DataFrame:
    """A row for each sample of wanted (sample, resolution): its resolutions by state, the status, whether it passes.

    weights: (sample, resolution, converged); a resolution without a row has no weights, one without the
    attribute can't be told. Only weights that converged are published.
    """
    at = wanted.join(weights.withColumn("__here", F.lit(True)), ["sample", "resolution"], "left")
    status = F.when(F.col("converged"), "PASS").when(~F.col("converged"), "WARN").otherwise("NOT_ASSESSED")
    listed = lambda s: F.array_join(F.array_sort(F.collect_list(F.when(F.col("status") == s, F.col("resolution")))).cast("array<string>"), ",")
    out = at.withColumn("status", status).groupBy("sample").agg(
        F.count("*").alias("n_configured"), listed("PASS").alias("converged"), listed("WARN").alias("nonconverged"), listed("NOT_ASSESSED").alias("missing"),
        F.when(F.bool_or(F.col("status") == "NOT_ASSESSED"), "NOT_ASSESSED").when(F.bool_or(F.col("status") == "WARN"), "WARN").otherwise("PASS").alias("status"),
        F.count_if((F.col("status") != "PASS") & F.col("__here")).alias("n_removed"),
    )
    return out.withColumn("passed", F.when(F.col("status") == "PASS", True))


def unknown_status(reports: DataFrame) -> DataFrame:
    """Balance reports whose status is none that a balance can have; one without a status isn't assessed."""
    return reports.where(~F.coalesce("status", F.lit("NOT_ASSESSED")).isin("PASS", "WARN", "NOT_ASSESSED"))


def bootstrap_violations(values: DataFrame, wanted: DataFrame) -> DataFrame:
    """(sample, broken) of wanted samples whose loops (sample, real, control) can't be resampled: none, unmatched, none finite."""
    some = finite(F.col("real")) & finite(F.col("control"))
    per = values.groupBy("sample").agg(F.count("*").alias("n"), F.count("real").alias("a"), F.count("control").alias("b"), F.count_if(some).alias("k"))
    both = wanted.select("sample").join(per, "sample", "left").na.fill(0, ["n", "a", "b", "k"])
    return violations(both, {"present": F.col("n") > 0, "matched": F.col("a") == F.col("b"), "finite": F.col("k") > 0}).select("sample", "broken")


def unmatched_environments(wanted: DataFrame, captured: DataFrame) -> DataFrame:
    """(name, n) of wanted environments (name, digest) that other than one installed capture (digest, installed) is equal to."""
    n = captured.where("installed").groupBy("digest").agg(F.count("*").alias("n"))
    return wanted.join(n, "digest", "left").select("name", F.coalesce("n", F.lit(0)).alias("n")).where("n <> 1")


def unequal_places(a: DataFrame, b: DataFrame, key: list[str]) -> DataFrame:
    """(place, side a, side b) where two tables, each with its rows numbered by place, differ in key or length."""
    one = lambda df, name: df.select("place", F.struct(*key).alias(name))
    return one(a, "a").join(one(b, "b"), "place", "full").where("not (a <=> b)")


def record_violations(files: DataFrame) -> DataFrame:
    """(sample, broken) of read files (sample, mate, n_lines): lines in fours, as many of both mates, none empty."""
    per = files.groupBy("sample").agg(F.sum(F.when(F.col("mate") == 1, F.col("n_lines"))).alias("r1"), F.sum(F.when(F.col("mate") == 2, F.col("n_lines"))).alias("r2"))
    rules = {"fours": (F.col("r1") % 4 == 0) & (F.col("r2") % 4 == 0), "mates": F.col("r1") == F.col("r2"), "present": (F.col("r1") > 0) & (F.col("r2") > 0)}
    return violations(per, rules).select("sample", "broken")


def resolved_viewpoints(points: DataFrame, sizes: DataFrame) -> DataFrame:
    """points (name, chrom, pos) with whether they lie in [0, size) of a known chromosome."""
    return points.join(F.broadcast(sizes.select("chrom", "size")), "chrom", "left").select("name", "chrom", "pos", F.coalesce((F.col("pos") >= 0) & (F.col("pos") < F.col("size")), F.lit(False)).alias("valid"))


def zero_unless_finite(value: Column) -> Column:
    """NaN, infinities and null as 0."""
    return F.when(F.coalesce(finite(value), F.lit(False)), value).otherwise(0.0)
