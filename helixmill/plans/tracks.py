"""Queries on intervals, matrices, quality, design and graphs."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..adapters import SQL, WIDTH, cte, table
from ..functions import coords as fn
from ..operators import aggregate_peaks, differential, graph, intervals, matrix
from .contacts import _BASE, PRIMARY_SQL, _keep, eligible, query
from ..operators import universe

_ISLANDS = """w AS (SELECT *, max(e) OVER (PARTITION BY sample, chrom ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS r FROM peaks),
i AS (SELECT *, sum(CASE WHEN s < r THEN 0 ELSE 1 END) OVER (PARTITION BY sample, chrom ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS k FROM w),
merged AS (SELECT sample, chrom, min(s) AS s, max(e) AS e FROM i GROUP BY sample, chrom, k)"""
_PEAKS = f"{cte('peaks')}, {_ISLANDS}"


@query(f"{_PEAKS} SELECT * FROM merged")
def win02_merged_peaks(spark, d):
    return intervals.merge_intervals(table(spark, d, "peaks"), ["sample", "chrom"])


@query(f"""{_PEAKS}, pt AS (SELECT DISTINCT chrom, p FROM (SELECT chrom, s AS p FROM merged UNION ALL SELECT chrom, e FROM merged)), seg AS (SELECT chrom, p AS s, lead(p) OVER (PARTITION BY chrom ORDER BY p) AS e FROM pt)
SELECT seg.chrom, seg.s, seg.e, count(DISTINCT sample) AS support FROM seg JOIN merged m ON m.chrom = seg.chrom AND m.s < seg.e AND m.e > seg.s GROUP BY ALL HAVING count(DISTINCT sample) >= 2""")
def win03_consensus_peaks(spark, d):
    """Segments that at least two samples' peaks cover."""
    return intervals.supported_segments(table(spark, d, "peaks"), 2)


@query(f"{cte('peaks')} SELECT chrom, s, e, max(e) OVER (PARTITION BY chrom ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS reach FROM (SELECT DISTINCT chrom, s, e FROM peaks)")
def win01_running_reach(spark, d):
    return intervals.running_reach(table(spark, d, "peaks").select("chrom", "s", "e").distinct())


@query(f"""{cte('peaks')}, st AS (SELECT chrom, s AS p, 1 AS x FROM peaks UNION ALL SELECT chrom, e, -1 FROM peaks), t AS (SELECT chrom, p, sum(x) AS x FROM st GROUP BY ALL),
r AS (SELECT chrom, p AS s, lead(p) OVER (PARTITION BY chrom ORDER BY p) AS e, CAST(sum(x) OVER (PARTITION BY chrom ORDER BY p) AS BIGINT) AS depth FROM t) SELECT * FROM r WHERE e IS NOT NULL AND depth > 0""")
def win04_coverage(spark, d):
    return intervals.coverage_steps(table(spark, d, "peaks"))


@query(f"{cte('peaks')} SELECT sample, chrom, s, e, lead(s) OVER (PARTITION BY sample, chrom ORDER BY s, e) AS next_s FROM peaks QUALIFY next_s < e")
def win09_not_disjoint(spark, d):
    return intervals.not_disjoint(table(spark, d, "peaks"), ["sample", "chrom"]).select("sample", "chrom", "s", "e", "next_s")


@query(f"{cte('bins', 'peaks')} SELECT bins.chrom, bins.s, count(p.chrom) AS n, CAST(count(p.chrom) AS DOUBLE) / greatest((bins.e - bins.s) / 1000.0, 1) AS density FROM bins LEFT JOIN peaks p ON p.chrom = bins.chrom AND p.s < bins.e AND p.e > bins.s GROUP BY bins.chrom, bins.s, bins.e")
def join02_peak_density(spark, d):
    n = intervals.count_overlaps(table(spark, d, "bins"), table(spark, d, "peaks"), ["chrom", "s", "e"])
    return n.select("chrom", "s", "n", (F.col("n") / F.greatest((F.col("e") - F.col("s")) / 1000, F.lit(1.0))).alias("density"))


@query(f"{cte('bins', 'track')} SELECT b.chrom, b.s, round(sum(t.value * (least(b.e, t.e) - greatest(b.s, t.s))) / sum(least(b.e, t.e) - greatest(b.s, t.s)), 6) AS value FROM bins b LEFT JOIN track t ON t.chrom = b.chrom AND t.s < b.e AND t.e > b.s GROUP BY ALL")
def join03_weighted_mean(spark, d):
    """A coarse track laid on fine bins; bins it doesn't reach have null."""
    return intervals.weighted_mean(table(spark, d, "bins"), table(spark, d, "track"), ["chrom", "s", "e"]).select("chrom", "s", F.round("value", 6).alias("value"))


@query(f"{cte('bins', 'blacklist')} SELECT b.chrom, b.bin_id, b.s, EXISTS (SELECT 1 FROM blacklist k WHERE k.chrom = b.chrom AND k.s < b.e AND k.e > b.s) AS blocked FROM bins b")
def join04_blocked_bins(spark, d):
    return intervals.with_overlap_flag(table(spark, d, "bins"), table(spark, d, "blacklist"), ["bin_id"], "blocked").select("chrom", "bin_id", "s", "blocked")


@query(f"{cte('peaks', 'blacklist')} SELECT sample, chrom, s, e FROM peaks p WHERE NOT EXISTS (SELECT 1 FROM blacklist k WHERE k.chrom = p.chrom AND k.s < p.e AND k.e > p.s)")
def flt25_clear_peaks(spark, d):
    return intervals.with_overlap_flag(table(spark, d, "peaks"), table(spark, d, "blacklist"), ["chrom", "s", "e"], "blocked").where("not blocked").select("sample", "chrom", "s", "e")


_NEAR = """x AS (SELECT a.chrom, a.s, a.e, t.gene AS name, CASE WHEN t.pos IS NULL THEN NULL WHEN t.pos < a.s THEN a.s - t.pos WHEN t.pos >= a.e THEN t.pos - a.e + 1 ELSE 0 END AS distance, t.pos FROM anchors a LEFT JOIN tss t ON t.chrom = a.chrom),
near AS (SELECT chrom, s, e, name, CAST(distance AS BIGINT) AS distance FROM x QUALIFY row_number() OVER (PARTITION BY chrom, s, e ORDER BY distance, pos, name) = 1)"""
_ANCHORS = f"{_BASE}, tss AS ({SQL['tss']}), anchors AS (SELECT DISTINCT chrom1 AS chrom, start1 AS s, end1 AS e FROM cand)"


def _anchors(spark, d):
    return universe.support(eligible(spark, d), 2).select(F.col("chrom1").alias("chrom"), F.col("start1").alias("s"), F.col("end1").alias("e")).distinct()


def _genes(spark, d):
    return table(spark, d, "tss").select("chrom", "pos", F.col("gene").alias("name"))


@query(f"{_ANCHORS}, {_NEAR} SELECT chrom, s, e, distance FROM near")
def join10_nearest_gene(spark, d):
    """The distance to the nearest start of a gene."""
    return intervals.nearest(_anchors(spark, d), _genes(spark, d), ["chrom", "s", "e"]).select("chrom", "s", "e", "distance")


@query(f"""{_ANCHORS}, a2 AS (SELECT * FROM anchors UNION SELECT DISTINCT chrom2, start2, end2 FROM cand), {_NEAR.replace('anchors a', 'a2 a')}, pk AS ({SQL['peaks']}),
n AS (SELECT a.chrom, a.s, a.e, count(pk.chrom) AS n FROM a2 a LEFT JOIN pk ON pk.chrom = a.chrom AND pk.s < a.e AND pk.e > a.s GROUP BY ALL)
SELECT c.chrom1, c.start1, c.start2, x.n AS peaks1, y.n AS peaks2, x.n > 0 AND y.n > 0 AS both_peaks, coalesce(p.distance <= 2000 AND q.distance <= 2000, false) AS promoter_promoter, coalesce((p.distance <= 2000) <> (q.distance <= 2000), false) AS promoter_distal
FROM cand c JOIN n x ON x.chrom = c.chrom1 AND x.s = c.start1 JOIN n y ON y.chrom = c.chrom2 AND y.s = c.start2 JOIN near p ON p.chrom = c.chrom1 AND p.s = c.start1 JOIN near q ON q.chrom = c.chrom2 AND q.s = c.start2""")
def pip12_annotated_loops(spark, d):
    """Loops with peaks at their anchors, and whether they join promoters."""
    loops = universe.support(eligible(spark, d), 2)
    anchors = loops.select(F.explode(F.array(F.struct(F.col("chrom1").alias("chrom"), F.col("start1").alias("s"), F.col("end1").alias("e")), F.struct(F.col("chrom2").alias("chrom"), F.col("start2").alias("s"), F.col("end2").alias("e")))).alias("a")).select("a.*").distinct()
    n = intervals.count_overlaps(anchors, table(spark, d, "peaks"), ["chrom", "s", "e"])
    info = n.join(intervals.nearest(anchors, _genes(spark, d), ["chrom", "s", "e"]), ["chrom", "s", "e"]).select("chrom", "s", "n", "distance")
    one, two = info.toDF("chrom1", "start1", "peaks1", "d1"), info.toDF("chrom2", "start2", "peaks2", "d2")
    p, q = F.coalesce(F.col("d1") <= 2000, F.lit(False)), F.coalesce(F.col("d2") <= 2000, F.lit(False))
    out = loops.join(one, ["chrom1", "start1"]).join(two, ["chrom2", "start2"])
    return out.select("chrom1", "start1", "start2", "peaks1", "peaks2", ((F.col("peaks1") > 0) & (F.col("peaks2") > 0)).alias("both_peaks"), (p & q).alias("promoter_promoter"), (p != q).alias("promoter_distal"))


@query(f"""{cte('pairs', 'peaks')}, ends AS (SELECT sample, chrom1 AS chrom, pos1 AS p FROM pairs WHERE pair_type = 'UU' UNION ALL SELECT sample, chrom2, pos2 FROM pairs WHERE pair_type = 'UU'),
mp AS (SELECT DISTINCT chrom, s, e FROM peaks WHERE sample = 'click')
SELECT sample, count(*) AS total, count(*) FILTER (EXISTS (SELECT 1 FROM mp WHERE mp.chrom = ends.chrom AND mp.s <= p AND mp.e > p)) AS in_peaks, CASE WHEN count(*) = 0 THEN 0.0 ELSE CAST(count(*) FILTER (EXISTS (SELECT 1 FROM mp WHERE mp.chrom = ends.chrom AND mp.s <= p AND mp.e > p)) AS DOUBLE) / count(*) END AS frip
FROM ends WHERE {PRIMARY_SQL.format('chrom')} GROUP BY sample""")
def pip22_reads_in_peaks(spark, d):
    """The share of both ends of unique pairs that lies in peaks; each end counts once."""
    end = lambda i: F.struct(F.col(f"chrom{i}").alias("chrom"), F.col(f"pos{i}").alias("s"))
    ends = table(spark, d, "pairs").where("pair_type = 'UU'").select("sample", F.explode(F.array(end(1), end(2))).alias("x")).select("sample", "x.chrom", "x.s", (F.col("x.s") + 1).alias("e"))
    ends = ends.where(fn.primary(F.col("chrom")))
    flagged = intervals.with_overlap_flag(ends, table(spark, d, "peaks").where("sample = 'click'"), ["chrom", "s", "e"], "hit")
    return flagged.groupBy("sample").agg(F.count("*").alias("total"), F.count_if("hit").alias("in_peaks")).withColumn("frip", F.when(F.col("total") > 0, F.col("in_peaks") / F.col("total")).otherwise(0.0))


_CLASS = """CASE WHEN rfrag1 < 0 OR rfrag2 < 0 THEN 'unassigned' WHEN rfrag1 <> rfrag2 THEN 'regular' WHEN (CASE WHEN pos1 <= pos2 THEN strand1 || strand2 ELSE strand2 || strand1 END) = '+-' THEN 'dangling_end'
WHEN (CASE WHEN pos1 <= pos2 THEN strand1 || strand2 ELSE strand2 || strand1 END) = '-+' THEN 'self_circle' ELSE 'same_strand' END"""


@query(f"{cte('pairs')} SELECT sample, {_CLASS} AS class, count(*) AS n, CAST(count(*) AS DOUBLE) / sum(count(*)) OVER (PARTITION BY sample) AS fraction FROM pairs GROUP BY sample, class")
def pip19_restriction_classes(spark, d):
    p = table(spark, d, "pairs")
    n = p.groupBy("sample", fn.fragment_class(*(F.col(c) for c in ("rfrag1", "rfrag2", "strand1", "strand2", "pos1", "pos2"))).alias("class")).agg(F.count("*").alias("n"))
    return n.withColumn("fraction", F.col("n") / F.sum("n").over(Window.partitionBy("sample")))


@query(f"""{cte('pairs')} SELECT sample, count(*) AS total, count(*) FILTER (pair_type = 'UU') AS kept, count(*) FILTER (pair_type = 'DD') AS dups, count(*) FILTER (pair_type = 'UU' AND chrom1 = chrom2) AS cis,
count(*) FILTER (pair_type = 'UU' AND chrom1 <> chrom2) AS trans, count(*) FILTER (pair_type = 'UU' AND chrom1 = chrom2 AND abs(pos1 - pos2) >= 20000) AS cis_20kb,
count(*) FILTER (pair_type = 'UU' AND rfrag1 >= 0 AND rfrag2 >= 0 AND (chrom1 <> chrom2 OR abs(rfrag1 - rfrag2) > 1)) AS valid FROM pairs GROUP BY sample""")
def agg27_pair_statistics(spark, d):
    uu, cis = F.col("pair_type").isin("UU"), F.col("chrom1") == F.col("chrom2")
    return table(spark, d, "pairs").groupBy("sample").agg(
        F.count("*").alias("total"), F.count_if(uu).alias("kept"), F.count_if(F.col("pair_type") == "DD").alias("dups"), F.count_if(uu & cis).alias("cis"), F.count_if(uu & ~cis).alias("trans"),
        F.count_if(uu & cis & (F.abs(F.col("pos1") - F.col("pos2")) >= 20_000)).alias("cis_20kb"), F.count_if(uu & fn.valid_ligation(*(F.col(c) for c in ("chrom1", "chrom2", "rfrag1", "rfrag2")))).alias("valid"),
    )


@query(f"""{cte('pairs')}, k AS (SELECT sample, chrom1, pos1 // 5000 * 5000 AS a, chrom2, pos2 // 5000 * 5000 AS b FROM pairs),
o AS (SELECT sample, CASE WHEN (chrom1, a) <= (chrom2, b) THEN chrom1 ELSE chrom2 END AS chrom1, CASE WHEN (chrom1, a) <= (chrom2, b) THEN a ELSE b END AS start1, CASE WHEN (chrom1, a) <= (chrom2, b) THEN chrom2 ELSE chrom1 END AS chrom2, CASE WHEN (chrom1, a) <= (chrom2, b) THEN b ELSE a END AS start2 FROM k)
SELECT *, count(*) AS n FROM o GROUP BY ALL""")
def agg25_binned_pairs(spark, d):
    return matrix.bin_pairs(table(spark, d, "pairs"), WIDTH, ["sample"])


@query(f"{cte('pairs')} SELECT sample, chrom1, pos1, chrom2, pos2, strand1, strand2, count(*) - 1 AS extra FROM pairs GROUP BY ALL HAVING count(*) > 1")
def mdl11_exact_duplicates(spark, d):
    """How many copies of a pair beyond the first are marked, without tolerance."""
    key = ["sample", "chrom1", "pos1", "chrom2", "pos2", "strand1", "strand2"]
    return matrix.mark_duplicates(table(spark, d, "pairs"), ["sample"], 0).groupBy(*key).agg(F.count_if("duplicate").alias("extra")).where("extra > 0")


@query()
def mdl11_tolerant_duplicates(spark, d):
    p = table(spark, d, "pairs").select("sample", "chrom1", "pos1", "chrom2", "pos2", "strand1", "strand2")
    return matrix.mark_duplicates(p, ["sample"], 3).groupBy("sample").agg(F.count("*").alias("n"), F.count_if("duplicate").alias("duplicates"))


@query(f"{cte('contacts')} SELECT sample, chrom, start1 // 25000 * 25000 AS start1, start2 // 25000 * 25000 AS start2, CAST(sum(score) AS BIGINT) AS score FROM contacts GROUP BY ALL")
def agg26_coarsened(spark, d):
    c = table(spark, d, "contacts")
    return matrix.coarsen(c, 25_000, ["sample", "chrom"], "score")


_PIX = "px AS (SELECT c.sample, a.bin_id AS bin1, b.bin_id AS bin2, c.score AS count FROM contacts c JOIN bins a ON a.chrom = c.chrom AND a.s = c.start1 JOIN bins b ON b.chrom = c.chrom AND b.s = c.start2)"


def _pixels(spark, d):
    c, b = table(spark, d, "contacts"), table(spark, d, "bins").select("chrom", "s", "bin_id")
    return c.join(b.toDF("chrom", "start1", "bin1"), ["chrom", "start1"]).join(b.toDF("chrom", "start2", "bin2"), ["chrom", "start2"]).select("sample", "bin1", "bin2", F.col("score").alias("count"))


_HIT = "blk AS (SELECT DISTINCT bin_id FROM bins b JOIN blacklist k ON k.chrom = b.chrom AND k.s < b.e AND k.e > b.s)"


@query(f"{cte('contacts', 'bins', 'blacklist')}, {_PIX}, {_HIT} SELECT sample, CAST(sum(count) AS BIGINT) AS input, CAST(sum(CASE WHEN bin1 IN (FROM blk) OR bin2 IN (FROM blk) THEN 0 ELSE count END) AS BIGINT) AS retained FROM px GROUP BY sample")
def pip08_blacklist_pixels(spark, d):
    """Contacts before and after pixels with a blocked bin are dropped."""
    px = _pixels(spark, d)
    blocked = intervals.with_overlap_flag(table(spark, d, "bins"), table(spark, d, "blacklist"), ["bin_id"], "blocked").where("blocked").select("bin_id")
    whole, left = px.groupBy("sample").agg(F.sum("count").alias("input")), matrix.drop_blocked(px, blocked).groupBy("sample").agg(F.sum("count").alias("retained"))
    return whole.join(left, "sample", "left").withColumn("retained", F.coalesce("retained", F.lit(0).cast("long")))


@query(f"{cte('contacts', 'bins')}, {_PIX} SELECT sample, bin_id, CAST(sum(count) AS BIGINT) AS total FROM (SELECT sample, bin1 AS bin_id, count FROM px UNION ALL SELECT sample, bin2, count FROM px) GROUP BY ALL")
def agg07_marginals(spark, d):
    return matrix.marginals(_pixels(spark, d), ["sample"])


@query(f"{cte('contacts')} SELECT sample, CAST(sum(CASE WHEN start2 > start1 THEN score ELSE 0 END) AS BIGINT) AS off_diagonal, CAST(sum(CASE WHEN start2 - start1 BETWEEN 20000 AND 100000 THEN score ELSE 0 END) AS BIGINT) AS in_range FROM contacts WHERE {PRIMARY_SQL.format('chrom')} GROUP BY sample")
def pip18_contact_depth(spark, d):
    c = table(spark, d, "contacts")
    return matrix.depth(c.where(fn.primary(F.col("chrom"))), 20_000, 100_000)


@query(f"{cte('contacts', 'chroms')} SELECT sample, chrom, (start2 - start1) // 5000 AS diag, CAST(sum(score) AS BIGINT) AS total, CAST(ceil(any_value(size) / 5000) - (start2 - start1) // 5000 AS BIGINT) AS n_pairs, sum(score) / (ceil(any_value(size) / 5000) - (start2 - start1) // 5000) AS mean FROM contacts JOIN chroms USING (chrom) WHERE start2 - start1 >= 10000 GROUP BY sample, chrom, start2 - start1")
def agg28_expected(spark, d):
    return matrix.expected_cis(table(spark, d, "contacts"), table(spark, d, "chroms"), WIDTH, 2)


@query(f"{cte('contacts')}, k AS (SELECT CAST(unnest(range(71)) AS BIGINT) AS k) SELECT sample, chrom, k * 5000 AS start, CAST(sum(score) AS BIGINT) AS diamond FROM contacts, k WHERE start1 // 5000 BETWEEN k - 10 AND k - 1 AND start2 // 5000 BETWEEN k + 1 AND k + 10 GROUP BY ALL")
def agg29_insulation(spark, d):
    return matrix.insulation(table(spark, d, "contacts"), WIDTH, 10)


@query(f"{cte('contacts', 'bins')}, n AS (SELECT sample, CASE WHEN start1 = 100000 THEN start2 ELSE start1 END AS s, CAST(sum(score) AS BIGINT) AS n FROM contacts WHERE chrom = 'chr5' AND (start1 = 100000 OR start2 = 100000) GROUP BY ALL) SELECT sample, b.chrom, b.s, b.e, coalesce(n, 0) AS n FROM bins b CROSS JOIN (SELECT DISTINCT sample FROM contacts) x LEFT JOIN n USING (sample, s) WHERE b.chrom = 'chr5'")
def pip17_viewpoint(spark, d):
    return matrix.viewpoint_profile(table(spark, d, "contacts"), table(spark, d, "bins"), "chr5", 102_345, WIDTH).select("sample", "chrom", "s", "e", "n")


@query(f"{cte('contacts')} SELECT start2 - start1 AS dist, avg(score) AS mean, count(*) AS n FROM contacts WHERE start2 - start1 BETWEEN 25000 AND 50000000 AND score > 0 GROUP BY ALL")
def agg19_distance_decay(spark, d):
    c = table(spark, d, "contacts").withColumn("dist", F.col("start2") - F.col("start1"))
    return c.where(F.col("dist").between(25_000, 50_000_000) & (F.col("score") > 0)).groupBy("dist").agg(F.avg("score").alias("mean"), F.count("*").alias("n"))


@query(f"""{cte('contacts')}, v AS (SELECT sample, chrom, start1, CAST(sum(score) AS DOUBLE) AS v FROM contacts GROUP BY ALL)
SELECT a.sample AS sample_a, b.sample AS sample_b, count(*) AS n, round(corr(a.v, b.v), 6) AS r FROM v a JOIN v b ON a.chrom = b.chrom AND a.start1 = b.start1 AND a.sample < b.sample GROUP BY ALL HAVING count(*) >= 100""")
def agg18_sample_correlation(spark, d):
    """Pearson correlation of every two samples over the bins both have, with 100 at least."""
    v = table(spark, d, "contacts").groupBy("sample", "chrom", "start1").agg(F.sum("score").cast("double").alias("v"))
    a, b = v.toDF("sample_a", "chrom", "start1", "a"), v.toDF("sample_b", "chrom", "start1", "b")
    return a.join(b, ["chrom", "start1"]).where("sample_a < sample_b").groupBy("sample_a", "sample_b").agg(F.count("*").alias("n"), F.round(F.corr("a", "b"), 6).alias("r")).where("n >= 100")


@query()
def mdl05_balanced_weights(spark, d):
    """Weights by iterative correction of every sample's matrix, until it converges."""
    w, found = matrix.balance_each(_pixels(spark, d), "sample", keep=_keep(spark))
    known = spark.createDataFrame([(one, bool(ok), float(var)) for one, (ok, var) in found.items()], "sample string, converged boolean, variance double")
    return w.join(F.broadcast(known), "sample").select("sample", "bin_id", "weight", fn.balance_status(F.lit(True), F.col("converged")).alias("status"), "variance")


@query()
def mdl06_eigenvector(spark, d):
    return matrix.eigenvector(table(spark, d, "contacts"), 25_000)


def _apa_loops(spark, d):
    u = universe.support(eligible(spark, d), 3)
    u = aggregate_peaks.usable_loops(u, WIDTH, 5, 60_000)
    return u.select(F.abs(F.xxhash64("chrom1", "start1", "start2")).alias("loop_id"), F.col("chrom1").alias("chrom"), "start1", "start2")


def _one_sample(spark, d):
    return table(spark, d, "contacts").groupBy("chrom", "start1", "start2").agg(F.sum("score").alias("score"))


_APA = f"""{_BASE}, lp AS (SELECT chrom1 AS chrom, start1, start2 FROM cand WHERE support >= 3 AND start2 - start1 >= 60000), all1 AS (SELECT chrom, start1, start2, sum(score) AS score FROM contacts GROUP BY ALL), off AS (SELECT unnest(range(-5, 6)) AS o),
cell AS (SELECT y.o AS dy, x.o AS dx, coalesce(score, 0) AS v FROM lp CROSS JOIN off y CROSS JOIN off x LEFT JOIN all1 a ON a.chrom = lp.chrom AND a.start1 = lp.start1 + y.o * 5000 AND a.start2 = lp.start2 + x.o * 5000)"""


@query(f"{_APA} SELECT CAST(dy AS INTEGER) AS dy, CAST(dx AS INTEGER) AS dx, round(avg(v), 6) AS mean, count(*) AS n FROM cell GROUP BY ALL")
def pip09_mean_window(spark, d):
    cells = aggregate_peaks.windows(_apa_loops(spark, d), _one_sample(spark, d), WIDTH, 5)
    return aggregate_peaks.mean_window(cells).select("dy", "dx", F.round("mean", 6).alias("mean"), "n")


@query("""SELECT c.s_nationkey AS nation, 1 AS x, count(*) AS n, median(s_acctbal) AS med, round(max(s_acctbal) / 1000, 1) AS longest FROM supplier c GROUP BY ALL""")
def agg09_stripe_statistics(spark, d):
    """Number, median and longest by group."""
    s = table(spark, d, "supplier")
    return s.groupBy(F.col("s_nationkey").alias("nation"), F.lit(1).alias("x")).agg(F.count("*").alias("n"), F.median("s_acctbal").alias("med"), F.round(F.max("s_acctbal") / 1000, 1).alias("longest"))


_STATUS = """CASE WHEN NOT (yield_pct >= 25 AND dup_pct <= 50 AND cis_fraction >= 0.7 AND replicate_status <> 'FAIL') THEN 'FAIL' WHEN replicate_status IN ('DISCORDANT', 'WARN') OR balance_status IN ('DISCORDANT', 'WARN') THEN 'PASS_WITH_UNCERTAINTY'
WHEN replicate_status = 'NOT_ASSESSED' OR balance_status = 'NOT_ASSESSED' THEN 'PASS_WITH_NOT_ASSESSED' ELSE 'PASS' END"""


@query(f"{cte('qc')} SELECT sample, {_STATUS} AS status, CASE WHEN {_STATUS} = 'PASS' THEN true END AS overall_pass FROM qc")
def pip14_overall_status(spark, d):
    q = table(spark, d, "qc")
    s = fn.overall_status(F.col("yield_pct"), F.col("dup_pct"), F.col("cis_fraction"), [F.col("replicate_status")], [F.col("balance_status")])
    return q.select("sample", s.alias("status")).withColumn("overall_pass", fn.pass_or_null(F.col("status")))


@query(f"{cte('qc')} SELECT CAST(dup_pct AS BIGINT) % 10 AS grp, CASE WHEN count(cis_fraction) = 0 THEN 'NOT_ASSESSED' WHEN bool_and(cis_fraction >= 0.7) THEN 'PASS' WHEN NOT bool_or(cis_fraction >= 0.7) THEN 'FAIL' ELSE 'DISCORDANT' END AS status, min(cis_fraction) AS lo, max(cis_fraction) AS hi, median(cis_fraction) AS mid, round(avg(cis_fraction), 9) AS mean FROM qc GROUP BY ALL")
def fn09_replicate_status(spark, d):
    q = table(spark, d, "qc")
    c = F.col("cis_fraction")
    return q.groupBy((F.col("dup_pct").cast("long") % 10).alias("grp")).agg(fn.replicate_status(c, 0.7).alias("status"), F.min(c).alias("lo"), F.max(c).alias("hi"), F.median(c).alias("mid"), F.round(F.avg(c), 9).alias("mean"))


@query(f"{cte('qc')} SELECT replicate_status AS grp, count(*) AS n, CASE WHEN bool_or(balance_status = 'NOT_ASSESSED') THEN 'NOT_ASSESSED' WHEN bool_or(balance_status = 'WARN') THEN 'WARN' ELSE 'PASS' END AS worst, count(*) FILTER (balance_status = 'PASS') AS n_pass, round(avg(CASE WHEN yield_pct = 0 THEN 0.0 ELSE 100.0 * dup_pct / yield_pct END), 6) AS pct FROM qc GROUP BY ALL")
def agg22_balance_summary(spark, d):
    q = table(spark, d, "qc")
    return q.groupBy(F.col("replicate_status").alias("grp")).agg(F.count("*").alias("n"), fn.worst_balance(F.col("balance_status")).alias("worst"), F.count_if(F.col("balance_status") == "PASS").alias("n_pass"), F.round(F.avg(fn.percent(F.col("dup_pct"), F.col("yield_pct"))), 6).alias("pct"))


@query(f"{cte('design')} SELECT subject_id, count(*) FILTER (arm = 'BUILDING') AS n_case, count(*) FILTER (arm = 'MACHINERY') AS n_control, max(CASE WHEN arm = 'BUILDING' THEN sample_id END) AS case_sample, max(CASE WHEN arm = 'MACHINERY' THEN sample_id END) AS control_sample FROM design GROUP BY subject_id")
def agg30_pair_roster(spark, d):
    return differential.pair_roster(table(spark, d, "design"), "BUILDING", "MACHINERY")


@query(f"{cte('design')} SELECT a.sample_id AS sample, count(b.sample_id) AS n_siblings, least(2, greatest(1, count(b.sample_id))) AS least_support FROM design a LEFT JOIN design b ON a.arm = b.arm AND a.subject_id <> b.subject_id AND a.sample_id <> b.sample_id GROUP BY ALL")
def join20_siblings(spark, d):
    """How many samples of the same arm come from other subjects: counts instead of pairs."""
    x = table(spark, d, "design")
    arm, own = x.groupBy("arm").agg(F.count("*").alias("n")), x.groupBy("arm", "subject_id").agg(F.count("*").alias("m"))
    n = F.col("n") - F.col("m")
    return x.join(arm, "arm").join(own, ["arm", "subject_id"]).select(F.col("sample_id").alias("sample"), n.alias("n_siblings"), F.least(F.lit(2).cast("long"), F.greatest(F.lit(1).cast("long"), n)).alias("least_support"))


_COUNTS = f"{_BASE}, g AS (SELECT sha1(concat_ws(chr(31), c.chrom1, c.start1, c.end1, c.chrom2, c.start2, c.end2)) AS loop_key, s.sample, coalesce(k.score, 0) AS count FROM cand c CROSS JOIN (SELECT DISTINCT sample FROM calls) s LEFT JOIN calls k USING (sample, chrom1, start1, end1, chrom2, start2, end2))"
_FACTORS = "l AS (SELECT *, min(count) OVER (PARTITION BY loop_key) AS lo, ln(count::DOUBLE + CASE WHEN count = 0 THEN 1 ELSE 0 END) AS x FROM g), r AS (SELECT sample, x - avg(x) OVER (PARTITION BY loop_key) AS r FROM l WHERE lo > 0), sf AS (SELECT sample, exp(median(r)) AS size_factor FROM r GROUP BY sample)"


def _counts(spark, d):
    u = universe.universe_counts(eligible_all(spark, d), universe.support(eligible(spark, d), 2))
    return u.select(fn.loop_key(*map(F.col, universe.COORDS)).alias("loop_key"), "sample", F.col("score").alias("count"))


def eligible_all(spark, d):
    from .contacts import calls

    return calls(spark, d)


@query(f"{_COUNTS}, {_FACTORS} SELECT sample, round(size_factor, 6) AS size_factor FROM sf")
def mdl01_size_factors(spark, d):
    return differential.size_factors(_counts(spark, d)).withColumn("size_factor", F.round("size_factor", 6))


@query(f"{_COUNTS}, {_FACTORS}, v AS (SELECT loop_key, sample, count / size_factor AS v FROM g JOIN sf USING (sample)) SELECT a.loop_key, p.subject_id, round(log2((a.v + 1) / (b.v + 1)), 6) AS log2_ratio FROM (VALUES ('p0', 's0', 's1'), ('p1', 's2', 's3')) p(subject_id, ca, co) JOIN v a ON a.sample = ca JOIN v b ON b.sample = co AND a.loop_key = b.loop_key")
def fn01_paired_effects(spark, d):
    c = _counts(spark, d)
    roster = spark.createDataFrame([("p0", "s0", "s1"), ("p1", "s2", "s3")], "subject_id string, case_sample string, control_sample string")
    out = differential.paired_effects(differential.normalised(c, differential.size_factors(c)), roster)
    return out.select("loop_key", "subject_id", F.round("log2_ratio", 6).alias("log2_ratio"))


@query()
def pip05_differential(spark, d):
    """Wald tests of two pairs for each loop, adjusted."""
    import pandas as pd

    c = _counts(spark, d)
    design = pd.DataFrame({"sample": ["s0", "s1", "s2", "s3"], "subject_id": ["p0", "p0", "p1", "p1"], "arm": ["case", "control"] * 2})
    rank, width = differential.design_rank(design, ["subject_id", "arm"])
    if rank < width:
        raise ValueError("the design is confounded")
    tested = differential.negative_binomial(c, differential.size_factors(c), design, "case")
    out = differential.benjamini_hochberg(tested.withColumn("all", F.lit(1)), ["all"]).drop("all")
    return out.withColumn("significant", fn.significant(F.col("padj"), F.col("log2_fold_change")))


@query(f"""{cte('loops')}, p AS (SELECT sample, chrom1, start1, start2, pvalue, count(*) OVER (PARTITION BY sample, chrom1) AS n, rank() OVER (PARTITION BY sample, chrom1 ORDER BY pvalue) + count(*) OVER (PARTITION BY sample, chrom1, pvalue) - 1 AS k FROM loops)
SELECT sample, chrom1, start1, start2, round(least(1.0, min(pvalue * n / k) OVER (PARTITION BY sample, chrom1 ORDER BY pvalue DESC RANGE UNBOUNDED PRECEDING)), 9) AS padj FROM p""")
def win10_adjusted(spark, d):
    p = table(spark, d, "loops").withColumn("pvalue", F.col("pvalue").cast("double"))
    return differential.benjamini_hochberg(p, ["sample", "chrom1"]).select("sample", "chrom1", "start1", "start2", F.round("padj", 9).alias("padj"))


@query(f"{cte('bins')} SELECT chrom, s, CAST(row_number() OVER (ORDER BY chrom, s) - 1 AS BIGINT) AS node FROM bins")
def win06_node_index(spark, d):
    return graph.node_index(table(spark, d, "bins").select("chrom", "s")).select("chrom", "s", "node")


_NODES = "nd AS (SELECT chrom, s, CAST(row_number() OVER (ORDER BY chrom, s) - 1 AS BIGINT) AS node FROM (SELECT DISTINCT chrom, s // 25000 * 25000 AS s FROM bins))"


def _coarse(spark, d):
    return graph.node_index(table(spark, d, "bins").select("chrom", fn.snap_start(F.col("s"), 25_000).alias("s")).distinct())


@query(f"""{cte('bins', 'loops')}, {_NODES}, e AS (SELECT least(a.node, b.node) AS src, greatest(a.node, b.node) AS dst, l.* FROM loops l JOIN nd a ON a.chrom = l.chrom1 AND a.s = l.start1 // 25000 * 25000 JOIN nd b ON b.chrom = l.chrom2 AND b.s = l.start2 // 25000 * 25000 WHERE a.node <> b.node),
g AS (SELECT src, dst, CAST(max(score) AS DOUBLE) AS score, CAST(min(pvalue) AS DOUBLE) AS pvalue, CAST(min(fdr) AS DOUBLE) AS fdr, max(start2 // 25000 * 25000 - start1 // 25000 * 25000) AS distance, count(*) AS n FROM e GROUP BY src, dst)
SELECT src, dst, score, round(pvalue, 9) AS pvalue, round(fdr, 9) AS fdr, distance, n FROM g UNION ALL SELECT dst, src, score, round(pvalue, 9), round(fdr, 9), distance, n FROM g""")
def agg10_loop_edges(spark, d):
    e = graph.loop_edges(table(spark, d, "loops"), _coarse(spark, d), 25_000)
    return e.withColumns({c: F.round(c, 9) for c in ("pvalue", "fdr")})


@query(f"{cte('bins')}, {_NODES}, x AS (SELECT node AS src, lead(node) OVER (PARTITION BY chrom ORDER BY node) AS dst FROM nd) SELECT src, dst FROM x WHERE dst IS NOT NULL UNION ALL SELECT dst, src FROM x WHERE dst IS NOT NULL")
def win05_neighbour_edges(spark, d):
    return graph.neighbour_edges(_coarse(spark, d))


@query(f"{cte('bins')}, {_NODES}, f AS (SELECT chrom, s, CAST(row_number() OVER (ORDER BY chrom, s) - 1 AS BIGINT) AS node FROM bins) SELECT f.node AS child, nd.node AS parent FROM f JOIN nd ON nd.chrom = f.chrom AND nd.s = f.s // 25000 * 25000")
def join18_containment(spark, d):
    return graph.containment(graph.node_index(table(spark, d, "bins").select("chrom", "s")), _coarse(spark, d), 25_000)


@query(f"""{cte('bins', 'blacklist', 'track')}, v AS (SELECT b.bin_id, sum(t.value * (least(b.e, t.e) - greatest(b.s, t.s))) / sum(least(b.e, t.e) - greatest(b.s, t.s)) AS value FROM bins b LEFT JOIN track t ON t.chrom = b.chrom AND t.s < b.e AND t.e > b.s GROUP BY ALL), {_HIT}
SELECT bin_id, bin_id NOT IN (FROM blk) AND value IS NOT NULL AS value_observed, CASE WHEN bin_id NOT IN (FROM blk) AND value IS NOT NULL THEN round(value, 6) ELSE 0.0 END AS value FROM v""")
def pip13_node_features(spark, d):
    """Features with their observed masks; blocked and unreached bins are unobserved and zero."""
    b = table(spark, d, "bins")
    v = intervals.weighted_mean(b, table(spark, d, "track"), ["chrom", "s", "e"]).select("bin_id", "chrom", "s", "e", "value")
    flagged = intervals.with_overlap_flag(v, table(spark, d, "blacklist"), ["bin_id"], "blocked")
    return graph.masked_features(flagged, ["value"], "blocked").select("bin_id", "value_observed", F.round("value", 6).alias("value"))


@query("SELECT event_id, CASE WHEN lower(trim(t)) IN ('na', 'nan') THEN NULL WHEN TRY_CAST(t AS DOUBLE) BETWEEN 0 AND 1 THEN TRY_CAST(t AS DOUBLE) END AS value, coalesce(lower(trim(t)) IN ('na', 'nan') OR TRY_CAST(t AS DOUBLE) BETWEEN 0 AND 1, false) AS valid FROM (SELECT event_id, CASE event_id % 5 WHEN 0 THEN 'NA' WHEN 1 THEN ' nan ' WHEN 2 THEN '0.' || (event_id % 100) WHEN 3 THEN 'inf' ELSE 'garbage' END AS t FROM events)")
def fn06_probabilities(spark, d):
    e = table(spark, d, "events")
    k = F.col("event_id") % 5
    t = F.when(k == 0, "NA").when(k == 1, " nan ").when(k == 2, F.concat(F.lit("0."), (F.col("event_id") % 100).cast("string"))).when(k == 3, "inf").otherwise("garbage")
    return e.select("event_id", fn.probability(t).alias("p")).select("event_id", "p.value", "p.valid")


@query("SELECT event_type AS sample, count(*) AS n, CAST(sum(TRY_CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS k FROM events GROUP BY ALL")
def src18_json_values(spark, d):
    e = table(spark, d, "events")
    return e.groupBy(F.col("event_type").alias("sample")).agg(F.count("*").alias("n"), F.sum(F.get_json_object("props", "$.k").try_cast("long")).alias("k"))


@query(f"{cte('chroms')} SELECT chrom, CAST(0 AS BIGINT) AS s, size AS e, chrom AS name FROM chroms WHERE regexp_full_match(chrom, 'chr([0-9]+|X)')")
def src22_main_view(spark, d):
    from ..sources.readers import main_view

    return main_view(table(spark, d, "chroms"))


@query("SELECT c_custkey AS id, 'H3K27ac_' || substr(sha256('arm=' || c_mktsegment || '|nation=' || c_nationkey), 1, 12) AS grp, CAST(('0x' || substr(sha256(least(c_name, c_mktsegment) || '|' || greatest(c_name, c_mktsegment)), 1, 8)) AS BIGINT) AS seed FROM customer")
def prj07_group_key(spark, d):
    c = table(spark, d, "customer")
    return c.select(F.col("c_custkey").alias("id"), fn.group_key(F.lit("H3K27ac"), arm=F.col("c_mktsegment"), nation=F.col("c_nationkey")).alias("grp"), fn.pair_seed(F.col("c_name"), F.col("c_mktsegment")).alias("seed"))
