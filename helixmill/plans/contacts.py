"""Queries on contacts, loops and the hypothesis universe."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..adapters import WIDTH, cte, table
from ..functions import coords as fn
from ..operators import contracts, matching, matrix, universe
from ..operators.intervals import blocked_loops

LOWER, UPPER, MIN_COUNT, MIN_SAMPLES = 20_000, 3_000_000, 5, 2
QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


PRIMARY_SQL = "regexp_full_match({}, 'chr(?:[1-9]|1[0-9]|2[0-2]|X)')"
_CALLS = "calls AS (SELECT sample, chrom AS chrom1, start1, start1 + 5000 AS end1, chrom AS chrom2, start2, start2 + 5000 AS end2, score FROM contacts)"
_BLOCKED = "EXISTS (SELECT 1 FROM blacklist b WHERE b.chrom = c.chrom1 AND ((c.start1 < b.e AND c.end1 > b.s) OR (c.start2 < b.e AND c.end2 > b.s)))"
_ELIGIBLE = f"elig AS (SELECT * FROM calls c WHERE {PRIMARY_SQL.format('chrom1')} AND start2 - start1 BETWEEN 20000 AND 3000000 AND score >= 5 AND NOT {_BLOCKED})"
_CAND = "cand AS (SELECT chrom1, start1, end1, chrom2, start2, end2, CAST(count(*) AS BIGINT) AS support FROM elig GROUP BY ALL HAVING count(*) >= 2)"
_BASE = f"{cte('contacts', 'blacklist')}, {_CALLS}, {_ELIGIBLE}, {_CAND}"


def calls(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "contacts")
    return c.select("sample", F.col("chrom").alias("chrom1"), "start1", (F.col("start1") + WIDTH).alias("end1"), F.col("chrom").alias("chrom2"), "start2", (F.col("start2") + WIDTH).alias("end2"), "score")


def eligible(spark: SparkSession, d: str) -> DataFrame:
    return universe.eligible(calls(spark, d), table(spark, d, "blacklist"), MIN_COUNT, LOWER, UPPER)


@query(f"{_BASE} SELECT c.*, s.sample, coalesce(k.score, 0) AS score FROM cand c CROSS JOIN (SELECT DISTINCT sample FROM calls) s LEFT JOIN calls k USING (sample, chrom1, start1, end1, chrom2, start2, end2)")
def pip03_universe(spark, d):
    """Candidates supported by enough samples, with zero-filled counts of every sample."""
    return universe.universe_counts(calls(spark, d), universe.support(eligible(spark, d), MIN_SAMPLES))


@query(f"{_BASE} SELECT * FROM cand")
def agg01_candidate_support(spark, d):
    return universe.support(eligible(spark, d), MIN_SAMPLES)


@query(f"""{_BASE}, g AS (SELECT c.*, s.sample, coalesce(k.score, 0) AS score FROM cand c CROSS JOIN (SELECT DISTINCT sample FROM calls) s LEFT JOIN calls k USING (sample, chrom1, start1, end1, chrom2, start2, end2))
SELECT chrom1, start1, end1, chrom2, start2, end2, count(*) FILTER (score >= 5) AS support, coalesce(string_agg(sample, ',' ORDER BY sample) FILTER (score >= 5), '') AS support_samples,
'{{' || string_agg('"' || sample || '":' || score, ',' ORDER BY sample) || '}}' AS source_counts FROM g GROUP BY ALL""")
def fn18_support_table(spark, d):
    return universe.support_table(pip03_universe(spark, d), MIN_COUNT)


@query(f"{_BASE} SELECT e.* FROM elig e SEMI JOIN cand USING (chrom1, start1, end1, chrom2, start2, end2)")
def join08_candidate_rows(spark, d):
    e = eligible(spark, d)
    return e.join(universe.support(e, MIN_SAMPLES), universe.COORDS, "left_semi").select(*e.columns)


@query(f"{_BASE} SELECT e.sample, e.score + 1 AS score, c.score AS all_score, chrom1, start1, end1, chrom2, start2, end2 FROM elig e JOIN calls c USING (sample, chrom1, start1, end1, chrom2, start2, end2) WHERE e.score % 7 = 0")
def chk09_score_mismatch(spark, d):
    """The anti-check finds exactly the scores that were tampered with."""
    e = eligible(spark, d)
    bad = e.withColumn("score", F.when(F.col("score") % 7 == 0, F.col("score") + 1).otherwise(F.col("score")))
    return universe.inconsistent(calls(spark, d), bad).select("sample", "score", "all_score", *universe.COORDS)


@query(f"""{_BASE} SELECT count(*) AS input, count(*) FILTER (NOT {PRIMARY_SQL.format('chrom1')}) AS non_primary,
count(*) FILTER ({PRIMARY_SQL.format('chrom1')} AND {_BLOCKED}) AS blocked, count(*) FILTER ({PRIMARY_SQL.format('chrom1')} AND NOT {_BLOCKED}) AS retained,
count(*) FILTER ({PRIMARY_SQL.format('chrom1')} AND NOT {_BLOCKED} AND score >= 5) AS eligible FROM calls c""")
def agg02_row_audit(spark, d):
    """Every input row is counted as removed or retained."""
    rows = blocked_loops(calls(spark, d), table(spark, d, "blacklist"))
    main = fn.primary(F.col("chrom1"), F.col("chrom2"))
    audit = contracts.count_by(rows, non_primary=~main, blocked=main & F.col("blocked"), retained=main & ~F.col("blocked"), eligible=main & ~F.col("blocked") & (F.col("score") >= MIN_COUNT))
    contracts.assert_empty(contracts.conserved(audit, "input", ["non_primary", "blocked", "retained"]), "rows got lost")
    return audit


_LABEL = f"CASE WHEN NOT {PRIMARY_SQL.format('chrom1')} THEN '1 chromosome' WHEN start1 = start2 THEN '2 same bin' WHEN {_BLOCKED} THEN '3 blacklist' WHEN score < 6 THEN '4 reads' ELSE '5 kept' END"


@query(f"{_BASE} SELECT sample, {_LABEL} AS outcome, count(*) AS n FROM calls c GROUP BY ALL")
def agg03_filter_audit(spark, d):
    """Each removal counted after the filters before it."""
    rows = blocked_loops(calls(spark, d), table(spark, d, "blacklist"))
    label = F.when(~fn.primary(F.col("chrom1")), "1 chromosome").when(F.col("start1") == F.col("start2"), "2 same bin").when(F.col("blocked"), "3 blacklist").when(F.col("score") < 6, "4 reads").otherwise("5 kept")
    return rows.groupBy("sample", label.alias("outcome")).agg(F.count("*").alias("n"))


@query(f"{_BASE} SELECT * EXCLUDE (end1, end2, chrom2) FROM calls c WHERE {_LABEL} = '5 kept'")
def pip02_reporting_filter(spark, d):
    rows = blocked_loops(calls(spark, d), table(spark, d, "blacklist"))
    return rows.where(fn.primary(F.col("chrom1"), F.col("chrom2")) & (F.col("start1") != F.col("start2")) & ~F.col("blocked") & (F.col("score") >= 6)).select("sample", "chrom1", "start1", "start2", "score")


@query(f"{_BASE} SELECT sha1(concat_ws(chr(31), chrom1, start1, end1, chrom2, start2, end2)) AS loop_key, support FROM cand")
def prj06_loop_key(spark, d):
    u = universe.support(eligible(spark, d), MIN_SAMPLES)
    return u.select(fn.loop_key(*map(F.col, universe.COORDS)).alias("loop_key"), "support")


@query(f"""{cte('contacts')}, m AS (SELECT sample, chrom, start1 + 1700 AS a, start1 + 4100 AS b, start2 - 900 AS c, start2 + 3300 AS d, score FROM contacts)
SELECT sample, chrom, least((a + b) // 2 // 10000 * 10000, (c + d) // 2 // 10000 * 10000) AS start1, greatest((a + b) // 2 // 10000 * 10000, (c + d) // 2 // 10000 * 10000) AS start2, CAST(sum(score) AS BIGINT) AS score
FROM m WHERE (a + b) // 2 // 10000 <> (c + d) // 2 // 10000 GROUP BY ALL""")
def prj02_snap_midpoints(spark, d):
    """Anchors snapped by midpoint, ordered, same-bin ones dropped."""
    c = table(spark, d, "contacts")
    a = fn.snap_mid(F.col("start1") + 1700, F.col("start1") + 4100, 10_000)
    b = fn.snap_mid(F.col("start2") - 900, F.col("start2") + 3300, 10_000)
    return c.select("sample", "chrom", F.least(a, b).alias("start1"), F.greatest(a, b).alias("start2"), "score").where("start1 <> start2").groupBy("sample", "chrom", "start1", "start2").agg(F.sum("score").alias("score"))


@query(f"""{_BASE}, l AS (SELECT DISTINCT chrom1 AS chrom, start1, start1 + 15000 AS e1, start2, start2 + 10000 AS e2 FROM elig),
px AS (SELECT DISTINCT chrom, start1, start2, least(x, y) * 5000 AS p1, greatest(x, y) * 5000 AS p2 FROM (SELECT *, unnest(range(start1 // 5000, (e1 - 1) // 5000 + 1)) AS x FROM l) a, unnest(range(start2 // 5000, (e2 - 1) // 5000 + 1)) AS u(y) WHERE (y - x) * 5000 BETWEEN 20000 AND 3000000)
SELECT l.chrom, l.start1, l.start2, s.sample, CAST(coalesce(sum(c.score), 0) AS BIGINT) AS n FROM l CROSS JOIN (SELECT DISTINCT sample FROM contacts) s LEFT JOIN px USING (chrom, start1, start2) LEFT JOIN contacts c ON c.sample = s.sample AND c.chrom = px.chrom AND c.start1 = p1 AND c.start2 = p2 GROUP BY ALL""")
def pip04_loop_counts(spark, d):
    """Contacts in all pixels that a loop's anchors span; shared pixels count for every loop."""
    e = eligible(spark, d).select("chrom1", "start1", (F.col("start1") + 15000).alias("end1"), "chrom2", "start2", (F.col("start2") + 10000).alias("end2")).distinct()
    out = matrix.count_loops(e, table(spark, d, "contacts"), WIDTH, LOWER, UPPER, ["chrom1", "start1", "end1", "start2", "end2"])
    return out.select(F.col("chrom1").alias("chrom"), "start1", "start2", "sample", "n")


@query(f"{cte('loops')} SELECT sample, chrom1, start1, start2, score, fdr FROM loops WHERE fdr <= 0.05 + 1e-10 AND {PRIMARY_SQL.format('chrom1')} AND start2 - start1 <> 0")
def fn07_q_threshold(spark, d):
    x = table(spark, d, "loops")
    return x.where(fn.within_q(F.col("fdr"), 0.05) & fn.primary(F.col("chrom1")) & (F.col("start1") != F.col("start2"))).select("sample", "chrom1", "start1", "start2", "score", "fdr")


@query(f"{_BASE} SELECT sample, chrom1, start1, start2, score, CASE WHEN chrom1 = 'chrUn_1' THEN 'order' END AS x FROM calls WHERE false")
def chk01_geometry(spark, d):
    """Violations of loop geometry; the calls are sound, so there are none."""
    sized = calls(spark, d).join(F.broadcast(table(spark, d, "chroms")), F.col("chrom1") == F.col("chrom"))
    bad = contracts.violations(sized, contracts.loop_geometry(WIDTH, 5000, UPPER, F.col("size")))
    return bad.select("sample", "chrom1", "start1", "start2", "score", F.col("broken").alias("x"))


@query(f"{cte('contacts')} SELECT sample, chrom, start1, start2, CASE WHEN start2 - start1 < 20000 THEN 'distance,grid' ELSE 'grid' END AS broken FROM contacts WHERE score % 5 = 0 UNION ALL SELECT sample, chrom, start1, start2, 'distance' FROM contacts WHERE score % 5 <> 0 AND start2 - start1 < 20000")
def chk01_broken_geometry(spark, d):
    """Shifted anchors and short loops are named by the rules they break."""
    moved = F.when(F.col("score") % 5 == 0, 1).otherwise(0)
    c = calls(spark, d).withColumns({"o1": F.col("start1"), "o2": F.col("start2")}).withColumns({k: F.col(k) + moved for k in ("start1", "end1", "start2", "end2")})
    return contracts.violations(c, contracts.loop_geometry(WIDTH, LOWER, UPPER, F.lit(10**9))).select("sample", F.col("chrom1").alias("chrom"), F.col("o1").alias("start1"), F.col("o2").alias("start2"), "broken")


@query(f"{cte('pairs')} SELECT chrom1, pos1, chrom2, pos2, count(*) AS n FROM pairs GROUP BY ALL HAVING count(*) > 1")
def chk07_duplicates(spark, d):
    return contracts.duplicates(table(spark, d, "pairs"), ["chrom1", "pos1", "chrom2", "pos2"])


@query(f"{_BASE}, a AS (SELECT chrom1, start1, start2 FROM elig WHERE sample = 's0'), b AS (SELECT chrom1, start1, start2 FROM elig WHERE sample = 's1') SELECT *, 'left' AS side FROM (FROM a EXCEPT ALL FROM b) UNION ALL SELECT *, 'right' FROM (FROM b EXCEPT ALL FROM a)")
def set03_differences(spark, d):
    e = eligible(spark, d)
    one, two = (e.where(F.col("sample") == s).select("chrom1", "start1", "start2") for s in ("s0", "s1"))
    return contracts.set_difference(one, two)


@query(f"{_BASE}, a AS (SELECT DISTINCT chrom1, start1, start2 FROM elig WHERE sample = 's0'), b AS (SELECT DISTINCT chrom1, start1, start2 FROM elig WHERE sample = 's1') SELECT * FROM (FROM a INTERSECT FROM b)")
def set04_intersection(spark, d):
    e = eligible(spark, d)
    one, two = (e.where(F.col("sample") == s).select("chrom1", "start1", "start2") for s in ("s0", "s1"))
    return one.intersect(two)


_MATCH0 = f"""{_BASE}, p AS (SELECT DISTINCT chrom1, start1, start2 FROM elig WHERE sample = 's0'), o AS (SELECT DISTINCT chrom1, start1, start2 FROM elig WHERE sample = 's2'),
m AS (SELECT count(*) AS k FROM (FROM p INTERSECT FROM o)), n AS (SELECT (SELECT count(*) FROM p) AS np, (SELECT count(*) FROM o) AS no)"""


def _places(spark, d, sample):
    return eligible(spark, d).where(F.col("sample") == sample).select(F.col("chrom1").alias("chrom"), "start1", "start2")


@query(f"{_MATCH0} SELECT np AS n_primary, no AS n_other, k AS n_matched, k / nullif(np + no - k, 0) AS jaccard, k / nullif(np, 0) AS primary_share, k / nullif(no, 0) AS other_share FROM m, n")
def set06_exact_concordance(spark, d):
    a, b = _places(spark, d, "s0"), _places(spark, d, "s2")
    return matching.concordance_summary(a, b, matching.greedy_matching(matching.candidate_matches(a, b, WIDTH, 0)))


@query()
def join15_tolerant_matching(spark, d):
    """One-to-one matches within one bin, nearest first."""
    a, b = _places(spark, d, "s0"), _places(spark, d, "s2")
    return matching.greedy_matching(matching.candidate_matches(a, b, WIDTH, 1))


@query(f"""{_BASE}, p AS (SELECT DISTINCT chrom1 AS chrom, start1 AS p1, start2 AS p2 FROM elig WHERE sample = 's0'), o AS (SELECT DISTINCT chrom1 AS chrom, start1 AS o1, start2 AS o2 FROM elig WHERE sample = 's2')
SELECT chrom, p1, p2, o1, o2, abs(p1 - o1) + abs(p2 - o2) AS distance FROM p JOIN o USING (chrom) WHERE abs(p1 - o1) <= 5000 AND abs(p2 - o2) <= 5000""")
def prj14_candidate_matches(spark, d):
    return matching.candidate_matches(_places(spark, d, "s0"), _places(spark, d, "s2"), WIDTH, 1).select("chrom", "p1", "p2", "o1", "o2", "distance")


@query(f"""{_BASE}, p AS (SELECT DISTINCT sample, chrom1 AS chrom, start1, start2 FROM elig)
SELECT a.chrom, a.start1, a.start2, count(DISTINCT b.sample) AS support, string_agg(DISTINCT b.sample, ',' ORDER BY b.sample) AS samples FROM (SELECT DISTINCT chrom, start1, start2 FROM p) a JOIN p b ON a.chrom = b.chrom AND abs(a.start1 - b.start1) <= 5000 AND abs(a.start2 - b.start2) <= 5000 GROUP BY ALL""")
def join16_tolerant_support(spark, d):
    p = eligible(spark, d).select("sample", F.col("chrom1").alias("chrom"), "start1", "start2")
    out = matching.tolerant_support(p, WIDTH, 1)
    return out.select("chrom", "start1", "start2", F.col("support").cast("long").alias("support"), F.array_join("samples", ",").alias("samples"))


def _keep(spark: SparkSession):
    """Writes a round's table to the checkpoint folder: the session's, or one of our own where none is set and all run on this machine."""
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        at = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
        if not at and not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(at or tempfile.mkdtemp(prefix="helixmill-"))
    return lambda df, name: df.checkpoint().toDF(*df.columns)


@query()
def pip06_consensus_loops(spark, d):
    """Loops that at least three samples call within a bin."""
    p = eligible(spark, d).select("sample", F.col("chrom1").alias("chrom"), "start1", "start2")
    return matching.consensus_loops(p, WIDTH, 1, 3, table(spark, d, "chroms"))


@query(f"{_BASE} SELECT chrom1, start1, start1 + 5000 AS end1, chrom1 AS chrom2, start2, start2 + 5000 AS end2, count(DISTINCT sample) AS support, string_agg(DISTINCT sample, ',' ORDER BY sample) AS samples FROM elig GROUP BY ALL HAVING count(DISTINCT sample) >= 2")
def pip06_consensus_exact(spark, d):
    """Without tolerance a consensus is a count."""
    p = eligible(spark, d).select("sample", F.col("chrom1").alias("chrom"), "start1", "start2")
    out = matching.consensus_loops(p, WIDTH, 0, 2, table(spark, d, "chroms"))
    return out.withColumn("support", F.col("support").cast("long"))


_RANK = "CASE WHEN chrom1 = 'chrX' THEN 23 WHEN chrom1 = 'chrY' THEN 24 WHEN chrom1 LIKE 'chrUn%' THEN 1000000 ELSE CAST(substr(chrom1, 4) AS INTEGER) END"


@query(f"{_BASE} SELECT chrom1, start1, start2, support, CAST(row_number() OVER (ORDER BY {_RANK}, start1, start2) AS INTEGER) AS place FROM cand")
def sort05_natural_order(spark, d):
    """Every candidate's place in natural order: its place on the chromosome after all of the chromosomes before."""
    u = universe.support(eligible(spark, d), MIN_SAMPLES).withColumn("r", fn.natural_rank(F.col("chrom1")))
    sizes = u.groupBy("r", "chrom1").agg(F.count("*").alias("n"))
    before = sizes.select("chrom1", (F.sum("n").over(Window.orderBy("r", "chrom1")) - F.col("n")).alias("before"))  # a row for each chromosome
    own = F.row_number().over(Window.partitionBy("chrom1").orderBy("start1", "start2"))
    return u.withColumn("own", own).join(F.broadcast(before), "chrom1").select("chrom1", "start1", "start2", "support", (F.col("before") + F.col("own")).cast("int").alias("place"))


@query(f"{cte('loops')} SELECT chrom1, start1, start2, sample, score, fdr FROM loops ORDER BY fdr, chrom1, start1, start2, sample LIMIT 12")
def sort07_top_loops(spark, d):
    return table(spark, d, "loops").orderBy("fdr", "chrom1", "start1", "start2", "sample").select("chrom1", "start1", "start2", "sample", "score", "fdr").limit(12)


@query(f"{cte('loops')} SELECT chrom1, start1, min(sample) AS sample FROM loops GROUP BY ALL")
def sort06_first_per_place(spark, d):
    first = F.row_number().over(Window.partitionBy("chrom1", "start1").orderBy("sample", "start2"))
    return table(spark, d, "loops").withColumn("r", first).where("r = 1").select("chrom1", "start1", "sample")
