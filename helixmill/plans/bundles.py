"""Queries on whole results: windows and controls, replicates, bundles and their broken twins, settings, reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..adapters import SQL, WIDTH, cte, table
from ..functions import coords as fn
from ..operators import aggregate_peaks, bundles, matrix, reporting
from .contacts import _BASE, MIN_COUNT, MIN_SAMPLES, PRIMARY_SQL, _keep, pip03_universe, query
from .rules import SAMPLES, _candidates
from .tracks import _apa_loops, _one_sample

WIN = 5

# Windows around loops and their matched controls

_BINS = f"""all1 AS (SELECT chrom, start1, start2, sum(score) AS score FROM contacts GROUP BY ALL),
depth AS (SELECT chrom, p AS s, sum(score) AS total FROM (SELECT chrom, start1 AS p, score FROM contacts UNION ALL SELECT chrom, start2, score FROM contacts) x GROUP BY ALL),
bins AS ({SQL['bins']}), peaks AS ({SQL['peaks']}), chroms AS ({SQL['chroms']}),
pb AS (SELECT DISTINCT chrom, unnest(range(s // 5000, (e - 1) // 5000 + 1)) * 5000 AS s FROM peaks),
bb AS (SELECT DISTINCT chrom, unnest(range(s // 5000, (e - 1) // 5000 + 1)) * 5000 AS s FROM blacklist),
bt AS (SELECT b.chrom, b.s, coalesce(d.total, 0) AS total, pb.s IS NOT NULL AS anchor, bb.s IS NOT NULL AS blocked, c.size FROM bins b JOIN chroms c USING (chrom) LEFT JOIN depth d ON d.chrom = b.chrom AND d.s = b.s LEFT JOIN pb ON pb.chrom = b.chrom AND pb.s = b.s LEFT JOIN bb ON bb.chrom = b.chrom AND bb.s = b.s),
lp AS (SELECT chrom1 AS chrom, start1, start2 FROM cand WHERE support >= 3 AND start2 - start1 >= 60000)"""
_APA = f"{_BASE}, {_BINS}"


def _bin_table(spark, d):
    """Bins with their depth, whether a peak or the blacklist meets them, and the chromosome's size."""
    ends = table(spark, d, "contacts").select("chrom", F.explode(F.array("start1", "start2")).alias("s"), "score").groupBy("chrom", "s").agg(F.sum("score").alias("total"))
    spread = lambda name, flag: table(spark, d, name).select("chrom", F.explode(F.expr(f"sequence(s div {WIDTH} * {WIDTH}, (e - 1) div {WIDTH} * {WIDTH}, cast({WIDTH} as bigint))")).alias("s")).distinct().withColumn(flag, F.lit(True))
    out = table(spark, d, "bins").select("chrom", "s").join(F.broadcast(table(spark, d, "chroms")), "chrom").join(ends, ["chrom", "s"], "left")
    out = out.join(spread("peaks", "anchor"), ["chrom", "s"], "left").join(spread("blacklist", "blocked"), ["chrom", "s"], "left")
    return out.select("chrom", "s", F.coalesce("total", F.lit(0)).alias("total"), *(F.coalesce(c, F.lit(False)).alias(c) for c in ("anchor", "blocked")), "size")


@query(f"""{_APA}, off AS (SELECT unnest(range(-5, 6)) AS o),
cell AS (SELECT lp.chrom, lp.start1, lp.start2, y.o AS dy, x.o AS dx, CASE WHEN NOT u.blocked AND u.total >= 300 AND NOT v.blocked AND v.total >= 300 THEN coalesce(a.score, 0) END AS v FROM lp CROSS JOIN off y CROSS JOIN off x
  JOIN bt u ON u.chrom = lp.chrom AND u.s = lp.start1 + y.o * 5000 JOIN bt v ON v.chrom = lp.chrom AND v.s = lp.start2 + x.o * 5000 LEFT JOIN all1 a ON a.chrom = lp.chrom AND a.start1 = u.s AND a.start2 = v.s),
ok AS (SELECT chrom, start1, start2 FROM cell GROUP BY ALL HAVING count(*) = 121 AND count(v) >= 0.8 * 121 AND bool_or(dy = 0 AND dx = 0 AND v IS NOT NULL))
SELECT CAST(dy AS INTEGER) AS dy, CAST(dx AS INTEGER) AS dx, round(avg(v), 6) AS mean, count(v) AS n, count(*) AS n_windows FROM cell SEMI JOIN ok USING (chrom, start1, start2) GROUP BY ALL""")
def flt13_usable_windows(spark, d):
    """The mean window of loops whose window is whole and mostly known; cells of masked bins don't count."""
    bins = _bin_table(spark, d).select("chrom", "s", (~F.col("blocked") & (F.col("total") >= 300)).alias("usable"))
    cells = aggregate_peaks.windows(_apa_loops(spark, d), _one_sample(spark, d), WIDTH, WIN, bins)
    kept = aggregate_peaks.usable_windows(cells, WIN)
    return kept.groupBy("dy", "dx").agg(F.round(F.avg("value"), 6).alias("mean"), F.count("value").alias("n"), F.count("*").alias("n_windows"))


_CONTROLS = f"""{_APA}, known AS (SELECT lp.*, a.total AS t1, b.total AS t2, a.anchor AS a1, b.anchor AS a2, a.size FROM lp JOIN bt a ON a.chrom = lp.chrom AND a.s = start1 JOIN bt b ON b.chrom = lp.chrom AND b.s = start2 WHERE a.anchor OR b.anchor),
tries AS (SELECT *, md5(concat_ws('|', 42, chrom, start1, start2, draw, attempt)) AS h FROM known, (SELECT unnest(range(20)) AS draw) x, (SELECT unnest(range(200)) AS attempt) y),
moved AS (SELECT *, (CAST('0x' || substr(h, 1, 8) AS BIGINT) % ((1000000 - 30000) // 5000) * 5000 + 30000) * CASE WHEN CAST('0x' || substr(h, 9, 1) AS BIGINT) < 8 THEN 1 ELSE -1 END AS shift FROM tries),
fit AS (SELECT m.chrom, m.start1, m.start2, draw, attempt, start1 + shift AS c1, start2 + shift AS c2 FROM moved m JOIN bt a ON a.chrom = m.chrom AND a.s = start1 + shift JOIN bt b ON b.chrom = m.chrom AND b.s = start2 + shift
  WHERE start1 + shift >= 25000 AND start2 + shift + 30000 <= m.size AND NOT a.blocked AND NOT b.blocked AND a.anchor = a1 AND b.anchor = a2 AND a.total > 0 AND b.total > 0 AND t1 > 0 AND t2 > 0
  AND abs(log2(a.total / t1)) <= 1.5 AND abs(log2(b.total / t2)) <= 1.5),
controls AS (SELECT chrom, start1, start2, CAST(draw AS INTEGER) AS draw, CAST(min(attempt) AS INTEGER) AS attempt, arg_min(c1, attempt) AS c1, arg_min(c2, attempt) AS c2 FROM fit GROUP BY ALL)"""


def _controls(spark, d):
    return aggregate_peaks.matched_controls(_apa_loops(spark, d).drop("loop_id"), _bin_table(spark, d), WIDTH, WIN, 1.5, keep=_keep(spark))


@query(f"{_CONTROLS} SELECT * FROM controls")
def mdl03_matched_controls(spark, d):
    """Twenty draws a loop of up to 200 attempts each: shifted copies of equal anchor classes and like depth."""
    return _controls(spark, d)


@query(f"""{_CONTROLS}, mean AS (SELECT c.chrom, c.start1, c.start2, avg(coalesce(a.score, 0)) AS control FROM controls c LEFT JOIN all1 a ON a.chrom = c.chrom AND a.start1 = c1 AND a.start2 = c2 GROUP BY ALL),
v AS (SELECT coalesce(a.score, 0) AS real, control FROM mean m LEFT JOIN all1 a ON a.chrom = m.chrom AND a.start1 = m.start1 AND a.start2 = m.start2)
SELECT round(avg(real) / greatest(avg(control), 1e-9), 6) AS ratio, count(*) AS n FROM v""")
def agg13_matched_ratio(spark, d):
    """Loops' centres over the mean of their controls'."""
    v = aggregate_peaks.matched_values(_apa_loops(spark, d), _controls(spark, d), _one_sample(spark, d))
    return v.agg(F.round(F.avg("real") / F.greatest(F.avg("control"), F.lit(1e-9)), 6).alias("ratio"), F.count("*").alias("n"))


@query(f"""{_CONTROLS}, mean AS (SELECT c.chrom, c.start1, c.start2, avg(coalesce(a.score, 0)) AS control FROM controls c LEFT JOIN all1 a ON a.chrom = c.chrom AND a.start1 = c1 AND a.start2 = c2 GROUP BY ALL),
num AS MATERIALIZED (SELECT row_number() OVER (ORDER BY m.chrom, m.start1, m.start2) - 1 AS i, CAST(coalesce(a.score, 0) AS DOUBLE) AS real, control FROM mean m LEFT JOIN all1 a ON a.chrom = m.chrom AND a.start1 = m.start1 AND a.start2 = m.start2),
draw AS (SELECT b, CAST('0x' || substr(md5(concat_ws('|', 42, b, i)), 1, 15) AS BIGINT) % (SELECT count(*) FROM num) AS i FROM num, (SELECT unnest(range(500)) AS b) x),
boot AS (SELECT b, avg(real) / greatest(avg(control), 1e-9) AS r FROM draw JOIN num USING (i) GROUP BY b)
SELECT round(avg(real) / greatest(avg(control), 1e-9), 6) AS ratio, count(*) AS n, (SELECT round(quantile_cont(r, 0.025), 6) FROM boot) AS low, (SELECT round(quantile_cont(r, 0.975), 6) FROM boot) AS high FROM num""")
def pip09_matched_ratio(spark, d):
    """The same with a bootstrap interval."""
    v = aggregate_peaks.matched_values(_apa_loops(spark, d), _controls(spark, d), _one_sample(spark, d))
    out = aggregate_peaks.bootstrap_ratio(_keep(spark)(v, "values"))
    return out.select(F.round("ratio", 6).alias("ratio"), "n", F.round("low", 6).alias("low"), F.round("high", 6).alias("high"))


# Replicates

_SCC = f"""{cte('contacts', 'chroms')}, use AS (SELECT * FROM contacts WHERE {PRIMARY_SQL.format('chrom')} AND chrom <> 'chrX'),
pairs AS (SELECT a.sample AS a, b.sample AS b FROM (SELECT DISTINCT sample FROM use) a JOIN (SELECT DISTINCT sample FROM use) b ON a.sample < b.sample),
pos AS (SELECT sample, chrom, start1 // 25000 AS x, start2 // 25000 AS y, sum(score) AS v FROM use GROUP BY ALL), tot AS (SELECT sample, chrom, sum(v) AS total FROM pos GROUP BY ALL),
lim AS (SELECT a, b, p.sample, p.chrom, CAST(floor(least(p.total, q.total) * 4294967296::HUGEINT // p.total) AS BIGINT) AS keep FROM pairs, tot p, tot q WHERE p.chrom = q.chrom AND ((p.sample = a AND q.sample = b) OR (p.sample = b AND q.sample = a))),
px AS (SELECT l.a, l.b, l.sample, l.chrom, x, y, CASE WHEN keep >= 4294967296 THEN v ELSE len([i FOR i IN range(1, CAST(v AS BIGINT) + 1) IF CAST('0x' || substr(md5(concat_ws('|', l.a, l.b, l.chrom, x, y, i)), 1, 8) AS BIGINT) < keep]) END AS v FROM lim l JOIN pos USING (sample, chrom)),
both2 AS (SELECT * FROM px WHERE v > 0 UNION ALL SELECT a, b, sample, chrom, y, x, v FROM px WHERE v > 0 AND x <> y), o AS (SELECT unnest(range(-1, 2)) AS o),
cell AS (SELECT a, b, t.chrom, x + i.o AS x, y + j.o - x - i.o AS d, CAST(sum(CASE WHEN sample = a THEN v ELSE 0 END) AS DOUBLE) AS p, CAST(sum(CASE WHEN sample = b THEN v ELSE 0 END) AS DOUBLE) AS q FROM both2 t, o i, o j, chroms c
  WHERE c.chrom = t.chrom AND x + i.o >= 0 AND (y + j.o) * 25000 < c.size AND y + j.o - x - i.o BETWEEN 1 AND 200 GROUP BY ALL),
sums AS (SELECT a, b, chrom, d, count(*) AS n, sum(p) AS sp, sum(q) AS sq, sum(p * p) AS pp, sum(q * q) AS qq, sum(p * q) AS pq FROM cell GROUP BY ALL),
rho AS (SELECT a, b, chrom, n * (1 - 1 / (CAST(n AS DOUBLE) * n)) / 12 AS w, (n * pq - sp * sq) / sqrt(n * pp - sp * sp) / sqrt(n * qq - sq * sq) AS r FROM sums WHERE n >= 3 AND n * pp - sp * sp > 0 AND n * qq - sq * sq > 0),
scc AS (SELECT a, b, e.chrom, coalesce(s, -2.0) AS scc FROM (SELECT DISTINCT a, b, chrom FROM pairs, tot WHERE sample IN (a, b)) e LEFT JOIN (SELECT a, b, chrom, sum(w * r) / sum(w) AS s FROM rho GROUP BY ALL) z USING (a, b, chrom))"""


def _scc(spark, d):
    """Contacts of the autosomes on the concordance's grid, written once for all that read them, and the concordance."""
    grid = _keep(spark)(matrix.coarsen(table(spark, d, "contacts"), 25_000, ["sample", "chrom"], "score"), "grid")
    use = grid.where(fn.primary(F.col("chrom")) & (F.col("chrom") != "chrX"))  # after the sums: a test of a chromosome, not of a contact
    pairs = spark.sql("SELECT * FROM VALUES " + ", ".join(f"('{a}', '{b}')" for a in SAMPLES for b in SAMPLES if a < b) + " AS t(a, b)")
    return use, matrix.concordance(use, pairs, table(spark, d, "chroms"), 25_000, 1, 5_000_000)


@query(f"{_SCC} SELECT a, b, chrom, round(scc, 6) AS scc FROM scc")
def mdl04_concordance(spark, d):
    """Concordance of every two samples by chromosome, the deeper one thinned to the other."""
    return _scc(spark, d)[1].select("a", "b", "chrom", F.round("scc", 6).alias("scc"))


@query(f"""{_SCC}, depth AS (SELECT sample, CAST(sum(score) AS BIGINT) AS contacts FROM use GROUP BY ALL), mean AS (SELECT a, b, avg(scc) AS scc FROM scc WHERE scc > -2.0 AND NOT isnan(scc) GROUP BY ALL),
told AS (SELECT m.*, least(x.contacts, y.contacts) < 1000 AS confounded FROM mean m JOIN depth x ON x.sample = a JOIN depth y ON y.sample = b), own AS (SELECT unnest([a, b]) AS sample, scc, confounded FROM told)
SELECT sample, contacts, count(scc) FILTER (NOT confounded) AS n_pairs, count(*) FILTER (confounded) AS n_confounded, round(avg(scc) FILTER (NOT confounded), 6) AS mean, round(min(scc) FILTER (NOT confounded), 6) AS lo,
round(median(scc) FILTER (NOT confounded), 6) AS mid, round(max(scc) FILTER (NOT confounded), 6) AS hi, CASE WHEN count(scc) FILTER (NOT confounded) = 0 THEN 'NOT_ASSESSED' WHEN bool_and(scc >= 0.3) FILTER (NOT confounded) THEN 'PASS' WHEN NOT bool_or(scc >= 0.3) FILTER (NOT confounded) THEN 'FAIL' ELSE 'DISCORDANT' END AS status
FROM depth LEFT JOIN own USING (sample) GROUP BY sample, contacts""")
def pip10_replicate_report(spark, d):
    """Each sample's concordance with the others, pairs under the floor of contacts apart."""
    use, scc = _scc(spark, d)
    out = matrix.replicate_report(scc, use.groupBy("sample").agg(F.sum("score").alias("contacts")), 0.3, 1000)
    return out.select("sample", "contacts", "n_pairs", "n_confounded", *(F.round(c, 6).alias(c) for c in ("mean", "lo", "mid", "hi")), "status")


# Contracts: each query must be empty, its twin on broken tables not

_KEY = "concat(chrom1, ':', CAST(start1 AS VARCHAR), ':', CAST(start2 AS VARCHAR))"
_SUPPORT = f"""{_BASE}, g AS (SELECT {_KEY} AS key, s.sample, coalesce(k.score, 0) AS score FROM cand c CROSS JOIN (SELECT DISTINCT sample FROM calls) s LEFT JOIN calls k USING (sample, chrom1, start1, end1, chrom2, start2, end2)),
clean AS (SELECT key, count(*) FILTER (score >= 5) AS support, list_sort(list(sample) FILTER (score >= 5)) AS support_samples FROM g GROUP BY key)"""
_SUPPORT_RULES = """, r AS (SELECT key, coalesce(list_sort(list(sample) FILTER (score >= 5)), []) AS real FROM g GROUP BY key), j AS (SELECT s.*, real FROM t s LEFT JOIN r USING (key)),
v AS (SELECT 'repeated_key' AS rule, count(*) AS n FROM (SELECT key FROM t GROUP BY key HAVING count(*) > 1) UNION ALL SELECT 'missing_key', count(*) FROM r ANTI JOIN t USING (key) UNION ALL SELECT 'unknown_key', count(*) FROM t ANTI JOIN r USING (key)
UNION ALL SELECT 'samples', count(*) FROM j WHERE list_sort(support_samples) <> real UNION ALL SELECT 'support', count(*) FROM j WHERE support <> len(real) UNION ALL SELECT 'too_few', count(*) FROM t WHERE support < 2) SELECT * FROM v WHERE n > 0"""


def _support(spark, d):
    counts = pip03_universe(spark, d).select(F.concat_ws(":", "chrom1", "start1", "start2").alias("key"), "sample", "score")
    real = counts.groupBy("key").agg(F.count_if(F.col("score") >= MIN_COUNT).alias("support"), F.array_sort(F.collect_list(F.when(F.col("score") >= MIN_COUNT, F.col("sample")))).alias("support_samples"))
    return real, counts


@query(f"{_SUPPORT}, t AS (SELECT * FROM clean){_SUPPORT_RULES}")
def chk13_support_contract(spark, d):
    """The support table says what the counts say."""
    return bundles.support_violations(*_support(spark, d), MIN_COUNT, MIN_SAMPLES)


@query(f"""{_SUPPORT}, t AS (SELECT CASE WHEN support = 4 AND key LIKE '%:5000:%' THEN key || 'x' ELSE key END AS key, CASE WHEN key LIKE '%:10000:%' THEN 1 ELSE support END AS support,
CASE WHEN key LIKE '%:15000:%' THEN list_concat(support_samples, ['s9']) ELSE support_samples END AS support_samples FROM clean UNION ALL SELECT * FROM clean WHERE key LIKE 'chr1:%'){_SUPPORT_RULES}""")
def chk13_support_contract_broken(spark, d):
    real, counts = _support(spark, d)
    has = lambda p: F.col("key").like(p)
    broken = real.select(
        F.when((F.col("support") == 4) & has("%:5000:%"), F.concat("key", F.lit("x"))).otherwise(F.col("key")).alias("key"), F.when(has("%:10000:%"), F.lit(1).cast("long")).otherwise(F.col("support")).alias("support"),
        F.when(has("%:15000:%"), F.concat("support_samples", F.array(F.lit("s9")))).otherwise(F.col("support_samples")).alias("support_samples"),
    )
    return bundles.support_violations(broken.unionByName(real.where(has("chr1:%"))), counts, MIN_COUNT, MIN_SAMPLES)


_RESULT = f"""{cte('loops')}, res AS (SELECT {_KEY} AS loop_key, chrom1, start1, start2, min(fdr) AS padj, CAST(sum(score) AS DOUBLE) / 100 - 1 AS lfc, CAST(1 AS DOUBLE) / count(*) AS lfc_se, 'PILOT_UNDERPOWERED' AS status FROM loops GROUP BY ALL),
pe AS (SELECT loop_key, pair_id, chrom1, start1, start2, abs(lfc) AS case_n, lfc_se AS control_n, lfc AS ratio, status FROM res CROSS JOIN (SELECT unnest(['p0', 'p1', 'p2']) AS pair_id) x)"""
_BUNDLE_RULES = """, per AS (SELECT loop_key, count(DISTINCT pair_id) AS pairs FROM b GROUP BY ALL),
v AS (SELECT 'repeated_loop' AS rule, count(*) AS n FROM (SELECT loop_key FROM a GROUP BY loop_key HAVING count(*) > 1) UNION ALL SELECT 'null_key', (SELECT count(*) FROM a WHERE loop_key IS NULL) + (SELECT count(*) FROM b WHERE loop_key IS NULL OR pair_id IS NULL)
UNION ALL SELECT 'status', (SELECT count(*) FROM a WHERE status IS DISTINCT FROM 'PILOT_UNDERPOWERED') + (SELECT count(*) FROM b WHERE status IS DISTINCT FROM 'PILOT_UNDERPOWERED')
UNION ALL SELECT 'padj', count(*) FROM a WHERE NOT (isfinite(padj) AND padj BETWEEN 0 AND 1) UNION ALL SELECT 'lfc', count(*) FROM a WHERE NOT isfinite(lfc) UNION ALL SELECT 'lfc_se', count(*) FROM a WHERE NOT (isfinite(lfc_se) AND lfc_se >= 0)
UNION ALL SELECT 'repeated_pair', count(*) FROM (SELECT 1 FROM b GROUP BY loop_key, pair_id HAVING count(*) > 1) UNION ALL SELECT 'unknown_pair', count(*) FROM b WHERE pair_id IS NULL OR pair_id NOT IN ('p0', 'p1', 'p2')
UNION ALL SELECT 'uncovered_loop', count(*) FROM a WHERE NOT EXISTS (SELECT 1 FROM per WHERE per.loop_key = a.loop_key AND pairs = 3) UNION ALL SELECT 'unknown_loop', count(*) FROM b WHERE NOT EXISTS (SELECT 1 FROM a WHERE a.loop_key = b.loop_key)
UNION ALL SELECT 'place', count(*) FROM (SELECT DISTINCT loop_key, chrom1, start1, start2 FROM b) x JOIN a ON a.loop_key = x.loop_key WHERE (a.chrom1, a.start1, a.start2) <> (x.chrom1, x.start1, x.start2)
UNION ALL SELECT 'number', count(*) FROM b WHERE NOT coalesce(isfinite(case_n) AND isfinite(control_n) AND isfinite(ratio), false) UNION ALL SELECT 'negative', count(*) FROM b WHERE case_n < 0 OR control_n < 0) SELECT * FROM v WHERE n > 0"""


def _bundle(spark, d):
    key = F.concat_ws(":", "chrom1", "start1", "start2")
    res = table(spark, d, "loops").groupBy(key.alias("loop_key"), "chrom1", "start1", "start2").agg(F.min("fdr").alias("padj"), (F.sum("score").cast("double") / 100 - 1).alias("lfc"), (F.lit(1.0) / F.count("*")).alias("lfc_se")).withColumn("status", F.lit("PILOT_UNDERPOWERED"))
    pe = res.withColumn("pair_id", F.explode(F.array(*map(F.lit, ("p0", "p1", "p2"))))).select("loop_key", "pair_id", "chrom1", "start1", "start2", F.abs("lfc").alias("case_n"), F.col("lfc_se").alias("control_n"), F.col("lfc").alias("ratio"), "status")
    return res, pe


@query(f"{_RESULT}, a AS (SELECT * FROM res), b AS (SELECT * FROM pe){_BUNDLE_RULES}")
def chk16_bundle_contract(spark, d):
    """Differential results and paired effects agree."""
    return bundles.bundle_violations(*_bundle(spark, d), ["p0", "p1", "p2"], "PILOT_UNDERPOWERED")


@query(f"""{_RESULT}, a AS (SELECT CASE WHEN start2 = 35000 THEN NULL ELSE loop_key END AS loop_key, chrom1, start1, start2, CASE WHEN start1 = 5000 THEN padj + 1 ELSE padj END AS padj, CASE WHEN start1 = 10000 THEN 'nan'::DOUBLE ELSE lfc END AS lfc,
CASE WHEN start1 = 15000 THEN -lfc_se ELSE lfc_se END AS lfc_se, CASE WHEN start1 = 20000 THEN NULL ELSE status END AS status FROM res UNION ALL SELECT * FROM res WHERE chrom1 = 'chr2'),
b AS (SELECT loop_key, CASE WHEN start1 = 25000 THEN 'p9' WHEN start1 = 30000 THEN 'p0' ELSE pair_id END AS pair_id, chrom1, CASE WHEN start1 = 35000 THEN start1 + 1 ELSE start1 END AS start1, start2, CASE WHEN start1 = 40000 THEN -1.0 ELSE case_n END AS case_n,
CASE WHEN start1 = 45000 THEN NULL ELSE control_n END AS control_n, CASE WHEN start1 = 50000 THEN 'inf'::DOUBLE ELSE ratio END AS ratio, status FROM pe){_BUNDLE_RULES}""")
def chk16_bundle_contract_broken(spark, d):
    res, pe = _bundle(spark, d)
    at = lambda s, value, c: F.when(F.col("start1") == s, value).otherwise(F.col(c))
    a = res.withColumns({"loop_key": F.when(F.col("start2") != 35000, F.col("loop_key")), "padj": at(5000, F.col("padj") + 1, "padj"), "lfc": at(10000, float("nan"), "lfc"), "lfc_se": at(15000, -F.col("lfc_se"), "lfc_se"), "status": F.when(F.col("start1") != 20000, F.col("status"))})
    pair = F.when(F.col("start1") == 25000, "p9").when(F.col("start1") == 30000, "p0").otherwise(F.col("pair_id"))
    b = pe.withColumns({"pair_id": pair, "case_n": at(40000, -1.0, "case_n"), "control_n": F.when(F.col("start1") != 45000, F.col("control_n")), "ratio": at(50000, float("inf"), "ratio")})
    b = b.withColumn("start1", at(35000, F.col("start1") + 1, "start1"))
    return bundles.bundle_violations(a.unionByName(res.where("chrom1 = 'chr2'")), b, ["p0", "p1", "p2"], "PILOT_UNDERPOWERED")


@query(f"{_RESULT} SELECT loop_key FROM (SELECT loop_key FROM res WHERE start1 <> 60000 UNION ALL SELECT 'elsewhere') x FULL JOIN (SELECT DISTINCT loop_key AS k FROM pe) y ON x.loop_key = y.k WHERE x.loop_key IS NULL OR y.k IS NULL".replace("SELECT loop_key FROM (SELECT", "SELECT coalesce(x.loop_key, y.k) AS loop_key FROM (SELECT", 1))
def chk15_result_keys(spark, d):
    """Keys that only the results or only the tested universe hold; one of each kind is planted."""
    res, pe = _bundle(spark, d)
    told = res.where("start1 <> 60000").select("loop_key").unionByName(spark.createDataFrame([("elsewhere",)], "loop_key string"))
    tested = pe.select("loop_key").distinct()
    return told.join(tested, "loop_key", "left_anti").unionByName(tested.join(told, "loop_key", "left_anti"))


_TEXT_CALLS = """raw AS (SELECT sample, chrom1, start1, start2, CASE WHEN score % 9 = 0 THEN 'x' ELSE CAST(start1 AS {s}) END AS s1, CAST(CASE WHEN score % 10 = 0 THEN start1 ELSE start1 + 5000 END AS {s}) AS e1, CAST(start2 AS {s}) AS s2, CAST(start2 + 5000 AS {s}) AS e2,
CASE WHEN score % 11 = 0 THEN concat(CAST(score AS {s}), '.5') WHEN score % 13 = 0 THEN '0' ELSE CAST(score AS {s}) END AS cc, CASE score % 14 WHEN 0 THEN 'nan' WHEN 1 THEN '-0.1' WHEN 2 THEN '1.2' ELSE '0.001' END AS p, CASE score % 15 WHEN 0 THEN '0.02' WHEN 1 THEN '' ELSE '0.01' END AS q FROM {t})"""
_CALL_SQL = """n AS (SELECT sample, chrom1, start1, start2, try_cast(s1 AS DOUBLE) AS a, try_cast(e1 AS DOUBLE) AS b, try_cast(s2 AS DOUBLE) AS c, try_cast(e2 AS DOUBLE) AS e, try_cast(cc AS DOUBLE) AS k, try_cast(p AS DOUBLE) AS p, try_cast(q AS DOUBLE) AS q FROM raw),
v AS (SELECT *, concat_ws(',', CASE WHEN NOT coalesce(a >= 0 AND c >= 0 AND b > a AND e > c AND k > 0, false) THEN 'geometry' END, CASE WHEN NOT coalesce(a = floor(a) AND b = floor(b) AND c = floor(c) AND e = floor(e) AND k = floor(k), false) THEN 'integer' END,
CASE WHEN NOT coalesce(isfinite(p) AND p BETWEEN 0 AND 1 AND isfinite(q) AND q BETWEEN 0 AND 1, false) THEN 'probability' END, CASE WHEN NOT coalesce(q <= 0.01 + 1e-11, false) THEN 'threshold' END) AS broken FROM n) SELECT sample, chrom1, start1, start2, broken FROM v WHERE broken <> ''"""


@query(f"{cte('loops')}, {_TEXT_CALLS.format(s='VARCHAR', t='loops')}, {_CALL_SQL}")
def chk20_reporting_calls(spark, d):
    """Reporting calls as text that break a rule, and which."""
    raw = spark.sql(f"WITH {_TEXT_CALLS.format(s='STRING', t='{loops}')} SELECT * FROM raw", loops=table(spark, d, "loops"))
    return bundles.violations(raw, bundles.call_rules(0.01)).select("sample", "chrom1", "start1", "start2", "broken")


_SETTINGS = """st AS (SELECT CASE WHEN c_custkey % 97 = 0 THEN '-bad' WHEN c_custkey % 89 = 0 THEN 'same' ELSE c_name END AS sample_id, CASE WHEN c_custkey % 7 = 0 THEN 5500 ELSE 5000 END AS resolution, CASE WHEN c_custkey % 11 = 0 THEN 100 ELSE 20000 END AS lower,
CASE WHEN c_custkey % 13 = 0 THEN 20000 ELSE 3000000 END AS upper, CASE WHEN c_custkey % 17 = 0 THEN 1.0 ELSE 0.01 END AS q, c_custkey % 19 AS min_count, c_custkey % 23 AS min_samples, 20 AS n_samples, c_custkey % 29 - 1 AS tolerance, concat(c_name, '_1') AS r1, CASE c_custkey % 31 WHEN 0 THEN NULL WHEN 1 THEN concat(c_name, '_1') ELSE concat(c_name, '_2') END AS r2 FROM {t})"""


@query(f"""WITH {_SETTINGS.format(t='customer')}, v AS (SELECT sample_id, concat_ws(',', CASE WHEN NOT (lower >= resolution AND lower < upper) THEN 'distance' END, CASE WHEN NOT (min_count >= 1) THEN 'min_count' END, CASE WHEN NOT (min_samples BETWEEN 1 AND n_samples) THEN 'min_samples' END,
CASE WHEN NOT (q > 0 AND q < 1) THEN 'q' END, CASE WHEN NOT coalesce(r1 IS NOT NULL AND r2 IS NOT NULL AND r1 <> r2, false) THEN 'reads' END, CASE WHEN NOT (resolution > 0 AND resolution % 1000 = 0) THEN 'resolution' END, CASE WHEN NOT regexp_full_match(sample_id, '[A-Za-z0-9#][A-Za-z0-9_.#-]*') OR sample_id LIKE '%#%' THEN 'sample' END, CASE WHEN tolerance < 0 THEN 'tolerance' END) AS broken FROM st)
SELECT sample_id, broken FROM v WHERE broken <> '' UNION ALL SELECT sample_id, 'repeated' FROM st GROUP BY sample_id HAVING count(*) > 1""")
def chk21_settings(spark, d):
    """Settings that break a rule, and ids that repeat."""
    st = spark.sql(f"WITH {_SETTINGS.format(t='{customer}')} SELECT * FROM st", customer=table(spark, d, "customer"))
    return bundles.setting_violations(st)


_AGG = f"""{cte('contacts')}, cells AS (SELECT sample, (start2 // 5000 - start1 // 5000) % 3 AS dy, start1 // 5000 % 3 AS dx, CAST(sum(CASE WHEN sample = 's2' THEN 0 ELSE score END) AS DOUBLE) AS value FROM contacts WHERE sample <> 's3' OR start1 // 5000 % 3 < 2 GROUP BY ALL),
told AS (SELECT sample, status FROM (VALUES ('s0', 'DESCRIPTIVE'), ('s1', 'NOT_ASSESSED'), ('s2', 'DESCRIPTIVE'), ('s3', 'unknown'), ('s4', 'NOT_ASSESSED')) t(sample, status)),
n AS (SELECT sample, count(*) AS n, count(DISTINCT dy) AS h, count(DISTINCT dx) AS w, bool_or(value <> 0) AS a FROM cells GROUP BY ALL)"""


@query(f"""{_AGG}, v AS (SELECT sample, concat_ws(',', CASE WHEN status IN ('DESCRIPTIVE', 'NOT_ASSESSED') AND (status = 'DESCRIPTIVE') <> coalesce(a, false) THEN 'content' END, CASE WHEN NOT coalesce(h = w AND h % 2 = 1 AND n = h * w, false) THEN 'square' END, CASE WHEN status NOT IN ('DESCRIPTIVE', 'NOT_ASSESSED') THEN 'status' END) AS broken FROM told LEFT JOIN n USING (sample))
SELECT * FROM v WHERE broken <> ''""")
def chk17_aggregate_status(spark, d):
    """Aggregate matrices whose told status contradicts their cells."""
    c = table(spark, d, "contacts").withColumns({"i": F.floor(F.col("start1") / WIDTH), "j": F.floor(F.col("start2") / WIDTH)})
    cells = c.where("sample <> 's3' or i % 3 < 2").groupBy("sample", ((F.col("j") - F.col("i")) % 3).alias("dy"), (F.col("i") % 3).alias("dx")).agg(F.sum("score").cast("double").alias("value"))
    cells = cells.withColumn("value", F.when(F.col("sample") == "s2", 0.0).otherwise(F.col("value")))
    told = spark.createDataFrame([("s0", "DESCRIPTIVE"), ("s1", "NOT_ASSESSED"), ("s2", "DESCRIPTIVE"), ("s3", "unknown"), ("s4", "NOT_ASSESSED")], "sample string, status string")
    return bundles.aggregate_status_violations(cells, told)


@query("SELECT o_orderkey, o_custkey, CASE o_orderkey % 6 WHEN 0 THEN '0' WHEN 1 THEN '-5' WHEN 2 THEN 'x' WHEN 3 THEN 'inf' ELSE '1500.5' END AS length, 'length' AS broken FROM orders WHERE o_orderkey % 6 < 4")
def chk18_stripe_rows(spark, d):
    """Stripes whose length isn't a positive finite number."""
    k = F.col("o_orderkey") % 6
    rows = table(spark, d, "orders").select("o_orderkey", "o_custkey", F.when(k == 0, "0").when(k == 1, "-5").when(k == 2, "x").when(k == 3, "inf").otherwise("1500.5").alias("length"))
    n = F.col("length").try_cast("double")
    return bundles.violations(rows, {"length": bundles.finite(n) & (n > 0)}).select("o_orderkey", "o_custkey", "length", "broken")


_BALANCE = "w AS (SELECT concat('b', CAST(c_custkey // 4 AS {s})) AS sample, (c_custkey % 4 + 1) * 5000 AS resolution, CASE c_nationkey % 4 WHEN 0 THEN NULL WHEN 1 THEN false ELSE true END AS converged, c_nationkey % 9 = 0 AS gone FROM {t})"


@query(f"""WITH {_BALANCE.format(s='VARCHAR', t='customer')}, s AS (SELECT sample, resolution, NOT gone AS here, CASE WHEN gone OR converged IS NULL THEN 'NOT_ASSESSED' WHEN converged THEN 'PASS' ELSE 'WARN' END AS status FROM w)
SELECT sample, count(*) AS n_configured, coalesce(string_agg(resolution, ',' ORDER BY resolution) FILTER (status = 'PASS'), '') AS converged, coalesce(string_agg(resolution, ',' ORDER BY resolution) FILTER (status = 'WARN'), '') AS nonconverged, coalesce(string_agg(resolution, ',' ORDER BY resolution) FILTER (status = 'NOT_ASSESSED'), '') AS missing,
CASE WHEN bool_or(status = 'NOT_ASSESSED') THEN 'NOT_ASSESSED' WHEN bool_or(status = 'WARN') THEN 'WARN' ELSE 'PASS' END AS status, count(*) FILTER (status <> 'PASS' AND here) AS n_removed, CASE WHEN bool_and(status = 'PASS') THEN true END AS passed FROM s GROUP BY sample""")
def pip20_balance_report(spark, d):
    """Each sample's balance over its resolutions, and how many weights aren't published."""
    w = spark.sql(f"WITH {_BALANCE.replace('c_custkey // 4', 'c_custkey div 4').format(s='STRING', t='{customer}')} SELECT * FROM w", customer=table(spark, d, "customer"))
    return bundles.balance_report(w.where("not gone").select("sample", "resolution", "converged"), w.select("sample", "resolution"))


@query(f"""{_BASE}, a AS (SELECT chrom1, start1, start2, row_number() OVER (ORDER BY chrom1, start1, start2) AS place FROM cand), b AS (SELECT chrom1, start1 + CASE WHEN place % 50 = 0 THEN 5000 ELSE 0 END AS start1, start2, place FROM a WHERE place > 1 UNION ALL SELECT 'chr0', 0, 0, max(place) + 1 FROM a)
SELECT place FROM a FULL JOIN b USING (place) WHERE (a.chrom1, a.start1, a.start2) IS DISTINCT FROM (b.chrom1, b.start1, b.start2) OR a.chrom1 IS NULL OR b.chrom1 IS NULL""")
def chk26_ordered_places(spark, d):
    """Places at which two ordered tables differ."""
    from pyspark.sql import Window

    a = _candidates(spark, d).select("chrom1", "start1", "start2")
    first = a.groupBy("chrom1").agg(F.count("*").alias("n"))
    before = first.select("chrom1", (F.sum("n").over(Window.orderBy("chrom1")) - F.col("n")).alias("before"))  # a row for each chromosome
    a = a.withColumn("own", F.row_number().over(Window.partitionBy("chrom1").orderBy("start1", "start2"))).join(F.broadcast(before), "chrom1").select("chrom1", "start1", "start2", (F.col("own") + F.col("before")).alias("place"))
    b = a.where("place > 1").withColumn("start1", F.col("start1") + F.when(F.col("place") % 50 == 0, 5000).otherwise(0))
    b = b.unionByName(a.agg(F.max("place").alias("m")).select(F.lit("chr0").alias("chrom1"), F.lit(0).cast("long").alias("start1"), F.lit(0).cast("long").alias("start2"), (F.col("m") + 1).alias("place")))
    return bundles.unequal_places(a, b, ["chrom1", "start1", "start2"]).select("place")


@query("""WITH f AS (SELECT concat('r', CAST(o_custkey AS VARCHAR)) AS sample, o_orderkey % 2 + 1 AS mate, sum(o_orderkey % 7 * 4 + CASE WHEN o_orderkey % 50 = 0 THEN 1 ELSE 0 END) AS n_lines FROM orders GROUP BY ALL),
p AS (SELECT sample, sum(n_lines) FILTER (mate = 1) AS r1, sum(n_lines) FILTER (mate = 2) AS r2 FROM f GROUP BY sample),
v AS (SELECT sample, concat_ws(',', CASE WHEN NOT coalesce(r1 % 4 = 0 AND r2 % 4 = 0, false) THEN 'fours' END, CASE WHEN NOT coalesce(r1 = r2, false) THEN 'mates' END, CASE WHEN NOT coalesce(r1 > 0 AND r2 > 0, false) THEN 'present' END) AS broken FROM p) SELECT * FROM v WHERE broken <> ''""")
def chk23_read_records(spark, d):
    """Samples whose read files have broken records or unequal mates."""
    o = table(spark, d, "orders").select(F.concat(F.lit("r"), "o_custkey").alias("sample"), (F.col("o_orderkey") % 2 + 1).alias("mate"), (F.col("o_orderkey") % 7 * 4 + F.when(F.col("o_orderkey") % 50 == 0, 1).otherwise(0)).alias("n"))
    return bundles.record_violations(o.groupBy("sample", "mate").agg(F.sum("n").alias("n_lines")))


@query(f"{cte('tss', 'chroms')} SELECT gene AS name, t.chrom, pos, coalesce(pos < size - 100000, false) AS valid FROM (SELECT gene, CASE WHEN pos % 17 = 0 THEN 'chrZ' ELSE chrom END AS chrom, pos FROM tss) t LEFT JOIN chroms c ON c.chrom = t.chrom")
def fn24_viewpoints(spark, d):
    """Viewpoints on a known chromosome and inside it."""
    points = table(spark, d, "tss").select(F.col("gene").alias("name"), F.when(F.col("pos") % 17 == 0, "chrZ").otherwise(F.col("chrom")).alias("chrom"), "pos")
    return bundles.resolved_viewpoints(points, table(spark, d, "chroms").withColumn("size", F.col("size") - 100_000))


@query(f"{cte('track')} SELECT chrom, s, CASE WHEN CAST(value AS BIGINT) % 5 IN (0, 1, 2) THEN 0.0 ELSE value END AS value FROM track")
def fn25_known_signal(spark, d):
    """What isn't a finite number counts as no signal."""
    k = F.col("value").cast("long") % 5
    v = F.when(k == 0, float("nan")).when(k == 1, float("-inf")).when(k != 2, F.col("value"))
    return table(spark, d, "track").select("chrom", "s", bundles.zero_unless_finite(v).alias("value"))


_LIBRARY = f"{cte('qc')}, lib AS (SELECT sample, CASE WHEN sample % 10 = 3 THEN 'demonstration' ELSE 'primary' END AS report_role, yield_pct, dup_pct, 100 * cis_fraction AS cis_pct, CASE WHEN balance_status = 'PASS' THEN yield_pct / 10 END AS apa, balance_status FROM qc)"


@query(f"{_LIBRARY} SELECT sample, report_role, yield_pct, dup_pct, cis_pct, yield_pct < 25 AS low_yield, dup_pct > 50 AS high_dup, cis_pct < 100 * CAST(0.7 AS DOUBLE) AS low_cis, 'ICE' AS normalization, 5000 AS resolution FROM lib WHERE report_role = 'primary'")
def pip15_library_panel(spark, d):
    """Primary libraries with the gates that they fail, and the panel's constants."""
    q = table(spark, d, "qc").select("sample", F.when(F.col("sample") % 10 == 3, "demonstration").otherwise("primary").alias("report_role"), "yield_pct", "dup_pct", (100 * F.col("cis_fraction")).alias("cis_pct"))
    gates = reporting.gate_values({"valid_pair_yield_pct": 25.0, "duplicate_pct_max": 50.0, "cis_fraction_min": 0.7})
    return reporting.primary_libraries(q).withColumns({
        "low_yield": reporting.fails(F.col("yield_pct"), least=gates["yield_pct"]), "high_dup": reporting.fails(F.col("dup_pct"), most=gates["dup_pct"]),
        "low_cis": reporting.fails(F.col("cis_pct"), least=gates["cis_pct"]), "normalization": F.lit("ICE"), "resolution": F.lit(5000),
    })


@query(f"{_LIBRARY} SELECT sample, apa FROM lib WHERE balance_status = 'PASS' AND report_role = 'primary'")
def flt26_balanced_values(spark, d):
    """Aggregate ratios that the report plots: of balanced matrices of primary libraries only."""
    q = table(spark, d, "qc").where("balance_status = 'PASS' and sample % 10 <> 3")
    return q.select("sample", (F.col("yield_pct") / 10).alias("apa"))


@query(f"{cte('qc')} SELECT sample, replicate_status AS status FROM qc WHERE replicate_status IN ('FAIL', 'DISCORDANT')")
def chk25_balance_status(spark, d):
    """Reports whose status is none of a balance's."""
    return bundles.unknown_status(table(spark, d, "qc").select("sample", F.col("replicate_status").alias("status")))


_DRAWN = "dr AS (SELECT l_suppkey % 60 AS sample, CASE WHEN l_suppkey % 7 = 0 AND l_linenumber = 1 THEN NULL ELSE l_quantity END AS real, CASE WHEN l_suppkey % 5 = 0 THEN CAST('nan' AS DOUBLE) ELSE l_discount END AS control FROM {t})"


@query(f"""WITH {_DRAWN.format(t='lineitem')}, p AS (SELECT sample, count(*) AS n, count(real) AS a, count(control) AS b, count(*) FILTER (real IS NOT NULL AND control IS NOT NULL AND NOT isnan(control)) AS k FROM dr GROUP BY sample),
w AS (SELECT unnest(range(70)) AS sample), v AS (SELECT w.sample, concat_ws(',', CASE WHEN coalesce(k, 0) = 0 THEN 'finite' END, CASE WHEN a <> b THEN 'matched' END, CASE WHEN n IS NULL THEN 'present' END) AS broken FROM w LEFT JOIN p USING (sample)) SELECT * FROM v WHERE broken <> ''""")
def chk28_bootstrap_inputs(spark, d):
    """Samples whose loops and controls can't be resampled."""
    values = spark.sql(f"WITH {_DRAWN.format(t='{lineitem}')} SELECT * FROM dr", lineitem=table(spark, d, "lineitem"))
    return bundles.bootstrap_violations(values, spark.range(70).toDF("sample"))


@query("""WITH n AS (SELECT md5(CAST(c_custkey % 40 AS VARCHAR)) AS digest, count(*) AS n FROM customer WHERE c_custkey % 40 > 5 AND (c_custkey > 40 OR c_custkey % 2 = 0) AND c_custkey < 60 GROUP BY ALL)
SELECT s_name AS name, coalesce(n, 0) AS n FROM supplier LEFT JOIN n ON digest = md5(CAST(s_suppkey % 40 AS VARCHAR)) WHERE coalesce(n, 0) <> 1""")
def chk29_environments(spark, d):
    """Environments that other than one installed one is equal to."""
    digest = lambda c: F.md5((F.col(c) % 40).cast("string").cast("binary")).alias("digest")
    there = (F.col("c_custkey") % 40 > 5) & ((F.col("c_custkey") > 40) | (F.col("c_custkey") % 2 == 0)) & (F.col("c_custkey") < 60)
    return bundles.unmatched_environments(table(spark, d, "supplier").select(F.col("s_name").alias("name"), digest("s_suppkey")), table(spark, d, "customer").select(digest("c_custkey"), there.alias("installed")))


@query("""WITH o AS (SELECT o_orderkey, unnest([{'attribute': 'price', 'json': CAST(to_json(floor(o_totalprice) + 0.5) AS VARCHAR)}, {'attribute': 'status', 'json': CAST(to_json(o_orderstatus) AS VARCHAR)}, {'attribute': 'large', 'json': CAST(to_json(o_totalprice > 100000) AS VARCHAR)},
{'attribute': 'gone', 'json': 'null'}, {'attribute': 'both', 'json': CAST(to_json([o_custkey, o_orderkey]) AS VARCHAR)}]) AS x FROM orders) SELECT o_orderkey, x.attribute, x.json FROM o""")
def prj17_json_scalars(spark, d):
    """Attributes of several types as JSON: numbers, bytes, truth values, null, lists."""
    rows = table(spark, d, "orders").select("o_orderkey", (F.floor("o_totalprice") + F.lit(0.5).cast("double")).alias("price"), F.col("o_orderstatus").cast("binary").alias("status"), (F.col("o_totalprice") > 100000).alias("large"), F.lit(None).cast("string").alias("gone"), F.array("o_custkey", "o_orderkey").alias("both"))
    return reporting.json_scalars(rows, "o_orderkey", ["price", "status", "large", "gone", "both"])
