"""Queries on selections, contracts, keyed assembly and report tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..adapters import SQL, WIDTH, cte, table
from ..functions import coords as fn
from ..operators import aggregate_peaks, contracts, differential, graph, intervals, matrix, reporting, universe
from ..sources.readers import main_view
from .contacts import _BASE, _BLOCKED, LOWER, MIN_COUNT, PRIMARY_SQL, UPPER, calls, eligible, query
from .tracks import _APA, _apa_loops, _one_sample, _pixels

PLACE = ["chrom1", "start1", "start2"]
SAMPLES = ["s0", "s1", "s2", "s3"]


def _candidates(spark, d):
    return universe.support(eligible(spark, d), 2)


# Projections


@query(f"""{cte('pairs')} SELECT chrom1 AS chrom, least(pos1 // 25000, pos2 // 25000) * 25000 AS a, greatest(pos1 // 25000, pos2 // 25000) * 25000 AS b, count(*) AS n
FROM pairs WHERE chrom1 = chrom2 AND pos1 // 25000 <> pos2 // 25000 GROUP BY ALL""")
def prj05_unordered_keys(spark, d):
    """Ends snapped by their start, keyed without order, same-bin pairs dropped."""
    a, b = (fn.snap_start(F.col(p), 25_000) for p in ("pos1", "pos2"))
    p = table(spark, d, "pairs").where("chrom1 = chrom2").select(F.col("chrom1").alias("chrom"), F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))
    return p.where("a <> b").groupBy("chrom", "a", "b").agg(F.count("*").alias("n"))


@query(f"""{_BASE}, chroms AS ({SQL['chroms']}) SELECT chrom1, start1, start2, greatest(start1 - 5000, 0) AS from1, least(end1 + 5000, size) AS to1, greatest(start2 - 5000, 0) AS from2, least(end2 + 5000, size) AS to2
FROM cand JOIN chroms ON chrom = chrom1""")
def prj08_footprints(spark, d):
    out = reporting.footprints(_candidates(spark, d), table(spark, d, "chroms"), WIDTH, 1)
    return out.select(*PLACE, "from1", "to1", "from2", "to2")


@query(f"{cte('contacts', 'bins')} SELECT sample, a.bin_id AS bin1, b.bin_id AS bin2, score AS count FROM contacts c JOIN bins a ON a.chrom = c.chrom AND a.s = start1 JOIN bins b ON b.chrom = c.chrom AND b.s = start2")
def prj09_global_bins(spark, d):
    return _pixels(spark, d)


_TEXT_TRACK = """raw AS (SELECT event_id AS id, event_type AS chrom, (event_id * 37) % 200000 AS s, (event_id * 37) % 200000 + CASE WHEN event_id % 11 = 0 THEN 0 ELSE 25000 END AS e,
CASE event_id % 7 WHEN 0 THEN 'nan' WHEN 1 THEN 'inf' WHEN 2 THEN 'x' WHEN 3 THEN '' ELSE CAST(event_id % 97 AS STRING) END AS value FROM {events})"""


@query(f"WITH {_TEXT_TRACK.format(events='events')} SELECT id, chrom, s, e, try_cast(value AS DOUBLE) AS value FROM raw WHERE isfinite(try_cast(value AS DOUBLE)) AND e > s")
def prj11_clean_track(spark, d):
    """Values that aren't finite numbers and empty intervals fall away."""
    raw = spark.sql(f"WITH {_TEXT_TRACK} SELECT * FROM raw", events=table(spark, d, "events"))
    return reporting.clean_track(raw)


@query(f"""{_BASE}, l AS (SELECT DISTINCT chrom1 AS chrom, start1, start2 FROM elig),
px AS (SELECT *, unnest(range(start1 // 5000, start1 // 5000 + 3)) AS x FROM l), py AS (SELECT *, unnest(range(start2 // 5000, start2 // 5000 + 2)) AS y FROM px)
SELECT chrom, start1, start2, least(x, y) * 5000 AS px1, greatest(x, y) * 5000 AS px2 FROM py WHERE (y - x) * 5000 BETWEEN 20000 AND 3000000""")
def prj13_spanned_pixels(spark, d):
    """Every pixel that a loop's anchors of three and two bins span."""
    wide = eligible(spark, d).select("chrom1", "start1", (F.col("start1") + 15000).alias("end1"), "chrom2", "start2", (F.col("start2") + 10000).alias("end2")).distinct()
    px = matrix.loop_pixels(wide, WIDTH, LOWER, UPPER, PLACE)
    return px.select(F.col("chrom1").alias("chrom"), "start1", "start2", F.col("px_start1").alias("px1"), F.col("px_start2").alias("px2"))


@query(f"{cte('track')} SELECT chrom, s, e, value FROM track WHERE chrom = 'chr3' AND s < 120000 AND e > 30000 AND value IS NOT NULL")
def prj16_track_slice(spark, d):
    t = table(spark, d, "track")
    return t.where((F.col("chrom") == "chr3") & fn.overlaps(F.col("s"), F.col("e"), F.lit(30_000), F.lit(120_000))).dropna().select("chrom", "s", "e", "value")


@query(f"""{cte('pairs')}, ends AS (SELECT sample, chrom1 AS chrom, pos1 AS p, strand1 AS strand FROM pairs WHERE pair_type = 'UU' UNION ALL SELECT sample, chrom2, pos2, strand2 FROM pairs WHERE pair_type = 'UU')
SELECT sample, chrom, strand, count(*) AS n, min(p) AS first_pos, max(p) AS last_pos FROM ends WHERE {PRIMARY_SQL.format('chrom')} GROUP BY ALL""")
def prj18_read_ends(spark, d):
    """Both ends of every unique pair as single reads on primary chromosomes."""
    end = lambda i: F.struct(F.col(f"chrom{i}").alias("chrom"), F.col(f"pos{i}").alias("p"), F.col(f"strand{i}").alias("strand"))
    ends = table(spark, d, "pairs").where("pair_type = 'UU'").select("sample", F.explode(F.array(end(1), end(2))).alias("x")).select("sample", "x.*")
    return ends.where(fn.primary(F.col("chrom"))).groupBy("sample", "chrom", "strand").agg(F.count("*").alias("n"), F.min("p").alias("first_pos"), F.max("p").alias("last_pos"))


# Filters


@query(f"""{_BASE}, peaks AS ({SQL['peaks']}), a AS (SELECT DISTINCT chrom1 AS chrom, start1 AS s FROM elig UNION SELECT chrom1, start2 FROM elig),
hit AS (SELECT chrom, s FROM a WHERE EXISTS (SELECT 1 FROM peaks p WHERE p.chrom = a.chrom AND p.s < a.s + 5000 AND p.e > a.s)) SELECT sample, chrom1, start1, start2, score FROM elig e
WHERE EXISTS (SELECT 1 FROM hit h WHERE h.chrom = chrom1 AND h.s = start1) OR EXISTS (SELECT 1 FROM hit h WHERE h.chrom = chrom1 AND h.s = start2)""")
def flt05_required_anchors(spark, d):
    """Calls of which either anchor meets a peak."""
    met = intervals.blocked_loops(eligible(spark, d), table(spark, d, "peaks"))
    return met.where("blocked").select("sample", *PLACE, "score")


@query(f"{cte('contacts')} SELECT sample, CAST(coalesce(sum(score) FILTER ((start2 - start1) // 5000 > 0 AND (start2 - start1) // 5000 <= 102345 // 5000), 0) AS BIGINT) AS depth FROM contacts GROUP BY sample")
def flt11_offset_depth(spark, d):
    """Contacts off the diagonal up to the offset that the greatest distance allows."""
    offset = F.floor((F.col("start2") - F.col("start1")) / WIDTH)
    inside = (offset > 0) & (offset <= 102_345 // WIDTH)
    return table(spark, d, "contacts").groupBy("sample").agg(F.coalesce(F.sum(F.when(inside, F.col("score"))), F.lit(0).cast("long")).alias("depth"))


@query(f"{cte('design')} SELECT * FROM design WHERE arm = 'BUILDING' AND subject_id IN ('p1', 'p3', 'p5')")
def flt17_selected_samples(spark, d):
    return reporting.select_samples(table(spark, d, "design"), {"arm": "BUILDING"}, ["p1", "p3", "p5"])


@query(f"{cte('bins')} SELECT chrom, count(*) AS n_bins FROM bins WHERE {PRIMARY_SQL.format('chrom')} AND chrom NOT IN ('chr21', 'chrX') GROUP BY chrom")
def flt18_graph_chromosomes(spark, d):
    b = table(spark, d, "bins")
    return b.where(fn.primary(F.col("chrom")) & ~F.col("chrom").isin("chr21", "chrX")).groupBy("chrom").agg(F.count("*").alias("n_bins"))


@query(f"""{cte('loops')} SELECT sample, chrom1, start1, start2, score FROM loops WHERE chrom1 = 'chr4' AND chrom2 = 'chr4' AND least(start1, start2) < 60000 AND greatest(end1, end2) > 40000
AND NOT (least(start1, start2) < 40000 AND greatest(end1, end2) > 60000)""")
def flt19_view_arcs(spark, d):
    return reporting.view_arcs(table(spark, d, "loops"), "chr4", 40_000, 60_000).select("sample", *PLACE, "score")


@query(f"""{cte('qc')}, t AS (SELECT sample, CASE sample % 9 WHEN 0 THEN NULL WHEN 1 THEN 'n/a' ELSE CAST(CAST(yield_pct AS INTEGER) AS VARCHAR) END AS y, dup_pct, cis_fraction FROM qc)
SELECT sample, coalesce(try_cast(y AS DOUBLE) < 25, false) AS low_yield, dup_pct > 50 AS high_dup, cis_fraction < 0.7 AS low_cis FROM t""")
def flt22_gate_failures(spark, d):
    """What can't be read as a number misses no gate."""
    k = F.col("sample") % 9
    text = F.when(k == 0, F.lit(None).cast("string")).when(k == 1, "n/a").otherwise(F.col("yield_pct").cast("int").cast("string"))
    fails = reporting.fails
    return table(spark, d, "qc").select("sample", fails(text, least=25).alias("low_yield"), fails(F.col("dup_pct"), most=50).alias("high_dup"), fails(F.col("cis_fraction"), least=0.7).alias("low_cis"))


@query(f"{cte('chroms', 'contacts')} SELECT chrom FROM chroms WHERE regexp_full_match(chrom, 'chr([0-9]+|X)') AND chrom <> 'chrX' AND chrom IN (SELECT chrom FROM contacts WHERE sample = 's0')")
def flt27_scored_chromosomes(spark, d):
    """Chromosomes of the view that the matrix has, without X."""
    seen = table(spark, d, "contacts").where("sample = 's0'").select("chrom").distinct()
    return main_view(table(spark, d, "chroms")).where("chrom <> 'chrX'").join(seen, "chrom", "left_semi").select("chrom")


# Joins


@query(f"""{_BASE} SELECT sha1(concat_ws(chr(31), chrom1, start1, end1, chrom2, start2, end2)) AS loop_key, chrom1, start1, start2, support AS value FROM cand""")
def join13_keyed_results(spark, d):
    """Results by key with the coordinates put back; a key that either side repeats is an error."""
    u = _candidates(spark, d).withColumn("loop_key", fn.loop_key(*map(F.col, universe.COORDS)))
    return contracts.one_to_one(u.select("loop_key", F.col("support").alias("value")), u.select("loop_key", *PLACE), ["loop_key"]).select("loop_key", *PLACE, "value")


@query(f"""{_BASE} SELECT c.chrom1, c.start1, c.start2, {', '.join(f"CAST(coalesce(sum(k.score) FILTER (k.sample = '{s}'), 0) AS BIGINT) AS {s}" for s in SAMPLES)}
FROM cand c LEFT JOIN calls k USING (chrom1, start1, end1, chrom2, start2, end2) GROUP BY ALL""")
def join14_aligned_samples(spark, d):
    """A column per sample; no cell is missing."""
    counts = universe.universe_counts(calls(spark, d), _candidates(spark, d))
    return reporting.aligned(counts, PLACE, SAMPLES)


_SEED = "CAST('0x' || substr(sha256(concat_ws('|', least(a.sample, b.sample), greatest(a.sample, b.sample), '25000', '1')), 1, 8) AS BIGINT)"


@query(f"{cte('contacts')}, x AS (SELECT DISTINCT sample FROM contacts) SELECT a.sample AS sample_a, b.sample AS sample_b, {_SEED} AS seed FROM x a JOIN x b ON a.sample < b.sample")
def join19_replicate_pairs(spark, d):
    """Every two samples of a study once, with a seed that doesn't depend on their order."""
    x = table(spark, d, "contacts").select("sample").distinct()  # samples of a study are few
    a, b = x.toDF("sample_a"), x.toDF("sample_b")
    return a.join(F.broadcast(b), F.col("sample_a") < F.col("sample_b")).withColumn("seed", fn.pair_seed(F.col("sample_b"), F.col("sample_a"), F.lit("25000"), F.lit("1")))


@query(f"""{cte('contacts', 'pairs', 'loops')} SELECT * FROM (SELECT sample, CAST(sum(score) AS BIGINT) AS contacts, count(*) AS pixels FROM contacts GROUP BY sample)
JOIN (SELECT sample, count(*) AS pairs, count(*) FILTER (chrom1 = chrom2) / count(*) AS cis FROM pairs GROUP BY sample) USING (sample) JOIN (SELECT sample, count(*) AS loops FROM loops GROUP BY sample) USING (sample)""")
def join22_library_table(spark, d):
    """One row per library, put together from three reports that must all have it."""
    c, p, x = (table(spark, d, t).groupBy("sample") for t in ("contacts", "pairs", "loops"))
    reports = c.agg(F.sum("score").alias("contacts"), F.count("*").alias("pixels")), p.agg(F.count("*").alias("pairs"), (F.count_if(F.col("chrom1") == F.col("chrom2")) / F.count("*")).alias("cis")), x.agg(F.count("*").alias("loops"))
    return reporting.library_table(reports[0].select("sample"), *reports)


@query(f"""{_BASE}, peaks AS ({SQL['peaks']}), bins AS ({SQL['bins']}), hit AS (SELECT DISTINCT b.chrom, b.s FROM bins b JOIN peaks p ON p.chrom = b.chrom AND p.s < b.e AND p.e > b.s),
a AS (SELECT shift, chrom1 AS chrom, ((start1 + end1) // 2 + shift) // 5000 * 5000 AS s FROM cand, (SELECT unnest([0, 35000]) AS shift))
SELECT CAST(shift AS INTEGER) AS shift, h.s IS NOT NULL AS in_class, count(*) AS n FROM a LEFT JOIN hit h USING (chrom, s) GROUP BY ALL""")
def join23_anchor_class(spark, d):
    """How many real and shifted anchors have their midpoint in a bin that meets a peak."""
    hit = intervals.with_overlap_flag(table(spark, d, "bins"), table(spark, d, "peaks"), ["bin_id"], "in_class").where("in_class").select("chrom", "s", "in_class")
    shifts = F.explode(F.array(F.lit(0), F.lit(35_000)))
    a = _candidates(spark, d).select(F.col("chrom1").alias("chrom"), "start1", "end1", shifts.alias("shift")).withColumn("s", fn.snap_start(F.floor((F.col("start1") + F.col("end1")) / 2) + F.col("shift"), WIDTH))
    return a.join(hit, ["chrom", "s"], "left").groupBy("shift", F.coalesce("in_class", F.lit(False)).alias("in_class")).agg(F.count("*").alias("n"))


@query(f"{cte('pairs', 'bins')} SELECT bin_id, count(*) AS n FROM pairs p JOIN bins b ON b.chrom = p.chrom1 AND b.s <= pos1 AND b.e > pos1 GROUP BY ALL")
def join24_containing_bin(spark, d):
    """The bin that holds a point, met on the grid."""
    p = table(spark, d, "pairs").select(F.col("chrom1").alias("chrom"), fn.snap_start(F.col("pos1"), WIDTH).alias("s"), "pos1")
    return p.join(table(spark, d, "bins"), ["chrom", "s"]).where("pos1 < e").groupBy("bin_id").agg(F.count("*").alias("n"))


# Aggregations, windows, sorts and sets


@query(f"{cte('loops')} SELECT chrom1, start1, start2, string_agg(DISTINCT sample, ',' ORDER BY sample) AS samples, count(DISTINCT sample) AS n, count(DISTINCT sample) = 4 AS covered FROM loops GROUP BY ALL")
def agg11_sample_sets(spark, d):
    """Samples that call a place, as a sorted list, and whether they are all that are expected."""
    x = table(spark, d, "loops").groupBy(*PLACE).agg(F.array_sort(F.collect_set("sample")).alias("s"))
    return x.select(*PLACE, F.array_join("s", ",").alias("samples"), F.size("s").cast("long").alias("n"), (F.col("s") == F.array(*map(F.lit, SAMPLES))).alias("covered"))


@query(f"""{_APA}, m AS (SELECT dy, dx, avg(v) AS mean FROM cell GROUP BY ALL) SELECT round(max(mean) FILTER (dy = 0 AND dx = 0), 6) AS centre, round(avg(mean) FILTER ((dy <= -3 AND dx <= -3) OR (dy >= 3 AND dx >= 3)), 6) AS background,
round(max(mean) FILTER (dy = 0 AND dx = 0) / greatest(avg(mean) FILTER ((dy <= -3 AND dx <= -3) OR (dy >= 3 AND dx >= 3)), 1e-9), 6) AS ratio FROM m""")
def agg15_corner_ratio(spark, d):
    """The mean window's centre over its corners."""
    cells = aggregate_peaks.windows(_apa_loops(spark, d), _one_sample(spark, d), WIDTH, 5)
    return aggregate_peaks.centre_ratio(aggregate_peaks.mean_window(cells), 5).select(*(F.round(c, 6).alias(c) for c in ("centre", "background", "ratio")))


@query(f"{cte('design')} SELECT subject_id, count(*) FILTER (arm = 'BUILDING') AS n_case, count(*) FILTER (arm = 'MACHINERY') AS n_control FROM design WHERE arm IN ('BUILDING', 'MACHINERY') GROUP BY subject_id")
def agg17_level_counts(spark, d):
    x = table(spark, d, "design").where(F.col("arm").isin("BUILDING", "MACHINERY"))
    return x.groupBy("subject_id").agg(F.count_if(F.col("arm") == "BUILDING").alias("n_case"), F.count_if(F.col("arm") == "MACHINERY").alias("n_control"))


@query(f"{cte('qc')} SELECT replicate_status, median(yield_pct) AS med_yield, median(cis_fraction) AS med_cis FROM qc GROUP BY ALL")
def agg20_class_medians(spark, d):
    return table(spark, d, "qc").groupBy("replicate_status").agg(F.median("yield_pct").alias("med_yield"), F.median("cis_fraction").alias("med_cis"))


@query(f"{cte('bins')} SELECT chrom, CAST(dense_rank() OVER (ORDER BY min(bin_id)) - 1 AS INTEGER) AS chrom_id FROM bins GROUP BY chrom")
def win07_chromosome_ids(spark, d):
    """Chromosomes numbered by their first bin."""
    first = table(spark, d, "bins").groupBy("chrom").agg(F.min("bin_id").alias("b"))  # a row per chromosome
    return first.select("chrom", (F.dense_rank().over(Window.orderBy("b")) - 1).alias("chrom_id"))


@query(f"{_BASE} SELECT chrom1, start1, start2, support, CAST(row_number() OVER (PARTITION BY chrom1 ORDER BY support DESC, start1, start2) AS INTEGER) AS place FROM cand")
def sort01_seed_ranks(spark, d):
    w = Window.partitionBy("chrom1").orderBy(F.desc("support"), "start1", "start2")
    return _candidates(spark, d).select(*PLACE, "support", F.row_number().over(w).alias("place"))


@query(f"{_BASE} SELECT * FROM cand ORDER BY ALL")
def sort02_coordinate_order(spark, d):
    """By coordinates; chromosomes as text, chr10 before chr2."""
    return _candidates(spark, d).orderBy(*universe.COORDS)


@query(f"""{cte('loops')}, p AS (SELECT sample, chrom1, start1, start2, CASE WHEN score % 6 <> 0 THEN fdr END AS padj FROM loops)
SELECT *, CAST(row_number() OVER (PARTITION BY sample ORDER BY padj NULLS LAST, chrom1, start1, start2) AS INTEGER) AS place FROM p""")
def sort04_result_order(spark, d):
    """By adjusted p within a sample, missing ones last."""
    x = table(spark, d, "loops").select("sample", *PLACE, F.when(F.col("score") % 6 != 0, F.col("fdr")).alias("padj"))
    return x.withColumn("place", F.row_number().over(Window.partitionBy("sample").orderBy(F.asc_nulls_last("padj"), *PLACE)))


@query("SELECT event_type AS panel, min(event_id) AS first_row FROM events GROUP BY ALL ORDER BY 2")
def sort10_panel_order(spark, d):
    """Distinct panels in the order in which they come first."""
    return table(spark, d, "events").groupBy(F.col("event_type").alias("panel")).agg(F.min("event_id").alias("first_row")).orderBy("first_row")


@query(f"{_BASE} SELECT chrom1, start1, start2, count(*) AS n FROM (SELECT DISTINCT sample, chrom1, start1, start2 FROM elig) t GROUP BY ALL")
def set01_all_calls(spark, d):
    """The calls of all samples laid together, each once."""
    e = eligible(spark, d).select("sample", *PLACE)
    every = reduce(lambda a, b: a.unionByName(b), (e.where(F.col("sample") == s) for s in SAMPLES))
    return every.dropDuplicates().groupBy(*PLACE).agg(F.count("*").alias("n"))


@query(f"{cte('design')} SELECT DISTINCT subject_id, 'control only' AS side FROM design WHERE arm = 'MACHINERY' AND subject_id NOT IN (SELECT subject_id FROM design WHERE arm = 'BUILDING') UNION ALL SELECT DISTINCT subject_id, 'either' FROM design WHERE arm IN ('BUILDING', 'MACHINERY')")
def set05_subjects_missing(spark, d):
    """Subjects that only the control has, and those of either arm."""
    x = table(spark, d, "design")
    case, control = (x.where(F.col("arm") == a).select("subject_id") for a in ("BUILDING", "MACHINERY"))
    return control.subtract(case).withColumn("side", F.lit("control only")).unionByName(case.union(control).distinct().withColumn("side", F.lit("either")))


# Scalar functions


@query(f"""{cte('pairs')}, n AS (SELECT sample, count(*) AS total, count(*) FILTER (pair_type = 'UU') AS kept, CASE WHEN sample = 's1' THEN 0.25 END AS stored FROM pairs GROUP BY sample)
SELECT sample, 100.0 * kept / total AS kept_pct, coalesce(CAST(stored AS DOUBLE), kept / total) AS fraction, 0.0::DOUBLE AS of_nothing FROM n""")
def fn02_percentages(spark, d):
    """Percentages guarded against zero; a stored fraction comes before a computed one."""
    n = table(spark, d, "pairs").groupBy("sample").agg(F.count("*").alias("total"), F.count_if(F.col("pair_type") == "UU").alias("kept"))
    stored = F.when(F.col("sample") == "s1", 0.25)
    return n.select("sample", fn.percent(F.col("kept"), F.col("total")).alias("kept_pct"), F.coalesce(stored, F.col("kept") / F.col("total")).alias("fraction"), fn.percent(F.col("kept"), F.lit(0)).alias("of_nothing"))


@query(f"{cte('chroms')} SELECT chrom, CAST(ceil(size / 5000) AS BIGINT) AS n_bins, CAST(ceil(size / 100000) AS BIGINT) AS n_coarse FROM chroms")
def fn04_bin_counts(spark, d):
    return table(spark, d, "chroms").select("chrom", F.ceil(F.col("size") / 5000).alias("n_bins"), F.ceil(F.col("size") / 100_000).alias("n_coarse"))


_NUMBER_TEXT = "CASE event_id % 6 WHEN 0 THEN '7.0' WHEN 1 THEN '7.5' WHEN 2 THEN 'nan' WHEN 3 THEN 'x' WHEN 4 THEN '' ELSE CAST(event_id AS STRING) END"


@query(f"SELECT event_id, CASE WHEN isfinite(try_cast({_NUMBER_TEXT} AS DOUBLE)) AND floor(try_cast({_NUMBER_TEXT} AS DOUBLE)) = try_cast({_NUMBER_TEXT} AS DOUBLE) THEN CAST(try_cast({_NUMBER_TEXT} AS DOUBLE) AS BIGINT) END AS whole FROM events")
def fn05_strict_integers(spark, d):
    return table(spark, d, "events").select("event_id", fn.strict_int(F.expr(_NUMBER_TEXT)).alias("whole"))


@query("""WITH n AS (SELECT c_nationkey AS nation, c_mktsegment AS segment, count(*) AS pairs FROM customer GROUP BY ALL)
SELECT nation, segment, CASE WHEN pairs < 2 THEN 'TOO_FEW_PAIRS' WHEN pairs < 8 THEN 'PILOT_UNDERPOWERED' ELSE 'STANDARD_INFERENCE' END AS status FROM n""")
def fn10_design_status(spark, d):
    n = table(spark, d, "customer").groupBy(F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment")).agg(F.count("*").alias("pairs"))
    return n.select("nation", "segment", fn.design_status(F.col("pairs"), 8).alias("status"))


@query(f"""{cte('qc')} SELECT sample, CASE WHEN sample % 5 = 0 OR sample % 5 = 4 THEN 'NOT_ASSESSED' WHEN sample % 2 = 0 THEN 'PASS' ELSE 'WARN' END AS balance,
CASE replicate_status WHEN 'PASS' THEN true WHEN 'FAIL' THEN false END AS gate, CASE replicate_status WHEN 'PASS' THEN 'PASS' WHEN 'FAIL' THEN 'FAIL' ELSE 'UNDECIDED' END AS label FROM qc""")
def fn12_status_gates(spark, d):
    """Balance fails closed; a gate is true, false or undecided."""
    gate = fn.status_gate(F.col("replicate_status"))
    converged = F.when(F.col("sample") % 5 != 4, F.col("sample") % 2 == 0)
    return table(spark, d, "qc").select("sample", fn.balance_status(F.col("sample") % 5 != 0, converged).alias("balance"), gate.alias("gate"), F.when(gate, "PASS").when(~gate, "FAIL").otherwise("UNDECIDED").alias("label"))


@query(f"{cte('loops')}, l AS (SELECT chrom1, start1, string_agg(DISTINCT sample, ',' ORDER BY sample) AS samples FROM loops GROUP BY ALL) SELECT sample, count(*) AS n FROM (SELECT unnest(string_split(samples, ',')) AS sample FROM l) t GROUP BY ALL")
def fn19_sample_lists(spark, d):
    """Sorted lists written and read back."""
    written = table(spark, d, "loops").groupBy("chrom1", "start1").agg(F.array_join(F.array_sort(F.collect_set("sample")), ",").alias("samples"))
    return written.select(F.explode(F.split("samples", ",")).alias("sample")).groupBy("sample").agg(F.count("*").alias("n"))


_NAMES = "concat(CASE c_custkey % 3 WHEN 0 THEN 'H3K27ac' WHEN 1 THEN 'H3K4me3' ELSE 'CTCF' END, '_d', CAST(c_custkey AS STRING), '_rep', CAST(c_custkey % 4 AS STRING))"


@query(f"SELECT c_custkey AS id, replace(replace(regexp_replace({_NAMES}, 'H3(K27ac|K4me3|K4me1|K27me3)', '\\1'), '_rep', ' r'), '_', ' ') AS label FROM customer")
def fn20_sample_labels(spark, d):
    return table(spark, d, "customer").select(F.col("c_custkey").alias("id"), fn.sample_label(F.expr(_NAMES)).alias("label"))


@query("SELECT c_name AS sample, 'age' AS key, CASE WHEN c_custkey % 4 = 0 THEN 0.0 ELSE CAST(c_custkey % 90 AS DOUBLE) END AS value, c_custkey % 4 <> 0 AS observed FROM customer")
def fn21_token_values(spark, d):
    """Blank cells are unobserved zeros; columns of texts are passed over."""
    t = table(spark, d, "customer").select("c_name", F.when(F.col("c_custkey") % 4 == 0, " ").otherwise((F.col("c_custkey") % 90).cast("string")).alias("age"), F.col("c_mktsegment").alias("arm"))
    return graph.token_values(t, "c_name")


@query(f"{cte('qc')} SELECT replicate_status AS grp, 'weight' AS normalization, CAST(NULL AS VARCHAR) AS absent FROM qc GROUP BY ALL")
def fn23_single_values(spark, d):
    """An annotation's one value; none gives null."""
    q = table(spark, d, "qc").groupBy(F.col("replicate_status").alias("grp"))
    return q.agg(reporting.single_value(F.when(F.col("sample") % 3 == 0, "weight")).alias("normalization"), reporting.single_value(F.lit(None).cast("string")).alias("absent"))


@query(f"{cte('loops')} SELECT sample, chrom1, start1, start2, round(pvalue - 1.96 * fdr, 9) AS low, round(pvalue + 1.96 * fdr, 9) AS high FROM loops")
def fn27_intervals(spark, d):
    x = table(spark, d, "loops").withColumn("ci", fn.interval(F.col("pvalue"), F.col("fdr")))
    return x.select("sample", *PLACE, F.round("ci.low", 9).alias("low"), F.round("ci.high", 9).alias("high"))


@query("SELECT event_id, event_type AS by_folder, CASE WHEN event_id % 5 <> 0 THEN concat(event_type, '_', event_id) END AS by_name FROM events")
def fn29_path_samples(spark, d):
    """Samples by the name of a file and by its folder."""
    e = table(spark, d, "events")
    path = F.concat(F.lit("out/"), "event_type", F.lit("/"), "event_type", F.lit("_"), "event_id", F.when(F.col("event_id") % 5 == 0, ".txt").otherwise(".peaks.bed"))
    return e.withColumn("p", fn.path_sample(path, ".peaks.bed")).select("event_id", "p.by_folder", "p.by_name")


@query(f"{cte('track')} SELECT chrom, bool_or(s % 50000 = 0) AS available, CASE WHEN NOT bool_or(s % 50000 = 0) THEN 'no finite values' END AS reason FROM track GROUP BY chrom")
def fn30_availability(spark, d):
    t = table(spark, d, "track").withColumn("value", F.when(F.col("s") % 50_000 == 0, F.col("value")).otherwise(float("nan")))
    return t.groupBy("chrom").agg(*reporting.availability(F.col("value"), "no finite values"))


@query(f"""{cte('loops')} SELECT sample, chrom1, start1, start2, CASE WHEN score % 5 = 0 THEN 323.306215 ELSE round(-log10(pvalue), 6) END AS evidence, CASE WHEN end2 - start1 > 0 THEN round(log10(end2 - start1), 6) END AS span FROM loops""")
def fn34_plot_clamps(spark, d):
    p = F.when(F.col("score") % 5 == 0, 0.0).otherwise(F.col("pvalue"))
    span = F.col("end2") - F.col("start1")
    return table(spark, d, "loops").select("sample", *PLACE, F.round(fn.evidence(p), 6).alias("evidence"), F.when(span > 0, F.round(F.log10(span), 6)).alias("span"))


_MARKS = {"BUILDING": {"mode": "broad", "q": 0.05, "broad_cutoff": 0.2}, "MACHINERY": {"mode": "narrow", "q": 0.001}}


@query("""SELECT DISTINCT c_mktsegment AS mark, CASE c_mktsegment WHEN 'BUILDING' THEN 'broad' ELSE 'narrow' END AS mode, CAST(CASE c_mktsegment WHEN 'BUILDING' THEN 0.05 WHEN 'MACHINERY' THEN 0.001 ELSE 0.01 END AS DOUBLE) AS q,
CAST(CASE c_mktsegment WHEN 'BUILDING' THEN 0.2 ELSE 0.1 END AS DOUBLE) AS broad_cutoff FROM customer""")
def fn35_peak_settings(spark, d):
    m = table(spark, d, "customer").select(F.col("c_mktsegment").alias("mark")).distinct()
    return m.withColumn("x", reporting.peak_settings(F.col("mark"), _MARKS)).select("mark", "x.*")


# Contracts


@query(f"""{cte('contacts')}, f AS (SELECT score % 3 AS a, score % 2 AS b FROM contacts) SELECT 'Peak-to-Peak' AS kind, count(*) FILTER (a = 2) AS bad_flags, count(*) FILTER (NOT (a = 1 AND b = 1)) AS bad_kind FROM f
UNION ALL SELECT 'Peak-to-NonPeak', count(*) FILTER (a = 2), count(*) FILTER (a = b) FROM f UNION ALL SELECT 'Peak-to-ALL', count(*) FILTER (a = 2), count(*) FILTER (a <> 1 AND b <> 1) FROM f UNION ALL SELECT 'ALL-to-ALL', count(*) FILTER (a = 2), 0 FROM f""")
def chk02_peak_flags(spark, d):
    """Rows whose flags are no flags, or don't fit the kind of interaction."""
    f = table(spark, d, "contacts").select((F.col("score") % 3).alias("a"), (F.col("score") % 2).alias("b"))
    one = lambda kind: F.struct(F.lit(kind).alias("kind"), *(F.count_if(~ok).alias(f"bad_{n}") for n, ok in reporting.peak_flags(kind, F.col("a"), F.col("b")).items()))
    return f.agg(F.array(*map(one, reporting.INTERACTIONS)).alias("x")).select(F.inline("x"))


@query(f"{cte('contacts')} SELECT sample, count(*) AS n, 'left' AS side FROM contacts WHERE sample = 's2' GROUP BY sample UNION ALL SELECT sample, count(*) + 1, 'right' FROM contacts WHERE sample = 's2' GROUP BY sample")
def chk08_audited_rows(spark, d):
    """Observed rows against an audit in which one sample's number is wrong."""
    seen = table(spark, d, "contacts").groupBy("sample").agg(F.count("*").alias("n"))
    return contracts.set_difference(seen, seen.withColumn("n", F.col("n") + F.when(F.col("sample") == "s2", 1).otherwise(0)))


@query(f"""{_BASE} SELECT sample, chrom1, start1, start2, concat_ws(',', CASE WHEN {_BLOCKED} THEN 'clear' END, CASE WHEN start2 - start1 < 20000 THEN 'distance' END, CASE WHEN score < 5 THEN 'enough' END) AS broken
FROM calls c WHERE {PRIMARY_SQL.format('chrom1')} AND ({_BLOCKED} OR start2 - start1 < 20000 OR score < 5)""")
def chk05_revalidated_rows(spark, d):
    """Calls tested again on all that eligible rows must keep, the blacklist too."""
    rows = intervals.blocked_loops(calls(spark, d).where(fn.primary(F.col("chrom1"))), table(spark, d, "blacklist"))
    rules = contracts.loop_geometry(WIDTH, LOWER, UPPER, F.lit(10**9)) | {"clear": ~F.col("blocked"), "enough": F.col("score") >= MIN_COUNT}
    return contracts.violations(rows, rules).select("sample", *PLACE, "broken")


@query(f"{_BASE}, a AS (SELECT chrom1, start1, end1, chrom2, start2, end2, count(*) AS again FROM calls WHERE score >= 5 GROUP BY ALL) SELECT chrom1, start1, start2, support, coalesce(again, 0) AS again FROM cand LEFT JOIN a USING (chrom1, start1, end1, chrom2, start2, end2) WHERE coalesce(again, 0) <> support")
def chk10_support_again(spark, d):
    """Candidates whose support, counted anew from all calls, is another; none."""
    again = calls(spark, d).where(F.col("score") >= MIN_COUNT).groupBy(*universe.COORDS).agg(F.count("*").alias("again"))
    both = _candidates(spark, d).join(again, universe.COORDS, "left").withColumn("again", F.coalesce("again", F.lit(0).cast("long")))
    return both.where("again <> support").select(*PLACE, "support", "again")


@query(f"{_BASE} SELECT chrom1, start1, start2, 1 AS n FROM cand WHERE false")
def chk11_universe_rules(spark, d):
    """Places of the universe that aren't cis and upper, or come twice; none."""
    u = _candidates(spark, d)
    bad = contracts.violations(u, {"cis": F.col("chrom1") == F.col("chrom2"), "upper": F.col("start1") < F.col("start2")}).select(*PLACE, F.lit(1).alias("n"))
    return bad.unionByName(contracts.duplicates(u, universe.COORDS).select(*PLACE, F.col("n").cast("int").alias("n")))


@query(f"SELECT event_id, concat_ws(',', CASE WHEN event_id % 6 IN (1, 2, 3, 4) THEN 'count' END) AS broken FROM events WHERE event_id % 6 IN (1, 2, 3, 4)")
def chk12_count_values(spark, d):
    """Counts that aren't whole numbers from 0."""
    e = table(spark, d, "events").select("event_id", fn.strict_int(F.expr(_NUMBER_TEXT)).alias("count"))
    return contracts.violations(e, {"count": F.col("count") >= 0}).select("event_id", "broken")


@query(f"""{cte('design')}, r AS (SELECT subject_id, count(*) FILTER (arm = 'BUILDING') AS n_case, count(*) FILTER (arm = 'MACHINERY') AS n_control FROM design GROUP BY subject_id)
SELECT subject_id, n_case, n_control FROM r WHERE NOT (n_case = 1 AND n_control = 1)""")
def chk14_unpaired(spark, d):
    """Subjects that don't have one case and one control."""
    r = differential.pair_roster(table(spark, d, "design"), "BUILDING", "MACHINERY")
    return contracts.violations(r, {"one_to_one": (F.col("n_case") == 1) & (F.col("n_control") == 1)}).select("subject_id", "n_case", "n_control")


@query(f"""{cte('loops')}, x AS (SELECT *, CASE score % 8 WHEN 0 THEN 1.5 WHEN 1 THEN 'nan'::DOUBLE ELSE fdr END AS q, CASE WHEN score % 9 = 0 THEN 0 ELSE 1 END AS scale, start1 + CASE WHEN score % 10 = 0 THEN 7 ELSE 0 END AS at FROM loops),
b AS (SELECT sample, chrom1, start1, start2, concat_ws(',', CASE WHEN score % 10 = 0 THEN 'grid' END, CASE WHEN score % 8 IN (0, 1) THEN 'q' END, CASE WHEN score % 9 = 0 THEN 'scale' END) AS broken FROM x) SELECT * FROM b WHERE broken <> ''""")
def chk19_caller_rows(spark, d):
    """Rows of a caller off the grid, with a q beyond [0, 1] or without a positive finite scale."""
    k = F.col("score")
    x = table(spark, d, "loops").withColumns({"q": F.when(k % 8 == 0, 1.5).when(k % 8 == 1, float("nan")).otherwise(F.col("fdr")), "scale": F.when(k % 9 == 0, 0.0).otherwise(1.0), "at": F.col("start1") + F.when(k % 10 == 0, 7).otherwise(0)})
    rules = {"cis": F.col("chrom1") == F.col("chrom2"), "grid": F.col("at") % WIDTH == 0, "q": reporting.finite(F.col("q")) & F.col("q").between(0, 1), "scale": reporting.finite(F.col("scale")) & (F.col("scale") > 0)}
    return contracts.violations(x, rules).select("sample", *PLACE, "broken")


@query(f"{cte('track', 'peaks')} SELECT 'track' AS name, count(*) AS n FROM track WHERE e <= s UNION ALL SELECT 'peaks', count(*) FROM peaks WHERE e <= s UNION ALL SELECT 'overlapping', count(*) FROM (SELECT chrom, lead(s) OVER (PARTITION BY chrom ORDER BY s, e) AS nx, e FROM track) t WHERE nx < e")
def chk30_source_rules(spark, d):
    """Empty intervals, and intervals of a track that overlap the next."""
    t, p = table(spark, d, "track"), table(spark, d, "peaks")
    rows = {"track": t.where("e <= s"), "peaks": p.where("e <= s"), "overlapping": intervals.not_disjoint(t, ["chrom"])}
    return reduce(lambda a, b: a.unionByName(b), (x.agg(F.count("*").alias("n")).select(F.lit(k).alias("name"), "n") for k, x in rows.items()))


# Composites


@query(f"""{_BASE}, t AS (SELECT *, CASE WHEN score % 4 = 0 THEN 'NA' WHEN score % 4 = 1 THEN '0.5' ELSE '0.01' END AS q FROM calls c WHERE {PRIMARY_SQL.format('chrom1')} AND NOT {_BLOCKED})
SELECT sample, count(*) AS retained, count(*) FILTER (score >= 5) AS eligible, count(*) FILTER (q = '0.5') AS above_q, count(*) FILTER (q = 'NA') AS missing_q FROM t GROUP BY sample""")
def pip01_normalised_audit(spark, d):
    """All interactions parsed and cleaned without looking at q, with what is counted on the way."""
    k = F.col("score") % 4
    rows = calls(spark, d).withColumn("p", fn.probability(F.when(k == 0, "NA").when(k == 1, "0.5").otherwise("0.01")))
    contracts.assert_empty(rows.where("not p.valid").select("p.valid"), "a q-value is no probability")
    kept = intervals.blocked_loops(rows.where(fn.primary(F.col("chrom1"), F.col("chrom2"))), table(spark, d, "blacklist")).where("not blocked")
    return kept.groupBy("sample").agg(F.count("*").alias("retained"), F.count_if(F.col("score") >= MIN_COUNT).alias("eligible"), F.count_if(F.col("p.value") > 0.05).alias("above_q"), F.count_if(F.col("p.value").isNull()).alias("missing_q"))


@query(f"""{cte('design')}, st AS (SELECT concat('d', CAST(o_custkey AS VARCHAR)) AS sample, CAST(floor(o_totalprice) AS BIGINT) + 1 AS length FROM orders)
SELECT d.sample_id AS sample, d.arm AS mark, 5000 AS resolution, count(st.length) AS n_stripes, coalesce(round(median(st.length) / 1000, 1), 0.0) AS median_length_kb, coalesce(round(max(st.length) / 1000, 1), 0.0) AS max_length_kb
FROM design d LEFT JOIN st ON st.sample = d.sample_id GROUP BY ALL ORDER BY 2, 1""")
def pip16_stripe_summary(spark, d):
    """Stripes of every sample by mark; samples without any have zeros."""
    samples = table(spark, d, "design").select(F.col("sample_id").alias("sample"), F.col("arm").alias("mark"))
    st = table(spark, d, "orders").select(F.concat(F.lit("d"), "o_custkey").alias("sample"), (F.floor("o_totalprice") + 1).alias("length"))
    return reporting.stripe_summary(samples, st, WIDTH)
