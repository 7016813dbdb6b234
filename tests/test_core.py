"""Core operators on worked examples."""

import gzip
import hashlib
import json
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from helixmill import catalog
from helixmill.functions import coords as fn
from helixmill.functions import rolls
from helixmill.operators import aggregate_peaks, contracts, differential, graph, intervals, matching, matrix, reporting, universe
from helixmill.sources import readers, sinks


def table(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def values(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


PEAK = "sample string, chrom string, s long, e long"


@pytest.mark.parametrize(
    ("peaks", "want"),
    [
        ([("a", 100, 200), ("a", 1000, 1100), ("b", 150, 250)], [(150, 200, 2)]),
        ([("a", 0, 100), ("b", 50, 150), ("c", 100, 200)], [(50, 100, 2), (100, 150, 2)]),
    ],
)
def test_consensus_peaks(spark, peaks, want):
    df = table(spark, [(s, "chr1", a, b) for s, a, b in peaks], PEAK)
    assert values(intervals.supported_segments(df, 2), "s", "e", "support") == want


def test_weighted_mean(spark):
    bins = table(spark, [("chr1", i * 5000, i * 5000 + 5000) for i in range(6)] + [("chr2", 0, 20000), ("chr3", 0, 10)], "chrom string, s long, e long")
    track = table(spark, [("chr1", 0, 25000, 2.0), ("chr1", 25000, 100000, 7.0), ("chr2", 0, 5000, 2.0), ("chr2", 5000, 20000, 6.0)], "chrom string, s long, e long, value double")
    got = {(r["chrom"], r["s"]): r["value"] for r in intervals.weighted_mean(bins, track, ["chrom", "s", "e"]).collect()}
    assert [got["chr1", i * 5000] for i in range(6)] == [2, 2, 2, 2, 2, 7] and got["chr2", 0] == 5.0 and got["chr3", 0] is None


def test_overlaps_against_brute_force(spark):
    rng = random.Random(5)
    mk = lambda n: [(f"chr{rng.randint(1, 2)}", a := rng.randrange(300_000), a + rng.choice([1, 500, 120_000])) for _ in range(n)]
    left, right = mk(60), mk(60)
    a, b = (table(spark, x, "chrom string, s long, e long") for x in (left, right))
    got = values(intervals.overlap_pairs(a, b), "chrom", "s", "e", "r_s", "r_e")
    assert got == sorted((c, s, e, s2, e2) for c, s, e in left for c2, s2, e2 in right if c == c2 and s < e2 and e > s2)
    assert intervals.overlap_pairs(a, b.limit(0)).count() == 0


def test_nearest_against_brute_force(spark):
    rng = random.Random(6)
    points = sorted({("chr1", a := rng.randrange(1000), a + rng.randint(1, 50)) for _ in range(60)}) + [("chr9", 1, 2)]
    feats = [("chr1", rng.randrange(1000), f"g{i}") for i in range(25)]
    got = values(intervals.nearest(table(spark, points, "chrom string, s long, e long"), table(spark, feats, "chrom string, pos long, name string"), ["chrom", "s", "e"]).where("distance is not null"), "s", "e", "distance")
    assert got == sorted((s, e, min(s - p if p < s else p - e + 1 if p >= e else 0 for _, p, _ in feats)) for c, s, e in points if c == "chr1")


def calls(spark, rows):
    return table(spark, [(s, "chr1", a, b) for s, a, b in rows], "sample string, chrom string, start1 long, start2 long")


def test_consensus_loops(spark):
    sizes = table(spark, [("chr1", 1_000_000)], "chrom string, size long")
    shifted = calls(spark, [("sample_a", 0, 20000), ("sample_b", 5000, 25000)])
    cols = ["start1", "end1", "start2", "end2", "support"]
    assert values(matching.consensus_loops(shifted, 5000, 1, 2, sizes), *cols) == [(0, 10000, 15000, 30000, 2)]
    assert matching.consensus_loops(shifted, 5000, 0, 2, sizes).count() == 0
    vote = calls(spark, [("sample_a", 0, 20000), ("sample_a", 5000, 25000), ("sample_b", 5000, 25000)])
    assert values(matching.consensus_loops(vote, 5000, 1, 2, sizes), "support", "samples") == [(2, "sample_a,sample_b")]
    chain = calls(spark, [(f"s{i}", 5000 * i, 40000 + 5000 * i) for i in range(4)])
    assert matching.tolerant_support(chain, 5000, 1).agg(F.max("support")).first()[0] == 3


def greedy(seeds, reach):
    out = []
    for s, a, b in sorted((-s, a, b) for a, b, s in seeds):
        if all(max(abs(a - x), abs(b - y)) > reach * 5000 for x, y in out):
            out.append((a, b))
    return sorted(out)


@pytest.mark.parametrize("tol", [0, 1, 2, 4])
def test_representatives_equal_sequential_choice(spark, tol):
    rng = random.Random(tol)
    seeds = [(a * 5000, b * 5000, rng.randint(1, 4)) for a, b in {(rng.randrange(40), rng.randrange(40)) for _ in range(120)}]
    df = table(spark, [("chr1", *s) for s in seeds], "chrom string, start1 long, start2 long, support int")
    assert values(matching.spaced_representatives(df, 5000, 2 * tol), "start1", "start2") == greedy(seeds, 2 * tol)


def test_seventy_five_thousand_seeds(spark):
    df = spark.range(75_000).select(F.lit("chr1").alias("chrom"), (F.col("id") * 15000).alias("start1"), (F.col("id") * 15000).alias("start2"), F.lit(2).alias("support"))
    assert matching.spaced_representatives(df, 5000, 2).count() == 75_000


def test_seventy_five_thousand_dense_seeds(spark):
    import time

    side = 274  # all of equal support and next to each other: one conflict chain through the whole square
    df = spark.range(75_000).select(F.lit("chr1").alias("chrom"), ((F.col("id") / side).cast("long") * 5000).alias("start1"), (F.col("id") % side * 5000).alias("start2"), F.lit(2).alias("support"))
    began = time.time()
    got = {(r["start1"], r["start2"]) for r in matching.spaced_representatives(df, 5000, 2).collect()}
    assert time.time() - began < 60
    assert got == {(a * 5000, b * 5000) for a in range(0, side, 3) for b in range(0, side, 3) if a * side + b < 75_000}


def test_twenty_thousand_loops_against_as_many(spark):
    import time

    place = lambda shift: spark.range(20_000).select(F.lit("chr1").alias("chrom"), (F.col("id") % 200 * 10_000 + shift).alias("start1"), ((F.col("id") / 200).cast("long") * 10_000).alias("start2"))
    began = time.time()
    edges = matching.candidate_matches(place(0), place(10_000), 10_000, 1)
    got = matching.greedy_matching(edges)
    assert got.count() == 19_900 and got.where("distance = 0").count() == 19_900
    assert edges.count() <= 9 * 20_000 and time.time() - began < 90


def test_matching_equals_sequential_choice(spark):
    rng = random.Random(8)
    a, b = ({(rng.randrange(12) * 10000, rng.randrange(12) * 10000) for _ in range(50)} for _ in range(2))
    mk = lambda x: table(spark, [("chr1", *p) for p in x], "chrom string, start1 long, start2 long")
    edges = matching.candidate_matches(mk(a), mk(b), 10000, 1)
    want, used_a, used_b = [], set(), set()
    for _, p, o in sorted((abs(p[0] - o[0]) + abs(p[1] - o[1]), p, o) for p in a for o in b if max(abs(p[0] - o[0]), abs(p[1] - o[1])) <= 10000):
        if p not in used_a and o not in used_b:
            want.append((*p, *o))
            used_a.add(p)
            used_b.add(o)
    got = matching.greedy_matching(edges)
    assert values(got, "p1", "p2", "o1", "o2") == sorted(want)
    one = matching.concordance_summary(mk(a), mk(b), got).first()
    assert one["jaccard"] == len(want) / (len(a) + len(b) - len(want))


def loops(spark, rows):
    return table(spark, rows, "sample string, chrom1 string, start1 long, end1 long, chrom2 string, start2 long, end2 long, score long")


def test_universe(spark):
    at = {"loop1": ("chr1", 0, 5000, "chr1", 20000, 25000), "loop2": ("chr1", 5000, 10000, "chr1", 30000, 35000)}
    rows = [("s1", *at["loop1"], 8), ("s1", *at["loop2"], 1), ("s2", *at["loop1"], 7), ("s3", *at["loop1"], 3), ("s3", *at["loop2"], 9), ("s4", *at["loop2"], 10)]
    every, mask = loops(spark, rows), table(spark, [("chr2", 0, 100)], "chrom string, s long, e long")
    cand = universe.support(universe.eligible(every, mask, 5, 20000, 3_000_000), 2)
    got = universe.support_table(universe.universe_counts(every, cand.drop("support")), 5).orderBy("start1").collect()
    assert [r["support"] for r in got] == [2, 2] and got[0]["support_samples"] == "s1,s2" and json.loads(got[0]["source_counts"]) == {"s1": 8, "s2": 7, "s3": 3, "s4": 0}
    tampered = every.withColumn("score", F.when(F.col("sample") == "s1", F.col("score") + 1).otherwise(F.col("score")))
    assert universe.inconsistent(every, tampered).count() == 2 and universe.inconsistent(every, every).count() == 0


def test_contracts(spark):
    df = table(spark, [(1,), (2,)], "x int")
    contracts.assert_empty(df.where("x > 5"), "none")
    with pytest.raises(contracts.ContractError, match="odd"):
        contracts.assert_empty(df, "odd rows")
    with pytest.raises(contracts.ContractError):
        contracts.require_columns(df, ["y"])
    with pytest.raises(contracts.ContractError, match="repeats"):
        contracts.one_to_one(df.union(df), df, ["x"])
    off = loops(spark, [("s", "chr1", 1, 5001, "chr1", 20000, 25000, 3)])
    assert contracts.violations(off, contracts.loop_geometry(5000, 10000, 50000, F.lit(100000))).first()["broken"] == "grid"


def test_scalar_functions(spark):
    one = lambda df, c: df.select(c).first()[0]
    t = table(spark, [("NA",), ("0.5",), ("inf",), ("1.2",), ("garbage",), (" nan ",)], "t string")
    assert [tuple(r["p"]) for r in t.select(fn.probability(F.col("t")).alias("p")).collect()] == [(None, True), (0.5, True), (None, False), (None, False), (None, False), (None, True)]
    x = table(spark, [("chr10", "chr2", "chrX", "chrUn")], "a string, b string, c string, d string")
    assert tuple(x.select(*(fn.natural_rank(F.col(c)) for c in "abcd")).first()) == (10, 2, 23, 1_000_000)
    frag = lambda *v: one(table(spark, [v], "a long, b long, s string, t string, p long, q long"), fn.fragment_class(*map(F.col, "abstpq")))
    assert [frag(1, 1, "+", "-", 5, 9), frag(1, 1, "-", "+", 5, 9), frag(1, 2, "+", "-", 5, 9), frag(-1, 2, "+", "-", 5, 9), frag(1, 1, "+", "+", 5, 9)] == ["dangling_end", "self_circle", "regular", "unassigned", "same_strand"]
    for scores, want in ([], "NOT_ASSESSED"), ([0.7], "PASS"), ([0.72, 0.91], "PASS"), ([0.2, 0.69], "FAIL"), ([0.2, 0.91], "DISCORDANT"):
        assert one(table(spark, [(s,) for s in scores], "v double").agg(fn.replicate_status(F.col("v"), 0.7).alias("s")), "s") == want
    with pytest.raises(Exception, match="unknown status"):
        table(spark, [("odd",)], "s string").select(fn.status_gate(F.col("s"))).collect()


def test_differential(spark):
    v = table(spark, [(k, s, x) for k, row in {"a": [10, 5, 20, 10], "b": [4, 4, 2, 8]}.items() for s, x in zip(["case1", "ctrl1", "case2", "ctrl2"], map(float, row), strict=True)], "loop_key string, sample string, value double")
    roster = table(spark, [("d1", "case1", "ctrl1"), ("d2", "case2", "ctrl2")], "subject_id string, case_sample string, control_sample string")
    got = {(r["loop_key"], r["subject_id"]): r["log2_ratio"] for r in differential.paired_effects(v, roster).collect()}
    assert len(got) == 4 and got["a", "d1"] == pytest.approx(np.log2(11 / 6))
    p = table(spark, [("g", 0.01), ("g", 0.04), ("g", 0.03), ("g", 0.5), ("g", None), ("g", 0.04)], "g string, pvalue double")
    adj = sorted((r["pvalue"], round(r["padj"], 6)) for r in differential.benjamini_hochberg(p, ["g"]).where("pvalue is not null").collect())
    assert adj == [(0.01, 0.05), (0.03, 0.05), (0.04, 0.05), (0.04, 0.05), (0.5, 0.5)]
    assert differential.design_rank(pd.DataFrame({"s": ["a", "a", "b", "b"], "c": ["x", "y", "x", "y"]}), ["s", "c"]) == (3, 3)
    assert differential.design_rank(pd.DataFrame({"s": ["a", "a", "b", "b"], "c": ["x", "x", "y", "y"]}), ["s", "c"]) == (2, 3)
    up = table(spark, [("up", s, n) for s, n in zip(["a1", "b1", "a2", "b2"], [200, 20, 180, 22], strict=True)], "loop_key string, sample string, count long")
    design = pd.DataFrame({"sample": ["a1", "b1", "a2", "b2"], "subject_id": ["1", "1", "2", "2"], "arm": ["case", "ctrl"] * 2})
    r = differential.negative_binomial(up, table(spark, [(s, 1.0) for s in design["sample"]], "sample string, size_factor double"), design, "case").first()
    assert r["log2_fold_change"] == pytest.approx(np.log2(380 / 42), abs=0.2) and r["pvalue"] < 0.01


def test_bootstrap_and_balance(spark):
    place = "chrom string, start1 long, start2 long, real double, control double"
    df = table(spark, [("chr1", 0, 9, 10.0, 5.0), ("chr2", 0, 9, 20.0, 10.0), ("chr2", 5_000_000, 9, 40.0, 20.0), ("chr2", 5, 9, None, 1.0), ("chr2", 6, 9, 1.0, float("nan"))], place)
    assert tuple(aggregate_peaks.bootstrap_ratio(df, 200).first()) == pytest.approx((2.0, 3, 2.0, 2.0))
    rng = np.random.default_rng(1)
    real, control = rng.gamma(4.0, 2.0, 80), rng.gamma(3.0, 1.0, 80)
    got = aggregate_peaks.bootstrap_ratio(table(spark, [("chr1", 5000 * i, 9, float(a), float(b)) for i, (a, b) in enumerate(zip(real, control, strict=True))], place)).first()
    drawn = [[int(hashlib.md5(f"42|{b}|{i}".encode()).hexdigest()[:15], 16) % 80 for i in range(80)] for b in range(500)]
    low, high = np.quantile([real[d].mean() / control[d].mean() for d in drawn], [0.025, 0.975])
    assert tuple(got) == pytest.approx((real.mean() / control.mean(), 80, low, high))
    px = [(i, j, 5 + (i * 7 + j) % 11) for i in range(12) for j in range(i + 1, 12)]
    w, ok, _ = matrix.balance(table(spark, px, "bin1 int, bin2 int, count int"), ignore_diags=1, min_nnz=2, mad_max=50, tol=1e-6)
    weight = {r["bin_id"]: r["weight"] for r in w.collect()}
    sums = np.zeros(12)
    for i, j, c in px:
        sums[[i, j]] += c * weight[i] * weight[j]
    assert ok and sums.std() / sums.mean() < 2e-3


def test_graph(spark):
    bins = lambda w, n: graph.node_index(table(spark, [("chr1", i * w) for i in range(n)], "chrom string, s long"))
    assert values(graph.containment(bins(5000, 4), bins(10000, 2), 10000), "child", "parent") == [(0, 0), (1, 0), (2, 1), (3, 1)]
    with pytest.raises(contracts.ContractError):
        graph.containment(bins(5000, 4), bins(10000, 1), 10000)
    rows = [("chr1", 0, "chr1", 55000, 9, 0.02, 0.04), ("chr1", 5000, "chr1", 60000, 12, 0.01, 0.03), ("chr1", 0, "chr1", 5000, 3, 0.1, 0.1)]
    e = graph.loop_edges(table(spark, rows, "chrom1 string, start1 long, chrom2 string, start2 long, score long, pvalue double, fdr double"), bins(25000, 3), 25000)
    assert values(e, "src", "dst", "score", "pvalue", "fdr", "distance", "n") == [(0, 2, 12.0, 0.01, 0.03, 50000, 2), (2, 0, 12.0, 0.01, 0.03, 50000, 2)]
    tok = graph.token_values(table(spark, [("A", "40", "", "case"), ("B", "50", "2.5", "control")], "sample_id string, age string, metabolite string, label string"), "sample_id")
    assert values(tok, "sample", "key", "value", "observed") == [("A", "age", 40.0, True), ("A", "metabolite", 0.0, False), ("B", "age", 50.0, True), ("B", "metabolite", 2.5, True)]
    with pytest.raises(contracts.ContractError):
        graph.token_values(table(spark, [("A", "1"), ("B", "x")], "sample_id string, age string"), "sample_id")


def test_readers_and_sinks(spark, tmp_path):
    (tmp_path / "b.bed").write_bytes(gzip.compress(b"chr1\t0\t10\nchr1\tx\t3\n"))  # gzip without its suffix
    assert values(readers.read_bed(spark, str(tmp_path / "b.bed")), "chrom", "s", "e") == [("chr1", 0, 10)]
    with pytest.raises(contracts.ContractError):
        readers.read_bed(spark, str(tmp_path / "b.bed"), strict=True)
    (tmp_path / "l.tsv").write_text("chr1\ts1\te1\tchr2\ts2\te2\tcc\tP-Value_Bias\tQ-Value_Bias\nchr1\t2255000\t2260000\tchr1\t2300000\t2305000\t24\t2.7e-07\t0.0025\nchr1\tbad\t1\tchr1\t2\t3\t1\tNA\tNA\n")
    assert values(readers.read_bedpe(spark, str(tmp_path / "l.tsv")), "start1", "score", "pvalue", "fdr") == [(2255000, 24.0, 2.7e-07, 0.0025)]
    with pytest.raises(contracts.ContractError):
        readers.read_bedpe(spark, str(tmp_path / "l.tsv"), strict=True)
    (tmp_path / "p.pairs").write_text("## pairs\n#columns: readID chrom1 pos1 chrom2 pos2 strand1 strand2 pair_type rfrag1 rfrag2\nr1\tchr1\t100\tchr1\t500\t+\t-\tUU\t1\t2\n")
    assert values(readers.read_pairs(spark, str(tmp_path / "p.pairs")), "readID", "pos2", "rfrag2") == [("r1", 500, 2)]
    (tmp_path / "s.txt").write_text("total\t200\nname\tx\ntotal\t90\n")
    assert readers.read_key_values(spark, str(tmp_path / "s.txt")) == {"total": 90.0}
    (tmp_path / "f.json").write_text(json.dumps({"summary": {"before_filtering": {"total_reads": 2000}, "after_filtering": {"total_reads": 1800}}}))
    assert readers.read_trim_report(spark, str(tmp_path / "f.json")) == (1000, 900)
    (tmp_path / "g.gtf").write_text('#x\nchr1\ts\tgene\t11\t20\t.\t-\t.\tgene_id "i"; gene_name "N";\nchr1\ts\texon\t1\t2\t.\t+\t.\t\n')
    assert values(readers.read_tss(spark, str(tmp_path / "g.gtf")), "chrom", "pos", "name") == [("chr1", 19, "N")]
    df = table(spark, [("chr1", 5), ("chr1", 1)], "chrom string, s long")
    for name in ("a.gz", "c.gz"):
        sinks.write_text(df, str(tmp_path / name), ["chrom", "s"])
    assert (tmp_path / "a.gz").read_bytes() == (tmp_path / "c.gz").read_bytes() and gzip.decompress((tmp_path / "a.gz").read_bytes()) == b"chrom\ts\nchr1\t1\nchr1\t5\n"
    sinks.write_json({"a": np.int64(3)}, str(tmp_path / "j.json"))
    assert json.loads((tmp_path / "j.json").read_text()) == {"a": 3}


def test_catalog():
    assert catalog.FLAGSHIP in catalog.QUERIES and set(catalog.ORACLES) <= set(catalog.QUERIES)


def test_report_rules(spark):
    row = lambda **x: spark.createDataFrame([x])
    design = spark.createDataFrame([("a", "p1", "case"), ("b", "p2", "case"), ("c", "p1", "control")], "sample string, subject_id string, arm string")
    assert [r.sample for r in reporting.select_samples(design, {"arm": "case"}, ["p1"]).collect()] == ["a"]
    with pytest.raises(contracts.ContractError):
        reporting.select_samples(design, {"tissue": "x"})
    gate = row(a="3", b="x", c="nan").select(*(reporting.fails(F.col(c), least=5).alias(c) for c in "abc")).first()
    assert tuple(gate) == (True, False, False)
    with pytest.raises(contracts.ContractError):
        reporting.fails(F.col("a"), least=1, most=2)
    arcs = spark.createDataFrame([("chr1", 0, 10, "chr1", 90, 100), ("chr1", 30, 40, "chr1", 90, 100), ("chr2", 30, 40, "chr2", 50, 60), ("chr1", 0, 10, "chr1", 10, 20)], "chrom1 string, start1 long, end1 long, chrom2 string, start2 long, end2 long")
    assert [r.start1 for r in reporting.view_arcs(arcs, "chr1", 20, 80).collect()] == [30]
    stripes = spark.createDataFrame([("a", 1500), ("a", 2500)], "sample string, length long")
    got = [tuple(r) for r in reporting.stripe_summary(design.select("sample", F.col("arm").alias("mark")), stripes, 5000).select("sample", "n_stripes", "median_length_kb", "max_length_kb").collect()]
    assert got == [("a", 2, 2.0, 2.5), ("b", 0, 0.0, 0.0), ("c", 0, 0.0, 0.0)]
    with pytest.raises(contracts.ContractError):
        reporting.stripe_summary(design, spark.createDataFrame([("a", 0)], "sample string, length long"), 5000)


def test_assembled_tables(spark):
    long = spark.createDataFrame([("k", "x", 1), ("k", "y", 2)], "key string, sample string, score long")
    assert tuple(reporting.aligned(long, ["key"], ["x", "y"]).first()) == ("k", 1, 2)
    with pytest.raises(contracts.ContractError):
        reporting.aligned(long, ["key"], ["x", "y", "z"])
    with pytest.raises(contracts.ContractError):
        reporting.aligned(long.union(long), ["key"], ["x", "y"])
    ids = long.select("sample")
    assert reporting.library_table(ids, long.select("sample", "score")).count() == 2
    with pytest.raises(contracts.ContractError):
        reporting.library_table(ids, long.where("sample = 'x'").select("sample", "score"))
    track = spark.createDataFrame([("c", 0, 5, "1"), ("c", 5, 5, "1"), ("c", 5, 9, "inf"), ("c", 5, 9, "x"), ("c", 5, 9, None)], "chrom string, s long, e long, value string")
    assert reporting.clean_track(track).count() == 1
    one = long.agg(reporting.single_value(F.lit("w")).alias("w"), *reporting.availability(F.lit(float("nan")), "none")).first()
    assert tuple(one) == ("w", False, "none")
    with pytest.raises(Exception, match="several values"):
        long.agg(reporting.single_value(F.col("sample"))).collect()
    paths = spark.createDataFrame([("r/s1/s1.bed",), ("s2.txt",)], "p string").select(fn.path_sample(F.col("p"), ".bed").alias("x")).select("x.*").collect()
    assert [tuple(p) for p in paths] == [("s1", "s1"), (None, None)]


def test_every_sample_is_balanced(spark):
    import numpy as np

    from helixmill.plans import tracks

    d = "/root/testdata/sf0.01"
    got = tracks.mdl05_balanced_weights(spark, d).collect()
    assert {r["sample"] for r in got} == {"s0", "s1", "s2", "s3"}
    px = tracks._pixels(spark, d).collect()
    for s in ("s0", "s1", "s2", "s3"):
        w = {r["bin_id"]: r["weight"] for r in got if r["sample"] == s}
        total = dict.fromkeys(w, 0.0)
        for r in px:
            if r["sample"] == s and r["bin2"] - r["bin1"] >= 2 and r["bin1"] in w and r["bin2"] in w:
                for b in (r["bin1"], r["bin2"]):
                    total[b] += r["count"] * w[r["bin1"]] * w[r["bin2"]]
        assert {(r["status"], r["variance"] < 1e-5) for r in got if r["sample"] == s} == {("PASS", True)}
        assert np.var(list(total.values())) < 1e-5 and abs(np.mean(list(total.values())) - 1) < 1e-6


def test_library_without_the_training_data_subpackage(tmp_path):
    import pathlib
    import shutil
    import subprocess
    import sys

    root = pathlib.Path(__file__).resolve().parents[1]
    shutil.copytree(root / "helixmill", tmp_path / "helixmill", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 100 and set(e.oracle_sql()) <= set(q) and not any(k.startswith('op') or k == 'pipeline' for k in q)"
    for leftover in (False, True):  # the pipeline's file may be left behind
        if leftover:
            (tmp_path / "corpus_pipeline.py").write_text("from helixmill.llm.common import Scratch")
        done = subprocess.run([sys.executable, "-W", "ignore", "-c", code], cwd=tmp_path, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(tmp_path)}, capture_output=True, text=True)
        assert done.returncode == 0, done.stderr


def test_files_and_gates(spark, tmp_path):
    (tmp_path / "empty").touch()
    (tmp_path / "whole").write_text("a\nb\n")
    (tmp_path / "packed").write_bytes(gzip.compress(b"c\n"))
    paths = [str(tmp_path / n) for n in ("whole", "empty", "none", "packed")]
    assert readers.missing_files(spark, [*paths, str(tmp_path)]) == [*paths[1:3], str(tmp_path)]
    readers.require_files(spark, paths[:1])
    with pytest.raises(contracts.ContractError, match="none"):
        readers.require_files(spark, paths)
    assert values(readers.read_lines(spark, str(tmp_path)), "value") == [("a",), ("b",), ("c",)]
    assert reporting.gate_values({"valid_pair_yield_pct": 1, "duplicate_pct_max": 2, "cis_fraction_min": 0.5, "x": 0}) == {"yield_pct": 1.0, "dup_pct": 2.0, "cis_pct": 50.0}
    with pytest.raises(contracts.ContractError, match="cis_fraction_min"):
        reporting.gate_values({"valid_pair_yield_pct": 1, "duplicate_pct_max": 2})
    with pytest.raises(contracts.ContractError, match="report_role"):
        reporting.primary_libraries(table(spark, [(1,)], "a int"))
    odd = table(spark, [(1, bytearray(b"a\xff\"}"), float("inf"), None)], "k int, raw binary, x double, none int")
    assert values(reporting.json_scalars(odd, "k", ["raw", "x", "none"]), "attribute", "json") == [("none", "null"), ("raw", '"a\ufffd\\"}"'), ("x", '"Infinity"')]


def test_rolls_are_md5s_first_bits():
    keys, first, last = [b"s0|s1|chr1|0|3", b"s0|s1|chr11|10|13", b"x" * 70, b"", b"s0|s1|chr1|0|4"], [1, 95, 999_990, 1, 5], [2000, 1100, 1_000_030, 12, 4]
    limit = np.array([1 << 31, 3_000_000_000, (1 << 32) - 1, 1 << 30, 1 << 31])
    want = [sum(int(hashlib.md5(k + f"|{i}".encode()).hexdigest()[:8], 16) < m for i in range(a, b + 1)) for k, a, b, m in zip(keys, first, last, limit.tolist(), strict=True)]
    assert rolls.count_below(keys, first, last, limit).tolist() == want


def test_deep_pixels_are_thinned_once_and_by_many_tasks(spark):
    rows = [("p", 1, 100_000, 1 << 30), ("p", 2, 7, 1 << 32), ("q", 3, 0, 5), ("q", 4, 3, 0)]
    px = spark.createDataFrame(rows, "name string, x int, v long, keep long")
    got = {r["x"]: r["v"] for r in matrix.thinned(px, F.concat_ws("|", "name", "x")).collect()}
    want = sum(hashlib.md5(f"p|1|{i}".encode()).digest()[:4] < bytes([64, 0, 0, 0]) for i in range(1, 100_001))
    assert got == {1: want, 2: 7}


def test_replicates_report_of_deep_contacts(spark):
    """Six pixels of 400,000 contacts each against a shallow sample: work for all tasks, hashed once."""
    cells = [("chr1", 25_000 * k, 25_000 * (k + 2)) for k in range(6)]
    contacts = spark.createDataFrame([(s, *c, n + k) for s, n in (("a", 400_000), ("b", 1_000)) for k, c in enumerate(cells)], "sample string, chrom string, start1 long, start2 long, score long")
    pairs, sizes = spark.createDataFrame([("a", "b")], "a string, b string"), spark.createDataFrame([("chr1", 352_000)], "chrom string, size long")
    scc = matrix.concordance(contacts, pairs, sizes, 25_000, 1, 5_000_000)
    plan = scc._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1
    report = {r["sample"]: r for r in matrix.replicate_report(scc, contacts.groupBy("sample").agg(F.sum("score").alias("contacts")), 0.3, 1000).collect()}
    assert report["a"]["contacts"] == 2_400_015 and report["a"]["n_pairs"] == report["b"]["n_pairs"] == 1


def test_runs_of_rolls_are_md5s_first_bits():
    """Runs that share all but their last digits: keys of all places in a word, digits over the end of a block, ends of runs."""
    for n in (0, 16, 17, 18, 19, 45, 46, 47, 48, 49, 50, 51, 60, 110):
        for first, last in ((3, 9_999), (9_990, 14_400), (20_000, 24_999), (95_000, 104_999)):
            key, limit = b"k" * n, 3_000_000_000
            want = sum(int.from_bytes(hashlib.md5(key + b"|%d" % i).digest()[:4]) < limit for i in range(first, last + 1))
            assert rolls.count_below([key], [first], [last], np.array([limit])).tolist() == [want]
    assert rolls.run_below(b"s0|s1|chr1|0|3", 1_075_000, 1_099_999, 1 << 31) == sum(hashlib.md5(b"s0|s1|chr1|0|3|%d" % i).digest()[0] < 128 for i in range(1_075_000, 1_100_000))


def test_replicates_report_reads_contacts_once(spark, tmp_path):
    """What the report needs of the contacts is written once: four readers of it, none of the table."""
    rows = [(k, k * 7, k * 3, k % 7 + 1, 20.0 + k % 9) for k in range(20_000)]
    spark.createDataFrame(rows, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double").coalesce(1).write.parquet(f"{tmp_path}/lineitem.parquet")
    report = catalog.QUERIES["pip10_replicate_report"](spark, str(tmp_path))
    assert "FileScan" not in report._jdf.queryExecution().executedPlan().toString()
    want = spark.read.parquet(f"{tmp_path}/lineitem.parquet").where("(l_suppkey + l_partkey) % 25 < 22").groupBy(F.concat(F.lit("s"), F.col("l_linenumber") % 4).alias("s")).agg(F.sum("l_quantity").cast("long"))
    assert {r["sample"]: r["contacts"] for r in report.collect()} == dict(map(tuple, want.collect()))


def test_report_payload_by_records(spark, tmp_path):
    """One record a line; the reader's schema has no field for each key, and what is no record isn't passed over."""
    rows = [(k, k / 3, f'a "b"\n{k}' if k % 5 else None) for k in range(3000)]
    sinks.write_payload(spark.createDataFrame(rows, "sample long, y double, s string"), "qc", "sample", path := str(tmp_path / "p.json"))
    assert json.load(open(path)) == {"id": "qc", "plot_type": "table", "data": {str(k): {"y": y, "s": s} for k, y, s in rows}}
    got = readers.read_payload(spark, path, "sample", "y: double, s: string")
    assert got.columns == ["sample", "y", "s"] and sorted((int(r[0]), r[1], r[2]) for r in got.collect()) == rows
    with open(path, "a") as f:
        f.write("    half a record\n")
    with pytest.raises(Exception, match="no record of a payload"):
        readers.read_payload(spark, path, "sample", "y: double, s: string").collect()
