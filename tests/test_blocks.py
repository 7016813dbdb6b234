"""Ordered computations over many blocks, against brute force."""

import random

import numpy as np
import pytest

from helixmill.operators import differential, graph, intervals


@pytest.fixture(scope="module")
def peaks():
    """Intervals of two chromosomes and none, ties and empty ones among them, some over many blocks."""
    rng = random.Random(9)
    rows = []
    for _ in range(250):
        s = rng.randrange(400)
        rows.append((rng.choice("ab"), rng.choice(["chr1", "chr2", None]), s, s + rng.choice([1, 2, 3, 5, 8, 60])))
    return [*rows, ("a", "chr1", 900, 905), ("a", "chr1", 900, 905), ("b", "chr3", 7, 7), ("b", "chr3", 7, 7)]


SCHEMA = "sample string, chrom string, s long, e long"


def groups(rows, *at):
    out = {}
    for r in rows:
        out.setdefault(tuple(r[i] for i in at), []).append(r)
    return out


def merged(rows):
    out = []
    for (sample, chrom), own in groups(rows, 0, 1).items():
        reach = None
        for _, _, s, e in sorted(own, key=lambda r: r[2:]):
            if reach is None or s >= reach:
                out.append([sample, chrom, s, e])
                reach = e
            out[-1][3] = reach = max(reach, e)
    return [tuple(r) for r in out]


def steps(rows):
    """(chrom, s, e, depth) between neighbouring ends."""
    out = []
    for (chrom,), own in groups(rows, 1).items():
        places = sorted({p for r in own for p in r[2:]})
        out += [(chrom, a, b, sum(r[2] <= a and b <= r[3] for r in own)) for a, b in zip(places, places[1:], strict=False)]
    return out


def listed(rows):
    return sorted(rows, key=str)


@pytest.mark.parametrize("bucket", [3, 50, 10_000])
def test_sorted_intervals(spark, peaks, bucket):
    df = spark.createDataFrame(peaks, SCHEMA).repartition(5)
    assert listed(tuple(r) for r in intervals.merge_intervals(df, ["sample", "chrom"], bucket).select("sample", "chrom", "s", "e").collect()) == listed(merged(peaks))
    assert listed(tuple(r) for r in intervals.coverage_steps(df, bucket).collect()) == listed(r for r in steps(peaks) if r[3] > 0)
    assert listed(tuple(r) for r in intervals.supported_segments(df, 2, bucket).collect()) == listed(r for r in steps(merged(peaks)) if r[3] >= 2)
    single = listed({(c, s, e) for _, c, s, e in peaks})
    one = spark.createDataFrame(single, "chrom string, s long, e long")
    reach = [(c, s, e, max(x for d, b, x in single if d == c and (b, x) <= (s, e))) for c, s, e in single]
    assert listed(tuple(r) for r in intervals.running_reach(one, bucket).collect()) == listed(reach)
    after = [(c, s, e, min((b, x) for d, b, x in single if d == c and (b, x) > (s, e))[0]) for c, s, e in single if any(d == c and (b, x) > (s, e) for d, b, x in single)]
    assert listed(tuple(r) for r in intervals.not_disjoint(one, ["chrom"], bucket).collect()) == listed(r for r in after if r[3] < r[2])
    feats = [("chr1", p, f"g{p}") for p in (5, 90, 91, 333)] + [("chr2", 399, "z")]
    near = intervals.nearest(one.where("chrom is not null"), spark.createDataFrame(feats, "chrom string, pos long, name string"), ["chrom", "s", "e"], bucket)

    def distance(c, s, e):
        return min((s - p if p < s else p - e + 1 if p >= e else 0 for d, p, _ in feats if d == c), default=None)

    assert listed((r["chrom"], r["s"], r["e"], r["distance"]) for r in near.collect()) == listed((c, s, e, distance(c, s, e)) for c, s, e in single if c)


def test_neighbours_and_nodes(spark):
    bins = [(c, s) for c in ("chr1", "chr10", "chr2") for s in range(0, 45_000_000, 1_500_000)]
    nodes = graph.node_index(spark.createDataFrame(bins, "chrom string, s long").repartition(3)).select("chrom", "s", "node")
    assert sorted(tuple(r) for r in nodes.collect()) == [(c, s, i) for i, (c, s) in enumerate(sorted(bins))]
    wide = nodes.withColumn("node", nodes["node"] * 7_000)  # many blocks
    got = {(r["src"] // 7_000, r["dst"] // 7_000) for r in graph.neighbour_edges(wide).collect()}
    ahead = {(i, i + 1) for i in range(len(bins) - 1) if (i + 1) % 30}
    assert got == ahead | {(b, a) for a, b in ahead}


def test_adjusted_p_values(spark):
    rng = np.random.default_rng(4)
    p = np.concatenate([rng.random(400), rng.random(100) * 1e-3, 10.0 ** -rng.integers(3, 300, 60), [0.0, 0.0, 1.0, 1.0, 1.0, 0.25, 0.25]])
    rows = [(g, int(i), float(x)) for g in ("a", "b") for i, x in enumerate(p if g == "a" else p[::7])]
    df = spark.createDataFrame([*rows, ("a", -1, None), ("b", -2, float("nan")), (None, -3, 0.5)], "g string, i long, pvalue double").repartition(6)
    got = {(r["g"], r["i"]): r["padj"] for r in differential.benjamini_hochberg(df, ["g"]).collect()}
    assert got["a", -1] is None and got["b", -2] is None and got[None, -3] == 0.5 and len(got) == len(rows) + 3
    for g in ("a", "b"):
        own = sorted((x, i) for h, i, x in rows if h == g)
        least = 1.0
        for k in range(len(own), 0, -1):
            x, i = own[k - 1]
            least = min(least, x * len(own) / k)
            assert got[g, i] == pytest.approx(least, rel=1e-12, abs=0)
