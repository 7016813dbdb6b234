"""Selections, gates and per-sample tables for reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .contracts import ContractError, assert_empty, one_to_one, require_columns

#: Flags that each kind of interaction asks of its two anchors.
INTERACTIONS = ("Peak-to-Peak", "Peak-to-NonPeak", "Peak-to-ALL", "ALL-to-ALL")


def finite(value: Column) -> Column:
    return value.isNotNull() & ~F.isnan(value) & (F.abs(value) < float("inf"))


def clean_track(rows: DataFrame, value: str = "value") -> DataFrame:
    """Rows of a track (chrom, s, e, value as text) whose value is a finite number and whose interval isn't empty."""
    d = F.col(value).try_cast("double")
    return rows.where(F.coalesce(finite(d), F.lit(False)) & (F.col("e") > F.col("s"))).withColumn(value, d)


def select_samples(samples: DataFrame, equal: dict[str, str], subjects: list[str] | None = None) -> DataFrame:
    """Samples whose columns have the given values; with subjects, theirs only. An unknown column is an error."""
    if unknown := set(equal) - set(samples.columns):
        raise ContractError(f"unknown columns: {sorted(unknown)}")
    kept = reduce(lambda df, kv: df.where(F.col(kv[0]) == kv[1]), equal.items(), samples)
    return kept if subjects is None else kept.where(F.col("subject_id").isin(subjects))


def view_arcs(loops: DataFrame, chrom: str, start: int, end: int) -> DataFrame:
    """Loops that reach into the view, without arcs that only span it."""
    left, right = F.least("start1", "start2"), F.greatest("end1", "end2")
    return loops.where((F.col("chrom1") == chrom) & (F.col("chrom2") == chrom) & (left < end) & (right > start) & ~((left < start) & (right > end)))


def fails(value: Column, least: float | None = None, most: float | None = None) -> Column:
    """Whether an assessed value misses its gate; what isn't a number misses none."""
    if (least is None) == (most is None):
        raise ContractError("a gate has either a least or a greatest value")
    d = value.try_cast("double")
    return F.coalesce(d.isNotNull() & ~F.isnan(d) & ((d < least) if most is None else (d > most)), F.lit(False))


def gate_values(thresholds: dict[str, float]) -> dict[str, float]:
    """The configured gates by the column that they are on; all three must be there, and the cis fraction becomes a percentage."""
    need = {"valid_pair_yield_pct", "duplicate_pct_max", "cis_fraction_min"}
    if missing := sorted(need - set(thresholds)):
        raise ContractError(f"gates without a value: {missing}")
    return {"yield_pct": float(thresholds["valid_pair_yield_pct"]), "dup_pct": float(thresholds["duplicate_pct_max"]), "cis_pct": 100.0 * float(thresholds["cis_fraction_min"])}


def primary_libraries(libraries: DataFrame) -> DataFrame:
    """Libraries of headline reports; a table without roles is an error."""
    return require_columns(libraries, ["report_role"]).where("report_role = 'primary'")


def json_scalars(rows: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """(key, attribute, json): attributes of any type as JSON text; bytes are read as UTF-8, what isn't is replaced."""
    kinds = dict(rows.dtypes)
    read = lambda c: F.make_valid_utf8(F.col(c).cast("string")) if kinds[c] == "binary" else F.col(c)
    told = lambda c: F.regexp_extract(F.to_json(F.struct(read(c).alias("v")), {"ignoreNullFields": "false"}), r'(?s)^\{"v":(.*)\}$', 1)
    long = rows.select(key, F.explode(F.array(*(F.struct(F.lit(c).alias("attribute"), told(c).alias("json")) for c in columns))).alias("x"))
    return long.select(key, "x.*")


def peak_flags(kind: str, first: Column, second: Column) -> dict[str, Column]:
    """Rules on the two anchors' peak flags for a kind of interaction."""
    if kind not in INTERACTIONS:
        raise ContractError(f"unknown kind of interaction: {kind}")
    fits = {"Peak-to-Peak": (first == 1) & (second == 1), "Peak-to-NonPeak": first != second, "Peak-to-ALL": (first == 1) | (second == 1), "ALL-to-ALL": F.lit(True)}
    return {"flags": first.isin(0, 1) & second.isin(0, 1), "kind": fits[kind]}


def library_table(samples: DataFrame, *reports: DataFrame) -> DataFrame:
    """One row per sample with the columns of all reports; every report must have every sample once."""
    for report in reports:
        assert_empty(samples.join(report, "sample", "left_anti"), "a report lacks samples")
        samples = one_to_one(samples, report, ["sample"])
    return samples


def aligned(long: DataFrame, key: list[str], samples: list[str], value: str = "score") -> DataFrame:
    """A column per sample; every key must have every sample once."""
    wide = long.groupBy(*key).pivot("sample", samples).agg(F.sum(value).alias("value"), F.count(F.lit(1)).alias("rows"))
    full = reduce(lambda a, b: a & b, (F.coalesce(F.col(f"`{s}_rows`"), F.lit(0)) == 1 for s in samples))
    assert_empty(wide.where(~full).select(*key), "a key lacks or repeats a sample")
    return wide.select(*key, *(F.col(f"`{s}_value`").alias(s) for s in samples))


def stripe_summary(samples: DataFrame, stripes: DataFrame, resolution: int) -> DataFrame:
    """samples (sample, mark) with number, median and greatest length of their stripes in kb; zeros without any."""
    assert_empty(stripes.where(~F.coalesce(finite(F.col("length").cast("double")) & (F.col("length") > 0), F.lit(False))), "a stripe's length must be positive")
    kb = lambda c: F.round(c / 1000, 1)
    n = stripes.groupBy("sample").agg(F.count("*").alias("n_stripes"), kb(F.median("length")).alias("median_length_kb"), kb(F.max("length")).alias("max_length_kb"))
    out = samples.join(n, "sample", "left").withColumn("resolution", F.lit(resolution))
    return out.fillna(0, ["n_stripes"]).fillna(0.0, ["median_length_kb", "max_length_kb"]).orderBy("mark", "sample")


def peak_settings(mark: Column, marks: dict[str, dict]) -> Column:
    """Mode, q and broad cutoff of a mark's peaks; defaults where the configuration says nothing."""
    pick = lambda name, default: F.coalesce(*(F.when(mark == m, F.lit(v[name])) for m, v in marks.items() if name in v), F.lit(default))
    return F.struct(pick("mode", "narrow").alias("mode"), pick("q", 0.01).alias("q"), pick("broad_cutoff", 0.1).alias("broad_cutoff"))


def single_value(column: Column) -> Column:
    """Aggregate: the one value that a column has, null without any; two are an error."""
    return F.when(F.count_distinct(column) <= 1, F.max(column)).otherwise(F.raise_error(F.lit("an annotation has several values")).cast("string"))


def availability(value: Column, reason: str) -> list[Column]:
    """Aggregates: whether a feature has a finite value, and else the reason."""
    some = F.coalesce(F.bool_or(finite(value)), F.lit(False))
    return [some.alias("available"), F.when(~some, F.lit(reason)).alias("reason")]


def footprints(loops: DataFrame, sizes: DataFrame, width: int, tolerance: int) -> DataFrame:
    """Loops with their anchors widened by tolerance bins, within the chromosome. sizes: a row per chromosome."""
    by = tolerance * width
    ends = {f"{side}{i}": expr for i in (1, 2) for side, expr in (("from", F.greatest(F.col(f"start{i}") - by, F.lit(0))), ("to", F.least(F.col(f"end{i}") + by, F.col("size"))))}
    return loops.join(F.broadcast(sizes.select(F.col("chrom").alias("chrom1"), "size")), "chrom1").withColumns(ends).drop("size")
