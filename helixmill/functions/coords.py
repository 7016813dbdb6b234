"""Column functions on coordinates, keys and parsed values. Intervals are 0-based and half-open."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Chromosomes of the primary set.
PRIMARY = r"^chr(?:[1-9]|1[0-9]|2[0-2]|X)$"
VIEW = r"^chr([0-9]+|X)$"


def primary(*chroms: Column) -> Column:
    out = F.lit(True)
    for c in chroms:
        out = out & c.rlike(PRIMARY)
    return out


def snap_start(pos: Column, width: int) -> Column:
    return (F.floor(pos / width) * width).cast("long")


def snap_mid(start: Column, end: Column, width: int) -> Column:
    return snap_start(F.floor((start + end) / 2), width)


def overlaps(s1: Column, e1: Column, s2: Column, e2: Column) -> Column:
    """Touching intervals don't overlap."""
    return (s1 < e2) & (e1 > s2)


def loop_key(*coords: Column) -> Column:
    return F.sha1(F.concat_ws("\x1f", *(c.cast("string") for c in coords)).cast("binary"))


def group_key(mark: Column, **cols: Column) -> Column:
    """Sanitised mark and a short digest of the grouping columns' values."""
    text = F.concat_ws("|", *(F.concat(F.lit(f"{k}="), F.coalesce(c.cast("string"), F.lit(""))) for k, c in cols.items()))
    return F.concat_ws("_", F.regexp_replace(mark, r"[^A-Za-z0-9]+", "_"), F.substring(F.sha2(text.cast("binary"), 256), 1, 12))


def natural_rank(chrom: Column) -> Column:
    """Numbers first, then X, Y, M; others behind all."""
    name = F.upper(F.regexp_replace(chrom, "(?i)^chr", ""))
    return F.coalesce(F.when(name.rlike("^[0-9]{1,6}$"), F.try_to_number(name, F.lit("999999")).cast("int")), F.when(name == "X", 23), F.when(name == "Y", 24), F.when(name.isin("M", "MT"), 25), F.lit(1_000_000))


def strict_int(text: Column) -> Column:
    """The integer a text stands for, whole floats too; null for anything else."""
    d = text.try_cast("double")
    return F.when(d.isNotNull() & ~F.isnan(d) & (F.abs(d) < 9e15) & (d == F.floor(d)), d.cast("long"))


def probability(text: Column) -> Column:
    """(value or null, is valid): NA and NaN are valid and missing, else a finite number in [0, 1]."""
    d = F.trim(text).try_cast("double")
    na = F.lower(F.trim(text)).isin("na", "nan")
    ok = d.isNotNull() & ~F.isnan(d) & d.between(0, 1)
    return F.struct(F.when(ok & ~na, d).alias("value"), F.coalesce(na | ok, F.lit(False)).alias("valid"))


def within_q(q: Column, threshold: float) -> Column:
    return q <= threshold + max(1e-12, abs(threshold) * 1e-9)


def percent(part: Column, whole: Column) -> Column:
    """Zero where there is nothing to divide by."""
    return F.when(whole == 0, F.lit(0.0)).otherwise(100.0 * part / whole)


def ratio_or_null(part: Column, whole: Column) -> Column:
    return F.when(whole != 0, part / whole)


def paired_log2(case: Column, control: Column) -> Column:
    return F.log2((case + 1) / (control + 1))


def fragment_class(rfrag1: Column, rfrag2: Column, strand1: Column, strand2: Column, pos1: Column, pos2: Column) -> Column:
    """How the ends of a pair lie to restriction fragments; the first case that holds counts."""
    first = F.when(pos1 <= pos2, strand1).otherwise(strand2)
    second = F.when(pos1 <= pos2, strand2).otherwise(strand1)
    return (
        F.when((rfrag1 < 0) | (rfrag2 < 0), "unassigned")
        .when(rfrag1 != rfrag2, "regular")
        .when((first == "+") & (second == "-"), "dangling_end")
        .when((first == "-") & (second == "+"), "self_circle")
        .otherwise("same_strand")
    )


def valid_ligation(chrom1: Column, chrom2: Column, rfrag1: Column, rfrag2: Column) -> Column:
    return (rfrag1 >= 0) & (rfrag2 >= 0) & ((chrom1 != chrom2) | (F.abs(rfrag1 - rfrag2) > 1))


def significant(padj: Column, lfc: Column, fdr: float = 0.05, least: float = 1.0) -> Column:
    return F.coalesce((padj < fdr) & (F.abs(lfc) >= least), F.lit(False))


def pair_seed(first: Column, second: Column, *params: Column) -> Column:
    """A 32-bit seed that doesn't depend on the order of the two names."""
    text = F.concat_ws("|", F.least(first, second), F.greatest(first, second), *params)
    return F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 8), 16, 10).cast("long")


def json_map(keys_values: Column) -> Column:
    """Sorted, compact JSON of an array of (key, value) structs."""
    return F.to_json(F.map_from_entries(F.array_sort(keys_values)))


def float_or(text: Column, default: float) -> Column:
    d = text.try_cast("double")
    return F.when(d.isNotNull() & ~F.isnan(d), d).otherwise(F.lit(default))


def short_label(text: Column, longest: int = 24) -> Column:
    plain = F.regexp_replace(text, "_", " ")
    return F.when(F.length(plain) > longest, F.concat(F.substring(plain, 1, longest - 1), F.lit("…"))).otherwise(plain)


def sample_label(text: Column) -> Column:
    """A sample's name for axes: marks without their histone, replicates as r1, blanks for underscores."""
    plain = F.regexp_replace(text, "H3(K27ac|K4me3|K4me1|K27me3)", "$1")
    return F.regexp_replace(F.regexp_replace(plain, "_rep", " r"), "_", " ")


def interval(estimate: Column, error: Column) -> Column:
    """Wald interval of 95%."""
    return F.struct((estimate - 1.96 * error).alias("low"), (estimate + 1.96 * error).alias("high"))


def evidence(padj: Column) -> Column:
    """-log10 of an adjusted p-value; zero counts as the smallest positive double."""
    return -F.log10(F.greatest(padj, F.lit(5e-324)))


def path_sample(path: Column, suffix: str) -> Column:
    """(sample by the file's name, by its folder): the name without the suffix, null if it hasn't that suffix."""
    name = F.element_at(F.split(path, "/"), -1)
    folder = F.try_element_at(F.split(path, "/"), F.lit(-2))
    return F.struct(F.when(name.endswith(suffix), F.substring(name, F.lit(1), F.length(name) - len(suffix))).alias("by_name"), folder.alias("by_folder"))


# Statuses of several values; never plain booleans.


def balance_status(present: Column, converged: Column) -> Column:
    return F.when(~present | converged.isNull(), "NOT_ASSESSED").when(converged, "PASS").otherwise("WARN")


def worst_balance(status: Column) -> Column:
    """Aggregate of resolutions."""
    return F.when(F.bool_or(status == "NOT_ASSESSED"), "NOT_ASSESSED").when(F.bool_or(status == "WARN"), "WARN").otherwise("PASS")


def pass_or_null(status: Column) -> Column:
    return F.when(status == "PASS", F.lit(True))


def replicate_status(value: Column, threshold: float) -> Column:
    """Aggregate of replicate scores; null ones don't count."""
    n, ok = F.count(value), F.count_if(value >= threshold)
    return F.when(n == 0, "NOT_ASSESSED").when(ok == n, "PASS").when(ok == 0, "FAIL").otherwise("DISCORDANT")


def status_gate(status: Column) -> Column:
    """True, false or null for undecided; unknown statuses are errors."""
    return F.when(status == "PASS", F.lit(True)).when(status == "FAIL", F.lit(False)).when(
        status.isin("DISCORDANT", "NOT_ASSESSED", "WARN", "DESCRIPTIVE"), F.lit(None).cast("boolean")
    ).otherwise(F.raise_error(F.concat(F.lit("unknown status "), F.coalesce(status, F.lit("null")))).cast("boolean"))


def overall_status(yield_pct: Column, dup_pct: Column, cis_fraction: Column, hard: list[Column], soft: list[Column], min_yield: float = 25.0, max_dup: float = 50.0, min_cis: float = 0.7) -> Column:
    every = [*hard, *soft]
    passed = (yield_pct >= min_yield) & (dup_pct <= max_dup) & (cis_fraction >= min_cis)
    for h in hard:
        passed = passed & (h != "FAIL")
    some = lambda *names: F.greatest(*(s.isin(*names).cast("int") for s in every), F.lit(0)) == 1
    return F.when(~F.coalesce(passed, F.lit(False)), "FAIL").when(some("DISCORDANT", "WARN"), "PASS_WITH_UNCERTAINTY").when(some("NOT_ASSESSED"), "PASS_WITH_NOT_ASSESSED").otherwise("PASS")


def design_status(pairs: Column, publication_min: int = 3) -> Column:
    return F.when(pairs < 2, "TOO_FEW_PAIRS").when(pairs < publication_min, "PILOT_UNDERPOWERED").otherwise("STANDARD_INFERENCE")
