"""Readers. Texts are read as strings and converted with checks; null stands for missing."""

from __future__ import annotations

import gzip
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.coords import PRIMARY, VIEW, strict_int
from ..operators.contracts import ContractError, assert_empty, require_columns

#: Names under which paired-interval columns come.
ALIASES = {
    "chrom1": ["chrom1", "chr1", "bin1_chr"], "start1": ["start1", "s1", "bin1_start"], "end1": ["end1", "e1", "bin1_end"],
    "chrom2": ["chrom2", "chr2", "bin2_chromosome"], "start2": ["start2", "s2", "bin2_start"], "end2": ["end2", "e2", "bin2_end"],
    "score": ["score", "cc", "count"], "pvalue": ["pvalue", "p-value_bias", "p"], "fdr": ["fdr", "q-value_bias", "q"],
}
COORDS = ["chrom1", "start1", "end1", "chrom2", "start2", "end2"]


def _files(spark: SparkSession, path: str):
    """A path of the session's file systems, and its own."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def _opens(spark: SparkSession, path: str, magic: bytes) -> bool:
    """Whether the file begins so."""
    p, files = _files(spark, path)
    f = files.open(p)
    try:
        return all(f.read() == b for b in magic)
    finally:
        f.close()


def missing_files(spark: SparkSession, paths: list[str]) -> list[str]:
    """Those of the files that aren't there or have no bytes."""
    def empty(path: str) -> bool:
        p, files = _files(spark, path)
        return not files.exists(p) or files.getFileStatus(p).isDirectory() or files.getFileStatus(p).getLen() == 0

    return [path for path in paths if empty(path)]


def require_files(spark: SparkSession, paths: list[str]) -> None:
    if missing := missing_files(spark, paths):
        raise ContractError(f"missing or empty files: {missing}")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(value): lines of text, unpacked where the first two bytes say gzip, whatever the name.

    Plain files stay splittable; only gzip files under another suffix are unpacked whole, one a task.
    """
    paths = [r["path"] for r in spark.read.format("binaryFile").load(path).select("path").collect()]  # contents aren't read
    odd = [p for p in paths if not p.endswith(".gz") and _opens(spark, p, b"\x1f\x8b")]
    plain = sorted(set(paths) - set(odd))
    parts = []
    if plain:
        parts.append(spark.read.text(plain))
    if odd:

        def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                for content in pdf["content"]:
                    yield pd.DataFrame({"value": gzip.decompress(content).decode().splitlines()})

        parts.append(spark.read.format("binaryFile").load(odd).select("content").mapInPandas(unpack, "value string"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def read_chromsizes(spark: SparkSession, path: str, strict: bool = False) -> DataFrame:
    """(chrom, size). Blank lines are passed over; strict passes over comments too, and raises for short lines and empty files."""
    lines = read_lines(spark, path).where(F.trim("value") != "")
    parts = F.split("value", r"\s+")
    if strict:
        lines = lines.where(~F.col("value").startswith("#"))
        assert_empty(lines.where(F.size(parts) < 2), "a line of chromosome sizes has fewer than two fields")
        if lines.isEmpty():
            raise ContractError("no chromosome sizes")
    return lines.select(parts[0].alias("chrom"), parts[1].cast("long").alias("size"))


def read_bed(spark: SparkSession, path: str, strict: bool = False) -> DataFrame:
    """(chrom, s, e) of the first three fields. Strict raises for short lines, negative starts and ends that aren't beyond the start."""
    lines = read_lines(spark, path).where((F.trim("value") != "") & ~F.col("value").rlike(r"^(#|track|browser)"))
    f = F.split("value", "\t")
    if strict:
        assert_empty(lines.where(F.size(f) < 3), "a BED line has fewer than three fields")
    rows = lines.where(F.size(f) >= 3).select(f[0].alias("chrom"), strict_int(f[1]).alias("s"), strict_int(f[2]).alias("e"))
    if strict:
        assert_empty(rows.where("s is null or e is null or s < 0 or e <= s"), "a BED interval is malformed")
    return rows.where("s is not null and e is not null")


def _headed(spark: SparkSession, path: str) -> DataFrame | None:
    lines = read_lines(spark, path)
    if lines.isEmpty():
        return None
    first = lines.first()["value"].split("\t")
    names = [c.strip().lstrip("#") for c in first]
    wide = any(n.lower() in ALIASES["chrom1"] for n in names) and not any(n.isdigit() for n in names)  # a chromosome may be named like a column
    if not wide and len(names) < 6:
        raise ContractError(f"not a paired-interval table: {names}")
    columns = names if wide else [*COORDS, *(f"field{i}" for i in range(7, len(names) + 1))]
    body = lines.where(F.col("value") != "\t".join(first)) if wide else lines
    f = F.split("value", "\t")
    return body.where(F.trim("value") != "").select(*(F.get(f, i).alias(c) for i, c in enumerate(columns)))


def read_bedpe(spark: SparkSession, path: str, strict: bool = False) -> DataFrame:
    """Coordinates, score, pvalue, fdr under their usual names; the first alias wins, whatever the case.

    Rows with bad coordinates are dropped, or raise if strict. An empty file gives no rows.
    """
    schema = "chrom1 string, start1 long, end1 long, chrom2 string, start2 long, end2 long, score double, pvalue double, fdr double"
    raw = _headed(spark, path)
    if raw is None:
        return spark.createDataFrame([], schema)
    low = {c.lower(): c for c in reversed(raw.columns)}
    pick = {k: next((low[a] for a in names if a in low), None) for k, names in ALIASES.items()}
    if missing := [k for k in COORDS if pick[k] is None]:
        raise ContractError(f"missing columns: {missing}")
    cols = []
    for k, c in pick.items():
        x = F.col(f"`{c}`") if c else F.lit(None).cast("string")
        d = x.try_cast("double")
        cols.append((x if k.startswith("chrom") else strict_int(x) if k in COORDS else F.when(~F.isnan(d), d)).alias(k))
    rows = raw.select(*cols)
    bad = " or ".join(f"{c} is null" for c in COORDS)
    if strict:
        assert_empty(rows.where(bad), "a paired interval has bad coordinates")
    return rows.where(f"not ({bad})")


def read_calls(spark: SparkSession, path: str, required: list[str]) -> DataFrame:
    """A headed table of strings, only the required columns."""
    return require_columns(spark.read.csv(path, sep="\t", header=True, inferSchema=False), required).select(*(F.col(f"`{c}`") for c in required))


def read_pairs(spark: SparkSession, path: str) -> DataFrame:
    """A pairs file by the names its #columns line gives; positions and fragments are integers."""
    lines = read_lines(spark, path)
    head = lines.where(F.col("value").startswith("#columns:")).first()
    if head is None:
        raise ContractError("no #columns line")
    names = head["value"].split(":", 1)[1].split()
    f = F.split("value", "\t")
    number = ("pos1", "pos2", "rfrag1", "rfrag2", "mapq1", "mapq2")
    return lines.where(~F.col("value").startswith("#") & (F.trim("value") != "")).select(*((f[i].cast("long") if n in number else f[i]).alias(n) for i, n in enumerate(names)))


def read_key_values(spark: SparkSession, path: str) -> dict[str, float]:
    """Numbers of a key/value text; other values are passed over, the last of a key counts. Such reports are small."""
    rows = read_lines(spark, path).select(F.regexp_extract("value", r"^(\S+)\s+(\S+)", 1).alias("k"), F.regexp_extract("value", r"^(\S+)\s+(\S+)", 2).try_cast("double").alias("v"))
    return {r["k"]: r["v"] for r in rows.where("k <> '' and v is not null").collect()}


def read_one_row(spark: SparkSession, path: str) -> dict[str, float | str]:
    row = spark.read.csv(path, sep="\t", header=True, inferSchema=False).first()
    if row is None:
        raise ContractError("the table has no row")

    def value(x: str | None):
        try:
            return float(x)
        except (TypeError, ValueError):
            return x

    return {k: value(v) for k, v in row.asDict().items()}


def read_trim_report(spark: SparkSession, path: str) -> tuple[int, int]:
    """(raw, retained) pairs; read numbers must be even, and no more retained than raw."""
    s = spark.read.json(path, multiLine=True).select("summary.before_filtering.total_reads", "summary.after_filtering.total_reads").toDF("a", "b").first()
    if s["a"] % 2 or s["b"] % 2 or s["b"] > s["a"]:
        raise ContractError(f"read numbers aren't those of pairs: {s['a']}, {s['b']}")
    return s["a"] // 2, s["b"] // 2


def read_json(spark: SparkSession, path: str, required: list[str], schema: str | None = None) -> DataFrame:
    return require_columns(spark.read.json(path, multiLine=True, schema=schema), required)


def read_payload(spark: SparkSession, path: str, key: str, record: str) -> DataFrame:
    """(key string, columns of record) of a section that write_payload wrote: its lines are read by many tasks, never the document as one value."""
    one = F.regexp_extract("value", r"^ {4}(\".*\}),?$", 1)
    frame = F.col("value").isin("{", '  "data": {', "  },", "}", "") | F.col("value").rlike(r'^  "(id|plot_type)": ')
    found = F.from_json(F.concat(F.lit("{"), one, F.lit("}")), f"map<string,struct<{record}>>")
    wrong = F.raise_error(F.concat(F.lit("no record of a payload: "), "value"))
    told = read_lines(spark, path).select(F.when(~frame, F.when(F.coalesce(F.size(found), F.lit(0)) == 1, found).otherwise(wrong)).alias("r"))
    return told.select(F.explode("r").alias(key, "r")).select(key, "r.*")


def read_balance(spark: SparkSession, path: str) -> DataFrame:
    """(sample, resolution, converged, variance) of balance reports, a row for each resolution that has weights."""
    reports = read_json(spark, path, ["sample"], "sample string, resolutions map<string,struct<converged:boolean,variance:double>>")
    return reports.select("sample", F.explode("resolutions").alias("k", "r")).select("sample", F.col("k").cast("long").alias("resolution"), "r.*")


def read_table(spark: SparkSession, path: str, required: list[str], allow_empty: bool = False) -> DataFrame:
    df = require_columns(spark.read.csv(path, sep="\t", header=True, inferSchema=False), required)
    if not allow_empty and df.isEmpty():
        raise ContractError("the table has no rows")
    return df


def read_samples(spark: SparkSession, path: str) -> DataFrame:
    """A sample sheet: strings only, comments passed over, blanks kept as empty strings."""
    return spark.read.csv(path, sep="\t", header=True, inferSchema=False, comment="#", nullValue="\u0000", emptyValue="").na.fill("")


def read_tss(spark: SparkSession, path: str) -> DataFrame:
    """(chrom, pos, name, strand) of genes in a GTF: the start on +, the last base on -."""
    f = F.split("value", "\t")
    rows = read_lines(spark, path).where(~F.col("value").startswith("#")).where(f[2] == "gene")
    start, end = f[3].cast("long") - 1, f[4].cast("long")
    name = F.coalesce(F.nullif(F.regexp_extract(f[8], 'gene_name "([^"]+)"', 1), F.lit("")), F.regexp_extract(f[8], 'gene_id "([^"]+)"', 1))
    return rows.select(f[0].alias("chrom"), F.when(f[6] == "+", start).otherwise(end - 1).alias("pos"), name.alias("name"), f[6].alias("strand"))


def main_view(sizes: DataFrame) -> DataFrame:
    """Whole chromosomes with numbers or X as intervals."""
    return sizes.where(F.col("chrom").rlike(VIEW)).select("chrom", F.lit(0).cast("long").alias("s"), F.col("size").alias("e"), F.col("chrom").alias("name"))


def primary_only(df: DataFrame, column: str = "chrom") -> DataFrame:
    return df.where(F.col(column).rlike(PRIMARY))


def score_column(columns: list[str], window: int) -> str:
    """The insulation score's column: the exact name, then a prefix, then a part of the name."""
    exact = f"log2_insulation_score_{window}"
    for test in (lambda c: c == exact, lambda c: c.startswith("log2_insulation_score"), lambda c: "insulation" in c.lower()):
        if found := next((c for c in columns if test(c)), None):
            return found
    raise ContractError(f"no insulation score among {columns}")
