"""Queries that write tables by the sinks and read them back by the readers."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..adapters import cte, table
from ..sources import readers, sinks
from .contacts import _keep, query


def _folder(spark) -> str:
    """A fresh folder beside the checkpoints, which the driver and all executors see."""
    _keep(spark)
    return f"{spark.sparkContext._jsc.sc().getCheckpointDir().get().removeprefix('file:')}/files-{uuid.uuid4().hex}".replace("//", "/")


def _rows(spark, values: dict, schema: str = "name string, value double"):
    return spark.createDataFrame([(k, float(v)) for k, v in values.items()], schema)


@query(f"{cte('peaks')} SELECT chrom, s, e FROM peaks")
def src03_interval_file(spark, d):
    """Intervals through a packed file whose name doesn't say so."""
    sinks.write_text(table(spark, d, "peaks").select("chrom", "s", "e"), path := f"{_folder(spark)}/peaks.bed", ["chrom", "s", "e"], header=False)
    return readers.read_bed(spark, path, strict=True)


@query(f"{cte('tss')} SELECT gene AS value FROM tss")
def src01_text_lines(spark, d):
    sinks.write_text(table(spark, d, "tss").select("gene"), path := f"{_folder(spark)}/names.txt", ["gene"], header=False, packed=False)
    return readers.read_lines(spark, path)


@query(f"{cte('chroms')} SELECT chrom, size FROM chroms")
def src02_chromosome_sizes(spark, d):
    sinks.write_text(table(spark, d, "chroms").select("chrom", "size"), path := f"{_folder(spark)}/sizes.txt", ["chrom"], header=False)
    return readers.read_chromsizes(spark, path, strict=True)


@query(f"{cte('loops')} SELECT chrom1, start1, end1, chrom2, start2, end2, CAST(score AS DOUBLE) AS score, round(pvalue, 12) AS pvalue, round(fdr, 12) AS fdr FROM loops")
def src05_paired_file(spark, d):
    """Paired intervals with statistics under their callers' column names."""
    names = {"chrom1": "chr1", "start1": "s1", "end1": "e1", "chrom2": "chr2", "start2": "s2", "end2": "e2", "score": "cc", "pvalue": "P-Value_Bias", "fdr": "Q-Value_Bias"}
    rows = table(spark, d, "loops").select(*(F.col(k).alias(v) for k, v in names.items()))
    sinks.write_text(rows, path := f"{_folder(spark)}/calls.tsv", ["chr1", "s1", "s2", "cc"])
    return readers.read_bedpe(spark, path, strict=True).withColumns({c: F.round(c, 12) for c in ("pvalue", "fdr")})


@query(f"{cte('loops')} SELECT chrom1, start1, end1, chrom2, start2, end2 FROM loops")
def snk06_paired_export(spark, d):
    """Six columns without a header, read back by place."""
    sinks.write_bedpe(table(spark, d, "loops"), path := f"{_folder(spark)}/loops.bedpe")
    return readers.read_bedpe(spark, path, strict=True).select("chrom1", "start1", "end1", "chrom2", "start2", "end2")


@query(f"{cte('loops')} SELECT sample, CAST(score AS VARCHAR) AS score FROM loops")
def src07_required_columns(spark, d):
    sinks.write_text(table(spark, d, "loops").select("chrom1", "sample", "start1", "score"), path := f"{_folder(spark)}/calls.tsv.gz", ["chrom1", "sample", "start1", "score"])
    return readers.read_calls(spark, path, ["sample", "score"])


@query(f"{cte('pairs')} SELECT chrom1, pos1, chrom2, pos2, strand1, strand2, pair_type, rfrag1, rfrag2 FROM pairs")
def src14_pairs_file(spark, d):
    """Pairs by the names that the file's header gives."""
    names = ["chrom1", "pos1", "chrom2", "pos2", "strand1", "strand2", "pair_type", "rfrag1", "rfrag2"]
    body = table(spark, d, "pairs").select(F.concat_ws("\t", *(F.col(c).cast("string") for c in names)).alias("v"))
    head = spark.createDataFrame([("#columns: " + " ".join(names),)], "v string")
    sinks.write_text(head.unionByName(body), path := f"{_folder(spark)}/x.pairs.gz", ["v"], header=False)
    return readers.read_pairs(spark, path)


@query("SELECT 'total' AS name, CAST(count(*) AS DOUBLE) AS value FROM lineitem UNION ALL SELECT 'returned', CAST(count(*) FILTER (l_returnflag = 'R') AS DOUBLE) FROM lineitem")
def src15_key_values(spark, d):
    """A report's numbers by key; other lines are passed over."""
    n = table(spark, d, "lineitem").agg(F.count("*").alias("total"), F.count_if(F.col("l_returnflag") == "R").alias("returned")).first()
    sinks.write_audit({"version": "x.y", **n.asDict()}, path := f"{_folder(spark)}/stats.txt")
    return _rows(spark, readers.read_key_values(spark, path))


@query("SELECT 'lines' AS name, CAST(count(*) AS DOUBLE) AS value FROM lineitem UNION ALL SELECT 'quantity', sum(l_quantity) FROM lineitem")
def src16_one_row(spark, d):
    """A table of one row, by column."""
    one = table(spark, d, "lineitem").agg(F.count("*").alias("lines"), F.sum("l_quantity").alias("quantity"))
    sinks.write_text(one, path := f"{_folder(spark)}/one.tsv", ["lines"], packed=False)
    return _rows(spark, readers.read_one_row(spark, path))


@query("SELECT count(*) AS raw, count(*) FILTER (l_discount < 0.05) AS retained FROM lineitem")
def src17_trim_report(spark, d):
    n = table(spark, d, "lineitem").agg(F.count("*").alias("a"), F.count_if(F.col("l_discount") < 0.05).alias("b")).first()
    sinks.write_json({"summary": {"before_filtering": {"total_reads": 2 * n["a"]}, "after_filtering": {"total_reads": 2 * n["b"]}}}, path := f"{_folder(spark)}/trim.json")
    return spark.createDataFrame([readers.read_trim_report(spark, path)], "raw long, retained long")


@query(f"{cte('design')} SELECT sample_id, subject_id, arm, '' AS notes FROM design")
def src19_sample_sheet(spark, d):
    """A sample sheet: strings, comments passed over, blanks kept."""
    rows = table(spark, d, "design").select("sample_id", "subject_id", "arm", F.lit("").alias("notes"))
    sinks.write_text(rows.unionByName(rows.limit(1).withColumn("sample_id", F.lit("#left out"))), path := f"{_folder(spark)}/samples.tsv", ["sample_id"], packed=False)
    return readers.read_samples(spark, path)


@query(f"{cte('tss')} SELECT chrom, pos, gene AS name, CASE WHEN pos % 2 = 0 THEN '+' ELSE '-' END AS strand FROM tss")
def src20_gene_starts(spark, d):
    """Starts of genes of an annotation: of + the first base, of - the last."""
    t = table(spark, d, "tss").withColumn("strand", F.when(F.col("pos") % 2 == 0, "+").otherwise("-"))
    line = lambda kind: F.concat_ws("\t", "chrom", F.lit("x"), F.lit(kind), F.when(F.col("strand") == "+", F.col("pos") + 1).otherwise(F.greatest(F.col("pos") - 500, F.lit(1))).cast("string"), F.when(F.col("strand") == "+", F.col("pos") + 900).otherwise(F.col("pos") + 1).cast("string"), F.lit("."), "strand", F.lit("."), F.concat(F.lit('gene_id "G"; gene_name "'), "gene", F.lit('";')))
    sinks.write_text(t.select(line("gene").alias("v")).unionByName(t.select(line("exon").alias("v"))), path := f"{_folder(spark)}/genes.gtf", ["v"], header=False)
    return readers.read_tss(spark, path).select("chrom", "pos", "name", "strand")


@query(f"{cte('contacts')} SELECT sample, chrom, start1, start2, score FROM contacts WHERE sample = 's1' AND chrom = 'chr3'")
def src10_partition_fetch(spark, d):
    """One sample's one chromosome of a table that is partitioned by both: other files aren't opened."""
    sinks.write_table(table(spark, d, "contacts"), path := f"{_folder(spark)}/contacts", by=["sample", "chrom"])
    return spark.read.parquet(path).where("sample = 's1' and chrom = 'chr3'").select("sample", "chrom", "start1", "start2", "score")


@query(f"{cte('track')} SELECT chrom, s, e, round(value, 6) AS value FROM track WHERE chrom <> 'chr2'")
def snk07_signal_export(spark, d):
    """A signal file: places without a value are left out."""
    t = table(spark, d, "track").withColumn("value", F.when(F.col("chrom") != "chr2", F.col("value")))
    sinks.write_bedgraph(t, path := f"{_folder(spark)}/x.bedgraph")
    f = F.split("value", "\t")
    return readers.read_lines(spark, path).select(f[0].alias("chrom"), f[1].cast("long").alias("s"), f[2].cast("long").alias("e"), F.round(f[3].cast("double"), 6).alias("value"))


@query(f"{cte('qc')} SELECT sample, yield_pct, balance_status FROM qc")
def snk12_report_payload(spark, d):
    """A report section's JSON, read back record by record."""
    q = table(spark, d, "qc").select("sample", "yield_pct", "balance_status")
    sinks.write_payload(q, "qc", "sample", path := f"{_folder(spark)}/payload.json")
    got = readers.read_payload(spark, path, "sample", "yield_pct: double, balance_status: string")
    return got.withColumn("sample", F.col("sample").cast("long"))


@query(f"{cte('qc')} SELECT sample, CAST(yield_pct AS VARCHAR) AS yield_pct FROM qc")
def snk11_report_table(spark, d):
    """The quality table as Markdown, its rows read back."""
    path = f"{_folder(spark)}/qc.md"
    sinks._publish(path, sinks.qc_markdown(table(spark, d, "qc").select("sample", F.col("yield_pct").cast("string").alias("yield_pct")), "sample").encode())
    f = F.split("value", r"\s*\|\s*")
    return readers.read_lines(spark, path).where(F.col("value").rlike(r"^\| \d")).select(f[1].cast("long").alias("sample"), f[2].alias("yield_pct"))


@query("SELECT 'outputs' AS kind, sha256(string_agg(CAST(n_nationkey AS VARCHAR) || chr(9) || n_name || chr(10), '' ORDER BY n_nationkey)) AS digest FROM nation")
def snk15_run_manifest(spark, d):
    """The digest that a run's manifest has of a file."""
    sinks.write_text(table(spark, d, "nation").select("n_nationkey", "n_name"), path := f"{_folder(spark)}/out.tsv", ["n_nationkey"], header=False, packed=False)
    run = sinks.run_manifest({"a": 1}, [], [path], "2024-01-01T00:00:00Z")
    return spark.createDataFrame([("outputs", run["outputs"][path])], "kind string, digest string")


@query(f"{cte('chroms')} SELECT chrom, size FROM chroms WHERE size < 0")
def snk08_empty_export(spark, d):
    """A table without rows is a header, and comes back with its columns and no rows."""
    sinks.write_text(table(spark, d, "chroms").where("size < 0").select("chrom", "size"), path := f"{_folder(spark)}/none.tsv.gz", ["chrom"])
    return readers.read_table(spark, path, ["chrom", "size"], allow_empty=True).select("chrom", F.col("size").cast("long").alias("size"))


@query("SELECT sample, resolution, converged, variance FROM (SELECT c_name AS sample, CAST((c_custkey % 4 + 1) * 5000 AS BIGINT) AS resolution, CASE c_nationkey % 4 WHEN 0 THEN NULL WHEN 1 THEN false ELSE true END AS converged, CAST(c_nationkey AS DOUBLE) / 4 AS variance FROM customer) x")
def src13_balance_attributes(spark, d):
    """Attributes of weights by resolution, through the reports' JSON."""
    converged = F.when(F.col("c_nationkey") % 4 == 1, False).when(F.col("c_nationkey") % 4 > 0, True)
    rows = table(spark, d, "customer").select("c_name", ((F.col("c_custkey") % 4 + 1) * 5000).cast("string").alias("resolution"), converged.alias("converged"), (F.col("c_nationkey") / 4).alias("variance"))
    reports = [{"sample": r["c_name"], "resolutions": {r["resolution"]: {"converged": r["converged"], "variance": r["variance"]}}} for r in rows.toLocalIterator()]  # a report for each library
    sinks.write_json(reports, path := f"{_folder(spark)}/balance.json")
    return readers.read_balance(spark, path)


@query("SELECT unnest(['empty.txt', 'none.txt']) AS name")
def chk27_required_files(spark, d):
    """Files that aren't there or are empty."""
    at = _folder(spark)
    sinks.write_text(table(spark, d, "nation").select("n_name"), f"{at}/whole.txt", ["n_name"], packed=False)
    sinks.write_text(table(spark, d, "nation").select("n_name").where("n_name is null"), f"{at}/empty.txt", ["n_name"], header=False, packed=False)
    found = readers.missing_files(spark, [f"{at}/{name}.txt" for name in ("whole", "empty", "none")])
    return spark.createDataFrame([(p.rpartition("/")[2],) for p in found], "name string")
