"""Contact-data tables derived from the star-schema test tables.

One SQL text each, run by Spark here and used as a CTE by the checking SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

WIDTH = 5000
CHROM_SIZE = 352_000
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def _chrom(k: str) -> str:
    return f"CASE WHEN {k} < 22 THEN concat('chr', CAST({k} + 1 AS STRING)) WHEN {k} = 22 THEN 'chrX' WHEN {k} = 23 THEN 'chrY' ELSE 'chrUn_1' END"


_C22 = "concat('chr', CAST({} % 22 + 1 AS STRING))"
_GRID = "SELECT k FROM range(71) AS z(k)"

SQL = {
    "contacts": f"""SELECT sample, chrom, start1, start1 + gap * 5000 AS start2, CAST(sum(q) AS BIGINT) AS score FROM (
        SELECT concat('s', CAST(l_linenumber % 4 AS STRING)) AS sample, {_chrom('(l_suppkey + l_partkey) % 25')} AS chrom,
        (l_partkey % 40) * 5000 AS start1, (l_orderkey % 30) + 1 AS gap, CAST(l_quantity AS BIGINT) AS q FROM lineitem) t
        GROUP BY sample, chrom, start1, gap""",
    "blacklist": f"SELECT DISTINCT {_C22.format('s_suppkey')} AS chrom, (s_suppkey % 7) * 25000 + 1000 AS s, (s_suppkey % 7) * 25000 + 3000 AS e FROM supplier WHERE s_suppkey % 3 = 0",
    "peaks": f"SELECT event_type AS sample, {_C22.format('user_id')} AS chrom, (event_id * 37) % 200000 AS s, (event_id * 37) % 200000 + CAST(floor(value) AS BIGINT) + 1 AS e FROM events",
    "tss": f"SELECT c_name AS gene, {_C22.format('c_custkey')} AS chrom, (c_custkey * 7919) % 350000 AS pos FROM customer",
    "chroms": f"SELECT {_chrom('k')} AS chrom, CAST(352000 AS BIGINT) AS size FROM ({_GRID}) z WHERE k < 25",
    "bins": f"SELECT {_chrom('c.k')} AS chrom, CAST(c.k * 71 + g.k AS BIGINT) AS bin_id, CAST(g.k * 5000 AS BIGINT) AS s, CAST(CASE WHEN g.k = 70 THEN 352000 ELSE g.k * 5000 + 5000 END AS BIGINT) AS e FROM (SELECT k FROM ({_GRID}) z WHERE k < 24) c CROSS JOIN ({_GRID}) g",
    "track": f"SELECT chrom, slot * 25000 AS s, slot * 25000 + 25000 AS e, CAST(sum(v) AS DOUBLE) AS value FROM (SELECT {_C22.format('o_custkey')} AS chrom, o_orderkey % 14 AS slot, CAST(floor(o_totalprice) AS BIGINT) AS v FROM orders) t GROUP BY chrom, slot",
    "pairs": f"""SELECT concat('s', CAST(l_linenumber % 4 AS STRING)) AS sample, {_chrom('l_partkey % 25')} AS chrom1, (l_partkey * 131) % 350000 AS pos1,
        {_chrom('CASE WHEN l_orderkey % 3 = 0 THEN l_suppkey % 25 ELSE l_partkey % 25 END')} AS chrom2, (l_suppkey * 977 + l_orderkey * 13) % 350000 AS pos2,
        CASE WHEN l_returnflag = 'A' THEN '+' ELSE '-' END AS strand1, CASE WHEN l_linestatus = 'O' THEN '+' ELSE '-' END AS strand2,
        CASE WHEN l_orderkey % 11 = 0 THEN 'UR' WHEN l_orderkey % 13 = 0 THEN 'DD' ELSE 'UU' END AS pair_type, l_partkey % 50 - 1 AS rfrag1, l_suppkey % 50 - 1 AS rfrag2 FROM lineitem""",
    "loops": f"""SELECT sample, chrom AS chrom1, start1, start1 + 5000 AS end1, chrom AS chrom2, start2, start2 + 5000 AS end2, score,
        CAST(1 AS DOUBLE) / (1 + score) AS pvalue, CAST(2 AS DOUBLE) / (2 + score) AS fdr FROM ({{contacts}}) k WHERE score >= 20""",
    "design": "SELECT concat('d', CAST(c_custkey AS STRING)) AS sample_id, concat('p', CAST(c_nationkey AS STRING)) AS subject_id, c_mktsegment AS arm FROM customer",
    "qc": "SELECT CAST(c_custkey AS BIGINT) AS sample, CAST(c_custkey % 100 AS DOUBLE) AS yield_pct, CAST((c_custkey * 7) % 80 AS DOUBLE) AS dup_pct, CAST((c_custkey * 13) % 100 AS DOUBLE) / 100 AS cis_fraction, CASE c_custkey % 4 WHEN 0 THEN 'PASS' WHEN 1 THEN 'FAIL' WHEN 2 THEN 'DISCORDANT' ELSE 'NOT_ASSESSED' END AS replicate_status, CASE c_custkey % 3 WHEN 0 THEN 'PASS' WHEN 1 THEN 'WARN' ELSE 'NOT_ASSESSED' END AS balance_status FROM customer",
}
SQL["loops"] = SQL["loops"].format(contacts=SQL["contacts"])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """An adapter's table, or a test table itself."""
    read = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES if name == t or (name in SQL and f"FROM {t}" in SQL[name])}
    if name not in SQL:
        return read[name]
    text = SQL[name]
    for t in read:
        text = text.replace(f"FROM {t}", f"FROM {{{t}}}")
    return spark.sql(text, **read)


def cte(*names: str) -> str:
    """WITH clause of the adapters, to which a query's own are added after a comma."""
    return "WITH " + ",\n".join(f"{n} AS ({SQL[n]})" for n in names)
