"""Sinks. Tables are Parquet; texts and documents are small, the same for the same rows, and appear whole or not at all."""

from __future__ import annotations

import contextlib
import gzip
import hashlib
import json
import os
import tempfile
from collections.abc import Iterator
from typing import Any, BinaryIO

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@contextlib.contextmanager
def _published(path: str) -> Iterator[BinaryIO]:
    """A file that appears under its path when it is whole."""
    os.makedirs(os.path.dirname(os.path.abspath(path)), exist_ok=True)
    fd, temp = tempfile.mkstemp(dir=os.path.dirname(os.path.abspath(path)))
    with os.fdopen(fd, "wb") as f:
        yield f
    os.replace(temp, path)


def _publish(path: str, data: bytes) -> None:
    with _published(path) as f:
        f.write(data)


def write_table(df: DataFrame, path: str, by: list[str] | None = None) -> None:
    """Parquet by Spark's commit protocol, partitioned by columns that readers prune on."""
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*by) if by else writer).parquet(path)


def write_text(df: DataFrame, path: str, order: list[str], header: bool = True, packed: bool = True) -> None:
    """A tab-separated export in a fixed order, the header once, gzip without a time stamp.

    Rows go through the driver partition by partition into the file. Without rows a header is all there is.
    """
    rows = df.orderBy(*order).select(F.concat_ws("\t", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns)).alias("v"))
    with _published(path) as raw, gzip.GzipFile(filename="", mode="wb", fileobj=raw, mtime=0) if packed else contextlib.nullcontext(raw) as f:
        if header:
            f.write(("\t".join(df.columns) + "\n").encode())
        for r in rows.toLocalIterator():
            f.write((r["v"] + "\n").encode())


def write_bedpe(df: DataFrame, path: str) -> None:
    """Six columns, no header."""
    cols = ["chrom1", "start1", "end1", "chrom2", "start2", "end2"]
    write_text(df.select(*cols), path, cols, header=False, packed=False)


def write_bedgraph(df: DataFrame, path: str) -> None:
    """chrom, s, e, value; rows without value are left out."""
    write_text(df.select("chrom", "s", "e", "value").where("value is not null"), path, ["chrom", "s"], header=False, packed=False)


def write_json(value: Any, path: str) -> None:
    _publish(path, (json.dumps(value, indent=2, sort_keys=True, default=lambda x: x.item() if hasattr(x, "item") else str(x)) + "\n").encode())


def write_audit(values: dict[str, Any], path: str) -> None:
    _publish(path, "".join(f"{k}\t{v}\n" for k, v in values.items()).encode())


def balance_rows(reports: DataFrame) -> DataFrame:
    """One row per resolution of reports (sample, resolutions map of structs)."""
    return reports.select("sample", F.explode("resolutions").alias("resolution", "r")).select("sample", F.col("resolution").cast("long").alias("resolution"), "r.*")


def write_payload(df: DataFrame, section: str, key: str, path: str) -> None:
    """A report section's JSON: its id, and a record for each row by key, one a line, in the order of keys as text.

    Rows go through the driver partition by partition into the file; of a repeated key one record is written.
    """
    dump = lambda x: json.dumps(x, sort_keys=True, default=str)
    rows = df.withColumn("__key", F.coalesce(F.col(key).cast("string"), F.lit("null"))).drop(key).dropDuplicates(["__key"]).orderBy("__key")
    with _published(path) as f:
        f.write(b'{\n  "data": {')
        for n, r in enumerate(rows.toLocalIterator()):
            record = r.asDict(recursive=True)
            f.write(f"{',' if n else ''}\n    {json.dumps(record.pop('__key'))}: {dump(record)}".encode())
        f.write(f'\n  }},\n  "id": {json.dumps(section)},\n  "plot_type": "table"\n}}\n'.encode())


def qc_markdown(df: DataFrame, key: str) -> str:
    lines = [f"| {' | '.join(df.columns)} |", f"|{'---|' * len(df.columns)}"]
    return "\n".join(lines + [f"| {' | '.join('' if v is None else str(v) for v in r)} |" for r in df.orderBy(key).collect()]) + "\n"


def file_digest(path: str) -> str:
    h = hashlib.sha256()
    with open(path, "rb") as f:
        for block in iter(lambda: f.read(1 << 20), b""):
            h.update(block)
    return h.hexdigest()


def json_digest(value: Any) -> str:
    return hashlib.sha256(json.dumps(value, sort_keys=True, separators=(",", ":")).encode()).hexdigest()


def run_manifest(config: dict, inputs: list[str], outputs: list[str], created: str) -> dict:
    """What a run read and wrote, by digest."""
    return {
        "schema": "helixmill-run-v1", "created_utc": created, "config_sha256": json_digest(config),
        "inputs": {p: file_digest(p) for p in sorted(inputs)}, "outputs": {p: file_digest(p) for p in sorted(outputs)},
    }
