"""URL rules in a sorted digest array.

Every rule (host and path prefix) is keyed by the 64-bit xxhash of its text. The sorted
keys, and the full strings to confirm a hit, lie in one file that Spark hands to every
executor from the shared folder; its Python workers map it into memory and probe it by vectorised binary search
with the host suffixes and path prefixes of each url.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import UPPER, Scratch, publish

OUT = "page_id long, host string, path string, rule string, verdict string"


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path): after the first `://`; both empty for null and for urls without it."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    whole = F.coalesce(url, F.lit(""))
    return F.translate(F.regexp_extract(whole, pattern, 1), UPPER, UPPER.lower()), F.regexp_extract(whole, pattern, 2)


def split_rule(rule: str) -> tuple[str, str]:
    host, slash, path = rule.partition("/")
    return host.translate(str.maketrans(UPPER, UPPER.lower())), slash + path


def rule_file(rules: Iterable[tuple[str, str]]) -> bytes:
    """rules: (allow or block, host/path). Of equal rules block wins."""
    chosen: dict[str, bool] = {}
    for verdict, rule in rules:
        text = "".join(split_rule(rule))
        chosen[text] = chosen.get(text, False) or verdict == "block"
    texts = [t.encode() for t in chosen]
    keys = np.array([xxhash.xxh64_intdigest(t) for t in texts], np.uint64)
    order = np.argsort(keys, kind="stable")
    block = np.fromiter(chosen.values(), bool, len(texts))[order]
    offsets = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(texts[i]) for i in order], out=offsets[1:])
    lengths = np.array(sorted({len(split_rule(t)[1]) for t in chosen}), np.int64)
    numbers = (np.array([len(texts), len(lengths)], np.int64), keys[order], offsets, lengths, block.astype(np.uint8))
    return b"".join([part.tobytes() for part in numbers] + [texts[i] for i in order])


class DigestArray:
    """A rule file, memory-mapped."""

    def __init__(self, path: str):
        data = np.memmap(path, np.uint8, "r")
        n, k = (int(x) for x in data[:16].view(np.int64))
        at = 16
        self.keys, at = data[at : at + 8 * n].view(np.uint64), at + 8 * n
        self.offsets, at = data[at : at + 8 * (n + 1)].view(np.int64), at + 8 * (n + 1)
        self.path_lengths, at = [int(x) for x in data[at : at + 8 * k].view(np.int64)], at + 8 * k
        self.block, self.text = data[at : at + n], data[at + n :]

    def probe(self, texts: list[bytes]) -> np.ndarray:
        """The rule's place for each text, -1 without one: binary search, then the stored string decides."""
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, texts), np.uint64, len(texts))
        first, last = np.searchsorted(self.keys, hashes, "left"), np.searchsorted(self.keys, hashes, "right")
        found = np.full(len(texts), -1, np.int64)
        for i in np.flatnonzero(first < last):
            for at in range(first[i], last[i]):
                if self.text[self.offsets[at] : self.offsets[at + 1]].tobytes() == texts[i]:
                    found[i] = at
        return found

    def longest(self, hosts: list[str], paths: list[str]) -> list[tuple[str, bool] | None]:
        """The longest rule that fits each url, with block or not; of equal length the longer host."""
        owner, texts, rank = [], [], []
        for i, (host, path) in enumerate(zip(hosts, paths, strict=True)):
            suffixes = [host] + [host[j + 1 :] for j, c in enumerate(host) if c == "."]
            for cut in self.path_lengths:
                if cut <= len(path):
                    for s in suffixes:
                        owner.append(i)
                        texts.append((s + path[:cut]).encode())
                        rank.append((len(s) + cut, len(s)))
        best: list = [None] * len(hosts)
        for k in np.flatnonzero((found := self.probe(texts)) >= 0):
            if best[owner[k]] is None or rank[k] > best[owner[k]][0]:
                best[owner[k]] = (rank[k], texts[k].decode(), bool(self.block[found[k]]))
        return [b and b[1:] for b in best]


def url_filter(pages: DataFrame, rules: list[tuple[str, str]], default: str = "allow", id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per row of pages: id, host, path, the longest fitting rule or null, verdict.

    A rule fits its host and all subdomains where the url's path starts with the rule's.
    Urls without a rule get the default; so do null and malformed ones. Rows repeat as they
    do in pages. No rules, or no rows, are no error.
    """
    name = publish(Scratch(pages.sparkSession), "urls.rules", rule_file(rules))
    host, path = url_parts(F.col(url_col))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), host.alias("host"), path.alias("path"))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        array = DigestArray(SparkFiles.get(name))
        for batch in batches:
            best = array.longest(batch.column("host").to_pylist(), batch.column("path").to_pylist())
            verdict = [default if b is None else ("block" if b[1] else "allow") for b in best]
            rule = pa.array([b and b[0] for b in best], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, rule, pa.array(verdict, pa.string())], ["page_id", "host", "path", "rule", "verdict"])

    return rows.mapInArrow(judge, OUT)


RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/")]


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A verdict on every page's url."""
    return url_filter(spark.read.parquet(f"{sf_dir}/pages.parquet"), RULES)


OP7_SQL = r"""
WITH u AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)([^?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)([^?#]*)', 2, 's') AS path
  FROM pages
), r(verdict, rhost, rpath) AS (
  VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')
), p AS (
  SELECT h.host, h.path, arg_max(rhost || rpath, length(rhost || rpath)) AS rule, arg_max(verdict, length(rhost || rpath)) AS verdict
  FROM (SELECT DISTINCT host, path FROM u) h JOIN r ON (h.host = rhost OR ends_with(h.host, '.' || rhost)) AND starts_with(h.path, rpath)
  GROUP BY h.host, h.path
)
SELECT page_id, u.host, u.path, p.rule, coalesce(p.verdict, 'allow') AS verdict FROM u LEFT JOIN p ON u.host = p.host AND u.path = p.path
"""
