"""Benchmark decontamination by greedy string tiling.

Documents and benchmark items meet in seeds, word runs of MIN_TILE words that both hold (of
fewer, 2 at least, for items without a sentence that long). An item of which the seeds in a
document could cover enough is tiled: running Karp-Rabin finds maximal matches among unmarked
words, the longest are marked first, and so on with shorter windows. Where these tiles don't
cover enough, whole sentences of the item, short ones too, are looked for first, within an
item's length of a shared seed, and runs are tiled in what is left. Tiles stand in any order,
so a passage whose sentences were moved is caught, unless it has one-word sentences only. A
document is contaminated by an item of which tiles cover at least COVERAGE of the words.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, give_back, small_batches, text_slices

MIN_TILE = 5
COVERAGE = 0.75
#: The benchmark goes to the executors in blocks of so many characters at most, or one item.
BLOCK_CHARS = 4_000_000
MATCH = "array<struct<item_id:long,coverage:double,n_tiles:int,longest:int,tiles:array<struct<item_word:int,doc_word:int,length:int>>>>"
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_END = re.compile(r"(?<=[.!?\u2026])[\"')\]\u00bb\u2019\u201d]*\s+|[\u3002\uff01\uff1f\n\r]+")
_MOD, _RADIX = (1 << 61) - 1, 1_000_003


def words_of(text: str | None) -> list[bytes]:
    return _WORD.findall((text or "").encode("utf-8", "surrogatepass").lower())


def sentences_of(text: str | None) -> list[tuple[int, int]]:
    """(start, length) in words of the text's sentences, which end at a mark before a space or at a line's end."""
    out, at = [], 0
    for part in _END.split(text or ""):
        if n := len(words_of(part)):
            out.append((at, n))
            at += n
    return out


def _windows(ids: list[int], marked: list[bool], size: int) -> Iterator[tuple[int, int]]:
    """(start, rolling hash) of each run of size unmarked words."""
    top, h, n = pow(_RADIX, size - 1, _MOD), 0, 0
    for i, x in enumerate(ids):
        if marked[i]:
            h = n = 0
            continue
        if n == size:
            h = (h - ids[i - size] * top) % _MOD
            n -= 1
        h = (h * _RADIX + x) % _MOD
        n += 1
        if n == size:
            yield i - size + 1, h


def tile(item: list[int], doc: list[int], least: int) -> list[tuple[int, int, int]]:
    """Tiles (start in item, start in doc, length), no two sharing a word of either; longest first."""
    a, b = [x < 0 for x in item], [x < 0 for x in doc]
    out: list[tuple[int, int, int]] = []
    size = max(least, min(len(item), len(doc)))
    while size >= least:
        at: dict[int, list[int]] = {}
        for p, h in _windows(item, a, size):
            at.setdefault(h, []).append(p)
        found = []
        for t, h in _windows(doc, b, size):
            for p in at.get(h, ()):
                if item[p : p + size] != doc[t : t + size] or (p and t and not a[p - 1] and not b[t - 1] and item[p - 1] == doc[t - 1]):
                    continue  # a false hash, or the middle of a longer match
                n = size
                while p + n < len(item) and t + n < len(doc) and not a[p + n] and not b[t + n] and item[p + n] == doc[t + n]:
                    n += 1
                found.append((-n, p, t))
        marked = False
        for n, p, t in sorted(found):
            n = -n
            if not any(a[p : p + n]) and not any(b[t : t + n]):
                a[p : p + n], b[t : t + n] = [True] * n, [True] * n
                out.append((p, t, n))
                marked = True
        if not marked:  # else what was left of crossed matches is searched at this size again
            if size == least:
                break
            size = max(least, size // 2)
    return out


def tile_sentences(item: list[int], sentences: list[tuple[int, int]], doc: list[int], least: int) -> list[tuple[int, int, int]]:
    """As tile(), but whole sentences are marked first, the longest first, and then what tile() finds in the rest."""
    a, b = list(item), list(doc)
    at: dict[int, list[int]] = {}
    for t, x in enumerate(doc):
        if x >= 0:
            at.setdefault(x, []).append(t)
    out = []
    for p, n in sorted(sentences, key=lambda x: -x[1]):
        for t in at.get(item[p], ()):
            if b[t : t + n] == item[p : p + n]:
                out.append((p, t, n))
                a[p : p + n] = b[t : t + n] = [-1] * n
                break
    joined: list[tuple[int, int, int]] = []
    for p, t, n in sorted(out + tile(a, b, least)):
        if joined and joined[-1][0] + joined[-1][2] == p and joined[-1][1] + joined[-1][2] == t:
            joined[-1] = (joined[-1][0], joined[-1][1], joined[-1][2] + n)
        else:
            joined.append((p, t, n))
    return sorted(joined, key=lambda x: -x[2])


class SeedIndex:
    """Benchmark items as word numbers, and the items of each seed."""

    def __init__(self, items: list[tuple[int, str | None]], least: int = MIN_TILE, coverage: float = COVERAGE):
        self.coverage = coverage
        self.vocabulary: dict[bytes, int] = {}
        self.items: list[tuple[int, np.ndarray, int]] = []
        self.sentences: list[list[tuple[int, int]]] = []
        self.short: list[set[int]] = []  # the words of sentences that may hold no seed
        keys: dict[int, dict[int, list[int]]] = {}
        for item_id, text in items:
            ids = np.array([self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words_of(text)], np.int64)
            if not len(ids):
                continue
            sentences = sentences_of(text)
            k = min(least, len(ids))
            seed = k if len(ids) < least else min(least, max(2, max(n for _, n in sentences)))
            for p, h in enumerate(self._hashes(ids, seed)):
                keys.setdefault(seed, {}).setdefault(int(h), []).append((len(self.items), p))
            self.items.append((item_id, ids, k))
            self.sentences.append(sentences)
            self.short.append({i for p, n in sentences if n < seed for i in range(p, p + n)} if len(ids) >= least else set())
        self.seeds = {k: (np.array(sorted(at), np.uint64), at) for k, at in keys.items()}

    @staticmethod
    def _hashes(ids: np.ndarray, k: int) -> np.ndarray:
        h = np.zeros(max(0, len(ids) - k + 1), np.uint64)
        for i in range(k):
            h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + ids[i : len(ids) - k + 1 + i].astype(np.uint64) + np.uint64(1)
        return h

    @staticmethod
    def _near(ids: np.ndarray, places: list[np.ndarray], k: int, around: int) -> tuple[list[int], list[int]]:
        """The words of seeds of k words and so many around them, with -1 where others are left out, and their places in the document."""
        near = np.zeros(len(ids) + 1, np.int64)
        at = np.concatenate(places)
        np.add.at(near, np.maximum(at - around, 0), 1)
        np.add.at(near, np.minimum(at + k + around, len(ids)), -1)
        back = np.flatnonzero(np.cumsum(near[:-1]) > 0)
        gaps = np.flatnonzero(np.diff(back) > 1) + 1
        return np.insert(ids[back], gaps, -1).tolist(), np.insert(back, gaps, -1).tolist()

    def matches(self, text: str | None) -> list[dict]:
        """Items that contaminate this whole text, in order of item_id."""
        get = self.vocabulary.get
        ids = np.array([get(w, -1) for w in words_of(text)], np.int64)
        out = []
        for k, (sorted_keys, at) in self.seeds.items():
            if len(ids) < k:
                continue
            known = ids >= 0
            ok = np.logical_and.reduce([known[i : len(ids) - k + 1 + i] for i in range(k)])
            starts = np.flatnonzero(ok)
            if not len(starts):
                continue
            h = self._hashes(ids, k)[starts]
            place = np.minimum(np.searchsorted(sorted_keys, h), len(sorted_keys) - 1)
            hit = sorted_keys[place] == h
            if not hit.any():
                continue
            found, group = np.unique(h[hit], return_inverse=True)
            places = np.split(starts[hit][np.argsort(group, kind="stable")], np.cumsum(np.bincount(group))[:-1])
            covered: dict[int, np.ndarray] = {}
            where: dict[int, list[np.ndarray]] = {}
            for key, here in zip(found.tolist(), places, strict=True):  # a seed that repeats in the document counts once
                for item, p in at[key]:
                    if item not in covered:
                        covered[item], where[item] = np.zeros(len(self.items[item][1]) + 1, np.int64), []
                    covered[item][p] += 1
                    covered[item][p + k] -= 1
                    if not where[item] or where[item][-1] is not here:
                        where[item].append(here)
            for item, steps in covered.items():
                item_id, words, least = self.items[item]
                need = self.coverage * len(words) - 1e-9
                cover = set(np.flatnonzero(np.cumsum(steps[:-1]) > 0).tolist())
                if len(cover | self.short[item]) < need:
                    continue  # tiles lie within shared seeds and short sentences, so they cover no more
                tiles: list[tuple[int, int, int]] = []
                if len(cover) >= need:
                    doc, real = self._near(ids, where[item], k, 0)
                    tiles = tile(words.tolist(), doc, least)
                if sum(n for _, _, n in tiles) < need and len(words) >= MIN_TILE:
                    doc, real = self._near(ids, where[item], k, len(words))
                    tiles = tile_sentences(words.tolist(), self.sentences[item], doc, least)
                share = sum(n for _, _, n in tiles) / len(words)
                if share >= self.coverage - 1e-9:
                    out.append({"item_id": item_id, "coverage": share, "n_tiles": len(tiles), "longest": max(n for _, _, n in tiles), "tiles": [{"item_word": p, "doc_word": real[t], "length": n} for p, t, n in tiles]})
        return sorted(out, key=lambda m: (m["item_id"] is None, m["item_id"]))


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple[int, str | None]]]:
    """The benchmark's rows by blocks of at most BLOCK_CHARS characters, or one item; the driver holds one at a time."""
    block: list[tuple[int, str | None]] = []
    size = 0
    for r in benchmark.select(F.col("item_id").cast("long"), "text").toLocalIterator():
        if block and size + len(r[1] or "") > BLOCK_CHARS:
            yield block
            block, size = [], 0
        block.append((r[0], r[1]))
        size += len(r[1] or "")
    yield block


def _matches(spark: SparkSession, items: list[tuple[int, str | None]], coverage: float, text: Column) -> Column:
    small_batches(spark)
    shared = spark.sparkContext.broadcast(SeedIndex(items, MIN_TILE, coverage))
    tiles = pa.list_(pa.struct([("item_word", pa.int32()), ("doc_word", pa.int32()), ("length", pa.int32())]))
    kind = pa.list_(pa.struct([("item_id", pa.int64()), ("coverage", pa.float64()), ("n_tiles", pa.int32()), ("longest", pa.int32()), ("tiles", tiles)]))

    @F.arrow_udf(MATCH)
    def find(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            found = [shared.value.matches(t) for lo, n in text_slices(texts) for t in texts.slice(lo, n).to_pylist()]
            give_back()
            yield pa.array(found, kind)

    return find(F.coalesce(text, F.lit("")))


def with_matches(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", out_col: str = "matches", coverage: float = COVERAGE) -> DataFrame:
    """docs with an array (MATCH) of the items that contaminate the text; empty for clean, empty and null texts.

    Items without words match nothing; items shorter than MIN_TILE must stand whole; repeated
    items match each. A benchmark of several blocks is matched block by block, so that neither
    the driver nor an executor holds more than one.
    """
    spark, blocks = docs.sparkSession, _blocks(benchmark)
    first, second = next(blocks), next(blocks, None)
    if second is None:
        return docs.withColumn(out_col, _matches(spark, first, coverage, F.col(text_col)))
    scratch, found = Scratch(spark), None
    rows = scratch.table(docs.withColumn("__row", F.monotonically_increasing_id()), "docs")
    for k, block in enumerate(itertools.chain([first, second], blocks)):
        one = rows.select("__row", _matches(spark, block, coverage, F.col(text_col)).alias("m")).where("size(m) > 0")
        one = scratch.table(one.select("__row", F.explode("m").alias("m")).hint("rebalance"), f"block-{k}")
        found = one if found is None else found.unionByName(one)
    by_row = found.groupBy("__row").agg(F.array_sort(F.collect_list("m")).alias("__m"))
    return rows.join(by_row, "__row", "left").withColumn(out_col, F.coalesce("__m", F.expr(f"cast(array() as {MATCH})"))).drop("__row", "__m")


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", coverage: float = COVERAGE) -> DataFrame:
    """A row for each contaminated row of docs and item: id, item_id, coverage, n_tiles, longest, tiles."""
    found = with_matches(docs.select(F.col(id_col), F.col(text_col).alias("t")), benchmark, "t", "m", coverage)
    return found.select(id_col, F.explode("m").alias("m")).select(id_col, "m.*")


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contaminated documents, with the benchmark items they hold."""
    docs, items = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate(docs, items).drop("tiles").withColumn("contaminated", F.lit(True))
