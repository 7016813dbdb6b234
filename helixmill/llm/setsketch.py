"""SetSketch near-duplicates: mergeable, locality-sensitive registers; likelihood; exact check.

A register holds the truncated logarithm of the smallest of exponential variates that a
document's shingles draw, so registers of a union are the maxima of registers. Two
documents' registers are equal nearly as often as their Jaccard similarity says, so bands
of them find candidates; a joint likelihood of all registers drops the hopeless; full
shingle sets decide.

Work stays linear in hot groups: documents of equal sets are one class; in each bucket of
a band, classes are first linked with one pivot, then only members of different components
are compared, by registers, block by block in a task's memory, and nothing but links comes
out. Where these blocks would be more work than looking at every register, members go first
that share no rare register with another: a pair equal in EQUAL of REGISTERS registers shares
one of the REGISTERS - EQUAL + 1 rarest of either, so what only a common passage (of up to
three fifths of a text) brought together is left out, whatever its number.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, give_back, sift, small_batches, text_slices
from .components import EDGES_A_TASK, components, joined_labels

WORDS = 5
#: Linked where DENOMINATOR * intersection >= NUMERATOR * union.
NUMERATOR, DENOMINATOR = 75, 100
#: 64 bands of 6: a pair of similarity 0.75 shares no band with probability (1 - 0.75^6)^64 < 4e-6.
BANDS, ROWS = 64, 6
REGISTERS = BANDS * ROWS
#: Sketch parameters: base, rate and largest register value.
BASE, RATE, LARGEST = 1.001, 20.0, 65534
#: A candidate goes on unless its estimate lies so many standard errors under the threshold.
SIGMAS = 6.0
#: Registers are equal with a probability of the similarity at least, so linked sets have fewer equal ones only beyond SIGMAS.
EQUAL = math.floor(REGISTERS * NUMERATOR / DENOMINATOR - SIGMAS * math.sqrt(REGISTERS * NUMERATOR / DENOMINATOR * (1 - NUMERATOR / DENOMINATOR)))
#: Members of a bucket compared at a time, and their shingles unless one set alone has more.
BLOCK, BLOCK_SHINGLES = 256, 1 << 19
#: Rare registers are looked for where blocks would compare more pairs than so many for each member.
PAIRS_A_MEMBER = 64 * REGISTERS

_rng = np.random.default_rng(20240229)
_MUL = _rng.integers(0, 1 << 31, REGISTERS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_ADD = _rng.integers(0, 1 << 32, REGISTERS, dtype=np.uint32)
_P = np.uint64(0x9E3779B97F4A7C15)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingle_set(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted 64-bit hashes of a whole text's distinct word shingles; one for fewer words, none for no words."""
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, tokens), np.uint64, len(tokens))
    if not len(h):
        return h
    k = min(words, len(h))
    out = np.full(len(h) - k + 1, k, np.uint64)
    for i in range(k):
        out = out * _P + h[i : len(h) - k + 1 + i]
        out ^= out >> np.uint64(29)
    return np.unique(_mix(out))


def sketch(shingles: np.ndarray) -> np.ndarray:
    """REGISTERS values; 0 everywhere for the empty set. sketch(a | b) == maximum(sketch(a), sketch(b)).

    The low halves of the hashes are enough: a coincidence can only make registers equal.
    """
    if not len(shingles):
        return np.zeros(REGISTERS, np.uint16)
    low, best = shingles.astype(np.uint32), np.zeros(REGISTERS, np.uint32)
    for lo in range(0, len(low), 64):
        x = low[lo : lo + 64, None] * _MUL
        x += _ADD
        np.maximum(best, x.max(0), out=best)
    gap = (2.0**32 - 1 - best.astype(np.float64)) + 0.5
    least = -np.log1p(-gap / 2.0**32) / RATE  # the smallest exponential variate
    return np.clip(np.floor(1 - np.log(least) / math.log(BASE)), 0, LARGEST).astype(np.uint16)


def band_keys(registers: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band, different between bands."""
    rows = registers.astype(np.uint64).reshape(BANDS, ROWS)
    out = np.arange(1, BANDS + 1, dtype=np.uint64) * _P
    for k in range(ROWS):
        out = _mix(out * _P + rows[:, k] + np.uint64(1))
    return out.view(np.int64)


def likely_similarity(up: np.ndarray, down: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Jaccard similarity of largest joint likelihood, by golden section.

    up, down: how many registers of a are larger, smaller than b's; sizes are known exactly.
    """
    up, down, n_a, n_b = (np.asarray(v, float) for v in (up, down, n_a, n_b))
    u, v, equal = n_a / (n_a + n_b), n_b / (n_a + n_b), REGISTERS - up - down
    p = lambda x: -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / math.log(BASE)

    def cost(j: np.ndarray) -> np.ndarray:
        a, b = p(u - v * j), p(v - u * j)
        return -(up * np.log(np.maximum(a, 1e-12)) + down * np.log(np.maximum(b, 1e-12)) + equal * np.log(np.maximum(1 - a - b, 1e-12)))

    lo, hi, g = np.zeros_like(u), np.minimum(u / v, v / u), (math.sqrt(5) - 1) / 2
    for _ in range(24):
        x, y = hi - g * (hi - lo), lo + g * (hi - lo)
        left = cost(x) < cost(y)
        lo, hi = np.where(left, lo, x), np.where(left, y, hi)
    return (lo + hi) / 2


def hopeful(j: np.ndarray) -> np.ndarray:
    t = NUMERATOR / DENOMINATOR
    return j >= t - SIGMAS * math.sqrt(t * (1 - t) / REGISTERS)


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    """Exact, on full sets."""
    if DENOMINATOR * min(len(a), len(b)) < NUMERATOR * max(len(a), len(b)):
        return False
    both = len(a) + len(b) - len(np.union1d(a, b)) if len(a) < 64 else int((b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum())
    return DENOMINATOR * both >= NUMERATOR * (len(a) + len(b) - both)


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, n in text_slices(batch.column("t")):
            part = batch.slice(lo, n)
            sets = [shingle_set(t) for t in part.column("t").to_pylist()]
            keys = [band_keys(sketch(s)) if len(s) else np.zeros(0, np.int64) for s in sets]
            digest = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(digest, pa.binary()), pa.array(keys, pa.list_(pa.int64()))], ["id", "n", "digest", "bands"]
            )
            del sets, keys
        give_back()


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, n in text_slices(batch.column("t")):
            part = batch.slice(lo, n)
            sets = [shingle_set(t) for t in part.column("t").to_pylist()]
            columns = [[xxhash.xxh3_128_digest(s.tobytes()) for s in sets], [sketch(s).tobytes() for s in sets], [s.tobytes() for s in sets]]
            yield pa.RecordBatch.from_arrays([part.column("id"), *(pa.array(c, pa.binary()) for c in columns)], ["id", "digest", "sketch", "shingles"])
            del sets, columns
        give_back()


def _unpack(column: pa.Array, kind) -> list[np.ndarray]:
    return [np.frombuffer(x, kind) for x in column.to_pylist()]


def _likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo in range(0, batch.num_rows, 2048):
            part = batch.slice(lo, 2048)
            a, b = (np.stack(_unpack(part.column(c), np.uint16)) for c in ("sa", "sb"))
            j = likely_similarity((a > b).sum(1), (a < b).sum(1), part.column("na").to_numpy(), part.column("nb").to_numpy())
            yield part.select(["a", "b"]).filter(pa.array(hopeful(j)))


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, n in text_slices(batch.column("xa")):
            part = batch.slice(lo, n)
            keep = [linked(x, y) for x, y in zip(_unpack(part.column("xa"), np.uint64), _unpack(part.column("xb"), np.uint64), strict=True)]
            yield part.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
        give_back()


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) that are linked: first by registers, then by sets."""
    small = sets.select("node", "n", "sketch")
    both = pairs.join(small.toDF("a", "na", "sa"), "a").join(small.toDF("b", "nb", "sb"), "b")
    likely = both.select("a", "b", "na", "nb", "sa", "sb").mapInArrow(_likely, "a long, b long")
    full = sets.select("node", "shingles")
    return likely.join(full.toDF("a", "xa"), "a").join(full.toDF("b", "xb"), "b").select("a", "b", "xa", "xb").mapInArrow(_confirm, "a long, b long")


def register_tokens(shingles: np.ndarray) -> np.ndarray:
    """For each register a number of its place and of the shingle whose variate it holds."""
    low, best, token = shingles.astype(np.uint32), np.zeros(REGISTERS, np.uint32), np.full(REGISTERS, shingles[0])
    for lo in range(0, len(low), 64):
        x = low[lo : lo + 64, None] * _MUL
        x += _ADD
        at = x.argmax(0)
        value = x[at, np.arange(REGISTERS)]
        more = value > best
        best[more], token[more] = value[more], shingles[lo + at[more]]
    return _mix(token + np.arange(1, REGISTERS + 1, dtype=np.uint64) * _P).view(np.int64)


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, n in text_slices(batch.column("shingles")):
            part = batch.slice(lo, n)
            flat = np.concatenate([register_tokens(x) for x in _unpack(part.column("shingles"), np.uint64)])
            lists = pa.ListArray.from_arrays(np.arange(n + 1, dtype=np.int32) * REGISTERS, flat)
            yield pa.RecordBatch.from_arrays([part.column("node"), part.column("component"), lists], ["node", "component", "tokens"])


def rare_sharers(nodes: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """Of nodes (node, component, shingles) those (node) that share one of their rarest registers with another component's.

    A register counts by the shingle it holds, which has more bits than its value. Rare is
    what few of all nodes have. No pair of different components with EQUAL registers of the
    same shingles loses a member. A node's registers are gathered, never a register's nodes.
    """
    each = scratch.table(nodes.mapInArrow(_tokens, "node long, component long, tokens array<long>"), f"{name}-registers").select("node", "component", F.explode("tokens").alias("token"))
    shared = scratch.table(each.groupBy("token").agg(F.count("*").alias("n"), F.min("component").alias("lo"), F.max("component").alias("hi")).where("n > 1"), f"{name}-shared")
    known = each.join(shared.select("token", "n", (F.col("lo") != F.col("hi")).alias("mixed")), "token")
    rows = known.groupBy("node", "component").agg(F.array_sort(F.collect_list(F.struct("n", "token", "mixed"))).alias("c"))
    rarest = rows.withColumn("c", F.expr(f"slice(c, 1, greatest(0, {REGISTERS - EQUAL + 1} - ({REGISTERS} - size(c))))"))  # registers of one node only come first and meet no other
    prefix = scratch.table(rarest.select("node", "component", F.explode("c.token").alias("token")), f"{name}-rarest")
    mixed = prefix.groupBy("token").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi").select("token")
    out = scratch.table(prefix.join(mixed, "token", "left_semi").select("node").distinct(), name)
    scratch.drop(f"{name}-registers", f"{name}-shared", f"{name}-rarest")
    return out


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.RecordBatch]:
    """Runs of rows with equal keys, as they stand; a run may go over several batches."""
    begun: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        k = np.stack([batch.column(c).to_numpy() for c in keys], 1)
        starts = [0, *(np.flatnonzero((k[1:] != k[:-1]).any(1)) + 1).tolist(), batch.num_rows]
        for lo, hi in zip(starts, starts[1:], strict=False):
            part = batch.slice(lo, hi - lo)
            if begun and any(begun[-1].column(c)[0] != part.column(c)[0] for c in keys):
                yield pa.concat_batches(begun) if len(begun) > 1 else begun[0]
                begun = []
            begun.append(part)
    if begun:
        yield pa.concat_batches(begun) if len(begun) > 1 else begun[0]


def _compare_blocks(group: pa.RecordBatch) -> list[tuple[int, int]]:
    """Links between members of different components: block i with block j of one bucket.

    Within the task, members that a found link has joined are not compared again.
    """
    ids, comp, block, size = (group.column(c).to_numpy() for c in ("node", "component", "block", "n"))
    if (comp == comp[0]).all():
        return []
    i, j = group.column("i")[0].as_py(), group.column("j")[0].as_py()
    regs, shingles = np.stack(_unpack(group.column("sketch"), np.uint16)), group.column("shingles")
    parent = {c: c for c in set(comp.tolist())}

    def find(c: int) -> int:
        while parent[c] != c:
            parent[c] = parent[parent[c]]
            c = parent[c]
        return c

    out = []
    rows, cols = np.flatnonzero(block == i), np.flatnonzero(block == j)
    for x in rows:
        ys = cols[(comp[cols] != comp[x]) & (DENOMINATOR * np.minimum(size[cols], size[x]) >= NUMERATOR * np.maximum(size[cols], size[x]))]
        ys = ys[ys > x] if i == j else ys
        if not len(ys):
            continue
        ys = ys[(regs[ys] == regs[x]).sum(1, dtype=np.uint16) >= EQUAL]
        if not len(ys):
            continue
        a, b = regs[x], regs[ys]
        near = ys[hopeful(likely_similarity((a > b).sum(1), (a < b).sum(1), np.full(len(ys), size[x]), size[ys]))]
        mine = np.frombuffer(shingles[x].as_py(), np.uint64)
        for y in near:
            if find(int(comp[x])) != find(int(comp[y])) and linked(mine, np.frombuffer(shingles[y].as_py(), np.uint64)):
                out.append((int(ids[x]), int(ids[y])))
                parent[find(int(comp[x]))] = find(int(comp[y]))
    return out


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for group in _groups(batches, ["key", "i", "j"]):
        if found := _compare_blocks(group):
            a, b = zip(*found, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
    give_back()


def _late_links(named: DataFrame, sets: DataFrame, scratch: Scratch, pairs_a_member: int) -> DataFrame:
    """Links between members other than the pivot that one bucket still has in several components."""

    def divided(rows: DataFrame) -> DataFrame:
        groups = rows.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("m"), F.sum("n").alias("all"))
        return groups.where("lo <> hi").select("key", "m", F.greatest(F.ceil(F.col("m") / BLOCK), F.ceil(F.col("all") / BLOCK_SHINGLES)).cast("int").alias("blocks"))

    others = named.where("node <> pivot and size > 2").select("key", "node", "component", "n")
    split = scratch.table(divided(others), "divided")
    open_rows = scratch.table(others.join(split, "key"), "open")
    members = open_rows.select("node", "component").distinct()
    pairs = split.agg(F.sum(F.col("m").cast("double") * F.col("m") / 2)).first()[0] or 0.0
    if pairs > pairs_a_member * members.count():
        alive = rare_sharers(members.join(sets.select("node", "shingles"), "node"), scratch, "rare")
        fewer = open_rows.drop("m", "blocks").join(alive, "node", "left_semi")
        open_rows = scratch.table(fewer.join(divided(fewer), "key"), "open-rare")
    dealt = open_rows.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    tasks = dealt.select("key", "node", "component", "block", other).select("key", "node", "component", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    loaded = tasks.join(sets, "node")
    return loaded.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j").mapInArrow(_compare, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", pairs_a_member: int = PAIRS_A_MEMBER) -> DataFrame:
    """One row per row of docs: id, n_shingles, component_id, kept, links.

    component_id is the smallest id reachable over links, kept marks that id. links counts
    the found links between classes of equal sets that touch the row's class. Texts without
    words, null ones too, are alone. Repeated rows are in their component, and rows that share
    an id but not the text count each by its own text; a null id has a row of its own with
    null component, kept. An empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    spark = docs.sparkSession
    scratch = Scratch(spark)
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("t"))
    sigs = scratch.table(base.mapInArrow(_signatures, "id long, n long, digest binary, bands array<long>"), "signatures")
    # Classes of equal sets, each a node.
    named = sigs.where("digest is not null and id is not null")
    classes = named.groupBy("digest").agg(F.min("id").alias("rep"), F.first("n").alias("n"), F.first("bands").alias("bands"))
    classes = scratch.table(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    keyed = classes.select("node", "n", F.explode("bands").alias("key"))
    buckets = scratch.table(keyed.groupBy("key").agg(F.min("node").alias("pivot"), F.count("*").alias("size")).where("size > 1"), "buckets")
    members = scratch.table(sift(keyed, buckets, "key", scratch, "in-bucket").join(buckets, "key"), "members")
    # Sets of classes that share a bucket, from the whole texts.
    wanted = scratch.table(members.select("node").distinct().join(classes.select("node", "n", "digest", F.col("rep").alias("id")), "node"), "wanted")
    sets = sift(base.where("id is not null"), wanted, "id", scratch, "wanted-ids").mapInArrow(_sets, "id long, digest binary, sketch binary, shingles binary")
    sets = scratch.table(sets.join(wanted, ["digest", "id"]).dropDuplicates(["digest", "id"]).select("node", "n", "sketch", "shingles"), "sets")
    # Each class with its smallest pivot, then with the pivots of buckets that are still divided.
    few = 1 + wanted.count() // EDGES_A_TASK  # links and labels are as many as these at most: few files
    first = members.where("node <> pivot").groupBy("node").agg(F.min("pivot").alias("a")).select("a", F.col("node").alias("b"))
    edges = scratch.table(_verified(first, sets).distinct().coalesce(few), "edges-1")
    label = scratch.table(components(edges, scratch, "c1").coalesce(few), "label-1")
    with_label = lambda: members.join(label.withColumnRenamed("id", "node"), "node", "left").withColumn("component", F.coalesce("component", "node"))
    head = label.toDF("pivot", "pivot_component")
    apart = with_label().where("node <> pivot").join(head, "pivot", "left").where("component <> coalesce(pivot_component, pivot)")
    pairs = apart.select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct().join(first, ["a", "b"], "left_anti")
    second = scratch.table(_verified(pairs, sets).distinct().coalesce(few), "edges-2")
    label = scratch.table(joined_labels(label, second, scratch, "c2").coalesce(few), "label-2")
    late = scratch.table(_late_links(with_label(), sets, scratch, pairs_a_member).coalesce(few), "edges-3")
    label = scratch.table(joined_labels(label, late, scratch, "c3").coalesce(few), "label")
    edges = edges.unionByName(second).unionByName(late).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    degree = edges.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count("*").alias("links"))
    tied = classes.select("node", "rep").join(label.withColumnRenamed("id", "node"), "node")
    least = tied.groupBy("component").agg(F.min("rep").alias("component_id"))
    tied = scratch.table(tied.join(least, "component").join(degree, "node", "left").select("node", "component_id", F.coalesce("links", F.lit(0)).alias("links")).coalesce(few), "tied")
    told = classes.select("digest", "node", "rep").join(tied, "node", "left").select("digest", F.coalesce("component_id", "rep").alias("component"), F.coalesce("links", F.lit(0).cast("long")).alias("links"))
    alone = sigs.where("digest is null or id is null").select("id", "n", F.col("id").alias("component"), F.lit(0).cast("long").alias("links"))
    out = scratch.table(named.select("id", "n", "digest").join(told, "digest").select("id", "n", "component", "links").unionByName(alone), "out")
    scratch.drop("signatures", "classes", "members", "wanted", "sets", "buckets", "edges-1", "edges-2", "edges-3", "open", "open-rare", "tied")
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"), F.col("id").eqNullSafe(F.col("component")).alias("kept"), "links")


def op9_setsketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("links")


OP9_SQL = None  # components need iteration; tests hold the query against brute force
