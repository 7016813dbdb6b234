"""Shared pieces of the training-data operators: scratch tables and a fixed-size key filter."""

from __future__ import annotations

import atexit
import ctypes
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_roots: list[tuple[SparkSession, str]] = []


def ascii_lower(text: Column) -> Column:
    """Null counts as empty; only A-Z change."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, UPPER.lower())


def held_out(doc_id: Column) -> Column:
    """True where crc32 of the id as text leaves 1 modulo 3; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir, or one of our own where that is unset and all run on this machine."""
    if at := spark.sparkContext.getConf().get("spark.checkpoint.dir", None):
        return at.rstrip("/")
    known = spark.sparkContext._jsc.sc().getCheckpointDir()
    if known.isDefined():
        return known.get()
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    spark.sparkContext.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="helixmill-"))
    return spark.sparkContext._jsc.sc().getCheckpointDir().get()


def _delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(p, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(p)


class Scratch:
    """Tables written to the shared folder, so that a lost executor costs no recomputation.

    table() cuts the lineage; drop() frees what is no longer read. What is left goes when
    the driver ends.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.root = spark, f"{shared_folder(spark)}/helixmill-{uuid.uuid4().hex}"
        if not _roots:
            atexit.register(_clean)
        _roots.append((spark, self.root))

    def table(self, df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{self.root}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.root}/{name}")

    def drop(self, *names: str) -> None:
        for name in names:
            _delete(self.spark, f"{self.root}/{name}")


def publish(scratch: Scratch, name: str, data: bytes) -> str:
    """Writes data to the shared folder and has Spark hand it to every executor; its name for SparkFiles."""
    spark, name = scratch.spark, f"{uuid.uuid4().hex}-{name}"
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{scratch.root}/{name}")
    files = p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    out = files.create(p)
    for lo in range(0, len(data), 1 << 22):
        out.write(bytearray(data[lo : lo + (1 << 22)]))
    out.close()
    spark.sparkContext.addFile(files.makeQualified(p).toString())
    return name


def _clean() -> None:
    for spark, root in _roots:
        try:
            _delete(spark, root)
        except Exception:  # the session may have ended first
            return


def runs(sizes: np.ndarray, rows: int, size: int) -> Iterator[tuple[int, int]]:
    """(start, length) of runs of at most so many rows, and of so much size unless one row alone has more."""
    ends, at = np.cumsum(sizes), 0
    while at < len(ends):
        full = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + size, "right"))
        stop = min(at + rows, max(at + 1, full), len(ends))
        yield at, stop - at
        at = stop


def text_slices(texts: pa.Array, rows: int = 512, size: int = 1 << 22) -> Iterator[tuple[int, int]]:
    """Runs of texts by their bytes: so few become Python objects that a worker's need depends on the longest text, not on the batch."""
    return runs(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64), rows, size)


#: Bytes of an Arrow batch of texts: a task holds one on either side.
BATCH_BYTES = 8 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Has the session's Arrow batches be of BATCH_BYTES at most, where it lets them be larger.

    By rows alone a batch of long texts is a whole partition.
    """
    if int(spark.conf.get(_BATCH).rstrip("b")) > BATCH_BYTES:
        spark.conf.set(_BATCH, f"{BATCH_BYTES}b")


_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)


def give_back() -> None:
    """Freed memory goes back to the system; a Python worker outlives its task, and with it would its peak."""
    pa.default_memory_pool().release_unused()
    if _trim:
        _trim(0)


def key_bitmap(keys: DataFrame, key: str, bits: int) -> DataFrame:
    """2^bits bits in rows of 512 words; the bit of each key's hash is set.

    Of fixed size whatever the number of keys: 2^bits / 8 bytes at most.
    """
    place = F.pmod(F.xxhash64(key), F.lit(1 << bits)) + 1
    words = F.expr("transform(sequence(0, 511), i -> cast(conv(hex(substring(bm, i * 8 + 1, 8)), 16, -10) as bigint))")
    return (
        keys.select(place.alias("place"))
        .groupBy(F.bitmap_bucket_number("place").alias("bm_bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bm"))
        .select("bm_bucket", words.alias("bm_words"))
    )


def with_maybe(rows: DataFrame, key: str, bitmap: DataFrame, bits: int, flag: str) -> DataFrame:
    """Adds flag: true for every row whose key is among the bitmap's, and for few others.

    The bitmap is broadcast; its size is fixed by bits. Large columns of rows don't move.
    """
    place = F.pmod(F.xxhash64(key), F.lit(1 << bits))
    bit, byte = place % 8, F.floor(place / 8) % 4096
    hit = F.expr("getbit(bm_words[cast(bm_word as int)], cast(bm_shift as int)) = 1")
    return (
        rows.withColumns({"bm_bucket": F.bitmap_bucket_number(place + 1), "bm_word": F.floor(byte / 8), "bm_shift": (7 - byte % 8) * 8 + bit})
        .join(F.broadcast(bitmap), "bm_bucket", "left")
        .withColumn(flag, F.coalesce(hit, F.lit(False)))
        .drop("bm_bucket", "bm_word", "bm_shift", "bm_words")
    )


#: A key filter has so many bits for each key, and at most 2^MAX_BITS of them in all (16 MB).
BITS_A_KEY, MIN_BITS, MAX_BITS = 16, 16, 27


def filter_bits(n_keys: int) -> int | None:
    """Bits of a filter for so many keys, as a power of two; None beyond the largest."""
    bits = max(MIN_BITS, (BITS_A_KEY * max(1, n_keys) - 1).bit_length())
    return bits if bits <= MAX_BITS else None


def without(rows: DataFrame, gone: DataFrame, key: str, scratch: Scratch, name: str) -> DataFrame:
    """rows whose key, never null, isn't in gone (key). Only rows that the filter can't tell are shuffled."""
    if (bits := filter_bits(gone.count())) is None:
        return rows.join(gone, key, "left_anti").select(*rows.columns)
    marked = with_maybe(rows, key, scratch.table(key_bitmap(gone, key, bits), name), bits, "bm_maybe")
    perhaps = marked.where("bm_maybe").select(*rows.columns).join(gone, key, "left_anti").select(*rows.columns)
    return marked.where("not bm_maybe").select(*rows.columns).unionByName(perhaps)


def sift(rows: DataFrame, keys: DataFrame, key: str, scratch: Scratch, name: str) -> DataFrame:
    """rows without most of those whose key isn't among keys; a join decides about the others.

    The filter is broadcast, sized by a count of the keys. For more keys than the largest
    one is good for, rows stay as they are and the join has all the work.
    """
    if (bits := filter_bits(keys.count())) is None:
        return rows
    bitmap = scratch.table(key_bitmap(keys, key, bits), name)
    return with_maybe(rows, key, bitmap, bits, "bm_maybe").where("bm_maybe").drop("bm_maybe")
