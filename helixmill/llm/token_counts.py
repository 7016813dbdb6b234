"""Token counts behind a digest cache.

A text's key is the SHA-256 of its UTF-8 bytes (null: empty) under a digest of the
tokenizer's file and library version. Stored counts are joined by key; each distinct text
that has none is encoded once and its count appended to the cache.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, filter_bits, give_back, key_bitmap, path_exists, shared_folder, small_batches, text_slices, with_maybe

CACHE_SCHEMA = "digest string, n_tokens long"
#: Up to so many missing digests (64 bytes each) are broadcast to keep texts with stored counts out of the shuffle.
BROADCAST_MISSES = 100_000


def tokenizer_version(model: bytes) -> str:
    import sentencepiece

    return hashlib.sha256(model + b"|sentencepiece " + sentencepiece.__version__.encode()).hexdigest()[:32]


def token_counts(
    docs: DataFrame, model: bytes, cache_path: str, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per row of docs: id, n_bytes, n_tokens; the cache at cache_path grows by what it lacked.

    Null text counts as empty and has no tokens. Repeated rows are counted each but encoded
    once. Two writers at once can append a key twice, so a key is read once.
    """
    small_batches(docs.sparkSession)
    spark = docs.sparkSession
    path = f"{cache_path.rstrip('/')}/{tokenizer_version(model)}"
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = docs.select(F.col(id_col), text.alias("t"), F.sha2(text.cast("binary"), 256).alias("digest"))
    have = path_exists(spark, path)
    stored = spark.read.schema(CACHE_SCHEMA).parquet(path) if have else None
    wanted = keyed.select("digest", "t")
    if have:
        missing = keyed.select("digest").distinct().join(stored, "digest", "left_anti")
        few = missing.limit(BROADCAST_MISSES + 1).count()
        wanted = wanted.join(F.broadcast(missing), "digest", "left_semi") if few <= BROADCAST_MISSES else wanted.join(stored, "digest", "left_anti")
    else:
        few = 1
    if few:
        _once(wanted, Scratch(spark)).mapInArrow(_counter(spark.sparkContext.broadcast(model)), CACHE_SCHEMA).write.mode("append").parquet(path)
    counts = spark.read.schema(CACHE_SCHEMA).parquet(path).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))
    compact = keyed.select(id_col, "digest", F.octet_length("t").cast("long").alias("n_bytes"))
    return compact.join(counts, "digest").select(id_col, "n_bytes", "n_tokens")


def _once(texts: DataFrame, scratch: Scratch) -> DataFrame:
    """Each distinct text of texts (digest, t) once. Digests move; a text does only where a filter of the repeated ones can't tell it from them."""
    twice = scratch.table(texts.groupBy("digest").agg(F.count("*").alias("n")).where("n > 1").select("digest"), "twice")
    one = lambda df: df.groupBy("digest").agg(F.first("t").alias("t"))  # noqa: E731  copies meet within a task first
    if (bits := filter_bits(twice.count())) is None:
        return one(texts)
    marked = with_maybe(texts, "digest", scratch.table(key_bitmap(twice, "digest", bits), "twice-bits"), bits, "bm_maybe")
    return marked.where("not bm_maybe").select("digest", "t").unionByName(one(marked.where("bm_maybe")))


def _counter(model):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_proto=model.value)
        for batch in batches:
            texts = batch.column("t")
            n = [len(sp.encode(t, num_threads=1)) for lo, size in text_slices(texts) for t in texts.slice(lo, size).to_pylist()]
            give_back()
            yield pa.RecordBatch.from_arrays([batch.column("digest"), pa.array(n, pa.int64())], ["digest", "n_tokens"])

    return count


def op8_token_counts(spark: SparkSession, sf_dir: str, model_path: str | None = None, limit: int = 4096) -> DataFrame:
    """Tokens of every document. The cache starts empty, so that a call's cost doesn't depend on earlier ones."""
    import public_tokenizers

    with open(model_path or public_tokenizers.path("piece_bpe_32k.model"), "rb") as f:
        model = f.read()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = token_counts(docs, model, f"{shared_folder(spark)}/token-cache-{uuid.uuid4().hex}")
    return out.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
