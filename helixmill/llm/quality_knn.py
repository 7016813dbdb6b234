"""Quality by nearest-neighbour voting in a latent-semantic space.

Terms are hashed byte trigrams, runs of character classes and word repetitions of the whole
text. TF-IDF of the labelled sample is reduced by a truncated SVD; the labelled vectors, of
fixed number and width, go to every task. There each block of documents is projected and
multiplied with all of them: exact cosines, whose nearest vote with their similarity.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import give_back, held_out, small_batches, text_slices
from .labelled import training_ids, training_texts

#: Bound of the labelled sample, and so of what is broadcast: MAX_ROWS x RANK floats.
MAX_ROWS = 3000
RANK = 96
NEIGHBOURS = 25
POWER = 6
GRAMS, SHAPES, REPEATS = 4096, 2048, 24
TERMS = GRAMS + SHAPES + REPEATS
BLOCK = 512
PIECE = 1 << 20

_CLASS = np.full(256, 15, np.uint32)
for _k, _s in enumerate([b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" ", b"\n\r", b".,;:", b"!", b"?", b"|", b"#$%&*@^~", b"<>/\\", b"()[]{}", b"'\"`-_", b"=+"]):
    _CLASS[list(_s)] = _k
_CLASS[128:] = 0


def term_counts(text: str) -> np.ndarray:
    """Counts of all terms of a whole text; long ones go in pieces that overlap by what a term spans."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    out = np.zeros(TERMS, np.float32)
    for lo in range(0, len(raw), PIECE):
        b = raw[lo : lo + PIECE + 3].astype(np.uint32)
        if len(b) >= 3:
            g = (b[:-2] * 2654435761 + b[1:-1] * 40503 * 65537 + b[2:] * 2246822519)[:PIECE]
            out[:GRAMS] += np.bincount((g >> 15) % GRAMS, minlength=GRAMS)
        if len(b) >= 4:
            c = _CLASS[raw[lo : lo + PIECE + 3]]
            s = (((c[:-3] * 16 + c[1:-2]) * 16 + c[2:-1]) * 16 + c[3:])[:PIECE]
            out[GRAMS : GRAMS + SHAPES] += np.bincount((s * 2654435761 >> 11) % SHAPES, minlength=SHAPES)
    words = text.split()
    n = len(words)
    if n:
        rates = [
            sum(a == b for a, b in zip(words, words[1:], strict=False)) / n,
            1 - len(set(words)) / n,
            1 - len(lines := set(text.split("\n"))) / (text.count("\n") + 1) if text else 0.0,
            sum(a == b for a, b in zip(words, words[2:], strict=False)) / n,
        ]
        del lines
        for k, r in enumerate(rates):
            out[GRAMS + SHAPES + 6 * k + min(5, int(r * 10))] += n / 4
    return out


class LatentVoter:
    """TF-IDF, its singular vectors and the labelled vectors."""

    def __init__(self, counts: np.ndarray, y: np.ndarray, rank: int = RANK, neighbours: int = NEIGHBOURS):
        self.prior, self.neighbours = float(y.mean()) if len(y) else 0.5, neighbours
        self.idf = np.log((1 + len(y)) / (1 + (counts > 0).sum(0))).astype(np.float32) + 0.1
        x = self._weigh(counts)
        rank = min(rank, *x.shape) if len(y) else 0
        g = np.random.default_rng(5).standard_normal((x.shape[1], rank + min(16, max(0, x.shape[0] - rank)))).astype(np.float32)
        q = x @ g
        for _ in range(3):
            q = x @ (x.T @ np.linalg.qr(q)[0])
        _, _, v = np.linalg.svd(np.linalg.qr(q)[0].T @ x, full_matrices=False) if len(y) else (0, 0, np.zeros((0, TERMS)))
        self.basis = np.ascontiguousarray(v[:rank].T, np.float32)
        self.vectors, self.y = self._unit(x @ self.basis), y.astype(np.float32)

    @staticmethod
    def _unit(x: np.ndarray) -> np.ndarray:
        n = np.linalg.norm(x, axis=1, keepdims=True)
        return np.divide(x, n, out=np.zeros_like(x), where=n > 0)

    def _weigh(self, counts: np.ndarray) -> np.ndarray:
        x = np.log1p(counts)
        x *= self.idf
        n = np.linalg.norm(x, axis=1, keepdims=True)
        return np.divide(x, n, out=x, where=n > 0)

    def scores(self, counts: np.ndarray) -> np.ndarray:
        """The share of label 1 among the nearest, weighted by cosine; the prior where nothing is similar."""
        near = self._unit(self._weigh(counts) @ self.basis)
        out = np.full(len(counts), self.prior)
        k = min(self.neighbours, len(self.y))
        if not k:
            return out
        for lo in range(0, len(near), BLOCK):
            cos = near[lo : lo + BLOCK] @ self.vectors.T
            top = np.argpartition(-cos, k - 1, axis=1)[:, :k]
            w = np.maximum(np.take_along_axis(cos, top, 1), 0).astype(np.float64) ** POWER
            total = w.sum(1)
            out[lo : lo + BLOCK] = np.divide((w * self.y[top]).sum(1), total, out=np.full(len(w), self.prior), where=total > 1e-12)
        return np.clip(out, 0, 1)

    def score_texts(self, texts: list[str | None]) -> np.ndarray:
        return np.concatenate([self.scores(np.stack([term_counts(t or "") for t in texts[lo : lo + BLOCK]])) for lo in range(0, len(texts), BLOCK)] or [np.zeros(0)])


def _sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [(lambda c: (np.flatnonzero(c).astype(np.int32), c[c > 0]))(term_counts(t)) for t in batch.column("t").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("y"), pa.array([i for i, _ in found], pa.list_(pa.int32())), pa.array([v for _, v in found], pa.list_(pa.float32()))], ["doc_id", "y", "i", "v"]
        )


def fit_quality(docs: DataFrame, labels: DataFrame, target: str = "quality", max_rows: int = MAX_ROWS) -> LatentVoter:
    """Fits on at most max_rows labelled documents; their sparse counts come to the driver, texts don't."""
    sample = training_texts(docs, training_ids(docs, labels, target, max_rows)).mapInArrow(_sparse, "doc_id long, y int, i array<int>, v array<float>")
    rows = sample.toArrow().sort_by("doc_id").combine_chunks()  # lists of numbers stay packed
    counts = np.zeros((len(rows), TERMS), np.float32)
    for k, (i, v) in enumerate(zip(rows["i"], rows["v"], strict=True)):
        counts[k, i.values.to_numpy()] = v.values.to_numpy()
    return LatentVoter(counts, rows["y"].to_numpy().astype(np.int64))


def quality_score(spark: SparkSession, model: LatentVoter, text: Column) -> Column:
    """The score of a text column, as a column: other columns stay as they are and don't reach Python."""
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf(T.DoubleType())
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            scores = [shared.value.score_texts(texts.slice(lo, n).to_pylist()) for lo, n in text_slices(texts, BLOCK)]
            give_back()
            yield pa.array(np.concatenate(scores) if scores else [], pa.float64())

    return score(F.coalesce(text, F.lit("")))


def quality_classifier(
    docs: DataFrame, labels: DataFrame, threshold: float = 0.5, target: str = "quality", max_rows: int = MAX_ROWS,
    score_col: str = "score", predicted_col: str = "predicted",
) -> DataFrame:
    """docs with score_col and predicted_col (1 if the score >= threshold) added, replacing columns of those names.

    Null and empty texts get the share of label 1 in the sample, as does all without labels
    (then 0.5). An empty table stays empty; repeated rows get equal scores.
    """
    model = fit_quality(docs, labels, target, max_rows)
    scored = docs.withColumn(score_col, quality_score(docs.sparkSession, model, F.col("text")))
    return scored.withColumn(predicted_col, (F.col(score_col) >= threshold).cast("int"))


def op10_quality_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality of every document."""
    docs, labels = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = quality_classifier(docs.select("doc_id", "text"), labels)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
