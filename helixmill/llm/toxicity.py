"""Toxicity by gradient-boosted trees over dense features, calibrated by isotonic regression.

Features of the whole text: densities of a fixed and of a learnt lexicon, how close lexicon
words stand to the second person, capitals, punctuation and obfuscation rates, length. The
learnt lexicon holds words that labelled toxic documents use far more often than others.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import UPPER, give_back, held_out, small_batches, text_slices
from .labelled import training_ids, training_texts

MAX_ROWS = 8000
#: The lexicon and the trees that calibrate a row's margin have not seen its fold.
FOLDS = 4
#: Learnt lexicon: at most so many words, each in at least so many labelled toxic documents, and in that share of them.
LEARNT_WORDS, LEARNT_DOCS, LEARNT_SHARE, LEARNT_RATIO = 200, 4, 0.01, 15.0
#: Fixed lexicon: insults in the languages of the corpus.
LEXICON = frozenset(
    """idiot idiots moron morons stupid dumb loser losers pathetic worthless trash scum disgusting clown clowns fool fools
    imbecile jerk filth vermin ugly hate hateful shut crap bastard freak garbage creep coward liar
    idiote imbécile stupide crétin ordure dégoûtant dummkopf trottel abschaum widerlich idiota estúpido imbécil basura asqueroso""".split()
)
SECOND_PERSON = frozenset("you your yours yourself u ur tu te toi vous votre vos du dich dir dein deine ihr euch usted ustedes tus vuestro".split())
NEAR = 5
FEATURES = ["fixed_rate", "fixed_count", "learnt_rate", "learnt_count", "distinct", "near_you", "you_rate", "capital_rate", "shout_rate", "bang_rate", "question_rate", "symbol_rate", "obfuscated_rate", "obfuscated_hits", "repeat_rate", "log_words"]
_LEET = str.maketrans("013457@$!", "oieastasi")
_EDGE = ".,;:!?\"'()[]{}|*#%&$~<>-_"


_SYMBOLS, _CAPITALS = b"#$%&*@^~|", UPPER.encode()
_MEMO_WORDS = 200_000


def classify(word: str) -> tuple[str, int, int, int, int]:
    """(plain form with look-alikes undone, in the fixed lexicon, second person, obfuscated, all capitals)."""
    low = word.lower()
    p = low.strip(_EDGE)
    q, odd = p, 0
    if p and not p.isalpha() and any(c.isalpha() for c in p):
        q = re.sub(r"[\W\d_]", "", p.translate(_LEET))
        odd = int(not p.replace("-", "").replace("'", "").isalpha())
    elif low[:1] in "$@!" and low[1:2].isalpha() and (undone := re.sub(r"[\W\d_]", "", low.rstrip(_EDGE).translate(_LEET))) in LEXICON:
        q, odd = undone, 1
    return q, int(q in LEXICON), int(p in SECOND_PERSON), odd, int(len(p) > 2 and word.isupper())


def features(text: str, learnt: frozenset[str], memo: dict | None = None) -> list[float]:
    """FEATURES of a whole text. memo keeps classified words between texts; it is emptied when it grows large."""
    memo = {} if memo is None else memo
    if len(memo) > _MEMO_WORDS:
        memo.clear()
    words = text.split()
    n = max(1, len(words))
    counts = Counter(words)
    fixed = learnt_n = you = odd = odd_hits = shout = 0
    seen, hits, yours = set(), set(), set()
    for w, c in counts.items():
        if (kind := memo.get(w)) is None:
            kind = memo[w] = classify(w)
        q, fx, y, o, up = kind
        odd += c * o
        shout += c * up
        if y:
            you += c
            yours.add(w)
        if fx or q in learnt:
            fixed += c * fx
            learnt_n += c * (q in learnt)
            odd_hits += c * o
            seen.add(q)
            hits.add(w)
    near = 0
    if hits and yours:
        a, b = (np.array([i for i, w in enumerate(words) if w in group]) for group in (hits, yours))
        k = np.searchsorted(b, a)
        gap = np.minimum(np.abs(a - b[np.minimum(k, len(b) - 1)]), np.abs(a - b[np.maximum(k - 1, 0)]))
        near = int((gap <= NEAR).sum())
    raw = text.encode("utf-8", "surrogatepass")
    size = max(1, len(raw))
    return [
        fixed / n, min(fixed, 50), learnt_n / n, min(learnt_n, 50), len(seen), near / n, you / n, (len(raw) - len(raw.translate(None, _CAPITALS))) / size, shout / n,
        text.count("!") / n, text.count("?") / n, (len(raw) - len(raw.translate(None, _SYMBOLS))) / size, odd / n, min(odd_hits, 50), 1 - len(counts) / n if words else 0.0, math.log1p(len(words)),
    ]


class BoostedTrees:
    """Logistic loss, depth-limited trees over quantile bins."""

    def __init__(self, rounds: int = 60, depth: int = 3, rate: float = 0.15, bins: int = 32, l2: float = 2.0, least: float = 4.0):
        self.rounds, self.depth, self.rate, self.bins, self.l2, self.least = rounds, depth, rate, bins, l2, least

    def fit(self, x: np.ndarray, y: np.ndarray) -> BoostedTrees:
        self.cuts = [np.unique(np.quantile(c, np.linspace(0, 1, self.bins + 1)[1:-1])) for c in x.T]
        binned = self._bin(x)
        p = min(max(float(y.mean()), 1e-3), 1 - 1e-3)
        self.start, self.trees = math.log(p / (1 - p)), []
        margin = np.full(len(y), self.start)
        for _ in range(self.rounds):
            prob = 1 / (1 + np.exp(-margin))
            tree = self._grow(binned, prob - y, prob * (1 - prob))
            self.trees.append(tree)
            margin += self._apply(tree, binned)
        return self

    def _bin(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(c, v, "right") for c, v in zip(self.cuts, x.T, strict=True)], 1) if len(x) else np.zeros(x.shape, np.int64)

    def _grow(self, b: np.ndarray, g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        size = 2 ** (self.depth + 1) - 1
        feature, cut, value, node = np.full(size, -1), np.zeros(size, int), np.zeros(size), np.zeros(len(g), int)
        for at in range(size):
            rows = np.flatnonzero(node == at)
            sg, sh = g[rows].sum(), h[rows].sum()
            value[at] = -self.rate * sg / (sh + self.l2)
            if at >= 2**self.depth - 1 or len(rows) < 2:
                continue
            best = (1e-6, -1, 0)
            for f in range(b.shape[1]):
                hist = [np.cumsum(np.bincount(b[rows, f], w, self.bins))[:-1] for w in (g[rows], h[rows])]
                gain = hist[0] ** 2 / (hist[1] + self.l2) + (sg - hist[0]) ** 2 / (sh - hist[1] + self.l2) - sg**2 / (sh + self.l2)
                gain[(hist[1] < self.least / 10) | (sh - hist[1] < self.least / 10)] = 0
                k = int(gain.argmax())
                if gain[k] > best[0]:
                    best = (float(gain[k]), f, k)
            if best[1] >= 0:
                feature[at], cut[at] = best[1], best[2]
                node[rows] = 2 * at + 1 + (b[rows, best[1]] > best[2])
        return feature, cut, value

    @staticmethod
    def _apply(tree: tuple[np.ndarray, np.ndarray, np.ndarray], b: np.ndarray) -> np.ndarray:
        feature, cut, value = tree
        node = np.zeros(len(b), int)
        while len(go := np.flatnonzero(feature[node] >= 0)):
            at = node[go]
            node[go] = 2 * at + 1 + (b[go, feature[at]] > cut[at])
        return value[node]

    def margins(self, x: np.ndarray) -> np.ndarray:
        b = self._bin(x)
        return self.start + sum((self._apply(t, b) for t in self.trees), np.zeros(len(x)))


class Isotonic:
    """Pool-adjacent-violators; between knots it interpolates, beyond them it stays."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        order = np.argsort(x, kind="stable")
        blocks: list[list[float]] = []  # mean, weight, first x, last x
        for a, b in zip(x[order], y[order], strict=True):
            blocks.append([float(b), 1.0, float(a), float(a)])
            while len(blocks) > 1 and (blocks[-2][0] >= blocks[-1][0] or blocks[-2][3] == blocks[-1][2]):
                m, w, _, last = blocks.pop()
                blocks[-1] = [(blocks[-1][0] * blocks[-1][1] + m * w) / (blocks[-1][1] + w), blocks[-1][1] + w, blocks[-1][2], last]
        self.x = np.array([v for m, w, a, b in blocks for v in (a, b)])
        self.y = np.array([v for m, w, a, b in blocks for v in ((m * w + 0.5 * 0.2) / (w + 0.2),) * 2])
        self.y = np.maximum.accumulate(self.y) if len(self.y) else self.y

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return np.interp(x, self.x, self.y) if len(self.x) else np.full(len(x), 0.5)


def out_of_fold_margins(xs: list[np.ndarray], y: np.ndarray, fold: np.ndarray) -> np.ndarray:
    """Margins of trees that have not seen the row's fold; xs[k] are all rows' features under the lexicon learnt without fold k."""
    out = np.zeros(len(y))
    for k in range(FOLDS):
        out[fold == k] = BoostedTrees().fit(xs[k][fold != k], y[fold != k]).margins(xs[k][fold == k])
    return out


class ToxicityModel:
    """xs: features under each fold's lexicon, then under that of all rows, which is learnt."""

    def __init__(self, xs: list[np.ndarray], y: np.ndarray, fold: np.ndarray, learnt: frozenset[str]):
        self.learnt, self.fixed_score = learnt, float(y.mean()) if len(y) else 0.0
        self.trees = self.calibrate = None
        if len(y) >= 20 and 0 < y.sum() < len(y):
            self.calibrate = Isotonic(out_of_fold_margins(xs, y, fold), y.astype(float))
            self.trees = BoostedTrees().fit(xs[FOLDS], y)

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.trees is None:
            return np.full(len(x), self.fixed_score)
        return np.clip(self.calibrate(self.trees.margins(x)), 0, 1)

    def score_texts(self, texts: list[str | None]) -> np.ndarray:
        memo: dict = {}
        return self.scores(np.array([features(t or "", self.learnt, memo) for t in texts]).reshape(len(texts), len(FEATURES)))


def _featurise(lexicons: list[frozenset[str]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: dict = {}
        for batch in batches:
            texts = batch.column("t")
            x = [[v for lexicon in lexicons for v in features(t, lexicon, memo)] for lo, n in text_slices(texts) for t in texts.slice(lo, n).to_pylist()]
            give_back()
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "y", "fold")), pa.array(x, pa.list_(pa.float64()))], ["doc_id", "y", "fold", "x"])

    return run


def learn_lexicons(texts: DataFrame, share: float = LEARNT_SHARE, ratio: float = LEARNT_RATIO) -> list[frozenset[str]]:
    """For each fold of texts (t, y, fold) the words learnt without it, then those learnt from all rows.

    A word is learnt where its share among toxic documents is so many times that among others.
    """
    words = texts.select("y", "fold", F.explode(F.array_distinct(F.regexp_extract_all(F.lower("t"), F.lit(r"([\p{L}]{3,})"), 1))).alias("word"))
    of = lambda y, k: F.sum(((F.col("y") == y) & (F.col("fold") != k)).cast("long"))  # noqa: E731  fold FOLDS has no rows
    counts = [of(y, k).alias(f"n{y}_{k}") for y in (0, 1) for k in range(FOLDS + 1)]
    total = texts.agg(*counts).first()
    fits = {k: (F.col(f"n1_{k}") >= max(LEARNT_DOCS, share * total[f"n1_{k}"])) & (F.col(f"n1_{k}") / total[f"n1_{k}"] >= ratio * (F.col(f"n0_{k}") + 1) / total[f"n0_{k}"]) for k in range(FOLDS + 1) if total[f"n1_{k}"] and total[f"n0_{k}"]}
    if not fits:
        return [frozenset()] * (FOLDS + 1)
    rows = words.groupBy("word").agg(*counts).where(reduce(or_, fits.values())).collect()  # of a bounded sample
    out = []
    for k in range(FOLDS + 1):
        p, n = total[f"n1_{k}"] or 0, total[f"n0_{k}"] or 0
        rate = {r["word"]: (r[f"n1_{k}"] / p) / ((r[f"n0_{k}"] + 1) / n) for r in rows if k in fits and r[f"n1_{k}"] >= max(LEARNT_DOCS, share * p)}
        out.append(frozenset(sorted((w for w in rate if rate[w] >= ratio), key=lambda w: (-rate[w], w))[:LEARNT_WORDS]))  # noqa: B023
    return out


def labelled_features(docs: DataFrame, labels: DataFrame, target: str, max_rows: int, **limits) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, list[frozenset[str]]]:
    """Features under each lexicon, labels, folds and lexicons of at most max_rows labelled documents outside the held-out third."""
    texts = training_texts(docs, training_ids(docs, labels, target, max_rows)).withColumn("fold", F.pmod(F.xxhash64("doc_id", F.lit(29)), F.lit(FOLDS)).cast("int"))
    lexicons = learn_lexicons(texts, **limits)
    rows = texts.mapInArrow(_featurise(lexicons), "doc_id long, y int, fold int, x array<double>").toArrow().sort_by("doc_id").combine_chunks()
    x = np.array(rows["x"].to_pylist(), float).reshape(len(rows), len(lexicons), len(FEATURES))
    return [x[:, k] for k in range(len(lexicons))], rows["y"].to_numpy().astype(np.int64), rows["fold"].to_numpy(), lexicons


def fit_toxicity(docs: DataFrame, labels: DataFrame, target: str = "toxic", max_rows: int = MAX_ROWS) -> ToxicityModel:
    """Fits on at most max_rows labelled documents; the driver gets their features, not their texts."""
    xs, y, fold, lexicons = labelled_features(docs, labels, target, max_rows)
    return ToxicityModel(xs, y, fold, lexicons[FOLDS])


def toxicity_score(spark: SparkSession, model: ToxicityModel, text: Column) -> Column:
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf(T.DoubleType())
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            scores = [shared.value.score_texts(texts.slice(lo, n).to_pylist()) for lo, n in text_slices(texts)]
            give_back()
            yield pa.array(np.concatenate(scores) if scores else [], pa.float64())

    return score(F.coalesce(text, F.lit("")))


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, target: str = "toxic", max_rows: int = MAX_ROWS) -> DataFrame:
    """docs with score and predicted (1 if score >= threshold) added, replacing columns of those names.

    Null and empty texts are scored like a text without any word. With fewer than 20 labelled
    rows, or one class only, the score is the share of label 1. An empty table stays empty;
    repeated rows get equal scores.
    """
    model = fit_toxicity(docs, labels, target, max_rows)
    return docs.withColumn("score", toxicity_score(docs.sparkSession, model, F.col("text"))).withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity of every document."""
    docs, labels = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = toxicity(docs.select("doc_id", "text"), labels)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
