"""Quality classifier: hashed word n-gram logistic regression with follow-the-regularised-leader updates."""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .common import Seen, fold, map_batches, table, texts

DIM_BITS = 18
#: At most so many labelled rows are fitted, those with the lowest hash of their id; all rows are scored.
SAMPLE = 20_000
SHARDS, EPOCHS, THRESHOLD, FOLDS = 8, 5, 0.3, 5
_LETTERS, _DIGIT, _RUN = re.compile(r"[^\W\d_]+"), re.compile(r"\d+"), re.compile(r"(.)\1+")

_hash = xxhash.xxh3_64_intdigest


def shape(word: str) -> str:
    """The word's outline: A for all capitals, Aa, a, 0 for digits; other signs stay, repeated ones as two."""
    body = word.rstrip(",.")
    if body.islower() and body.isalpha():
        return "a" + _RUN.sub(r"\1\1", word[len(body) :])
    letters = _LETTERS.sub(lambda m: "A" if m[0].isupper() and len(m[0]) > 1 else "C" if m[0][0].isupper() else "a", word)
    return _RUN.sub(r"\1\1", _DIGIT.sub("0", letters))


class Features:
    """Slots of a text's word 1- and 2-grams and of its outlines' 1- to 3-grams. The outline of a word that repeats the one
    before it is a sign of its own."""

    def __init__(self, bits: int = DIM_BITS):
        self.shift, self.seen, self.hashes = np.uint64(64 - bits), Seen(), np.zeros((1 << 12, 2), np.uint64)

    def __call__(self, text: str | None) -> list[np.ndarray]:
        words = (text or "").split()
        if not words:
            return []
        seen = self.seen
        new, at = seen.missing(words), len(seen)
        if new:
            while at + len(new) > len(self.hashes):
                self.hashes = np.concatenate([self.hashes, np.zeros_like(self.hashes)])
            self.hashes[at : at + len(new), 0] = [_hash(w.lower()) for w in new]
            self.hashes[at : at + len(new), 1] = [_hash(shape(w)) for w in new]
            seen.update(zip(new, range(at, at + len(new)), strict=True))
        both = self.hashes[np.fromiter(map(seen.__getitem__, words), np.int64, len(words))]
        both[1:, 1][both[1:, 0] == both[:-1, 0]] = 1
        out = []
        for column, most in ((both[:, 0], 2), (both[:, 1], 3)):
            gram = column
            for n in range(1, most + 1):
                if n > 1:
                    if len(gram) < 2:
                        break
                    gram = gram[:-1] * np.uint64(0x9E3779B97F4A7C15) + column[n - 1 :] * np.uint64(0xC2B2AE3D27D4EB4F)
                out.append((gram ^ (gram >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> self.shift)
        return out


@dataclass
class Ftrl:
    """Per-coordinate FTRL-proximal for logistic loss."""

    scale = 8.0
    bits: int = DIM_BITS
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 0.002
    l2: float = 0.001

    def __post_init__(self):
        self.z, self.n = np.zeros((1 << self.bits) + 1), np.zeros((1 << self.bits) + 1)

    def weights(self, at: np.ndarray | slice = slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        return np.where(np.abs(z) <= self.l1, 0.0, -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2))

    def sparse(self, grams: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Slots (the last one is the constant) and values: for each kind of n-gram, `scale` times its share of the text."""
        at, x = [np.array([1 << self.bits])], [np.ones(1)]
        for g in grams:
            slot, tf = np.unique(g, return_counts=True)
            at.append(slot.astype(np.int64))
            x.append(self.scale * tf / len(g))
        return np.concatenate(at), np.concatenate(x)

    def learn(self, grams: list[np.ndarray], label: int) -> None:
        at, x = self.sparse(grams)
        w = self.weights(at)
        g = (1 / (1 + np.exp(-np.clip(w @ x, -35, 35))) - label) * x
        # A slot that two kinds share adds both gradients.
        at, back = np.unique(at, return_inverse=True)
        g = np.bincount(back, g)
        w = self.weights(at)
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[at] = n + g * g


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, shards: int = SHARDS, epochs: int = EPOCHS, folds: int = FOLDS, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> np.ndarray:
    """Weights, of fixed size. Learns from labelled rows whose fold is not 0, at most `sample` of them; each of `shards` tasks
    runs its own updates over its share and the weights' mean is taken, so no task or driver sees more than a share of a
    bounded sample. Rows with a null label or id aren't learnt from; without any label all weights are 0 (score 0.5). An id with
    several labels has the highest, one with several texts is learnt from that of the lowest hash, once."""
    ids = labels.select(labels[id_col].cast("long").alias("doc_id"), labels[label_col].cast("int").alias("label")).where(
        F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & (fold(F.col("doc_id"), folds) != 0)
    )
    # The sample is a set of ids of a bounded size and can be broadcast.
    ids = ids.groupBy("doc_id").agg(F.max("label").alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = texts(docs, id_col, text_col).join(F.broadcast(ids), "doc_id").groupBy("doc_id", "label").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("one")).select("doc_id", "label", "one.text")

    def fit(own):
        model, features = Ftrl(), Features()
        # A share of a bounded sample; texts are hashed at once.
        seen = [
            (xxhash.xxh3_64_intdigest(str(i)), label, [g.astype(np.int32) for g in features(text)])
            for i, text, label in zip(*(own.column(k).to_pylist() for k in ("doc_id", "text", "label")), strict=True)
        ]
        seen.sort(key=lambda x: (x[0], x[1], sum(map(len, x[2]))))
        for epoch in range(epochs):
            for _, label, grams in seen[:: -1 if epoch % 2 else 1]:
                model.learn(grams, label)
        w = model.weights()
        at = np.flatnonzero(w)
        return pa.table({"slot": pa.array([-1, *at.tolist()], pa.int32()), "w": pa.array([1.0, *w[at].tolist()])})

    # As many groups as shards, however many partitions there are.
    shard = F.pmod(F.xxhash64("doc_id"), F.lit(shards)).alias("shard")
    fitted = rows.groupBy(shard).applyInArrow(fit, "slot int, w double")
    out = np.zeros((1 << DIM_BITS) + 1)
    sums = {r.slot: r.w for r in fitted.groupBy("slot").agg(F.sum("w").alias("w")).collect()}  # at most 2^18 + 2 rows
    for slot, w in sums.items():
        if slot >= 0:
            out[slot] = w / sums[-1]
    return out


def scored(docs: DataFrame, weights: np.ndarray, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """docs with one more column, the probability of label 1. Null and empty texts get the constant's. No shuffle."""
    sent = docs.sparkSession.sparkContext.broadcast(weights)

    def make():
        w, features, scale = sent.value, Features(), Ftrl.scale

        def step(cols):
            z = np.empty(len(cols[text_col]))
            for k, text in enumerate(cols[text_col]):
                # A dot product with shares is the mean weight over the n-grams.
                z[k] = w[-1] + scale * sum(w[g].mean() for g in features(text))
            yield cols | {score_col: 1 / (1 + np.exp(-np.clip(z, -35, 35)))}

        return step

    if score_col in docs.columns:
        raise ValueError(f"{score_col} is a column of the input; name another score_col")
    return map_batches(docs, make, StructType([*docs.schema.fields, StructField(score_col, DoubleType())]))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality score of every document, learnt from four fifths of the labelled ones; odd rows as in the functions it calls."""
    docs = table(spark, sf_dir, "documents")
    out = scored(texts(docs), train(docs, table(spark, sf_dir, "labels")))
    return out.select(
        "doc_id", F.coalesce(fold(F.col("doc_id"), FOLDS) == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
