"""Quality by nearest-neighbour voting in a latent-semantic space.

Features: hashed tokens, token pairs and the shape of the text (share of repeated tokens,
symbols, digits, mean word length), 2^BITS coordinates, log counts times inverse document
frequency of the labelled sample, length 1. The leading RANK directions of the labelled
vectors (an eigenproblem of at most 2^BITS coordinates, solved by the driver from the bounded
sample, whose vectors tasks make) span the latent space. The labelled vectors are broadcast (``max_docs`` x RANK numbers),
every document takes exact cosine products with all of them, block by block, and its
NEIGHBOURS most similar vote with their similarity.

Training reads at most ``max_docs`` labelled rows (all if fewer), chosen by a hash of
doc_id; everything else covers all documents.

Defined results: null and empty texts have no direction and get the mean label of the
labelled rows; null labels and null doc_ids are never trained on; labelled rows of equal
(computed) similarity at the last place are taken by smaller position (order by hash of doc_id); without labels
every score is 0.5; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicmart.llm.common import fold, sampled, scratch, stored
from civicmart.llm.textmodel import TOKENS, WordHash, mixed, word_hashes
from civicmart.llm.tokenize import batches

BITS = 10
SHAPES = 8
RANK = 48
NEIGHBOURS = 15
MAX_DOCS = 4_000


def raw_vector(text: str | None, cache: WordHash, bits: int = BITS) -> np.ndarray:
    """Log counts of hashed tokens and pairs, then the shape of a whole text."""
    out = np.zeros((1 << bits) + SHAPES, dtype=np.float32)
    tokens = TOKENS.findall(text.lower()) if text else []
    if not tokens:
        return out
    h = word_hashes(tokens, cache)
    one = (mixed(h) >> np.uint64(64 - bits)).astype(np.int64)
    out[:1 << bits] = np.log1p(np.bincount(one, minlength=1 << bits))
    n = len(tokens)
    pairs = h[:-1] * np.uint64(31) + h[1:]
    words = [t for t in tokens if t[0].isalpha()]
    shape = (len(np.unique(h)) / n, len(np.unique(pairs)) / max(1, n - 1),
             float((h[1:] == h[:-1]).mean()) if n > 1 else 0.0,
             sum(1 for t in tokens if not t[0].isalnum()) / n,
             sum(1 for t in tokens if t[0].isdigit()) / n,
             min(2.0, sum(map(len, words)) / max(1, len(words)) / 10),
             min(1.0, n / 2000), len(words) / n)
    out[1 << bits:] = shape
    return out


class Space:
    """Weights of the coordinates, latent directions, labelled vectors and their labels."""

    def __init__(self, idf, base, labelled, labels) -> None:
        self.idf, self.base, self.labelled, self.labels = idf, base, labelled, labels

    @staticmethod
    def weighted(raw: np.ndarray, idf: np.ndarray, bits: int = BITS) -> np.ndarray:
        x = raw * idf
        words = x[:, :1 << bits]
        norm = np.linalg.norm(words, axis=1, keepdims=True)
        words /= np.where(norm > 0, norm, 1)
        return x

    def project(self, raw: np.ndarray) -> np.ndarray:
        y = self.weighted(raw, self.idf) @ self.base
        norm = np.linalg.norm(y, axis=1, keepdims=True)
        return y / np.where(norm > 0, norm, 1)

    def vote(self, raw: np.ndarray, k: int = NEIGHBOURS) -> np.ndarray:
        """Score of each row: its nearest labelled vectors' labels, weighted by similarity."""
        mean = float(self.labels.mean())
        sims = self.project(raw) @ self.labelled.T
        k = min(k, sims.shape[1])
        near = np.argpartition(-sims, k - 1, axis=1)[:, :k]
        last = np.take_along_axis(sims, near, axis=1).min(axis=1, keepdims=True)
        for row in np.flatnonzero((sims >= last).sum(axis=1) > k):  # a tie at the last place
            near[row] = np.argsort(-sims[row], kind="stable")[:k]
        weight = np.clip(np.take_along_axis(sims, near, axis=1), 0, None) ** 4
        total = weight.sum(axis=1)
        votes = (weight * self.labels[near]).sum(axis=1)
        empty = ~raw.any(axis=1) | (total <= 0)
        return np.clip(np.where(empty, mean, votes / np.where(total > 0, total, 1)), 0.0, 1.0)


def train(rows: DataFrame, label: str = "label", max_docs: int = MAX_DOCS, bits: int = BITS,
          rank: int = RANK) -> Space | None:
    """Fit the space on (doc_id, text, label)."""
    spark = rows.sparkSession
    known = rows.where(f"{label} IS NOT NULL AND doc_id IS NOT NULL")
    known = sampled(known, max_docs, "quality").select("doc_id", "text", F.col(label).cast("int").alias("y"))

    def vectorise(it):
        cache = WordHash()
        for table in it:
            for part in batches(table, 256):
                got = [raw_vector(t, cache, bits).tobytes() for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("y"), pa.array(got, pa.binary())],
                    names=["doc_id", "y", "x"])

    # Bounded by max_docs rows of 2^bits numbers.
    data = stored(known.repartition(12, F.xxhash64("doc_id", "text"))
                  .mapInArrow(vectorise, "doc_id long, y int, x binary"), scratch(spark, "lsa-rows"))
    got = data.orderBy(F.xxhash64("doc_id"), "doc_id", "y", "x").select("y", "x").collect()
    if not got:
        return None
    raw = np.stack([np.frombuffer(r.x, np.float32) for r in got])
    labels = np.array([r.y for r in got], dtype=np.float32)
    seen = (raw[:, :1 << bits] > 0).sum(axis=0)
    idf = np.concatenate([np.log((1 + len(raw)) / (1 + seen)), np.ones(SHAPES)]).astype(np.float32)
    x = Space.weighted(raw, idf, bits)
    _, vectors = np.linalg.eigh(x.T @ x)
    base = np.ascontiguousarray(vectors[:, ::-1][:, :rank]).astype(np.float32)
    space = Space(idf, base, None, labels)
    space.labelled = space.project(raw).astype(np.float32)
    return space


def score(docs: DataFrame, space: Space | None, bits: int = BITS) -> DataFrame:
    """doc_id and score of every document, from its text alone."""
    state = docs.sparkSession.sparkContext.broadcast(
        None if space is None else (space.idf, space.base, space.labelled, space.labels))

    def run(it):
        own = None if state.value is None else Space(*state.value)
        cache = WordHash()
        for table in it:
            for part in batches(table, 256):
                if own is None:
                    got = np.full(part.num_rows, 0.5)
                else:
                    got = own.vote(np.stack([raw_vector(t, cache, bits)
                                             for t in part.column("text").to_pylist()]))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(got.astype(float), pa.float64())],
                    names=["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, score double")


def quality(docs: DataFrame, labels: DataFrame, max_docs: int = MAX_DOCS) -> DataFrame:
    """Train on the labelled training folds and score every document."""
    learn = labels.where(fold(F.col("doc_id"), 5) != 0).select("doc_id", F.col("quality").alias("label"))
    chosen = sampled(learn.where("label IS NOT NULL"), max_docs, "quality-labels")
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    space = train(rows, max_docs=2 * max_docs)
    return score(docs, space).select(
        "doc_id", F.coalesce(fold(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out"),
        "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
