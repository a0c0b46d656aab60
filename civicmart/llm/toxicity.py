"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text: the set of its words, and the set of its word pairs, word triples and
skip-grams (pairs with one or two words between), each hashed to ``2^BITS`` coordinates
of its own. A word that occurs has value 1, an n-gram GRAM_VALUE: there are many more of
them, and L1 then asks more evidence of each. FTRL
keeps z and n for each coordinate; a weight is zero while |z| <= L1, and its learning rate
falls with its own gradients alone, so the weights are sparse and only the non-zero ones
are broadcast for scoring.

Training: at most ``max_docs`` labelled rows (all if fewer), chosen by a hash of doc_id.
FTRL is sequential, so one task streams these rows, in the order of a hash, PASSES times;
``max_docs`` bounds its work, and its state is the two arrays z and n. Everything else
(features of the rows, scores of all documents) runs in as many tasks as there are.

Defined results: null and empty texts have no feature and get the bias's score; null
labels and null doc_ids are never trained on; a doc_id labelled twice trains twice;
without labels every score is 0.5; an empty table gives an empty result; other columns
are not read.
"""

from __future__ import annotations

import io
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicmart.llm.common import fold, sampled, scratch, stored
from civicmart.llm.textmodel import LETTERS, WordHash, mixed, word_hashes
from civicmart.llm.tokenize import batches

BITS = 18
MAX_DOCS = 16_000
PASSES = 4
ALPHA, BETA, L1, L2 = 1.0, 1.0, 5.0, 0.1
GRAM_VALUE = 0.3


def features(text: str | None, cache: WordHash, bits: int = BITS) -> np.ndarray:
    """Sorted coordinates of a whole text."""
    words = LETTERS.findall(text.lower()) if text else []
    if not words:
        return np.empty(0, dtype=np.int64)
    h = word_hashes(words, cache)
    with np.errstate(over="ignore"):
        a = h * np.uint64(0x9E3779B97F4A7C15)
        b = h * np.uint64(0xC2B2AE3D27D4EB4F)
        c = h * np.uint64(0x165667B19E3779F9)
        parts = [a[:-1] + b[1:], a[:-2] + b[1:-1] + c[2:]]
        for gap in (2, 3):  # one or two words between
            parts.append(a[:-gap] + (b[gap:] ^ np.uint64(0x5851F42D4C957F2D * gap % 2**64)))
    return np.concatenate([_present(a, bits), _present(np.concatenate(parts), bits) + (1 << bits)])


def _present(hashes: np.ndarray, bits: int) -> np.ndarray:
    keys = (mixed(hashes) >> np.uint64(64 - bits)).astype(np.int64)
    if len(keys) < 20_000:
        return np.unique(keys)
    seen = np.zeros(1 << bits, dtype=bool)  # long texts: mark instead of sort
    seen[keys] = True
    return np.flatnonzero(seen)


def values(coords: np.ndarray, bits: int = BITS) -> np.ndarray:
    """The value of each coordinate of a text: words 1, n-grams GRAM_VALUE, the bias 1."""
    return np.where((coords >= 1 << bits) & (coords < 2 << bits), GRAM_VALUE, 1.0)


def weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    w = -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2)
    return np.where(np.abs(z) <= L1, 0.0, w)


def _sigmoid(x: float) -> float:
    return float(1.0 / (1.0 + np.exp(-np.clip(x, -35.0, 35.0))))


def ftrl(rows, z: np.ndarray, n: np.ndarray, bias_at: int) -> None:
    """One pass of FTRL over (coordinates, label, weight), updating z and n in place."""
    value = values(np.arange(bias_at + 1), (bias_at >> 1).bit_length() - 1)
    for coords, label, weight in rows:
        i = np.append(coords, bias_at)
        w = weights(z[i], n[i])
        g = (_sigmoid((w * value[i]).sum()) - label) * weight * value[i]
        step = (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / ALPHA
        z[i] += g - step * w
        n[i] += g * g


def _squeezed(coords: np.ndarray) -> bytes:
    """Sorted coordinates as compressed steps: a few bytes a feature in the stored rows."""
    return zlib.compress(np.diff(coords, prepend=0).astype("<i4").tobytes(), 1)


def _coords(data: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(zlib.decompress(data), "<i4").astype(np.int64))


def _packed(z: np.ndarray, n: np.ndarray) -> bytes:
    out = io.BytesIO()
    at = np.flatnonzero((z != 0) | (n != 0))
    np.savez(out, at=at.astype(np.int32), z=z[at], n=n[at])
    return out.getvalue()


def train(rows: DataFrame, label: str = "label", bits: int = BITS,
          passes: int = PASSES) -> tuple[np.ndarray, np.ndarray]:
    """Non-zero coordinates and weights (the last coordinate, 2 * 2^bits, is the bias)."""
    spark = rows.sparkSession
    size = 2 << bits
    known = rows.where(f"{label} IS NOT NULL AND doc_id IS NOT NULL")
    known = known.select("doc_id", "text", F.col(label).cast("int").alias("y"))

    def featurise(it):
        cache = WordHash()
        for table in it:
            for part in batches(table, 256):
                got = [_squeezed(features(t, cache, bits))
                       for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("y"), pa.array(got, pa.binary())],
                    names=["doc_id", "y", "x"])

    # Where the rows are: texts aren't shuffled. The caller bounds the rows.
    data = stored(known.mapInArrow(featurise, "doc_id long, y int, x binary"), scratch(spark, "ftrl-rows"))
    count = {r.y: r["count"] for r in data.groupBy("y").count().collect()}
    total = sum(count.values())
    if not total:
        return np.empty(0, np.int64), np.empty(0)
    balance = {y: (total / (2.0 * k)) ** 0.5 for y, k in count.items()}
    z, n = np.zeros(size + 1), np.zeros(size + 1)
    # No shuffle in a pass: one task reads the stored rows and sorts them.
    stream = data.coalesce(1).sortWithinPartitions(F.xxhash64(F.lit("order"), "doc_id"), "x")
    for _ in range(passes):
        state = spark.sparkContext.broadcast(_packed(z, n))

        def learn(it, state=state):
            start = np.load(io.BytesIO(state.value))
            z, n = np.zeros(size + 1), np.zeros(size + 1)
            z[start["at"]], n[start["at"]] = start["z"], start["n"]
            for table in it:
                ftrl(((_coords(x), y, balance[y]) for x, y in zip(
                    table.column("x").to_pylist(), table.column("y").to_pylist(), strict=True)),
                    z, n, size)
            yield pa.RecordBatch.from_arrays([pa.array([_packed(z, n)], pa.binary())],
                                             names=["state"])

        after = np.load(io.BytesIO(stream.select("y", "x").mapInArrow(learn, "state binary")
                                   .first().state))
        z[after["at"]], n[after["at"]] = after["z"], after["n"]
        state.destroy()
    w = weights(z, n)
    at = np.flatnonzero(w)
    return at, w[at]


def score(docs: DataFrame, at: np.ndarray, w: np.ndarray, bits: int = BITS) -> DataFrame:
    """doc_id and score of every document, from its text alone."""
    state = docs.sparkSession.sparkContext.broadcast((at.astype(np.int32), w.astype(np.float32)))

    def run(it):
        own_at, own_w = state.value
        full = np.zeros((2 << bits) + 1)
        full[own_at] = own_w
        full *= values(np.arange(len(full)), bits)
        cache = WordHash()
        for table in it:
            for part in batches(table, 512):
                got = [_sigmoid(full[features(t, cache, bits)].sum() + full[-1])
                       for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(got, pa.float64())],
                                                 names=["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, score double")


def toxicity(docs: DataFrame, labels: DataFrame, max_docs: int = MAX_DOCS) -> DataFrame:
    """Train on the labelled training folds and score every document."""
    learn = labels.where(fold(F.col("doc_id"), 5) != 0).select("doc_id", F.col("toxic").alias("label"))
    # At most twice max_docs labels: a proven bound for the broadcast.
    chosen = sampled(learn.where("label IS NOT NULL"), max_docs, "toxicity-labels")
    # Documents or labels that share a doc_id multiply rows, so what one task learns from is bounded again.
    rows = sampled(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id"), 4 * max_docs, "toxicity-rows")
    at, w = train(rows)
    return score(docs, at, w).select(
        "doc_id", F.coalesce(fold(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out"),
        "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
