"""Hard-negative mining by coordinate pruning over length buckets.

Entries become whole numbers x = floor(scale * c); a row's score is its exact inner product with
the anchor. For every anchor the ``positives`` best other rows of its label are found; for each of them
the ``negatives`` best rows of other labels whose score is at least ``low`` and at most ``high``
(fractions of 100) of the positive's.

Rows are dealt by (label, length) to tasks. A task cuts its rows into *buckets* of one label and
similar lengths, and keeps in each, for every coordinate, the rows sorted by that coordinate of their
unit vector. All anchors are streamed from the shared folder past the buckets, batch by batch:

* A score limit and the bucket's shortest and longest row bound the angle between anchor and row. That
  bounds what the row may have at any coordinate: for the anchor's *focus* coordinates (its largest)
  the feasible values are a stretch of the sorted list. A bucket that can't reach the limit is skipped.
* The shortest stretch gives the candidates, the other stretches are intersected with them, and what
  is left is scored exactly. Where no stretch excludes anything, anchors are scored together.
* The limit rises with what the task has found so far for the anchor: its last place among the best.

A task reports its best few for each anchor and positive; Spark ranks those of all tasks. Bounds are
widened by more than rounding can be, so pruning never loses a row.

Defined results: rows without a label, or whose vector is null or empty or holds a null or
non-finite entry, take no part; nor do those of another length than most, or with a squared length
of 2^52 or more after scaling (their scores might not be exact). Ties go to the smaller id, null ids last,
then to the row read first; rows sharing an id are rows each (an anchor's
double may be its positive); anchors without a positive, and positives without a negative in
range, give no rows; an empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.dataset as pads
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from civicmart.llm.common import scratch, stored
from civicmart.llm.files import open_store

SCALE, POSITIVES, NEGATIVES, LOW, HIGH = 256, 5, 3, 50, 95
ROWS_PER_TASK = 32_768
BUCKET_ROWS, BUCKET_RATIO = 4096, 0.9  # rows of a bucket, and its shortest to its longest
FOCUS = 4
ANCHOR_BATCH = 512
LONGEST = 1 << 52  # squared length; scores below are exact in doubles
SLACK = 1e-6       # far above what rounding to single precision changes
MAX_ID = (1 << 63) - 1


def whole_vectors(rows: DataFrame, key: str, vector: str, label: Column, scale: int) -> DataFrame:
    """(uid, id, label, x, square): usable rows of the usual length, numbered."""
    entries = rows.select(F.col(key).cast("long").alias("id"), label.cast("long").alias("label"),
                          F.col(vector).alias("v"))
    finite = F.forall("v", lambda c: c.isNotNull() & (F.abs(c.cast("double") * scale) < F.lit(float(1 << 26))))
    picked = entries.where(F.col("label").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0) & finite)
    sizes = picked.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    x = F.transform("v", lambda c: F.floor(c.cast("double") * scale).cast("int"))
    return (picked.where(F.size("v") == (sizes.d if sizes else 0))
            .select("id", "label", x.alias("x"))
            .withColumn("square", F.aggregate("x", F.lit(0).cast("long"),
                                              lambda a, c: a + c.cast("long") * c.cast("long")))
            .where(F.col("square") < LONGEST)
            .withColumn("uid", F.monotonically_increasing_id()))


def feasible(focus: np.ndarray, least: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Range of a unit vector's coordinate, from the anchor's unit coordinate and bounds of their cosine."""
    own = np.arccos(np.clip(focus, -1, 1))
    wide = np.arccos(np.clip(least, -1, 1))   # at most this far from the anchor
    near = np.arccos(np.clip(most, -1, 1))    # and at least this far
    far_end = np.minimum(np.minimum(np.pi, own + wide), 2 * np.pi - own - near)
    near_end = np.maximum(np.maximum(0, own - wide), near - own)
    return np.cos(np.maximum(far_end, 0)) - SLACK, np.cos(np.minimum(near_end, np.pi)) + SLACK


class Bucket:
    """Rows of one label and similar length, with a sorted list for every coordinate."""

    def __init__(self, label: int, uid: np.ndarray, ids: np.ndarray, x: np.ndarray) -> None:
        order = np.lexsort((uid, ids))  # ties go to the smaller place
        self.label, self.uid, self.ids = label, uid[order], ids[order]
        self.x = x[order].astype(np.float64)
        length = np.sqrt((self.x * self.x).sum(axis=1))
        self.shortest, self.longest = float(length.min()), float(length.max())
        self.unit = (self.x / np.maximum(length, 1e-300)[:, None]).astype(np.float32)
        self.by = np.argsort(self.unit, axis=0).astype(np.uint16).T
        self.values = np.ascontiguousarray(np.sort(self.unit, axis=0).T)

    def candidates(self, a: np.ndarray, least: np.ndarray, most: np.ndarray):
        """(anchors, rows or None for all, scores) that may score from ``least`` to ``most``; exact scores."""
        size = np.sqrt((a * a).sum(axis=1))
        long_, short = size * max(self.longest, 1e-300), size * max(self.shortest, 1e-300)
        with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
            cos_least = np.nan_to_num(np.where(least > 0, least / long_, least / short), nan=-1.0)
            cos_most = np.nan_to_num(np.where(most > 0, most / short, most / long_), nan=1.0)
        if self.shortest == 0:  # a zero row scores 0 with any anchor
            cos_least = np.where(least <= 0, -1.0, cos_least)
            cos_most = np.where(most >= 0, 1.0, cos_most)
        live = np.flatnonzero((cos_least <= 1 + SLACK) & (cos_most >= -1 - SLACK) & (least <= most))
        if not len(live):
            return
        unit = a[live] / np.maximum(size[live], 1e-300)[:, None]
        k = min(FOCUS, a.shape[1])
        focus = np.argpartition(-np.abs(unit), k - 1, axis=1)[:, :k]
        lo, hi = feasible(np.take_along_axis(unit, focus, 1), cos_least[live, None], cos_most[live, None])
        free = (lo <= self.values[focus, 0]) & (hi >= self.values[focus, -1])
        free |= (size[live] == 0)[:, None] | (self.shortest == 0)
        whole = np.flatnonzero(free.all(axis=1))
        if len(whole):
            scores = a[live[whole]] @ self.x.T
            for k, own in zip(live[whole].tolist(), scores, strict=True):
                yield k, None, own
        for i in np.flatnonzero(~free.all(axis=1)).tolist():
            stretches = sorted((np.searchsorted(self.values[f], u, "right") - (s := np.searchsorted(self.values[f], b)),
                                int(s), int(f), float(b), float(u))
                               for f, b, u, open_ in zip(focus[i].tolist(), lo[i].tolist(), hi[i].tolist(),
                                                         free[i].tolist(), strict=True) if not open_)
            n, s, f, _, _ = stretches[0]
            rows = self.by[f, s:s + max(0, n)]
            for _, _, f, b, u in stretches[1:]:
                at = self.unit[rows, f]
                rows = rows[(at >= b) & (at <= u)]
            if len(rows):
                rows = np.sort(rows)
                yield int(live[i]), rows, self.x[rows] @ a[live[i]]


class Best:
    """The best ``k`` rows of a query so far: score, id, uid; ``limit`` is what others must reach."""

    __slots__ = ("k", "limit", "rows")

    def __init__(self, k: int, limit: float) -> None:
        self.k, self.limit, self.rows = k, limit, []

    def add(self, scores: np.ndarray, ids: np.ndarray, uids: np.ndarray) -> None:
        if len(scores) > self.k:  # no score below the k-th can stay; ties are told apart below
            least = np.partition(scores, len(scores) - self.k)[len(scores) - self.k]
            some = scores >= least
            scores, ids, uids = scores[some], ids[some], uids[some]
        self.rows += zip((-scores).tolist(), ids.tolist(), uids.tolist(), strict=True)
        self.rows.sort()
        del self.rows[self.k:]
        if len(self.rows) == self.k:
            self.limit = max(self.limit, -self.rows[-1][0])


def _column(part, name: str) -> np.ndarray:
    return part.column(name).to_numpy(zero_copy_only=False) if isinstance(part, pa.RecordBatch) \
        else part.column(name).to_numpy()


def _matrix(part) -> np.ndarray:
    x = part.column("x")
    x = x.combine_chunks() if isinstance(x, pa.ChunkedArray) else x
    return x.flatten().to_numpy().reshape(len(x), -1)


def buckets(tables) -> list[Bucket]:
    """Buckets of a task's rows, which come sorted by label and length."""
    out = []
    tables = [t for t in tables if t.num_rows]
    if not tables:
        return out
    label, square, uid = (np.concatenate([_column(t, c) for t in tables]) for c in ("label", "square", "uid"))
    ids = np.concatenate([t.column("id").fill_null(MAX_ID).to_numpy(zero_copy_only=False)
                          if isinstance(t, pa.RecordBatch) else t.column("id").fill_null(MAX_ID).to_numpy()
                          for t in tables])
    x = np.concatenate([_matrix(t) for t in tables])
    begin = 0
    for k in range(1, len(label) + 1):
        if k == len(label) or label[k] != label[begin] or k - begin == BUCKET_ROWS \
                or square[begin] < BUCKET_RATIO ** 2 * square[k]:
            out.append(Bucket(int(label[begin]), uid[begin:k], ids[begin:k], x[begin:k]))
            begin = k
    return out


def _streamed(folder: str, columns: list[str], labels: list[int] | None = None):
    """Batches of a table in the shared folder, of some labels."""
    store, where = open_store(folder)
    wanted = None if labels is None else pads.field("label").isin(labels)
    for part in pads.dataset(where, filesystem=store, format="parquet").to_batches(
            columns=columns, filter=wanted, batch_size=ANCHOR_BATCH):
        if part.num_rows:
            yield part


def _frame(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names=names)


def _in_tasks(vectors: DataFrame, rows_per_task: int) -> DataFrame:
    tasks = max(1, -(-vectors.count() // rows_per_task))
    # uid: equal rows, however many, are split too.
    return (vectors.repartitionByRange(tasks, "label", "square", "uid")
            .sortWithinPartitions("label", "square", "uid"))


def find_positives(dealt: DataFrame, anchors: str, k: int) -> DataFrame:
    """(anchor, uid, id, score): the best ``k`` rows of each anchor's label in every task."""

    def search(it):
        own = buckets(list(it))
        for part in _streamed(anchors, ["uid", "label", "x"], sorted({b.label for b in own})) if own else ():
            a, uid, label = _matrix(part).astype(np.float64), _column(part, "uid"), _column(part, "label")
            best = [Best(k, -np.inf) for _ in range(len(a))]
            for b in reversed(own):  # long rows first: they raise the limits
                mine = np.flatnonzero(label == b.label)
                if not len(mine):
                    continue
                least = np.array([best[q].limit for q in mine.tolist()])
                for q, rows, scores in b.candidates(a[mine], least, np.full(len(mine), np.inf)):
                    q = int(mine[q])
                    uids, ids = (b.uid, b.ids) if rows is None else (b.uid[rows], b.ids[rows])
                    some = (uids != uid[q]) & (scores >= best[q].limit)
                    best[q].add(scores[some], ids[some], uids[some])
            found = [(int(uid[q]), u, i, int(-s)) for q in range(len(a)) for s, i, u in best[q].rows]
            if found:
                yield _frame(found, ["anchor", "uid", "id", "score"])

    return dealt.mapInArrow(search, "anchor long, uid long, id long, score long")


def find_negatives(dealt: DataFrame, wanted: str, k: int, low: int, high: int) -> DataFrame:
    """(anchor, place, uid, id, score): per anchor and positive the best ``k`` rows in range of every task."""

    def search(it):
        own = buckets(list(it))
        for part in _streamed(wanted, ["uid", "label", "x", "scores"]) if own else ():
            a, uid, label = _matrix(part).astype(np.float64), _column(part, "uid"), _column(part, "label")
            lists = part.column("scores").to_pylist()
            best = [[Best(k, -(-low * s // 100)) for s in scores] for scores in lists]
            top = [[high * s // 100 for s in scores] for scores in lists]
            most = np.array([max(t) for t in top], dtype=np.float64)
            for b in reversed(own):
                mine = np.flatnonzero(label != b.label)
                least = np.array([min((x.limit for x, t in zip(best[q], top[q], strict=True) if x.limit <= t),
                                      default=np.inf) for q in mine.tolist()])
                for q, rows, scores in b.candidates(a[mine], least, most[mine]):
                    q = int(mine[q])
                    for x, t in zip(best[q], top[q], strict=True):
                        some = np.flatnonzero((scores >= x.limit) & (scores <= t))
                        if len(some):
                            at = some if rows is None else rows[some]
                            x.add(scores[some], b.ids[at], b.uid[at])
            found = [(int(uid[q]), p, u, i, int(-s)) for q in range(len(a))
                     for p, x in enumerate(best[q]) for s, i, u in x.rows]
            if found:
                yield _frame(found, ["anchor", "place", "uid", "id", "score"])

    return dealt.mapInArrow(search, "anchor long, place long, uid long, id long, score long")


def _ranked(found: DataFrame, by: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "id", "uid")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(rows: DataFrame, anchor: Column, key: str = "vec_id", vector: str = "embedding",
                   label: Column | None = None, scale: int = SCALE, positives: int = POSITIVES,
                   negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH,
                   rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``anchor`` tells by the column ``id`` (the key as a long) which rows are anchors.
    """
    spark = rows.sparkSession
    label = F.col("label") if label is None else label
    vectors = stored(whole_vectors(rows, key, vector, label, scale), scratch(spark, "negatives-vectors"))
    dealt = _in_tasks(vectors, rows_per_task)
    folder = scratch(spark, "negatives-anchors")
    anchors = stored(vectors.where(anchor).select("uid", "id", "label", "x").sortWithinPartitions("label"), folder)
    first = stored(_ranked(find_positives(dealt, folder, positives), ["anchor"], positives),
                   scratch(spark, "negatives-positives"))
    places = first.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct(
        F.col("rank"), "score"))).alias("p"))  # at most ``positives`` a group
    folder = scratch(spark, "negatives-wanted")
    stored(anchors.join(places, F.col("uid") == F.col("anchor"))
           .select("uid", "label", "x", F.col("p.score").alias("scores")), folder)
    found = _ranked(find_negatives(dealt, folder, negatives, low, high), ["anchor", "place"], negatives)

    def named(c):  # a null id was searched as the largest
        return F.nullif(F.col(c), F.lit(MAX_ID))

    pairs = first.select("anchor", (F.col("rank") - 1).cast("long").alias("place"), named("id").alias("positive_id"),
                         F.col("score").alias("positive_score"))
    return (found.select("anchor", "place", "rank", named("id").alias("negative_id"),
                         F.col("score").alias("negative_score"))
            .join(pairs, ["anchor", "place"])
            .join(anchors.select(F.col("uid").alias("anchor"), F.col("id").alias("anchor_id")), "anchor")
            .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id",
                    "positive_score", "negative_score"))
