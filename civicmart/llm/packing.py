"""Bounded-space online best-fit packing of token sequences.

Every document becomes its ids plus the end id. A document over ``capacity`` tokens is
cut into full pieces, the first one taking the remainder; others stay whole. Pieces of
exactly ``capacity`` tokens are sequences by themselves. The rest are dealt by a hash of
their document and content (so documents without a doc_id spread too) over tasks of about ``pieces_per_task`` pieces. Each task sees its pieces
in hash order and holds at most ``open_bins`` bins open: a piece goes to the bin whose
free space fits it most closely, found in a bitset keyed by free space; when no bin
fits and all are open, the fullest closes first. Memory is bounded by ``open_bins``.

Defined results: null or empty text is the end id alone (one piece of length 1); rows
with a null doc_id or sharing a doc_id are packed each for itself; an empty table gives
an empty result; other columns are not read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicmart.llm.common import scratch, stored
from civicmart.llm.tokenize import BATCH_CHARS, BATCH_ROWS, batches, default_tokenizer, encoder

CAPACITY = 2048
OPEN_BINS = 1024
PIECES_PER_TASK = 20_000

PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"
PLACED = PIECE + ", sequence_id long, offset long"


def cut_points(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` tokens: the first takes the remainder."""
    first = n % capacity or min(n, capacity)
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


def document_pieces(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY,
                    end_id: int = 0) -> DataFrame:
    """One row per piece of each document: doc_id, piece, start, length, ids_crc32."""
    path = tokenizer or default_tokenizer()

    def cut(it):
        enc = encoder(path)
        end = np.array([end_id], dtype="<u4")
        for table in it:
            for part in batches(table, BATCH_ROWS, BATCH_CHARS):
                rows = []
                for doc, ids in zip(part.column(0).to_pylist(),
                                    enc.encode(part.column(1)), strict=True):
                    all_ids = np.concatenate([ids.astype("<u4"), end])
                    for k, (s, n) in enumerate(cut_points(len(all_ids), capacity)):
                        rows.append((doc, k, s, n, zlib.crc32(all_ids[s:s + n].tobytes())))
                cols = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int64(),
                                                           pa.int64(), pa.int64()), strict=True)],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text")).mapInArrow(cut, PIECE)


class BestFit:
    """Bins of one task. ``place`` returns (bin number, offset) of a piece."""

    def __init__(self, capacity: int, open_bins: int) -> None:
        self.capacity, self.open_bins = capacity, open_bins
        self.free = 0                # bit f is set if an open bin has f tokens free
        self.at: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.n_open = self.n_bins = 0

    def place(self, length: int) -> tuple[int, int]:
        if length == self.capacity:  # full by itself: never open
            self.n_bins += 1
            return self.n_bins - 1, 0
        fits = self.free >> length
        if fits:
            space = length + (fits & -fits).bit_length() - 1
            bin_no = self._take(space)
        else:
            if self.n_open == self.open_bins:  # the fullest closes
                self._take((self.free & -self.free).bit_length() - 1)
                self.n_open -= 1
            space, bin_no = self.capacity, self.n_bins
            self.n_bins += 1
            self.n_open += 1
        left = space - length
        if left:
            self.at[left].append(bin_no)
            self.free |= 1 << left
        else:
            self.n_open -= 1
        return bin_no, self.capacity - space

    def _take(self, space: int) -> int:
        bin_no = self.at[space].pop()
        if not self.at[space]:
            self.free &= ~(1 << space)
        return bin_no


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY, open_bins: int = OPEN_BINS,
                pieces_per_task: int = PIECES_PER_TASK) -> DataFrame:
    """Add sequence_id and offset to a written table of pieces."""
    tasks = max(1, -(-pieces.where(F.col("length") < capacity).count() // pieces_per_task))

    def pack(it):
        from pyspark import TaskContext
        base = TaskContext.get().partitionId() << 40
        bins = BestFit(capacity, open_bins)
        for table in it:
            lengths = table.column("length").to_pylist()
            placed = [bins.place(n) for n in lengths]
            yield pa.RecordBatch.from_arrays(
                [*table.columns, pa.array([base + b for b, _ in placed], pa.int64()),
                 pa.array([o for _, o in placed], pa.int64())],
                names=[*table.schema.names, "sequence_id", "offset"])

    # Full order inside a task: the same bins whenever a task runs again.
    order = F.xxhash64("doc_id", "piece", "length", "ids_crc32")
    dealt = (pieces.repartition(tasks, order)
             .sortWithinPartitions(order, "doc_id", "piece", "length", "ids_crc32"))
    return dealt.mapInArrow(pack, PLACED)


def best_fit(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY,
             open_bins: int = OPEN_BINS, pieces_per_task: int = PIECES_PER_TASK,
             end_id: int = 0) -> DataFrame:
    """Tokenise, cut and pack all documents; one row per piece with its place."""
    pieces = stored(document_pieces(docs, tokenizer, capacity, end_id),
                    scratch(docs.sparkSession, "pieces"))
    return pack_pieces(pieces, capacity, open_bins, pieces_per_task)
