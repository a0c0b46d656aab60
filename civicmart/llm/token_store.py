"""Token-id shards with a minimal perfect hash index for keyed access.

Documents are encoded, the end id appended, and written in ascending doc_id order as
shards. A shard is one file:

    magic | raw ids (little-endian, 2 bytes if the vocabulary allows, else 4)
          | key count, slot width, hash levels, payload offsets, lengths, fingerprints | footer

The index is a minimal perfect hash over the shard's distinct doc_ids: levels of bit
arrays, in each of which the keys that meet no other key are settled; a key's slot is
the rank of its bit. A lookup hashes the key level by level (constant expected time),
compares the stored 32-bit fingerprint, so that foreign keys are refused, and reads
``length`` ids at ``offset``. Memory of a task is bounded by one shard's index; payloads
stream to the file once, the index follows them, and a footer of fixed size tells where it begins.

Shards are ranges of (doc_id, hash of the text) of about ``rows_per_shard`` documents, however many
shards that makes, so a doc_id of very many rows fills several. Only one row a shard passes the driver: its file,
sizes and first and last key, by which a key finds its shards and a shard its first global position.

Defined results: null text is the end id alone; rows with a null doc_id come last, in an
index slot of their own, and come back without a doc_id; rows sharing a doc_id lie together under one key, in the order of
their texts' hashes, and come back as rows each; an empty table gives no shard and no rows.
"""

from __future__ import annotations

import io
import struct
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicmart.llm.common import scratch, stored
from civicmart.llm.files import attempt_name, open_store
from civicmart.llm.tokenize import BATCH_CHARS, BATCH_ROWS, batches, default_tokenizer, encoder

MAGIC = b"TIDS0002"
ROWS_PER_SHARD = 5_000
FOOTER = struct.Struct("<QII")  # where the index begins, its size and checksum; the magic follows
GAMMA = 2.0  # bits a key in each level of the hash

MANIFEST = "shard int, file string, n_rows long, n_tokens long, n_bytes long, low long, high long, nulls long"


def _mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit hash of integer keys (multiply-xorshift), one family member per seed."""
    with np.errstate(over="ignore"):
        x = keys.astype(np.uint64) + np.uint64(((2 * seed + 1) * 0x9E3779B97F4A7C15) % 2**64)
        x ^= x >> np.uint64(32)
        x *= np.uint64(0xD6E8FEB86659FD93)
        x ^= x >> np.uint64(32)
        x *= np.uint64(0xD6E8FEB86659FD93)
        return x ^ (x >> np.uint64(32))


class PerfectHash:
    """Minimal perfect hash of distinct integer keys: key -> 0 .. n-1."""

    def __init__(self, levels: list[np.ndarray]) -> None:
        self.levels = levels                      # boolean arrays
        counts = [int(b.sum()) for b in levels]
        self.before = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
        self.ranks = [np.cumsum(b) - 1 for b in levels]

    @classmethod
    def of(cls, keys: np.ndarray) -> PerfectHash:
        levels, left = [], keys
        while len(left):
            size = max(8, int(len(left) * GAMMA))
            at = (_mixed(left, len(levels)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            levels.append(alone)
            left = left[~alone[at]]
        return cls(levels)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key; -1 where no level holds it (a foreign key may get a slot)."""
        out = np.full(len(keys), -1, dtype=np.int64)
        todo = np.arange(len(keys))
        for k, bits in enumerate(self.levels):
            at = (_mixed(keys[todo], k) % np.uint64(len(bits))).astype(np.int64)
            hit = bits[at]
            out[todo[hit]] = self.before[k] + self.ranks[k][at[hit]]
            todo = todo[~hit]
        return out


def fingerprints(keys: np.ndarray) -> np.ndarray:
    return (_mixed(keys, 1 << 20) >> np.uint64(32)).astype("<u4")


def index_bytes(keys: np.ndarray, rows: np.ndarray, offsets: np.ndarray, lengths: np.ndarray,
                width: int, payload: int) -> bytes:
    """Index and footer of a shard whose magic and payload take ``payload`` bytes. A key covers ``rows`` documents
    that lie together; ``lengths`` (one a document) follow in payload order, ``offsets`` are per key."""
    mph = PerfectHash.of(keys)
    slot = mph.slots(keys)
    by_slot = np.empty(len(keys), dtype=np.int64)
    by_slot[slot] = np.arange(len(keys))
    first = np.concatenate([[0], np.cumsum(rows)[:-1]])
    out = io.BytesIO()
    out.write(struct.pack("<IIII", len(keys), len(lengths), width, len(mph.levels)))
    for bits in mph.levels:
        out.write(struct.pack("<I", len(bits)) + np.packbits(bits).tobytes())
    out.write(fingerprints(keys)[by_slot].tobytes())
    out.write(offsets[by_slot].astype("<u8").tobytes())
    out.write(first[by_slot].astype("<u4").tobytes())
    out.write(rows[by_slot].astype("<u4").tobytes())
    out.write(lengths.astype("<u4").tobytes())
    body = out.getvalue()
    return body + FOOTER.pack(payload, len(body), zlib.crc32(body)) + MAGIC


class Shard:
    """Keyed access to a shard file."""

    def __init__(self, source) -> None:
        self.source = source
        source.seek(0, 2)
        tail = FOOTER.size + len(MAGIC)
        source.seek(max(0, source.tell() - tail))
        foot = source.read(tail)
        if len(foot) < tail or foot[FOOTER.size:] != MAGIC:
            raise ValueError("not a token shard")
        begin, size, crc = FOOTER.unpack(foot[:FOOTER.size])
        source.seek(begin)
        body = source.read(size)
        if len(body) != size or zlib.crc32(body) != crc:
            raise ValueError("a token shard whose index is damaged")
        self.payload = len(MAGIC)
        n_keys, n_rows, self.width, n_levels = struct.unpack_from("<IIII", body)
        at, levels = 16, []
        for _ in range(n_levels):
            (bits,) = struct.unpack_from("<I", body, at)
            packed = np.frombuffer(body, np.uint8, -(-bits // 8), at + 4)
            levels.append(np.unpackbits(packed, count=bits).astype(bool))
            at += 4 + len(packed)
        self.hash = PerfectHash(levels)
        parts = []
        for kind, n in (("<u4", n_keys), ("<u8", n_keys), ("<u4", n_keys), ("<u4", n_keys),
                        ("<u4", n_rows)):
            parts.append(np.frombuffer(body, kind, n, at))
            at += parts[-1].nbytes
        self.prints, self.offsets, self.first, self.rows, self.lengths = parts

    def lookup(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key, -1 for keys that the shard doesn't hold."""
        slots = self.hash.slots(keys)
        known = slots >= 0
        known[known] = self.prints[slots[known]] == fingerprints(keys[known])
        return np.where(known, slots, -1)

    def documents(self, slot: int) -> Iterator[tuple[int, np.ndarray]]:
        """(offset, ids) of each document under a key, read from the payload."""
        first = int(self.first[slot])
        yield from self._read(int(self.offsets[slot]), self.lengths[first:first + int(self.rows[slot])])

    def without_key(self) -> Iterator[tuple[int, np.ndarray]]:
        """(offset, ids) of the documents without a doc_id, which lie behind all others."""
        keyed = int(self.rows.sum())
        yield from self._read(int(self.lengths[:keyed].sum(dtype=np.int64)), self.lengths[keyed:])

    def _read(self, offset: int, lengths: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        for n in lengths.tolist():
            self.source.seek(self.payload + offset * self.width)
            raw = self.source.read(n * self.width)
            yield offset, np.frombuffer(raw, f"<u{self.width}")
            offset += n


class ShardWriter:
    """Writes one shard: payload as it comes, then index and footer."""

    def __init__(self, store, where: str, shard: int, width: int) -> None:
        self.shard, self.width = shard, width
        self.keys, self.rows, self.offsets, self.lengths = (array("q") for _ in range(4))
        self.n_tokens = self.nulls = 0
        self.name = attempt_name(where, f"shard-{shard:08d}")
        self.out = store.open_output_stream(self.name)
        self.out.write(MAGIC)

    def add(self, keys: list[int | None], parts: list[bytes]) -> None:
        """Documents come in ascending order of their keys, those without a key last."""
        for key, part in zip(keys, parts, strict=True):
            if key is None:
                self.nulls += 1
            elif self.keys and self.keys[-1] == key:
                self.rows[-1] += 1
            else:
                self.keys.append(key)
                self.rows.append(1)
                self.offsets.append(self.n_tokens)
            n = len(part) // self.width
            self.lengths.append(n)
            self.n_tokens += n
        self.out.write(b"".join(parts))

    def close(self) -> tuple:
        payload = len(MAGIC) + self.n_tokens * self.width
        end = index_bytes(*(np.array(x, np.int64) for x in (self.keys, self.rows, self.offsets, self.lengths)),
                          self.width, payload)
        self.out.write(end)
        self.out.close()
        return (self.shard, self.name.rsplit("/", 1)[1], len(self.lengths), self.n_tokens, payload + len(end),
                self.keys[0] if self.keys else None, self.keys[-1] if self.keys else None, self.nulls)


def write_shards(docs: DataFrame, folder: str, tokenizer: str | None = None, end_id: int = 0,
                 rows_per_shard: int = ROWS_PER_SHARD) -> DataFrame:
    """Write all documents as shards below ``folder``; returns the manifest, one row a shard."""
    path = tokenizer or default_tokenizer()
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    shards = max(1, -(-docs.count() // rows_per_shard))

    def write(it):
        from pyspark import TaskContext
        enc = encoder(path)
        end = end_id.to_bytes(enc.dtype.itemsize, "little")
        shard = None
        for table in it:
            for part in batches(table, BATCH_ROWS, BATCH_CHARS):
                if shard is None:
                    store, where = open_store(folder)
                    store.create_dir(where, recursive=True)
                    shard = ShardWriter(store, where, TaskContext.get().partitionId(), enc.dtype.itemsize)
                shard.add(part.column("doc_id").to_pylist(),
                          enc.encode_bytes(part.column("text"), end))
        if shard is not None:
            cols = [[c] for c in shard.close()]
            kinds = [pa.int32(), pa.string(), *[pa.int64()] * 6]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)],
                                             names=[f.split()[0] for f in MANIFEST.split(", ")])

    order = [F.col("doc_id").asc_nulls_last(), F.xxhash64("text")]
    dealt = docs.repartitionByRange(shards, *order).sortWithinPartitions(*order, "text")
    return stored(dealt.mapInArrow(write, MANIFEST), scratch(docs.sparkSession, "manifest"))


def read_documents(keys: DataFrame, manifest: DataFrame, folder: str) -> DataFrame:
    """Look every doc_id of ``keys`` up in the shards; its ids' position, count and crc32.

    A null among the keys asks for the documents without a doc_id.
    """
    rows = manifest.orderBy("shard").collect()  # one row a shard
    files = {k: r.file for k, r in enumerate(rows)}
    base = np.concatenate([[0], np.cumsum([r.n_tokens for r in rows])]).astype(np.int64)
    keyed = np.array([k for k, r in enumerate(rows) if r.low is not None], dtype=np.int64)
    low = np.array([r.low for r in rows if r.low is not None], dtype=np.int64)
    high = np.array([r.high for r in rows if r.low is not None], dtype=np.int64)
    nulls = [k for k, r in enumerate(rows) if r.nulls]

    def address(it):
        """The shards whose range holds a key: one, or those that a much repeated key fills."""
        for table in it:
            docs = table.column("doc_id").drop_null()
            docs = docs.to_numpy(zero_copy_only=False) if isinstance(docs, pa.Array) else docs.to_numpy()
            first, last = np.searchsorted(high, docs, "left"), np.searchsorted(low, docs, "right")
            count = np.maximum(last - first, 0)
            step = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            shard = keyed[np.repeat(first, count) + step]
            absent = nulls if table.column("doc_id").null_count else []
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.append(shard, absent).astype(np.int32)),
                 pa.array([*np.repeat(docs, count).tolist(), *[None] * len(absent)], pa.int64())],
                names=["shard", "doc_id"])

    def read(it):
        store, where = open_store(folder)
        at_hand, shard = None, None  # keys come in shard order: a shard is opened once
        for table in it:
            shards, docs = table.column("shard").to_numpy(), table.column("doc_id")
            for k in np.unique(shards).tolist():
                if k != at_hand:
                    if shard is not None:
                        shard.source.close()
                    at_hand, shard = k, Shard(store.open_input_file(f"{where.rstrip('/')}/{files[k]}"))
                mine = docs.filter(pa.array(shards == k))
                out = []
                if mine.null_count:
                    out += [(None, base[k] + at, len(ids), zlib.crc32(ids.astype("<u4")))
                            for at, ids in shard.without_key()]
                    mine = mine.drop_null()
                mine = np.array(mine.to_pylist(), dtype=np.int64)
                for doc, slot in zip(mine.tolist(), shard.lookup(mine).tolist(), strict=True):
                    if slot >= 0:
                        out += [(doc, base[k] + at, len(ids), zlib.crc32(ids.astype("<u4")))
                                for at, ids in shard.documents(slot)]
                for a in range(0, len(out), 10_000):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, pa.int64()) for c in zip(*out[a:a + 10_000], strict=True)],
                        names=["doc_id", "start", "n_tokens", "ids_crc32"])
        if shard is not None:
            shard.source.close()

    wanted = (keys.select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
              .mapInArrow(address, "shard int, doc_id long")
              .repartitionById(max(1, len(rows)), F.col("shard"))
              .sortWithinPartitions("shard", "doc_id"))
    return wanted.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_store(docs: DataFrame, tokenizer: str | None = None,
                rows_per_shard: int = ROWS_PER_SHARD) -> DataFrame:
    """Write all documents as shards and read each back through the index."""
    folder = scratch(docs.sparkSession, "tokens")
    manifest = write_shards(docs, folder, tokenizer, rows_per_shard=rows_per_shard)
    return read_documents(docs.select("doc_id"), manifest, folder)
