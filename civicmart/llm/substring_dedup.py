"""Substring dedup: repeated passages found by backward search in FM-indexes, one per shard.

Words are maximal runs without ASCII white space, unchanged. A window is ``window``
consecutive words of one document. A window whose words also start in a document with a
smaller doc_id is repeated, and all words it covers go.

1. *Shards by content.* A window's key is the smallest hash of its ``gram``-word grams, so
   equal windows have equal keys wherever they stand, and neighbouring windows mostly share
   theirs: a document falls into *pieces*, runs of windows of one key. Only keys that two
   texts hold can matter; pieces of other keys are left where they are. A key of very many
   rows (a gram in a third of all documents) is replaced by the hash of the whole window, so
   that no shard depends on how often a gram is used.
2. *Index.* A shard holds the pieces of some keys; the distinct ones, each with its smallest
   doc_id, are put into a compressed FM-index (``fm_index``).
3. *Matching statistics.* The pieces are streamed through the index of their shard: backward search
   gives for each word the longest match that starts there. A stretch of at least ``window``
   words is an interval of rows, and the smallest doc_id among them is that of the first
   document holding the window.
4. *Removal.* Each occurrence of a piece loses the windows with a first document smaller than
   its own; the intervals are joined back to the texts and the words dropped. The joins before
   and after the search read one exchange of the texts.

Windows that are themselves in very many rows are merged before they are sent anywhere. Their list
has a proven bound: tasks report what is above a share of their batch, so at most ``1 / share``
windows can be listed and none of twice that share is missed. They are searched in an index
of their own and looked up by their text where the words are dropped. The same holds for
frequent keys.

Defined results: null and empty texts have no words; a null doc_id counts as larger than every
doc_id, all rows without one as one document; rows sharing a doc_id are one document (what they share stays in each); texts shorter than a
window keep all; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from civicmart.llm.common import scratch, stored
from civicmart.llm.fm_index import FMIndex
from civicmart.llm.textmodel import mixed
from civicmart.llm.tokenize import batches

WINDOW, GRAM = 13, 5
SHARD_WORDS = 1_000_000  # of a shard, if all of its windows were repeated
HOT_SHARE = 1e-4       # a key is frequent from this share of all rows on: at most 1 / HOT_SHARE keys
RUN = 64               # windows of a piece at most; longer runs of a key are cut
BATCH_CHARS = 2_000_000
MAX_ID = (1 << 63) - 1

_FACTOR = 0x9E3779B97F4A7C15
_INVERSE = pow(_FACTOR, -1, 1 << 64)


_BYTE = mixed(np.arange(1, 257, dtype=np.uint64) << np.uint64(20))
_POWERS = {base: np.ones(1, np.uint64) for base in (_FACTOR, _INVERSE)}


def _powers(base: int, n: int) -> np.ndarray:
    """The first ``n`` powers, kept up to a batch's usual size."""
    known = _POWERS[base]
    if len(known) < n:
        steps = np.full(max(n, 2 * BATCH_CHARS), base, np.uint64)
        steps[0] = 1
        known = np.multiply.accumulate(steps)
        if n <= 2 * BATCH_CHARS:
            _POWERS[base] = known
    return known[:n]


class Words:
    """The words of a batch of texts: row, hash and, joined by single spaces, their bytes."""

    def __init__(self, texts: pa.Array) -> None:
        texts = texts.cast(pa.large_binary())
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
        offsets = offsets - offsets[0]
        self.offsets = offsets
        n = len(data)
        solid = (data != 32) & ((data < 9) | (data > 13))
        edge = np.zeros(n + 1, dtype=bool)  # a row begins here: no word goes across
        edge[offsets] = True
        before = np.concatenate([[False], solid[:-1]]) if n else solid
        after = np.concatenate([solid[1:], [False]]) if n else solid
        self.starts = np.flatnonzero(solid & (edge[:-1] | ~before))
        self.ends = np.flatnonzero(solid & (edge[1:] | ~after)) + 1
        # Row of each word: the rows that begin at or before it; of empty ones the last counts.
        self.row = np.searchsorted(offsets, self.starts, "right") - 1
        self.size = self.ends - self.starts
        self._data, self._solid = data, solid

    def hashes(self) -> np.ndarray:
        """64-bit polynomial hashes of the words."""
        n = len(self._data)
        with np.errstate(over="ignore"):
            sums = np.concatenate([[np.uint64(0)], np.cumsum(_BYTE[self._data] * _powers(_FACTOR, n))])
            own = (sums[self.ends] - sums[self.starts]) * _powers(_INVERSE, n)[self.starts]
            return mixed(own ^ (own >> np.uint64(31)))

    def joined(self) -> tuple[bytes, np.ndarray]:
        """All words, a space behind each, and where each begins."""
        at = np.cumsum(self.size + 1) - (self.size + 1)
        out = np.full(int(self.size.sum()) + len(self.size), 32, dtype=np.uint8)
        solid = self._data[self._solid]
        out[np.arange(len(solid)) + np.repeat(np.arange(len(self.size)), self.size)] = solid
        return out.tobytes(), at


def _rolled(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of each ``n`` consecutive words."""
    last = len(hashes) - n + 1
    with np.errstate(over="ignore"):
        sums = np.concatenate([[np.uint64(0)], np.cumsum(hashes * _powers(_FACTOR, len(hashes)))])
        out = (sums[n:] - sums[:last]) * _powers(_INVERSE, last)
    return mixed(out ^ (out >> np.uint64(32)))


def _among(values: np.ndarray, listed: np.ndarray) -> np.ndarray:
    if not len(listed):
        return np.zeros(len(values), dtype=bool)
    return listed[np.minimum(np.searchsorted(listed, values), len(listed) - 1)] == values


class Windows:
    """Windows of a batch: the first word (``at``) and the key of each."""

    def __init__(self, words: Words, window: int, gram: int, grams_hot: np.ndarray) -> None:
        if len(words.row) < window:
            self.at = self.key = self.whole = np.zeros(0, np.int64)
            return
        hashes = words.hashes()
        grams, last = _rolled(hashes, gram), len(words.row) - window + 1
        least, wide = grams, 1  # minima of stretches, doubled as far as they fit
        while wide < window - gram + 1:
            step = min(wide, window - gram + 1 - wide)
            least, wide = np.minimum(least[:len(least) - step], least[step:]), wide + step
        inside = words.row[:last] == words.row[window - 1:]
        self.at = np.flatnonzero(inside)
        self.whole = _rolled(hashes, window)[inside].view(np.int64)
        gram_key = least[inside].view(np.int64)
        self.key = np.where(_among(gram_key, grams_hot), self.whole, gram_key)


def _texts(docs: DataFrame) -> DataFrame:
    """doc_id, doc (null as the largest), routing hash of the row, text."""
    doc = F.col("doc_id").cast("long")
    return docs.select(doc.alias("doc_id"), F.coalesce(doc, F.lit(MAX_ID)).alias("doc"),
                       F.xxhash64(doc, "text").alias("r"),
                       F.coalesce("text", F.lit("")).alias("text"))


def _parts(tables):
    for table in tables:
        yield from batches(table, 4096, BATCH_CHARS)


def _column(part, name: str) -> pa.Array:
    c = part.column(name)
    return c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c


def frequent_keys(texts: DataFrame, window: int, gram: int, share: float) -> tuple[np.ndarray, np.ndarray, int]:
    """Keys and windows that hold more than about ``share`` of all rows, sorted; and the number of windows."""

    def report(it):
        for part in _parts(it):
            found = Windows(Words(_column(part, "text")), window, gram, np.zeros(0, np.int64))
            for kind, keys in ((0, found.key), (1, found.whole)):
                keys = np.sort(keys)
                first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[:len(keys)])
                values, counts = keys[first], np.diff(np.append(first, len(keys)))
                often = counts > max(1, share * len(keys))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.append(np.full(often.sum(), kind), kind).astype(np.int32)),
                     pa.array(np.append(values[often], 0), mask=np.append(np.zeros(often.sum(), bool), True)),
                     pa.array(np.append(counts[often], len(keys)).astype(np.int64))],
                    names=["kind", "key", "n"])

    counted = stored(texts.select("text").mapInArrow(report, "kind int, key long, n long")
                     .groupBy("kind", "key").agg(F.sum("n").alias("n")),
                     scratch(texts.sparkSession, "substring-frequent"))
    total = max([r.n for r in counted.where("key IS NULL").collect()], default=0)  # two rows
    limit = max(500, int(share * total))
    rows = counted.where(F.col("key").isNotNull() & (F.col("n") > limit)).collect()  # 2 / share at most
    grams, windows = (np.sort(np.array([r.key for r in rows if r.kind == k], dtype=np.int64)) for k in (0, 1))
    return grams, windows, total


def frequent_windows(texts: DataFrame, window: int, hot: np.ndarray) -> dict[bytes, int]:
    """The text of each frequent window and the smallest doc_id that holds it, by an index of their own."""
    if not len(hot):
        return {}
    spark = texts.sparkSession
    listed = spark.sparkContext.broadcast(hot)

    def occurrences(it):
        for part in _parts(it):
            words = Words(_column(part, "text"))
            found = Windows(words, window, 1, np.zeros(0, np.int64))
            at = found.at[_among(found.whole, listed.value)]
            joined, begins = words.joined()
            ends = np.append(begins, len(joined))[at + window] - 1
            least: dict[bytes, int] = {}
            docs = _column(part, "doc").to_numpy()[words.row[at]]
            for s, e, doc in zip(begins[at].tolist(), ends.tolist(), docs.tolist(), strict=True):
                text = joined[s:e]
                least[text] = min(doc, least.get(text, MAX_ID))
            yield pa.RecordBatch.from_arrays([pa.array(list(least), pa.binary()),
                                              pa.array(list(least.values()), pa.int64())], names=["piece", "doc"])

    distinct = texts.mapInArrow(occurrences, "piece binary, doc long").groupBy("piece").agg(F.min("doc").alias("doc"))
    # One shard: no more than 1 / share windows.
    told = (distinct.select(F.lit(0).alias("shard"), "doc", F.lit(0).cast("long").alias("r"),
                            F.lit(0).cast("long").alias("start"), "piece")
            .groupBy("shard").applyInArrow(lambda t: first_documents(t, window), "piece binary, doc long"))
    return {bytes(r.piece): r.doc for r in told.collect()}


def shared_keys(texts: DataFrame, window: int, gram: int, hot: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """(r, keys): for each text the keys that some other text holds too, but for frequent windows."""
    lists = texts.sparkSession.sparkContext.broadcast(hot)

    def keys(it):
        grams_hot, windows_hot = lists.value
        for part in _parts(it):
            words = Words(_column(part, "text"))
            found = Windows(words, window, gram, grams_hot)
            cold = ~_among(found.whole, windows_hot)
            row, key = words.row[found.at[cold]], found.key[cold]
            new = np.ones(len(row), dtype=bool)
            new[1:] = (row[1:] != row[:-1]) | (key[1:] != key[:-1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(key[new]), _column(part, "r").take(pa.array(row[new]))], names=["key", "r"])

    same = Window.partitionBy("key")  # no key in it is frequent
    return (texts.select("r", "text").mapInArrow(keys, "key long, r long")
            .withColumns({"low": F.min("r").over(same), "high": F.max("r").over(same)}).where("low <> high")
            .groupBy("r").agg(F.collect_set("key").alias("keys")))


PIECES = "shard long, doc long, r long, start long, piece binary"


def pieces(with_keys: DataFrame, window: int, gram: int, hot: tuple[np.ndarray, np.ndarray],
           shards: int) -> DataFrame:
    """Runs of windows that may be repeated, with their words, of (doc, r, text, keys, ..)."""
    lists = with_keys.sparkSession.sparkContext.broadcast(hot)

    def cut(it):
        grams_hot, windows_hot = lists.value
        for part in _parts(it):
            words = Words(_column(part, "text"))
            found = Windows(words, window, gram, grams_hot)
            listed = _column(part, "keys")
            row = words.row[found.at]
            ends = np.searchsorted(row, np.arange(part.num_rows), "right")
            wanted, begin = np.zeros(len(row), dtype=bool), 0
            for k, end in enumerate(ends.tolist()):
                if end > begin:
                    wanted[begin:end] = _among(found.key[begin:end], np.sort(listed[k].values.to_numpy()))
                begin = end
            wanted &= ~_among(found.whole, windows_hot)
            at, key, row = found.at[wanted], found.key[wanted], row[wanted]
            if not len(at):
                continue
            first = _run_starts(at, row, key)
            since = np.arange(len(at)) - np.repeat(first, np.diff(np.append(first, len(at))))
            first = np.flatnonzero(since % RUN == 0)
            last = np.append(first[1:], len(at)) - 1
            joined, begins = words.joined()
            a, b = at[first], at[last] + window  # first word, and the word behind the last
            ends_at = np.append(begins, len(joined))[b] - 1
            text = [joined[s:e] for s, e in zip(begins[a].tolist(), ends_at.tolist(), strict=True)]
            row = row[first]
            yield pa.RecordBatch.from_arrays(
                [pa.array((mixed(key[first].view(np.uint64)) % np.uint64(shards)).astype(np.int64)),
                 _column(part, "doc").take(pa.array(row)), _column(part, "r").take(pa.array(row)),
                 pa.array(a - np.searchsorted(words.row, row, "left")), pa.array(text, pa.binary())],
                names=["shard", "doc", "r", "start", "piece"])

    return with_keys.mapInArrow(cut, PIECES)


def _run_starts(at: np.ndarray, *same: np.ndarray) -> np.ndarray:
    """Where runs of consecutive places with equal values begin."""
    new = np.ones(len(at), dtype=bool)
    new[1:] = at[1:] != at[:-1] + 1
    for values in same:
        new[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(new)


class _Shard:
    """The distinct pieces of a shard, indexed, and each one's repeated windows."""

    def __init__(self, table: pa.Table, window: int) -> None:
        places: dict[bytes, int] = {}
        self.piece = np.fromiter((places.setdefault(p, len(places)) for p in table.column("piece").to_pylist()),
                                 np.int64, table.num_rows)
        self.doc = table.column("doc").to_numpy()
        self.texts = list(places)
        n = len(places)
        low, high = np.full(n, MAX_ID), np.full(n, -MAX_ID - 1)
        np.minimum.at(low, self.piece, self.doc)
        np.maximum.at(high, self.piece, self.doc)
        words = [t.split(b" ") for t in places]
        sizes = np.fromiter(map(len, words), np.int64, n)
        ids: dict[bytes, int] = {}
        flat = np.fromiter((ids.setdefault(w, len(ids) + 1) for ws in words for w in ws), np.int64, int(sizes.sum()))
        begins = np.cumsum(sizes + 1) - (sizes + 1)
        text = np.zeros(int((sizes + 1).sum()), dtype=np.int64)
        text[np.arange(len(flat)) + np.repeat(np.arange(n), sizes)] = flat
        index = FMIndex(text, window)
        length, row = index.matching_statistics(text, begins, begins + sizes)
        # The first document of every block of rows that agree on a window.
        owner = np.repeat(np.arange(n), sizes + 1)
        starts = index.starts(window)
        first_doc = np.minimum.reduceat(low[owner[index.order]], starts[:-1])
        at = np.flatnonzero(length >= window)
        least = first_doc[np.searchsorted(starts, row[at], "right") - 1]
        at, least = at[least < high[owner[at]]], least[least < high[owner[at]]]
        first = _run_starts(at, owner[at], least)
        last = np.append(first[1:], len(at))[:len(first)] - 1
        # Runs of windows by piece: first and last window, smallest doc_id that holds them.
        self.of = owner[at[first]]
        self.a, self.b = at[first] - begins[self.of], at[last] - begins[self.of]
        self.least, self.low = least[first], low


def repeated_in_shard(table: pa.Table, window: int) -> pa.Table:
    """(doc, r, first, last): word intervals that occurrences in a shard lose."""
    shard = _Shard(table, window)
    begin = np.searchsorted(shard.of, shard.piece, "left")
    count = np.searchsorted(shard.of, shard.piece, "right") - begin
    row = np.repeat(np.arange(len(shard.piece)), count)
    run = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(begin, count)
    gone = shard.least[run] < shard.doc[row]
    row, run = row[gone], run[gone]
    start = table.column("start").to_numpy()[row]
    return pa.table([pa.array(shard.doc[row]), pa.array(table.column("r").to_numpy()[row]),
                     pa.array(start + shard.a[run]), pa.array(start + shard.b[run] + window - 1)],
                    names=["doc", "r", "first", "last"])


def first_documents(table: pa.Table, window: int) -> pa.Table:
    """Each distinct piece (a single window here) with the smallest doc_id of its rows in the index."""
    shard = _Shard(table, window)
    return pa.table([pa.array(shard.texts, pa.binary()), pa.array(shard.low)], names=["piece", "doc"])


KEPT = "doc_id long, n_words long, n_removed long, kept_text string"


def substring_dedup(docs: DataFrame, window: int = WINDOW, gram: int = GRAM,
                    shard_words: int = SHARD_WORDS, hot_share: float = HOT_SHARE) -> DataFrame:
    """Drop repeated passages of ``docs``; returns doc_id, n_words, n_removed, kept_text."""
    spark = docs.sparkSession
    gram = min(gram, window)
    texts = _texts(docs)
    *hot, n_windows = frequent_keys(texts, window, gram, hot_share)
    hot = tuple(hot)
    # A run of one key has about (window - gram + 2) / 2 windows, and window - 1 words more.
    run = (window - gram + 2) / 2
    shards = max(1, -(-int(n_windows * (run + window - 1) / run) // shard_words))
    often = spark.sparkContext.broadcast((hot[1], frequent_windows(texts, window, hot[1])))
    dealt = texts.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "r")
    # Both joins take all columns of the texts, so that they read the same exchange.
    found = pieces(dealt.join(shared_keys(texts, window, gram, hot), "r"), window, gram, hot, shards)
    gone = (found.groupBy("shard").applyInArrow(lambda t: repeated_in_shard(t, window),
                                                "doc long, r long, first long, last long")
            .groupBy("r").agg(F.collect_set(F.struct("doc", "first", "last")).alias("gone")))

    def drop(it):
        windows_hot, first_of = often.value
        for part in _parts(it):
            words = Words(_column(part, "text"))
            n = np.bincount(words.row, minlength=part.num_rows)
            word0 = np.cumsum(n) - n
            docs_of, listed = _column(part, "doc").to_numpy(), _column(part, "gone")
            stay = np.ones(len(words.row) + 1, dtype=bool)
            joined, begins = words.joined()
            ends = np.append(begins, len(joined))[1:] - 1
            for k, spans in enumerate(listed):
                if spans.is_valid:
                    own, first, last = (spans.values.field(c).to_numpy() for c in range(3))
                    for a, b in zip(first[own == docs_of[k]].tolist(), last[own == docs_of[k]].tolist(), strict=True):
                        stay[word0[k] + a:word0[k] + b + 1] = False
            if len(windows_hot):
                found = Windows(words, window, 1, np.zeros(0, np.int64))
                for at in found.at[_among(found.whole, windows_hot)].tolist():
                    text = joined[begins[at]:ends[at + window - 1]]
                    if first_of.get(text, MAX_ID) < docs_of[words.row[at]]:
                        stay[at:at + window] = False
            stay = stay[:-1]
            kept = np.bincount(words.row[stay], minlength=part.num_rows)
            texts_kept = []
            for k, (a, m, left) in enumerate(zip(word0.tolist(), n.tolist(), kept.tolist(), strict=True)):
                if left == m:
                    texts_kept.append(joined[begins[a]:ends[a + m - 1]] if m else b"")
                else:
                    texts_kept.append(b" ".join([joined[begins[i]:ends[i]]
                                                 for i in (a + np.flatnonzero(stay[a:a + m])).tolist()]))
            yield pa.RecordBatch.from_arrays(
                [_column(part, "doc_id"), pa.array(n), pa.array(n - kept), pa.array(texts_kept, pa.string())],
                names=["doc_id", "n_words", "n_removed", "kept_text"])

    return dealt.join(gone, "r", "left").mapInArrow(drop, KEPT)
