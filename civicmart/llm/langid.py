"""Language ID by word-first backoff.

Model: for the words seen in training, per-language log frequencies; below them tables
of character n-grams of 5, 4, 3, 2 and 1 (with word boundaries), likewise. A known word
is scored by its own log frequencies. An unseen word is covered by n-grams, longest
first: wherever no n-gram of an order is known, the next shorter order is tried. The
document's score is the posterior of its best language under the summed word scores,
tempered by the square root of the number of words (words of a text aren't independent).

Training reads at most about ``max_docs`` labelled documents, the same number of each language as far as it
has them; counts are aggregated in Spark. For each language the ``max_words`` and ``max_grams``
(each order) most frequent entries are kept, so small languages aren't crowded out by large ones.
Tasks write the tables to the shared folder and workers read them there: the model never passes the driver.

Defined results: null text, or text without a letter, is ``und`` with score 0; so is any
text if no labelled row exists. Null doc_id is never trained on. Repeated rows are rows
each, in training too (a row that makes up most of a table is bounded there); ties between languages go to
the alphabetically first; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import pickle
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.dataset as pads
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from civicmart.llm.common import fold, sampled, scratch
from civicmart.llm.files import open_store
from civicmart.llm.textmodel import letter_words
from civicmart.llm.tokenize import batches

MAX_DOCS = 10_000
MAX_WORDS = 60_000   # of a language
MAX_GRAMS = 10_000   # of a language and order
MIN_SCORE = 0.5      # of a document kept by ``with_language``: likelier than all other languages together
ORDERS = (5, 4, 3, 2, 1)
HELD_WORDS = 200_000  # distinct words a worker counts before it hands them on
CACHE = 150_000  # unseen words remembered by a worker


def grams(word: str, n: int) -> list[str]:
    marked = word if n == 1 else f"^{word}$"
    return [marked[i:i + n] for i in range(len(marked) - n + 1)]


def _counts(rows: DataFrame) -> DataFrame:
    """(kind, item, lang, n): words (kind 0) and n-grams (kind n), counted once a partition first."""

    def count(it):
        words: dict[str, Counter] = {}
        for table in it:
            for part in batches(table, 256):
                for lang, text in zip(part.column("lang").to_pylist(),
                                      part.column("text").to_pylist(), strict=True):
                    words.setdefault(lang, Counter()).update(letter_words((text or "").lower()))
                if sum(map(len, words.values())) > HELD_WORDS:
                    yield from _batches(words)
                    words = {}
        yield from _batches(words)

    def _batches(words):
        # N-grams of each distinct word once, times its count: one batch a kind and language.
        for lang, own in words.items():
            for kind in (0, *ORDERS):
                items: Counter = own if kind == 0 else Counter()
                if kind:
                    for word, k in own.items():
                        for g in grams(word, kind):
                            items[g] += k
                if items:
                    n = len(items)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([kind] * n, pa.int32()), pa.array(list(items), pa.string()),
                         pa.array([lang] * n, pa.string()), pa.array(list(items.values()), pa.int64())],
                        names=["kind", "item", "lang", "n"])

    return (rows.select("lang", "text").mapInArrow(count, "kind int, item string, lang string, n long")
            .groupBy("kind", "item", "lang").agg(F.sum("n").alias("n")))


@dataclass(frozen=True)
class Fitted:
    """Where the tables of a model lie, its languages, and the counts by (kind, language)."""

    langs: list[str]
    totals: dict[tuple[int, str], int]
    folder: str

    def load(self) -> Model:
        """The model, read by a task (0.4 s for four languages)."""
        tables: dict[int, dict[str, int]] = {}
        rows: dict[int, np.ndarray] = {}
        store, where = open_store(self.folder)
        for kind in (0, *ORDERS):
            total = np.array([self.totals.get((kind, lang), 0) + 1 for lang in self.langs], dtype=float)
            found = pads.dataset(where, filesystem=store, format="parquet").to_table(
                columns=["item", "at", "ns"], filter=pads.field("kind") == kind)
            at, ns = (found.column(c).combine_chunks() for c in ("at", "ns"))
            row = np.repeat(np.arange(len(found)), np.diff(at.offsets.to_numpy()) if len(found) else 0)
            counts = np.full((len(found), len(total)), 0.5)
            counts[row, at.flatten().to_numpy()] += ns.flatten().to_numpy()
            tables[kind] = dict(zip(found.column("item").to_pylist(), range(len(found)), strict=True))
            rows[kind] = np.log(counts / total).astype(np.float32)
        return Model(self.langs, tables, rows)


class Model:
    """Languages and log-probabilities: ``tables[0]`` gives the row of a word in ``rows[0]``, ``tables[n]`` of an n-gram."""

    def __init__(self, langs: list[str], tables: dict[int, dict[str, int]], rows: dict[int, np.ndarray]) -> None:
        self.langs, self.tables, self.grams = langs, tables, rows
        self.unknown = np.zeros(len(langs), np.float32)
        self.known = len(tables.get(0, {}))
        self.rows = np.zeros((self.known + CACHE, len(langs)), np.float32)
        if self.known:
            self.rows[:self.known] = rows[0]
        self._forget()

    def _forget(self) -> None:
        """Rows of known words stay; rows of unseen words are added as they come."""
        self.place = dict(self.tables.get(0, {}))

    def _places(self, words) -> list[int]:
        """Row of each word's log-probabilities: itself if known, else by backoff."""
        if len(self.place) + len(words) > self.known + CACHE:
            self._forget()
        place = self.place
        out = []
        for word in words:
            at = place.get(word)
            if at is None:
                at = len(place)
                if at == len(self.rows):  # a text of more unseen words than are remembered
                    self.rows = np.concatenate([self.rows, np.zeros((CACHE, len(self.langs)), np.float32)])
                place[word] = at
                self.rows[at] = self._backoff(word)
            out.append(at)
        return out

    def _backoff(self, word: str) -> np.ndarray:
        # Longest n-grams first; stretches they don't cover are tried at the next order.
        marked, total, used = f"^{word}$", self.unknown.copy(), 0
        open_spans = [(0, len(marked))]
        for n in ORDERS:
            table, own, left = self.tables[n], self.grams[n], []
            for lo, hi in open_spans:
                start = at = lo
                while at + n <= hi:
                    known = table.get(marked[at:at + n])
                    if known is None:
                        at += 1
                        continue
                    if at > start:
                        left.append((start, at))
                    total += own[known]
                    used += 1
                    at += n
                    start = at
                if start < hi:
                    left.append((start, hi))
            open_spans = left
        return total / max(1, used)  # an unseen word weighs as one piece of evidence

    def predict(self, text: str | None) -> tuple[str, float]:
        words = Counter(letter_words(text.lower())) if text else None
        if not words or not self.langs:
            return "und", 0.0
        times = np.fromiter(words.values(), dtype=float, count=len(words))
        total = times @ self.rows[self._places(words)]
        total = (total - total.max()) / np.sqrt(times.sum())
        p = np.exp(total)
        best = int(p.argmax())
        return self.langs[best], float(p[best] / p.sum())


def train(labelled: DataFrame, max_docs: int = MAX_DOCS, max_words: int = MAX_WORDS,
          max_grams: int = MAX_GRAMS) -> Fitted:
    """Model of the rows of ``labelled`` (doc_id, text, lang); lang must not be null."""
    spark = labelled.sparkSession
    known = labelled.where("lang IS NOT NULL AND text IS NOT NULL AND doc_id IS NOT NULL") \
        .select("doc_id", "text", "lang")
    rows = sampled(known, max_docs, "langid", by="lang")
    path = scratch(spark, "langid-counts")
    _counts(rows.repartition(F.xxhash64("doc_id", "text"))).write.parquet(path)
    counted = spark.read.schema("kind int, item string, lang string, n long").parquet(path)
    sums = counted.groupBy("kind", "lang").agg(F.sum("n").alias("n")).collect()  # kinds x languages
    langs = sorted({r.lang for r in sums})
    place = F.create_map(*[F.lit(x) for k, lang in enumerate(langs) for x in (lang, k)]) if langs else F.lit(None)
    most = F.row_number().over(Window.partitionBy("kind", "lang").orderBy(F.desc("n"), "item"))
    folder = scratch(spark, "langid-model")
    if langs:
        (counted.withColumn("kept", most <= F.when(F.col("kind") == 0, max_words).otherwise(max_grams))
         .groupBy("kind", "item").agg(F.max("kept").alias("kept"), F.collect_list(F.struct(
             place[F.col("lang")].alias("at"), "n")).alias("by"))
         .where("kept").select("kind", "item", F.col("by.at").alias("at"), F.col("by.n").alias("ns"))
         .write.parquet(folder))
    return Fitted(langs, {(r.kind, r.lang): r.n for r in sums}, folder)


def predict(docs: DataFrame, fitted: Fitted) -> DataFrame:
    """doc_id, lang_pred, score of every document; only the text is looked at."""
    state = pickle.dumps(fitted)

    def run(it):
        own = pickle.loads(state).load() if fitted.langs else None
        for table in it:
            for part in batches(table, 512):
                got = [own.predict(t) if own else ("und", 0.0) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array([g[0] for g in got], pa.string()),
                     pa.array([g[1] for g in got], pa.float64())],
                    names=["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, lang_pred string, score double")


def identify(docs: DataFrame, max_docs: int = MAX_DOCS) -> DataFrame:
    """Train on the training folds of ``docs`` and predict all of them."""
    model = train(docs.where(fold(F.col("doc_id"), 3) != 1), max_docs)
    return predict(docs, model).select(
        "doc_id", F.coalesce(fold(F.col("doc_id"), 3) == 1, F.lit(False)).alias("held_out"),
        "lang_pred", "score")


def with_language(docs: DataFrame, max_docs: int = MAX_DOCS, languages: list[str] | None = None,
                  min_score: float = MIN_SCORE) -> DataFrame:
    """Rows of ``docs`` whose language is found; all columns as they came.

    A row stays if a language is predicted for it (not ``und``), with at least ``min_score``, and
    it is one of ``languages`` (default: any learned one). Without a labelled row nothing can be
    predicted; rows whose text has a letter then stay.
    """
    model = train(docs.where(fold(F.col("doc_id"), 3) != 1), max_docs)
    state = pickle.dumps(model)
    at = docs.columns.index("text")

    def stays(own: Model | None, text: str | None) -> bool:
        if own is None:
            return bool(text and letter_words(text.lower()))
        lang, score = own.predict(text)
        if lang == "und" and "und" not in own.langs or not text:
            return False
        return score >= min_score and (languages is None or lang in languages)

    def run(it):
        own = pickle.loads(state).load() if model.langs else None
        for table in it:
            for part in batches(table, 512):
                keep = [stays(own, t) for t in part.column(at).to_pylist()]
                yield part.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
