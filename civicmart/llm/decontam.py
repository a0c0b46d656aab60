"""Benchmark decontamination by SimHash over item-sized windows (DataFrame code only).

Words are maximal runs of letters and digits, lower-cased; shingles are five consecutive words (an item of
fewer words is one shingle). A document is contaminated by an item if some window of the
document, as long as the item (the whole document where that is shorter), has a weighted
shingle similarity (sum of smaller over sum of larger counts) of at least ``similarity``.

1. *Anchors.* A window that similar holds at most ``missing`` shingles that the item
   lacks, so of any ``missing + 1`` positions in it one is a shingle of the item. Every
   ``stride``-th shingle position of every document, with the stride small enough for
   the shortest items, therefore meets each such window; positions are looked up in the
   shingles of the benchmark. This only skips windows that can't be similar.
2. *Windows.* Around each anchor, all windows of the anchored item's length are
   fingerprinted: SimHash of 64 bits over the window's shingles.
3. *Multi-index.* Fingerprints are cut into ``radius + 1`` blocks; a window within
   ``radius`` bits of an item agrees with it on a block. A window is joined with the items of
   its own anchors on (item, block number, block value), and bits are counted, so items that
   share no shingle with it are never met. Where the benchmark is too large to broadcast,
   blocks are dealt over tasks by the document.
4. *Exact check.* The pairs left are verified by exact weighted-shingle similarity.

The radius is the one lossy choice: at similarity 0.8 a window differs from its item in
9.7 bits on average (standard deviation 2.9), so 23 bits lie 4.6 deviations off.

Benchmark tables are broadcast only if a count proves at most BROADCAST_ROWS hashes. Defined results: null or empty texts and items without a word
match nothing; a null item_id is an item like others; rows sharing a doc_id are judged as rows each and reported once; repeated
items are reported each; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicmart.llm.common import scratch, stored

SHINGLE, SIMILARITY, RADIUS = 5, 0.8, 23
BROADCAST_ROWS = 2_000_000  # shingle hashes of 8 to 24 bytes


def words(text: Column) -> Column:
    """Lower-cased words; null and empty texts have none."""
    parts = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+")
    return F.filter(parts, lambda w: w != "")


def _shingle_at(hashes: Column, at: Column, shingle: int) -> Column:
    return F.xxhash64(*[F.get(hashes, at + k) for k in range(shingle)])


def _shingles(hashes: Column, shingle: int) -> Column:
    """Hashes of all shingles; a sequence shorter than a shingle is one (none if empty)."""
    n = F.size(hashes)
    return F.when(n == 0, F.array().cast("array<bigint>")).otherwise(F.transform(
        F.sequence(F.lit(0), F.greatest(n - shingle, F.lit(0))),
        lambda i: _shingle_at(hashes, i, shingle)))


def _bounded(df: DataFrame, rows: int) -> DataFrame:
    """A broadcast hint for a table counted to be small; otherwise Spark shuffles."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def stride_for(n: int, similarity: float) -> int:
    """Largest step that hits a shared shingle in every window similar to an item of ``n`` shingles."""
    best = n
    for window in range(max(1, math.ceil(similarity * n)), n + 1):
        shared = math.ceil(similarity / (1 + similarity) * (window + n) - 1e-9)
        best = min(best, max(1, window // (window - shared + 1)))
    return best


def bit_counts(h: Column) -> list[Column]:
    """For each of 64 bits: in how many rows of a group it is set."""
    return [F.sum(F.shiftrightunsigned(h, k).bitwiseAND(F.lit(1))).alias(f"b{k}") for k in range(64)]


def fingerprint(total: Column) -> Column:
    """The SimHash from the 64 counts: a bit is 1 if set in over half the shingles."""
    out = F.lit(0).cast("long")
    for k in range(64):
        out = out.bitwiseOR(F.when(F.col(f"b{k}") * 2 > total,
                                   F.lit((1 << k) - (1 << 64 if k == 63 else 0)).cast("long"))
                            .otherwise(F.lit(0).cast("long")))
    return out


def simhashes(shingles: DataFrame, keys: list[str]) -> DataFrame:
    """One fingerprint ``fp`` and shingle count ``n_own`` for each group of shingle rows (``h``)."""
    counted = shingles.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_own"), *bit_counts(F.col("h")))
    return counted.select(*keys, "n_own", fingerprint(F.col("n_own")).alias("fp"))


def tagged(hashes: Column) -> Column:
    """The array with repeats told apart by their number, so that set operations count them."""
    repeated = F.transform(hashes, lambda x, i: F.xxhash64(x, F.size(F.filter(
        F.slice(hashes, 1, i), lambda y: y == x))))
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes),
                  F.transform(hashes, lambda x: F.xxhash64(x, F.lit(0)))).otherwise(repeated)


def block_keys(fp: Column, radius: int) -> Column:
    n = radius + 1
    cuts = [64 * k // n for k in range(n + 1)]
    return F.array(*[F.struct(F.lit(k).alias("block"), F.shiftrightunsigned(fp, cuts[k]).bitwiseAND(
        F.lit((1 << (cuts[k + 1] - cuts[k])) - 1)).cast("int").alias("value")) for k in range(n)])


SCORED = "doc_id long, th long, item long, item_id long, n_words int, start int, similarity double"


def matches(docs: DataFrame, benchmark: DataFrame, shingle: int = SHINGLE,
            similarity: float = SIMILARITY, radius: int = RADIUS) -> DataFrame:
    """One row per contaminated document and item: doc_id, item_id, similarity, window_start, n_words."""
    best = _scored(docs, benchmark, shingle, similarity, radius) \
        .groupBy("doc_id", "item", "item_id", "n_words").agg(
            F.max(F.struct("similarity", (-F.col("start")).alias("s"))).alias("b"))
    return best.select("doc_id", F.col("item_id").cast("long").alias("item_id"),
                       F.col("b.similarity").alias("similarity"),
                       (-F.col("b.s")).alias("window_start"), "n_words")


def _scored(docs: DataFrame, benchmark: DataFrame, shingle: int = SHINGLE,
            similarity: float = SIMILARITY, radius: int = RADIUS) -> DataFrame:
    """The most similar window (the first of equals) of each text (doc_id, th) and item."""
    spark = docs.sparkSession
    items = stored(benchmark.select("item_id", words(F.col("text")).alias("w")).where(F.size("w") > 0)
                   .select("item_id", F.transform("w", lambda w: F.xxhash64(w)).alias("wh"),
                           F.size("w").alias("n_words"), F.least(F.size("w"), F.lit(shingle)).alias("k")),
                   scratch(spark, "bench-words"))
    out = spark.createDataFrame([], SCORED)
    for r in items.select("k").distinct().orderBy("k").collect():  # at most ``shingle`` rows
        out = out.unionByName(_windows(docs, items.where(F.col("k") == r.k), r.k, similarity, radius))
    return out


def _windows(docs: DataFrame, items: DataFrame, shingle: int, similarity: float, radius: int) -> DataFrame:
    """Windows similar to items whose shingles have ``shingle`` words each."""
    spark = docs.sparkSession
    # Items of the same words are one here; their item_ids come back at the end.
    named = stored(items.select(F.xxhash64("wh").alias("item"), "item_id", "n_words", "wh"),
                   scratch(spark, "bench-named"))
    items = stored(named.groupBy("item", "n_words").agg(F.first("wh").alias("wh"))
                   .select("item", "n_words", _shingles(F.col("wh"), shingle).alias("sh"))
                   .withColumn("n", F.size("sh")), scratch(spark, "bench-items"))
    # An anchor is a shingle and an item that holds it.
    holders = stored(items.select(F.explode("sh").alias("h"), "item", "n").distinct(),
                     scratch(spark, "bench-holders"))
    n_holders = holders.count()
    lengths, n_shingles = [], 0
    for r in items.groupBy("n").count().collect():  # distinct item lengths
        lengths.append(r.n)
        n_shingles += r["n"] * r["count"]
    stride = min(stride_for(n, similarity) for n in lengths)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("th"),
                       F.transform(words(F.col("text")), lambda w: F.xxhash64(w)).alias("wh")) \
        .where(F.size("wh") > 0)
    last = F.greatest(F.size("wh") - shingle, F.lit(0))
    probes = rows.select("doc_id", "th", F.explode(F.transform(
        F.sequence(F.lit(0), last, F.lit(stride)),
        lambda p: F.struct(p.alias("p"), _shingle_at(F.col("wh"), p, shingle).alias("h")))).alias("q")) \
        .select("doc_id", "th", "q.p", "q.h")
    anchors = probes.join(_bounded(holders, n_holders), "h")
    found = stored(anchors.groupBy("doc_id", "th").agg(
        F.collect_set(F.struct("item", "n", "p")).alias("at")), scratch(spark, "anchors"))

    # Windows of the anchored documents only.
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text") \
        .withColumn("th", F.xxhash64("text")) \
        .join(found.withColumnsRenamed({"doc_id": "_d", "th": "_t"}),
              F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("th") == F.col("_t"))) \
        .dropDuplicates(["doc_id", "th"]) \
        .select("doc_id", "th", "at", F.transform(words(F.col("text")), lambda w: F.xxhash64(w)).alias("wh"))
    texts = texts.select("doc_id", "th", "at", _shingles(F.col("wh"), shingle).alias("sh"))
    def reach(a):
        """Starts of the windows around an anchor, as long as its item."""
        return F.sequence(F.greatest(a["p"] - a["n"] + 1, F.lit(0)),
                          F.least(a["p"], F.greatest(F.size("sh") - a["n"], F.lit(0))))

    starts = F.array_distinct(F.flatten(F.transform("at", lambda a: F.transform(
        reach(a), lambda s: F.shiftleft(a["n"].cast("long"), 32) + s))))  # as one number: distinct by hashing
    windows = texts.withColumn("s", F.explode(starts)) \
        .withColumn("n", F.shiftright("s", 32).cast("int")) \
        .withColumn("start", F.col("s").bitwiseAND(F.lit(0xFFFFFFFF)).cast("int")) \
        .select("doc_id", "th", "n", "start", F.slice("sh", F.col("start") + 1, F.col("n")).alias("sh"))
    windows = stored(windows, scratch(spark, "windows"))

    keys = ["doc_id", "th", "n", "start"]
    prints = simhashes(windows.select(*keys, F.explode("sh").alias("h")), keys)
    item_prints = simhashes(items.select("item", F.explode("sh").alias("h")), ["item"])
    # A window is compared with the items of its anchors only.
    asked = (texts.select("doc_id", "th", "sh", F.explode("at").alias("a"))
             .select("doc_id", "th", F.col("a.n").alias("n"), F.col("a.item").alias("item"),
                     F.explode(reach(F.col("a"))).alias("start")).distinct())
    asked = asked.withColumnsRenamed({k: f"_{k}" for k in keys})
    prints = prints.join(asked, F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("th") == F.col("_th"))
                         & (F.col("n") == F.col("_n")) & (F.col("start") == F.col("_start"))) \
        .select(*keys, "item", "fp")
    item_blocks = stored(item_prints.select("item", F.col("fp").alias("item_fp"),
                                            F.explode(block_keys(F.col("fp"), radius)).alias("k"))
                         .select("item", "item_fp", "k.block", "k.value"),
                         scratch(spark, "bench-blocks"))
    n_blocks = item_blocks.count()
    probed = prints.select(*keys, "item", "fp", F.explode(block_keys(F.col("fp"), radius)).alias("k")) \
        .select(*keys, "item", "fp", "k.block", "k.value")
    on = ["item", "block", "value"]
    if n_blocks > BROADCAST_ROWS:  # an item may be that of very many windows: deal them by the document
        parts = 64
        probed = probed.withColumn("part", F.pmod(F.xxhash64("doc_id", "start"), F.lit(parts)))
        item_blocks = item_blocks.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
        on = ["part", *on]
    near = (probed.join(_bounded(item_blocks, n_blocks), on)
            .where(F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp"))) <= radius)
            .groupBy(*keys).agg(F.collect_set("item").alias("items")))

    # Exact weighted similarity of what is left, row by row: a window beside an item.
    own = windows.withColumnsRenamed({k: f"_{k}" for k in keys}).join(
        near, F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("th") == F.col("_th"))
        & (F.col("n") == F.col("_n")) & (F.col("start") == F.col("_start")))
    item_sets = stored(items.select("item", "n_words", tagged(F.col("sh")).alias("item_sh")),
                       scratch(spark, "bench-sets"))
    pairs = own.select("doc_id", "th", "n", "start", F.size("sh").alias("size"), tagged(F.col("sh")).alias("sh"),
                       F.explode("items").alias("item")).join(_bounded(item_sets, n_shingles), "item")
    scored = (pairs.withColumn("both", F.size(F.array_intersect("sh", "item_sh")))
              .withColumn("similarity", F.col("both") / (F.col("size") + F.col("n") - F.col("both")))
              .where(F.col("similarity") >= similarity))
    best = scored.groupBy("doc_id", "th", "item", "n_words").agg(
        F.max(F.struct("similarity", (-F.col("start")).alias("s"))).alias("b"))
    names = named.select("item", "item_id").distinct()
    return best.join(names, "item").select(
        "doc_id", "th", "item", F.col("item_id").cast("long").alias("item_id"), "n_words",
        (-F.col("b.s")).alias("start"), F.col("b.similarity").alias("similarity"))


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Rows of ``docs`` that no benchmark item contaminates; all columns as they came.

    A row is judged by its own text: others of its doc_id (or without one) stay.
    """
    flagged = _scored(docs.select("doc_id", "text"), benchmark) \
        .select(F.col("doc_id").alias("_flagged"), F.col("th").alias("_text_hash")).distinct()
    return docs.join(flagged, docs["doc_id"].eqNullSafe(flagged["_flagged"])
                     & (F.xxhash64(docs["text"]) == flagged["_text_hash"]), "left_anti")
