"""Exact dedup on an extendible-hash index kept in shared files (DataFrame code only).

Texts are equal when they are identical after deleting ASCII white space. The index
has one entry for each distinct text, with the text, in buckets addressed by a directory over the
leading bits of the text's 64-bit hash:

* the *directory* holds, for each prefix, its local depth and bucket; a bucket over
  ``bucket_rows`` entries is split on its next bit, and the directory doubles (global
  depth + 1) whenever a bucket as deep as the directory must split;
* each bucket's entries lie together, sorted by hash, in the files written by the
  *owner task* of its key range (``repartitionByRange`` on bucket and hash);
* entries of one hash form a *chain* (``chain`` 0, 1, ..) in their bucket, told apart by their bytes.

Entries are made by grouping on bucket, hash and the bytes of the whole normalised text
(partial aggregation keeps a hot text from meeting in one task); a later batch meets the entries
of earlier ones the same way. To look a row up, its prefix gives the bucket, the bucket and hash the
chain. A chain of one entry is the row's own, as its text was indexed; in a longer chain the
bytes decide.

Of a group one row stays: the one with the most code points, then the smallest doc_id, then the
smallest hash of its original text, then the one read first. Defined results: null text is the empty text; null doc_id loses every
tie against a non-null one; rows with the same doc_id and the same text count as rows each, and one of them stays; an empty
table gives an empty result; columns other than doc_id and text are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from civicmart.llm.common import SPACE_CLASS, salted_join, scratch, stored

MAX_DEPTH = 16


@dataclass(frozen=True)
class ExactIndex:
    """Entries (one per distinct text) and directory, both files in the shared folder."""

    entries: DataFrame
    directory: DataFrame
    depth: int


def normalised(text):
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE_CLASS + "+", "")


def _hashed(docs: DataFrame) -> DataFrame:
    text = F.col("text")
    return docs.select("doc_id", F.xxhash64("text").alias("th"),
                       F.char_length(F.coalesce(text, F.lit(""))).alias("n_chars"),
                       normalised(text).alias("norm")).withColumn("h", F.xxhash64("norm"))


def hashed_rows(docs: DataFrame) -> DataFrame:
    """(uid, doc_id, th, n_chars, h) of each row, without its text, numbered and stored."""
    return stored(_hashed(docs).drop("norm").withColumn("uid", F.monotonically_increasing_id()),
                  scratch(docs.sparkSession, "exact-rows"))


def _prefix(h, depth: int):
    """The leading ``depth`` bits of a 64-bit hash as a number."""
    return F.lit(0).cast("int") if depth == 0 else F.shiftrightunsigned(h, 64 - depth).cast("int")


def build_directory(hashes: DataFrame, bucket_rows: int) -> tuple[DataFrame, int]:
    """Directory rows (prefix, local_depth, bucket) and the global depth, for distinct hashes (h).

    The counts of all prefixes of MAX_DEPTH bits are aggregated once (at most
    2^MAX_DEPTH rows). Doubling then goes on while a bucket as deep as the directory
    is overfull. The directory is broadcast, so its size is bounded: beyond 2^MAX_DEPTH buckets of ``bucket_rows``
    a bucket holds more entries, in longer runs of its files; nothing else changes.
    """
    spark = hashes.sparkSession
    counts = (hashes.groupBy(_prefix(F.col("h"), MAX_DEPTH).alias("leaf"))
              .agg(F.count(F.lit(1)).alias("n")))
    n = {r.leaf: r.n for r in counts.collect()}  # at most 2^MAX_DEPTH rows
    depth, full, leaves = 0, {0: sum(n.values())}, {}
    while full:
        split: dict[int, int] = {}
        for prefix, rows in full.items():
            if rows <= bucket_rows or depth == MAX_DEPTH:
                leaves[(prefix, depth)] = rows
            else:
                split[2 * prefix] = split[2 * prefix + 1] = 0
        if not split:
            break
        depth += 1
        for leaf, rows in n.items():
            at = leaf >> (MAX_DEPTH - depth)
            if at in split:
                split[at] += rows
        full = split
    rows = [(p << (depth - d) | i, d, p << (depth - d))
            for (p, d) in leaves for i in range(1 << (depth - d))]
    return spark.createDataFrame(sorted(rows), "prefix int, local_depth int, bucket int"), depth


def _addressed(rows: DataFrame, directory: DataFrame, depth: int) -> DataFrame:
    """Rows with the bucket that the directory gives for their hash's prefix."""
    return (rows.withColumn("prefix", _prefix(F.col("h"), depth))
            .join(F.broadcast(directory.select("prefix", "bucket")), "prefix")  # at most 2^MAX_DEPTH rows
            .drop("prefix"))


def build_index(docs: DataFrame, earlier: ExactIndex | None = None,
                bucket_rows: int = 200_000, rows: DataFrame | None = None) -> ExactIndex:
    """Index all texts of ``docs``; with ``earlier``, extend that index by a new batch.

    Of equal texts the entry with the most code points, then the smallest doc_id, stays.
    """
    spark = docs.sparkSession
    rows = hashed_rows(docs) if rows is None else rows
    hashes = rows.select("h")
    if earlier is not None:
        hashes = hashes.unionByName(earlier.entries.select("h"))
    directory, depth = build_directory(hashes.distinct(), bucket_rows)
    directory = stored(directory, scratch(spark, "exact-directory"))
    fresh = _hashed(docs).select("h", "norm", "n_chars", F.bitwise_not("doc_id").alias("nid"),
                                 F.lit(1).cast("long").alias("group_size"))
    if earlier is not None:
        fresh = fresh.unionByName(earlier.entries.select("h", "norm", "n_chars", F.bitwise_not("keep_id").alias("nid"),
                                                         "group_size"))
    # ~doc_id falls as doc_id rises, and null is the least.
    grouped = (_addressed(fresh, directory, depth).groupBy("bucket", "h", "norm")
               .agg(F.sum("group_size").alias("group_size"), F.max(F.struct("n_chars", "nid")).alias("w")))
    chain = Window.partitionBy("bucket", "h").orderBy("norm")
    placed = (grouped.repartitionByRange("bucket", "h").withColumn("chain", F.row_number().over(chain) - 1)
              .select("bucket", "h", "chain", "norm", F.sha2("norm", 256).alias("sha"),
                      F.bitwise_not("w.nid").alias("keep_id"), F.col("w.n_chars").alias("n_chars"), "group_size")
              .sortWithinPartitions("bucket", "h", "chain"))
    path = scratch(spark, "exact-index")
    placed.write.option("compression", "zstd").parquet(path)
    return ExactIndex(spark.read.schema(placed.schema).parquet(path), directory, depth)


def look_up(docs: DataFrame, index: ExactIndex, rows: DataFrame | None = None) -> DataFrame:
    """(uid, doc_id, th, n_chars, bucket, h, chain) of each row of ``docs``, all of whose texts are indexed."""
    rows = hashed_rows(docs) if rows is None else rows
    found = _addressed(rows, index.directory, index.depth)
    long_chains = index.entries.where("chain > 0").select("bucket", "h").distinct()
    if long_chains.isEmpty():  # almost always
        return found.withColumn("chain", F.lit(0))
    # Rows of the same doc_id and text have the same entry, whichever is asked.
    asked = _addressed(_hashed(docs), index.directory, index.depth).join(long_chains, ["bucket", "h"], "left_semi")
    told = (asked.join(index.entries.select("bucket", "h", "norm", "chain"), ["bucket", "h", "norm"])
            .groupBy("h", "doc_id", "th").agg(F.min("chain").alias("chain"))
            .withColumnsRenamed({"h": "_h", "doc_id": "_d", "th": "_t"}))
    return found.join(told, (F.col("h") == F.col("_h")) & F.col("doc_id").eqNullSafe(F.col("_d"))
                      & F.col("th").eqNullSafe(F.col("_t")), "left") \
        .withColumn("chain", F.coalesce("chain", F.lit(0))).drop("_h", "_d", "_t")


def _judged(docs: DataFrame, index: ExactIndex, rows: DataFrame | None) -> DataFrame:
    """Rows with their entry (keep_id, group_size, sha) and the number of the one row that stays."""
    spark = docs.sparkSession
    key = ["bucket", "h", "chain"]
    found = stored(look_up(docs, index, rows), scratch(spark, "exact-found"))
    best = found.groupBy(*key).agg(F.max(F.struct(
        "n_chars", F.bitwise_not("doc_id").alias("nid"), F.bitwise_not("th").alias("t"),
        F.bitwise_not("uid").alias("u"))).alias("best"), F.count(F.lit(1)).alias("n"))
    entries = stored(index.entries.select(*key, "sha", "keep_id", "group_size")
                     .join(best.select(*key, F.bitwise_not("best.u").alias("stays"), "n"), key),
                     scratch(spark, "exact-judged"))
    total = found.count()
    return salted_join(found, entries, key, "n", total, F.xxhash64("uid"))


def assign(docs: DataFrame, index: ExactIndex, rows: DataFrame | None = None) -> DataFrame:
    """Per row of ``docs``: keep_id, group_size, kept and text_sha256 from the index."""
    return _judged(docs, index, rows).select(
        "doc_id", "keep_id", "group_size", (F.col("uid") == F.col("stays")).alias("kept"),
        F.col("sha").alias("text_sha256"))


def exact_dedup(docs: DataFrame, bucket_rows: int = 200_000) -> DataFrame:
    """Index ``docs`` and return one row per document, dropped ones too."""
    docs = docs.select("doc_id", "text")
    rows = hashed_rows(docs)
    return assign(docs, build_index(docs, bucket_rows=bucket_rows, rows=rows), rows)


def kept_documents(docs: DataFrame) -> DataFrame:
    """The row of each group of ``docs`` that stays, all columns as they came.

    It is found by its doc_id and the hash of its text; of rows alike in both one stays.
    """
    spark, own = docs.sparkSession, docs.select("doc_id", "text")
    rows = hashed_rows(own)
    judged = _judged(own, build_index(own, rows=rows), rows)
    alike = rows.groupBy("doc_id", "th").agg(F.count(F.lit(1)).alias("_copies")) \
        .withColumnsRenamed({"doc_id": "_keep", "th": "_text_hash"})
    keep = judged.where("uid = stays").select(F.col("doc_id").alias("_d"), F.col("th").alias("_t"))
    keep = stored(keep.join(alike, F.col("_d").eqNullSafe(F.col("_keep")) & F.col("_t").eqNullSafe(F.col("_text_hash")))
                  .select("_keep", "_text_hash", "_copies"), scratch(spark, "exact-keep"))

    def rows_of(kept):
        return docs.join(kept, docs["doc_id"].eqNullSafe(kept["_keep"])
                         & F.xxhash64(docs["text"]).eqNullSafe(kept["_text_hash"]), "left_semi")

    repeated = keep.where("_copies > 1")
    if repeated.isEmpty():
        return rows_of(keep)
    return rows_of(keep.where("_copies = 1")).unionByName(
        rows_of(repeated).dropDuplicates(["doc_id", "text"]))
