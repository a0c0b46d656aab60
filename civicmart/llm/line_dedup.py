"""Line dedup over levelled sorted runs of line hashes (DataFrame code only).

A line's key is the line with ASCII white space stripped at both ends and A-Z
lower-cased. A key of at least ``min_chars`` code points keeps its lines only in the
smallest doc_id that holds it; all other lines stay.

The index is a list of *runs*. A run is a table of (h1, h2, owner), hash-bucketed by
both hashes, each bucket one sorted file, so that a later batch merge-joins it without
shuffling it again (Spark still sorts a bucket it reads, which finds it in order). Documents come in batches of ascending doc_id. A batch

1. reduces its lines to distinct keys with their smallest doc_id (partial aggregation:
   a hot line shrinks before the shuffle),
2. anti-joins them with every run, and
3. writes what is left as a new run of level 0.

``FANOUT`` runs of one level are compacted into one run of the next. Runs are disjoint
by construction, so the owner of a key stands in exactly one of them. Keys are 128 bits
of hash (two xxHash64 values of different seeds), never the text.

Defined results: null or empty text is one empty line; null doc_id counts as larger
than every doc_id, and all rows without
one as one document; rows sharing a doc_id are one document (a line they
share stays in each); an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civicmart.llm.common import SPACE_CLASS, lower_ascii, salted_join, scratch, stored

FANOUT = 4
MAX_ID = (1 << 63) - 1


@dataclass
class LineIndex:
    """Runs by level: ``levels[k]`` holds the paths of the runs of level k."""

    spark: SparkSession
    buckets: int
    levels: list[list[str]] = field(default_factory=list)

    def runs(self) -> list[str]:
        return [p for level in self.levels for p in level]

    def read(self, name: str) -> DataFrame:
        return self.spark.table(name)

    def _write(self, df: DataFrame) -> str:
        """Write a frame that is dealt by (h1, h2) as a run: a bucket a task, one file each."""
        path = scratch(self.spark, "lines-run")
        name = "llm_" + path.rsplit("-", 1)[1]
        (df.write.bucketBy(self.buckets, "h1", "h2")
         .sortBy("h1", "h2").option("path", path).format("parquet").saveAsTable(name))
        return name

    def add(self, lines: DataFrame) -> None:
        """Add a batch of lines (owner id, h1, h2) whose documents come after all earlier ones."""
        self._push(0, self._write(self.unknown(lines)))

    def unknown(self, lines: DataFrame) -> DataFrame:
        """Keys of a batch (with their smallest id) that no run holds.

        Keys are dealt as the runs' buckets are, so only the batch moves; runs are read where they lie.
        """
        fresh = (lines.groupBy("h1", "h2").agg(F.min("id").alias("owner"))
                 .repartition(self.buckets, "h1", "h2"))
        for run in self.runs():
            fresh = fresh.join(self.read(run).hint("merge"), ["h1", "h2"], "left_anti")
        return fresh

    def _push(self, level: int, run: str) -> None:
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) == FANOUT:
            merged = self._write(self.owners(self.levels[level]).repartition(self.buckets, "h1", "h2"))
            for old in self.levels[level]:
                self.spark.sql(f"DROP TABLE {old}")
            self.levels[level] = []
            self._push(level + 1, merged)

    def owners(self, runs: Iterable[str] | None = None) -> DataFrame:
        """All keys with the smallest doc_id that holds them, over the given (or all) runs."""
        parts = [self.read(r) for r in (self.runs() if runs is None else runs)]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out


def line_key(line):
    """The key of a line: ASCII white space stripped at both ends, A-Z lower-cased."""
    space = " \t\n\u000b\f\r"
    return lower_ascii(F.trim(line, F.lit(space)))


def long_lines(docs: DataFrame, min_chars: int = 10) -> DataFrame:
    """(id, doc_id, th, pos, h1, h2) of each line whose key has at least ``min_chars`` code points."""
    lines = docs.select("doc_id", F.xxhash64("text").alias("th"),
                        F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n", -1)).alias("pos", "line"))
    keyed = lines.withColumn("key", line_key(F.col("line"))).where(F.char_length("key") >= min_chars)
    return keyed.select(F.coalesce("doc_id", F.lit(MAX_ID)).alias("id"), "doc_id", "th", "pos",
                        F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(7), "key").alias("h2"))  # hash of 7 as the seed


def line_dedup(docs: DataFrame, batches: int = 4, min_chars: int = 10, buckets: int | None = None,
               index: LineIndex | None = None) -> DataFrame:
    """Drop repeated lines of ``docs``; returns doc_id, n_lines, n_dropped, kept_text.

    ``index``: continue an index of earlier documents (all with smaller doc_ids).
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    index = index or LineIndex(spark, buckets)
    cuts = (docs.agg(F.percentile_approx("doc_id", [i / batches for i in range(1, batches)]))
            .first()[0] or []) if batches > 1 else []
    batch = F.lit(0)
    for cut in sorted(set(cuts)):
        batch = batch + (F.col("id") > cut).cast("int")
    path = scratch(spark, "lines")
    long_lines(docs, min_chars).withColumn("batch", batch).write.partitionBy("batch").parquet(path)
    lines = spark.read.schema("id long, doc_id long, th long, pos int, h1 long, h2 long, batch int") \
        .parquet(path)
    for b in range(len(set(cuts)) + 1):
        index.add(lines.where(F.col("batch") == b).select("id", "h1", "h2"))

    owners = index.owners()
    # Rows of a key (what a hot key must be dealt by), and the first and last document: a key
    # matters if one of them isn't its owner, who may stand in an earlier run.
    uses = lines.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("low"),
                                         F.max("id").alias("high"))
    total = lines.count()
    sized = stored(owners.join(uses, ["h1", "h2"]).where("low <> owner OR high <> owner")
                   .drop("low", "high"), scratch(spark, "lines-owners"))
    extra = salted_join(lines, sized, ["h1", "h2"], "n", total, F.xxhash64("id", "pos"), "inner")
    masks = (extra.where(F.col("id") != F.col("owner"))
             .groupBy("doc_id", "th").agg(F.sort_array(F.collect_set("pos")).alias("gone")))
    masks = stored(masks, scratch(spark, "lines-masks"))
    marked = docs.withColumn("th", F.xxhash64("text")).join(
        masks.withColumnsRenamed({"doc_id": "_d", "th": "_t"}),
        F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("th") == F.col("_t")), "left")
    # Runs of lines between dropped ones, cut by position: one pass however many lines go.
    marked = marked.withColumn("parts", F.split(F.coalesce("text", F.lit("")), "\n", -1))
    marked = marked.withColumn("gaps", F.when(F.col("gone").isNotNull(), F.concat(
        F.array(F.lit(-1)), F.col("gone"), F.array(F.size("parts")))))
    pieces = F.flatten(F.transform(
        F.sequence(F.lit(1), F.size("gaps") - 1),
        lambda i: F.slice(F.col("parts"), F.element_at("gaps", i) + 2,
                          F.element_at("gaps", i + 1) - F.element_at("gaps", i) - 1)))
    kept = (F.when(F.col("gaps").isNull(), F.coalesce("text", F.lit("")))
            .otherwise(F.array_join(pieces, "\n")))
    return marked.select("doc_id", F.size("parts").cast("long").alias("n_lines"),
                         F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"),
                         kept.alias("kept_text"))
