"""SimHash near-dedup over BK-trees.

Fingerprint: 64 bits over 3-word shingles (XXH64, seed 42, repeats included); a bit is 1
if set in over half of the shingles' hashes. Rows of equal fingerprints are first merged,
so the trees hold distinct fingerprints only.

A BK-tree keeps the children of a node keyed by their integer Hamming distance to it;
a search of radius r follows only edges in [d - r, d + r]. One tree over a whole corpus
could not be broadcast within a proven bound, so trees are built for *shards*: the 64
bits are cut into blocks, some of which two fingerprints within the radius must share
(pigeonhole), and a shard holds the fingerprints that agree on a choice of blocks: each
link lies inside at least one shard. Shards over ``TREE_NODES`` nodes are cut into several trees of at most
that many. Each tree is shipped to one task and built there once; the shard's other fingerprints stream
through it in blocks, which go down its levels together.
Each tree returns a spanning forest of the links it found, so a dense group gives about
as many links as it has members, and no connection is lost. Components follow by
alternating star rounds in Spark.

Defined results: null and empty texts have fingerprint zero, linked like any other;
null doc_ids come last in the choice of a component's smallest; rows sharing a doc_id are
rows each, and ``one_of_each`` keeps exactly one row a component (of a smallest doc_id, or of
none, held by several rows: the one with the smallest fingerprint, then text hash); an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import re
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicmart.llm.common import salted_join, scratch, stored
from civicmart.llm.components import components
from civicmart.llm.tokenize import batches

SHINGLE, RADIUS, SEED = 3, 2, 42
TREE_NODES = 1000
QUERY_BLOCK = 1024     # queries that go down a tree together
SMALL_SEARCH = 1024    # up to so many queries x nodes, queries go one by one
TREE = ("block", "value", "tree")
ALL_BITS = (1 << 64) - 1
WORD = re.compile("[^ \t\n\v\f\r]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def simhash(text: str | None, shingle: int = SHINGLE) -> int:
    """The 64-bit fingerprint of a whole text, as an unsigned integer."""
    text = text or ""
    words = WORD.findall(text.lower() if text.isascii() else text.translate(LOWER))
    if not words:
        return 0
    if len(words) < shingle:
        parts = [" ".join(words)]
    else:
        parts = map(" ".join, zip(*[words[k:] for k in range(shingle)], strict=False))
    of = xxhash.xxh64_intdigest
    hashes = np.array([of(p, SEED) for p in parts], dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):  # bounded memory for very long texts
        block = hashes[at:at + (1 << 16)]
        ones += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1,
                              bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(ones * 2 > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, th, fp): the text's hash, and the fingerprint's 64 bits as a signed long."""

    def run(it):
        for table in it:
            for part in batches(table, 512):
                fps = np.array([simhash(t, shingle) for t in part.column(2).to_pylist()],
                               dtype=np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(fps.view(np.int64))],
                    names=["doc_id", "th", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("th"),
                       "text").mapInArrow(run, "doc_id long, th long, fp long")


def distance(a: int, b: int) -> int:
    """Differing bits of two 64-bit values, signed or not."""
    return ((a ^ b) & ALL_BITS).bit_count()


class BKTree:
    """Distinct 64-bit values; children are keyed by their Hamming distance to the parent."""

    def __init__(self, values) -> None:
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []
        self._edges: tuple[np.ndarray, ...] | None = None
        for v in values:
            self.add(v)

    def add(self, value: int) -> None:
        if self.values:
            node = 0
            while True:
                d = distance(value, self.values[node])
                if d == 0:
                    return
                child = self.children[node].get(d)
                if child is None:
                    self.children[node][d] = len(self.values)
                    break
                node = child
        self.values.append(value)
        self.children.append({})
        self._edges = None

    def within(self, value: int, radius: int):
        """Values at most ``radius`` bits away; only edges within the radius are followed."""
        todo = [0] if self.values else []
        while todo:
            node = todo.pop()
            d = distance(value, self.values[node])
            if d <= radius:
                yield self.values[node]
            todo += [child for key, child in self.children[node].items()
                     if d - radius <= key <= d + radius]

    def _arrays(self) -> tuple[np.ndarray, ...]:
        """Values; of each node the first edge and how many; of each edge its key and child."""
        if self._edges is None:
            counts = np.array([len(c) for c in self.children], dtype=np.int64)
            edges = [e for c in self.children for e in c.items()]
            keys, nodes = np.array(edges, dtype=np.int64).reshape(-1, 2).T
            values = np.array([v & ALL_BITS for v in self.values], dtype=np.uint64)
            self._edges = values, np.cumsum(counts) - counts, counts, keys, nodes
        return self._edges

    def search(self, queries: list[int], radius: int) -> list[tuple[int, int]]:
        """(query, value) of all values at most ``radius`` bits from each query.

        All queries go down the tree together, a level a step; few queries go one by one.
        """
        if len(queries) * len(self.values) <= SMALL_SEARCH:
            return [(q, v) for q in queries for v in self.within(q, radius)]
        values, first, counts, keys, nodes = self._arrays()
        out = []
        for at in range(0, len(queries), QUERY_BLOCK):
            asked = queries[at:at + QUERY_BLOCK]
            wanted = np.array([q & ALL_BITS for q in asked], dtype=np.uint64)
            q, node = np.arange(len(wanted)), np.zeros(len(wanted), dtype=np.int64)
            while len(q):
                d = np.bitwise_count(wanted[q] ^ values[node]).astype(np.int64)
                hit = d <= radius
                out += [(asked[i], self.values[k])
                        for i, k in zip(q[hit].tolist(), node[hit].tolist(), strict=True)]
                n = counts[node]
                edge = np.repeat(first[node] - (np.cumsum(n) - n), n) + np.arange(n.sum())
                q, d = np.repeat(q, n), np.repeat(d, n)
                follow = np.abs(keys[edge] - d) <= radius
                q, node = q[follow], nodes[edge[follow]]
        return out


def forest(tree: BKTree, queries: list[int], radius: int) -> list[tuple[int, int]]:
    """A spanning forest of the links between ``queries`` and the tree's values."""
    parent, out = {}, []

    def root(x):
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for q, v in tree.search(queries, radius):
        a, b = root(q), root(v)
        if a != b:
            parent[max(a, b)] = min(a, b)
            out.append((q, v))
    return out


def shard_keys(fp, radius: int, agree: int):
    """Keys of the shards that hold a fingerprint.

    Of ``radius + agree`` blocks, two values within ``radius`` bits share at least
    ``agree``; a key is the content of one choice of ``agree`` blocks.
    """
    n = radius + agree
    cuts = [64 * k // n for k in range(n + 1)]
    masks = [sum(((1 << (cuts[k + 1] - cuts[k])) - 1) << cuts[k] for k in chosen)
             for chosen in combinations(range(n), agree)]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    return F.array(*[F.struct(F.lit(k).alias("block"), fp.bitwiseAND(F.lit(m)).alias("value"))
                     for k, m in enumerate(signed)])


def search_trees(tables, radius: int):
    """Links of rows (block, value, tree, asks, fps): each tree's own values, then the blocks that ask it."""
    key, tree = None, BKTree([])
    for part in (p for table in tables for p in batches(table, 64)):
        found = []
        for *own, asks, fps in zip(*(part.column(c).to_pylist() for c in (*TREE, "asks", "fps")), strict=True):
            if own != key:  # a number may have queries but no values of its own
                key, tree = own, BKTree([] if asks else fps)
            found += forest(tree, fps, radius)
        if found:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in zip(*found, strict=True)], names=["a", "b"])


def links(distinct: DataFrame, radius: int = RADIUS, tree_nodes: int = TREE_NODES,
          agree: int | None = None) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints within ``radius`` bits as they are.

    ``agree`` (1 up to 4 million fingerprints, then 2, then 3) makes shards narrower as
    the corpus grows; the links are the same for every choice.
    """
    spark = distinct.sparkSession
    if agree is None:
        n = distinct.count()
        agree = 1 if n <= 1 << 22 else 2 if n <= 1 << 32 else 3
    keyed = distinct.select("fp", F.explode(shard_keys(F.col("fp"), radius, agree)).alias("k")) \
        .select("fp", "k.block", "k.value")
    sizes = stored(keyed.groupBy("block", "value").agg(F.count(F.lit(1)).alias("n"))
                   .where("n > 1"), scratch(spark, "bk-shards"))
    total = sizes.agg(F.sum("n")).first()[0] or 0
    members = salted_join(keyed, sizes, ["block", "value"], "n", total, F.xxhash64("fp"), "inner")
    trees = F.ceil(F.col("n") / F.lit(tree_nodes)).cast("int")
    blocks = (members.withColumn("trees", trees)
              .withColumn("tree", F.pmod(F.xxhash64("fp"), F.col("trees")).cast("int"))
              .groupBy("block", "value", "trees", "tree")
              .agg(F.collect_list("fp").alias("fps")))  # about tree_nodes values at most
    # A block is the tree of its number, and a block of queries to the trees before it.
    sent = (blocks.withColumn("to", F.explode(F.sequence(F.lit(0), F.col("tree"))))
            .select("block", "value", F.col("to").alias("tree"),
                    (F.col("to") < F.col("tree")).alias("asks"), "fps"))
    met = sent.repartition(*TREE).sortWithinPartitions(*TREE, "asks")
    return met.mapInArrow(lambda it: search_trees(it, radius), "a long, b long")


def _rooted(docs: DataFrame, shingle: int, radius: int) -> tuple[DataFrame, DataFrame]:
    """Fingerprints of all rows, and each distinct one's smallest doc_id, row count and root."""
    spark = docs.sparkSession
    fps = stored(fingerprints(docs, shingle), scratch(spark, "simhash"))
    distinct = stored(fps.groupBy("fp").agg(F.min("doc_id").alias("least"),
                                            F.count(F.lit(1)).alias("n")),
                      scratch(spark, "simhash-distinct"))
    linked = components(links(distinct.select("fp"), radius))
    roots = distinct.join(linked.withColumnRenamed("node", "fp"), "fp", "left") \
        .withColumn("root", F.coalesce("root", "fp"))
    return fps, roots


def simhash_dedup(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """doc_id, fingerprint (hex), component_id (smallest doc_id reachable) of every document."""
    spark = docs.sparkSession
    fps, roots = _rooted(docs, shingle, radius)
    # Component of each distinct fingerprint; a component of very many is dealt over tasks.
    counted = stored(roots.groupBy("root").agg(F.min("least").alias("component_id"),
                                               F.count(F.lit(1)).alias("members")),
                     scratch(spark, "simhash-roots"))
    of_fp = stored(salted_join(roots.select("fp", "root", "n"), counted, ["root"], "members",
                               counted.agg(F.sum("members")).first()[0] or 0, F.xxhash64("fp"),
                               "inner").select("fp", "component_id", "n"),
                   scratch(spark, "simhash-components"))
    total = of_fp.agg(F.sum("n")).first()[0] or 0
    out = salted_join(fps, of_fp, ["fp"], "n", total, F.xxhash64("doc_id"), "inner")
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                      "component_id")


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """The row of ``docs`` that stands for each component: of the smallest doc_id; all columns as they came."""
    spark = docs.sparkSession
    fps, roots = _rooted(docs.select("doc_id", "text"), shingle, radius)
    none = F.col("doc_id").isNull().alias("none")
    # Partial minima at each step: no hot group of rows meets in one task.
    least = (fps.groupBy("fp", "doc_id", "th").agg(F.count(F.lit(1)).alias("copies"))
             .groupBy("fp").agg(F.min(F.struct(none, "doc_id", "fp", "th", "copies")).alias("row")))
    keep = stored(roots.select("fp", "root").join(least, "fp")
                  .groupBy("root").agg(F.min("row").alias("row"))
                  .select(F.col("row.doc_id").alias("_keep"), F.col("row.th").alias("_text_hash"),
                          F.col("row.copies").alias("_copies")), scratch(spark, "simhash-keep"))

    def rows_of(kept):
        return docs.join(kept, docs["doc_id"].eqNullSafe(kept["_keep"])
                         & (F.xxhash64(docs["text"]) == kept["_text_hash"]), "left_semi")

    repeated = keep.where("_copies > 1")
    if repeated.isEmpty():
        return rows_of(keep)
    return rows_of(keep.where("_copies = 1")).unionByName(
        rows_of(repeated).dropDuplicates(["doc_id", "text"]))
