"""Shared pieces of the corpus operators: scratch tables, hot-key joins, text keys."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from civicmart.session import shared_dir

# ASCII white space of the text contracts: [\x20\x09-\x0D].
SPACE_CLASS = r"[ \t\n\u000B\f\r]"

# A key is hot from this many rows on, or from 1/HOT_LIST of all rows: so at most
# HOT_LIST keys can be hot, which is the proven bound of the broadcast hot list.
HOT_LIST = 10_000
HOT_ROWS = 500

# Whole texts in one Arrow batch of the pipeline's Python stages.
TEXT_ROWS = 1_000

SAMPLE_STEPS = 1 << 52
SAMPLE_PARTS = 8


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the Python workers of this application the package (once), wherever they run."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parents[2]
    # Kept while the application lives: executors that join later fetch it from the driver.
    archive = Path(tempfile.mkdtemp(prefix="civicmart-code-"), "civicmart_code.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted((root / "civicmart").rglob("*.py")):
            z.write(f, f.relative_to(root))
    sc.addPyFile(str(archive))
    _SHIPPED.add(sc.applicationId)


def bound_batches(spark: SparkSession) -> None:
    """Send Python workers at most TEXT_ROWS texts at once, unless the session asks for fewer.

    Spark's 10,000 whole texts are built, sent and received as one buffer each: of 3 kB they are 30 MB,
    held twice while the buffer grows, for every task of an executor.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= TEXT_ROWS:
        spark.conf.set(key, str(TEXT_ROWS))


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share."""
    return f"{shared_dir(spark)}/llm-{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends at durable files."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(c: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    ascii_only = F.octet_length(c) == F.char_length(c)  # then lower() is the same, and faster
    return F.when(ascii_only, F.lower(c)).otherwise(F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


def hot_keys(groups: DataFrame, keys: Sequence[str], size: str, total: int) -> DataFrame:
    """Keys of ``groups`` with many rows, and in how many parts each is to be dealt.

    A key is hot above ``max(HOT_ROWS, total / HOT_LIST)`` rows, so the list has at
    most HOT_LIST rows whatever the input: small enough to broadcast.
    """
    limit = max(HOT_ROWS, -(-total // HOT_LIST))
    return (groups.where(F.col(size) > limit)
            .select(*keys, F.ceil(F.col(size) / F.lit(limit)).cast("int").alias("_parts")))


def salted_join(left: DataFrame, groups: DataFrame, keys: Sequence[str], size: str,
                total: int, salt: Column, how: str = "left") -> DataFrame:
    """Join rows with a table that has one row a key, hot keys dealt over many tasks.

    ``groups`` (one row per ``keys``, read from files; ``size`` holds the rows that
    ``left`` has of the key) is replicated for its hot keys, once for each part;
    rows of ``left`` choose a part by ``salt``. No task then gets more than about
    ``max(HOT_ROWS, total / HOT_LIST)`` rows of a key, with or without AQE. Null keys
    match nothing. Rows of ``left`` are neither lost nor repeated by a left join.
    """
    hot = hot_keys(groups, keys, size, total)
    dealt = (left.join(F.broadcast(hot), list(keys), "left")
             .withColumn("_part", F.when(F.col("_parts").isNull(), F.lit(0))
                         .otherwise(F.pmod(salt, F.col("_parts")).cast("int")))
             .drop("_parts"))
    limit = max(HOT_ROWS, -(-total // HOT_LIST))
    parts = F.greatest(F.lit(1), F.when(F.col(size) > limit, F.ceil(F.col(size) / F.lit(limit)))
                       .otherwise(1)).cast("int")
    spread = groups.withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1)))
    return dealt.join(spread, [*keys, "_part"], how).drop("_part")


def sample_place(df: DataFrame, seed: str) -> Column:
    """A row's place among SAMPLE_STEPS, from the hash of all its columns."""
    return F.pmod(F.xxhash64(F.lit(seed), *[F.col(f"`{c}`") for c in df.columns]), F.lit(SAMPLE_STEPS))


def sample_steps(limit: int, n: int) -> int:
    """Rows with a place below this number are about ``limit`` of ``n``."""
    return SAMPLE_STEPS if n <= limit else int(limit / n * SAMPLE_STEPS)


def sampled(df: DataFrame, limit: int, seed: str, by: str | None = None) -> DataFrame:
    """Rows for fitting a model, chosen by a hash of all their columns: all if at most ``limit``, else about
    ``limit`` and never over twice as many.

    With ``by``, every value of that column gets an equal part of ``limit`` and what small ones leave over is not
    dealt out. The same rows are chosen on every run and for every partitioning. Repeated
    rows have one hash; where so many are alike that the share of all rows misses the limit by half, rows
    are taken in the order of their hash instead, which bounds them too. SAMPLE_STEPS is far above any
    row count over ``limit``, so the share never rounds to nothing.
    """
    h = F.xxhash64(F.lit(seed), *[F.col(f"`{c}`") for c in df.columns])
    place = sample_place(df, seed)
    groups = [by] if by else []
    sizes = df.groupBy(*groups).agg(F.count(F.lit(1)).alias("n")).collect() if by else [None]
    if by:
        n = {r[0]: r.n for r in sizes}  # one number a value of ``by``
    else:
        n = {None: df.count()}
    part = -(-limit // max(1, len(n)))
    if all(k <= part for k in n.values()):
        return df
    share = F.lit(0).cast("long")
    for value, k in n.items():
        own = F.lit(sample_steps(part, k))
        share = F.when(F.col(by).eqNullSafe(F.lit(value)), own).otherwise(share) if by else own
    picked = df.where(place < share)
    got = {r[0]: r.n for r in picked.groupBy(*groups).agg(F.count(F.lit(1)).alias("n")).collect()} if by \
        else {None: picked.count()}
    if all(min(part, k) // 2 <= got.get(value, 0) <= 2 * part for value, k in n.items()):
        return picked
    rank = F.row_number().over(Window.partitionBy(*groups, F.pmod(h, F.lit(SAMPLE_PARTS))).orderBy("_h"))
    return (df.withColumn("_h", h).withColumn("_rank", rank)
            .where(F.col("_rank") <= -(-2 * part // SAMPLE_PARTS)).drop("_h", "_rank"))


def fold(key: Column, n: int) -> Column:
    """crc32 of the key as text, modulo ``n``: the documented train / held-out folds."""
    return F.crc32(key.cast("string").cast("binary")) % n
