"""Raw sources: header CSV exports (S1, S2), sheet grids (S3, S4), folder profile."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civicmart.functions.parse import null_if_missing
from civicmart.sources.sinks import CSV_OPTIONS

CORRUPT = "_corrupt_record"


def read_raw_csv(spark: SparkSession, path: str, columns: Sequence[str] | None = None,
                 multi_line: bool = False, glob: str | None = None) -> DataFrame:
    """Header CSV -> all-string columns named by the header; no schema inference.

    Only the header line of the first file is read eagerly (to name the columns).
    Every file's own header is compared with it while reading, so a file with other
    columns or another order fails instead of filling the wrong columns. A row that
    does not have as many fields as the header fails too: a quoted line break needs
    ``multi_line`` (whole files then go to one task each). ``columns`` selects the
    ones the cleaners use, in any order, and fails early with the list of available
    columns if one is absent.
    """
    reader = (spark.read.options(**CSV_OPTIONS).option("header", True).option("inferSchema", False)
              .option("multiLine", multi_line).option("enforceSchema", False)
              .option("mode", "FAILFAST").option("columnPruning", False))
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    df = reader.csv(path)
    if columns is None:
        return df
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; found {df.columns}")
    return df.select(*[F.col(f"`{c}`") for c in columns])


def header_groups(spark: SparkSession, path: str, glob: str | None = None) -> list[tuple[list[str], list[str]]]:
    """Files of a folder grouped by their header line: (columns, file paths) of each group.

    Lines are told apart by where they stand, so only one line a file is kept. The driver holds
    the file names, as it does to plan any read of them.
    """
    heads = head_lines(spark, path, 1, glob).select("file", "line").collect()  # one a file
    groups: dict[str, list[str]] = {}
    for r in heads:
        groups.setdefault(r.line.lstrip("\ufeff"), []).append(r.file)
    out = []
    for line, files in sorted(groups.items()):
        parsed = spark.createDataFrame([(line,)], "line string")
        n = 1 + line.count(",")
        names = parsed.select(F.from_csv("line", ", ".join(f"_c{i} string" for i in range(n)), CSV_OPTIONS)).first()[0]
        out.append(([c for c in names if c is not None], sorted(files)))
    return out


def read_raw_csv_lenient(spark: SparkSession, path: str, columns: Sequence[str],
                         glob: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Header CSV whose files may differ -> (rows, rejects); one bad file or row doesn't end the folder.

    Files are read in groups of one header and unioned by name, so columns may come in any order and
    further ones are ignored. A row with fewer fields than its header is padded with NULL, as a data-frame
    reader does. Rejected, with the reason: rows with more fields, and files that lack one of ``columns``.
    ``rejects`` is (file, reason, line); its file-level rows have no line. Fields don't hold line breaks.
    """
    rows = spark.createDataFrame([], ", ".join(f"`{c}` string" for c in columns))
    rejects = spark.createDataFrame([], "file string, reason string, line string")
    for names, files in header_groups(spark, path, glob):
        missing = [c for c in columns if c not in names]
        if missing:
            listed = spark.createDataFrame([(f, f"missing columns {missing}", None) for f in files], rejects.schema)
            rejects = rejects.unionByName(listed)
            continue
        # One field beyond the header tells too long rows from short ones.
        schema = _wide_string_schema(len(names) + 1).add(CORRUPT, T.StringType())
        read = (spark.read.options(**CSV_OPTIONS).option("header", True).option("enforceSchema", True)
                .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
                .option("columnPruning", False).schema(schema).csv(files)
                .withColumn("file", F.col("_metadata.file_path")))
        # Spark keeps the text of every row that hasn't exactly the schema's fields: without it there is one more.
        # (It refuses to read that text alone, so the first field is looked at along.)
        too_long = ((F.col(CORRUPT).isNull() | (_fields(F.col(CORRUPT)) > len(names)))
                    & (F.length(F.coalesce("_c0", F.lit(""))) >= 0))
        line = F.coalesce(CORRUPT, F.to_csv(F.struct(*[f"_c{i}" for i in range(len(names) + 1)])))
        rows = rows.unionByName(read.where(~too_long).select(
            *[F.col(f"_c{names.index(c)}").alias(c) for c in columns]))
        rejects = rejects.unionByName(read.where(too_long).select(
            "file", F.lit(f"more than {len(names)} fields").alias("reason"), line.alias("line")))
    return rows, rejects


def _fields(line: Column) -> Column:
    """Fields of a CSV line: commas outside quotes, and one."""
    return F.regexp_count(F.regexp_replace(line, '"([^"]|"")*"', ""), F.lit(",")) + 1


def head_lines(spark: SparkSession, path: str, k: int = 3, glob: str | None = None) -> DataFrame:
    """The first ``k`` lines of each file as they stand: (file, line_no, line).

    A line's place is (start of its split, place in the task), which is the file's order however many
    splits it has. Only splits that begin in the first bytes can hold a first line, but a line may be long, so
    all are looked at; each task keeps ``k`` lines a file (planned as a WindowGroupLimit).
    """
    reader = spark.read
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    lines = reader.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("pos"),
        F.col("value").alias("line"))
    order = Window.partitionBy("file").orderBy("block", "pos")
    return (lines.withColumn("line_no", F.row_number().over(order)).where(F.col("line_no") <= k)
            .select("file", "line_no", "line"))


def _wide_string_schema(n_cols: int) -> T.StructType:
    return T.StructType([T.StructField(f"_c{i}", T.StringType()) for i in range(n_cols)])


def grid_width(spark: SparkSession, path: str, glob: str = "*.csv", multi_line: bool = True) -> int:
    """Columns that hold every cell of every file: 1 + the most commas in a record (one job).

    A record of more than one field does not fit the one-column schema used here, so
    its text arrives as the corrupt record; commas inside quotes only make the bound wider.
    """
    schema = _wide_string_schema(1).add(CORRUPT, T.StringType())
    raw = (spark.read.options(**CSV_OPTIONS).option("header", False).option("multiLine", multi_line)
           .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
           .option("pathGlobFilter", glob).schema(schema).csv(path))
    # The first field is read along: Spark refuses to read the corrupt record alone.
    row = raw.agg(F.max(F.regexp_count(F.col(CORRUPT), F.lit(","))), F.max("_c0")).first()
    return 1 + int(row[0] or 0)


def read_grid(spark: SparkSession, path: str, glob: str = "*.csv") -> DataFrame:
    """Headerless delimited sheet exports -> ``(file, row_idx, cells)``; every cell is read.

    ``file`` is the whole path, so files of one name in two folders stay two sheets.
    Cells with a missing-value token of a default pandas read are NULL. Multi-line
    parsing keeps quoted newlines inside header cells. It also means a file is never
    split: its rows arrive in order inside one task, so the row index is the row's
    ``monotonically_increasing_id`` minus the first id of its file. Only that per-file
    minimum is aggregated and joined back (one row per file).
    """
    width = grid_width(spark, path, glob)
    raw = (spark.read.options(**CSV_OPTIONS).option("header", False).option("multiLine", True)
           .option("mode", "PERMISSIVE")
           .option("pathGlobFilter", glob).schema(_wide_string_schema(width)).csv(path))
    raw = raw.select(F.col("_metadata.file_path").alias("file"),
                     F.monotonically_increasing_id().alias("_seq"),
                     F.array(*[null_if_missing(F.col(f"_c{i}")) for i in range(width)]).alias("cells"))
    starts = raw.groupBy("file").agg(F.min("_seq").alias("_start"))
    return (raw.join(starts, "file")
            .select("file", (F.col("_seq") - F.col("_start")).cast("int").alias("row_idx"), "cells"))


def profile_raw(spark: SparkSession, path: str, glob: str = "*.csv", sample_rows: int = 2) -> DataFrame:
    """Per CSV file: data rows, header width (real CSV split) and the first data rows.

    Counts are a grouped aggregate, the header is the first row of its file, and the
    sample is a per-file top-k (planned as a WindowGroupLimit, so only k rows per task
    and file move).
    """
    n_cols = grid_width(spark, path, glob, multi_line=False)
    raw = (spark.read.options(**CSV_OPTIONS).option("header", False).option("mode", "PERMISSIVE")
           .option("pathGlobFilter", glob).schema(_wide_string_schema(n_cols)).csv(path))
    cols = [F.col(f"_c{i}") for i in range(n_cols)]
    # A large file is read as several splits packed into tasks; ids are not
    # promised to follow file order across tasks, so order by (block start,
    # position inside the task), which is the file order.
    rows = raw.select(F.col("_metadata.file_path").alias("file"),
                      F.struct(F.col("_metadata.file_block_start").alias("block"),
                               F.monotonically_increasing_id().alias("pos")).alias("_seq"),
                      F.array(*cols).alias("cells"))
    per_file = rows.groupBy("file").agg(
        (F.count(F.lit(1)) - 1).alias("n_rows"),
        F.min_by("cells", "_seq").alias("header"))
    width = F.aggregate(F.transform(F.col("header"), lambda c, i: F.when(c.isNotNull(), i + 1).otherwise(0)),
                        F.lit(0), lambda acc, x: F.greatest(acc, x))
    per_file = per_file.select("file", "n_rows", width.alias("n_columns"))
    ranked = rows.withColumn("rn", F.row_number().over(Window.partitionBy("file").orderBy("_seq")))
    sample = (ranked.where((F.col("rn") > 1) & (F.col("rn") <= sample_rows + 1))
              .select("file", "rn", F.concat_ws(",", F.col("cells")).alias("line")))
    sample = sample.groupBy("file").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("rn", "line"))), lambda s: s["line"]).alias("sample"))
    return per_file.join(sample, "file", "left")
