"""What each file of a snapshot holds: recorded with the copy, compared before it is used."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablevault.functions.columns import limb_sums, limb_total, row_hash
from tablevault.sources import filesystem

MANIFEST = "file string, bytes bigint, row_count bigint, checksum decimal(38,0)"

# What can be wrong with a file.
MISSING, EXTRA, RESIZED, CHANGED = "missing", "extra", "resized", "changed"
DAMAGE = (
    "file string, problem string, recorded_bytes bigint, found_bytes bigint, "
    "recorded_rows bigint, found_rows bigint"
)


def listed(spark: SparkSession, path: str, suffix: str = "parquet") -> DataFrame:
    """(file, bytes) of the data files below `path`, by name relative to it; not their content."""
    if not filesystem.exists(spark, path):
        return spark.createDataFrame([], "file string, bytes bigint")
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", f"*.{suffix}")
        .option("recursiveFileLookup", "true")
        .load(path)
    )
    return files.select(
        _below(spark, path, files["_metadata.file_path"]).alias("file"),
        F.col("length").alias("bytes"),
    )


def contents(frame: DataFrame, path: str) -> DataFrame:
    """(file, row_count, checksum) of the files below `path` that `frame` reads rows from.

    One scan; what is shuffled is a row per file and task. Files without rows have none.
    """
    spark = frame.sparkSession
    hashed = frame.select(
        _below(spark, path, F.col("_metadata.file_path")).alias("file"),
        row_hash(frame.schema).alias("hash"),
    )
    return (
        hashed.groupBy("file")
        .agg(F.count(F.lit(1)).alias("row_count"), *limb_sums(F.col("hash"), "checksum"))
        .select("file", "row_count", limb_total("checksum").alias("checksum"))
    )


def _below(spark: SparkSession, path: str, file: Column) -> Column:
    """A file's name relative to `path`: both have the same folders, however they are escaped."""
    depth = filesystem.depth(spark, path)
    parts = F.split(F.regexp_replace(file, "^[A-Za-z0-9+.-]+:(//[^/]*)?/*", ""), "/")
    return F.array_join(F.slice(parts, depth + 1, F.size(parts)), "/")


def manifest(frame: DataFrame, path: str) -> DataFrame:
    """One row per data file below `path`, as in `MANIFEST`; `frame` reads them."""
    found = contents(frame, path)
    return listed(frame.sparkSession, path).join(found, "file", "left").select(
        "file",
        "bytes",
        F.coalesce("row_count", F.lit(0)).alias("row_count"),
        F.coalesce("checksum", F.lit(0).cast("decimal(38,0)")).alias("checksum"),
    )


def totals(lines: DataFrame) -> dict:
    """Files, bytes, rows and checksum of a whole manifest, and a hash of its lines."""
    line = F.xxhash64("file", "bytes", "row_count", "checksum")
    row = lines.agg(
        F.count(F.lit(1)).alias("files"),
        F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"),
        F.coalesce(F.sum("row_count"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum("checksum"), F.lit(0)).cast("string").alias("checksum"),
        F.coalesce(F.bit_xor(line), F.lit(0)).alias("lines"),
    ).first()
    return row.asDict()


def damage(recorded: DataFrame, frame: DataFrame, path: str, content: bool = True) -> DataFrame:
    """The files below `path` that are not those of the manifest, as in `DAMAGE`.

    Files are first told by name and size, which costs a listing. With `content` the rows of
    the others are compared by one scan too, so a file that was replaced by one of the same
    size, or whose bytes were altered, is named. `frame` should pass over files it cannot
    read: they count as changed.
    """
    spark = frame.sparkSession
    known = recorded.select(
        "file", F.col("bytes").alias("recorded_bytes"), F.col("row_count").alias("recorded_rows"),
        F.col("checksum").alias("recorded_checksum"),
    )
    there = listed(spark, path).withColumnRenamed("bytes", "found_bytes")
    both = known.join(there, "file", "full")
    if content and filesystem.exists(spark, path):
        read = contents(frame, path).toDF("file", "found_rows", "found_checksum")
        both = both.join(read, "file", "left")
        found = F.col("found_bytes").isNotNull()
        both = both.withColumn("found_rows", F.when(found, F.coalesce("found_rows", F.lit(0))))
        zero = F.lit(0).cast("decimal(38,0)")
        same = (F.col("recorded_rows") == F.col("found_rows")) & (
            F.col("recorded_checksum") == F.coalesce("found_checksum", zero)
        )
    else:
        both = both.withColumn("found_rows", F.lit(None).cast("bigint"))
        same = F.lit(True)
    problem = (
        F.when(F.col("found_bytes").isNull(), MISSING)
        .when(F.col("recorded_bytes").isNull(), EXTRA)
        .when(~same, CHANGED)
        .when(F.col("recorded_bytes") != F.col("found_bytes"), RESIZED)
    )
    return both.select(
        "file", problem.alias("problem"), "recorded_bytes", "found_bytes", "recorded_rows",
        "found_rows",
    ).where("problem IS NOT NULL")
