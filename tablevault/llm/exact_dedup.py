"""Exact deduplication by sorting contents."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablevault.functions.columns import column
from tablevault.llm.common import ascii_lower, text_or_empty

# Characters of the text that lead the sort key. Splitters are sampled from the key, so it
# holds a prefix and a hash instead of whole texts.
PREFIX = 48


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: str = "largest",
    hot_share: int = 1024,
    salts: int = 256,
) -> DataFrame:
    """Group documents whose normalised texts are equal, and keep one of each group.

    Texts are normalised by lower-casing A-Z. Sampled splitters deal the rows out by ranges
    of (prefix, hash, salt), each range is sorted externally by the same key and the whole
    text, and neighbours with equal whole texts form a group. The salt is 0 except for texts
    that hold at least one in `hot_share` rows: their rows are sorted as up to `salts`
    groups, whose results (one row per group) are then merged.

    One row per input row: the id, `keep_id` (largest or smallest id of the group),
    `group_size`, `kept` and `text_sha256` of the normalised text. Defined cases: a NULL
    text counts as empty; NULL ids are never preferred over others; of rows that repeat both
    id and text exactly one is kept; other columns are not read.
    """
    largest = keep == "largest"
    if keep not in ("largest", "smallest"):
        raise ValueError(f"keep must be 'largest' or 'smallest', not {keep!r}")
    rows = docs.select(
        column(id_col).alias("id"), ascii_lower(text_or_empty(text_col)).alias("norm")
    ).withColumn("hash", F.xxhash64("norm"))

    # At most `hot_share` texts can each hold one in `hot_share` rows, which bounds what is
    # broadcast here.
    counts = rows.groupBy("hash").agg(F.count(F.lit(1)).alias("rows"))
    least = max(docs.count() // hot_share, salts)
    hot = counts.where(F.col("rows") > least).select("hash", F.lit(True).alias("hot"))
    salt = F.pmod(F.xxhash64(F.col("id"), F.lit("salt")), F.lit(salts))
    rows = rows.join(F.broadcast(hot), "hash", "left").select(
        "id",
        "norm",
        "hash",
        F.coalesce("hot", F.lit(False)).alias("hot"),
        F.when(F.col("hot"), salt).otherwise(F.lit(0)).alias("salt"),
        F.substring("norm", 1, PREFIX).alias("prefix"),
    )

    key = ["prefix", "hash", "salt"]
    equal = Window.partitionBy(*key, "norm")
    best = F.col("id").desc_nulls_last() if largest else F.col("id").asc_nulls_last()
    extreme = F.max if largest else F.min
    sorted_rows = rows.repartitionByRange(*key)
    grouped = sorted_rows.select(
        "id",
        "hash",
        "hot",
        F.sha2("norm", 256).alias("sha"),
        extreme("id").over(equal).alias("best"),
        F.count(F.lit(1)).over(equal).alias("size"),
        F.row_number().over(equal.orderBy(best)).alias("place"),
    )
    merged = (
        grouped.where(F.col("hot") & (F.col("place") == 1))
        .groupBy(F.col("hash").alias("hot_hash"), F.col("sha").alias("hot_sha"))
        .agg(extreme("best").alias("hot_best"), F.sum("size").alias("hot_size"))
    )
    result = grouped.join(
        F.broadcast(merged),
        grouped["hot"] & (F.col("hash") == F.col("hot_hash")) & (F.col("sha") == F.col("hot_sha")),
        "left",
    ).withColumn("keep_id", F.when(F.col("hot"), F.col("hot_best")).otherwise(F.col("best")))
    return result.select(
        F.col("id").alias(id_col),
        "keep_id",
        F.when(F.col("hot"), F.col("hot_size")).otherwise(F.col("size")).alias("group_size"),
        ((F.col("place") == 1) & F.col("id").eqNullSafe(F.col("keep_id"))).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )
