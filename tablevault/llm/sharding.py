"""Shards of near equal size, by way of fixed virtual slots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablevault.functions.columns import column
from tablevault.llm.common import text_or_empty
from tablevault.sources.scratch import scratch_path

SLOTS = 4096


def with_slots(
    docs: DataFrame, slots: int = SLOTS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Id, size in bytes plus 1, CRC-32 of the text and virtual slot of every row.

    The slot follows from the id and the text alone, so it never changes. A NULL text has
    no bytes; rows with a NULL id are spread by their texts.
    """
    text = text_or_empty(text_col)
    crc = F.crc32(text.cast("binary"))
    return docs.select(
        column(id_col).alias("id"),
        (F.octet_length(text).cast("long") + 1).alias("size"),
        crc.alias("crc"),
        F.pmod(F.xxhash64(column(id_col), crc), F.lit(slots)).alias("virtual_slot"),
    )


def slot_sizes(rows: DataFrame, slots: int = SLOTS) -> DataFrame:
    """Bytes and rows of each virtual slot, empty ones too; `slots` rows at most."""
    found = rows.groupBy("virtual_slot").agg(
        F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows")
    )
    every = rows.sparkSession.range(slots).withColumnRenamed("id", "virtual_slot")
    return every.join(found, "virtual_slot", "left").na.fill(0, ["bytes", "rows"])


def slot_map(sizes: DataFrame, shards: int) -> DataFrame:
    """Assign slots to shards: the largest slot first, always to the lightest shard.

    The fold runs over one array with an entry per slot, whose number is fixed.
    """
    slot = F.struct("bytes", "rows", "virtual_slot")
    ordered = F.array_sort(
        F.collect_list(slot),
        lambda a, b: F.when(a["bytes"] != b["bytes"], F.when(a["bytes"] > b["bytes"], -1).otherwise(1))
        .when(a["virtual_slot"] < b["virtual_slot"], -1)
        .when(a["virtual_slot"] > b["virtual_slot"], 1)
        .otherwise(0),
    )
    placed_type = "array<struct<virtual_slot:bigint,bytes:bigint,rows:bigint,shard:int>>"
    start = F.struct(
        F.array_repeat(F.lit(0).cast("long"), shards).alias("loads"),
        F.array().cast(placed_type).alias("placed"),
    )

    def place(state, s):
        lightest = (F.array_position(state["loads"], F.array_min(state["loads"])) - 1).cast("int")
        return F.transform(
            F.array(lightest),
            lambda shard: F.struct(
                F.transform(
                    state["loads"],
                    lambda load, i: load + F.when(i == shard, s["bytes"]).otherwise(0),
                ).alias("loads"),
                F.concat(
                    state["placed"],
                    F.array(
                        F.struct(
                            s["virtual_slot"].alias("virtual_slot"),
                            s["bytes"].alias("bytes"),
                            s["rows"].alias("rows"),
                            shard.alias("shard"),
                        )
                    ),
                ).alias("placed"),
            ),
        )[0]

    folded = sizes.agg(F.aggregate(ordered, start, place).alias("state"))
    return folded.select(F.inline("state.placed"))


def rebalanced(current: DataFrame, shards: int) -> DataFrame:
    """Edit a map for more shards, or for sizes that have changed.

    Every shard keeps its slots, in slot order, up to an equal share of all bytes; only the
    slots beyond that move, filling up the shards that lack over a twentieth of their share.
    With one more shard and sizes that were even, slots move into the new shard alone.
    """
    share = F.sum("bytes").over(Window.partitionBy()) / F.lit(shards)
    upto = Window.partitionBy("shard").orderBy("virtual_slot")
    marked = current.withColumn("share", share).withColumn("filled", F.sum("bytes").over(upto))
    stays = (F.col("filled") <= F.col("share") + F.col("bytes") / 2) & (F.col("shard") < shards)
    marked = marked.withColumn("stays", stays)
    every = current.sparkSession.range(shards).select(F.col("id").cast("int").alias("shard"))
    used = marked.where("stays").groupBy("shard").agg(F.sum("bytes").alias("used"))
    total = marked.select("share").limit(1)
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    room = (
        every.join(used, "shard", "left")
        .crossJoin(total)  # one row
        .withColumn("room", F.greatest(F.lit(0.0), F.col("share") - F.coalesce("used", F.lit(0))))
        .where("room > share / 20")
        .withColumn("from", F.coalesce(F.sum("room").over(before), F.lit(0.0)))
        .agg(F.array_sort(F.collect_list(F.struct("from", F.col("shard").alias("to")))).alias("rooms"))
    )
    moving = marked.where(~F.col("stays")).withColumn(
        "middle",
        F.sum("bytes").over(Window.orderBy("shard", "virtual_slot")) - F.col("bytes") / 2,
    )
    target = F.filter("rooms", lambda r: r["from"] <= F.col("middle"))
    moved = moving.crossJoin(room).select(  # `room` is one row, with an entry per shard
        "virtual_slot", "bytes", "rows", F.element_at(target, -1)["to"].alias("shard")
    )
    kept = marked.where("stays").select("virtual_slot", "bytes", "rows", "shard")
    return kept.unionByName(moved)


def store_map(spark: SparkSession, path: str, version: int, current: DataFrame) -> DataFrame:
    """Write a map as a new version below `path`, and read it again. Versions never change."""
    current.coalesce(1).write.mode("errorifexists").parquet(f"{path}/version={version}")
    return spark.read.schema(current.schema).parquet(f"{path}/version={version}")


def shard(
    docs: DataFrame,
    shards: int = 16,
    slots: int = SLOTS,
    id_col: str = "doc_id",
    text_col: str = "text",
    map_path: str | None = None,
) -> DataFrame:
    """Deal all rows out to shards of near equal bytes.

    Rows are hashed into a fixed number of virtual slots, bytes are summed up per slot, and
    the slots are assigned to shards by a map that is stored as version 1 below `map_path`
    (the shared scratch folder by default). `rebalanced` edits such a map later.

    One row per input row: id, size, text_crc32, shard, virtual_slot, and `slot`, the row's
    place in its shard, without gaps from 0, in the order of (virtual slot, id, CRC, size).
    Defined cases: NULL texts have size 1 and CRC 0, rows that repeat get places of their
    own, an empty table gives no rows.
    """
    spark = docs.sparkSession
    rows = with_slots(docs, slots, id_col, text_col)
    path = map_path or scratch_path(spark, "slot-map")
    assigned = store_map(spark, path, 1, slot_map(slot_sizes(rows, slots), shards))
    before = Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(
        Window.unboundedPreceding, -1
    )
    based = assigned.select(
        "virtual_slot", "shard", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("base")
    )
    within = Window.partitionBy("virtual_slot").orderBy("id", "crc", "size")
    placed = rows.withColumn("place", F.row_number().over(within))
    # The map has one row per slot, whatever the size of the data.
    return placed.join(F.broadcast(based), "virtual_slot").select(
        F.col("id").alias(id_col),
        "size",
        F.col("crc").alias("text_crc32"),
        "shard",
        (F.col("base") + F.col("place") - 1).alias("slot"),
        "virtual_slot",
    )
