"""Repeated windows of texts, found by groups of ever finer keys.

Windows are handled in runs: neighbouring windows of one document that share an anchor. An
anchor is a piece of text that the window's own content picks, so equal windows have equal
anchors at equal places. Keys are then compared from the coarsest to the finest:

1. the anchor's content; what occurs once in all documents leaves here,
2. the content of the whole run; equal runs are repeats window by window,
3. the content of the single window, for the runs that are left in a group of several.

Anchors are counted by a partial aggregation. The rows of an anchor then meet in one task, but
for those of hot anchors, which are salted and merged, so a group that holds a third of all
rows is no bottleneck. Positions travel, and of texts only the runs of the last step.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablevault.functions.columns import column
from tablevault.llm.common import python_tasks, stored, text_or_empty

NULL_ID = -(1 << 63)
# A span is start << SPAN_BITS | (windows - 1).
SPAN_BITS = 8
# Units (bytes or words) of text that are worked on at once inside a task.
CHUNK = 1 << 18
HOT_SHARE = 8192
HOT_LEAST = 1024
SALTS = 64

KEYS = "key long"
RUNS = "key long, run long, span long, doc long, part int"
REMOVED_TYPE = "array<struct<start:long,end:long>>"
REMOVED = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
UNITS = "key long, doc long, part int, span long, content binary"


def identified(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, doc, part, text): `doc` is never NULL, and (doc, part) is unique.

    NULL ids come first. Rows that share an id are told apart by `part`, in the order of
    their texts.
    """
    rows = docs.select(
        column(id_col).cast("long").alias("id"),
        F.coalesce(column(id_col).cast("long"), F.lit(NULL_ID)).alias("doc"),
        text_or_empty(text_col).cast("binary").alias("text"),
    )
    repeated = rows.groupBy("doc").count().where("count > 1").limit(1).count() > 0
    if repeated:
        order = Window.partitionBy("doc").orderBy("text")
        part = F.row_number().over(order) - 1
    else:
        part = F.lit(0)
    return rows.select("id", "doc", part.alias("part"), "text")


def batches(rows: Iterator[pa.RecordBatch], size: int = CHUNK) -> Iterator[list]:
    """Lists of (doc, part, text, spans or None) whose texts add up to about `size` bytes."""
    held, total = [], 0
    for batch in rows:
        spans = batch.column("spans").to_pylist() if "spans" in batch.schema.names else None
        docs, parts, texts = (batch.column(c) for c in ("doc", "part", "text"))
        for i in range(batch.num_rows):
            text = texts[i].as_py()
            held.append((docs[i].as_py(), parts[i].as_py(), text, spans[i] if spans else None))
            total += len(text)
            if total >= size:
                yield held
                held, total = [], 0
    if held:
        yield held


def repeated_spans(
    texts: DataFrame,
    keys: Callable,
    runs: Callable,
    units: Callable,
    stride: int,
    width: int,
    within: bool,
) -> DataFrame:
    """`texts` with an array `spans` of the repeated windows of each, NULL if it has none.

    `texts` has (id, doc, part, text); `keys`, `runs` and `units` are functions for
    `mapInArrow` that give rows of `KEYS`, `RUNS` and, from texts with an array `spans` of
    (key, span), `UNITS`. A unit is the content of a run; its window i is the `width` bytes
    at `stride` times i. With `within`, a window is repeated if it also starts earlier, be
    it in the same document; else only if it also starts in an earlier document.

    A key's rows meet in one place, so its runs are compared without another shuffle.
    """
    python_tasks(texts.sparkSession)
    order = ["doc", "part", "span"] if within else ["doc", "part"]
    place = F.struct(*order)
    base = texts.select("doc", "part", "text")
    shared = stored(
        base.mapInArrow(keys, KEYS).groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"),
        "anchors",
    )
    total = shared.agg(F.sum("n")).first()[0] or 0
    # At most HOT_SHARE anchors can each hold one in HOT_SHARE of the runs, which bounds what
    # is broadcast. Their runs are dealt out as SALTS groups.
    least = max(total // HOT_SHARE, HOT_LEAST)
    hot = shared.where(F.col("n") >= least).select("key", F.lit(True).alias("hot"))
    zero = F.lit(0).cast("long")
    salt = F.when(F.col("hot"), F.pmod(F.xxhash64("doc", "part"), F.lit(SALTS))).otherwise(zero)
    salts = F.sequence(zero, F.when(F.col("n") >= least, zero + (SALTS - 1)).otherwise(zero))
    wanted = shared.select("key", F.explode(salts).alias("salt"))
    found = base.mapInArrow(runs, RUNS).join(F.broadcast(hot), "key", "left")
    found = found.withColumn("hot", F.coalesce("hot", F.lit(False)))
    found = found.withColumn("salt", salt).join(wanted, ["key", "salt"], "left_semi")

    group = Window.partitionBy("key", "salt")
    equal = Window.partitionBy("key", "salt", "run")
    repeat = F.rank().over(equal.orderBy(*order)) > 1
    open_ = F.min("run").over(group) < F.max("run").over(group)
    judged = found.withColumn("repeat", repeat).withColumn("open", open_)
    judged = stored(
        judged.where("repeat OR open OR hot").select(
            "doc",
            "part",
            "span",
            "repeat",
            F.col("hot") & ~F.col("repeat"),
            F.when(~F.col("repeat"), F.col("key")).alias("key"),
            F.when(~F.col("repeat") & F.col("hot"), F.col("run")).alias("run"),
        ).toDF("doc", "part", "span", "repeat", "hot", "key", "run"),
        "judged",
    )
    # Of a hot group, the first of each salt are left to compare.
    few = judged.where("hot")
    first = few.groupBy("key", "run").agg(F.min(place).alias("first"))
    several = first.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")
    few = few.drop("repeat").join(first, ["key", "run"]).join(
        several.withColumn("several", F.lit(True)), "key", "left"
    )
    few = few.withColumn("repeat", place > F.col("first"))
    columns = ["doc", "part", "span", "key"]
    settled = judged.where("repeat").select(columns[:3])
    settled = settled.unionByName(few.where("repeat").select(columns[:3]))
    unsettled = judged.where("NOT repeat AND NOT hot").select(columns)
    unsettled = unsettled.unionByName(few.where("NOT repeat AND several").select(columns))

    # Both joins with the texts read all columns of one shuffle of them.
    dealt = texts.repartition("doc", "part")
    left = unsettled.groupBy("doc", "part").agg(
        F.collect_list(F.struct("key", "span")).alias("spans")
    )
    contents = dealt.join(left, ["doc", "part"]).mapInArrow(units, UNITS)
    # Equal windows have equal keys, so what follows stays where the key went.
    count = F.col("span").bitwiseAND(F.lit((1 << SPAN_BITS) - 1)).cast("int")
    single = (
        contents.repartition("key")
        .select("*", F.explode(F.sequence(F.lit(0), count)).alias("i"))
        .select(
            "key",
            "doc",
            "part",
            (F.col("span") - count + F.shiftleft(F.col("i").cast("long"), SPAN_BITS)).alias("span"),
            F.substring("content", F.col("i") * stride + 1, F.lit(width)).alias("window"),
        )
        .select(
            "key",
            "doc",
            "part",
            "span",
            F.xxhash64("window").alias("one"),
            F.xxhash64("window", F.lit(1)).alias("two"),
        )
    )
    equal = Window.partitionBy("key", "one", "two").orderBy(*order)
    again = single.withColumn("place", F.rank().over(equal)).where("place > 1")
    spans = (
        settled.unionByName(again.select("doc", "part", "span"))
        .groupBy("doc", "part")
        .agg(F.collect_list("span").alias("spans"))
    )
    return dealt.join(spans, ["doc", "part"], "left")


def opened(spans: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys, first windows and numbers of windows of the (key, span) of one text."""
    packed = np.array([s["span"] for s in spans], np.int64)
    found = np.array([s["key"] for s in spans], np.int64)
    return found, packed >> SPAN_BITS, (packed & ((1 << SPAN_BITS) - 1)) + 1


def covered(spans: list | None, units: int, window: int) -> np.ndarray:
    """Which of a text's units lie in a repeated window."""
    edges = np.zeros(units + 1, np.int32)
    if spans:
        packed = np.asarray(spans, np.int64)
        starts = packed >> SPAN_BITS
        ends = starts + (packed & ((1 << SPAN_BITS) - 1)) + window
        np.add.at(edges, starts, 1)
        np.add.at(edges, ends, -1)
    return np.cumsum(edges[:-1]) > 0


def stretches(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true values."""
    steps = np.diff(np.concatenate(([0], mask.astype(np.int8), [0])))
    return np.flatnonzero(steps == 1), np.flatnonzero(steps == -1)
