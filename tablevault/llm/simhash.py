"""Near-duplicate documents by SimHash fingerprints, compared through segment bit counts."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablevault.functions.columns import column
from tablevault.llm.common import ascii_lower, python_tasks, release, stored, text_or_empty
from tablevault.llm.components import components

SHINGLE = 4
DISTANCE = 4
SEED = 42
# A segment is two bits, so the embedding has 32 dimensions with values 0, 1 and 2.
SEGMENTS = 32
_EVEN = 0x5555555555555555
# Axes of the grid: groups of neighbouring segments. Two points within the distance agree in
# all but DISTANCE of the groups, so one cell per choice of the other groups is enough. More
# groups mean more and finer cells, for more documents.
GROUPS = 9
_CHUNK = 1 << 20
_GAP = re.compile(rb"[\x20\x09-\x0D]")


def _word_lists(text: bytes, shingle: int) -> Iterator[list[bytes]]:
    """A text's words in lists of bounded size that overlap by a shingle less one word."""
    at, carried = 0, []
    while True:
        gap = _GAP.search(text, at + _CHUNK) if len(text) - at > _CHUNK else None
        end = gap.start() if gap else len(text)
        words = carried + text[at:end].split()
        if gap is None:
            yield words
            return
        if len(words) >= shingle:
            yield words
            carried = words[len(words) - shingle + 1 :]
        else:
            carried = words
        at = end


def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The SimHash of a text: a bit is 1 if it is set in over half the shingles' hashes.

    A-Z are lower-cased. A text of fewer words than a shingle is one shingle, a text without
    words has fingerprint 0.
    """
    counts, total, hashed = np.zeros(64, np.int64), 0, xxhash.xxh64_intdigest
    for words in _word_lists(text.lower(), shingle):
        if not words:
            continue
        joined = b" ".join(words)
        width = min(shingle, len(words))
        if len(words) < shingle and total:
            continue  # the overlap alone
        ends = np.cumsum([len(w) + 1 for w in words])
        starts = (ends - [len(w) + 1 for w in words]).tolist()
        ends = (ends[width - 1 :] - 1).tolist()
        hashes = np.fromiter(
            (hashed(joined[a:b], seed) for a, b in zip(starts, ends, strict=False)),
            np.uint64,
            len(ends),
        )
        for i in range(0, len(hashes), 4096):
            block = hashes[i : i + 4096].view(np.uint8).reshape(-1, 8)
            counts += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        total += len(hashes)
    bits = counts * 2 > total
    return int(np.packbits(bits, bitorder="little").view(np.uint64)[0])


def fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE
) -> DataFrame:
    """(id, fp) per row, the fingerprint as a signed bigint."""
    python_tasks(docs.sparkSession)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(t.as_py(), shingle) for t in batch.column("text")]
            values = np.array(found, np.uint64).view(np.int64)
            yield pa.record_batch([batch.column("id"), pa.array(values)], ["id", "fp"])

    rows = docs.select(
        column(id_col).cast("long").alias("id"), text_or_empty(text_col).cast("binary").alias("text")
    )
    return rows.mapInArrow(hashed, "id long, fp long")


def column_fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE
) -> DataFrame:
    """`fingerprints` by column expressions alone: (id, fp) once per id and text.

    Spark's xxhash64 of a text is its XXH64 by the seed 42. A shingle is a row of generated
    code; two bits of its hash go into the halves of each of 32 sums, so a text may have two
    billion shingles. Rows that repeat double all counts, which changes no bit. The words of a
    text are held in memory at once, here and in no other step.
    """
    text = text_or_empty(text_col)
    rows = docs.select(
        column(id_col).cast("long").alias("id"),
        F.xxhash64(text).alias("content"),
        F.array_remove(F.split(ascii_lower(text), r"[\x20\x09-\x0D]+"), "").alias("words"),
    )
    size = F.size("words")
    # Words beside their next ones; a text of fewer words than a shingle is its first entry.
    beside = F.arrays_zip(
        F.col("words").alias("w0"),
        *[F.slice("words", F.lit(i + 1), size).alias(f"w{i}") for i in range(1, shingle)],
    )
    starts = F.slice(beside, F.lit(1), F.greatest(size - (shingle - 1), F.lit(1)))
    names = [f"w{i}" for i in range(shingle)]
    shingles = rows.select("id", "content", F.inline_outer(starts).alias(*names)).select(
        "id",
        "content",
        # Without words, no bit is set.
        F.when(F.col("w0").isNull(), F.lit(0)).otherwise(F.xxhash64(F.concat_ws(" ", *names))).alias("h"),
    )
    ends = F.lit((1 << 32) + 1)
    sums = [
        F.sum(F.shiftrightunsigned("h", i).bitwiseAND(ends)).alias(f"s{i}") for i in range(32)
    ]
    counted = shingles.groupBy("id", "content").agg(F.count(F.lit(1)).alias("total"), *sums)

    def bit(i: int) -> Column:
        count = F.shiftright(f"s{i % 32}", 32) if i >= 32 else F.col(f"s{i}").bitwiseAND(F.lit((1 << 32) - 1))
        return F.when(2 * count > F.col("total"), F.lit(_signed(1 << i))).otherwise(F.lit(0))

    return counted.select("id", reduce(Column.bitwiseOR, [bit(i) for i in range(64)]).alias("fp"))


def embedded(fp: Column) -> Column:
    """The bit counts of a fingerprint's segments, packed into one bigint.

    Each count takes the two bits of its segment as 00, 01 or 11, so the Manhattan distance
    of two points is the number of bits in which they differ.
    """
    even = F.lit(_EVEN)
    low, high = fp.bitwiseAND(even), F.shiftrightunsigned(fp, 1).bitwiseAND(even)
    return low.bitwiseOR(high).bitwiseOR(F.shiftleft(low.bitwiseAND(high), 1))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _axes(groups: int, distance: int) -> list[int]:
    """Masks that keep `groups - distance` of the groups of segments."""
    edges = [round(i * SEGMENTS / groups) * 2 for i in range(groups + 1)]
    masks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:], strict=False)]
    return [_signed(sum(c)) for c in combinations(masks, groups - distance)]


def _apart(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def _gridded(points: DataFrame, distance: int, groups: int) -> DataFrame:
    """`points` (fp, ...), once for each `cell` of the grid that a point is in."""
    cells = F.array(
        *[
            F.xxhash64(F.lit(i), embedded(F.col("fp")).bitwiseAND(F.lit(mask)))
            for i, mask in enumerate(_axes(groups, distance))
        ]
    )
    # Points are few bytes but many cells, so they are spread over all tasks before.
    tasks = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return points.repartition(tasks).select("*", F.explode(cells).alias("cell"))


def classes(points: DataFrame, distance: int = DISTANCE, groups: int = GROUPS) -> DataFrame:
    """(fp, class) for the distinct fingerprints in `points`: components of close ones.

    Two fingerprints are linked if at most `distance` bits differ. Their points under
    `embedded` are then at most as far apart, and share a cell of the grid. The join runs in
    two steps, since a cell may hold a great many near copies:

    1. Each point is compared with its cell's least point, in one pass over sorted cells. That
       joins most copies into components. Points that are alone in all their cells are done.
    2. The others are filed once more, with their component. Points of one cell are compared
       with each other only if they are in different components, first by Manhattan distance,
       then by all bits. Cells of one component, as those of copies, end before the join.

    Points that step 1 joined need no further link, so no link between components is lost.
    """
    points = stored(points.select("fp").distinct(), "fp")
    in_cell = Window.partitionBy("cell")
    # In a cell of several points, each is beside the least or is itself the least of more.
    hubs = _gridded(points, distance, groups).select(
        "fp", F.min("fp").over(in_cell).alias("hub"), F.max("fp").over(in_cell).alias("most")
    )
    shared = stored(hubs.where("hub < most").select("fp", "hub"), "cells")
    release(points.sparkSession)
    first = shared.where((F.col("fp") != F.col("hub")) & (_apart("fp", "hub") <= distance))
    joined = components(first.select(F.col("fp").alias("u"), F.col("hub").alias("v")))
    joined = stored(joined, "joined")
    release(points.sparkSession)

    near = shared.select("fp").distinct()
    parts = near.join(joined, near["fp"] == joined["node"], "left").select(
        "fp", F.coalesce("component", "fp").alias("part")
    )
    members = _gridded(stored(parts, "parts"), distance, groups)
    mixed = members.select(
        "*", F.min("part").over(in_cell).alias("least"), F.max("part").over(in_cell).alias("most")
    ).where("least < most")
    point = embedded(F.col("fp")).alias("point")
    open_ = stored(mixed.select("cell", "fp", point, "part"), "open")
    release(points.sparkSession)
    a = open_.select("cell", *[F.col(c).alias(f"{c}_a") for c in ("fp", "point", "part")])
    b = open_.select("cell", *[F.col(c).alias(f"{c}_b") for c in ("fp", "point", "part")])
    # The lower bound is a bit count of two columns that are there already, and so cheap.
    close = (
        (F.col("cell_a") == F.col("cell"))
        & (F.col("part_a") < F.col("part_b"))
        & (_apart("point_a", "point_b") <= distance)
        & (_apart("fp_a", "fp_b") <= distance)
    )
    second = a.withColumnRenamed("cell", "cell_a").join(b, close)
    merged = components(second.select(F.col("part_a").alias("u"), F.col("part_b").alias("v")))
    merged = stored(merged, "merged")

    part = points.join(joined, points["fp"] == joined["node"], "left").select(
        "fp", F.coalesce("component", "fp").alias("part")
    )
    return part.join(merged, part["part"] == merged["node"], "left").select(
        "fp", F.coalesce("component", "part").alias("class")
    )


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    distance: int = DISTANCE,
    groups: int = GROUPS,
    native: bool = False,
) -> DataFrame:
    """Group documents whose SimHash fingerprints are linked by chains of close ones.

    One row per input row: id, `fp` (signed bigint) and `component_id`, the least id that is
    reachable. Defined cases: NULL and wordless texts have fingerprint 0 and are linked like
    any other; rows with a NULL id are members but never name a component unless all its
    ids are NULL; rows that repeat are members of one component; other columns are not read. With `native`, no
    Python runs in tasks, and rows of one id and text are one row.
    """
    hashed = column_fingerprints if native else fingerprints
    rows = stored(hashed(docs, id_col, text_col, shingle), "fingerprints")
    release(docs.sparkSession)
    found = stored(classes(rows, distance, groups), "classes")
    release(docs.sparkSession)
    # Ids go down to one row per fingerprint before they meet the classes.
    least = rows.groupBy("fp").agg(F.min("id").alias("least"))
    named = found.join(least, "fp")
    of_class = named.groupBy("class").agg(F.min("least").alias("component_id"))
    by_fp = named.select("fp", "class").join(of_class, "class").select("fp", "component_id")
    return rows.join(by_fp, "fp").select(F.col("id").alias(id_col), "fp", "component_id")
