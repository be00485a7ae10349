"""The trie of conversation prefixes, from ROLLUPs over columns of turn ids."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablevault.functions.columns import column
from tablevault.llm.common import python_tasks, stored, text_or_empty

# Turns of a column block.
WIDTH = 8
# Turn numbers, and conversation ids of an end, that are handled together: a power of two.
_RANGE_BITS, _CHUNK_BITS = 10, 12
_TURNS = [f"t{i}" for i in range(1, WIDTH + 1)]
_EMPTY = hashlib.sha256().hexdigest()


def turn_ids(
    rows: DataFrame,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """Every turn as (conv, place, a, b, words): its place from 1 and 128 bits of content.

    NULL roles and texts count as empty, NULL turn numbers come first, and turns of the same
    number are ordered by content. Places are counted inside ranges of turn numbers, each
    beginning behind the turns counted before it, so a conversation that is a third of the
    table is many groups. Rows with a NULL id belong to no conversation and are left out.
    """
    role, text = text_or_empty(role_col), text_or_empty(text_col)
    # SHA-256 of both, with the role's length in front; the first half of it is enough.
    content = F.sha2(F.concat_ws(":", F.length(role).cast("string"), F.concat(role, text)), 256)
    turns = rows.where(column(id_col).isNotNull()).select(
        column(id_col).cast("long").alias("conv"),
        column(turn_col).cast("long").alias("turn"),
        content.alias("sha"),
        F.size(F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))).alias("words"),
    )

    def bits(start: int) -> Column:
        """16 hexadecimal digits as a bigint."""
        high = F.conv(F.substring("sha", start, 8), 16, 10).cast("long")
        low = F.conv(F.substring("sha", start + 8, 8), 16, 10).cast("long")
        return F.shiftleft(high, 32).bitwiseOR(low)

    turns = turns.select(
        "conv", "turn", F.shiftright("turn", _RANGE_BITS).alias("range"),
        bits(1).alias("a"), bits(17).alias("b"), "words",
    )
    inside = Window.partitionBy("conv", "range")
    numbered = turns.withColumns(
        {
            "place": F.row_number().over(inside.orderBy("turn", "a", "b")),
            "rows": F.count(F.lit(1)).over(inside),
        }
    )
    earlier = Window.partitionBy("conv").orderBy("range").rowsBetween(
        Window.unboundedPreceding, -1
    )
    starts = (
        numbered.where("place = 1")
        .select("conv", "range", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("before"))
        .where("before > 0")
        .toDF("start_conv", "start_range", "before")
    )
    found = numbered.join(
        starts,
        (F.col("conv") == F.col("start_conv")) & F.col("range").eqNullSafe(F.col("start_range")),
        "left",
    )
    place = F.col("place") + F.coalesce("before", F.lit(0))
    return found.select("conv", place.alias("place"), "a", "b", "words")


def rebuilt(turns: DataFrame, group: int = 20, most: int = 4) -> DataFrame:
    """Put the first turns of a group's first conversation before the others' own.

    The first h turns of conversation `c - c % group` come first (fewer or none if it has no
    more), then c's own turns without its first h; h is crc32 of c's decimal digits modulo
    `most`. Conversations without any turn left keep one row of place 0 and NULL content.
    """
    turns = stored(turns, "trie-turns")
    h = F.pmod(F.crc32(F.col("conv").cast("string").cast("binary")), F.lit(most))
    heads = (
        turns.where((F.col("conv") % group == 0) & (F.col("place") < most))
        .groupBy(F.col("conv").alias("base"))
        .agg(F.array_sort(F.collect_list(F.struct("place", "a", "b", "words"))).alias("head"))
    )
    convs = (
        turns.groupBy("conv")
        .agg(F.max("place").alias("own"))
        .withColumns({"base": F.col("conv") - F.col("conv") % group, "h": h.cast("int")})
        .join(heads, "base", "left")
        .select("conv", "h", F.coalesce(F.slice("head", 1, F.col("h")), F.array()).alias("head"))
    )
    # Row 0 stands for the conversation itself.
    zero = F.struct(
        F.lit(0).cast("long").alias("place"), F.lit(None).cast("long").alias("a"),
        F.lit(None).cast("long").alias("b"), F.lit(None).cast("int").alias("words"),
    )
    shared = convs.select(
        "conv",
        F.inline(
            F.concat(
                F.array(zero),
                F.transform(
                    "head",
                    lambda t: F.struct(
                        t["place"].cast("long").alias("place"), t["a"].alias("a"),
                        t["b"].alias("b"), t["words"].alias("words"),
                    ),
                ),
            )
        ),
    )
    # Only a head that is too short moves a conversation's own turns.
    moved = convs.select(
        F.col("conv").alias("moved_conv"), (F.size("head") - F.col("h")).alias("by")
    ).where("by < 0")
    own = (
        turns.where(F.col("place") > h)
        .join(moved, F.col("conv") == F.col("moved_conv"), "left")
        .select(
            "conv",
            (F.col("place") + F.coalesce("by", F.lit(0))).cast("long").alias("place"),
            "a", "b", "words",
        )
    )
    return shared.unionByName(own)


def _blocks(turns: DataFrame) -> DataFrame:
    """One row per conversation and block of `WIDTH` places, with the turns as columns.

    A turn id is 128 bits of place and content. `k1`, `k2` are the exclusive or of all turn
    ids before the block, which is the same for all conversations that agree so far: the
    node by which the block before ends. `e1`, `e2` are the conversation's own end, in its
    last block.
    """
    place = F.greatest(F.col("place") - 1, F.lit(0))
    turn = F.struct(
        F.xxhash64("place", "a", "b").alias("x"),
        F.xxhash64("b", "place", "a").alias("y"),
        "words",
    )
    placed = turns.select(
        "conv",
        F.floor(place / WIDTH).alias("block"),
        (place % WIDTH).alias("at"),
        "place",
        F.when(F.col("a").isNotNull(), turn).alias("turn"),
    )
    rows = placed.groupBy("conv", "block").agg(
        F.max("place").alias("length"),
        F.coalesce(F.bit_xor("turn.x"), F.lit(0)).alias("x"),
        F.coalesce(F.bit_xor("turn.y"), F.lit(0)).alias("y"),
        *[F.max(F.when(F.col("at") == i, F.col("turn"))).alias(t) for i, t in enumerate(_TURNS)],
    )
    ordered = Window.partitionBy("conv").orderBy("block")
    whole = Window.partitionBy("conv")
    sums = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = F.lead("block").over(ordered).isNull()
    x, y = F.bit_xor("x").over(sums), F.bit_xor("y").over(sums)
    return rows.select(
        "conv",
        "block",
        x.bitwiseXOR(F.col("x")).alias("k1"),
        y.bitwiseXOR(F.col("y")).alias("k2"),
        F.when(last, x).alias("e1"),
        F.when(last, y).alias("e2"),
        F.max("length").over(whole).alias("length"),
        *_TURNS,
    )


def _rolled_up(blocks: DataFrame, *measures: str) -> DataFrame:
    """`measures` of every prefix, from one ROLLUP over the turn columns of all blocks.

    Within a block the columns are rolled up behind the node that the block continues, and
    grouping_id tells how many of them a row still has. Rows whose last column holds no
    turn are conversations that ended before; a block's row without columns repeats the
    last one of the block before, so it is kept for the root alone.
    """
    level = f"{WIDTH} - bit_count(grouping_id())"
    held = " ".join(f"WHEN {i} THEN {t} IS NOT NULL" for i, t in enumerate(_TURNS, 1))
    rows = blocks.sparkSession.sql(
        f"""
        SELECT block, k1, k2, {", ".join(_TURNS)}, {level} AS level, {", ".join(measures)}
        FROM {{blocks}}
        GROUP BY block, k1, k2, ROLLUP ({", ".join(_TURNS)})
        HAVING CASE {level} {held} ELSE block = 0 END
        """,
        blocks=blocks,
    )
    names = rows.columns[WIDTH + 4 :]
    last = F.get(F.array(*_TURNS), F.col("level").cast("int") - 1)

    def node(key: str, field: str) -> Column:
        value = F.col(key)
        for t in _TURNS:
            value = value.bitwiseXOR(F.coalesce(F.col(f"{t}.{field}"), F.lit(0)))
        return value

    root = F.col("level") == 0
    return rows.select(
        node("k1", "x").alias("n1"),
        node("k2", "y").alias("n2"),
        (F.col("block") * WIDTH + F.col("level")).alias("depth"),
        F.when(root, 0).otherwise(last["words"]).cast("long").alias("words"),
        F.when(~root, last["x"]).alias("x"),
        F.when(~root, last["y"]).alias("y"),
        *names,
    )


def _end_digests(ends: DataFrame) -> DataFrame:
    """(n1, n2, sha): the digest of the ids that end at a node, in order.

    The ids of a node are joined to texts by ranges of 4096 ids, so only the texts of the
    ranges meet, sorted by Spark, and are fed to the digest one after the other.
    """
    python_tasks(ends.sparkSession)
    ranges = ends.groupBy("n1", "n2", F.shiftright("conv", _CHUNK_BITS).alias("range")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("conv")), lambda c: c.cast("string")), ",")
        .alias("ids")
    )

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, sha, done = None, None, []

        def batch() -> pa.RecordBatch:
            n1, n2, shas = zip(*done, strict=True)
            done.clear()
            return pa.record_batch(
                [pa.array(n1, pa.int64()), pa.array(n2, pa.int64()), pa.array(shas)],
                ["n1", "n2", "sha"],
            )

        for rows in batches:
            columns = [rows.column(c).to_pylist() for c in ("n1", "n2", "ids")]
            for n1, n2, ids in zip(*columns, strict=True):
                if (n1, n2) != node:
                    if node:
                        done.append((*node, sha.hexdigest()))
                    node, sha = (n1, n2), hashlib.sha256(ids.encode())
                else:
                    sha.update(b"," + ids.encode())
                if len(done) == 10_000:
                    yield batch()
        if node:
            done.append((*node, sha.hexdigest()))
            yield batch()

    placed = ranges.repartition("n1", "n2").sortWithinPartitions("n1", "n2", "range")
    return placed.select("n1", "n2", "ids").mapInArrow(digested, "n1 long, n2 long, sha string")


def prefix_trie(turns: DataFrame) -> DataFrame:
    """The nodes of the trie of all conversations, given as `rebuilt` or `turn_ids` has them.

    One row per distinct sequence of first turns, the empty one included: `conv_id` (least
    member), `depth`, `parent_conv_id`, `n_convs`, `n_children`, `n_leaves`, `saved_tokens`
    (over the subtree, members beyond the first times the last turn's words) and
    `ends_sha256` (of the ids that end there). An empty table has no nodes.

    A node's least member passes through it on its own way down, and the nodes of which a
    conversation is the least member are the lower end of that way. So a subtree's sum is a
    running sum along one conversation plus the totals of the node's other members, and
    those come from a second ROLLUP: no round for each depth, no pairs of nodes.
    Nodes are told apart by 128 bits of their turns' contents and places.
    """
    blocks = stored(_blocks(turns), "trie-blocks")
    found = _rolled_up(
        blocks, "count(*) AS n_convs", "min(conv) AS conv_id", "max(length) AS deepest"
    )
    own = (F.col("n_convs") - 1) * F.col("words")
    leaf = (F.col("deepest") == F.col("depth")).cast("long")
    nodes = found.select(
        "n1", "n2", "depth", "conv_id", "n_convs",
        own.alias("saved"), leaf.alias("leaf"),
        F.col("n1").bitwiseXOR(F.col("x")).alias("p1"),
        F.col("n2").bitwiseXOR(F.col("y")).alias("p2"),
    )
    way = Window.partitionBy("conv_id")
    below = way.orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    nodes = stored(
        nodes.select(
            "n1", "n2", "p1", "p2", "depth", "conv_id", "n_convs",
            F.sum("saved").over(below).alias("saved_below"),
            F.sum("leaf").over(below).alias("leaves_below"),
            F.sum("saved").over(way).alias("saved_all"),
            F.sum("leaf").over(way).alias("leaves_all"),
            F.row_number().over(way.orderBy("depth")).alias("step"),
        ),
        "trie-nodes",
    )
    totals = nodes.where("step = 1 AND (saved_all > 0 OR leaves_all > 0)").select(
        F.col("conv_id").alias("conv"), "saved_all", "leaves_all"
    )
    sums = _rolled_up(
        blocks.join(totals, "conv"), "sum(saved_all) AS saved_all", "sum(leaves_all) AS leaves_all"
    )
    ends = blocks.where("e1 IS NOT NULL").select(
        F.col("e1").alias("n1"), F.col("e2").alias("n2"), "conv"
    )
    facts = (
        nodes.select(
            "n1", "n2", "p1", "p2", "depth", "conv_id", "n_convs",
            (F.col("saved_below") - F.col("saved_all")).alias("saved"),
            (F.col("leaves_below") - F.col("leaves_all")).alias("leaves"),
        )
        .unionByName(
            sums.select("n1", "n2", F.col("saved_all").alias("saved"), F.col("leaves_all").alias("leaves")),
            allowMissingColumns=True,
        )
        .unionByName(
            nodes.where("p1 IS NOT NULL").select(
                F.col("p1").alias("n1"), F.col("p2").alias("n2"), F.lit(1).alias("child")
            ),
            allowMissingColumns=True,
        )
        .unionByName(_end_digests(ends), allowMissingColumns=True)
    )
    whole = facts.groupBy("n1", "n2").agg(
        *[F.max(c).alias(c) for c in ("p1", "p2", "depth", "conv_id", "n_convs")],
        F.sum("saved").alias("saved_tokens"),
        F.sum("leaves").alias("n_leaves"),
        F.count("child").alias("n_children"),
        F.coalesce(F.max("sha"), F.lit(_EMPTY)).alias("ends_sha256"),
    )
    parents = nodes.select(
        F.col("n1").alias("q1"), F.col("n2").alias("q2"), F.col("conv_id").alias("parent_conv_id")
    )
    return whole.join(
        parents, (F.col("p1") == F.col("q1")) & (F.col("p2") == F.col("q2")), "left"
    ).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        "ends_sha256",
    )
