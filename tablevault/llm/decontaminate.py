"""Find and remove benchmark passages in training text."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablevault.functions.columns import column
from tablevault.llm.common import ascii_lower, settled, text_or_empty

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10
# Benchmarks with more distinct windows than this go through a shuffled join instead of a
# set that is sent to every task.
MOST_BROADCAST = 200_000
_BUCKETS = 1 << 14
LEAD = 3  # words that are looked up before the whole window


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(text), F.lit(WORD), F.lit(0))


def _window(words: Column, start: Column, length: int) -> list[Column]:
    return [F.get(words, start + i) for i in range(length)]


def _described(words: Column, length: int) -> Callable[[Column], Column]:
    return lambda i: F.struct(
        F.lit(length).alias("length"),
        F.xxhash64(*_window(words, i, length)).alias("hash"),
        F.xxhash64(*_window(words, i, min(length, LEAD))).alias("lead"),
        F.concat_ws(" ", *_window(words, i, length)).alias("text"),
        i.alias("start"),
    )


def _starts(words: Column, length: int) -> Column:
    last = F.size(words) - length
    return F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))


def benchmark_windows(
    benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text", window: int = WINDOW
) -> DataFrame:
    """Distinct windows of all items: length, hash, text, and the sorted ids of their items.

    A window is `window` consecutive words; an item of fewer words, but not none, is one.
    """
    words = benchmark.select(
        column(item_col).cast("string").alias("item"), words_of(text_or_empty(text_col)).alias("words")
    ).where(F.size("words") > 0)
    whole = F.array(
        F.struct(
            F.size("words").alias("length"),
            F.xxhash64("words").alias("hash"),
            F.xxhash64(F.slice("words", 1, LEAD)).alias("lead"),
            F.array_join("words", " ").alias("text"),
            F.lit(0).alias("start"),
        )
    )
    cut = F.transform(_starts(F.col("words"), window), _described(F.col("words"), window))
    each = words.select(
        "item", F.inline(F.when(F.size("words") < window, whole).otherwise(cut))
    )
    return each.groupBy("length", "hash", "lead", "text").agg(
        F.array_sort(F.collect_set("item")).alias("items")
    )


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    most_broadcast: int = MOST_BROADCAST,
    carry: bool = False,
) -> DataFrame:
    """Mark the words of every document that lie inside a benchmark window.

    Every window of a document is hashed and looked up in the set of the benchmark's window
    hashes; hits are verified by their whole text. The set is part of the plan, after a count
    has shown that it has at most `most_broadcast` entries; larger benchmarks are looked up
    by a shuffled join.

    One row per document: id, n_words, n_hit, n_items, `items` (sorted as strings),
    `hit_words` (sorted positions) and contaminated; with `carry` also the whole input row
    as struct `row` and its words as `words`. Defined cases: NULL or wordless texts have no
    words and are never hit; NULL item ids name no item, yet their windows hit; an empty
    benchmark hits nothing; rows that repeat are judged one by one.
    """
    windows = benchmark_windows(benchmark, item_col, item_text_col, window)
    known = windows.limit(most_broadcast + 1).collect()
    rows = docs.select(
        column(id_col).alias("id"),
        words_of(text_or_empty(text_col)).alias("words"),
        *([F.struct(*[column(c) for c in docs.columns]).alias("row")] if carry else []),
    )
    if len(known) > most_broadcast:
        rows = _by_join(rows, windows)
    else:
        rows = _by_set(rows, known)
    flat = F.array_sort(
        F.array_distinct(
            F.flatten(
                F.transform("hits", lambda h: F.sequence(h["start"], h["start"] + h["length"] - 1))
            )
        )
    )
    items = F.array_sort(F.array_distinct(F.flatten(F.transform("hits", lambda h: h["items"]))))
    found = rows.withColumns({"hit_words": flat, "items": items}).select(
        F.col("id").alias(id_col),
        F.size("words").cast("long").alias("n_words"),
        F.size("hit_words").cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        "items",
        "hit_words",
        (F.size("hit_words") > 0).alias("contaminated"),
        *(["row", "words"] if carry else []),
    )
    return settled(found)


_HITS = "array<struct<start:int,length:int,items:array<string>>>"
_TABLE = "array<array<struct<text:string,items:array<string>>>>"


def _by_set(rows: DataFrame, known: list) -> DataFrame:
    """Look the windows up in literals: a hash set first, then the whole text."""
    if not known:
        return rows.withColumn("hits", F.array().cast(_HITS))
    found = []
    for length in sorted({k["length"] for k in known}):
        own = [k for k in known if k["length"] == length]
        found.append(_hits(length, own))
    return rows.withColumn("hits", F.concat(*found).cast(_HITS))


def _hits(length: int, known: list) -> Column:
    """Where `words` holds known windows of one length.

    A cheap look at the first words comes first: few starts are left for the whole window's
    hash, and fewer for the comparison of texts.
    """
    lead = min(length, LEAD)
    leads = {k["lead"] for k in known}
    hashes = {k["hash"] for k in known}
    buckets: list[list] = [[] for _ in range(_BUCKETS)]
    for k in known:
        buckets[k["hash"] % _BUCKETS].append({"text": k["text"], "items": k["items"]})
    table = F.from_json(F.lit(json.dumps(buckets)), _TABLE)  # folded to a literal
    words = F.col("words")

    # As SQL text, since a set of thousands of literals is slow to build by column calls.
    led = _sql_filter(_sql_starts(length), lead, leads)
    starts = F.expr(_sql_filter(led, length, hashes))

    def verified(i):
        bucket = F.get(
            table, F.pmod(F.xxhash64(*_window(words, i, length)), F.lit(_BUCKETS)).cast("int")
        )
        text = F.concat_ws(" ", *_window(words, i, length))
        return F.transform(
            F.filter(bucket, lambda b: b["text"] == text),
            lambda b: F.struct(
                i.alias("start"), F.lit(length).alias("length"), b["items"].alias("items")
            ),
        )

    return F.flatten(F.transform(starts, verified))


def _sql_starts(length: int) -> str:
    last = f"size(words) - {length}"
    return f"CASE WHEN {last} >= 0 THEN sequence(0, {last}) ELSE CAST(array() AS ARRAY<INT>) END"


def _sql_filter(starts: str, length: int, hashes: set[int]) -> str:
    window = ", ".join(f"get(words, i + {k})" for k in range(length))
    wanted = ", ".join(f"{h}L" for h in sorted(hashes))
    return f"filter({starts}, i -> xxhash64({window}) IN ({wanted}))"


def _by_join(rows: DataFrame, windows: DataFrame) -> DataFrame:
    """Look the windows up by a shuffled join on their hashes, then verify the whole text."""
    words = F.col("words")
    lengths = [r["length"] for r in windows.select("length").distinct().collect()]
    each = F.flatten(
        F.array(
            *[
                F.transform(
                    _starts(words, n),
                    _described(words, n),
                )
                for n in sorted(lengths)
            ]
        )
    )
    rows = rows.withColumn("content", F.xxhash64("words"))
    hits = (
        rows.select("id", "content", F.inline(each))
        .join(windows, ["length", "hash", "text"])
        .groupBy("id", "content")
        .agg(F.collect_set(F.struct("start", "length", "items")).alias("hits"))
        .select(F.col("id").alias("hit_id"), F.col("content").alias("hit_content"), "hits")
    )
    same = F.col("id").eqNullSafe(F.col("hit_id")) & (F.col("content") == F.col("hit_content"))
    return (
        rows.join(hits, same, "left")
        .withColumn("hits", F.coalesce(F.col("hits").cast(_HITS), F.array().cast(_HITS)))
        .drop("hit_id", "hit_content", "content")
    )
