"""Byte-level BPE tokens by folding merges with array functions, from a rank file, and back."""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablevault.functions.columns import column
from tablevault.llm.common import python_tasks, text_or_empty

# Distinct words that a task keeps folded from its first batch to the next ones, at most.
FREQUENT = 1 << 14
# Bytes of a batch: a batch's words are in memory several times while they are folded.
BATCH = "4m"
_TRIES = 1024
# Words of at most so many bytes are folded together, by length: a turn takes one pass over
# all of them. Longer words are folded one by one, which takes n log n steps each.
_TOGETHER = (8, 16, 32, 64, 128, 512)
_NO_PAIR = np.iinfo(np.int64).max


@dataclass
class Vocabulary:
    """Token bytes by rank, and the rank of every pair of tokens that merges into a token.

    The pairs are a sparse matrix, (left rank, right rank) -> merged rank. Its rows are laid
    over each other in one array, each shifted to where its entries meet free places: the
    entry of (a, b) is at `shift[a] + b`, and is a's if `owner` says so.
    """

    tokens: list[bytes]
    shift: list[int]
    owner: list[int]
    merged: list[int]

    @classmethod
    def read(cls, path: str) -> Vocabulary:
        """Read a file of lines `base64(token) rank`, which every client can open."""
        with open(path, "rb") as lines:
            ranks = {
                base64.b64decode(token): int(rank)
                for token, rank in (line.split() for line in lines if line.strip())
            }
        return cls.of(ranks)

    @classmethod
    def of(cls, ranks: dict[bytes, int]) -> Vocabulary:
        if len(set(ranks.values())) != len(ranks) or any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError("ranks must be distinct and cover all single bytes")
        size = max(ranks.values()) + 1
        tokens = [b""] * size
        rows: dict[int, dict[int, int]] = {}
        for token, rank in ranks.items():
            tokens[rank] = token
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    rows.setdefault(left, {})[right] = rank
        return cls(tokens, *_laid_over(rows, size))


def _laid_over(rows: dict[int, dict[int, int]], size: int) -> tuple[list, list, list]:
    """Shifts, owners and values of the rows, the longest laid first, each as low as it fits."""
    entries = sum(map(len, rows.values()))
    taken = np.zeros(4 * entries + 2 * size + _TRIES, bool)
    owner, merged = np.full(len(taken), -1, np.int32), np.zeros(len(taken), np.int32)
    shift, low, free = [0] * size, {}, 0
    for left, row in sorted(rows.items(), key=lambda r: -len(r[1])):
        rights = np.fromiter(row, np.int64, len(row))
        while taken[free]:
            free += 1
        # Rows of one length fail at the same crowded places: go on where the last one lay.
        at = max(free, low.get(len(row), 0)) - rights.min()
        while True:
            tries = at + np.arange(max(8, min(_TRIES, (1 << 16) // len(row))))
            clear = ~taken[tries[:, None] + rights].any(axis=1)
            if clear.any():
                at = int(tries[clear.argmax()])
                break
            at = int(tries[-1]) + 1
        low[len(row)] = at + int(rights.min())
        shift[left] = at
        taken[at + rights] = True
        owner[at + rights], merged[at + rights] = left, list(row.values())
    length = int(np.flatnonzero(taken)[-1]) + 1 if entries else 1
    return shift, owner[:length].tolist(), merged[:length].tolist()


class Folder:
    """Folds words to token ranks with one vocabulary; goes to the tasks as a few arrays."""

    def __init__(self, vocabulary: Vocabulary):
        self._none = len(vocabulary.tokens)  # beside the ends of a word
        lowest = min(0, *vocabulary.shift)
        # No place that a look-up may ask for is outside of the arrays.
        self._shift = np.array([*vocabulary.shift, 0], np.int64) - lowest
        length = int(self._shift.max()) + self._none + 1
        self._owner, self._merged = np.full(length, -1, np.int32), np.zeros(length, np.int32)
        filled = slice(-lowest, len(vocabulary.owner) - lowest)
        self._owner[filled], self._merged[filled] = vocabulary.owner, vocabulary.merged
        self._single = np.zeros(256, np.int32)
        for rank, token in enumerate(vocabulary.tokens):
            if len(token) == 1:
                self._single[token[0]] = rank
        self._tokens = pa.array([t or None for t in vocabulary.tokens], pa.binary())

    def _pairs(self, left: np.ndarray, right: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Rank of the merged pair, then its place, in one number; `_NO_PAIR` without a merger."""
        at = self._shift[left] + right
        found = self._merged[at].astype(np.int64) << 32 | place
        return np.where(self._owner[at] == left, found, _NO_PAIR)

    def fold(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Token ranks of all words, one after the other, and where each begins.

        A word that is a token is that token. In all others the pair of least rank merges,
        leftmost first, till none does.
        """
        words = words.cast(pa.binary())
        whole = pc.index_in(words, value_set=self._tokens).fill_null(-1).to_numpy()
        n_bytes = pc.binary_length(words).to_numpy()
        counts = np.where(whole >= 0, 1, 0).astype(np.int64)
        parts, least = [], 0
        for most in (*_TOGETHER, _NO_PAIR):
            rows = np.flatnonzero((whole < 0) & (n_bytes > least) & (n_bytes <= most))
            least = most
            if len(rows):
                fold = self._one_by_one if most == _NO_PAIR else self._together
                ids, counts[rows] = fold(words.take(pa.array(rows)))
                parts.append((rows, ids))
        starts = _starts(counts)
        result = np.empty(starts[-1], np.int32)
        known = np.flatnonzero(whole >= 0)
        result[starts[known]] = whole[known]
        for rows, ids in parts:
            result[_ranges(starts[rows], counts[rows])] = ids
        return result, starts

    def _together(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ranks of all words in a row and their number for each: one merger a word and turn."""
        data, starts = _bytes(words)
        n = len(data)
        ids = np.append(self._single[data], self._none)
        place = np.arange(n + 1)
        after, before = place + 1, place - 1
        after[starts[1:] - 1], before[starts[:-1]] = n, n
        after[n] = before[n] = n
        pairs = self._pairs(ids, ids[after], place)
        while True:
            best = np.minimum.reduceat(pairs[:n], starts[:-1])
            best = best[best < _NO_PAIR]
            if not len(best):
                break
            at, rank = best & 0xFFFFFFFF, (best >> 32).astype(np.int32)
            gone, left = after[at], before[at]
            right = after[gone]
            ids[at], ids[gone], pairs[gone] = rank, -1, _NO_PAIR
            after[at], before[right] = right, at
            pairs[at] = self._pairs(rank, ids[right], at)
            pairs[left] = self._pairs(ids[left], rank, left)
        stays = ids[:n] >= 0
        return ids[:n][stays], np.add.reduceat(stays.astype(np.int64), starts[:-1])

    def _one_by_one(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The same for long words, with the pairs of a word in a heap."""
        folded = [self._long(word.as_py()) for word in words]
        return np.concatenate(folded), np.array([len(f) for f in folded], np.int64)

    def _long(self, word: bytes) -> np.ndarray:
        ids = self._single[np.frombuffer(word, np.uint8)]
        n = len(ids)
        place = np.arange(n - 1)
        heap = self._pairs(ids[:-1], ids[1:], place)
        pairs = [*heap.tolist(), _NO_PAIR]
        heap = heap[heap < _NO_PAIR].tolist()
        heapq.heapify(heap)
        ids, after, before = ids.tolist(), list(range(1, n + 1)), list(range(-1, n - 1))
        shift, owner, merged = self._shift, self._owner, self._merged

        def pair(left: int, right: int) -> None:
            """Look the pair of two places up anew."""
            at = shift[ids[left]] + ids[right]
            known = owner[at] == ids[left]
            pairs[left] = int(merged[at]) << 32 | left if known else _NO_PAIR
            if known:
                heapq.heappush(heap, pairs[left])

        while heap:
            best = heapq.heappop(heap)
            at = best & 0xFFFFFFFF
            if pairs[at] != best:
                continue  # one of the two has merged otherwise
            gone = after[at]
            ids[at], ids[gone], pairs[gone] = best >> 32, -1, _NO_PAIR
            after[at] = right = after[gone]
            if right < n:
                before[right] = at
                pair(at, right)
            else:
                pairs[at] = _NO_PAIR
            if before[at] >= 0:
                pair(before[at], at)
        ids = np.array(ids, np.int32)
        return ids[ids >= 0]


def _starts(counts: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])


def _ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The places start, start + 1, ... of each range, one range after the other."""
    shifted = starts - _starts(counts)[:-1]
    return np.repeat(shifted, counts) + np.arange(counts.sum())


def _bytes(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a binary array without NULLs, and where each value begins."""
    _, offsets, data = words.buffers()
    starts = np.frombuffer(offsets, np.int32)[words.offset : words.offset + len(words) + 1]
    if starts[0] == starts[-1]:
        return np.empty(0, np.uint8), starts.astype(np.int64) - starts[0]
    return np.frombuffer(data, np.uint8)[starts[0] : starts[-1]], starts.astype(np.int64) - starts[0]


def pieces_of(text: Column, pattern: str) -> Column:
    """The matches of a tokenizer's pattern, with white space as Unicode has it."""
    return F.regexp_extract_all(text, F.lit(f"(?U){pattern}"), F.lit(0))


def encode(
    docs: DataFrame,
    vocabulary: Vocabulary,
    pattern: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    most_frequent: int = FREQUENT,
) -> DataFrame:
    """Token ranks of every text: (id, `ids`).

    Texts are split by the tokenizer's pattern, and each word is folded: the pair of
    neighbouring tokens whose merger ranks lowest becomes one token until no pair merges.
    A word that is a token as a whole is that token. Inside a task, the distinct words of a
    batch of texts are folded together, each once, by array functions that merge one pair of
    every word a turn. The `most_frequent` most frequent words of a task's first batch stay
    folded for the next ones, which changes no result.

    Defined cases: NULL and empty texts have no tokens; rows that repeat are encoded one by
    one; other columns are not read.
    """
    python_tasks(docs.sparkSession, BATCH)
    folder = Folder(vocabulary)
    pieces = docs.select(
        column(id_col).alias("id"), pieces_of(text_or_empty(text_col), pattern).alias("pieces")
    )

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: tuple | None = None
        for batch in batches:
            lists = batch.column("pieces")
            words = lists.flatten().dictionary_encode()
            number = words.indices.to_numpy()
            ids, starts = _folded(folder, words.dictionary, kept)
            counts = np.diff(starts)
            if kept is None:
                often = np.argsort(-np.bincount(number, minlength=len(counts)), kind="stable")
                often = often[:most_frequent]
                frequent = ids[_ranges(starts[often], counts[often])], _starts(counts[often])
                kept = words.dictionary.take(pa.array(often)), *frequent
            flat = ids[_ranges(starts[number], counts[number])]
            in_text = _starts(counts[number])[_starts(pc.list_value_length(lists).to_numpy())]
            tokens = pa.ListArray.from_arrays(pa.array(in_text, pa.int32()), pa.array(flat))
            yield pa.record_batch([batch.column("id"), tokens], [id_col, "ids"])

    id_field = T.StructField(id_col, pieces.schema["id"].dataType)
    schema = T.StructType([id_field, T.StructField("ids", T.ArrayType(T.IntegerType()))])
    return pieces.mapInArrow(encoded, schema)


def _folded(folder: Folder, words: pa.Array, kept: tuple | None) -> tuple[np.ndarray, np.ndarray]:
    """`folder.fold(words)`, with the words in `kept` (words, ranks, starts) taken from there."""
    if kept is None or not len(kept[0]):
        return folder.fold(words)
    known = pc.index_in(words, value_set=kept[0]).fill_null(-1).to_numpy()
    old, new = np.flatnonzero(known >= 0), np.flatnonzero(known < 0)
    fresh, fresh_starts = folder.fold(words.take(pa.array(new)))
    counts = np.empty(len(words), np.int64)
    counts[new], counts[old] = np.diff(fresh_starts), np.diff(kept[2])[known[old]]
    starts = _starts(counts)
    ids = np.empty(starts[-1], np.int32)
    ids[_ranges(starts[new], counts[new])] = fresh
    ids[_ranges(starts[old], counts[old])] = kept[1][_ranges(kept[2][known[old]], counts[old])]
    return ids, starts


def decode(tokens: DataFrame, vocabulary: Vocabulary, ids_col: str = "ids") -> DataFrame:
    """Add `decoded`, the bytes of the token ranks in `ids_col` put together.

    NULL for a NULL list and for lists with an unknown rank; empty for an empty list.
    """
    python_tasks(tokens.sparkSession, BATCH)
    data, starts = _bytes(pa.array(vocabulary.tokens, pa.binary()))
    lengths = np.diff(starts)

    @F.arrow_udf("binary")
    def decoded(lists: pa.Array) -> pa.Array:
        ids = lists.flatten().fill_null(-1).to_numpy()
        in_list = _starts(pc.list_value_length(lists).fill_null(0).to_numpy())
        known = (ids >= 0) & (ids < len(lengths))
        ids = np.where(known, ids, 0)
        known &= lengths[ids] > 0
        flat = data[_ranges(starts[ids], lengths[ids])]
        ends = _starts(lengths[ids])[in_list].astype(np.int32)
        found = pa.Array.from_buffers(
            pa.binary(), len(lists), [None, pa.py_buffer(ends), pa.py_buffer(flat)]
        )
        whole = np.diff(_starts(~known)[in_list]) == 0
        return pc.if_else(pc.and_(pa.array(whole), lists.is_valid()), found, None)

    return tokens.withColumn("decoded", decoded(column(ids_col)))
