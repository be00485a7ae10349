"""Removal of long word sequences that an earlier document has too, by recompression."""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tablevault.llm import hashing as H
from tablevault.llm import repeats as R

WINDOW = 50
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


@functools.cache
def _tools() -> tuple:
    return H.Rolling(0x5DEECE66D1CE4E5B), H.Rolling(0x2545F4914F6CDD1D), H.symbols(256, 23)


def split_words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words in a text's bytes."""
    return R.stretches(~_SPACE[data])


def _named_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The 64-bit name of each word of all texts, and the number of words of each text."""
    data = np.frombuffer(b" ".join(texts), np.uint8)
    starts, ends = split_words(data)
    rolling, _, symbols = _tools()
    names = rolling.between(rolling.prefix(symbols[data]), starts, ends)
    names = H.mix_pair(names, (ends - starts).astype(np.uint64))
    limits = np.cumsum([len(t) + 1 for t in texts])
    counts = np.diff(np.searchsorted(starts, limits), prepend=0)
    return names, counts


class _Level:
    """Symbols of one round: names, the words they cover (a to b), and their evidence.

    The words from l to u are evidence of a symbol: whatever stands around them, a text that
    holds these words holds the symbol there. A symbol that depends on where its text begins
    or ends gets evidence that reaches beyond it, so that no window holds it. Along the
    symbols l and u never fall.
    """

    def __init__(self, name, a, b, l, u):  # noqa: E741
        self.name, self.a, self.b, self.l, self.u = name, a, b, l, u

    def __len__(self):
        return len(self.name)


def _runs_named(s: _Level, words, lo, hi) -> _Level:
    """Name each maximal run of equal symbols as one symbol, (symbol, length)."""
    n = len(s)
    joined = (s.name[1:] == s.name[:-1]) & (lo[s.a[1:]] == lo[s.a[:-1]])
    first = np.flatnonzero(np.concatenate(([True], ~joined)))
    last = np.append(first[1:], n) - 1
    count = last - first + 1
    a, b = s.a[first], s.b[last]
    name = np.where(count > 1, H.mix_pair(s.name[first], count.astype(np.uint64)), s.name[first])
    # The neighbours must differ from the run. One word next to it often shows that they do;
    # if not, the whole neighbour is evidence.
    begins, ends = a == lo[a], b == hi[a]
    before, after = np.maximum(first - 1, 0), np.minimum(last + 1, n - 1)
    near = words[np.maximum(a - 1, 0)] != words[s.b[first] - 1]
    left = np.where(begins, a - 1, np.where(near, a - 1, s.l[before]))
    near = words[np.minimum(b, len(words) - 1)] != words[s.a[last]]
    right = np.where(ends, b + 1, np.where(near, b + 1, s.u[after]))
    return _Level(name, a, b, np.minimum(s.l[first], left), np.maximum(s.u[last], right))


def _pairs_named(s: _Level, lo, hi, turn: int) -> _Level:
    """Name neighbours as one symbol where a left symbol meets a right one.

    A bit of its name makes a symbol a left or a right one, anew in each round.
    """
    side = (H.mix(s.name ^ np.uint64(turn * 0x9E3779B9 + 1)) & np.uint64(1)).astype(bool)
    begins, ends = s.a == lo[s.a], s.b == hi[s.a]
    n = len(s)
    pair = np.zeros(n, bool)
    pair[:-1] = ~side[:-1] & side[1:] & ~ends[:-1]
    second = np.zeros(n, bool)
    second[1:] = pair[:-1]
    keep = ~second
    at = np.flatnonzero(keep)
    follow = np.minimum(at + 1, n - 1)
    before = np.maximum(at - 1, 0)
    paired = pair[at]
    name = np.where(paired, H.mix_pair(s.name[at] ^ np.uint64(turn), s.name[follow]), s.name[at])
    b = np.where(paired, s.b[follow], s.b[at])
    # A left symbol stays alone because a left one follows, a right one because a right one
    # is before it.
    alone_left, alone_right = ~paired & ~side[at], ~paired & side[at]
    l = np.where(alone_right, np.where(begins[at], s.a[at] - 1, s.l[before]), s.l[at])  # noqa: E741
    l = np.minimum(l, s.l[at])  # noqa: E741
    u = np.where(paired, s.u[follow], s.u[at])
    u = np.where(alone_left, np.where(ends[at], s.b[at] + 1, s.u[follow]), u)
    return _Level(name, s.a[at], b, l, np.maximum(u, s.u[at]))


def _rounds(window: int) -> int:
    """The round whose symbols windows are filed under: evidence of about a third of a window.

    A round makes symbols a third longer.
    """
    return max(0, round(math.log(max(window / 9, 1)) / math.log(4 / 3)))


def _anchors(words, lo, hi, starts, window: int):
    """For each window start: one of the symbols that the window holds.

    It is the one of the least hashed name, and of equal ones the first, among those of the
    highest round, up to the `_rounds` of the window, of which the window holds any. Returns
    the symbols' names (mixed with their round) and first words. Equal windows hold equal
    symbols in equal places, and a single word is always held.
    """
    at = np.arange(len(words))
    levels = [_Level(words, at, at + 1, at, at + 1)]
    for turn in range(1, _rounds(window) + 1):
        levels.append(_pairs_named(_runs_named(levels[-1], words, lo, hi), lo, hi, turn))
    name = np.zeros(len(starts), np.uint64)
    place = np.zeros(len(starts), np.int64)
    rest = np.arange(len(starts))
    for turn in range(len(levels) - 1, -1, -1):
        level = levels[turn]
        first = np.searchsorted(level.l, starts[rest])
        last = np.searchsorted(level.u, starts[rest] + window, "right") - 1
        held = first <= last
        take = rest[held]
        names = H.mix(level.name + np.uint64(turn))
        symbol = _least_between(names, first[held], last[held])
        name[take], place[take] = names[symbol], level.a[symbol]
        rest = rest[~held]
        if not len(rest):
            break
    return name, place


def _least_between(values: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Index of the first least value from `first` to `last`, for each pair of bounds."""
    if not len(first):
        return first
    # Row k of the table has the least of 2**k values; two overlapping rows cover any range.
    power = (np.frexp(last - first + 1)[1] - 1).astype(np.int64)
    least = np.arange(len(values))
    out = np.empty(len(first), np.int64)
    for k in range(int(power.max()) + 1):
        if k:
            half = 1 << (k - 1)
            a, b = least[:-half], least[half:]
            least = np.where(values[a] <= values[b], a, b)
        own = power == k
        a, b = least[first[own]], least[last[own] - (1 << k) + 1]
        out[own] = np.where(values[a] <= values[b], a, b)
    return out


def _pieces(texts: list, window: int) -> Iterator[tuple]:
    """(words, text bounds, window starts, owner, doc, part and offset of pieces)."""
    names, counts = _named_words([t[2] for t in texts])
    begins = np.cumsum(counts) - counts
    step = R.CHUNK // 4
    held, owners, offsets, total = [], [], [], 0
    for i, (begin, count) in enumerate(zip(begins, counts, strict=True)):
        for at in range(0, max(0, count - window + 1), step):
            held.append(names[begin + at : begin + min(count, at + step + window - 1)])
            owners.append(i)
            offsets.append(at)
            total += len(held[-1])
            if total >= step:
                yield _joined(held, owners, offsets, window)
                held, owners, offsets, total = [], [], [], 0
    if held:
        yield _joined(held, owners, offsets, window)


def _joined(held: list, owners: list, offsets: list, window: int) -> tuple:
    sizes = np.array([len(p) for p in held])
    begins = np.cumsum(sizes) - sizes
    lo, hi = np.repeat(begins, sizes), np.repeat(begins + sizes, sizes)
    counts = sizes - window + 1
    piece = np.repeat(np.arange(len(held)), counts)
    starts = np.arange(len(piece)) - np.repeat(np.cumsum(counts) - counts, counts) + begins[piece]
    words = np.concatenate(held)
    return words, lo, hi, starts, piece, begins, np.array(owners), np.array(offsets)


def _runs(texts: list, window: int, full: bool) -> Iterator[pa.RecordBatch]:
    _, rolling, _ = _tools()
    docs = np.array([t[0] for t in texts], np.int64)
    parts = np.array([t[1] for t in texts], np.int32)
    for words, lo, hi, starts, piece, begins, owners, offsets in _pieces(texts, window):
        name, place = _anchors(words, lo, hi, starts, window)
        new = np.ones(len(starts), bool)
        new[1:] = (
            (place[1:] != place[:-1]) | (name[1:] != name[:-1]) | (piece[1:] != piece[:-1])
        )
        at = np.flatnonzero(new)
        key = pa.array(H.signed(name[at]))
        if not full:
            yield pa.record_batch([key], ["key"])
            continue
        count = np.diff(np.append(at, len(starts)))
        start, own = starts[at], piece[at]
        sums = rolling.prefix(words)
        whole = rolling.between(sums, start, start + count - 1 + window)
        shape = ((place[at] - start) << R.SPAN_BITS | count).astype(np.uint64)
        span = (start - begins[own] + offsets[own]) << R.SPAN_BITS | (count - 1)
        owner = owners[own]
        yield pa.record_batch(
            [key, pa.array(H.signed(H.mix_pair(whole, shape))), pa.array(span),
             pa.array(docs[owner]), pa.array(parts[owner])],
            ["key", "run", "span", "doc", "part"],
        )


def _units(texts: list, window: int) -> Iterator[pa.RecordBatch]:
    first, second, _ = _tools()
    for doc, part, text, spans in texts:
        words, _ = _named_words([text])
        key, start, count = R.opened(spans)
        ends = np.cumsum(count)
        starts = np.repeat(start, count) + np.arange(ends[-1]) - np.repeat(ends - count, count)
        one = first.between(first.prefix(words), starts, starts + window)
        two = second.between(second.prefix(words), starts, starts + window)
        hashes = np.stack([one, two], axis=1).tobytes()
        contents = [
            hashes[16 * (b - n) : 16 * b] for b, n in zip(ends.tolist(), count.tolist(), strict=True)
        ]
        yield pa.record_batch(
            [pa.array(key), pa.array(np.full(len(key), doc, np.int64)),
             pa.array(np.full(len(key), part, np.int32)),
             pa.array(start << R.SPAN_BITS | (count - 1)), pa.array(contents, pa.binary())],
            ["key", "doc", "part", "span", "content"],
        )


def remove_repeated_words(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW
) -> DataFrame:
    """Remove every word inside a window of words that an earlier document has too.

    Recompression: round by round, runs of equal symbols and then pairs of neighbouring
    symbols are named as new symbols. A name is a hash of what it stands for, hence the same
    in all documents without a shared dictionary, and a bit of it decides which neighbours
    pair up. Equal stretches of text therefore get equal symbols inside, up to a few at both
    ends. Each window is filed under a symbol that its words alone imply; symbols that several places share reveal candidates, which are verified by
    comparing runs of windows and at last single windows.

    Earlier means a smaller id. Returns per input row: id, `n_words`, `removed` (array of
    start and end, in words, of the maximal removed runs) and `kept` (the remaining words,
    joined by one space). Defined cases: NULL texts have no words; NULL ids come first; rows
    that share an id count as documents in the order of their texts; texts of fewer words
    than a window keep all; other columns are not read.
    """
    if not 2 <= window < 1 << R.SPAN_BITS:
        raise ValueError(f"window must be from 2 to {(1 << R.SPAN_BITS) - 1} words")

    def keys(rows):
        for texts in R.batches(rows):
            yield from _runs(texts, window, False)

    def runs(rows):
        for texts in R.batches(rows):
            yield from _runs(texts, window, True)

    def units(rows):
        for texts in R.batches(rows):
            yield from _units(texts, window)

    def cut(rows):
        for batch in rows:
            out = []
            for text, spans in zip(batch.column("text"), batch.column("spans"), strict=True):
                data = text.as_py()
                begin, end = split_words(np.frombuffer(data, np.uint8))
                mask = R.covered(spans.as_py(), len(begin), window)
                kept = [
                    data[a:b]
                    for a, b in zip(begin[~mask].tolist(), end[~mask].tolist(), strict=True)
                ]
                removed = [
                    {"start": a, "end": b}
                    for a, b in zip(*(x.tolist() for x in R.stretches(mask)), strict=True)
                ]
                out.append((len(begin), removed, b" ".join(kept).decode("utf-8", "replace")))
            yield pa.record_batch(
                [
                    batch.column("id"),
                    pa.array([o[0] for o in out], pa.int64()),
                    pa.array([o[1] for o in out], R.REMOVED),
                    pa.array([o[2] for o in out], pa.string()),
                ],
                [id_col, "n_words", "removed", "kept"],
            )

    texts = R.identified(docs, id_col, text_col)
    dealt = R.repeated_spans(texts, keys, runs, units, 16, 16, within=False)
    schema = f"`{id_col}` long, n_words long, removed {R.REMOVED_TYPE}, kept string"
    return dealt.select("id", "text", "spans").mapInArrow(cut, schema)
