"""Removal of long repeated byte strings, by grouping suffixes through a limited depth."""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tablevault.llm import hashing as H
from tablevault.llm import repeats as R

LENGTH = 100
GRAM = 24


@functools.cache
def _tools() -> tuple:
    return (
        H.Rolling(0x5DEECE66D1CE4E5B),
        H.Rolling(0x2545F4914F6CDD1D),
        H.symbols(256, 11),
        H.symbols(256, 97),
    )


def _leftmost_least(values: np.ndarray, width: int) -> np.ndarray:
    """Index of the first least value in each stretch of `width`, by doubling."""
    least, at, reach = values, np.arange(len(values), dtype=np.int32), 1
    while reach < width:
        step = min(reach, width - reach)
        n = len(least) - step
        left = least[:n] <= least[step:]
        at = np.where(left, at[:n], at[step:])
        least = np.where(left, least[:n], least[step:])
        reach += step
    return at


def _pieces(texts: list, length: int) -> Iterator[tuple]:
    """(bytes, valid window starts, piece number of each, doc, part and offset of pieces).

    Texts longer than a chunk are cut into pieces that overlap by a window less one byte, so
    each window is in one piece.
    """
    held, docs, parts, offsets, total = [], [], [], [], 0
    for doc, part, text, _ in texts:
        for at in range(0, max(1, len(text) - length + 1), R.CHUNK):
            piece = text[at : at + R.CHUNK + length - 1]
            held.append(piece)
            docs.append(doc)
            parts.append(part)
            offsets.append(at)
            total += len(piece)
            if total >= R.CHUNK:
                yield _joined(held, docs, parts, offsets, length)
                held, docs, parts, offsets, total = [], [], [], [], 0
    if held:
        yield _joined(held, docs, parts, offsets, length)


def _joined(held: list, docs: list, parts: list, offsets: list, length: int) -> tuple:
    sizes = np.array([len(p) for p in held], np.int64)
    begins = np.cumsum(sizes) - sizes
    data = np.frombuffer(b"".join(held), np.uint8)
    owner = np.repeat(np.arange(len(held)), np.maximum(sizes - length + 1, 0))
    counts = np.maximum(sizes - length + 1, 0)
    first = np.cumsum(counts) - counts
    valid = np.arange(len(owner)) - first[owner] + begins[owner]
    return data, valid, owner, begins, np.array(docs), np.array(parts, np.int32), np.array(offsets)


def _runs(texts: list, length: int, gram: int, full: bool) -> Iterator[pa.RecordBatch]:
    gram_hash, run_hash, gram_symbols, run_symbols = _tools()
    for data, valid, owner, begins, docs, parts, offsets in _pieces(texts, length):
        if not len(valid):
            continue
        sums = gram_hash.prefix(gram_symbols[data])
        grams = gram_hash.every(sums, gram)
        anchor = _leftmost_least(grams, length - gram + 1)[valid]
        new = np.ones(len(valid), bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1])
        at = np.flatnonzero(new)
        anchor = anchor[at]
        key = pa.array(H.signed(grams[anchor]))
        if not full:
            yield pa.record_batch([key], ["key"])
            continue
        count = np.diff(np.append(at, len(valid)))
        start, own = valid[at], owner[at]
        sums = run_hash.prefix(run_symbols[data])
        whole = run_hash.between(sums, start, start + count - 1 + length)
        shape = ((anchor - start) << R.SPAN_BITS | count).astype(np.uint64)
        span = (start - begins[own] + offsets[own]) << R.SPAN_BITS | (count - 1)
        yield pa.record_batch(
            [key, pa.array(H.signed(H.mix_pair(whole, shape))), pa.array(span),
             pa.array(docs[own]), pa.array(parts[own])],
            ["key", "run", "span", "doc", "part"],
        )


def _units(texts: list, length: int) -> Iterator[pa.RecordBatch]:
    for doc, part, text, spans in texts:
        key, start, count = R.opened(spans)
        contents = [
            text[a : a + n - 1 + length] for a, n in zip(start.tolist(), count.tolist(), strict=True)
        ]
        yield pa.record_batch(
            [pa.array(key), pa.array(np.full(len(key), doc, np.int64)),
             pa.array(np.full(len(key), part, np.int32)),
             pa.array(start << R.SPAN_BITS | (count - 1)), pa.array(contents, pa.binary())],
            ["key", "doc", "part", "span", "content"],
        )


def remove_repeated_bytes(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    gram: int = GRAM,
) -> DataFrame:
    """Remove every byte that lies in a string of `length` bytes which also starts earlier.

    Suffixes are told apart only through their first `length` bytes, by keys of falling
    significance, and a group that is down to one suffix leaves. They are grouped by hashes
    of the keys, not put in order: the groups are those of a radix sort, and nothing but the
    groups is needed. The first key is the suffix's least `gram`-byte string, which
    neighbouring suffixes share, so that they travel as one row; then comes the run of such
    neighbours as a whole, then the suffix's other bytes. Groups that are equal in all keys
    are exactly the repeated strings. Keys are compared as 64-bit hashes, two or three for
    each decision. For long strings the first key is longer than `gram`, since a run has no
    more than `2 ** SPAN_BITS` suffixes.

    Earlier means a smaller id or, in one document, an earlier start. Returns per input row:
    id, `n_bytes`, `removed` (array of start and end of the maximal removed runs) and `kept`
    (binary, the remaining bytes). Defined cases: NULL texts are empty; NULL ids come first;
    rows that share an id count as documents in the order of their texts; texts shorter than
    `length` keep all bytes; other columns are not read.
    """
    if not 0 < gram <= length:
        raise ValueError("gram must be between 1 and length")
    gram = max(gram, length + 1 - (1 << R.SPAN_BITS))

    def keys(rows):
        for texts in R.batches(rows):
            yield from _runs(texts, length, gram, False)

    def runs(rows):
        for texts in R.batches(rows):
            yield from _runs(texts, length, gram, True)

    def units(rows):
        for texts in R.batches(rows):
            yield from _units(texts, length)

    def cut(rows):
        for batch in rows:
            out = []
            for text, spans in zip(batch.column("text"), batch.column("spans"), strict=True):
                data = np.frombuffer(text.as_py(), np.uint8)
                mask = R.covered(spans.as_py(), len(data), length)
                begin, end = R.stretches(mask)
                removed = [{"start": int(a), "end": int(b)} for a, b in zip(begin, end, strict=True)]
                out.append((len(data), removed, data[~mask].tobytes()))
            yield pa.record_batch(
                [
                    batch.column("id"),
                    pa.array([o[0] for o in out], pa.int64()),
                    pa.array([o[1] for o in out], R.REMOVED),
                    pa.array([o[2] for o in out], pa.binary()),
                ],
                [id_col, "n_bytes", "removed", "kept"],
            )

    texts = R.identified(docs, id_col, text_col)
    dealt = R.repeated_spans(texts, keys, runs, units, 1, length, within=True)
    schema = f"`{id_col}` long, n_bytes long, removed {R.REMOVED_TYPE}, kept binary"
    return dealt.select("id", "text", "spans").mapInArrow(cut, schema)
