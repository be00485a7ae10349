"""Ranked lexical search over bit-sliced Bloom signatures, with exact scores."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablevault.functions.columns import column
from tablevault.llm.common import python_tasks, stored, text_or_empty
from tablevault.llm.hashing import Rolling, U, mix, symbols
from tablevault.sources.scratch import scratch_path

# A signature holds a key for each term and each of these counts that the term reaches.
LEVELS = (1, 2, 3, 4, 6, 8, 12, 16, 24, 32, 48, 64)
BITS_PER_KEY, PROBES = 10, 4
# Wider signatures fill up instead; a full one excludes nothing.
MOST_BITS = 1 << 22
# Keys of the documents in one block of the index, and documents, at most.
BLOCK_KEYS, BLOCK_ROWS = 1 << 18, 4096
# Items, and terms of items, that are looked up together; a longer item is a block of its own.
ITEMS, ITEM_TERMS = 256, 1 << 14
# Candidate documents that may be broadcast.
MOST_BROADCAST = 1 << 16
_PIECE = 1 << 20  # bytes hashed together
INDEX = "ids array<long>, lengths array<long>, width int, slices binary"
RESULT = "item_id long, rank int, doc_id long, score long"

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IN_TERM = np.ones(256, bool)
for _low, _high in ((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F)):
    _IN_TERM[_low : _high + 1] = False
_SYMBOLS, _ROLLING = symbols(256, 11), Rolling(0xD1342543DE82EF95)


@dataclass
class Tokens:
    """The terms of a batch of texts, in order: their documents, places and 64-bit hashes."""

    data: np.ndarray
    doc: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray

    @classmethod
    def of(cls, texts: pa.Array) -> Tokens:
        """Bytes decide alone: no byte of a longer UTF-8 sequence is ASCII."""
        texts = texts.cast(pa.large_binary())
        _, offsets, data = texts.buffers()
        offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(data or b"", np.uint8)
        data, offsets = _LOWER[data[offsets[0] : offsets[-1]]], offsets - offsets[0]
        inside = _IN_TERM[data]
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        borders = offsets[1:-1]
        borders = borders[(borders > 0) & (borders < len(data))]
        first[borders] = inside[borders]
        last[borders - 1] = inside[borders - 1]
        start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
        doc = np.searchsorted(offsets, start, side="right") - 1
        return cls(data, doc, start, end, _hashes(data, start, end))


def _hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    found = np.empty(len(start), U)
    at = 0
    while at < len(start):
        to = max(at + 1, int(np.searchsorted(end, start[at] + _PIECE, side="right")))
        low = start[at]
        sums = _ROLLING.prefix(_SYMBOLS[data[low : end[to - 1]]])
        found[at:to] = _ROLLING.between(sums, start[at:to] - low, end[at:to] - low)
        at = to
    return found


def _counted(tokens: Tokens) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, hash and count of each distinct hash in each document, by document."""
    order = np.lexsort((tokens.hash, tokens.doc))
    doc, hashes = tokens.doc[order], tokens.hash[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (hashes[1:] != hashes[:-1])
    at = np.flatnonzero(new)
    return doc[at], hashes[at], np.diff(np.append(at, len(doc)))


def _probes(keys: np.ndarray, width: int) -> np.ndarray:
    """The bits of each key in signatures of `width` bits: one row per probe."""
    step = mix(keys ^ U(0x9E3779B97F4A7C15)) | U(1)
    turns = np.arange(PROBES, dtype=U)[:, None]
    return ((keys + turns * step) % U(width)).astype(np.int64)


def _keys(hashes: np.ndarray, level: int) -> np.ndarray:
    return mix(hashes + U((level + 1) * 0x9E3779B97F4A7C15 % (1 << 64)))


class _Pending:
    """Documents of about the same number of keys, on their way into one block."""

    def __init__(self, size: int):
        keys = 2.0 ** (size / 2)
        self.width = min(MOST_BITS, max(64, math.ceil(BITS_PER_KEY * keys)))
        self.ids, self.lengths, self.keys, self.held = [], [], [], 0

    def add(self, doc: int | None, length: int, keys: np.ndarray) -> bool:
        self.ids.append(doc)
        self.lengths.append(length)
        self.keys.append(keys)
        self.held += len(keys)
        return self.held >= BLOCK_KEYS or len(self.ids) == BLOCK_ROWS

    def block(self) -> dict:
        rows = -(-len(self.ids) // 8) * 8
        row = np.repeat(np.arange(len(self.ids)), [len(k) for k in self.keys])
        bits = np.zeros(self.width * rows, bool)
        for places in _probes(np.concatenate(self.keys), self.width):
            bits[places * rows + row] = True
        slices = np.packbits(bits.reshape(self.width, rows), axis=1)
        return {
            "ids": self.ids, "lengths": self.lengths, "width": self.width,
            "slices": slices.tobytes(),
        }


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The index of all documents that hold a term: one row per block, as in `INDEX`.

    A document's signature is a Bloom filter of its terms and of how often they occur.
    Documents of about as many keys share a width and a block, which holds their signatures
    turned: for each bit a bitmap over its documents. A task keeps at most `BLOCK_KEYS` keys
    per width. NULL texts hold no term; NULL ids are kept.
    """
    python_tasks(docs.sparkSession)

    def indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending: dict[int, _Pending] = {}
        for batch in batches:
            ids = batch.column("id").to_pylist()
            tokens = Tokens.of(batch.column("text"))
            lengths = np.bincount(tokens.doc, minlength=len(ids))
            doc, hashes, counts = _counted(tokens)
            reached = [counts >= least for least in LEVELS]
            keys = np.concatenate([_keys(hashes[r], i) for i, r in enumerate(reached)])
            owner = np.concatenate([doc[r] for r in reached])
            order = np.argsort(owner, kind="stable")
            ends = np.cumsum(np.bincount(owner, minlength=len(ids)))
            for i, own in enumerate(np.split(keys[order], ends[:-1])):
                if not len(own):
                    continue
                size = math.ceil(2 * math.log2(len(own)))
                group = pending.setdefault(size, _Pending(size))
                if group.add(ids[i], int(lengths[i]), own):
                    yield pa.RecordBatch.from_pylist([pending.pop(size).block()], _INDEX_ARROW)
        for group in pending.values():
            yield pa.RecordBatch.from_pylist([group.block()], _INDEX_ARROW)

    rows = docs.select(column(id_col).cast("long").alias("id"), text_or_empty(text_col).alias("text"))
    return rows.mapInArrow(indexed, INDEX)


_INDEX_ARROW = pa.schema(
    [
        ("ids", pa.list_(pa.int64())),
        ("lengths", pa.list_(pa.int64())),
        ("width", pa.int32()),
        ("slices", pa.binary()),
    ]
)


class Terms:
    """Distinct terms, found in tokens by hash and then compared byte by byte."""

    def __init__(self, terms: list[bytes]):
        data = pa.array([b" ".join(terms)], pa.large_binary())
        self.tokens = Tokens.of(data)  # terms are their own only tokens
        self.count = len(terms)
        self.order = np.argsort(self.tokens.hash, kind="stable")
        self.sorted = self.tokens.hash[self.order]
        alike = np.unique(self.sorted, return_counts=True)[1]
        self.most_alike = int(alike.max(initial=0))

    def among(self, tokens: Tokens) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the tokens that are terms, and of the terms that they are."""
        own = self.tokens
        left = np.searchsorted(self.sorted, tokens.hash)
        found = []
        for turn in range(self.most_alike):
            at = np.minimum(left + turn, self.count - 1)
            token = np.flatnonzero(self.sorted[at] == tokens.hash)
            term = self.order[at[token]]
            length = tokens.end[token] - tokens.start[token]
            same = length == own.end[term] - own.start[term]
            token, term, length = token[same], term[same], length[same]
            for n in np.unique(length):
                these = np.flatnonzero(length == n)
                for part in np.array_split(these, -(-len(these) * int(n) // _PIECE)):
                    along = np.arange(n)
                    texts = tokens.data[tokens.start[token[part], None] + along]
                    wanted = own.data[own.start[term[part], None] + along]
                    equal = part[(texts == wanted).all(axis=1)]
                    found.append((token[equal], term[equal]))
        if not found:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        token, term = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.argsort(token, kind="stable")
        return token[order], term[order]


def document_frequencies(
    docs: DataFrame, terms: list[bytes], text_col: str = "text"
) -> dict[int, int]:
    """How many documents hold each of `terms`, by its number; counted exactly, over all."""
    python_tasks(docs.sparkSession)
    wanted = Terms(terms)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(wanted.count, np.int64)
        for batch in batches:
            tokens = Tokens.of(batch.column("text"))
            token, term = wanted.among(tokens)
            pairs = np.unique(tokens.doc[token] * wanted.count + term)
            held += np.bincount(pairs % wanted.count, minlength=wanted.count)
        term = np.flatnonzero(held)
        yield pa.record_batch([pa.array(term), pa.array(held[term])], ["term", "docs"])

    rows = docs.select(text_or_empty(text_col).alias("text"))
    found = rows.mapInArrow(counted, "term long, docs long").groupBy("term").agg(F.sum("docs"))
    return dict(map(tuple, found.collect()))  # a row for each of `terms`, at most


@dataclass
class _Items:
    """A block of items: their ids, and for each the numbers and weights of its terms."""

    ids: list
    terms: list[bytes]
    item: np.ndarray  # item of each entry, ascending
    term: np.ndarray
    weight: np.ndarray
    documents: int
    length: int

    def parts(self, counts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """What a term of that count in a document of that length scores per unit of weight."""
        norm = 100 - 90 + (90 * lengths * self.documents) // self.length
        return (1_000_000_000 * counts) // (1000 * counts + 8 * norm)


def _item_blocks(items: DataFrame, id_col: str, text_col: str) -> Iterator[tuple]:
    """Blocks of (item ids, distinct terms, item and term of each entry)."""
    ids, numbers, entries = [], {}, []
    rows = items.select(column(id_col).cast("long"), text_or_empty(text_col))
    for item, text in rows.toLocalIterator():
        tokens = Tokens.of(pa.array([text.encode()], pa.large_binary()))
        own = dict.fromkeys(
            tokens.data[s:e].tobytes() for s, e in zip(tokens.start, tokens.end, strict=True)
        )
        if ids and (len(ids) == ITEMS or len(entries) + len(own) > ITEM_TERMS):
            yield ids, list(numbers), entries
            ids, numbers, entries = [], {}, []
        entries += [(len(ids), numbers.setdefault(t, len(numbers))) for t in own]
        ids.append(item)
    if entries:
        yield ids, list(numbers), entries


class _Bounds:
    """Upper bounds of all items' scores for the documents of a block of the index.

    A bit-and of a key's slices tells which documents may hold it. The sums of the terms'
    weights over these bitmaps, level by level, count each term as often as it may occur at
    most: a document's count is below the next level that its signature does not show.
    """

    def __init__(self, items: _Items):
        self.items = items
        self.hashes = Terms(items.terms).tokens.hash
        # Sums of weights are whole numbers, which floats of enough bits add up exactly.
        total = np.bincount(items.item, items.weight).max(initial=0)
        self.weights = np.zeros(
            (len(items.ids), len(items.terms)), np.float32 if total < 1 << 24 else np.float64
        )
        self.weights[items.item, items.term] = items.weight
        self.most = np.append(np.array(LEVELS[1:], np.int64) - 1, np.iinfo(np.int64).max)

    def of(self, width: int, slices: np.ndarray, lengths: np.ndarray) -> Iterator[tuple]:
        """(number of the first document, bounds[item, document]), some documents at a time."""
        step = max(8, min(512, (1 << 23) // len(self.hashes) // 8 * 8))
        for low in range(0, len(lengths), step):
            n = lengths[low : low + step]
            part = slices[:, low // 8 : (low + step) // 8]
            bounds = np.zeros((len(self.weights), len(n)), np.int64)
            before, alive, held = np.zeros(len(n), np.int64), np.arange(len(self.hashes)), None
            for level, most in enumerate(self.most):
                places = _probes(_keys(self.hashes[alive], level), width)
                bits = np.bitwise_and.reduce(part[places], axis=0)
                if held is not None:
                    bits &= held
                some = bits.any(axis=1)
                alive, held = alive[some], bits[some]
                if not len(alive):
                    break
                shown = np.unpackbits(held, axis=1, count=len(n)).astype(self.weights.dtype)
                sums = (self.weights[:, alive] @ shown).astype(np.int64)
                scored = self.items.parts(np.minimum(most, n), n)
                bounds += sums * (scored - before)
                before = scored
            yield low, bounds


def _scan(
    index: DataFrame, items: _Items, best: int | None = None, least: np.ndarray | None = None
) -> DataFrame:
    """(item, doc_id) to be scored: per task each item's `best` highest bounds, or all
    documents whose bounds reach `least`."""

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(item: np.ndarray, ids: list) -> pa.RecordBatch:
            return pa.record_batch(
                [pa.array(item, pa.int64()), pa.array(ids, pa.int64())], ["item", "doc_id"]
            )

        upper = _Bounds(items)
        top = np.zeros((len(items.ids), best or 0), np.int64)
        top_ids = np.full(top.shape, None, object)
        for batch in batches:
            for row in batch.to_pylist():
                lengths, ids = np.array(row["lengths"], np.int64), np.array(row["ids"], object)
                slices = np.frombuffer(row["slices"], np.uint8).reshape(row["width"], -1)
                for low, bounds in upper.of(row["width"], slices, lengths):
                    own = ids[low : low + bounds.shape[1]]
                    if best is None:
                        item, doc = np.nonzero((bounds > 0) & (bounds >= least[:, None]))
                        if len(item):
                            yield found(item, own[doc].tolist())
                        continue
                    better = np.flatnonzero((bounds > top.min(axis=1)[:, None]).any(axis=1))
                    if not len(better):
                        continue
                    both = np.concatenate([top[better], bounds[better]], axis=1)
                    names = np.concatenate(
                        [top_ids[better], np.broadcast_to(own, (len(better), len(own)))], axis=1
                    )
                    chosen = np.argpartition(-both, best - 1, axis=1)[:, :best]
                    top[better] = np.take_along_axis(both, chosen, axis=1)
                    top_ids[better] = np.take_along_axis(names, chosen, axis=1)
        if best is not None:
            item, at = np.nonzero(top)
            bound = pa.array(top[item, at])
            yield found(item, top_ids[item, at].tolist()).append_column("bound", bound)

    kind = "item long, doc_id long" + (", bound long" if best else "")
    return index.mapInArrow(scanned, kind)


def _scored(
    docs: DataFrame, pairs: DataFrame, items: _Items, id_col: str, text_col: str, bounded: bool
) -> DataFrame:
    """(item, doc_id, score) of the pairs whose exact score is above 0."""
    wanted = Terms(items.terms)
    ends = np.searchsorted(items.item, np.arange(len(items.ids) + 1))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens = Tokens.of(batch.column("text"))
            n = np.bincount(tokens.doc, minlength=batch.num_rows)
            token, term = wanted.among(tokens)
            ids, asked = batch.column("doc_id").to_pylist(), batch.column("items").to_pylist()
            borders = np.searchsorted(tokens.doc[token], np.arange(batch.num_rows + 1))
            rows = []
            for i, doc in enumerate(ids):
                counts = np.bincount(
                    term[borders[i] : borders[i + 1]], minlength=wanted.count
                ).astype(np.int64)
                if not counts.any():
                    continue
                parts = items.parts(counts, n[i : i + 1].astype(np.int64))
                for item in asked[i]:
                    own = slice(ends[item], ends[item + 1])
                    score = int((parts[items.term[own]] * items.weight[own]).sum())
                    if score:
                        rows.append((item, doc, score))
            if rows:
                columns = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)]
                yield pa.record_batch(columns, ["item", "doc_id", "score"])

    asked = pairs.groupBy(F.col("doc_id").alias("asked")).agg(F.collect_set("item").alias("items"))
    asked = F.broadcast(asked) if bounded else asked
    rows = docs.select(column(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    joined = rows.join(asked, F.col("doc_id").eqNullSafe(F.col("asked")))
    return joined.select("doc_id", "text", "items").mapInArrow(
        scored, "item long, doc_id long, score long"
    )


def _best(rows: DataFrame, order: list, best: int, rank: str = "rank") -> DataFrame:
    place = F.row_number().over(Window.partitionBy("item").orderBy(*order))
    return rows.withColumn(rank, place).where(F.col(rank) <= best)


def search(
    docs: DataFrame,
    items: DataFrame,
    best: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    index: DataFrame | None = None,
) -> DataFrame:
    """The `best` documents of each item: (item_id, rank, doc_id, score), as in `RESULT`.

    Items are looked up in blocks, each against the whole index (`build_index`, made here
    unless given). The documents of the highest bounds are scored exactly from their texts;
    the worst of the best of them is a score that the result reaches, so every document whose
    bound is below it is out. All others are scored exactly, too. Bounds are never too low,
    so the result is that of scoring all documents.

    Defined cases: NULL and empty texts hold no term and are never found; items without a
    term, or whose terms no document holds, have no rows; equal scores go by ascending id,
    NULL ids last; each row of either table counts for itself, also if it repeats an id; an
    empty table of either kind gives no rows; other columns are not read.
    """
    spark = docs.sparkSession
    if index is None:
        index = stored(build_index(docs, id_col, text_col), "search-index")
    total = F.aggregate("lengths", F.lit(0).cast("long"), lambda n, x: n + x)
    documents, length = index.agg(F.sum(F.size("ids")), F.sum(total)).first()
    path = scratch_path(spark, "search-results")
    spark.createDataFrame([], RESULT).write.parquet(path)
    for ids, terms, entries in _item_blocks(items, item_id_col, item_text_col):
        if not documents:
            break
        held = document_frequencies(docs, terms, text_col)
        weight = [
            math.floor(1000 * math.log((2 * documents + 2) / (2 * held.get(i, 0) + 1)))
            for i in range(len(terms))
        ]
        item, term = np.array([e for e in entries if e[1] in held]).reshape(-1, 2).T
        if not len(item):
            continue
        block = _Items(ids, terms, item, term, np.array(weight)[term], documents, length)
        seeds = _best(
            _scan(index, block, best=2 * best),
            [F.desc("bound"), F.asc_nulls_last("doc_id")], 2 * best,
        )
        scores = _scored(docs, seeds, block, id_col, text_col, bounded=True)
        worst = _best(scores, [F.desc("score")], best).where(F.col("rank") == best)
        least = np.zeros(len(ids), np.int64)
        for number, score in worst.select("item", "score").collect():  # a row for each item
            least[number] = score
        pairs = stored(_scan(index, block, least=least), "search-candidates")
        bounded = pairs.count() <= MOST_BROADCAST
        scores = _scored(docs, pairs, block, id_col, text_col, bounded)
        ranked = _best(scores, [F.desc("score"), F.asc_nulls_last("doc_id")], best)
        names = spark.createDataFrame(list(enumerate(ids)), "item long, item_id long")
        ranked.join(F.broadcast(names), "item").select(
            "item_id", "rank", "doc_id", "score"
        ).write.mode("append").parquet(path)
    return spark.read.schema(RESULT).parquet(path)
