"""Language identification by Bloom filters that hold all languages at once."""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablevault.functions.columns import column
from tablevault.llm import hashing as H
from tablevault.llm.common import python_tasks

UNDETERMINED = "und"
# Documents per language that the filters are fitted on, about.
FIT_DOCUMENTS = 2000
# The most frequent n-grams of each language that go into the filters.
GRAMS = 500
SLOTS = 1 << 16
_CHARACTERS = 1 << 18


def held_out(id_col: str = "doc_id") -> Column:
    """Whether a document is kept from the fit: CRC-32 of the id as text, modulo 5, is 0."""
    code = F.crc32(column(id_col).cast("string").cast("binary"))
    return F.coalesce(F.pmod(code, F.lit(5)) == 0, F.lit(False))


@functools.cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def _grams(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Trigrams of lower-cased letters as 63-bit codes, and the text that each stands in.

    Everything but letters is a border, code 0, which may lead or end a trigram. Texts are
    taken in pieces of bounded size, each trigram in one of them.
    """
    held, owners, sizes, total = [], [], [], 0
    for i, text in enumerate(texts):
        text = text.lower()
        for at in range(0, len(text), _CHARACTERS):
            end = min(len(text), at + _CHARACTERS)
            # One character more on either side; the outer ones are no middles.
            piece = (text[at - 1] if at else " ") + text[at:end] + text[end : end + 1].ljust(1)
            held.append(piece)
            owners.append(i)
            sizes.append(len(piece))
            total += len(piece)
            if total >= _CHARACTERS:
                yield _coded(held, owners, sizes)
                held, owners, sizes, total = [], [], [], 0
    if held:
        yield _coded(held, owners, sizes)


def _coded(held: list, owners: list, sizes: list) -> tuple[np.ndarray, np.ndarray]:
    codes = np.frombuffer("".join(held).encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = np.where(_letters()[codes], codes, 0).astype(np.uint64)
    middle = codes != 0
    ends = np.cumsum(sizes)
    middle[ends - 1] = False
    middle[ends - np.asarray(sizes)] = False
    at = np.flatnonzero(middle)
    grams = (codes[at - 1] << np.uint64(42)) | (codes[at] << np.uint64(21)) | codes[at + 1]
    return grams, np.repeat(np.asarray(owners), sizes)[at]


def _slots(grams: np.ndarray, slots: int) -> list[np.ndarray]:
    h = H.mix(grams)
    mask = np.uint64(slots - 1)
    return [((h >> np.uint64(shift)) & mask).astype(np.int64) for shift in (0, 21, 42)]


@dataclass
class LanguageFilters:
    """One Bloom filter per language, stored slot by slot: bit l of a slot is language l's.

    A query reads a trigram's three slots and gets the set of all languages that hold it.
    Beyond 64 languages a slot has several words.
    """

    languages: list[str]
    table: np.ndarray  # slots x words, 64 languages a word

    @classmethod
    def built(cls, grams: dict[str, list[int]], slots: int = SLOTS) -> LanguageFilters:
        languages = list(grams)
        table = np.zeros((slots, max(1, -(-len(languages) // 64))), np.uint64)
        for i, language in enumerate(languages):
            for at in _slots(np.array(grams[language], np.uint64), slots):
                table[at, i // 64] |= np.uint64(1 << (i % 64))
        return cls(languages, table)

    def hits(self, grams: np.ndarray, owners: np.ndarray, texts: int) -> np.ndarray:
        """Per text and language: how many trigrams the language's filter holds."""
        one, two, three = _slots(grams, len(self.table))
        found = self.table[one] & self.table[two] & self.table[three]
        out = np.empty((texts, len(self.languages)))
        for i in range(len(self.languages)):
            bit = (found[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1)
            out[:, i] = np.bincount(owners, bit.astype(np.float64), texts)
        return out

    def false_rates(self) -> np.ndarray:
        """How often each language's filter claims a trigram that it does not hold."""
        fill = [
            np.mean((self.table[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1))
            for i in range(len(self.languages))
        ]
        return np.array(fill) ** 3


def fit(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    per_language: int = FIT_DOCUMENTS,
    grams: int = GRAMS,
    slots: int = SLOTS,
) -> LanguageFilters:
    """Fit the filters on about `per_language` documents of each language.

    They are chosen by a hash of the id among those that are not held out and have a text
    and a language. What comes to the driver is the `grams` most frequent trigrams of each
    language.
    """
    python_tasks(docs.sparkSession)
    rows = docs.where(~held_out(id_col) & column(id_col).isNotNull()).select(
        column(id_col).cast("string").alias("id"),
        column(text_col).cast("string").alias("text"),
        column(lang_col).cast("string").alias("lang"),
    )
    rows = rows.where("text IS NOT NULL AND lang IS NOT NULL")
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not sizes:
        return LanguageFilters([], np.zeros((slots, 1), np.uint64))
    share = F.lit(0.0)
    for language, count in sizes.items():
        share = F.when(F.col("lang") == language, min(1.0, per_language / count)).otherwise(share)
    place = F.pmod(F.xxhash64("id", F.lit("fit")), F.lit(1_000_000)) / 1_000_000.0

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            for found, owner in _grams(batch.column("text").to_pylist()):
                names = np.array(langs, object)[owner]
                for language in set(langs):
                    values, counts = np.unique(found[names == language], return_counts=True)
                    yield pa.record_batch(
                        [pa.array([language] * len(values), pa.string()),
                         pa.array(H.signed(values)), pa.array(counts)],
                        ["lang", "gram", "n"],
                    )

    best = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    top = (
        rows.where(place < share)
        .select("text", "lang")
        .mapInArrow(counted, "lang string, gram long, n long")
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
        .withColumn("place", F.row_number().over(best))
        .where(F.col("place") <= grams)
        .select("lang", "gram")
        .collect()
    )
    by_language: dict[str, list[int]] = {
        language: [] for language in sorted(sizes, key=lambda x: (-sizes[x], x))
    }
    for row in top:
        by_language[row["lang"]].append(row["gram"])
    return LanguageFilters.built(by_language, slots)


def predict(
    docs: DataFrame,
    filters: LanguageFilters,
    text_col: str = "text",
    lang_name: str = "lang_pred",
    score_name: str = "score",
) -> DataFrame:
    """Add each text's language and its score to all columns of `docs`.

    The score of a language is the share of the text's trigrams that its filter holds, less
    what a filter of its fill would claim falsely; the best one wins, of equals the one with
    more documents in the fit. Defined cases: a text that is NULL or has no letter, and
    every text when the fit saw no language, gets `und` and score 0; columns of `docs` that
    have the names of the new ones are replaced.
    """
    python_tasks(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(filters)  # its size is fixed
    kept = [c for c in docs.columns if c not in (lang_name, score_name)]

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters = shared.value
        false_rates = filters.false_rates()
        for batch in batches:
            texts = [t or "" for t in batch.column(0).to_pylist()]
            hits = np.zeros((len(texts), len(filters.languages)))
            total = np.zeros(len(texts))
            if filters.languages:
                for grams, owners in _grams(texts):
                    hits += filters.hits(grams, owners, len(texts))
                    total += np.bincount(owners, minlength=len(texts))
                n = np.maximum(total, 1)[:, None]
                shares = np.clip((hits / n - false_rates) / (1 - false_rates), 0, 1)
                best = shares.argmax(axis=1)
                names = np.array(filters.languages, object)[best]
                names[total == 0] = UNDETERMINED
                scores = np.where(total > 0, shares[np.arange(len(texts)), best], 0.0)
            else:
                names, scores = [UNDETERMINED] * len(texts), np.zeros(len(texts))
            yield pa.record_batch(
                [batch.column(1), pa.array(list(names), pa.string()), pa.array(scores)],
                ["row", "lang", "score"],
            )

    packed = docs.select(
        column(text_col).cast("string").alias("text"),
        F.struct(*[column(c) for c in kept]).alias("row"),
    )
    schema = T.StructType(
        [
            T.StructField("row", packed.schema["row"].dataType),
            T.StructField("lang", T.StringType()),
            T.StructField("score", T.DoubleType()),
        ]
    )
    found = packed.mapInArrow(named, schema)
    return found.select(
        *[F.col("row").getField(c).alias(c) for c in kept],
        F.col("lang").alias(lang_name),
        F.col("score").alias(score_name),
    )
