"""Cleaning documents for training: language, repeated lines, near copies, benchmarks, tokens.

Each stage takes all that the one before it kept, and all but the last return the columns of
documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablevault.llm import bpe, language
from tablevault.llm.common import stored, table
from tablevault.llm.decontaminate import find_contamination
from tablevault.llm.line_dedup import drop_recurring_lines
from tablevault.llm.simhash import near_duplicates

VOCABULARY = "byte_bpe_50k.tiktoken"
# Texts of which less than this share of trigrams is known in any one language are rejected.
LEAST_SCORE = 0.1


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Reject texts without a letter and texts that fit no language."""
    names = {"lang_name": "predicted_lang", "score_name": "predicted_score"}
    found = language.predict(docs, language.fit(docs), **names)
    known = F.col("predicted_lang") != language.UNDETERMINED
    return found.where(known & (F.col("predicted_score") >= LEAST_SCORE)).select(docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop recurring lines from all documents but the first that has them; all rows stay.

    Lines of 50 words or more that only copies of one document share stay for the next stage.
    NULL texts stay NULL, empty ones empty; rows that share an id count as one document; an
    empty table stays empty; all columns stay, whatever their names.
    """
    copies = near_duplicates(docs, native=True).select(
        F.col("doc_id").alias("doc"), F.col("component_id").alias("group")
    )
    found = drop_recurring_lines(docs, short_lines=True, copies=copies)
    return found.withColumn("n_chars", F.char_length("text").cast("bigint")).select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document of the least id of each group of near copies by SimHash.

    Fingerprints are of four-word shingles and link at four differing bits or fewer. Texts
    without words are alike, so one of them stays. Rows that share an id stay or go together;
    rows without an id stay only where no row of their group has one.
    """
    found = near_duplicates(docs)
    kept = found.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    kept = kept.select(F.col("doc_id").alias("kept_id")).distinct()
    return docs.join(kept, F.col("doc_id").eqNullSafe(F.col("kept_id")), "left_semi")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark passage.

    NULL and empty texts hold none; each row is judged by itself; without benchmark items,
    or of an empty table, nothing goes.
    """
    found = find_contamination(docs, table(spark, sf_dir, "benchmark"), carry=True)
    return found.where("NOT contaminated").select("row.*")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ranks of every text, and a digest of what they decode to.

    NULL and empty texts have no tokens and the digest of nothing; each row is encoded by
    itself; an empty table gives no rows.
    """
    vocabulary = bpe.Vocabulary.read(public_tokenizers.path(VOCABULARY))
    encoded = bpe.encode(docs, vocabulary, public_tokenizers.PATTERN)
    return bpe.decode(encoded, vocabulary).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        "ids",
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("tokens", tokens),
]
# Fingerprints, fitted filters and token ranks are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to `documents`; each is written and read again as the next one's input."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stored(docs, f"pipeline-{name}")
    return docs
