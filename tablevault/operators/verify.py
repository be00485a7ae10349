"""Verification of a copy against its source."""

from __future__ import annotations

import logging
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablevault.functions.columns import column
from tablevault.operators.diff import (
    FIRST,
    diff_counts,
    fingerprint,
    mark_names,
    same_schema,
    sample_diff,
)
from tablevault.operators.profile import profile_diff

logger = logging.getLogger(__name__)


@dataclass(frozen=True)
class Checks:
    """Which checks decide.

    `full_diff` is exact and covers the sample, so the sample is only drawn without it, by
    `sample_method`: 'first' in content order, or 'spread' over the table.
    `fingerprint` is the check for very large tables: one scan per side, no shuffle of rows.
    """

    row_count: bool = True
    sample: bool = True
    sample_size: int = 1000
    sample_method: str = FIRST
    full_diff: bool = True
    fingerprint: bool = False
    profile: bool = False


def verify(source: DataFrame, target: DataFrame, checks: Checks = Checks()) -> DataFrame:
    """One row: counts on both sides, differing rows, each check's outcome, and `passed`.

    A check that did not run has a NULL outcome. Tables of different schema fail without
    their rows being compared, since a comparison would first have to change types.
    """
    if not same_schema(source, target):
        return _report([_counts(source, target)], schema_match=False, checks=checks)
    parts = []
    if checks.full_diff:
        parts.append(diff_counts(source, target))
    else:
        parts.append(_counts(source, target))
        if checks.sample:
            parts.append(_sample_counts(source, target, checks))
    if checks.fingerprint:
        parts.append(_fingerprint_match(source, target))
    if checks.profile:
        parts.append(
            profile_diff(source, target).agg(F.bool_and("equal").alias("profile_match"))
        )
    return _report(parts, schema_match=True, checks=checks)


def _counts(source: DataFrame, target: DataFrame) -> DataFrame:
    one = F.lit(1)
    sides = source.select(F.lit("s").alias("side")).union(target.select(F.lit("t").alias("side")))
    return sides.agg(
        F.count(F.when(F.col("side") == "s", one)).alias("source_rows"),
        F.count(F.when(F.col("side") == "t", one)).alias("target_rows"),
    )


def _sample_counts(source: DataFrame, target: DataFrame, checks: Checks) -> DataFrame:
    side, copies = map(column, mark_names(source.columns))

    def of(kind: str) -> Column:
        return F.coalesce(F.sum(F.when(side == kind, copies)), F.lit(0))

    return sample_diff(source, target, checks.sample_size, checks.sample_method).agg(
        of("missing").alias("missing_rows"), of("extra").alias("extra_rows")
    )


def _fingerprint_match(source: DataFrame, target: DataFrame) -> DataFrame:
    both = fingerprint(source).union(fingerprint(target))
    return both.agg(
        (F.countDistinct("row_count", "checksum") == 1).alias("fingerprint_match")
    )


_MEASURES = {
    "source_rows": "bigint",
    "target_rows": "bigint",
    "missing_rows": "bigint",
    "extra_rows": "bigint",
    "fingerprint_match": "boolean",
    "profile_match": "boolean",
}


def _report(parts: list[DataFrame], *, schema_match: bool, checks: Checks) -> DataFrame:
    """Fold one-row results, each holding some of the measures, into a single row."""
    rows = [
        part.select(
            *[
                (F.col(name) if name in part.columns else F.lit(None)).cast(dtype).alias(name)
                for name, dtype in _MEASURES.items()
            ]
        )
        for part in parts
    ]
    merged = rows[0]
    for row in rows[1:]:
        merged = merged.union(row)
    merged = merged.agg(*[F.max(name).alias(name) for name in _MEASURES])
    counts_agree = F.col("source_rows") == F.col("target_rows")
    rows_agree = (F.col("missing_rows") == 0) & (F.col("extra_rows") == 0)
    decisive = [F.lit(schema_match)]
    if checks.row_count:
        decisive.append(counts_agree)
    if schema_match:
        if checks.full_diff or checks.sample:
            decisive.append(rows_agree)
        if checks.fingerprint:
            decisive.append(F.col("fingerprint_match"))
        if checks.profile:
            decisive.append(F.col("profile_match"))
    passed = decisive[0]
    for outcome in decisive[1:]:
        passed = passed & outcome
    return merged.select(
        F.lit(schema_match).alias("schema_match"),
        "source_rows",
        "target_rows",
        "missing_rows",
        "extra_rows",
        "fingerprint_match",
        "profile_match",
        F.coalesce(passed, F.lit(False)).alias("passed"),
    )


def verify_clone(source: DataFrame, target: DataFrame, checks: Checks = Checks()) -> bool:
    """Whether the copy passes; a check that cannot run at all counts as failed."""
    try:
        report = verify(source, target, checks).first()
    except Exception as error:
        logger.error("Verification could not run: %s", error)
        return False
    if not report["passed"]:
        logger.error("Verification failed: %s", report.asDict())
    return report["passed"]
