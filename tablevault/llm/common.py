"""Helpers that the operators of this package share."""

from __future__ import annotations

import string
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablevault.functions.columns import column
from tablevault.sources.scratch import scratch_path


def text_or_empty(name: str) -> Column:
    return F.coalesce(column(name).cast("string"), F.lit(""))


def _all_ascii(text: Column) -> Column:
    return F.octet_length(text) == F.char_length(text)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else.

    `lower` folds every alphabet, so it serves only what is all ASCII. Other texts are taken
    apart at spaces, which leaves few pieces for the much slower `translate`.
    """
    piecewise = F.transform(
        F.split(text, " "),
        lambda w: F.when(_all_ascii(w), F.lower(w))
        .when(w.rlike("[A-Z]"), F.translate(w, string.ascii_uppercase, string.ascii_lowercase))
        .otherwise(w),
    )
    return F.when(_all_ascii(text), F.lower(text)).otherwise(F.array_join(piecewise, " "))


def settled(df: DataFrame) -> DataFrame:
    """`df`, of which later filters are not pushed into the expressions that made it.

    A pushed filter repeats the expressions of every column it reads, each inside the other,
    which for nested array functions takes longer than all the rest. No filter passes the
    generator that this adds.
    """
    return df.select(F.inline(F.array(F.struct(*[column(c) for c in df.columns]))))


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write `df` to the shared scratch folder and read it again.

    This cuts the lineage, so what is read several times is computed once, and a lost
    executor costs no more than the tasks it was running.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let Spark drop what finished steps still hold: shuffle files, broadcasts, plans.

    They go when the driver's JVM has collected what stood for them, which may be long after
    many steps that leave their results in tables. For loops of such steps.
    """
    spark.sparkContext._jvm.java.lang.System.gc()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def python_tasks(spark: SparkSession, batch: str = "8m") -> None:
    """Prepare a session for operators that run Python code inside tasks.

    Rows go to Python in batches of about `batch` bytes at most, however long the texts are.
    This package is sent along as a zip, so executors need not have it installed.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", batch)
    context = spark.sparkContext
    if context.applicationId not in _SENT:
        folder = tempfile.mkdtemp(prefix="tablevault-code-")
        package = Path(__file__).parents[1]
        with zipfile.ZipFile(f"{folder}/{package.name}.zip", "w") as archive:
            for file in sorted(package.rglob("*.py")):
                archive.write(file, file.relative_to(package.parent))
        context.addPyFile(archive.filename)  # Spark itself copies it to every executor
        _SENT.add(context.applicationId)


_SENT: set[str] = set()
