"""Small helpers for frames with columns the operators do not know."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# What all contracts call white space, as the inside of a character class.
SPACE = r"\x20\x09-\x0D"


def without(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """``df`` without columns named like an operator's own, whatever their case.

    An operator's columns win over input columns of the same name.
    """
    taken = {n.lower() for n in names}
    clash = [c for c in df.columns if c.lower() in taken]
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c not in clash]) if clash else df


def text_or_empty(text: str) -> Column:
    return F.coalesce(F.col(text), F.lit(""))


def words_of(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` as an array; none for a null text."""
    parts = F.split(F.coalesce(text, F.lit("")), f"[{SPACE}]+")
    return F.filter(parts, lambda w: w != "")


def word_count(text: Column) -> Column:
    """The number of words ``[^\\x20\\x09-\\x0D]+``; 0 for a null text."""
    return F.coalesce(F.regexp_count(text, F.lit(f"[^{SPACE}]+")), F.lit(0)).cast("long")


BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


@contextmanager
def small_batches(spark: SparkSession, size: str = "8m") -> Iterator[None]:
    """Within the block, jobs pass rows to Python in Arrow batches of about ``size``."""
    before = spark.conf.get(BATCH_BYTES)
    spark.conf.set(BATCH_BYTES, size)
    try:
        yield
    finally:
        spark.conf.set(BATCH_BYTES, before)


def settle(spark: SparkSession) -> None:
    """The session setting these operators are best run with: Arrow batches of 8 MB.

    The default of 64 MB costs an executor several hundred MB per task with long texts.
    """
    spark.conf.set(BATCH_BYTES, "8m")
