"""Chains of overlapping intervals."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F



def chained_days(df: DataFrame, id: str, start: str, end: str) -> DataFrame:
    """Per person and start day, the first start and last end of its overlap chain.

    Intervals are reduced to the latest end per start day before the window, so
    a window never holds more rows than there are days.
    """
    ends = F.greatest(F.coalesce(F.col(end), F.col(start)), F.col(start))
    daily = (
        df.where(F.col(start).isNotNull())
        .groupBy(F.col(id).alias(id), F.col(start).alias(start))
        .agg(F.max(ends).alias("_end"))
    )
    person = Window.partitionBy(id).orderBy(start)
    before = person.rowsBetween(Window.unboundedPreceding, -1)
    so_far = person.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    opens = F.coalesce(F.col(start) > F.max("_end").over(before), F.lit(True))
    chain = Window.partitionBy(id, "_chain")
    return (
        daily.withColumn("_opens", opens.cast("int"))
        .withColumn("_chain", F.sum("_opens").over(so_far))
        .select(
            id,
            start,
            F.min(start).over(chain).alias("first_start"),
            F.max("_end").over(chain).alias("last_end"),
        )
    )


def adm_limits(df: DataFrame, id: str, start: str, end: str) -> DataFrame:
    """Every row with the true first start and last end of its chain of admissions.

    Our rule: admissions of a person chain when one starts no later than the
    latest end so far, so touching days count. Start and end are dates; a
    missing end counts as its start.
    """
    return df.join(chained_days(df, id, start, end), [id, start], "left").select(
        *df.columns, "first_start", "last_end"
    )


def merged_periods(df: DataFrame, id: str, start: str, end: str) -> DataFrame:
    """One row per chain."""
    return (
        chained_days(df, id, start, end)
        .groupBy(id, "first_start")
        .agg(F.max("last_end").alias("last_end"))
    )
