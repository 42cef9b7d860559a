"""Carrying known values forward in time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Days of a block; a person's rows of one block are scanned together.
BLOCK_DAYS = 32


def carry_forward(
    df: DataFrame,
    values: Sequence[str],
    id: str = "pnr",
    order: Sequence[str] = ("date",),
    block_days: int = BLOCK_DAYS,
) -> DataFrame:
    """``df`` with each missing value replaced by the person's last known one.

    Our rule: rows follow ``order``, of which the first column is a date or time, nulls first. Rows that are
    equal in it know each other's values, and of several the greatest counts. What is not null stays. Rows
    without an id are left as they are.

    Two levels: the last known value per person and block of days is found by an aggregate, carried over
    the blocks (one row each), and met again by the rows, which then only look back within their
    block. So a person who owns much of the table is spread over blocks, and none of a
    person's rows are gathered but those of a block.
    """
    first = order[0]
    block = F.coalesce(F.floor(F.unix_date(F.col(first).cast("date")) / block_days), F.lit(-(1 << 31)))
    rows = df.withColumn("_block", block)
    known = {v: F.when(F.col(v).isNotNull(), F.struct(*order, F.col(v).alias("_value"))) for v in values}
    ends = rows.where(F.col(id).isNotNull()).groupBy(id, "_block")
    ends = ends.agg(*[F.max(known[v]).alias(f"_end_{i}") for i, v in enumerate(values)])
    before = Window.partitionBy(id).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    # Of structs that begin with the order, the greatest is the last.
    carried = ends.select(id, "_block", *[F.max(f"_end_{i}").over(before).alias(f"_from_{i}") for i in range(len(values))])
    within = Window.partitionBy(id, "_block").orderBy(*order).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    seen = rows.select("*", *[F.max(known[v]).over(within).alias(f"_in_{i}") for i, v in enumerate(values)])
    met = seen.join(carried, [id, "_block"], "left")
    place = {v: i for i, v in enumerate(values)}
    return met.select(
        *[
            F.when(F.col(c).isNotNull() | F.col(id).isNull(), F.col(c))
            .otherwise(F.coalesce(F.col(f"_in_{place[c]}._value"), F.col(f"_from_{place[c]}._value"))).alias(c)
            if c in place else F.col(c)
            for c in df.columns
        ]
    )
