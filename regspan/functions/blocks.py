"""Aligned blocks of 1, 2, 4, … days.

Every interval is the union of a few such blocks (two of each size at most), and every day lies
in exactly one block of each size. "Which intervals hold this day" thus becomes an equi join.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Day numbers count from the first date there is, and need this many bits for the last one.
FIRST_DAY = "0001-01-01"
LAST_DAY = "9999-12-31"
DAY_BITS = 22


def day_number(date: Column) -> Column:
    return F.datediff(date, F.lit(FIRST_DAY).cast("date"))


def blocks(low: str, high: str) -> Column:
    """The largest aligned blocks ``(bits, block)`` that make up the days ``[low, high)``.

    Of each block size, the first whole block belongs if its number is odd
    (the next larger block would start before ``low``), and the last whole
    block if its number is even (the next larger would end after ``high``).
    """
    found = []
    for bits in range(DAY_BITS + 1):
        first = f"shiftright({low} + {(1 << bits) - 1}, {bits})"
        after = f"shiftright({high}, {bits})"
        for block, belongs in ((first, f"{first} % 2 = 1"), (f"{after} - 1", f"{after} % 2 = 1")):
            found.append(
                f"CASE WHEN {first} < {after} AND {belongs}"
                f" THEN struct({bits} AS bits, {block} AS block) END"
            )
    return F.expr(f"array_compact(array({', '.join(found)}))")


def blocks_of_day(day: str) -> Column:
    """The one block of each size that holds a day, smallest first."""
    return F.expr(
        f"transform(sequence(0, {DAY_BITS}), b -> struct(b AS bits, shiftright({day}, b) AS block))"
    )
