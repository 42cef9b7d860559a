"""Splitting observation periods on a time axis.

Observations are half-open ``[start, end)`` rows. Splitting never moves,
loses or repeats time: the pieces of an observation join up to it exactly, and
its event indicator stays on the last piece. An empty observation is kept as one piece.
A missing end is open, for observations and for periods: the last piece of an open observation
has no end either.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.blocks import LAST_DAY
from .skyline import BIN_YEARS, timelines

_PIECE = "_piece"


def _explode_cuts(base: DataFrame, cuts: Column, start: str, end: str) -> DataFrame:
    """One row per piece; ``cuts`` is an array of dates, in any order."""
    points = F.array_sort(F.array_distinct(F.array_compact(cuts)))
    inside = F.filter(points, lambda c: (c > F.col(start)) & F.coalesce(c < F.col(end), F.lit(True)))
    points = F.concat(F.array(F.col(start)), inside)
    df = base.withColumn("_points", points)
    piece = F.transform(
        F.col("_points"),
        lambda p, i: F.struct(
            p.alias("start"), F.coalesce(F.get(F.col("_points"), i + 1), F.col(end)).alias("end")
        ),
    )
    return df.withColumn(_PIECE, F.explode(piece)).drop("_points")


def _piece_columns(base: DataFrame, start: str, end: str, event: str | None) -> list[Column]:
    out = []
    for name in base.columns:
        if name == start:
            out.append(F.col(f"{_PIECE}.start").alias(start))
        elif name == end:
            out.append(F.col(f"{_PIECE}.end").alias(end))
        elif name == event:
            last = F.col(f"{_PIECE}.end").eqNullSafe(F.col(end))
            out.append(F.when(last, F.col(event)).otherwise(0).alias(event))
        else:
            out.append(F.col(name))
    return out


def lexis_two(
    base: DataFrame,
    dates: DataFrame,
    conditions: Sequence[str],
    id: str = "pnr",
    start: str = "start",
    end: str = "end",
    event: str | None = None,
) -> DataFrame:
    """Split at the date each condition appears; a 0/1 column per condition.

    Our rule: a condition is 1 from its date on. A date on or before the start
    makes the whole observation 1, one on or after the end, or none, makes it
    0. ``dates`` may repeat an id; the earliest date counts.
    """
    first = dates.groupBy(id).agg(*[F.min(c).alias(f"_{c}") for c in conditions])
    joined = base.join(first, id, "left")
    cuts = F.array(*[F.col(f"_{c}") for c in conditions])
    pieces = _explode_cuts(joined, cuts, start, end)
    flags = [
        F.coalesce(F.col(f"_{c}") <= F.col(f"{_PIECE}.start"), F.lit(False)).cast("int").alias(c)
        for c in conditions
    ]
    return pieces.select(*_piece_columns(base, start, end, event), *flags)


def lexis_seq(
    base: DataFrame,
    cuts: Sequence[dt.date | int],
    kind: str = "calendar",
    start: str = "start",
    end: str = "end",
    event: str | None = None,
    birth: str | None = None,
    label: str = "band",
) -> DataFrame:
    """Split at calendar dates, or at ages in whole years counted from ``birth``.

    The label is the number of cuts at or before the piece, 0 before the first.
    """
    ordered = sorted(set(cuts))
    if kind == "calendar":
        points = F.array(*[F.lit(c).cast("date") for c in ordered])
    elif kind == "age":
        if birth is None:
            raise ValueError("age cuts need a birth date column")
        points = F.array(*[F.add_months(F.col(birth), 12 * int(c)) for c in ordered])
    else:
        raise ValueError(f"kind must be 'calendar' or 'age', not {kind!r}")
    pieces = _explode_cuts(base, points, start, end)
    band = F.size(F.filter(F.array_compact(points), lambda c: c <= F.col(f"{_PIECE}.start")))
    return pieces.select(*_piece_columns(base, start, end, event), band.alias(label))


def _open_end(end: str) -> Column:
    return F.coalesce(F.col(end), F.lit(LAST_DAY).cast("date"))


def value_steps(periods: DataFrame, id: str, start: str, end: str, value: str) -> DataFrame:
    """The steps ``(id, at, value)`` of a value given by periods.

    Where periods overlap, the one that started last decides, then the larger
    value; uncovered time has a null value. There is a step at every start and
    at every end. A period without an end is open.
    """
    spans = _spans(periods, id, start, end, value, F.col(end).isNotNull())
    points = timelines(spans).select("_id", F.explode(F.flatten("years.points")).alias("p"))
    return points.select(F.col("_id").alias(id), "p.at", "p.value")


def _spans(periods: DataFrame, id: str, start: str, end: str, value: str, ends: Column) -> DataFrame:
    """Periods as the sweep reads them: days as numbers; ``_ends`` tells whether the end is a step."""
    spans = periods.where(F.col(id).isNotNull() & (F.col(start) < _open_end(end)))
    return spans.select(
        F.col(id).alias("_id"), F.unix_date(F.col(start)).alias("_s"),
        F.unix_date(_open_end(end)).alias("_e"), ends.alias("_ends"), F.col(value).alias("_value"),
    )


def _bin(date: str) -> Column:
    return F.floor(F.year(date) / BIN_YEARS).cast("int")


def lexis_from_to(
    base: DataFrame,
    periods: DataFrame,
    id: str = "pnr",
    start: str = "start",
    end: str = "end",
    event: str | None = None,
    period_start: str = "from",
    period_end: str = "to",
    value: str = "value",
    name: str | None = None,
    default=None,
) -> DataFrame:
    """Split at every period start and end inside the observation.

    The new column holds the covering period's value, else ``default``;
    overlaps follow ``value_steps``. A missing end is open, of observations and periods alike;
    an end of 9999-12-31 of a period is the same.

    Periods and observation starts of a person are swept once in order of days into one timeline
    that knows, for each day on it, the value and the next step. Observations meet it by
    person and look at the points of their own years, so an open one looks at no empty time.
    """
    name = name or value
    far = F.lit(LAST_DAY).cast("date")
    spans = _spans(periods, id, period_start, period_end, value, F.coalesce(F.col(period_end) < far, F.lit(False)))
    starts = base.where(F.col(id).isNotNull() & F.col(start).isNotNull())
    starts = starts.select(F.col(id).alias("_id"), F.unix_date(F.col(start)).alias("_s"))
    known = timelines(spans.unionByName(starts, allowMissingColumns=True))
    # The points of an observation's own years, and of those only the ones inside it.
    last_day = F.greatest(F.date_sub(_open_end(end), 1), F.col(start))
    mine = F.filter("years", lambda y: (y["bin"] >= _bin(start)) & (y["bin"] <= F.floor(F.year(last_day) / BIN_YEARS)))
    joined = base.join(known, F.col(id) == F.col("_id"), "left")
    joined = joined.withColumn("_points", F.flatten(F.transform(mine, lambda y: y["points"]))).drop("years", "_id")
    pieces = F.expr(
        f"""CASE WHEN `{id}` IS NULL OR `{start}` IS NULL THEN
              array(struct(`{start}` AS start, `{end}` AS end, null AS value))
            ELSE transform(
              filter(_points, p -> p.at = `{start}`
                OR (p.is_step AND p.at > `{start}` AND coalesce(p.at < `{end}`, true))),
              p -> struct(p.at AS start, least(p.next, `{end}`) AS end, p.value AS value))
            END"""
    )
    split = joined.withColumn(_PIECE, F.explode(pieces))
    found = F.coalesce(F.col(f"{_PIECE}.value"), F.lit(default))
    return split.select(*_piece_columns(base, start, end, event), found.alias(name))
