"""Events in a window of days before an index date, as rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def events_before(
    index: DataFrame,
    events: DataFrame,
    days: int,
    id: str = "pnr",
    date: str = "index_date",
    event_date: str = "date",
    at_least: int = 1,
    name: str = "days_before",
) -> DataFrame:
    """Each index row with each event of the same person at most ``days`` and at least ``at_least`` days earlier.

    Our rule: both bounds belong to the window; 0 lets the index date itself in, a negative bound days after
    it. Index rows without an event in the window, missing ids and missing dates give no rows; repeated
    rows on either side count each. The result has the columns of both tables and ``name``, the days between.

    Time is cut into buckets as wide as the window. An event lies in one of them and a window in one or
    two, so events meet index dates by person and bucket: a person's rows are never all paired, and a
    person who owns much of the table is spread over buckets.
    """
    if days < at_least:
        raise ValueError(f"no day is at most {days} and at least {at_least} days earlier")
    clash = ({c.lower() for c in index.columns} & {c.lower() for c in events.columns}) - {id.lower()}
    if clash:
        raise ValueError(f"in both tables: {', '.join(sorted(clash))}")
    width = days - at_least + 1
    day = F.unix_date(F.col(date).cast("date"))
    probes = F.array_distinct(F.array(*[F.floor((day - n) / width) for n in (days, at_least)]))
    asked = index.where(F.col(date).isNotNull()).withColumn("_bucket", F.explode(probes))
    happened = F.unix_date(F.col(event_date).cast("date"))
    dated = events.where(F.col(event_date).isNotNull()).withColumn("_bucket", F.floor(happened / width))
    between = (day - happened).alias(name)
    met = asked.join(dated, [id, "_bucket"])
    others = [c for c in events.columns if c != id]
    return met.select(*index.columns, *others, between).where(F.col(name).between(at_least, days))
