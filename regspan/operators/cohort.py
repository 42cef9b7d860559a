"""Cutting registers to a study population, and first/last presence."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.codes import shortest_prefixes, starts_with_any, valid_id
from ..functions.values import year_dependent


def person_list(population: DataFrame, id: str = "pnr") -> DataFrame:
    """The distinct valid ids."""
    return population.where(valid_id(F.col(id))).select(id).distinct()


def restrict(register: DataFrame, population: DataFrame, id: str = "pnr") -> DataFrame:
    """The register's rows of persons in the population, each kept once."""
    return register.join(person_list(population, id), id, "left_semi")


def cohort_extract(
    register: DataFrame,
    population: DataFrame,
    columns: Sequence[str] | None = None,
    where: Column | None = None,
    id: str = "pnr",
) -> DataFrame:
    """Predicate and projection at the scan, then the cohort; all columns by default."""
    rows = register if where is None else register.where(where)
    if columns is not None:
        rows = rows.select(*dict.fromkeys([id, *columns]))
    return restrict(rows, population, id)


def governed_extract(
    register: DataFrame,
    population: DataFrame,
    columns: Sequence[str],
    approved: Sequence[str],
    code: str,
    prefixes: Sequence[str],
    date: str,
    start: str,
    id: str = "pnr",
) -> DataFrame:
    """An extract within an approval: listed columns, code groups and period only.

    A prefix stands for the whole code group below it. Asking for a column
    outside the approval is an error.
    """
    allowed = {c.lower() for c in approved}
    refused = [c for c in columns if c.lower() not in allowed]
    if refused:
        raise ValueError(f"columns not approved: {', '.join(refused)}")
    within = starts_with_any(F.col(code), shortest_prefixes(prefixes)) & (
        F.col(date) >= F.lit(start).cast("date")
    )
    rows = register.where(within).select(*dict.fromkeys([id, *columns]))
    return restrict(rows, population, id).select(*columns)


def left_merge(base: DataFrame, tables: Sequence[DataFrame], on: str | Sequence[str]) -> DataFrame:
    """Fold tables onto a base, whose rows all remain, each once.

    Our rule: a table that repeats a key counts with its least row (columns compared in order, nulls
    first), so the base is never multiplied; keys with a null match nothing. Tables already grouped by
    the key are not shuffled again.
    """
    keys = [on] if isinstance(on, str) else list(on)

    def one_each(table: DataFrame) -> DataFrame:
        others = [c for c in table.columns if c not in keys]
        known = reduce(lambda a, b: a & b, (F.col(k).isNotNull() for k in keys))
        least = table.where(known).groupBy(*keys).agg(F.min(F.struct(*others)).alias("_least"))
        return least.select(*keys, *[F.col(f"_least.{c}").alias(c) for c in others])

    return reduce(lambda a, b: a.join(one_each(b), keys, "left"), tables, base)


def code_list_filter(df: DataFrame, code: str, codes: DataFrame) -> DataFrame:
    """Rows whose code is in a list; repeats in the list do not multiply rows."""
    return df.join(codes.select(F.col(codes.columns[0]).alias(code)).distinct(), code, "left_semi")


# The most codes that are compared inside the scan.
LISTED_CODES = 50_000


def listed_codes(df: DataFrame, code: str, codes: DataFrame, most: int = LISTED_CODES) -> DataFrame:
    """Rows whose code is one of a list, tested while the register is scanned.

    Up to ``most`` distinct codes are read once and become a set that the scan receives: Parquet
    skips what lies outside its range, other rows cost one look-up. A longer list is met by
    a join, see ``code_list_filter``. Null codes are in no list.
    """
    wanted = codes.select(F.col(codes.columns[0]).alias(code)).where(F.col(code).isNotNull()).distinct()
    found = wanted.limit(most + 1).collect()
    if len(found) > most:
        return code_list_filter(df, code, wanted)
    listed = [r[0] for r in found]
    if listed and all(isinstance(c, str) for c in listed):
        # As text: thousands of literals are slow to make one by one.
        quoted = ", ".join("'" + c.replace("\\", "\\\\").replace("'", "\\'") + "'" for c in listed)
        return df.where(F.expr(f"`{code}` IN ({quoted})"))
    return df.where(F.col(code).isin(listed) if listed else F.lit(False))


def first_presence(
    snapshots: DataFrame,
    id: str,
    date: str,
    attributes: Sequence[str] = (),
    switch_year: int = 2007,
    later_gap: int = 95,
    earlier_gap: int = 370,
) -> DataFrame:
    """First unbroken run of snapshots per person: ``inn``, ``out`` and first attributes.

    A gap breaks the run when it is strictly longer than the limit, which
    depends on the year of the snapshot after the gap. An attribute is the one
    on the first snapshot day (the smallest where that day holds several).
    """
    daily = (
        snapshots.where(valid_id(F.col(id)) & F.col(date).isNotNull())
        .groupBy(id, F.col(date).alias("_day"))
        .agg(*([F.min(a).alias(a) for a in attributes] or [F.count(F.lit(1)).alias("_n")]))
    )
    person = Window.partitionBy(id).orderBy("_day")
    limit = year_dependent(F.col("_day"), switch_year, later_gap, earlier_gap)
    gap = F.datediff(F.col("_day"), F.lag("_day").over(person))
    broken = F.max(F.col("_broken")).over(
        person.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    kept = (
        daily.withColumn("_broken", F.coalesce(gap > limit, F.lit(False)))
        .withColumn("_broken", broken)
        .where(~F.col("_broken"))
    )
    first = [F.min_by(F.struct(*attributes), "_day").alias("_first")] if attributes else []
    out = kept.groupBy(id).agg(F.min("_day").alias("inn"), F.max("_day").alias("out"), *first)
    return out.select(id, *[F.col(f"_first.{a}").alias(a) for a in attributes], "inn", "out")


def first_event(events: DataFrame, id: str, date: str, name: str | None = None) -> DataFrame:
    """The earliest event date per person."""
    return (
        events.where(valid_id(F.col(id)) & F.col(date).isNotNull())
        .groupBy(id)
        .agg(F.min(date).alias(name or date))
    )


def first_event_after(
    events: DataFrame, base: DataFrame, id: str, date: str, after: str, name: str | None = None
) -> DataFrame:
    """The earliest event strictly after a date in ``base`` (one row per person)."""
    days = events.where(valid_id(F.col(id))).select(id, date).distinct()
    later = base.select(id, F.col(after).alias("_after")).join(days, id)
    return later.where(F.col(date) > F.col("_after")).groupBy(id).agg(F.min(date).alias(name or date))
