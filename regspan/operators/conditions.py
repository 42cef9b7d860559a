"""Conditions from code prefixes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.codes import Conditions, condition_lists, matched_conditions, matches

# Up to this many prefixes a list is written into the scan as literals.
LITERAL_PREFIXES = 200


def find_condition(
    df: DataFrame,
    code: str,
    keep: Sequence[str],
    conditions: Conditions | DataFrame,
    match: str = "start",
    codes: DataFrame | None = None,
) -> DataFrame:
    """Rows whose code belongs to a condition, one row per input row and condition.

    Our rule: several matching prefixes of one condition give one row, a row
    may match several conditions, a null code matches nothing, input
    duplicates are kept. ``conditions`` is a mapping or a DataFrame
    ``(condition, prefix)``. Short mappings become literal expressions (no
    shuffle, prefixes pushed to the scan). Long lists are matched on the
    distinct codes only and joined back; ``codes`` may name a smaller table
    with the same column, and then only rows with one of its codes are found,
    for lists of any length. An empty prefix is an error in a mapping and
    matches nothing in a table. ``match="contains"`` looks for the parts anywhere in the code.
    """
    if match not in ("start", "contains"):
        raise ValueError(f"match must be 'start' or 'contains', not {match!r}")
    if not isinstance(conditions, DataFrame):
        lists = condition_lists(conditions)
        pairs = [(name, p) for name, prefixes in lists.items() for p in prefixes]
        if len(pairs) <= LITERAL_PREFIXES:
            hits = F.explode(matched_conditions(F.col(code), lists, match))
            wanted = matches(F.col(code), [p for _, p in pairs], match)
            rows = df.where(wanted)
            if codes is not None:
                rows = rows.join(codes.select(code).distinct(), code, "left_semi")
            return rows.select(*keep, hits.alias("condition"))
        conditions = df.sparkSession.createDataFrame(pairs, "condition string, prefix string")
    members = code_conditions(df if codes is None else codes, code, conditions, match)
    needed = df.select(*dict.fromkeys([*keep, code])).where(F.col(code).isNotNull())
    return needed.join(members, code).select(
        *keep, F.explode("_conditions").alias("condition")
    )


def code_conditions(df: DataFrame, code: str, table: DataFrame, match: str = "start") -> DataFrame:
    """One row per distinct code with the sorted array of its conditions.

    Each distinct code is expanded to its own beginnings (or parts) of the lengths that occur in
    the table and equi-joined to it once; a ``startswith`` join would compare every code with every prefix.
    """
    codes = df.select(code).distinct().where(F.length(code) > 0)
    wanted = table.select("condition", "prefix").where(F.length("prefix") > 0).distinct()
    # A few numbers, found by a subquery.
    lengths = wanted.agg(F.collect_set(F.length("prefix"))).scalar()
    fitting = F.filter("_lengths", lambda n: n <= F.length(code))
    if match == "start":
        parts = F.transform(fitting, lambda n: F.substring(F.col(code), F.lit(1), n))
    else:
        starts = lambda n: F.sequence(F.lit(1), F.length(code) - n + 1)
        parts = F.flatten(
            F.transform(fitting, lambda n: F.transform(starts(n), lambda i: F.substring(F.col(code), i, n)))
        )
    expanded = codes.withColumn("_lengths", lengths).select(code, F.explode(F.array_distinct(parts)).alias("prefix"))
    return (
        expanded.join(wanted, "prefix")
        .groupBy(code)
        .agg(F.sort_array(F.collect_set("condition")).alias("_conditions"))
    )


def condition_wide(found: DataFrame, id: str, date: str, names: Sequence[str]) -> DataFrame:
    """Long conditions to one row per id: the first date of each, null if never."""
    return found.groupBy(id).agg(
        *[F.min(F.when(F.col("condition") == name, F.col(date))).alias(name) for name in names]
    )
