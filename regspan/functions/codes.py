"""Code prefixes: predicates and condition lists.

A condition list maps a condition name to one or more code prefixes:
``{"ami": ["410", "DI21"], "angina": ["413", "DI20"]}``.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

Conditions = Mapping[str, "str | Iterable[str]"]


def condition_lists(conditions: Conditions) -> dict[str, list[str]]:
    """Every condition with a sorted list of distinct, non-empty prefixes."""
    out = {}
    for name, codes in conditions.items():
        prefixes = sorted({codes} if isinstance(codes, str) else set(codes))
        if not prefixes or "" in prefixes:
            raise ValueError(f"condition {name!r} needs non-empty prefixes")
        out[name] = prefixes
    if not out:
        raise ValueError("no conditions given")
    return out


def shortest_prefixes(prefixes: Iterable[str]) -> list[str]:
    """The same prefix set without entries a shorter entry already covers."""
    kept: list[str] = []
    for prefix in sorted(set(prefixes)):
        if not kept or not prefix.startswith(kept[-1]):
            kept.append(prefix)
    return kept


def starts_with_any(code: Column, prefixes: Iterable[str]) -> Column:
    """True where the code starts with one of the prefixes.

    Written as OR-ed ``startswith`` so that the Parquet scan receives
    ``StringStartsWith`` filters (a regular expression would not be pushed).
    """
    return reduce(lambda a, b: a | b, [code.startswith(p) for p in shortest_prefixes(prefixes)])


def contains_any(code: Column, parts: Iterable[str]) -> Column:
    return reduce(lambda a, b: a | b, [code.contains(p) for p in sorted(set(parts))])


def matches(code: Column, prefixes: Iterable[str], match: str = "start") -> Column:
    if match == "start":
        return starts_with_any(code, prefixes)
    if match == "contains":
        return contains_any(code, prefixes)
    raise ValueError(f"match must be 'start' or 'contains', not {match!r}")


def matched_conditions(code: Column, conditions: Conditions, match: str = "start") -> Column:
    """Array with the name of each condition the code belongs to."""
    return F.array_compact(
        F.array(
            *[
                F.when(matches(code, prefixes, match), F.lit(name))
                for name, prefixes in condition_lists(conditions).items()
            ]
        )
    )


def valid_id(column: Column) -> Column:
    """Null and the empty string both mean a missing person id."""
    return column.isNotNull() & (column.cast("string") != "")
