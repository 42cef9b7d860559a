"""Weighted comorbidity score."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.codes import Conditions, condition_lists, matches


def charlson(
    diagnoses: DataFrame,
    id: str,
    code: str,
    date: str,
    index_date: str,
    codes: Conditions,
    weights: Mapping[str, float],
    lookback_days: int | None = None,
    severe_over_mild: Sequence[tuple[str, str]] = (),
) -> tuple[DataFrame, DataFrame]:
    """The index of each id at its index date, and the components behind it.

    Returns ``(id, index_date, charlson_index)`` and ``(id, index_date, one 0/1
    column per component)``. Our rule: a component is present when a diagnosis
    on or before the index date matches one of its prefixes (within
    ``lookback_days`` if given); the index is the sum of the weights present;
    ids without any score 0. With ``severe_over_mild`` pairs the mild
    component's weight is not added where any of its severe ones is present.
    """
    lists = condition_lists(codes)
    unknown = set(lists) ^ set(weights)
    if unknown:
        raise ValueError(f"codes and weights differ: {sorted(unknown)}")
    in_time = F.col(date) <= F.col(index_date)
    if lookback_days is not None:
        in_time &= F.col(date) >= F.date_sub(F.col(index_date), lookback_days)
    present = [
        F.coalesce(F.max((in_time & matches(F.col(code), prefixes)).cast("int")), F.lit(0)).alias(name)
        for name, prefixes in lists.items()
    ]
    # Flags are maxima, so all but one row per id and input task vanish before the shuffle.
    components = diagnoses.groupBy(id, index_date).agg(*present)
    severe_of: dict[str, list[str]] = {}
    for severe, mild in severe_over_mild:
        severe_of.setdefault(mild, []).append(severe)
    unknown = {name for pair in severe_over_mild for name in pair} - set(weights)
    if unknown:
        raise ValueError(f"no weights for {sorted(unknown)}")

    def counted(name: str) -> Column:
        severe = [F.col(s) for s in severe_of.get(name, [])]
        return F.lit(1) - (F.greatest(*severe) if len(severe) > 1 else severe[0]) if severe else F.lit(1)

    score = sum((F.col(name) * F.lit(weight) * counted(name) for name, weight in weights.items()), F.lit(0))
    return components.select(id, index_date, score.alias("charlson_index")), components


def weighted_score(
    found: DataFrame, weights: Mapping[str, float], id: str, component: str = "condition"
) -> DataFrame:
    """``(id, score)``: the sum of the weights of the distinct components of each id."""
    present = [
        F.max((F.col(component) == name).cast("int")).alias(f"_has_{i}")
        for i, name in enumerate(weights)
    ]
    score = sum(
        (F.col(f"_has_{i}") * F.lit(weight) for i, weight in enumerate(weights.values())), F.lit(0)
    )
    return found.groupBy(id).agg(*present).select(id, score.alias("score"))
