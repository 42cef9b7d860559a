"""Row-wise rules of single registers."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Civil status codes of the population rule.
LIVING_STATUS = ("01", "03", "05", "07")
LEFT_STATUS = ("70", "80", "90")


def numeric_result(value: Column, result_type: Column, numeric_types: Iterable[str]) -> Column:
    """The number in a laboratory value whose type says it is numeric, else null."""
    return F.when(result_type.isin(*numeric_types), value.try_cast("double"))


def text_result(value: Column, result_type: Column, numeric_types: Iterable[str]) -> Column:
    """The value kept as text where it is not a number."""
    number = numeric_result(value, result_type, numeric_types)
    return F.when(number.isNull(), value.cast("string"))


def alive_from(status: Column, status_start: Column, date: str = "1990-01-01") -> Column:
    """Alive on, or born after, a date: still registered, or left on or after it."""
    return status.isin(*LIVING_STATUS) | (
        status.isin(*LEFT_STATUS) & (status_start >= F.lit(date).cast("date"))
    )


def plausible_death(death: Column, entry: Column) -> Column:
    """A death before entry is an error and becomes null."""
    return F.when(death < entry, None).otherwise(death)


def reconciled_birth(person_register: Column, snapshot: Column) -> Column:
    """The person register decides; the snapshot fills in where it is silent."""
    return F.coalesce(person_register, snapshot)


def year_dependent(date: Column, switch_year: int, later: int, earlier: int) -> Column:
    """One number for dates after the switch year, another up to and including it."""
    return F.when(F.year(date) > switch_year, F.lit(later)).otherwise(F.lit(earlier))
