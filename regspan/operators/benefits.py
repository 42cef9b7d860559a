"""Wide period tables (one column per week, month or quarter) to long periods."""

from __future__ import annotations

import datetime as dt
from bisect import insort
from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import month_column, week_column
from .cohort import left_merge

PERIOD_PARSERS: dict[str, Callable[[str], tuple[dt.date, dt.date]]] = {
    "support": week_column,
    "branch": month_column,
}


def columns_with_prefix(df: DataFrame, prefix: str) -> list[str]:
    """Columns whose name starts with a prefix, whatever the case."""
    return [c for c in df.columns if c.lower().startswith(prefix.lower())]


def _runs(
    df: DataFrame, id: str, kind: str, columns: Sequence[str] | None,
    parser: Callable[[str], tuple[dt.date, dt.date]] | None, empty: bool,
) -> DataFrame:
    """``(id, _spell)``: the unbroken runs of equal codes of each wide row, found inside the row.

    ``empty`` also returns the runs without a code, so that a row's runs fill all its periods.
    """
    parse = parser or PERIOD_PARSERS[kind]
    if columns is None:
        columns = columns_with_prefix(df, "y_") if kind == "support" else [
            c for c in df.columns if c != id
        ]
    if not columns:
        raise ValueError("no period columns")
    spans = sorted((*parse(c), c) for c in columns)
    starts, ends, names = ([s[i] for s in spans] for i in range(3))
    n = len(names)
    def dates(days: Sequence[dt.date]) -> str:
        return "array(" + ", ".join(f"DATE '{d}'" for d in days) + ")"

    # Periods that do not continue the one before; consecutive columns have none.
    apart = [i for i in range(1, n) if starts[i] != ends[i - 1]]
    gap = f"OR array_contains(array({', '.join(map(str, apart))}), i)" if apart else ""
    listed = ", ".join(f"nullif(`{c}`, '')" for c in names)
    changes = (
        f"filter(sequence(1, {n - 1}), i -> NOT get(_codes, i) <=> get(_codes, i - 1) {gap})"
        if n > 1
        else "cast(array() AS array<int>)"
    )
    # Where a new code begins, with both ends of the table.
    edges = f"concat(array(0), {changes}, array({n}))"
    spells = f"""filter(
        transform(_edges, (i, k) -> struct(
          get(_codes, i) AS code, get({dates(starts)}, i) AS start,
          get({dates(ends)}, get(_edges, k + 1) - 1) AS end)),
        s -> {"s.start" if empty else "s.code"} IS NOT NULL)"""
    return (
        df.select(id, F.expr(f"array({listed})").alias("_codes"))
        .select(id, "_codes", F.expr(edges).alias("_edges"))
        .select(id, F.explode(F.expr(spells)).alias("_spell"))
    )


def import_dream(
    df: DataFrame,
    id: str = "pnr",
    kind: str = "support",
    columns: Sequence[str] | None = None,
    parser: Callable[[str], tuple[dt.date, dt.date]] | None = None,
    code: str = "code",
) -> DataFrame:
    """Benefit weeks (``support``) or profession months (``branch``) as periods.

    Our rule: one output row ``(id, code, start, end)`` per unbroken run of
    equal codes, end exclusive; null and empty codes are no benefit. Column
    names give the dates. A row of the wide table is one person's whole
    history, so runs are found inside the row and nothing is shuffled; where a person may
    have several rows, or the register comes in several deliveries, ``import_deliveries`` stitches them.
    """
    out = _runs(df, id, kind, columns, parser, empty=False)
    return out.select(id, F.col("_spell.code").alias(code), "_spell.start", "_spell.end")


def import_deliveries(
    deliveries: Sequence[DataFrame],
    id: str = "pnr",
    kind: str = "support",
    columns: Sequence[str] | None = None,
    parser: Callable[[str], tuple[dt.date, dt.date]] | None = None,
    code: str = "code",
) -> DataFrame:
    """Benefit periods from several wide tables, oldest delivery first, and several rows per person.

    Our rule: for a person it lists, a later delivery decides about every period it has a column for, also
    where it has no code; rows of one delivery complete each other, of two codes in one period the greater one
    counts. Runs of equal codes that touch are one period, within a row or across rows and
    deliveries; a period that no column covers ends a run. Rows without an id are left out.

    Runs are found inside each wide row, so only runs are shuffled, equal ones of a person once; they are stitched
    per person in order of time as a stream that holds one run per delivery and code.
    """
    parts = [
        _runs(df, id, kind, columns, parser, empty=True).select(
            F.col(id).alias("_id"), F.lit(i).alias("_delivery"), F.col("_spell.code").alias("_code"),
            F.unix_date("_spell.start").alias("_s"), F.unix_date("_spell.end").alias("_e"),
        )
        for i, df in enumerate(deliveries)
    ]
    known = F.col("_id").isNotNull() & (F.col("_id").cast("string") != "")
    runs = reduce(DataFrame.unionByName, parts).where(known).distinct()
    kind_of_id = runs.schema["_id"].dataType.simpleString()
    ordered = runs.repartition("_id").sortWithinPartitions("_id", "_s")
    out = ordered.mapInArrow(_stitch, f"_id {kind_of_id}, code string, start date, end date")
    return out.toDF(id, code, "start", "end")


class Stitching:
    """The code of each day from overlapping runs, the latest delivery and then the greatest code on top."""

    def __init__(self) -> None:
        self.periods: list[list] = []  # code, start, end
        self._keys: list[tuple[int, str]] = []
        self._ends: dict[tuple[int, str], int] = {}
        self._at = 0

    def _advance(self, day: int | None) -> None:
        while self._keys and (day is None or self._at < day):
            top = self._keys[-1]
            end = self._ends[top]
            if end <= self._at:
                self._keys.pop()
                del self._ends[top]
                continue
            stop = end if day is None else min(end, day)
            code = top[1]
            if code:
                last = self.periods[-1] if self.periods else None
                if last and last[0] == code and last[2] == self._at:
                    last[2] = stop
                else:
                    self.periods.append([code, self._at, stop])
            self._at = stop

    def add(self, delivery: int, code: str | None, start: int, end: int) -> None:
        """A run; starts never fall."""
        self._advance(start)
        self._at = start
        key = (delivery, code or "")
        if key not in self._ends:
            insort(self._keys, key)
        self._ends[key] = max(end, self._ends.get(key, end))

    def close(self) -> None:
        self._advance(None)


def _stitch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs ordered by person and start to periods."""
    ids: list = []
    periods: list[list] = []
    who, line, kind = None, None, None

    def written() -> pa.RecordBatch:
        code, start, end = zip(*periods) if periods else ((), (), ())
        days = [pa.array(x, pa.int32()).cast(pa.date32()) for x in (start, end)]
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, kind), pa.array(code, pa.string()), *days], ["_id", "code", "start", "end"]
        )

    def finish() -> None:
        line.close()
        ids.extend([who] * len(line.periods))
        periods.extend(line.periods)

    for batch in batches:
        kind = batch.schema.field("_id").type
        for new, *run in zip(*[batch.column(c).to_pylist() for c in ("_id", "_delivery", "_code", "_s", "_e")]):
            if line is None or new != who:
                if line is not None:
                    finish()
                    if len(ids) > 50_000:
                        yield written()
                        ids, periods = [], []
                who, line = new, Stitching()
            line.add(*run)
    if line is not None:
        finish()
        yield written()


def wide_to_long(
    df: DataFrame, keys: Sequence[str], columns: Sequence[str], name: str, value: str
) -> DataFrame:
    """One row per key row and listed column, values as they are."""
    long = df.select(*keys, F.posexplode(F.array(*[F.col(c) for c in columns])).alias("_at", value))
    label = F.get(F.lit(list(columns)), F.col("_at"))
    return long.select(*keys, label.alias(name), value)


def lab_coverage_long(
    counts: DataFrame,
    id_codes: DataFrame | None = None,
    keys: Sequence[str] = ("region", "speciale", "laboratorium"),
    prefix: str = "kvartal",
) -> DataFrame:
    """Reported samples per laboratory and quarter, with the laboratory's id code.

    A laboratory that the code table repeats counts with its least row there, see ``left_merge``.
    """
    long = wide_to_long(counts, keys, columns_with_prefix(counts, prefix), "quarter", "n")
    return long if id_codes is None else left_merge(long, [id_codes], keys)
