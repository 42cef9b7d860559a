"""One timeline per person from overlapping periods, by a sweep over days.

Periods arrive in order of their start. A stack holds the open ones, the latest start on top; a period
that begins hides all that end no later than itself, so ends rise from the top of the stack to its bottom
and each period is pushed and removed once. The value of a day is the one on top.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Years per block of a timeline.
BIN_YEARS = 5
# Points written at once.
POINTS = 50_000


class Timeline:
    """The points of one person: day, whether it is a step, and the value from that day on."""

    def __init__(self) -> None:
        self.days: list[int] = []
        self.steps: list[bool] = []
        self.values: list = []
        self._open: list[tuple[int, object]] = []
        self._ends: list[int] = []
        self._waiting: set[int] = set()
        self._today: int | None = None
        self._step = False

    def _write(self, day: int, step: bool) -> None:
        while self._open and self._open[-1][0] <= day:
            self._open.pop()
        self.days.append(day)
        self.steps.append(step)
        self.values.append(self._open[-1][1] if self._open else None)

    def _turn(self, day: int | None) -> None:
        """Write the day at hand and the ends before ``day``."""
        if self._today is not None:
            self._write(self._today, self._step)
        while self._ends and (day is None or self._ends[0] < day):
            end = heapq.heappop(self._ends)
            self._waiting.discard(end)
            self._write(end, True)
        self._today, self._step = day, bool(self._ends) and self._ends[0] == day
        if self._step:
            self._waiting.discard(heapq.heappop(self._ends))

    def add(self, start: int, end: int | None, ends: bool, value) -> None:
        """A period, or without an end a day that is asked for; starts never fall.

        Of equal starts the one added last wins.
        """
        if start != self._today:
            self._turn(start)
        if end is None:
            return
        self._step = True
        while self._open and self._open[-1][0] <= end:
            self._open.pop()
        self._open.append((end, value))
        if ends and end not in self._waiting:
            self._waiting.add(end)
            heapq.heappush(self._ends, end)

    def close(self) -> None:
        self._turn(None)


def _nested(ids: list, lines: list[Timeline], id_type: pa.DataType, value_type: pa.DataType) -> pa.RecordBatch:
    days = np.array([d for t in lines for d in t.days], np.int32)
    steps = [s for t in lines for s in t.steps]
    following: list[int | None] = []
    for t in lines:
        after, back = None, []
        for day, step in zip(reversed(t.days), reversed(t.steps)):
            back.append(after)
            after = day if step else after
        following += reversed(back)
    year = days.astype("datetime64[D]").astype("datetime64[Y]").astype(np.int64) + 1970
    bins = year // BIN_YEARS
    person = np.repeat(np.arange(len(lines)), [len(t.days) for t in lines])
    first = np.ones(len(days), bool)
    first[1:] = (bins[1:] != bins[:-1]) | (person[1:] != person[:-1])
    at = np.flatnonzero(first)
    points = pa.StructArray.from_arrays(
        [
            pa.array(days).cast(pa.date32()), pa.array(steps, pa.bool_()),
            pa.array([v for t in lines for v in t.values], value_type),
            pa.array(following, pa.int32()).cast(pa.date32()),
        ],
        ["at", "is_step", "value", "next"],
    )
    blocks = pa.ListArray.from_arrays(pa.array(np.append(at, len(days)).astype(np.int32)), points)
    years = pa.StructArray.from_arrays([pa.array(bins[at].astype(np.int32)), blocks], ["bin", "points"])
    counts = np.searchsorted(person[at], np.arange(len(lines) + 1)).astype(np.int32)
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, id_type), pa.ListArray.from_arrays(pa.array(counts), years)], ["_id", "years"]
    )


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ordered by person and start to one row per person, read as a stream."""
    ids: list = []
    lines: list[Timeline] = []
    done, types = 0, None
    for batch in batches:
        types = batch.schema.field("_id").type, batch.schema.field("_value").type
        for who, *row in zip(*[batch.column(c).to_pylist() for c in ("_id", "_s", "_e", "_ends", "_value")]):
            if not ids or who != ids[-1]:
                if lines:
                    lines[-1].close()
                    done += len(lines[-1].days)
                if done > POINTS:
                    yield _nested(ids, lines, *types)
                    ids, lines, done = [], [], 0
                ids.append(who)
                lines.append(Timeline())
            lines[-1].add(*row)
    if lines:
        lines[-1].close()
        yield _nested(ids, lines, *types)


def timelines(spans: DataFrame) -> DataFrame:
    """One row per person: ``_id`` and ``years``, blocks of years in order, each with the points in it.

    ``spans`` holds periods ``[_s, _e)`` in day numbers with ``_value``, and days asked for, which have no ``_e``.
    Every start is a step, and every end whose ``_ends`` is true. A point has the day ``at``, ``is_step``, the
    ``value`` from there on (null if no period covers it) and the ``next`` step. Where periods
    overlap, the one that started last decides, then the larger value.

    Equal periods are reduced before they are shuffled, to one row per person, start and end; then a person's
    rows are sorted and swept in one task as a stream, which holds the open periods no other one
    hides, and the person's days. Days bound both, whatever the number of rows.
    """
    reduced = spans.groupBy("_id", "_s", "_e").agg(F.max("_ends").alias("_ends"), F.max("_value").alias("_value"))
    dealt = reduced.repartition("_id").sortWithinPartitions("_id", "_s", "_value", "_e")
    id_type, value_type = (spans.schema[c].dataType.simpleString() for c in ("_id", "_value"))
    point = f"struct<at:date,is_step:boolean,value:{value_type},next:date>"
    return dealt.mapInArrow(_sweep, f"_id {id_type}, years array<struct<bin:int,points:array<{point}>>>")
