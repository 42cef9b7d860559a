"""Benchmark decontamination: test n-grams searched in whole documents."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ..sources.sinks import keep
from .words import ALPHANUMERIC, mix, utf8, word_hashes

# Words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` of lower-cased text in one window.
N = 13
# Windows sent to every executor at once; a larger benchmark is scanned in several passes.
BROADCAST_WINDOWS = 200_000

_Q = mix(np.arange(101, 165, dtype=np.uint64)) | np.uint64(1)

Windows = dict[int, list[tuple[bytes, list[int]]]]


def _window_hashes(words: np.ndarray, longest: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each length up to ``longest``: the hashes of all windows of that many words."""
    total = np.zeros(len(words), np.uint64)
    for j in range(min(longest, len(words))):
        total = total[: len(words) - j] + words[j:] * _Q[j]
        yield j + 1, mix(total + np.uint64(j + 1))


def _item_windows(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    """(_item, _length, _window hash, _words) for the windows of each item."""
    for batch in batches:
        text, items = batch.column("_text"), batch.column("_item")
        data, _ = utf8(text)
        out: list[list] = [[], [], [], []]
        for i, count, start, end, hashes, first in word_hashes(text, ALPHANUMERIC):
            for k in range(count):
                lo, hi = int(first[k]), int(first[k + 1])
                if lo == hi:
                    continue
                length, found = list(_window_hashes(hashes[lo:hi], n))[-1]
                words = [data[a:b].tobytes().lower() for a, b in zip(start[lo:hi], end[lo:hi])]
                for p, h in enumerate(found.view(np.int64)):
                    out[0].append(items[i + k])
                    out[1].append(length)
                    out[2].append(int(h))
                    out[3].append(b" ".join(words[p : p + length]))
        kinds = (items.type, pa.int32(), pa.int64(), pa.binary())
        yield pa.RecordBatch.from_arrays(
            [pa.array(values, kind) for values, kind in zip(out, kinds)],
            names=["_item", "_length", "_window", "_words"],
        )


def benchmark_windows(benchmark: DataFrame, item: str, text: str, n: int) -> DataFrame:
    """Each distinct window with the distinct ids of its items, written once."""
    rows = benchmark.select(F.col(item).alias("_item"), F.col(text).alias("_text"))
    kind = rows.schema["_item"].dataType.simpleString()
    found = rows.mapInArrow(
        lambda it: _item_windows(it, n), f"_item {kind}, _length int, _window long, _words binary"
    )
    items = F.sort_array(F.collect_set("_item")).alias("_items")
    return keep(found.groupBy("_window", "_length", "_words").agg(items), "windows")


class _Filter:
    """Which 64-bit hashes may be in the set: one bit table, then the exact words."""

    def __init__(self, windows: Windows, lengths: set[int]):
        self.windows, self.lengths = windows, lengths
        self.bits = max(16, (64 * len(windows)).bit_length())
        self.table = np.zeros(1 << self.bits, bool)
        self.table[self._slot(np.array(list(windows), np.int64).view(np.uint64))] = True

    def _slot(self, h: np.ndarray) -> np.ndarray:
        return (h >> np.uint64(64 - self.bits)).astype(np.int64)

    def hits(self, h: np.ndarray) -> np.ndarray:
        return np.flatnonzero(self.table[self._slot(h)])


_filters: dict[str, _Filter] = {}

SPANS = "array<struct<first:long,words:long,start:long,end:long>>"
_SPAN_TYPE = pa.list_(pa.struct([(f, pa.int64()) for f in ("first", "words", "start", "end")]))
_FOUND = f"_found_words long, _found_spans {SPANS}, _found_items array<{{item}}>"


def _merge(windows: list[tuple[int, int]]) -> list[tuple[int, int]]:
    merged: list[tuple[int, int]] = []
    for lo, hi in sorted(windows):
        if merged and lo <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(merged[-1][1], hi))
        else:
            merged.append((lo, hi))
    return merged


def _scan(
    batches: Iterator[pa.RecordBatch], shared, name: str, n: int, text: str, columns: list[str], only_hit: bool,
    kind: pa.DataType,
) -> Iterator[pa.RecordBatch]:
    if name not in _filters:  # once per Python worker, not per task
        _filters.clear()
        _filters[name] = _Filter(*shared.value)
    known = _filters[name]
    for batch in batches:
        data, at = utf8(batch.column(text))
        counts, spans, items = [], [], []
        for i, count, start, end, hashes, first in word_hashes(batch.column(text), ALPHANUMERIC):
            hit: dict[int, tuple[list[tuple[int, int]], set[int]]] = {}
            for length, found in _window_hashes(hashes, n):
                for p in known.hits(found) if length in known.lengths else ():
                    p = int(p)
                    k = int(np.searchsorted(first, p, "right")) - 1
                    if p + length > first[k + 1]:
                        continue  # runs into the next text
                    here = zip(start[p : p + length], end[p : p + length])
                    words = b" ".join(data[a:b].tobytes().lower() for a, b in here)
                    for wanted, ids in known.windows.get(int(found[p : p + 1].view(np.int64)[0]), ()):
                        if wanted == words:
                            got = hit.setdefault(k, ([], set()))
                            got[0].append((p, p + length))
                            got[1].update(ids)
            for k in range(count):
                counts.append(int(first[k + 1] - first[k]))
                windows, ids = hit.get(k, ((), ()))
                items.append(sorted(ids))
                spans.append([])
                if windows:
                    base = int(at[i + k])
                    chars = np.cumsum((data[base : int(at[i + k + 1])] & 0xC0) != 0x80)
                    for lo, hi in _merge(windows):
                        left, right = int(chars[start[lo] - base]) - 1, int(chars[end[hi - 1] - base - 1])
                        spans[-1].append({"first": lo - int(first[k]), "words": hi - lo, "start": left, "end": right})
        out = pa.RecordBatch.from_arrays(
            [
                *(batch.column(c) for c in columns),
                pa.array(counts, pa.int64()),
                pa.array(spans, _SPAN_TYPE),
                pa.array(items, pa.list_(kind)),
            ],
            names=[*columns, "_found_words", "_found_spans", "_found_items"],
        )
        yield out.filter(pa.array([bool(s) for s in spans], pa.bool_())) if only_hit else out


def _find(
    docs: DataFrame, benchmark: DataFrame, text: str, item: str, item_text: str, n: int, percent: int,
    columns: list[str], most: int,
) -> DataFrame:
    """``columns`` of ``docs`` and the findings as columns ``_found_…``."""
    windows = benchmark_windows(benchmark, item, item_text, n)
    # What is broadcast are windows and, for each, its items.
    total = windows.agg(F.sum(F.greatest(F.size("_items"), F.lit(1)))).first()[0] or 0
    blocks = max(1, -(-total // most))
    item_type = benchmark.schema[item].dataType
    kind = to_arrow_type(item_type)

    def scan(block: int, rows: DataFrame, columns: list[str], only_hit: bool) -> DataFrame:
        table: Windows = {}
        lengths: set[int] = set()
        for r in windows.where(F.pmod(F.xxhash64("_window"), F.lit(blocks)) == block).collect():
            table.setdefault(r["_window"], []).append((bytes(r["_words"]), list(r["_items"])))
            lengths.add(r["_length"])
        shared, name = docs.sparkSession.sparkContext.broadcast((table, lengths)), uuid.uuid4().hex
        types = "".join(f"`{c}` {rows.schema[c].dataType.simpleString()}, " for c in columns)
        types += _FOUND.format(item=item_type.simpleString())
        rows = rows.select(*columns, *([] if text in columns else [text]))
        return rows.mapInArrow(lambda it: _scan(it, shared, name, n, text, columns, only_hit, kind), types)

    if blocks == 1:
        found = scan(0, docs, columns, False)
    else:
        numbered = keep(docs.withColumn("_found_row", F.monotonically_increasing_id()), "documents")
        first = scan(0, numbered, [*columns, "_found_row"], False)
        passes = [scan(b, numbered, ["_found_row"], True) for b in range(1, blocks)]
        found = _together(first, passes).select(*columns, "_found_words", "_found_spans", "_found_items")
    n_hit = F.aggregate("_found_spans", F.lit(0).cast("long"), lambda a, s: a + s["words"])
    return found.withColumn("_found_hit", n_hit).withColumn(
        "_found_bad",
        (F.col("_found_hit") > 0) & (100 * F.col("_found_hit") >= percent * F.col("_found_words")),
    )


def _together(first: DataFrame, passes: list[DataFrame]) -> DataFrame:
    """The findings of several scans, put together by row number."""
    parts = [p.select("_found_row", "_found_spans", "_found_items") for p in [first, *passes]]
    every = reduce(DataFrame.union, parts).where(F.size("_found_spans") > 0)
    grouped = every.groupBy("_found_row").agg(
        F.sort_array(F.flatten(F.collect_list("_found_spans"))).alias("_s"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("_found_items")))).alias("_i"),
    )
    none = F.expr(f"CAST(array() AS {SPANS})")

    def add(done, span):
        last = F.try_element_at(done, F.lit(-1))
        stop = F.greatest(last["first"] + last["words"], span["first"] + span["words"])
        longer = F.struct(
            last["first"].alias("first"), (stop - last["first"]).alias("words"),
            last["start"].alias("start"), F.greatest(last["end"], span["end"]).alias("end"),
        )
        joins = (F.size(done) > 0) & (span["first"] <= last["first"] + last["words"])
        return F.when(joins, F.concat(F.slice(done, 1, F.size(done) - 1), F.array(longer))).otherwise(
            F.concat(done, F.array(span))
        )

    merged = grouped.select("_found_row", F.aggregate("_s", none, add).alias("_s"), "_i")
    return first.join(merged, "_found_row", "left").withColumns(
        {
            "_found_spans": F.coalesce("_s", "_found_spans"),
            "_found_items": F.coalesce("_i", "_found_items"),
        }
    )


def find_passages(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    n: int = N,
    percent: int = 5,
    columns: list[str] | None = None,
    most: int = BROADCAST_WINDOWS,
) -> DataFrame:
    """``docs`` (or some ``columns``) with ``n_words``, ``n_hit``, ``items``, ``spans``, ``contaminated``.

    A-Z is lower-cased; words are runs of digits, letters a-z and all characters from U+0080 on.
    A window is ``n`` consecutive words of an item, or the whole item if it has fewer, but not
    none. Every document window is looked up by hash and confirmed word by word. ``spans`` are
    the merged stretches inside any occurrence: first word, number of words, and characters
    ``start`` to ``end`` of the text. ``items`` are the ids of items with an occurring window,
    ``n_hit`` the words in spans. A document is contaminated if ``n_hit`` is positive and at
    least ``percent`` % of its words.

    Null and empty texts have no words; an item without an id still hits but is not listed; an
    empty benchmark hits nothing; repeated items count once. Input columns of the new names
    are replaced.

    The windows, each with its items, are counted before they are broadcast. A benchmark of more than ``most``
    such pairs is cut by hash of the window into blocks of about that many; documents are then written once, scanned
    once per block, and the findings meet by row, so a benchmark twice as large costs a scan more. Item ids may have any
    type that can be sorted.
    """
    found = _find(docs, benchmark, text, item, item_text, n, percent, columns or docs.columns, most)
    names = {"n_words": "words", "n_hit": "hit", "items": "items", "spans": "spans", "contaminated": "bad"}
    kept = [c for c in (columns or docs.columns) if c.lower() not in names]
    return found.select(*kept, *[F.col(f"_found_{old}").alias(new) for new, old in names.items()])


def without_contaminated(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text",
    n: int = N, percent: int = 5, most: int = BROADCAST_WINDOWS,
) -> DataFrame:
    """The documents that are not contaminated, with their own columns and whole texts."""
    found = _find(docs, benchmark, text, item, item_text, n, percent, docs.columns, most)
    return found.where("NOT _found_bad").select(*docs.columns)


def without_passages(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text",
    n: int = N, most: int = BROADCAST_WINDOWS,
) -> DataFrame:
    """All documents, with the benchmark's passages cut out of their texts."""
    found = _find(docs, benchmark, text, item, item_text, n, 0, docs.columns, most)
    piece = lambda lo, hi: F.substring(F.col(text), (lo + 1).cast("int"), (hi - lo).cast("int"))
    cut = F.aggregate(
        "_found_spans",
        F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at")),
        lambda a, s: F.struct(F.concat(a["out"], piece(a["at"], s["start"])).alias("out"), s["end"].alias("at")),
        lambda a: F.concat(a["out"], piece(a["at"], F.length(F.col(text)).cast("long"))),
    )
    clean = F.when(F.size("_found_spans") > 0, cut).otherwise(F.col(text))
    return found.withColumn(text, clean).select(*docs.columns)
