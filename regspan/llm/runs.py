"""Periodic runs of words, caught online over dyadic blocks.

A run is a maximal stretch of words that repeats with its smallest period at least twice. Words are
appended to a ``Catchers`` object. Every completed block of 2**i words becomes a catcher: it waits for the
words appended between two and four block lengths behind it, and each of those is compared with it by the
suffix of one block that it ends (two live catchers per size and word). A suffix equal to the block is the
beginning of a square whose period is their distance. It is extended to both sides; while it reaches the
last word it stays open and is carried on by the words appended next. Squares of one stretch merge into
its run.

Why none is missed: a run of period p, 2·2**i <= p < 4·2**i, holds at least p words in a row that are equal
to the word p later, and any 2·2**i - 1 words in a row hold a whole block of 2**i. Each word costs two
comparisons of fingerprints per block size, all words appended together in one vector operation.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import NOT_SPACE, mix, word_hashes

# A run has at least so many words.
LEAST = 12
# Words appended at once; a longer text comes in several parts.
APPEND = 1 << 20
# Bytes of text copied at once.
COPY = 1 << 20

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)

RUNS = "array<struct<start:long,length:long,period:long>>"


def _powers(base: int, start: int, n: int) -> np.ndarray:
    """``base`` to the powers ``start`` … ``start + n - 1``, modulo 2**64."""
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = pow(base, start, 1 << 64)
    return np.multiply.accumulate(out) if n else out


def _grown(array: np.ndarray, used: int, n: int) -> np.ndarray:
    """``array`` with room for ``n`` entries, doubling so that appending stays linear."""
    if n <= len(array):
        return array
    out = np.empty(max(n, 2 * len(array)), array.dtype)
    out[:used] = array[:used]
    return out


class Catchers:
    """All catchers of a growing sequence of words (64-bit hashes)."""

    def __init__(self, least: int = LEAST) -> None:
        self.least = least
        self.n = 0
        self.words = np.zeros(0, np.uint64)
        # Sums of word times power, and the inverse powers that shift a difference to the origin.
        self.sums = np.zeros(1, np.uint64)
        self.shift = np.zeros(0, np.uint64)
        self.open = np.zeros((0, 3), np.int64)  # start, end, period; end is the last word
        self.closed: list[np.ndarray] = []

    def append(self, words: np.ndarray, reach: Sequence[tuple[int, int]] = ()) -> None:
        """Append ``words``, advance open squares, and let the catchers look for new ones.

        ``reach`` may list (length, words): texts of at least that length lie within so many first words.
        """
        old, n = self.n, self.n + len(words)
        self.words = _grown(self.words, old, n)
        self.sums = _grown(self.sums, old + 1, n + 1)
        self.shift = _grown(self.shift, old, n)
        self.words[old:n] = words
        self.shift[old:n] = _powers(_INVERSE, old, len(words))
        with np.errstate(over="ignore"):
            np.cumsum(words * _powers(_BASE, old, len(words)), out=self.sums[old + 1 : n + 1])
            self.sums[old + 1 : n + 1] += self.sums[old]
        self.n = n
        waiting = self.open
        self.open = np.zeros((0, 3), np.int64)
        if len(waiting):
            s, e, p = waiting.T
            self._settle(s, e + self._right(e - p, e), p)
        size = 2
        while True:
            # The first listed length that a run caught by this block size may have.
            need = max(self.least, 4 * size if size > 4 else self.least)
            stop = n if not reach else max((w for length, w in reach if length >= need), default=0)
            if min(stop, n) < need:
                break
            self._catch(size, old, min(stop, n))
            size *= 2

    def _catch(self, size: int, old: int, n: int) -> None:
        """Compare the suffixes that end at words ``old`` … ``n`` with the blocks of ``size`` they may repeat."""
        base = max(old // size - 4, 0)
        first = max(base, 1) * size  # before it no block is complete
        if n < first:
            return
        with np.errstate(over="ignore"):
            prints = (self.sums[first : n + 1] - self.sums[first - size : n + 1 - size]) * self.shift[
                first - size : n + 1 - size
            ]
        base = first // size
        if size == 4:  # also waits for the shortest periods: such runs hold 9 words equal to later ones
            for p in (1, 2, 3):
                hit = prints[p:][::size] == prints[: len(prints) - p][::size]
                self._extend(hit, lambda i, p=p: ((base + i) * size, np.full(len(i), p)), size, 1)
        rows = -(-len(prints) // size)
        blocks = np.zeros(rows * size, np.uint64)
        blocks[: len(prints)] = prints
        last = len(prints) - (rows - 1) * size  # suffixes in the last row
        blocks = blocks.reshape(rows, size)
        for d in (2, 3):
            if rows <= d:
                break
            hit = blocks[d:] == blocks[:-d, :1]
            hit[-1, last:] = False
            self._extend(hit, lambda i, d=d: ((base + i // size) * size, d * size + i % size), size, size)

    def _extend(self, hit: np.ndarray, place, size: int, width: int) -> None:
        """Extend the squares behind the first of adjacent hits of one period to both sides."""
        hit = hit.reshape(-1, width)
        fresh = hit.copy()
        fresh[1:] &= ~hit[:-1]
        found = np.flatnonzero(fresh)
        if len(found):
            a, p = place(found)
            a, p = a.astype(np.int64), p.astype(np.int64)
            s = a - size - self._left(a - size, a - size + p)
            self._settle(s, a + p + self._right(a, a + p), p)

    def _settle(self, s: np.ndarray, e: np.ndarray, p: np.ndarray) -> None:
        """Keep what reaches the last word open, and what is long enough as closed."""
        still = e == self.n
        keep = still | (e - s >= np.maximum(self.least, 2 * p))
        found = np.unique(np.stack([s[keep], e[keep], p[keep]], axis=1), axis=0)
        still = found[:, 1] == self.n
        if still.any():
            self.open = np.unique(np.concatenate([self.open, found[still]]), axis=0)
        if not still.all():
            self.closed.append(found[~still])

    def _same(self, x: np.ndarray, y: np.ndarray, length: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (self.sums[x + length] - self.sums[x]) * self.shift[x] == (
                self.sums[y + length] - self.sums[y]
            ) * self.shift[y]

    def _far(self, most: np.ndarray, same) -> np.ndarray:
        """The largest number up to ``most`` for which ``same`` holds: doubling steps, then halving ones."""
        got = np.zeros(len(most), np.int64)
        alive, step = np.arange(len(most)), 1
        while len(alive):
            alive = alive[got[alive] + step <= most[alive]]
            alive = alive[same(alive, got[alive], step)]
            got[alive] += step
            step *= 2
        while step > 1:
            step //= 2
            may = np.flatnonzero(got + step <= most)
            may = may[same(may, got[may], step)]
            got[may] += step
        return got

    def _right(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Equal words from ``x`` and ``y`` on; ``y`` is the later one."""
        return self._far(self.n - y, lambda i, got, k: self._same(x[i] + got, y[i] + got, k))

    def _left(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Equal words before ``x`` and ``y``; ``x`` is the earlier one."""
        return self._far(x, lambda i, got, k: self._same(x[i] - got - k, y[i] - got - k, k))

    def _true(self, s: int, e: int, p: int) -> bool:
        w, n = self.words, self.n
        return (
            np.array_equal(w[s : e - p], w[s + p : e])
            and (s == 0 or w[s - 1] != w[s - 1 + p])
            and (e == n or w[e] != w[e - p])
        )

    def _stretches(self, p: int) -> np.ndarray:
        """All stretches of period ``p``, word by word."""
        w = self.words[: self.n]
        equal = np.concatenate([[False], w[:-p] == w[p:], [False]])
        turns = np.flatnonzero(equal[1:] != equal[:-1])
        s, e = turns[::2], turns[1::2] + p
        keep = e - s >= max(self.least, 2 * p)
        return np.stack([s[keep], e[keep], np.full(int(keep.sum()), p)], axis=1)

    @staticmethod
    def _smallest(found: np.ndarray) -> np.ndarray:
        """Marks the first of sorted rows of one start and end, the one of the smallest period."""
        new = np.ones(len(found), bool)
        new[1:] = (found[1:, :2] != found[:-1, :2]).any(axis=1)
        return new

    def runs(self) -> np.ndarray:
        """(start, end, period) of all runs of the words appended so far, by start and period.

        Fingerprints only propose: every run is confirmed word by word, and where one proves wrong
        the stretches of its period are found without fingerprints.
        """
        s, e, p = self.open.T
        parts = [*self.closed, self.open[e - s >= np.maximum(self.least, 2 * p)]]
        found = np.unique(np.concatenate(parts), axis=0)  # smallest period first for a start and an end
        if not len(found):
            return found
        new = self._smallest(found)
        right = np.fromiter((self._true(*r) for r in found[new].tolist()), bool, int(new.sum()))
        if not right.all():
            doubted = ~right[np.cumsum(new) - 1]
            again = [self._stretches(q) for q in np.unique(found[doubted, 2]).tolist()]
            found = np.unique(np.concatenate([found[~doubted], *again]), axis=0)
            new = self._smallest(found)
        found = found[new]
        return found[np.lexsort((found[:, 2], found[:, 0]))]


def _alone(n: int, salt: int) -> np.ndarray:
    """Hashes that stand for no word and differ from each other."""
    return mix(np.arange(n, dtype=np.uint64) + np.uint64((0xA5 << 56) + (salt << 40)))


def runs_of_texts(hashes: np.ndarray, first: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, np.ndarray]:
    """Runs of several texts given as word hashes; ``first`` has each text's first word, and the end.

    Returns (start, end, period) in ``hashes``' own numbering, by text, start and period, and the text of each.
    """
    counts = np.diff(first)
    order = np.argsort(-counts, kind="stable")
    order = order[counts[order] >= least]
    if not len(order):
        return np.zeros((0, 3), np.int64), np.zeros(0, np.int64)
    # Longest texts first, each with a lone word behind it, so that large blocks see long texts only.
    lengths = counts[order] + 1
    place = np.concatenate([[0], np.cumsum(lengths)])
    at = np.arange(place[-1]) - np.repeat(place[:-1] - first[order], lengths)
    ends = place[1:] - 1
    at[ends] = 0
    row = hashes[at]
    row[ends] = _alone(len(ends), 1)
    catchers = Catchers(least)
    sizes = 1 << np.arange(2, int(counts.max()).bit_length() + 2)
    reach = [(least, int(place[-1]))]
    reach += [(int(k), int(place[np.count_nonzero(counts[order] >= k)])) for k in sizes if k > least]
    for i in range(0, len(row), APPEND):
        catchers.append(row[i : i + APPEND], reach)
    found = catchers.runs()
    text = np.searchsorted(place, found[:, 0], "right") - 1
    found[:, :2] -= (place[text] - first[order][text])[:, None]
    text = order[text]
    by = np.lexsort((found[:, 2], found[:, 0]))  # hashes are numbered text by text
    return found[by], text[by]


def _joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> Iterator[np.ndarray]:
    """The bytes of some words, one space behind each."""
    sizes = ends - starts + 1
    total = np.concatenate([[0], np.cumsum(sizes)])
    i = 0
    while i < len(sizes):
        j = max(i + 1, int(np.searchsorted(total, total[i] + COPY, "right")) - 1)
        n = int(total[j] - total[i])
        source = np.arange(n) + np.repeat(starts[i:j] - (total[i:j] - total[i]), sizes[i:j])
        last = total[i + 1 : j + 1] - total[i] - 1
        source[last] = 0
        out = data[source]
        out[last] = 32
        yield out
        i = j


def _find(batches: Iterator[pa.RecordBatch], text: str, names: Sequence[str], least: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        column = batch.column(text)
        data = np.frombuffer(column.fill_null("").buffers()[2] or b"", np.uint8)
        sizes, runs, counts = [], [], []
        pieces: list[np.ndarray] = []
        for _, n, starts, ends, hashes, first in word_hashes(column, NOT_SPACE):
            found, of = runs_of_texts(hashes, first, least)
            # Dropped words: those any run covers after its first period.
            change = np.zeros(len(hashes) + 1, np.int64)
            np.add.at(change, found[:, 0] + found[:, 2], 1)
            np.add.at(change, found[:, 1], -1)
            kept = np.flatnonzero(np.cumsum(change[:-1]) == 0)
            pieces += _joined(data, starts[kept], ends[kept])
            bytes_to = np.concatenate([[0], np.cumsum(ends[kept] - starts[kept] + 1)])
            sizes.append(np.diff(bytes_to[np.searchsorted(kept, first)]))
            counts.append(np.bincount(of, minlength=n))
            runs.append(np.stack([found[:, 0] - first[of], found[:, 1] - found[:, 0], found[:, 2]], axis=1))
        size = np.concatenate([*sizes, np.zeros(0, np.int64)]).astype(np.int64)
        stops = np.cumsum(size)
        out = np.concatenate([*pieces, np.zeros(0, np.uint8)])
        if len(out):  # no space behind the last word of a text
            drop = stops[size > 0] - 1
            keep = np.ones(len(out), bool)
            keep[drop] = False
            out = out[keep]
        offsets = np.concatenate([[0], np.cumsum(np.maximum(size - 1, 0))]).astype(np.int32)
        collapsed = pa.StringArray.from_buffers(len(batch), pa.py_buffer(offsets), pa.py_buffer(out))
        run = np.concatenate([*runs, np.zeros((0, 3), np.int64)])
        fields = [pa.array(np.ascontiguousarray(run[:, k])) for k in range(3)]
        at = np.concatenate([[0], np.cumsum(np.concatenate([*counts, np.zeros(0, np.int64)]))]).astype(np.int32)
        listed = pa.ListArray.from_arrays(pa.array(at), pa.StructArray.from_arrays(fields, ["start", "length", "period"]))
        carried = [batch.column(c) for c in names]
        yield pa.RecordBatch.from_arrays([*carried, listed, collapsed], [*names, "_runs", "_collapsed"])


def find_runs(
    docs: DataFrame, text: str = "text", columns: Sequence[str] | None = None, least: int = LEAST
) -> DataFrame:
    """``docs`` (or some ``columns``) with ``runs`` and ``collapsed``.

    Words are ``[^\\x20\\x09-\\x0D]+``, numbered from 0. ``runs`` lists (start, length, period) of every run of at
    least ``least`` words and two periods, by start, then period; runs may overlap. ``collapsed`` holds
    the words that no run covers behind its first period, joined by one space. Words count as equal
    if their 64-bit hashes are.

    A null or wordless text has no runs and collapses to an empty one; a text of one repeated word to that
    word; repeated rows are treated each; an empty table gives an empty result. Input columns of the new
    names are replaced. Rows are worked on where they are read, with no shuffle; memory is about 60 bytes
    per word of the longest text.
    """
    kept = [c for c in (columns or docs.columns) if c.lower() not in ("runs", "collapsed")]
    inside = [f"_{i}" for i in range(len(kept))]  # tasks see plain names
    rows = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(kept, inside)], F.col(f"`{text}`").alias("_text"))
    schema = "".join(f"{n} {rows.schema[n].dataType.simpleString()}, " for n in inside)
    found = rows.mapInArrow(lambda it: _find(it, "_text", inside, least), f"{schema}_runs {RUNS}, _collapsed string")
    return found.toDF(*kept, "runs", "collapsed")
