"""64-bit hashes of all words of a batch of texts, on the UTF-8 bytes with NumPy.

Used inside tasks only. A word is a run of word bytes; texts never share a word. Memory is
bounded by the slice size, not by the batch or the longest text, apart from 8 bytes per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 18

_P = 0x9E3779B97F4A7C15
_P_INVERSE = pow(_P, -1, 1 << 64)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

# [^\x20\x09-\x0D]
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[32, 9, 10, 11, 12, 13]] = False
# [^\x00-\x2F\x3A-\x60\x7B-\x7F], for lower-cased text
ALPHANUMERIC = np.zeros(256, bool)
ALPHANUMERIC[48:58] = ALPHANUMERIC[97:123] = ALPHANUMERIC[128:] = True

_powers: dict[str, np.ndarray] = {}


def _power(kind: str, base: int, n: int) -> np.ndarray:
    table = _powers.get(kind)
    if table is None or len(table) < n:
        table = np.full(max(n, SLICE_BYTES * 2), base, np.uint64)
        table[0] = 1
        table = _powers[kind] = np.multiply.accumulate(table)
    return table[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection that spreads every input bit (the splitmix64 finisher)."""
    h = (h ^ (h >> np.uint64(30))) * _M1
    h = (h ^ (h >> np.uint64(27))) * _M2
    return h ^ (h >> np.uint64(31))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offsets of its texts; null is empty."""
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    at = np.zeros(1, np.int64)
    if len(column):
        at = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), at


def _hash_slice(raw: np.ndarray, cuts: np.ndarray, is_word: np.ndarray):
    """Starts, ends and hashes of the words of some bytes; no word crosses a cut."""
    low = _LOWER[raw]
    inside = is_word[low]
    begins, stops = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    stops[:-1] &= ~inside[1:]
    cut = cuts[(cuts > 0) & (cuts < len(raw))]
    begins[cut] = inside[cut]
    stops[cut - 1] = inside[cut - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    total = np.empty(len(raw) + 1, np.uint64)
    total[0] = 0
    np.cumsum((low.astype(np.uint64) + np.uint64(1)) * _power("P", _P, len(raw)), out=total[1:])
    h = (total[end] - total[start]) * _power("inverse", _P_INVERSE, len(raw))[start]
    return start, end, mix(h + (end - start).astype(np.uint64))


def word_hashes(
    column: pa.Array, is_word: np.ndarray, slice_bytes: int = SLICE_BYTES
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For runs of texts: first text, number of texts, word starts, ends, hashes, first word of each.

    Starts and ends are byte positions in the column's data. ``firsts`` has one entry
    more than the run has texts. A run holds about ``slice_bytes`` or one longer text, which
    is hashed piece by piece between words.
    """
    data, at = utf8(column)
    n = len(column)
    i = 0
    while i < n:
        j = int(np.searchsorted(at, at[i] + slice_bytes, "right")) - 1
        j = min(max(j, i + 1), n)
        starts, ends, hashes = [], [], []
        lo, stop = int(at[i]), int(at[j])
        while lo < stop:
            hi = min(lo + 2 * slice_bytes, stop)
            if hi < stop:  # within one long text: go back to the end of a word, or on to it
                spaces = np.flatnonzero(~is_word[_LOWER[data[lo:hi]]])
                while not len(spaces) and hi < stop:
                    more = min(hi + slice_bytes, stop)
                    spaces = np.flatnonzero(~is_word[_LOWER[data[hi:more]]]) + (hi - lo)
                    hi = more
                hi = lo + int(spaces[-1]) + 1 if len(spaces) else stop
            s, e, h = _hash_slice(data[lo:hi], at[i : j + 1] - lo, is_word)
            starts.append(s + lo)
            ends.append(e + lo)
            hashes.append(h)
            lo = hi
        join = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
        start = join(starts, np.int64)
        yield i, j - i, start, join(ends, np.int64), join(hashes, np.uint64), np.searchsorted(start, at[i : j + 1])
        i = j
