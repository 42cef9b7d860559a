"""Token counts of whole texts; huge ones by overlapping chunks that are spliced where they agree."""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import without

# Characters of a chunk, and of the overlap of two chunks to begin with.
CHUNK, OVERLAP = 32_768, 512
# Characters encoded in one call.
CALL = 1 << 20
# A Python worker remembers the counts of pieces up to so many characters, and of these so many bytes in all.
LONGEST = 64
REMEMBERED = 1 << 27
# Bytes of a remembered piece besides its characters: object headers, the count and the table's entry.
ENTRY = 160


# Before a space or line end, behind anything but white space, a byte-level BPE pre-tokenizer (see ``cuts_hold``) always
# cuts: no alternative of its pattern continues over that place, and what follows does not look back.
_CUT = re.compile(r"(?<=\S)(?=[ \n])")


def stable(text: str, p: int) -> bool:
    return 0 < p < len(text) and text[p] in " \n" and not text[p - 1].isspace()


class Piece:
    """The tokens of ``text[start:stop]`` with their places in the whole text."""

    def __init__(self, tokenizer, text: str, start: int, stop: int):
        self.found = tokenizer.encode(text[start:stop], add_special_tokens=False)
        self.start, self.stop = start, stop

    def __len__(self) -> int:
        return len(self.found)

    def upto(self, p: int) -> int | None:
        """Tokens before ``p``, if the character before it ends a token."""
        i = self.found.char_to_token(p - 1 - self.start)
        if i is None:
            return None
        while i + 1 < len(self) and self.found.token_to_chars(i + 1)[1] <= p - self.start:
            i += 1  # a character may be made of several tokens
        return i + 1 if self.found.token_to_chars(i)[1] == p - self.start else None


def splice(text: str, left: Piece, right: Piece) -> int | None:
    """A stable place in the overlap from which both pieces have the same tokens, up to another one."""
    places = [p for p in range(right.start + 1, left.stop) if stable(text, p)]
    if len(places) < 2:
        return None
    first, last = places[0], places[-1]
    cut = [piece.upto(p) for piece in (left, right) for p in (first, last)]
    if None in cut or left.found.ids[cut[0] : cut[1]] != right.found.ids[cut[2] : cut[3]]:
        return None
    return first


def count_long(tokenizer, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
    """Tokens of the whole text from overlapping pieces.

    If two pieces do not align, the overlap is doubled; past a chunk's length the left piece is
    made longer instead, at last to the end of the text.
    """
    total, done, width = 0, 0, overlap
    left = Piece(tokenizer, text, 0, min(chunk, len(text)))
    while left.stop < len(text):
        begin = left.stop - width
        if begin <= max(left.start, done):
            grown = min(left.stop + (left.stop - left.start), len(text))
            left, width = Piece(tokenizer, text, left.start, grown), overlap
            continue
        right = Piece(tokenizer, text, begin, min(begin + max(chunk, 2 * width), len(text)))
        p = splice(text, left, right)
        if p is None or p <= done:
            width *= 2
            continue
        total += left.upto(p) - (left.upto(done) if done else 0)
        left, done, width = right, p, overlap
    return total + len(left) - (left.upto(done) if done else 0)


class Counter:
    """Token counts of short texts: the sum over their pieces between cuts.

    Counts of short pieces are remembered, within ``most`` bytes; new pieces are encoded together,
    since each begins at a cut, and told apart by the tokens' places. Long pieces, which hardly
    recur, are counted anew each time.
    """

    def __init__(self, tokenizer, most: int = REMEMBERED, longest: int = LONGEST):
        self.tokenizer, self.most, self.longest = tokenizer, most, longest
        self.known: dict[str, int] = {"": 0}
        self.size = 0
        self.cuts = cuts_hold(tokenizer)

    def learn(self, pieces: set[str]) -> dict[str, int]:
        """The counts of pieces."""
        out: dict[str, int] = {}
        alone = [p for p in pieces if p[0] not in " \n"]  # beginnings of texts
        for p, found in zip(alone, self.tokenizer.encode_batch_fast(alone, add_special_tokens=False)):
            out[p] = len(found)
        together = [p for p in pieces if p[0] in " \n" and not p[-1].isspace()]
        if together:
            found = self.tokenizer.encode("".join(together), add_special_tokens=False)
            ends = np.array([b for _, b in found.offsets])
            stops = np.cumsum([len(p) for p in together])
            counts = np.diff(np.searchsorted(ends, stops, "right"), prepend=0)
            out.update(zip(together, counts.tolist()))
        last = [p for p in pieces if p[0] in " \n" and p[-1].isspace()]  # ends of texts
        for p, found in zip(last, self.tokenizer.encode_batch_fast(last, add_special_tokens=False)):
            out[p] = len(found)
        return out

    def counts(self, texts: list[str]) -> list[int]:
        parts = [_CUT.split(t) for t in texts]
        if self.size > self.most:
            self.known, self.size = {"": 0}, 0
        new = {p for ps in parts for p in ps if p not in self.known}
        passing: dict[str, int] = {}
        if new:
            for p, n in self.learn(new).items():
                if len(p) <= self.longest:
                    self.known[p] = n
                    self.size += 4 * len(p) + ENTRY
                else:
                    passing[p] = n
        known = self.known
        if not passing:
            return [sum(map(known.__getitem__, ps)) for ps in parts]
        return [sum(known[p] if p in known else passing[p] for p in ps) for ps in parts]


def cuts_hold(tokenizer) -> bool:
    """Whether a tokenizer file cuts texts before spaces and line ends whatever surrounds them, as ``stable`` assumes.

    True for a byte-level pre-tokenizer with the pattern this was shown for, without a normaliser and without
    tokens added to the vocabulary that hold white space or take what is around them.
    """
    spec = json.loads(tokenizer.to_str())
    before = spec.get("pre_tokenizer") or {}
    added = spec.get("added_tokens") or []
    return (
        before.get("type") == "ByteLevel"
        and before.get("use_regex", True)
        and not before.get("add_prefix_space", True)
        and spec.get("normalizer") is None
        and not any(t.get("lstrip") or t.get("rstrip") or re.search(r"\s", t["content"]) for t in added)
    )


_loaded: dict[str, Counter] = {}


def _counter(name: str, content: str) -> Counter:
    if name not in _loaded:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        _loaded.clear()
        tokenizer = Tokenizer.from_str(content)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        _loaded[name] = Counter(tokenizer)
    return _loaded[name]


def _count(
    batches: Iterator[pa.RecordBatch], name: str, content, text: str, columns: Sequence[str], chunk: int, overlap: int
) -> Iterator[pa.RecordBatch]:
    counter = _counter(name, content.value)
    for batch in batches:
        column = batch.column(text)
        counts = np.zeros(len(batch), np.int64)
        waiting: list[int] = []
        texts: list[str] = []
        size = 0
        for i in range(len(batch)):
            value = column[i].as_py() or ""
            if not counter.cuts:
                counts[i] = len(counter.tokenizer.encode(value, add_special_tokens=False))
                continue
            if len(value) > chunk:
                counts[i] = count_long(counter.tokenizer, value, chunk, overlap)
                continue
            waiting.append(i)
            texts.append(value)
            size += len(value)
            if size > CALL:
                counts[waiting] = counter.counts(texts)
                waiting, texts, size = [], [], 0
        if waiting:
            counts[waiting] = counter.counts(texts)
        carried = [batch.column(c) for c in columns]
        yield pa.RecordBatch.from_arrays([*carried, pa.array(counts)], [*columns, "_tokens"])


def count_tokens(
    docs: DataFrame, tokenizer: str, text: str = "text", columns: Sequence[str] | None = None,
    chunk: int = CHUNK, overlap: int = OVERLAP,
) -> DataFrame:
    """``docs`` (or some ``columns``) with ``n_bytes`` (UTF-8) and ``n_tokens``.

    ``tokenizer`` is the path of a file of the library tokenizers, read on the driver
    and sent to the tasks (a few MB). Texts are cut and spliced if it is byte-level with the usual pattern, for which
    the places are known where no token can cross; with any other file each text is encoded whole. Counts are those of the whole text without begin, end or
    added special tokens; strings of special tokens inside a text are handled as the library does
    by default. A null text is empty and has none; an empty table gives an empty result; repeated
    rows are counted each. Input columns of the new names are replaced. Rows are counted where they
    are read: no shuffle, and memory bounded by a chunk besides the row itself, unless a text has no
    certain cut in it.
    """
    with open(tokenizer, encoding="utf-8") as file:
        content = file.read()
    shared = docs.sparkSession.sparkContext.broadcast(content)
    kept = [c for c in (columns or docs.columns) if c.lower() not in ("n_bytes", "n_tokens")]
    rows = docs.select(*kept, *([] if text in kept else [text]))
    bytes_ = F.octet_length(F.coalesce(F.col(text), F.lit(""))).cast("long")
    rows = without(rows, ["_bytes"]).withColumn("_bytes", bytes_)
    kept = [c for c in kept if c in rows.columns]
    carried = [*kept, "_bytes"]
    schema = "".join(f"`{c}` {rows.schema[c].dataType.simpleString()}, " for c in carried) + "_tokens long"
    found = rows.mapInArrow(lambda it: _count(it, tokenizer, shared, text, carried, chunk, overlap), schema)
    return found.select(*kept, F.col("_bytes").alias("n_bytes"), F.col("_tokens").alias("n_tokens"))
