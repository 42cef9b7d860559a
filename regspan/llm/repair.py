"""Repair of the structure of conversations by a grammar-compressed dynamic program.

The turns of a conversation become a word over nine symbols: the initial of the role (system, user,
assistant, other) with or without a missing end, and one symbol for turns that have to go. The cheapest
edits into ``(s?(ua)+)?`` follow from one min-plus transfer matrix per symbol, over the four states of that
pattern; an entry holds the least cost from state to state and the edits that reach it. Re-Pair replaces
the pairs of symbols that recur in the conversations of a batch by rules. Each rule's matrix is the product
of its two parts' matrices, evaluated once, bottom-up, and shared by all conversations that use the rule; its
edits are ropes that point into the parts' ropes. A conversation's matrix is the product over its few
symbols left.

Products are associative, so long conversations are worked on in pieces of at most 4,096 turns that are then
multiplied together.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.sinks import keep

# Cost of the edits; a turn kept or given another role without its end costs INSERT more.
REROLE, DELETE, INSERT, OPEN_END = 3, 4, 3, 3
SPACES = " \t\n\x0b\x0c\r"
ENDS = ".!?"
LEGAL = ("su", "ua", "au")
# Turns of a piece are those whose place has the same bits above the lowest 12.
PIECE_BITS = 12
# Pieces of a conversation multiplied in one task.
MERGE_BITS = 6
# Rules a task remembers from earlier batches.
REMEMBER = 20_000

# States: 0 nothing yet, 1 after the system turn, 2 after a user turn, 3 after an assistant turn (0 and 3 may end).
NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}
# Fewest inserted turns from state to state.
INSERTED = {(i, i): 0 for i in range(4)} | {(0, 2): 1, (1, 2): 1, (3, 2): 1, (2, 3): 1, (0, 3): 2, (1, 3): 2}
SYMBOLS = "suaoSUAOX"


class Ropes:
    """Texts as leaves and joins of two; equal texts are told by length and fingerprint, without being written out."""

    _PRIME, _BASE = (1 << 61) - 1, 911_382_323_000_007

    def __init__(self) -> None:
        self.leaf: list[str | None] = []
        self.kids: list[tuple[int, int]] = []
        self.print: list[tuple[int, int, int]] = []  # length, fingerprint, base to the length
        self.known: dict[str | tuple[int, int], int] = {}

    def _add(self, key, leaf, kids, mark) -> int:
        self.known[key] = len(self.leaf)
        self.leaf.append(leaf)
        self.kids.append(kids)
        self.print.append(mark)
        return len(self.leaf) - 1

    def text(self, s: str) -> int:
        if s in self.known:
            return self.known[s]
        h = 0
        for c in s:
            h = (h * self._BASE + ord(c)) % self._PRIME
        return self._add(s, s, (0, 0), (len(s), h, pow(self._BASE, len(s), self._PRIME)))

    def join(self, a: int, b: int) -> int:
        (n, h, p), (m, g, q) = self.print[a], self.print[b]
        if not n or not m:
            return a if n else b
        if (a, b) in self.known:
            return self.known[a, b]
        return self._add((a, b), None, (a, b), (n + m, (h * q + g) % self._PRIME, p * q % self._PRIME))

    def less(self, a: int, b: int) -> bool:
        """Whether the text of ``a`` sorts before that of ``b``; only differing parts are opened."""
        left, right = [a], [b]
        while left and right:
            x, y = left.pop(), right.pop()
            if self.print[x][:2] == self.print[y][:2]:
                continue
            s, t = self.leaf[x], self.leaf[y]
            if s is not None and t is not None:
                n = min(len(s), len(t))
                if s[:n] != t[:n]:
                    return s < t
                left += [self.text(s[n:])] if len(s) > n else []
                right += [self.text(t[n:])] if len(t) > n else []
            elif t is not None or (s is None and self.print[x][0] >= self.print[y][0]):
                left += self.kids[x][::-1]
                right.append(y)
            else:
                left.append(x)
                right += self.kids[y][::-1]
        return bool(right)

    def write(self, a: int) -> str:
        out, todo = [], [a]
        while todo:
            x = todo.pop()
            if self.leaf[x] is not None:
                out.append(self.leaf[x])
            else:
                todo += self.kids[x][::-1]
        return "".join(out)


# A matrix lists, for each pair of states 4 * i + j, the least cost and the edits, or None.
def _product(a: list, b: list, join, less) -> list:
    out: list = [None] * 16
    for i in range(0, 16, 4):
        for k in range(4):
            x = a[i + k]
            if x is None:
                continue
            for j in range(4):
                y = b[4 * k + j]
                if y is None:
                    continue
                best, cost = out[i + j], x[0] + y[0]
                if best is None or cost < best[0]:
                    out[i + j] = (cost, join(x[1], y[1]))
                elif cost == best[0]:
                    edits = join(x[1], y[1])
                    if less(edits, best[1]):
                        out[i + j] = (cost, edits)
    return out


def _edits_of(symbol: str) -> list:
    """The matrix of one turn: insertions before it, then keep, rerole or delete."""
    out: list = [None] * 16

    def offer(i: int, j: int, cost: int, edits: str) -> None:
        if out[4 * i + j] is None or (cost, edits) < out[4 * i + j]:
            out[4 * i + j] = (cost, edits)

    for (i, k), n in INSERTED.items():
        offer(i, k, n * INSERT + DELETE, "I" * n + "D")
        if symbol == "X":
            continue
        extra = OPEN_END if symbol.isupper() else 0
        for (state, role), j in NEXT.items():
            if state == k and role == symbol.lower():
                offer(i, j, n * INSERT + extra, "I" * n + "K")
            if state == k and role != "s":
                offer(i, j, n * INSERT + REROLE + extra, "I" * n + "R")
    return out


def pair_up(words: list[np.ndarray], nodes: int, rules: dict[tuple[int, int], int]) -> tuple[list[np.ndarray], list[tuple[int, int]]]:
    """Re-Pair over all ``words``: pairs of symbols that recur become rules until none recurs.

    A round replaces the most frequent pair, and with it other pairs of at least half its count that share no
    symbol with those replaced before. Returns the shortened words and the pairs of the rules, new or
    already in ``rules``, in order of their making.
    """
    line = np.concatenate([np.append(w, -1) for w in words]) if words else np.zeros(0, np.int64)
    made: list[tuple[int, int]] = []
    while len(line) > 1:
        wide = nodes + len(rules) + 1
        whole = (line[:-1] >= 0) & (line[1:] >= 0)
        codes, counts = np.unique((line[:-1] * wide + line[1:])[whole], return_counts=True)
        if not len(codes) or counts.max() < 2:
            break
        order = np.lexsort((codes, -counts))
        used: set[int] = set()
        chosen: dict[int, int] = {}
        for c, n in zip(codes[order].tolist(), counts[order].tolist()):
            if 2 * n < counts.max() or n < 2:
                break
            a, b = divmod(c, wide)
            if used.isdisjoint((a, b)):
                used |= {a, b}
                chosen[c] = rules.setdefault((a, b), nodes + len(rules))
                made.append((a, b))
        pairs = np.where(whole, line[:-1] * wide + line[1:], -1)
        keys = np.array(sorted(chosen))
        at = np.minimum(np.searchsorted(keys, pairs), len(keys) - 1)
        hit = np.flatnonzero(keys[at] == pairs)
        # Within a row of equal symbols, every second pair: pairs of two symbols never overlap.
        start = np.ones(len(hit), bool)
        start[1:] = hit[1:] != hit[:-1] + 1
        run = np.maximum.accumulate(np.where(start, np.arange(len(hit)), 0))
        hit = hit[(np.arange(len(hit)) - run) % 2 == 0]
        line = line.copy()
        line[hit] = np.array([chosen[k] for k in keys.tolist()])[at[hit]]
        line = np.delete(line, hit + 1)
    cuts = np.flatnonzero(line < 0)
    return [line[a:b] for a, b in zip(np.append(0, cuts[:-1] + 1), cuts)], made


class Repairer:
    """Matrices of symbols, rules and words of symbols; rules are shared between all words and batches."""

    def __init__(self) -> None:
        self.ropes = Ropes()
        self.rules: dict[tuple[int, int], int] = {}
        self.matrix: dict[int, list] = {}
        for i, s in enumerate(SYMBOLS):
            self.matrix[i] = [e and (e[0], self.ropes.text(e[1])) for e in _edits_of(s)]

    def _times(self, a: list, b: list) -> list:
        return _product(a, b, self.ropes.join, self.ropes.less)

    def evaluate(self, words: list[str]) -> dict[str, list]:
        """The matrix of each word, edits written out."""
        distinct = sorted(set(words))
        code = {s: i for i, s in enumerate(SYMBOLS)}
        lines = [np.array([code[s] for s in w], np.int64) for w in distinct]
        short, made = pair_up(lines, len(SYMBOLS), self.rules)
        for a, b in made:  # parts come before the rules that use them
            node = self.rules[a, b]
            if node not in self.matrix:
                self.matrix[node] = self._times(self.matrix[a], self.matrix[b])
        out = {}
        for w, line in zip(distinct, short):
            total = self.matrix[int(line[0])]
            for node in line[1:].tolist():
                total = self._times(total, self.matrix[node])
            out[w] = [e and (e[0], self.ropes.write(e[1])) for e in total]
        return out


ENTRY = pa.struct([("cost", pa.int64()), ("audit", pa.string()), ("states", pa.string())])
PART = pa.struct([("first", pa.int64()), ("n", pa.int64())])
COUNTS = ["blank", "duplicate", "truncated", "illegal"]
PIECE = (
    "_first long, blank long, duplicate long, truncated long, illegal long, roles string, low long, high long, turns long,"
    " entries array<struct<cost:long,audit:string,states:string>>, parts array<struct<first:long,n:long>>"
)
PLAN = (
    "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string,"
    " parts array<struct<first:long,n:long,state:int,audit:string>>"
)


def _illegal(roles: str) -> int:
    return sum(roles[i : i + 2] not in LEGAL for i in range(len(roles) - 1))


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every piece with its matrix; ``roles`` becomes its first and last role."""
    repairer = Repairer()
    for batch in batches:
        if len(repairer.rules) > REMEMBER:
            repairer = Repairer()
        rows = batch.to_pydict()
        found = repairer.evaluate(rows["symbols"])
        counts = [[w.count(f) for w in rows["faults"]] for f in "bdt"]
        entries = [
            [e and {"cost": e[0], "audit": e[1], "states": str(k // 4)} for k, e in enumerate(found[w])]
            for w in rows["symbols"]
        ]
        parts = [[{"first": f, "n": len(w)}] for f, w in zip(rows["_first"], rows["roles"])]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("_conv"), batch.column("_first"), *[pa.array(c, pa.int64()) for c in counts],
                pa.array([_illegal(w) for w in rows["roles"]], pa.int64()),
                pa.array([w[0] + w[-1] for w in rows["roles"]], pa.string()),
                batch.column("low"), batch.column("high"), pa.array(rows["turns"], pa.int64()),
                pa.array(entries, pa.list_(ENTRY)), pa.array(parts, pa.list_(PART)),
            ],
            ["_conv", "_first", *COUNTS, "roles", "low", "high", "turns", "entries", "parts"],
        )


def _follow(a: dict, b: dict) -> dict:
    """Two adjacent pieces of one conversation as one."""
    join = lambda x, y: (x[0] + y[0], x[1] + y[1])
    less = lambda x, y: x[0] < y[0]
    pairs = [[e and (e["cost"], (e["audit"], e["states"])) for e in piece["entries"]] for piece in (a, b)]
    total = _product(*pairs, join, less)
    both = {f: a[f] + b[f] for f in (*COUNTS, "turns")}
    both["illegal"] += a["roles"][-1] + b["roles"][0] not in LEGAL
    both["turns"] -= a["high"] is not None and a["high"] == b["low"]
    return both | {
        "_first": a["_first"],
        "roles": a["roles"][0] + b["roles"][-1],
        "low": b["low"] if a["low"] is None else a["low"],
        "high": a["high"] if b["high"] is None else b["high"],
        "entries": [e and {"cost": e[0], "audit": e[1][0], "states": e[1][1]} for e in total],
        "parts": a["parts"] + b["parts"],
    }


def _whole(pieces: list[dict]) -> dict:
    total = pieces[0]
    for piece in pieces[1:]:
        total = _follow(total, piece)
    return total


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = [_whole(p) for p in batch.column("pieces").to_pylist()]
        kind = batch.schema.field("pieces").type.value_type
        merged = pa.array(out, kind)
        yield pa.RecordBatch.from_arrays(
            [batch.column("_conv"), *merged.flatten()], ["_conv", *[kind.field(i).name for i in range(kind.num_fields)]]
        )


def _finish(piece: dict) -> dict:
    """Ends the cheapest way and cuts the edits into those of each part."""
    ways = []
    for j, n in ((0, 0), (1, 2), (2, 1), (3, 0)):
        e = piece["entries"][j]
        if e:
            ways.append((e["cost"] + n * INSERT, e["audit"] + "I" * n, e["states"]))
    cost, audit, states = min(ways)
    turns = np.flatnonzero(np.frombuffer(audit.encode(), np.uint8) != ord("I")) + 1
    parts, at, done = [], 0, 0
    for part, state in zip(piece["parts"], states):
        done += part["n"]
        stop = int(turns[done - 1]) if part is not piece["parts"][-1] else len(audit)
        parts.append({**part, "state": int(state), "audit": audit[at:stop]})
        at = stop
    gaps = piece["high"] - piece["low"] + 1 - piece["turns"] if piece["low"] is not None else 0
    told = {f: piece[f] for f in COUNTS}
    return told | {"gaps": min(gaps, (1 << 63) - 1), "cost": cost, "audit": audit, "parts": parts}


def _plan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.struct([
        ("gaps", pa.int64()), *[(f, pa.int64()) for f in COUNTS], ("cost", pa.int64()), ("audit", pa.string()),
        ("parts", pa.list_(pa.struct([("first", pa.int64()), ("n", pa.int64()), ("state", pa.int32()), ("audit", pa.string())]))),
    ])
    for batch in batches:
        out = pa.array([_finish(_whole(p)) for p in batch.column("pieces").to_pylist()], kind)
        names = [kind.field(i).name for i in range(kind.num_fields)]
        yield pa.RecordBatch.from_arrays([batch.column("_conv"), *out.flatten()], ["_conv", *names])


def lines_of(rows: Iterator[tuple]) -> Iterator[tuple]:
    """(conversation, place, number, role, text) of every repaired turn, in order.

    ``rows`` are (conversation, place, kind, role, text, state, edits) in order. Kind 0 brings the edits of a piece, kind 1
    a turn of it; kind -1 stands before a conversation and is passed on without a place.
    """
    conv, place, n, edits, at, state = None, 0, 0, "", 0, 0
    for new, where, kind, role, text, start, audit in rows:
        if kind == 1 and where != place:
            place, n = where, 0
        while at < len(edits) and edits[at] == "I":  # before this turn, or left at the end of a piece
            own, state = ("assistant", 3) if state == 2 else ("user", 2)
            at, n = at + 1, n + 1
            yield conv, place, n, own, ""
        if kind == -1:
            edits, at = "", 0
            yield new, None, 0, None, None
        elif kind == 0:
            conv, place, n, edits, at, state = new, where, 0, audit, 0, start
        else:
            edit, at = edits[at], at + 1
            if edit != "D":
                if edit == "R":
                    role = "assistant" if state == 2 else "user"
                state, n = NEXT[state, role[0]], n + 1
                yield conv, place, n, role, text
    while at < len(edits):
        own, state = ("assistant", 3) if state == 2 else ("user", 2)
        at, n = at + 1, n + 1
        yield conv, place, n, own, ""


INPUT = ["_conv", "_at", "_kind", "role", "text", "state", "audit"]


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[batch.column(c).to_pylist() for c in INPUT])


def _written(rows: Iterator[tuple], schema: pa.Schema, weight) -> Iterator[pa.RecordBatch]:
    """Rows in batches of a few MB."""
    waiting, size = [], 0
    for row in rows:
        waiting.append(row)
        size += weight(row)
        if size > 1 << 22:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*waiting), schema)], schema=schema)
            waiting, size = [], 0
    if waiting:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*waiting), schema)], schema=schema)


def _turns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    first = next(batches, None)
    if first is None:
        return
    kinds = [first.schema.field("_conv").type, pa.int64(), pa.int32(), pa.string(), pa.string()]
    schema = pa.schema(list(zip(["_conv", "_at", "_n", "role", "text"], kinds)))
    rows = lines_of(_stream(_chained(first, batches)))
    yield from _written(rows, schema, lambda r: 50 + len(r[4]))


def _chained(first, rest):
    yield first
    yield from rest


def _hashed(lines: Iterator[tuple]) -> Iterator[tuple]:
    """(conversation, digest) for every row of kind -1 and the turns behind it; nothing is held but the digest."""
    digest, current, empty = None, None, True
    for conv, place, _, role, text in lines:
        if place is None:
            if digest is not None:
                yield current, digest.hexdigest()
            digest, current, empty = hashlib.sha256(), conv, True
        else:
            digest.update(f"{'' if empty else chr(10)}{role}:{text}".encode())
            empty = False
    if digest is not None:
        yield current, digest.hexdigest()


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    first = next(batches, None)
    if first is None:
        return
    schema = pa.schema([("_conv", first.schema.field("_conv").type), ("sha256", pa.string())])
    yield from _written(_hashed(lines_of(_stream(_chained(first, batches)))), schema, lambda r: 100)


@dataclass
class Repair:
    """What ``repair`` found: ``plan`` has one row per conversation, ``rows`` its turns in order, both written."""

    rows: DataFrame
    plan: DataFrame
    id: str

    def summary(self) -> DataFrame:
        """One row per conversation with turns: counts of faults, cost and edits."""
        return self.plan.select(
            F.col("_conv").alias(self.id), "gaps", *COUNTS, "cost", "audit"
        )

    def _dealt(self, marks: DataFrame | None, *by: Column) -> DataFrame:
        """Turns and edits of a piece (or, with ``marks``, of a conversation) in one task, in order."""
        nothing = [F.lit(None).cast(t).alias(c) for c, t in (("role", "string"), ("text", "string"), ("state", "int"), ("audit", "string"))]
        turns = self.rows.select("_conv", "_at", F.lit(1).alias("_kind"), "role", "text", *nothing[2:])
        edits = self.plan.select("_conv", F.explode("parts").alias("p")).select(
            "_conv", F.col("p.first").alias("_at"), F.lit(0).alias("_kind"), *nothing[:2], "p.state", "p.audit"
        )
        both = turns.unionByName(edits)
        if marks is not None:
            both = both.unionByName(marks.select("_conv", F.lit(-1).cast("long").alias("_at"), F.lit(-1).alias("_kind"), *nothing))
        return both.repartition(*by).sortWithinPartitions("_conv", "_at", "_kind")

    def _kind(self) -> str:
        return self.rows.schema["_conv"].dataType.simpleString()

    def turns(self) -> DataFrame:
        """Every repaired turn with its conversation; ``place`` and ``number`` give the order.

        Dealt by piece, so a conversation of any length is spread over tasks.
        """
        dealt = self._dealt(None, F.col("_conv"), F.shiftright("_at", PIECE_BITS))
        found = dealt.mapInArrow(_turns, f"_conv {self._kind()}, _at long, _n int, role string, text string")
        return found.toDF(self.id, "place", "number", "role", "text")

    def digests(self, ids: DataFrame) -> DataFrame:
        """The digest of the repaired ``role:text`` lines of each conversation of ``ids`` (distinct), joined by newlines.

        A digest reads its conversation in order, so a conversation passes through one task, which
        holds only the digest and a batch of rows.
        """
        marks = ids.select(F.col(f"`{self.id}`").alias("_conv"))
        found = self._dealt(marks, F.col("_conv")).mapInArrow(_digests, f"_conv {self._kind()}, sha256 string")
        return found.toDF(self.id, "repaired_sha256")


def ordered(turns: DataFrame, id: str, turn: str, role: str, text: str) -> DataFrame:
    """All turns by conversation and turn, with ``_at`` rising in that order, and what tells their faults; written.

    The table is sorted as a whole, so that a long conversation lies in several tasks' files.
    """
    clean = F.rtrim(F.col("text"), F.lit(SPACES))
    initial = F.substring("role", 1, 1)
    rows = turns.select(
        F.col(f"`{id}`").alias("_conv"), F.col(f"`{turn}`").cast("long").alias("_turn"),
        F.coalesce(F.col(f"`{role}`"), F.lit(" ")).alias("role"), F.coalesce(F.col(f"`{text}`"), F.lit(" ")).alias("text"),
    ).orderBy("_conv", F.col("_turn").asc_nulls_first(), "role", "text")
    return keep(
        rows.select(
            "_conv", "_turn", "role", "text",
            F.monotonically_increasing_id().alias("_at"),
            F.when(initial.isin("s", "u", "a"), initial).otherwise("o").alias("_role"),
            (clean == "").alias("_blank"),
            (~F.substring(clean, -1, 1).isin(*ENDS)).alias("_open"),
            F.xxhash64("role", "text").alias("_hash"),
            F.crc32(F.concat("role", F.lit(":"), "text").cast("binary")).alias("_crc"),
            F.octet_length("text").alias("_size"),
        ),
        "turns",
    )


def pieces(rows: DataFrame) -> DataFrame:
    """Faults and symbols of all turns, and the matrix of each piece of a conversation.

    A turn repeats an earlier one if it is not the first of its conversation, role and text (told by 96 bits
    of hashes and the length). First turns are found by a partial aggregate and met again by place, a
    key without repeats, so no turn or conversation can be too frequent.
    """
    narrow = rows.select("_conv", "_turn", "_at", "_role", "_blank", "_open", "_hash", "_crc", "_size")
    firsts = narrow.where(~F.col("_blank")).groupBy("_conv", "_hash", "_crc", "_size").agg(F.min("_at").alias("_at"))
    marked = narrow.join(firsts.select("_at", F.lit(True).alias("_new")), "_at", "left")
    fault = F.expr("CASE WHEN _blank THEN 'b' WHEN _new IS NULL THEN 'd' WHEN _open THEN 't' ELSE 'k' END")
    symbol = F.expr("CASE WHEN _fault IN ('b', 'd') THEN 'X' WHEN _fault = 't' THEN upper(_role) ELSE _role END")
    told = marked.withColumn("_fault", fault).withColumn("_symbol", symbol)
    grouped = told.groupBy("_conv", F.shiftright("_at", PIECE_BITS).alias("_piece")).agg(
        F.sort_array(F.collect_list(F.struct("_at", "_turn", "_role", "_fault", "_symbol"))).alias("t")
    )
    shown = grouped.select(
        "_conv",
        F.expr("t[0]._at AS _first"),
        *[F.expr(f"array_join(transform(t, x -> x.{c}), '') AS {n}") for c, n in
          (("_symbol", "symbols"), ("_role", "roles"), ("_fault", "faults"))],
        F.expr("array_min(transform(t, x -> x._turn)) AS low"),
        F.expr("array_max(transform(t, x -> x._turn)) AS high"),
        F.expr("size(array_distinct(filter(transform(t, x -> x._turn), x -> x IS NOT NULL))) AS turns"),
    )
    kind = rows.schema["_conv"].dataType.simpleString()
    return shown.mapInArrow(_pieces, f"_conv {kind}, {PIECE}")


def repair(turns: DataFrame, id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> Repair:
    """The cheapest edits that bring each conversation's roles into ``(s?(ua)+)?``.

    A turn's first fault counts: blank (no visible character), duplicate (role and text of an earlier turn), truncated
    (the last visible character is none of ``.!?``). Blank and duplicate turns are deleted (4); any other
    turn is kept (0), deleted (4) or given the role user or assistant (3), and costs 3 more if it stays truncated;
    empty turns of user or assistant are inserted (3). Of equally cheap edits the least in order of
    their initials D, I, K, R wins. ``gaps`` counts the turn numbers missing between the least and the greatest;
    ``illegal`` the adjacent roles that are not system-user, user-assistant or assistant-user, before any edit.

    Null roles and texts are one space, so such turns are blank or of no known role; roles are known by their
    initial. Turns without a number come first; equal numbers are in order of role, then text; repeated rows are duplicates. A null
    conversation id is one conversation. Columns other than the four are ignored; an empty table gives no rows.

    Conversations are sorted, marked and evaluated in pieces of up to 4,096 turns and merged 64 pieces at a
    time, so no task sees a long conversation whole; its edits, a byte or two a turn, are in the end one row.
    """
    rows = ordered(turns, id, turn, role, text)
    found = keep(pieces(rows), "pieces")
    kind = rows.schema["_conv"].dataType.simpleString()
    packed = F.sort_array(F.collect_list(F.struct(*[c for c in found.columns if c != "_conv"]))).alias("pieces")
    bits = PIECE_BITS
    while (found.groupBy("_conv").count().agg(F.max("count")).first()[0] or 0) > 1 << MERGE_BITS:
        bits += MERGE_BITS
        group = found.groupBy("_conv", F.shiftright("_first", bits).alias("_piece")).agg(packed)
        found = keep(group.select("_conv", "pieces").mapInArrow(_merge, f"_conv {kind}, {PIECE}"), "pieces")
    plan = found.groupBy("_conv").agg(packed).mapInArrow(_plan, f"_conv {kind}, {PLAN}")
    return Repair(rows, keep(plan, "repairs"), id)
