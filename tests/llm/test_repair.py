"""Conversation repair against a plain row-by-row program, and that against all edits."""

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest

from regspan.llm import repair as module
from regspan.llm.queries import QUERIES
from regspan.llm.repair import Repairer, Ropes, lines_of, pair_up, repair

PATTERN = re.compile(r"(s?(ua)+)?")


def faults(rows):
    out, seen = [], set()
    for role, text in rows:
        clean = text.strip(" \t\n\x0b\x0c\r")
        out.append("b" if not clean else "d" if (role, text) in seen else "k" if clean[-1] in ".!?" else "t")
        seen.add((role, text))
    return out


def plain(rows):
    """Least (cost, edits) and the lines they give, row by row over what was written last."""
    states = {"": (0, "", [])}

    def follow(before):
        return "us" if before == "" else "a" if before == "u" else "u"

    def offer(to, state, way):
        if state not in to or way[:2] < to[state][:2]:
            to[state] = way

    def with_inserts(states):
        todo, out = list(states.items()), {}
        while todo:
            state, (c, a, t) = todo.pop()
            if state in out and out[state][:2] <= (c, a):
                continue
            out[state] = (c, a, t)
            for role in follow(state):
                if role != "s":
                    name = {"u": "user", "a": "assistant"}[role]
                    todo.append((role, (c + 3, a + "I", [*t, name + ":"])))
        return out

    for (role, text), fault in zip(rows, faults(rows)):
        new = {}
        for state, (c, a, t) in with_inserts(states).items():
            offer(new, state, (c + 4, a + "D", t))
            if fault in "bd":
                continue
            extra = 3 * (fault == "t")
            if role[:1] and role[0] in follow(state):
                offer(new, role[0], (c + extra, a + "K", [*t, f"{role}:{text}"]))
            for name in ("user", "assistant"):
                if name[0] in follow(state):
                    offer(new, name[0], (c + 3 + extra, a + "R", [*t, f"{name}:{text}"]))
        states = new
    ends = with_inserts(states)
    return min((ends[s] for s in ("", "a") if s in ends), key=lambda w: w[:2])


def all_edits(rows, longest=3):
    """The same by trying every list of edits with up to ``longest`` insertions at a place."""
    marks = faults(rows)
    best = None
    for inserts in itertools.product(range(longest), repeat=len(rows) + 1):
        for names in itertools.product(("user", "assistant"), repeat=sum(inserts)):
            for edits in itertools.product("DKR", repeat=len(rows)):
                if any(f in "bd" and e != "D" for f, e in zip(marks, edits)):
                    continue
                for roles in itertools.product(("user", "assistant"), repeat=edits.count("R")):
                    r, n = iter(roles), iter(names)
                    cost, audit, out = 0, "", []
                    for k in range(len(rows) + 1):
                        for _ in range(inserts[k]):
                            cost, audit, out = cost + 3, audit + "I", [*out, next(n) + ":"]
                        if k == len(rows):
                            break
                        e, extra = edits[k], 3 * (marks[k] == "t")
                        audit += e
                        if e == "D":
                            cost += 4
                        else:
                            role = rows[k][0] if e == "K" else next(r)
                            cost, out = cost + extra + 3 * (e == "R"), [*out, f"{role}:{rows[k][1]}"]
                    if PATTERN.fullmatch("".join(o[0] for o in out)) and (best is None or (cost, audit) < best[:2]):
                        best = (cost, audit, out)
    return best


def rows_of(rng, n):
    roles = ["system", "user", "assistant", "tool", "user", "assistant"]
    return [(rng.choice(roles), rng.choice(["", "one.", "two!", "open end", "three?"])) for _ in range(n)]


def expected(rows, turns):
    """The columns of the query from (turn, role, text) in order."""
    pairs = [r[0][:1] + s[0][:1] for r, s in zip(rows, rows[1:])]
    cost, audit, lines = plain(rows)
    known = [t for t in turns if t is not None]
    gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
    f = faults(rows)
    illegal = sum(p not in ("su", "ua", "au") for p in pairs)
    digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return gaps, f.count("b"), f.count("d"), f.count("t"), illegal, cost, audit, digest


def test_plain_program_tries_enough():
    rng = random.Random(1)
    for n in (0, 1, 2, 2, 3, 3):
        rows = rows_of(rng, n)
        assert plain(rows)[:2] == all_edits(rows, 3 if n < 3 else 2)[:2]


def test_pairs_become_rules():
    words = [np.array([0, 1] * 8), np.array([2, 0, 1, 0, 1]), np.array([5] * 9), np.array([7])]
    rules = {}
    short, made = pair_up(words, 9, rules)
    back = {v: k for k, v in rules.items()}

    def spell(node):
        return [node] if node < 9 else spell(back[node][0]) + spell(back[node][1])

    for w, s in zip(words, short):
        assert [x for node in s.tolist() for x in spell(node)] == w.tolist() and len(s) <= len(w)
    line = [p for s in short for p in zip(s.tolist(), s.tolist()[1:])]
    assert len(line) == len(set(line)) and (0, 1) in made and len(short[0]) <= 2


def test_ropes_sort_like_their_texts():
    rng = random.Random(2)
    ropes = Ropes()
    nodes = {t: ropes.text(t) for t in ("D", "K", "IK", "IIR", "R")}
    for _ in range(300):
        a, b = rng.choice(sorted(nodes)), rng.choice(sorted(nodes))
        nodes[a + b] = ropes.join(nodes[a], nodes[b])
    texts = sorted(nodes)
    for _ in range(2000):
        a, b = rng.choice(texts), rng.choice(texts)
        assert ropes.less(nodes[a], nodes[b]) == (a < b) and ropes.write(nodes[a]) == a


def test_shared_rules_give_the_plain_result():
    rng = random.Random(3)
    repairer = Repairer()
    for _ in range(4):
        cases = [rows_of(rng, rng.randrange(1, 14)) for _ in range(60)] + [[("user", f"{i}.") for i in range(200)]]
        words = []
        for rows in cases:
            initial = [r[0] if r[0] in "sua" else "o" for r, _ in rows]
            words.append("".join("X" if f in "bd" else i.upper() if f == "t" else i for i, f in zip(initial, faults(rows))))
        found = repairer.evaluate(words)
        for rows, w in zip(cases, words):
            ends = [(e[0] + 3 * n, e[1] + "I" * n) for e, n in zip(found[w][:4], (0, 2, 1, 0)) if e]
            assert min(ends) == plain(rows)[:2]
    assert len(repairer.rules) > 20


def frame(spark, conversations):
    rows = [(c, t, r, x) for c, turns in conversations.items() for t, r, x in turns]
    random.Random(5).shuffle(rows)
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)


@pytest.mark.parametrize("bits, merge", [(12, 6), (2, 1)])
def test_pieces_of_conversations(spark, monkeypatch, bits, merge):
    monkeypatch.setattr(module, "PIECE_BITS", bits)
    monkeypatch.setattr(module, "MERGE_BITS", merge)
    rng = random.Random(bits)
    conversations = {c: [(t, *r) for t, r in enumerate(rows_of(rng, rng.randrange(1, 30)))] for c in range(25)}
    conversations[99] = [(t // 2 * 3, *r) for t, r in enumerate(sorted(rows_of(rng, 70)))]
    conversations[99].sort()
    conversations[100] = [(None, "user", "a."), (None, "user", "b."), (-4, "assistant", "c."), (7, "tool", "d.")]
    turns = frame(spark, conversations)
    found = repair(turns)
    summary = {r.conv_id: tuple(r)[1:] for r in found.summary().collect()}
    digests = {r.conv_id: r.repaired_sha256 for r in found.digests(turns.select("conv_id").distinct()).collect()}
    lines = {}
    for r in found.turns().orderBy("conv_id", "place", "number").collect():
        lines.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    for c, rows in conversations.items():
        want = expected([(r, x) for _, r, x in rows], [t for t, _, _ in rows])
        assert (*summary[c], digests[c]) == want
        assert hashlib.sha256("\n".join(lines.get(c, [])).encode()).hexdigest() == want[-1]


def test_query_by_brute_force(spark, tmp_path):
    rng = random.Random(7)
    rows = []
    for c in [*range(150), None]:
        for t in range(rng.randrange(1, 9)):
            role = ["system", "user", "assistant"][(t + 1) % 3 if rng.random() < 0.2 else 1 + t % 2]
            rows.append((c, t if rng.random() < 0.95 else None, role if rng.random() < 0.97 else None, rng.choice(["a. b", "x!", None, "yes?", f"{t}.", " . "])))
    rows = list({(r[0], r[1]): r for r in rows}.values())
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    kept = {}
    for c, t, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or " ", r[3] or " ")):
        kept.setdefault(c, [])
        role, text = " " if role is None else role, " " if text is None else text
        show = lambda v: " " if v is None else str(v)
        d = zlib.crc32(f"{show(c)}:{show(t)}".encode()) % 20
        text = "" if d == 1 else re.sub("[.!?]", "", text) if d == 2 else text
        kept[c] += [(t, "user" if d == 4 else role, text)] * (0 if d == 0 else 2 if d == 3 else 1)
    empty = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    got = QUERIES["op13_repair"](spark, str(tmp_path)).collect()
    assert len(got) == len(kept) and {r.conv_id for r in got} == set(kept)
    for r in got:
        v = kept[r.conv_id]
        assert tuple(r)[1:] == (expected([(a, b) for _, a, b in v], [t for t, _, _ in v]) if v else empty)


def test_empty_table_and_other_columns(spark):
    turns = spark.createDataFrame([], "conv_id long, turn int, role string, text string, _conv string, audit int")
    found = repair(turns)
    assert found.summary().collect() == [] == found.turns().collect()
    assert found.digests(turns.select("conv_id").distinct()).collect() == []
    one = spark.createDataFrame([("c", 1, "user", "Hi.", "x", 2)], "conv_id string, turn int, role string, text string, _conv string, audit int")
    assert [tuple(r) for r in repair(one).turns().collect()][0][3:] == ("user", "Hi.")
    assert tuple(repair(one).summary().first()) == ("c", 0, 0, 0, 0, 0, 3, "KI")


def test_lines_of_a_conversation_without_edits():
    assert list(lines_of(iter([(5, -1, -1, None, None, None, None)]))) == [(5, None, 0, None, None)]
