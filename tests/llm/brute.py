"""Plain Python versions of the operators, for small fixtures."""

import base64
import hashlib
import re
from collections import Counter, defaultdict

LOWER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def alphanumeric(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def shingles(text, width):
    w = words((text or "").translate(LOWER))
    if len(w) < width:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)}


def components(rows, width, percent=80):
    """Least id reachable of each row (id, text), by all pairs."""
    sets = [shingles(t, width) for _, t in rows]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                up[root(i)] = root(j)
    ids = defaultdict(list)
    for i, (id, _) in enumerate(rows):
        if id is not None:
            ids[root(i)].append(id)
    return [min(ids[root(i)], default=None) if sets[i] else rows[i][0] for i in range(len(rows))], [len(s) for s in sets]


def passages(text, items, n=13):
    w = alphanumeric(text)
    covered, found = set(), set()
    for id, other in items:
        o = alphanumeric(other)
        size = min(n, len(o))
        for i in range(len(o) - size + 1 if size else 0):
            for p in range(len(w) - size + 1):
                if w[p : p + size] == o[i : i + size]:
                    covered.update(range(p, p + size))
                    if id is not None:
                        found.add(id)
    return len(w), len(covered), found, bool(covered) and 20 * len(covered) >= len(w)


def measures(text):
    text = text or ""
    w = words(text)
    triples = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    counts = Counter(triples)
    repeated = {i + k for i, t in enumerate(triples) if counts[t] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    return {
        "n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_dup_lines": dup, "n_repeat_words": len(repeated), "n_upper": len(re.findall("[A-Z]", text)),
    }


def fails_rules(text):
    m = measures(text)
    n = m["n_words"]
    return (
        n < 50 or 100 * m["n_repeat_words"] > 50 * n or 100 * m["n_symbols"] > 25 * n or m["word_chars"] < 2 * n
        or m["word_chars"] > 25 * n or 2 * m["n_dup_lines"] > n or 100 * m["n_upper"] > 30 * m["word_chars"]
    )


def targets(sizes, weights=(5, 2, 1), most=3):
    """Water filling by rounds: sizes by source, sorted by name."""
    names = sorted(sizes, key=lambda s: (s is None, s))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        left = total - sum(most * sizes[s] for s in full)
        weight = sum(w[s] for s in names if s not in full)
        target = {s: most * sizes[s] if s in full else left * w[s] / weight for s in names}
        above = {s for s in names if s not in full and target[s] > most * sizes[s] + 1e-9}
        if not above:
            return target
        full |= above


def maximal(turns):
    """Ids of conversations that are no proper beginning of another; the least of equal ones."""
    seqs = defaultdict(set)
    for conv, turn, role, text in turns:
        seqs[conv].add((turn, role, text))
    key = lambda t: (t[0] is not None, t[0] or 0, t[1] or "", t[2] or "")
    seqs = {c: tuple(sorted(s, key=key)) for c, s in seqs.items()}
    whole = {}
    for c, s in seqs.items():
        if s not in whole or whole[s] is None or (c is not None and c < whole[s]):
            whole[s] = c
    # A beginning ends between two turn numbers.
    begun = {s[:k] for s in whole for k in range(1, len(s)) if s[k - 1][0] != s[k][0]}
    return {c for s, c in whole.items() if s not in begun}


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()
