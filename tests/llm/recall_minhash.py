"""Components of op4 against those of all pairs, on the tables of a folder: ``python tests/llm/recall_minhash.py FOLDER``.

All pairs are found exactly: a link of similarity 0.8 shares one of the rarest shingles of both sets (prefix
filter), and the pairs that do are counted in full by DuckDB. Prints documents, links' recall by document, and differences.
"""

import os
import sys

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

EXACT = r"""
CREATE TABLE words AS
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents;
CREATE TABLE shingles AS
  SELECT DISTINCT doc_id, hash(s) AS s
  FROM (SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i+3], ' ')) END) AS s FROM words);
CREATE TABLE sets AS SELECT doc_id, list_sort(list(s)) AS l, count(*) AS n FROM shingles GROUP BY doc_id;
-- Equal sets are one class.
CREATE TABLE classes AS SELECT min(doc_id) AS c, l, min(n) AS n FROM sets GROUP BY l;
CREATE TABLE members AS SELECT doc_id, c FROM sets JOIN classes USING (l);
CREATE TABLE own AS SELECT c, n, unnest(l) AS s FROM classes;
CREATE TABLE ranked AS
  SELECT c, n, s, row_number() OVER (PARTITION BY c ORDER BY f, s) AS k
  FROM own JOIN (SELECT s, count(*) AS f FROM own GROUP BY s) USING (s);
-- Sets of n and at least 0.8 n shingles in common share one of the n - ceil(0.8 n) + 1 rarest.
CREATE TABLE heads AS SELECT * FROM ranked WHERE k <= n - ceil(0.8 * n) + 1;
CREATE TABLE pairs AS
  SELECT DISTINCT a.c AS a, b.c AS b FROM heads a JOIN heads b ON a.s = b.s AND a.c < b.c AND 10 * least(a.n, b.n) >= 8 * greatest(a.n, b.n);
CREATE TABLE links AS
  SELECT a, b FROM pairs JOIN classes x ON x.c = a JOIN classes y ON y.c = b,
  LATERAL (SELECT len(list_intersect(x.l, y.l)) AS common) WHERE 100 * common >= 80 * (x.n + y.n - common);
"""


def exact(folder: str) -> dict:
    """Least id reachable of each document that has words."""
    con = duckdb.connect()
    files = f"{folder}/documents.parquet"
    files += "/*.parquet" if os.path.isdir(files) else ""
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{files}')")
    con.execute(EXACT)
    up: dict = {}

    def root(x):
        while up.get(x, x) != x:
            up[x] = up.get(up[x], up[x])
            x = up[x]
        return x

    for a, b in con.execute("SELECT a, b FROM links").fetchall():
        a, b = sorted((root(a), root(b)))
        up[b] = a
    return {d: root(c) for d, c in con.execute("SELECT doc_id, c FROM members").fetchall()}


def main() -> None:
    from regspan.llm.queries import QUERIES
    from regspan.session import local_session

    folder = sys.argv[1]
    want = exact(folder)
    found = {r.doc_id: r.component_id for r in QUERIES["op4_minhash"](local_session(8, "recall"), folder).collect()}
    linked = [d for d, c in want.items() if d != c]
    right = sum(found[d] == want[d] for d in linked)
    wrong = [d for d in want if found[d] != want[d]]
    share = right / len(linked) if linked else 1.0
    print(f"{len(found)} documents, {len(linked)} not least of their component, recall {share:.6f}, {len(wrong)} differ {wrong[:5]}")


if __name__ == "__main__":
    main()
