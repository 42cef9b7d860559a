"""Spark results against DuckDB on the same tables: names, types and every value."""

from __future__ import annotations

import os
import sys

import duckdb
import pyarrow as pa

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf}/{name}.parquet')")
    return con


def kind(t: pa.DataType) -> str:
    if pa.types.is_string(t) or pa.types.is_large_string(t):
        return "string"
    if pa.types.is_timestamp(t):
        return "timestamp"
    return str(t)


def rows_of(table: pa.Table) -> list[tuple]:
    names = sorted(table.column_names)
    columns = [table.column(n).to_pylist() for n in names]
    return sorted(zip(*columns), key=lambda r: [(v is None, str(type(v)), v if v is not None else 0) for v in r])


def differences(ours: pa.Table, oracle: pa.Table) -> list[str]:
    out = []
    mine = {f.name: kind(f.type) for f in ours.schema}
    theirs = {f.name: kind(f.type) for f in oracle.schema}
    if mine != theirs:
        out.append(f"schema {sorted(mine.items() ^ theirs.items())}")
    if ours.num_rows != oracle.num_rows:
        out.append(f"rows {ours.num_rows} != {oracle.num_rows}")
    if set(mine) == set(theirs):
        a, b = rows_of(ours), rows_of(oracle)
        wrong = [(x, y) for x, y in zip(a, b) if x != y]
        if wrong:
            out.append(f"values {sorted(mine)}: {len(wrong)} differ, first {wrong[:2]}")
    return out


if __name__ == "__main__":
    import time

    from __spark_entry__ import oracle_sql, queries
    from regspan.session import local_session

    sf = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark = local_session()
    wanted = sys.argv[1:] or list(oracle_sql())
    oracles, bad = oracle_sql(), 0
    con = connect(sf)
    for name in wanted:
        begun = time.time()
        try:
            ours = queries()[name](spark, sf).toArrow()
            spent = time.time() - begun
            begun = time.time()
            oracle = con.execute(oracles[name]).to_arrow_table()
            problems = differences(ours, oracle)
        except Exception as err:  # report and go on
            problems, spent = [f"{type(err).__name__}: {str(err)[:600]}"], 0.0
            ours = pa.table({})
        bad += bool(problems)
        print(f"{'BAD' if problems else 'ok '} {name} rows={ours.num_rows} {spent:.2f}s sql {time.time() - begun:.2f}s", *problems, flush=True)
    print(len(wanted), "queries,", bad, "bad")
