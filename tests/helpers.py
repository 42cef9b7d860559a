"""Small helpers for fixtures and plans."""

import datetime as dt


def d(text):
    return None if text is None else dt.date.fromisoformat(text)


def rows(df, *columns):
    """Rows as sorted tuples; nulls first."""
    out = [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
    return sorted(out, key=lambda r: [(v is not None, v if v is not None else 0) for v in r])


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()
