"""Density matching."""

from __future__ import annotations

from pyspark.sql import functions as F

from regspan.operators.matching import exposure_match, incidence_match, match_report
from regspan.sources.sinks import keep

from . import query
from .tables import VISITS, table, visits

SEED, K = 17, 3


def _followed(spark, sf):
    """One row per person: entry, end, event of debtors at their last visit but the final one."""
    seen = visits(spark, sf).groupBy("pnr").agg(
        F.min("day").alias("entry"), F.max("day").alias("end"),
        F.max(F.when(F.col("o_orderpriority") == "2-HIGH", F.col("day"))).alias("late"),
        F.min(F.when(F.col("o_orderpriority") == "1-URGENT", F.col("day"))).alias("exposure_date"),
    )
    person = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("pnr"), "c_mktsegment", "c_acctbal"
    )
    followed = seen.join(person.hint("merge"), "pnr").select(
        F.col("pnr").alias("id"), "c_mktsegment", "entry", "end", "exposure_date",
        F.when(F.col("c_acctbal") < 0, F.coalesce("late", "end")).alias("case_date"),
    )
    # Matching reads its input several times.
    return keep(followed, "followed")


FOLLOWED = f"""{VISITS}, followed AS (
  SELECT pnr AS id, c_mktsegment, min(day) AS entry, max(day) AS "end",
         min(day) FILTER (o_orderpriority = '1-URGENT') AS exposure_date,
         CASE WHEN c_acctbal < 0 THEN coalesce(max(day) FILTER (o_orderpriority = '2-HIGH'), max(day)) END AS case_date
  FROM visits JOIN customer ON c_custkey = pnr GROUP BY pnr, c_mktsegment, c_acctbal)"""


def _matched_sql(match_date: str, leaves: str) -> str:
    """Brute force: every pair, candidates in the documented order, the seeded draw by number."""
    return f"""RECURSIVE {FOLLOWED}, risk AS (
      SELECT *, CAST(entry - DATE '0001-01-01' AS BIGINT) AS low,
             CAST(least({leaves}) - DATE '0001-01-01' AS BIGINT) AS high,
             ('0x' || substr(md5('{SEED}|' || id), 1, 15))::BIGINT AS ord
      FROM followed
    ), pairs AS (
      SELECT c.id AS case_id, c.c_mktsegment, c.{match_date} AS match_date, r.id,
             r.low, r.high, r.ord, CAST(c.{match_date} - DATE '0001-01-01' AS BIGINT) AS t
      FROM followed c JOIN risk r ON r.c_mktsegment = c.c_mktsegment AND r.id <> c.id
      WHERE c.{match_date} IS NOT NULL AND r.entry <= c.{match_date} AND least({leaves}) > c.{match_date}
    ), sized AS (
      SELECT *, (SELECT max(b) FROM range(0, 23) g(b)
                 WHERE (t >> b) << b >= low AND ((t >> b) + 1) << b <= high) AS bits
      FROM pairs
    ), numbered AS (
      SELECT *, row_number() OVER (PARTITION BY case_id ORDER BY bits, ord, id) - 1 AS number,
             count(*) OVER (PARTITION BY case_id) AS available
      FROM sized
    ), cases AS (SELECT DISTINCT case_id, available, least(available, {K}) AS taken FROM numbered
    ), draw AS (
      SELECT case_id, available, taken, 0 AS i, CAST([] AS BIGINT[]) AS chosen FROM cases
      UNION ALL
      SELECT case_id, available, taken, i + 1,
             list_append(chosen, CASE WHEN list_contains(chosen, h % (top + 1)) THEN top ELSE h % (top + 1) END)
      FROM (SELECT *, available - taken + i AS top,
                   ('0x' || substr(md5('{SEED}|' || case_id || '|' || i), 1, 15))::BIGINT AS h
            FROM draw WHERE i < taken)
    ), picks AS (
      SELECT case_id, unnest(chosen) AS number, generate_subscripts(chosen, 1) AS rank FROM draw WHERE i = taken
    ), matched AS (
      SELECT case_id, id, c_mktsegment, match_date, CAST(rank AS INTEGER) AS rank
      FROM picks JOIN numbered USING (case_id, number)
      UNION ALL
      SELECT id, id, c_mktsegment, {match_date}, 0 FROM followed WHERE {match_date} IS NOT NULL)"""


INCIDENCE = _matched_sql("case_date", 'r."end", r.case_date').replace(
    "CAST(least(r.\"end\", r.case_date)", "CAST(least(\"end\", case_date)"
)
EXPOSURE = _matched_sql("exposure_date", 'r."end", r.case_date, r.exposure_date').replace(
    "CAST(least(r.\"end\", r.case_date, r.exposure_date)", "CAST(least(\"end\", case_date, exposure_date)"
)

REPORT = """
SELECT 'controls_per_case' AS measure, CAST(controls AS BIGINT) AS key, count(*) AS n
FROM (SELECT case_id, count(*) FILTER (rank > 0) AS controls FROM matched GROUP BY case_id) GROUP BY ALL
UNION ALL
SELECT 'times_used', CAST(used AS BIGINT), count(*)
FROM (SELECT id, count(*) AS used FROM matched WHERE rank > 0 GROUP BY id) GROUP BY ALL
UNION ALL
SELECT 'case_and_control', 1, count(*)
FROM (SELECT id FROM matched GROUP BY id HAVING bool_or(rank = 0) AND bool_or(rank > 0))
HAVING count(*) > 0"""


def _incidence(spark, sf):
    return incidence_match(_followed(spark, sf), K, ["c_mktsegment"], SEED)


def _exposure(spark, sf):
    return exposure_match(_followed(spark, sf), K, ["c_mktsegment"], SEED)


@query(f"WITH {INCIDENCE} SELECT * FROM matched")
def incidence_matching(spark, sf):
    return _incidence(spark, sf)


@query(f"WITH {EXPOSURE} SELECT * FROM matched")
def exposure_matching(spark, sf):
    return _exposure(spark, sf)


@query(f"WITH {INCIDENCE} {REPORT}")
def matching_report(spark, sf):
    return match_report(_incidence(spark, sf))


@query(f"WITH {EXPOSURE} {REPORT}")
def exposure_report(spark, sf):
    return match_report(_exposure(spark, sf))
