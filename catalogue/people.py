"""Cohorts, presence, follow-up, merges and economy."""

from __future__ import annotations

from pyspark.sql import functions as F

from regspan.operators.cohort import (
    first_event,
    first_event_after,
    first_presence,
    person_list,
    restrict,
)
from regspan.operators.income import average_income
from regspan.plans.extracts import education_level
from regspan.plans.population import follow_up_end, left_merge, study_population

from . import query
from .tables import LINES, OBSERVATIONS, VISITS, lines, observations, table, visits

# First unbroken run of visits; the limit is 95 days after 1997 and 370 days up to then.
PRESENCE = f"""{VISITS}, daily AS (
  SELECT pnr, day, min(o_orderpriority) AS priority FROM visits GROUP BY pnr, day
), gaps AS (
  SELECT *, day - lag(day) OVER (PARTITION BY pnr ORDER BY day) AS gap FROM daily
), marked AS (
  SELECT *, sum(CASE WHEN gap > CASE WHEN year(day) > 1997 THEN 95 ELSE 370 END THEN 1 ELSE 0 END)
    OVER (PARTITION BY pnr ORDER BY day) AS breaks FROM gaps
), presence AS (
  SELECT pnr, arg_min(priority, day) AS priority, min(day) AS inn, max(day) AS "out"
  FROM marked WHERE breaks = 0 GROUP BY pnr)"""

FOLLOWED = f"""{PRESENCE}, gone AS (
  SELECT p.pnr, min(CAST(l_shipdate AS DATE)) AS haend_dato
  FROM presence p JOIN orders o ON o.o_custkey = p.pnr JOIN lineitem ON l_orderkey = o.o_orderkey
  WHERE l_returnflag = 'R' AND CAST(l_shipdate AS DATE) > p."out" GROUP BY p.pnr
), dead AS (
  SELECT pnr, min(day) + 300 AS doddato FROM visits
  WHERE o_orderpriority = '5-LOW' AND o_orderstatus = 'F' GROUP BY pnr
), followed AS (
  SELECT pnr, priority, inn, haend_dato,
         CASE WHEN doddato >= inn THEN doddato END AS doddato,
         least("out" + CASE WHEN year("out") > 1997 THEN 91 ELSE 365 END, haend_dato,
               CASE WHEN doddato >= inn THEN doddato END) AS "out"
  FROM presence LEFT JOIN gone USING (pnr) LEFT JOIN dead USING (pnr))"""


def _presence(spark, sf):
    return first_presence(visits(spark, sf), "pnr", "day", ["o_orderpriority"], switch_year=1997)


def _migrations(spark, sf):
    return lines(spark, sf, coded=False).where(F.col("l_returnflag") == "R").select("pnr", F.col("ship").alias("haend_dato"))


def _deaths(spark, sf):
    dead = visits(spark, sf).where("o_orderpriority = '5-LOW' AND o_orderstatus = 'F'")
    return dead.select("pnr", F.date_add("day", 300).alias("doddato"))


@query(f"WITH {PRESENCE} SELECT * FROM presence")
def presence_run(spark, sf):
    return _presence(spark, sf).withColumnRenamed("o_orderpriority", "priority")


@query(f'WITH {FOLLOWED} SELECT pnr, inn, "out", haend_dato, doddato FROM followed')
def follow_up(spark, sf):
    followed = follow_up_end(
        _presence(spark, sf), _migrations(spark, sf), _deaths(spark, sf), switch_year=1997
    )
    return followed.select("pnr", "inn", "out", "haend_dato", "doddato")


@query(f"""
WITH {FOLLOWED}, snap AS (
  SELECT pnr, arg_min(birth, day) AS birth FROM (
    SELECT pnr, day, min(DATE '1950-01-01' + CAST(floor(o_totalprice / 50) AS INTEGER)) AS birth
    FROM visits GROUP BY pnr, day) GROUP BY pnr
), born AS (
  SELECT c_custkey AS pnr, DATE '1950-01-01' + CAST(floor(c_acctbal) AS INTEGER) AS birth
  FROM customer WHERE c_acctbal > 0)
SELECT f.pnr, coalesce(b.birth, s.birth) AS foed_dag, priority AS koen, inn, "out", haend_dato, doddato
FROM followed f JOIN snap s USING (pnr) LEFT JOIN born b USING (pnr)
""")
def population(spark, sf):
    day0 = F.lit("1950-01-01").cast("date")
    snapshots = visits(spark, sf).select(
        "pnr", F.col("day").alias("referencetid"), F.col("o_orderpriority").alias("koen"),
        F.date_add(day0, F.floor(F.col("o_totalprice") / 50).cast("int")).alias("foed_dag"),
    )
    persons = table(spark, sf, "customer").where("c_acctbal > 0").select(
        F.col("c_custkey").alias("pnr"),
        F.date_add(day0, F.floor("c_acctbal").cast("int")).alias("foed_dag_person"),
    )
    return study_population(
        snapshots, persons, _migrations(spark, sf), _deaths(spark, sf), switch_year=1997
    )


@query(f"WITH {PRESENCE} SELECT DISTINCT pnr FROM visits")
def persons(spark, sf):
    return person_list(visits(spark, sf))


@query(f"""
WITH {LINES}
SELECT pnr, o_orderkey, p_partkey, ship FROM lines
WHERE pnr IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)
""")
def cohort_restriction(spark, sf):
    people = table(spark, sf, "customer").where("c_acctbal < 0").select(F.col("c_custkey").alias("pnr"))
    mine = lines(spark, sf, coded=False).select("pnr", "o_orderkey", "p_partkey", "ship")
    return restrict(mine, people)


@query("""
SELECT l_orderkey, l_partkey, o_custkey, o_orderstatus
FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderpriority = '1-URGENT'
""")
def fact_join(spark, sf):
    diagnoses = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey")
    contacts = table(spark, sf, "orders").where("o_orderpriority = '1-URGENT'").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderstatus"
    )
    return diagnoses.join(contacts, "l_orderkey")


@query(f"""
WITH {VISITS}
SELECT c_custkey AS pnr, c_mktsegment, f.first_visit, u.first_urgent
FROM customer
LEFT JOIN (SELECT pnr, min(day) AS first_visit FROM visits GROUP BY pnr) f ON f.pnr = c_custkey
LEFT JOIN (SELECT pnr, min(day) AS first_urgent FROM visits WHERE o_orderpriority = '1-URGENT'
           GROUP BY pnr) u ON u.pnr = c_custkey
""")
def left_merge_chain(spark, sf):
    seen = visits(spark, sf)
    people = table(spark, sf, "customer").select(F.col("c_custkey").alias("pnr"), "c_mktsegment")
    urgent = first_event(seen.where("o_orderpriority = '1-URGENT'"), "pnr", "day", "first_urgent")
    return left_merge(people, [first_event(seen, "pnr", "day", "first_visit"), urgent], "pnr")


@query(f"""
WITH {VISITS}, least AS (
  SELECT pnr, day, o_orderkey, row_number() OVER (PARTITION BY pnr ORDER BY day, o_orderkey) AS i FROM visits)
SELECT c_custkey AS pnr, c_mktsegment, day, o_orderkey
FROM customer LEFT JOIN least ON pnr = c_custkey AND i = 1
""")
def left_merge_repeats(spark, sf):
    """A table with a row per visit: its least row counts, persons stay unique."""
    people = table(spark, sf, "customer").select(F.col("c_custkey").alias("pnr"), "c_mktsegment")
    return left_merge(people, [visits(spark, sf).select("pnr", "day", "o_orderkey")], "pnr")


@query(f"""
WITH {PRESENCE}
SELECT p.pnr, min(v.day) AS returned FROM presence p JOIN visits v ON v.pnr = p.pnr AND v.day > p."out"
GROUP BY p.pnr
""")
def event_after_presence(spark, sf):
    seen = visits(spark, sf)
    return first_event_after(seen, _presence(spark, sf), "pnr", "day", "out", "returned")


@query(f"""
WITH {OBSERVATIONS}, income AS (
  SELECT pnr, year(day) AS year, sum(o_totalprice) AS income FROM visits GROUP BY 1, 2)
SELECT o.pnr, o."end" AS date, round(avg(i.income), 4) AS average_income, count(i.income) AS years_found
FROM observations o
LEFT JOIN income i ON i.pnr = o.pnr AND i.year BETWEEN year(o."end") - 5 AND year(o."end") - 1
GROUP BY o.pnr, o."end"
""")
def income_before(spark, sf):
    income = visits(spark, sf).groupBy("pnr", F.year("day").alias("year")).agg(
        F.sum("o_totalprice").alias("income")
    )
    ids = observations(spark, sf).select("pnr", F.col("end").alias("date"))
    return average_income(ids, income, id="pnr").withColumn(
        "average_income", F.round("average_income", 4)
    )


@query("""
SELECT c_custkey AS pnr, CAST(c_nationkey AS VARCHAR) AS hfaudd, r_name AS level5, n_name AS isced
FROM customer LEFT JOIN (nation JOIN region ON n_regionkey = r_regionkey AND r_name <> 'ASIA')
  ON n_nationkey = c_nationkey
WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')
""")
def education(spark, sf):
    register = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("pnr"), F.col("c_nationkey").cast("string").alias("hfaudd")
    )
    people = visits(spark, sf).where("o_orderstatus = 'F'")
    regions = table(spark, sf, "region").where("r_name <> 'ASIA'")
    lookup = table(spark, sf, "nation").join(regions, F.col("n_regionkey") == F.col("r_regionkey"))
    lookup = lookup.select(
        F.col("n_nationkey").cast("string").alias("hfaudd"),
        F.col("r_name").alias("level5"), F.col("n_name").alias("isced"),
    )
    return education_level(register, people, lookup).select("pnr", "hfaudd", "level5", "isced")


@query("""
WITH lookup AS (
  SELECT CAST(n_regionkey AS VARCHAR) AS hfaudd, CAST(n_nationkey % 3 AS INTEGER) AS level5, n_name AS isced
  FROM nation WHERE n_regionkey < 4
  QUALIFY row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey % 3, n_name) = 1)
SELECT c_custkey AS pnr, CAST(c_nationkey % 6 AS VARCHAR) AS hfaudd, level5, isced
FROM customer LEFT JOIN lookup ON CAST(c_nationkey % 6 AS VARCHAR) = hfaudd
WHERE c_custkey IN (SELECT o_custkey FROM orders)
""")
def education_repeats(spark, sf):
    """A code table that repeats its codes: the least row of each counts, no person is multiplied."""
    register = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("pnr"), (F.col("c_nationkey") % 6).cast("string").alias("hfaudd")
    )
    lookup = table(spark, sf, "nation").where("n_regionkey < 4").select(
        F.col("n_regionkey").cast("string").alias("hfaudd"),
        (F.col("n_nationkey") % 3).cast("int").alias("level5"), F.col("n_name").alias("isced"),
    )
    return education_level(register, visits(spark, sf), lookup).select("pnr", "hfaudd", "level5", "isced")
