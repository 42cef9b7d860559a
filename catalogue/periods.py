"""Admissions, time splitting and treatment periods."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from regspan.operators.intervals import adm_limits, merged_periods
from regspan.operators.prescriptions import Drug, treatment_periods
from regspan.operators.splitting import lexis_from_to, lexis_seq, lexis_two
from regspan.sources.sinks import keep

from . import query
from .tables import LINES, OBSERVATIONS, lines, observations, table, visits

CHAINS = f"""{LINES}, stays AS (
  SELECT pnr, o_orderkey, p_partkey, l_quantity, day AS start, day + CAST(l_quantity AS INTEGER) AS "end" FROM lines
), marked AS (
  SELECT *, max("end") OVER (PARTITION BY pnr ORDER BY start, "end", o_orderkey, p_partkey
                             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before
  FROM stays
), chained AS (
  SELECT *, sum(CASE WHEN before >= start THEN 0 ELSE 1 END)
    OVER (PARTITION BY pnr ORDER BY start, "end", o_orderkey, p_partkey ROWS UNBOUNDED PRECEDING) AS chain
  FROM marked)"""


def _stays(spark, sf):
    return lines(spark, sf, coded=False).select(
        "pnr", "o_orderkey", "p_partkey", F.col("day").alias("start"),
        F.date_add("day", F.col("l_quantity").cast("int")).alias("end"),
    )


@query(f"""
WITH {CHAINS}
SELECT pnr, o_orderkey, p_partkey, start, "end",
       min(start) OVER c AS first_start, max("end") OVER c AS last_end
FROM chained WINDOW c AS (PARTITION BY pnr, chain)
""")
def admission_limits(spark, sf):
    # Read twice: for the rows and for their days.
    return adm_limits(keep(_stays(spark, sf), "stays"), "pnr", "start", "end")


@query(f"""
WITH {CHAINS}
SELECT pnr, min(start) AS first_start, max("end") AS last_end FROM chained GROUP BY pnr, chain
""")
def admission_chains(spark, sf):
    return merged_periods(_stays(spark, sf), "pnr", "start", "end")


@query(f"""
WITH {OBSERVATIONS}, cuts AS (
  SELECT pnr, min(day) FILTER (o_orderpriority = '2-HIGH') AS high,
         min(day) FILTER (o_orderpriority = '1-URGENT') AS urgent
  FROM visits GROUP BY pnr
), points AS (
  SELECT pnr, start AS p FROM observations
  UNION SELECT o.pnr, high FROM observations o JOIN cuts USING (pnr) WHERE high > start AND high < "end"
  UNION SELECT o.pnr, urgent FROM observations o JOIN cuts USING (pnr) WHERE urgent > start AND urgent < "end"
), pieces AS (
  SELECT p.pnr, p AS start, coalesce(lead(p) OVER (PARTITION BY p.pnr ORDER BY p), o."end") AS "end",
         o."end" AS final, event
  FROM points p JOIN observations o USING (pnr))
SELECT s.pnr, s.start, s."end", CASE WHEN s."end" = final THEN event ELSE 0 END AS event,
       CAST(coalesce(high <= s.start, false) AS INTEGER) AS high,
       CAST(coalesce(urgent <= s.start, false) AS INTEGER) AS urgent
FROM pieces s LEFT JOIN cuts USING (pnr)
""")
def split_two(spark, sf):
    def when(priority):
        return F.when(F.col("o_orderpriority") == priority, F.col("day"))

    dates = visits(spark, sf).select(
        "pnr", when("2-HIGH").alias("high"), when("1-URGENT").alias("urgent")
    )
    return lexis_two(observations(spark, sf), dates, ["high", "urgent"], event="event")


@query(f"""
WITH {OBSERVATIONS}, periods AS (
  SELECT DISTINCT pnr, day AS f, day + 60 * CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS t,
         o_orderpriority AS value
  FROM visits WHERE o_orderstatus <> 'P'
), points AS (
  SELECT pnr, start AS p FROM observations
  UNION SELECT o.pnr, f FROM observations o JOIN periods USING (pnr) WHERE f > start AND f < "end"
  UNION SELECT o.pnr, t FROM observations o JOIN periods USING (pnr) WHERE t > start AND t < "end"
), pieces AS (
  SELECT p.pnr, p AS start, coalesce(lead(p) OVER (PARTITION BY p.pnr ORDER BY p), o."end") AS "end",
         o."end" AS final, event
  FROM points p JOIN observations o USING (pnr))
SELECT s.pnr, s.start, s."end", CASE WHEN s."end" = final THEN event ELSE 0 END AS event,
       coalesce((SELECT arg_max(value, (f, value)) FROM periods x
                 WHERE x.pnr = s.pnr AND x.f <= s.start AND x.t > s.start), 'none') AS exposure
FROM pieces s
""")
def split_from_to(spark, sf):
    periods = visits(spark, sf).where("o_orderstatus <> 'P'").select(
        "pnr", F.col("day").alias("from"),
        F.date_add("day", 60 * F.substring("o_orderpriority", 1, 1).cast("int")).alias("to"),
        F.col("o_orderpriority").alias("value"),
    )
    return lexis_from_to(
        observations(spark, sf), periods, event="event", name="exposure", default="none"
    )


_YEARS = list(range(1995, 2003))


@query(f"""
WITH {OBSERVATIONS}, points AS (
  SELECT pnr, start AS p FROM observations
  UNION SELECT pnr, make_date(y, 1, 1) FROM observations, (SELECT unnest({_YEARS}) AS y)
        WHERE make_date(y, 1, 1) > start AND make_date(y, 1, 1) < "end")
SELECT o.pnr, p AS start, coalesce(lead(p) OVER w, o."end") AS "end",
       CASE WHEN lead(p) OVER w IS NULL THEN event ELSE 0 END AS event,
       CAST(least(greatest(year(p) - {_YEARS[0] - 1}, 0), {len(_YEARS)}) AS INTEGER) AS year_band
FROM points JOIN observations o USING (pnr) WINDOW w AS (PARTITION BY o.pnr ORDER BY p)
""")
def split_calendar(spark, sf):
    cuts = [dt.date(y, 1, 1) for y in _YEARS]
    return lexis_seq(observations(spark, sf), cuts, event="event", label="year_band")


_AGES = [20, 25, 30, 32, 34, 36, 38, 40, 42, 44, 46, 48, 50]


@query(f"""
WITH {OBSERVATIONS}, born AS (
  SELECT o.*, DATE '1950-01-01' + CAST(floor(c_acctbal) AS INTEGER) AS birth
  FROM observations o JOIN customer ON c_custkey = pnr
), cuts AS (
  SELECT pnr, a, CAST(birth + to_years(CAST(a AS INTEGER)) AS DATE) AS c FROM born, (SELECT unnest({_AGES}) AS a)
), points AS (
  SELECT pnr, start AS p FROM born
  UNION SELECT b.pnr, c FROM born b JOIN cuts USING (pnr) WHERE c > start AND c < "end"
), pieces AS (
  SELECT b.pnr, birth, p AS start, coalesce(lead(p) OVER (PARTITION BY b.pnr ORDER BY p), b."end") AS "end",
         b."end" AS final, event
  FROM points JOIN born b USING (pnr))
SELECT s.pnr, s.start, s."end", s.birth, CASE WHEN s."end" = final THEN event ELSE 0 END AS event,
       CAST((SELECT count(*) FROM cuts WHERE cuts.pnr = s.pnr AND c <= s.start) AS INTEGER) AS age_band
FROM pieces s
""")
def split_age(spark, sf):
    birth = F.date_add(F.lit("1950-01-01").cast("date"), F.floor("c_acctbal").cast("int"))
    people = table(spark, sf, "customer").select(F.col("c_custkey").alias("pnr"), birth.alias("birth"))
    base = observations(spark, sf).join(people, "pnr")
    return lexis_seq(base, _AGES, "age", event="event", birth="birth", label="age_band")


DRUGS = {
    "eco": Drug(["ECO"], {2.5: 10.0, 0.1: 0.7, 20: 30.0}, min_dose=0.3, max_dose=120.0, max_depot=20_000.0),
    "large": Drug(["LARGE"], {2.5: 8.0, 0.1: 0.3}, min_dose=0.1, max_dose=400.0, max_depot=5_000.0, n_prev=2),
}

# One recursion step per purchase of a person and drug; the run history is a list.
TREATED = f"""RECURSIVE {LINES}, rx AS (
  SELECT pnr, CASE WHEN p_type LIKE 'ECO%' THEN 'eco' ELSE 'large' END AS drug, day,
         CAST(round(CAST(l_quantity AS DOUBLE) * p_size * strength, 6) AS DECIMAL(28, 6)) AS amount, strength
  FROM (SELECT *, CASE l_returnflag WHEN 'A' THEN 2.5::DOUBLE WHEN 'N' THEN 0.1::DOUBLE ELSE 20.0::DOUBLE END AS strength FROM lines)
  WHERE p_type LIKE 'ECO%' OR p_type LIKE 'LARGE%'
), limits(drug, lo, hi, cap, n_prev) AS (
  VALUES ('eco', 0.3::DOUBLE, 120.0::DOUBLE, 20000.0::DOUBLE, 3), ('large', 0.1::DOUBLE, 400.0::DOUBLE, 5000.0::DOUBLE, 2)
), daily AS (
  SELECT pnr, drug, day, CAST(sum(amount) AS DOUBLE) AS amount, max(strength) AS strength,
         row_number() OVER (PARTITION BY pnr, drug ORDER BY day) AS i
  FROM rx GROUP BY pnr, drug, day
), buys AS (
  SELECT d.*, CASE WHEN drug = 'eco' THEN CASE strength WHEN 2.5::DOUBLE THEN 10.0::DOUBLE WHEN 0.1::DOUBLE THEN 0.7::DOUBLE ELSE 30.0::DOUBLE END
              ELSE CASE strength WHEN 2.5::DOUBLE THEN 8.0::DOUBLE WHEN 0.1::DOUBLE THEN 0.3::DOUBLE ELSE strength END END AS start_dose
  FROM daily d
), fold AS (
  SELECT pnr, drug, i, day, amount, start_dose AS dose, amount AS depot,
         CAST([] AS STRUCT(a DOUBLE, d BIGINT)[]) AS run
  FROM buys WHERE i = 1
  UNION ALL
  SELECT pnr, drug, i, day, amount,
         CASE WHEN fresh THEN start_dose
              ELSE least(hi, greatest(lo, list_sum([x.a FOR x IN run2]) / list_sum([x.d FOR x IN run2]))) END AS dose,
         CASE WHEN fresh THEN 0 ELSE left_over END + amount AS depot,
         CASE WHEN fresh THEN CAST([] AS STRUCT(a DOUBLE, d BIGINT)[]) ELSE run2 END AS run
  FROM (
    SELECT b.pnr, b.drug, b.i, b.day, b.amount, b.start_dose, lo, hi,
           floor(f.depot / f.dose) < (b.day - f.day) AS fresh,
           least(cap, greatest(0, f.depot - f.dose * (b.day - f.day))) AS left_over,
           list_append(f.run, {{'a': f.amount, 'd': CAST(b.day - f.day AS BIGINT)}})[-n_prev:] AS run2
    FROM fold f JOIN buys b ON b.pnr = f.pnr AND b.drug = f.drug AND b.i = f.i + 1
    JOIN limits l ON l.drug = b.drug)
), periods AS (
  SELECT pnr, drug, day AS start,
         least(day + CAST(floor(depot / dose) AS INTEGER), lead(day) OVER (PARTITION BY pnr, drug ORDER BY day),
               DATE '9999-12-31') AS "end",
         round(dose, 6) AS dose
  FROM fold)"""


def _prescribed(spark, sf):
    strength = F.when(F.col("l_returnflag") == "A", 2.5).when(F.col("l_returnflag") == "N", 0.1).otherwise(20.0)
    return lines(spark, sf).select(
        "pnr", F.col("p_type").alias("atc"), F.col("day").alias("eksd"),
        F.col("l_quantity").alias("apk"), F.col("p_size").alias("packsize"), strength.alias("strnum"),
    )


@query(f'WITH {TREATED} SELECT * FROM periods WHERE start < "end"')
def treatment(spark, sf):
    return treatment_periods(_prescribed(spark, sf), DRUGS)


@query(f"""
WITH {TREATED}, marked AS (
  SELECT *, CASE WHEN lag("end") OVER w = start AND lag(dose) OVER w = dose THEN 0 ELSE 1 END AS opens
  FROM periods WHERE start < "end" WINDOW w AS (PARTITION BY pnr, drug ORDER BY start)
), runs AS (SELECT *, sum(opens) OVER (PARTITION BY pnr, drug ORDER BY start) AS run FROM marked)
SELECT pnr, drug, dose, min(start) AS start, max("end") AS "end" FROM runs GROUP BY pnr, drug, run, dose
""")
def treatment_merged(spark, sf):
    return treatment_periods(_prescribed(spark, sf), DRUGS, merge=True)


FAR = "DATE '9999-12-31'"


@query(f"""
WITH {OBSERVATIONS}, base AS (
  SELECT pnr, start, event, CASE pnr % 3 WHEN 0 THEN NULL WHEN 1 THEN {FAR} ELSE "end" END AS "end" FROM observations
), periods AS (
  SELECT DISTINCT pnr, day AS f, o_orderpriority AS value,
         CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN {FAR} WHEN '2' THEN {FAR}
              ELSE day + 60 * CAST(substr(o_orderpriority, 1, 1) AS INTEGER) END AS t
  FROM visits WHERE o_orderstatus <> 'P'
), points AS (
  SELECT pnr, start AS p FROM base
  UNION SELECT b.pnr, f FROM base b JOIN periods USING (pnr) WHERE f > start AND f < coalesce("end", {FAR})
  UNION SELECT b.pnr, t FROM base b JOIN periods USING (pnr) WHERE t > start AND t < coalesce("end", {FAR})
), pieces AS (
  SELECT p.pnr, p AS start, lead(p) OVER (PARTITION BY p.pnr ORDER BY p) AS next, b."end" AS final, event
  FROM points p JOIN base b USING (pnr))
SELECT s.pnr, s.start, coalesce(next, final) AS "end", CASE WHEN next IS NULL THEN event ELSE 0 END AS event,
       coalesce((SELECT arg_max(value, (f, value)) FROM periods x
                 WHERE x.pnr = s.pnr AND x.f <= s.start AND x.t > s.start), 'none') AS exposure
FROM pieces s
""")
def split_open(spark, sf):
    """Observations and periods that are open, or coded 9999-12-31."""
    far = F.lit("9999-12-31").cast("date")
    third = F.col("pnr") % 3
    end = F.when(third == 1, far).when(third == 2, F.col("end"))
    priority = F.substring("o_orderpriority", 1, 1)
    to = F.when(priority == "1", far).when(priority != "2", F.date_add("day", 60 * priority.cast("int")))
    periods = visits(spark, sf).where("o_orderstatus <> 'P'").select(
        "pnr", F.col("day").alias("from"), to.alias("to"), F.col("o_orderpriority").alias("value")
    )
    base = observations(spark, sf).withColumn("end", end)
    return lexis_from_to(base, periods, event="event", name="exposure", default="none")
