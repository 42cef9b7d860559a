"""Conditions, registers by condition, benefits, hypertension and comorbidity."""

from __future__ import annotations

from functools import reduce

import datetime as dt

from pyspark.sql import functions as F

from regspan.operators.benefits import import_deliveries, import_dream, lab_coverage_long
from regspan.operators.comorbidity import charlson, weighted_score
from regspan.operators.conditions import condition_wide, find_condition
from regspan.operators.cohort import restrict
from regspan.operators.prescriptions import hypertension_at, hypertension_first
from regspan.operators.carry import carry_forward
from regspan.operators.lookback import events_before as look_back
from regspan.plans.extracts import hospital_conditions, lab_results, laboratory_values as lab_values, medication
from regspan.sources.registers import read_periods

from . import query
from .tables import LINES, VISITS, lines, table, visits, yearly_prescriptions

# Two prefixes of one condition, overlapping conditions and a nested prefix.
BRANDS = {"first": ["Brand#1"], "teens": ["Brand#12", "Brand#13"], "other": ["Brand#2", "Brand#3", "Brand#25"]}

FOUND = f"""{LINES}, found AS (
  SELECT *, 'first' AS condition FROM lines WHERE p_brand LIKE 'Brand#1%'
  UNION ALL SELECT *, 'teens' FROM lines WHERE p_brand LIKE 'Brand#12%' OR p_brand LIKE 'Brand#13%'
  UNION ALL SELECT *, 'other' FROM lines
            WHERE p_brand LIKE 'Brand#2%' OR p_brand LIKE 'Brand#3%' OR p_brand LIKE 'Brand#25%')"""


def debtors(spark, sf):
    return table(spark, sf, "customer").where("c_acctbal < 0").select(F.col("c_custkey").alias("pnr"))


@query(f"""
WITH {FOUND}
SELECT pnr,
       min(ship) FILTER (condition = 'first') AS "first",
       min(ship) FILTER (condition = 'teens') AS teens,
       min(ship) FILTER (condition = 'other') AS other
FROM found WHERE pnr IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0) GROUP BY pnr
""")
def cohort_conditions(spark, sf):
    coded = lines(spark, sf).select("pnr", "ship", "p_brand")
    mine = restrict(coded, debtors(spark, sf))
    found = find_condition(mine, "p_brand", ["pnr", "ship"], BRANDS)
    return condition_wide(found, "pnr", "ship", list(BRANDS))


@query(f"WITH {FOUND} SELECT pnr, o_orderkey, ship, condition FROM found")
def find_condition_start(spark, sf):
    return find_condition(lines(spark, sf), "p_brand", ["pnr", "o_orderkey", "ship"], BRANDS)


@query(f"""
WITH {LINES}
SELECT pnr, ship, p_type, 'has_m' AS condition FROM lines WHERE contains(p_type, 'M')
UNION ALL SELECT pnr, ship, p_type, 'has_al' FROM lines WHERE contains(p_type, 'AL') OR contains(p_type, 'ALL')
""")
def find_condition_contains(spark, sf):
    return find_condition(
        lines(spark, sf), "p_type", ["pnr", "ship", "p_type"],
        {"has_m": "M", "has_al": ["AL", "ALL"]}, match="contains",
    )


@query("""
WITH list AS (
  SELECT DISTINCT 'small' AS condition, p_brand AS prefix FROM part WHERE p_size < 2
  UNION SELECT DISTINCT 'group ' || substr(p_brand, 7, 1), substr(p_brand, 1, 7) FROM part
  UNION SELECT DISTINCT 'type ' || p_type, p_brand FROM part WHERE p_size > 48
), members AS (
  SELECT DISTINCT p_brand, condition FROM (SELECT DISTINCT p_brand FROM part) JOIN list ON starts_with(p_brand, prefix))
SELECT l_orderkey, l_linenumber, l_partkey, condition
FROM lineitem JOIN part ON l_partkey = p_partkey JOIN members USING (p_brand)
""")
def prefix_join(spark, sf):
    part = table(spark, sf, "part")
    prefixes = reduce(
        lambda a, b: a.union(b),
        [
            part.where("p_size < 2").select(F.lit("small").alias("condition"), F.col("p_brand").alias("prefix")),
            part.select(
                F.concat(F.lit("group "), F.substring("p_brand", 7, 1)), F.substring("p_brand", 1, 7)
            ),
            part.where("p_size > 48").select(F.concat(F.lit("type "), F.col("p_type")), "p_brand"),
        ],
    ).distinct()
    item = table(spark, sf, "lineitem").withColumnRenamed("l_partkey", "p_partkey")
    coded = item.join(part.select("p_partkey", "p_brand"), "p_partkey")
    coded = coded.withColumnRenamed("p_partkey", "l_partkey")
    keep = ["l_orderkey", "l_linenumber", "l_partkey"]
    return find_condition(coded, "p_brand", keep, prefixes, codes=part)


@query("""
WITH list AS (
  SELECT DISTINCT 'size ' || p_size AS condition, substr(p_type, 2, 3) AS part FROM part WHERE p_size < 3
  UNION SELECT 'any l', 'L'
), members AS (
  SELECT DISTINCT p_type, condition FROM (SELECT DISTINCT p_type FROM part) JOIN list ON contains(p_type, part))
SELECT p_partkey, p_type, condition FROM part JOIN members USING (p_type)
""")
def contains_join(spark, sf):
    """Parts of codes from a table, anywhere in the code."""
    part = table(spark, sf, "part")
    some = part.where("p_size < 3").select(
        F.concat(F.lit("size "), F.col("p_size").cast("string")).alias("condition"), F.substring("p_type", 2, 3).alias("prefix")
    )
    parts = some.union(some.sparkSession.range(1).select(F.lit("any l"), F.lit("L"))).distinct()
    return find_condition(part, "p_type", ["p_partkey", "p_type"], parts, match="contains")


@query("""
SELECT CAST(o_custkey AS VARCHAR) AS pnr, inddto, condition FROM (
  SELECT o_custkey, CAST(l_shipdate AS DATE) AS inddto, p_brand
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
  WHERE l_returnflag = 'R'
  UNION ALL
  SELECT o_custkey, CAST(o_orderdate AS DATE), p_brand
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
  WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderstatus <> 'P'
    AND floor(o_totalprice / 10000) > 12)
JOIN (VALUES ('ami', 'Brand#10'), ('ami', 'Brand#21'), ('angina', 'Brand#13'), ('angina', 'Brand#20')) c(condition, prefix)
  ON starts_with(p_brand, prefix)
WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)
""")
def hospital(spark, sf):
    coded = lines(spark, sf)
    pnr = F.col("pnr").cast("string").alias("pnr")
    admissions = coded.select(
        pnr, F.col("p_brand").alias("diag"), F.col("ship").alias("inddto"),
        F.when(F.col("l_returnflag") == "R", "0").otherwise("2").alias("pattype"),
    )
    part = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    diagnoses = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey").join(part, "l_partkey")
    diagnoses = diagnoses.select(
        F.col("l_orderkey").cast("string").alias("dw_ek_kontakt"), F.col("p_brand").alias("diagnosekode")
    )
    hours = F.floor(F.col("o_totalprice") / 10000).cast("int") + 20
    contacts = visits(spark, sf).select(
        F.col("o_orderkey").cast("string").alias("dw_ek_kontakt"),
        F.col("pnr").cast("string").alias("cpr"),
        F.col("day").alias("dato_start"), F.lit("20:00:00").alias("tidspunkt_start"),
        F.when(F.col("o_orderstatus") != "P", F.date_add("day", F.floor(hours / 24).cast("int"))).alias("dato_slut"),
        F.concat(F.lpad((hours % 24).cast("string"), 2, "0"), F.lit(":00:00")).alias("tidspunkt_slut"),
        F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "ALCA00").otherwise("ALCA10").alias("kontakttype"),
    )
    people = debtors(spark, sf).select(pnr)
    heart = {"ami": ["Brand#10", "Brand#21"], "angina": ["Brand#13", "Brand#20"]}
    return hospital_conditions(admissions, diagnoses, contacts, people, heart)


@query("""
SELECT user_id AS pnr, ts AS samplingdate, value AS samplevalue, condition
FROM events JOIN (VALUES ('bought', 'purch'), ('c', 'c'), ('click', 'click')) c(condition, prefix)
  ON starts_with(event_type, prefix)
WHERE user_id IN (SELECT c_custkey FROM customer WHERE c_acctbal > 2000)
""")
def laboratory(spark, sf):
    register = table(spark, sf, "events").select(
        F.col("user_id").alias("pnr"), F.col("event_type").alias("analysiscode"),
        F.col("ts").alias("samplingdate"), F.col("value").alias("samplevalue"),
    )
    people = table(spark, sf, "customer").where("c_acctbal > 2000").select(F.col("c_custkey").alias("pnr"))
    return lab_results(register, people, {"bought": "purch", "c": ["c"], "click": "click"})


@query(f"""
WITH {FOUND}
SELECT pnr, p_brand AS atc, ship AS eksd, p_size AS packsize, condition,
       CASE WHEN year(ship) > 1997 THEN l_extendedprice END AS volume
FROM found
WHERE condition <> 'first' AND year(ship) BETWEEN 1996 AND 1999
  AND pnr IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)
""")
def prescriptions(spark, sf):
    columns = ["pnr", "atc", "eksd", "volume", "packsize"]
    register = read_periods(
        spark, yearly_prescriptions(spark, sf), r"file=lmdb199[6-9]12.*", columns, period="source_year"
    )
    groups = {k: v for k, v in BRANDS.items() if k != "first"}
    return medication(register, debtors(spark, sf), groups)


def _bounds(days):
    """The first and last day of a column: two values, whatever the table's size."""
    return days.agg(*[f(F.to_date(days.columns[0])).alias(f.__name__) for f in (F.min, F.max)]).first()


def _weeks(first, last):
    """Names of all weeks that hold a day from ``first`` to ``last``."""
    day = first - dt.timedelta(days=first.weekday())
    while day <= last:
        year, week, _ = day.isocalendar()
        yield f"y_{year % 100:02d}{week:02d}"
        day += dt.timedelta(days=7)


@query("""
WITH weekly AS (
  SELECT user_id AS pnr, CAST(date_trunc('week', ts) AS DATE) AS week,
         arg_min(event_type, (ts, event_id)) AS code
  FROM events GROUP BY 1, 2
), marked AS (
  SELECT *, CASE WHEN lag(week) OVER w = week - 7 AND lag(code) OVER w = code THEN 0 ELSE 1 END AS opens
  FROM weekly WINDOW w AS (PARTITION BY pnr ORDER BY week)
), runs AS (
  SELECT *, sum(opens) OVER (PARTITION BY pnr ORDER BY week) AS run FROM marked)
SELECT pnr, code, min(week) AS start, max(week) + 7 AS "end" FROM runs GROUP BY pnr, run, code
""")
def dream_long(spark, sf):
    events = table(spark, sf, "events")
    thursday = F.date_add(F.trunc(F.col("ts").cast("date"), "week"), 3)
    week = F.concat(
        F.lit("y_"), F.substring(F.year(thursday).cast("string"), 3, 2),
        F.lpad(F.weekofyear(thursday).cast("string"), 2, "0"),
    )
    first = F.min_by("event_type", F.struct("ts", "event_id"))
    wide = (
        events.groupBy(F.col("user_id").alias("pnr"), week.alias("week")).agg(first.alias("code"))
        .groupBy("pnr").pivot("week", list(_weeks(*_bounds(events.select("ts"))))).agg(F.min("code"))
    )
    return import_dream(wide)


@query(f"""
WITH {VISITS}, monthly AS (
  SELECT pnr, CAST(date_trunc('month', day) AS DATE) AS month, arg_min(o_orderpriority, (day, o_orderkey)) AS code
  FROM visits GROUP BY 1, 2
), marked AS (
  SELECT *, CASE WHEN lag(month) OVER w = month - INTERVAL 1 MONTH AND lag(code) OVER w = code
            THEN 0 ELSE 1 END AS opens
  FROM monthly WINDOW w AS (PARTITION BY pnr ORDER BY month)
), runs AS (
  SELECT *, sum(opens) OVER (PARTITION BY pnr ORDER BY month) AS run FROM marked)
SELECT pnr, code, min(month) AS start, CAST(max(month) + INTERVAL 1 MONTH AS DATE) AS "end"
FROM runs GROUP BY pnr, run, code
""")
def branch_long(spark, sf):
    first_day, last_day = _bounds(visits(spark, sf).select("day"))
    numbers = range(first_day.year * 12 + first_day.month - 1, last_day.year * 12 + last_day.month)
    months = [f"br_{n // 12}_{n % 12 + 1:02d}" for n in numbers]
    month = F.concat(F.lit("br_"), F.date_format("day", "yyyy_MM"))
    first = F.min_by("o_orderpriority", F.struct("day", "o_orderkey"))
    wide = (
        visits(spark, sf).groupBy("pnr", month.alias("month")).agg(first.alias("code"))
        .groupBy("pnr").pivot("month", months).agg(F.min("code"))
    )
    return import_dream(wide, kind="branch")


@query(f"""
WITH {VISITS}, monthly AS (
  SELECT pnr, CAST(date_trunc('month', day) AS DATE) AS month, day, o_orderkey, o_orderpriority AS code FROM visits
), older AS (
  SELECT pnr, month, arg_min(code, (day, o_orderkey)) AS code
  FROM monthly WHERE month < DATE '1999-01-01' GROUP BY 1, 2
), newer AS (
  SELECT pnr, month, max(code) AS code
  FROM (SELECT pnr, month, arg_max(code, (day, o_orderkey)) AS code
        FROM monthly WHERE month >= DATE '1998-01-01' GROUP BY pnr, month, o_orderkey % 2)
  GROUP BY 1, 2
), decided AS (
  SELECT * FROM newer
  UNION ALL SELECT * FROM older
  WHERE month < DATE '1998-01-01' OR pnr NOT IN (SELECT pnr FROM newer)
), marked AS (
  SELECT *, CASE WHEN lag(month) OVER w = month - INTERVAL 1 MONTH AND lag(code) OVER w = code
            THEN 0 ELSE 1 END AS opens
  FROM decided WINDOW w AS (PARTITION BY pnr ORDER BY month)
), runs AS (
  SELECT *, sum(opens) OVER (PARTITION BY pnr ORDER BY month) AS run FROM marked)
SELECT pnr, code, min(month) AS start, CAST(max(month) + INTERVAL 1 MONTH AS DATE) AS "end"
FROM runs GROUP BY pnr, run, code
""")
def dream_deliveries(spark, sf):
    """Two deliveries that share persons and a year; the newer one has up to two rows per person."""
    seen = visits(spark, sf).withColumn("month", F.date_trunc("month", "day").cast("date"))
    first_day, last_day = _bounds(seen.select("day"))
    numbers = range(first_day.year * 12 + first_day.month - 1, last_day.year * 12 + last_day.month)
    name = F.concat(F.lit("br_"), F.date_format("month", "yyyy_MM"))
    order = F.struct("day", "o_orderkey")

    def wide(rows, pick, keys, years):
        months = [f"br_{n // 12}_{n % 12 + 1:02d}" for n in numbers if n // 12 in years]
        codes = rows.groupBy(*keys, name.alias("name")).agg(pick("o_orderpriority", order).alias("code"))
        return codes.groupBy(*keys).pivot("name", months).agg(F.min("code"))

    older = wide(seen.where("year(month) < 1999"), F.min_by, ["pnr"], range(1900, 1999))
    part = (F.col("o_orderkey") % 2).alias("part")
    newer = wide(seen.where("year(month) >= 1998").withColumn("part", part), F.max_by, ["pnr", "part"], range(1998, 2100))
    return import_deliveries([older, newer.drop("part")], kind="branch")


@query("""
WITH counted AS (
  SELECT r_name AS region, o_orderpriority AS speciale, n_name AS laboratorium,
         'kvartal' || year(o_orderdate) || '_' || quarter(o_orderdate) AS quarter, count(*) AS n
  FROM orders JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  GROUP BY ALL
), labs AS (SELECT DISTINCT region, speciale, laboratorium FROM counted)
SELECT l.region, l.speciale, l.laboratorium, q.quarter, c.n, d.idcode
FROM labs l CROSS JOIN (
  SELECT 'kvartal' || (i // 4) || '_' || (i % 4 + 1) AS quarter
  FROM (SELECT unnest(range(min(year(o_orderdate) * 4 + quarter(o_orderdate) - 1),
                            max(year(o_orderdate) * 4 + quarter(o_orderdate)))) AS i FROM orders)) q
LEFT JOIN counted c USING (region, speciale, laboratorium, quarter)
LEFT JOIN (
  SELECT DISTINCT r_name AS region, n_name AS laboratorium, o_orderpriority AS speciale,
         CAST(n_nationkey AS VARCHAR) || o_orderpriority AS idcode
  FROM orders, nation JOIN region ON n_regionkey = r_regionkey
  WHERE r_name <> 'EUROPE') d USING (region, speciale, laboratorium)
""")
def coverage_long(spark, sf):
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    places = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    people = table(spark, sf, "customer").select(F.col("c_custkey").alias("pnr"), "c_nationkey")
    quarter = F.concat(F.lit("kvartal"), F.year("day"), F.lit("_"), F.quarter("day"))
    per_lab = visits(spark, sf).withColumn("quarter", quarter).join(people, "pnr")
    per_lab = per_lab.groupBy("c_nationkey", F.col("o_orderpriority").alias("speciale"), "quarter").agg(
        F.count(F.lit(1)).alias("n")
    )
    first, last = _bounds(visits(spark, sf).select("day"))
    numbers = range(first.year * 4 + (first.month - 1) // 3, last.year * 4 + (last.month - 1) // 3 + 1)
    quarters = [f"kvartal{n // 4}_{n % 4 + 1}" for n in numbers]
    named = per_lab.join(places, F.col("c_nationkey") == F.col("n_nationkey"))
    wide = (
        named.groupBy(
            F.col("r_name").alias("region"), "speciale", F.col("n_name").alias("laboratorium"),
        ).pivot("quarter", quarters).agg(F.sum("n"))
    )
    id_codes = named.where("r_name <> 'EUROPE'").select(
        F.col("r_name").alias("region"), "speciale", F.col("n_name").alias("laboratorium"),
        F.concat(F.col("n_nationkey").cast("string"), F.col("speciale")).alias("idcode"),
    ).distinct()
    return lab_coverage_long(wide, id_codes)


@query("""
WITH quarterly AS (
  SELECT r_name AS region, 'kvartal' || year(o_orderdate) || '_' || quarter(o_orderdate) AS quarter, count(*) AS n
  FROM orders JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ALL)
SELECT region, quarter, n, idcode
FROM quarterly LEFT JOIN (
  SELECT r_name AS region, min(n_name) AS idcode FROM nation JOIN region ON n_regionkey = r_regionkey
  WHERE r_name <> 'EUROPE' GROUP BY 1) USING (region)
WHERE quarter < 'kvartal1998'
""")
def coverage_repeats(spark, sf):
    """A code table with five id codes per laboratory, of which the least counts."""
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    places = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    places = places.select("n_nationkey", "n_name", F.col("r_name").alias("region"))
    people = table(spark, sf, "customer").select(F.col("c_custkey").alias("pnr"), F.col("c_nationkey").alias("n_nationkey"))
    quarter = F.concat(F.lit("kvartal"), F.year("day"), F.lit("_"), F.quarter("day")).alias("quarter")
    counted = visits(spark, sf).where("year(day) < 1998").join(people, "pnr").join(places, "n_nationkey")
    names = [f"kvartal{y}_{q}" for y in (1995, 1996, 1997) for q in (1, 2, 3, 4)]
    wide = counted.groupBy("region", quarter).count().groupBy("region").pivot("quarter", names).agg(F.sum("count"))
    id_codes = places.where("region <> 'EUROPE'").select("region", F.col("n_name").alias("idcode"))
    return lab_coverage_long(wide, id_codes, keys=["region"])


CLASSES = {"eco": ["ECONOMY"], "large": ["LARGE"], "promo": ["PROMO"]}

CLASSED = f"""{LINES}, classed AS (
  SELECT pnr, ship, p_type AS class FROM lines WHERE p_type IN ('ECONOMY', 'LARGE', 'PROMO'))"""


@query(f"""
WITH {CLASSED}, last AS (SELECT pnr, max(day) AS index_date FROM visits GROUP BY pnr)
SELECT l.pnr, l.index_date, count(DISTINCT class) AS n_classes,
       CAST(count(DISTINCT class) >= 2 AS INTEGER) AS hypertension
FROM last l LEFT JOIN classed c ON c.pnr = l.pnr AND ship >= index_date - 180 AND ship < index_date
GROUP BY l.pnr, l.index_date
""")
def hypertension_index(spark, sf):
    index = visits(spark, sf).groupBy("pnr").agg(F.max("day").alias("index_date"))
    rx = lines(spark, sf).select("pnr", "p_type", "ship")
    return hypertension_at(rx, index, CLASSES, atc="p_type", date="ship")


@query(f"""
WITH {CLASSED}, firsts AS (
  SELECT pnr, year(ship) * 4 + quarter(ship) AS q, class, min(ship) AS first_day
  FROM classed GROUP BY 1, 2, 3
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY pnr, q ORDER BY first_day, class) AS r FROM firsts
), good AS (SELECT pnr, q, first_day FROM ranked WHERE r = 2)
SELECT b.pnr, min(b.first_day) AS hypertension_date
FROM good a JOIN good b ON a.pnr = b.pnr AND b.q = a.q + 1 GROUP BY b.pnr
""")
def hypertension_start(spark, sf):
    rx = lines(spark, sf).select("pnr", "p_type", "ship")
    return hypertension_first(rx, CLASSES, atc="p_type", date="ship")


WEIGHTS = {"first": 1, "other": 2, "severe": 6}
COMPONENTS = {"first": ["Brand#1"], "other": ["Brand#2", "Brand#3"], "severe": ["Brand#14"]}

SCORED = f"""{LINES}, last AS (SELECT pnr, max(day) AS index_date FROM visits GROUP BY pnr),
flags AS (
  SELECT l.pnr, index_date,
    CAST(coalesce(bool_or(ship <= index_date AND p_brand LIKE 'Brand#1%'), false) AS INTEGER) AS "first",
    CAST(coalesce(bool_or(ship <= index_date AND (p_brand LIKE 'Brand#2%' OR p_brand LIKE 'Brand#3%')), false) AS INTEGER) AS other,
    CAST(coalesce(bool_or(ship <= index_date AND p_brand LIKE 'Brand#14%'), false) AS INTEGER) AS severe
  FROM lines l JOIN last USING (pnr) GROUP BY l.pnr, index_date)"""


def _charlson(spark, sf, **options):
    index = visits(spark, sf).groupBy("pnr").agg(F.max("day").alias("index_date"))
    coded = lines(spark, sf).select("pnr", "p_brand", "ship")
    diagnoses = coded.join(index, "pnr")
    return charlson(
        diagnoses, "pnr", "p_brand", "ship", "index_date", COMPONENTS, WEIGHTS, **options
    )


@query(f"""
WITH {SCORED}
SELECT pnr, index_date, "first" * (1 - greatest(severe, other)) + 2 * other + 6 * severe AS charlson_index FROM flags
""")
def charlson_index(spark, sf):
    return _charlson(spark, sf, severe_over_mild=[("severe", "first"), ("other", "first")])[0]


@query(f'WITH {SCORED} SELECT pnr, index_date, "first", other, severe FROM flags')
def charlson_components(spark, sf):
    return _charlson(spark, sf)[1]


@query(f"""
WITH {FOUND}
SELECT pnr, CAST(sum(CASE condition WHEN 'first' THEN 1 WHEN 'teens' THEN 6 ELSE 2 END) AS INTEGER) AS score
FROM (SELECT DISTINCT pnr, condition FROM found) GROUP BY pnr
""")
def component_score(spark, sf):
    found = find_condition(lines(spark, sf), "p_brand", ["pnr"], BRANDS)
    return weighted_score(found, {"first": 1, "teens": 6, "other": 2}, "pnr")


# Every third order belongs to one person, who thus owns a third of all rows.
_HEAVY = "CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE pnr END"


@query(f"""
WITH {VISITS}, dated AS (SELECT {_HEAVY} AS pnr, day, o_orderkey, o_orderpriority FROM visits),
first_days AS (SELECT pnr, year(day) AS year, min(day) AS index_date FROM dated GROUP BY 1, 2)
SELECT f.pnr, f.year, f.index_date, d.day AS date, d.o_orderkey, CAST(f.index_date - d.day AS INTEGER) AS days_before
FROM first_days f JOIN dated d ON d.pnr = f.pnr AND d.day BETWEEN f.index_date - 180 AND f.index_date - 1
""")
def events_before(spark, sf):
    """The visits in the 180 days before a person's first visit of each year."""
    seen = visits(spark, sf).select(F.expr(_HEAVY).alias("pnr"), F.col("day").alias("date"), "o_orderkey")
    index = seen.groupBy("pnr", F.year("date").cast("long").alias("year")).agg(F.min("date").alias("index_date"))
    return look_back(index, seen, 180)


@query(f"""
WITH {VISITS}, known AS (
  SELECT {_HEAVY} AS pnr, day, o_orderkey, CASE WHEN o_orderstatus = 'P' THEN o_orderpriority END AS priority,
         CASE WHEN o_orderkey % 5 = 0 THEN o_totalprice END AS price
  FROM visits)
SELECT pnr, day, o_orderkey, last_value(priority IGNORE NULLS) OVER w AS priority,
       last_value(price IGNORE NULLS) OVER w AS price
FROM known WINDOW w AS (PARTITION BY pnr ORDER BY day, o_orderkey)
""")
def carried_forward(spark, sf):
    """The last known priority and price at each visit."""
    known = visits(spark, sf).select(
        F.expr(_HEAVY).alias("pnr"), "day", "o_orderkey",
        F.when(F.col("o_orderstatus") == "P", F.col("o_orderpriority")).alias("priority"),
        F.when(F.col("o_orderkey") % 5 == 0, F.col("o_totalprice")).alias("price"),
    )
    return carry_forward(known, ["priority", "price"], order=["day", "o_orderkey"])


@query("""
WITH register AS (
  SELECT o_custkey AS pnr, CAST(l_shipdate AS DATE) AS samplingdate, 'NPU' || lpad(CAST(l_partkey AS VARCHAR), 5, '0') AS code,
         CASE WHEN l_returnflag = 'R' THEN 'failed' END AS note, CASE WHEN l_returnflag = 'N' THEN l_quantity END AS number,
         l_returnflag
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT pnr, samplingdate, CAST(number AS DOUBLE) AS number, CASE WHEN l_returnflag = 'A' THEN '7' ELSE note END AS note, condition
FROM register JOIN (VALUES ('low', 'NPU0000'), ('any', 'NPU000'), ('first', 'NPU00001')) c(condition, prefix) ON starts_with(code, prefix)
WHERE code IN (SELECT 'NPU' || lpad(CAST(p_partkey AS VARCHAR), 5, '0') FROM part WHERE p_size < 40)
  AND pnr IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)
""")
def laboratory_values(spark, sf):
    """Results of a list of thousands of codes, numbers and texts apart."""
    as_code = lambda c: F.concat(F.lit("NPU"), F.lpad(F.col(c).cast("string"), 5, "0"))
    flag = F.col("l_returnflag")
    register = table(spark, sf, "lineitem").join(
        visits(spark, sf).select("pnr", F.col("o_orderkey").alias("l_orderkey")), "l_orderkey"
    ).select(
        "pnr", F.to_date("l_shipdate").alias("samplingdate"), as_code("l_partkey").alias("analysiscode"),
        F.when(flag == "R", "failed").when(flag == "A", "7").otherwise(F.col("l_quantity").cast("string")).alias("value"),
        F.when(flag == "A", "A").otherwise("N").alias("resulttype"),
    )
    parts = table(spark, sf, "part").where("p_size < 40").select(as_code("p_partkey").alias("code"))
    people = table(spark, sf, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("pnr"))
    named = {"low": "NPU0000", "any": "NPU000", "first": "NPU00001"}
    return lab_values(register, people, parts.union(parts), named)
