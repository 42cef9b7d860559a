"""Scans, extracts, filters, inventory and kept results."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from regspan.functions.codes import starts_with_any, valid_id
from regspan.functions.dates import seconds_between
from regspan.functions.values import alive_from, numeric_result, plausible_death, text_result
from regspan.operators.cohort import cohort_extract, code_list_filter, governed_extract, left_merge, restrict
from regspan.session import own_folder
from regspan.sources.buckets import save_bucketed
from regspan.sources.inventory import dataset_contents, inventory
from regspan.sources.inventory import project_inventory as tree_inventory
from regspan.sources.rebuilt import rebuilt
from regspan.sources.registers import (
    append,
    cast_failures,
    extract,
    lower_names,
    read_periods,
    read_register,
    select_prefix,
)
from regspan.sources.sinks import materialise

from . import query
from .tables import LINES, VISITS, lines, table, visits, yearly_prescriptions


@query("""
SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderpriority = '1-URGENT'
""")
def register_scan(spark, sf):
    df = read_register(
        spark, f"{sf}/orders.parquet",
        ["O_ORDERKEY", "O_CUSTKEY", "O_TOTALPRICE", "O_ORDERPRIORITY"],
    )
    return df.where(F.col("o_orderpriority") == "1-URGENT").drop("o_orderpriority")


@query(f"""
WITH {LINES}
SELECT pnr, p_brand AS atc, ship AS eksd,
       CASE WHEN year(ship) > 1997 THEN l_extendedprice END AS volume,
       CAST(year(ship) AS INTEGER) AS source_year
FROM lines
""")
def period_scan(spark, sf):
    return read_periods(
        spark, yearly_prescriptions(spark, sf), r"file=lmdb\d{4}12",
        ["pnr", "atc", "eksd", "volume"], period="source_year",
    )


@query(f"""
WITH {LINES}
SELECT CAST(year(ship) AS INTEGER) AS source_year, count(*) AS n, count(DISTINCT pnr) AS persons
FROM lines WHERE year(ship) IN (1996, 1997, 1998, 1999) GROUP BY 1
""")
def period_selection(spark, sf):
    df = read_periods(
        spark, yearly_prescriptions(spark, sf), r"file=lmdb199[6-9]12.*", ["pnr"],
        period="source_year",
    )
    return df.groupBy("source_year").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("pnr").alias("persons")
    )


@query(f"""
WITH {LINES}
SELECT pnr, eksd, min(packsize) AS packsize FROM (
  SELECT pnr, ship AS eksd, p_size AS packsize FROM lines WHERE year(ship) IN (1997, 1998))
GROUP BY pnr, eksd
""")
def period_append(spark, sf):
    df = read_periods(
        spark, yearly_prescriptions(spark, sf), r"file=lmdb199[78].*", ["pnr", "eksd", "packsize"],
        types={"packsize": "int"},
    )
    return df.groupBy("pnr", "eksd").agg(F.min("packsize").alias("packsize"))


@query("""
SELECT o_custkey AS pnr, o_orderkey, o_orderstatus, o_orderdate, o_orderpriority FROM orders
""")
def columns_by_prefix(spark, sf):
    upper = table(spark, sf, "orders").withColumnRenamed("o_custkey", "PNR")
    return select_prefix(upper, ["PNR"], "O_ORDER")


@query("""
SELECT * FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)
""")
def whole_row_extract(spark, sf):
    people = table(spark, sf, "customer").where("c_acctbal < 0")
    return cohort_extract(
        table(spark, sf, "orders"), people.select(F.col("c_custkey").alias("o_custkey")), id="o_custkey"
    )


@query("""
SELECT l_orderkey, l_quantity FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 30
""")
def keep_list_extract(spark, sf):
    where = (F.col("l_returnflag") == "R") & (F.col("l_quantity") > 30)
    return extract(table(spark, sf, "lineitem"), ["l_orderkey", "l_quantity"], where)


@query("""
SELECT count(*) AS n FROM (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R' LIMIT 10000)
""")
def row_cap(spark, sf):
    capped = extract(table(spark, sf, "lineitem"), ["l_orderkey"], F.col("l_returnflag") == "R", 10_000)
    return capped.agg(F.count(F.lit(1)).alias("n"))


# Columns of the given tables, for the inventory's SQL.
_COLUMNS = {
    "region": "r_regionkey r_name",
    "nation": "n_nationkey n_name n_regionkey",
    "customer": "c_custkey c_name c_nationkey c_acctbal c_mktsegment",
    "supplier": "s_suppkey s_name s_nationkey s_acctbal",
    "part": "p_partkey p_name p_brand p_type p_size p_retailprice",
    "orders": "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority",
    "lineitem": "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice"
    " l_discount l_tax l_returnflag l_linestatus l_shipdate",
    "events": "event_id ts user_id event_type value props",
    "documents": "doc_id text lang source n_chars",
    "embeddings": "vec_id embedding label",
    "pages": "page_id url html",
    "benchmark": "item_id text",
    "labels": "doc_id quality toxic",
    "conversations": "conv_id turn role text",
}


@query(
    " UNION ALL ".join(
        f"SELECT '{name}' AS dataset, unnest({columns.split()}) AS \"column\", n AS \"rows\""
        f" FROM (SELECT count(*) AS n FROM {name})"
        for name, columns in _COLUMNS.items()
    )
)
def register_inventory(spark, sf):
    return inventory(spark, sf).drop("type")


_DESCRIBED = ("customer", "orders", "lineitem", "part", "events")


@query(
    " UNION ALL ".join(
        f"SELECT '{name}' AS dataset, '{c}' AS \"column\", count(*) AS \"rows\","
        f" count({c}) AS non_null FROM {name}"
        for name in _DESCRIBED
        for c in _COLUMNS[name].split()
    )
)
def register_contents(spark, sf):
    measures = ["rows", "non_null"]
    described = [dataset_contents(table(spark, sf, name), name, measures) for name in _DESCRIBED]
    return append(described).drop("type")


@query("""
SELECT 'p_partkey' AS "column", CAST(min(p_partkey) AS VARCHAR) AS least, CAST(max(p_partkey) AS VARCHAR) AS greatest FROM part
UNION ALL SELECT 'p_name', min(p_name), max(p_name) FROM part
UNION ALL SELECT 'p_brand', min(p_brand), max(p_brand) FROM part
UNION ALL SELECT 'p_type', min(p_type), max(p_type) FROM part
UNION ALL SELECT 'p_size', CAST(min(p_size) AS VARCHAR), CAST(max(p_size) AS VARCHAR) FROM part
UNION ALL SELECT 'p_retailprice', CAST(min(p_retailprice) AS VARCHAR), CAST(max(p_retailprice) AS VARCHAR) FROM part
""")
def column_ranges(spark, sf):
    ranges = dataset_contents(table(spark, sf, "part"), measures=["least", "greatest"])
    return ranges.select("column", "least", "greatest")


@query("""
SELECT o_custkey AS pnr, count(*) AS visits, CAST(max(o_orderdate) AS DATE) AS last_visit
FROM orders GROUP BY o_custkey
""")
def materialised_result(spark, sf):
    per_person = visits(spark, sf).groupBy("pnr").agg(
        F.count(F.lit(1)).alias("visits"), F.max("day").alias("last_visit")
    )
    return materialise(per_person, f"{own_folder(spark)}/result-{uuid.uuid4().hex}", ["pnr"])


@query("""
SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS pnr FROM orders
WHERE o_orderpriority NOT IN ('1-URGENT', '5-LOW')
""")
def valid_ids(spark, sf):
    priority = F.col("o_orderpriority")
    pnr = F.when(priority == "5-LOW", "").when(priority != "1-URGENT", F.col("o_custkey").cast("string"))
    df = table(spark, sf, "orders").select("o_orderkey", pnr.alias("pnr"))
    return df.where(valid_id(F.col("pnr")))


@query(f"""
WITH {LINES} SELECT pnr, o_orderkey, ship, p_brand FROM lines WHERE p_brand LIKE 'Brand#1%'
""")
def prefix_filter(spark, sf):
    # 'Brand#12' is inside 'Brand#1' and adds nothing.
    hit = starts_with_any(F.col("p_brand"), ["Brand#1", "Brand#12"])
    return lines(spark, sf).where(hit).select("pnr", "o_orderkey", "ship", "p_brand")


@query("""
SELECT o_orderkey FROM orders
WHERE o_orderstatus = 'O' AND (o_orderpriority LIKE '1-%' OR o_orderpriority LIKE '5-%')
""")
def prefix_and_equality(spark, sf):
    hit = starts_with_any(F.col("o_orderpriority"), ["1-", "5-"])
    df = table(spark, sf, "orders").where((F.col("o_orderstatus") == "O") & hit)
    return df.select("o_orderkey")


@query("""
SELECT l_orderkey, l_partkey, CAST(l_quantity * 3600 AS BIGINT) AS seconds
FROM lineitem WHERE l_quantity > 12 AND l_linestatus = 'F'
""")
def duration_filter(spark, sf):
    # From 20:00, l_quantity hours.
    hours, day = F.col("l_quantity").cast("int") + 20, F.to_date("l_shipdate")
    contacts = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey",
        day.alias("dato_start"), F.lit("20:00:00").alias("tidspunkt_start"),
        F.when(F.col("l_linestatus") == "F", F.date_add(day, F.floor(hours / 24).cast("int"))).alias("dato_slut"),
        F.concat(F.lpad((hours % 24).cast("string"), 2, "0"), F.lit(":00:00")).alias("tidspunkt_slut"),
    )
    seconds = seconds_between(
        F.col("dato_start"), F.col("tidspunkt_start"), F.col("dato_slut"), F.col("tidspunkt_slut")
    )
    return contacts.select("l_orderkey", "l_partkey", seconds.alias("seconds")).where("seconds > 43200")


@query("""
SELECT l_orderkey, l_partkey, l_quantity FROM lineitem
WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_size < 5)
""")
def code_list_semi(spark, sf):
    codes = table(spark, sf, "part").where("p_size < 5").select("p_partkey")
    df = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    return code_list_filter(df, "l_partkey", codes.union(codes))


@query(f"""
WITH {LINES}
SELECT pnr, p_brand, ship, l_quantity FROM lines
WHERE (p_brand LIKE 'Brand#1%' OR p_brand LIKE 'Brand#23%') AND ship >= DATE '1997-01-01'
  AND pnr IN (SELECT c_custkey FROM customer WHERE c_acctbal > 1000)
""")
def approved_extract(spark, sf):
    people = table(spark, sf, "customer").where("c_acctbal > 1000").select(F.col("c_custkey").alias("pnr"))
    return governed_extract(
        lines(spark, sf), people,
        columns=["pnr", "p_brand", "ship", "l_quantity"],
        approved=["PNR", "P_BRAND", "SHIP", "L_QUANTITY", "P_SIZE"],
        code="p_brand", prefixes=["Brand#1", "Brand#14", "Brand#23"],
        date="ship", start="1997-01-01",
    )


@query(f"""
WITH {VISITS}
SELECT o_orderkey FROM visits
WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')
   OR (o_orderpriority IN ('3-MEDIUM', '4-NOT SPECIFIED') AND day >= DATE '1998-01-01')
""")
def population_status(spark, sf):
    codes = {"1-URGENT": "01", "2-HIGH": "07", "3-MEDIUM": "90", "4-NOT SPECIFIED": "70", "5-LOW": "20"}
    status = F.create_map(*[F.lit(x) for pair in codes.items() for x in pair])[F.col("o_orderpriority")]
    return visits(spark, sf).where(alive_from(status, F.col("day"), "1998-01-01")).select("o_orderkey")


@query("""
SELECT c_custkey AS pnr, c_mktsegment AS segment, CAST(1998 AS INTEGER) AS source_year,
       DATE '1998-12-31' AS referencetid
FROM customer
""")
def derived_columns(spark, sf):
    df = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("PNR"), F.col("c_mktsegment").alias("Segment"), "c_name"
    )
    return lower_names(df).drop("c_name").select(
        "*", F.lit(1998).alias("source_year"), F.make_date(F.lit(1998), F.lit(12), F.lit(31)).alias("referencetid")
    )


@query("""
SELECT event_id, CASE WHEN event_type <> 'error' THEN value END AS number,
       CASE WHEN event_type = 'error' THEN 'failed' END AS note
FROM events
""")
def value_parsing(spark, sf):
    is_text = F.col("event_type") == "error"
    df = table(spark, sf, "events").select(
        "event_id",
        F.when(is_text, "failed").otherwise(F.col("value").cast("string")).alias("value"),
        F.when(is_text, "A").otherwise("N").alias("resulttype"),
    )
    args = F.col("value"), F.col("resulttype"), ["N"]
    return df.select("event_id", numeric_result(*args).alias("number"), text_result(*args).alias("note"))


@query("""
SELECT count(*) FILTER (event_type = 'error') AS value, CAST(0 AS BIGINT) AS event_id FROM events
""")
def cast_check(spark, sf):
    is_text = F.col("event_type") == "error"
    df = table(spark, sf, "events").select(
        "event_id", F.when(is_text, "failed").otherwise(F.col("value").cast("string")).alias("value")
    )
    return cast_failures(df, {"value": "double", "event_id": "int"})


@query(f"""
WITH {LINES}
SELECT o_orderkey, p_partkey, day AS inn, CASE WHEN ship >= day THEN ship END AS doddato FROM lines
""")
def impossible_dates(spark, sf):
    return lines(spark, sf, coded=False).select(
        "o_orderkey", "p_partkey", F.col("day").alias("inn"),
        plausible_death(F.col("ship"), F.col("day")).alias("doddato"),
    )


@query("""
SELECT o_custkey AS pnr, o_totalprice AS amount, CAST(NULL AS VARCHAR) AS segment FROM orders
UNION ALL SELECT c_custkey, NULL, c_mktsegment FROM customer
""")
def append_with_nulls(spark, sf):
    orders = table(spark, sf, "orders").select(F.col("o_custkey").alias("pnr"), F.col("o_totalprice").alias("amount"))
    people = table(spark, sf, "customer").select(F.col("c_mktsegment").alias("segment"), F.col("c_custkey").alias("pnr"))
    return append([orders, people])


@query(
    " UNION ALL ".join(
        f"SELECT '{dataset}' AS dataset, unnest({[c for c in _COLUMNS[name].split() if c != part]}) AS \"column\", n AS \"rows\""
        f" FROM (SELECT count(*) AS n FROM {name})"
        for dataset, name, part in (
            ("Grunddata/cpr/person", "customer", ""), ("Grunddata/lpr/kontakter", "orders", "o_orderstatus"),
            ("Grunddata/lpr/diagnoser", "lineitem", ""), ("Eksterne data/land", "nation", ""),
        )
    )
)
def project_inventory(spark, sf):
    """A tree of registers, one of them in folders per status."""
    root = f"{own_folder(spark)}/tree-{uuid.uuid4().hex}"
    for folder, name in (("Grunddata/cpr/person", "customer"), ("Grunddata/lpr/diagnoser", "lineitem"), ("Eksterne data/land", "nation")):
        table(spark, sf, name).write.parquet(f"{root}/{folder}.parquet")
    table(spark, sf, "orders").write.partitionBy("o_orderstatus").parquet(f"{root}/Grunddata/lpr/kontakter.parquet")
    return tree_inventory(spark, root).select("dataset", "column", "rows")


@query("""
SELECT o_custkey AS pnr, o_orderpriority AS priority, count(*) AS visits, CAST(max(o_orderdate) AS DATE) AS last_visit
FROM orders GROUP BY ALL
""")
def rebuilt_result(spark, sf):
    """Made once; the second call finds plan, files and parameters unchanged and reads what the first one wrote."""
    path = f"{own_folder(spark)}/kept-{uuid.uuid4().hex}"

    def made():
        seen = visits(spark, sf).withColumnRenamed("o_orderpriority", "priority")
        per_person = seen.groupBy("pnr", "priority").agg(F.count(F.lit(1)).alias("visits"), F.max("day").alias("last_visit"))
        return rebuilt(per_person, path)

    made()
    return made()


@query("""
WITH cohort AS (SELECT c_custkey AS pnr, c_mktsegment FROM customer WHERE c_acctbal < 0)
SELECT c.pnr, c_mktsegment, first_day, last_day, items
FROM cohort c
LEFT JOIN (SELECT o_custkey AS pnr, CAST(min(o_orderdate) AS DATE) AS first_day, CAST(max(o_orderdate) AS DATE) AS last_day
           FROM orders GROUP BY 1) v USING (pnr)
LEFT JOIN (SELECT o_custkey AS pnr, count(*) AS items FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1) i USING (pnr)
""")
def bucketed_cohort(spark, sf):
    """Registers in buckets cut to a cohort, reduced and merged by person, all without a shuffle."""
    return bucket_merge(*bucketed_registers(spark, sf))


def bucketed_registers(spark, sf):
    folder = f"{own_folder(spark)}/buckets-{uuid.uuid4().hex}"
    people = table(spark, sf, "customer").select(F.col("c_custkey").alias("pnr"), "c_mktsegment", "c_acctbal")
    items = lines(spark, sf, coded=False).select("pnr", "p_partkey")
    seen = visits(spark, sf).select("pnr", "day")
    parts = (("people", people), ("visits", seen), ("items", items))
    return [save_bucketed(df, f"{folder}/{name}", 8) for name, df in parts]


def bucket_merge(people, seen, items):
    cohort = people.where("c_acctbal < 0").select("pnr", "c_mktsegment")
    mine = [restrict(df, cohort) for df in (seen, items)]
    presence = mine[0].groupBy("pnr").agg(F.min("day").alias("first_day"), F.max("day").alias("last_day"))
    counted = mine[1].groupBy("pnr").agg(F.count(F.lit(1)).alias("items"))
    return left_merge(cohort, [presence, counted], "pnr")
