"""The given tables in register terms, for Spark and for SQL.

person = customer, visit = order, code = part brand or type.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from regspan.session import own_folder


_schemas: dict[str, StructType] = {}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A given table; its schema is read from the files once per process."""
    path = f"{sf}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def visits(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with the person id and the order day."""
    return table(spark, sf, "orders").select(
        F.col("o_custkey").alias("pnr"),
        F.to_date("o_orderdate").alias("day"),
        "o_orderkey", "o_orderpriority", "o_orderstatus", "o_totalprice",
    )


def lines(spark: SparkSession, sf: str, coded: bool = True) -> DataFrame:
    """Line items with person and dates, and the part's codes if ``coded``."""
    item = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), F.col("l_partkey").alias("p_partkey"),
        "l_quantity", "l_extendedprice", "l_returnflag", "l_linestatus",
        F.to_date("l_shipdate").alias("ship"),
    )
    dated = item.join(visits(spark, sf), "o_orderkey")
    if not coded:
        return dated
    part = table(spark, sf, "part").select("p_partkey", "p_brand", "p_type", "p_size")
    return dated.join(part, "p_partkey")


def observations(spark: SparkSession, sf: str) -> DataFrame:
    """One observation per person: first to last visit, event 1 for a negative balance."""
    seen = visits(spark, sf).groupBy("pnr").agg(
        F.min("day").alias("start"), F.date_add(F.max("day"), 1).alias("end")
    )
    person = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("pnr"), (F.col("c_acctbal") < 0).cast("int").alias("event")
    )
    return seen.join(person, "pnr")


# The same views as SQL, to be put after WITH.
VISITS = """visits AS (
  SELECT o_custkey AS pnr, CAST(o_orderdate AS DATE) AS day, o_orderkey,
         o_orderpriority, o_orderstatus, o_totalprice
  FROM orders)"""

LINES = f"""{VISITS}, lines AS (
  SELECT v.*, p_partkey, l_quantity, l_extendedprice, l_returnflag, l_linestatus,
         CAST(l_shipdate AS DATE) AS ship, p_brand, p_type, p_size
  FROM lineitem
  JOIN visits v ON l_orderkey = v.o_orderkey
  JOIN part ON l_partkey = p_partkey)"""

OBSERVATIONS = f"""{VISITS}, observations AS (
  SELECT pnr, min(day) AS start, max(day) + 1 AS "end",
         CAST(min(c_acctbal) < 0 AS INTEGER) AS event
  FROM visits JOIN customer ON pnr = c_custkey GROUP BY pnr)"""

_written: dict[tuple[str, str], str] = {}


def yearly_prescriptions(spark: SparkSession, sf: str) -> str:
    """Folder with one directory per shipping year, ``…lmdbYYYY12``, written by Spark.

    The years to 1997 lack the ``volume`` column, as registers drift. Written
    once per session, below the shared folder.
    """
    key = (spark.sparkContext.applicationId, sf)
    if key not in _written:
        folder = f"{own_folder(spark)}/yearly-{uuid.uuid4().hex}"
        rx = lines(spark, sf).select(
            "pnr", F.col("p_brand").alias("ATC"), F.col("ship").alias("eksd"),
            F.col("l_extendedprice").alias("volume"), F.col("p_size").alias("packsize"),
            F.concat(F.lit("lmdb"), F.year("ship"), F.lit("12")).alias("file"),
        )
        early = F.year("eksd") <= 1997
        # Rebalanced, a year becomes a few files of good size, however large it is.
        for part in (rx.where(early).drop("volume"), rx.where(~early)):
            balanced = part.hint("rebalance", F.col("file"))
            balanced.write.mode("append").partitionBy("file").parquet(folder)
        _written[key] = folder
    return _written[key]
