"""Cutting to a population: rows, repeats, filters and scans."""

import pytest
from helpers import plan

from catalogue.people import follow_up
from catalogue.scans import approved_extract
from regspan.operators.cohort import restrict

SF = "/root/testdata/sf0.001"


def test_restrict_keeps_duplicates_once_each(spark):
    register = spark.createDataFrame([("P1", 1), ("P1", 1), ("P2", 2), (None, 3), ("", 4)], "pnr string, v int")
    people = spark.createDataFrame([("P1",), ("P1",), ("",), (None,)], "pnr string")
    assert sorted(r["v"] for r in restrict(register, people).collect()) == [1, 1]


@pytest.mark.parametrize("query", [follow_up, approved_extract])
def test_fact_table_is_scanned_once_with_its_filters(spark, query):
    """Also where nothing is broadcast, as with large tables."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(query(spark, SF))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    initial = text.split("Initial Plan")[-1]
    scans = [line for line in initial.splitlines() if "lineitem.parquet" in line]
    assert len(scans) == 1
    if query is follow_up:
        assert "EqualTo(l_returnflag,R)" in scans[0]
