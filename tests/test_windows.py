"""Looking back before a date, carrying values forward, and lists of exact codes."""

import datetime as dt
import random

import pytest
from helpers import d, plan, rows

from regspan.operators.carry import carry_forward
from regspan.operators.cohort import listed_codes
from regspan.operators.lookback import events_before
from regspan.plans.extracts import laboratory_values

DAY = dt.date(2000, 1, 1)


def day(n):
    return None if n is None else DAY + dt.timedelta(days=n)


@pytest.fixture(scope="module")
def events(spark):
    rng = random.Random(1)
    # A third of all rows belongs to one person.
    data = [("P0" if i % 3 == 0 else f"P{rng.randrange(8)}", day(rng.randrange(-40, 400)), i) for i in range(900)]
    data += [("P1", None, 900), (None, day(5), 901), ("P0", day(100), 902), ("P0", day(100), 902)]
    return spark.createDataFrame(data, "pnr string, date date, n int")


@pytest.fixture(scope="module")
def index(spark):
    rng = random.Random(2)
    data = [(f"P{rng.randrange(10)}", i, day(rng.randrange(0, 420))) for i in range(60)]
    data += [("P0", 60, None), (None, 61, day(5)), ("P0", 62, day(101)), ("P0", 62, day(101))]
    return spark.createDataFrame(data, "pnr string, i int, index_date date")


@pytest.mark.parametrize("days, at_least", [(30, 1), (1, 1), (0, 0), (90, 60), (5, -5), (-3, -20), (400, 0)])
def test_events_before_against_all_pairs(events, index, days, at_least):
    want = sorted(
        (x.pnr, x.i, x.index_date, e.date, e.n, (x.index_date - e.date).days)
        for x in index.collect() for e in events.collect()
        if x.pnr == e.pnr and x.pnr and x.index_date and e.date and at_least <= (x.index_date - e.date).days <= days
    )
    assert rows(events_before(index, events, days, at_least=at_least)) == want


def test_events_meet_by_bucket(spark, events, index):
    found = events_before(index, events, 30)
    assert found.columns == ["pnr", "i", "index_date", "date", "n", "days_before"]
    assert "NestedLoop" not in plan(found) and "Cartesian" not in plan(found)
    assert rows(events_before(index.limit(0), events, 30)) == []
    with pytest.raises(ValueError, match="in both"):
        events_before(index.withColumnRenamed("i", "n"), events, 30)
    with pytest.raises(ValueError, match="no day"):
        events_before(index, events, 3, at_least=4)


@pytest.mark.parametrize("block_days", [1, 7, 32, 5000])
def test_carry_forward_against_a_loop(spark, block_days):
    rng = random.Random(block_days)
    data = []
    for i in range(500):
        person = "P0" if i % 3 == 0 else rng.choice(["P1", "P2", "P3", None, ""])
        data.append((i, person, day(rng.choice([None, rng.randrange(300)])), rng.randrange(3), rng.choice([None, None, 1, 2, 3]), rng.choice([None, "a", "b"])))
    df = spark.createDataFrame(data, "i int, pnr string, date date, k int, v int, w string").repartition(4)
    got = {r.i: (r.v, r.w) for r in carry_forward(df, ["v", "w"], order=["date", "k"], block_days=block_days).collect()}
    key = lambda r: (r[2] is not None, r[2] or DAY, r[3])
    for r in data:
        for at in (4, 5):
            value = r[at]
            if value is None and r[1] is not None:
                known = [(key(o), o[at]) for o in data if o[1] == r[1] and key(o) <= key(r) and o[at] is not None]
                value = max(known)[1] if known else None
            assert got[r[0]][at - 4] == value
    assert len(got) == len(data)


def test_no_window_over_a_person(spark):
    df = spark.createDataFrame([("P", DAY, 1)], "pnr string, date date, v int")
    out = carry_forward(df, ["v"])
    assert out.columns == df.columns and rows(carry_forward(df.limit(0), ["v"])) == []
    scans = [x for x in plan(out).split("== Initial Plan ==")[-1].splitlines() if "Window [" in x]
    assert len(scans) == 2 and sum("_block" in x and "_in_0" in x for x in scans) == 1
    assert next(x for x in scans if "_in_0" in x).count("_block") >= 1


def test_listed_codes_reach_the_scan(spark, tmp_path):
    path = f"{tmp_path}/lab"
    spark.range(1000).selectExpr("concat('NPU', lpad(id, 5, '0')) AS code", "id").write.parquet(path)
    register = spark.read.parquet(path)
    codes = spark.createDataFrame([(f"NPU{i:05d}",) for i in range(0, 500, 3)] * 2 + [(None,)], "c string")
    found = listed_codes(register, "code", codes)
    assert found.count() == 167 and "PushedFilters: [In(code" in plan(found) and "Join" not in plan(found)
    joined = listed_codes(register, "code", codes, most=10)
    assert rows(joined) == rows(found.select(*joined.columns)) and "Join" in plan(joined)
    assert listed_codes(register, "code", codes.limit(0)).count() == 0


def test_laboratory_values(spark):
    register = spark.createDataFrame(
        [("P1", d("2010-01-01"), "NPU03230", "4.1", "N"), ("P1", d("2010-01-02"), "NPU03230", "<2", "N"),
         ("P1", d("2010-01-03"), "NPU03429", "140", "A"), ("P2", d("2010-01-01"), "NPU03230", "5", "N"),
         ("P1", d("2010-01-04"), "NPU99999", "1", "N"), ("P1", d("2010-01-05"), "NPU03429", None, "N"), ("P1", None, None, "1", "N")],
        "pnr string, samplingdate date, analysiscode string, value string, resulttype string",
    )
    people = spark.createDataFrame([("P1",)], "pnr string")
    codes = spark.createDataFrame([("NPU03230",), ("NPU03429",), ("NPU03230",)], "code string")
    named = {"potassium": "NPU03230", "any": "NPU"}
    assert rows(laboratory_values(register, people, codes, {"potassium": "NPU03230"}), "samplingdate", "number", "note") == [
        (d("2010-01-01"), 4.1, None), (d("2010-01-02"), None, "<2")
    ]
    assert laboratory_values(register, people, codes, named).count() == 6
    assert rows(laboratory_values(register, people, codes), "analysiscode", "number", "note") == [
        ("NPU03230", None, "<2"), ("NPU03230", 4.1, None), ("NPU03429", None, None), ("NPU03429", None, "140"),
    ]
