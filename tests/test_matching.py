"""Matching: every control at risk, exact numbers, stable and even draws."""

import datetime as dt
import random
from collections import Counter, defaultdict

import pytest
from helpers import d, plan, rows
from pyspark.sql import functions as F

from catalogue import QUERIES
from catalogue import matched as matching_queries
from regspan.functions.blocks import DAY_BITS, blocks, blocks_of_day
from regspan.operators.matching import exposure_match, incidence_match, match_report

SCHEMA = "id string, sex string, entry date, `end` date, case_date date, exposure_date date"


def day(n):
    return None if n is None else dt.date(2000, 1, 1) + dt.timedelta(days=n)


@pytest.fixture(scope="module")
def people():
    random.seed(11)
    out = []
    for i in range(240):
        entry = random.randrange(200)
        end = random.choice([None, entry + random.randrange(1, 900)])
        last = end if end is not None else 1000
        case = random.randrange(entry, last) if random.random() < 0.2 else None
        exposed = random.randrange(entry, last) if random.random() < 0.4 else None
        # One stratum holds most persons; some strata are missing.
        sex = random.choice(["m", "m", "m", "m", "f", None])
        out.append((f"P{i:03d}", sex, day(entry), day(end), day(case), day(exposed)))
    return out


def eligible(people, leaves, match, case):
    t = case[match]
    return {
        p[0]
        for p in people
        if case[1] is not None and p[1] == case[1] and p[0] != case[0] and p[2] <= t
        and all(p[c] is None or p[c] > t for c in leaves)
    }


@pytest.mark.parametrize("k", [1, 4, 500])
@pytest.mark.parametrize("kind", ["incidence", "exposure"])
def test_controls_are_at_risk(spark, people, kind, k):
    df = spark.createDataFrame(people, SCHEMA)
    operator, match, leaves = (
        (incidence_match, 4, [3, 4]) if kind == "incidence" else (exposure_match, 5, [3, 4, 5])
    )
    matched = operator(df, k, ["sex"], seed=5)
    assert matched.columns == ["case_id", "id", "sex", "match_date", "rank"]
    by_case = defaultdict(list)
    for r in matched.collect():
        by_case[r["case_id"]].append(r)
    cases = {p[0]: p for p in people if p[match] is not None}
    assert set(by_case) == set(cases)
    for name, case in cases.items():
        allowed = eligible(people, leaves, match, case)
        found = sorted(by_case[name], key=lambda r: r["rank"])
        assert [r["rank"] for r in found] == list(range(len(found)))
        assert found[0]["id"] == name and {r["match_date"] for r in found} == {case[match]}
        controls = [r["id"] for r in found[1:]]
        assert len(set(controls)) == len(controls) == min(k, len(allowed))
        assert set(controls) <= allowed


def test_seed_decides(spark, people):
    df = spark.createDataFrame(people, SCHEMA)
    one = rows(incidence_match(df, 3, ["sex"], seed=1), "case_id", "rank", "id")
    again = rows(incidence_match(df.repartition(13), 3, ["sex"], seed=1), "case_id", "rank", "id")
    other = rows(incidence_match(df, 3, ["sex"], seed=2), "case_id", "rank", "id")
    assert one == again != other


@pytest.mark.parametrize("far", ["2200-01-01", "1795-01-01", "9999-12-30", "0001-01-02"])
def test_any_day_of_the_calendar(spark, far):
    """No case is left out because its day is far from today."""
    t = d(far)
    people = [("K", "m", t, None, t, None), ("A", "m", t, None, None, None), ("B", "m", d("2000-01-01"), d("2001-01-01"), None, None)]
    found = rows(incidence_match(spark.createDataFrame(people, SCHEMA), 2, ["sex"], seed=1), "case_id", "id", "rank")
    assert found == [("K", "A", 1), ("K", "K", 0)]


def test_no_strata(spark, people):
    df = spark.createDataFrame(people, SCHEMA)
    matched = incidence_match(df, 2, seed=1)
    assert matched.columns == ["case_id", "id", "match_date", "rank"]
    assert matched.where("rank > 0").count() > 0


def test_draws_are_even(spark):
    # 200 cases of one day draw 2 of the same 20 candidates: each is expected 20 times.
    candidates = [(f"C{i}", "m", day(0), day(500), None, None) for i in range(20)]
    cases = [(f"K{i}", "m", day(0), day(500), day(100), None) for i in range(200)]
    df = spark.createDataFrame(candidates + cases, SCHEMA)
    used = Counter(r["id"] for r in incidence_match(df, 2, seed=9).where("rank > 0").collect())
    assert sum(used.values()) == 400 and len(used) == 20
    assert sum((n - 20) ** 2 / 20 for n in used.values()) < 50


def test_blocks_cover_each_day_once(spark):
    random.seed(4)
    top = 1 << DAY_BITS
    spans = [(0, top), (0, 1), (5, 5), (7, 6), (top - 1, top), (3, 4)]
    spans += [tuple(sorted(random.sample(range(top), 2))) for _ in range(30)]
    spans += [(s := random.randrange(top - 50), s + random.randrange(50)) for _ in range(30)]
    df = spark.createDataFrame(spans, "low int, high int")
    for r in df.select("*", blocks("low", "high").alias("b")).collect():
        covered = sorted((b["block"] << b["bits"], (b["block"] + 1) << b["bits"]) for b in r["b"])
        assert all(x[1] == y[0] for x, y in zip(covered, covered[1:]))
        assert len(covered) <= 2 * DAY_BITS
        if r["low"] < r["high"]:
            assert (covered[0][0], covered[-1][1]) == (r["low"], r["high"])
        else:
            assert covered == []
    (row,) = spark.range(1).select(blocks_of_day("77").alias("b")).collect()
    assert all(b["block"] == 77 >> b["bits"] for b in row["b"]) and len(row["b"]) == DAY_BITS + 1


def test_report(spark):
    data = [("K1", "K1", 0), ("K1", "A", 1), ("K1", "K2", 2), ("K2", "K2", 0), ("K2", "A", 1), ("K3", "K3", 0)]
    matched = spark.createDataFrame(data, "case_id string, id string, rank int")
    assert rows(match_report(matched)) == [
        ("case_and_control", 1, 1),
        ("controls_per_case", 0, 1), ("controls_per_case", 1, 1), ("controls_per_case", 2, 1),
        ("times_used", 1, 1), ("times_used", 2, 1),
    ]
    assert match_report(matched.where(F.col("rank") == 0)).count() == 1


def test_bad_k(spark, people):
    with pytest.raises(ValueError):
        incidence_match(spark.createDataFrame(people, SCHEMA), 0)


def test_case_without_candidates_is_kept(spark):
    df = spark.createDataFrame([("A", "m", d("2000-01-01"), None, d("2001-01-01"), None)], SCHEMA)
    assert rows(incidence_match(df, 2, ["sex"]), "case_id", "id", "rank") == [("A", "A", 0)]


@pytest.mark.parametrize("operator", [incidence_match, exposure_match])
def test_nothing_is_broadcast(spark, people, tmp_path, operator):
    """A person becomes many rows, of which the size of the input's files says nothing."""
    path = str(tmp_path / "people")
    spark.createDataFrame(people, SCHEMA).write.parquet(path)
    found = operator(spark.read.parquet(path), 2, ["sex"], seed=5)
    assert "Broadcast" not in plan(found)
    assert found.where("rank > 0").count() > 0


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Customers with five orders each."""
    folder = tmp_path_factory.mktemp("tables")
    urgency = "element_at(array('1-URGENT', '2-HIGH', '5-LOW'), cast(1 + id % 3 AS int))"
    spark.range(40).selectExpr(
        "id AS c_custkey", "concat('C', id) AS c_name", "cast(id % 5 AS int) AS c_nationkey",
        "cast(id % 4 - 1 AS double) AS c_acctbal", "string(id % 2) AS c_mktsegment",
    ).write.parquet(str(folder / "customer.parquet"))
    spark.range(200).selectExpr(
        "id AS o_orderkey", "id % 40 AS o_custkey", "'O' AS o_orderstatus", "1.0D AS o_totalprice",
        "timestamp(date_add(date'2000-01-01', cast(id * 37 % 500 AS int))) AS o_orderdate",
        f"{urgency} AS o_orderpriority",
    ).write.parquet(str(folder / "orders.parquet"))
    return str(folder)


@pytest.mark.parametrize("name", ["exposure_report", "incidence_matching", "matching_report", "exposure_matching"])
def test_query_broadcasts_nothing(spark, tables, monkeypatch, name):
    assert QUERIES[name](spark, tables).count() > 0
    # Not written in between, the persons' own join shows in the plan as well.
    monkeypatch.setattr(matching_queries, "keep", lambda df, name: df)
    assert "Broadcast" not in plan(QUERIES[name](spark, tables))
