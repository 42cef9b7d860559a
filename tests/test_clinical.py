"""Benefits, hypertension, comorbidity and treatment periods."""

import datetime as dt
import math
import random

import pytest
from helpers import d, rows
from pyspark.sql import functions as F

from regspan.functions.dates import iso_week_start, month_column, week_column
from regspan.operators.benefits import Stitching, import_deliveries, import_dream, lab_coverage_long
from regspan.operators.comorbidity import charlson, weighted_score
from regspan.operators.prescriptions import (
    Drug,
    hypertension_at,
    hypertension_first,
    treatment_periods,
)


def test_period_columns():
    assert iso_week_start(2020, 53) == d("2020-12-28")
    assert week_column("y_2053") == (d("2020-12-28"), d("2021-01-04"))
    assert week_column("Y_7001")[0] == d("1969-12-29") and week_column("y_6901")[0] == d("2068-12-31")
    with pytest.raises(ValueError):
        week_column("y_2153")
    with pytest.raises(ValueError):
        week_column("z_2101")
    assert month_column("br_2011_12") == (d("2011-12-01"), d("2012-01-01"))
    assert month_column("br_2011_2") == (d("2011-02-01"), d("2011-03-01"))


def test_dream(spark):
    names = ["y_2052", "y_2053", "y_2101", "y_2102", "y_2104", "y_2105"]  # week 3 of 2021 has no column
    data = [
        ("P1", "111", "111", "111", None, "222", "222"),  # across New Year
        ("P2", "", "111", "222", "222", "222", ""),  # change without a gap; missing week 3 ends a run
        ("P3", None, "", None, None, None, None),
        ("P4", "1", None, "1", None, None, "1"),
    ]
    wide = spark.createDataFrame(data, ", ".join(f"{c} string" for c in ["pnr", *names]))
    w = {c: week_column(c) for c in names}
    shuffled = wide.select("pnr", *reversed(names))
    assert rows(import_dream(shuffled)) == sorted([
        ("P1", "111", w["y_2052"][0], w["y_2101"][1]), ("P1", "222", w["y_2104"][0], w["y_2105"][1]),
        ("P2", "111", w["y_2053"][0], w["y_2053"][1]), ("P2", "222", w["y_2101"][0], w["y_2102"][1]),
        ("P2", "222", w["y_2104"][0], w["y_2104"][1]),
        ("P4", "1", w["y_2052"][0], w["y_2052"][1]), ("P4", "1", w["y_2101"][0], w["y_2101"][1]),
        ("P4", "1", w["y_2105"][0], w["y_2105"][1]),
    ])
    assert "Exchange" not in import_dream(wide)._jdf.queryExecution().executedPlan().toString()


def test_dream_round_trip(spark):
    random.seed(2)
    names = [f"y_{y:02d}{w:02d}" for y in (18, 19) for w in range(1, 53)]
    data = [(f"P{i}", *[random.choice([None, "", "1", "1", "2"]) for _ in names]) for i in range(20)]
    wide = spark.createDataFrame(data, ", ".join(f"{c} string" for c in ["pnr", *names]))
    out = {}
    for pnr, code, start, end in rows(import_dream(wide)):
        for name in names:
            s, e = week_column(name)
            if start <= s and e <= end:
                assert (pnr, name) not in out
                out[pnr, name] = code
    assert out == {(r[0], n): c for r in data for n, c in zip(names, r[1:]) if c}


def test_branch_months(spark):
    wide = spark.createDataFrame([("P", "a", "a", "b")], "pnr string, br_2011_11 string, br_2011_12 string, br_2012_01 string")
    assert rows(import_dream(wide, kind="branch")) == [
        ("P", "a", d("2011-11-01"), d("2012-01-01")), ("P", "b", d("2012-01-01"), d("2012-02-01")),
    ]


def test_rows_of_one_person_are_stitched(spark):
    names = "pnr string, y_0801 string, y_0802 string, y_0803 string, y_0804 string"
    wide = spark.createDataFrame([("P", "1", "1", None, ""), ("P", None, None, "1", "2"), ("Q", "5", None, "5", "5"), (None, "7", "7", "7", "7"), ("", "7", None, None, None)], names)
    assert rows(import_deliveries([wide])) == [
        ("P", "1", d("2007-12-31"), d("2008-01-21")), ("P", "2", d("2008-01-21"), d("2008-01-28")),
        ("Q", "5", d("2007-12-31"), d("2008-01-07")), ("Q", "5", d("2008-01-14"), d("2008-01-28")),
    ]
    assert len(rows(import_dream(wide.where("pnr = 'P'")))) == 3


def test_later_deliveries_decide(spark):
    old = spark.createDataFrame([("P", "1", "1", "1"), ("Q", "1", "1", "1")], "pnr string, y_0801 string, y_0802 string, y_0803 string")
    new = spark.createDataFrame([("P", None, "1", "1"), ("R", "3", "4", "4"), ("R", "9", "4", None)], "pnr string, y_0803 string, y_0804 string, y_0806 string")
    assert rows(import_deliveries([old, new])) == [
        ("P", "1", d("2007-12-31"), d("2008-01-14")), ("P", "1", d("2008-01-21"), d("2008-01-28")), ("P", "1", d("2008-02-04"), d("2008-02-11")),
        ("Q", "1", d("2007-12-31"), d("2008-01-21")),
        ("R", "4", d("2008-01-21"), d("2008-01-28")), ("R", "4", d("2008-02-04"), d("2008-02-11")), ("R", "9", d("2008-01-14"), d("2008-01-21")),
    ]
    assert rows(import_deliveries([old.limit(0), new.limit(0)])) == []


def test_stitching_against_weeks():
    rng = random.Random(4)
    for _ in range(300):
        deliveries = []
        for _ in range(rng.randrange(1, 4)):
            low, high = sorted(rng.sample(range(12), 2))
            rows_ = [{w: rng.choice([None, None, "a", "b"]) for w in range(low, high)} for _ in range(rng.randrange(1, 3))]
            deliveries.append(rows_)
        runs, week = [], {}
        for i, rows_ in enumerate(deliveries):
            for row in rows_:
                for w, code in row.items():
                    if runs and runs[-1][0] == i and runs[-1][1] == code and runs[-1][3] == w:
                        runs[-1][3] = w + 1
                    else:
                        runs.append([i, code, w, w + 1])
            for w in rows_[0]:
                week[w] = max((r[w] or "" for r in rows_))
        want = []
        for w in sorted(week):
            if week[w] and want and want[-1][0] == week[w] and want[-1][2] == w:
                want[-1][2] = w + 1
            elif week[w]:
                want.append([week[w], w, w + 1])
        line = Stitching()
        for run in sorted(runs, key=lambda r: (r[2], rng.random())):
            line.add(*run)
        line.close()
        assert line.periods == want


def test_repeated_id_codes(spark):
    counts = spark.createDataFrame([("R", 3)], "region string, kvartal2008_1 int")
    codes = spark.createDataFrame([("R", "X2"), ("R", "X1"), (None, "X0")], "region string, idcode string")
    assert rows(lab_coverage_long(counts, codes, keys=["region"]), "quarter", "n", "idcode") == [("kvartal2008_1", 3, "X1")]


def test_coverage(spark):
    counts = spark.createDataFrame([("N", "s", "L", 3, None)], "region string, speciale string, laboratorium string, kvartal2008_1 int, kvartal2008_2 int")
    codes = spark.createDataFrame([("X1", "L", "N", "s")], "idcode string, laboratorium string, region string, speciale string")
    assert rows(lab_coverage_long(counts, codes), "quarter", "n", "idcode") == [("kvartal2008_1", 3, "X1"), ("kvartal2008_2", None, "X1")]
    assert lab_coverage_long(counts).columns == ["region", "speciale", "laboratorium", "quarter", "n"]


CLASSES = {"a": ["A"], "b": ["B1", "B2"], "c": "C"}


def test_hypertension_at(spark):
    rx = spark.createDataFrame(
        [("P", "A1", d("2010-01-01")), ("P", "B1", d("2010-06-29")), ("P", "B2", d("2010-06-30")), ("P", "C", d("2010-06-30")),
         ("Q", "A", d("2010-01-01")), ("Q", "A2", d("2010-02-01")), ("R", "ZZ", d("2010-06-01"))],
        "pnr string, atc string, eksd date",
    )
    index = spark.createDataFrame(
        [("P", d("2010-06-30")), ("P", d("2010-07-01")), ("P", d("2010-06-29")), ("Q", d("2010-03-01")), ("N", d("2010-03-01"))],
        "pnr string, index_date date",
    )
    expected = [
        ("N", d("2010-03-01"), 0, 0),
        ("P", d("2010-06-29"), 1, 0),  # the index day itself does not count
        ("P", d("2010-06-30"), 2, 1),  # 180 days back still counts
        ("P", d("2010-07-01"), 2, 1),  # 181 days back does not: b and c
        ("Q", d("2010-03-01"), 1, 0),
    ]
    assert rows(hypertension_at(rx, index, CLASSES)) == expected


def test_hypertension_first(spark):
    data = [
        ("P", "A", "2009-11-01"), ("P", "B1", "2009-12-01"), ("P", "A", "2010-02-01"), ("P", "C", "2010-03-05"), ("P", "B1", "2010-03-09"),
        ("Q", "A", "2009-11-01"), ("Q", "B1", "2009-12-01"), ("Q", "A", "2010-05-01"), ("Q", "C", "2010-05-05"),  # a quarter between
        ("R", "B1", "2009-11-01"), ("R", "B2", "2009-12-01"), ("R", "A", "2010-02-01"), ("R", "C", "2010-03-05"),  # one class at first
    ]
    rx = spark.createDataFrame([(p, a, d(x)) for p, a, x in data], "pnr string, atc string, eksd date")
    assert rows(hypertension_first(rx, CLASSES)) == [("P", d("2010-03-05"))]


def test_charlson(spark):
    data = [
        ("P", "I21", "2000-01-01"), ("P", "I22", "2000-01-02"), ("P", "E11", "2009-01-01"), ("P", "E14", "2011-01-01"),
        ("Q", "E14", "2010-01-01"), ("Q", "E11", "2010-01-01"), ("R", None, "2000-01-01"), ("S", "I21", "2010-01-02"),
    ]
    df = spark.createDataFrame([(p, c, d(x), d("2010-01-01")) for p, c, x in data], "pnr string, code string, day date, ix date")
    codes, weights = {"mi": ["I21", "I22"], "dm": ["E11"], "dm_severe": ["E14"]}, {"mi": 1, "dm": 1, "dm_severe": 2}
    args = (df, "pnr", "code", "day", "ix", codes, weights)
    index, parts = charlson(*args)
    assert rows(index, "pnr", "charlson_index") == [("P", 2), ("Q", 3), ("R", 0), ("S", 0)]
    assert rows(parts, "pnr", "mi", "dm", "dm_severe") == [("P", 1, 1, 0), ("Q", 0, 1, 1), ("R", 0, 0, 0), ("S", 0, 0, 0)]
    recent, _ = charlson(*args, lookback_days=400)
    assert rows(recent, "pnr", "charlson_index") == [("P", 1), ("Q", 3), ("R", 0), ("S", 0)]
    severe, _ = charlson(*args, severe_over_mild=[("dm_severe", "dm")])
    assert rows(severe, "pnr", "charlson_index") == [("P", 2), ("Q", 2), ("R", 0), ("S", 0)]
    # Several severe components over one mild: any of them replaces it.
    several = [("dm_severe", "mi"), ("dm", "mi")]
    both, _ = charlson(df, "pnr", "code", "day", "ix", codes, {"mi": 1, "dm": 3, "dm_severe": 4}, severe_over_mild=several)
    assert rows(both, "pnr", "charlson_index") == [("P", 3), ("Q", 7), ("R", 0), ("S", 0)]
    with pytest.raises(ValueError):
        charlson(*args, severe_over_mild=[("dm_severe", "nosuch")])
    with pytest.raises(ValueError):
        charlson(df, "pnr", "code", "day", "ix", codes, {"mi": 1})
    found = spark.createDataFrame([("P", "mi"), ("P", "mi"), ("P", "dm"), ("Q", "x")], "pnr string, condition string")
    assert rows(weighted_score(found, weights, "pnr")) == [("P", 2), ("Q", 0)]


DRUGS = {
    "x": Drug(["X"], {5.0: 5.0, 10.0: 15.0}, min_dose=2.0, max_dose=30.0, max_depot=200.0),
    "y": Drug(["Y1", "X9"], {}, min_dose=1.0, max_dose=50.0, max_depot=1000.0, n_prev=1),
}
RX = "pnr string, atc string, eksd date, apk int, packsize int, strnum double"


def expected_periods(data):
    """The documented rule, purchase by purchase."""
    out = []
    buys = {}
    for pnr, atc, day, apk, packsize, strength in data:
        for name, drug in DRUGS.items():
            if atc and any(atc.startswith(p) for p in drug.prefixes):
                old = buys.setdefault((pnr, name), {}).get(day, (0.0, 0.0))
                buys[pnr, name][day] = (old[0] + apk * packsize * strength, max(old[1], strength))
    for (pnr, name), days in buys.items():
        drug, depot, dose, run, last, amount, mine = DRUGS[name], 0.0, 1.0, [], None, 0.0, []
        for day in sorted(days):
            bought, strength = days[day]
            passed = (day - last).days if last else None
            if last is None or math.floor(depot / dose) < passed:
                dose, run, left = drug.default_doses.get(strength, strength), [], 0.0
            else:
                left = min(drug.max_depot, max(0.0, depot - dose * passed))
                run = (run + [(amount, passed)])[-drug.n_prev:]
                dose = sum(a for a, _ in run) / sum(n for _, n in run)
                dose = min(drug.max_dose, max(drug.min_dose, dose))
            depot, last, amount = left + bought, day, bought
            mine.append([day, day + dt.timedelta(days=math.floor(depot / dose)), round(dose, 6)])
        for a, b in zip(mine, mine[1:]):
            a[1] = min(a[1], b[0])
        out += [(pnr, name, s, e, dose) for s, e, dose in mine if s < e]
    return sorted(out)


def prescriptions(seed, n=250):
    random.seed(seed)
    return [
        (f"P{random.randrange(8)}", random.choice(["X1", "X2", "X9", "Y1", "Z", None]),
         d("2010-01-01") + dt.timedelta(days=random.randrange(700)),
         random.choice([0, 1, 1, 2, 5]), random.choice([10, 20, 100]), random.choice([1.0, 5.0, 10.0]))
        for _ in range(n)
    ]


@pytest.mark.parametrize("seed", [1, 2])
def test_treatment_against_loop(spark, seed):
    data = prescriptions(seed)
    df = spark.createDataFrame(data, RX).repartition(5)
    assert rows(treatment_periods(df, DRUGS)) == expected_periods(data)


def test_treatment_uses_only_the_past(spark):
    data = prescriptions(3)
    cut = d("2011-01-01")
    df = spark.createDataFrame(data, RX)
    known = {r[:3]: r[3:] for r in rows(treatment_periods(df, DRUGS))}
    early = {r[:3]: r[3:] for r in rows(treatment_periods(df.where(F.col("eksd") <= F.lit(cut)), DRUGS))}
    assert {k: v[1] for k, v in known.items() if k[2] <= cut} == {k: v[1] for k, v in early.items()}
    for (pnr, drug, start), (end, _) in early.items():
        last = max(s for p, x, s in early if (p, x) == (pnr, drug))
        assert start == last or known[pnr, drug, start][0] == end


def test_treatment_hand_case(spark):
    data = [
        ("P", "X1", d("2010-01-01"), 1, 20, 5.0),  # 100 mg, default 5 a day: 20 days
        ("P", "X1", d("2010-01-11"), 1, 20, 5.0),  # early: 50 left, 100 mg in 10 days is 10 a day, 150/10
        ("P", "X1", d("2010-03-01"), 1, 10, 10.0),  # new run: 15 a day, 6 days
    ]
    df = spark.createDataFrame(data, RX)
    assert rows(treatment_periods(df, DRUGS)) == [
        ("P", "x", d("2010-01-01"), d("2010-01-11"), 5.0),
        ("P", "x", d("2010-01-11"), d("2010-01-26"), 10.0),
        ("P", "x", d("2010-03-01"), d("2010-03-07"), 15.0),
    ]


def test_treatment_merge(spark):
    data = [("P", "Y1", d("2010-01-01") + dt.timedelta(days=10 * i), 1, 10, 1.0) for i in range(4)]
    df = spark.createDataFrame(data, RX)
    assert len(rows(treatment_periods(df, DRUGS))) == 4
    assert rows(treatment_periods(df, DRUGS, merge=True)) == [("P", "y", d("2010-01-01"), d("2010-02-10"), 1.0)]


def test_impossible_limits():
    with pytest.raises(ValueError):
        Drug(["X"], min_dose=0.0)
    with pytest.raises(ValueError):
        Drug(["X"], min_dose=2.0, max_dose=1.0)


def test_a_depot_lasts_as_long_as_it_lasts(spark):
    rx = spark.createDataFrame([("P", "Y1", d("2000-01-01"), 1, 50_000, 1.0), ("Q", "Y1", d("2000-01-01"), 10_000, 100_000, 1.0)], RX)
    drugs = {"y": Drug(["Y1"], {1.0: 1.0}, min_dose=0.001, max_dose=1e6, max_depot=1e12)}
    found = {r["pnr"]: r["end"] for r in treatment_periods(rx, drugs).collect()}
    assert found == {"P": d("2000-01-01") + dt.timedelta(days=50_000), "Q": d("9999-12-31")}


def test_day_amounts_do_not_depend_on_the_order_of_rows(spark):
    day = [("P", "Y1", d("2000-01-01"), 1, n, s) for n, s in [(3, 0.1), (7, 0.1), (1, 2.5), (2, 0.3), (9, 0.1)] * 20]
    from regspan.operators.prescriptions import daily_purchases

    found = set()
    for seed in range(5):
        random.seed(seed)
        random.shuffle(day)
        df = spark.createDataFrame(day, RX).repartition(1 + seed)
        (row,) = daily_purchases(df, DRUGS, "pnr", "atc", "eksd", "apk", "packsize", "strnum").collect()
        found.add(row["amount"])
    assert found == {100.0}
