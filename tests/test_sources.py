"""Reading, describing and writing registers, and the study from a register tree."""

import os
import subprocess
import sys

import pytest
from helpers import d, plan, rows
from pyspark.sql import functions as F

from regspan.functions.codes import valid_id
from regspan.functions.values import alive_from, numeric_result, text_result
from regspan.plans import extracts
from regspan.plans.population import read_population
from regspan.session import shared_folder
from regspan.sources.buckets import read_bucketed, save_bucketed
from regspan.sources.files import list_names, list_periods, locate
from regspan.sources.inventory import dataset_contents, dataset_of, inventory, project_inventory
from regspan.sources.rebuilt import fingerprint, rebuilt
from regspan.sources.registers import (
    append,
    cast_failures,
    extract,
    read_periods,
    read_register,
    select_prefix,
)
from regspan.sources.sinks import materialise

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SF = os.environ.get("SF_DIR", "/root/testdata/sf0.001")


def write(spark, path, data, schema):
    spark.createDataFrame(data, schema).write.mode("overwrite").parquet(str(path))


@pytest.fixture
def yearly(spark, tmp_path):
    write(spark, tmp_path / "lmdb201312.parquet", [("P0", "C03")], "pnr string, atc string")
    write(spark, tmp_path / "lmdb201412.parquet", [("P1", "C03")], "PNR string, ATC string")
    write(spark, tmp_path / "lmdb201512.parquet", [("P1", "C07", 2.5)], "pnr string, atc string, volume double")
    write(spark, tmp_path / "lmdb201506.parquet", [("P9", "C07", 2.5)], "pnr string, atc string, volume double")
    write(spark, tmp_path / "lmdb202212.parquet", [("P2", "C03", 1.0)], "pnr string, atc string, volume double")
    write(spark, tmp_path / "other201512.parquet", [("P9",)], "pnr string")
    return str(tmp_path)


def test_period_selection(spark, yearly):
    assert list(list_periods(spark, yearly, extracts.MEDICATION_FILES)) == [
        "lmdb201412.parquet", "lmdb201512.parquet", "lmdb202212.parquet"
    ]
    with pytest.raises(FileNotFoundError):
        read_periods(spark, yearly, "bef")


def test_period_scan_with_drift(spark, yearly):
    df = read_periods(spark, yearly, extracts.MEDICATION_FILES, ["pnr", "atc", "volume"], period="source_year")
    assert df.columns == ["pnr", "atc", "volume", "source_year"]
    assert dict(df.dtypes)["source_year"] == "int"
    assert rows(df, "pnr", "source_year", "volume") == [("P1", 2014, None), ("P1", 2015, 2.5), ("P2", 2022, 1.0)]
    # All columns when none are listed.
    assert set(read_periods(spark, yearly, r"lmdb2015").columns) == {"pnr", "atc", "volume"}
    text = plan(read_periods(spark, yearly, r"lmdb2015", ["pnr"]).where("pnr = 'P1'"))
    assert "ReadSchema: struct<pnr:string>" in text and "EqualTo(pnr,P1)" in text
    with pytest.raises(ValueError, match="nosuch"):
        read_periods(spark, yearly, r"lmdb2015", ["pnr", "nosuch"])


def test_period_types(spark, tmp_path):
    write(spark, tmp_path / "udda2014", [("P1", 10)], "pnr string, hfaudd int")
    write(spark, tmp_path / "udda2015", [("P1", "11")], "pnr string, hfaudd string")
    with pytest.raises(TypeError, match="hfaudd"):
        read_periods(spark, str(tmp_path), extracts.EDUCATION_FILES)
    df = read_periods(spark, str(tmp_path), extracts.EDUCATION_FILES, types={"hfaudd": "string"}, period="year")
    assert rows(df, "year", "hfaudd") == [(2014, "10"), (2015, "11")]
    write(spark, tmp_path / "udda2016", [("P1", "x")], "pnr string, hfaudd string")
    bad = read_periods(spark, str(tmp_path), "udda", types={"hfaudd": "int"})
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        bad.collect()
    raw = read_periods(spark, str(tmp_path), "udda", types={"hfaudd": "string"})
    assert rows(cast_failures(raw, {"hfaudd": "int", "pnr": "string"})) == [(1, 0)]


def test_locate_ignores_case(spark, tmp_path):
    write(spark, tmp_path / "Grunddata" / "Death" / "dod.parquet", [(1,)], "a int")
    assert locate(spark, str(tmp_path), "grunddata", "DEATH", "dod.parquet").endswith("/Grunddata/Death/dod.parquet")
    with pytest.raises(FileNotFoundError):
        locate(spark, str(tmp_path), "Grunddata", "Birth")
    folder = str(tmp_path / "Grunddata" / "Death" / "dod.parquet")
    assert all(not n.startswith("_") for n in list_names(spark, folder))


def test_read_and_cut(spark, tmp_path):
    path = str(tmp_path / "dream.parquet")
    write(spark, path, [("P1", "a", "b", 1)], "PNR string, Y_0801 string, y_0802 string, other int")
    assert read_register(spark, path, ["PNR", "Other"]).columns == ["pnr", "other"]
    wide = select_prefix(spark.read.parquet(path), ["PNR"], "Y_")
    assert wide.columns == ["pnr", "y_0801", "y_0802"]
    assert "other" not in plan(wide).split("ReadSchema")[1]
    df = spark.range(100)
    assert extract(df, ["id"], F.col("id") > 10, 5).count() == 5
    assert extract(df, where=F.col("id") > 10).count() == 89
    assert rows(append([spark.range(1).select("id"), spark.createDataFrame([("x", 5)], "a string, id long")]), "id", "a") == [(0, None), (5, "x")]


def test_inventory(spark, tmp_path):
    write(spark, tmp_path / "a.parquet", [("P1", 1.5), (None, 2.5), ("P1", None)], "pnr string, v double")
    write(spark, tmp_path / "b", [(1,)], "n int")
    assert rows(inventory(spark, str(tmp_path))) == [
        ("a", "pnr", "string", 3), ("a", "v", "double", 3), ("b", "n", "int", 1)
    ]
    out = dataset_contents(spark.read.parquet(str(tmp_path / "a.parquet")), "a")
    assert rows(out) == [
        ("a", "pnr", "string", 3, 2, 1, "P1", "P1"), ("a", "v", "double", 3, 2, 2, "1.5", "2.5")
    ]
    nested = spark.range(2).select(F.array("id").alias("xs"))
    assert rows(dataset_contents(nested), "column", "non_null", "distinct", "least") == [("xs", 2, None, None)]


def test_materialise(spark, tmp_path):
    df = spark.range(50).withColumn("pnr", F.col("id") % 5)
    kept = materialise(df, str(tmp_path / "kept"), ["pnr"])
    assert kept.count() == 50 and kept.columns == df.columns
    assert "Range" not in plan(kept)
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir", shared_folder(spark)).rstrip("/")


def test_bucketed_registers_meet_without_shuffle(spark, tmp_path):
    from catalogue.scans import bucket_merge, bucketed_registers

    df = spark.range(1000).select(F.col("id").alias("pnr"), (F.col("id") * 2).alias("v"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        one = save_bucketed(df, f"{tmp_path}/one", 8)
        two = save_bucketed(df.withColumnRenamed("v", "w"), f"{tmp_path}/two", 4)
        joined = one.join(two, "pnr").groupBy("pnr").agg(F.sum("w"))
        assert "Exchange" not in plan(joined) and "SortMergeJoin" in plan(joined)
        assert joined.count() == 1000
        assert len(two.inputFiles()) == 4
        again = read_bucketed(spark.newSession(), f"{tmp_path}/two")
        assert "Bucketed: true" in plan(again.groupBy("pnr").count()) and rows(again) == rows(two)
        merged = bucket_merge(*bucketed_registers(spark, SF))
        assert "Exchange" not in plan(merged) and plan(merged).count("SortMergeJoin") >= 4
        save_bucketed(df.limit(5), f"{tmp_path}/one", 2)
        assert read_bucketed(spark, f"{tmp_path}/one").count() == 5
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def listing(path):
    return sorted((f, os.stat(os.path.join(at, f)).st_mtime_ns) for at, _, files in os.walk(path) for f in files)


def test_rebuilt_only_when_something_changed(spark, tmp_path):
    source, kept = f"{tmp_path}/source", f"{tmp_path}/kept"
    spark.range(100).write.parquet(source)

    def made(parameters=None, least=5, **more):
        df = spark.read.parquet(source).where(F.col("id") >= least).withColumnRenamed("id", "n")
        return rebuilt(df, kept, parameters, **more)

    assert made().count() == 95
    before = listing(kept)
    assert made().count() == 95 and listing(kept) == before
    assert made(least=6).count() == 94 and listing(kept) != before  # another plan
    assert len(os.listdir(kept)) == 1
    assert made({"year": 2020}).count() == 95  # another parameter
    before = listing(kept)
    spark.range(100, 110).write.mode("append").parquet(source)  # another file
    assert made({"year": 2020}).count() == 105 and listing(kept) != before
    assert made(keep_builds=2).count() == 105 and len(os.listdir(kept)) == 2
    one = next(f for f in os.listdir(source) if f.startswith("part"))
    before = listing(kept)
    os.utime(f"{source}/{one}", (1, 1))  # the same file, touched
    assert made(keep_builds=2).count() == 105 and listing(kept) != before


def test_fingerprints_tell_sources_apart(spark, tmp_path):
    for name, n in (("a", 3), ("b", 4)):
        spark.range(n).write.parquet(f"{tmp_path}/{name}")
    a, b = (spark.read.parquet(f"{tmp_path}/{n}") for n in "ab")
    assert fingerprint(a.join(b, "id", "left")) != fingerprint(b.join(a, "id", "left"))
    assert fingerprint(a) != fingerprint(a.toDF("other")) and fingerprint(a) == fingerprint(spark.read.parquet(f"{tmp_path}/a"))
    held = spark.createDataFrame([(1,)], "id long")
    with pytest.raises(ValueError, match="not files"):
        fingerprint(a.join(held, "id"))
    assert fingerprint(a.join(held, "id"), {"ids": [1]}) != fingerprint(a.join(held, "id"), {"ids": [2]})


def test_failed_build_leaves_the_earlier_one(spark, tmp_path):
    source, kept = f"{tmp_path}/source", f"{tmp_path}/kept"
    spark.range(10).write.parquet(source)
    rebuilt(spark.read.parquet(source), kept)
    before = sorted(os.listdir(kept))
    bad = spark.read.parquet(source).select(F.raise_error(F.lit("no")).cast("long").alias("id"))
    with pytest.raises(Exception, match="no"):
        rebuilt(bad, kept)
    assert sorted(os.listdir(kept)) == before


def test_project_tree(spark, tmp_path):
    root = tmp_path / "project 1"
    spark.range(5).write.parquet(f"{root}/Grunddata/cpr/person.parquet")
    for year, kind in ((2001, "int"), (2002, "string")):
        df = spark.range(year - 2000).select(F.col("id").cast(kind).alias("v"), F.lit(1.5).alias("w"), F.current_date().alias("d"))
        df.write.partitionBy("w").parquet(f"{root}/Grunddata/lab/year={year}")
    spark.range(2).toPandas().to_parquet(f"{root}/single.parquet")
    spark.range(3).write.json(f"{root}/notes")
    found = project_inventory(spark, str(root))
    assert rows(found.drop("files")) == [
        ("Grunddata/cpr/person", "id", "bigint", 5), ("Grunddata/lab", "d", "date", 3), ("Grunddata/lab", "v", "int", 1),
        ("Grunddata/lab", "v", "string", 2), ("single", "id", "bigint", 2),
    ]
    files = spark.read.parquet(f"{root}/Grunddata/cpr/person.parquet").inputFiles()
    assert found.where("dataset LIKE '%person'").first().files == len(files)
    assert dataset_of("file:/r/a/b.parquet/x=1/part-0.parquet", "file:/r") == "a/b"
    assert dataset_of("file:/r/a/b.parquet", "file:/r") == "a/b"


def test_stock_session_without_a_shared_folder(tmp_path):
    """A plain local session, with no setting from anywhere."""
    code = f"""
import sys; sys.path.insert(0, {ROOT!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
assert spark.conf.get("spark.checkpoint.dir", None) is None
from catalogue import QUERIES
from regspan.session import shared_folder
print("rows", QUERIES["incidence_matching"](spark, {SF!r}).count(), shared_folder(spark) == shared_folder(spark.newSession()))
"""
    (tmp_path / "conf").mkdir()
    env = {k: v for k, v in os.environ.items() if k != "SPARK_CONF_DIR"} | {"SPARK_CONF_DIR": str(tmp_path / "conf")}
    done = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, timeout=600)
    assert done.returncode == 0, done.stderr[-2000:]
    assert int(done.stdout.split()[1]) > 0 and done.stdout.split()[2] == "True"


def test_row_rules(spark):
    df = spark.createDataFrame(
        [("01", None), ("07", None), ("90", d("1990-01-01")), ("70", d("1989-12-31")), ("80", None), ("20", d("2000-01-01")), (None, None)],
        "status string, since date",
    )
    kept = df.where(alive_from(F.col("status"), F.col("since")))
    assert [r["status"] for r in kept.collect()] == ["01", "07", "90"]
    values = spark.createDataFrame([("1.5", "N"), ("<5", "N"), ("neg", "A"), (None, "N"), ("7", "A")], "value string, kind string")
    args = F.col("value"), F.col("kind"), ["N"]
    out = [tuple(r) for r in values.select(numeric_result(*args), text_result(*args)).collect()]
    assert out == [(1.5, None), (None, "<5"), (None, "neg"), (None, None), (None, "7")]
    ids = spark.createDataFrame([("P",), ("",), (None,)], "pnr string")
    assert rows(ids.where(valid_id(F.col("pnr")))) == [("P",)]


@pytest.fixture
def tree(spark, tmp_path):
    g = tmp_path / "Grunddata"
    pop = g / "Population"
    write(spark, pop / "fain1984.parquet", [("P1", "1"), ("P3", "2"), ("", "1")], "PNR string, KOEN string")
    bef = "pnr string, foed_dag date, koen string, referencetid date"
    write(spark, pop / "bef1985.parquet", [("P1", d("1950-01-01"), "1", d("1985-12-31"))], bef)
    write(spark, pop / "bef200803.parquet", [("P2", d("1960-01-01"), "2", d("2008-03-31"))], bef)
    write(spark, pop / "t_person.parquet", [("P1", d("1950-02-02")), (None, d("1950-02-02"))], "v_pnr string, d_foddato date")
    write(spark, pop / "vnds2024.parquet", [("P2", "2008-05-01", "U"), ("P1", "1986-01-15", "I")], "pnr string, haend_dato string, indud_kode string")
    write(spark, g / "Death" / "dod.parquet", [("P1", "1986-02-01"), ("P9", "1990-01-01")], "pnr string, doddato string")
    write(spark, g / "cancer" / "tumor_aarlig.parquet", [("P1", "t1"), ("P9", "t2")], "PNR string, TUMOR string")
    write(spark, g / "laboratory" / "laboratorieproevesvar.parquet",
          [("P1", "NPU03230", d("1985-01-01"), 4.1), ("P1", "NPU03231", d("1985-01-01"), 4.1), ("P9", "NPU03429", d("1985-01-01"), 140.0), ("P2", "NPU03429", d("2008-01-01"), 139.0)],
          "pnr string, analysiscode string, samplingdate date, samplevalue double")
    write(spark, g / "lpr" / "diag_indl.parquet", [("P1", "4101", d("1985-06-01"), "0")], "pnr string, diag string, inddto date, pattype string")
    write(spark, g / "lpr" / "diagnoser.parquet", [("k1", "DI200")], "dw_ek_kontakt string, diagnosekode string")
    write(spark, g / "lpr" / "kontakter.parquet", [("k1", "P2", d("2008-03-01"), "10:00:00", d("2008-03-02"), "10:00:00", "ALCA00")],
          "dw_ek_kontakt string, cpr string, dato_start date, tidspunkt_start string, dato_slut date, tidspunkt_slut string, kontakttype string")
    med = "pnr string, atc string, eksd date, packsize double"
    write(spark, g / "medication" / "lmdb201412.parquet", [("P1", "C03A", d("2014-01-01"), 10.0), ("P1", "N05", d("2014-01-01"), 10.0)], med)
    write(spark, g / "medication" / "lmdb201512.parquet", [("P2", "C07", d("2015-01-01"), 1.0, 10.0)], med.replace("packsize", "volume double, packsize"))
    write(spark, g / "Social" / "dream202509.parquet", [("P1", "111", "111"), ("P9", "1", "1")], "PNR string, Y_0801 string, Y_0802 string")
    write(spark, g / "Social" / "udda2014.parquet", [("P1", "10"), ("P9", "10")], "pnr string, hfaudd string")
    return str(tmp_path)


def test_study_from_tree(spark, tree):
    population = read_population(spark, tree)
    assert rows(population) == [
        ("P1", d("1950-02-02"), "1", d("1984-12-31"), d("1986-02-01"), None, d("1986-02-01")),
        ("P2", d("1960-01-01"), "2", d("2008-03-31"), d("2008-05-01"), d("2008-05-01"), None),
        ("P3", None, "2", d("1984-12-31"), d("1985-12-31"), None, None),
    ]
    assert rows(extracts.read_cancer(spark, tree, population)) == [("P1", "t1")]
    assert rows(extracts.read_death(spark, tree, population)) == [("P1", "1986-02-01")]
    assert rows(extracts.read_lab(spark, tree, population), "pnr", "condition", "samplevalue") == [
        ("P1", "potassium", 4.1), ("P2", "sodium", 139.0)
    ]
    assert rows(extracts.read_hospital(spark, tree, population)) == [
        ("P1", d("1985-06-01"), "ami"), ("P2", d("2008-03-01"), "angina")
    ]
    assert rows(extracts.read_medication(spark, tree, population)) == [
        ("P1", "C03A", d("2014-01-01"), None, 10.0, "diuretics"), ("P2", "C07", d("2015-01-01"), 1.0, 10.0, "betablocker")
    ]
    assert rows(extracts.read_dream(spark, tree, population)) == [("P1", "111", d("2007-12-31"), d("2008-01-14"))]
    lookup = spark.createDataFrame([("10", 2)], "hfaudd string, level5 int")
    assert rows(extracts.read_education(spark, tree, population, lookup), "pnr", "year", "level5") == [("P1", 2014, 2)]


def test_year_from_an_encoded_name(spark, tmp_path):
    for name in ("bef 1985", "bef 2019+x", "bef é 2001"):
        write(spark, tmp_path / name, [(name,)], "pnr string")
    df = read_periods(spark, str(tmp_path), "bef", period="year")
    found = {r["pnr"]: r["year"] for r in df.collect()}
    assert found == {"bef 1985": 1985, "bef 2019+x": 2019, "bef é 2001": 2001}


def test_drift_between_the_files_of_a_directory(spark, tmp_path):
    write(spark, tmp_path / "a", [("P1",)], "pnr string")
    write(spark, tmp_path / "b", [("P2", 1)], "pnr string, v int")
    write(spark, tmp_path / "c", [("P3", "x")], "pnr string, v string")
    folder = tmp_path / "reg" / "udda2014"
    folder.mkdir(parents=True)

    def move(name):
        for i, part in enumerate((tmp_path / name).glob("part-*.parquet")):
            part.rename(folder / f"{name}{i}.parquet")

    for name in "ab":
        move(name)
    df = read_periods(spark, str(tmp_path / "reg"), "udda")
    assert rows(df, "pnr", "v") == [("P1", None), ("P2", 1)]
    move("c")
    with pytest.raises(TypeError, match="udda2014"):
        read_periods(spark, str(tmp_path / "reg"), "udda")


def test_contents_compute_only_what_is_asked(spark):
    df = spark.createDataFrame([("a", 1), (None, 2)], "s string, n int")
    found = dataset_contents(df, "t", ["rows", "non_null"])
    assert found.columns == ["dataset", "column", "type", "rows", "non_null"]
    assert rows(found, "column", "rows", "non_null") == [("n", 2, 2), ("s", 2, 1)]
    text = plan(found)
    assert "approx_count_distinct" not in text and "min(" not in text
    with pytest.raises(ValueError):
        dataset_contents(df, measures=["median"])


def test_release_deletes_what_was_kept(spark):
    from regspan.session import own_folder, release
    from regspan.sources.sinks import keep

    kept = keep(spark.range(3), "numbers")
    assert kept.count() == 3 and list_names(spark, own_folder(spark))
    release(spark)
    with pytest.raises(Exception):
        list_names(spark, own_folder(spark))
