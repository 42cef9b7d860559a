"""Register extracts of a study population."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.codes import Conditions, condition_lists, starts_with_any
from ..functions.dates import seconds_between
from ..functions.values import numeric_result, text_result
from ..operators.benefits import import_dream
from ..operators.cohort import cohort_extract, left_merge, listed_codes, restrict
from ..operators.conditions import find_condition
from ..sources.files import locate
from ..sources.registers import append, read_periods, read_register, select_prefix

HALF_DAY = 12 * 60 * 60


def _any_prefix(column: str, conditions: Conditions):
    prefixes = [p for ps in condition_lists(conditions).values() for p in ps]
    return starts_with_any(F.col(column), prefixes)


def hospital_conditions(
    admissions: DataFrame,
    diagnoses: DataFrame,
    contacts: DataFrame,
    population: DataFrame,
    conditions: Conditions,
    patient_type: str = "0",
    contact_type: str = "ALCA00",
    longer_than: int = HALF_DAY,
) -> DataFrame:
    """``(pnr, inddto, condition)`` from the older and the newer hospital register.

    Older: ``admissions`` (pnr, diag, inddto, pattype) of one patient type.
    Newer: ``diagnoses`` (dw_ek_kontakt, diagnosekode) of ``contacts``
    (dw_ek_kontakt, cpr, start and end date and time, kontakttype) of one type
    that last strictly longer than 12 hours of wall-clock time; a contact
    without an end does not count. Both sides are filtered before they meet.
    """
    older = restrict(
        admissions.where((F.col("pattype") == patient_type) & _any_prefix("diag", conditions))
        .select("pnr", "diag", "inddto"),
        population,
    )
    lasted = seconds_between(
        F.col("dato_start"), F.col("tidspunkt_start"), F.col("dato_slut"), F.col("tidspunkt_slut")
    )
    stays = contacts.where((F.col("kontakttype") == contact_type) & (lasted > longer_than)).select("dw_ek_kontakt", F.col("cpr").alias("pnr"), F.col("dato_start").alias("inddto"))
    wanted = diagnoses.where(_any_prefix("diagnosekode", conditions)).select(
        "dw_ek_kontakt", F.col("diagnosekode").alias("diag")
    )
    newer = wanted.join(restrict(stays, population), "dw_ek_kontakt")
    keep = ["pnr", "inddto"]
    return append(find_condition(df, "diag", keep, conditions) for df in (older, newer))


def lab_results(
    register: DataFrame,
    population: DataFrame,
    conditions: Conditions,
    columns: Sequence[str] = ("pnr", "samplingdate", "samplevalue"),
    code: str = "analysiscode",
) -> DataFrame:
    """Laboratory results of the population for named analyses."""
    wanted = [code, *columns]
    rows = cohort_extract(register, population, wanted, _any_prefix(code, conditions))
    return find_condition(rows, code, columns, conditions)


def laboratory_values(
    register: DataFrame,
    population: DataFrame,
    codes: DataFrame,
    conditions: Conditions | None = None,
    columns: Sequence[str] = ("pnr", "samplingdate"),
    code: str = "analysiscode",
    value: str = "value",
    result_type: str = "resulttype",
    numeric_types: Sequence[str] = ("N",),
) -> DataFrame:
    """Results of listed analyses with their value as ``number`` or, where it is none, as ``note``.

    ``codes`` is a list of exact codes; its set is tested in the scan, in front of the prefixes
    of ``conditions``, which name the analyses (without them, the code itself stays). A value whose type says it
    is numeric and that is a number goes to ``number``, anything else to ``note``. One pass over the register.
    """
    rows = listed_codes(register, code, codes)
    where = None if conditions is None else _any_prefix(code, conditions)
    rows = cohort_extract(rows, population, [code, *columns, value, result_type], where)
    split = F.col(value), F.col(result_type), list(numeric_types)
    shown = rows.withColumn("number", numeric_result(*split)).withColumn("note", text_result(*split))
    kept = [*columns, "number", "note"]
    if conditions is None:
        return shown.select(code, *kept)
    return find_condition(shown, code, kept, conditions)


def medication(
    register: DataFrame,
    population: DataFrame,
    conditions: Conditions,
    columns: Sequence[str] = ("pnr", "atc", "eksd", "volume", "packsize"),
    code: str = "atc",
) -> DataFrame:
    """Dispensed prescriptions of the population for named drug groups."""
    wanted = [code, *columns]
    rows = cohort_extract(register, population, wanted, _any_prefix(code, conditions))
    return find_condition(rows, code, columns, conditions)


def education_level(
    register: DataFrame, population: DataFrame, lookup: DataFrame | None, code: str = "hfaudd"
) -> DataFrame:
    """Education records of the population with the levels of a code table.

    A code the table does not know keeps its row with null levels; one that it repeats counts with
    its least row there, see ``left_merge``.
    """
    rows = restrict(register, population)
    return rows if lookup is None else left_merge(rows, [lookup], code)


# Directory-name patterns of the yearly registers.
MEDICATION_FILES = r"lmdb20(14|1[5-9]|2[0-2])12.*"
EDUCATION_FILES = r"udda20(14|1[5-9]|2[0-2]).*"
# Code lists of the example study.
LABORATORY = {"potassium": ["NPU03230"], "sodium": ["NPU03429"]}
HEART = {"ami": ["410", "DI21"], "angina": ["413", "DI20"]}
DRUGS = {"diuretics": ["C03"], "betablocker": ["C07"]}


def read_cancer(spark: SparkSession, root: str, population: DataFrame) -> DataFrame:
    path = locate(spark, root, "Grunddata", "cancer", "tumor_aarlig.parquet")
    return cohort_extract(read_register(spark, path), population)


def read_death(spark: SparkSession, root: str, population: DataFrame) -> DataFrame:
    path = locate(spark, root, "Grunddata", "death", "dod.parquet")
    return cohort_extract(read_register(spark, path), population)


def read_lab(
    spark: SparkSession, root: str, population: DataFrame, conditions: Conditions = LABORATORY
) -> DataFrame:
    path = locate(spark, root, "Grunddata", "laboratory", "laboratorieproevesvar.parquet")
    return lab_results(read_register(spark, path), population, conditions)


def read_hospital(
    spark: SparkSession, root: str, population: DataFrame, conditions: Conditions = HEART
) -> DataFrame:
    tables = [
        read_register(spark, locate(spark, root, "Grunddata", "lpr", f"{name}.parquet"))
        for name in ("diag_indl", "diagnoser", "kontakter")
    ]
    return hospital_conditions(*tables, population, conditions)


def read_medication(
    spark: SparkSession, root: str, population: DataFrame,
    conditions: Conditions = DRUGS, files: str = MEDICATION_FILES,
) -> DataFrame:
    folder = locate(spark, root, "Grunddata", "medication")
    columns = ["pnr", "atc", "eksd", "volume", "packsize"]
    register = read_periods(spark, folder, files, columns, period="source_year")
    return medication(register, population, conditions, columns)


def read_dream(
    spark: SparkSession, root: str, population: DataFrame, file: str = "dream202509.parquet"
) -> DataFrame:
    wide = spark.read.parquet(locate(spark, root, "Grunddata", "Social", file))
    return import_dream(restrict(select_prefix(wide, ["PNR"], "Y_"), population))


def read_education(
    spark: SparkSession, root: str, population: DataFrame,
    lookup: DataFrame | None = None, files: str = EDUCATION_FILES,
) -> DataFrame:
    folder = locate(spark, root, "Grunddata", "social")
    register = read_periods(spark, folder, files, ["pnr", "hfaudd"], period="year")
    return education_level(register, population, lookup)
