"""The study population: one row per person with entry and end of follow-up."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.codes import valid_id
from ..functions.values import plausible_death, reconciled_birth, year_dependent
from ..operators.cohort import first_event, first_event_after, first_presence, left_merge
from ..sources.files import locate
from ..sources.registers import append, read_periods, read_register


def follow_up_end(
    presence: DataFrame,
    migrations: DataFrame,
    deaths: DataFrame,
    id: str = "pnr",
    migration_date: str = "haend_dato",
    death_date: str = "doddato",
    switch_year: int = 2007,
    later_days: int = 91,
    earlier_days: int = 365,
) -> DataFrame:
    """``presence`` with first emigration after it, death and the end of follow-up.

    ``out`` becomes the earliest of: last presence plus 91 or 365 days (by its
    year), the first emigration after the last presence, and death. A death
    before entry is ignored. Repeated ids in the event tables cannot multiply persons.
    """
    left = first_event_after(migrations, presence, id, migration_date, "out")
    died = first_event(deaths, id, death_date)
    extended = F.date_add(
        F.col("out"), year_dependent(F.col("out"), switch_year, later_days, earlier_days)
    )
    return (
        left_merge(presence, [left, died], id)
        .withColumn(death_date, plausible_death(F.col(death_date), F.col("inn")))
        .withColumn("out", F.least(extended, F.col(death_date), F.col(migration_date)))
    )


def study_population(
    snapshots: DataFrame,
    persons: DataFrame,
    migrations: DataFrame,
    deaths: DataFrame,
    switch_year: int = 2007,
    later_gap: int = 95,
    earlier_gap: int = 370,
    later_days: int = 91,
    earlier_days: int = 365,
) -> DataFrame:
    """``(pnr, foed_dag, koen, inn, out, haend_dato, doddato)``, unique on ``pnr``.

    ``snapshots``: pnr, koen, foed_dag, referencetid; ``persons``: pnr,
    foed_dag_person; ``migrations`` (out only): pnr, haend_dato; ``deaths``:
    pnr, doddato.
    """
    presence = first_presence(
        snapshots, "pnr", "referencetid", ["foed_dag", "koen"], switch_year, later_gap, earlier_gap
    )
    births = first_event(persons, "pnr", "foed_dag_person")
    followed = follow_up_end(
        presence, migrations, deaths, "pnr", "haend_dato", "doddato",
        switch_year, later_days, earlier_days,
    )
    return followed.join(births, "pnr", "left").select(
        "pnr",
        reconciled_birth(F.col("foed_dag_person"), F.col("foed_dag")).alias("foed_dag"),
        "koen", "inn", "out", "haend_dato", "doddato",
    )


def read_population(
    spark: SparkSession, root: str, migration_file: str = "vnds2024.parquet"
) -> DataFrame:
    """``study_population`` from a register tree.

    ``root/Grunddata/Population`` holds ``fainYYYY…`` (reference date: the last
    day of the year in the name), ``befYYYY…``, ``t_person`` and the migration
    file; ``root/Grunddata/Death`` holds ``dod``.
    """
    folder = locate(spark, root, "Grunddata", "Population")
    dates = {"foed_dag": "date", "referencetid": "date"}
    fain = read_periods(spark, folder, "fain", ["pnr", "koen"], period="_year")
    fain = fain.withColumn("referencetid", F.make_date("_year", F.lit(12), F.lit(31))).drop("_year")
    bef = read_periods(spark, folder, "bef", ["pnr", "koen", "foed_dag", "referencetid"], dates)
    snapshots = append([fain, bef]).where(valid_id(F.col("pnr")))
    persons = read_register(spark, locate(spark, folder, "t_person.parquet")).select(
        F.col("v_pnr").alias("pnr"), F.col("d_foddato").cast("date").alias("foed_dag_person")
    )
    migrations = read_register(spark, locate(spark, folder, migration_file))
    migrations = migrations.where(F.col("indud_kode") == "U").select(
        "pnr", F.col("haend_dato").cast("date").alias("haend_dato")
    )
    deaths = read_register(spark, locate(spark, root, "Grunddata", "Death", "dod.parquet"))
    deaths = deaths.select("pnr", F.col("doddato").cast("date").alias("doddato"))
    return study_population(snapshots, persons, migrations, deaths)
