"""Average income before a date."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F



def average_income(
    ids: DataFrame,
    income: DataFrame,
    id: str = "id",
    date: str = "date",
    year: str = "year",
    amount: str = "income",
    years: int = 5,
) -> DataFrame:
    """Every row of ``ids`` with ``average_income`` and ``years_found``.

    Our rule: the mean of the non-null incomes of the ``years`` calendar years
    before the year of the date (that year not included), and the number of
    years that had one; null and 0 where there is none. Incomes are reduced to
    one row per id and year first, and so are the dates.
    """
    yearly = (
        income.where(F.col(amount).isNotNull())
        .groupBy(id, F.col(year).alias("_year"))
        .agg(F.sum(amount).alias("_sum"), F.count(amount).alias("_n"))
    )
    wanted = ids.select(id, F.year(date).alias("_index_year")).distinct()
    window = (F.col("_year") >= F.col("_index_year") - years) & (F.col("_year") < F.col("_index_year"))
    means = (
        wanted.join(yearly, id)
        .where(window)
        .groupBy(id, "_index_year")
        .agg(
            (F.sum("_sum") / F.sum("_n")).alias("average_income"),
            F.count("_year").alias("years_found"),
        )
    )
    dated = ids.withColumn("_index_year", F.year(date))
    return dated.join(means, [id, "_index_year"], "left").select(
        *ids.columns, "average_income", F.coalesce("years_found", F.lit(0)).alias("years_found")
    )
