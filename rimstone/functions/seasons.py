"""Season labels such as 2025-26, as columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def season_of_year(year: Column) -> Column:
    """Label of the season that starts in a year: the year, a hyphen and two digits of the next year."""
    following = F.pmod(year + 1, F.lit(100)).cast("string")
    return F.concat(year.cast("string"), F.lit("-"), F.lpad(following, 2, "0"))


def season_table(spark: SparkSession, start_year: int, end_year: int) -> DataFrame:
    """One row per season that starts in `start_year` or later and before `end_year`, with its label."""
    years = spark.range(start_year, max(start_year, end_year)).select(F.col("id").cast("int").alias("start_year"))
    return years.withColumn("season", season_of_year(F.col("start_year")))


def latest_completed_season(as_of: Column) -> Column:
    """The season that began the calendar year before a date or time."""
    return season_of_year(F.year(as_of) - 1)
