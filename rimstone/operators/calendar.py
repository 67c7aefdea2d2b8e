"""Report slots of a year, their file names, and which of them are missing."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rimstone.operators.skew import spread_join

# The public address of the reports, and the text before the slot in a file name.
REPORT_BASE = "https://ak-static.cms.nba.com/referee/injury"
REPORT_PREFIX = "Injury-Report_"
# No reports from July to September; 15-minute reports from 2026 on; first year is 2018.
OFF_SEASON = (7, 9)
FIRST_QUARTER_YEAR = 2026
FIRST_YEAR = 2018


def year_table(spark: SparkSession, start: int = FIRST_YEAR, end: int = FIRST_QUARTER_YEAR) -> DataFrame:
    """The report years, last one included."""
    return spark.range(start, end + 1).select(F.col("id").cast("int").alias("year"))


def slot_text(time: Column, quarterly: Column) -> Column:
    """Text of a slot in file names: 2024-01-01_09AM for hourly, 2026-01-01_09_15AM for 15-minute reports.

    Put together from the parts of the wall-clock time; `date_format` would take it through the session's
    time zone and move slots that fall into a clock change.
    """
    hour = F.hour(time)
    twelve = F.lpad((F.pmod(hour + 11, F.lit(12)) + 1).cast("string"), 2, "0")
    minute = F.concat(F.lit("_"), F.lpad(F.minute(time).cast("string"), 2, "0"))
    half = F.when(hour < 12, "AM").otherwise("PM")
    return F.concat(F.to_date(time).cast("string"), F.lit("_"), twelve, F.when(quarterly, minute).otherwise(""), half)


def slot_calendar(
    years: DataFrame, as_of: datetime | Column, *, quarter_from: int = FIRST_QUARTER_YEAR
) -> DataFrame:
    """Every slot of the given years that is in season and not after `as_of`, a wall-clock time.

    A year runs from 1 January 00:00 to 31 December 00:00, so the last day has one slot only.
    """
    limit = F.lit(as_of.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz") if isinstance(as_of, datetime) else as_of
    quarterly = F.col("year") >= quarter_from
    start = F.make_timestamp_ntz("year", F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0))
    end = F.make_timestamp_ntz("year", F.lit(12), F.lit(31), F.lit(0), F.lit(0), F.lit(0))
    step = F.when(quarterly, F.expr("interval 15 minutes")).otherwise(F.expr("interval 60 minutes"))
    slots = years.select("year", F.explode(F.sequence(start, end, step)).alias("slot_time"))
    in_season = ~F.month("slot_time").between(*OFF_SEASON)
    return slots.where(in_season & (F.col("slot_time") <= limit)).withColumn(
        "slot", slot_text(F.col("slot_time"), quarterly)
    )


def report_urls(slots: DataFrame) -> DataFrame:
    """Add the file name and address of each slot's report."""
    name = F.concat(F.lit(REPORT_PREFIX), F.col("slot"), F.lit(".pdf"))
    return slots.withColumn("file_name", name).withColumn("url", F.concat(F.lit(f"{REPORT_BASE}/"), name))


def missing_slots(slots: DataFrame, present: DataFrame, key: str) -> DataFrame:
    """Slots for which no file is present."""
    return spread_join(slots, present.select(key).distinct(), [key], "left_anti")
