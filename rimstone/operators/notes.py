"""Small steps that the lake's source notes describe for data not yet ingested."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rimstone.operators.cleaning import require_columns

# Airports near teams, team count, and the words of a challenge page.
AIRPORT_TYPES = ("large_airport", "medium_airport")
AIRPORT_COUNTRIES = ("US", "CA")
TEAM_COUNT = 30
CHALLENGE_WORDS = ("cf-browser-verification", "Just a moment")
EARTH_RADIUS_KM = 6371.0088
COMMENT = r"(?s)<!--(.*?)-->"


def near_airports(airports: DataFrame) -> DataFrame:
    """Large and medium airports of the two countries with teams."""
    require_columns(airports, ["type", "iso_country"])
    return airports.where(F.col("type").isin(*AIRPORT_TYPES) & F.col("iso_country").isin(*AIRPORT_COUNTRIES))


def team_airports(airports: DataFrame, codes: Sequence[str]) -> DataFrame:
    """Airports whose code is one of the team markets'; the list has one code per team."""
    return airports.where(F.col("iata_code").isin(*codes))


def reference_faults(df: DataFrame, required: Sequence[str], rows: int = TEAM_COUNT) -> DataFrame:
    """Wrong row count or NULLs in a reference table, as `(fault, n)`; no row when it is sound."""
    counts = df.agg(
        F.count(F.lit(1)).alias("rows"), *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in required]
    )
    lines = [F.struct(F.lit("rows").alias("fault"), F.col("rows").alias("n"), (F.col("rows") != rows).alias("bad"))]
    lines += [
        F.struct(F.lit(f"null_{c}").alias("fault"), F.col(f"null_{c}").alias("n"), (F.col(f"null_{c}") > 0).alias("bad"))
        for c in required
    ]
    return counts.select(F.inline(F.array(*lines))).where("bad").drop("bad")


def unresolved_codes(codes: DataFrame, reference: DataFrame, key: str) -> DataFrame:
    """Codes with no row in the reference table."""
    return codes.select(key).distinct().join(reference, key, "left_anti")


def with_arena(games: DataFrame, arenas: DataFrame, team: str = "team_abbreviation") -> DataFrame:
    """Arena of each game's home team, by team code; Spark broadcasts the arena table while it is small."""
    return games.join(arenas, team, "left")


def distance_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance by the haversine formula."""
    half = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2)
    across = F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return 2 * EARTH_RADIUS_KM * F.asin(F.sqrt(half + across))


def travel(schedule: DataFrame, team: str, day: str, lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """Distance from a team's previous venue; one row per team and day, so a team's window spans its calendar."""
    w = Window.partitionBy(team).orderBy(day)
    km = distance_km(F.lag(lat).over(w), F.lag(lon).over(w), F.col(lat), F.col(lon))
    return schedule.withColumn("travel_km", km)


def back_to_back(games: DataFrame, team: str, day: str) -> DataFrame:
    """Days on which a team plays the day after another game.

    Days are made distinct first, so a team's window holds at most one row per calendar day.
    """
    days = games.select(team, F.to_date(day).alias("game_day")).distinct()
    gap = F.datediff("game_day", F.lag("game_day").over(Window.partitionBy(team).orderBy("game_day")))
    return days.withColumn("gap", gap).where("gap = 1").drop("gap")


def comment_texts(pages: DataFrame, key: str, html: str = "html") -> DataFrame:
    """Text of every HTML comment of a page, in order: `(key, pos, comment)`."""
    found = F.regexp_extract_all(html, F.lit(COMMENT), 1)
    return pages.select(key, F.posexplode(found).alias("pos", "comment"))


def page_verdicts(pages: DataFrame, key: str, html: str = "html") -> DataFrame:
    """Whether a page may be parsed: `challenge`, `no_table` or `ok`."""
    challenge = F.lit(False)
    for word in CHALLENGE_WORDS:
        challenge = challenge | F.contains(F.col(html), F.lit(word))
    verdict = F.when(challenge, "challenge").when(~F.contains(F.col(html), F.lit("<table")), "no_table").otherwise("ok")
    return pages.select(key, verdict.alias("verdict"))
