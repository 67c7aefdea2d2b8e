"""Steps described in the source notes."""

from datetime import date

import pytest
from conftest import rows
from pyspark.sql import functions as F

from rimstone.operators import notes


def test_airports(spark):
    made = [("A", "large_airport", "US"), ("B", "small_airport", "US"), ("C", "medium_airport", "CA"), ("D", "large_airport", "FR"), (None, "large_airport", "US")]
    near = notes.near_airports(spark.createDataFrame(made, "iata_code string, type string, iso_country string"))
    assert rows(near.select("iata_code")) == sorted([("A",), ("C",), (None,)], key=repr)
    assert rows(notes.team_airports(near, ["A", "B"]).select("iata_code")) == [("A",)]
    codes = spark.createDataFrame([("A",), ("Z",)], "iata_code string")
    assert rows(notes.unresolved_codes(codes, near, "iata_code")) == [("Z",)]


def test_reference_table_faults(spark):
    teams = spark.createDataFrame([("BOS", "East"), ("LAL", None)], "code string, conference string")
    assert rows(notes.reference_faults(teams, ["code", "conference"])) == [("null_conference", 1), ("rows", 2)]
    assert rows(notes.reference_faults(teams, ["code"], rows=2)) == []


def test_arena_and_travel(spark):
    arenas = spark.createDataFrame(
        [("BOS", 42.3662, -71.0621), ("LAL", 34.043, -118.2673)], "team_abbreviation string, latitude double, longitude double"
    )
    games = spark.createDataFrame(
        [("X", date(2025, 1, 1), "BOS"), ("X", date(2025, 1, 3), "LAL"), ("X", date(2025, 1, 4), "LAL"), ("Y", date(2025, 1, 1), "??")],
        "team string, day date, team_abbreviation string",
    )
    found = notes.travel(notes.with_arena(games, arenas), "team", "day")
    got = [r["travel_km"] for r in found.where("team = 'X'").orderBy("day").collect()]
    assert got[0] is None and got[1] == pytest.approx(4170, abs=20) and got[2] == 0
    assert found.where("team = 'Y' and latitude is null").count() == 1


def test_back_to_back(spark):
    made = [("X", f"2025-01-{d:02d}") for d in (1, 2, 2, 4, 5, 6)]
    days = notes.back_to_back(spark.createDataFrame(made, "team string, day string"), "team", "day")
    assert rows(days.select(F.dayofmonth("game_day"))) == [(2,), (5,), (6,)]


def test_comments_and_verdicts(spark):
    made = [(1, "<p><!-- <table>\nx</table> --><!--b--></p>"), (2, "Just a moment <table>"), (3, "<p>"), (4, "<table></table>")]
    pages = spark.createDataFrame(made, "id int, html string")
    assert rows(notes.comment_texts(pages, "id")) == [(1, 0, " <table>\nx</table> "), (1, 1, "b")]
    assert rows(notes.page_verdicts(pages, "id")) == [(1, "ok"), (2, "challenge"), (3, "no_table"), (4, "ok")]
