from datetime import date

import pytest
from conftest import rows
from pyspark.sql import functions as F

from rimstone import functions as fn
from rimstone.errors import MissingSuffix
from rimstone.sinks import naming

NAMES = ["CurrentStatus", "Game Date", "TEAM_ID", "team", "GameDate Time"]
SNAKES = ["current_status", "game_date", "t_ea_m__id", "team", "game_date_time"]


def test_snake_names(spark):
    assert fn.snake_names(NAMES) == SNAKES and fn.snake_names([]) == []


def test_snake_column_agrees(spark):
    df = spark.createDataFrame([(n,) for n in NAMES], "name string")
    assert rows(df.select("name", fn.snake("name"))) == sorted(zip(NAMES, SNAKES), key=repr)


def test_trim_and_hash_of_ids(spark):
    df = spark.createDataFrame([(7, " 22025 "), (None, None)], "id int, season string")
    got = rows(df.select(fn.trimmed("id"), fn.trimmed("season"), fn.hash_key(fn.trimmed("id"))))
    assert got[1] == (None, None, None)
    assert got[0][:2] == ("7", "22025") and len(got[0][2]) == 64


@pytest.mark.parametrize(
    ("path", "n", "tail"),
    [
        ("/data/2025-26/a.parquet", 2, "2025-26/a.parquet"),
        ("/data/player-bios/2026-01-01/a.parquet", 3, "player-bios/2026-01-01/a.parquet"),
        ("a.parquet", 2, "a.parquet"),
    ],
)
def test_path_tail(spark, path, n, tail):
    assert spark.range(1).select(fn.path_tail(F.lit(path), n)).first()[0] == tail


def test_stem_and_last_part(spark):
    got = spark.range(1).select(fn.file_stem(F.lit("/x/2025-26/log-00.parquet")), fn.last_part(F.lit("a/b/c.pdf"))).first()
    assert tuple(got) == ("log-00", "c.pdf")


def test_kebab(spark):
    wanted = "league-game-logs-00-t-regular-season"
    column = fn.kebab(F.lit("league-game-logs"), F.lit("00"), F.lit("T"), F.lit("Regular Season"))
    assert spark.range(1).select(column).first()[0] == wanted
    with pytest.raises(MissingSuffix):
        naming.targets(spark, "/d", [naming.Declared("league-game-logs", (), ("2025-26",))])


def test_seasons(spark):
    assert rows(fn.season_table(spark, 1999, 2001), "start_year") == [(1999, "1999-00"), (2000, "2000-01")]
    assert fn.season_table(spark, 2002, 2001).count() == 0
    assert spark.range(1).select(fn.latest_completed_season(F.lit(date(2026, 3, 1)))).first()[0] == "2025-26"


def test_targets(spark):
    made = naming.targets(
        spark,
        "/d/",
        [
            naming.Declared("league-game-logs", ("00", "T", "All Star"), ("2025-26",)),
            naming.Declared("players-info", (1, "00"), ("player-bios", "2026-01-02")),
            naming.Declared("players-info", (1, "00"), ("player-bios", "")),
        ],
    )
    assert [t.s3_key for t in made[:2]] == [
        "2025-26/league-game-logs-00-t-all-star.parquet", "player-bios/2026-01-02/players-info-1-00.parquet"
    ]
    assert made[1] == naming.Target("players-info-1-00", "/d/" + made[1].s3_key, made[1].s3_key)
    assert abs((date.fromisoformat(made[2].s3_key.split("/")[1]) - date.today()).days) <= 1
    with pytest.raises(ValueError, match="no folder"):
        naming.targets(spark, "/d", [naming.Declared("x", (1,), ())])
    assert naming.qualified("t", " silver ", "dev") == "dev.silver.t"
    assert naming.qualified("t") == "default.t"


def test_wanted_targets(spark):
    seasons = spark.createDataFrame([("2024-25",)], "season string")
    made = naming.wanted_targets(
        "box-score-logs", {"traditional": ("team_stats",), "summary": ("game_info",)}, seasons, ["0", "0"]
    )
    assert {r["s3_key"] for r in made.collect()} == {
        "2024-25/box-score-logs-0-0-traditional-team-stats.parquet",
        "2024-25/box-score-logs-0-0-summary-game-info.parquet",
    }
