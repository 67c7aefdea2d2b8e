"""Cleaning, deduplication and the silver game-log table."""

from datetime import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from rimstone.errors import ContractBroken, MissingColumn
from rimstone.operators.checks import enforce
from rimstone.operators.cleaning import clean, require_columns, snake_columns, tag_source, with_hash_keys
from rimstone.operators.dedup import latest_per_key
from rimstone.plans import game_logs
from rimstone.sinks.parquet import require_schema, save_table

T0, T1 = datetime(2025, 10, 22), datetime(2025, 10, 23)
BRONZE_SCHEMA = (
    "SEASON_ID string, TEAM_ID long, TEAM_ABBREVIATION string, TEAM_NAME string, GAME_ID string, GAME_DATE string, "
    "MATCHUP string, WL string, MIN long, FGM long, FGA long, FG_PCT double, FG3M long, FG3A long, FG3_PCT double, "
    "FTM long, FTA long, FT_PCT double, OREB long, DREB long, REB long, AST long, STL long, BLK long, TOV long, "
    "PF long, PTS long, PLUS_MINUS long, VIDEO_AVAILABLE long, season string, _bronze_path string, "
    "_source_name string, _ingested_at timestamp"
)
SOURCE = "league-game-logs-00-t-regular-season"
PATH = f"s3://b/2025-26/{SOURCE}.parquet"


def game_row(**changes):
    row = dict(
        SEASON_ID="22025", TEAM_ID=1610612745, TEAM_ABBREVIATION="HOU", TEAM_NAME="Houston Rockets",
        GAME_ID="0022500001", GAME_DATE="2025-10-21", MATCHUP="HOU @ OKC", WL="L", MIN=290, FGM=43, FGA=97,
        FG_PCT=0.443, FG3M=11, FG3A=39, FG3_PCT=0.282, FTM=27, FTA=31, FT_PCT=0.871, OREB=16, DREB=36, REB=52,
        AST=23, STL=6, BLK=5, TOV=25, PF=26, PTS=124, PLUS_MINUS=-1, VIDEO_AVAILABLE=1, season="2025-26",
        _bronze_path=PATH, _source_name=SOURCE, _ingested_at=T0,
    )
    return {**row, **changes}


def opponent(**changes):
    other = dict(
        TEAM_ID=1610612760, TEAM_ABBREVIATION="OKC", TEAM_NAME="Oklahoma City Thunder", MATCHUP="OKC vs. HOU", WL="W",
        FGM=44, PTS=44 * 2 + 11 + 27 - 1, FTM=26, FTA=31, FT_PCT=0.839, FG_PCT=0.454, PLUS_MINUS=1,
    )
    return game_row(**{**other, **changes})


def bronze_of(spark, *made):
    names = [c.split()[0] for c in BRONZE_SCHEMA.split(", ")]
    return spark.createDataFrame([tuple(r[n] for n in names) for r in made], BRONZE_SCHEMA)


def test_silver_matches_its_contract(spark):
    bronze = bronze_of(spark, game_row(TEAM_NAME=" Houston Rockets ", SEASON_ID=" 22025"), opponent())
    table = game_logs.silver(bronze, T1)
    assert len(game_logs.COLUMNS) == 36
    require_schema(table, game_logs.silver_schema())
    row = table.where("team_abbreviation = 'HOU'").first()
    assert row["team_name"] == "Houston Rockets" and row["season_id"] == "22025" and row["team_id"] == "1610612745"
    assert str(row["fg_pct"]) == "0.443" and str(row["game_date"]) == "2025-10-21"
    assert "video_available" not in table.columns


def test_silver_keeps_latest_then_greatest_path(spark):
    older = game_row(PTS=1, _ingested_at=T0, _bronze_path="z")
    same_time = game_row(PTS=2, _ingested_at=T1, _bronze_path="a")
    newest = game_row(PTS=3, _ingested_at=T1, _bronze_path="b")
    table = game_logs.silver(bronze_of(spark, older, same_time, newest), T1)
    assert [r["pts"] for r in table.collect()] == [3]


def test_null_keys_are_one_key(spark):
    made = [game_row(GAME_ID=None, TEAM_ID=None, SEASON_ID=None, PTS=p, _ingested_at=t) for p, t in ((1, T0), (2, T1))]
    table = game_logs.silver(bronze_of(spark, *made), T1)
    assert rows(table.select("pts", "game_sk")) == [(2, None)]


def test_out_of_range_value_raises(spark):
    with pytest.raises(Exception, match="CAST_OVERFLOW|NUMERIC_VALUE_OUT_OF_RANGE|overflow"):
        game_logs.silver(bronze_of(spark, game_row(PTS=40000)), T1).collect()


def test_all_checks_pass_on_a_sound_game(spark):
    bronze = bronze_of(spark, game_row(), opponent())
    summary = game_logs.check_table(game_logs.silver(bronze, T1), bronze)
    assert summary.count() == 77
    assert rows(summary.where("failures > 0")) == []
    assert enforce(summary) == []


def test_checks_find_faults(spark):
    bad = opponent(PLUS_MINUS=2, REB=99, MATCHUP="OKC vs HOU", FT_PCT=None, WL=None, _bronze_path="/elsewhere/x")
    bronze = bronze_of(spark, game_row(), bad)
    found = {r["check"] for r in game_logs.check_table(game_logs.silver(bronze, T1), bronze).where("failures > 0").collect()}
    assert found == {
        "rule_reb", "range_reb", "rule_matchup", "rule_ft_pct", "not_null_wl", "rule__bronze_path",
        "not_two_zero_sum_rows",
    }


def test_rows_not_latest(spark):
    bronze = bronze_of(spark, game_row(_ingested_at=T0), game_row(_ingested_at=T1))
    stale = game_logs.silver(bronze.where(F.col("_ingested_at") == F.lit(T0)), T1)
    assert game_logs.rows_not_latest(stale, bronze).count() == 1
    assert game_logs.rows_not_latest(game_logs.silver(bronze, T1), bronze).count() == 0


def test_dedup_is_deterministic_beyond_its_order(spark):
    made = [("k", 1, v) for v in ("a", "b", "c")]
    for order in (made, made[::-1]):
        df = spark.createDataFrame(order, "k string, t int, v string").repartition(3)
        assert rows(latest_per_key(df, ["k"], ["t"])) == [("k", 1, "c")]


def test_dedup_of_a_hot_key_trims_before_the_shuffle(spark):
    df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), "id")
    latest = latest_per_key(df, ["k"], ["id"])
    assert latest.count() == 20_001
    assert latest.where("k = 0").first()["id"] == 29_997
    plan = latest._jdf.queryExecution().toString()
    assert plan.count("WindowGroupLimit") >= 2


def test_clean_and_tags(spark):
    df = spark.createDataFrame([(" a ", "5", 1)], "name string, n string, other int")
    made = with_hash_keys(tag_source(clean(df, trims=["name"], casts={"n": "smallint"}), "feed"), {"sk": "name"})
    assert made.dtypes[:3] == [("name", "string"), ("n", "smallint"), ("source_name", "string")]
    assert made.first()["name"] == "a"
    assert snake_columns(df.toDF("PlayerName", "b", "c")).columns == ["player_name", "b", "c"]
    with pytest.raises(MissingColumn, match="GAME_ID.*name"):
        require_columns(df, ["GAME_ID"])


def test_table_is_saved_with_comments_and_only_by_contract(spark):
    bronze = bronze_of(spark, game_row(), opponent())
    declared = game_logs.silver_schema()
    name = save_table(
        game_logs.silver(bronze, T1), game_logs.TABLE, declared, description=game_logs.TABLE_COMMENT
    )
    saved = spark.table(name)
    assert saved.count() == 2
    assert saved.schema["team_sk"].metadata["comment"] == "Hash of team_id"
    with pytest.raises(ContractBroken):
        save_table(saved.drop("pts"), game_logs.TABLE, declared)
    with pytest.raises(ContractBroken):
        save_table(saved.withColumn("pts", F.col("pts").cast("int")), game_logs.TABLE, declared)
