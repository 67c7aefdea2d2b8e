"""Scans, lineage, listings and drift-safe loads."""

import logging
from datetime import datetime

import pandas as pd
import pytest
from conftest import rows
from pyspark.sql import functions as F

from rimstone.errors import EmptyDataset, MissingColumn
from rimstone.session import materialize, shared_folder
from rimstone.sinks.parquet import write_folders, write_parquet
from rimstone.sources import datasets as ds
from rimstone.sources import drift, files
from rimstone.operators.ledger import Ledger
from rimstone.plans.publish import reconcile
from rimstone.sources.drift import file_groups, read_with_drift
from rimstone.sources.listing import StoreListing


@pytest.fixture
def season(tmp_path):
    """A season folder with one-file datasets as another tool writes them."""
    folder = tmp_path / "2024-25"
    folder.mkdir()
    pd.DataFrame({"GAME_ID": ["1", "1", "2"], "PTS": [1, 2, 3]}).to_parquet(folder / "league-game-logs-a.parquet")
    pd.DataFrame({"GAME_ID": ["2"], "PTS": [4]}).to_parquet(folder / "league-game-logs-b.parquet")
    pd.DataFrame({"gameId": ["9"]}).to_parquet(folder / "play-by-play-logs-0-0.parquet")
    (folder / "league-game-logs-c.csv").write_text("GAME_ID\n7\n")
    return folder


def test_prefix_scan_takes_matching_parquet_only(spark, season):
    scanned = files.with_source_name(files.scan_prefix(spark, str(season), "league-game-logs"))
    assert rows(scanned.select("source_name", "GAME_ID").distinct()) == [
        ("league-game-logs-a", "1"),
        ("league-game-logs-a", "2"),
        ("league-game-logs-b", "2"),
    ]


def test_prefix_scan_of_nothing_warns(spark, season, caplog):
    with caplog.at_level(logging.WARNING):
        assert files.scan_prefix(spark, str(season), "box-score") is None
    assert "box-score" in caplog.text


def test_lineage_of_files_and_of_folders(spark, tmp_path, season):
    write_parquet(spark.range(3).repartition(2), str(tmp_path / "2023-24" / "league-game-logs-d.parquet"))
    for folder, name in (("2024-25", "league-game-logs-a"), ("2023-24", "league-game-logs-d")):
        loaded = files.with_lineage(spark.read.parquet(f"{tmp_path}/{folder}/{name}.parquet"))
        assert rows(loaded.select("season", "_source_name").distinct()) == [(folder, name)]
        rule = "_bronze_path like '%/' || season || '/' || _source_name || '%'"
        assert loaded.where(f"not ({rule})").count() == 0
        assert loaded.where("_ingested_at is null").count() == 0


def test_game_ids_by_source(spark, tmp_path, season):
    lake = ds.Landed(spark, str(tmp_path))
    assert rows(lake.game_ids_by_source("2024-25")) == [
        ("league-game-logs-a", "1"),
        ("league-game-logs-a", "2"),
        ("league-game-logs-b", "2"),
    ]
    with pytest.raises(EmptyDataset, match="key list is empty"):
        lake.game_ids_by_source("2024-25", "box-score")
    with pytest.raises(MissingColumn, match="GAME_ID"):
        lake.game_ids_by_source("2024-25", "play-by-play")


def test_readers_require_their_columns(spark, season):
    lake = ds.Landed(spark, str(season.parent))
    with pytest.raises(MissingColumn, match="actionNumber"):
        lake.get_play_by_play_logs("2024-25")


def test_dataset_names(spark):
    lake = ds.Landed(spark, "/lake", run_date="2026-01-02")
    assert lake.game_log_dataset("2024-25").path == "/lake/2024-25/league-game-logs-00-t-regular-season.parquet"
    scores = {n: d for v in ds.BOX_SCORE_DATASETS for n, d in lake.box_score_datasets("2024-25", v).items()}
    assert scores["team_starter_bench_stats"].source_name == "box-score-logs-0-0-traditional-team-starter-bench-stats"
    assert sum(len(v) for v in ds.BOX_SCORE_DATASETS.values()) == 14
    assert lake.roster_datasets()["coaches"].path == "/lake/rosters/2026-01-02/team-00-coaches.parquet"
    assert lake.player_detail_dataset().path == "/lake/player-bios/2026-01-02/players-info-1-00.parquet"
    assert lake.injury_dataset(2025).path == "/lake/injuries/2025/parsed/injuries.parquet"


def test_frames_are_named_by_position(spark):
    named = ds.name_parts(["a", "b"], [spark.range(1), spark.range(2)])
    assert named["b"].count() == 2
    with pytest.raises(ValueError):
        ds.name_parts(["a"], [])


def test_types_that_drift_between_seasons(spark, tmp_path):
    for folder, pts in (("2022-23", [1, 2]), ("2023-24", [3.0, None]), ("2024-25", ["4", "5"])):
        (tmp_path / folder).mkdir()
        pd.DataFrame({"GAME_ID": ["x", "y"], "PTS": pts}).to_parquet(tmp_path / folder / "log.parquet")
    extra = pd.DataFrame({"GAME_ID": ["z"], "PTS": [6], "NEW": ["n"]})
    extra.to_parquet(tmp_path / "2024-25" / "log2.parquet")
    assert file_groups(spark, str(tmp_path)).select("signature").distinct().count() == 4
    loaded = read_with_drift(spark, str(tmp_path), {"PTS": "smallint"})
    assert dict(loaded.dtypes)["PTS"] == "smallint"
    assert rows(loaded.select("season", "PTS", "NEW")) == sorted(
        [("2022-23", 1, None), ("2022-23", 2, None), ("2023-24", 3, None), ("2023-24", None, None),
         ("2024-25", 4, None), ("2024-25", 5, None), ("2024-25", 6, "n")],
        key=repr,
    )


def test_union_keeps_duplicates_and_outer_columns(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x")], "id int, a string")
    b = spark.createDataFrame([("y", 1)], "b string, id int")
    assert rows(files.union_by_name([a, b])) == sorted([(1, "x", None)] * 2 + [(1, None, "y")], key=repr)


def test_raw_files_and_object_keys(spark, tmp_path):
    raw = tmp_path / "injuries" / "2025" / "raw"
    (raw / "deep").mkdir(parents=True)
    (raw / "Injury-Report_1.pdf").write_bytes(b"%PDF-1")
    (raw / "deep" / "Injury-Report_2.pdf").write_bytes(b"%PDF-22")
    (raw / "notes.txt").write_text("no")
    write_parquet(spark.range(3).repartition(2), str(tmp_path / "2024-25" / "log.parquet"))
    loaded = files.read_raw_files(spark, str(raw))
    assert rows(loaded.select("length", F.length("content"))) == [(6, 6), (7, 7)]
    assert files.list_files(spark, str(raw), "*.pdf").columns == ["path", "modificationTime", "length"]
    assert rows(files.object_keys(spark, str(tmp_path))) == [
        ("2024-25/log.parquet",),
        ("injuries/2025/raw/Injury-Report_1.pdf",),
        ("injuries/2025/raw/deep/Injury-Report_2.pdf",),
        ("injuries/2025/raw/notes.txt",),
    ]
    assert files.object_exists(spark, str(tmp_path), "2024-25/log.parquet")
    assert not files.object_exists(spark, str(tmp_path), "injuries/2025/raw")
    assert not files.object_exists(spark, str(tmp_path / "nowhere"), "x")


def test_catalog_table_scan(spark):
    spark.sql("create database if not exists bronze")
    spark.range(2).write.mode("overwrite").saveAsTable("bronze.games")
    assert files.read_table(spark, "games", schema="bronze").count() == 2
    assert files.read_table(spark, "games", schema="bronze", catalog="spark_catalog").count() == 2


def test_materialized_table_lies_in_the_shared_folder(spark):
    made = materialize(spark.range(3).withColumn("at", F.lit(datetime(2025, 1, 1))), "probe")
    assert made.count() == 3
    assert all(shared_folder(spark) in f for f in made.inputFiles())


def test_parts_of_a_folder_that_differ_keep_all_columns(spark, tmp_path):
    folder = tmp_path / "logs.parquet"
    folder.mkdir()
    pd.DataFrame({"GAME_ID": ["1"], "PTS": [1]}).to_parquet(folder / "part-0.parquet")
    pd.DataFrame({"GAME_ID": ["2"], "AST": [5]}).to_parquet(folder / "part-1.parquet")
    loaded = read_with_drift(spark, str(tmp_path), {"PTS": "smallint", "AST": "smallint"})
    assert rows(loaded.select("GAME_ID", "PTS", "AST")) == [("1", 1, None), ("2", None, 5)]
    pd.DataFrame({"GAME_ID": [3.5]}).to_parquet(folder / "part-2.parquet")
    with pytest.raises(Exception, match="(?i)merge"):
        read_with_drift(spark, str(tmp_path), {"PTS": "smallint"})


def test_seasons_of_one_era_are_merged_in_one_job_and_others_halved(spark, tmp_path, monkeypatch):
    for year in range(8):
        kind = "long" if year < 4 or year == 7 else "string"
        made = spark.range(3).select(F.col("id").cast(kind).alias("GAME_ID"), F.lit(year).alias(f"only_{year}"))
        write_parquet(made, str(tmp_path / f"20{year:02d}-{year + 1:02d}" / "league-game-logs-x.parquet"))
    paths = drift.dataset_paths(spark, str(tmp_path), prefix="league-game-logs")
    tried = []
    whole = drift.schema_groups
    monkeypatch.setattr(drift, "schema_groups", lambda s, p: tried.append(len(p)) or whole(s, p))
    groups = drift.schema_groups(spark, paths)
    assert [len(g) for g, _ in groups] == [4, 3, 1] or sorted(len(g) for g, _ in groups) == [1, 1, 2, 4]
    assert tried.count(1) <= 2 and tried[0] == 8
    assert drift.dataset_paths(spark, str(tmp_path), prefix="other") == []
    lake = ds.Landed(spark, str(tmp_path))
    ids = lake.game_ids_by_source("*")
    assert rows(ids) == [("league-game-logs-x", str(i)) for i in range(3)]
    with pytest.raises(EmptyDataset):
        lake.game_ids_by_source("19*")


def test_datasets_are_read_in_declared_types(spark, tmp_path):
    lake = ds.Landed(spark, str(tmp_path))
    for season, kind in (("2023-24", "string"), ("2024-25", "int")):
        made = spark.sql(f"select '2' SEASON_ID, cast(7 as {kind}) TEAM_ID, '001' GAME_ID, cast(101 as {kind}) PTS")
        write_parquet(made, lake.game_log_dataset(season).path)
    assert dict(lake.get_game_logs("2024-25").dtypes)["PTS"] == "bigint"
    both = lake.get_game_logs("*")
    assert dict(both.dtypes)["TEAM_ID"] == "bigint" and rows(both.select("TEAM_ID", "PTS")) == [(7, 101)] * 2


def test_folders_are_written_in_one_job(spark, tmp_path):
    made = spark.range(10).select("id", F.concat(F.lit("20%:"), F.col("id") % 3, F.lit("/a b.parquet")).alias("to"))
    counts = write_folders(made, "to", str(tmp_path))
    assert counts == {"20%:0/a b.parquet": 4, "20%:1/a b.parquet": 3, "20%:2/a b.parquet": 3}
    assert rows(spark.read.parquet(str(tmp_path / "20%:1" / "a b.parquet"))) == [(1,), (4,), (7,)]
    assert write_folders(made.where("id < 1"), "to", str(tmp_path)) == {"20%:0/a b.parquet": 1}
    assert sorted(p.name for p in tmp_path.iterdir()) == ["20%:0", "20%:1", "20%:2"]


def test_only_changed_folders_are_listed_again(spark, tmp_path):
    import os
    import time

    root = tmp_path / "lake"
    for key in ("2022-23/a.parquet", "2023-24/a.parquet", "injuries/2024/raw/deep/x.pdf"):
        (root / key).parent.mkdir(parents=True, exist_ok=True)
        (root / key).write_bytes(b"x")
    (root / "2022-23" / "b.parquet").mkdir()
    (root / "2022-23" / "b.parquet" / "part-0.parquet").write_bytes(b"x")
    (root / "2022-23" / "_staged-c.parquet").mkdir()
    old = time.time() - 100
    for folder, _, _ in os.walk(root):
        os.utime(folder, (old, old))
    listing = StoreListing(spark, str(root), str(tmp_path / "kept"))
    assert listing.refresh() == 7
    want = ["2022-23/a.parquet", "2022-23/b.parquet", "2023-24/a.parquet", "injuries/2024/raw/deep/x.pdf"]
    assert rows(listing.keys()) == [(k,) for k in want]
    assert listing.refresh() == 0
    (root / "2023-24" / "new.parquet").write_bytes(b"x")
    assert listing.refresh() == 1 and rows(listing.keys()) == sorted([*[(k,) for k in want], ("2023-24/new.parquet",)])
    assert listing.refresh() == 1  # its stamp is too young to be trusted
    (root / "injuries/2024/raw/deep/x.pdf").unlink()
    (root / "injuries/2024/raw/deep").rmdir()
    asked = spark.createDataFrame([(k,) for k in [*want, "nowhere"]], "s3_key string")
    assert rows(listing.stored_among(asked)) == [(k,) for k in want[:3]]
    ledger = Ledger(spark, str(tmp_path / "ledger"))
    ledger.open_runs([want[0], want[3]], datetime(2020, 1, 1))
    assert reconcile(ledger, str(root), listing) == {"Success": 1, "Failure": 1}
    assert StoreListing(spark, str(tmp_path / "none"), str(tmp_path / "kept2")).refresh() == 0
