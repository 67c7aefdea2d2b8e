"""Two-phase publishing and the per-dataset entry points."""

from datetime import datetime, timedelta, timezone

import pytest
from conftest import rows
from test_layout import golden

from rimstone.errors import BudgetExceeded, EmptyDataset
from rimstone.functions import season_table
from rimstone.operators.ledger import FAILURE, PENDING, SUCCESS, Ledger
from rimstone.plans import ingest as ing
from rimstone.plans import publish as pub
from rimstone.sinks.naming import Target
from rimstone.session import filesystem
from rimstone.sinks import parquet as sink
from rimstone.sinks.parquet import publish_parquet, read_published, write_parquet
from rimstone.sources.datasets import BOX_SCORE_DATASETS, Landed

SEASON = "2024-25"


@pytest.fixture
def ledger(spark, tmp_path):
    made = Ledger(spark, str(tmp_path / "ledger"))
    made.create()
    return made


def target(tmp_path, name="log"):
    return Target(name, f"{tmp_path}/lake/{SEASON}/{name}.parquet", f"{SEASON}/{name}.parquet")


def outcomes(ledger):
    return {r["s3_key"]: (r["status"], r["rows_in"]) for r in ledger.state().collect()}


def test_publish_records_rows(spark, tmp_path, ledger):
    assert pub.publish(ledger, target(tmp_path), lambda s: s.range(5)) == 5
    assert outcomes(ledger) == {f"{SEASON}/log.parquet": (SUCCESS, 5)}
    assert spark.read.parquet(target(tmp_path).path).count() == 5
    codecs = [f for f in spark.read.parquet(target(tmp_path).path).inputFiles() if "zstd" in f]
    assert codecs


def test_empty_dataset_is_refused_and_the_old_one_stays(spark, tmp_path, ledger):
    pub.publish(ledger, target(tmp_path), lambda s: s.range(5))
    with pytest.raises(EmptyDataset):
        pub.publish(ledger, target(tmp_path), lambda s: s.range(5).where("id > 9"))
    assert spark.read.parquet(target(tmp_path).path).count() == 5
    assert sorted(r["status"] for r in ledger.state().collect()) == [FAILURE, SUCCESS]
    assert [p.name for p in (tmp_path / "lake" / SEASON).iterdir()] == ["log.parquet"]


def test_failed_write_keeps_the_old_dataset(spark, tmp_path):
    path = target(tmp_path).path
    assert publish_parquet(spark.range(2), path) == 2
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        publish_parquet(spark.range(2).selectExpr("cast(concat('x', id) as int) as n"), path)
    assert spark.read.parquet(path).count() == 2
    assert publish_parquet(spark.range(3), path) == 3
    assert spark.read.parquet(path).count() == 3


def test_failed_move_puts_the_old_dataset_back(spark, tmp_path, monkeypatch):
    path = target(tmp_path).path
    publish_parquet(spark.range(2), path)
    real = sink.move

    def failing(fs, source, to):
        if "_staged" in str(source):
            raise OSError("no move")
        real(fs, source, to)

    monkeypatch.setattr(sink, "move", failing)
    with pytest.raises(OSError, match="no move"):
        publish_parquet(spark.range(3), path)
    assert spark.read.parquet(path).count() == 2
    assert [p.name for p in (tmp_path / "lake" / SEASON).iterdir()] == ["log.parquet"]


def test_old_dataset_is_found_after_a_stop_between_the_moves(spark, tmp_path):
    path = target(tmp_path).path
    publish_parquet(spark.range(2), path)
    fs, final = filesystem(spark, path)
    fs.rename(final, filesystem(spark, sink.former_path(path))[1])
    assert read_published(spark, path).count() == 2
    with pytest.raises(EmptyDataset):
        publish_parquet(spark.range(0), path)
    assert read_published(spark, path).count() == 2
    assert publish_parquet(spark.range(3), path) == 3
    assert [p.name for p in (tmp_path / "lake" / SEASON).iterdir()] == ["log.parquet"]


def test_failed_build_is_recorded_and_raised(tmp_path, ledger):
    def build(spark):
        raise RuntimeError("no answer")

    with pytest.raises(RuntimeError):
        pub.publish(ledger, target(tmp_path), build)
    (row,) = ledger.state().collect()
    assert (row["status"], row["error_message"]) == (FAILURE, "no answer")


def test_first_failing_dataset_leaves_the_later_ones_pending(tmp_path, ledger):
    targets = {n: target(tmp_path, n) for n in ("a", "b", "c")}
    with pytest.raises(EmptyDataset):
        pub.publish_many(
            ledger, targets, lambda s: {"a": s.range(2), "b": s.range(0), "c": s.range(3)}
        )
    assert outcomes(ledger) == {
        f"{SEASON}/a.parquet": (SUCCESS, 2),
        f"{SEASON}/b.parquet": (FAILURE, None),
        f"{SEASON}/c.parquet": (PENDING, None),
    }


def test_failed_shared_build_fails_every_dataset(tmp_path, ledger):
    def build(spark):
        raise RuntimeError("down")

    with pytest.raises(RuntimeError):
        pub.publish_many(ledger, {n: target(tmp_path, n) for n in ("a", "b")}, build)
    assert {s for s, _ in outcomes(ledger).values()} == {FAILURE}


def test_ingest_skips_what_is_done_and_always_reconciles(spark, tmp_path, ledger):
    root = f"{tmp_path}/lake"
    ledger.open_runs(["x/gone.parquet"], datetime.now(timezone.utc) - timedelta(hours=1))
    assert pub.ingest(ledger, root, target(tmp_path), lambda s: s.range(5)) == 5
    assert outcomes(ledger)["x/gone.parquet"] == (FAILURE, None)

    def must_not_run(spark):
        raise AssertionError

    assert pub.ingest(ledger, root, target(tmp_path), must_not_run) is None
    assert pub.ingest(ledger, root, target(tmp_path), lambda s: s.range(6), skip_done=False) == 6


def test_ingest_many_builds_only_what_is_missing(tmp_path, ledger):
    root = f"{tmp_path}/lake"
    targets = {n: target(tmp_path, n) for n in ("a", "b")}
    pub.publish(ledger, targets["a"], lambda s: s.range(1))
    asked = []

    def build(spark, names):
        asked.append(list(names))
        return {n: spark.range(2) for n in names}

    assert pub.ingest_many(ledger, root, targets, build) == {"b": 2}
    assert pub.ingest_many(ledger, root, targets, build) == {}
    assert asked == [["b"]]


def test_raw_run_has_no_rows_and_a_stale_one_fails(spark, tmp_path, ledger):
    folder = tmp_path / "lake" / "injuries" / "2025" / "raw"
    folder.mkdir(parents=True)
    listed = pub.publish_raw(ledger, str(folder), "injuries/2025/raw", lambda: (folder / "a.pdf").write_bytes(b"x"))
    assert listed.count() == 1
    assert outcomes(ledger) == {"injuries/2025/raw": (SUCCESS, None)}
    ledger.open_runs(["injuries/2024/raw"], datetime.now(timezone.utc) - timedelta(hours=1))
    pub.reconcile(ledger, f"{tmp_path}/lake")
    assert outcomes(ledger)["injuries/2024/raw"] == (FAILURE, None)


def test_loops_stop_at_the_first_error(spark):
    seen = []

    def step(season):
        seen.append(season)
        if season == "2019-20":
            raise RuntimeError

    with pytest.raises(RuntimeError):
        pub.for_each_season(step, season_table(spark, 2018, 2022))
    assert seen == ["2018-19", "2019-20"]
    assert pub.for_each_year(lambda year, step: (year, step), {2018: {"step": 60}}) == [(2018, 60)]


def test_a_season_from_landing_to_bronze(spark, tmp_path, ledger):
    """Game logs drive play-by-play, which drives box scores; players drive details and rosters."""
    landing = Landed(spark, f"{tmp_path}/landing", run_date="2026-01-02")
    bronze = Landed(spark, f"{tmp_path}/lake", run_date="2026-01-02")

    def land(dataset, made, schema):
        write_parquet(spark.createDataFrame(made, schema), dataset.path)

    ids = "SEASON_ID string, TEAM_ID long, GAME_ID string"
    for season_type in ("Regular Season", "Playoffs"):
        land(landing.game_log_dataset(SEASON, "T", season_type), [("2", 1, "g1"), ("2", 2, "g2"), ("2", 3, "g1")], ids)
    land(
        landing.play_by_play_dataset(SEASON),
        [("g1", 1, 1), ("g1", 2, 2), ("g2", 1, 1), ("g3", 1, 1)],
        "gameId string, actionNumber long, actionId long",
    )
    for variant in BOX_SCORE_DATASETS:
        for dataset in landing.box_score_datasets(SEASON, variant).values():
            land(dataset, [("g1", "s", 5), ("g3", "s", 6)], "gameId string, source_name string, v int")
    land(landing.player_list_dataset(SEASON), [(7, 1), (8, 2)], "PERSON_ID long, TEAM_ID long")
    land(landing.player_detail_dataset(), [(7, "6-5"), (9, "6-6")], "PERSON_ID long, HEIGHT string")
    for name, key in (("roster", "PLAYER_ID"), ("coaches", "COACH_ID")):
        land(landing.roster_datasets()[name], [(1, 7), (3, 9)], f"TEAM_ID long, {key} long")

    assert ing.ingest_league_game_logs(ledger, landing, bronze, SEASON) == 3
    assert ing.ingest_league_game_logs(ledger, landing, bronze, SEASON) is None
    assert ing.ingest_league_game_logs(ledger, landing, bronze, SEASON, season_type="Playoffs") == 3
    # Each game is listed by two sources, so its actions are kept once for each.
    assert ing.ingest_play_by_play(ledger, landing, bronze, SEASON) == 6
    actions = bronze.get_play_by_play_logs(SEASON)
    assert rows(actions.groupBy("source_name").count()) == [
        ("league-game-logs-00-t-playoffs", 3),
        ("league-game-logs-00-t-regular-season", 3),
    ]
    scores = ing.ingest_box_scores(ledger, landing, bronze, SEASON)
    assert len(scores) == 14 and set(scores.values()) == {1}
    assert ing.ingest_box_scores(ledger, landing, bronze, SEASON) == {}
    assert ing.ingest_players(ledger, landing, bronze, SEASON) == 2
    assert ing.ingest_players(ledger, landing, bronze, SEASON) == 2
    players = bronze.get_all_players_info(SEASON)
    assert ing.ingest_player_details(ledger, landing, bronze, players) == 1
    assert ing.ingest_rosters(ledger, landing, bronze, players) == {"roster": 1, "coaches": 1}
    assert bronze.get_player_info(players).count() == 1
    assert {n: d.count() for n, d in bronze.get_team_roster_info(players).items()} == {"roster": 1, "coaches": 1}
    found = bronze.get_box_score_game_logs(actions.select("gameId"), "advanced", SEASON)
    assert {n: d.count() for n, d in found.items()} == {"player_stats": 1, "team_stats": 1}


def test_injury_reports_are_published_after_their_raw_files(spark, tmp_path, ledger):
    bronze = Landed(spark, f"{tmp_path}/lake")
    raw = tmp_path / "lake" / "injuries" / "2026" / "raw"
    raw.mkdir(parents=True)
    (raw / "Injury-Report_1.pdf").write_bytes(b"x")
    assert ing.ingest_injury_reports(ledger, bronze, 2026, golden(spark)) == 2
    assert ing.ingest_injury_reports(ledger, bronze, 2026, golden(spark)) is None
    assert outcomes(ledger) == {
        "injuries/2026/raw": (SUCCESS, None),
        "injuries/2026/parsed/injuries.parquet": (SUCCESS, 2),
    }


def test_a_source_with_too_many_uncovered_keys_fails(spark, tmp_path, ledger):
    """Ten games of which nothing has landed are let pass; the eleventh stops the run, which stays to be done."""
    landing, bronze = Landed(spark, f"{tmp_path}/landing"), Landed(spark, f"{tmp_path}/lake")
    games = spark.range(20).selectExpr("'2' as SEASON_ID", "1L as TEAM_ID", "concat('g', id) as GAME_ID")
    write_parquet(games, bronze.game_log_dataset(SEASON).path)
    actions = spark.range(20).selectExpr("concat('g', id) as gameId", "1L as actionNumber", "1L as actionId", "id")
    write_parquet(actions.where("id >= 11").drop("id"), landing.play_by_play_dataset(SEASON).path)
    with pytest.raises(BudgetExceeded, match="11 failed"):
        ing.ingest_play_by_play(ledger, landing, bronze, SEASON)
    assert {s for s, _ in outcomes(ledger).values()} == {FAILURE}
    write_parquet(actions.where("id >= 10").drop("id"), landing.play_by_play_dataset(SEASON).path)
    assert ing.ingest_play_by_play(ledger, landing, bronze, SEASON) == 10


def test_many_targets_in_one_job_and_the_first_failure_leaves_the_rest_pending(spark, tmp_path, ledger):
    targets = {s: target(tmp_path, s) for s in ("a", "b c", "d", "e")}
    made = spark.range(10).selectExpr("id", "case when id < 2 then 'a' when id < 7 then 'b c' when id = 7 then 'e' else 'other' end as season")
    with pytest.raises(EmptyDataset):
        pub.publish_targets(ledger, targets, made, "season")
    assert {k.partition("/")[2]: v for k, v in outcomes(ledger).items()} == {
        "a.parquet": (SUCCESS, 2), "b c.parquet": (SUCCESS, 5), "d.parquet": (FAILURE, None), "e.parquet": (PENDING, None),
    }
    assert rows(spark.read.parquet(targets["a"].path)) == [(0,), (1,)]
    left = sorted(p.name for p in (tmp_path / "lake" / SEASON).iterdir())
    assert left == ["a.parquet", "b c.parquet"]
    calls = []

    def build(s, names):
        calls.append(names)
        return s.range(4).selectExpr("id", "if(id < 3, 'd', 'e') as season")

    assert pub.ingest_targets(ledger, str(tmp_path / "lake"), targets, build, "season") == {"d": 3, "e": 1}
    assert pub.ingest_targets(ledger, str(tmp_path / "lake"), targets, build, "season") == {} and calls == [["d", "e"]]


def test_a_failed_computation_fails_every_target(spark, tmp_path, ledger):
    targets = {s: target(tmp_path, s) for s in ("a", "b")}
    broken = spark.range(3).selectExpr("cast(concat('x', id) as int) as n", "'a' as season")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        pub.publish_targets(ledger, targets, broken, "season")
    assert {v for v, _ in outcomes(ledger).values()} == {FAILURE}
    assert pub.publish_targets(ledger, {}, broken, "season") == {}


def test_seasons_of_different_types_are_published_in_one_job(spark, tmp_path, ledger):
    landing, bronze = Landed(spark, str(tmp_path / "landing")), Landed(spark, str(tmp_path / "lake"))
    for season, kind, n in (("2022-23", "string", 2), ("2023-24", "int", 3)):
        made = spark.range(n).selectExpr("'2' SEASON_ID", f"cast(id as {kind}) TEAM_ID", "'001' GAME_ID", f"cast(99 as {kind}) PTS")
        write_parquet(made, landing.game_log_dataset(season).path)
    seasons = ["2022-23", "2023-24", "2024-25", "2025-26"]
    with pytest.raises(EmptyDataset):
        ing.ingest_game_log_seasons(ledger, landing, bronze, seasons)
    assert sorted(outcomes(ledger).values(), key=str) == [(FAILURE, None), (PENDING, None), (SUCCESS, 2), (SUCCESS, 3)]
    both = bronze.get_game_logs("*")
    assert both.count() == 5 and dict(both.dtypes)["PTS"] == "bigint" and "_season" not in both.columns
