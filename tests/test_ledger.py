"""Run ledger, reconcile and the report calendar."""

from datetime import datetime, timedelta, timezone

import pytest
from conftest import rows
from pyspark.sql import functions as F

from rimstone.operators import calendar as cal
from rimstone.operators.ledger import FAILURE, PENDING, SUCCESS, Ledger, latest_good, missing, run_state

NOW = datetime(2026, 1, 1, 12, tzinfo=timezone.utc)
LONG_AGO = NOW - timedelta(minutes=30)


@pytest.fixture
def ledger(spark, tmp_path):
    made = Ledger(spark, str(tmp_path / "ledger"))
    made.create()
    made.create()
    return made


def keys_of(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "s3_key string")


def statuses(ledger):
    return {r["s3_key"]: r["status"] for r in ledger.state().collect()}


def test_open_and_close(ledger):
    (run,) = ledger.open_runs(["s/a.parquet"], LONG_AGO)
    assert len(run.run_id) == 64
    assert statuses(ledger) == {"s/a.parquet": PENDING}
    ledger.close(run, SUCCESS, rows_in=5, ended_at=LONG_AGO)
    (row,) = ledger.state().collect()
    assert (row["status"], row["rows_in"], row["error_message"]) == (SUCCESS, 5, None)
    assert ledger.events().count() == 2


def test_outcome_beats_pending_at_equal_time(spark, ledger):
    (run,) = ledger.open_runs(["k"], NOW)
    ledger.close(run, FAILURE, error="boom", ended_at=NOW)
    for _ in range(2):
        state = run_state(ledger.events().repartition(3))
        assert rows(state.select("status", "error_message")) == [(FAILURE, "boom")]


@pytest.mark.parametrize(
    ("stored", "expected"),
    [
        ({"a"}, {"a": SUCCESS, "b": FAILURE}),
        (set(), {"a": FAILURE, "b": FAILURE}),
        ({"a", "b"}, {"a": SUCCESS, "b": SUCCESS}),
    ],
)
def test_reconcile_routes_stale_runs(spark, ledger, stored, expected):
    ledger.open_runs(["a", "b"], LONG_AGO)
    ledger.open_runs(["fresh"], NOW - timedelta(minutes=10))
    objects = keys_of(spark, *stored, "other", "other")
    counts = ledger.reconcile(lambda stale: objects, NOW)
    assert counts == {s: list(expected.values()).count(s) for s in (SUCCESS, FAILURE)}
    assert statuses(ledger) == {**expected, "fresh": PENDING}


def test_reconcile_of_nothing_writes_nothing(spark, ledger):
    before = ledger.events().inputFiles()
    assert ledger.reconcile(None, NOW) == {SUCCESS: 0, FAILURE: 0}
    ledger.set_status(spark.createDataFrame([], "run_id string, outcome string"))
    assert ledger.events().inputFiles() == before


def test_only_successful_ended_runs_with_rows_are_done(spark, ledger):
    for name, status, n in (("done", SUCCESS, 3), ("empty", SUCCESS, 0), ("failed", FAILURE, None)):
        (run,) = ledger.open_runs([name], LONG_AGO)
        ledger.close(run, status, rows_in=n)
    ledger.open_runs(["open"], NOW)
    wanted = keys_of(spark, "done", "empty", "failed", "open", "new")
    assert rows(ledger.missing(wanted)) == [("empty",), ("failed",), ("new",), ("open",)]
    assert not ledger.should_ingest("done") and ledger.should_ingest("empty") and ledger.should_ingest("new")


def test_promoted_run_does_not_count_as_done(spark, ledger):
    ledger.open_runs(["a"], LONG_AGO)
    ledger.reconcile(lambda stale: keys_of(spark, "a"), NOW)
    assert statuses(ledger) == {"a": SUCCESS}
    assert ledger.should_ingest("a")


def test_latest_good_run_per_key(spark):
    made = [
        ("r1", "a", datetime(2026, 1, 1), SUCCESS, 5), ("r2", "a", datetime(2026, 1, 2), SUCCESS, 6),
        ("r3", "a", datetime(2026, 1, 3), SUCCESS, 0), ("r4", "b", datetime(2026, 1, 1), FAILURE, 9),
    ]
    state = spark.createDataFrame(made, "run_id string, s3_key string, ended_at timestamp, status string, rows_in long")
    assert rows(latest_good(state).select("run_id")) == [("r2",)]
    assert rows(missing(keys_of(spark, "a", "b"), state)) == [("b",)]


def years(spark, *values):
    return spark.createDataFrame([(y,) for y in values], "year int")


def test_hourly_calendar(spark):
    slots = cal.slot_calendar(years(spark, 2024), datetime(2030, 1, 1))
    assert slots.count() == 6553
    assert {r["m"] for r in slots.select(F.month("slot_time").alias("m")).distinct().collect()} == {
        1, 2, 3, 4, 5, 6, 10, 11, 12,
    }
    assert slots.where("date(slot_time) = '2024-12-31'").count() == 1
    first = slots.orderBy("slot_time").first()
    assert first["slot"] == "2024-01-01_12AM"


def test_quarter_calendar_and_future(spark):
    as_of = datetime(2026, 6, 15, 12)
    slots = cal.report_urls(cal.slot_calendar(years(spark, 2026), as_of))
    last = slots.orderBy(F.col("slot_time").desc()).first()
    assert last["slot_time"] == as_of and last["slot"] == "2026-06-15_12_00PM"
    assert last["url"] == "https://ak-static.cms.nba.com/referee/injury/Injury-Report_2026-06-15_12_00PM.pdf"
    assert slots.where("slot_time > timestamp_ntz'2026-06-15 12:00:00'").count() == 0
    assert rows(cal.year_table(spark))[0] == (2018,) and cal.year_table(spark).count() == 9


def test_missing_slots(spark):
    slots = cal.report_urls(cal.slot_calendar(years(spark, 2024), datetime(2024, 1, 1, 3)))
    present = spark.createDataFrame([("Injury-Report_2024-01-01_01AM.pdf",)] * 2, "file_name string")
    left = cal.missing_slots(slots, present, "file_name")
    assert [r["slot"] for r in left.orderBy("slot_time").collect()] == [
        "2024-01-01_12AM", "2024-01-01_02AM", "2024-01-01_03AM",
    ]


def test_a_state_read_touches_the_snapshot_and_the_tail_only(spark, ledger):
    runs = ledger.open_runs(["a", "b"], LONG_AGO)
    ledger.close(runs[0], SUCCESS, rows_in=3, ended_at=LONG_AGO)
    before = rows(ledger.state())
    assert ledger.compact() == 1 and ledger.generation() == 1
    assert rows(ledger.state()) == before
    assert all("/snapshot-000001/" in f for f in ledger.recent().inputFiles())
    ledger.open_runs(["c"], LONG_AGO)
    read = ledger.recent().inputFiles()
    assert any("/tail-000001/" in f for f in read) and not any("/tail-000000/" in f for f in read)
    changes = ledger.state().where("s3_key = 'b'").select("run_id", F.lit(FAILURE).alias("outcome"))
    ledger.set_status(changes, NOW)
    assert statuses(ledger) == {"a": SUCCESS, "b": FAILURE, "c": PENDING}
    assert ledger.compact() == 2
    assert statuses(ledger) == {"a": SUCCESS, "b": FAILURE, "c": PENDING}
    assert ledger.events().count() == 5
    assert ledger.should_ingest("b") and not ledger.should_ingest("a")


def test_an_unfinished_snapshot_is_not_read(spark, ledger, tmp_path):
    ledger.open_runs(["a"], LONG_AGO)
    ledger.compact()
    unfinished = tmp_path / "ledger" / "snapshot-000002"
    unfinished.mkdir()
    (unfinished / "part-0.parquet").write_bytes(b"half")
    assert ledger.generation() == 1 and statuses(ledger) == {"a": PENDING}
    assert ledger.compact() == 2 and statuses(ledger) == {"a": PENDING}
    assert not ledger.compact_if(files=1)
    ledger.open_runs(["b"], LONG_AGO)
    assert ledger.compact_if(files=1)
    ledger.forget(keep=1)
    assert statuses(ledger) == {"a": PENDING, "b": PENDING} and ledger.generation() == 3


def test_status_updates_keep_their_tasks(spark, ledger):
    ledger.open_runs([f"k{i}" for i in range(40)], LONG_AGO)
    states = ledger.state().select("run_id", F.lit(FAILURE).alias("outcome"))
    ledger.set_status(states.repartition(4), NOW)
    assert set(statuses(ledger).values()) == {FAILURE}
