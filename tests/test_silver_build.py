"""Silver build by versions: write, check, switch."""

import logging

import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_silver import T0, T1, bronze_of, game_row, opponent

from rimstone.errors import ChecksFailed, EmptyDataset, LakeError
from rimstone.gallery.base import split_up
from rimstone.operators import checks as ck
from rimstone.plans import game_logs
from rimstone.sinks import versions as vs

NAME = f"silver_v.{game_logs.TABLE}"


def test_error_check_leaves_the_former_version_and_a_warning_does_not_stop(spark, caplog):
    sound = bronze_of(spark, game_row(), opponent())
    first = game_logs.build(sound, T1, schema="silver_v")
    assert (first.version.rows, first.warnings, first.failures) == (2, {}, None)
    assert vs.published(spark, NAME) == first.version.number
    assert spark.table(NAME).schema["pts"].metadata["comment"] == "Points"

    broken = bronze_of(spark, game_row(), opponent(REB=99))
    with pytest.raises(ChecksFailed, match="rule_reb"):
        game_logs.build(broken, T1, schema="silver_v")
    assert vs.published(spark, NAME) == first.version.number
    assert rows(spark.table(NAME).select("reb").distinct()) == [(52,)]
    assert vs.versions(spark, NAME) == [first.version.number]
    kept = spark.table(f"audit.{game_logs.TABLE}_failures")
    assert rows(kept.select("check", "severity", "team_abbreviation", "reb")) == [
        ("range_reb", "warn", "OKC", 99), ("rule_reb", "error", "OKC", 99),
    ]

    odd = bronze_of(spark, game_row(MIN=999), opponent())
    with caplog.at_level(logging.WARNING):
        second = game_logs.build(odd, T1, schema="silver_v")
    assert second.warnings == {"range_min": 1} and "range_min" in caplog.text
    assert vs.published(spark, NAME) == second.version.number
    assert spark.table(NAME).agg(F.max("min")).first()[0] == 999

    assert vs.roll_back(spark, NAME) == first.version.number
    assert spark.table(NAME).agg(F.max("min")).first()[0] == 290
    with pytest.raises(LakeError, match="no former version"):
        vs.roll_back(spark, NAME)


def test_empty_build_is_refused_and_old_versions_expire(spark):
    declared = spark.range(1).schema
    with pytest.raises(EmptyDataset):
        vs.stage(spark.range(0), "small", declared, schema="silver_w")
    assert vs.published(spark, "silver_w.small") is None
    spark.range(1).write.saveAsTable("silver_w.small")  # a plain table from before
    made = []
    for n in (2, 3, 4):
        version = vs.stage(spark.range(n), "small", declared, schema="silver_w")
        vs.switch(spark, version)
        made.append(version.number)
    assert spark.table("silver_w.small").count() == 4
    pending = vs.stage(spark.range(9), "small", declared, schema="silver_w")
    assert vs.expire(spark, "silver_w.small", keep=2) == ["0" * 20, made[0]]
    assert vs.versions(spark, "silver_w.small") == [*made[1:], pending.number]
    assert spark.table("silver_w.small").count() == 4


def test_failing_rows_of_all_checks_in_one_pass(spark):
    made = [(1, "W", "abc"), (2, None, "abcd"), (None, "X", None), (None, "W", "abc"), (1, "L", "x")]
    df = spark.createDataFrame(made, "k int, wl string, code string")
    checks = [ck.not_null("wl"), ck.length_is("code", 3), ck.in_values("wl", ["W", "L"], severity=ck.WARN)]
    twice = ck.GroupCheck("unique_k", "unique", ("k",), ck.duplicate_keys(df, ["k"]))
    found = ck.failing_check_rows(df, checks, [twice])
    assert rows(found) == sorted(
        [
            ("not_null_wl", "not_null", "error", 2, None, "abcd"),
            ("length_code", "length_equal_to", "error", 2, None, "abcd"),
            ("length_code", "length_equal_to", "error", 1, "L", "x"),
            ("values_wl", "accepted_values", "warn", None, "X", None),
            *[("unique_k", "unique", "error", *row) for row in made if row[0] != 2],
        ],
        key=repr,
    )
    plain = ck.failing_check_rows(df, checks)._jdf.queryExecution().executedPlan().toString()
    assert plain.count("Scan") == 1 and "Exchange" not in plain


def test_failing_rows_agree_with_the_summary(spark):
    older = game_row(_ingested_at=T0, GAME_ID="0022500002")
    bronze = bronze_of(spark, game_row(), opponent(PLUS_MINUS=2, WL=None), older, game_row(_ingested_at=T1, GAME_ID="0022500002"))
    table = game_logs.silver(bronze.where("not (GAME_ID = '0022500002' and _ingested_at > '2025-10-22 12:00:00')"), T1)
    counted = {r["check"]: r["count"] for r in game_logs.failing_rows_of(table, bronze).groupBy("check").count().collect()}
    summary = {r["check"]: r["failures"] for r in game_logs.check_table(table, bronze).where("failures > 0").collect()}
    assert set(counted) == set(summary) and counted["not_latest_bronze"] == 1
    assert counted["not_two_zero_sum_rows"] == 3 and summary["not_two_zero_sum_rows"] == 2


def test_few_broken_groups_leave_the_table_unshuffled(spark):
    df = spark.range(2000).selectExpr("id", "cast(nullif(id % 1999, 5) as string) as k")
    twice = ck.GroupCheck("unique_k", "unique", ("k",), ck.duplicate_keys(df, ["k"]))
    found = ck.failing_check_rows(df, [ck.not_null("k")], [twice])
    assert rows(found.select("check", "id")) == [("not_null_k", 5), ("unique_k", 0), ("unique_k", 1999)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_partitions_of_orders_grow_with_their_rows(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    spark.range(1000).coalesce(1).write.parquet(path)
    cut = split_up(spark.read.parquet(path), "id", 50)
    assert cut.rdd.getNumPartitions() == 20 and cut.count() == 1000
    assert split_up(spark.read.parquet(path), "id").rdd.getNumPartitions() == 8
