"""Key lists, skewed joins, per-key functions and their budget."""

from collections import Counter

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rimstone.errors import BudgetExceeded, EmptyDataset, MissingColumn
from rimstone.operators import keyed as kd
from rimstone.operators.skew import spread_join

SHAPE = T.StructType([T.StructField("v", T.LongType())])


def games(spark, n=6, source="a"):
    return spark.createDataFrame([(source, i) for i in range(n)], "source_name string, game int")


def test_distinct_keys(spark):
    df = spark.createDataFrame([("a", "0022500001")] * 3 + [("b", "0022500001")], "source_name string, GAME_ID string")
    assert rows(kd.distinct_keys(df, "GAME_ID")) == [("0022500001",)]
    by_source = kd.keys_by_source(df, "GAME_ID")
    assert rows(by_source) == [("a", "0022500001"), ("b", "0022500001")]
    assert rows(kd.key_counts(by_source)) == [("(all)", 2), ("a", 1), ("b", 1)]
    with pytest.raises(MissingColumn, match="gameId"):
        kd.distinct_keys(df, "gameId")
    with pytest.raises(EmptyDataset, match="key list is empty"):
        kd.require_keys(by_source.where("false"))


def test_lookup_and_uncovered(spark):
    logs = spark.createDataFrame([(1, "x"), (1, "y"), (2, "z"), (None, "n")], "g int, v string")
    keys = spark.createDataFrame([(1,), (1,), (3,), (None,)], "g int")
    assert rows(kd.covered_by(logs, keys, "g")) == [(1, "x"), (1, "y")]
    assert rows(kd.uncovered_by(keys, logs, "g")) == [(3,), (None,)]


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("spread", [1, 2, 8])
def test_spread_join_equals_plain_join_on_a_hot_key(spark, how, spread):
    """A third of the rows share one key, and a third are copies of one row."""
    made = [(0, i) for i in range(300)] + [(1, 7)] * 300 + [(i, i) for i in range(300)] + [(None, 1)]
    many = spark.createDataFrame(made, "k int, v int").repartition(5)
    one = spark.createDataFrame([(k, f"n{k}") for k in range(0, 250)], "k int, name string")
    got = Counter(map(tuple, spread_join(many, one, ["k"], how, spread=spread).collect()))
    assert got == Counter(map(tuple, many.join(one, "k", how).collect()))


def test_spread_join_sides_have_their_own_exchange(spark):
    """Adaptive execution splits a hot key only if both shuffles are right below the join."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        many = spark.range(1000).select((F.col("id") % 10).alias("k"), "id")
        one = many.groupBy("k").agg(F.max("id").alias("top"))
        plan = spread_join(many, one, ["k"])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    lines = [line.strip(" :+-") for line in plan.splitlines()]
    at = next(i for i, line in enumerate(lines) if line.startswith("SortMergeJoin"))
    assert lines[at + 1].startswith("Sort") and lines[at + 2].startswith("Exchange")
    assert plan.count("Exchange hashpartitioning(k#") == 3


def test_spread_join_refuses_joins_that_keep_unmatched_copies(spark):
    with pytest.raises(ValueError):
        spread_join(spark.range(1), spark.range(1), ["id"], "full")


def failing_on(bad):
    def function(key):
        if key in bad:
            raise RuntimeError(f"no {key}")
        return [{"v": key * 10}, {"v": key * 10 + 1}]

    return function


def test_per_key_function_keeps_failures(spark):
    applied = kd.apply_per_key(games(spark), "game", failing_on({2}), SHAPE)
    assert rows(kd.results_of(applied)) == sorted([(i * 10 + d,) for i in (0, 1, 3, 4, 5) for d in (0, 1)], key=repr)
    outcomes = {r["game"]: r["error"] for r in kd.outcomes_of(applied).collect()}
    assert outcomes == {0: None, 1: None, 2: "RuntimeError: no 2", 3: None, 4: None, 5: None}


def test_per_key_function_with_several_datasets(spark):
    def function(team):
        return {"roster": [{"v": team}], "coaches": [] if team else [{"name": "c"}]}

    coach = T.StructType([T.StructField("name", T.StringType())])
    applied = kd.apply_per_key(games(spark, 2), "game", function, {"roster": SHAPE, "coaches": coach})
    assert rows(kd.results_of(applied, "roster")) == [(0,), (1,)]
    assert rows(kd.results_of(applied, "coaches")) == [("c",)]


@pytest.mark.parametrize(
    ("n_bad", "budget", "verdict"), [(3, 3, "passed"), (4, 3, "aborted"), (10, 10, "passed"), (11, 10, "aborted")]
)
def test_budget_tolerates_its_number_and_no_more(spark, n_bad, budget, verdict):
    applied = kd.apply_per_key(games(spark, 20), "game", failing_on(set(range(n_bad))), SHAPE)
    report = kd.budget_report(kd.outcomes_of(applied), "game", budget=budget)
    row = report.first()
    assert (row["n_done"], row["n_failed"], row["verdict"]) == (20 - n_bad, n_bad, verdict)
    assert row["failed_keys"] == list(range(min(n_bad, budget + 1)))
    if verdict == "aborted":
        with pytest.raises(BudgetExceeded):
            kd.enforce_budget(report)
    else:
        kd.enforce_budget(report)


def test_budget_is_counted_per_source(spark):
    keys = games(spark, 6, "a").union(games(spark, 6, "b"))
    report = kd.budget_report(
        kd.outcomes_of(kd.apply_per_key(keys, "game", failing_on({0, 1}), SHAPE)), "game", budget=3
    )
    assert {(r["source_name"], r["n_failed"], r["verdict"]) for r in report.collect()} == {
        ("a", 2, "passed"),
        ("b", 2, "passed"),
    }


def test_all_failed_is_an_error(spark):
    applied = kd.apply_per_key(games(spark, 2), "game", failing_on({0, 1}), SHAPE)
    report = kd.budget_report(kd.outcomes_of(applied), "game")
    with pytest.raises(EmptyDataset):
        kd.enforce_budget(report)


def test_adaptive_execution_splits_a_hot_key(spark):
    """With a third of the rows on one key the join below a spread join is split at run time."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
    }
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        many = spark.range(0, 60_000, 1, 6).select(
            F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v")
        )
        one = many.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
        joined = spread_join(many, one, ["k"])
        collected = joined.groupBy("k").agg(F.max("v"), F.count(F.lit(1)).alias("rows"))
        assert sum(r["rows"] for r in collected.collect()) == 60_000
        plan = collected._jdf.queryExecution().executedPlan().toString()
    finally:
        for name in settings:
            spark.conf.unset(name)
    assert "skew=true" in plan


def test_one_aborted_source_among_many_empty_ones(spark):
    rows = [(f"s{i:02}", i, "gone") for i in range(40)] + [("z", k, "gone") for k in range(12)]
    outcomes = spark.createDataFrame(rows, "source_name string, game long, error string")
    with pytest.raises(BudgetExceeded, match="41 sources, 1 of them aborted"):
        kd.enforce_budget(kd.budget_report(outcomes, "game"))


def test_records_of_a_key_are_handed_on_and_withdrawn_when_it_fails(spark):
    """A key of a million records is never held; what a failed key had made does not stay."""

    def function(key):
        import resource

        before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
        for i in range(1_000_000 if key == 0 else 30_000):
            if key == 1 and i == 29_999:
                raise RuntimeError("late")
            yield {"v": i}
        if key == 0 and resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before > 150_000:  # kilobytes
            raise MemoryError("records were held")

    from rimstone.session import materialize

    keys = games(spark, 3).union(spark.createDataFrame([("b", None)], "source_name string, game int"))
    applied = materialize(kd.apply_per_key(keys, "game", function, SHAPE), "applied")
    errors = {(r[0], r["game"]): r["error"] for r in kd.outcomes_of(applied).collect()}
    assert errors == {("a", 0): None, ("a", 1): "RuntimeError: late", ("a", 2): None, ("b", None): None}
    assert applied.where("game = 1 and dataset is not null").count() > 0
    assert kd.results_of(applied).count() == 1_060_000
