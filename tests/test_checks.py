"""NULL semantics, severities and stored failures of checks."""

import logging

import pytest
from conftest import rows
from pyspark.sql import functions as F

from rimstone.errors import ChecksFailed
from rimstone.operators import checks as ck


def table(spark):
    made = [("W", 5, "abc"), ("L", -1, "abcd"), (None, 3, None), ("X", None, "abc"), ("W", -2, "")]
    return spark.createDataFrame(made, "wl string, margin int, code string")


@pytest.mark.parametrize(
    ("check", "failures"),
    [
        (ck.not_null("wl"), 1),
        (ck.length_is("code", 3), 2),
        (ck.in_range("margin", -1, 4), 2),
        (ck.in_values("wl", ["W", "L"]), 1),
        (ck.holds("result", "(wl = 'W' and margin > 0) or (wl = 'L' and margin < 0)"), 2),
        (ck.holds("same", "<=> nullif(code, '')", column="code"), 1),
        (ck.holds("pattern", "rlike r'^a'", column="code"), 1),
        (ck.holds("like", "like concat('%', 'c', '%')", column="code"), 1),
    ],
)
def test_null_passes_unless_the_rule_is_null_safe(spark, check, failures):
    df = table(spark)
    assert ck.failing_rows(df, check).count() == failures
    assert ck.summarize(df, [check]).first()["failures"] == failures
    assert df.where(check.fails().isNull()).count() == 0


def test_summary_is_one_pass(spark):
    checks = [ck.not_null("wl"), ck.length_is("code", 3), ck.in_range("margin", 0, 9)]
    plan = ck.summarize(table(spark), checks)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan") == 1


def test_values_groups_and_duplicates(spark):
    df = table(spark)
    assert rows(ck.value_counts_outside(df, "wl", ["W", "L"])) == [("X", 1)]
    assert rows(ck.duplicate_keys(df, ["wl"])) == [("W", 2)]
    measures = {"n": F.count(F.lit(1)), "total": F.sum("margin")}
    assert rows(ck.groups_breaking(df, ["wl"], measures, "n = 2")) == sorted(
        [("L", 1, -1), (None, 1, 3), ("X", 1, None)], key=repr
    )
    assert rows(ck.groups_breaking(df, ["wl"], measures, "total > 0")) == [("L", 1, -1)]


def test_enforce_raises_for_errors_and_warns_otherwise(spark, caplog):
    df = table(spark)
    with pytest.raises(ChecksFailed, match=r"not_null_wl \(1\)"):
        ck.enforce(ck.summarize(df, [ck.not_null("wl")]))
    with caplog.at_level(logging.WARNING):
        assert len(ck.enforce(ck.summarize(df, [ck.in_range("margin", 0, 4)]))) == 1
    assert "range_margin" in caplog.text


def test_failures_are_stored(spark):
    check = ck.in_values("wl", ["W", "L"])
    name = ck.store_failures(ck.failing_rows(table(spark), check), check.name)
    assert name == "audit.values_wl"
    assert rows(spark.table(name)) == [("X", None, "abc")]
