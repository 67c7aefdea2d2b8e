"""As-of and interval joins against plain versions, with everything on one key, NULLs and ties."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from rimstone.operators.asof import asof_join
from rimstone.operators.intervals import interval_join


def plain_asof(left, right):
    out = []
    for k, t, v in left:
        before = [(rt, rv) for rk, rt, rv in right if None not in (k, t, rk, rt) and rk == k and rt <= t]
        best = max(before, key=lambda r: (r[0], r[1] is not None, r[1] or 0), default=(None, None))
        out.append((k, t, v, *best))
    return Counter(out)


@pytest.mark.parametrize("share", [0.0, 0.4, 1.0])
@pytest.mark.parametrize("partitions", [1, 7])
def test_asof_join(spark, share, partitions):
    pick = random.Random(4)

    def key():
        return 0 if pick.random() < share else pick.choice([1, 2, 3, None])

    left = [(key(), pick.choice([pick.randrange(200), None] if i % 9 == 0 else [pick.randrange(200)]), i) for i in range(300)]
    right = [(key(), pick.choice([pick.randrange(150, 160), pick.randrange(200)]), pick.choice([1, 2, None])) for _ in range(90)]
    right += right[:5] + [(0, None, 1)]
    a = spark.createDataFrame(left, "k int, t int, v int")
    b = spark.createDataFrame(right, "k int, at int, w int")
    joined = asof_join(a, b, ["k"], "t", "at", partitions)
    assert joined.columns == ["k", "t", "v", "at", "w"]
    assert Counter(map(tuple, joined.collect())) == plain_asof(left, right)
    assert asof_join(a, b.where("false"), ["k"], "t", "at").where("at is not null").isEmpty()
    assert asof_join(a.where("false"), b, ["k"], "t", "at").isEmpty()


def test_one_key_fills_many_partitions(spark):
    """All rows have one key, and only the first of them has anything to carry, through every partition."""
    left = spark.range(4000).select(F.lit("x").alias("k"), F.col("id").alias("t"))
    right = spark.createDataFrame([("x", 5, "first")], "k string, at long, name string")
    joined = asof_join(left, right, ["k"], "t", "at", 8)
    assert joined.where("name = 'first'").count() == 3995
    with pytest.raises(ValueError, match="both tables"):
        asof_join(left, right.withColumnRenamed("name", "t"), ["k"], "t", "at")


@pytest.mark.parametrize("kind", ["int", "double", "timestamp", "timestamp_ntz", "date"])
def test_interval_join(spark, kind):
    pick = random.Random(8)
    points = [(pick.choice([0, 0, 1, None]), pick.randrange(-50, 900), i) for i in range(200)] + [(0, None, 999)]
    spans = []
    for i in range(150):
        low = pick.randrange(-40, 800)
        spans.append((pick.choice([0, 0, 1, None]), low, low + pick.choice([0, 0, 1, 3, 4, 16, 64, 700, -5]), 1000 + i))
    spans += [(0, None, 5, 1), (0, 5, None, 2), *spans[:3]]

    def typed(df, *columns):
        how = {"timestamp": "timestamp_seconds({c} * 900)", "timestamp_ntz": "timestamp_ntz'2024-03-31 00:00:00' + make_dt_interval(0, 0, {c} * 10, 0)",
               "date": "date_add(date'2024-01-01', {c})"}.get(kind, f"cast({{c}} as {kind})")
        return df.withColumns({c: F.expr(how.format(c=c)) for c in columns})

    a = typed(spark.createDataFrame(points, "k int, at int, p int"), "at")
    b = typed(spark.createDataFrame(spans, "k int, low int, high int, s int"), "low", "high")
    got = interval_join(a, b, ["k"], "at", "low", "high")
    want = Counter(
        (p, s) for k, at, p in points for ks, low, high, s in spans
        if None not in (k, at, ks, low, high) and k == ks and low <= at <= high
    )
    assert Counter(map(tuple, got.select("p", "s").collect())) == want
    assert "NestedLoop" not in got._jdf.queryExecution().executedPlan().toString()
    assert interval_join(a, b.where("false"), ["k"], "at", "low", "high").isEmpty()
