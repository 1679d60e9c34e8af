import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from cartlane.modes import REFERENCE, STRICT
from cartlane.operators.orders import given_discounts
from cartlane.operators.promotions import active_at, active_at_each
from cartlane.plans.stabbing import stab
from tests.conftest import rows


def brute(points, intervals, start=True):
    return sorted((p, t, i) for p, t in points for i, a, b in intervals if None not in (t, b) and (a is not None or not start) and (not start or a <= t) and t < b)


def run(spark, points, intervals, start="a", **options):
    p = spark.createDataFrame(points, "p int, t long")
    i = spark.createDataFrame(intervals, "i int, a long, b long")
    return sorted(rows(stab(p, i, "t", start, "b", **options), "p", "t", "i"))


@pytest.mark.parametrize("seed", range(4))
def test_equals_brute_force(spark, seed):
    draw = random.Random(seed)
    reach = 10 ** draw.choice([1, 3, 6, 15])
    time = lambda: draw.randrange(-reach, reach)
    points = [(n, None if draw.random() < 0.1 else time()) for n in range(150)]
    intervals = []
    for n in range(120):
        a, length = time(), draw.choice([-2, 0, 1, 2, 3, 7, 8, 30, reach // 100 + 1, reach])
        intervals.append((n, None if draw.random() < 0.1 else a, None if draw.random() < 0.1 else a + length))
    assert run(spark, points, intervals) == brute(points, intervals)
    assert run(spark, points, intervals, start=None) == brute(points, intervals, start=False)


def test_edges_of_intervals(spark):
    points = [(t, t) for t in range(-3, 40)]
    intervals = [(100 * a + b, a, b) for a in range(-2, 36, 3) for b in range(a, a + 37, 4)]
    assert run(spark, points, intervals) == brute(points, intervals)


def test_a_hot_moment_is_dealt_to_parts(spark):
    draw = random.Random(1)
    points = [(n, 500 if n % 3 else draw.randrange(1000)) for n in range(600)]
    intervals = [(n, a := draw.randrange(1000), a + draw.randrange(1, 300)) for n in range(60)]
    assert run(spark, points, intervals, hot=10) == brute(points, intervals)


def test_equal_columns_and_nothing(spark):
    p = spark.createDataFrame([(1, 5, "x"), (2, 5, "y"), (3, 5, None)], "p int, t long, k string")
    i = spark.createDataFrame([(7, 0, 9, "x"), (8, 6, 9, "y"), (9, 0, 9, None)], "i int, a long, b long, k string")
    assert rows(stab(p, i, "t", "a", "b", on=("k",))) == [(1, 5, "x", 7, 0, 9)]
    assert stab(p.filter("false"), i.drop("k"), "t", "a", "b").collect() == []
    assert stab(p, i.filter("false").drop("k"), "t", "a", "b").collect() == []
    with pytest.raises(ValueError):
        stab(p, i, "t", "a", "b")


def test_the_plan_has_no_nested_loop(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        p, i = spark.range(100).selectExpr("id p", "id t"), spark.range(50).selectExpr("id i", "id a", "id + 9 b")
        plan = stab(p, i, "t", "a", "b")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "SortMergeJoin" in plan


DAY = dt.datetime(2024, 1, 1)


def _terms(spark):
    day = lambda n: None if n is None else DAY + dt.timedelta(days=n)
    spans = [(1, 0, 10), (2, 5, 6), (3, None, 9), (4, 3, None), (5, 9, 3), (6, -50, 100)]
    terms = [(i, "percent" if i % 2 else "amount", 10, day(a), day(b)) for i, a, b in spans]
    return spark.createDataFrame(terms, "id long, type string, value int, started_at timestamp_ntz, expired_at timestamp_ntz").withColumn(
        "value", F.col("value").cast("decimal(15,2)")
    )


def test_active_at_each_equals_active_at(spark):
    terms = _terms(spark)
    moments = [DAY + dt.timedelta(days=d, microseconds=m) for d in (-60, 0, 3, 5, 6, 9, 10, 99) for m in (-1, 0, 1)]
    df = spark.createDataFrame([(n, m) for n, m in enumerate(moments)], "moment int, at timestamp_ntz")
    for window in (False, True):
        got = rows(active_at_each(df, "at", terms, window), "moment", "id")
        assert got == sorted(((n, r["id"]) for n, m in enumerate(moments) for r in active_at(terms, m, window).collect()), key=repr)


def test_each_order_is_discounted_at_its_own_time(spark):
    terms = _terms(spark)
    made = [(n, DAY + dt.timedelta(days=n % 12 - 1), None if n % 9 == 8 else n % 8, 100) for n in range(96)]
    df = spark.createDataFrame(made, "id long, at timestamp_ntz, discount_id long, order_amount int")
    df = df.withColumn("order_amount", F.col("order_amount").cast("decimal(15,2)"))
    for mode in (REFERENCE, STRICT):
        got = {r["id"]: (r["discount_id"], r["discount_amount"]) for r in given_discounts(df, terms, F.col("at"), mode).collect()}
        for at in {m[1] for m in made}:
            for r in given_discounts(df.filter(F.col("at") == at), terms, at, mode).collect():
                assert got[r["id"]] == (r["discount_id"], r["discount_amount"])
        assert len(got) == 96 and any(a for _, a in got.values())
