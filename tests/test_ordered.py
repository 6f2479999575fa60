import random
from datetime import date, timedelta

from pyspark.sql import functions as F

from airtally.operators.ordered import latest_per_key, previous_value, running_sum, top_per_group


def table(seed=1, n=500):
    rng = random.Random(seed)
    days = [date(2024, 1, 1) + timedelta(days=rng.randrange(200)) for _ in range(n)]
    return [("hot" if rng.random() < 0.4 else f"k{rng.randrange(8)}", d, i, rng.randrange(50)) for i, d in enumerate(days)]


SCHEMA = "k string, d date, i int, v int"


def test_previous_value_is_a_lag(spark, rows):
    data = table()
    df = previous_value(spark.createDataFrame(data, SCHEMA), ["k"], ["d", "i"], "v", "prev", F.trunc("d", "month"))
    last, expected = {}, []
    for k, d, i, v in sorted(data, key=lambda r: (r[1], r[2])):
        expected.append((i, last.get(k)))
        last[k] = v
    assert sorted((r["i"], r["prev"]) for r in df.collect()) == sorted(expected)


def test_previous_value_keeps_nulls(spark):
    data = [("a", date(2024, 1, 1), 1, 5), ("a", date(2024, 2, 1), 2, None), ("a", date(2024, 3, 1), 3, 7)]
    df = previous_value(spark.createDataFrame(data, SCHEMA), ["k"], ["d"], "v", "prev", F.trunc("d", "month"))
    assert sorted((r["i"], r["prev"]) for r in df.collect()) == [(1, None), (2, 5), (3, None)]


def test_running_sum(spark):
    data = table(2)
    df = running_sum(spark.createDataFrame(data, SCHEMA), ["k"], ["d", "i"], "v", "s", F.trunc("d", "month"))
    total, expected = {}, []
    for k, d, i, v in sorted(data, key=lambda r: (r[1], r[2])):
        total[k] = total.get(k, 0) + v
        expected.append((i, total[k]))
    assert sorted((r["i"], r["s"]) for r in df.collect()) == sorted(expected)


def test_top_per_group_cuts_before_the_shuffle(spark):
    df = top_per_group(spark.createDataFrame(table(), SCHEMA), ["k"], [F.col("v").desc(), F.col("i")], 3, "r")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
    assert {r["r"] for r in df.collect()} == {1, 2, 3}


def test_latest_per_key_takes_missing_times_first(spark):
    data = [("a", date(2024, 1, 1), 1, 1), ("a", None, 2, 2), ("b", date(2024, 1, 2), 3, 3), ("b", date(2024, 1, 1), 4, 4)]
    df = latest_per_key(spark.createDataFrame(data, SCHEMA), ["k"], [F.col("d").desc_nulls_first()])
    assert sorted(r["i"] for r in df.collect()) == [2, 3]
