"""Tasks of ordered operators grow in number with the rows, not in size."""

import pytest
from pyspark.sql import functions as F

from convoy.operators import ordered
from convoy.operators.ordered import ordered_groups, running_count
from convoy.operators.trends import pair_wear_trends, rolling_trend, tick_trends, windowed_telemetry
from convoy.plans import testviews as tv

DATA = "/root/testdata/sf0.01"
ROWS, TASK = 10_000, 250


@pytest.fixture
def small_tasks(monkeypatch):
    monkeypatch.setattr(ordered, "TASK_ROWS", TASK, raising=False)


def _largest(df):
    """Share of the largest task, and the number of tasks with rows."""
    sizes = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    return max(sizes) / sum(sizes), len(sizes)


def _spread(df):
    share, tasks = _largest(df)
    assert tasks >= 0.8 * ROWS / TASK
    assert share < 4 * TASK / ROWS


def _without_dealing(monkeypatch, make):
    dealt = sorted(map(str, make().collect()))
    monkeypatch.setattr(ordered, "TASK_ROWS", 10**9, raising=False)
    assert dealt == sorted(map(str, make().collect()))


def test_capped_trend(spark, small_tasks, monkeypatch):
    def make():
        return rolling_trend(tv.samples(spark, DATA), "7 days", cap=4, bound=tv.bound(spark, DATA)).select("asset_id", "seq", "n", F.round("slope_per_hour", 6))

    _spread(make())
    _without_dealing(monkeypatch, make)


def test_rolling_trend(spark, small_tasks, monkeypatch):
    def make():
        return rolling_trend(tv.samples(spark, DATA), "7 days", bound=tv.bound(spark, DATA)).select("asset_id", "seq", "n", F.round("slope_per_hour", 6))

    _spread(make())
    _without_dealing(monkeypatch, make)


def _ticks(spark):
    return tick_trends(tv.telemetry(spark, DATA), "7 days", "14 days", bound=tv.bound(spark, DATA))


def test_tick_trends(spark, small_tasks, monkeypatch):
    _spread(_ticks(spark))
    _without_dealing(monkeypatch, lambda: _ticks(spark).select("asset_id", "seq", "signal", "n", F.round("slope_per_hour", 6)))


def test_pair_wear_trends(spark, small_tasks):
    _spread(pair_wear_trends(_ticks(spark)))


def test_windowed_telemetry(spark, small_tasks):
    _spread(windowed_telemetry(tv.telemetry(spark, DATA), "7 days", "14 days", bound=tv.bound(spark, DATA)))


def test_counted_rows_and_split_groups(spark, small_tasks):
    rows = spark.range(ROWS).select((F.col("id") % 500).alias("k"), "id")
    _spread(ordered_groups(rows, "k", ["id"]).with_running(n=running_count()).result())
    hot = ordered_groups(rows.withColumn("k", F.when(F.col("k") < 100, 0).otherwise(F.col("k"))), "k", ["id"], hot_rows=1000)
    assert hot.split
    assert _largest(hot.with_running(n=running_count()).result())[1] >= 20
    assert hot.with_running(n=running_count()).result().agg(F.sum("n")).first()[0] == 2000 * 2001 // 2 + 400 * 20 * 21 // 2
