"""The named queries on tables above the hot limit without a hot asset: tasks by rows, same results, events numbered once."""

import pytest
from pyspark.sql import functions as F

from convoy.operators import ordered
from convoy.operators.trends import tick_trends
from convoy.plans import testviews as tv
from convoy.plans.catalog import QUERIES

DATA = "/root/testdata/sf0.01"
#: No asset of DATA has as many rows; the table, and with it every bound, has more.
ROWS, TASK, HOT = 10_000, 250, 2_000


@pytest.fixture
def at_size(spark, monkeypatch):
    monkeypatch.setattr(ordered, "TASK_ROWS", TASK)
    spark.conf.set(ordered.HOT_ROWS_CONF, str(HOT))
    yield
    spark.conf.unset(ordered.HOT_ROWS_CONF)


@pytest.mark.parametrize("name", ["window_envelopes", "windowed_consumables", "windowed_telemetry", "windowed_wear", "tick_trends", "pair_wear_trends", "rolling_trend"])
def test_tasks_by_rows(spark, at_size, name):
    df = QUERIES[name](spark, DATA)
    sizes = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) >= 0.8 * ROWS / TASK
    assert max(sizes) < 4 * TASK / ROWS * sum(sizes)
    dealt = sorted(map(str, df.collect()))
    spark.conf.unset(ordered.HOT_ROWS_CONF)
    assert dealt == sorted(map(str, QUERIES[name](spark, DATA).collect()))


def test_events_are_numbered_once(spark, at_size, monkeypatch):
    """Planning must not run the numbering to count what a slice holds."""
    telemetry, most = tv.telemetry(spark, DATA), tv.bound(spark, DATA)
    ran = []
    for name in ("count", "collect"):
        call = getattr(type(telemetry), name)
        monkeypatch.setattr(type(telemetry), name, lambda df, call=call: ran.append(df) or call(df))
    tick_trends(telemetry, "7 days", "14 days", bound=most)
    assert not [df for df in ran if "Window" in df._jdf.queryExecution().analyzed().toString()]
