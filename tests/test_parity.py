"""Every query against its SQL at sf0.01, and with hot groups forced at sf0.001."""

import pytest

import parity
from __spark_entry__ import entry, oracle_sql, queries
from convoy.plans.catalog import QUERIES
from convoy.plans.oracles import ORACLES
from convoy.operators.ordered import HOT_ROWS_CONF

SMALL, MEDIUM = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
ORDERED = (
    "odometer", "terrain_integral", "observed_hours", "rounds_fired", "wear_running", "derived_events",
    "tumbling_alerts", "offline_alerts", "resolve_region_with_hold", "ewma", "sample_delta", "thermal_runaway",
    "emit_ticks", "tick_trends", "capped_trend", "rolling_trend", "windowed_telemetry", "thermal_drift", "usage_state",
)


@pytest.fixture(scope="module")
def connections():
    return {sf: parity.connect(sf) for sf in (SMALL, MEDIUM)}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, connections, name):
    difference = parity.compare(QUERIES[name](spark, MEDIUM), connections[MEDIUM], ORACLES[name])
    assert difference is None, difference


@pytest.mark.parametrize("name", ORDERED)
def test_query_with_hot_groups(spark, connections, name):
    spark.conf.set(HOT_ROWS_CONF, "10")
    try:
        df = QUERIES[name](spark, SMALL)
        difference = parity.compare(df, connections[SMALL], ORACLES[name])
    finally:
        spark.conf.unset(HOT_ROWS_CONF)
    assert difference is None, difference


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.keys() <= queries().keys() and ORACLES.items() <= oracle_sql().items()


def test_entry(spark):
    assert entry(spark).count() == 2
