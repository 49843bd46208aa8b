import json

import pytest
from pyspark.sql import functions as F

from convoy.operators import alerts, routing
from convoy.operators.regional import latest_state

READ = "device string, type string, t double, seq long, data string"


def timed(spark, rows, ddl):
    return spark.createDataFrame(rows, ddl).withColumn("ts", F.timestamp_micros((F.col("t") * 1e6).cast("long"))).drop("t")


def test_routing(spark):
    rows = timed(spark, [
        ("d", "temperature", 0.0, 1, "{}"), ("d", "Connection_Lost", 0.0, 2, "{}"), ("d", "humidity", 0.0, 3, "{}"),
        ("", "temperature", 0.0, 4, "{}"), (None, "temperature", 0.0, 5, "{}"),
    ], READ)
    out = routing.route_by_config(rows).collect()
    assert [(r.seq, r.window_seconds, r.critical_threshold) for r in out] == [(1, 10, 85.0)]
    assert [r.seq for r in routing.route_by_config(rows, engine="timer").collect()] == [2]
    twice = (("temperature", "window", 10, 1.0), ("temperature", "window", 99, 2.0))
    assert routing.route_by_config(rows, twice).first().critical_threshold == 1.0
    assert routing.route_by_config(rows, (), "window").count() == 0


@pytest.mark.parametrize("data,expected", [
    ('{"temperature": 5.5}', 5.5), ('{"temperature": 0, "value": 7}', 7.0), ('{"temperature": 0.0}', None),
    ('{"value": 0}', 0.0), ('{"value": "abc"}', None), ('{"temperature": "12.5", "value": 1}', 12.5),
    ('{"temperature": "abc", "value": 1}', None), ('{"temperature": null, "value": 3}', 3.0), ("{}", None), ("oops", None),
    ('{"temperature":"0","value":9}', 0.0), ('{"temperature":true}', 1.0), ('{"value":"12d"}', None), ('{"temperature":[],"value":4}', 4.0),
    ('{"temperature":{},"value":"5"}', 5.0), ('{"temperature":[1],"value":4}', None), ('{"temperature":false,"value":false}', 0.0),
    ('{"temperature":"","value":6}', 6.0), ('{"temperature":1e3}', 1000.0), ("[1]", None), (None, None),
])
def test_reading(spark, data, expected):
    out = routing.extract_reading(spark.createDataFrame([(data,)], "data string")).collect()
    assert [r.reading for r in out] == ([] if expected is None else [expected])


@pytest.mark.parametrize("hot_rows", [None, 2])
def test_tumbling(spark, hot_rows):
    values = [("d", 0.0, 85.0), ("d", 1.0, 85.0), ("d", 2.0, 86.0), ("d", 9.9, 10.0), ("d", 10.0, 90.0), ("e", 0.0, 84.0)]
    rows = timed(spark, [(d, "temperature", t, i, json.dumps({"value": v})) for i, (d, t, v) in enumerate(values)], READ)
    readings = routing.extract_reading(routing.route_by_config(rows))
    out = routing.tumbling_alerts(readings, hot_rows=hot_rows).orderBy("seq").collect()
    assert [(r.seq, r.n, round(r["mean"], 6)) for r in out] == [(2, 3, 85.333333), (4, 1, 90.0)]
    means = {(r.device, r.window_start.second): r["mean"] for r in routing.tumbling_mean(readings, "10 seconds").collect()}
    assert means == {("d", 0): 66.5, ("d", 10): 90.0, ("e", 0): 84.0}


def test_types_share_a_mean_on_request(spark):
    rows = timed(spark, [("d", "x", 0.0, 1, '{"value": 100}'), ("d", "y", 1.0, 2, '{"value": 20}')], READ)
    sensors = (("x", "window", 10, 50.0), ("y", "window", 10, 50.0))
    readings = routing.extract_reading(routing.route_by_config(rows, sensors))
    assert [r.n for r in routing.tumbling_alerts(readings, per_type=False).orderBy("seq").collect()] == [1, 2]
    assert [r.n for r in routing.tumbling_alerts(readings).collect()] == [1]


@pytest.mark.parametrize("hot_rows", [None, 1])
def test_offline(spark, hot_rows):
    rows = timed(spark, [
        ("back", 0.0, 1, "lost"), ("back", 45.0, 2, "restored"),
        ("late", 0.0, 3, "lost"), ("late", 45.000001, 4, "restored"),
        ("gone", 0.0, 5, "lost"),
        ("same", 0.0, 6, "restored"), ("same", 0.0, 7, "lost"),
        ("twice", 0.0, 8, "lost"), ("twice", 30.0, 9, "lost"), ("twice", 60.0, 10, "restored"),
        ("other", 0.0, 11, "lost"), ("other", 1.0, 12, "noise"),
    ], "device string, t double, seq long, state string")
    out = routing.offline_alerts(rows, hot_rows=hot_rows)
    assert {r.seq for r in out.collect()} == {3, 5, 7, 8, 11}
    event = json.loads(routing.offline_events(out.filter("seq = 5")).first().data)
    assert event == {"device_id": "gone", "status": "OFFLINE", "timeout_seconds": 45, "severity": "CRITICAL"}


ALERT = "id string, source string, type string, time string, data string"


def test_projection(spark):
    at = "2024-01-01T00:00:00Z"
    events = spark.createDataFrame([
        ("1", "d", "fleet.tactical.ThresholdExceeded", at, '{"severity":"HIGH"}'),
        ("1", "d", "fleet.tactical.ThresholdExceeded", "2024-01-01T00:00:01Z", '{"severity":"LOW"}'),
        ("2", "d", "fleet.tactical.DeviceOfflineAlert", at, '{"severity":"CRITICAL"}'),
        ("3", "", "fleet.tactical.ThresholdExceeded", at, "{}"), ("", "d", "fleet.tactical.X", at, "{}"),
        ("4", "d", "fleet.tactical.X", "", "{}"), ("5", "d", "fleet.sensor.temperature", at, "{}"),
        ("6", "d", "fleet.tactical.ThresholdExceeded", at, "{}"), ("7", "d", "fleet.tactical.X", "not a time", "{}"),
    ], ALERT)
    found = {r.id: (r.device_id, r.severity) for r in alerts.project_alerts(events).collect()}
    assert found == {"1": ("d", "HIGH"), "2": ("d", "UNKNOWN"), "6": ("d", "")}
    stated = {r.id: r.severity for r in alerts.project_alerts(events, severity_from_data=True).collect()}
    assert stated["2"] == "CRITICAL"
    existing = spark.createDataFrame([("1",)], "id string")
    assert {r.id for r in alerts.project_alerts(events, existing).collect()} == {"2", "6"}


def test_critical_actions(spark):
    events = timed(spark, [("CriticalAnomaly", "d", 0.0, 1), ("CriticalAnomaly", None, 0.0, 2), ("Other", "d", 0.0, 3)],
                   "type string, source string, t double, seq long")
    critical = alerts.critical_anomalies(events, default_device="dev")
    rows = alerts.radar_state(critical).orderBy("device_id").collect()
    assert [(r.device_id, r.radar_status, r.transmit_power) for r in rows] == [("d", "DEGRADED", 85), ("dev", "DEGRADED", 85)]
    assert alerts.work_orders(critical).select("id").distinct().count() == 2


def test_latest_state(spark):
    rows = timed(spark, [("a", 1.0, 1, "x"), ("a", 2.0, 0, "y"), ("a", 2.0, 2, "z"), ("", 9.0, 9, "n")],
                 "asset_id string, t double, seq long, body string")
    assert [r.body for r in latest_state(rows).collect()] == ["z"]
