"""A stream over the same rows, split into several files, gives what the batch operator gives."""

import json
import os

import pytest
from pyspark.sql import functions as F

from convoy.operators import alerts, regional, routing, thermal, trends, usage
from convoy.plans import testviews as tv
from convoy.sources import readers
from convoy.sources.tables import BatchTable, KeyedTable
from convoy.streaming import jobs

SF = "/root/testdata/sf0.001"
NOW = {"availableNow": True}


@pytest.fixture()
def run(spark, tmp_path):
    def as_stream(df, name):
        """Three files in time order, one per micro-batch."""
        path = str(tmp_path / name)
        cut = df.withColumn("_part", F.ntile(3).over(tv_order()))
        for part in (1, 2, 3):
            cut.filter(F.col("_part") == part).drop("_part").coalesce(1).write.mode("append").parquet(path)
        return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)

    def collect(stream, name):
        query = (
            stream.writeStream.format("memory").queryName(name).outputMode("append")
            .option("checkpointLocation", str(tmp_path / f"{name}-checkpoint")).trigger(**NOW).start()
        )
        query.awaitTermination()
        return spark.table(name)

    return as_stream, collect, tmp_path


def tv_order():
    from pyspark.sql import Window
    return Window.orderBy("ts", "seq")


def text_device():
    return F.col("device").cast("string")


def rows(df, *columns):
    return sorted(tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.select(*columns).collect())


def test_offline(spark, run):
    as_stream, collect, _ = run
    source = tv.connections(spark, SF)
    stream = jobs.stream_offline(as_stream(source, "conn"), "0 seconds", tv.OFFLINE_SECONDS)
    plan = stream._jdf.queryExecution().logical().toString()
    assert "LeftOuter" in plan and "TransformWithState" not in plan and "Python" not in plan
    streamed = collect(stream, "offline_out")
    end = source.agg(F.max(F.unix_micros("ts"))).first()[0]
    batch = routing.offline_alerts(source, tv.OFFLINE_SECONDS).withColumn("detected_us", F.unix_micros("detected_at"))
    due = rows(batch.filter(F.col("detected_us") < end - 1000), text_device(), "seq", "detected_us")
    assert due and due == [r for r in rows(streamed, "device", "seq", "detected_us") if r[2] < end - 1000]


def test_tumbling_alerts(spark, run):
    as_stream, collect, _ = run
    source = routing.extract_reading(routing.route_by_config(tv.readings(spark, SF), tv.SENSORS))
    streamed = collect(jobs.stream_tumbling_alerts(as_stream(source, "read"), "0 seconds", per_type=False), "tumbling_out")
    batch = routing.tumbling_alerts(source, per_type=False)
    assert rows(streamed, "device", "seq", "n", "mean") == rows(batch, text_device(), "seq", "n", "mean") != []


def test_tumbling_mean(spark, run):
    as_stream, collect, _ = run
    source = routing.extract_reading(routing.route_by_config(tv.readings(spark, SF), tv.SENSORS))
    streamed = rows(collect(jobs.stream_tumbling_mean(as_stream(source, "mean"), "1 day", "0 seconds"), "mean_out"),
                    "device", F.col("window_start").cast("long"), "n", "mean")
    batch = rows(routing.tumbling_mean(source, "1 day"), text_device(), F.col("window_start").cast("long"), "n", "mean")
    last = max(r[1] for r in batch)
    assert [r for r in streamed if r[1] < last] == [r for r in batch if r[1] < last]


def test_wear(spark, run):
    as_stream, collect, _ = run
    source = tv.telemetry(spark, SF)
    fired = F.col("sustainment.wear.components").isNotNull()
    streamed = collect(jobs.stream_wear(as_stream(source, "tel"), fired), "wear_out")
    batch = usage.running_usage(usage.kinematics(source, fired.alias("fired")), F.col("fired"))
    names = ("asset_id", "seq", "distance_m", "terrain_deg_km", "observed_hours", "rounds_fired")
    assert rows(streamed, *names) == rows(batch, *names)


def test_trends(spark, run):
    as_stream, collect, _ = run
    source = tv.telemetry(spark, SF)
    streamed = collect(jobs.stream_trends(as_stream(source, "trend"), "7 days", "14 days"), "trend_out")
    batch = trends.tick_trends(source, "7 days", "14 days").filter("n >= 2")
    names = ("asset_id", "seq", "signal", "n", "slope_per_hour", "r_squared", "latest", "window_start_us")
    assert rows(streamed, *names) == rows(batch, *names)


def _half(source, first):
    half = source.agg(F.percentile_approx(F.unix_micros("ts"), 0.5)).first()[0]
    return source.filter(F.unix_micros("ts") <= half if first else F.unix_micros("ts") > half)


def test_wear_goes_on_from_a_batch(spark, run):
    """A stream over the second half that starts with the state of the first; the state can be read back after a restart."""
    as_stream, collect, tmp = run
    source = tv.telemetry(spark, SF)
    fired = F.col("sustainment.wear.components").isNotNull()
    before = usage.usage_state(usage.kinematics(_half(source, True), fired.alias("fired")), F.col("fired"))
    folder = str(tmp / "before")
    before.write.parquet(folder)
    stream = jobs.stream_wear(as_stream(_half(source, False), "later"), fired, spark.read.parquet(folder))
    streamed = collect(stream, "later_out")
    whole = usage.running_usage(usage.kinematics(source, fired.alias("fired")), F.col("fired"))
    half = _half(source, True).agg(F.max(F.unix_micros("ts"))).first()[0]
    names = ("asset_id", "seq", "distance_m", "terrain_deg_km", "observed_hours", "rounds_fired")
    assert rows(streamed, *names) == rows(whole.filter(F.unix_micros("ts") > half), *names) != []

    state = spark.read.format("statestore").option("path", str(tmp / "later_out-checkpoint")).option("stateVarName", "usage").load()
    held = state.select(F.col("key.asset_id").alias("asset_id"), "value.*")
    end = usage.usage_state(usage.kinematics(source, fired.alias("fired")), F.col("fired"))
    names = ("asset_id", "distance_m", "first_us", "last_us", "rounds", "x", "roll")
    assert rows(held, *names) == rows(end, *names)


def test_several_detectors(spark, run):
    as_stream, collect, _ = run
    source = tv.telemetry(spark, SF)
    streamed = collect(jobs.stream_detect(as_stream(source, "det")), "det_out")
    batch = thermal.detect(thermal.event_view(source), [thermal.thermal_runaway, thermal.thermal_drift])
    names = ("rule_id", "severity", "asset_id", "seq", "summary", F.col("detected_at").cast("long"))
    assert rows(streamed, *names) == rows(batch, *names)
    assert len({r.rule_id for r in streamed.collect()}) == 2
    drift = F.get_json_object("evidence", "$.drift_k").cast("double")
    assert rows(streamed.filter("rule_id like '%drift%'"), "asset_id", "seq", drift) == rows(batch.filter("rule_id like '%drift%'"), "asset_id", "seq", drift)


def test_silent_assets_leave_the_state(spark, run):
    """With ``idle`` the state of an asset that no longer sends goes; what is written follows the batch."""
    import time

    _, collect, tmp = run
    source = tv.telemetry(spark, SF)
    assets = sorted(r[0] for r in source.select("asset.asset_id").distinct().collect())
    folder, checkpoint = str(tmp / "silent"), str(tmp / "silent-checkpoint")
    source.withColumn("n", F.row_number().over(tv_order())).filter("n <= 200").drop("n").coalesce(1).write.parquet(folder)

    def step(name):
        """Entries of the state after the rows that have come since the step before."""
        stream = spark.readStream.schema(source.schema).parquet(folder)
        query = jobs.stream_trends(stream, "7 days", "14 days", idle="20 seconds").writeStream.format("noop").queryName(name).outputMode(
            "append").option("checkpointLocation", checkpoint).trigger(processingTime="1 second").start()
        try:
            deadline, seen = time.time() + 40, []
            while time.time() < deadline and not seen:
                time.sleep(0.5)
                seen = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["numInputRows"] > 0]
            return seen[-1]
        finally:
            query.stop()

    entries = step("silent_one")
    assert entries > 100
    one = assets[0]
    time.sleep(21)
    source.filter(F.col("asset.asset_id") == one).limit(20).coalesce(1).write.mode("append").parquet(folder)
    assert 0 < step("silent_two") < entries / 3


def test_offline_keeps_open_losses_only(spark, run):
    """Losses on both sides of the watermark, a restore at the very end of the timeout, and repeated rows."""
    _, collect, tmp = run
    lost, restored = "Connection_Lost", "Connection_Restored"
    write_events(tmp / "events", [
        [("1", "a", lost, 0, {}), ("1", "a", lost, 0, {}), ("2", "b", lost, 0, {}), ("3", "", lost, 0, {})],
        [("4", "b", restored, 45, {}), ("5", "c", lost, 10, {}), ("6", "c", restored, 56, {})],
        [("7", "d", lost, 500, {})], [("8", "d", restored, 500, {})], [("9", "e", lost, 900, {})], [("10", "e", restored, 901, {})],
    ])
    source = routing.connection_states(readers.read_cloud_events(spark, str(tmp / "events"), stream=True, maxFilesPerTrigger="1"))
    streamed = collect(jobs.stream_offline(source, "1 minute"), "open_out")
    batch = routing.offline_alerts(routing.connection_states(readers.read_cloud_events(spark, str(tmp / "events"))))
    assert rows(streamed, "device") == rows(batch, "device") == [("a",), ("a",), ("c",), ("d",)]


def write_events(folder, batches):
    """Cloud events as JSON lines, a file for each micro-batch."""
    folder.mkdir()
    for number, events in enumerate(batches):
        lines = [
            json.dumps({"id": i, "source": d, "type": t, "time": f"2024-01-01T00:{s // 60:02d}:{s % 60:02d}Z", "data": json.dumps(data)})
            for i, d, t, s, data in events
        ]
        path = folder / f"{number}.json"
        path.write_text("\n".join(lines))
        os.utime(path, (1_700_000_000 + number, 1_700_000_000 + number))


def test_offline_from_cloud_events(spark, run):
    """Text ids, and a restore that comes two batches after its loss, though only five seconds later in event time."""
    _, collect, tmp = run
    lost, restored = "fleet.sensor.Connection_Lost", "Connection_Restored"
    write_events(tmp / "events", [
        [("1", "radar-1", lost, 0, {}), ("2", "radar-2", lost, 1, {})],
        [("3", "radar-3", lost, 40, {}), ("x", "radar-1", "other", 41, {})],
        [("4", "radar-1", restored, 5, {}), ("5", "radar-3", restored, 80, {})],
        [("6", "radar-9", lost, 600, {})],
        [("7", "radar-9", restored, 601, {})],
    ])
    source = routing.connection_states(readers.read_cloud_events(spark, str(tmp / "events"), stream=True, maxFilesPerTrigger="1"))
    streamed = collect(jobs.stream_offline(source, "1 minute"), "late_out")
    batch = routing.offline_alerts(routing.connection_states(readers.read_cloud_events(spark, str(tmp / "events"))))
    assert rows(streamed, "device") == rows(batch, "device") == [("radar-2",)]


def test_tumbling_from_cloud_events(spark, run):
    _, collect, tmp = run
    kind = "fleet.sensor.temperature"
    write_events(tmp / "events", [
        [("1", "radar-1", kind, 0, {"temperature": 90}), ("2", "radar-1", kind, 3, {"temperature": "80"})],
        [("3", "radar-1", kind, 9, {"value": 99}), ("4", "radar-2", kind, 4, {"temperature": 10})],
        [("5", "radar-2", kind, 5, {"temperature": 200})],
    ])
    sensors = routing.namespaced()

    def read(stream):
        events = readers.read_cloud_events(spark, str(tmp / "events"), stream=stream, **({"maxFilesPerTrigger": "1"} if stream else {}))
        return routing.extract_reading(routing.route_by_config(events, sensors))

    streamed = collect(jobs.stream_tumbling_alerts(read(True), "1 minute"), "tumble_out")
    assert rows(streamed, "device", "n", "mean") == rows(routing.tumbling_alerts(read(False)), "device", "n", "mean") != []


def test_region_with_hold(spark, run):
    """The registry row may come shortly after the event, and in a later batch."""
    _, collect, tmp = run
    event = "asset_id string, region_id string, ms long, seq long, note string"
    entry = "asset_id string, region_id string, edge_id string, ms long, seq long"
    events = [
        [("a", "", 1000, 1, "x"), ("b", "", 1000, 2, "y"), ("c", "given", 1000, 3, None)],
        [("a", "", 5000, 4, "z"), ("d", "", 5000, 5, "w"), ("d", None, 5001, 6, "v")],
        [("q", "", 90_000, 7, "end")], [("q", "", 190_000, 8, "end")],
    ]
    registry = [
        [("a", "east", "e", 500, 1)], [("b", "west", "e", 1350, 2), ("a", "north", "e", 4000, 3), ("d", "late", "e", 5400, 4)],
        [("z", "far", "e", 90_000, 5)], [("z", "far", "e", 190_000, 6)],
    ]

    def source(name, batches, ddl, stream):
        folder = tmp / name
        if not folder.exists():
            for number, rows_ in enumerate(batches):
                part = spark.createDataFrame(rows_, ddl).withColumn("ts", F.timestamp_millis("ms")).drop("ms")
                part.coalesce(1).write.mode("append").parquet(str(folder))
        reader = spark.readStream.option("maxFilesPerTrigger", 1) if stream else spark.read
        return reader.schema(spark.read.parquet(str(folder)).schema).parquet(str(folder))

    def both(stream):
        return source("ev", events, event, stream), source("reg", registry, entry, stream)

    streamed = collect(jobs.stream_resolve_region(*both(True), "5 seconds"), "region_out")
    names = ("asset_id", "region_id", "seq", F.coalesce("note", F.lit("")))
    assert rows(streamed.filter("asset_id <> 'q'"), *names) == rows(regional.resolve_region(*both(False)), *names)
    assert {r.seq: r.region_id for r in streamed.collect()} == {1: "east", 2: "west", 3: "given", 4: "north", 5: "late", 6: "late"}


def test_region_with_hold_and_events_out_of_order(spark, run):
    """A held event ahead of the watermark does not end what an event before it needs; repeated rows stay."""
    _, collect, tmp = run
    event = "asset_id string, region_id string, ms long, seq long, note string"
    entry = "asset_id string, region_id string, edge_id string, ms long, seq long"
    events = [
        [("a", "", 100_000, 1, "early"), ("a", "", 110_000, 2, "ahead"), ("a", "", 110_000, 2, "again"), ("a", "", 110_000, 2, "again")],
        [("q", "", 112_000, 3, "end")], [("q", "", 112_001, 4, "end")], [("a", "", 107_000, 5, "late")], [("q", "", 290_000, 6, "end")],
    ]
    registry = [[("a", "old", "e", 90_000, 1), ("a", "new", "e", 108_500, 2)], [("z", "far", "e", 112_000, 3)],
                [("z", "far", "e", 112_001, 4)], [("z", "far", "e", 112_002, 5)], [("z", "far", "e", 290_000, 6)]]

    def source(name, batches, ddl, stream):
        folder = tmp / name
        if not folder.exists():
            for rows_ in batches:
                part = spark.createDataFrame(rows_, ddl).withColumn("ts", F.timestamp_millis("ms")).drop("ms")
                part.coalesce(1).write.mode("append").parquet(str(folder))
        reader = spark.readStream.option("maxFilesPerTrigger", 1) if stream else spark.read
        return reader.schema(spark.read.parquet(str(folder)).schema).parquet(str(folder))

    def both(stream):
        return source("ev2", events, event, stream), source("reg2", registry, entry, stream)

    streamed = collect(jobs.stream_resolve_region(*both(True), "6 seconds"), "region_order_out")
    names = ("asset_id", "region_id", "seq", "note")
    got = rows(streamed.filter("asset_id <> 'q'"), *names)
    assert got == rows(regional.resolve_region(*both(False)), *names) and len(got) == 5


def test_anomalies(spark, run):
    as_stream, collect, _ = run
    source = tv.telemetry(spark, SF)
    streamed = collect(jobs.stream_anomalies(as_stream(source, "hot")), "hot_out")
    batch = thermal.thermal_runaway(thermal.event_view(source))
    names = ("asset_id", "seq", "summary", F.col("detected_at").cast("long"))
    assert rows(streamed, *names) == rows(batch, *names) != []


def test_windowed_records(spark, run):
    as_stream, collect, _ = run
    source = tv.telemetry(spark, SF)
    streamed = collect(jobs.stream_windowed_telemetry(as_stream(source, "win"), "7 days", "14 days"), "win_out")
    batch = trends.windowed_telemetry(source, "7 days", "14 days")
    fuel = F.try_element_at("fluid_trends", F.lit("fuel_remaining"))
    plain = (
        "asset_id", "seq", "platform_variant", F.col("computed_at").cast("long"), F.col("provenance.sample_time").cast("long"),
        F.round(F.coalesce(fuel["slope"]["value"], F.lit(-1.0)), 6), F.size("consumable_trends"), F.size("wear_trends"),
        F.concat_ws(",", "active_fault_codes_latest"), F.col("window.duration_us"), F.col("window.sample_count"), F.concat_ws(",", "mixed_units"),
    )
    assert rows(streamed, *plain) == rows(batch, *plain) != []
    for entries, columns in (
        ("consumable_trends", ("e.slot_key", F.round("e.remaining.slope.value", 6), "e.remaining.slope.unit", F.coalesce("e.capacity", F.lit(-1.0)), F.coalesce("e.nsn", F.lit("")))),
        ("wear_trends", ("e.component_key", F.round(F.coalesce("e.hours_in_service.slope.value", F.lit(-1.0)), 6), F.round(F.coalesce("e.remaining_useful_life.latest.value", F.lit(-1.0)), 6))),
    ):
        one, two = (d.select("asset_id", "seq", F.explode(entries).alias("e")) for d in (streamed, batch))
        assert rows(one, "asset_id", "seq", *columns) == rows(two, "asset_id", "seq", *columns) != []


def test_latest_state_and_alerts(spark, run):
    as_stream, _, tmp = run
    source = tv.events(spark, SF)
    table = KeyedTable(str(tmp / "latest"), ("asset_id",), ("ts", "seq"), buckets=4)
    jobs.stream_latest_state(as_stream(source, "ev"), table, str(tmp / "c1"), NOW).awaitTermination()
    assert rows(table.current(spark), "asset_id", "seq") == rows(regional.latest_state(source), "asset_id", "seq")

    source = tv.alert_events(spark, SF)
    projected = KeyedTable(str(tmp / "alerts"), ("id",), buckets=4)
    jobs.stream_alert_projection(
        as_stream(source, "al"), projected, str(tmp / "c2"), NOW, order=("ts", "seq")
    ).awaitTermination()
    expected = alerts.project_alerts(source, order=("ts", "seq"))
    assert rows(projected.current(spark), "id", "device_id", "severity") == rows(expected, "id", "device_id", "severity")


def test_rollups(spark, run):
    as_stream, _, tmp = run
    source = tv.envelopes(spark, SF).withColumnRenamed("wrapped_at", "ts").withColumn("wrapped_at", F.col("ts"))
    root = str(tmp / "rollups")
    jobs.stream_rollups(as_stream(source, "env"), root, str(tmp / "c3"), NOW).awaitTermination()
    assets = regional.latest_by_asset(source)
    for name, expected, columns in (
        ("fleet_summary", regional.fleet_summary(assets), ("region_id", "nominal", "degraded", "critical", "asset_count")),
        ("top_factors", regional.top_factors(assets), ("region_id", "factor_id", "count", "rank")),
        ("wear_trends", regional.wear_trends(regional.wear_latest(source)),
         ("region_id", "component_id", "unit", "mean_rul_remaining", "asset_count")),
    ):
        written = BatchTable(f"{root}/{name}").read(spark)
        newest = written.filter(F.col("batch_id") == written.agg(F.max("batch_id")).first()[0])
        assert rows(newest, *columns) == rows(expected, *columns) != []


def test_heartbeat_without_new_data(spark, run):
    """The clock publishes rollups while the source is idle, and nothing before there are assets."""
    import time

    as_stream, _, tmp = run
    root = str(tmp / "idle")
    beat = jobs.stream_heartbeat(spark, root, str(tmp / "beat"), {"processingTime": "1 second"})
    try:
        time.sleep(4)
        assert BatchTable(f"{root}/fleet_summary").read(spark) is None
        source = tv.envelopes(spark, SF).withColumn("ts", F.col("wrapped_at"))
        jobs.stream_contributions(as_stream(source, "idle_env"), root, str(tmp / "keep"), NOW).awaitTermination()

        def beats():
            written = BatchTable(f"{root}/fleet_summary").read(spark)
            return written, set() if written is None else {r[0] for r in written.select("batch_id").distinct().collect()}

        # From here on the source is idle; the first beat after it may have begun before.
        known, deadline = beats()[1], time.time() + 90
        while time.time() < deadline and len(beats()[1] - known) < 3:
            time.sleep(1)
        written, found = beats()
    finally:
        beat.stop()
    columns = ("region_id", "nominal", "degraded", "critical", "asset_count")
    expected = rows(regional.fleet_summary(regional.latest_by_asset(source)), *columns)
    idle = sorted(found - known)[1:3]
    assert len(idle) == 2
    for batch in idle:
        assert rows(written.filter(F.col("batch_id") == batch), *columns) == expected


def test_fan_in_of_edges(spark, run):
    """Three edges of different lateness, one of them idle, through guard and dispatch, as in batch."""
    as_stream, collect, _ = run
    derived = tv.sustainment(spark, SF)
    edges = {
        f"edge-{i}": regional.wrap_sustainment(derived.filter(F.col("seq") % 3 == i), f"edge-{i}", F.concat(F.lit("region-"), F.col("seq") % 2)).withColumn(
            "ts", F.col("wrapped_at")) for i in range(3)
    }
    edges["edge-2"] = edges["edge-2"].filter("wrapped_at < '2024-01-03'")
    with pytest.raises(ValueError):
        jobs.stream_fan_in({"edge-0": edges["edge-0"]}, {})

    def through(df):
        return regional.contributions(regional.guard_region(df, "region-1"))

    batch = through(regional.fan_in(*edges.values()))
    streams = {name: as_stream(df, name) for name, df in edges.items()}
    joined = jobs.stream_fan_in(streams, dict.fromkeys(edges, "40 days"))
    names = ("asset_id", "seq", "edge_id", "payload_type")
    assert rows(collect(through(joined), "edges_out"), *names) == rows(batch, *names) != []


def test_an_idle_edge_does_not_hold_the_others_back(spark, run):
    as_stream, collect, _ = run
    source = tv.sustainment(spark, SF).select("ts", "seq", F.col("ts").alias("wrapped_at"), F.col("asset.asset_id").alias("asset_id"))
    edges = {"a": source, "b": source.orderBy("ts").limit(3)}

    def windows(name):
        streams = {edge: as_stream(df, f"{name}-{edge}") for edge, df in edges.items()}
        joined = jobs.stream_fan_in(streams, {"a": "1 hour", "b": "1 hour"})
        return collect(joined.groupBy(F.window("wrapped_at", "1 day")).count(), name).count()

    held_back = windows("policy_min")
    (setting, value), = jobs.WATERMARK_POLICY.items()
    spark.conf.set(setting, value)
    try:
        assert windows("policy_max") > 10 > held_back
    finally:
        spark.conf.unset(setting)


def test_fan_out_reads_once_and_repeats_nothing(spark, run):
    """Latest state, anomalies and an append table from one read; a failure between sinks leaves no duplicate."""
    as_stream, _, tmp = run
    source = tv.telemetry(spark, SF)
    stream, checkpoint = as_stream(source, "fan"), str(tmp / "fan-checkpoint")
    latest = KeyedTable(str(tmp / "fan-latest"), ("event_id",), ("ts", "seq"), buckets=4)
    log = BatchTable(str(tmp / "fan-log"))
    calls = {"log": 0, "state": 0, "broken": 0}
    reads = spark.sparkContext.accumulator(0)

    def counted(rows_):
        for batch in rows_:
            reads.add(batch.num_rows)
            yield batch

    def append(rows_, batch_id):
        calls["log"] += 1
        log.write(rows_.select("event_id"), batch_id)

    def break_once(rows_, batch_id):
        if batch_id == 1 and not calls["broken"]:
            calls["broken"] = 1
            raise RuntimeError("between sinks")

    def state(rows_, batch_id):
        calls["state"] += 1
        latest.merge(rows_.select("event_id", "ts", "seq"))

    narrow = stream.select("event_id", "ts", "seq")
    read = narrow.mapInArrow(counted, narrow.schema)
    sinks = {"log": append, "check": break_once, "state": state}
    with pytest.raises(Exception, match="between sinks"):
        jobs.stream_fan_out(read, sinks, checkpoint, NOW).awaitTermination()
    jobs.stream_fan_out(read, sinks, checkpoint, NOW).awaitTermination()
    n = source.count()
    assert log.read(spark).count() == latest.current(spark).count() == n
    assert calls == {"log": 3, "state": 3, "broken": 1}
    # Each batch is read once; the one that failed a second time when it is run again.
    assert n < reads.value < 1.5 * n


def test_drops_are_counted_in_streams(spark, run):
    from convoy.sources import quality
    from convoy.streaming.tracking import DropCounts

    _, collect, tmp = run
    lines = [
        ['{"asset_id":"a","edge_id":"e","region_id":"r"}', "broken", '{"asset_id":"","region_id":"r"}'],
        ['{"asset_id":"b","region_id":""}', '{"asset_id":"c","region_id":"r"}', "[1"],
    ]
    folder = tmp / "lines"
    folder.mkdir()
    for number, texts in enumerate(lines):
        (folder / f"{number}.txt").write_text("\n".join(texts))
    listener = DropCounts()
    spark.streams.addListener(listener)
    try:
        checked = quality.check_registry(spark.readStream.option("maxFilesPerTrigger", 1).text(str(folder)))
        out = collect(quality.used(quality.accounted(checked, "registry", quality.REGISTRY_REASONS)), "drops_out")
        import time
        deadline = time.time() + 30
        while time.time() < deadline and listener.counts.get("registry", {}).get("rows_in", 0) < 6:
            time.sleep(0.5)
    finally:
        spark.streams.removeListener(listener)
    counts = dict(listener.counts["registry"])
    assert counts == {"rows_in": 6, "malformed": 2, "blank_asset": 1, "blank_region": 1}
    assert counts["rows_in"] - sum(v for k, v in counts.items() if k != "rows_in") == out.count() == 2
