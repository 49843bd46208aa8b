"""The operators as streaming queries.

Functions return streaming DataFrames where Spark keeps the state, and started queries where
a table is kept through ``foreachBatch``.

``delay`` says how late an event may come: the watermark trails the newest event time by it. What
arrives later than that is dropped, and timers fire that much later. There is no default, since
any default would drop rows of some source. Jobs without ``delay`` take rows of a key in the order
of event time within a batch and keep every row.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from convoy.functions.common import blank, filled, micros
from convoy.operators import alerts, regional, routing, thermal, trends, usage
from convoy.sources.tables import BatchTable, KeyedTable, Notes
from convoy.streaming.processors import SAMPLE_RATE, Feature, LifetimeUsage, Rated, RegionHold, TickTrends, TickWindows, TumblingMean, moving_average

HEARTBEAT = "30 seconds"


def _timed(df: DataFrame, delay: str) -> DataFrame:
    rows = df.withColumns({"ts": F.col("ts").cast("timestamp"), "device": F.col("device").cast("string")})
    return rows.withColumn("us", micros(F.col("ts"))).withWatermark("ts", delay)


# ---------------------------------------------------------------- state kept by Spark

def stream_tumbling_mean(readings: DataFrame, window: str, delay: str) -> DataFrame:
    """Final mean per device and window, emitted once the watermark has passed the window."""
    return routing.tumbling_mean(_timed(readings, delay), window)


def stream_tumbling_alerts(readings: DataFrame, delay: str, per_type: bool = True) -> DataFrame:
    rows = _timed(readings, delay).withColumn("group_type", F.col("type") if per_type else F.lit(""))
    return rows.groupBy("device").transformWithState(TumblingMean(), TumblingMean.OUTPUT, "Append", "EventTime")


def stream_offline(connections: DataFrame, delay: str,
                   timeout_seconds: int = routing.OFFLINE_TIMEOUT_SECONDS) -> DataFrame:
    """Each lost connection that no restore follows within the timeout: losses joined with restores, those without kept.

    Spark's join holds the open losses and recent restores and lets them go by the watermark; nothing leaves the JVM.
    """
    rows = connections.filter(filled(F.col("device"))).select(
        F.col("device").cast("string").alias("device"), F.col("ts").cast("timestamp").alias("ts"), "seq", "state")

    def of(state: str) -> DataFrame:
        # The time is part of the condition, so that it stays above the watermark and both sides see the time of all rows.
        return rows.withWatermark("ts", delay).filter(F.when(F.col("state") == state, F.col("ts")).isNotNull())

    lost = of("lost").select("device", "seq", F.col("ts").alias("lost_at"))
    restored = of("restored").select(F.col("device").alias("_device"), F.col("ts").alias("restored_at"))
    answered = (F.col("device") == F.col("_device")) & F.expr(
        f"restored_at > lost_at and restored_at <= lost_at + interval {int(timeout_seconds)} seconds")
    open_ = lost.join(restored, answered, "leftOuter").filter(F.col("restored_at").isNull())
    return open_.select(
        "device", "seq", micros(F.col("lost_at")).alias("lost_us"), (micros(F.col("lost_at")) + timeout_seconds * 1_000_000).alias("detected_us"))


def stream_wear(telemetry: DataFrame, fired: Column | None = None, before: DataFrame | None = None) -> DataFrame:
    """Usage so far per event; feed it to ``derive_sustainment`` for wear.

    ``before`` is ``usage_state`` of the rows that came before the stream; it counts at the first start of the query.
    """
    flag = F.lit(False) if fired is None else fired
    rows = usage.kinematics(telemetry, flag.alias("fired")).withColumn("us", micros(F.col("ts")))
    initial = None if before is None else before.groupBy("asset_id")
    return rows.groupBy("asset_id").transformWithState(LifetimeUsage(), LifetimeUsage.OUTPUT, "Append", "None", initial)


def stream_resolve_region(events: DataFrame, registry: DataFrame, delay: str, attempts: int = regional.LOOKUP_ATTEMPTS,
                          delay_us: int = regional.LOOKUP_DELAY_US) -> DataFrame:
    """Events with their region, open ones filled from the registry as of their arrival and held for the
    last lookup; those whose asset stays unknown are dropped. Columns are those of ``events``."""
    stated = events.filter(filled(F.col("region_id")))
    if attempts < 1:
        return stated
    at = {"ts": F.col("ts").cast("timestamp"), "us": micros(F.col("ts"))}
    open_ = events.filter(blank(F.col("region_id")) & filled(F.col("asset_id"))).withColumn("event", F.to_json(F.struct("*")))
    known = registry.filter(filled(F.col("asset_id")) & filled(F.col("region_id"))).withColumn("event", F.lit(None).cast("string"))
    rows = reduce(DataFrame.unionByName, [
        df.withColumns(at).select("asset_id", "ts", "us", "seq", "region_id", "event").withWatermark("ts", delay) for df in (open_, known)
    ])
    found = rows.groupBy("asset_id").transformWithState(RegionHold(attempts, delay_us), RegionHold.OUTPUT, "Append", "EventTime")
    parsed = found.select("region_id", F.from_json("event", events.schema).alias("e"))
    return stated.unionByName(parsed.select("e.*", F.col("region_id").alias("_found")).withColumn("region_id", F.col("_found")).drop("_found"))


def stream_detectors() -> tuple[tuple[Feature, thermal.Rule], ...]:
    """The detectors that streams know: the feature a state is kept for, and the rule over it."""
    return (SAMPLE_RATE, thermal.runaway_rule()), (moving_average(thermal.EWMA_ALPHA), thermal.drift_rule())


def stream_detect(telemetry: DataFrame, detectors: tuple[tuple[Feature, thermal.Rule], ...] | None = None) -> DataFrame:
    """Anomalies of all detectors as ``thermal.detect`` finds them, in one pass that keeps a state for each."""
    detectors = detectors or stream_detectors()
    rows = thermal.thermal_samples(thermal.event_view(telemetry)).select(
        "asset_id", "seq", micros(F.col("ts")).alias("us"), micros(F.col("sample_time")).alias("sample_us"),
        "component_temp_k", "ambient_temp_k",
    )
    rating = Rated(tuple(feature for feature, _ in detectors))
    rated = rows.groupBy("asset_id").transformWithState(rating, rating.output, "Append", "None").withColumns(
        {"ts": F.timestamp_micros("us"), "sample_time": F.timestamp_micros("sample_us")})
    records = F.array(*[rule.record() for _, rule in detectors])
    found = rated.withColumn("_found", F.explode(F.filter(records, lambda r: r.isNotNull())))
    return found.select(
        "_found.rule_id", "_found.severity", "asset_id", "_found.summary", F.coalesce("sample_time", "ts").alias("detected_at"), "ts", "seq",
        "_found.evidence")


def stream_anomalies(telemetry: DataFrame) -> DataFrame:
    """Thermal runaways; feed them to ``anomaly_events``."""
    return stream_detect(telemetry, ((SAMPLE_RATE, thermal.runaway_rule()),))


def _ttl(idle: str | None) -> int | None:
    return None if idle is None else trends.interval_us(idle) // 1000


def _mode(idle: str | None) -> str:
    """Expiry goes by processing time, which Spark must be told."""
    return "None" if idle is None else "ProcessingTime"


def _sampled(telemetry: DataFrame, fluid_window, wear_window, *keep: Column) -> DataFrame:
    """Events of an asset with the signals, readings, units and window lengths of their samples."""
    wear_us, fluid_us = trends.interval_us(wear_window), trends.interval_us(fluid_window)
    def width(sample: Column) -> Column:
        return F.when(sample["signal"].startswith("wear_"), wear_us).otherwise(fluid_us).cast("long")

    return trends.event_samples(telemetry, *keep).select(
        "asset_id", micros(F.col("ts")).alias("us"), "seq", *[k for k in ("tick",) if keep],
        F.col("found.signal").alias("signals"), F.col("found.value").alias("readings"), F.col("found.unit").alias("units"),
        F.transform("found", width).alias("widths"),
    )


def stream_trends(telemetry: DataFrame, fluid_window=trends.FLUID_WINDOW, wear_window=trends.WEAR_WINDOW,
                  every: int = trends.EMIT_EVERY, cap: int | None = None, idle: str | None = None) -> DataFrame:
    """Trends of every signal at each tick of an asset; ``idle`` is how long a silent asset's state stays."""
    rows = _sampled(telemetry, fluid_window, wear_window)
    return rows.groupBy("asset_id").transformWithState(TickTrends(every, cap, _ttl(idle)), TickTrends.OUTPUT, "Append", _mode(idle))


def stream_windowed_telemetry(telemetry: DataFrame, fluid_window=trends.FLUID_WINDOW, wear_window=trends.WEAR_WINDOW,
                              every: int = trends.EMIT_EVERY, cap: int | None = None, edge_id: str = "edge-01",
                              region_id: str = "region-01", producer_id: str = "edge-windows", idle: str | None = None) -> DataFrame:
    """The windowed record of every tick, as the batch operator builds it; ``idle`` is how long a silent asset's state stays."""
    tick = F.struct(*trends.tick_fields())
    rows = _sampled(telemetry, fluid_window, wear_window, F.to_json(tick).alias("tick"))
    ticks = rows.groupBy("asset_id").transformWithState(TickWindows(every, cap, _ttl(idle)), TickWindows.OUTPUT, "Append", _mode(idle))
    fields = telemetry.select(tick.alias("t")).schema["t"].dataType
    opened = ticks.withColumns({"ts": F.timestamp_micros("us"), "_tick": F.from_json("tick", fields)})
    return trends.window_records(
        trends.gathered_trends(opened.select("asset_id", "ts", "seq", "trends", "_tick.*")), edge_id, region_id, producer_id)


# ---------------------------------------------------------------- tables kept by batches

def _start(df: DataFrame, write, checkpoint: str, trigger: dict | None) -> StreamingQuery:
    return (
        df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": HEARTBEAT})).start()
    )


def append_stream(df: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Alerts, windows, derived events and anomalies go to append-only tables."""
    return (
        df.writeStream.format("parquet").outputMode("append").option("path", path)
        .option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": HEARTBEAT})).start()
    )


def stream_latest_state(events: DataFrame, table: KeyedTable, checkpoint: str, trigger: dict | None = None):
    return _start(events, table.upsert(), checkpoint, trigger)


def stream_alert_projection(events: DataFrame, table: KeyedTable, checkpoint: str, trigger: dict | None = None,
                            **options):
    """Alert table in which an id is written once, whatever is sent again later; ``table`` is keyed by id, without an order."""
    def write(rows: DataFrame, batch_id: int) -> None:
        table.merge(alerts.project_alerts(rows, **options))

    return _start(events, write, checkpoint, trigger)


def unique_alerts(alert_rows: DataFrame, horizon: str) -> DataFrame:
    """Alerts once per id when repeats come within ``horizon``; keeps that much state and no table."""
    return alert_rows.withWatermark("detected_at", horizon).dropDuplicatesWithinWatermark(["id"])


ROLLUPS = ("fleet_summary", "top_factors", "wear_trends")


def _contribution_tables(root: str) -> tuple[KeyedTable, KeyedTable]:
    order = ("wrapped_at", "seq")
    return (
        KeyedTable(f"{root}/contributions", ("region_id", "asset_id", "payload_type", "names_edge"), order),
        KeyedTable(f"{root}/wear", ("region_id", "asset_id", "component_id"), order),
    )


def keep_contributions(batch: DataFrame, root: str) -> None:
    """Merges what the envelopes of a batch say into the stored state; only the buckets of their assets are written."""
    state, wear = _contribution_tables(root)
    batch = batch.persist()
    try:
        state.merge(regional.contributions(batch).withColumn("names_edge", F.coalesce(F.col("edge_id") != "", F.lit(False))))
        wear.merge(regional.wear_contributions(batch))
    finally:
        batch.unpersist()


def publish_rollups(spark: SparkSession, root: str, batch_id: int, n: int = regional.TOP_FACTORS) -> None:
    """The three rollups of every region from the stored state; nothing while there are no assets."""
    state, wear = (table.current(spark) for table in _contribution_tables(root))
    if state is None or wear is None:
        return
    assets = regional.latest_contributions(state).persist()
    try:
        if assets.isEmpty():
            return
        for name, rollup in zip(ROLLUPS, (regional.fleet_summary(assets), regional.top_factors(assets, n), regional.wear_trends(wear))):
            BatchTable(f"{root}/{name}").write(regional.stamp_provenance(rollup, F.current_timestamp()), batch_id)
    finally:
        assets.unpersist()


def stream_rollups(envelopes: DataFrame, root: str, checkpoint: str, trigger: dict | None = None,
                   n: int = regional.TOP_FACTORS) -> StreamingQuery:
    """On each batch of envelopes: merge new contributions, then write the three rollups of every region."""
    def write(batch: DataFrame, batch_id: int) -> None:
        keep_contributions(batch, root)
        publish_rollups(batch.sparkSession, root, batch_id, n)

    return _start(envelopes, write, checkpoint, trigger)


def stream_contributions(envelopes: DataFrame, root: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Keeps the stored state up to date and publishes nothing; ``stream_heartbeat`` does that."""
    return _start(envelopes, lambda batch, batch_id: keep_contributions(batch, root), checkpoint, trigger)


def stream_heartbeat(spark: SparkSession, root: str, checkpoint: str, trigger: dict | None = None,
                     n: int = regional.TOP_FACTORS) -> StreamingQuery:
    """Rollups of the stored state at every heartbeat, also while no envelope comes.

    A ``rate`` source is the clock: it has rows whenever time has passed, so its batches do not wait for data. The
    state is read through its manifest, so a heartbeat sees whole batches of the query that keeps it.
    """
    clock = spark.readStream.format("rate").option("rowsPerSecond", 1).option("numPartitions", 1).load()
    return _start(clock, lambda _, batch_id: publish_rollups(spark, root, batch_id, n), checkpoint, trigger)


# ---------------------------------------------------------------- many sources, many sinks

#: The session setting under which an idle or late edge does not hold the others back.
WATERMARK_POLICY = {"spark.sql.streaming.multipleWatermarkPolicy": "max"}


def stream_fan_in(edges: dict[str, DataFrame], delays: dict[str, str], time: str = "wrapped_at") -> DataFrame:
    """Envelopes of all edges as one stream, each edge with a watermark of its own ``delay``.

    Start the query in a session with ``WATERMARK_POLICY``: the stream's watermark is then that of the edge that is
    furthest ahead, so an idle edge holds back no other. With Spark's default the slowest edge decides.
    """
    late = set(edges) - set(delays)
    if late:
        raise ValueError(f"no delay for {sorted(late)}")
    return regional.fan_in(*[df.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, delays[edge]) for edge, df in edges.items()])


Sink = Callable[[DataFrame, int], None]


def stream_fan_out(source: DataFrame, sinks: dict[str, Sink], checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """One read of a source for several sinks.

    A batch is persisted and handed to the sinks in turn. A sink that has finished a batch is noted beside the
    checkpoint, so that after a failure between sinks the batch goes only to those that still lack it; a sink that failed half way
    gets it again and must overwrite what it wrote for that batch, as ``BatchTable.write`` and ``KeyedTable.merge`` do.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        done = Notes(batch.sparkSession, f"{checkpoint}/finished")
        batch = batch.persist()
        try:
            for name, sink in sinks.items():
                if done.last(name) < batch_id:
                    sink(batch, batch_id)
                    done.put(name, batch_id)
        finally:
            batch.unpersist()

    return _start(source, write, checkpoint, trigger)
