"""Sensor events: routing by configuration, reading extraction, tumbling means, offline devices."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from convoy.functions.common import filled, iso_time, micros, stable_id
from convoy.operators.ordered import last_value, ordered_groups, running_count, running_sum

# The shipped sensor configuration (type, engine, window seconds, threshold).
SENSORS = (
    ("temperature", "window", 10, 85.0),
    ("Connection_Lost", "timer", 45, 0.0),
)
OFFLINE_TIMEOUT_SECONDS = 45
TACTICAL = "tactical."


def route_by_config(events: DataFrame, sensors: Iterable[tuple] = SENSORS, engine: str = "window") -> DataFrame:
    """Events whose type is configured for ``engine``, with window and threshold.

    The configuration is a short list written by hand, so it goes into the plan as literals:
    no join, and the list of types reaches the scan as a filter. The first entry of a type counts.
    """
    first: dict[str, tuple] = {}
    for row in sensors:
        first.setdefault(row[0], tuple(row))
    chosen = {kind: row for kind, row in first.items() if row[1] == engine}
    if not chosen:
        return events.withColumns({
            "window_seconds": F.lit(0), "critical_threshold": F.lit(0.0)
        }).filter(F.lit(False))

    def setting(position: int, kind: str) -> Column:
        pairs = [F.lit(x) for t, row in chosen.items() for x in (t, row[position])]
        return F.element_at(F.create_map(*pairs), F.col("type")).cast(kind)

    return events.filter(filled(F.col("device")) & F.col("type").isin(*chosen)).withColumns({
        "window_seconds": setting(2, "int"), "critical_threshold": setting(3, "double"),
    })


# Fixed value: what counts as a number in a text.
_NUMBER = r"(?i)^\s*[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf|infinity|nan)\s*$"


def extract_reading(events: DataFrame, data: str = "data") -> DataFrame:
    """``temperature``, or ``value`` when it is missing, null, false, zero or empty.

    Numbers, booleans and texts that hold a number count; rows without one are dropped. The kind
    of the JSON value decides: the text "0" is a temperature of 0, the number 0 is none.
    """
    def bound(value: Column, use) -> Column:
        """``use`` of a value that is evaluated once, however often it is named."""
        return F.transform(F.array(value), use)[0]

    def kind(value: Column) -> Column:
        return F.coalesce(F.schema_of_variant(value), F.lit("VOID"))

    def number(value: Column, is_a: Column) -> Column:
        text = F.try_variant_get(value, "$", "string")
        return (
            F.when(is_a == "BOOLEAN", F.try_variant_get(value, "$", "boolean").cast("double"))
            .when(is_a == "STRING", F.when(text.rlike(_NUMBER), F.trim(text).try_cast("double")))
            .when(~is_a.rlike("^(VOID|ARRAY|OBJECT)"), F.try_variant_get(value, "$", "double"))
        )

    def empty(value: Column, is_a: Column) -> Column:
        return (
            F.when(is_a == "VOID", True)
            .when(is_a == "BOOLEAN", ~F.try_variant_get(value, "$", "boolean"))
            .when(is_a.rlike("^(STRING|ARRAY|OBJECT)"), F.try_variant_get(value, "$", "string").isin("", "[]", "{}"))
            .otherwise(F.try_variant_get(value, "$", "double") == 0)
        )

    def field(name: str):
        return lambda parsed: F.try_variant_get(parsed, f"$.{name}", "variant")

    def chosen(parsed: Column) -> Column:
        first = bound(field("temperature")(parsed), lambda t: bound(kind(t), lambda k: F.when(~F.coalesce(empty(t, k), F.lit(False)), F.struct(number(t, k)))))
        second = bound(field("value")(parsed), lambda v: bound(kind(v), lambda k: number(v, k)))
        return bound(first, lambda t: F.when(t.isNotNull(), t["col1"]).otherwise(second))

    # Exploding an array keeps Spark from evaluating the reading once more in a filter of its own.
    reading = F.filter(F.array(bound(F.try_parse_json(F.col(data)), chosen)), lambda r: r.isNotNull())
    return events.withColumn("reading", F.explode(reading))


def namespaced(sensors: Iterable[tuple] = SENSORS, namespace: str = "fleet") -> tuple[tuple, ...]:
    """The configuration with types as events carry them: namespace and sensor prefix before the name."""
    return tuple((f"{namespace}.sensor.{kind}", *rest) for kind, *rest in sensors)


def connection_states(events: DataFrame, namespace: str = "fleet") -> DataFrame:
    """Events of the two connection types with ``state`` lost or restored; others are left out.

    Types count with and without the namespace and sensor prefix.
    """
    states = {"Connection_Lost": "lost", "Connection_Restored": "restored"}
    types = {t: state for name, state in states.items() for t in (name, f"{namespace}.sensor.{name}")}
    pairs = [F.lit(x) for pair in types.items() for x in pair]
    return events.filter(F.col("type").isin(*types)).withColumn("state", F.element_at(F.create_map(*pairs), F.col("type")))


def window_start(ts: Column, seconds: Column) -> Column:
    return F.timestamp_micros(micros(ts) - F.pmod(micros(ts), seconds.cast("long") * 1_000_000))


def tumbling_running_mean(readings: DataFrame, per_type: bool = True, hot_rows: int | None = None, bound: int | None = None) -> DataFrame:
    """Mean of the readings of a window after each event."""
    keys = ["device", *(["type"] if per_type else []), "window_start"]
    groups = ordered_groups(
        readings.withColumn("window_start", window_start(F.col("ts"), F.col("window_seconds"))),
        keys, ["ts", "seq"], hot_rows, bound,
    ).with_running(_sum=running_sum("reading"), n=running_count())
    return groups.with_columns(mean=F.col("_sum") / F.col("n")).result().drop("_sum")


def tumbling_alerts(readings: DataFrame, per_type: bool = True, hot_rows: int | None = None, bound: int | None = None) -> DataFrame:
    """One alert per event that leaves the mean of its window above the threshold."""
    means = tumbling_running_mean(readings, per_type, hot_rows, bound)
    return means.filter(~F.isnan("mean") & (F.col("mean") > F.col("critical_threshold")))


def tumbling_mean(readings: DataFrame, window: str) -> DataFrame:
    """Final mean and count per device and window; works on streams with a watermark."""
    return (
        readings.groupBy("device", F.window("ts", window).alias("w"))
        .agg(F.avg("reading").alias("mean"), F.count("reading").alias("n"))
        .select("device", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "mean", "n")
    )


def threshold_events(alerts: DataFrame, namespace: str = "fleet") -> DataFrame:
    """Alerts as cloud events with a JSON payload."""
    kind = f"{namespace}.{TACTICAL}ThresholdExceeded"
    return alerts.select(
        stable_id(F.lit(kind), F.col("device"), micros(F.col("ts")), F.col("seq")).alias("id"),
        F.col("device").cast("string").alias("source"),
        F.lit(kind).alias("type"),
        iso_time(F.col("ts")).alias("time"),
        F.lit("application/json").alias("datacontenttype"),
        F.to_json(F.struct(
            F.col("device").cast("string").alias("device_id"), F.col("mean").alias("average_reading"),
            F.col("critical_threshold").alias("threshold"), F.lit("HIGH").alias("severity"),
        )).alias("data"),
    )


def offline_alerts(connections: DataFrame, timeout_seconds: int = OFFLINE_TIMEOUT_SECONDS,
                   hot_rows: int | None = None, bound: int | None = None) -> DataFrame:
    """Each lost connection that no restore follows within the timeout.

    The next restore is found by one pass backwards in time, not by a join per device, so a
    device with very many events costs no more per event than any other.
    """
    restored = F.col("state") == "restored"
    at = micros(F.col("ts"))
    groups = ordered_groups(
        connections.filter(filled(F.col("device")) & F.col("state").isin("lost", "restored")),
        "device", [F.desc("ts"), restored.asc(), F.desc("seq")], hot_rows, bound,
    ).with_running(_restored_us=last_value(F.when(restored, at)))
    deadline = at + timeout_seconds * 1_000_000
    return (
        groups.result()
        .filter(~restored & (F.col("_restored_us").isNull() | (F.col("_restored_us") > deadline)))
        .select(
            "device", "seq", F.col("ts").alias("lost_at"), F.timestamp_micros(deadline).alias("detected_at"),
            F.lit("OFFLINE").alias("status"), F.lit(timeout_seconds).alias("timeout_seconds"),
            F.lit("CRITICAL").alias("severity"),
        )
    )


def offline_events(alerts: DataFrame, namespace: str = "fleet") -> DataFrame:
    kind = f"{namespace}.{TACTICAL}DeviceOfflineAlert"
    return alerts.select(
        stable_id(F.lit(kind), F.col("device"), micros(F.col("lost_at")), F.col("seq")).alias("id"),
        F.col("device").cast("string").alias("source"),
        F.lit(kind).alias("type"),
        iso_time(F.col("detected_at")).alias("time"),
        F.lit("application/json").alias("datacontenttype"),
        F.to_json(F.struct(
            F.col("device").cast("string").alias("device_id"), "status", "timeout_seconds", "severity",
        )).alias("data"),
    )
