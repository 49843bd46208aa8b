"""Every operator as a query over the test tables: ``(spark, sf_dir) -> DataFrame``.

Results are flat, doubles rounded to six digits and times given as microseconds, so that
they can be compared with the SQL in ``oracles``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from convoy.functions.common import micros
from convoy.functions.quantities import euler, known_unit, position, quantity_in, to_unit, vector3
from convoy.functions.wear_models import WearLife
from convoy.operators import alerts, regional, routing, thermal, trends, usage, wear
from convoy.plans import testviews as tv
from convoy.sources import quality, readers

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

LIFE = WearLife(track_km=6.0, engine_hours=700.0, barrel_rounds=20, terrain_deg_km=300.0)
TREND_WINDOW, FLUID_WINDOW, WEAR_WINDOW = "7 days", "7 days", "14 days"


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def r6(value) -> Column:
    return F.round(value, 6)


def us(name: str) -> Column:
    return micros(F.col(name))


def _long(name: str) -> Column:
    return F.col(name).cast("long").alias(name)


# ---------------------------------------------------------------- sources

@query
def cloud_event_source(spark, sf_dir):
    """Cloud events as JSON text, a tenth of them broken and some with broken data."""
    e = tv.events(spark, sf_dir)
    text = F.to_json(F.struct(
        F.col("seq").cast("string").alias("id"), F.col("asset_id").alias("source"), F.col("kind").alias("type"),
        F.when(F.col("k") % 10 == 1, "not json").otherwise(F.to_json(F.struct("value"))).alias("data"),
    ))
    lines = e.select("seq", F.when(F.col("k") % 10 == 0, F.substring(text, 1, 20)).otherwise(text).alias("value"))
    parsed = readers.parse_cloud_events(lines, "value", "seq")
    return parsed.select("seq", "id", "source", "type", r6(F.get_json_object("data", "$.value").cast("double")).alias("reading"))


@query
def registry_source(spark, sf_dir):
    """Registry changelog as JSON; blank assets and blank regions do not count."""
    rows = tv.registry(spark, sf_dir)
    text = F.to_json(F.struct(
        F.when(F.col("seq") % 11 == 0, "").otherwise(F.col("asset_id")).alias("asset_id"),
        F.when(F.col("seq") % 5 == 0, F.lit(None)).otherwise(F.col("edge_id")).alias("edge_id"),
        F.when(F.col("seq") % 7 == 0, "").otherwise(F.col("region_id")).alias("region_id"),
    ))
    return readers.parse_registry(rows.select("seq", text.alias("value")), "value", "seq")


@query
def cm_state_source(spark, sf_dir):
    """Configuration state as JSON; a missing or non-numeric code becomes 0."""
    rows = tv.cm_state(spark, sf_dir)
    text = F.to_json(F.struct(
        "asset_id", "region_id", "edge_id",
        F.when(F.col("seq") % 5 == 0, "unknown").otherwise(F.col("overall_status").cast("string")).alias("overall_status"),
        F.when(F.col("seq") % 7 != 0, F.col("lifecycle")).alias("lifecycle"),
    ))
    parsed = readers.parse_cm_state(rows.select("seq", text.alias("value")), "value", "seq")
    return parsed.select("seq", "asset_id", "region_id", "edge_id", _long("overall_status"), _long("lifecycle"))


@query
def logistics_source(spark, sf_dir):
    rows = tv.logistics(spark, sf_dir)
    text = F.to_json(F.struct("status", "provenance"))
    parsed = readers.parse_logistics(rows.select("seq", text.alias("value")), "value", "seq")
    factor = F.get("status.constraining_factors", F.lit(0))
    return parsed.select(
        "seq", F.col("status.asset_id").alias("asset_id"),
        F.col("status.overall_severity").cast("long").alias("overall_severity"),
        factor["factor_id"].alias("factor_id"), factor["severity"].cast("long").alias("factor_severity"),
        F.col("provenance.edge_id").alias("edge_id"),
    )


@query
def edge_sources(spark, sf_dir):
    """Derived sustainment of several edges, one source each, stacked with the edge's name."""
    read = readers.read_edges(spark, {f"edge-{i}": f"{sf_dir}/events.parquet" for i in range(3)}, tv.EVENTS)
    number = F.substring_index("source_edge_id", "-", -1).cast("long")
    rows = read.filter((F.col("event_type") == "purchase") & (F.col("event_id") % 3 == number)).select(
        F.col("event_id").alias("seq"), F.col("ts").cast("timestamp").alias("ts"), F.struct(F.col("user_id").cast("string").alias("asset_id")).alias("asset"),
        F.struct(F.struct(F.lit(None).cast("map<string,string>").alias("components")).alias("wear")).alias("sustainment"), "source_edge_id")
    wrapped = regional.wrap_sustainment(rows, F.col("source_edge_id"), F.concat(F.lit("region-"), F.substring_index("source_edge_id", "-", -1).cast("int") % 2))
    return wrapped.select("seq", "source_edge_id", "region_id", "asset_id")


def _registry_texts(spark, sf_dir):
    """Registry changelog as text, some of it broken, some without asset or region."""
    rows = tv.registry(spark, sf_dir)
    text = F.to_json(F.struct(
        F.when(F.col("seq") % 11 == 0, "").otherwise(F.col("asset_id")).alias("asset_id"), "edge_id",
        F.when(F.col("seq") % 7 == 0, "").otherwise(F.col("region_id")).alias("region_id"),
    ))
    return rows.select("seq", F.when(F.col("seq") % 13 == 0, F.substring(text, 1, 15)).otherwise(text).alias("value"))


@query
def source_drops(spark, sf_dir):
    """Rows of two sources that are left out, by reason, with the numbers of rows that came and that are used."""
    e = tv.events(spark, sf_dir)
    event = F.to_json(F.struct(
        F.col("seq").cast("string").alias("id"), F.when(F.col("k") % 17 != 0, F.col("asset_id")).alias("source"), F.col("kind").alias("type"),
        F.when(F.col("k") % 10 == 1, "not json").otherwise(F.to_json(F.struct("value"))).alias("data"),
    ))
    events = quality.check_cloud_events(e.select("seq", F.when(F.col("k") % 10 == 0, F.substring(event, 1, 20)).otherwise(event).alias("value")))
    checked = {"registry": quality.check_registry(_registry_texts(spark, sf_dir)), "cloud_events": events}
    return regional.fan_in(*[
        rows.groupBy(F.lit(name).alias("source"), F.coalesce(quality.REASON, F.lit("used")).alias("reason")).agg(F.count("*").alias("n"))
        for name, rows in checked.items()
    ])


@query
def quarantine(spark, sf_dir):
    """The registry rows that are left out, as they came."""
    left_out = quality.quarantined(quality.check_registry(_registry_texts(spark, sf_dir)), "registry")
    return left_out.select("source", "reason", F.length("raw").cast("long").alias("characters"))


@query
def unresolved_events(spark, sf_dir):
    """Configuration events that no registry row answers, by reason."""
    events = tv.cm_state(spark, sf_dir)
    rows = quality.check_resolution(events, _resolved(spark, sf_dir))
    return rows.groupBy(F.coalesce(quality.REASON, F.lit("used")).alias("reason")).agg(F.count("*").alias("n"))


@query
def latest_state(spark, sf_dir):
    e = regional.latest_state(tv.events(spark, sf_dir))
    return e.select("asset_id", "seq", us("ts").alias("us"), "kind", r6("value").alias("value"))


# ---------------------------------------------------------------- projections

@query
def telemetry_source(spark, sf_dir):
    """Telemetry as JSON text, parsed by the reader; every tenth line is broken and left out."""
    source = tv.telemetry(spark, sf_dir)
    fields = [c for c in source.columns if c not in ("ts", "seq")]
    text = F.to_json(F.struct(*fields), {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"})
    lines = source.select(F.when(F.col("seq") % 10 == 0, F.substring(text, 1, 40)).otherwise(text).alias("value"))
    parsed = readers.parse_telemetry(lines)
    return _event_columns(thermal.event_view(parsed.withColumn("seq", F.col("event_id").cast("long"))))


@query
def event_view(spark, sf_dir):
    return _event_columns(thermal.event_view(tv.telemetry(spark, sf_dir)))


def _event_columns(view):
    return view.select(
        "asset_id", "seq", us("sample_time").alias("us"),
        *[r6(F.col(c)["value"]).alias(c) for c in ("component_temp", "ambient_temp", "ground_speed",
                                                   "fuel_remaining", "bus_voltage")],
    )


@query
def unit_normalize(spark, sf_dir):
    e = tv.events(spark, sf_dir)
    unit = F.element_at(F.array(*[F.lit(u) for u in ("K", "degC", "[degF]", "", "furlong")]), F.col("k") % 5 + 1)
    value = F.when(F.col("k") % 10 >= 8, 0.0).otherwise(F.col("value"))
    e = e.select("seq", value.alias("value"), unit.alias("unit"))
    return e.select(
        "seq", r6(to_unit(F.col("value"), F.col("unit"), "kelvin")).alias("kelvin"),
        r6(to_unit(F.col("value"), F.col("unit"), "[degF]")).alias("deg_f"),
        known_unit(F.col("unit")).cast("long").alias("known"),
    )


@query
def speed_and_volume_units(spark, sf_dir):
    """Knots to metres per second and gallons to litres; a unit of another kind gives null."""
    e = tv.events(spark, sf_dir)
    speed = F.when(F.col("k") % 3 == 0, "[kn_i]").when(F.col("k") % 3 == 1, "km/h").otherwise("gal_us")
    volume = F.when(F.col("k") % 3 == 2, "gal_us").otherwise("L")
    return e.select(
        "seq", r6(to_unit(F.col("value"), speed, "m/s")).alias("metres_per_second"),
        r6(to_unit(F.col("value"), volume, "L")).alias("litres"),
    )


@query
def position_frames(spark, sf_dir):
    e = tv.events(spark, sf_dir)
    k = F.col("k")

    def frame(i: int, names) -> Column:
        parts = (F.col("value"), k, F.col("seq") % 100)
        unit = "m" if i != 1 else "deg"
        return F.when(k % 4 == i, F.struct(*[tv.q(p, unit).alias(n) for p, n in zip(parts, names)]))

    pos = F.struct(
        frame(0, "xyz").alias("ecef"), frame(1, ("lat", "lon", "alt")).alias("wgs84"),
        frame(2, ("east", "north", "up")).alias("local_enu"),
    )
    resolved = e.select("seq", pos.alias("pos")).select("seq", position(F.col("pos")).alias("p"))
    return resolved.select("seq", F.col("p.frame").alias("frame"),
                           *[r6(F.col(f"p.c{i}.value")).alias(f"c{i}") for i in (1, 2, 3)])


@query
def attitude_and_vectors(spark, sf_dir):
    e = tv.events(spark, sf_dir)
    angles = F.struct(
        tv.unset_q().alias("yaw"), tv.q(F.col("k") - 50, "deg").alias("pitch"),
        F.when(F.col("k") % 2 == 0, tv.q(F.col("value"), "deg")).alias("roll"),
    )
    vector = F.struct(
        F.col("value").alias("x"), F.col("k").cast("double").alias("y"), F.lit(0.0).alias("z"),
        F.when(F.col("k") % 3 == 0, "").otherwise("m/s").alias("unit"),
    )
    out = e.select("seq", angles.alias("a"), vector.alias("v"))
    out = out.select("seq", euler(F.col("a")).alias("a"), vector3(F.col("v")).alias("v"))
    return out.select(
        "seq", *[r6(F.col(f"a.{n}.value")).alias(n) for n in ("yaw", "pitch", "roll")],
        *[r6(F.col(f"v.{n}.value")).alias(f"v{n}") for n in "xyz"],
    )


@query
def kinematics(spark, sf_dir):
    kin = usage.kinematics(tv.telemetry(spark, sf_dir))
    return kin.select("asset_id", "seq", us("ts").alias("us"), *[
        r6(c).alias(c) for c in ("x_m", "y_m", "z_m", "pitch_deg", "roll_deg")
    ])


@query
def signals(spark, sf_dir):
    return trends.signals(tv.telemetry(spark, sf_dir)).select("asset_id", "seq", "signal", r6("value").alias("value"), "unit")


@query
def route_by_config(spark, sf_dir):
    routed = routing.route_by_config(tv.readings(spark, sf_dir), tv.SENSORS)
    return routed.select("device", "seq", "type", _long("window_seconds"), "critical_threshold")


@query
def extract_reading(spark, sf_dir):
    e = tv.events(spark, sf_dir)
    k = F.col("k")
    data = (
        F.when(k % 5 == 0, F.to_json(F.struct(F.col("value").alias("temperature"))))
        .when(k % 5 == 1, F.to_json(F.struct(F.lit(0).alias("temperature"), "value")))
        .when(k % 5 == 2, F.to_json(F.struct(F.lit("abc").alias("value"))))
        .when(k % 5 == 3, F.to_json(F.struct(F.lit("12.5").alias("temperature"), "value")))
        .otherwise("{}")
    )
    odd = [
        '{"temperature":"0","value":9}', '{"temperature":true}', '{"value":"12d"}', '{"temperature":[],"value":4}', '{"temperature":{"a":1},"value":4}',
    ]
    data = F.when(F.col("seq") % 7 == 0, F.element_at(F.array(*map(F.lit, odd)), (k % 5 + 1).cast("int"))).otherwise(data)
    return routing.extract_reading(e.select("seq", data.alias("data"))).select("seq", r6("reading").alias("reading"))


def _resolved(spark, sf_dir, attempts=regional.LOOKUP_ATTEMPTS, **options):
    most = tv.bound(spark, sf_dir) * (1 + attempts)
    return regional.resolve_region(tv.cm_state(spark, sf_dir), tv.registry(spark, sf_dir), attempts, bound=most, **options)


@query
def route_region(spark, sf_dir):
    resolved = _resolved(spark, sf_dir)
    return regional.route_region(resolved, "region-1").select("asset_id", "seq", "region_id")


@query
def guard_region(spark, sf_dir):
    """Envelopes with their own tag: empty, this region, another one."""
    derived = tv.sustainment(spark, sf_dir)
    tag = F.when(F.col("seq") % 3 == 0, "").otherwise(F.concat(F.lit("region-"), F.col("seq") % 3))
    env = regional.wrap_sustainment(derived, "edge-1", tag)
    return regional.guard_region(env, "region-1").select("asset_id", "seq", "region_id")


@query
def payload_dispatch(spark, sf_dir):
    """What each envelope contributes to its asset."""
    rows = regional.contributions(tv.envelopes(spark, sf_dir))
    return rows.select(
        "region_id", "asset_id", "payload_type", "seq",
        F.coalesce("severity", F.lit(0)).cast("long").alias("severity"),
        F.coalesce(F.size("factors"), F.lit(0)).cast("long").alias("n_factors"),
        _long("overall_status"), _long("lifecycle"), F.coalesce("edge_id", F.lit("")).alias("edge_id"),
    )


@query
def tactical_filter(spark, sf_dir):
    rows = alerts.tactical_alerts(tv.alert_events(spark, sf_dir))
    return rows.select("id", "seq", "type", "source", "severity", us("detected_at").alias("us"))


@query
def severity_from_payload(spark, sf_dir):
    rows = alerts.tactical_alerts(tv.alert_events(spark, sf_dir), severity_from_data=True)
    return rows.groupBy("type", "severity").agg(F.count("*").alias("n"))


@query
def critical_actions(spark, sf_dir):
    critical = alerts.critical_anomalies(tv.anomalies(spark, sf_dir))
    return alerts.radar_state(critical).select(
        "id", "device_id", "radar_status", _long("transmit_power"), us("timestamp").alias("us")
    )


@query
def work_orders(spark, sf_dir):
    critical = alerts.critical_anomalies(tv.anomalies(spark, sf_dir))
    return alerts.work_orders(critical).withColumn("us", us("created_at")).drop("created_at")


# ---------------------------------------------------------------- joins

@query
def registry_latest(spark, sf_dir):
    return regional.registry_latest(tv.registry(spark, sf_dir))


@query
def resolve_region(spark, sf_dir):
    resolved = _resolved(spark, sf_dir)
    return resolved.select("asset_id", "seq", us("ts").alias("us"), "region_id")


@query
def resolve_region_with_hold(spark, sf_dir):
    """A hold of six hours per attempt, so that late registrations matter in this data."""
    resolved = _resolved(spark, sf_dir, attempts=3, delay_us=6 * 3_600_000_000)
    return resolved.select("asset_id", "seq", "region_id")


@query
def offline_alerts(spark, sf_dir):
    found = routing.offline_alerts(tv.connections(spark, sf_dir), tv.OFFLINE_SECONDS, bound=tv.bound(spark, sf_dir))
    return found.select(
        "device", "seq", us("lost_at").alias("lost_us"), us("detected_at").alias("detected_us"),
        "status", _long("timeout_seconds"), "severity",
    )


@query
def pair_wear_trends(spark, sf_dir):
    found = trends.pair_wear_trends(_tick_trends(spark, sf_dir))
    return found.select(
        "asset_id", "seq", "component_key",
        r6("hours_in_service.slope.value").alias("hours_slope"),
        r6("remaining_useful_life.slope.value").alias("rul_slope"),
        r6("remaining_useful_life.latest.value").alias("rul_latest"),
    )


@query
def enrich_consumables(spark, sf_dir):
    telemetry = tv.telemetry(spark, sf_dir)
    events = telemetry.select(
        F.col("asset.asset_id").alias("asset_id"), "ts", "seq", F.col("sustainment.consumables.items").alias("items")
    )
    found = trends.enrich_consumables(_tick_trends(spark, sf_dir), events)
    return found.select("asset_id", "seq", "slot_key", r6("remaining.slope.value").alias("slope"),
                        "capacity", "nsn")


@query
def merge_assets(spark, sf_dir):
    merged = regional.merge_assets(tv.envelopes(spark, sf_dir))
    return merged.select(
        "region_id", "asset_id", _long("logistics_severity"), _long("cm_overall_status"), _long("cm_lifecycle"),
        F.size("sustainment_wear").cast("long").alias("n_components"),
        r6(F.try_element_at("sustainment_wear", F.lit("engine"))["rul"]).alias("engine_rul"),
        "last_source_edge_id",
    )


@query
def insert_ignore(spark, sf_dir):
    """Alerts whose id the table already holds are left alone."""
    events = tv.alert_events(spark, sf_dir)
    existing = events.filter(F.col("seq") % 6 == 0).select("id").distinct()
    return alerts.project_alerts(events, existing, order=("ts", "seq")).select("id", "device_id", "severity")


# ---------------------------------------------------------------- aggregations

def _readings(spark, sf_dir):
    return routing.extract_reading(routing.route_by_config(tv.readings(spark, sf_dir), tv.SENSORS))


@query
def tumbling_alerts(spark, sf_dir):
    found = routing.tumbling_alerts(_readings(spark, sf_dir), per_type=False, bound=tv.bound(spark, sf_dir))
    return found.select("device", "seq", us("window_start").alias("window_us"), "n", r6("mean").alias("mean"))


@query
def tumbling_alerts_per_type(spark, sf_dir):
    found = routing.tumbling_alerts(_readings(spark, sf_dir), bound=tv.bound(spark, sf_dir))
    return found.select("device", "type", "seq", "n", r6("mean").alias("mean"))


@query
def tumbling_mean(spark, sf_dir):
    found = routing.tumbling_mean(_readings(spark, sf_dir), "1 day")
    return found.select("device", us("window_start").alias("window_us"), r6("mean").alias("mean"), "n")


def _usage(spark, sf_dir):
    kin = usage.kinematics(tv.telemetry(spark, sf_dir), F.col("sustainment.wear.components").isNotNull().alias("fired"))
    return usage.running_usage(kin, F.col("fired"), bound=tv.bound(spark, sf_dir))


@query
def odometer(spark, sf_dir):
    return _usage(spark, sf_dir).select("asset_id", "seq", r6("distance_m").alias("distance_m"))


@query
def terrain_integral(spark, sf_dir):
    return _usage(spark, sf_dir).select("asset_id", "seq", r6("terrain_deg_km").alias("terrain_deg_km"))


@query
def observed_hours(spark, sf_dir):
    return _usage(spark, sf_dir).select("asset_id", "seq", r6("observed_hours").alias("observed_hours"))


@query
def rounds_fired(spark, sf_dir):
    e = tv.events(spark, sf_dir)
    return usage.rounds_fired(e, F.col("kind") == "purchase", bound=tv.bound(spark, sf_dir)).select("asset_id", "seq", "rounds_fired")


@query
def latest_by_asset(spark, sf_dir):
    latest = regional.latest_by_asset(tv.envelopes(spark, sf_dir))
    return latest.select(
        "region_id", "asset_id", _long("logistics_severity"), _long("cm_overall_status"), _long("cm_lifecycle"),
        F.size("logistics_factors").cast("long").alias("n_factors"), "last_source_edge_id",
        us("last_updated").alias("updated_us"),
    )


@query
def wear_latest(spark, sf_dir):
    return regional.wear_latest(tv.envelopes(spark, sf_dir)).withColumn("rul", r6("rul"))


@query
def severity_buckets(spark, sf_dir):
    found = regional.severity_buckets(regional.latest_by_asset(tv.envelopes(spark, sf_dir)))
    return found.select("region_id", "asset_id", _long("bucket_rank"), "bucket")


@query
def fleet_summary(spark, sf_dir):
    return regional.fleet_summary(regional.latest_by_asset(tv.envelopes(spark, sf_dir)))


@query
def top_factors(spark, sf_dir):
    found = regional.top_factors(regional.latest_by_asset(tv.envelopes(spark, sf_dir)))
    return found.select("region_id", "factor_id", "count", _long("rank"))


@query
def factor_breakdown(spark, sf_dir):
    found = regional.top_factors(regional.latest_by_asset(tv.envelopes(spark, sf_dir)), n=5)
    return found.select("region_id", "factor_id", F.explode("severity_breakdown").alias("severity", "n"))


@query
def wear_trends(spark, sf_dir):
    found = regional.wear_trends(regional.wear_latest(tv.envelopes(spark, sf_dir)))
    return found.withColumn("mean_rul_remaining", r6("mean_rul_remaining"))


@query
def wear_trends_ordered(spark, sf_dir):
    """Wear trends as an ordered array per region, with the place of each entry."""
    found = regional.ordered_wear_trends(regional.wear_trends(regional.wear_latest(tv.envelopes(spark, sf_dir))))
    return found.select("region_id", F.posexplode("wear_trends").alias("place", "t")).select(
        "region_id", _long("place"), "t.component_id", "t.unit", r6("t.mean_rul_remaining").alias("mean_rul_remaining"), "t.asset_count",
    )


@query
def connection_states(spark, sf_dir):
    """Lost and restored connections from cloud events whose types carry namespace and prefix."""
    e = tv.events(spark, sf_dir)
    kind = (
        F.when(F.col("kind") == "error", "fleet.sensor.Connection_Lost").when(F.col("kind") == "signup", "fleet.sensor.Connection_Restored")
        .when(F.col("kind") == "view", "Connection_Lost").otherwise(F.col("kind"))
    )
    return routing.connection_states(e.select("seq", kind.alias("type"))).select("seq", "state")


@query
def stamped_rollup(spark, sf_dir):
    """Fleet summary with the provenance of the rollup."""
    assets = regional.latest_by_asset(tv.envelopes(spark, sf_dir))
    stamped = regional.stamp_provenance(
        regional.fleet_summary(assets), F.lit("2024-02-01 00:00:00").cast("timestamp")
    )
    return stamped.select(
        "region_id", "asset_count", us("observed_at").alias("observed_us"),
        F.col("provenance.producer_id").alias("producer_id"), F.col("provenance.classification").alias("classification"),
    )


# ---------------------------------------------------------------- windows

def _trend_columns(df: DataFrame) -> DataFrame:
    return df.select(
        "asset_id", "signal", "seq", "n", r6("slope_per_hour").alias("slope"), r6("r_squared").alias("r2"),
        r6("latest").alias("latest"), "window_start_us", "latest_us",
    )


@query
def rolling_trend(spark, sf_dir):
    return _trend_columns(trends.rolling_trend(tv.samples(spark, sf_dir), TREND_WINDOW, bound=tv.bound(spark, sf_dir)))


@query
def capped_trend(spark, sf_dir):
    """The same with at most four samples per window."""
    return _trend_columns(trends.rolling_trend(tv.samples(spark, sf_dir), TREND_WINDOW, cap=4, bound=tv.bound(spark, sf_dir)))


@query
def emit_ticks(spark, sf_dir):
    return trends.emit_ticks(tv.events(spark, sf_dir), bound=tv.bound(spark, sf_dir)).select("asset_id", "seq", "n_events")


def _tick_trends(spark, sf_dir):
    return trends.tick_trends(tv.telemetry(spark, sf_dir), FLUID_WINDOW, WEAR_WINDOW, bound=tv.bound(spark, sf_dir))


@query
def tick_trends(spark, sf_dir):
    found = _tick_trends(spark, sf_dir)
    return _trend_columns(found.filter("n >= 2"))


@query
def windowed_telemetry(spark, sf_dir):
    found = trends.windowed_telemetry(tv.telemetry(spark, sf_dir), FLUID_WINDOW, WEAR_WINDOW, bound=tv.bound(spark, sf_dir))
    fuel = F.try_element_at("fluid_trends", F.lit("fuel_remaining"))
    return found.select(
        "asset_id", "seq", us("computed_at").alias("us"), "platform_variant",
        r6(fuel["slope"]["value"]).alias("fuel_slope"), r6(fuel["r_squared"]).alias("fuel_r2"),
        fuel["slope"]["unit"].alias("fuel_slope_unit"),
        F.size("consumable_trends").cast("long").alias("n_consumables"),
        F.size("wear_trends").cast("long").alias("n_wear"),
        F.size("active_fault_codes_latest").cast("long").alias("n_faults"),
        F.col("window.sample_count").alias("sample_count"), us("window.window_start").alias("start_us"),
        F.col("window.duration_us").alias("duration_us"),
    )


def _windowed(spark, sf_dir):
    return trends.windowed_telemetry(tv.telemetry(spark, sf_dir), FLUID_WINDOW, WEAR_WINDOW, bound=tv.bound(spark, sf_dir))


@query
def windowed_consumables(spark, sf_dir):
    """The rounds trends of the windowed records, entry by entry."""
    rows = _windowed(spark, sf_dir).select("asset_id", "seq", F.explode("consumable_trends").alias("c"))
    return rows.select("asset_id", "seq", "c.slot_key", r6("c.remaining.slope.value").alias("slope"), "c.capacity", "c.nsn")


@query
def windowed_wear(spark, sf_dir):
    """The wear trends of the windowed records, entry by entry."""
    rows = _windowed(spark, sf_dir).select("asset_id", "seq", F.explode("wear_trends").alias("w"))
    return rows.select(
        "asset_id", "seq", "w.component_key", r6("w.hours_in_service.slope.value").alias("hours_slope"),
        r6("w.remaining_useful_life.slope.value").alias("rul_slope"), r6("w.remaining_useful_life.latest.value").alias("rul_latest"),
    )


@query
def window_envelopes(spark, sf_dir):
    """Windowed records as envelopes that carry the whole record."""
    wrapped = regional.wrap_windows(_windowed(spark, sf_dir), "edge-1", "region-1")
    record = F.col(regional.WINDOWS)
    return wrapped.select(
        "source_edge_id", "region_id", "asset_id", "seq", us("wrapped_at").alias("us"), "payload_type",
        record["platform_variant"].alias("platform_variant"), record["provenance"]["producer_id"].alias("producer_id"),
        F.size(record["consumable_trends"]).cast("long").alias("n_consumables"), record["window"]["sample_count"].alias("sample_count"),
    )


@query
def ewma(spark, sf_dir):
    return thermal.ewma(tv.events(spark, sf_dir), "value", bound=tv.bound(spark, sf_dir)).select("asset_id", "seq", r6("ewma").alias("ewma"))


@query
def ewma_spike(spark, sf_dir):
    """The average after rare, very large values: every earlier row still counts, as powers of ten show."""
    e = tv.events(spark, sf_dir).withColumn("value", (F.col("value") + 1) * F.when(F.col("seq") % 500 == 0, 1e20).otherwise(1.0))
    return thermal.ewma(e, "value", bound=tv.bound(spark, sf_dir)).select("asset_id", "seq", r6(F.log10("ewma")).alias("log_ewma"))


@query
def sample_delta(spark, sf_dir):
    return thermal.sample_delta(tv.events(spark, sf_dir), "value", bound=tv.bound(spark, sf_dir)).select("asset_id", "seq", r6("rate").alias("rate"))


# ---------------------------------------------------------------- detection and wear

@query
def thermal_runaway(spark, sf_dir):
    found = thermal.thermal_runaway(thermal.event_view(tv.telemetry(spark, sf_dir)), bound=tv.bound(spark, sf_dir))
    return found.select(
        "asset_id", "seq", "rule_id", "severity", us("detected_at").alias("us"),
        r6("evidence.delta_k").alias("delta_k"), r6("evidence.rate_k_per_sample").alias("rate_k"),
    )


def _runaways(spark, sf_dir):
    most = tv.bound(spark, sf_dir)
    return lambda view: thermal.thermal_runaway(view, bound=most)


@query
def thermal_drift(spark, sf_dir):
    """Component temperature far above its own moving average."""
    found = thermal.thermal_drift(thermal.event_view(tv.telemetry(spark, sf_dir)), bound=tv.bound(spark, sf_dir))
    return found.select("asset_id", "seq", "rule_id", "severity", us("detected_at").alias("us"), r6("evidence.drift_k").alias("drift_k"))


@query
def usage_state(spark, sf_dir):
    """Where the usage of every asset stands, for a stream to go on from."""
    kin = usage.kinematics(tv.telemetry(spark, sf_dir), F.col("sustainment.wear.components").isNotNull().alias("fired"))
    known = usage.usage_state(kin, F.col("fired"), bound=tv.bound(spark, sf_dir))
    return known.select("asset_id", *[r6(c).alias(c) for c in ("distance_m", "x", "y", "z", "roll")], "first_us", "last_us", "rounds")


@query
def anomaly_events(spark, sf_dir):
    found = thermal.anomaly_events(thermal.detect(thermal.event_view(tv.telemetry(spark, sf_dir)), [_runaways(spark, sf_dir)]))
    return found.select(
        "specversion", "source", "type", "subject", "time", "datacontenttype",
        F.get_json_object("data", "$.severity").alias("severity"),
        r6(F.get_json_object("data", "$.evidence.delta_k").cast("double")).alias("delta_k"),
        F.get_json_object("data", "$.edge_id").alias("edge_id"),
    )


@query
def alert_projection(spark, sf_dir):
    found = alerts.project_alerts(tv.alert_events(spark, sf_dir), order=("ts", "seq"))
    return found.withColumn("us", us("detected_at")).drop("detected_at")


@query
def alert_table(spark, sf_dir):
    """Threshold and offline alerts from raw events to the alert table."""
    hot = routing.threshold_events(routing.tumbling_alerts(_readings(spark, sf_dir), per_type=False, bound=tv.bound(spark, sf_dir)))
    off = routing.offline_events(routing.offline_alerts(tv.connections(spark, sf_dir), tv.OFFLINE_SECONDS, bound=tv.bound(spark, sf_dir)))
    table = alerts.project_alerts(hot.unionByName(off))
    return table.groupBy("device_id", "event_type", "severity").agg(
        F.count("*").alias("n"), F.max(us("detected_at")).alias("last_us")
    )


def _wear_columns(df: DataFrame, *keep: str) -> DataFrame:
    return df.select("asset_id", *keep, "component", r6("measure").alias("measure"), "measure_unit",
                     r6("rul_pct").alias("rul_pct"), "status")


@query
def wear_status(spark, sf_dir):
    """Wear per asset and component at the end of the data."""
    kin = usage.kinematics(tv.telemetry(spark, sf_dir), F.col("sustainment.wear.components").isNotNull().alias("fired"))
    totals = usage.usage_totals(kin, F.col("fired"), bound=tv.bound(spark, sf_dir))
    return _wear_columns(wear.wear_rows(wear.derive_sustainment(totals, LIFE)))


@query
def wear_running(spark, sf_dir):
    """Wear per event, asset and component."""
    derived = wear.derive_sustainment(_usage(spark, sf_dir), LIFE)
    return _wear_columns(wear.wear_rows(derived, "seq"), "seq")


@query
def derived_events(spark, sf_dir):
    found = wear.derived_events(tv.telemetry(spark, sf_dir), LIFE, bound=tv.bound(spark, sf_dir))
    p, components = F.col("provenance"), F.col("sustainment.wear.components")
    return found.select(
        F.col("asset.asset_id").alias("asset_id"), "seq", F.col("asset.platform_variant").alias("platform_variant"),
        p["edge_id"].alias("edge_id"), p["region_id"].alias("region_id"), us("provenance.sample_time").alias("us"),
        F.size(components).cast("long").alias("n_components"),
        r6(F.try_element_at(components, F.lit("track"))["remaining_useful_life"]["value"]).alias("track_rul"),
        F.try_element_at("sustainment.value_provenance", F.lit("*"))["origin"].alias("origin"),
    )


# ---------------------------------------------------------------- set operations

@query
def fan_in_union(spark, sf_dir):
    rows = tv.envelopes(spark, sf_dir)
    return rows.select("region_id", "source_edge_id", "asset_id", "payload_type", "seq", us("wrapped_at").alias("us"))
