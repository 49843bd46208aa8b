"""The domain streams as views over the generated ``events`` table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from convoy.operators import regional
from convoy.schemas import Q, WEAR_STATE

SENSORS = tuple((t, "window", 86_400, 85.0) for t in ("click", "view", "purchase", "signup")) + (
    ("error", "timer", 43_200, 0.0),
)
OFFLINE_SECONDS = 43_200
EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
COMPONENTS = ("track", "engine", "barrel", "suspension")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rows: asset, time, sequence, kind, value and the number inside ``props``."""
    return spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet").select(
        F.col("event_id").alias("seq"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("user_id").cast("string").alias("asset_id"),
        F.col("event_type").alias("kind"),
        "value",
        F.get_json_object("props", "$.k").cast("int").alias("k"),
    )


def bound(spark: SparkSession, sf_dir: str) -> int:
    """Rows of the table that all views come from; parquet knows them, so nothing is scanned."""
    return spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet").count()


def q(value: Column, unit: str | Column) -> Column:
    unit = F.lit(unit) if isinstance(unit, str) else unit
    return F.struct(value.cast("double").alias("value"), unit.alias("unit"))


def unset_q() -> Column:
    return F.struct(F.lit(0.0).alias("value"), F.lit("").alias("unit"))


def component(k: Column) -> Column:
    return F.element_at(F.array(*[F.lit(c) for c in COMPONENTS]), k % 4 + 1)


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sensor events; the reading sits in a JSON payload."""
    e = events(spark, sf_dir)
    return e.select(
        F.col("asset_id").cast("long").alias("device"), F.col("kind").alias("type"), "ts", "seq",
        F.to_json(F.struct("value")).alias("data"),
    )


def connections(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir).filter(F.col("kind").isin("error", "signup"))
    return e.select(
        F.col("asset_id").cast("long").alias("device"), "ts", "seq",
        F.when(F.col("kind") == "error", "lost").otherwise("restored").alias("state"),
    )


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir).filter("kind = 'signup'")
    return e.select(
        "asset_id", "ts", "seq",
        F.concat(F.lit("edge-"), F.col("k") % 3).alias("edge_id"),
        F.concat(F.lit("region-"), F.col("k") % 2).alias("region_id"),
    )


def cm_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir).filter("kind = 'view'")
    return e.select(
        "asset_id", "ts", "seq", F.lit("").alias("region_id"),
        F.when(F.col("k") % 7 == 0, "").otherwise(F.concat(F.lit("edge-"), F.col("k") % 3)).alias("edge_id"),
        (F.col("k") % 5).alias("overall_status"), (F.floor(F.col("k") / 5) % 5).cast("int").alias("lifecycle"),
    )


def logistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir).filter("kind = 'error'")
    factor = F.struct(
        F.concat(F.lit("f"), F.col("k") % 13).alias("factor_id"), (F.col("k") % 5).alias("severity")
    )
    return e.select(
        "ts", "seq", F.lit("").alias("region_id"), "asset_id",
        F.struct(
            "asset_id", (F.col("k") % 5).alias("overall_severity"), F.array(factor).alias("constraining_factors")
        ).alias("status"),
        F.struct(F.lit("").alias("region_id"), F.concat(F.lit("edge-"), F.col("k") % 3).alias("edge_id"))
        .alias("provenance"),
    )


def sustainment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Derived events with one component each."""
    e = events(spark, sf_dir).filter("kind = 'purchase'")
    rul = q(F.col("value"), F.when(F.col("k") % 10 < 8, "%").otherwise("h"))
    state = F.struct(
        F.lit(None).cast(Q).alias("hours_in_service"), F.lit(None).cast(Q).alias("cycles"),
        rul.alias("remaining_useful_life"), F.lit("NOMINAL").alias("status"),
    ).cast(WEAR_STATE)
    return e.select(
        "ts", "seq", F.struct("asset_id").alias("asset"),
        F.struct(F.struct(F.create_map(component(F.col("k")), state).alias("components")).alias("wear"))
        .alias("sustainment"),
    )


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full telemetry events with every field the operators read."""
    e = events(spark, sf_dir)
    k, value, kind = F.col("k"), F.col("value"), F.col("kind")
    pitch = F.when(kind == "error", unset_q()).otherwise(
        F.when(k % 2 == 0, q(k - 50, "deg")).otherwise(q(F.radians(k - 50), "rad"))
    )
    items = F.create_map(
        F.concat(F.lit("slot"), k % 2),
        F.struct(
            k.cast("double").alias("quantity_remaining"),
            F.when(k % 10 < 8, 100.0).otherwise(0.0).alias("quantity_capacity"),
            F.concat(F.lit("nsn-"), k % 3).alias("nsn"),
        ),
    )
    wear = F.create_map(component(k), F.struct(
        F.when(k % 10 < 9, q(k, "h")).otherwise(unset_q()).alias("hours_in_service"),
        F.lit(None).cast(Q).alias("cycles"), q(value, "%").alias("remaining_useful_life"),
        F.lit("NOMINAL").alias("status"),
    ).cast(WEAR_STATE))
    text = F.lit("").alias
    return e.select(
        "ts", "seq", F.col("seq").cast("string").alias("event_id"),
        F.struct(
            "asset_id", F.concat(F.lit("call-"), "asset_id").alias("callsign"), F.lit("ground").alias("platform_type"),
            F.concat(F.lit("v"), k % 3).alias("platform_variant"), F.lit("blue").alias("force"),
        ).alias("asset"),
        F.struct(
            F.struct(
                F.col("ts").alias("valid_at"),
                F.struct(q(value, "m").alias("x"), q(k, "m").alias("y"), q(F.col("seq") % 100, "m").alias("z")).alias("ecef"),
            ).alias("position"),
            F.struct(q(value, "km/h").alias("ground_speed")).alias("velocity"),
            F.struct(F.struct(
                unset_q().alias("yaw"), pitch.alias("pitch"), q(F.pmod(value, F.lit(45.0)), "deg").alias("roll")
            ).alias("euler")).alias("attitude"),
        ).alias("kinematics"),
        F.struct(
            F.struct(
                q(value + 300, "K").alias("component_temperature"), q(F.lit(300.0) + k / 2, "K").alias("ambient_temperature")
            ).alias("thermal"),
            F.struct(F.when(kind == "view", q(value, "L")).otherwise(unset_q()).alias("fuel_remaining")).alias("fluids"),
            F.struct(F.when(kind == "signup", q(k, "V")).otherwise(unset_q()).alias("bus_voltage")).alias("power"),
            F.struct(F.when(kind == "click", items).alias("items")).alias("consumables"),
            F.struct(F.when(kind == "purchase", wear).alias("components")).alias("wear"),
            F.struct(F.when(kind == "error", F.array(F.concat(F.lit("fault-"), k % 13)))
                     .otherwise(F.array().cast("array<string>")).alias("active_fault_codes")).alias("health"),
        ).alias("sustainment"),
        F.struct(
            text("producer_id"), F.col("ts").alias("sample_time"),
            F.when(k % 4 == 0, "").otherwise(F.concat(F.lit("edge-"), k % 3)).alias("edge_id"),
            F.when(k % 4 == 0, "").otherwise(F.concat(F.lit("region-"), k % 2)).alias("region_id"),
        ).alias("provenance"),
    )


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).select("asset_id", F.col("kind").alias("signal"), "ts", "seq", "value")


def alert_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cloud events in which every id occurs twice."""
    e = events(spark, sf_dir)
    kind = (
        F.when(F.col("kind") == "view", "fleet.sensor.temperature")
        .when(F.col("kind") == "error", "fleet.tactical.DeviceOfflineAlert")
        .otherwise("fleet.tactical.ThresholdExceeded")
    )
    severity = F.when(F.col("k") % 10 == 0, F.lit(None)).otherwise(
        F.element_at(F.array(*[F.lit(s) for s in ("LOW", "MEDIUM", "HIGH")]), F.col("k") % 3 + 1)
    )
    return e.select(
        F.floor(F.col("seq") / 2).cast("string").alias("id"), kind.alias("type"),
        F.when(F.col("k") == 99, "").otherwise(F.col("asset_id")).alias("source"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("time"),
        F.to_json(F.struct(severity.alias("severity"))).alias("data"), "ts", "seq",
    )


def anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir)
    return e.select(
        F.when((F.col("kind") == "error") & (F.col("k") >= 90), "CriticalAnomaly").otherwise("Other").alias("type"),
        F.when(F.col("k") < 95, F.col("asset_id")).alias("source"), "ts", "seq",
    )


def envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fan-in stream of all regions: edge payloads are tagged with the asset's newest
    region, headquarters payloads are resolved from the registry."""
    known = registry(spark, sf_dir)
    newest = regional.registry_latest(known).select(
        "asset_id", F.col("edge_id").alias("home_edge"), F.col("region_id").alias("home_region")
    )
    derived = sustainment(spark, sf_dir).withColumn("asset_id", F.col("asset.asset_id")).join(newest, "asset_id")
    # An event and its lookups: no timeline has more rows than that many times the table.
    most = bound(spark, sf_dir) * (1 + regional.LOOKUP_ATTEMPTS)
    log = regional.resolve_region(logistics(spark, sf_dir), known, bound=most)
    cm = regional.resolve_region(cm_state(spark, sf_dir), known, bound=most)
    return regional.fan_in(
        regional.wrap_logistics(log, F.col("region_id")),
        regional.wrap_cm_state(cm, F.col("region_id")),
        regional.wrap_sustainment(derived, F.col("home_edge"), F.col("home_region")),
    )
