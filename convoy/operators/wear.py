"""Wear records from usage, and the derived-sustainment event."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from convoy.functions.common import filled, stable_id
from convoy.functions.wear_models import WearLife, derived_provenance, wear_components
from convoy.operators.usage import kinematics, running_usage


def derive_sustainment(usage: DataFrame, life: WearLife = WearLife()) -> DataFrame:
    """Adds the wear map and the message-level provenance, one row in, one row out."""
    return usage.withColumns({
        "components": wear_components(
            F.col("distance_m"), F.col("observed_hours"), F.col("rounds_fired"), F.col("terrain_deg_km"), life
        ),
        "value_provenance": derived_provenance(),
    })


def wear_rows(derived: DataFrame, *keep: str) -> DataFrame:
    """Long form: one row per asset and component."""
    state = F.col("state")
    measure = F.coalesce(state["hours_in_service"], state["cycles"])
    return (
        derived.select("asset_id", *keep, F.explode("components").alias("component", "state"))
        .select(
            "asset_id", *keep, "component",
            measure["value"].alias("measure"), measure["unit"].alias("measure_unit"),
            state["remaining_useful_life"]["value"].alias("rul_pct"), state["status"].alias("status"),
        )
    )


def derived_events(telemetry: DataFrame, life: WearLife = WearLife(), fired: Column | None = None,
                   edge_id: str = "edge-01", region_id: str = "region-01", namespace: str = "fleet",
                   hot_rows: int | None = None, bound: int | None = None) -> DataFrame:
    """One derived event per observation: identity and provenance of its source, wear so far."""
    observations = kinematics(
        telemetry, F.col("asset"), F.col("provenance").alias("source"), F.col("ts").alias("_arrived")
    )
    usage = derive_sustainment(running_usage(observations, fired, hot_rows, bound), life)
    return usage.select(
        stable_id(F.lit("derived"), F.col("asset_id"), F.col("ts"), F.col("seq")).alias("event_id"),
        F.lit(1).alias("schema_revision"),
        "seq", "ts", "asset",
        F.struct(
            F.struct("components").alias("wear"), F.col("value_provenance")
        ).alias("sustainment"),
        F.struct(
            F.lit("prognostics-derivation").alias("producer_id"),
            F.lit(f"{namespace}.prognostics.v1").alias("source_protocol"),
            F.coalesce("source.sample_time", "_arrived").alias("sample_time"),
            F.col("_arrived").alias("ingest_time"),
            F.lit("U").alias("classification"),
            F.when(filled(F.col("source.edge_id")), F.col("source.edge_id")).otherwise(edge_id).alias("edge_id"),
            F.when(filled(F.col("source.region_id")), F.col("source.region_id")).otherwise(region_id).alias("region_id"),
        ).alias("provenance"),
    )
