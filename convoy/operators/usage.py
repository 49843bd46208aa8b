"""Lifetime usage per asset: distance, observed hours, terrain stress, rounds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from convoy.functions.common import filled, micros
from convoy.functions.newest import newest_rows
from convoy.functions.quantities import quantity_in
from convoy.operators.ordered import (
    OrderedGroups, first_value, last_value, ordered_groups, previous_row, running_count, running_max, running_sum,
)

_HOUR_US = 3_600_000_000.0


def kinematics(telemetry: DataFrame, *keep: Column) -> DataFrame:
    """Earth-fixed position in metres and attitude in degrees; other frames are left out."""
    pos = F.col("kinematics.position")

    def coordinate(axis: str) -> Column:
        stated = pos["ecef"][axis]
        return F.coalesce(quantity_in(stated, "m"), stated["value"], F.lit(0.0)).alias(f"{axis}_m")

    def degrees(angle: str) -> Column:
        q = F.col(f"kinematics.attitude.euler.{angle}")
        value = F.coalesce(q["value"], F.lit(0.0))
        return F.when(filled(q["unit"]), F.when(q["unit"] == "rad", F.degrees(value)).otherwise(value))

    valid_at = pos["valid_at"]
    return telemetry.filter(filled(F.col("asset.asset_id")) & pos["ecef"].isNotNull()).select(
        F.col("asset.asset_id").alias("asset_id"),
        F.when(micros(valid_at) > 0, valid_at).otherwise(F.col("ts")).alias("ts"),
        "seq",
        *[coordinate(a) for a in "xyz"],
        degrees("pitch").alias("pitch_deg"), degrees("roll").alias("roll_deg"),
        *keep,
    )


def _segments(observations: DataFrame, hot_rows: int | None, bound: int | None) -> OrderedGroups:
    """Distance to the previous observation and the terrain stress of that segment."""
    groups = ordered_groups(
        observations.withColumn("_us", micros(F.col("ts"))), "asset_id", ["ts", "seq"], hot_rows, bound
    ).with_running(
        _prev=previous_row(x=F.col("x_m"), y=F.col("y_m"), z=F.col("z_m")),
        _pitch=last_value("pitch_deg", inclusive=False),
        _roll=last_value("roll_deg", inclusive=False),
    )
    prev = F.col("_prev")
    step = [F.col(f"{a}_m") - prev[a] for a in "xyz"]
    metres = F.coalesce(F.sqrt(step[0] * step[0] + step[1] * step[1] + step[2] * step[2]), F.lit(0.0))
    stress = (
        (F.abs("_pitch") + F.abs("pitch_deg")) / 2 + (F.abs("_roll") + F.abs("roll_deg")) / 2
    ) * (F.col("_segment_m") / 1000.0)
    return groups.with_columns(_segment_m=metres).with_columns(_segment_stress=F.coalesce(stress, F.lit(0.0)))


_WORK = ("_us", "_prev", "_pitch", "_roll", "_segment_m", "_segment_stress", "_first_us", "_last_us")


def running_usage(observations: DataFrame, fired: Column | None = None,
                  hot_rows: int | None = None, bound: int | None = None) -> DataFrame:
    """Usage so far at every observation; ``fired`` flags rows that count as a round."""
    groups = _segments(observations, hot_rows, bound).with_running(
        distance_m=running_sum("_segment_m"),
        terrain_deg_km=running_sum("_segment_stress"),
        _first_us=first_value("_us"),
        _last_us=running_max("_us"),
        rounds_fired=running_count(F.lit(False) if fired is None else fired),
    )
    hours = (F.col("_last_us") - F.col("_first_us")) / _HOUR_US
    return groups.with_columns(observed_hours=hours).result().drop(*_WORK)


def usage_totals(observations: DataFrame, fired: Column | None = None,
                 hot_rows: int | None = None, bound: int | None = None) -> DataFrame:
    """Usage per asset at the end of the data; only segment lengths need an order."""
    flag = F.lit(False) if fired is None else fired
    return (
        _segments(observations, hot_rows, bound).result().groupBy("asset_id")
        .agg(
            F.sum("_segment_m").alias("distance_m"),
            F.sum("_segment_stress").alias("terrain_deg_km"),
            ((F.max("_us") - F.min("_us")) / _HOUR_US).alias("observed_hours"),
            F.count_if(flag).alias("rounds_fired"),
        )
    )


def usage_state(observations: DataFrame, fired: Column | None = None, hot_rows: int | None = None, bound: int | None = None) -> DataFrame:
    """What a stream must know of each asset to go on where ``observations`` end: totals, and the last position and attitude."""
    last = running_usage(observations, fired, hot_rows, bound)
    known = ordered_groups(last, "asset_id", ["ts", "seq"], hot_rows, bound).with_running(
        pitch=last_value("pitch_deg"), roll=last_value("roll_deg"), first_us=first_value(micros(F.col("ts"))), last_us=running_max(micros(F.col("ts"))),
    ).result()
    newest = newest_rows(known, ("asset_id",), ("ts", "seq"))
    return newest.select(
        "asset_id", "distance_m", "terrain_deg_km", "first_us", "last_us", F.col("rounds_fired").alias("rounds"),
        F.col("x_m").alias("x"), F.col("y_m").alias("y"), F.col("z_m").alias("z"), "pitch", "roll",
    )


def rounds_fired(events: DataFrame, fired: Column, key: str = "asset_id",
                 hot_rows: int | None = None, bound: int | None = None) -> DataFrame:
    """Running number of rounds fired by an asset."""
    return ordered_groups(events, key, ["ts", "seq"], hot_rows, bound).with_running(
        rounds_fired=running_count(fired)
    ).result()
