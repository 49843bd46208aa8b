"""Wear of one asset from its lifetime usage."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class WearLife:
    """Total life of each component, in the unit its usage is measured in."""

    # Default life totals.
    track_km: float = 5000.0
    engine_hours: float = 5000.0
    barrel_rounds: int = 1000
    terrain_deg_km: float = 100000.0

    @classmethod
    def from_options(cls, options: Mapping[str, str] | None = None) -> "WearLife":
        """Defaults overridden by ``PROGNOSTICS_*`` options (the environment if none given)."""
        options = os.environ if options is None else options
        names = {
            "track_km": ("PROGNOSTICS_TRACK_LIFE_TOTAL_KM", float),
            "engine_hours": ("PROGNOSTICS_ENGINE_LIFE_TOTAL_HOURS", float),
            "barrel_rounds": ("PROGNOSTICS_BARREL_LIFE_TOTAL_ROUNDS", int),
            "terrain_deg_km": ("PROGNOSTICS_TERRAIN_TOTAL_DEG_KM", float),
        }
        return cls(**{f: kind(options[n]) for f, (n, kind) in names.items() if n in options})


def percent_remaining(used: Column, total: Column) -> Column:
    share = F.least(F.lit(1.0), F.greatest(F.lit(0.0), used / total))
    return F.when(total > 0, F.lit(100.0) * (F.lit(1.0) - share)).otherwise(0.0)


def wear_status(used: Column, total: Column) -> Column:
    share = used / total
    return (
        F.when(total <= 0, "UNSPECIFIED")
        .when(share >= 1.0, "CRITICAL")
        .when(share >= 0.9, "SERVICE_DUE")
        .when(share >= 0.5, "DEGRADED")
        .otherwise("NOMINAL")
    )


def _wear(used: Column, unit: str, total: float, counted_in_cycles: bool = False) -> Column:
    used = used.cast("double")
    total = F.lit(float(total))
    measure = F.struct(used.alias("value"), F.lit(unit).alias("unit"))
    unset = F.lit(None).cast("struct<value:double,unit:string>")
    hours, cycles = (unset, measure) if counted_in_cycles else (measure, unset)
    state = F.struct(
        hours.alias("hours_in_service"),
        cycles.alias("cycles"),
        F.struct(percent_remaining(used, total).alias("value"), F.lit("%").alias("unit"))
        .alias("remaining_useful_life"),
        wear_status(used, total).alias("status"),
    )
    return F.when(used > 0, state)


def track_wear(distance_m: Column, life: WearLife) -> Column:
    return _wear(distance_m / 1000.0, "km", life.track_km)


def engine_wear(hours: Column, life: WearLife) -> Column:
    return _wear(hours, "h", life.engine_hours)


def barrel_wear(rounds: Column, life: WearLife) -> Column:
    return _wear(rounds, "1", life.barrel_rounds, counted_in_cycles=True)


def suspension_wear(terrain_deg_km: Column, life: WearLife) -> Column:
    return _wear(terrain_deg_km, "deg.km", life.terrain_deg_km)


def wear_components(
    distance_m: Column, hours: Column, rounds: Column, terrain_deg_km: Column, life: WearLife
) -> Column:
    """``map<component, wear>`` of the models that have input."""
    states = {
        "track": track_wear(distance_m, life),
        "engine": engine_wear(hours, life),
        "barrel": barrel_wear(rounds, life),
        "suspension": suspension_wear(terrain_deg_km, life),
    }
    entries = F.array(*[
        F.struct(F.lit(name).alias("key"), state.alias("value")) for name, state in states.items()
    ])
    return F.map_from_entries(F.filter(entries, lambda e: e["value"].isNotNull()))


def derived_provenance() -> Column:
    """Marks every value of a record as derived, with no confidence claimed."""
    return F.create_map(
        F.lit("*"), F.struct(F.lit("DERIVED").alias("origin"), F.lit(0.0).alias("confidence"))
    )
