"""Quantities: presence, unit conversion, position frames, vectors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Dialect names and the unit each stands for.
UNIT_ALIASES = {
    "[degF]": "degF",
    "[kn_i]": "knot",
    "gal_us": "gallon",
    "1": "dimensionless",
}

# Unit -> (dimension, factor to the base unit, offset in the base unit).
UNITS = {
    "K": ("temperature", 1.0, 0.0),
    "kelvin": ("temperature", 1.0, 0.0),
    "degC": ("temperature", 1.0, 273.15),
    "degF": ("temperature", 5.0 / 9.0, 459.67 * 5.0 / 9.0),
    "m": ("length", 1.0, 0.0),
    "km": ("length", 1000.0, 0.0),
    "ft": ("length", 0.3048, 0.0),
    "m/s": ("speed", 1.0, 0.0),
    "km/h": ("speed", 1.0 / 3.6, 0.0),
    "knot": ("speed", 1852.0 / 3600.0, 0.0),
    "V": ("voltage", 1.0, 0.0),
    "mV": ("voltage", 0.001, 0.0),
    "s": ("time", 1.0, 0.0),
    "min": ("time", 60.0, 0.0),
    "h": ("time", 3600.0, 0.0),
    "L": ("volume", 0.001, 0.0),
    "gallon": ("volume", 0.003785411784, 0.0),
    "m^3": ("volume", 1.0, 0.0),
    "rad": ("angle", 1.0, 0.0),
    "deg": ("angle", 0.017453292519943295, 0.0),
    "count": ("count", 1.0, 0.0),
    "%": ("ratio", 0.01, 0.0),
    "dimensionless": ("ratio", 1.0, 0.0),
}

QUANTITY = "struct<value:double,unit:string>"


def present(value: Column, unit: Column) -> Column:
    """True unless value is 0 and unit is empty, which is how an unset quantity arrives."""
    return value.isNotNull() & ((value != 0) | (F.coalesce(unit, F.lit("")) != ""))


def quantity(q: Column) -> Column:
    """The quantity, or null when it is unset; ``(0, 'unit')`` stays."""
    return F.when(present(q["value"], q["unit"]), q)


def _lookup(entries: dict, key: Column) -> Column:
    pairs = [F.lit(x) for pair in entries.items() for x in pair]
    return F.try_element_at(F.create_map(*pairs), key)


def canonical_unit(unit: Column) -> Column:
    return F.coalesce(_lookup(UNIT_ALIASES, unit), unit)


def known_unit(unit: Column) -> Column:
    return canonical_unit(unit).isin(*UNITS)


def _convertible(target: str) -> dict[str, tuple[float, float]]:
    """Factor and offset to the base unit of every name that converts to ``target``, dialect names included."""
    dimension = UNITS[UNIT_ALIASES.get(target, target)][0]
    names = {name: UNIT_ALIASES.get(name, name) for name in (*UNITS, *UNIT_ALIASES)}
    return {name: UNITS[unit][1:] for name, unit in names.items() if UNITS[unit][0] == dimension}


def convertible(q: Column, target: str) -> Column:
    """Whether ``quantity_in`` gives a value, in a form that reaches the scan as a filter."""
    return q["value"].isNotNull() & q["unit"].isin(*_convertible(target))


def to_unit(value: Column, unit: Column, target: str) -> Column:
    """``value`` converted to ``target``; null for unset, unknown or incompatible units."""
    _, factor, offset = UNITS[UNIT_ALIASES.get(target, target)]
    known = {name: F.struct(F.lit(f).alias("factor"), F.lit(o).alias("offset")) for name, (f, o) in _convertible(target).items()}
    scale = F.try_element_at(F.create_map(*[x for name, pair in known.items() for x in (F.lit(name), pair)]), unit)
    # A unit that converts is not empty, so the quantity is set.
    return (value * scale["factor"] + scale["offset"] - F.lit(offset)) / F.lit(factor)


def quantity_in(q: Column, target: str) -> Column:
    return to_unit(q["value"], q["unit"], target)


# Position frames and the names of their components.
FRAMES = {
    "ecef": ("x", "y", "z"),
    "wgs84": ("lat", "lon", "alt"),
    "local_enu": ("east", "north", "up"),
}


def position(pos: Column) -> Column:
    """Whichever frame is set, as ``struct<frame, c1, c2, c3>``; null when none is."""
    resolved = None
    for frame, names in FRAMES.items():
        packed = F.struct(
            F.lit(frame).alias("frame"),
            *[quantity(pos[frame][n]).alias(f"c{i}") for i, n in enumerate(names, 1)],
        )
        found = pos[frame].isNotNull()
        resolved = F.when(found, packed) if resolved is None else resolved.when(found, packed)
    return resolved


def euler(angles: Column) -> Column:
    """Yaw, pitch and roll, each null when unset."""
    return F.struct(*[quantity(angles[n]).alias(n) for n in ("yaw", "pitch", "roll")])


def vector3(v: Column) -> Column:
    """Three quantities that share one unit; null when the unit is empty."""
    axes = F.struct(*[
        F.struct(v[a].alias("value"), canonical_unit(v["unit"]).alias("unit")).alias(a)
        for a in ("x", "y", "z")
    ])
    return F.when(F.coalesce(v["unit"], F.lit("")) != "", axes)
