"""Small expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def filled(value: Column) -> Column:
    """Neither null nor empty, in a form that reaches the scan as a filter."""
    return value.isNotNull() & (value.cast("string") != "")


def blank(value: Column) -> Column:
    return value.isNull() | (value.cast("string") == "")


def slot(us: Column, width: Column | int) -> Column:
    """Number of the ``width``-long slot a time falls in, exact for any integer time."""
    width = F.lit(width) if isinstance(width, int) else width
    return ((us - F.pmod(us, width)) / width).cast("long")


def empty_to_null(value: Column) -> Column:
    return F.when(filled(value), value)


def micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def stable_id(*parts: Column) -> Column:
    """The same id for the same event, so that a rerun writes the same rows."""
    return F.sha2(F.concat_ws("|", *[p.cast("string") for p in parts]), 256)


def iso_time(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
