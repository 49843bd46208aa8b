"""Rows that sources cannot use: counted by reason, and kept in a quarantine table instead of vanishing.

A check is a list of reasons with the condition under which a row is left out; the first that holds is the row's reason.
``accounted`` observes the counts while the rows pass, so counting costs no pass of its own, in batch and in streams.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from convoy import schemas
from convoy.functions.common import blank

REASON = "_reason"
#: Prefix of the names of observed metrics.
METRICS = "rows_of_"

_BAD = "_corrupt_record"


def reasoned(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """``df`` with the reason why a row is left out; null for rows that are used."""
    first = reduce(lambda rest, check: F.when(F.coalesce(check[1], F.lit(False)), check[0]).otherwise(rest),
                   reversed(checks.items()), F.lit(None).cast("string"))
    return df.withColumn(REASON, first)


def accounted(reasoned_rows: DataFrame, source: str, reasons, observation: Observation | None = None) -> DataFrame:
    """The same rows; rows in and rows left out by reason are observed as ``rows_of_<source>``."""
    counts = [F.count(F.lit(1)).alias("rows_in"), *[F.count_if(F.col(REASON) == r).alias(r) for r in reasons]]
    return reasoned_rows.observe(observation or f"{METRICS}{source}", *counts)


def used(reasoned_rows: DataFrame) -> DataFrame:
    return reasoned_rows.filter(F.col(REASON).isNull()).drop(REASON)


def quarantined(reasoned_rows: DataFrame, source: str, raw: str = "value") -> DataFrame:
    """source, reason and raw text of the rows left out."""
    return reasoned_rows.filter(F.col(REASON).isNotNull()).select(
        F.lit(source).alias("source"), F.col(REASON).alias("reason"), F.col(raw).cast("string").alias("raw"))


def parsed(df: DataFrame, column: str, ddl: str) -> DataFrame:
    """``df`` with the fields of a JSON column as ``_j``, and as reason for text that is no such object."""
    fields = F.from_json(F.col(column), f"{ddl}, {_BAD} string", {"columnNameOfCorruptRecord": _BAD})
    return df.withColumn("_j", fields)


def _malformed(column: str) -> Column:
    return F.col(column).isNull() | F.col("_j").isNull() | F.col(f"_j.{_BAD}").isNotNull()


#: Reasons of the sources, in the order in which they are looked for.
TELEMETRY_REASONS = ("malformed", "blank_asset")
REGISTRY_REASONS = ("malformed", "blank_asset", "blank_region")
CLOUD_EVENT_REASONS = ("malformed", "malformed_data", "blank_device")
RESOLUTION_REASONS = ("blank_asset", "unknown_asset")


def check_telemetry(df: DataFrame, column: str = "value") -> DataFrame:
    """Telemetry texts with their reason; ``_j`` has the fields."""
    rows = parsed(df, column, schemas.TELEMETRY)
    return reasoned(rows, {"malformed": _malformed(column), "blank_asset": blank(F.col("_j.asset.asset_id"))})


def check_registry(df: DataFrame, column: str = "value") -> DataFrame:
    rows = parsed(df, column, schemas.REGISTRY)
    return reasoned(rows, {
        "malformed": _malformed(column), "blank_asset": blank(F.col("_j.asset_id")), "blank_region": blank(F.col("_j.region_id"))})


def check_cloud_events(df: DataFrame, column: str = "value") -> DataFrame:
    rows = parsed(df, column, schemas.CLOUD_EVENT)
    return reasoned(rows, {
        "malformed": _malformed(column), "malformed_data": F.try_parse_json("_j.data").isNull(), "blank_device": blank(F.col("_j.source"))})


def check_resolution(events: DataFrame, resolved: DataFrame, key: str = "seq") -> DataFrame:
    """``events`` with the reason why region resolution left them out; ``key`` names an event."""
    found = resolved.select(F.col(key).alias("_found")).distinct()
    rows = events.join(found, F.col(key).eqNullSafe(F.col("_found")), "left")
    open_ = blank(F.col("region_id"))
    return reasoned(rows, {
        "blank_asset": open_ & blank(F.col("asset_id")), "unknown_asset": open_ & F.col("_found").isNull()}).drop("_found")


def fields_of(used_rows: DataFrame, *keep: str) -> DataFrame:
    """The fields of rows that passed a check, next to ``keep``."""
    return used_rows.select(*keep, "_j.*").drop(_BAD)
