"""Alert projection into tables, and the actions that follow a critical anomaly."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from convoy.functions.common import filled, stable_id
from convoy.functions.newest import newest_rows
from convoy.operators.routing import TACTICAL

# The state row and the work order of a critical anomaly.
CRITICAL_TYPE = "CriticalAnomaly"
RADAR_STATUS = "DEGRADED"
TRANSMIT_POWER = 85
WORK_ORDER = {
    "issue": "Coolant Pressure Drop",
    "action_taken": "Throttled radar power to 85%",
    "priority": "CRITICAL",
}


def tactical_alerts(events: DataFrame, namespace: str = "fleet", severity_from_data: bool = False) -> DataFrame:
    """Tactical events with all required fields, as alert rows.

    Only threshold events carry a severity; others are UNKNOWN unless ``severity_from_data``.
    """
    prefix = f"{namespace}.{TACTICAL}"
    stated = F.coalesce(F.get_json_object("data", "$.severity"), F.lit(""))
    severity = F.when(F.col("type") == prefix + "ThresholdExceeded", stated)
    if severity_from_data:
        severity = F.when(stated != "", stated)
    return (
        events.filter(F.col("type").startswith(prefix))
        .filter(filled(F.col("id")) & filled(F.col("source")) & filled(F.col("time")))
        .withColumn("detected_at", F.try_to_timestamp("time"))
        .filter(F.col("detected_at").isNotNull())
        .withColumn("severity", F.coalesce(severity, F.lit("UNKNOWN")))
    )


def project_alerts(events: DataFrame, existing: DataFrame | None = None, namespace: str = "fleet",
                   severity_from_data: bool = False, order: tuple[str, ...] = ("detected_at",)) -> DataFrame:
    """One row per alert id, the earliest wins; ids already in ``existing`` are left alone.

    The earliest time is a hash aggregate with partial results before the shuffle, and equal copies are summed up
    likewise, so an id that was sent very many times does not gather in one task.
    """
    fields = dict.fromkeys(["id", "device_id", "event_type", "severity", "detected_at", *order])
    alerts = tactical_alerts(events, namespace, severity_from_data).withColumns({"device_id": F.col("source"), "event_type": F.col("type")})
    kept = newest_rows(alerts.select(*fields), ("id",), order, oldest=True).select("id", "device_id", "event_type", "severity", "detected_at")
    if existing is None:
        return kept
    return kept.join(existing.select("id"), "id", "left_anti")


def critical_anomalies(events: DataFrame, default_device: str = "device-00") -> DataFrame:
    """Critical anomalies; a missing source falls back to ``default_device``."""
    return events.filter(F.col("type") == CRITICAL_TYPE).withColumn(
        "device_id", F.coalesce(F.col("source").cast("string"), F.lit(default_device))
    )


def radar_state(critical: DataFrame) -> DataFrame:
    return critical.select(
        stable_id(F.lit("radar_state"), F.col("device_id"), F.col("seq")).alias("id"), "device_id",
        F.lit(RADAR_STATUS).alias("radar_status"), F.lit(TRANSMIT_POWER).alias("transmit_power"),
        F.col("ts").alias("timestamp"),
    )


def work_orders(critical: DataFrame) -> DataFrame:
    """Rows for the work-order table a delivery job reads."""
    return critical.select(
        stable_id(F.lit("work_order"), F.col("device_id"), F.col("seq")).alias("id"), "device_id",
        *[F.lit(text).alias(name) for name, text in WORK_ORDER.items()],
        F.col("ts").alias("created_at"),
    )
