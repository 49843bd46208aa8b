"""Regions: registry, region resolution, envelopes, per-asset state, rollups."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from convoy.functions.common import blank, filled, micros
from convoy.functions.newest import newest_rows, order_number
from convoy.functions.severity import (
    BUCKETS, bucket_name, cm_rank, logistics_rank, severity_name, worse_rank,
)
from convoy.operators.ordered import last_value, ordered_groups

# How often and how long an event waits for its asset to be registered.
LOOKUP_ATTEMPTS = 3
LOOKUP_DELAY_US = 200_000
TOP_FACTORS = 10
PRODUCER = "regional-aggregator"

# The names of the payloads.
LOGISTICS, SUSTAINMENT = "logistics_status", "derived_sustainment"
WINDOWS, CM_STATE = "asset_telemetry_windows", "asset_cm_state_json"


# ---------------------------------------------------------------- registry

def registry_latest(registry: DataFrame) -> DataFrame:
    """Newest edge and region per asset; rows without asset or region never count."""
    known = registry.filter(filled(F.col("asset_id")) & filled(F.col("region_id"))).select(
        "asset_id", F.coalesce("edge_id", F.lit("")).alias("edge_id"), "region_id", "ts", "seq")
    return newest_rows(known, ("asset_id",), ("ts", "seq")).select("asset_id", "edge_id", "region_id")


def resolve_region(events: DataFrame, registry: DataFrame, attempts: int = LOOKUP_ATTEMPTS,
                   delay_us: int = LOOKUP_DELAY_US, hot_rows: int | None = None, bound: int | None = None) -> DataFrame:
    """Fills empty regions from the registry as known when the event arrived.

    An event whose asset is unknown looks again ``attempts - 1`` times, ``delay_us`` apart, and
    is dropped when all lookups miss. Registry rows are merged into the event order once per
    attempt, moved back by that attempt's delay: one sort instead of a range join.
    """
    stated = events.filter(filled(F.col("region_id")))
    open_ = events.filter(blank(F.col("region_id")) & filled(F.col("asset_id")))
    if attempts < 1:
        return stated
    known = registry.filter(filled(F.col("asset_id")) & filled(F.col("region_id"))).select(
        "asset_id", micros(F.col("ts")).alias("_at"), "seq", F.col("region_id").alias("_region"),
        F.explode(F.array(*[F.lit(k) for k in range(attempts)])).alias("_try"),
    ).withColumn("_us", F.col("_at") - F.col("_try") * delay_us)
    timeline = open_.withColumn("_us", micros(F.col("ts"))).unionByName(
        known, allowMissingColumns=True
    )
    is_event = F.col("_try").isNull()
    found = ordered_groups(
        timeline, "asset_id", [F.col("_us"), is_event.asc(), F.col("_at"), F.col("seq")], hot_rows, bound
    ).with_running(**{
        f"_hit{k}": last_value(F.when(F.col("_try") == k, F.col("_region"))) for k in range(attempts)
    }).result().filter(is_event)
    hits = [f"_hit{k}" for k in range(attempts)]
    resolved = (
        found.withColumn("region_id", F.coalesce(*hits) if attempts > 1 else F.col(hits[0]))
        .filter(F.col("region_id").isNotNull())
        .drop("_us", "_at", "_region", "_try", *hits)
    )
    return stated.unionByName(resolved)


def route_region(events: DataFrame, region: str | Column) -> DataFrame:
    """Events that name this region; an empty region matches none."""
    wanted = F.lit(region) if isinstance(region, str) else region
    return events.filter(filled(F.col("region_id")) & (F.col("region_id") == wanted))


def guard_region(envelopes: DataFrame, region: str | Column) -> DataFrame:
    """Drops envelopes tagged with another region; an empty tag passes and takes this region."""
    wanted = F.lit(region) if isinstance(region, str) else region
    return envelopes.filter(blank(F.col("region_id")) | (F.col("region_id") == wanted)).withColumn(
        "region_id", wanted
    )


# ---------------------------------------------------------------- envelopes

def wrap(df: DataFrame, payload_type: str, payload: Column, asset_id: Column,
         edge_id: Column | str, region_id: Column | str) -> DataFrame:
    """Envelope with one payload; ``ts`` is the time of wrapping."""
    def text(value: Column | str) -> Column:
        return F.coalesce(F.lit(value) if isinstance(value, str) else value, F.lit(""))

    return df.select(
        text(edge_id).alias("source_edge_id"), text(region_id).alias("region_id"),
        F.col("ts").alias("wrapped_at"), "seq", F.coalesce(asset_id, F.lit("")).alias("asset_id"),
        F.lit(payload_type).alias("payload_type"), payload.alias(payload_type),
    )


def _message(df: DataFrame) -> Column:
    """The whole message; readers prune what they do not need."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns])


def wrap_logistics(logistics: DataFrame, region_id: Column | str) -> DataFrame:
    payload = _message(logistics)
    return wrap(logistics, LOGISTICS, payload, F.col("status.asset_id"), F.col("provenance.edge_id"), region_id)


def wrap_cm_state(cm: DataFrame, region_id: Column | str) -> DataFrame:
    payload = F.to_json(_message(cm))
    return wrap(cm, CM_STATE, payload, F.col("asset_id"), F.col("edge_id"), region_id)


def wrap_sustainment(derived: DataFrame, edge_id: Column | str, region_id: Column | str) -> DataFrame:
    payload = F.struct(
        F.col("asset.asset_id").alias("asset_id"), F.col("sustainment.wear.components").alias("components"),
        _message(derived).alias("message"),
    )
    return wrap(derived, SUSTAINMENT, payload, F.col("asset.asset_id"), edge_id, region_id)


def wrap_windows(windows: DataFrame, edge_id: Column | str, region_id: Column | str) -> DataFrame:
    payload = _message(windows)
    return wrap(windows.withColumn("ts", F.col("computed_at")), WINDOWS, payload, F.col("asset_id"),
                edge_id, region_id)


def fan_in(*wrapped: DataFrame) -> DataFrame:
    """All sources as one envelope stream; a payload a source lacks is null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), wrapped)


def payloads(envelopes: DataFrame, payload_type: str) -> DataFrame:
    """Envelopes of one payload that name an asset."""
    return envelopes.filter((F.col("payload_type") == payload_type) & filled(F.col("asset_id")))


# ---------------------------------------------------------------- per-asset state

_CM_SCHEMA = "asset_id string, edge_id string, overall_status string, lifecycle string"


def _column_or_null(df: DataFrame, name: str, ddl: str) -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast(ddl)


def contributions(envelopes: DataFrame) -> DataFrame:
    """What each envelope says about its asset, flat; window payloads say nothing."""
    status = "struct<asset_id:string,overall_severity:int,constraining_factors:array<struct<factor_id:string,severity:int>>>"
    logistics = _column_or_null(envelopes, LOGISTICS, f"struct<status:{status}>")["status"]
    wear = _column_or_null(envelopes, SUSTAINMENT, "struct<asset_id:string>")
    cm = F.from_json(_column_or_null(envelopes, CM_STATE, "string"), _CM_SCHEMA)
    named = F.when(F.col("payload_type") == CM_STATE, F.col("_cm.asset_id")).otherwise(
        F.coalesce(
            F.when(filled(logistics["asset_id"]), logistics["asset_id"]),
            F.when(filled(wear["asset_id"]), wear["asset_id"]),
            F.col("asset_id"),
        )
    )
    return (
        envelopes.filter(filled(F.col("asset_id")) & F.col("payload_type").isin(LOGISTICS, SUSTAINMENT, CM_STATE))
        .withColumn("_cm", cm)
        .select(
            "region_id", named.alias("asset_id"), "payload_type", "wrapped_at", "seq",
            logistics["overall_severity"].alias("severity"),
            F.transform(
                F.filter(logistics["constraining_factors"], lambda f: f["severity"] > 1),
                lambda f: F.struct(f["factor_id"].alias("factor_id"), severity_name(f["severity"]).alias("severity")),
            ).alias("factors"),
            F.coalesce(F.col("_cm.overall_status").try_cast("int"), F.lit(0)).alias("overall_status"),
            F.coalesce(F.col("_cm.lifecycle").try_cast("int"), F.lit(0)).alias("lifecycle"),
            F.when(F.col("payload_type") == CM_STATE, F.col("_cm.edge_id")).otherwise(F.col("source_edge_id"))
            .alias("edge_id"),
        )
        .filter(filled(F.col("asset_id")))
    )


def latest_by_asset(envelopes: DataFrame) -> DataFrame:
    """Newest logistics and configuration contribution per asset, in a single aggregation.

    An asset with only wear data is listed too, with severity, status and lifecycle 0. The
    edge of a configuration row counts only when it is named.
    """
    return latest_contributions(contributions(envelopes))


def latest_contributions(rows: DataFrame) -> DataFrame:
    """``latest_by_asset`` for rows that are already flat.

    The newest times of the three kinds are one hash aggregate of numbers; the few rows that have them come back by a
    join. Of rows that tie the greatest content counts.
    """
    is_log, is_cm = F.col("payload_type") == LOGISTICS, F.col("payload_type") == CM_STATE
    kinds = {"log": is_log, "cm": is_cm, "edge": ~is_cm | filled(F.col("edge_id"))}
    fields = {"log": F.struct("severity", "factors"), "cm": F.struct("overall_status", "lifecycle"), "edge": F.struct("edge_id")}
    at = order_number(rows, ("wrapped_at", "seq"))
    tops = rows.groupBy(F.col("region_id").alias("_region"), F.col("asset_id").alias("_asset")).agg(
        *[F.max(F.when(kind, at)).alias(f"_{name}") for name, kind in kinds.items()], F.max("wrapped_at").alias("last_updated"))
    newest = {name: kind & (at == F.col(f"_{name}")) for name, kind in kinds.items()}
    found = rows.join(tops, F.col("region_id").eqNullSafe(F.col("_region")) & (F.col("asset_id") == F.col("_asset"))).filter(
        reduce(lambda a, b: a | b, newest.values()))
    latest = found.groupBy("region_id", "asset_id").agg(
        *[F.array_max(F.collect_set(F.when(newest[name], fields[name]))).alias(name) for name in kinds],
        F.max("last_updated").alias("last_updated"),
    ).withColumn("edge", F.col("edge.edge_id"))
    none = F.array().cast("array<struct<factor_id:string,severity:string>>")
    return latest.select(
        "region_id", "asset_id",
        F.coalesce("log.severity", F.lit(0)).alias("logistics_severity"),
        F.coalesce("log.factors", none).alias("logistics_factors"),
        F.coalesce("cm.overall_status", F.lit(0)).alias("cm_overall_status"),
        F.coalesce("cm.lifecycle", F.lit(0)).alias("cm_lifecycle"),
        F.coalesce("edge", F.lit("")).alias("last_source_edge_id"),
        "last_updated",
    )


def wear_contributions(envelopes: DataFrame) -> DataFrame:
    """Remaining life per component of each sustainment envelope; an unset one is skipped."""
    payload = F.col(SUSTAINMENT)
    rows = payloads(envelopes, SUSTAINMENT).select(
        "region_id",
        F.when(filled(payload["asset_id"]), payload["asset_id"]).otherwise(F.col("asset_id")).alias("asset_id"),
        "wrapped_at", "seq",
        F.explode(payload["components"]).alias("component_id", "state"),
    )
    rul = F.col("state.remaining_useful_life")
    unit = F.coalesce(rul["unit"], F.lit(""))
    value = F.coalesce(rul["value"], F.lit(0.0))
    return rows.filter((value != 0) | (unit != "")).select(
        "region_id", "asset_id", "component_id", "wrapped_at", "seq", unit.alias("unit"), value.alias("rul")
    )


def wear_latest(envelopes: DataFrame) -> DataFrame:
    """Newest remaining life per asset and component; a component missing from a newer
    message keeps its older value."""
    keys = ("region_id", "asset_id", "component_id")
    return newest_rows(wear_contributions(envelopes), keys, ("wrapped_at", "seq")).select(*keys, "unit", "rul")


def merge_assets(envelopes: DataFrame) -> DataFrame:
    """The whole state of an asset in one row, wear as a map."""
    wear = wear_latest(envelopes).groupBy("region_id", "asset_id").agg(
        F.map_from_entries(F.collect_list(F.struct(
            F.col("component_id").alias("key"), F.struct("unit", "rul").alias("value")
        ))).alias("wear")
    )
    empty = F.create_map().cast("map<string,struct<unit:string,rul:double>>")
    return (
        latest_by_asset(envelopes).join(wear, ["region_id", "asset_id"], "left")
        .withColumn("sustainment_wear", F.coalesce("wear", empty)).drop("wear")
    )


def severity_buckets(assets: DataFrame) -> DataFrame:
    """The worse of the logistics and the configuration bucket per asset."""
    rank = worse_rank(
        logistics_rank(F.col("logistics_severity")),
        cm_rank(F.col("cm_overall_status"), F.col("cm_lifecycle")),
    )
    return assets.select("region_id", "asset_id", rank.alias("bucket_rank"), bucket_name(rank).alias("bucket"))


# ---------------------------------------------------------------- rollups

def fleet_summary(assets: DataFrame) -> DataFrame:
    """Assets per bucket and region."""
    return severity_buckets(assets).groupBy("region_id").agg(
        *[F.count_if(F.col("bucket") == b).alias(b) for b in BUCKETS],
        F.count("*").alias("asset_count"),
    )


def top_factors(assets: DataFrame, n: int = TOP_FACTORS) -> DataFrame:
    """The ``n`` most frequent constraining factors per region, ties by id.

    Counting per (factor, severity) first leaves at most five rows per factor for the second
    aggregation, and the rank filter is applied before and after the shuffle.
    """
    counts = (
        assets.select("region_id", F.explode("logistics_factors").alias("f"))
        .groupBy("region_id", F.col("f.factor_id").alias("factor_id"), F.col("f.severity").alias("severity"))
        .count()
        .groupBy("region_id", "factor_id")
        .agg(
            F.sum("count").alias("count"),
            F.map_from_entries(F.collect_list(F.struct("severity", "count"))).alias("severity_breakdown"),
        )
    )
    ranked = Window.partitionBy("region_id").orderBy(F.desc("count"), F.asc("factor_id"))
    return counts.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= n)


def wear_trends(wear: DataFrame) -> DataFrame:
    """Mean remaining life and asset count per region, component and unit; units never mix."""
    return wear.groupBy("region_id", "component_id", "unit").agg(
        F.avg("rul").alias("mean_rul_remaining"), F.count("*").alias("asset_count")
    )


def ordered_wear_trends(trends: DataFrame) -> DataFrame:
    """The wear trends of a region as one array, ordered by component and unit; a row per region."""
    entry = F.struct("component_id", "unit", "mean_rul_remaining", "asset_count")
    return trends.groupBy("region_id").agg(F.array_sort(F.collect_list(entry)).alias("wear_trends"))


def stamp_provenance(rollup: DataFrame, observed_at: Column) -> DataFrame:
    return rollup.withColumns({
        "observed_at": observed_at,
        "provenance": F.struct(
            F.lit(PRODUCER).alias("producer_id"), F.col("region_id"),
            observed_at.alias("ingest_time"), F.lit("U").alias("classification"),
        ),
    })


def latest_state(events: DataFrame, key: str = "asset_id") -> DataFrame:
    """The newest event per asset, all columns kept."""
    return newest_rows(events.filter(filled(F.col(key))), (key,), ("ts", "seq"))
