"""Anomaly detectors: functions from an event view to rows of the anomaly schema."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from convoy.functions.common import iso_time, micros, slot, stable_id
from convoy.functions.quantities import convertible, quantity, quantity_in
from convoy.operators.ordered import ordered_groups, previous_row, running_count

# Smoothing factor and limits of the thermal rule.
EWMA_ALPHA = 0.2
DELTA_LIMIT_K = 80.0
RATE_LIMIT_K = 2.0
THERMAL_RULE = "thermal.runaway.v1"

#: A rule of this library's own.
DRIFT_RULE = "thermal.drift.v1"
DRIFT_LIMIT_K = 40.0


def event_view(telemetry: DataFrame) -> DataFrame:
    """The few fields detectors read."""
    return telemetry.select(
        F.col("asset.asset_id").alias("asset_id"), "ts", "seq",
        F.col("kinematics.position.valid_at").alias("sample_time"),
        quantity(F.col("sustainment.thermal.component_temperature")).alias("component_temp"),
        quantity(F.col("sustainment.thermal.ambient_temperature")).alias("ambient_temp"),
        quantity(F.col("kinematics.velocity.ground_speed")).alias("ground_speed"),
        quantity(F.col("sustainment.fluids.fuel_remaining")).alias("fuel_remaining"),
        quantity(F.col("sustainment.power.bus_voltage")).alias("bus_voltage"),
    )


#: Rows of a block of the average at most.
EWMA_BLOCK = 4096
#: Powers of two between the largest and the smallest double, and a little more.
_DOUBLE_RANGE = 2100


def ewma(df: DataFrame, value: str, key: str = "asset_id", alpha: float = EWMA_ALPHA,
         out: str = "ewma", seed: float | None = None, hot_rows: int | None = None, bound: int | None = None) -> DataFrame:
    """Exponential moving average seeded with the first value (or with ``seed``).

    ``alpha`` may be anything above 0 up to 1; every earlier row counts with its full weight.
    """
    if not 0 < alpha <= 1:
        raise ValueError("alpha must lie above 0 and not above 1")
    decay = 1.0 - alpha
    numbered = ordered_groups(df, key, ["ts", "seq"], hot_rows, bound).with_running(_n=running_count()).result()
    share = alpha * F.col(value)
    start = F.col(value) if seed is None else share + decay * seed
    rows = numbered.withColumn("_share", F.when(F.col("_n") == 1, start).otherwise(share))
    if decay == 0.0:
        return rows.withColumn(out, F.col("_share")).drop("_n", "_share")
    return _decayed_sum(rows, key, "_n", "_share", math.log(decay), out).drop("_n", "_share")


def _decayed_sum(rows: DataFrame, key: str, n: str, share: str, log_decay: float, out: str) -> DataFrame:
    """``out(i) = share(i) + decay * out(i - 1)`` along the numbers ``n`` = 1, 2, ... of a key.

    Inside blocks it is a scaled running sum. Ends of blocks are a series of the same kind, one
    row for a block with the decay of a whole block: where few ends reach over the range of a
    double they are summed directly, otherwise the same method runs over them. So no group is
    larger than a block and nothing is cut off.
    """
    block = max(1, min(EWMA_BLOCK, math.ceil(-53 * math.log(2) / log_decay)))
    inside = Window.partitionBy(key, "_block").orderBy("_pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    pos = F.col("_pos")
    own = F.sum(F.col(share) * F.exp(-log_decay * pos)).over(inside) * F.exp(log_decay * pos)
    placed = rows.withColumns({
        "_block": slot(F.col(n) - 1, block), "_pos": ((F.col(n) - 1) % block).cast("double"),
    }).withColumn("_own", own)
    ends = placed.filter(pos == block - 1).select(key, (F.col("_block") + 1).alias("_block"), F.col("_own").alias("_end"))
    reach = math.ceil(-_DOUBLE_RANGE * math.log(2) / (log_decay * block))
    if reach <= 64:
        weighted = F.col("_end") * F.exp(log_decay * block * F.col("_back"))
        before = (
            ends.withColumn("_back", F.explode(F.sequence(F.lit(0), F.lit(reach))))
            .groupBy(key, (F.col("_block") + F.col("_back")).alias("_block")).agg(F.sum(weighted).alias("_carry"))
        )
    else:
        before = _decayed_sum(ends.withColumnRenamed("_block", "_b"), key, "_b", "_end", log_decay * block, "_carry").select(
            key, F.col("_b").alias("_block"), "_carry")
    carried = F.coalesce(F.col("_before") * F.exp(log_decay * (pos + 1)), F.lit(0.0))
    return placed.join(before.withColumnRenamed("_carry", "_before"), [key, "_block"], "left").withColumn(out, F.col("_own") + carried).drop("_block", "_pos", "_own", "_before")


def sample_delta(df: DataFrame, value: str, key: str = "asset_id", out: str = "rate",
                 hot_rows: int | None = None, bound: int | None = None) -> DataFrame:
    """Change since the previous sample; 0 on the first and after a previous value of 0."""
    groups = ordered_groups(df, key, ["ts", "seq"], hot_rows, bound).with_running(_prev=previous_row(v=F.col(value)))
    before = F.coalesce(F.nullif(F.col("_prev.v"), F.lit(0.0)), F.col(value))
    return groups.with_columns(**{out: F.col(value) - before}).result().drop("_prev")


def thermal_samples(view: DataFrame) -> DataFrame:
    """Events with both temperatures, in kelvin; the others go before anything is converted."""
    temperatures = {f"{name}_k": F.col(name) for name in ("component_temp", "ambient_temp")}
    return view.filter(reduce(lambda a, b: a & b, [convertible(q, "kelvin") for q in temperatures.values()])).select(
        "asset_id", "ts", "seq", "sample_time", *[quantity_in(q, "kelvin").alias(name) for name, q in temperatures.items()])


@dataclass(frozen=True)
class Rule:
    """When a sample is an anomaly and what is said about it, over the columns of a rated sample."""

    rule_id: str
    when: Column
    summary: Column
    evidence: Column
    severity: str = "critical"

    def record(self) -> Column:
        """The anomaly of a sample with its evidence as JSON; null if it is none."""
        return F.when(self.when, F.struct(
            F.lit(self.rule_id).alias("rule_id"), F.lit(self.severity).alias("severity"), self.summary.alias("summary"),
            F.to_json(self.evidence).alias("evidence")))


def runaway_rule() -> Rule:
    """Component far above ambient and still rising."""
    delta, rate = F.col("component_temp_k") - F.col("ambient_temp_k"), F.col("rate_k_per_sample")
    return Rule(
        THERMAL_RULE, (delta > DELTA_LIMIT_K) & (rate > RATE_LIMIT_K),
        # Fixed value: the wording of the summary.
        F.format_string("Component %.1fK above ambient, rising %.2fK/sample", delta, rate),
        F.struct("component_temp_k", "ambient_temp_k", delta.alias("delta_k"), "rate_k_per_sample"),
    )


def drift_rule(limit_k: float = DRIFT_LIMIT_K) -> Rule:
    """Component far above its own moving average."""
    drift = F.col("component_temp_k") - F.col("ewma_k")
    return Rule(
        DRIFT_RULE, drift > limit_k, F.format_string("Component %.1fK above its moving average", drift),
        F.struct("component_temp_k", "ewma_k", drift.alias("drift_k")), "warning",
    )


def found_by(rule: Rule, rated: DataFrame) -> DataFrame:
    """Anomalies among rated samples."""
    return rated.filter(rule.when).select(
        F.lit(rule.rule_id).alias("rule_id"), F.lit(rule.severity).alias("severity"), "asset_id", rule.summary.alias("summary"),
        F.coalesce("sample_time", "ts").alias("detected_at"), "ts", "seq", rule.evidence.alias("evidence"),
    )


def runaways(rated: DataFrame) -> DataFrame:
    """Anomalies among samples with their change since the sample before."""
    return found_by(runaway_rule(), rated)


def thermal_runaway(view: DataFrame, hot_rows: int | None = None, bound: int | None = None) -> DataFrame:
    """Component far above ambient and still rising; events lacking a temperature leave no trace."""
    return runaways(sample_delta(thermal_samples(view), "component_temp_k", out="rate_k_per_sample", hot_rows=hot_rows, bound=bound))


def thermal_drift(view: DataFrame, limit_k: float = DRIFT_LIMIT_K, hot_rows: int | None = None, bound: int | None = None) -> DataFrame:
    """Component far above the moving average of its temperature."""
    return found_by(drift_rule(limit_k), ewma(thermal_samples(view), "component_temp_k", out="ewma_k", hot_rows=hot_rows, bound=bound))


Detector = Callable[[DataFrame], DataFrame]

DETECTORS: list[Detector] = [thermal_runaway]


def detect(view: DataFrame, detectors: Iterable[Detector] | None = None) -> DataFrame:
    """All detectors over one view; evidence becomes JSON so that their rows can be stacked."""
    found = [d(view).withColumn("evidence", F.to_json("evidence")) for d in (detectors or DETECTORS)]
    return reduce(lambda a, b: a.unionByName(b), found)


def anomaly_events(anomalies: DataFrame, edge_id: str = "edge-01", region_id: str = "region-01",
                   namespace: str = "fleet") -> DataFrame:
    """Anomalies as cloud events; ``data`` is JSON."""
    kind = F.concat(F.lit(f"{namespace}.anomaly."), F.col("rule_id"))
    return anomalies.select(
        F.lit("1.0").alias("specversion"),
        stable_id(kind, F.col("asset_id"), micros(F.col("ts")), F.col("seq")).alias("id"),
        F.concat(F.lit(f"{namespace}/edge/{edge_id}/"), F.col("asset_id")).alias("source"),
        kind.alias("type"),
        F.col("asset_id").alias("subject"),
        iso_time(F.col("ts")).alias("time"),
        F.lit("application/json").alias("datacontenttype"),
        F.to_json(F.struct(
            "severity", "summary", F.parse_json("evidence").alias("evidence"),
            F.lit(edge_id).alias("edge_id"), F.lit(region_id).alias("region_id"),
        )).alias("data"),
    )
