import itertools

import pytest
from pyspark.sql import functions as F

from convoy.functions.severity import bucket_name, cm_rank, logistics_rank, worse_rank
from convoy.operators import regional

REG = "asset_id string, edge_id string, region_id string, t double, seq long"
EVENT = "asset_id string, region_id string, t double, seq long"
ENV = """region_id string, source_edge_id string, asset_id string, payload_type string, wrapped_at timestamp, seq long,
logistics_status struct<status:struct<asset_id:string,overall_severity:int,
  constraining_factors:array<struct<factor_id:string,severity:int>>>>,
derived_sustainment struct<asset_id:string,components:map<string,struct<remaining_useful_life:struct<value:double,unit:string>>>>,
asset_cm_state_json string"""


def timed(spark, rows, ddl):
    return spark.createDataFrame(rows, ddl).withColumn("ts", F.timestamp_micros((F.col("t") * 1e6).cast("long"))).drop("t")


def test_registry_latest(spark):
    registry = timed(spark, [
        ("a-1", "edge-01", "region-east", 1.0, 1), ("a-1", "edge-02", "region-west", 2.0, 2),
        ("a-1", "edge-03", "", 3.0, 3), ("a-2", "edge-01", "region-east", 1.0, 4),
        ("", "edge-01", "region-east", 1.0, 5), ("a-3", None, "region-east", 1.0, 6), ("a-4", "edge-1", None, 1.0, 7),
    ], REG)
    found = sorted(tuple(r) for r in regional.registry_latest(registry).collect())
    assert found == [("a-1", "edge-02", "region-west"), ("a-2", "edge-01", "region-east"), ("a-3", "", "region-east")]
    assert regional.registry_latest(registry.limit(0)).count() == 0


RESOLVE = [
    # registry rows (t, region), event (t, stated region), attempts, expected region or None when dropped
    ([(1.0, "east")], (2.0, ""), 3, "east"),
    ([(1.0, "east"), (3.0, "west")], (2.0, ""), 3, "east"),
    ([(1.0, "east"), (2.3, "west")], (2.0, ""), 3, "east"),
    ([], (2.0, ""), 3, None),
    ([(2.3, "east")], (2.0, ""), 3, "east"),
    ([(2.5, "east")], (2.0, ""), 3, None),
    ([(1.0, "east")], (2.0, ""), 0, None),
    ([(2.3, "east")], (2.0, ""), 1, None),
    ([(1.0, "east")], (2.0, "north"), 3, "north"),
    ([(2.0, "east")], (2.0, None), 3, "east"),
]


@pytest.mark.parametrize("hot_rows", [None, 1])
def test_resolve_region(spark, hot_rows):
    for attempts in (0, 1, 3):
        cases = [(i, c) for i, c in enumerate(RESOLVE) if c[2] == attempts]
        registry = timed(spark, [(f"a{i}", "edge-NORTH", region, t, 100 * i + j)
                                 for i, c in cases for j, (t, region) in enumerate(c[0])], REG)
        events = timed(spark, [(f"a{i}", c[1][1], c[1][0], i) for i, c in cases], EVENT)
        out = regional.resolve_region(events, registry, attempts=attempts, hot_rows=hot_rows)
        assert out.columns.count("region_id") == 1
        found = {r.seq: r.region_id for r in out.collect()}
        assert found == {i: c[3] for i, c in cases if c[3] is not None}


def test_resolve_region_without_key(spark):
    registry = timed(spark, [("a", "e", "east", 1.0, 1)], REG)
    events = timed(spark, [("", "", 2.0, 1), (None, "", 2.0, 2), ("", "north", 2.0, 3)], EVENT)
    assert [r.seq for r in regional.resolve_region(events, registry).collect()] == [3]


def test_region_filters(spark):
    rows = timed(spark, [("a", "east", 1.0, 1), ("a", "", 1.0, 2), ("a", None, 1.0, 3), ("a", "west", 1.0, 4)], EVENT)
    assert [r.seq for r in regional.route_region(rows, "east").collect()] == [1]
    guarded = regional.guard_region(rows, "east").orderBy("seq").collect()
    assert [(r.seq, r.region_id) for r in guarded] == [(1, "east"), (2, "east"), (3, "east")]


def bucket(severity, status, lifecycle):
    """Truth table, written out independently of the expressions."""
    order = ["nominal", "degraded", "critical", "non_operational"]
    left = {2: "degraded", 3: "critical", 4: "non_operational"}.get(severity, "nominal")
    if lifecycle == 4:
        right = "non_operational"
    elif status in (2, 3, 4) or lifecycle == 3:
        right = "degraded"
    else:
        right = "nominal"
    return max(left, right, key=order.index)


def test_bucket_table(spark):
    table = list(itertools.product(range(5), range(5), range(5)))
    df = spark.createDataFrame(table, "s int, c int, l int")
    rank = worse_rank(logistics_rank(F.col("s")), cm_rank(F.col("c"), F.col("l")))
    found = {(r.s, r.c, r.l): r.b for r in df.select("s", "c", "l", bucket_name(rank).alias("b")).collect()}
    assert found == {case: bucket(*case) for case in table}


def envelopes(spark, rows):
    """rows: (asset, t, kind, payload)"""
    out = []
    for seq, (asset, t, kind, payload) in enumerate(rows):
        log = wear = cm = None
        if kind == "logistics_status":
            severity, factors = payload
            log = {"status": {"asset_id": asset, "overall_severity": severity,
                              "constraining_factors": [{"factor_id": f, "severity": s} for f, s in factors]}}
        elif kind == "derived_sustainment":
            wear = {"asset_id": asset, "components": {
                c: {"remaining_useful_life": {"value": v, "unit": u}} for c, (v, u) in payload.items()}}
        else:
            cm = payload
        out.append(("r", f"edge-{seq}", asset, kind, None, seq, log, wear, cm, float(t)))
    df = spark.createDataFrame(out, ENV + ", t double")
    return df.withColumn("wrapped_at", F.timestamp_seconds("t")).drop("t")


def test_rollups(spark):
    env = envelopes(spark, [
        ("a", 1, "logistics_status", (3, [("fuel", 3), ("crew", 1), ("parts", 2)])),
        ("a", 2, "asset_cm_state_json", '{"asset_id":"a","overall_status":"2","lifecycle":2}'),
        ("b", 1, "logistics_status", (4, [("fuel", 4)])),
        ("b", 2, "logistics_status", (1, [("fuel", 2)])),
        ("c", 1, "asset_cm_state_json", '{"asset_id":"c","edge_id":"edge-x","overall_status":1,"lifecycle":4}'),
        ("c", 2, "asset_cm_state_json", "broken"),
        ("d", 1, "derived_sustainment", {"track": (50.0, "%"), "engine": (10.0, "h"), "barrel": (0.0, "%")}),
        ("d", 2, "derived_sustainment", {"track": (40.0, "%"), "engine": (0.0, ""), "suspension": (0.0, "")}),
        ("e", 1, "derived_sustainment", {"track": (20.0, "%"), "engine": (30.0, "%")}),
        ("", 1, "derived_sustainment", {"track": (99.0, "%")}),
        ("f", 1, "asset_telemetry_windows", None),
    ])
    assets = regional.latest_by_asset(env)
    state = {r.asset_id: r for r in assets.collect()}
    assert set(state) == {"a", "b", "c", "d", "e"}
    assert [tuple(f) for f in state["a"].logistics_factors] == [("fuel", "CRITICAL"), ("parts", "DEGRADED")]
    assert (state["a"].cm_overall_status, state["a"].cm_lifecycle, state["a"].last_source_edge_id) == (2, 2, "edge-0")
    assert state["c"].last_source_edge_id == "edge-x"
    assert (state["d"].logistics_severity, state["d"].cm_lifecycle, state["d"].logistics_factors) == (0, 0, [])

    summary = regional.fleet_summary(assets).first()
    assert tuple(summary) == ("r", 3, 0, 1, 1, 5)
    factors = {r.factor_id: (r["count"], r.severity_breakdown, r.rank) for r in regional.top_factors(assets).collect()}
    assert factors == {"fuel": (2, {"CRITICAL": 1, "DEGRADED": 1}, 1), "parts": (1, {"DEGRADED": 1}, 2)}
    assert regional.top_factors(assets, n=1).count() == 1

    wear = {(r.component_id, r.unit): (r.mean_rul_remaining, r.asset_count)
            for r in regional.wear_trends(regional.wear_latest(env)).collect()}
    assert wear == {
        ("track", "%"): (30.0, 2), ("engine", "h"): (10.0, 1), ("engine", "%"): (30.0, 1), ("barrel", "%"): (0.0, 1),
    }
    merged = {r.asset_id: r.sustainment_wear for r in regional.merge_assets(env).collect()}
    assert set(merged["d"]) == {"track", "engine", "barrel"} and merged["a"] == {}


def test_nothing_seen_nothing_emitted(spark):
    env = envelopes(spark, [("a", 1, "asset_telemetry_windows", None)])
    assets = regional.latest_by_asset(env)
    assert regional.fleet_summary(assets).count() == 0
    assert regional.top_factors(assets).count() == 0


def test_ties_by_factor(spark):
    env = envelopes(spark, [(f"a{i}", 1, "logistics_status", (2, [(f"f{i}", 2)])) for i in range(12)])
    found = [r.factor_id for r in regional.top_factors(regional.latest_by_asset(env)).orderBy("rank").collect()]
    assert found == sorted(f"f{i}" for i in range(12))[:10]
