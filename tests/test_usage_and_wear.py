import pytest
from pyspark.sql import functions as F

from convoy.functions.wear_models import WearLife, percent_remaining, wear_status
from convoy.operators.usage import kinematics, running_usage, usage_totals
from convoy.operators.wear import derive_sustainment, derived_events, wear_rows
from convoy.plans import testviews as tv

LIFE = WearLife(track_km=1000.0, engine_hours=1000.0, barrel_rounds=100, terrain_deg_km=1000.0)
OBS = "asset_id string, t double, seq long, x_m double, y_m double, z_m double, pitch_deg double, roll_deg double"

USAGE_CASES = {
    "first": ([(1, 0, 0, 0, 0, 0)], (0.0, 0.0, 0.0)),
    "line": ([(0, 0, 0, 0, 0, 0), (1, 1000, 0, 0, 0, 0)], (1000.0, 0.0, 1 / 3600)),
    "corner": ([(0, 0, 0, 0, 0, 0), (1, 1000, 0, 0, 0, 0), (2, 1000, 1000, 0, 0, 0)], (2000.0, 0.0, 2 / 3600)),
    "space": ([(0, 0, 0, 0, 0, 0), (1, 3, 4, 12, 0, 0)], (13.0, 0.0, 1 / 3600)),
    "hour": ([(0, 0, 0, 0, 0, 0), (3600, 0, 0, 0, 0, 0)], (0.0, 0.0, 1.0)),
    "trapezoid": ([(0, 0, 0, 0, 10, 0), (1, 1000, 0, 0, 10, 0)], (1000.0, 10.0, 1 / 3600)),
    "absolute": ([(0, 0, 0, 0, -15, 20), (1, 2000, 0, 0, -15, 20)], (2000.0, 70.0, 1 / 3600)),
    "missing attitude": ([(0, 0, 0, 0, None, None), (1, 1000, 0, 0, 10, 10)], (1000.0, 0.0, 1 / 3600)),
    "carried attitude": (
        [(0, 0, 0, 0, 10, 0), (1, 1000, 0, 0, None, None), (2, 2000, 0, 0, 20, 0)], (2000.0, 15.0, 2 / 3600)
    ),
}


@pytest.fixture(scope="module")
def observed(spark):
    rows = [
        (name, float(o[0]), i, *[None if v is None else float(v) for v in o[1:]])
        for name, (obs, _) in USAGE_CASES.items() for i, o in enumerate(obs)
    ]
    return spark.createDataFrame(rows, OBS).withColumn("ts", F.timestamp_micros((F.col("t") * 1e6).cast("long"))).drop("t")


@pytest.mark.parametrize("hot_rows", [None, 1])
def test_usage(observed, hot_rows):
    final = running_usage(observed, hot_rows=hot_rows).groupBy("asset_id").agg(
        F.max_by(F.struct("distance_m", "terrain_deg_km", "observed_hours"), "seq").alias("u")
    )
    found = {r.asset_id: tuple(r.u) for r in final.collect()}
    totals = {
        r.asset_id: (r.distance_m, r.terrain_deg_km, r.observed_hours)
        for r in usage_totals(observed, hot_rows=hot_rows).collect()
    }
    for name, (_, expected) in USAGE_CASES.items():
        assert found[name] == pytest.approx(expected), name
        assert totals[name] == pytest.approx(expected), name


def test_rounds(observed):
    fired = running_usage(observed.filter("asset_id = 'corner'"), F.col("seq") > 0)
    assert [r.rounds_fired for r in fired.orderBy("seq").collect()] == [0, 1, 2]


WEAR_CASES = {
    # name: (distance, hours, rounds, terrain) -> {component: (measure, unit, rul, status)}
    "empty": ((0.0, 0.0, 0, 0.0), {}),
    "track": ((250_000.0, 0.0, 0, 0.0), {"track": (250.0, "km", 75.0, "NOMINAL")}),
    "degraded": ((600_000.0, 0.0, 0, 0.0), {"track": (600.0, "km", 40.0, "DEGRADED")}),
    "due": ((950_000.0, 0.0, 0, 0.0), {"track": (950.0, "km", 5.0, "SERVICE_DUE")}),
    "critical": ((1_200_000.0, 0.0, 0, 0.0), {"track": (1200.0, "km", 0.0, "CRITICAL")}),
    "engine": ((0.0, 2.0, 0, 0.0), {"engine": (2.0, "h", 99.8, "NOMINAL")}),
    "barrel": ((0.0, 0.0, 25, 0.0), {"barrel": (25.0, "1", 75.0, "NOMINAL")}),
    "past life": ((0.0, 0.0, 150, 0.0), {"barrel": (150.0, "1", 0.0, "CRITICAL")}),
    "suspension": ((0.0, 0.0, 0, 400.0), {"suspension": (400.0, "deg.km", 60.0, "NOMINAL")}),
    "two": ((100_000.0, 1.0, 0, 0.0), {
        "track": (100.0, "km", 90.0, "NOMINAL"), "engine": (1.0, "h", 99.9, "NOMINAL")}),
}


def test_wear(spark):
    usage = spark.createDataFrame(
        [(n, *u) for n, (u, _) in WEAR_CASES.items()],
        "asset_id string, distance_m double, observed_hours double, rounds_fired long, terrain_deg_km double",
    )
    derived = derive_sustainment(usage, LIFE)
    assert derived.count() == len(WEAR_CASES)
    for row in derived.select("value_provenance").collect():
        assert {k: tuple(v) for k, v in row[0].items()} == {"*": ("DERIVED", 0.0)}
    found: dict = {n: {} for n in WEAR_CASES}
    for r in wear_rows(derived).collect():
        found[r.asset_id][r.component] = (r.measure, r.measure_unit, pytest.approx(r.rul_pct), r.status)
    assert found == {n: w for n, (_, w) in WEAR_CASES.items()}
    barrel = derived.filter("asset_id = 'barrel'").select("components.barrel.*").first()
    assert barrel.hours_in_service is None and barrel.cycles.value == 25.0


def test_no_life_left_to_give(spark):
    row = spark.range(1).select(
        percent_remaining(F.lit(5.0), F.lit(0.0)).alias("p"), wear_status(F.lit(5.0), F.lit(0.0)).alias("s"),
        wear_status(F.lit(0.5), F.lit(1.0)).alias("half"), wear_status(F.lit(0.9), F.lit(1.0)).alias("due"),
    ).first()
    assert tuple(row) == (0.0, "UNSPECIFIED", "DEGRADED", "SERVICE_DUE")


def test_life_options():
    life = WearLife.from_options({"PROGNOSTICS_BARREL_LIFE_TOTAL_ROUNDS": "250"})
    assert life == WearLife(barrel_rounds=250)


def test_kinematics_needs_earth_fixed_position(spark):
    source = tv.telemetry(spark, "/root/testdata/sf0.001").limit(10)
    unset = F.when(F.lit(False), F.col("kinematics.position.ecef"))
    other = source.withColumn("kinematics", F.col("kinematics").withField("position.ecef", unset))
    assert kinematics(other).count() == 0
    assert kinematics(source).count() == 10


def test_derived_event_identity(spark):
    source = tv.telemetry(spark, "/root/testdata/sf0.001")
    out = derived_events(source, edge_id="edge-x", region_id="region-x")
    assert out.count() == source.count() == out.select("event_id").distinct().count()
    row = out.filter("provenance.edge_id = 'edge-x'").first()
    assert row.provenance.region_id == "region-x" and row.asset.callsign == f"call-{row.asset.asset_id}"
    assert row.provenance.producer_id == "prognostics-derivation" and row.provenance.classification == "U"
