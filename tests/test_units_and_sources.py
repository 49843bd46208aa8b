import json

import pytest
from pyspark.sql import functions as F

from convoy.functions.quantities import known_unit, position, quantity, to_unit, vector3
from convoy.operators.regional import latest_state
from convoy.plans import testviews as tv
from convoy.schemas import TELEMETRY
from convoy.sources import readers
from convoy.sources.tables import BatchTable
from convoy.streaming import jobs


@pytest.mark.parametrize("value,unit,target,expected", [
    (100.0, "[degF]", "kelvin", 310.92777777), (0.0, "degC", "kelvin", 273.15), (0.0, "K", "degC", -273.15),
    (10.0, "[kn_i]", "m/s", 5.14444444), (1.0, "gal_us", "L", 3.785411784), (2.0, "1", "dimensionless", 2.0),
    (0.0, "", "kelvin", None), (5.0, "", "kelvin", None), (5.0, "m", "kelvin", None), (5.0, "furlong", "m", None),
    (180.0, "deg", "rad", 3.14159265), (None, "K", "K", None),
])
def test_conversion(spark, value, unit, target, expected):
    row = spark.createDataFrame([(value, unit)], "v double, u string").select(to_unit(F.col("v"), F.col("u"), target)).first()
    assert row[0] == (None if expected is None else pytest.approx(expected, abs=1e-7))


def test_presence(spark):
    df = spark.createDataFrame([((0.0, ""),), ((0.0, "%"),), ((1.0, ""),), (None,)], "q struct<value:double,unit:string>")
    assert [r[0] is not None for r in df.select(quantity(F.col("q"))).collect()] == [False, True, True, False]
    units = spark.createDataFrame([("[degF]",), ("furlong",)], "u string")
    assert [r[0] for r in units.select(known_unit(F.col("u"))).collect()] == [True, False]


def test_frames_and_vectors(spark):
    q = "struct<value:double,unit:string>"
    ddl = f"p struct<ecef:struct<x:{q},y:{q},z:{q}>,wgs84:struct<lat:{q},lon:{q},alt:{q}>,local_enu:struct<east:{q},north:{q},up:{q}>>"
    df = spark.createDataFrame([
        ((None, ((1.0, "deg"), (2.0, "deg"), (0.0, "")), None),), ((None, None, None),),
    ], ddl).select(position(F.col("p")).alias("r")).collect()
    assert df[0].r.frame == "wgs84" and df[0].r.c1.value == 1.0 and df[0].r.c3 is None
    assert df[1].r is None
    v = spark.createDataFrame([((1.0, 2.0, 3.0, "[kn_i]"),), ((1.0, 2.0, 3.0, ""),)], "v struct<x:double,y:double,z:double,unit:string>")
    first, second = [r[0] for r in v.select(vector3(F.col("v"))).collect()]
    assert (first.y.value, first.y.unit, second) == (2.0, "knot", None)


def test_telemetry_round_trip(spark, tmp_path):
    """Parquet and JSON lines give the same events; broken lines are left out."""
    source = tv.telemetry(spark, "/root/testdata/sf0.001")
    typed = spark.createDataFrame([], TELEMETRY).unionByName(source.drop("ts", "seq"), allowMissingColumns=True)
    typed.write.parquet(str(tmp_path / "p"))
    stamps = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}
    lines = typed.select(F.to_json(F.struct("*"), stamps).alias("value"))
    lines.unionByName(spark.createDataFrame([("{broken",), ("",)], "value string")).write.text(str(tmp_path / "j"))
    parquet = readers.read_telemetry(spark, str(tmp_path / "p"))
    text = readers.read_telemetry(spark, str(tmp_path / "j"), fmt="json")
    fields = ("event_id", "asset.asset_id", "ts", "seq", F.round("kinematics.position.ecef.x.value", 6), F.size("sustainment.wear.components"))
    assert sorted(map(str, parquet.select(*fields).collect())) == sorted(map(str, text.select(*fields).collect()))
    assert text.count() == 1000


def test_json_sources(spark):
    def lines(*rows):
        return spark.createDataFrame([(r if isinstance(r, str) else json.dumps(r),) for r in rows], "value string")

    registry = readers.parse_registry(lines(
        {"asset_id": "a", "edge_id": "e", "region_id": "r"}, {"asset_id": "", "region_id": "r"},
        {"asset_id": "b", "region_id": ""}, "nope", {"asset_id": "c", "region_id": "r"},
    )).collect()
    assert [tuple(r) for r in registry] == [("a", "e", "r"), ("c", "", "r")]
    cm = readers.parse_cm_state(lines({"asset_id": "a", "overall_status": "3"}, {"asset_id": "b", "lifecycle": 2}, "{")).collect()
    assert [(r.asset_id, r.region_id, r.overall_status, r.lifecycle) for r in cm] == [("a", "", 3, 0), ("b", "", 0, 2)]
    events = readers.parse_cloud_events(lines(
        {"id": "1", "source": "d", "type": "t", "data": {"value": 1}}, {"id": "2", "source": "d", "type": "t", "data": "{bad"},
    )).collect()
    assert [(r.id, r.data) for r in events] == [("1", '{"value":1}')]


def test_read_edges(spark, tmp_path):
    for edge in ("e1", "e2"):
        spark.createDataFrame([(edge,)], "asset_id string").write.parquet(str(tmp_path / edge))
    out = readers.read_edges(spark, {e: str(tmp_path / e) for e in ("e1", "e2")}, "asset_id string")
    assert sorted(tuple(r) for r in out.collect()) == [("e1", "e1"), ("e2", "e2")]


def test_append_stream(spark, tmp_path):
    source = tv.events(spark, "/root/testdata/sf0.001")
    source.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(source.schema).parquet(str(tmp_path / "in")).filter("kind = 'error'")
    jobs.append_stream(stream, str(tmp_path / "out"), str(tmp_path / "c"), {"availableNow": True}).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == source.filter("kind = 'error'").count()
    assert latest_state(source).count() == 15


def test_an_unreadable_table_is_an_error(spark, tmp_path):
    assert BatchTable(str(tmp_path / "none")).read(spark) is None
    (tmp_path / "bad" / "batch_id=0").mkdir(parents=True)
    (tmp_path / "bad" / "batch_id=0" / "part-0.parquet").write_text("no parquet")
    with pytest.raises(Exception):
        BatchTable(str(tmp_path / "bad")).read(spark)
