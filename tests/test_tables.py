"""Keyed tables, newest rows and drop accounting."""

import json
import random

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from convoy.functions.newest import newest_rows
from convoy.operators import alerts, regional
from convoy.plans import testviews as tv
from convoy.sources import quality, tables
from convoy.sources.tables import BatchTable, KeyedTable, Notes

SF = "/root/testdata/sf0.001"


def _rows(spark, *rows):
    return spark.createDataFrame(list(rows), "id string, v int, seq long")


def _held(df):
    return sorted((r.id, r.v) for r in df.collect())


def test_newest_row_wins(spark, tmp_path):
    table = KeyedTable(str(tmp_path / "t"), ("id",), ("seq",), buckets=4)
    assert table.current(spark) is None and table.of_keys(_rows(spark, ("a", 1, 1))) is None
    table.merge(_rows(spark, ("a", 1, 1), ("a", 2, 2)))
    table.merge(_rows(spark, ("b", 5, 1), ("a", 9, 0)))
    assert _held(table.current(spark)) == [("a", 2), ("b", 5)]
    assert _held(table.of_keys(_rows(spark, ("b", 0, 0), ("b", 0, 0), ("z", 0, 0)))) == [("b", 5)]
    table.merge(_rows(spark))
    assert _held(table.current(spark)) == [("a", 2), ("b", 5)]


def test_first_row_stays_without_an_order(spark, tmp_path):
    table = KeyedTable(str(tmp_path / "t"), ("id",), buckets=4)
    for batch in ([("a", 1, 1)], [("a", 2, 2), ("b", 2, 2)], [("a", 2, 2), ("b", 2, 2)], [("c", 3, 1)], [("b", 7, 7)]):
        table.merge(_rows(spark, *batch))
    assert _held(table.current(spark)) == [("a", 1), ("b", 2), ("c", 3)]


@pytest.mark.parametrize("order", [("seq",), ()])
def test_retries_and_restarts_change_nothing(spark, tmp_path, order):
    """Batches that come again, in whatever number, and failures before the manifest is replaced."""
    batches = [[(f"k{i % 7}", n * 10 + i, n) for i in range(n, n + 3)] for n in range(6)]
    plain = KeyedTable(str(tmp_path / "plain"), ("id",), order, buckets=4, max_changes=2)
    again = KeyedTable(str(tmp_path / "again"), ("id",), order, buckets=4, max_changes=2)
    for batch in batches:
        plain.merge(_rows(spark, *batch))
    commit = KeyedTable._commit

    for number, batch in enumerate(batches):
        if number % 2:
            def fail(self, spark, manifest):
                raise RuntimeError("before the manifest")

            KeyedTable._commit = fail
            try:
                with pytest.raises(RuntimeError):
                    again.merge(_rows(spark, *batch))
            finally:
                KeyedTable._commit = commit
        again.merge(_rows(spark, *batch))
        again.merge(_rows(spark, *batch))
    assert _held(again.current(spark)) == _held(plain.current(spark))
    before = set(tables._Files(spark, again.path).names())
    again.vacuum(spark)
    assert set(tables._Files(spark, again.path).names()) < before
    assert _held(again.current(spark)) == _held(plain.current(spark))


def test_a_batch_touches_its_buckets_only(spark, tmp_path):
    table = KeyedTable(str(tmp_path / "t"), ("id",), ("seq",), buckets=16, max_changes=3)
    table.merge(_rows(spark, *[(f"k{i}", i, 0) for i in range(200)]))

    def manifest():
        return json.loads((tmp_path / "t" / "manifest.json").read_text())

    first = manifest()["changes"]
    assert len(first) == 16
    table.merge(_rows(spark, ("k1", 1, 1), ("k2", 2, 1)))
    changed = {b for b, files in manifest()["changes"].items() if files != first[b]}
    assert 1 <= len(changed) <= 2
    written = [p for p in (tmp_path / "t").glob("change-*/_bucket=*") if p.parent.name not in first["0"]]
    assert {p.name.split("=")[1] for p in written} == changed
    # Looking up two keys reads two buckets at most: the first file of each, and one change.
    assert len(table.of_keys(_rows(spark, ("k1", 0, 0), ("k2", 0, 0))).inputFiles()) <= 4
    assert len(table.current(spark).inputFiles()) == 16 + len(changed)
    for n in range(2, 9):
        table.merge(_rows(spark, ("k1", n, n)))
    assert max(map(len, manifest()["changes"].values())) <= 3
    folders = {p.name for p in (tmp_path / "t").glob("change-*")}
    named = {c for changes in manifest()["changes"].values() for c in changes} | set(manifest()["unused"])
    assert folders == named
    assert (("k1", 8) in _held(table.current(spark))) and table.current(spark).count() == 200


def test_notes(spark, tmp_path):
    notes = Notes(spark, str(tmp_path / "n"))
    assert notes.last("a") == -1
    notes.put("a", 0)
    notes.put("b", 7)
    notes.put("a", 3)
    assert (notes.last("a"), notes.last("b")) == (3, 7)


def test_append_tables(spark, tmp_path):
    table = BatchTable(str(tmp_path / "log"))
    assert table.read(spark) is None
    table.append()(_rows(spark, ("a", 1, 1)), 0)
    for _ in range(2):
        table.append()(_rows(spark, ("b", 2, 2)), 1)
    assert _held(table.read(spark)) == [("a", 1), ("b", 2)]
    assert _held(table.read(spark, before=1)) == [("a", 1)]


def test_newest_rows_against_plain_python(spark):
    rng = random.Random(4)
    rows = [(rng.choice(["a", "b", None, "c" * 40]), rng.choice([None, -5, 0, 3, 10**15]), rng.choice([None, -(2**62), 7, 2**62]), str(rng.random())) for _ in range(300)]
    rows += rows[:50]
    df = spark.createDataFrame(rows, "k string, us long, seq long, note string").withColumn("ts", F.timestamp_micros("us"))

    def order(r):
        return tuple((v is not None, v or 0) for v in r[1:3])

    for oldest in (False, True):
        found = newest_rows(df.select("k", "ts", "seq", "note", "us"), ("k",), ("ts", "seq"), oldest).collect()
        best = {k: (min if oldest else max)(order(r) for r in rows if r[0] == k) for k in {r[0] for r in rows}}
        assert {r.k: order((r.k, r.us, r.seq)) for r in found} == best and len(found) == len(best)
        assert all((r.k, r.us, r.seq, r.note) in set(rows) for r in found)
    with_map = df.withColumn("m", F.create_map("note", "us"))
    assert newest_rows(with_map, ("k",), ("us",)).count() == 4
    with pytest.raises(TypeError):
        newest_rows(df, ("k",), ("note",))


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_row_is_sorted_before_it_is_reduced(spark):
    envelopes, events = tv.envelopes(spark, SF), tv.events(spark, SF)
    plans = {
        "latest_state": regional.latest_state(events), "registry_latest": regional.registry_latest(tv.registry(spark, SF)),
        "alerts": alerts.project_alerts(tv.alert_events(spark, SF), order=("ts", "seq")),
        "latest_by_asset": regional.latest_by_asset(envelopes), "wear_latest": regional.wear_latest(envelopes),
    }
    for name, df in plans.items():
        assert "SortAggregate" not in _plan(df), name


def test_drops_are_counted_in_batch(spark):
    texts = ['{"asset_id":"a","edge_id":"e","region_id":"r"}', "broken", '{"asset_id":"","region_id":"r"}', '{"asset_id":"b"}', None]
    checked = quality.check_registry(spark.createDataFrame([(t,) for t in texts], "value string"))
    seen = Observation("registry")
    used = quality.fields_of(quality.used(quality.accounted(checked, "registry", quality.REGISTRY_REASONS, seen)))
    assert used.count() == 1
    assert seen.get == {"rows_in": 5, "malformed": 2, "blank_asset": 1, "blank_region": 1}
    left_out = {(r.reason, r.raw) for r in quality.quarantined(checked, "registry").collect()}
    assert left_out == {("malformed", "broken"), ("malformed", None), ("blank_asset", texts[2]), ("blank_region", texts[3])}


def test_telemetry_and_cloud_events_are_checked(spark):
    telemetry = ['{"event_id":"1","asset":{"asset_id":"a"}}', '{"event_id":"2","asset":{"asset_id":""}}', '{"event_id":"3"}', "{"]
    rows = quality.check_telemetry(spark.createDataFrame([(t,) for t in telemetry], "value string")).collect()
    assert [r._reason for r in rows] == [None, "blank_asset", "blank_asset", "malformed"]
    events = ['{"id":"1","source":"d","data":"{}"}', '{"id":"1","source":"d","data":"{"}', '{"id":"1","source":"","data":"{}"}', "x"]
    rows = quality.check_cloud_events(spark.createDataFrame([(t,) for t in events], "value string")).collect()
    assert [r._reason for r in rows] == [None, "malformed_data", "blank_device", "malformed"]
