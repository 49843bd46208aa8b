"""JSON columns are parsed once per row, whatever the filter on malformed text asks."""

from convoy.sources import readers


def test_text_is_parsed_once(spark):
    lines = spark.createDataFrame([(1, '{"asset_id":"a","edge_id":"e","region_id":"r"}'), (2, "not json"), (3, None), (4, '{"asset_id":"b"}')], "seq long, value string")
    parsed = readers.parse_json(lines, "value", "asset_id string, edge_id string, region_id string", "seq")
    plan = parsed._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1
    assert sorted(map(tuple, parsed.collect())) == [(1, "a", "e", "r"), (4, "b", None, None)]
