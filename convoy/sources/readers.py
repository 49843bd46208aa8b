"""Sources: typed rows from parquet or JSON lines, in batch or as a stream.

Every reader adds ``ts`` (event time) and ``seq`` (tie-breaker); rows that cannot be parsed
are left out, as are rows without the key their consumers need.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from convoy import schemas
from convoy.functions.common import filled
from convoy.operators.regional import fan_in

_BAD = "_corrupt_record"


def parse_json(df: DataFrame, column: str, ddl: str, *keep: str) -> DataFrame:
    """Fields of a JSON column next to ``keep``; malformed text drops the row.

    The filter stands inside the array that is unfolded: as a filter of the rows it would be pushed below the parsed
    column, and every text, with what makes it, would be evaluated again for each of its conditions.
    """
    parsed = F.from_json(F.col(column), f"{ddl}, {_BAD} string", {"columnNameOfCorruptRecord": _BAD})
    well_formed = F.filter(F.array(parsed), lambda j: j.isNotNull() & j[_BAD].isNull())
    return df.select(*keep, F.inline(well_formed)).drop(_BAD)


def read_rows(spark: SparkSession, path: str, ddl: str, fmt: str = "parquet", stream: bool = False,
              **options: str) -> DataFrame:
    """Typed parquet (or ORC) as it is, or text lines parsed as JSON."""
    reader = (spark.readStream if stream else spark.read).options(**options)
    if fmt == "json":
        return parse_json(reader.format("text").load(path), "value", ddl)
    return reader.schema(ddl).format(fmt).load(path)


def _sequenced(df: DataFrame, ts: Column, *identity: Column) -> DataFrame:
    return df.withColumns({"ts": ts, "seq": F.xxhash64(*identity)})


def _telemetry(rows: DataFrame) -> DataFrame:
    """Event time from the sample, else from the message; rows without any keep a null time."""
    ts = F.coalesce("kinematics.position.valid_at", "provenance.sample_time", "provenance.ingest_time")
    return _sequenced(rows, ts, F.col("event_id"))


def parse_telemetry(df: DataFrame, column: str = "value", *keep: str) -> DataFrame:
    """Telemetry held as JSON text."""
    return _telemetry(parse_json(df, column, schemas.TELEMETRY, *keep))


def read_telemetry(spark: SparkSession, path: str, fmt: str = "parquet", stream: bool = False, **options) -> DataFrame:
    return _telemetry(read_rows(spark, path, schemas.TELEMETRY, fmt, stream, **options))


def read_cloud_events(spark: SparkSession, path: str, fmt: str = "json", stream: bool = False, **options) -> DataFrame:
    rows = read_rows(spark, path, schemas.CLOUD_EVENT, fmt, stream, **options)
    return _sequenced(rows.withColumn("device", F.col("source")), F.try_to_timestamp("time"), F.col("id"))


def parse_cloud_events(df: DataFrame, column: str = "value", *keep: str) -> DataFrame:
    """Cloud events held as JSON text; ``data`` stays JSON and must be valid."""
    events = parse_json(df, column, schemas.CLOUD_EVENT, *keep)
    return events.filter(F.try_parse_json("data").isNotNull())


def parse_registry(df: DataFrame, column: str = "value", *keep: str) -> DataFrame:
    """Registry changelog; rows without asset or region carry no usable mapping."""
    rows = parse_json(df, column, schemas.REGISTRY, *keep)
    return rows.filter(filled(F.col("asset_id")) & filled(F.col("region_id"))).withColumn(
        "edge_id", F.coalesce("edge_id", F.lit(""))
    )


def parse_cm_state(df: DataFrame, column: str = "value", *keep: str) -> DataFrame:
    """Configuration state; status and lifecycle default to 0."""
    text = "asset_id string, region_id string, edge_id string, overall_status string, lifecycle string"
    rows = parse_json(df, column, text, *keep)
    return rows.withColumns({
        **{c: F.coalesce(F.col(c).try_cast("int"), F.lit(0)) for c in ("overall_status", "lifecycle")},
        **{c: F.coalesce(F.col(c), F.lit("")) for c in ("asset_id", "region_id", "edge_id")},
    })


def parse_logistics(df: DataFrame, column: str = "value", *keep: str) -> DataFrame:
    return parse_json(df, column, schemas.LOGISTICS, *keep)


def read_edges(spark: SparkSession, paths: dict[str, str], ddl: str, fmt: str = "parquet",
               stream: bool = False) -> DataFrame:
    """One source per edge, stacked, tagged with the edge it came from."""
    return fan_in(*[
        read_rows(spark, path, ddl, fmt, stream).withColumn("source_edge_id", F.lit(edge))
        for edge, path in paths.items()
    ])
