"""The newest row of every key without sorting rows.

A maximum of whole rows makes Spark sort its input. Here the order of a row is one fixed-width number, whose maximum per
key is a hash aggregate over two or three columns of the scan; the rows that have it come back by one join, which is a
broadcast where keys are few.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, DateType, IntegerType, LongType, MapType, ShortType, TimestampNTZType, TimestampType

_WHOLE = (ByteType, ShortType, IntegerType, LongType)
_TIMES = (TimestampType, TimestampNTZType, DateType)
#: 2**64, and bounds for the leading part so that the number has 38 digits at most.
_STEP = "18446744073709551616"
_LEAST, _MOST = -4_000_000_000_000_000_000, 4_000_000_000_000_000_000


def _whole(df: DataFrame, name: str) -> Column:
    kind = df.select(name).schema[0].dataType
    if isinstance(kind, _TIMES):
        return F.unix_micros(F.col(name).cast("timestamp"))
    if isinstance(kind, _WHOLE):
        return F.col(name).cast("long")
    raise TypeError(f"{name} must be a time or a whole number to order rows, not {kind.simpleString()}")


def order_number(df: DataFrame, order: tuple[str, ...]) -> Column:
    """One number that grows with ``order``, one or two columns; nulls come first."""
    if len(order) == 1:
        return F.coalesce(_whole(df, order[0]), F.lit(-(2**63)))
    first, second = (_whole(df, name) for name in order)
    lead = F.greatest(F.lit(_LEAST), F.least(F.lit(_MOST), F.coalesce(first, F.lit(_LEAST))))
    rest = F.coalesce(second, F.lit(-(2**63))).cast("decimal(19,0)") + F.lit("9223372036854775808").cast("decimal(19,0)")
    return (lead.cast("decimal(19,0)") * F.lit(_STEP).cast("decimal(20,0)") + rest).cast("decimal(38,0)")


def newest_rows(df: DataFrame, keys, order, oldest: bool = False) -> DataFrame:
    """One row per key, that of the greatest ``order`` (or the smallest), with the columns of ``df``.

    Null keys are keys like others. Rows that tie are told apart by a hash of their content; equal rows count as one.
    """
    keys, order = tuple(keys), tuple(order)
    best = F.min if oldest else F.max
    top = df.groupBy(*[F.col(k).alias(f"_of_{k}") for k in keys]).agg(best(order_number(df, order)).alias("_top"))
    at = order_number(df, order) == F.col("_top")
    for k in keys:
        at = at & F.col(k).eqNullSafe(F.col(f"_of_{k}"))
    found = df.join(top, at, "inner").select(*df.columns)
    # One row per key but for ties, of which equal ones are summed up before the shuffle.
    if not any(isinstance(f.dataType, MapType) or "map<" in f.dataType.simpleString() for f in df.schema):
        found = found.distinct()
    earlier = Window.partitionBy(*keys).orderBy(F.xxhash64(F.to_json(F.struct("*")))).rowsBetween(Window.unboundedPreceding, -1)
    return found.withColumn("_earlier", F.count(F.lit(1)).over(earlier)).filter("_earlier = 0").drop("_earlier")
