"""Running aggregates over ordered groups that stay parallel when a group is hot.

``Window.partitionBy(key)`` puts every row of a key in one task. When one key may hold a
third of the data that task never ends, so groups above a row limit are range-split into
chunks by ``(key, order)``; each chunk is evaluated on its own and then shifted by what the
earlier chunks of the same key hold. What a chunk holds is a plain aggregate of its rows,
taken behind the one exchange that the windows use too; the prefix over chunks is a table
with at most one row per chunk. Without hot groups the plan is one plain window: one
exchange, one sort.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from convoy.session import ensure_checkpoint_dir

HOT_ROWS_CONF = "spark.convoy.hotGroupRows"
HOT_ROWS_DEFAULT = 10_000_000
#: Rows that one task is dealt on average. Adaptive execution joins small partitions by their compressed bytes, not by what
#: the sorts of a stage hold, and so gives each task a fixed share of the table, however large that is.
TASK_ROWS = 100_000

_CHUNK = "_chunk"
_RANK = "_chunk_rank"


@dataclass(frozen=True)
class Running:
    """One running aggregate from the start of the group up to (or before) each row."""

    kind: str
    value: Column
    inclusive: bool = True

    def aggregate(self, value: Column) -> Column:
        if self.kind == "sum":
            return F.sum(value)
        if self.kind == "max":
            return F.max(value)
        if self.kind == "first":
            return F.first(value, ignorenulls=True)
        if self.kind == "set":
            return F.collect_set(value)
        return F.last(value, ignorenulls=True)

    def whole(self) -> Column:
        """The value over all rows of a chunk; ranks give the order."""
        if self.kind == "first":
            return F.min_by(self.value, F.when(self.value.isNotNull(), F.col(_RANK)))
        if self.kind == "last":
            return F.max_by(self.value, F.when(self.value.isNotNull(), F.col(_RANK)))
        return self.finish(self.aggregate(self.value))

    def finish(self, local: Column) -> Column:
        if self.kind == "set":
            return F.array_distinct(F.flatten(local))
        return F.coalesce(local, F.lit(0)) if self.kind == "sum" else local

    def combine(self, carried: Column, local: Column) -> Column:
        if self.kind == "sum":
            return F.coalesce(carried, F.lit(0)) + F.coalesce(local, F.lit(0))
        if self.kind == "max":
            return F.greatest(carried, local)
        if self.kind == "first":
            return F.coalesce(carried, local)
        if self.kind == "set":
            return F.array_union(F.coalesce(carried, local), F.coalesce(local, carried))
        return F.coalesce(local, carried)


def running_sum(value, inclusive: bool = True) -> Running:
    return Running("sum", _column(value), inclusive)


def running_count(condition=None) -> Running:
    flag = F.lit(1) if condition is None else F.when(condition, 1).otherwise(0)
    return Running("sum", flag.cast("long"))


def running_max(value) -> Running:
    return Running("max", _column(value))


def running_set(values) -> Running:
    """Distinct entries of the arrays so far; for vocabularies that stay short."""
    return Running("set", _column(values))


def first_value(value) -> Running:
    return Running("first", _column(value))


def last_value(value, inclusive: bool = True) -> Running:
    """Last non-null value; ``inclusive=False`` looks only at earlier rows."""
    return Running("last", _column(value), inclusive)


def previous_row(**fields) -> Running:
    """Struct of the named expressions on the row before; null on the first row."""
    packed = F.struct(*[_column(v).alias(k) for k, v in fields.items()])
    return Running("last", packed, inclusive=False)


def _column(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


@dataclass(frozen=True)
class OrderedGroups:
    """A DataFrame with group keys and a total order inside each group."""

    df: DataFrame
    keys: tuple[str, ...]
    order: tuple[Column, ...]
    split: bool = False

    def with_running(self, **specs: Running) -> "OrderedGroups":
        groups = [*self.keys, _CHUNK] if self.split else list(self.keys)
        base = Window.partitionBy(*groups).orderBy(*self.order)
        upto = base.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        before = base.rowsBetween(Window.unboundedPreceding, -1)
        local = {
            name: spec.aggregate(spec.value).over(upto if spec.inclusive else before)
            for name, spec in specs.items()
        }
        if not self.split:
            return self._with({n: specs[n].finish(c) for n, c in local.items()})

        earlier = (
            Window.partitionBy(*self.keys).orderBy(_CHUNK)
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        carried = (
            self.df.filter(F.col(_CHUNK) > 0).groupBy(*self.keys, _CHUNK)
            .agg(*[s.whole().alias(f"_end_{n}") for n, s in specs.items()])
            .select(*self.keys, _CHUNK, *[
                s.finish(s.aggregate(F.col(f"_end_{n}")).over(earlier)).alias(f"_carry_{n}") for n, s in specs.items()
            ])
        )
        local = {n: specs[n].finish(c) for n, c in local.items()}
        joined = self.df.withColumns(local).join(carried, [*self.keys, _CHUNK], "left")
        merged = joined.withColumns({
            n: s.combine(F.col(f"_carry_{n}"), F.col(n)) for n, s in specs.items()
        })
        return replace(self, df=merged.drop(*[f"_carry_{n}" for n in specs]))

    def with_columns(self, **columns: Column) -> "OrderedGroups":
        return self._with(columns)

    def _with(self, columns: dict[str, Column]) -> "OrderedGroups":
        return replace(self, df=self.df.withColumns(columns))

    def apply(self, change: Callable[[DataFrame], DataFrame], *order: Column) -> "OrderedGroups":
        """The same groups after ``change``, which must keep keys and rows; ``order`` may
        restate the order in other columns that sort alike."""
        return replace(self, df=change(self.df), order=order or self.order)

    def result(self) -> DataFrame:
        return self.df.drop(_CHUNK, _RANK)


def dealt(df: DataFrame, keys, rows: int) -> DataFrame:
    """``df`` dealt out by ``keys`` to as many tasks as ``rows`` rows need; left to Spark where its cores are enough."""
    tasks = ceil(rows / TASK_ROWS)
    return df.repartition(tasks, *keys) if tasks > df.sparkSession.sparkContext.defaultParallelism else df


def hot_limit(spark: SparkSession, hot_rows: int | None = None) -> int:
    """Rows above which a group is split."""
    return hot_rows or int(spark.conf.get(HOT_ROWS_CONF, str(HOT_ROWS_DEFAULT)))


def largest_group(df: DataFrame, *keys: Column) -> int:
    """Rows of the largest group; reads no more than the keys."""
    return df.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0


def ordered_groups(df: DataFrame, keys, order, hot_rows: int | None = None, bound: int | None = None,
                   deal: bool = True) -> OrderedGroups:
    """Wrap ``df``; groups above ``hot_rows`` rows are split into chunks.

    ``bound`` is a number of rows that no group exceeds, for instance the rows of the file all of it comes from, which
    parquet knows without a scan. Without it the rows of ``df`` are counted, which runs all that stands before it. The
    number of tasks grows with it, unless ``deal`` says that ``df`` is dealt out by some of the keys already.
    """
    keys = (keys,) if isinstance(keys, str) else tuple(keys)
    order = tuple(_column(c) for c in order)
    spark = df.sparkSession
    limit = hot_limit(spark, hot_rows)
    if df.isStreaming:
        return OrderedGroups(df, keys, order)

    def plain(rows: int) -> OrderedGroups:
        return OrderedGroups(dealt(df, keys, rows) if deal else df, keys, order)

    if bound is not None and bound <= limit:
        return plain(bound)
    # No group is larger than the whole, and counting the whole needs no shuffle.
    if (rows := df.count()) <= limit:
        return plain(rows)

    # At most total_rows / limit keys pass the filter, so this collect is bounded.
    hot = df.groupBy(*keys).count().filter(F.col("count") > limit).collect()
    if not hot:
        return plain(rows)
    schema = df.select(*keys).schema
    hot_keys = spark.createDataFrame([tuple(r[k] for k in keys) for r in hot], schema)
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    chunks = max(2, ceil(2 * sum(r["count"] for r in hot) / limit))
    ensure_checkpoint_dir(spark)
    # Chunk and rank must be the same wherever they are read, hence the checkpoint. Ranks grow
    # with the order: partitions are ranges of it, and rows are sorted inside them.
    split = (
        df.join(hot_keys, list(keys), "left_semi")
        .repartitionByRange(chunks, *keys, *order).sortWithinPartitions(*keys, *order)
        .withColumns({_CHUNK: F.spark_partition_id() + 1, _RANK: F.monotonically_increasing_id()})
        .checkpoint()
    )
    cold = df.join(hot_keys, list(keys), "left_anti").withColumns({_CHUNK: F.lit(0), _RANK: F.lit(0).cast("long")})
    # One exchange for the windows, the chunk aggregates and the joins of all levels.
    together = cold.unionByName(split).repartition(max(partitions, ceil(rows / TASK_ROWS)), *keys, _CHUNK)
    return OrderedGroups(together, keys, order, split=True)
