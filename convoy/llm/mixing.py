"""Mixing sources to target weights by weighted fair queueing.

Sources in code point order, null last, weigh 5, 2, 1, repeating. Together they may take ``share`` times the words of
all documents; a target stops at ``epochs`` times its source's words, and what it cannot take is dealt anew by weight.
Every document waits ``epochs`` times in the queue of its source, in the order of a hash of its id. The virtual finish
time of a copy is the words of its source up to and with it, divided by the source's target. The mix is the copies in
order of finish time (then source, then place in the queue) as long as their words sum to at most the budget.

Only DataFrame operations are used. Running sums have two levels, so no source and no stretch of the global order has
to fit one task: rows fall into buckets by hash, as many for a source as its rows ask for, and buckets start where the
earlier ones end. The global order needs exact places only in the one range of finish times where the budget ends;
ranges before it are in, later ones out.

Defined results: documents without words (null or empty texts) have size 0 and take nothing; a null source is a source
of its own; rows with a null id are placed by checksum and length of their text; rows with equal ids stand together,
ordered by checksum and size, equal rows one after another; very long texts are only counted; an empty table gives an empty table. Other columns are carried through; columns of the names in ``COLUMNS`` are
replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from convoy.llm.common import WORD_PATTERN, cut, shelter

#: The weights of sources in code point order, repeating.
WEIGHTS = (5, 2, 1)
SHARE = 1.5
EPOCHS = 2
#: Rows that one bucket of a source, and one range of finish times, holds on average.
BUCKET_ROWS = 5_000
COLUMNS = ("size", "source_size", "target", "copies", "taken", "first_finish")

_HASH_DIGITS = 7  # hexadecimal digits of md5 that choose the bucket


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, share: float = SHARE, epochs: int = EPOCHS) -> DataFrame:
    """Target words of each source. ``sizes``: one row per source with ``_source`` and ``source_size``.

    The water level: sources are ordered by cap over weight; from the first one whose cap is not reached at the level
    that the rest of the budget allows, all targets are level times weight, the ones before it stop at their caps.
    The table has a row per source, so windows without a partition are small.
    """
    by_name = Window.orderBy(F.col("_source").isNull(), "_source")
    place = F.row_number().over(by_name)
    weight = F.element_at(F.array(*[F.lit(w).cast("double") for w in WEIGHTS]), (F.pmod(place - 1, F.lit(len(WEIGHTS))) + 1).cast("int"))
    by_level = Window.orderBy("_level_at_cap", "_place")
    earlier = by_level.rowsBetween(Window.unboundedPreceding, -1)
    later = by_level.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    return (
        sizes.withColumn("_place", place).withColumn("_weight", weight)
        .withColumn("_cap", F.col("source_size").cast("double") * epochs)
        .withColumn("_level_at_cap", F.col("_cap") / F.col("_weight"))
        .withColumn("_budget", F.sum(F.col("source_size").cast("double")).over(everything) * share)
        .withColumn("_level", (F.col("_budget") - F.coalesce(F.sum("_cap").over(earlier), F.lit(0.0))) / F.sum("_weight").over(later))
        .withColumn("_water", F.min(F.when(F.col("_level") <= F.col("_level_at_cap"), F.struct("_level_at_cap", "_place", "_level"))).over(everything)["_level"])
        .withColumn("target", F.when(F.col("_water").isNull(), F.col("_cap")).otherwise(F.least("_cap", F.col("_water") * F.col("_weight"))))
        .select("_source", "source_size", "target", "_place", "_budget")
    )


def mix(documents: DataFrame, share: float = SHARE, epochs: int = EPOCHS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``documents`` with size, source_size, target, copies (0 to ``epochs``), taken and first_finish."""
    plain, held, back = shelter(documents, COLUMNS)
    check = F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    # Rows without an id are spread by what they hold; they must not share one place of the queue.
    name = F.coalesce(F.col("doc_id").cast("string"), F.concat_ws(":", F.lit("no id"), check, F.length("text")))
    sized = plain.select(
        *[f"`{c}`" for c in held], words(F.col("text")).alias("size"), F.col("source").alias("_source"),
        F.md5(name.cast("binary")).alias("_hash"), check.alias("_check"),
    )
    narrow = cut(sized.select("_source", "_hash", "_check", "size"))
    totals = cut(source_targets(narrow.groupBy("_source").agg(F.sum("size").alias("source_size")), share, epochs))
    rows_of = narrow.groupBy("_source").agg(F.count(F.lit(1)).alias("_rows"))
    n_buckets = F.greatest(F.lit(1), F.ceil(F.col("_rows") / F.lit(bucket_rows))).cast("long")
    sources = cut(
        totals.join(rows_of.withColumnRenamed("_source", "_s"), F.col("_source").eqNullSafe(F.col("_s"))).drop("_s")
        .withColumn("_buckets", n_buckets)
    )
    total_rows = narrow.count()
    placed = _in_buckets(narrow, sources)
    starts = cut(_bucket_starts(placed))
    last = _last_taken(_queued(placed, starts), epochs, max(1, total_rows * epochs // bucket_rows)).first()  # one row
    return (
        _queued(_in_buckets(sized, sources), starts)
        .withColumn("copies", sum((F.when(_taken(k, last[0]), 1).otherwise(0) for k in range(epochs)), F.lit(0)))
        .withColumn("taken", F.col("copies") * F.col("size"))
        .withColumn("first_finish", _finish(0))
        .select(*back, *COLUMNS)
    )


def expand_copies(mixed: DataFrame) -> DataFrame:
    """A row for each copy that the mix takes, without the columns that ``mix`` added."""
    copies = mixed.filter(F.col("copies") > 0)
    return copies.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).drop("_copy", *COLUMNS)


def _in_buckets(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """``rows`` with the columns of their source (a row of ``sources``) and the bucket of its queue."""
    of = sources.withColumnRenamed("_source", "_s")
    number = F.conv(F.substring("_hash", 1, _HASH_DIGITS), 16, 10).cast("long")
    return (
        rows.join(F.broadcast(of) if _few(sources) else of, F.col("_source").eqNullSafe(F.col("_s"))).drop("_s")
        .withColumn("_bucket", F.floor(number * F.col("_buckets") / F.lit(16**_HASH_DIGITS)).cast("long"))
    )


def _bucket_starts(placed: DataFrame) -> DataFrame:
    """Words of a source's queue before each of its buckets."""
    in_source = Window.partitionBy("_p").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    return (
        placed.groupBy(F.col("_place").alias("_p"), F.col("_bucket").alias("_b")).agg(F.sum("size").alias("_words"))
        .withColumn("_start", F.coalesce(F.sum("_words").over(in_source), F.lit(0))).drop("_words")
    )


def _queued(placed: DataFrame, starts: DataFrame) -> DataFrame:
    """``placed`` with the words of the source's queue up to and with the row (``_upto``)."""
    in_bucket = Window.partitionBy("_place", "_bucket").orderBy("_hash", "_check", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        placed.withColumn("_inside", F.sum("size").over(in_bucket))
        .join(starts, (F.col("_place") == F.col("_p")) & (F.col("_bucket") == F.col("_b")))
        .withColumn("_upto", F.col("_start") + F.col("_inside")).drop("_p", "_b", "_inside", "_start")
    )


def _few(sources: DataFrame, most: int = 10_000) -> bool:
    """Whether the table of sources is proven small enough to be sent to every executor."""
    return sources.limit(most + 1).count() <= most


def _finish(k: int) -> Column:
    """Virtual finish time of the copy in epoch ``k``; null where the row takes no part."""
    upto = F.col("_upto") + F.lit(k) * F.col("source_size")
    return F.when((F.col("size") > 0) & (F.col("target") > 0), upto.cast("double") / F.col("target"))


def _taken(k: int, last) -> Column:
    """Whether the copy stands before or at the last one taken (finish time, place of its source), if any is taken."""
    if last is None:
        return F.lit(False)
    finish = _finish(k)
    before = (finish < last["_finish"]) | (finish == last["_finish"]) & (F.col("_place") <= last["_place"])
    return F.coalesce(before, F.lit(False))


def _last_taken(queued: DataFrame, epochs: int, ranges: int) -> DataFrame:
    """The finish time and source place of the last copy within the budget: one row, its struct null if there is none.

    Words flow evenly over finish times (the targets' sum per unit), so equal ranges of finish time hold about equal
    work. Places inside a source differ as long as sizes are above 0, so (finish, source) is a total order.
    """
    finish = F.array(*[F.struct(_finish(k).alias("_finish")) for k in range(epochs)])
    copies = cut(
        queued.filter((F.col("size") > 0) & (F.col("target") > 0))
        .select("size", "_place", "_budget", F.explode(finish).alias("_f"))
        .select("size", "_place", "_budget", F.col("_f._finish").alias("_finish"))
        .withColumn("_range", F.floor(F.col("_finish") * F.lit(ranges)).cast("long"))
    )
    upto = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sums = (
        copies.groupBy("_range").agg(F.sum("size").alias("_words"), F.first("_budget").alias("_b"))
        .withColumn("_before", F.coalesce(F.sum("_words").over(upto), F.lit(0)))
    )
    # The last range in which a copy can still be taken; its start is where the running sum inside it begins.
    crossing = cut(sums.filter(F.col("_before") < F.col("_b")).orderBy(F.desc("_range")).limit(2)).select(F.col("_range").alias("_r"), "_before")
    inside = Window.partitionBy("_range").orderBy("_finish", "_place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        copies.join(F.broadcast(crossing), F.col("_range") == F.col("_r"))
        .withColumn("_sum", F.col("_before") + F.sum("size").over(inside))
        .filter(F.col("_sum") <= F.col("_budget"))
        .agg(F.max(F.struct("_finish", "_place")).alias("_last"))
    )
