"""Sharding: a Feistel permutation over global row numbers, so that shard and slot of a row can be computed.

Rows are numbered without gaps in the order of a hash bucket, then id, size, checksum and the other columns. Numbers
come from two levels: rows of a bucket are numbered inside it, and buckets start where the earlier ones end. The bucket
is a function of the row, so the numbers do not depend on how the input was partitioned, and a lost executor cannot
change them. Equal rows are counted before they are shuffled. A keyed Feistel network permutes the smallest square
that holds all numbers; a number that lands outside is sent through again until it falls inside (cycle walking), which
makes it a permutation of the rows. Position p goes to shard ``p mod n`` and slot ``p div n``: counts of shards
differ by one at most, and slots have no gaps. ``rows`` is the law that holds.

Defined results: very long texts are measured whole and not read by Python; a null text has size 16 and checksum 0; null ids are rows like others; equal rows get a position
each; an empty table gives an empty table. Other columns are carried through; columns of the names in ``COLUMNS`` are
replaced.
"""

from __future__ import annotations

from math import ceil, isqrt

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from convoy.llm.common import identity, shelter

SHARDS = 40
SEED = 20_240_607
ROUNDS = 6
#: Rows that one bucket of the numbering holds on average.
BUCKET_ROWS = 5_000
OVERHEAD_BYTES = 16
COLUMNS = ("size", "text_crc32", "position", "law", "shard", "slot", "grown_shard")

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def permute(numbers: np.ndarray, n: int, seed: int = SEED, rounds: int = ROUNDS) -> np.ndarray:
    """A permutation of 0 to n - 1, applied to an array of such numbers."""
    side = np.uint64(max(1, isqrt(max(0, n - 1)) + 1))
    out = np.asarray(numbers).astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] // side, out[todo] % side
        for k in range(rounds):
            key = np.uint64((seed + 0x9E3779B97F4A7C15 * (k + 1)) % 2**64)
            left, right = right, (left + _mix(right ^ key)) % side
        out[todo] = left * side + right
        todo = todo[out[todo] >= np.uint64(n)]
    return out.astype(np.int64)


def unpermute(positions: np.ndarray, n: int, seed: int = SEED, rounds: int = ROUNDS) -> np.ndarray:
    """The row number at each position: the inverse of ``permute``."""
    side = np.uint64(max(1, isqrt(max(0, n - 1)) + 1))
    out = np.asarray(positions).astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] // side, out[todo] % side
        for k in reversed(range(rounds)):
            key = np.uint64((seed + 0x9E3779B97F4A7C15 * (k + 1)) % 2**64)
            left, right = (right + side - _mix(left ^ key) % side) % side, left
        out[todo] = left * side + right
        todo = todo[out[todo] >= np.uint64(n)]
    return out.astype(np.int64)


def measured(documents: DataFrame) -> DataFrame:
    """Size and checksum in place of the text, for callers that do not need the text behind the shuffle."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return documents.drop("size", "text_crc32").withColumns({
        "size": (F.octet_length(text) + OVERHEAD_BYTES).cast("long"), "text_crc32": F.crc32(text.cast("binary")),
    }).drop("text")


def assign_shards(documents: DataFrame, shards: int = SHARDS, seed: int = SEED, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``documents`` with position, law, shard, slot and grown_shard, and size and checksum of a column ``text``."""
    plain, held, back = shelter(documents, COLUMNS if "text" in documents.columns else COLUMNS[2:])
    sized, added = plain, []
    if "text" in plain.columns:
        sized = measured(plain.withColumn("_text", F.col("text"))).withColumnRenamed("_text", "text")
        added = ["size", "text_crc32"]
    copies = sized.groupBy(*[f"`{c}`" for c in sized.columns]).agg(F.count(F.lit(1)).alias("_copies"))
    total = plain.count()
    n_buckets = max(1, ceil(total / bucket_rows))
    content = [identity(sized, c) for c in sized.columns if c != "text"]
    in_bucket = F.pmod(F.xxhash64(*content), F.lit(n_buckets))
    starts = (
        sized.groupBy(in_bucket.alias("_bucket")).agg(F.count(F.lit(1)).alias("_in_bucket"))
        .withColumn("_start", F.sum("_in_bucket").over(Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)))
        .select(F.col("_bucket").alias("_of"), F.coalesce("_start", F.lit(0)).alias("_start"))
    )
    rows = copies.withColumn("_bucket", in_bucket)
    order = [*content, *(["text"] if "text" in plain.columns else [])]
    before = Window.partitionBy("_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    numbered = (
        rows.withColumn("_before", F.coalesce(F.sum("_copies").over(before), F.lit(0)))
        .join(starts, F.col("_bucket") == F.col("_of"))
        .withColumn("_copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_copies") - 1)))
        .withColumn("_number", F.col("_start") + F.col("_before") + F.col("_copy"))
    )

    @F.pandas_udf("long")
    def position(numbers: pd.Series) -> pd.Series:
        return pd.Series(permute(numbers.to_numpy(), total, seed))

    return (
        numbered.withColumn("position", position("_number"))
        .select(
            *back, *added, "position", F.lit("rows").alias("law"),
            F.pmod("position", F.lit(shards)).cast("int").alias("shard"),
            F.floor(F.col("position") / F.lit(shards)).cast("long").alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
        )
    )
