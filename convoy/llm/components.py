"""Connected components of pairs that grow from round to round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from convoy.llm.common import cut


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node in ``edges`` (u, v); the label is the smallest node of the component.

    Alternates two steps until nothing changes: every node links its larger neighbours to its smallest neighbour, then
    every node links its smaller neighbours and itself to the smallest of them. Both are a minimum by key and a join,
    so a node with very many neighbours is summed up before the shuffle. The number of rounds is logarithmic.
    """
    current = cut(edges.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    state = _state(current)
    while state[0]:
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(lowest, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(lowest.withColumnRenamed("m", "v"))
        current = cut(small.filter("u != v").distinct())
        before, state = state, _state(current)
        if before == state:
            break
    return current.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(
        current.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def merge_labels(labels: DataFrame | None, edges: DataFrame) -> DataFrame:
    """``labels`` (node, label) after adding ``edges`` (u, v)."""
    if labels is None:
        return cut(connected_components(edges))
    known = labels.select(F.col("node").alias("u"), F.col("label").alias("v"))
    return cut(connected_components(edges.select("u", "v").unionByName(known)))
