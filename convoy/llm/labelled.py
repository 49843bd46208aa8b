"""A bounded, reproducible matrix of labelled documents for fitting models on the driver."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from convoy.llm.common import bounded_sample, held_out, small_batches
from convoy.llm.doc_stats import FEATURES, statistics

#: So many labelled documents are used for fitting at most; hashes of their ids choose them.
MAX_TRAINING_ROWS = 20_000


def training_matrix(documents: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAINING_ROWS):
    """(features, labels) of rows that are not held out.

    Null ids and labels are left out; an id labelled both ways counts as 0; of rows that share an id the smallest
    features count. The labels are cut to ``max_rows`` before they meet the documents, so both the joined side and the
    collected matrix are bounded whatever the size of the tables.
    """
    small_batches(documents.sparkSession)
    known = (
        labels.select(F.col("doc_id").alias("_id"), F.col("quality").cast("int").alias("_label"))
        .filter(F.col("_id").isNotNull() & F.col("_label").isNotNull() & ~held_out(F.col("_id")))
        .groupBy("_id").agg(F.min("_label").alias("_label"))
    )
    chosen = bounded_sample(known, F.col("_id"), max_rows)
    texts = documents.select(F.col("doc_id").alias("_id"), F.col("text").alias("_text"))
    joined = texts.join(F.broadcast(chosen), "_id").select("_id", "_label", "_text")

    def measure(batches):
        for batch in batches:
            yield pd.DataFrame({"_id": batch["_id"], "_label": batch["_label"], "_x": [statistics(t)[1].tolist() for t in batch["_text"]]})

    kind = f"_id {chosen.schema['_id'].dataType.simpleString()}, _label int, _x array<double>"
    rows = (
        joined.mapInPandas(measure, kind).groupBy("_id").agg(F.min(F.struct("_label", "_x")).alias("_row"))
        .orderBy(F.xxhash64("_id"), "_id").limit(max_rows).select("_row.*").toPandas()
    )
    if rows.empty:
        return np.zeros((0, len(FEATURES))), np.zeros(0)
    return np.array(rows["_x"].tolist(), float), rows["_label"].to_numpy(float)
