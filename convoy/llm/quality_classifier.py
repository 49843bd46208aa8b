"""Quality classifier: histogram gradient-boosted trees over document statistics.

Only statistics of the text enter the score; labels, language, source and id do not. Labels are learned from rows
whose crc32 of the id, as text, modulo 5 is not 0; the others are held out.

Defined results: very long texts are scored whole; documents with equal statistics get equal scores; null and empty texts are scored by their statistics, all zero; a null id counts as empty text for
the held-out rule; repeated rows each get a row; without labels of both kinds the score is the share of good labels
(0.5 without any); an empty table gives an empty table. Other columns are carried through; ``held_out``, ``score`` and
``predicted`` are replaced.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from convoy.llm import trees
from convoy.llm.common import held_out, small_batches
from convoy.llm.doc_stats import FEATURES, statistics
from convoy.llm.labelled import MAX_TRAINING_ROWS, training_matrix

THRESHOLD = 0.3
SETTINGS = trees.Settings(trees=80, depth=5, rate=0.12)
COLUMNS = ("held_out", "score", "predicted")


def fit_classifier(documents: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAINING_ROWS, settings: trees.Settings = SETTINGS) -> trees.Trees:
    return trees.fit(*training_matrix(documents, labels, max_rows), settings)


def classify(documents: DataFrame, model: trees.Trees, threshold: float = THRESHOLD) -> DataFrame:
    """``documents`` with ``held_out``, ``score`` and ``predicted``."""
    small_batches(documents.sparkSession)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        x = np.array([statistics(t)[1] for t in texts], float).reshape(-1, len(FEATURES))
        return pd.Series(model.score(x))

    return (
        documents.drop(*COLUMNS).withColumn("held_out", held_out(F.col("doc_id")))
        .withColumn("score", score(F.col("text")))
        .withColumn("predicted", (F.col("score") >= threshold).cast("int"))
    )
