"""Quality rules: base rules, then boosted trees with monotonic constraints over document statistics.

A document fails the base rules when it has fewer than 50 words, or when more than half of its words lie in repeated
three-word windows. The others get the verdict of gradient-boosted trees fitted to labelled documents: kept when the
probability of good quality is at least ``threshold``. The trees must not reward repetition, symbols, duplicate lines
and their like (see ``DIRECTIONS``), so a text never passes because it got worse.

Defined results: very long texts are judged whole; documents that tie in score get the same verdict; null and empty texts have zero counts and fail the base rules; repeated rows each get their own row;
null ids are kept as they are; without labels of both kinds every document that passes the base rules is kept when the
share of good labels (0.5 without any) reaches the threshold; an empty table gives an empty table. Other columns are
carried through; columns of the names in ``COLUMNS`` are replaced.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from convoy.llm import trees
from convoy.llm.common import shelter, small_batches
from convoy.llm.doc_stats import BASE, FEATURES, statistics
from convoy.llm.labelled import MAX_TRAINING_ROWS, training_matrix

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: Documents are rejected only when the trees are fairly sure.
THRESHOLD = 0.3
#: Features along which the score may only fall.
FALLING = {"symbol_share", "dup_line_share", "repeat_share", "top_word_share", "bang_share", "bar_share", "symbol_word_share", "adjacent_share"}
DIRECTIONS = tuple(-1 if name in FALLING else 0 for name in FEATURES)
COLUMNS = (*BASE, "quality_score", "base_failed", "kept")


def fit_rules(documents: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAINING_ROWS, settings: trees.Settings = trees.Settings()) -> trees.Trees:
    x, y = training_matrix(documents, labels, max_rows)
    return trees.fit(x, y, settings, DIRECTIONS)


def apply_rules(documents: DataFrame, model: trees.Trees, threshold: float = THRESHOLD) -> DataFrame:
    """``documents`` with the columns ``COLUMNS``."""
    small_batches(documents.sparkSession)
    plain, _, back = shelter(documents, COLUMNS)

    @F.pandas_udf("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, quality_score double")
    def judge(texts: pd.Series) -> pd.DataFrame:
        measured = [statistics(t) for t in texts]
        base = np.array([m[0] for m in measured], np.int64).reshape(-1, len(BASE))
        x = np.array([m[1] for m in measured], float).reshape(-1, len(FEATURES))
        return pd.DataFrame(base, columns=list(BASE)).assign(quality_score=model.score(x))

    rows = plain.withColumn("_judged", judge(F.col("text"))).select(*back, "_judged.*")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return rows.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & (F.col("quality_score") >= threshold))
