"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from convoy.session import ensure_checkpoint_dir

#: Separators of words; ``bytes.split()`` splits at just these.
SEPARATORS = " \t\n\x0b\x0c\r"
#: The same rule as a pattern for Spark and DuckDB.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
#: Rows of a batch handed to Python: very long texts must not meet in one batch by the ten thousand.
BATCH_ROWS = 1000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Bounds what one Arrow batch may hold, unless the session asks for less."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= rows:
        spark.conf.set(name, str(rows))


def cut(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared checkpoint folder, so lost executors cannot change it."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "replace").split() if text else []


def held_out(doc_id: Column) -> Column:
    """Rows kept from training: crc32 of the id as text, modulo 5, is 0; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def bounded_sample(df: DataFrame, key: Column, rows: int) -> DataFrame:
    """Rows whose hash of ``key`` is below the share that gives ``rows`` of them; all if there are no more.

    The number is ``rows`` on average, give or take its root; no task sees more than its part of the sample.
    """
    total = df.count()
    if total <= rows:
        return df
    return df.filter(F.pmod(F.xxhash64(key, F.lit(7)), F.lit(1 << 40)) < int((1 << 40) * rows / total))


def partitions_for(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


_CODES: dict[bytes, int] = {}


def word_codes(words: list[bytes]) -> np.ndarray:
    """64-bit hashes of words. Codes of words seen before are remembered, up to a bound."""
    if len(_CODES) > 300_000:
        _CODES.clear()
    for word in set(words).difference(_CODES):
        _CODES[word] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
    return np.fromiter(map(_CODES.__getitem__, words), np.uint64, len(words))


def odd_multipliers(n: int, seed: int) -> list[int]:
    """``n`` fixed odd 64-bit numbers."""
    source = random.Random(seed)
    return [source.getrandbits(64) | 1 for _ in range(n)]


def shelter(df: DataFrame, replaced: tuple[str, ...] = ()) -> tuple[DataFrame, list[str], list[Column]]:
    """(``df`` without the columns ``replaced``, its column names, expressions that give the columns their old names).

    Columns that start with an underscore are renamed meanwhile, so they cannot clash with those an operator adds, and so
    are those whose names would need quoting.
    """
    kept = [i for i, c in enumerate(df.columns) if c not in replaced]
    held = [f"held{i}" if not re.fullmatch(r"[A-Za-z][A-Za-z0-9_ ]*", df.columns[i]) else df.columns[i] for i in kept]
    while clash := [k for k, name in enumerate(held) if held.count(name) > 1]:
        held[clash[-1]] += "_"
    every = dict(zip(kept, held))
    renamed = df.toDF(*[every.get(i, f"gone{i}") for i in range(len(df.columns))])
    back = [F.col(f"`{name}`").alias(df.columns[i]) for i, name in every.items()]
    return renamed.select(*[f"`{name}`" for name in held]), held, back


def identity(df: DataFrame, name: str) -> Column:
    """A column in a form that can be hashed and put in order; maps and variants by their text."""
    kind = df.schema[name].dataType.simpleString()
    return F.to_json(F.struct(F.col(f"`{name}`"))) if "map<" in kind or "variant" in kind else F.col(f"`{name}`")
