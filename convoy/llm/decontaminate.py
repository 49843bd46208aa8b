"""Benchmark decontamination by pigeonhole edit matching.

Texts and test items are compared in lower case with every run of other characters as one space. An item of m
characters may differ by k edits, k a fixed share of m. Cut into k + 1 pieces, at least one piece of a passage within
k edits is untouched, so all pieces of a block of items are looked up at once in the whole text (Aho-Corasick), and
around each hit Myers' bit-parallel distance decides whether the item is there. The test items are a stated query set:
they are taken in blocks of bounded bytes, each block against all documents.

Defined results: very long texts are searched whole, one at a time in a worker; null and empty texts and items match nothing; rows that are equal or share an id are scanned each and
reported once an id and item; null ids are reported with a null id; an empty table on either side gives no rows. An
item shorter than two pieces must be there exactly, bounded by word ends. Columns besides id and text are ignored by
``find_leaks`` and carried through by ``drop_contaminated``.
"""

from __future__ import annotations

import re
from functools import reduce
from math import ceil

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from convoy.llm.common import cut, shelter, small_batches

ERROR_SHARE = 0.08
#: A piece has at least so many characters; shorter ones would hit everywhere.
MIN_PIECE = 12
#: Bytes of items that one pass over the documents looks for.
BLOCK_BYTES = 1_000_000

_RUN = re.compile(r"[^\W_]+")


def _lower(text: str) -> str:
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def normalize(text: str | None) -> str:
    return " ".join(_RUN.findall(_lower(text))) if text else ""


def original_span(text: str, start: int, end: int) -> tuple[int, int]:
    """Where characters ``start`` to ``end`` of the normalized text stand in ``text``."""
    at, first, last = 0, None, 0
    for run in _RUN.finditer(_lower(text)):
        size = run.end() - run.start()
        if first is None and at + size > start:
            first = run.start() + max(0, start - at)
        if at < end:
            last = run.start() + min(size, end - at)
        at += size + 1
        if at >= end:
            break
    return first or 0, last


def error_budget(m: int, share: float = ERROR_SHARE) -> int:
    return max(0, min(int(share * m), m // MIN_PIECE - 1))


def pieces(item: str, k: int) -> list[tuple[int, str]]:
    """(offset, piece) of an item cut into k + 1 pieces of about equal length."""
    edges = [len(item) * i // (k + 1) for i in range(k + 2)]
    return [(a, item[a:b]) for a, b in zip(edges, edges[1:])]


def myers(pattern: str, text: str, k: int) -> tuple[int, int] | None:
    """(distance, end) of the best place of ``pattern`` in ``text`` within ``k`` edits, the first of equal ones."""
    m = len(pattern)
    equal: dict[str, int] = {}
    for i, c in enumerate(pattern):
        equal[c] = equal.get(c, 0) | 1 << i
    mask, high = (1 << m) - 1, 1 << (m - 1)
    up, down, score, best = mask, 0, m, None
    for j, c in enumerate(text):
        e = equal.get(c, 0)
        xv = e | down
        xh = (((e & up) + up) ^ up) | e
        ph = down | ~(xh | up) & mask
        mh = up & xh
        if ph & high:
            score += 1
        elif mh & high:
            score -= 1
        ph, mh = ph << 1 & mask, mh << 1 & mask
        up, down = (mh | ~(xv | ph)) & mask, ph & xv
        if score <= k and (best is None or score < best[0]):
            best = (score, j + 1)
            if not score:
                break
    return best


class Matcher:
    """Finds a block of items in texts."""

    def __init__(self, items: list[tuple[int | None, str]], share: float = ERROR_SHARE):
        self.items = [(key, item, error_budget(len(item), share)) for key, item in items if item]
        lookup: dict[str, list[tuple[int, int]]] = {}
        for number, (_, item, k) in enumerate(self.items):
            for offset, piece in pieces(item, k):
                lookup.setdefault(piece, []).append((number, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, uses in lookup.items():
            self.automaton.add_word(piece, (len(piece), uses))
        if lookup:
            self.automaton.make_automaton()

    def find(self, text: str | None) -> list[tuple[int | None, int, int, int]]:
        """(item, distance, start, end) in the text, the best place of each item."""
        flat = normalize(text)
        if not flat or not self.items:
            return []
        tried: set[tuple[int, int]] = set()
        found: dict[int, tuple[int, int, int]] = {}
        for last, (size, uses) in self.automaton.iter(flat):
            for number, offset in uses:
                _, item, k = self.items[number]
                if number in found and not found[number][0]:
                    continue
                begin = last + 1 - size - offset
                spot = (number, begin // (k + 1))  # begins this near share a window
                if spot in tried:
                    continue
                tried.add(spot)
                low = max(0, spot[1] * (k + 1) - k)
                window = flat[low: (spot[1] + 1) * (k + 1) + k + len(item)]
                hit = self._place(item, window, k, low, flat)
                if hit and (number not in found or hit < found[number]):
                    found[number] = hit
        return [(self.items[n][0], d, *original_span(text, a, b)) for n, (d, a, b) in found.items()]

    @staticmethod
    def _place(item: str, window: str, k: int, low: int, flat: str) -> tuple[int, int, int] | None:
        at = window.find(item)
        if at >= 0:
            start, end = low + at, low + at + len(item)
            whole = (not start or flat[start - 1] == " ") and (end == len(flat) or flat[end] == " ")
            return (0, start, end) if k or whole else None
        if not k:
            return None
        hit = myers(item, window, k)
        if hit is None:
            return None
        back = myers(item[::-1], window[hit[1] - 1:: -1], k)
        return hit[0], low + hit[1] - back[1], low + hit[1]


def find_leaks(documents: DataFrame, benchmark: DataFrame, share: float = ERROR_SHARE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, item_id, distance, start and end (code points of the text, end exclusive), a row an id and item."""
    small_batches(documents.sparkSession)
    items = benchmark.select("item_id", "text").filter(F.col("text").isNotNull())
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, ceil(total / block_bytes))
    ids = {"doc_id": documents.schema["doc_id"].dataType, "item_id": benchmark.schema["item_id"].dataType}
    schema = "doc_id string, item_id string, distance int, start int, end int"  # ids as text meanwhile: nulls stay nulls
    texts = documents.select(F.col("doc_id").cast("string"), "text").filter(F.col("text").isNotNull())

    def scan(rows):
        def run(batches):
            matcher = Matcher([(key, normalize(text)) for key, text in rows], share)
            for batch in batches:
                yield pd.DataFrame(
                    [(doc, *hit) for doc, text in zip(batch["doc_id"], batch["text"]) for hit in matcher.find(text)],
                    columns=["doc_id", "item_id", "distance", "start", "end"],
                ).astype({"distance": "int32", "start": "int32", "end": "int32"})
        return run

    parts = []
    for block in range(blocks):
        rows = [tuple(r) for r in items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).select(F.col("item_id").cast("string"), "text").collect()]
        parts.append(texts.mapInPandas(scan(rows), schema))
    hits = reduce(DataFrame.unionByName, parts).withColumns({name: F.col(name).cast(kind) for name, kind in ids.items()})
    best = hits.groupBy("doc_id", "item_id").agg(F.min(F.struct("distance", "start", "end")).alias("_hit"))
    return best.select("doc_id", "item_id", "_hit.*")


def drop_contaminated(documents: DataFrame, benchmark: DataFrame, share: float = ERROR_SHARE) -> DataFrame:
    """``documents`` without those whose text holds a test item. The text alone decides, by its digest: ids may be null or shared."""
    plain, _, back = shelter(documents)
    digest = F.sha2(F.col("text"), 256)
    leaks = cut(find_leaks(plain.select(digest.alias("doc_id"), "text"), benchmark, share).select(F.col("doc_id").alias("_digest")).distinct())
    return plain.join(leaks, digest == F.col("_digest"), "left_anti").select(*back)
