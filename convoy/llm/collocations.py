"""Collocations by suffix subtrees over vertically partitioned word prefixes.

Every word position of a piece of text starts a suffix, cut after ``DEPTH`` words. The tree of all suffixes of a corpus
fits in no memory, so it is built in parts that do not need one another:

1. Words are counted per language.
2. Vertical partitioning: suffixes fall into slots by their first word. Slots are packed into groups of at most
   ``budget`` suffixes; a slot above the budget is extended by the second word, which takes one more count over the
   texts for such slots alone, and a part that is still above it by the third.
3. Each group's suffixes are sorted and its subtree is read off: the leaves below a node add up to the count of the
   node's phrase. Tasks add up equal suffixes before they send them.
4. Phrases found often enough are scored against their parts by joins.

Words are 64-bit codes of language and word while they are counted, so subtrees of languages never mix. Should two words
share a code, the count starts again with other codes; so counts are exact. The routing table is broadcast; it has
65,536 entries and 256 more for each slot above the budget, whatever the corpus.

Defined results: a null text has no words; a null language is ``und``; repeated rows count as often as they occur; ties
of score and count are ordered by the phrase's bytes; an empty table has no collocations. Texts are counted whole; a
very long text is cut at separators while it is read, so a worker holds no more than its longest piece. Other columns
are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from convoy.llm.common import cut

DEPTH = 3
LEAST = 10
SHARE = 50
TOP = 2000
BUDGET = 2_000_000
#: Bytes of text that are split into words at once, and suffixes that are sorted before they are sent.
TEXT_BYTES = 4_000_000
SORT_ROWS = 1_000_000
#: Distinct words that are counted before they are sent, or remembered with their codes.
HELD_WORDS = 400_000
SLOTS, PARTS = 1 << 16, 1 << 8

_TABLE = bytes(
    ord("\n") if chr(b) in ".,;:!?\n\x0b\x0c\r" else ord(" ") if b == ord("\t") else b + 32 if 65 <= b <= 90 else b for b in range(256)
)
_BREAK = b"\xff"  # no byte of UTF-8


def _segments(text: str):
    """The bytes of a text in lower case, separators as line feeds, cut at separators into parts of limited size."""
    raw, start = text.encode("utf-8", "replace").translate(_TABLE), 0
    while len(raw) - start > TEXT_BYTES:
        end = raw.rfind(b"\n", start, start + TEXT_BYTES)
        end = end if end > start else raw.find(b"\n", start + TEXT_BYTES)
        if end < 0:
            break
        yield raw[start:end]
        start = end
    yield raw[start:] if start else raw


def _lots(batches):
    """(language, words with breaks between pieces) for texts of limited size."""
    held: dict[str, list[bytes]] = {}
    size = 0
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            for part in _segments(text or ""):
                held.setdefault(lang, []).append(part)
                size += len(part) + 64
                if size >= TEXT_BYTES:
                    yield from _split(held)
                    held, size = {}, 0
    yield from _split(held)


def _split(held: dict[str, list[bytes]]):
    for lang, parts in held.items():
        # A break between pieces, and between texts, so that no phrase reaches over one.
        yield lang, b"\n".join(parts).replace(b"\n", b" " + _BREAK + b" ").split()


def word_code(lang: str, word: bytes, seed: int) -> int:
    key = lang.encode("utf-8", "replace") + b"\0" + word
    return int.from_bytes(hashlib.blake2b(key, digest_size=8, salt=seed.to_bytes(8, "little")).digest(), "little") | 1


class _Codes(dict):
    """Codes of the words of a language; that of a break is 0, no word's is."""

    def __init__(self, lang: str, seed: int) -> None:
        super().__init__({_BREAK: 0})
        self.lang, self.seed = lang, seed

    def __missing__(self, word: bytes) -> int:
        if len(self) > HELD_WORDS:
            self.clear()
            self[_BREAK] = 0
        code = 0 if word == _BREAK else word_code(self.lang, word, self.seed)
        self[word] = code
        return code


# ---- 1. words

_WORDS = "code long, lang string, word string, n long"
_WORDS_ARROW = pa.schema([("code", pa.int64()), ("lang", pa.string()), ("word", pa.string()), ("n", pa.int64())])


def _count_words(seed: int):
    def rows(counts: dict[str, Counter]):
        for lang, words in counts.items():
            words.pop(_BREAK, None)
            if words:
                codes = np.array([word_code(lang, w, seed) for w in words], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([
                    pa.array(codes), pa.array([lang] * len(words), pa.string()), pa.array(list(words), pa.binary()).cast(pa.string()),
                    pa.array(list(words.values()), pa.int64()),
                ], schema=_WORDS_ARROW)

    def run(batches):
        counts: dict[str, Counter] = {}
        for lang, words in _lots(batches):
            counts.setdefault(lang, Counter()).update(words)
            if sum(map(len, counts.values())) > HELD_WORDS:
                yield from rows(counts)
                counts = {}
        yield from rows(counts)

    return run


def count_words(texts: DataFrame) -> tuple[DataFrame, int]:
    """(code, lang, word and n of all words, the seed of the codes)."""
    seed = 0
    while True:
        sent = texts.mapInArrow(_count_words(seed), _WORDS).repartition("code")
        words = cut(sent.groupBy("code", "lang", "word").agg(F.sum("n").alias("n")))
        if words.groupBy("code").count().filter("count > 1").isEmpty():
            return words, seed
        seed += 1


# ---- 2. groups of prefixes

def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return x ^ (x >> np.uint64(29))


def _slot(first: np.ndarray) -> np.ndarray:
    return (first >> np.uint64(48)).astype(np.int64)


def _part(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return (_mixed(first ^ _mixed(second)) >> np.uint64(56)).astype(np.int64)


class Groups:
    """The group of every suffix.

    ``slot`` has the group of each slot, or -1 - h where the slot is the h-th above the budget; then ``part`` has the
    first group of each of its parts and ``spread`` over how many groups the third word deals it.
    """

    def __init__(self, loads: np.ndarray, budget: int) -> None:
        self.budget, self.n = budget, 0
        self.large = np.flatnonzero(loads > budget)
        self.slot = np.zeros(len(loads), np.int32)
        self.slot[self.large] = -1 - np.arange(len(self.large))
        small = loads <= budget
        self.slot[small] = self._packed(loads[small])
        self.part = np.zeros((len(self.large), PARTS), np.int32)
        self.spread = np.ones((len(self.large), PARTS), np.int32)

    def _packed(self, loads: np.ndarray) -> np.ndarray:
        """Groups of neighbours within the budget, the next free number first."""
        out, held = np.zeros(len(loads), np.int32), 0
        group = self.n
        for i, load in enumerate(loads.tolist()):
            if held and held + load > self.budget:
                group, held = group + 1, 0
            out[i], held = group, held + load
        self.n = group + 1
        return out

    def extend(self, loads: np.ndarray) -> None:
        """Takes the loads of the parts of the large slots."""
        for h in range(len(self.large)):
            small = loads[h] <= self.budget
            self.part[h, small] = self._packed(loads[h, small])
            for k in np.flatnonzero(~small).tolist():
                self.spread[h, k] = -(-int(loads[h, k]) // self.budget)
                self.part[h, k], self.n = self.n, self.n + int(self.spread[h, k])

    def of(self, suffixes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(group of each suffix, whether its group is one of several that share the counts of its first two words)."""
        group = self.slot[_slot(suffixes[0])].astype(np.int64)
        shared = np.zeros(len(group), bool)
        at = np.flatnonzero(group < 0)
        if len(at):
            h, part = -1 - group[at], _part(suffixes[0, at], suffixes[1, at])
            wide = self.spread[h, part]
            third = (_mixed(suffixes[2, at] ^ suffixes[0, at]) >> np.uint64(32)).astype(np.int64) % wide
            group[at], shared[at] = self.part[h, part] + third, wide > 1
        return group, shared


def _suffixes(codes: np.ndarray) -> np.ndarray:
    """The suffixes of two words or more, cut after three; 0 stands for a missing third word."""
    wide = np.concatenate([codes, np.zeros(DEPTH, np.uint64)])
    three = np.stack([wide[i: i + len(codes)] for i in range(DEPTH)])
    return three[:, (three[0] != 0) & (three[1] != 0)]


def _coded(batches, seed: int):
    """Suffixes of limited lots of text."""
    known: dict[str, _Codes] = {}
    for lang, words in _lots(batches):
        if len(known) > 1000 or sum(map(len, known.values())) > 2 * HELD_WORDS:
            known = {}
        codes = known.setdefault(lang, _Codes(lang, seed))
        yield _suffixes(np.fromiter(map(codes.__getitem__, words), np.uint64, len(words)))


def _count_parts(seed: int, large: np.ndarray):
    def run(batches):
        rank = np.full(SLOTS, -1, np.int64)
        rank[large] = np.arange(len(large))
        loads: dict[int, np.ndarray] = {}
        for suffixes in _coded(batches, seed):
            h = rank[_slot(suffixes[0])]
            at = np.flatnonzero(h >= 0)
            keys, counts = np.unique(h[at] * PARTS + _part(suffixes[0, at], suffixes[1, at]), return_counts=True)
            for k, n in zip(keys.tolist(), counts.tolist()):
                loads[k] = loads.get(k, 0) + n
        yield pa.RecordBatch.from_pydict({"k": pa.array(list(loads), pa.int64()), "n": pa.array(list(loads.values()), pa.int64())})

    return run


def partition_prefixes(texts: DataFrame, words: DataFrame, seed: int, budget: int) -> Groups:
    """Groups of suffixes within the budget, from exact counts."""
    slot = F.shiftrightunsigned("code", 48)
    loads = np.zeros(SLOTS, np.int64)
    for row in words.groupBy(slot.alias("slot")).agg(F.sum("n").alias("n")).collect():  # SLOTS rows at most
        loads[row["slot"]] = row["n"]
    groups = Groups(loads, budget)
    if len(groups.large):
        parts = np.zeros(len(groups.large) * PARTS, np.int64)
        sent = texts.mapInArrow(_count_parts(seed, groups.large), "k long, n long")
        for row in sent.groupBy("k").agg(F.sum("n").alias("n")).collect():  # PARTS rows for each large slot at most
            parts[row["k"]] = row["n"]
        groups.extend(parts.reshape(-1, PARTS))
    return groups


# ---- 3. subtrees

_SENT = "group long, n long, shared boolean, data binary"
_SENT_ARROW = pa.schema([("group", pa.int64()), ("n", pa.int64()), ("shared", pa.bool_()), ("data", pa.binary())])


def _starts(rows: np.ndarray) -> np.ndarray:
    """Where a sorted column of suffixes differs from the one before, in any of ``rows``."""
    if not rows.shape[1]:
        return np.zeros(0, np.int64)
    return np.flatnonzero(np.concatenate([[True], (rows[:, 1:] != rows[:, :-1]).any(axis=0)]))


def _summed(suffixes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort(suffixes[::-1])
    suffixes, counts = suffixes[:, order], counts[order]
    starts = _starts(suffixes)
    return suffixes[:, starts], np.add.reduceat(counts, starts) if len(starts) else counts


def _packed(suffixes: np.ndarray, counts: np.ndarray) -> bytes:
    return zlib.compress(suffixes.tobytes() + counts.astype(np.uint64).tobytes(), 1)


def _unpacked(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(zlib.decompress(data), np.uint64).reshape(DEPTH + 1, n)


def _send_suffixes(seed: int, routes):
    def rows(suffixes: np.ndarray):
        groups = routes.value
        suffixes, counts = _summed(suffixes, np.ones(suffixes.shape[1], np.int64))
        group, shared = groups.of(suffixes)
        order = np.argsort(group, kind="stable")
        cuts = _starts(group[order][None])
        out = []
        for a, b in zip(cuts, [*cuts[1:], len(order)]):
            at = order[a:b]
            out.append((int(group[at[0]]), len(at), bool(shared[at[0]]), _packed(suffixes[:, at], counts[at])))
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), _SENT_ARROW.types)], schema=_SENT_ARROW)

    def run(batches):
        held, size = [], 0
        for suffixes in _coded(batches, seed):
            held.append(suffixes)
            size += suffixes.shape[1]
            if size >= SORT_ROWS:
                yield rows(np.concatenate(held, axis=1))
                held, size = [], 0
        if size:
            yield rows(np.concatenate(held, axis=1))

    return run


_NODES = "a long, b long, c long, n long"


def _subtree(least: int):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        parts = [_unpacked(data, n) for n, data in zip(group["n"], group["data"])]
        suffixes, leaves = _summed(np.concatenate([p[:DEPTH] for p in parts], axis=1), np.concatenate([p[DEPTH] for p in parts]).astype(np.int64))
        inner = _starts(suffixes[:2])
        two = np.add.reduceat(leaves, inner)
        # A group that shares its first two words with others knows only a part of their count.
        keep = np.full(len(inner), True) if bool(group["shared"].iloc[0]) else two >= least
        at, deep = inner[keep], np.flatnonzero((leaves >= least) & (suffixes[2] != 0))
        out = np.concatenate([suffixes[:2, at], suffixes[:2, deep]], axis=1).view(np.int64)
        third = np.concatenate([np.zeros(len(at), np.uint64), suffixes[2, deep]]).view(np.int64)
        return pd.DataFrame({"a": out[0], "b": out[1], "c": third, "n": np.concatenate([two[keep], leaves[deep]])})

    return run


def count_phrases(documents: DataFrame, least: int = LEAST, budget: int = BUDGET) -> tuple[DataFrame, DataFrame]:
    """(words: code, lang, word and n, phrases: codes a, b, c and n).

    Phrases are those of two words (c is 0) and three that occur ``least`` times or more.
    """
    texts = documents.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    words, seed = count_words(texts)
    routes = texts.sparkSession.sparkContext.broadcast(partition_prefixes(texts, words, seed, budget))
    sent = texts.mapInArrow(_send_suffixes(seed, routes), _SENT)
    nodes = sent.groupBy("group").applyInPandas(_subtree(least), _NODES)
    return words, cut(nodes.groupBy("a", "b", "c").agg(F.sum("n").alias("n")).filter(F.col("n") >= least))


# ---- 4. scores

def _score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 a a / (l r)); exact for counts below 10 to the 15th."""
    exact = {"a": a, "l": left, "r": right}
    wide = F.struct(*[c.cast("decimal(15,0)").alias(k) for k, c in exact.items()])
    return F.transform(F.array(wide), lambda w: F.call_function(
        "div", F.lit(1_000_000).cast("decimal(7,0)") * w["a"] * w["a"], w["l"] * w["r"]))[0].cast("long")


def collocations(documents: DataFrame, top: int = TOP, least: int = LEAST, share: int = SHARE, budget: int = BUDGET) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of the first ``top`` collocations of each language."""
    words, phrases = count_phrases(documents, least, budget)
    often = words.filter(F.col("n") >= least)
    totals = words.groupBy("lang").agg(F.sum("n").alias("total"))
    two = phrases.filter("c = 0").select("a", "b", F.col("n").alias("f"))
    three = phrases.filter("c != 0").select("a", "b", "c", F.col("n").alias("f"))

    def word(place: str) -> DataFrame:
        return often.select(F.col("code").alias(place), F.col("n").alias(f"f_{place}"), F.col("word").alias(f"w_{place}"))

    inside = three.select("a", "b", "f").unionByName(three.select(F.col("b").alias("a"), F.col("c").alias("b"), "f"))
    longest = inside.groupBy("a", "b").agg(F.max("f").alias("longest"))
    pairs = (
        two.join(longest, ["a", "b"], "left").filter(F.col("longest").isNull() | (100 * F.col("longest") < share * F.col("f")))
        .join(word("a"), "a").join(word("b"), "b")
        .select("a", "f", F.col("f_a").alias("l"), F.col("f_b").alias("r"), F.concat_ws(" ", "w_a", "w_b").alias("phrase"))
        .withColumn("score", _score(F.col("f"), F.col("l"), F.col("r")))
    )
    halves = (
        three.join(two.select("a", "b", F.col("f").alias("f_ab")), ["a", "b"])
        .join(two.select(F.col("a").alias("b"), F.col("b").alias("c"), F.col("f").alias("f_bc")), ["b", "c"])
        .join(word("a"), "a").join(word("b"), "b").join(word("c"), "c")
        .withColumns({"s1": _score(F.col("f"), F.col("f_a"), F.col("f_bc")), "s2": _score(F.col("f"), F.col("f_ab"), F.col("f_c"))})
    )
    early = F.col("s1") <= F.col("s2")
    triples = halves.select(
        "a", "f", F.when(early, F.col("f_a")).otherwise(F.col("f_ab")).alias("l"), F.when(early, F.col("f_bc")).otherwise(F.col("f_c")).alias("r"),
        F.concat_ws(" ", "w_a", "w_b", "w_c").alias("phrase"), F.least("s1", "s2").alias("score"))
    found = pairs.unionByName(triples).join(often.select(F.col("code").alias("a"), "lang"), "a").drop("a")
    # The first of every share of a language are found before its shares meet.
    order = [F.desc("score"), F.desc("f"), F.asc("phrase")]
    near = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(256))).orderBy(*order)
    best = found.withColumn("_place", F.row_number().over(near)).filter(F.col("_place") <= top)
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", F.col("f").alias("a"), "l", "r", F.col("total").alias("n"), "score")
