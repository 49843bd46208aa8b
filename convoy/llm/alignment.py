"""Alignment of two tokenizers over a corpus, with pair counts by external spill counting.

A text is encoded by a byte-level BPE (A) and a sentencepiece model (B). Where tokens of both end at the same byte the
text is cut into groups; the two tokens that end there are linked. How often an id pair is linked in the whole corpus
decides which links are the best of their B id.

1. Blocks: a task gathers links until ``BLOCK_LINKS`` and sorts them side-major: B id first, under a bit scramble that
   makes the leading bits a fair radix. The pair-document records of a block stay where they are, as one zstd run beside
   the block's documents, in a Parquet table in the shared folder; what travels is the run's directory, each distinct
   pair with its count, cut by radix.
2. Merge: the directories of a radix partition are merged by a heap, k at a time and in several rounds where there are
   more than ``FAN_IN``, so a task never holds more than that many. Side-major order brings all pairs of a B id
   together: their counts and the largest of them are known as soon as the merge leaves the id.
3. Contributions stream back: each directory gets the count of each of its pairs and whether it is the best, in its own
   order, down the rounds to the blocks, which add them up by document.

Both tokenizers split at the strings that ``_CHUNK`` finds, so those are aligned once and remembered. Texts with other
white space, or with the character that stands for a blank in B, are encoded whole.

Defined results: a text that is null or empty, or whose tokens of A or B do not spell it, has zeros and an empty digest
and takes no part in any count; repeated rows count each; a null id stays null; ties of the highest count are all best;
an empty table gives an empty table. Texts are aligned whole; a worker holds the longest one. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import os
import re
from functools import cache
from uuid import uuid4

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from convoy.llm.common import cut, partitions_for
from convoy.session import ensure_checkpoint_dir

BLOCK_LINKS = 2_000_000
FAN_IN = 512
#: Strings whose alignment a worker remembers, and characters that are encoded at once.
REMEMBERED = 300_000
LOT_CHARS = 4_000_000

_CHUNK = re.compile(r" [^ \n]+|\n(?= ?[^ \n])|[^ \n]+|[ \n]+[^ \n]*")
#: White space besides the blank and the line feed, and B's own sign for a blank.
_OTHER = re.compile("[^\\S \\n]|[\x1c-\x1f\u2581]")
_BLANK = "\u2581"


def _byte_of_char() -> dict[str, int]:
    """The fixed alphabet of byte-level BPE: visible Latin-1 stands for itself, the other bytes for 256 and on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {**{chr(b): b for b in visible}, **{chr(256 + k): b for k, b in enumerate(hidden)}}


class Aligner:
    """Alignments of texts as (tokens of A, tokens of B, groups, digest text, links), put together from those of chunks."""

    def __init__(self, path_a: str, path_b: str) -> None:
        import sentencepiece
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        alphabet = _byte_of_char()
        self.bytes_a: list[bytes] = [b""] * self.a.get_vocab_size()
        for token, i in self.a.get_vocab().items():
            known = all(c in alphabet for c in token)
            self.bytes_a[i] = bytes(alphabet[c] for c in token) if known else token.encode()
        self.bytes_b = [self._piece(i) for i in range(self.b.get_piece_size())]
        self.lead = len(self.b.encode("\n"))
        self.known: dict[str, tuple | None] = {}
        # Chunks may be encoded alone only if no piece of B reaches over their ends.
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.splits = not any(re.search(rf"[^{_BLANK}]{_BLANK}|\n| ", p) for p in pieces)

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace(_BLANK, " ").encode()

    def _aligned(self, text: bytes, a: list[int], b: list[int]) -> tuple | None:
        """(tokens of A, tokens of B, groups, digest text, links as bytes); None if a side does not spell the text."""
        part_a, part_b = [self.bytes_a[i] for i in a], [self.bytes_b[i] for i in b]
        if b"".join(part_a) != text or b"".join(part_b) != text:
            return None
        i = j = first_a = first_b = groups = 0
        end_a = end_b = 0
        said, links = [], []
        while i < len(a):
            end_a += len(part_a[i])
            i += 1
            while end_b < end_a:
                end_b += len(part_b[j])
                j += 1
            if end_b == end_a:
                said.append(f"{','.join(map(str, a[first_a:i]))}|{','.join(map(str, b[first_b:j]))}")
                links.append((b[j - 1] << 32) | a[i - 1])
                first_a, first_b, groups = i, j, groups + 1
        return len(a), len(b), groups, ";".join(said), np.array(links, np.uint64).tobytes()

    def _encoded_b(self, chunks: list[str]) -> list[list[int]]:
        """B adds a blank before a text: it stands for that of a chunk, or a line feed keeps it off and goes with it."""
        blank = [c[0] == " " for c in chunks]
        found = self.b.encode([c[1:] if own else "\n" + c for c, own in zip(chunks, blank)], num_threads=1)
        return [ids if own else ids[self.lead:] for ids, own in zip(found, blank)]

    def learn(self, chunks: list[str]) -> None:
        for k in range(0, len(chunks), 20_000):
            part = chunks[k: k + 20_000]
            side_a = [e.ids for e in self.a.encode_batch_fast(part, add_special_tokens=False)]
            for chunk, a, b in zip(part, side_a, self._encoded_b(part)):
                self.known[chunk] = self._aligned(chunk.encode(), a, b)

    def whole(self, text: str) -> tuple | None:
        a = self.a.encode(" " + text, add_special_tokens=False).ids
        return self._aligned((" " + text).encode("utf-8", "replace"), a, self.b.encode(text))

    def align(self, texts: list[str]) -> list[tuple | None]:
        if len(self.known) > REMEMBERED:
            self.known.clear()
        plain = [bool(t) and self.splits and not _OTHER.search(t) for t in texts]
        chunks = [_CHUNK.findall(" " + t) if p else [] for t, p in zip(texts, plain)]
        self.learn(list(set().union(*chunks).difference(self.known)))
        out = []
        for text, p, found in zip(texts, plain, chunks):
            if not text:
                out.append(None)
            elif not p:
                out.append(self.whole(text))
            else:
                parts = [*map(self.known.__getitem__, found)]
                if None in parts:
                    out.append(self.whole(text))
                else:
                    n_a, n_b, groups, said, links = zip(*parts)
                    out.append((sum(n_a), sum(n_b), sum(groups), ";".join(said), b"".join(links)))
        return out


@cache
def _aligner(path_a: str, path_b: str) -> Aligner:
    return Aligner(path_a, path_b)


# ---- 1. blocks

#: Odd, so that multiplying 32-bit ids by it loses nothing and makes their leading bits even.
_SCRAMBLE = 0x9E3779B1

_BLOCKS = "kind string, block string, part long, n long, data binary"
_BLOCKS_ARROW = pa.schema([("kind", pa.string()), ("block", pa.string()), ("part", pa.int64()), ("n", pa.int64()), ("data", pa.binary())])
_DOC = np.dtype([("known", "u1"), ("doc_id", "<i8"), ("n_a", "<i8"), ("n_b", "<i8"), ("n_groups", "<i8"), ("has", "u1"), ("sha", "u1", 32)])


def _side_major(pairs: np.ndarray) -> np.ndarray:
    """(B id, A id) as one number that sorts by radix, B id and A id."""
    b = (pairs >> np.uint64(32)) * np.uint64(_SCRAMBLE) & np.uint64(0xFFFFFFFF)
    return b << np.uint64(32) | pairs & np.uint64(0xFFFFFFFF)


def _zip(*columns: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(b"".join(np.ascontiguousarray(c).tobytes() for c in columns))


def _unzip(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def _directory(pairs: np.ndarray, counts: np.ndarray) -> bytes:
    """Pairs in ascending order as differences, with their counts."""
    return _zip(np.diff(pairs, prepend=np.uint64(0)), counts.astype(np.uint64))


def _pairs_of(data: bytes, n: int) -> tuple[np.ndarray, np.ndarray]:
    held = np.frombuffer(_unzip(data), np.uint64).reshape(2, n)
    return np.cumsum(held[0], dtype=np.uint64), held[1].astype(np.int64)


def _block(docs: list[tuple], parts: int) -> list[tuple]:
    """Rows of a block: its documents, its run of records, and its directory by radix."""
    name = f"{TaskContext.get().partitionId()}-{uuid4().hex}" if TaskContext.get() else uuid4().hex
    table = np.zeros(len(docs), _DOC)
    for k, (doc, found) in enumerate(docs):
        table[k]["known"], table[k]["doc_id"] = doc is not None, doc or 0
        if found:
            table[k]["n_a"], table[k]["n_b"], table[k]["n_groups"], table[k]["has"] = *found[:3], 1
            table[k]["sha"] = np.frombuffer(hashlib.sha256(found[3].encode()).digest(), np.uint8)
    sizes = [len(found[4]) // 8 if found else 0 for _, found in docs]
    pairs = _side_major(np.frombuffer(b"".join(found[4] for _, found in docs if found), np.uint64))
    doc = np.repeat(np.arange(len(docs), dtype=np.uint32), sizes)
    order = np.argsort(pairs, kind="stable")  # documents stay in order within a pair
    pairs, doc = pairs[order], doc[order]
    new_pair = np.concatenate([[True], pairs[1:] != pairs[:-1]]) if len(pairs) else np.zeros(0, bool)
    new_record = new_pair | np.concatenate([[True], doc[1:] != doc[:-1]]) if len(pairs) else new_pair
    record, first = np.flatnonzero(new_record), np.flatnonzero(new_pair)
    times = np.diff(record, append=len(pairs)).astype(np.uint32)
    of_pair = (np.cumsum(new_pair) - 1)[record].astype(np.uint32)
    records = _zip(np.diff(of_pair, prepend=np.uint32(0)), doc[record], times)
    distinct, counts = pairs[first], np.diff(first, append=len(pairs))
    rows = [("docs", name, -1, len(docs), _zip(table)), ("records", name, -1, len(record), records)]
    radix = ((distinct >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
    cuts = np.flatnonzero(np.diff(radix, prepend=-1))
    rows += [
        ("pairs", name, int(radix[a]), int(b - a), _directory(distinct[a:b], counts[a:b]))
        for a, b in zip(cuts, [*cuts[1:], len(distinct)])
    ]
    return rows


def _blocks(path_a: str, path_b: str, parts: int, block_links: int):
    def rows(docs):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*_block(docs, parts)), _BLOCKS_ARROW.types)], schema=_BLOCKS_ARROW)

    def run(batches):
        aligner, docs, links = _aligner(path_a, path_b), [], 0
        for batch in batches:
            ids, texts = batch.column("doc_id").to_pylist(), [t or "" for t in batch.column("text").to_pylist()]
            lots = np.cumsum([len(t) for t in texts]) // LOT_CHARS
            cuts = [0, *(np.flatnonzero(np.diff(lots)) + 1).tolist(), len(texts)]
            for a, b in zip(cuts, cuts[1:]):
                for doc, found in zip(ids[a:b], aligner.align(texts[a:b])):
                    docs.append((doc, found))
                    links += len(found[4]) // 8 if found else 0
                    if links >= block_links:
                        yield rows(docs)
                        docs, links = [], 0
        if docs:
            yield rows(docs)

    return run


# ---- 2. merge, and 3. what streams back

def _heap_merge(runs: list[tuple[np.ndarray, np.ndarray]]):
    """For each B id in order: (its pairs and their counts, [(run, from, to) of each run that has it])."""
    sides = [pairs >> np.uint64(32) for pairs, _ in runs]
    bounds = [np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]])).tolist() + [len(s)] if len(s) else [0] for s in sides]
    at = [0] * len(runs)
    heap = [(int(s[0]), k) for k, s in enumerate(sides) if len(s)]
    heapq.heapify(heap)
    while heap:
        side, took = heap[0][0], []
        while heap and heap[0][0] == side:
            k = heap[0][1]
            took.append((k, bounds[k][at[k]], bounds[k][at[k] + 1]))
            at[k] += 1
            if at[k] + 1 < len(bounds[k]):
                heapq.heapreplace(heap, (int(sides[k][bounds[k][at[k]]]), k))
            else:
                heapq.heappop(heap)
        pairs, inverse = np.unique(np.concatenate([runs[k][0][a:b] for k, a, b in took]), return_inverse=True)
        counts = np.zeros(len(pairs), np.int64)
        np.add.at(counts, inverse, np.concatenate([runs[k][1][a:b] for k, a, b in took]))
        yield pairs, counts, inverse, took


_MERGED = "part long, block string, n long, data binary"
_REPLIES = "block string, part long, data binary"


def _fold(group: pd.DataFrame) -> pd.DataFrame:
    """One round of the merge: the directories of a group as one, named after it."""
    runs = [_pairs_of(d, n) for d, n in zip(group["data"], group["n"])]
    merged = [(pairs, counts) for pairs, counts, _, _ in _heap_merge(runs)]
    pairs, counts = np.concatenate([m[0] for m in merged]), np.concatenate([m[1] for m in merged])
    return pd.DataFrame({"part": group["part"].iloc[:1], "block": group["parent"].iloc[:1], "n": [len(pairs)], "data": [_directory(pairs, counts)]})


def _reply(counts: np.ndarray, best: np.ndarray) -> bytes:
    return _zip(counts.astype(np.int64), best.astype(np.uint8))


def _answer(group: pd.DataFrame) -> pd.DataFrame:
    """The last round: counts and best pairs of a radix partition, for each of its directories."""
    runs = [_pairs_of(d, n) for d, n in zip(group["data"], group["n"])]
    counts = [np.zeros(len(r[0]), np.int64) for r in runs]
    best = [np.zeros(len(r[0]), bool) for r in runs]
    for _, found, inverse, took in _heap_merge(runs):
        top, at = found == found.max(), 0
        for k, a, b in took:
            own = inverse[at: at + b - a]
            counts[k][a:b], best[k][a:b] = found[own], top[own]
            at += b - a
    return pd.DataFrame({"block": group["block"], "part": group["part"], "data": [_reply(*x) for x in zip(counts, best)]})


def _pass_down(key, children: pd.DataFrame, replies: pd.DataFrame) -> pd.DataFrame:
    """Replies to the directories that were merged into one, from the reply to that one."""
    runs = [_pairs_of(d, n) for d, n in zip(children["data"], children["n"])]
    merged = np.unique(np.concatenate([r[0] for r in runs]))
    counts, best = _replied(replies["data"].iloc[0])
    out = []
    for pairs, _ in runs:
        at = np.searchsorted(merged, pairs)
        out.append(_reply(counts[at], best[at]))
    return pd.DataFrame({"block": children["block"], "part": children["part"], "data": out})


def _replied(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = _unzip(data)
    n = len(raw) // 9
    return np.frombuffer(raw, np.int64, n), np.frombuffer(raw, np.uint8, n, 8 * n).astype(bool)


def _counted(directories: DataFrame, fan_in: int) -> DataFrame:
    """Replies (block, part, data) to directories (part, block, n, data)."""
    rounds = []
    while (most := directories.groupBy("part").count().agg(F.max("count")).first()[0] or 0) > fan_in:
        groups = -(-most * 2 // fan_in)
        parent = F.concat_ws(":", F.lit(str(len(rounds))), F.pmod(F.xxhash64("block"), F.lit(groups)).cast("string"))
        directories = directories.withColumn("parent", parent)
        rounds.append(directories)
        directories = cut(directories.groupBy("part", "parent").applyInPandas(_fold, _MERGED))
    replies = directories.groupBy("part").applyInPandas(_answer, _REPLIES)
    for children in reversed(rounds):
        replies = children.groupBy("part", "parent").cogroup(replies.withColumnRenamed("block", "parent").groupBy("part", "parent")).applyInPandas(
            _pass_down, _REPLIES)
    return replies


_OUT = "doc_id string, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _contributions(group: pd.DataFrame) -> pd.DataFrame:
    """The documents of a block with what its records and the replies to its directory add up to."""
    def of(kind: str) -> pd.DataFrame:
        return group[group["kind"] == kind]

    docs = np.frombuffer(_unzip(of("docs")["data"].iloc[0]), _DOC)
    n = int(of("records")["n"].iloc[0])
    held = np.frombuffer(_unzip(of("records")["data"].iloc[0]), np.uint32).reshape(3, n)
    replies = [_replied(d) for d in of("reply").sort_values("part")["data"]]
    counts, best = (np.concatenate([r[k] for r in replies]) if replies else np.zeros(0, np.int64) for k in (0, 1))
    pair, doc, times = np.cumsum(held[0], dtype=np.uint32), held[1], held[2].astype(np.int64)
    sums = np.zeros((3, len(docs)), np.int64)
    for row, values in zip(sums, (times, np.where(best[pair], times, 0), counts[pair] * times)):
        np.add.at(row, doc, values)
    return pd.DataFrame({
        "doc_id": [str(d["doc_id"]) if d["known"] else None for d in docs],
        "n_a": docs["n_a"], "n_b": docs["n_b"], "n_groups": docs["n_groups"], "n_links": sums[0], "n_best": sums[1], "count_sum": sums[2],
        "groups_sha256": [bytes(d["sha"]).hex() if d["has"] else "" for d in docs],
    })


def align(documents: DataFrame, tokenizer_a: str, tokenizer_b: str, block_links: int = BLOCK_LINKS, fan_in: int = FAN_IN,
          parts: int | None = None) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every document."""
    spark = documents.sparkSession
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/alignment-{uuid4()}"
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows.mapInArrow(_blocks(tokenizer_a, tokenizer_b, parts or partitions_for(documents), block_links), _BLOCKS).write.parquet(folder)
    blocks = spark.read.parquet(folder)
    replies = _counted(blocks.filter("kind = 'pairs'").select("part", "block", "n", "data"), fan_in)
    meeting = blocks.filter("kind != 'pairs'").unionByName(
        replies.select(F.lit("reply").alias("kind"), "block", "part", F.lit(0).cast("long").alias("n"), "data"))
    done = meeting.groupBy("block").applyInPandas(_contributions, _OUT)
    return done.withColumn("doc_id", F.col("doc_id").cast("long"))  # as text meanwhile: null ids would make it a float
