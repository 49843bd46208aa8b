"""Token ids as length-delimited binary records, with an offset index for reads in any order.

A record file is a row of frames: length of the payload (8 bytes), its masked CRC-32C (4), the payload, its masked
CRC-32C (4); all numbers are little-endian, the framing is that of TFRecord. A payload is the byte width of an id, a
byte that is 1 where the document has an id, the document's id (8 bytes) and the token ids.

``write_records`` sorts documents by id over range partitions and each task streams its range into files of about
``FILE_BYTES``. Files lie beside two Parquet tables: ``index`` has file, offset and length of each record, ``files`` the
files in order with the number of ids before each. Every attempt of a task writes files of its own, and only those that
Spark's commit of the index names count, so lost executors and repeated tasks leave no trace in what is read.

``read_records`` deals pieces of files to tasks by the index, each read as a few large reads; ``read_shuffled`` deals
single records by a hash of their place and reads them by offset in that order. Both check all checksums.

Defined results: a null or empty text is a record with the end id alone; a null id sorts first and stays null; rows with
equal ids stand in order of a hash of their text, equal rows one after another; an empty table gives no file. A text is
encoded whole however long; the longest one must fit in a worker's memory. Other columns are ignored.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from functools import cache
from uuid import uuid4

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from convoy.llm.crc32c import masked

FILE_BYTES = 64_000_000
#: Bytes of text for one range of ids, and of records for one piece that a task reads.
RANGE_BYTES = 64_000_000
PIECE_BYTES = 32_000_000
FLUSH_BYTES = 4_000_000
#: Letters that are encoded together, and words in one string for the tokenizer, which is slower on longer strings.
ENCODE_CHARS = 8_000_000
JOINED_WORDS = 500
#: Strings between blanks whose ids a worker remembers, twice that for a while.
REMEMBERED = 600_000

_HEAD = "<BBq"
_HEAD_BYTES = struct.calcsize(_HEAD)
_FRAME = 16  # bytes of a record besides its payload


#: Letters that stay one character each in every normal form; and marks that are tokens of their own after them.
_LATIN = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+").fullmatch
_MARKS = ",.;:!?"


class ChunkEncoder:
    """Ids of texts by a tokenizer that never joins over a blank; strings between blanks are encoded once and remembered."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        self.tokenizer = Tokenizer.from_file(path)
        self.kind = np.dtype("<u2") if self.tokenizer.get_vocab_size() <= 1 << 16 else np.dtype("<u4")
        # Two generations: what is met again moves on, so frequent strings stay and rare ones go.
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}
        self.marks = {mark: self._single(mark) for mark in ("", *_MARKS)}
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        self.last = np.zeros(max(self.tokenizer.get_vocab().values()) + 1, bool)
        if suffix:
            self.last[[i for token, i in self.tokenizer.get_vocab().items() if token.endswith(suffix)]] = True
        # Whether words may be encoded in lower case, many in one string, and told apart by the ends of words.
        self.joins = bool(suffix) and self._single("AbÉ,") == self._single("abé") + self.marks[","]
        self.lowers = self.joins and all(self._single(c) == self._single(c.lower()) for c in map(chr, range(256)))
        self.special = [t.content.lower() for t in self.tokenizer.get_added_tokens_decoder().values()]

    def _single(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.kind).tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.known) > REMEMBERED:
            self.older, self.known, self.words = self.known, {}, {}
        # Each batch's distinct pieces are looked up once; numpy puts the ids of its texts together from theirs.
        split = pc.split_pattern(pa.array([self._lowered(text).replace("\n", " ") for text in texts], pa.large_string()), " ")
        coded = split.flatten().dictionary_encode()
        pieces = coded.dictionary.to_pylist()
        found = list(map(self.known.get, pieces))
        missing = [i for i, ids in enumerate(found) if ids is None]
        self._learn([pieces[i] for i in missing])
        for i in missing:
            found[i] = self.known[pieces[i]]
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // self.kind.itemsize
        codes = coded.indices.to_numpy()
        counts = sizes[codes]
        ends = np.concatenate([[0], np.cumsum(counts)])
        places = np.repeat((np.cumsum(sizes) - sizes)[codes] - ends[:-1], counts) + np.arange(ends[-1])
        data = np.frombuffer(b"".join(found), self.kind)[places].tobytes()
        cuts = (ends[split.offsets.to_numpy()] * self.kind.itemsize).tolist()
        return [data[a:b] for a, b in zip(cuts, cuts[1:])]

    def _lowered(self, text: str) -> str:
        """In lower case where the tokenizer sees no difference, so that fewer strings are to be learned and remembered."""
        low = text.lower()
        if not self.lowers or any(token in low for token in self.special):
            return text
        try:
            text.encode("latin-1")  # lower case is one character for one there, in any normal form
        except UnicodeEncodeError:
            return text
        return low

    def _learn(self, pieces: list[str]) -> None:
        plain, other = [], []
        for piece in pieces:
            if (ids := self.older.get(piece)) is not None:
                self.known[piece] = ids
                continue
            core, mark = (piece[:-1], piece[-1]) if piece and piece[-1] in _MARKS else (piece, "")
            if self.joins and (core.isascii() and core.isalpha() or _LATIN(core)):
                plain.append((piece, core.lower(), mark))
            else:
                other.append(piece)
        self._learn_words(list({core for _, core, _ in plain}.difference(self.words)))
        for piece, core, mark in plain:
            self.known[piece] = self.words[core] + self.marks[mark]
        for a in range(0, len(other), 20_000):
            part = other[a: a + 20_000]
            for piece, encoded in zip(part, self.tokenizer.encode_batch_fast(part, add_special_tokens=False)):
                self.known[piece] = np.array(encoded.ids, self.kind).tobytes()

    def _learn_words(self, words: list[str]) -> None:
        """Words of letters alone, many at a time in one string: each ends with the token that ends a word."""
        for a in range(0, len(words), JOINED_WORDS):
            part = words[a: a + JOINED_WORDS]
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, self.kind)
            ends = ((np.flatnonzero(self.last[ids]) + 1) * self.kind.itemsize).tolist()
            if len(ends) != len(part):
                raise ValueError("the tokenizer does not end words as it says")
            data = ids.tobytes()
            for word, start, end in zip(part, [0, *ends], ends):
                self.words[word] = data[start:end]


@cache
def _encoder(path: str) -> ChunkEncoder:
    return ChunkEncoder(path)


def frames(payloads: list[bytes]) -> list[bytes]:
    lengths = [struct.pack("<Q", len(p)) for p in payloads]
    return [
        b"".join((length, a.tobytes(), payload, b.tobytes()))
        for length, a, payload, b in zip(lengths, masked(lengths).astype("<u4"), payloads, masked(payloads).astype("<u4"))
    ]


def unframe(data: bytes) -> list[bytes]:
    """Payloads of the frames that ``data`` consists of; wrong lengths or checksums are errors."""
    lengths, payloads, sums, at = [], [], [], 0
    while at < len(data):
        size = struct.unpack_from("<Q", data, at)[0]
        if at + _FRAME + size > len(data):
            raise ValueError("a record ends early")
        lengths.append(data[at: at + 8])
        payloads.append(data[at + 12: at + 12 + size])
        sums.append((data[at + 8: at + 12], data[at + 12 + size: at + _FRAME + size]))
        at += _FRAME + size
    for parts, stored in ((lengths, [s[0] for s in sums]), (payloads, [s[1] for s in sums])):
        if masked(parts).astype("<u4").tobytes() != b"".join(stored):
            raise ValueError("a record's checksum does not fit")
    return payloads


def _ids(payload: bytes) -> np.ndarray:
    return np.frombuffer(payload, f"<u{payload[0]}", offset=_HEAD_BYTES)


_INDEX = "file string, number long, offset long, length long, before long, n_tokens long, doc_id long"
_INDEX_ARROW = pa.schema([
    ("file", pa.string()), ("number", pa.int64()), ("offset", pa.int64()), ("length", pa.int64()), ("before", pa.int64()),
    ("n_tokens", pa.int64()), ("doc_id", pa.int64()),
])


def _write(folder: str, tokenizer: str, end_id: int, file_bytes: int):
    def run(batches):
        encoder, (store, root) = _encoder(tokenizer), fs.FileSystem.from_uri(folder)
        range_number, attempt = TaskContext.get().partitionId(), uuid4().hex[:12]
        end = np.array([end_id], encoder.kind).tobytes()
        out, files, offset, before = None, 0, 0, 0
        try:
            for batch in batches:
                ids, texts = batch.column("doc_id").to_pylist(), [t or "" for t in batch.column("text").to_pylist()]
                sizes = np.cumsum([len(t) for t in texts]) // ENCODE_CHARS
                cuts = [0, *(np.flatnonzero(np.diff(sizes)) + 1).tolist(), len(texts)]
                for a, b in zip(cuts, cuts[1:]):
                    payloads = [
                        struct.pack(_HEAD, encoder.kind.itemsize, doc is not None, doc or 0) + tokens + end
                        for doc, tokens in zip(ids[a:b], encoder.encode(texts[a:b]))
                    ]
                    rows = []
                    for doc, payload, frame in zip(ids[a:b], payloads, frames(payloads)):
                        if out is None or offset >= file_bytes:
                            if out is not None:
                                out.close()
                            name = f"{range_number:08d}-{files:06d}-{attempt}.rec"
                            out, files, offset, before = store.open_output_stream(f"{root}/data/{name}"), files + 1, 0, 0
                        out.write(frame)
                        n = (len(payload) - _HEAD_BYTES) // encoder.kind.itemsize
                        rows.append((name, (range_number << 20) + files, offset, len(payload), before, n, doc))
                        offset, before = offset + len(frame), before + n
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _INDEX_ARROW.types)], schema=_INDEX_ARROW)
        finally:
            if out is not None:
                out.close()

    return run


def write_records(documents: DataFrame, folder: str, tokenizer: str, end_id: int, file_bytes: int = FILE_BYTES,
                  range_bytes: int = RANGE_BYTES) -> None:
    """Writes every document's ids and the end id to ``folder``, in ascending order of doc_id."""
    spark = documents.sparkSession
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = max(spark.sparkContext.defaultParallelism, int(total // range_bytes) + 1)
    # The place keeps a crowd of equal rows from being one range.
    keyed = rows.withColumns({"tie": F.xxhash64("text"), "place": F.monotonically_increasing_id()})
    ordered = keyed.repartitionByRange(ranges, F.asc_nulls_first("doc_id"), "tie", "place").sortWithinPartitions(
        F.asc_nulls_first("doc_id"), "tie", "place")
    store, root = fs.FileSystem.from_uri(folder)
    store.create_dir(f"{root}/data", recursive=True)
    index = ordered.select("doc_id", "text").mapInArrow(_write(folder, tokenizer, end_id, file_bytes), _INDEX)
    index.write.mode("overwrite").parquet(f"{folder}/index")
    files = spark.read.parquet(f"{folder}/index").groupBy("file", "number").agg(
        F.sum("n_tokens").alias("n_tokens"), F.count(F.lit(1)).alias("n_records"), F.sum(F.col("length") + _FRAME).alias("bytes"))
    # One row a file of tens of megabytes: 100 TB are about a million rows of this window.
    earlier = Window.orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    files.withColumn("start", F.coalesce(F.sum("n_tokens").over(earlier), F.lit(0))).write.mode("overwrite").parquet(f"{folder}/files")


def _index(spark: SparkSession, folder: str) -> tuple[DataFrame, int]:
    """(index with the number of ids before each record, bytes of all files)."""
    files = spark.read.parquet(f"{folder}/files")
    index = spark.read.parquet(f"{folder}/index").join(files.select("file", F.col("start").alias("base")), "file")
    total = files.agg(F.sum("bytes")).first()[0] or 0
    return index.select("file", "offset", "length", (F.col("base") + F.col("before")).alias("start")), total


def _stretches(batches):
    """(file, offset, bytes, start of each record) of neighbours in a file, of limited size."""
    now = None
    for batch in batches:
        for file, offset, length, start in zip(*(batch.column(c).to_pylist() for c in ("file", "offset", "length", "start"))):
            if now and now[0] == file and now[1] + now[2] == offset and now[2] < FLUSH_BYTES:
                now[2] += length + _FRAME
                now[3].append(start)
            else:
                if now:
                    yield now
                now = [file, offset, length + _FRAME, [start]]
    if now:
        yield now


def _read(folder: str, schema: pa.Schema, row):
    def run(batches):
        store, root = fs.FileSystem.from_uri(folder)
        opened, source = None, None
        rows, size = [], 0
        for file, offset, length, starts in _stretches(batches):
            if file != opened:
                if source is not None:
                    source.close()
                opened, source = file, store.open_input_file(f"{root}/data/{file}")
            data = source.read_at(length, offset)
            if len(data) < length:
                raise ValueError("a file of records ends early")
            for start, payload in zip(starts, unframe(data)):
                _, known, doc = struct.unpack_from(_HEAD, payload)
                rows.append((doc if known else None, start, *row(_ids(payload))))
            size += length
            if size >= FLUSH_BYTES:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)
                rows, size = [], 0
        if source is not None:
            source.close()
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

    return run


def _with_ids(ids: np.ndarray) -> tuple:
    return (ids.astype(np.int32),)


def _digest(ids: np.ndarray) -> tuple:
    return len(ids), zlib.crc32(ids.astype("<u4").tobytes())


_ROW = [("doc_id", pa.int64()), ("start", pa.int64())]
_IDS = pa.schema([*_ROW, ("ids", pa.list_(pa.int32()))])
_DIGESTS = pa.schema([*_ROW, ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])


def _in_pieces(spark: SparkSession, folder: str) -> DataFrame:
    index, total = _index(spark, folder)
    tasks = max(spark.sparkContext.defaultParallelism, int(total // PIECE_BYTES) + 1)
    piece = F.floor(F.col("offset") / PIECE_BYTES)
    return index.repartition(tasks, "file", piece).sortWithinPartitions("file", "offset")


def read_records(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start (ids of all records before it) and ids of every record."""
    return _in_pieces(spark, folder).mapInArrow(_read(folder, _IDS, _with_ids), "doc_id long, start long, ids array<int>")


def read_digests(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every record."""
    return _in_pieces(spark, folder).mapInArrow(
        _read(folder, _DIGESTS, _digest), "doc_id long, start long, n_tokens long, ids_crc32 long")


def read_shuffled(spark: SparkSession, folder: str, seed: int, tasks: int | None = None) -> DataFrame:
    """As ``read_records``, every record at a place that ``seed`` decides; each is one read by offset."""
    index, total = _index(spark, folder)
    drawn = F.xxhash64(F.lit(seed), "file", "offset")
    tasks = tasks or max(spark.sparkContext.defaultParallelism, int(total // PIECE_BYTES) + 1)
    dealt = index.withColumn("_drawn", drawn).repartition(tasks, "_drawn").sortWithinPartitions("_drawn")
    return dealt.mapInArrow(_read(folder, _IDS, _with_ids), "doc_id long, start long, ids array<int>")
