"""Exact removal of repeated byte strings by prefix-free parsing.

A byte of a document goes when it lies in a string of ``LENGTH`` bytes that also starts in a document with a smaller
id. Strings are judged on the input; matches do not cross documents.

Triggers cut texts into phrases: a rolling hash of ``GRAM`` bytes is a trigger where it is the smallest among the
hashes of some ``LENGTH``-byte string. Every such string thus holds a trigger, equal strings hold it at the same place,
and no phrase is longer than a string, so no repeat can be missed.

1. Parse: trigger hashes of whole texts are dealt out by hash; those of a single text cannot lie in a repeat and end
   here. Equal texts count as one, under their smallest id.
2. Dictionary: the shared triggers' phrases, each with the bytes within reach of a string that holds the trigger. A
   phrase that a smaller document holds in full settles all its strings at once.
3. Suffix arrays: the other phrases of a trigger are sorted by their suffixes of ``LENGTH`` bytes; equal neighbours form
   the runs of corpus order in which the smallest id decides.
4. Found intervals return to their documents, which are cut there.

Tasks sum up before they send: of equal triggers of a batch one is sent, of equal phrases that of the smallest id.
Nothing is broadcast or collected; every exchange goes by hash of a trigger or by id.

Defined results: very long texts are parsed whole, in segments of the rolling hash; a null text counts as empty; a text shorter than ``LENGTH`` loses nothing; rows with equal ids do not
take from each other, and equal rows get equal results; rows with a null id keep all their bytes and take from nobody;
an empty table gives an empty table. Columns besides id (an integer) and text are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from math import ceil

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from convoy.llm.common import cut, partitions_for, small_batches

LENGTH = 50
GRAM = 20
REACH = LENGTH - GRAM  # bytes before a trigger that a string holding it may begin
CONTEXT = REACH + LENGTH
#: Bytes of text that a task gathers before it sends, and that one bucket of triggers stands for.
FLUSH_BYTES = 4_000_000
BUCKET_BYTES = 3_000_000
#: Strings that one sort holds.
SORT_ROWS = 100_000
#: Bytes that one pass of the rolling hash takes; its tables of powers travel with the functions and stay small.
SEGMENT = 1 << 14

_BASE = 0x9E3779B97F4A7C15 | 1


def _powers(base: int) -> np.ndarray:
    out = np.full(SEGMENT + LENGTH, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_UP, _DOWN = _powers(_BASE), _powers(pow(_BASE, -1, 2**64))
_SPREAD = np.cumprod(np.full(CONTEXT + 2, 0xD1342543DE82EF95, np.uint64), dtype=np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _slide(x: np.ndarray, width: int, of) -> np.ndarray:
    """``of`` (minimum or maximum) over every ``width`` neighbours."""
    size = 1
    while 2 * size <= width:
        x = of(x[:-size], x[size:])
        size *= 2
    rest = width - size
    return of(x[: len(x) - rest], x[rest:]) if rest else x


def triggers(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(positions, hashes) of the triggers of a text."""
    places, hashes = [], []
    width = LENGTH - GRAM + 1
    for start in range(0, len(raw) - LENGTH + 1, SEGMENT):
        part = raw[start: start + SEGMENT + LENGTH - 1]
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(part * _UP[: len(part)], dtype=np.uint64)])
        grams = _mix((sums[GRAM:] - sums[:-GRAM]) * _DOWN[: len(part) - GRAM + 1])
        order = (grams >> np.uint64(32)).astype(np.uint32)
        least = _slide(order, width, np.minimum)
        pad = np.zeros(width - 1, np.uint32)
        at = np.flatnonzero(order == _slide(np.concatenate([pad, least, pad]), width, np.maximum))
        places.append(at + start)
        hashes.append(grams[at])
    if not places:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    positions, first = np.unique(np.concatenate(places), return_index=True)
    return positions, np.concatenate(hashes)[first]


def _bytes_of(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-8", "replace"), np.uint8)


def _runs(keys: np.ndarray) -> np.ndarray:
    """Starts of the runs of equal values."""
    return np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)


def _pack(values: np.ndarray) -> bytes:
    """The low 48 bits of values, six bytes each."""
    return np.ascontiguousarray(values.astype(np.uint64)).view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _unpack(data: bytes, n: int, start: int = 0) -> np.ndarray:
    out = np.zeros((n, 8), np.uint8)
    out[:, :6] = np.frombuffer(data, np.uint8, 6 * n, start).reshape(-1, 6)
    return out.view(np.uint64).ravel()


def _bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets in the order of the hashes, of which 48 bits are left."""
    return ((hashes >> np.uint64(16)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def _by_key(keys: np.ndarray, *columns: np.ndarray):
    """(key, its part of every column), after a stable sort by key."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    starts = _runs(keys)
    for a, b in zip(starts, [*starts[1:], len(keys)]):
        yield int(keys[a]), *(c[order[a:b]] for c in columns)


def _batches(frames, columns: list[str]):
    """Lists of rows with about ``FLUSH_BYTES`` of text."""
    rows, size = [], 0
    for frame in frames:
        for row in zip(*(frame[c] for c in columns)):
            rows.append(row)
            size += len(row[-1] or "") + 64
            if size >= FLUSH_BYTES:
                yield rows
                rows, size = [], 0
    if rows:
        yield rows


# ---- 1. which triggers occur in two texts
#
# Hashes of triggers and texts travel with 48 bits. Triggers or replies that coincide by chance only
# send a few phrases too many to step 2, where bytes decide; two texts of one trigger that coincide
# (once in 2**48 pairs) would be taken for one.

_SENT = "bucket long, reply boolean, a long, b long, data binary"


def _sent(rows: list) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["bucket", "reply", "a", "b", "data"])


def _short(cls: int) -> int:
    return cls & (1 << 48) - 1


def _parse(buckets: int):
    def run(frames):
        for rows in _batches(frames, ["cls", "text"]):
            hashes, owners = [], []
            for cls, text in rows:
                found = np.unique(triggers(_bytes_of(text))[1] >> np.uint64(16))
                hashes.append(found)
                owners.append(np.full(len(found), _short(cls), np.int64))
            hashes, owners = np.concatenate(hashes), np.concatenate(owners)
            order = np.lexsort((owners, hashes))
            hashes, owners = hashes[order], owners[order]
            starts = _runs(hashes)
            if not len(starts):
                continue
            counts = np.diff([*starts, len(hashes)])
            shared = owners[starts] != owners[starts + counts - 1]
            # What two texts of the batch share is known here; it is sent once, marked as shared.
            mine = np.repeat(shared, counts)
            out = [(cls % buckets, True, cls, 0, _pack(h)) for cls, h in _by_key(owners[mine], hashes[mine])]
            firsts = hashes[starts]
            place = _bucket(firsts, buckets)
            cuts = _runs(place)
            for a, b in zip(cuts, [*cuts[1:], len(place)]):
                data = _pack(firsts[a:b]) + _pack(owners[starts[a:b]]) + np.packbits(shared[a:b]).tobytes()
                out.append((int(place[a]), False, int(b - a), 0, data))
            yield _sent(out)

    return run


def _shared(groups: int):
    """Shared triggers of a bucket, packed by groups of texts: (text, number of triggers) pairs, then the triggers."""
    def run(bucket: pd.DataFrame) -> pd.DataFrame:
        rows = _shared_by_text(bucket)
        texts = np.array([r[0] for r in rows], np.int64)
        place = np.empty(len(rows), np.int64)
        place[:] = texts % groups
        out = []
        for group, at in _by_key(place, np.arange(len(rows))):
            data = [rows[k][1] for k in at]
            head = np.stack([texts[at], np.array([len(d) // 6 for d in data], np.int64)], 1)
            out.append((group, len(at), head.tobytes() + b"".join(data)))
        return pd.DataFrame(out, columns=["group", "n", "data"])

    return run


def _gather(group: pd.DataFrame) -> pd.DataFrame:
    """All shared triggers of each text of a group."""
    found: dict[int, list[bytes]] = {}
    for n, data in zip(group["n"], group["data"]):
        at = 16 * n
        for text, count in np.frombuffer(data, np.int64, 2 * n).reshape(-1, 2).tolist():
            found.setdefault(text, []).append(data[at: at + 6 * count])
            at += 6 * count
    return pd.DataFrame([(text, b"".join(parts)) for text, parts in found.items()], columns=["short", "shared"])


def _shared_by_text(group: pd.DataFrame) -> list[tuple[int, bytes]]:
    hashes, owners, known = [], [], []
    for n, data in zip(group["a"][~group["reply"]], group["data"][~group["reply"]]):
        hashes.append(_unpack(data, n))
        owners.append(_unpack(data, n, 6 * n).astype(np.int64))
        known.append(np.unpackbits(np.frombuffer(data, np.uint8, -1, 12 * n), count=n).astype(bool))
    out = [(int(cls), data) for cls, data in zip(group["a"][group["reply"]], group["data"][group["reply"]])]
    if hashes:
        hashes, owners, known = np.concatenate(hashes), np.concatenate(owners), np.concatenate(known)
        order = np.lexsort((owners, hashes))
        hashes, owners, known = hashes[order], owners[order], known[order]
        starts = _runs(hashes)
        counts = np.diff([*starts, len(hashes)])
        hit = np.logical_or.reduceat(known, starts) | (owners[starts] != owners[starts + counts - 1])
        tell = np.repeat(hit, counts) & ~known
        out += [(cls, _pack(np.unique(h))) for cls, h in _by_key(owners[tell], hashes[tell])]
    return out


# ---- 2. and 3. phrases of shared triggers, and what is removed

_SENT_ENTRY = [("doc", "i8"), ("row", "i8"), ("at", "i8"), ("left", "u1"), ("right", "u1"), ("text", "u1", (CONTEXT,))]
_ENTRY = np.dtype([("h", "u8"), ("key", "u8"), *_SENT_ENTRY])
_SENT_ENTRY = np.dtype(_SENT_ENTRY)


def _entries(doc: int, row: int, text: str, shared: np.ndarray) -> np.ndarray:
    """Phrases of the shared triggers of a text; ``row`` stands for id and text."""
    raw = _bytes_of(text)
    at, hashes = triggers(raw)
    at = at[np.isin(hashes >> np.uint64(16), shared)]
    out = np.zeros(len(at), _ENTRY)
    out["doc"], out["row"], out["at"] = doc, row, at
    out["left"], out["right"] = np.minimum(at, REACH), np.minimum(len(raw) - at, LENGTH)
    padded = np.concatenate([np.zeros(REACH, np.uint8), raw, np.zeros(LENGTH, np.uint8)])
    for a in range(0, len(at), 20_000):
        part = out[a: a + 20_000]
        part["text"] = padded[part["at"][:, None] + np.arange(CONTEXT)]
    return _keyed(out)


def _keyed(entries: np.ndarray) -> np.ndarray:
    """Fills in the hashes of trigger and phrase."""
    for a in range(0, len(entries), 20_000):
        part = entries[a: a + 20_000]
        wide = part["text"].astype(np.uint64)
        part["h"] = _mix(wide[:, REACH: REACH + GRAM] @ _UP[:GRAM])
        sums = wide @ _SPREAD[:CONTEXT] + part["left"] * _SPREAD[-2] + part["right"] * _SPREAD[-1]
        part["key"] = _mix(_mix(sums) ^ part["h"])
    return entries


def _send(entries: np.ndarray) -> bytes:
    out = np.zeros(len(entries), _SENT_ENTRY)
    for name in _SENT_ENTRY.names:
        out[name] = entries[name]
    return zlib.compress(out.tobytes(), 1)


def _receive(data: bytes) -> np.ndarray:
    sent = np.frombuffer(zlib.decompress(data), _SENT_ENTRY)
    out = np.zeros(len(sent), _ENTRY)
    for name in _SENT_ENTRY.names:
        out[name] = sent[name]
    return _keyed(out)


def _span(entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest and largest number of bytes before the trigger at which a string of the phrase may begin."""
    return np.maximum(LENGTH - entries["right"].astype(np.int64), 0), np.minimum(entries["left"].astype(np.int64), REACH)


def _intervals(entries: np.ndarray) -> np.ndarray:
    """(start, end) of the bytes that strings of each phrase cover; empty ones are left out."""
    low, high = _span(entries)
    pairs = np.stack([entries["at"] - high, entries["at"] - low + LENGTH], 1)
    return pairs[high >= low]


def _smallest_first(entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(entries by phrase and id, for each the smallest id that holds its phrase)."""
    entries = entries[np.lexsort((entries["doc"], entries["key"]))]
    starts = _runs(entries["key"])
    return entries, np.repeat(entries["doc"][starts], np.diff([*starts, len(entries)]))


def _replies(entries: np.ndarray, buckets: int) -> list:
    out = []
    if len(entries):
        for row, part in _by_key(entries["row"], entries):
            pairs = _intervals(part)
            if len(pairs):
                out.append((row % buckets, True, row, 0, merge(pairs).tobytes()))
    return out


def _phrases(buckets: int):
    def run(frames):
        for rows in _batches(frames, ["doc_id", "row", "shared", "text"]):
            parts = [
                _entries(doc, row, text, np.unique(_unpack(shared, len(shared) // 6)))
                for doc, row, shared, text in rows
            ]
            entries, smallest = _smallest_first(np.concatenate(parts))
            late = entries["doc"] > smallest
            out = _replies(entries[late], buckets)
            rest = entries[~late]
            place = _bucket(rest["h"] >> np.uint64(16), buckets)
            out += [(bucket, False, len(part), 0, _send(part)) for bucket, part in _by_key(place, rest)]
            yield _sent(out)

    return run


def _removed(group: pd.DataFrame) -> pd.DataFrame:
    out = list(zip(group["a"][group["reply"]], group["data"][group["reply"]]))
    parts = [_receive(data) for data in group["data"][~group["reply"]]]
    if parts:
        entries, smallest = _smallest_first(np.concatenate(parts))
        late = entries["doc"] > smallest
        out += [(row, data) for _, _, row, _, data in _replies(entries[late], 1)]
        out += _by_suffix(entries[~late])
    return pd.DataFrame(out, columns=["row", "data"])


def _by_suffix(entries: np.ndarray) -> list:
    """Intervals found by sorting the suffixes of phrases that share a trigger but are not equal."""
    entries = entries[np.lexsort((entries["key"], entries["h"]))]
    new_phrase = np.concatenate([[True], entries["key"][1:] != entries["key"][:-1]])
    phrase = np.cumsum(new_phrase) - 1  # of each entry
    distinct = entries[new_phrase]
    starts = _runs(distinct["h"])
    counts = np.diff([*starts, len(distinct)])
    several = np.repeat(counts > 1, counts)
    group = np.repeat(np.arange(len(starts)), counts)
    pairs = []
    chosen = np.flatnonzero(several)
    # Whole triggers at a time, so that the sorts stay small.
    weight = np.cumsum(np.ones(len(chosen), np.int64) * (REACH + 1)) // SORT_ROWS
    first_of_group = np.concatenate([[True], group[chosen][1:] != group[chosen][:-1]]) if len(chosen) else np.zeros(0, bool)
    lot = np.maximum.accumulate(np.where(first_of_group, weight, 0)) if len(chosen) else weight
    for _, part in _by_key(lot, chosen):
        rows = distinct[part]
        low, high = _span(rows)
        sizes = np.maximum(high - low + 1, 0)
        owner = np.repeat(np.arange(len(rows)), sizes)
        before = np.repeat(low, sizes) + np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        strings = np.lib.stride_tricks.sliding_window_view(rows["text"], LENGTH, axis=1)[owner, REACH - before]
        suffixes = np.ascontiguousarray(strings).view(f"S{LENGTH}").ravel()
        order = np.argsort(suffixes, kind="stable")
        sorted_suffixes, owner, before = suffixes[order], owner[order], before[order]
        run = _runs(sorted_suffixes)
        if not len(run):
            continue
        smallest = np.repeat(np.minimum.reduceat(rows["doc"][owner], run), np.diff([*run, len(owner)]))
        gone = rows["doc"][owner] > smallest
        pairs.append(np.stack([part[owner[gone]], before[gone]], 1))
    if not pairs:
        return []
    pairs = np.concatenate(pairs)
    # Every place of the phrase in its document loses the same strings.
    pairs = pairs[np.argsort(pairs[:, 0], kind="stable")]
    begin, end = np.searchsorted(pairs[:, 0], phrase, "left"), np.searchsorted(pairs[:, 0], phrase, "right")
    count = end - begin
    at = np.repeat(entries["at"], count) - pairs[np.repeat(begin - (np.cumsum(count) - count), count) + np.arange(count.sum()), 1]
    spans = np.stack([at, at + LENGTH], 1)
    return [(row, merge(part).tobytes()) for row, part in _by_key(np.repeat(entries["row"], count), spans)]


def merge(spans: np.ndarray) -> np.ndarray:
    """Spans (start, end) joined where they overlap or touch, in order."""
    if not len(spans):
        return spans.reshape(0, 2)
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    ends = np.maximum.accumulate(spans[:, 1])
    first = np.concatenate([[True], spans[1:, 0] > ends[:-1]])
    return np.stack([spans[first, 0], ends[np.concatenate([np.flatnonzero(first)[1:] - 1, [len(spans) - 1]])]], 1)


# ---- 4. the documents without what was found

def _cut_out(with_bytes: bool):
    def run(frames):
        for frame in frames:
            rows = []
            for doc, text, copy, data in zip(frame["doc_id"], frame["text"], frame["copy"], frame["data"]):
                raw = (text or "").encode("utf-8", "replace")
                spans = np.zeros((0, 2), np.int64)
                if copy and len(raw) >= LENGTH:
                    spans = np.array([[0, len(raw)]])
                elif data is not None and len(data):
                    spans = merge(np.concatenate([np.frombuffer(x, np.int64).reshape(-1, 2) for x in data]))
                kept, at = [], 0
                for a, b in spans:
                    kept.append(raw[at:a])
                    at = int(b)
                kept = b"".join([*kept, raw[at:]])
                row = (doc, len(raw), len(raw) - len(kept), len(spans), hashlib.sha256(kept).hexdigest())
                rows.append((*row, kept) if with_bytes else row)
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_bytes"]
            yield pd.DataFrame(rows, columns=names[: 5 + with_bytes])

    return run


def remove_repeats(documents: DataFrame, with_bytes: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, if asked for, kept_bytes of every row."""
    spark = documents.sparkSession
    small_batches(spark, 200)
    source = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    source = source.withColumn("cls", F.xxhash64("text", F.length("text")))
    narrow = cut(source.select("doc_id", "cls", F.octet_length("text").cast("long").alias("size")))
    total = narrow.agg(F.sum("size")).first()[0] or 0
    buckets = max(partitions_for(documents), ceil(total / BUCKET_BYTES))
    row = F.xxhash64("doc_id", "cls")
    # Texts are shuffled once; both joins below read the same exchange.
    dealt = source.select(row.alias("row"), "doc_id", "cls", "text").repartition("row")

    def same_text(cls: str):
        return F.col("cls").bitwiseXOR(F.col(cls)) == 0

    sent = source.filter(F.col("doc_id").isNotNull() & (F.octet_length("text") >= LENGTH)).select("cls", "text").mapInPandas(_parse(buckets), _SENT)
    packed = sent.groupBy("bucket").applyInPandas(_shared(partitions_for(documents)), "group long, n long, data binary")
    shared = packed.groupBy("group").applyInPandas(_gather, "short long, shared binary")
    first = narrow.filter("doc_id is not null").groupBy("cls").agg(F.min("doc_id").alias("first"))
    wanted = first.withColumn("short", F.col("cls").bitwiseAND(F.lit((1 << 48) - 1))).join(shared, "short").select(
        F.xxhash64("first", "cls").alias("of"), F.col("cls").alias("c"), "shared")

    texts = dealt.join(wanted, F.col("row") == F.col("of")).filter(same_text("c")).select("doc_id", "row", "shared", "text")
    sent = texts.mapInPandas(_phrases(buckets), _SENT)
    found = sent.groupBy("bucket").applyInPandas(_removed, "row long, data binary")
    found = found.groupBy(F.col("row").alias("of")).agg(F.collect_list("data").alias("data"))

    ids = narrow.filter("doc_id is not null").select("doc_id", "cls").distinct().join(first, "cls")
    marks = (
        ids.withColumn("_row", row).join(found, F.col("_row") == F.col("of"), "left")
        .filter("doc_id > first or data is not null")
        .select(F.col("_row").alias("of"), F.col("cls").alias("c"), (F.col("doc_id") > F.col("first")).alias("copy"), "data")
    )
    rows = (
        dealt.join(marks, (F.col("row") == F.col("of")) & same_text("c"), "left")
        .select(F.col("doc_id").cast("string"), "text", F.coalesce("copy", F.lit(False)).alias("copy"), "data")
    )
    schema = "doc_id string, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept_bytes binary" * with_bytes
    done = rows.mapInPandas(_cut_out(with_bytes), schema)
    return done.withColumn("doc_id", F.col("doc_id").cast("long"))  # as text meanwhile: null ids would make it a float
