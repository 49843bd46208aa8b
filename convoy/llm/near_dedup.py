"""MinHash near-duplicate detection with sequential Bayesian verification.

A document's set holds its distinct shingles of ``size`` words, hashed to 64 bits; with fewer words the whole sequence
is one shingle, without words the set is empty and linked with nothing. Documents with equal sets form a class. Two
classes are linked when the Jaccard similarity of their full sets is at least 80 %, and a component is what links reach.

1. Every document gets a digest of its set and a signature of 96 minimum hashes; classes are groups of digests.
2. 24 bands of 4 hashes propose candidates. A pair at 80 % similarity shares no band with probability
   (1 - 0.8**4)**24 = 3.2e-6. A bucket proposes its members against its first member, never all pairs.
3. The signatures of a candidate are compared in batches; after each batch it is dropped when the posterior probability
   that its similarity reaches the threshold is below ``MISS`` (uniform prior). Survivors are verified on full sets.
4. Components are formed. Buckets whose members now lie in several components go through again, with their sets: members
   are compared with members of other components only, by signature and then exactly, in blocks of bounded size, and
   what is found joins components at once. A task gives at most one link a member, so no link is left out because two
   documents never met a common first member, and a group that is one component already costs nothing more.

Defined results: very long texts count with their whole set of shingles, which must fit in a worker; null and empty texts have n_shingles 0 and are their own component; rows that are equal or share an
id count in one class each by their text; the component id is the smallest id reachable, null only if all ids in it are
null, in which case ``kept`` is true for each of these rows; an empty table gives an empty table. Rows are told apart by
a hash of id and text, so those without an id are linked like any others. ``mark_near_duplicates`` keeps one text of a
component, also where ids are null or shared, and carries other columns through; columns of the names in ``COLUMNS``
are replaced.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from convoy.llm.common import cut, odd_multipliers, shelter, small_batches, word_codes
from convoy.llm.components import merge_labels

SIZE = 5
PERCENT = 80
BANDS, ROWS = 24, 4
HASHES = BANDS * ROWS
BATCH = 16
#: Chosen probability to drop a pair above the threshold at a comparison of signatures.
MISS = 1e-5
#: Members of a bucket that meet in one task at most, squared.
BLOCK = 512
COLUMNS = ("n_shingles", "component_id", "kept")

_A = np.array(odd_multipliers(HASHES, 11), np.uint64)
_B = np.array(odd_multipliers(HASHES, 12), np.uint64)
_STEPS = np.array(odd_multipliers(64, 13), np.uint64)
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a whole text."""
    words = text.encode("utf-8", "replace").translate(_LOWER).split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    codes = word_codes(words)
    span = min(size, len(words))
    n = len(words) - span + 1
    out = np.full(n, span, np.uint64)
    for k in range(span):
        out = (out ^ codes[k: k + n]) * _STEPS[k % 64]
        out ^= out >> np.uint64(29)
    return np.unique(out)


def signature(shingles: np.ndarray) -> np.ndarray:
    out = np.full(HASHES, 2**32 - 1, np.uint32)
    for start in range(0, len(shingles), 4096):
        part = shingles[start: start + 4096]
        hashed = (part[None, :] * _A[:, None] + _B[:, None]) >> np.uint64(32)
        out = np.minimum(out, hashed.min(1).astype(np.uint32))
    return out


def least_matches(percent: int = PERCENT, miss: float = MISS) -> list[int]:
    """For each batch, the matches below which the posterior of similarity >= threshold is under ``miss``."""
    grid = (np.arange(4000) + 0.5) / 4000
    out = []
    for n in range(BATCH, HASHES + 1, BATCH):
        m = np.arange(n + 1)[:, None]
        log = m * np.log(grid) + (n - m) * np.log1p(-grid)
        density = np.exp(log - log.max(1, keepdims=True))
        tail = density[:, grid >= percent / 100].sum(1) / density.sum(1)
        out.append(int(np.argmax(tail >= miss)))
    return out


def survives(left: np.ndarray, right: np.ndarray, least: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """(rows of two signature matrices that are never pruned, their matches)."""
    rows = np.arange(len(left))
    matches = np.zeros(len(left), np.int64)
    for k, bound in enumerate(least):
        part = slice(k * BATCH, (k + 1) * BATCH)
        matches = matches + (left[rows, part] == right[rows, part]).sum(1)
        keep = matches >= bound
        rows, matches = rows[keep], matches[keep]
    return rows, matches


def _fingerprints(documents: DataFrame, size: int) -> DataFrame:
    """doc_id, _key (of the row), n_shingles, node (digest of the set), sig; node is null where the set is empty."""
    small_batches(documents.sparkSession)
    kind = documents.schema["doc_id"].dataType

    def measure(batches):
        for batch in batches:
            counts, nodes, sigs = [], [], []
            for text in batch["text"]:
                s = shingle_set(text, size)
                counts.append(len(s))
                nodes.append(_digest(s) if len(s) else None)
                sigs.append(signature(s).tobytes() if len(s) else None)
            yield pd.DataFrame({"doc_id": batch["doc_id"], "_key": batch["_key"], "n_shingles": counts, "node": pd.array(nodes, "Int64"), "sig": sigs})

    ids = documents.select(F.col("doc_id").cast("string"), _key().alias("_key"), "text")  # as text meanwhile: null ids would make it a float
    prints = ids.mapInPandas(measure, "doc_id string, _key long, n_shingles long, node long, sig binary")
    return prints.withColumn("doc_id", F.col("doc_id").cast(kind))


def _key() -> Column:
    """Hash of a row's id and text; ids may be null or shared."""
    return F.xxhash64("doc_id", "text")


def _digest(shingles: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)


def _sets(documents: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """node and set of the classes in ``wanted`` (node, _key), computed again from the text of the representative."""
    def measure(batches):
        done: set[int] = set()
        for batch in batches:
            nodes, members = [], []
            for node, text in zip(batch["node"], batch["text"]):
                if node not in done:  # equal rows have equal keys
                    found = shingle_set(text, size)
                    if _digest(found) == node:
                        done.add(node)
                        nodes.append(node)
                        members.append(found.view(np.int64))
            yield pd.DataFrame({"node": pd.Series(nodes, dtype="int64"), "members": members})

    texts = documents.select(_key().alias("_key"), "text").filter(F.col("text").isNotNull())
    found = texts.join(wanted, "_key").select("node", "text").mapInPandas(measure, "node long, members array<long>")
    return found.dropDuplicates(["node"])


def near_duplicates(documents: DataFrame, size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row of ``documents``."""
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("doc_id").isNull() & F.col("component_id").isNull())
    return _components(documents, size, percent).select("doc_id", "n_shingles", "component_id", kept.alias("kept"))


def _components(documents: DataFrame, size: int, percent: int) -> DataFrame:
    """doc_id, _key, n_shingles, component_id and the key of the component's first row for every row of ``documents``."""
    prints = cut(_fingerprints(documents, size))
    first = F.struct(F.col("doc_id").isNull().alias("anonymous"), "doc_id", "_key")
    classes = prints.filter(F.col("node").isNotNull()).groupBy("node").agg(F.min(first).alias("rep"), F.first("sig").alias("sig"))
    classes = cut(classes.select("node", "rep", "rep._key", "sig"))
    labels = _link(documents, classes, size, percent)
    rep = (
        classes.select("node", "rep").join(labels, "node", "left")
        .select("node", F.coalesce("label", "node").alias("label"), "rep")
    )
    smallest = rep.groupBy("label").agg(F.min("rep").alias("rep"))
    by_node = rep.drop("rep").join(smallest, "label").select("node", F.col("rep.doc_id").alias("component_id"), F.col("rep._key").alias("_keeper"))
    return prints.drop("sig").join(by_node, "node", "left").select(
        "doc_id", "_key", "n_shingles",
        F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.coalesce("_keeper", "_key").alias("_keeper"),
    )


def _link(documents: DataFrame, classes: DataFrame, size: int, percent: int) -> DataFrame:
    """node and label of every class that is linked with another."""
    least = least_matches(percent)
    words = [F.substring("sig", 1 + 4 * ROWS * b, 4 * ROWS) for b in range(BANDS)]
    banded = classes.select("node", F.explode(F.array(*[F.xxhash64(F.lit(b), w) for b, w in enumerate(words)])).alias("bucket"))
    buckets = cut(banded.groupBy("bucket").agg(F.min("node").alias("leader"), F.count(F.lit(1)).alias("members")).filter("members > 1"))
    members = cut(banded.join(buckets, "bucket"))
    signatures = classes.select("node", "sig")
    wanted = members.select("node").distinct().join(classes.select("node", "_key"), "node")
    sets = cut(_sets(documents, wanted, size))

    stars = members.filter(F.col("node") != F.col("leader")).select(F.col("leader").alias("u"), F.col("node").alias("v")).distinct()
    labels = merge_labels(None, _verified(_pruned(stars, signatures, least), sets, percent))
    return merge_labels(labels, cut(_between_components(members, sets, labels, least, percent)))


def _pruned(pairs: DataFrame, signatures: DataFrame, least: list[int]) -> DataFrame:
    """Pairs (u, v) whose signatures do not rule them out."""
    @F.pandas_udf("boolean")
    def alive(a: pd.Series, b: pd.Series) -> pd.Series:
        left = np.frombuffer(b"".join(a), np.uint32).reshape(-1, HASHES)
        right = np.frombuffer(b"".join(b), np.uint32).reshape(-1, HASHES)
        out = np.zeros(len(a), bool)
        out[survives(left, right, least)[0]] = True
        return pd.Series(out)

    both = (
        pairs.join(signatures.withColumnRenamed("node", "v").withColumnRenamed("sig", "b"), "v")
        .join(signatures.withColumnRenamed("node", "u").withColumnRenamed("sig", "a"), "u")
    )
    return both.filter(alive("a", "b")).select("u", "v")


def _labelled(df: DataFrame, labels: DataFrame, key: str, name: str) -> DataFrame:
    named = labels.select(F.col("node").alias(key), F.col("label").alias(name))
    return df.join(named, key, "left").withColumn(name, F.coalesce(name, key))


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose full sets are similar enough."""
    both = (
        pairs.join(sets.withColumnRenamed("node", "v").withColumnRenamed("members", "b"), "v")
        .join(sets.withColumnRenamed("node", "u").withColumnRenamed("members", "a"), "u")
    )
    shared = _shared(F.col("a"), F.col("b"))
    return cut(both.select("u", "v", shared.alias("n"), (F.size("a") + F.size("b")).alias("total")).filter(100 * F.col("n") >= percent * (F.col("total") - F.col("n"))).select("u", "v"))


def _shared(a: Column, b: Column) -> Column:
    @F.pandas_udf("long")
    def count(left: pd.Series, right: pd.Series) -> pd.Series:
        return pd.Series([len(np.intersect1d(x, y, assume_unique=True)) for x, y in zip(left, right)], dtype="int64")

    return count(a, b)


def _between_components(members: DataFrame, sets: DataFrame, labels: DataFrame, least: list[int], percent: int) -> DataFrame:
    """Links (u, v) between members of a bucket that lie in different components.

    Buckets are cut into blocks of about ``BLOCK`` members, and every two blocks of a bucket meet in a task of their own.
    """
    placed = cut(_labelled(members.select("bucket", "node"), labels, "node", "label"))
    mixed = placed.groupBy("bucket").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count(F.lit(1)).alias("n")).filter("lo != hi and n > 2")
    blocks = F.ceil(F.col("n") / F.lit(BLOCK)).cast("int")
    rows = (
        placed.join(mixed.select("bucket", "n"), "bucket").withColumn("blocks", blocks)
        .withColumn("block", F.pmod(F.xxhash64("node", "bucket"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("bucket", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "node", "label")
        .join(sets, "node")
    )

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        i, j = int(group["i"].iat[0]), int(group["j"].iat[0])
        found = links_between(
            *([x[c].tolist() for c in ("node", "label", "members")] for x in (group[group["block"] == i], group[group["block"] == j])),
            i == j, least, percent,
        )
        return pd.DataFrame({"u": [p[0] for p in found], "v": [p[1] for p in found]}, dtype="int64")

    return rows.groupBy("bucket", "i", "j").applyInPandas(compare, "u long, v long").distinct()


def links_between(left, right, same: bool, least: list[int], percent: int) -> list[tuple[int, int]]:
    """Links that join components, between two blocks (nodes, labels, sets) of a bucket, or inside one if ``same``."""
    parent = {label: label for label in (*left[1], *right[1])}

    def root(label: int) -> int:
        while parent[label] != label:
            parent[label] = label = parent[parent[label]]
        return label

    nodes, labels, sets = right
    if len({*left[1], *labels}) < 2:
        return []
    sizes = np.array([len(s) for s in sets])
    values = np.concatenate(sets)
    owners = np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(values, kind="stable")
    values, owners = values[order], owners[order]
    signatures = np.array([signature(np.asarray(s).view(np.uint64)) for s in sets])
    out = []
    for x, (node, label, members) in enumerate(zip(*left)):
        roots = np.array([root(v) for v in labels])
        apart = roots != root(label)
        if same:
            apart[: x + 1] = False
        others = np.flatnonzero(apart)
        if not len(others):
            continue
        own = signatures[x] if same else signature(np.asarray(members).view(np.uint64))
        others = others[survives(np.broadcast_to(own, (len(others), HASHES)), signatures[others], least)[0]]
        if not len(others):
            continue
        low, high = np.searchsorted(values, members, "left"), np.searchsorted(values, members, "right")
        count = high - low
        at = np.repeat(low - np.concatenate([[0], count.cumsum()[:-1]]), count) + np.arange(count.sum())
        shared = np.bincount(owners[at], minlength=len(sets))[others]
        for y in others[100 * shared >= percent * (len(members) + sizes[others] - shared)]:
            a, b = root(label), root(labels[y])
            if a != b:
                parent[max(a, b)] = min(a, b)
                out.append((min(node, nodes[y]), max(node, nodes[y])))
    return out


def mark_near_duplicates(documents: DataFrame, size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """``documents`` with ``COLUMNS``; of rows that repeat both id and text one is left, if there are such rows."""
    plain, held, back = shelter(documents, COLUMNS)
    rows = _components(plain.select("doc_id", "text"), size, percent)
    marks = cut(rows.groupBy("doc_id", "_key").agg(
        F.max("n_shingles").alias("n_shingles"), F.min("component_id").alias("component_id"),
        F.max(F.col("_key") == F.col("_keeper")).alias("kept"), F.count(F.lit(1)).alias("_copies")))
    if marks.filter("_copies > 1").limit(1).count():
        plain = plain.dropDuplicates(["doc_id", "text"])
    renamed = marks.withColumnRenamed("doc_id", "_id")
    keyed = plain.withColumn("_own", _key())
    return keyed.join(renamed, (F.col("_own") == F.col("_key")) & F.col("doc_id").eqNullSafe(F.col("_id"))).select(*back, *COLUMNS)
