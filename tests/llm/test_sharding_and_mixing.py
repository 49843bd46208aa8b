from collections import Counter, defaultdict
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

import messy
from convoy.llm import mixing, sharding
from convoy.llm.common import read_table
from convoy.llm.queries import op3_feistel_sharding

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("n", [0, 1, 2, 3, 10, 99, 1000])
def test_permutation_and_inverse(n):
    numbers = np.arange(n)
    there = sharding.permute(numbers, n)
    assert sorted(there) == list(range(n))
    assert (sharding.unpermute(there, n) == numbers).all()
    assert n < 50 or (there != numbers).mean() > 0.9


def test_shards(spark):
    texts = {r.doc_id: r.text for r in read_table(spark, SF, "documents").collect()}
    rows = op3_feistel_sharding(spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    slots = defaultdict(list)
    for r in rows:
        raw = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 16, crc32(raw), "rows", None)
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1 and len(slots) == 40


def test_shards_do_not_depend_on_partitions(spark):
    docs = read_table(spark, SF, "documents")
    one, two = (
        {(r.doc_id, r.shard, r.slot) for r in sharding.assign_shards(d, bucket_rows=30).collect()}
        for d in (docs, docs.repartition(7, "source")))
    assert one == two


def test_messy_shards(spark):
    out = sharding.assign_shards(messy.frame(spark), shards=4, bucket_rows=3)
    rows = out.collect()
    assert sorted(r.position for r in rows) == list(range(len(messy.ROWS)))
    assert {"_hash", "a b", "kept"} <= set(out.columns) and out.columns.count("size") == 1
    assert all(r.size == 16 and r.text_crc32 == 0 for r in rows if not r.text)
    assert sharding.assign_shards(messy.empty(spark)).count() == 0


def plain_targets(sizes):
    """Deals out what is above a cap again and again."""
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(names)}
    left, target, open_ = 1.5 * sum(sizes.values()), {}, set(names)
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if weight[s] * level > 2 * sizes[s]}
        for s in full or open_:
            target[s] = 2.0 * sizes[s] if full else weight[s] * level
        left -= sum(target[s] for s in full)
        open_ = open_ - full if full else set()
    return target


def check_mix(rows):
    sizes = Counter()
    for r in rows:
        assert r.size == len(messy.words(r.text))
        sizes[r.source] += r.size
    target, largest = plain_targets(sizes), max(r.size for r in rows)
    taken = Counter()
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(target[r.source])
        assert r.taken == r.copies * r.size and 0 <= r.copies <= 2
        taken[r.source] += r.taken
    assert sum(taken.values()) <= 1.5 * sum(sizes.values())
    assert sum(taken.values()) >= 1.5 * sum(sizes.values()) - largest or max(target.values()) < largest
    return taken, target


@pytest.mark.parametrize("bucket_rows", [7, 5000])
def test_mix(spark, bucket_rows):
    docs = read_table(spark, SF, "documents")
    rows = mixing.mix(docs, bucket_rows=bucket_rows).collect()
    taken, target = check_mix(rows)
    largest = Counter()
    for r in rows:
        largest[r.source] = max(largest[r.source], r.size)
    assert all(abs(taken[s] - target[s]) <= largest[s] for s in target)


def test_mix_reruns_agree(spark):
    docs = read_table(spark, SF, "documents")
    one, two = ({(r.doc_id, r.taken) for r in mixing.mix(d, bucket_rows=11).collect()} for d in (docs, docs.repartition(5)))
    assert one == two


def test_messy_mix(spark):
    out = mixing.mix(messy.frame(spark))
    rows = out.collect()
    check_mix(rows)
    assert len(rows) == len(messy.ROWS) and out.columns.count("size") == 1 and "_hash" in out.columns
    assert all(r.taken == 0 for r in rows if not messy.words(r.text))
    copies = mixing.expand_copies(out)
    assert copies.count() == sum(r.copies for r in rows) and "target" not in copies.columns
    assert mixing.mix(messy.empty(spark)).count() == 0
    assert mixing.mix(messy.frame(spark).filter("doc_id in (4, 5, 6)")).agg({"taken": "sum"}).first()[0] == 0


def test_columns_of_any_kind_and_name(spark):
    """Maps, and names that need quoting or look like an operator's own, come out as they went in."""
    from convoy.llm import near_dedup, pii

    rows = [(i, f"text number {i % 3} with words and more of them", "a", {"k": i}, f"v{i}", i) for i in range(12)] + [(None, "no id", "a", None, None, None)] * 2
    ddl = "doc_id long, text string, source string, m map<string,int>, `odd``name.x` string, _bucket int"
    df = spark.createDataFrame(rows, ddl)
    want = sorted(str((r[0], r[3], r[4], r[5])) for r in rows)
    outs = {
        "shards": sharding.assign_shards(df, shards=3, bucket_rows=4), "mix": mixing.mix(df, bucket_rows=4),
        "near": near_dedup.mark_near_duplicates(df), "pii": pii.mark_pii(df, np.zeros((len(pii.FEATURES), len(pii.KINDS)))),
    }
    for name, out in outs.items():
        assert {"m", "odd`name.x", "_bucket"} <= set(out.columns), name
        found = out.select("doc_id", "m", "`odd``name.x`", "_bucket").collect()
        # Of rows that repeat both id and text the marking of near duplicates leaves one, as it says.
        assert sorted(str(tuple(r)) for r in found) == (sorted(set(want)) if name == "near" else want), name


def test_rows_without_an_id_are_spread(spark):
    """A third of the rows without an id do not share one place of the queue."""
    rows = [(None if i % 3 == 0 else i, f"w{i} " * (1 + i % 5), "a") for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    hashes = mixing._in_buckets(
        df.select(F.col("text"), F.md5(F.coalesce(F.col("doc_id").cast("string"), F.concat_ws(":", F.lit("no id"), F.crc32(F.col("text").cast("binary")), F.length("text"))).cast("binary")).alias("_hash"),
                  F.col("source").alias("_source")),
        spark.createDataFrame([("a", 8)], "_source string, _buckets long"))
    counts = [r["count"] for r in hashes.groupBy("_bucket").count().collect()]
    assert len(counts) == 8 and max(counts) < 2 * min(counts)
    out = mixing.mix(df, bucket_rows=300).collect()
    assert sum(r.taken for r in out) <= 1.5 * sum(r.size for r in out) and len(out) == 3000
