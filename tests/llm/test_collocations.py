import re
from collections import Counter

import messy
import numpy as np
import pytest
from pyspark.sql import functions as F

from convoy.llm import collocations


def _pieces(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
        yield re.findall(r"[^\x20\x09]+", piece)


def plain(rows, least=10, share=50, top=2000):
    f, n = {}, Counter()
    for lang, text in rows:
        of = f.setdefault(lang or "und", Counter())
        for words in _pieces(text):
            n[lang or "und"] += len(words)
            for k in (1, 2, 3):
                of.update(tuple(words[i: i + k]) for i in range(len(words) - k + 1))
    out = set()
    for lang, of in f.items():
        chosen = {p: a for p, a in of.items() if len(p) > 1 and a >= least}
        held = Counter()
        for p, a in chosen.items():
            if len(p) == 3:
                for q in (p[:2], p[1:]):
                    held[q] = max(held[q], a)
        scored = []
        for p, a in chosen.items():
            if len(p) == 2 and held[p] * 100 >= share * a and held[p]:
                continue
            cuts = [(1_000_000 * a * a // (of[p[:k]] * of[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            scored.append((-score, -a, " ".join(p).encode(), of[p[:k]], of[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            out.add((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return out


TEXTS = [
    ("en", "New York is big. new york, New York! in New York city\nNew York city of new  york\tcity " * 4),
    ("en", "a a a a a a a a a a a a a a, a a a b a b a b a b a b a b a b a b a b a b a b"),
    ("fr", "New York; la ville de New York est la ville de Paris " * 9), (None, "x y z " * 12), (None, None), ("de", ""), ("de", ". ,\n"),
    ("en", "éa Éa   " * 11), ("und", "x y z w " * 3),
]


@pytest.mark.parametrize(("budget", "least", "share", "top"), [(1_000_000, 10, 50, 2000), (30, 2, 90, 5), (3, 10, 50, 2000)])
def test_small_texts(spark, budget, least, share, top):
    df = spark.createDataFrame(TEXTS * 2, "lang string, text string").repartition(3)
    found = collocations.collocations(df, top, least, share, budget)
    assert {tuple(r) for r in found.collect()} == plain(TEXTS * 2, least, share, top)


def test_tables(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = plain([tuple(r) for r in df.select("lang", "text").collect()])
    assert {tuple(r) for r in collocations.collocations(df, budget=5000).collect()} == want


def test_messy_documents(spark):
    found = {tuple(r) for r in collocations.collocations(messy.frame(spark), least=2).collect()}
    assert found == plain([(r[2], r[1]) for r in messy.ROWS], least=2)
    none = collocations.collocations(messy.empty(spark))
    assert none.dtypes == [("lang", "string"), ("rank", "bigint"), ("phrase", "string"), *[(c, "bigint") for c in ("a", "l", "r", "n", "score")]]
    assert none.count() == 0


def test_long_texts_are_cut_at_separators(spark, monkeypatch):
    monkeypatch.setattr(collocations, "TEXT_BYTES", 50)
    text = TEXTS[0][1] + "word " * 40 + ". " + "a, b " * 30
    parts = list(collocations._segments(text))
    assert len(parts) > 5 and max(map(len, parts)) < 300
    assert [w for p in parts for piece in p.split(b"\n") if (w := piece.split())] == [
        [x.encode() for x in words] for words in _pieces(text) if words]


def test_colliding_codes_start_again(spark, monkeypatch):
    true = collocations.word_code

    def narrow(lang, word, seed):
        return true(lang, word, seed) % (1 << 40) | 1 if seed else len(word) << 1 | 1

    monkeypatch.setattr(collocations, "word_code", narrow)
    df = spark.createDataFrame([("en", "aa bb cc")], "lang string, text string")
    sent = [b.to_pylist() for b in collocations._count_words(0)(iter([df.toArrow().to_batches()[0]]))]
    assert len({r["code"] for r in sent[0]}) == 1 and len(sent[0]) == 3


def test_exact_scores(spark):
    rows = [(a, left, right) for a in (10, 999_999_999_999, 123_456_789_012_345) for left in (a, a + 7) for right in (a + 1, 999_999_999_999_999)]
    df = spark.createDataFrame(rows, "a long, l long, r long")
    found = df.withColumn("s", collocations._score(F.col("a"), F.col("l"), F.col("r"))).collect()
    assert {tuple(r) for r in found} == {(a, l, r, 1_000_000 * a * a // (l * r)) for a, l, r in rows}


def test_groups_keep_to_the_budget():
    rng = np.random.default_rng(1)
    loads = rng.integers(0, 50, collocations.SLOTS)
    loads[[5, 900]] = 100_000, 2000
    groups = collocations.Groups(loads, 1000)
    parts = rng.integers(0, 300, (2, collocations.PARTS))
    parts[0, 7] = 5000
    groups.extend(parts)
    used = np.bincount(groups.slot[groups.slot >= 0], loads[groups.slot >= 0], groups.n)
    for h in range(2):
        small = groups.spread[h] == 1
        used += np.bincount(groups.part[h, small], parts[h, small], groups.n)
    assert used.max() <= 1000 and groups.spread[0, 7] == 5
