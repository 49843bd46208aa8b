import random

import numpy as np
import pytest

import messy
from convoy.llm import near_dedup
from convoy.llm.common import read_table

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, size):
    ws = messy.words((text or "").translate(LOWER))
    return frozenset(tuple(ws[k: k + size]) for k in range(max(1, len(ws) - size + 1))) if ws else frozenset()


def plain(texts, size):
    sets = {k: shingles(t, size) for k, t in texts.items()}
    groups = Groups = messy.Groups(sets)
    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= 80 * (len(sets[a]) + len(sets[b]) - common):
                groups.join(a, b)
    return {k: (len(sets[k]), Groups.find(k)) for k in keys}


def check(spark, texts, size=4):
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    rows = near_dedup.near_duplicates(docs, size).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == plain(texts, size)
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)


def test_documents(spark):
    check(spark, {r.doc_id: r.text for r in read_table(spark, "/root/testdata/sf0.001", "documents").collect()})


def near_copies(n, words=60, edits=6, seed=5):
    """Copies of one text with some words changed: many pairs lie on either side of the threshold."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(10**6)}" for _ in range(words)]
    out = {}
    for k in range(n):
        copy = list(base)
        for _ in range(rng.randrange(edits)):
            copy[rng.randrange(words)] = f"x{rng.randrange(10**6)}"
        out[k] = " ".join(copy)
    return out


def test_hot_group(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 16)
    check(spark, near_copies(150))


def test_links_between_blocks_finds_what_stars_miss():
    texts = near_copies(40, edits=9, seed=8)
    sets = {k: near_dedup.shingle_set(t, 4).view(np.int64) for k, t in texts.items()}
    least = near_dedup.least_matches()
    whole = near_dedup.links_between(([*sets], [*sets], [*sets.values()]), ([*sets], [*sets], [*sets.values()]), True, least, 80)
    groups = messy.Groups(sets)
    for u, v in whole:
        groups.join(u, v)
    assert {k: groups.find(k) for k in sets} == {k: v[1] for k, v in plain(texts, 4).items()}


def test_bounds_are_sound():
    least = near_dedup.least_matches()
    assert least == sorted(least) and least[0] > 0 and least[-1] < 0.8 * near_dedup.HASHES
    same = np.ones((3, near_dedup.HASHES), np.uint32)
    assert len(near_dedup.survives(same, same, least)[0]) == 3
    assert len(near_dedup.survives(same, 0 * same, least)[0]) == 0


def test_messy_rows(spark):
    rows = near_dedup.near_duplicates(messy.frame(spark), 4).collect()
    assert len(rows) == len(messy.ROWS)
    by = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert by[2].component_id == by[1].component_id == 1 and by[3].component_id == 1
    assert by[4].n_shingles == by[5].n_shingles == by[6].n_shingles == 0 and by[5].component_id == 5
    assert by[9].n_shingles == 1 and by[2**60 + 1].component_id == 2**60 + 1
    anonymous = sorted((r.n_shingles, r.component_id, r.kept) for r in rows if r.doc_id is None and r.n_shingles)
    assert [a[1:] for a in anonymous] == [(1, False)]
    assert near_dedup.near_duplicates(messy.empty(spark)).count() == 0
    marked = near_dedup.mark_near_duplicates(messy.frame(spark))
    assert marked.columns.count("kept") == 1 and {"_hash", "a b"} <= set(marked.columns)
    kept = [r.doc_id for r in marked.filter("kept").collect()]
    assert kept.count(9) == 1 and 2 not in kept and 1 in kept


def test_rows_without_an_id_are_linked(spark):
    base = [f"w{k}" for k in range(60)]
    text = lambda *changed: " ".join(f"x{k}" if k in changed else w for k, w in enumerate(base))
    other = lambda word, n=40: " ".join(f"{word}{k}" for k in range(n))
    rows = [
        (1, text()), (None, text(0)), (None, text(0, 59)), (5, text(0, 1, 58, 59)),  # a chain over rows without an id
        (None, other("y")), (None, other("y") + " end"), (None, other("z")), (3, other("v")), (3, other("u")), (3, other("u") + " end"), (None, None),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = plain(dict(enumerate(t for _, t in rows)), 4)
    ids = [[rows[k][0] for k in want if want[k][1] == want[n][1] and rows[k][0] is not None] for n in range(len(rows))]
    component = {n: min(ids[n], default=None) for n in range(len(rows))}
    assert component[1] == component[2] == component[3] == 1
    got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id), r.kept) for r in near_dedup.near_duplicates(docs, 4).collect())
    assert got == sorted((str(d), want[n][0], str(component[n]), d == component[n]) for n, (d, _) in enumerate(rows))
    kept = near_dedup.mark_near_duplicates(docs, 4).filter("kept").collect()
    assert sorted(want[rows.index((r.doc_id, r.text))][1] for r in kept) == sorted({g for _, g in want.values()})
    assert {r.text for r in kept} >= {text(), other("z"), other("v"), None}
