from collections import Counter

import numpy as np
import pytest

import messy
from convoy.llm import quality_classifier, quality_rules, trees
from convoy.llm.common import read_table
from convoy.llm.doc_stats import BASE, statistics
from convoy.llm.queries import op1_quality_rules, op2_quality_classifier

SF = "/root/testdata/sf0.01"


def plain_base(text):
    ws = messy.words(text)
    windows = Counter(zip(ws, ws[1:], ws[2:]))
    marked = {k + j for k, w in enumerate(zip(ws, ws[1:], ws[2:])) if windows[w] > 1 for j in range(3)}
    seen, dups = set(), 0
    for line in (text or "").split("\n"):
        if messy.words(line):
            dups += line in seen
            seen.add(line)
    return len(ws), sum(map(len, ws)), sum(c in "#*$%&|<>" for w in ws for c in w), dups, len(marked)


def test_base_counts(spark):
    rows = read_table(spark, SF, "documents").select("doc_id", "text").collect()
    got = {r.doc_id: r for r in op1_quality_rules(spark, SF).collect()}
    assert len(got) == len(rows)
    for r in rows:
        want = plain_base(r.text)
        mine = got[r.doc_id]
        assert tuple(mine[c] for c in BASE) == want
        failed = want[0] < 50 or 100 * want[4] > 50 * want[0]
        assert mine.base_failed == failed and not (failed and mine.kept)


def test_rules_keep_good_and_drop_bad(spark):
    labels = read_table(spark, SF, "labels")
    counts = Counter(
        (r.quality, r.kept) for r in op1_quality_rules(spark, SF).join(labels, "doc_id").filter("not base_failed").collect())
    assert counts[1, True] >= 0.99 * (counts[1, True] + counts[1, False])
    assert counts[0, False] >= 0.9 * (counts[0, True] + counts[0, False])


def test_held_out_accuracy(spark):
    rows = op2_quality_classifier(spark, SF).join(read_table(spark, SF, "labels"), "doc_id").filter("held_out").collect()
    assert len(rows) > 50 and all(0 <= r.score <= 1 for r in rows)
    assert sum(r.predicted == r.quality for r in rows) >= 0.95 * len(rows)


def slow_score(model, row):
    total = model.base
    for root in model.roots:
        node = root
        while model.feature[node] >= 0:
            node = model.left[node] + (row[model.feature[node]] > model.threshold[node])
        total += model.value[node]
    return 1 / (1 + np.exp(-total))


@pytest.fixture(scope="module")
def fitted():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(3000, 4))
    noise = rng.normal(size=3000)
    y = (x[:, 0] - 0.5 * x[:, 1] ** 2 + 0.3 * np.sin(5 * x[:, 2]) + 0.4 * noise > 0).astype(float)
    return x, y, trees.fit(x, y, directions=[1, 0, -1, 0])


def test_flat_traversal_equals_node_by_node(fitted):
    x, y, model = fitted
    assert np.allclose(model.score(x[:200]), [slow_score(model, r) for r in x[:200]])
    assert ((model.score(x) > 0.5) == y).mean() > 0.85


def test_monotonic(fitted):
    x, _, model = fitted
    for feature, sign in ((0, 1), (2, -1)):
        for row in x[:100]:
            line = np.tile(row, (50, 1))
            line[:, feature] = np.linspace(-3, 3, 50)
            assert (sign * np.diff(model.score(line)) >= -1e-12).all()


def test_one_label_gives_a_constant():
    model = trees.fit(np.zeros((5, 2)), np.ones(5))
    assert np.allclose(model.score(np.ones((3, 2))), 0.999)
    assert np.allclose(trees.fit(np.zeros((0, 2)), np.zeros(0)).score(np.ones((1, 2))), 0.5)


def test_long_text_uses_no_overflow():
    assert statistics(messy.LONG)[0][4] == 30_000


def test_messy_rows(spark):
    labels = spark.createDataFrame([(1, 1), (None, 0), (3, None), (1, 0)], "doc_id long, quality int")
    docs = messy.frame(spark)
    rules = quality_rules.apply_rules(docs, quality_rules.fit_rules(docs, labels))
    rows = rules.collect()
    assert len(rows) == len(messy.ROWS)
    assert rules.columns[-8:] == list(quality_rules.COLUMNS) and "_hash" in rules.columns and "a b" in rules.columns
    assert all(r.base_failed and not r.kept for r in rows if not r.text)
    assert sum(r.kept for r in rows) <= 6
    scored = quality_classifier.classify(docs, quality_classifier.fit_classifier(docs, labels)).collect()
    assert len(scored) == len(messy.ROWS) and all(r.score is not None for r in scored)
    nothing = messy.empty(spark)
    assert quality_rules.apply_rules(nothing, quality_rules.fit_rules(nothing, labels.limit(0))).count() == 0
    assert quality_classifier.classify(nothing, trees.constant(0.5)).count() == 0
