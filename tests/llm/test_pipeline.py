from collections import Counter

import messy
import parity
import pytest
import corpus_pipeline
from convoy.llm import decontaminate, mixing, near_dedup
from convoy.llm.common import read_table
from convoy.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    assert parity.compare(QUERIES[name](spark, SF), parity.connect(SF), ORACLES[name]) is None


def test_every_operator_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 11))


def test_stages_take_effect(spark):
    docs = read_table(spark, SF, "documents").cache()
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:3]:
        before, kept = kept, stage(spark, kept, SF).cache()
        assert kept.columns == docs.columns
        assert {r.doc_id for r in kept.collect()} < {r.doc_id for r in before.collect()}, name
    leaks = decontaminate.find_leaks(kept, read_table(spark, SF, "benchmark"))
    assert leaks.count() == 0
    assert near_dedup.near_duplicates(kept).filter("not kept").count() == 0
    bad = read_table(spark, SF, "labels").filter("quality = 0").join(kept, "doc_id").count()
    assert bad < 0.5 * read_table(spark, SF, "labels").filter("quality = 0").join(docs, "doc_id").count()
    rows = Counter(r.doc_id for r in corpus_pipeline.run(spark, SF).collect())
    assert rows == Counter({r.doc_id: r.copies for r in mixing.mix(kept).collect() if r.copies})


def test_messy_stages(spark):
    for docs in (messy.frame(spark), messy.empty(spark)):
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SF)
        assert docs.count() <= 2 * len(messy.ROWS)
