"""One query for each operator, over whole tables and with production parameters, and SQL where SQL can express it."""

from __future__ import annotations

from uuid import uuid4

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from convoy.llm import (
    alignment, collocations, decontaminate, html_text, license_scan, mixing, near_dedup, pii, quality_classifier, quality_rules, records,
    sharding, substring_dedup,
)
from convoy.llm.common import read_table
from convoy.llm.doc_stats import BASE
from convoy.session import ensure_checkpoint_dir

#: The id that ends every document in the record files.
END_ID = 1


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    model = quality_rules.fit_rules(documents, labels)
    return quality_rules.apply_rules(documents.select("doc_id", "text"), model).select("doc_id", *BASE, "base_failed", "quality_score", "kept")


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    model = quality_classifier.fit_classifier(documents, labels)
    return quality_classifier.classify(documents.select("doc_id", "text"), model).select("doc_id", "held_out", "score", "predicted")


def op3_feistel_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents").selectExpr("doc_id", "text")
    return sharding.assign_shards(sharding.measured(documents)).select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard", "position")


def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mix(documents).select("doc_id", "size", "source_size", "target", "taken", "copies")


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op6_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(read_table(spark, sf_dir, "documents"), size=4)


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_text(read_table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op8_pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.mark_pii(documents, pii.train(documents)).select("doc_id", *pii.COLUMNS)


def op9_prefix_free_parsing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(read_table(spark, sf_dir, "documents"))


def op11_binary_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/records-{uuid4()}"
    records.write_records(read_table(spark, sf_dir, "documents"), folder, public_tokenizers.path("word_bpe_49k.json"), END_ID)
    return records.read_digests(spark, folder).select("doc_id", "start", "n_tokens", "ids_crc32")


def op12_collocation_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read_table(spark, sf_dir, "documents"))


def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return alignment.align(read_table(spark, sf_dir, "documents"), a, b)


QUERIES = {
    f.__name__: f for f in (
        op1_quality_rules, op2_quality_classifier, op3_feistel_sharding, op4_source_mixing,
        op5_benchmark_decontamination, op6_minhash_near_dedup, op7_html_extraction, op8_pii_spans,
        op9_prefix_free_parsing, op10_license_scan, op11_binary_records, op12_collocation_mining, op13_tokenizer_alignment,
    )
}

# The mix in SQL. The queue order is the md5 of the id; ids are unique in the tables that the SQL runs on.
_OP4 = """
WITH d AS (
  SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
         CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
p AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS place, CAST(source_size AS DOUBLE) * 2 AS cap FROM s),
w AS (
  SELECT *, CAST([5, 2, 1][CAST((place - 1) % 3 + 1 AS INTEGER)] AS DOUBLE) AS weight,
         sum(CAST(source_size AS DOUBLE)) OVER () * 1.5 AS budget FROM p),
l AS (
  SELECT *, cap / weight AS at_cap,
         (budget - coalesce(sum(cap) OVER (ORDER BY cap / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
         / sum(weight) OVER (ORDER BY cap / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM w),
t AS (
  SELECT source, source_size, place, budget,
         CASE WHEN water IS NULL THEN cap ELSE least(cap, water * weight) END AS target
  FROM (SELECT *, (SELECT level FROM l WHERE level <= at_cap ORDER BY at_cap, place LIMIT 1) AS water FROM l)),
q AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, t.place, t.budget,
         sum(d.size) OVER (PARTITION BY t.place ORDER BY d.h ROWS UNBOUNDED PRECEDING) AS upto
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
c AS (
  SELECT doc_id, size, budget, place, CAST(upto + k * source_size AS DOUBLE) / target AS finish
  FROM q, (VALUES (0), (1)) e(k) WHERE size > 0 AND target > 0),
g AS (SELECT doc_id, budget, sum(size) OVER (ORDER BY finish, place ROWS UNBOUNDED PRECEDING) AS total FROM c),
n AS (SELECT doc_id, count(*) AS copies FROM g WHERE total <= budget GROUP BY doc_id)
SELECT q.doc_id, q.size, q.source_size, q.target, CAST(coalesce(n.copies, 0) * q.size AS BIGINT) AS taken,
       CAST(coalesce(n.copies, 0) AS INTEGER) AS copies
FROM q LEFT JOIN n ON q.doc_id IS NOT DISTINCT FROM n.doc_id
"""

# Near duplicates by all pairs that share a shingle, and components by reachability.
_OP6 = """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
g AS (
  SELECT doc_id, unnest(CASE WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
    ELSE [array_to_string(ws[i : i + 3], ' ') FOR i IN range(1, len(ws) - 2)] END) AS shingle
  FROM w WHERE len(ws) > 0),
s AS (SELECT DISTINCT doc_id, shingle FROM g),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS (
  SELECT u, v FROM p JOIN n x ON x.doc_id = u JOIN n y ON y.doc_id = v WHERE 100 * c >= 80 * (x.n + y.n - c)),
r AS (SELECT u, v FROM e UNION SELECT r.u, e.v FROM r JOIN e ON r.v = e.u),
m AS (SELECT u, min(v) AS low FROM r GROUP BY u)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, least(d.doc_id, coalesce(m.low, d.doc_id)) AS component_id,
       d.doc_id = least(d.doc_id, coalesce(m.low, d.doc_id)) AS kept
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN m ON m.u = d.doc_id
"""

# Repeats by the smallest id of every 50-byte string, in hexadecimal.
_OP9 = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
p AS (
  SELECT doc_id, i, substr(h, CAST(2 * i + 1 AS BIGINT), 100) AS x
  FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 49)) AS i FROM d WHERE len(h) >= 100)),
f AS (SELECT x, min(doc_id) AS low FROM p GROUP BY x),
g AS (SELECT p.doc_id, p.i FROM p JOIN f ON p.x = f.x WHERE f.low < p.doc_id),
c AS (SELECT DISTINCT doc_id, i + unnest(range(0, 50)) AS i FROM g),
n AS (SELECT doc_id, count(*) AS n_removed, count(*) FILTER (WHERE NOT joined) AS n_spans
      FROM (SELECT doc_id, coalesce(i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) = 1, false) AS joined FROM c) GROUP BY doc_id),
k AS (
  SELECT b.doc_id, string_agg(substr(b.h, CAST(2 * b.i + 1 AS BIGINT), 2), '' ORDER BY b.i) AS kept
  FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2)) AS i FROM d WHERE doc_id IN (SELECT doc_id FROM n)) b
  LEFT JOIN c ON c.doc_id = b.doc_id AND c.i = b.i WHERE c.i IS NULL GROUP BY b.doc_id)
SELECT d.doc_id, CAST(len(d.h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n.n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n.n_spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(CASE WHEN n.doc_id IS NULL THEN d.h ELSE coalesce(k.kept, '') END)) AS kept_sha256
FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN k ON k.doc_id = d.doc_id
"""

# Collocations by counting all phrases of up to three words.
_OP12 = """
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS ws FROM p),
x AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM w WHERE len(ws) > 0),
f1 AS (SELECT lang, ws[i] AS a, count(*) AS f FROM x GROUP BY ALL),
f2 AS (SELECT lang, ws[i] AS a, ws[i + 1] AS b, count(*) AS f FROM x WHERE i + 1 <= len(ws) GROUP BY ALL),
f3 AS (SELECT lang, ws[i] AS a, ws[i + 1] AS b, ws[i + 2] AS c, count(*) AS f FROM x WHERE i + 2 <= len(ws) GROUP BY ALL HAVING count(*) >= 10),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f1 GROUP BY lang),
inside AS (SELECT lang, a, b, f FROM f3 UNION ALL SELECT lang, b, c, f FROM f3),
longest AS (SELECT lang, a, b, max(f) AS m FROM inside GROUP BY ALL),
two AS (
  SELECT f2.lang, f2.a || ' ' || f2.b AS phrase, f2.f AS a, u.f AS l, v.f AS r
  FROM f2 JOIN f1 u ON u.lang = f2.lang AND u.a = f2.a JOIN f1 v ON v.lang = f2.lang AND v.a = f2.b
  LEFT JOIN longest g ON g.lang = f2.lang AND g.a = f2.a AND g.b = f2.b
  WHERE f2.f >= 10 AND (g.m IS NULL OR 100 * g.m < 50 * f2.f)),
three AS (
  SELECT f3.lang, f3.a || ' ' || f3.b || ' ' || f3.c AS phrase, f3.f AS a, u.f AS l1, v.f AS r1, s.f AS l2, t.f AS r2
  FROM f3 JOIN f1 u ON u.lang = f3.lang AND u.a = f3.a JOIN f2 v ON v.lang = f3.lang AND v.a = f3.b AND v.b = f3.c
  JOIN f2 s ON s.lang = f3.lang AND s.a = f3.a AND s.b = f3.b JOIN f1 t ON t.lang = f3.lang AND t.a = f3.c),
scored AS (
  SELECT lang, phrase, a, l1, r1, l2, r2, (1000000::HUGEINT * a * a) // (l1::HUGEINT * r1) AS s1, (1000000::HUGEINT * a * a) // (l2::HUGEINT * r2) AS s2
  FROM (SELECT * FROM three UNION ALL SELECT lang, phrase, a, l, r, l, r FROM two)),
best AS (
  SELECT lang, phrase, a, CASE WHEN s1 <= s2 THEN l1 ELSE l2 END AS l, CASE WHEN s1 <= s2 THEN r1 ELSE r2 END AS r,
         CAST(least(s1, s2) AS BIGINT) AS score FROM scored),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best)
SELECT ranked.lang, rank, phrase, a, l, r, n.n, score FROM ranked JOIN n ON n.lang = ranked.lang WHERE rank <= 2000
"""

ORACLES = {"op4_source_mixing": _OP4, "op6_minhash_near_dedup": _OP6, "op9_prefix_free_parsing": _OP9,
           "op12_collocation_mining": _OP12}
