"""Registered queries of the training-data operators: ``QUERIES`` and ``ORACLE``.

Each query applies its operator, with production parameters, to its whole
table and returns the full result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenledger.llm import (bpe, decontaminate, fingerprint, langid, linededup, neardup, negatives, packing, quality,
                             repeats, search, tokencount, toxicity)
from tokenledger.sources.tables import table


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.count_tokens(table(spark, sf_dir, "documents"))


def op2_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.digest(table(spark, sf_dir, "documents"))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents")).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = linededup.drop_boilerplate(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.col("__lines").alias("n_lines"), F.col("__dropped").alias("n_dropped"), "text")


def op7_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.edited_fingerprints(table(spark, sf_dir, "documents"))


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def op11_ranked_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.hard_negatives(table(spark, sf_dir, "embeddings"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "op1_token_counts": op1_token_counts,
    "op2_suffix_array_dedup": op2_suffix_array_dedup,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_language_id": op4_language_id,
    "op5_toxicity": op5_toxicity,
    "op6_line_dedup": op6_line_dedup,
    "op7_document_fingerprints": op7_document_fingerprints,
    "op8_benchmark_decontamination": op8_benchmark_decontamination,
    "op9_quality_classifier": op9_quality_classifier,
    "op10_minhash_near_dedup": op10_minhash_near_dedup,
    "op11_ranked_lexical_search": op11_ranked_lexical_search,
    "op12_bpe_round_trip": op12_bpe_round_trip,
    "op13_hard_negatives": op13_hard_negatives,
    "pipeline": pipeline,
}

#: DuckDB: the line-frequency rule of op6.
OP6_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source, text FROM documents),
l AS (SELECT rid, doc_id, source, u.line, u.pos FROM d,
      LATERAL (SELECT unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos) u),
t AS (SELECT *, trim(line, ' ' || chr(9) || chr(13)) AS k FROM l),
pages AS (SELECT source, count(*) AS pages FROM documents WHERE source IS NOT NULL GROUP BY source),
f AS (SELECT source, k, count(DISTINCT rid) AS n FROM t WHERE k <> '' AND source IS NOT NULL GROUP BY source, k),
b AS (SELECT f.source, f.k FROM f JOIN pages p ON f.source = p.source
      WHERE p.pages >= 10 AND f.n >= 3 AND f.n > CAST(0.015 AS DOUBLE) * p.pages),
x AS (SELECT t.*, b.k IS NOT NULL AS gone FROM t LEFT JOIN b ON t.source = b.source AND t.k = b.k),
g AS (SELECT rid, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
             coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '') AS text FROM x GROUP BY rid)
SELECT d.doc_id, coalesce(g.n_lines, 0)::BIGINT AS n_lines, coalesce(g.n_dropped, 0)::BIGINT AS n_dropped,
       CASE WHEN d.text IS NULL THEN NULL ELSE g.text END AS text
FROM d LEFT JOIN g ON d.rid = g.rid
"""

#: DuckDB: the contract of op8, by plain 13-word windows.
OP8_SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[0-9a-z\x{80}-\x{10FFFF}]+') AS ws FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[0-9a-z\x{80}-\x{10FFFF}]+') AS ws FROM benchmark WHERE item_id IS NOT NULL),
p AS (SELECT DISTINCT item, least(len(ws), 13) AS m, array_to_string(ws[i:i + least(len(ws), 13) - 1], ' ') AS phrase
      FROM (SELECT item, ws, unnest(generate_series(1, greatest(len(ws) - 12, 1))) AS i FROM b WHERE len(ws) > 0)),
sizes AS (SELECT DISTINCT m FROM p),
dw AS (SELECT doc_id, m, i, array_to_string(ws[i:i + m - 1], ' ') AS phrase
       FROM (SELECT doc_id, ws, m, unnest(generate_series(1, len(ws) - m + 1)) AS i FROM w, sizes WHERE len(ws) >= m)),
hit AS (SELECT dw.doc_id, dw.i, dw.m, p.item FROM dw JOIN p ON dw.m = p.m AND dw.phrase = p.phrase),
words AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (
        SELECT doc_id, unnest(generate_series(i, i + m - 1)) AS k FROM (SELECT DISTINCT doc_id, i, m FROM hit)) GROUP BY doc_id),
found AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
          FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id)
SELECT w.doc_id, coalesce(len(w.ws), 0)::BIGINT AS n_words, coalesce(words.n_hit, 0)::BIGINT AS n_hit,
       coalesce(found.n_items, 0)::BIGINT AS n_items, sha256(coalesce(found.items, '')) AS items_sha256,
       coalesce(words.n_hit, 0) > 0 AND 20 * coalesce(words.n_hit, 0) >= coalesce(len(w.ws), 0) AS contaminated
FROM w LEFT JOIN words ON w.doc_id = words.doc_id LEFT JOIN found ON w.doc_id = found.doc_id
"""

#: DuckDB: the rule of op2 on every 100-byte window (texts as hexadecimal).
OP2_SQL = r"""
WITH h AS (SELECT doc_id, coalesce(hex(encode(text)), '') AS x FROM documents),
win AS (SELECT doc_id, i, md5_number(substr(x, 2 * i + 1, 200)) AS k
        FROM (SELECT doc_id, x, unnest(range(0, len(x) // 2 - 99)) AS i FROM h) t),
hit AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY k ORDER BY doc_id, i) AS r FROM win) t WHERE r > 1),
isle AS (SELECT doc_id, min(i) AS a, max(i) + 100 AS b
         FROM (SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS g
               FROM (SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 100 THEN 0 ELSE 1 END AS fresh
                     FROM hit) t) t GROUP BY doc_id, g),
gap AS (SELECT isle.doc_id, coalesce(lag(b) OVER (PARTITION BY isle.doc_id ORDER BY a), 0) AS f, a AS t, x
        FROM isle JOIN h ON h.doc_id = isle.doc_id
        UNION ALL
        SELECT h.doc_id, coalesce(e.b, 0) AS f, len(x) // 2 AS t, x
        FROM h LEFT JOIN (SELECT doc_id, max(b) AS b FROM isle GROUP BY doc_id) e ON e.doc_id = h.doc_id),
kept AS (SELECT doc_id, string_agg(substr(x, 2 * f + 1, 2 * (t - f)), '' ORDER BY f) AS k FROM gap GROUP BY doc_id),
cut AS (SELECT doc_id, sum(b - a) AS removed, count(*) AS spans FROM isle GROUP BY doc_id)
SELECT h.doc_id, (len(x) // 2)::BIGINT AS n_bytes, coalesce(removed, 0)::BIGINT AS n_removed, coalesce(spans, 0)::BIGINT AS n_spans,
       sha256(unhex(k)) AS kept_sha256
FROM h JOIN kept ON kept.doc_id = h.doc_id LEFT JOIN cut ON cut.doc_id = h.doc_id
"""

#: DuckDB: the contract of op10 by counting shared shingles.
OP10_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, coalesce(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS ws FROM documents),
sh AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS x
       FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 2))) AS i FROM w WHERE len(ws) > 0) t),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM sh a JOIN sh b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
l AS (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * i >= 75 * (na.n + nb.n - i)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r AS (SELECT a AS doc_id, a AS root FROM e UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.doc_id),
c AS (SELECT doc_id, min(root) AS root FROM r GROUP BY doc_id)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, least(w.doc_id, coalesce(c.root, w.doc_id)) AS component_id,
       w.doc_id = least(w.doc_id, coalesce(c.root, w.doc_id)) AS kept
FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN c ON c.doc_id = w.doc_id
"""

#: DuckDB: the contract of op11 by joins on terms.
OP11_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+'), []) AS ws FROM documents),
q AS (SELECT iid, item_id, unnest(list_distinct(ws)) AS term FROM (SELECT row_number() OVER () AS iid, item_id, regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS ws FROM benchmark) t),
g AS (SELECT count(*)::BIGINT AS docs, sum(len(ws))::BIGINT AS total FROM d WHERE len(ws) > 0),
tf AS (SELECT rid, term, count(*)::BIGINT AS tf FROM (SELECT rid, unnest(ws) AS term FROM d) t
       WHERE term IN (SELECT term FROM q) GROUP BY rid, term),
w AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM tf, g GROUP BY term, docs),
m AS (SELECT rid, doc_id, (100 - 90 + ((90 * len(ws)::BIGINT * docs) // total))::BIGINT AS m FROM d, g WHERE len(ws) > 0),
s AS (SELECT iid, item_id, doc_id, m.rid, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
      FROM q JOIN tf ON q.term = tf.term JOIN w ON w.term = q.term JOIN m ON m.rid = tf.rid GROUP BY iid, item_id, doc_id, m.rid),
r AS (SELECT item_id, row_number() OVER (PARTITION BY iid ORDER BY score DESC, doc_id NULLS LAST) AS rank, doc_id, score FROM s WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM r WHERE rank <= 10
"""

#: DuckDB: the contract of op13 by all inner products.
OP13_SQL = r"""
WITH v AS (SELECT row_number() OVER () AS rid, vec_id::BIGINT AS vec_id,
                  CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
           FROM embeddings
           WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT a.vec_id AS anchor_id, a.rid AS aid, b.vec_id AS vec_id, b.rid AS rid, a.label = b.label AS same,
             list_inner_product(a.e, b.e)::BIGINT AS score
      FROM v a JOIN v b ON a.rid <> b.rid WHERE a.vec_id % 50 = 0),
pos AS (SELECT * FROM (SELECT anchor_id, aid, vec_id AS positive_id, rid AS pid, score AS positive_score,
                              row_number() OVER (PARTITION BY aid ORDER BY score DESC, vec_id) AS k FROM p WHERE same) t WHERE k <= 5),
neg AS (SELECT pos.anchor_id, positive_id, p.vec_id AS negative_id, positive_score, p.score AS negative_score,
               row_number() OVER (PARTITION BY pos.aid, pid ORDER BY p.score DESC, p.vec_id) AS rank
        FROM pos JOIN p ON p.aid = pos.aid AND NOT p.same
        WHERE 50 * positive_score <= 100 * p.score AND 100 * p.score <= 95 * positive_score)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM neg WHERE rank <= 3
"""

ORACLE = {
    "op2_suffix_array_dedup": OP2_SQL,
    "op6_line_dedup": OP6_SQL,
    "op8_benchmark_decontamination": OP8_SQL,
    "op10_minhash_near_dedup": OP10_SQL,
    "op11_ranked_lexical_search": OP11_SQL,
    "op13_hard_negatives": OP13_SQL,
}
