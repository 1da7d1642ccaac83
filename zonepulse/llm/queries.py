"""Queries over the driver's tables, one per operator, and their SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import collocations, cutting, decontaminate, extract, jaccard, langid, lmscore, packing, pii, quality, spans, toxicity, trie
from .common import table


def op7_cross_entropy_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return lmscore.difference(docs, table(spark, sf_dir, "labels"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = quality.quality_filter(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return checked.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "stratum"
    )


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op2_pii_boosting(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pii.find_spans(docs, pii.fit(docs))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.predict(docs, langid.fit(docs))


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.benchmark_hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_toxicity_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op6_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"), k=4, num=17, den=20)


def op9_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans.remove_repeats(table(spark, sf_dir, "documents"), passage=spans.PASSAGE)


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.extract(table(spark, sf_dir, "pages"))


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_cutting_stock_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    packed, width = cutting.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return cutting.with_crc32(packed, width)


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.conversation_trie(table(spark, sf_dir, "conversations"))


QUERIES = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_pii_boosting": op2_pii_boosting,
    "op3_language_id": op3_language_id,
    "op4_benchmark_decontamination": op4_benchmark_decontamination,
    "op5_toxicity_cnn": op5_toxicity_cnn,
    "op6_ngram_jaccard": op6_ngram_jaccard,
    "op7_cross_entropy_difference": op7_cross_entropy_difference,
    "op8_quality_rules": op8_quality_rules,
    "op9_sentence_spans": op9_sentence_spans,
    "op10_html_extraction": op10_html_extraction,
    "op11_phrase_collocations": op11_phrase_collocations,
    "op12_cutting_stock_packing": op12_cutting_stock_packing,
    "op13_conversation_trie": op13_conversation_trie,
}

#: DuckDB; the other operators fit models, follow hashes or parse, which SQL can't express.
ORACLE_SQL: dict[str, str] = {
    "op6_ngram_jaccard": r"""
WITH RECURSIVE tokens AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
runs AS (
  SELECT doc_id, CASE
    WHEN len(w) >= 4 THEN list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')]
    ELSE CAST([] AS VARCHAR[]) END AS s
  FROM tokens),
shingles AS (SELECT DISTINCT doc_id, unnest(s) AS shingle FROM runs),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n_shared
  FROM shingles x JOIN shingles y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id
  GROUP BY x.doc_id, y.doc_id),
links AS (
  SELECT a, b FROM shared JOIN sizes s ON s.doc_id = a JOIN sizes t ON t.doc_id = b
  WHERE 100 * n_shared >= 85 * (s.n + t.n - n_shared)),
reach AS (
  SELECT doc_id, doc_id AS root FROM documents
  UNION
  SELECT l.b, r.root FROM reach r JOIN links l ON l.a = r.doc_id)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, c.component_id
FROM documents d
LEFT JOIN sizes s ON s.doc_id = d.doc_id
JOIN (SELECT doc_id, min(root) AS component_id FROM reach GROUP BY doc_id) c ON c.doc_id = d.doc_id
""",
    "op11_phrase_collocations": r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
tokens AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
runs AS (
  SELECT lang, size, unnest(list_transform(range(1, len(w) - size + 2), lambda i: array_to_string(w[i:i + size - 1], ' '))) AS phrase
  FROM tokens, (VALUES (1), (2), (3), (4)) AS sizes(size) WHERE len(w) >= size),
counts AS (SELECT lang, size, phrase, count(*) AS f FROM runs GROUP BY lang, size, phrase),
totals AS (SELECT lang, sum(f) AS n FROM counts WHERE size = 1 GROUP BY lang),
candidates AS (SELECT lang, size, phrase, string_split(phrase, ' ') AS w, f AS a FROM counts WHERE size > 1 AND f >= 30),
cuts AS (
  SELECT lang, phrase, w, size, a, unnest(range(1, size)) AS k FROM candidates),
scored AS (
  SELECT c.lang, c.phrase, c.a, c.k, p.f AS l, q.f AS r, (CAST(2000000 AS HUGEINT) * c.a) // (p.f + q.f) AS score
  FROM cuts c
  JOIN counts p ON p.lang = c.lang AND p.phrase = array_to_string(c.w[1:c.k], ' ')
  JOIN counts q ON q.lang = c.lang AND q.phrase = array_to_string(c.w[c.k + 1:], ' ')),
best AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
parts AS (
  SELECT c.lang, array_to_string(c.w[i:i + s - 1], ' ') AS phrase, c.a AS f
  FROM candidates c, range(1, 4) AS starts(i), range(2, 4) AS lengths(s)
  WHERE s < c.size AND i + s - 1 <= c.size),
covering AS (SELECT lang, phrase, max(f) AS f FROM parts GROUP BY lang, phrase),
kept AS (
  SELECT b.* FROM best b LEFT JOIN covering v ON v.lang = b.lang AND v.phrase = b.phrase
  WHERE v.f IS NULL OR CAST(100 AS HUGEINT) * v.f < CAST(80 AS HUGEINT) * b.a),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM kept)
SELECT k.lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r,
  CAST(t.n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked k JOIN totals t ON t.lang = k.lang WHERE rank <= 2000
""",
    "op13_conversation_trie": r"""
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS t
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (
  SELECT conv_id, conv_id - conv_id % 100 AS base, CAST(conv_id AS VARCHAR) AS s,
    list({'role': role, 'text': text} ORDER BY t) AS turns
  FROM turns GROUP BY conv_id),
hashed AS (
  SELECT *, xor(list_reduce(
    list_prepend(CAST(4294967295 AS UBIGINT), list_transform(range(1, length(s) + 1), lambda i: CAST(ascii(s[i]) AS UBIGINT))),
    lambda c, b: list_reduce(list_prepend(xor(c, b), CAST([0, 1, 2, 3, 4, 5, 6, 7] AS UBIGINT[])),
      lambda x, y: xor(x >> 1, (x & 1) * CAST(3988292384 AS UBIGINT)))), CAST(4294967295 AS UBIGINT)) % 6 AS h
  FROM own),
paths AS (
  SELECT c.conv_id, list_concat(coalesce(b.turns, [])[1:CAST(c.h AS BIGINT)], c.turns[CAST(c.h AS BIGINT) + 1:]) AS path
  FROM hashed c LEFT JOIN own b ON b.conv_id = c.base),
steps AS (
  SELECT conv_id, len(path) AS n, unnest(range(0, len(path) + 1)) AS depth, path FROM paths),
members AS (
  SELECT conv_id, depth, n = depth AS ends,
    md5(CAST(list_transform(path[1:depth], lambda x: md5(concat(length(x.role), ':', x.role, x.text))) AS VARCHAR)) AS node,
    CASE WHEN depth > 0 THEN
      md5(CAST(list_transform(path[1:depth - 1], lambda x: md5(concat(length(x.role), ':', x.role, x.text))) AS VARCHAR)) END AS parent,
    CASE WHEN depth > 0 THEN length(path[depth].text) ELSE 0 END AS size
  FROM steps),
nodes AS (
  SELECT node, depth, min(parent) AS parent, min(size) AS size, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
  FROM members GROUP BY node, depth),
children AS (SELECT parent, depth - 1 AS depth, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY parent, depth),
full_nodes AS (
  SELECT n.*, coalesce(c.n_children, 0) AS n_children, p.conv_id AS parent_conv_id
  FROM nodes n LEFT JOIN children c ON c.parent = n.node AND c.depth = n.depth
  LEFT JOIN nodes p ON p.node = n.parent AND p.depth = n.depth - 1),
above AS (
  SELECT DISTINCT a.node AS top, a.depth AS top_depth, b.node, b.depth
  FROM nodes d JOIN members b ON b.node = d.node AND b.depth = d.depth AND b.conv_id = d.conv_id
  JOIN members a ON a.conv_id = b.conv_id AND a.depth <= b.depth),
sums AS (
  SELECT top, top_depth, count(*) FILTER (WHERE n.n_children = 0) AS n_leaves, sum((n.n_convs - 1) * n.size) AS saved_tokens
  FROM above JOIN full_nodes n ON n.node = above.node AND n.depth = above.depth GROUP BY top, top_depth)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, n.parent_conv_id, CAST(n.n_convs AS BIGINT) AS n_convs,
  CAST(n.n_children AS BIGINT) AS n_children, CAST(s.n_leaves AS BIGINT) AS n_leaves, CAST(s.saved_tokens AS BIGINT) AS saved_tokens,
  n.ends_sha256
FROM full_nodes n JOIN sums s ON s.top = n.node AND s.top_depth = n.depth
""",
}
