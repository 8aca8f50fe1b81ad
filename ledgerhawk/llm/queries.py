"""One registered query per operator: thin, over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (
    alignment,
    attention_lm,
    bytebpe,
    collocations,
    langid,
    licenses,
    multi_index,
    outliers,
    packing,
    parity_join,
    qda,
    simhash,
    simple8b,
)
from .common import read, shared_folder


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"))


def op2_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multi_index.nearest_neighbours(read(spark, sf_dir, "embeddings"), every=50, k=5)


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hexed(found["fp"]).alias("fingerprint"), "component_id")


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bytebpe.digests(bytebpe.encode(read(spark, sf_dir, "documents")))


def op5_simple8b(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark)
    simple8b.write_files(read(spark, sf_dir, "documents"), path)
    return simple8b.documents(simple8b.read_files(spark, path))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return langid.identify(docs, langid.train_on(docs)).select(
        "doc_id", langid.held_out().alias("held_out"), "lang_pred", "score", "n_spans")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outliers.verdicts(read(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "distance")


def op8_attention_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attention_lm.score(read(spark, sf_dir, "documents"))


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(read(spark, sf_dir, "documents"))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qda.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(read(spark, sf_dir, "documents"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(read(spark, sf_dir, "documents"))


def op13_parity_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parity_join.join(read(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_packing, op2_multi_index, op3_simhash, op4_byte_bpe, op5_simple8b, op6_language, op7_quality_rules,
        op8_attention_lm, op9_licenses, op10_quality_classifier, op11_alignment, op12_collocations, op13_parity_join)}


#: DuckDB: windows of one to five words by position, counted; every cut and every inner phrase by joins.
_COLLOCATIONS_SQL = r"""
WITH pieces AS (
  SELECT lang, doc, unnest(p) AS piece, generate_subscripts(p, 1) AS at FROM (
    SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS doc, regexp_split_to_array(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS p
    FROM documents)),
parted AS (SELECT lang, [x FOR x IN regexp_split_to_array(piece, '[\x20\x09]+') IF x <> ''] AS w FROM pieces),
phrases AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i
        FROM parted, (SELECT unnest(range(1, 6)) AS k) WHERE len(w) >= k)),
counts AS (SELECT lang, k, phrase, count(*) AS f FROM phrases GROUP BY lang, k, phrase HAVING count(*) >= 100),
totals AS (SELECT lang, sum(len(w)) AS n FROM parted GROUP BY lang),
cuts AS (
  SELECT lang, k, phrase, f, j, array_to_string(string_split(phrase, ' ')[1:j], ' ') AS head,
         array_to_string(string_split(phrase, ' ')[j + 1:k], ' ') AS tail
  FROM (SELECT lang, k, phrase, f, unnest(range(1, k)) AS j FROM counts WHERE k > 1)),
scored AS (
  SELECT c.lang, c.k, c.phrase, c.f AS a, c.j, h.f AS l, t.f AS r, n.n,
         (1000::HUGEINT * c.f * n.n) // (h.f::HUGEINT * t.f) AS score
  FROM cuts c JOIN counts h ON h.lang = c.lang AND h.phrase = c.head JOIN counts t ON t.lang = c.lang AND t.phrase = c.tail
  JOIN totals n ON n.lang = c.lang),
weakest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
inside AS (
  SELECT DISTINCT lang, array_to_string(string_split(phrase, ' ')[i:i + m - 1], ' ') AS phrase, f
  FROM (SELECT lang, k, phrase, f, m, unnest(range(1, k - m + 2)) AS i
        FROM (SELECT lang, k, phrase, f, unnest(range(2, k)) AS m FROM counts WHERE k > 2)))
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score FROM (
  SELECT w.*, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM weakest w
  WHERE NOT EXISTS (SELECT 1 FROM inside i WHERE i.lang = w.lang AND i.phrase = w.phrase AND 100 * i.f >= 100 * w.a))
WHERE rank <= 2000
"""

#: DuckDB: shingles of every text, pairs by common shingles, components by recursion.
_PARITY_JOIN_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, [x FOR x IN regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+') IF x <> ''] AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
  JOIN sizes p ON p.doc_id = a.doc_id JOIN sizes q ON q.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, p.n, q.n HAVING 100 * count(*) >= 80 * (p.n + q.n - count(*))),
reach AS (
  SELECT doc_id AS x, doc_id AS y FROM documents
  UNION SELECT r.x, l.y FROM reach r JOIN links l ON l.x = r.y)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, min(r.y) AS component_id
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id JOIN reach r ON r.x = d.doc_id GROUP BY d.doc_id, s.n
"""


def oracle_sql() -> dict[str, str]:
    """Only what DuckDB can express; the other queries have brute-force tests."""
    return {"op12_collocations": _COLLOCATIONS_SQL, "op13_parity_join": _PARITY_JOIN_SQL}
