"""The registered queries of the dealt operators, with production parameters, and their SQL."""

from __future__ import annotations

import string

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyload.llm.bpe import bpe_digests
from tallyload.llm.byte_bpe import byte_bpe_digests
from tallyload.llm.common import crc32_mod
from tallyload.llm.embeddings import embedding_neardup
from tallyload.llm.jaccard import jaccard_components
from tallyload.llm.language import language_predictions
from tallyload.llm.merkle import merkle_manifest, verify_manifest
from tallyload.llm.mixing import mix_sources
from tallyload.llm.neighbours import nearest_neighbours
from tallyload.llm.quality import quality_scores
from tallyload.llm.secrets import secret_scan, span_text
from tallyload.llm.spelling import variant_groups
from tallyload.llm.substrings import substring_dedup
from tallyload.llm.token_counts import token_counts


def vocabulary_path() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json"))


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_embedding_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_neardup(_table(spark, sf_dir, "embeddings"), threshold=0.9)


def op2_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(_table(spark, sf_dir, "embeddings"), k=20, query_every=20)


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(_table(spark, sf_dir, "documents"), window=13, digests=True).select(
        "doc_id", "n_words", "n_removed", F.col("kept").alias("kept_sha256"))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_predictions(_table(spark, sf_dir, "documents"))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_digests(_table(spark, sf_dir, "documents"), vocabulary_path())


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document by line: totals, crossing tokens, and a digest of the counts by line."""
    t = token_counts(_table(spark, sf_dir, "documents"), vocabulary_path(), rule="most")
    counts = F.concat_ws(",", F.col("section_tokens").cast("array<string>"))
    return t.select("doc_id", "n_tokens", "n_crossing", F.size("section_tokens").cast("long").alias("n_sections"),
                    F.coalesce(F.array_max("section_tokens"), F.lit(0)).alias("most_tokens"),
                    F.sha2(counts, 256).alias("counts_sha256"))


def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan(_table(spark, sf_dir, "documents"))
    number = lambda kind: F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long")
    return found.select("doc_id", number(0).alias("n_assign"), number(1).alias("n_access"), number(2).alias("n_hex"),
                        F.sha2(span_text(F.col("base")), 256).alias("base_sha256"), span_text(F.col("spans")).alias("spans"))


def op10_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(_table(spark, sf_dir, "documents"), words=3, threshold=(90, 100))


def op11_byte_level_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return byte_bpe_digests(_table(spark, sf_dir, "documents"), str(public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN)


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variant_groups(_table(spark, sf_dir, "documents"), noise=199, min_length=6, min_count=5, ratio=5)


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fifth document (by the CRC-32 of its id) is tampered with: its text loses its capital letters."""
    lower = lambda c: F.translate(c, string.ascii_uppercase, string.ascii_lowercase)
    manifest = merkle_manifest(_table(spark, sf_dir, "documents"), ["doc_id", "source", "lang", "n_chars", "text"], fanout=16,
                               altered={"text": lower}, altered_where=lambda doc_id: crc32_mod(doc_id, 5) == 0)
    return verify_manifest(manifest).select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


QUERIES = {f.__name__: f for f in (op1_embedding_neardup, op2_nearest_neighbours, op3_substring_dedup,
                                  op4_quality_classifier, op5_language_id, op6_bpe,
                                  op7_token_counts, op8_mix_sources, op9_secret_scan,
                                  op10_ngram_jaccard_join, op11_byte_level_bpe, op12_spelling_variants, op13_merkle_manifest)}

#: Words of DuckDB's ``documents``, one row each.
_WORDS = r"""
words AS (
  SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS pos
  FROM (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents))"""

#: CRC-32 of the decimal doc_id, before its last complement.
_CRC32 = """list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
  lambda c, b: list_reduce(list_prepend(xor(c, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
    lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END))"""


def _leaf_text(text: str) -> str:
    fields = ["doc_id", "source", "lang", "n_chars", text]
    return " || ".join(f"coalesce(strlen({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR, '-')" for c in fields)


ORACLE_SQL: dict[str, str] = {
    "op1_embedding_neardup": """
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e, sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])) AS norm FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 0.9),
reach(node, other) AS (
  SELECT vec_id, vec_id FROM embeddings UNION SELECT r.node, l.b FROM reach r JOIN links l ON r.other = l.a),
comp AS (SELECT node, min(other) AS component_id FROM reach GROUP BY node)
SELECT e.vec_id, coalesce(n.n_links, 0) AS n_links, c.component_id, e.vec_id = c.component_id AS kept
FROM embeddings e JOIN comp c ON c.node = e.vec_id
LEFT JOIN (SELECT a, count(*) AS n_links FROM links GROUP BY a) n ON n.a = e.vec_id""",
    "op3_substring_dedup": f"""
WITH {_WORDS},
windows AS (
  SELECT doc_id, pos, string_agg(word, ' ') OVER f AS win, count(*) OVER f AS n FROM words
  WINDOW f AS (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 12 FOLLOWING)),
firsts AS (SELECT win, min(doc_id) AS first_id FROM windows WHERE n = 13 GROUP BY win),
dup AS (SELECT w.doc_id, w.pos FROM windows w JOIN firsts USING (win) WHERE w.n = 13 AND first_id < w.doc_id),
marked AS (
  SELECT w.doc_id, w.pos, w.word, max(d.pos) OVER (PARTITION BY w.doc_id ORDER BY w.pos) AS last_start
  FROM words w LEFT JOIN dup d ON d.doc_id = w.doc_id AND d.pos = w.pos),
kept AS (
  SELECT doc_id, count(*) AS n_words, count(*) FILTER (WHERE w_gone) AS n_removed,
         coalesce(string_agg(word, ' ' ORDER BY pos) FILTER (WHERE NOT w_gone), '') AS kept
  FROM (SELECT *, coalesce(pos - last_start < 13, false) AS w_gone FROM marked) GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM documents d LEFT JOIN kept USING (doc_id)""",
    "op10_ngram_jaccard_join": r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS s FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id),
links AS (
  SELECT c.a, c.b FROM common c JOIN sizes x ON x.doc_id = c.a JOIN sizes y ON y.doc_id = c.b
  WHERE 100 * c.n >= 90 * (x.n + y.n - c.n)),
reach(node, other) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT r.node, l.b FROM reach r JOIN links l ON r.other = l.a),
comp AS (SELECT node, min(other) AS component_id FROM reach GROUP BY node)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, c.component_id
FROM documents d JOIN comp c ON c.node = d.doc_id LEFT JOIN sizes s USING (doc_id)""",
    "op13_merkle_manifest": f"""
WITH RECURSIVE rows_ AS (
  SELECT doc_id, source, sha256({_leaf_text('text')}) AS leaf,
         CASE WHEN xor({_CRC32}, 4294967295) % 5 = 0 THEN sha256({_leaf_text("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")}) END AS altered
  FROM documents),
sources AS (SELECT source, count(*) AS n, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS tree FROM rows_ GROUP BY source),
leaves AS (
  SELECT doc_id, leaf, altered, tree, n, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx
  FROM rows_ r JOIN sources s ON r.source IS NOT DISTINCT FROM s.source),
nodes AS (
  SELECT tree, 0 AS lvl, idx, n, leaf AS h FROM leaves
  UNION ALL
  SELECT tree, lvl + 1, idx // 16, (n + 15) // 16, sha256(string_agg(h, '' ORDER BY idx)) FROM nodes WHERE n > 1 GROUP BY tree, lvl, idx // 16, n),
subroots AS (SELECT tree, lvl, h FROM nodes WHERE n = 1),
uppers AS (
  SELECT 0 AS lvl, tree AS idx, (SELECT count(*) FROM sources) AS n, h FROM subroots
  UNION ALL
  SELECT lvl + 1, idx // 16, (n + 15) // 16, sha256(string_agg(h, '' ORDER BY idx)) FROM uppers WHERE n > 1 GROUP BY lvl, idx // 16, n),
steps AS (
  SELECT tree, lvl, idx // 16 AS run, list(h ORDER BY idx) AS hs FROM nodes WHERE n > 1 GROUP BY tree, lvl, idx // 16
  UNION ALL
  SELECT s.tree, s.lvl + u.lvl, u.run, u.hs
  FROM subroots s JOIN (SELECT lvl, idx // 16 AS run, list(h ORDER BY idx) AS hs FROM uppers WHERE n > 1 GROUP BY lvl, idx // 16) u
    ON u.run = s.tree // (16 ** (u.lvl + 1))::BIGINT),
climb AS (
  SELECT doc_id, leaf, altered, l.tree, s.lvl AS top, 0 AS lvl, CASE WHEN s.lvl = 0 THEN l.tree ELSE idx END AS pos, '' AS proof, coalesce(altered, leaf) AS folded
  FROM leaves l JOIN subroots s ON s.tree = l.tree
  UNION ALL
  SELECT doc_id, leaf, altered, c.tree, top, c.lvl + 1, CASE WHEN c.lvl + 1 = top THEN c.tree ELSE pos // 16 END,
         proof || array_to_string(hs[:pos % 16], '') || array_to_string(hs[pos % 16 + 2:], ''),
         sha256(array_to_string(hs[:pos % 16], '') || folded || array_to_string(hs[pos % 16 + 2:], ''))
  FROM climb c
  JOIN steps s ON s.tree = c.tree AND s.lvl = c.lvl AND s.run = c.pos // 16)
SELECT doc_id, leaf, (SELECT h FROM subroots s WHERE s.tree = c.tree) AS subroot, (SELECT h FROM uppers WHERE n = 1) AS root,
       sha256(proof) AS proof_sha256, folded AS folded_root, folded = (SELECT h FROM uppers WHERE n = 1) AS verified
FROM climb c WHERE lvl = top + (SELECT max(lvl) FROM uppers)""",
}
