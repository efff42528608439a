"""The operators bound to the driver tables, with production parameters.

Each query applies its operator to the whole table and returns its full result.
Vocabulary files come from the ``public_tokenizers`` package of the workers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import (bestfit_pack, collocations, decontaminate, html_extract, kneser_ney, license_scan, line_dedup, quality_rules, simhash_vptree, source_audit, suffix_dedup,
               token_counts, token_store)
from .common import read_table, scratch_path


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_extract.extract(read_table(spark, sf_dir, "pages"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document that lie in a 100-byte string with an earlier start."""
    rows = suffix_dedup.remove_repeats(read_table(spark, sf_dir, "documents"), length=100)
    return rows.select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
                       F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document by the 32k piece model; over 4096 is marked."""
    return token_counts.count_tokens(read_table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"), limit=4096)


def op4_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Perplexity and verdict of every document by models of the trusted text of its language."""
    rows = kneser_ney.classify(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return rows.drop("text_hash")


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every license notice in every document."""
    found = license_scan.scan(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "license_id", "containment", "begin_word")


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that holds a benchmark item, or a longer part of one."""
    found = decontaminate.find_overlaps(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "equal_words", "item_words", "first_word", "end_word")


def op7_bestfit_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 2048 tokens of the 50k byte vocabulary, end id 0."""
    return bestfit_pack.pack(read_table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), end_id=0, capacity=2048)


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and verdict of every document, fences by language and source."""
    rows = quality_rules.quality_rules(read_table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents: 3-word shingles, at most 2 bits apart."""
    rows = simhash_vptree.simhash_components(read_table(spark, sf_dir, "documents"), shingle=3, max_bits=2)
    return rows.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op10_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded by the 49k word vocabulary, written as shards and read back."""
    path = scratch_path(spark, "token-store")
    token_store.write_store(read_table(spark, sf_dir, "documents"), path, tokenizer_path("word_bpe_49k.json"), end_id=2)
    return token_store.read_store(spark, path).select("doc_id", "start", "n_tokens", "ids_crc32")


def op11_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Divergence of all sources of each language, and the ten terms that set each source apart."""
    return source_audit.audit(read_table(spark, sf_dir, "documents"), least_docs=10, top=10)


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of every document, those dropped because a later document holds them, and a digest of the rest."""
    docs = read_table(spark, sf_dir, "documents")
    rows = line_dedup.kept_texts(docs, line_dedup.keep_bitmaps(docs, least_chars=20, least_docs=3))
    return rows.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2000 phrases of each language by score."""
    return collocations.collocations(read_table(spark, sf_dir, "documents"), least=30, longest=4, share=80, top=2000)


QUERIES = {
    "op1_html_extract": op1_html_extract,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_token_counts": op3_token_counts,
    "op4_kneser_ney": op4_kneser_ney,
    "op5_license_scan": op5_license_scan,
    "op6_decontaminate": op6_decontaminate,
    "op7_bestfit_pack": op7_bestfit_pack,
    "op8_quality_rules": op8_quality_rules,
    "op9_simhash": op9_simhash,
    "op10_token_store": op10_token_store,
    "op11_source_audit": op11_source_audit,
    "op12_line_dedup": op12_line_dedup,
    "op13_collocations": op13_collocations,
}
#: DuckDB SQL where it can express a query; the others are tested against brute force.
ORACLE: dict[str, str] = {
    "op11_source_audit": r"""
WITH d AS (SELECT row_number() OVER () AS row_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
words AS (
  SELECT row_id, lang, source, translate(unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM d),
kept AS (SELECT lang, term, count(*) AS n FROM words GROUP BY lang, term HAVING count(DISTINCT row_id) >= 10),
langs AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang),
counts AS (SELECT lang, source, term, count(*) AS n FROM words JOIN kept USING (lang, term) GROUP BY lang, source, term),
sources AS (SELECT lang, source, sum(n) AS total FROM counts GROUP BY lang, source),
grp AS (SELECT DISTINCT lang, source FROM d),
valued AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
    1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 2)) // (coalesce(s.total, 0) + 2 * l.v) AS p,
    1 + (1000000000::HUGEINT * (k.n + 2)) // (l.total + 2 * l.v) AS q
  FROM grp g JOIN kept k ON k.lang = g.lang JOIN langs l ON l.lang = g.lang
  LEFT JOIN sources s ON s.lang = g.lang AND s.source = g.source
  LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
  FROM valued a JOIN valued b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source),
every AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(p.value, 0) AS BIGINT) AS value
  FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, CAST(((p - q) * (p - q)) // (p + q) AS BIGINT) FROM valued WHERE n > 0 AND p > q),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM every)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 10""".strip(),
    "op12_line_dedup": r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS place FROM documents),
keyed AS (
  SELECT doc_id, place, line,
    translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines),
many AS (SELECT k, max(doc_id) AS largest FROM keyed WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3),
judged AS (SELECT doc_id, place, line, m.k IS NOT NULL AND doc_id <> largest AS lost FROM keyed LEFT JOIN many m USING (k))
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (WHERE lost) AS BIGINT) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT lost), '')) AS kept_sha256
FROM judged GROUP BY doc_id""".strip(),
    "op13_collocations": r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
pieces AS (SELECT lang, regexp_extract_all(unnest(string_split_regex(text, '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS w FROM d),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM pieces GROUP BY lang),
places AS (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM pieces, (VALUES (1), (2), (3), (4)) AS sizes(k)),
f AS (SELECT lang, k, w[i : i + k - 1] AS ws, count(*) AS n FROM places GROUP BY ALL HAVING count(*) >= 30),
known AS (SELECT lang, k, ws, array_to_string(ws, ' ') AS phrase, n FROM f),
cuts AS (SELECT lang, phrase, ws, k, n AS a, unnest(range(1, k)) AS j FROM known WHERE k > 1),
scored AS (
  SELECT c.lang, c.phrase, c.a, c.j, x.n AS l, y.n AS r, (2000000::HUGEINT * c.a) // (x.n + y.n) AS score
  FROM cuts c JOIN known x ON x.lang = c.lang AND x.ws = c.ws[1 : c.j] JOIN known y ON y.lang = c.lang AND y.ws = c.ws[c.j + 1 : c.k]),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
sizes AS (SELECT lang, ws, k, n, unnest(range(2, k)) AS m FROM known WHERE k > 2),
inside AS (SELECT lang, n, m, ws, unnest(range(1, k - m + 2)) AS i FROM sizes),
covered AS (SELECT lang, array_to_string(ws[i : i + m - 1], ' ') AS phrase, max(n) AS n FROM inside GROUP BY ALL),
kept AS (SELECT x.* FROM lowest x LEFT JOIN covered c USING (lang, phrase) WHERE c.n IS NULL OR 100::HUGEINT * c.n < 80::HUGEINT * x.a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, totals.n AS n, CAST(score AS BIGINT) AS score
FROM kept JOIN totals USING (lang) QUALIFY rank <= 2000""".strip(),
}
