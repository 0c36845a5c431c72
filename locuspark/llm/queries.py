"""The queries ``opN_<name>`` and ``pipeline``, and their SQL for DuckDB.

Each query reads a whole table, applies its operator with production parameters
and derives the columns of its contract from the operator's output.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .exact_dedup import exact_duplicates
from .html_extract import extract
from .line_dedup import dedup_lines
from .packing import pack_documents
from .quality_classifier import fit, score
from .quality_rules import BASE, STOP_WORDS, quality_rules, words_of
from .sentencepiece_codec import decode, encode
from .simhash import members
from .substring_dedup import dedup_substrings
from .token_output import tokens_table


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` without the columns that no operator here reads, so that none of their names can clash with a result's."""
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = texts(spark, sf_dir)
    network, prior = fit(docs, table(spark, sf_dir, "labels").select("doc_id", "quality"))
    return score(docs, network, prior)


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_substrings(texts(spark, sf_dir))
    kept = F.array_join(words_of(F.col("text")), " ")
    return out.select("doc_id", "n_words", "n_removed", F.sha2(kept.cast("binary"), 256).alias("kept_sha256"))


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = members(texts(spark, sf_dir))
    return out.select(F.col("_doc").alias("doc_id"), F.lpad(F.lower(F.hex("_print")), 16, "0").alias("fingerprint"), F.col("_component").alias("component_id"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_lines(texts(spark, sf_dir))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op5_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages").select("page_id", "url", "html")).select("page_id", "url", "text", "n_chars")


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(texts(spark, sf_dir))


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: n_tokens, the SHA-256 of the ids as text joined by spaces, and whether decoding them gives the text back."""
    model = public_tokenizers.path("piece_bpe_32k.model")
    out = decode(encode(texts(spark, sf_dir), model), model)
    given = F.replace(F.coalesce("text", F.lit("")), F.lit("\u2581"), F.lit(" "))
    return out.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        (F.col("decoded") == given).alias("round_trip"),
    )


def op8_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens_table(texts(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules(texts(spark, sf_dir))
    return out.select("doc_id", *BASE, "base_failed", "kept")


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_classifier": op1_quality_classifier,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_simhash_near_dedup": op3_simhash_near_dedup,
    "op4_line_dedup": op4_line_dedup,
    "op5_html_extract": op5_html_extract,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_sentencepiece": op7_sentencepiece,
    "op8_token_output": op8_token_output,
    "op9_quality_rules": op9_quality_rules,
    "op10_best_fit_packing": op10_best_fit_packing,
}

BLANK_SQL = "(' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"

STOP_SQL = ", ".join(f"'{w}'" for w in STOP_WORDS)

SQL: dict[str, str] = {
    "op2_substring_dedup": """
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
g AS (SELECT doc_id, unnest(ws) AS word, unnest(range(len(ws))) AS i FROM w),
v AS (SELECT doc_id, i, md5(string_agg(word, ' ') OVER o) AS h, count(*) OVER o AS n FROM g
  WINDOW o AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 34 FOLLOWING)),
r AS (SELECT doc_id, i, count(*) OVER (PARTITION BY h) > 1 AS again FROM v WHERE n = 35),
c AS (SELECT g.doc_id, g.word, g.i,
  coalesce(max(CASE WHEN again THEN g.i END) OVER (PARTITION BY g.doc_id ORDER BY g.i ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) IS NOT NULL, false) AS gone
  FROM g LEFT JOIN r ON g.doc_id = r.doc_id AND g.i = r.i),
k AS (SELECT doc_id, count(*) FILTER (WHERE gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (WHERE NOT gone) AS kept FROM c GROUP BY doc_id)
SELECT w.doc_id, len(ws) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN k ON w.doc_id = k.doc_id""",
    "op4_line_dedup": f"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS pos FROM d),
k AS (SELECT *, translate(trim(line, {BLANK_SQL}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
c AS (SELECT key, max(doc_id) AS keep FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
m AS (SELECT k.doc_id, k.pos, k.line, c.key IS NOT NULL AND k.doc_id <> c.keep AS dropped FROM k LEFT JOIN c ON k.key = c.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM m GROUP BY doc_id""",
    "op6_exact_dedup": """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
  doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))""",
    "op9_quality_rules": f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS ws,
  list_filter(string_split(t, chr(10)), lambda l: trim(l, {BLANK_SQL}) <> '') AS ls FROM d),
g AS (SELECT doc_id, unnest(ws) AS a, unnest(range(len(ws))) AS i FROM w),
v AS (SELECT *, lead(a) OVER o AS b, lead(a, 2) OVER o AS c FROM g WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
h AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n FROM v WHERE c IS NOT NULL),
r AS (SELECT doc_id, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM h WHERE n > 1) GROUP BY doc_id),
f AS (SELECT w.doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
  length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, len(ls) - len(list_distinct(ls)) AS n_dup_lines,
  coalesce(n_repeat_words, 0) AS n_repeat_words, len(ls) AS n_lines,
  len(list_filter(ws, lambda x: lower(x) IN ({STOP_SQL}))) AS n_stop_words,
  length(regexp_replace(t, '[^A-ZÀ-ÖØ-Þ]', '', 'g')) AS n_upper,
  len(regexp_extract_all(t, '!!')) AS n_exclaimed
  FROM w LEFT JOIN r ON w.doc_id = r.doc_id),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM f)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND 100 * word_chars BETWEEN 200 * n_words AND 1400 * n_words
  AND 100 * n_symbols <= 10 * n_words AND 100 * n_stop_words >= 3 * n_words
  AND 100 * n_dup_lines <= 50 * n_lines AND 100 * n_upper <= 30 * word_chars
  AND 100 * n_exclaimed <= 10 * n_words AS kept
FROM b""",
}
