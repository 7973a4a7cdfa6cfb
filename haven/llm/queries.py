"""The dealt operators as registered queries over the given tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haven.llm import dialogue, lines, sharding, spelling, warc
from haven.llm.common import read_table
from haven.llm.decontam import contaminated
from haven.llm.dialogue import damaged, repair_structure
from haven.llm.exact import exact_dedup
from haven.llm.langid import fit, held_out, predict
from haven.llm.main_text import main_text
from haven.llm.pieces import encode_documents
from haven.llm.secret_scan import scan_secrets
from haven.llm.setsketch import near_duplicates
from haven.llm.spelling import spelling_groups
from haven.llm.substring import substring_dedup

#: The public vocabulary of operators 7 and 9.
VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")
SHARDS = 8


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(read_table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(read_table(spark, sf_dir, "documents"))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.law_columns(sharding.interleave(read_table(spark, sf_dir, "documents"), SHARDS))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(read_table(spark, sf_dir, "documents")).drop("matches")


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.pages_through_warc(read_table(spark, sf_dir, "pages"))


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(read_table(spark, sf_dir, "documents"), VOCABULARY, with_ids=False)


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    out = predict(docs, fit(docs, VOCABULARY), VOCABULARY)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lines.line_dedup(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.encode("kept_text", "UTF-8"), 256).alias("kept_sha256"))


def op11_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(read_table(spark, sf_dir, "pages"))


def op12_spelling_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_groups(read_table(spark, sf_dir, "documents"), noise=97)


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_structure(damaged(read_table(spark, sf_dir, "conversations")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_substring_dedup, op2_exact_dedup, op3_sharding, op4_secret_scan, op5_decontamination, op6_warc,
        op7_sentencepiece, op8_near_dedup, op9_language_id, op10_line_dedup, op11_main_text, op12_spelling_groups,
        op13_conversation_repair)}

EXACT_ORACLE = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256 FROM documents),
k AS (
  SELECT *, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size FROM d
  WINDOW w AS (PARTITION BY text_sha256 ORDER BY length(text) DESC, doc_id))
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM k
"""

SUBSTRING_ORACLE = r"""
WITH d AS (
  SELECT doc_id, [x FOR x IN regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+') IF x <> ''] AS w FROM documents),
win AS (
  SELECT doc_id, s, md5(array_to_string(w[s:s + 34], ' ')) AS h FROM (
    SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS s FROM d WHERE len(w) >= 35)),
rep AS (SELECT doc_id, s FROM (SELECT *, count(*) OVER (PARTITION BY h) AS n FROM win) WHERE n > 1),
pos AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS word FROM d WHERE len(w) > 0),
gone AS (
  SELECT p.doc_id, p.i, p.word, coalesce(max(r.s) >= p.i - 34, false) AS g
  FROM pos p ASOF LEFT JOIN rep r ON p.doc_id = r.doc_id AND p.i >= r.s GROUP BY p.doc_id, p.i, p.word)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(x.n_removed, 0)::BIGINT AS n_removed,
  sha256(coalesce(x.kept, '')) AS kept_sha256
FROM d LEFT JOIN (
  SELECT doc_id, count(*) FILTER (WHERE g) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (WHERE NOT g) AS kept
  FROM gone GROUP BY doc_id) x USING (doc_id)
"""

ORACLE: dict[str, str] = {
    "op1_substring_dedup": SUBSTRING_ORACLE,
    "op2_exact_dedup": EXACT_ORACLE,
    "op3_sharding": sharding.ORACLE,
    "op6_warc": warc.ORACLE,
    "op10_line_dedup": lines.ORACLE,
    "op12_spelling_groups": spelling.ORACLE,
    "op13_conversation_repair": dialogue.ORACLE,
}
