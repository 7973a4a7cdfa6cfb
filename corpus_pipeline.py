"""The corpus pipeline: five operators in a row over ``documents``.

Each stage works on all its predecessor kept, takes its decisions on whole
texts and, but for the last, returns the columns of ``documents``.  Columns
beyond ``doc_id`` and ``text`` pass as they are, whatever their names: a stage
holds them in one struct beside its own.  An empty table gives an empty table
of the same columns.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haven.llm.common import document_rows, read_table, scratch_root
from haven.llm.decontam import contaminated
from haven.llm.langid import UNKNOWN_WORD, fit, predict
from haven.llm.lines import line_dedup
from haven.llm.pieces import encode_documents
from haven.llm.queries import VOCABULARY
from haven.llm.setsketch import near_duplicates

#: Language ID rejects a document whose best language gets less than this.
MIN_SCORE = 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a language: none that stands out, or no letter,
    so null, empty and blank texts go.  Each row is judged by itself, with
    ties going to the first language by name: repeated rows and null ids go or
    stay alike, and texts of any length are scored whole.
    """
    held = docs.select(F.struct("*").alias("row"), "doc_id", "text")
    scored = predict(held, fit(docs, VOCABULARY), VOCABULARY, carry=["row"])
    return scored.filter((F.col("lang_pred") != UNKNOWN_WORD) & (F.col("score") >= MIN_SCORE)).select("row.*")


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes shared lines out of the texts; every document stays.

    A null text becomes an empty one; ``n_chars`` follows the text.  Rows of
    one id are one document, so repeated rows keep or lose a line alike, and a
    tie for the largest id cannot be; null ids are one document, the smallest.
    """
    out = line_dedup(docs.select(F.struct("*").alias("row"), "doc_id", "text"), keep=["row"])
    text = {"text": F.col("kept_text"), "n_chars": F.length("kept_text").cast("long")}
    return out.select(*(text.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each near-duplicate group: the smallest id.

    Documents without a word, null texts among them, are linked with nothing
    and stay, as do null ids; repeated rows of the kept id all stay.
    """
    stays = near_duplicates(docs).filter("kept").select(F.col("doc_id").alias("stays_id")).distinct()
    return docs.join(stays, docs["doc_id"].eqNullSafe(stays["stays_id"]), "left_semi")


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item.

    Null and empty texts hold none.  A row is known by its id and its text's
    hash, so rows of one id are judged each by its own text, and null ids too.
    """
    keyed = document_rows(docs)
    hits = contaminated(keyed, read_table(spark, sf_dir, "benchmark"), keys=("doc_id", "th")).select(
        F.col("doc_id").alias("hit_id"), F.col("th").alias("hit_th")).distinct()
    th = F.xxhash64(F.coalesce("text", F.lit("")))
    return docs.join(hits, docs["doc_id"].eqNullSafe(hits["hit_id"]) & (th == hits["hit_th"]), "left_anti")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of what is left, row by row; null and empty texts have the begin and end ids alone."""
    return encode_documents(docs, VOCABULARY)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("line_dedup", lines),
    ("near_dedup", near_dedup),
    ("decontamination", decontaminate),
    ("encode", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and reread."""
    docs = read_table(spark, sf_dir, "documents")
    base = f"{scratch_root(spark)}/pipeline-{uuid.uuid4().hex[:12]}"
    for n, (name, stage) in enumerate(STAGES):
        path = f"{base}/{n}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


#: Language scores, near-duplicate links and merges are beyond SQL; tests/llm compares with brute force.
ORACLE_SQL = None
