"""From raw documents to token ids in five stages, each one operator over all that the stage before it kept.

``STAGES`` names them in order; each function takes (spark, docs, sf_dir) and
returns a DataFrame, and all but the last return the columns of ``docs``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelforge.llm import bpe, contamination, jaccard, langid, lines
from panelforge.llm.common import fitting, table, written

#: A text whose words are on average less likely than this to be of the language that each is labelled with is rejected.
LEAST_SURE = 0.5


def _aside(docs: DataFrame, *made: str) -> tuple[DataFrame, list[Column]]:
    """``docs`` with columns that are named like an operator's results under other names, and what brings back its own columns."""
    names = {c: f"__docs_{c}" if c.lower() in made else c for c in docs.columns}
    return docs.withColumnsRenamed(names), [F.col(f"`{other}`").alias(c) for c, other in names.items()]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without any language (null, empty, without letters) or with words of none in particular; a text in several languages stays."""
    rows, own = _aside(docs, "lang_pred", "score", "sure")
    found = langid.identify(rows, langid.fit(docs), rows.columns, sure=True)
    return found.where((F.col("lang_pred") != langid.UNKNOWN) & (F.col("sure") >= LEAST_SURE)).select(*own)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes the lines that recur across documents out of the texts; ``n_chars`` follows."""
    rows, own = _aside(docs, "n_lines", "n_dropped")
    out = lines.dedup(rows).select(*own)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the least ``doc_id`` of every group of similar documents; documents without a key stay."""
    gone = jaccard.join(docs).where(F.col("component_id") != F.col("doc_id")).select("doc_id").distinct()
    gone = written(gone, "pipeline-duplicates")
    return docs.join(fitting(gone, jaccard.BROADCAST_BYTES), "doc_id", "left_anti").select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents of whose words a twentieth or more stand in passages of the benchmark."""
    rows, own = _aside(docs, "n_words", "n_hit", "items")
    found = contamination.find(rows, table(spark, sf_dir, "benchmark"), keep=rows.columns)
    return found.where(~((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))).select(*own)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids``, and whether decoding gives the text again."""
    out = bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, keep=["doc_id", "text"])
    return out.select("doc_id", "n_tokens", "ids", (F.col("decoded") == F.coalesce("text", F.lit("")).cast("binary")).alias("round_trip"))


STAGES = [("language", language), ("line_dedup", line_dedup), ("near_duplicates", near_duplicates), ("decontamination", decontamination), ("encoding", encoding)]

#: None of the learned, hashed and tokenising stages can be put in SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
