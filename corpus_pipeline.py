"""Corpus pipeline: five stages from raw documents to token ids, each over all that its predecessor kept.

Every stage takes (spark, docs, sf_dir); run() writes each result as Parquet to
the shared folder (``spark.checkpoint.dir``) and reads it back for the next, so
a lost executor never costs more than the stage at work.

Defined cases: an empty table gives no rows; rows with null texts go with the
first stage, as their words are too few; repeated rows are near duplicates, of
which one stays; other columns than those of ``documents`` pass all stages but
the last.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestack.llm import decontaminate, line_dedup, pieces, quality, simhash
from lodestack.session import remove, shared_folder, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or leave their language's bands go."""
    return quality.keep_good(docs)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of many documents stay only in the largest doc_id; n_chars follows the text."""
    out = line_dedup.drop_repeated_lines(docs)
    kept = F.col("line_dedup.kept")
    return out.withColumns({"text": kept, "n_chars": F.length(kept).cast("long")}).select(*docs.columns)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: five-word shingles, similarity 0.8 to the kept one."""
    return simhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of what is left."""
    return pieces.encode(docs).select(F.col("id").alias("doc_id"), F.size("tokens").cast("long").alias("n_tokens"), "tokens")


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup_stage),
    ("SimHash near-dedup", simhash_dedup),
    ("benchmark decontamination", decontamination),
    ("SentencePiece encoding", sentencepiece),
]

#: Fertility, SimHash and tokens cannot be said in SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the last stage; the tables of the stages before it are deleted once the next one is written."""
    home = f"{shared_folder(spark)}/corpus-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{home}/{k}")
        docs = spark.read.parquet(f"{home}/{k}")
        if k:
            remove(spark, f"{home}/{k - 1}")
    return docs
