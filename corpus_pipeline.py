"""The corpus pipeline: raw documents to token counts, in five stages.

Each stage works on all that the one before it kept; between stages the documents are written as Parquet.
All but the last return the columns of `documents`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.compression_quality import quality_score
from tidemark.llm.contamination import clean_documents
from tidemark.llm.line_spread import spread_lines
from tidemark.llm.near_duplicates import deduplicate
from tidemark.llm.queries import quality_model, table, token_digests
from tidemark.llm.tables import saved

LONG_SITES = 3  # sites that make a line of over 50 words boilerplate


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.7 or more."""
    model = quality_model(docs, spark, sf_dir)
    return docs.where(quality_score(model) >= 0.7)


def without_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that eight sites have stay only where they occur first; of over 50 words, those of three sites or eight documents.

    A document goes only if it loses lines and nothing but white space is left of it.
    `n_chars` follows the text.
    """
    found = spread_lines(docs, long_sites=LONG_SITES)
    found = found.where((F.col("n_removed") == 0) | F.col("clean").rlike(r"[^\x20\x09-\x0D]"))
    changed = F.when(F.col("n_removed") > 0, F.length("clean").cast("long")).otherwise(F.col("doc.n_chars"))
    new = {"text": F.col("clean").alias("text"), "n_chars": changed.alias("n_chars")}
    return found.select(*(new.get(name, F.col(f"doc.`{name}`")) for name in docs.columns))


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    return deduplicate(docs)


def without_contamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than one word in twenty is benchmark text."""
    return clean_documents(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document: number of tokens and digests of the ids and of the text they decode to."""
    return token_digests(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", good_quality),
    ("line_dedup", without_boilerplate),
    ("near_dedup", without_near_duplicates),
    ("decontamination", without_contamination),
    ("byte_bpe", tokens),
]

# The quality scores, the draws and the ids are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on `documents`."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"stage_{name}")
    return docs
