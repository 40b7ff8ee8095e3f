"""The operators of this subpackage as queries on the given tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers
from tidemark.llm import pii_crf as pii
from tidemark.llm import sql
from tidemark.llm.byte_bpe import encode_documents
from tidemark.llm.byte_index import simhash_components
from tidemark.llm.compression_quality import QualityModel, fit_quality, quality
from tidemark.llm.contamination import contamination, is_contaminated
from tidemark.llm.divergence_rules import quality_rules
from tidemark.llm.line_spread import spread_lines
from tidemark.llm.near_duplicates import near_duplicates
from tidemark.llm.phrase_mining import collocations
from tidemark.llm.pu_toxicity import fit_toxicity, toxicity
from tidemark.llm.secret_ownership import KINDS, scan_secrets, spans_text
from tidemark.llm.spelling_variants import spelling_variants
from tidemark.llm.training import remainder
from tidemark.llm.warc import archive_pages


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_pu_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Held-out rows give neither labels nor unlabelled text. The class prior is the share of toxic labels."""
    docs = table(spark, sf_dir, "documents")
    learn = remainder("doc_id", 5) != 0
    labels = table(spark, sf_dir, "labels").where(learn & F.col("toxic").isNotNull())
    prior = labels.agg(F.avg(F.col("toxic").cast("double"))).first()[0] or 0.0
    model = fit_toxicity(docs.where(learn), labels.where("toxic = 1"), prior=prior)
    return verdicts(toxicity(docs, model), remainder("doc_id", 5) == 0, 0.5)


def verdicts(scores: DataFrame, held_out, least: float) -> DataFrame:
    predicted = (F.col("score") >= least).cast("int")
    return scores.select("doc_id", held_out.alias("held_out"), "score", predicted.alias("predicted"))


def quality_model(docs: DataFrame, spark: SparkSession, sf_dir: str) -> QualityModel:
    labels = table(spark, sf_dir, "labels").where(remainder("doc_id", 4) != 2)
    return fit_quality(docs, labels.select("doc_id", F.col("quality").alias("label")))


def op3_compression_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return verdicts(quality(docs, quality_model(docs, spark, sf_dir)), remainder("doc_id", 4) == 2, 0.7)


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(table(spark, sf_dir, "documents"))


def token_digests(docs: DataFrame) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    encoded = encode_documents(docs, path, public_tokenizers.PATTERN)
    return encoded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), "decoded_sha256")


def op4_line_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = spread_lines(table(spark, sf_dir, "documents"))
    digest = F.sha2("clean", 256).alias("clean_sha256")
    return found.select(F.col("doc.doc_id").alias("doc_id"), "n_lines", "n_removed", digest)


def op5_skip_chain_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = pii.find_personal_data(docs, pii.fit_field(docs))

    def count(i: int, kind: str):
        return F.size(F.filter("base", lambda span: span["kind"] == i)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *(count(i, kind) for i, kind in enumerate(pii.KINDS)),
        F.sha2(pii.spans_text("base"), 256).alias("base_sha256"),
        pii.spans_text("spans").alias("spans"),
    )


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op7_secret_ownership(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A source owns its documents; those of one language are a repository."""
    found = scan_secrets(
        table(spark, sf_dir, "documents"), owner="source", repository=F.concat_ws("/", "source", "lang")
    )

    def count(spans: str, field: str, value: int | str, name: str):
        return F.size(F.filter(spans, lambda span: span[field] == value)).cast("long").alias(f"n_{name}")

    return found.select(
        "doc_id",
        *(count("base", "kind", i, kind) for i, kind in enumerate(KINDS[:3])),
        F.sha2(spans_text("base"), 256).alias("base_sha256"),
        spans_text("spans").alias("spans"),
        *(count("spans", "verdict", verdict, verdict) for verdict in ("live", "copied", "weak")),
    )


def op8_prefix_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        is_contaminated().alias("contaminated"),
    )


def op9_warc_salvage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archived(table(spark, sf_dir, "pages"))


def archived(pages: DataFrame) -> DataFrame:
    """What the archives of the pages say, with ids of the pages' own type."""
    records, _ = archive_pages(pages)
    kind = pages.schema["page_id"].dataType
    return records.select(
        F.col("id").cast(kind).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        F.col("type").alias("record_type"),
        F.col("refers_to").cast(kind).alias("refers_to"),
    )


def op10_divergence_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents")).drop("char_distance", "word_distance")


def op11_byte_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(table(spark, sf_dir, "documents"))


def op12_son_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


def op13_bitset_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corpus_pipeline import run  # its stages use the helpers above

    return run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_pu_toxicity": op1_pu_toxicity,
        "op2_byte_bpe": op2_byte_bpe,
        "op3_compression_quality": op3_compression_quality,
        "op4_line_spread": op4_line_spread,
        "op5_skip_chain_crf": op5_skip_chain_crf,
        "op6_near_duplicates": op6_near_duplicates,
        "op7_secret_ownership": op7_secret_ownership,
        "op8_prefix_join": op8_prefix_join,
        "op9_warc_salvage": op9_warc_salvage,
        "op10_divergence_rules": op10_divergence_rules,
        "op11_byte_index": op11_byte_index,
        "op12_son_phrases": op12_son_phrases,
        "op13_bitset_variants": op13_bitset_variants,
        "pipeline": pipeline,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op4_line_spread": sql.LINE_SPREAD,
        "op8_prefix_join": sql.CONTAMINATION,
        "op9_warc_salvage": sql.WARC,
        "op10_divergence_rules": sql.DIVERGENCE_RULES,
        "op12_son_phrases": sql.PHRASES,
    }
