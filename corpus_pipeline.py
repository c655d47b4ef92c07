"""A corpus from raw documents to token ids: five stages, each written before the next one reads it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lumenql.llm import bpe, decontam, near_dup, quality, secret_scan
from lumenql.llm.common import TEXT_ROWS, discard, in_few, materialize, scratch_scope, table
from lumenql.llm.queries import tokenizer_path


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep. Null and empty texts have no word and go; an empty table stays empty."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of each group that links at a Jaccard of 0.8 over five-word shingles.

    Rows are told by id and text; see ``near_dup.drop_near_copies`` for ids that are null or shared.
    """
    return in_few(near_dup.drop_near_copies(docs), docs.count(), 4, TEXT_ROWS)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text holds no benchmark item; a clean text stays though another row of its id goes."""
    return in_few(decontam.drop_leaked(docs, table(spark, sf_dir, "benchmark")), docs.count(), 4, TEXT_ROWS)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts masked; ``n_chars`` counts the text as it now is. Null texts stay as they are."""
    from pyspark.sql import functions as F

    masked = secret_scan.redact(docs)
    return masked.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars"))).select(*docs.columns)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document; a null or empty text has none."""
    return bpe.encode_decode(docs, tokenizer_path()).select("doc_id", "n_tokens", "ids")


STAGES = [
    ("quality rules", quality_stage),
    ("simhash near-dedup", dedup_stage),
    ("benchmark decontamination", decontamination_stage),
    ("secret scans", secrets_stage),
    ("bpe encoding", encoding_stage),
]

#: Links between fingerprints, templates and token ids are beyond SQL; tests/llm holds a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage kept in the shared folder goes once its successor is written."""
    docs, path = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        before = path
        with scratch_scope(spark) as keep:
            docs, path = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
            keep(path)
        if before:
            discard(spark, before)
    return docs
