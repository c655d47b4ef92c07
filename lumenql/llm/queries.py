"""The registered queries of the training-data operators: thin views of the operators' results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, decontam, quality, secret_scan, sharding, simhash, token_file, toxicity, url_reputation, warc
from .common import in_few, table

#: Tokenizer file of the encoding queries, by the name that its package gives it.
TOKENIZER = "word_bpe_49k.json"
URL_RULES = [
    url_reputation.rule("block", "com/en/"),
    url_reputation.rule("allow", "example.com/en/7"),
    url_reputation.rule("allow", "net/de/"),
    url_reputation.rule("block", "example.net/de/8"),
    url_reputation.rule("block", "org/es/"),
]
ARRIVALS = 11
#: Runs up to this size are the lowest tier.
BASE_BYTES = 64 << 20
#: Records of pages longer than this are segmented.
SEGMENT_BYTES = 8192
#: Pages that a task of the query's last stage reads back, at most, on average.
WARC_ROWS = 1 << 16


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(table(spark, sf_dir, "documents"))


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan_secrets(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
    spans = F.col("secret_spans")
    count = lambda kind: F.size(secret_scan.of_kind(spans, kind)).cast("long").alias(f"n_{kind}")
    base = secret_scan.as_text(secret_scan.of_kind(spans, "assign", "access", "hex"))
    return found.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(base.cast("binary"), 256).alias("base_sha256"), secret_scan.as_text(spans).alias("spans"))


def op3_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as the compacted store's newest version holds it, with that version and the merges behind its run.

    Runs below ``BASE_BYTES`` are the lowest tier, of which any four make a merge.
    """
    docs = table(spark, sf_dir, "documents").withColumn("arrival", F.pmod("doc_id", F.lit(ARRIVALS)).cast("int"))
    store = sharding.shard_table(docs, "arrival", base_bytes=BASE_BYTES)
    rows = store.read(shard=None, merges="n_merges")
    text = (F.octet_length("text").cast("long").alias("n_bytes"), F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"))
    return rows.select("doc_id", "arrival", *text, "n_merges", F.lit(store.version()).alias("version"))


def op4_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcomes are the labels whose ``doc_id`` is a page's id: good if of quality and not toxic."""
    pages, labels = table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels")
    good = ((F.col("quality") == 1) & (F.col("toxic") == 0)).cast("int").alias("good")
    outcomes = pages.join(labels, F.col("page_id") == F.col("doc_id")).select(url_reputation.host_of(F.col("url")).alias("host"), good)
    judged = url_reputation.judge_urls(pages.select("page_id", "url"), outcomes, URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    back = warc.round_trip(pages, segment_bytes=SEGMENT_BYTES)
    return in_few(back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"), pages.count(), file_rows=WARC_ROWS)


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(table(spark, sf_dir, "documents"), tokenizer_path(), digests=True)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    model = toxicity.train(docs, labels.where(~toxicity.held_out()))
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", toxicity.held_out().alias("held_out"), "score", (F.col("score") >= toxicity.PREDICT).cast("int").alias("predicted"), "n_hits")


def op8_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = quality.quality_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return report.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op10_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_file.round_trip(table(spark, sf_dir, "documents"), tokenizer_path())


QUERIES = {f.__name__: f for f in (op1_simhash, op2_secrets, op3_shards, op4_urls, op5_warc, op6_bpe, op7_toxicity, op8_decontam, op9_quality, op10_tokens)}
