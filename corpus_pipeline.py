"""Corpus pipeline: quality, near-duplicates, benchmark passages, secrets, tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from maskloom.llm import byte_bpe, decontam, quality, secret_ledger, simhash
from maskloom.llm.queries import TOKENIZERS
from maskloom.llm.tables import fresh_name, stored, table
from maskloom.session import scratch_dir


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality.keep_good(docs, quality.fit_table(docs, table(spark, sf_dir, "labels")))


def different(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest id."""
    return simhash.keep_one(docs)


def unseen(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no benchmark passage contaminates."""
    return decontam.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def harmless(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, its secrets replaced by a mark; ``n_chars`` follows the text."""
    clean = secret_ledger.redact(spark, docs, scratch_dir(spark, "ledger"))
    if "n_chars" not in docs.columns:
        return clean
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its token ids; ``round_trip`` says that they decode to the text."""
    ranks = f"{TOKENIZERS}/byte_bpe_multi_50k.tiktoken"
    rest = [c for c in docs.columns if c != "doc_id"]
    ids, decoded = fresh_name(docs, "ids"), fresh_name(docs, "decoded")
    both = byte_bpe.encode(docs, ranks, out=ids, keep=rest, decoded=decoded, cache_bytes=60_000_000)
    same = F.col(decoded) == F.coalesce("text", F.lit("")).cast("binary")
    n_tokens = F.size(ids).cast("bigint").alias(fresh_name(docs, "n_tokens"))
    return both.select("doc_id", *rest, ids, n_tokens, same.alias(fresh_name(docs, "round_trip")))


STAGES = [
    ("quality classifier", good),
    ("SimHash near-dedup", different),
    ("benchmark decontamination", unseen),
    ("secret scans", harmless),
    ("byte-level BPE", tokens),
]
#: SQL expresses neither the classifier nor the fingerprints; the tests compare with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written and read back before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
