"""One query per operator, over its whole table and with production parameters."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from maskloom.llm import byte_bpe, decontam, flat_graph, lm_score, orc_tokens, piece_counts, prefix_trie, quality, secret_ledger, simhash, toxicity, url_filter, whitening
from maskloom.llm.tables import table
from maskloom.session import scratch_dir

#: Where the public vocabularies lie on every machine.
TOKENIZERS = os.environ.get("TOKENIZER_DIR", "/opt/tokenizers")

#: The rules of the URL contract.
URL_RULES = ("block net/", "allow example.net/en/", "block example.com/de/", "allow org/fr/")


def op1_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    pages, rules = table(spark, folder, "pages"), url_filter.rules_of(*URL_RULES)
    model = url_filter.fit_table(url_filter.label_by_rules(pages, rules, limit=20_000))
    return url_filter.judge(pages, rules, model)


def op2_orc_token_ids(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_dir(spark, "token-ids")
    orc_tokens.write_ids(table(spark, folder, "documents"), path, f"{TOKENIZERS}/word_bpe_49k.json")
    return orc_tokens.with_crc32(orc_tokens.read_ids(spark, path)).select("doc_id", "start", "n_tokens", "ids_crc32")


def op3_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return quality.score(docs, quality.fit_table(docs, table(spark, folder, "labels")))


def op4_cross_entropy_difference(spark: SparkSession, folder: str) -> DataFrame:
    """How much like conversation each document is: the target is all turns, the background all documents."""
    return lm_score.score(table(spark, folder, "documents"), table(spark, folder, "conversations"))


def op5_winnowing_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontam.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark")).drop("items", "key")


def op6_viterbi_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return piece_counts.count_pieces(table(spark, folder, "documents"), f"{TOKENIZERS}/piece_bpe_32k.model")


def op7_secret_ledger(spark: SparkSession, folder: str) -> DataFrame:
    return secret_ledger.report(secret_ledger.scan(spark, table(spark, folder, "documents"), scratch_dir(spark, "ledger")))


def op8_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    ranks = f"{TOKENIZERS}/byte_bpe_multi_50k.tiktoken"
    both = byte_bpe.encode(table(spark, folder, "documents"), ranks, decoded="decoded")
    return both.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), byte_bpe.ids_digest(F.col("ids")).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op9_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


def op10_flat_graph_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return flat_graph.near_duplicates(table(spark, folder, "embeddings"))


def op11_conversation_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.conversation_trie(table(spark, folder, "conversations")).drop("node")


def op12_embedding_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.by_component(table(spark, folder, "embeddings"))


def op13_toxicity_grammar(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return toxicity.score(docs, toxicity.fit_table(docs, table(spark, folder, "labels")))


QUERIES = {
    f.__name__: f
    for f in (
        op1_url_filter,
        op2_orc_token_ids,
        op3_quality_classifier,
        op4_cross_entropy_difference,
        op5_winnowing_decontamination,
        op6_viterbi_token_counts,
        op7_secret_ledger,
        op8_byte_bpe,
        op9_simhash_near_dedup,
        op10_flat_graph_near_dedup,
        op11_conversation_trie,
        op12_embedding_whitening,
        op13_toxicity_grammar,
    )
}
ORACLES: dict[str, str] = {"op5_winnowing_decontamination": decontam.ORACLE, "op11_conversation_trie": prefix_trie.ORACLE}
