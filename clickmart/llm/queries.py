"""Registered queries of the thirteen operators, with production parameters, over whole tables."""

from __future__ import annotations

import functools
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickmart.llm import (co_training, decontaminate, language, line_quality, packing, phrase_dedup, prefix_trie, sharding, simhash,
                           spelling, token_count, url_filter, vector_dedup)
from clickmart.llm._store import ship_package

#: Names of domains that advertise in their name.
SPAM_LABELS = ("adult-x", "ads-track", "casino-win", "cheap-pills", "free-bets", "spam-farm")
#: A page is a keyword list if it has at least this many ``|`` for 100 characters.
KEYWORD_BARS = 1


def _table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def op1_sampled_splitters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(_table(spark, sf_dir, "documents", "doc_id", "text")).drop("text")


def op2_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = line_quality.judge_lines(_table(spark, sf_dir, "documents", "doc_id", "text", "source"))
    return judged.select("doc_id", *line_quality.STATS, "base_failed", "kept", "n_removed_words")


def op3_phrase_automata(spark: SparkSession, sf_dir: str) -> DataFrame:
    stripped = phrase_dedup.remove_repeats(_table(spark, sf_dir, "documents", "doc_id", "text"))
    return stripped.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def op4_pre_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.count_tokens(_table(spark, sf_dir, "documents", "doc_id", "text"), public_tokenizers.path("piece_bpe_32k.model"))


def op5_hierarchical_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = language.identify(_table(spark, sf_dir, "documents", "doc_id", "text", "lang"))
    return found.select("doc_id", "held_out", "lang_pred", "score")


def op6_simhash_gray_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents", "doc_id", "text"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op7_shortest_pack_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents", "doc_id", "text"), public_tokenizers.path("byte_bpe_50k.json"))


def op8_suffix_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(_table(spark, sf_dir, "documents", "doc_id", "text"),
                                        _table(spark, sf_dir, "benchmark", "item_id", "text"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def block_list(pages: DataFrame) -> DataFrame:
    """The list of op9, from all ``pages`` (url, html): their domains whose first label is a spam label,
    and the urls (host + path) of pages that are keyword lists.  Null html is none."""
    host, path = url_filter.host_and_path(F.col("__url"))
    parts = pages.select(F.col("url").alias("__url"), "html").select("html", host.alias("host"), path.alias("path"))
    domains = parts.select("host").distinct().select(F.explode(url_filter.domains_of(F.col("host"))).alias("domain"))
    bars = F.length("html") - F.length(F.replace("html", F.lit("|")))
    urls = parts.where((F.col("host") != "") & (F.col("path") != "") & (100 * bars >= KEYWORD_BARS * F.length("html")) & (bars > 0))
    return domains.where(F.substring_index("domain", ".", 1).isin(*SPAM_LABELS)).unionByName(
        urls.select(F.concat("host", "path").alias("domain"))).distinct()


def op9_bloom_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(_table(spark, sf_dir, "pages", "page_id", "url"),
                            block_list(_table(spark, sf_dir, "pages", "url", "html"))).drop("url")


def op10_co_training(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text", "source", "lang", "n_chars")
    labels = _table(spark, sf_dir, "labels", "doc_id", "quality", "toxic")
    return co_training.score(docs, co_training.fit(docs, labels)).select("doc_id", *co_training.OUT)


def op11_lattice_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dedup.near_vectors(_table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.conversation_trie(_table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))


def op13_bit_sliced_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(_table(spark, sf_dir, "documents", "doc_id", "text"))


def _shipped(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @functools.wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return query(spark, sf_dir)
    return run


QUERIES = {f.__name__: _shipped(f) for f in (
    op1_sampled_splitters, op2_line_frequency, op3_phrase_automata, op4_pre_token_counts, op5_hierarchical_language,
    op6_simhash_gray_index, op7_shortest_pack_first, op8_suffix_arrays, op9_bloom_cascade, op10_co_training,
    op11_lattice_hashing, op12_prefix_trie, op13_bit_sliced_spelling)}
