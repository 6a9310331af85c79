"""One ``opN_<name>`` query per operator, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from kerbside.llm import (bpe, decontaminate, language_id, mixing, periodic_runs, quality_rules,
                          resampling, secret_scan, sharding, simhash, token_counts, url_filter, warc)
from kerbside.llm.common import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@register("op1_bpe_codec")
def op1_bpe_codec(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    return bpe.digests(bpe.encode_decode(docs, tokenizer_path()))


@register("op3_simhash_near_duplicates")
def op3_simhash_near_duplicates(spark, sf_dir):
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"), shingle_words=3, max_distance=2)


@register("op5_quality_rules")
def op5_quality_rules(spark, sf_dir):
    return quality_rules.judge_documents(read_table(spark, sf_dir, "documents"))


@register("op2_url_filter")
def op2_url_filter(spark, sf_dir):
    return url_filter.judge_urls(read_table(spark, sf_dir, "pages"))


@register("op6_hilbert_shards")
def op6_hilbert_shards(spark, sf_dir):
    return sharding.assign(read_table(spark, sf_dir, "documents"), shards=40)


@register("op9_warc_round_trip")
def op9_warc_round_trip(spark, sf_dir):
    return warc.archive_round_trip(read_table(spark, sf_dir, "pages"))


@register("op10_secret_scan")
def op10_secret_scan(spark, sf_dir):
    return secret_scan.scan(read_table(spark, sf_dir, "documents"))


@register("op4_decontaminate")
def op4_decontaminate(spark, sf_dir):
    return decontaminate.contaminated_pairs(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"),
                                            short_items=True)


@register("op7_token_counts")
def op7_token_counts(spark, sf_dir):
    pieces = token_counts.zipf_pieces(tokenizer_path("piece_bpe_32k.model"))
    return token_counts.count_tokens(read_table(spark, sf_dir, "documents"), pieces)


@register("op8_language_id")
def op8_language_id(spark, sf_dir):
    return language_id.identify(read_table(spark, sf_dir, "documents"))


@register("op13_source_mix")
def op13_source_mix(spark, sf_dir):
    return mixing.copies(read_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@register("op11_importance_resampling")
def op11_importance_resampling(spark, sf_dir):
    return resampling.resample(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")).select(
        "doc_id", "n_features", "weight", "score", "rank")


@register("op12_periodic_runs")
def op12_periodic_runs(spark, sf_dir):
    docs = periodic_runs.with_planted_runs(read_table(spark, sf_dir, "documents"))
    return periodic_runs.digests(periodic_runs.find_runs(docs))
