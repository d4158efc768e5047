"""The operators applied to the given tables, with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from tillwork.llm import oracles
from tillwork.llm import language_id as lid
from tillwork.llm.bit_codes import nearest
from tillwork.llm.lexical_search import ranked_search
from tillwork.llm.license_scan import TEMPLATES, scan_licenses
from tillwork.llm.mixing import mix
from tillwork.llm.ngram_join import near_duplicates
from tillwork.llm.packing import pack_documents
from tillwork.llm.prefix_trie import build_trie, members_digest, ordered_turns, share_openings
from tillwork.llm.shared import shared_folder
from tillwork.llm.sharding import hilbert_shards
from tillwork.llm.simhash import near_fingerprints
from tillwork.llm.token_codec import read_tokens, write_tokens
from tillwork.llm.tokens import default_vocabulary
from tillwork.llm.url_filter import judge_urls
from tillwork.llm.voronoi import top_products
from tillwork.session import tuned

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def query(fn: Callable[[SparkSession, str], DataFrame]):
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return fn(tuned(spark), folder)

    QUERIES[fn.__name__] = run
    return fn


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op1_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return scan_licenses(table(spark, folder, "documents")).drop("spans")


@query
def op2_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents"))


@query
def op3_bit_codes(spark: SparkSession, folder: str) -> DataFrame:
    return nearest(table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0)


@query
def op4_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return judge_urls(table(spark, folder, "pages"), URL_RULES)


@query
def op5_voronoi_top_products(spark: SparkSession, folder: str) -> DataFrame:
    return top_products(table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0)


@query
def op6_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mix(table(spark, folder, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query
def op7_pack(spark: SparkSession, folder: str) -> DataFrame:
    return pack_documents(table(spark, folder, "documents"), default_vocabulary())


@query
def op8_hilbert_shards(spark: SparkSession, folder: str) -> DataFrame:
    placed = hilbert_shards(table(spark, folder, "documents"), 8)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@query
def op9_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    found = lid.identify(docs, lid.learn(docs))
    return found.select("doc_id", lid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@query
def op10_token_codec(spark: SparkSession, folder: str) -> DataFrame:
    files = shared_folder(spark, "tokens")
    write_tokens(table(spark, folder, "documents"), files, default_vocabulary())
    return read_tokens(spark, files, with_ids=False)


@query
def op11_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    trie = build_trie(*share_openings(ordered_turns(table(spark, folder, "conversations"))))
    none = F.sha2(F.lit(""), 256)
    return trie.nodes.join(members_digest(trie.ends), ["node1", "node2"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
        F.col("saved_bytes").alias("saved_tokens"), F.coalesce("ends_sha256", none).alias("ends_sha256"),
    )


@query
def op12_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return near_fingerprints(table(spark, folder, "documents"))


@query
def op13_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    return ranked_search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query
def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    return corpus_pipeline.run(spark, folder)


ORACLES["op1_license_scan"] = oracles.license_scan(TEMPLATES)
ORACLES["op2_ngram_join"] = oracles.NGRAM_JOIN
ORACLES["op4_url_filter"] = oracles.url_filter(URL_RULES)
ORACLES["op5_voronoi_top_products"] = oracles.TOP_PRODUCTS
ORACLES["op6_mix"] = oracles.MIX
ORACLES["op11_prefix_trie"] = oracles.PREFIX_TRIE
ORACLES["op13_lexical_search"] = oracles.LEXICAL_SEARCH
