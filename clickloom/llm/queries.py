"""One query per operator, over its whole table, with production parameters."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_folder
from . import (
    html, langid, neardup, negatives, packing, pieces, prefixtrie, private, quality, shards, suffixes, topk, warc,
)
from .text import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


@query
def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.rate(docs, keep_text=False).select("doc_id", *quality.COUNTS, "base_failed", "kept", "limit_level")


@query
def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shards.place(table(spark, sf_dir, "documents"), shards.lookup_table(spark), "doc_id")
    path = f"{shared_folder(spark)}/clickloom/shards-{uuid.uuid4().hex}"
    shards.write_shards(placed, path)
    return shards.read_shards(spark, path, placed.schema).select("doc_id", "slot", "shard")


@query
def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return html.extract(pages).select("page_id", "url", "text", "n_chars")


@query
def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_folder(spark)}/clickloom/warc-{uuid.uuid4().hex}"
    warc.write_archive(table(spark, sf_dir, "pages"), path)
    read = warc.read_archive(spark, path)
    whole = F.col("record_type") == "response"
    return read.select(
        "page_id",
        F.when(whole, F.octet_length("payload").cast("long")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(whole, F.sha2("payload", 256)).otherwise(F.col("payload_digest")).alias("payload_digest"),
        "record_type", "refers_to")


@query
def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), keep_ids=False)


@query
def op6_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return topk.search(vectors, F.col("vec_id") % 50 == 0)


@query
def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.connect(table(spark, sf_dir, "documents"), words=3, percent=85)


@query
def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffixes.cut_repeats(docs).select(
        F.col("_0").alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256")


@query
def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return private.find(docs, keep_text=False).drop("found")


@query
def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pieces.measure(docs).select("doc_id", "n_pieces", "ids_sha256", "round_trip")


@query
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(vectors, F.col("vec_id") % 100 == 0, label)


@query
def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = langid.is_held_out(F.col("doc_id"))
    model = langid.fit(docs.where(~held_out))
    told = langid.identify(docs.select("doc_id", held_out.alias("held_out"), "text"), model)
    return told.select("doc_id", "held_out", "lang_pred", "score", F.col("lang").isNull().alias("rejected"))


@query
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixtrie.build(table(spark, sf_dir, "conversations"))
