"""One query per training-data operator, with production parameters over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemoor.llm import quality, toxicity
from lakemoor.llm.ann import nearest
from lakemoor.llm.bpe import bpe_encode
from lakemoor.llm.chat import format_chats
from lakemoor.llm.exact_dedup import exact_dedup
from lakemoor.llm.html_extract import extract_text
from lakemoor.llm.licenses import scan_licenses
from lakemoor.llm.near_dedup import near_dedup
from lakemoor.llm.packing import pack
from lakemoor.llm.shared import table


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


OP1_SQL = r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents),
g AS (SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, sha256(d.t) AS text_sha256
FROM d JOIN g USING (t)
"""


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents")).drop("detections")


def op4_hash_prefix_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"))


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", toxicity.held_out("doc_id").alias("held_out"), "score", "predicted")


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages"))


def op9_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = bpe_encode(table(spark, sf_dir, "documents"), decode=True)
    return tokens.select(
        "doc_id",
        F.expr("cast(octet_length(ids) div 4 as bigint)").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_chats(table(spark, sf_dir, "conversations"))


QUERIES = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_packing": op2_packing,
    "op3_license_scan": op3_license_scan,
    "op4_hash_prefix_forest": op4_hash_prefix_forest,
    "op5_near_dedup": op5_near_dedup,
    "op6_toxicity": op6_toxicity,
    "op7_quality": op7_quality,
    "op8_html_text": op8_html_text,
    "op9_bpe_round_trip": op9_bpe_round_trip,
    "op10_chat_format": op10_chat_format,
}
ORACLES = {"op1_exact_dedup": OP1_SQL}
