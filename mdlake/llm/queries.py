"""The queries of this subpackage and the SQL that they are held against, by name."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mdlake.llm import bpe, chat, decontam, langid, license_scan, line_dedup, negatives, quality, repair, toxicity, warc
from mdlake.llm.common import park, shared_dir, table
from mdlake.llm.exact_dedup import exact_dedup
from mdlake.llm.simhash import near_groups

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return register


@query(
    "op3_exact_dedup",
    r"""
    WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n_chars, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents),
    k AS (SELECT *, first_value(doc_id) OVER (PARTITION BY norm ORDER BY n_chars DESC, doc_id) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size FROM d)
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256, n_chars FROM k
    """,
)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


@query("op8_simhash_near_dedup")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(table(spark, sf_dir, "documents"))


@query("op4_byte_bpe")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    coded = bpe.encode(table(spark, sf_dir, "documents"), path, pattern, bytes_col="decoded", keep=["doc_id"])
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query("op5_language_id")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    profiles = langid.learn_profiles(docs.filter(~langid.held_out()))
    rows = docs.select("doc_id", "text", langid.held_out().alias("held_out"))
    return langid.identify(rows, profiles).select("doc_id", "held_out", "lang_pred", "score")


@query("op9_benchmark_decontamination")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query(
    "op7_warc",
    r"""
    WITH p AS (SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS h FROM pages),
    g AS (SELECT *, max(page_id) OVER (PARTITION BY payload) AS response FROM p)
    SELECT page_id, octet_length(encode(payload)) AS payload_bytes,
           array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(h, 1 + 5 * (i // 4)::INT, 5))::INT >> (5 * (3 - i % 4))::INT) & 31), 1) FOR i IN range(32)], '') AS payload_digest,
           CASE WHEN page_id = response THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN page_id <> response THEN response END AS refers_to
    FROM g
    """,
)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    manifest = park(warc.write_archives(table(spark, sf_dir, "pages"), folder), "manifest")
    return warc.read_archives(manifest).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op10_license_scan", license_scan.oracle_sql())
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scan(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.array_join("licenses", ",").alias("licenses"), F.array_join("sentence_ids", ",").alias("sentence_ids"))


@query("op1_line_dedup", line_dedup.ORACLE_SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return docs.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("text_sha256"))


@query("op2_quality_classifier")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    trusted = table(spark, sf_dir, "labels").filter("quality = 1 AND toxic = 0").select("doc_id")
    return quality.classify(table(spark, sf_dir, "documents"), trusted, sharded_order=quality.SHARDED_ORDER)


@query("op6_chat_formatting")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.conversations(table(spark, sf_dir, "conversations"))


@query("op13_conversation_repair", repair.ORACLE_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    return repair.with_all(repair.report(repair.damaged(turns)), "conv_id", turns)


@query("op12_hard_negatives", negatives.ORACLE_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(negatives.usable(table(spark, sf_dir, "embeddings"), label), F.col("vec_id") % 100 == 0)


@query("op11_toxicity")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select("doc_id", "held_out", "score", "predicted", F.size("spans").cast("long").alias("n_spans"))
