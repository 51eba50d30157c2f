"""The corpus operators over their whole tables, and the SQL for those that have one."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenureframe.llm.common import read_table
from tenureframe.llm.conversations import damaged, repair_conversations, turn_digests
from tenureframe.llm.divergence import source_divergence
from tenureframe.llm.exact_dedup import exact_groups
from tenureframe.llm.language import held_out, learn_profiles, predict_language
from tenureframe.llm.oracle import CONVERSATIONS_SQL, DIVERGENCE_SQL
from tenureframe.llm.packing import packed_pieces
from tenureframe.llm.pieces import piece_digests
from tenureframe.llm.private_data import scan_private
from tenureframe.llm.repeats import remove_repeats
from tenureframe.llm.secrets import scan_secrets
from tenureframe.llm.sharding import shard_documents
from tenureframe.llm.simhash import near_components
from tenureframe.llm.url_filter import RULES, judge_urls, rules_table
from tenureframe.llm.winnowing import compare_with_next

Query = Callable[[SparkSession, str], DataFrame]

# Places of the public vocabularies; parameters of the operators.
BYTE_VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packed_pieces(_documents(spark, sf_dir), BYTE_VOCABULARY)
    return pieces.select(
        F.col("id").alias("doc_id"),
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )


def op2_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_with_next(_documents(spark, sf_dir)).withColumnRenamed("id", "doc_id")


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    digests = piece_digests(_documents(spark, sf_dir), PIECE_MODEL)
    return digests.withColumnRenamed("id", "doc_id")


def op4_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(_documents(spark, sf_dir)).withColumnRenamed("id", "doc_id")


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(read_table(spark, sf_dir, "pages"), rules_table(spark, RULES))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(_documents(spark, sf_dir)).withColumnRenamed("id", "doc_id")


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_components(_documents(spark, sf_dir))
    return found.select(
        F.col("id").alias("doc_id"),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        "component_id",
    )


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(_documents(spark, sf_dir))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select("doc_id", "text", "lang")
    profiles = learn_profiles(docs.filter(~held_out()))
    rows = docs.select("doc_id", "text", held_out().alias("held_out"))
    found = predict_language(rows, profiles)
    return found.select("doc_id", "held_out", "lang_pred", "score")


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shard_documents(_documents(spark, sf_dir))
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "tokens",
    )


def op11_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = damaged(read_table(spark, sf_dir, "conversations"))
    repairs, turns = repair_conversations(rows, copies=F.col("copies"))
    digests = turn_digests(turns).withColumnRenamed("conv", "digested")
    nothing = F.sha2(F.lit(""), 256)
    return repairs.join(digests, F.col("conv").eqNullSafe(F.col("digested")), "left").select(
        F.col("conv").alias("conv_id"),
        *("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"),
        F.coalesce("repaired_sha256", nothing).alias("repaired_sha256"),
    )


def op12_private_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_private(_documents(spark, sf_dir)).withColumnRenamed("id", "doc_id")


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(_documents(spark, sf_dir))


LLM_QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        op1_packing,
        op2_winnowing,
        op3_sentencepiece,
        op4_repeats,
        op5_url_filter,
        op6_secret_scan,
        op7_simhash,
        op8_exact_dedup,
        op9_language,
        op10_sharding,
        op11_conversations,
        op12_private_data,
        op13_source_divergence,
    )
}

LLM_ORACLE: dict[str, str] = {
    "op5_url_filter": """
        WITH rules(h, p, v) AS (
            VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'),
                   ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'),
                   ('com', '/de/', 'block')
        ),
        rest AS (
            SELECT page_id,
                   CASE WHEN position('://' IN url) > 0
                        THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest
            FROM pages
        ),
        hosts AS (
            SELECT page_id, coalesce(rest, '') AS rest,
                   regexp_extract(coalesce(rest, ''), '^[^/?#]*') AS h0
            FROM rest
        ),
        parsed AS (
            SELECT page_id,
                   translate(h0, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   regexp_extract(substr(rest, length(h0) + 1), '^[^?#]*') AS path
            FROM hosts
        )
        SELECT page_id, host, path,
               (SELECT arg_max(h || p, length(h || p)) FROM rules
                WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)) AS rule,
               coalesce((SELECT arg_max(v, length(h || p)) FROM rules
                WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)),
                'allow') AS verdict
        FROM parsed
    """,
    "op8_exact_dedup": """
        WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
        g AS (SELECT text, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept,
               sha256(text) AS text_sha256
        FROM d JOIN g USING (text)
    """,
    "op11_conversations": CONVERSATIONS_SQL,
    "op13_source_divergence": DIVERGENCE_SQL,
}
