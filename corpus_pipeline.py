"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame. ``run`` writes every
stage's result to the shared folder and hands what it reads back to the next one, so
a lost executor never costs more than one stage. All stages but the last return the
columns of ``documents``, and any further ones, whatever their names.

A row is known by its id and the digest of its text. Rows that share both are repeats of
one another: the dedup stages keep one of them, the least by source and language. A NULL
id is smaller than any other; NULL ids are an id like others, so rows that share an id, or
have none, are told apart by their texts. An empty table passes every stage as an empty
table; texts are read whole, however long.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tenureframe.llm.common import prepare_workers, read_table, staged, text_or_empty
from tenureframe.llm.exact_dedup import NO_ID, exact_groups
from tenureframe.llm.language import UNDETERMINED, held_out, learn_profiles, predict_language
from tenureframe.llm.packing import packed_sequences
from tenureframe.llm.queries import BYTE_VOCABULARY
from tenureframe.llm.secrets import redact_documents
from tenureframe.llm.simhash import MAX_BITS, SHINGLE_WORDS, near_components

# Units a packing task remembers: workers also hold what earlier stages left.
REMEMBER = 200_000

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

# Below this score a text is like none of the learned languages.
LEAST_SCORE = 0.15


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or like no learned language, go.

    A missing label is filled in by the prediction. Where no row has a label, nothing
    can be learned, and only texts without letters go.
    """
    prepare_workers(spark)
    profiles = learn_profiles(docs.filter(~held_out()))
    if not profiles:
        return docs.filter(F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    inner = docs.withColumnsRenamed({"lang_pred": "_lang_pred", "score": "_score"})
    found = predict_language(inner, profiles)
    kept = found.filter((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= LEAST_SCORE))
    labelled = kept.withColumn("lang", F.coalesce("lang", "lang_pred")).drop("lang_pred", "score")
    return labelled.withColumnsRenamed({"_lang_pred": "lang_pred", "_score": "score"})


def _one_each(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """One row of ``docs`` for each (``id``, ``digest``) of ``kept``.

    Rows travel as one value, so that no name among theirs can clash. Join and window
    share their keys: the texts are shuffled once.
    """
    keys = ["id", "digest"]
    rows = docs.select(
        F.struct("*").alias("row"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"),
        F.unhex(F.sha2(text_or_empty("text"), 256)).alias("digest"),
    )
    copy = F.row_number().over(Window.partitionBy(*keys).orderBy("row.source", "row.lang"))
    return (
        rows.join(kept, keys, "left_semi").withColumn("copy", copy).filter("copy = 1").select("row.*")
    )


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest id stays. NULL and empty texts are equal;
    a text that no other row has stays, whatever its id."""
    prepare_workers(spark)
    kept = exact_groups(docs).filter("kept")
    id_key = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id")
    return _one_each(docs, kept.select(id_key, F.unhex("text_sha256").alias("digest")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies, one document stays: the one with the smallest id, of
    equal ids the one with the smallest digest; one without an id only if all are.

    Documents whose SimHash fingerprints of three-word runs differ in at most three bits
    are linked, and groups are what links connect. NULL, empty and blank texts have
    fingerprint zero and are one group.
    """
    prepare_workers(spark)
    found = near_components(docs, words_per_shingle=SHINGLE_WORDS, max_bits=MAX_BITS)
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "digest")).alias("first")
    id_key = F.coalesce("first.id", F.lit(NO_ID)).alias("id")
    return _one_each(docs, found.groupBy("root").agg(first).select(id_key, "first.digest"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced in the texts; every document stays, with repeated rows, NULL
    ids and NULL, empty or blank texts as they are."""
    prepare_workers(spark)
    return redact_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of token ids with the ids of the documents in them, in order. A NULL or
    empty text is an end token alone; every row is packed, repeated ones and those without
    an id as well. The result has columns of its own."""
    prepare_workers(spark)
    return packed_sequences(docs, BYTE_VOCABULARY, remember=REMEMBER)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("secret_scan", secret_scan),
    ("packing", packing),
]

# Language profiles, fingerprints and vocabularies cannot be said in SQL; the tests
# hold the pipeline against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


PIPELINE_QUERIES = {"pipeline": run}
PIPELINE_ORACLE: dict[str, str] = {}
