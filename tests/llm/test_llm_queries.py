"""Registered corpus queries against their SQL, and the pipeline against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
import corpus_pipeline
from tenureframe.llm import secrets
from tenureframe.llm.queries import LLM_ORACLE, LLM_QUERIES
from tests.llm.test_llm_operators import brute_components, brute_fingerprint, expected_ids
from tests.oracle_compare import duck, spark_rows, sql_rows

SF_DIR = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(LLM_ORACLE))
def test_query_matches_sql(spark, name):
    columns, rows = spark_rows(LLM_QUERIES[name](spark, SF_DIR))
    expected_columns, expected = sql_rows(duck(SF_DIR), LLM_ORACLE[name])
    assert columns == expected_columns and rows and rows == expected


def test_all_operators_and_the_pipeline_are_registered():
    names = entry_points.queries()
    numbers = sorted(int(n[2:].split("_")[0]) for n in names if n[:2] == "op" and n[2].isdigit())
    assert numbers == list(range(1, 14)) and "pipeline" in names
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language_id", "exact_dedup", "near_dedup", "secret_scan", "packing",
    ]


def test_stages_by_brute_force(spark, small_dir):
    """Each stage on all that the one before kept."""
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    # Near copies of long texts: a word more at the end.
    copies = docs.filter("n_chars > 3000").withColumns(
        {
            "doc_id": F.col("doc_id") + 1_000_000,
            "text": F.concat("text", F.lit(" more")),
            "n_chars": F.col("n_chars") + 5,
        }
    )
    docs = docs.unionByName(copies)
    given = {r["doc_id"]: r["text"] for r in docs.collect()}
    stages = dict(corpus_pipeline.STAGES)

    kept = stages["language_id"](spark, docs, small_dir)
    assert kept.columns == docs.columns and kept.count() == len(given)
    kept = stages["exact_dedup"](spark, kept, small_dir)
    last = {text: doc_id for doc_id, text in sorted(given.items())}
    found = {r["doc_id"]: r["text"] for r in kept.collect()}
    assert kept.columns == docs.columns and found == {i: t for t, i in last.items()}

    kept = stages["near_dedup"](spark, kept, small_dir)
    ids = sorted(found)
    groups = brute_components(ids, [brute_fingerprint(found[i]) for i in ids])
    found = {r["doc_id"]: r["text"] for r in kept.collect()}
    assert kept.columns == docs.columns and sorted(found) == sorted(set(groups)) != ids

    kept = stages["secret_scan"](spark, kept, small_dir)
    clean = {i: secrets.redact(t, secrets.find_spans(t)[1]) for i, t in found.items()}
    found = {r["doc_id"]: (r["text"], r["n_chars"]) for r in kept.collect()}
    assert kept.columns == docs.columns and found == {i: (t, len(t)) for i, t in clean.items()}

    packed = sorted(stages["packing"](spark, kept, small_dir).collect(), key=lambda r: r["sequence_id"])
    order = list(dict.fromkeys(i for r in packed for i in r["doc_ids"]))
    assert sorted(order) == sorted(clean)
    ids = expected_ids([clean[i] for i in order])
    stream = [x for doc in ids for x in [*doc, 1]]
    assert np.frombuffer(b"".join(r["ids"] for r in packed), "<u4").tolist() == stream
    assert all(r["length"] == 2048 for r in packed[:-1])


def test_pipeline_runs_whole(spark, small_dir):
    result = corpus_pipeline.run(spark, small_dir)
    assert result.columns == ["sequence_id", "length", "ids", "doc_ids"] and result.count() > 10


def test_near_copies_with_equal_or_missing_ids(spark):
    """One row of each group stays, however the ids of its rows agree; no name can clash."""
    words = " ".join(f"w{i}" for i in range(400))
    rows = [
        (7, words, "a"), (7, words + " more", "b"), (7, words, "a"),
        (None, "other " + words[::-1], "c"), (None, words[::-1], "d"),
        (None, words, "e"), (9, words + " end", "f"), (8, "alone " * 9, "g"),
    ]
    names = "doc_id long, text string, source string, lang string, _id_key int, _text_key int, "
    names += "_kept_id int, row int, id int, digest int, copy int"
    docs = spark.createDataFrame([(*r, "en", 1, 2, 3, 4, 5, 6, 7) for r in rows], names)
    kept = corpus_pipeline.near_dedup(spark, docs, "")
    assert kept.columns == docs.columns
    found = sorted(((r["doc_id"], r["source"]) for r in kept.collect()), key=str)
    assert len(found) == 3 and found[0][0] == 7 and found[1] == (8, "g") and found[2][0] is None
    assert found[2][1] in "cd" and {r["copy"] for r in kept.collect()} == {7}
    distinct = corpus_pipeline.exact_dedup(spark, docs, "")
    assert distinct.columns == docs.columns and distinct.count() == 6


def test_stages_on_odd_and_empty_tables(spark, odd, none):
    docs, empty = odd, none
    counts = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs, empty = stage(spark, docs, ""), stage(spark, empty, "")
        assert docs.columns == empty.columns == odd.columns
        counts.append(docs.count())
        assert empty.count() == 0
    # Null, empty and blank texts go, and one that is like no learned language; then the
    # copy of row 4, and row 3, which has the same text.
    assert counts == [6, 4, 4, 4]
    kept = corpus_pipeline.exact_dedup(spark, odd, "").collect()
    assert [r["doc_id"] for r in kept].count(4) == 1 and 3 not in [r["doc_id"] for r in kept]
    assert corpus_pipeline.packing(spark, docs, "").count() > 0
    assert corpus_pipeline.packing(spark, empty, "").count() == 0
    unlabelled = odd.withColumn("lang", F.lit(None).cast("string"))
    assert corpus_pipeline.language_id(spark, unlabelled, "").count() == 7
