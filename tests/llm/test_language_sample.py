"""The rows that languages are learned from."""

import pytest
from pyspark.sql import functions as F

from tenureframe.llm import language


@pytest.mark.parametrize("sample_docs", [1, 7, 1000, 100_000])
def test_last_places_by_sorting(spark, sample_docs):
    # One label holds most rows; one has few; places come twice.
    label = F.when(F.col("id") % 10 < 8, "hot").when(F.col("id") == 9, "one").otherwise("rest")
    rows = spark.range(20_000).select(label.alias("label"), F.xxhash64(F.col("id") % 15_000).alias("place"))
    rows = rows.repartition(7)
    expected = {}
    for row in sorted(rows.collect(), key=lambda r: r["place"]):
        expected.setdefault(row["label"], []).append(row["place"])
    assert language.last_places(rows, sample_docs) == {
        name: places[:sample_docs][-1] for name, places in expected.items()
    }


def test_one_step_of_places(spark):
    """All rows in one step, as equal ids have it."""
    rows = spark.range(50).select(F.lit("a").alias("label"), (F.col("id") % 5).alias("place"))
    assert language.last_places(rows, 20) == {"a": 1}
    assert language.last_places(rows.limit(0), 20) == {}
