"""Language identification by rank-order profiles.

A profile is the list of the most frequent letter n-grams, most frequent first. N-grams
are taken over a word and the gaps on its sides; one that begins with a gap is counted
with the shorter one behind the gap.
Each language's profile is learned from a bounded number of labelled documents
(``sample_docs`` per language, those with the lowest hashes of their ids, whole texts). A document
gets the language whose profile has the smallest out-of-place distance to its own:
the sum over its n-grams of how far their ranks differ, and of ``profile_size``
for each n-gram that the language's profile lacks. The score is one minus the
distance over the largest possible one.

Profiles go to the tasks: ``profile_size`` n-grams for each learned language.

Defined results: a NULL text or one without letters is ``und`` with score 0, and so
is every text when nothing could be learned; rows without a label or an id are not
learned from; equal distances go to the language first in order; repeated rows are
predicted each; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from tenureframe.llm.common import per_batch

UNDETERMINED = "und"
LONGEST = 3
PROFILE_SIZE = 400
SAMPLE_DOCS = 1000
# The highest bits of a row's place by which rows are counted before any are ranked.
PLACE_BITS = 16
# Letters travel as numbers of so many bits, three to an n-gram.
BITS = 21


@lru_cache(1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def grams_of(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of the words of a text, with their counts; words are padded by 0."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    letter = _letters()[codes]
    # One gap between words, and one at either end.
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    kept = np.where(letter, codes, 0)[keep].astype(np.uint64)
    line = np.concatenate(([0], kept, [0])).astype(np.uint64)
    one, two, three = line, line[:-1], line[:-2]
    pairs = (two << np.uint64(BITS)) | line[1:]
    triples = (three << np.uint64(2 * BITS)) | (line[1:-1] << np.uint64(BITS)) | line[2:]
    return np.unique(
        np.concatenate(
            (
                one[one > 0],
                pairs[(two > 0) | (line[1:] > 0)],
                triples[line[1:-1] > 0],
            )
        ),
        return_counts=True,
    )


def top_grams(grams: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """The most frequent n-grams, most frequent first, equals by value."""
    if len(grams) > size:
        enough = counts >= np.partition(counts, -size)[-size]
        grams, counts = grams[enough], counts[enough]
    return grams[np.lexsort((grams, -counts))][:size]


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that are not learned from: a remainder of the id's checksum."""
    remainder = F.crc32(F.col(id_col).cast("string").cast("binary")) % 4
    return F.coalesce(remainder == 2, F.lit(False))


def last_places(labelled: DataFrame, sample_docs: int) -> dict[str, int]:
    """The place of each label's last row among its ``sample_docs`` lowest ones.

    Rows are counted by label and the highest bits of their places first. Only those
    of the one step in which the last row lies are ranked, so a label with very many
    rows sends counts, and a 65,536th part of its rows.
    """
    step = F.shiftright("place", 64 - PLACE_BITS)
    upto = Window.partitionBy("label").orderBy("step")
    steps = (
        labelled.groupBy("label", step.alias("step"))
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("before", F.sum("n").over(upto) - F.col("n"))
        .filter(F.col("before") < sample_docs)
        .groupBy("label")
        .agg(F.max(F.struct("step", "before")).alias("last"))
        .select("label", "last.step", "last.before")
        .collect()
    )
    if not steps:
        return {}

    def given(name: str) -> Column:
        pairs = [F.lit(x) for row in steps for x in (row["label"], row[name])]
        return F.create_map(*pairs)[F.col("label")]

    order = Window.partitionBy("label").orderBy("place")
    found = (
        labelled.filter(step == given("step"))
        .select("label", "place", F.row_number().over(order).alias("nth"))
        .filter(F.col("nth") <= sample_docs)
        .filter(F.col("nth") <= sample_docs - given("before"))
        .groupBy("label")
        .agg(F.max("place").alias("last"))
        .collect()
    )
    return {row["label"]: row["last"] for row in found}


def learn_profiles(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "lang",
    sample_docs: int = SAMPLE_DOCS,
    profile_size: int = PROFILE_SIZE,
) -> dict[str, np.ndarray]:
    """Each language's n-grams, most frequent first."""
    labelled = docs.select(
        F.xxhash64(id_col).alias("place"),
        F.col(text_col).cast("string").alias("text"),
        F.col(label_col).cast("string").alias("label"),
    ).filter(F.col(id_col).isNotNull() & F.col("text").isNotNull() & F.col("label").isNotNull())
    # The last place taken, found without the texts; then texts are read where they are.
    places = last_places(labelled.select("label", "place"), sample_docs)
    if not places:
        return {}
    last = F.create_map(*[F.lit(x) for pair in places.items() for x in pair])
    sample = labelled.filter(F.col("place") <= last[F.col("label")]).select("label", "text")

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        labels, all_grams, all_counts = [], [], []
        columns = (batch.column(c).to_pylist() for c in ("label", "text"))
        for label, text in zip(*columns):
            grams, counts = grams_of(text)
            labels += [label] * len(grams)
            all_grams.append(grams.astype(np.int64))
            all_counts.append(counts)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(labels, pa.string()),
                pa.array(np.concatenate(all_grams)),
                pa.array(np.concatenate(all_counts)),
            ],
            ["label", "gram", "n"],
        )

    ranked = Window.partitionBy("label").orderBy(F.desc("n"), "gram")
    rows = (
        sample.mapInArrow(per_batch(count), "label string, gram long, n long")
        .groupBy("label", "gram")
        .agg(F.sum("n").alias("n"))
        .withColumn("rank", F.row_number().over(ranked))
        .filter(F.col("rank") <= profile_size)
        .orderBy("label", "rank")
        .collect()
    )
    profiles: dict[str, list[int]] = {}
    for row in rows:
        profiles.setdefault(row["label"], []).append(row["gram"])
    return {label: np.array(grams, np.int64) for label, grams in profiles.items()}


class OutOfPlace:
    """Distances of a document's profile to every language's."""

    def __init__(self, profiles: dict[str, np.ndarray], profile_size: int):
        self.labels = sorted(profiles)
        self.size = profile_size
        self.grams = np.unique(np.concatenate([profiles[x] for x in self.labels]))
        self.ranks = np.full((len(self.grams) + 1, len(self.labels)), -1, np.int64)
        for column, label in enumerate(self.labels):
            at = np.searchsorted(self.grams, profiles[label])
            self.ranks[at, column] = np.arange(len(at))

    def predict(self, text: str | None) -> tuple[str, float]:
        grams, counts = grams_of(text or "")
        own = top_grams(grams.astype(np.int64), counts, self.size)
        if not len(own):
            return UNDETERMINED, 0.0
        at = np.searchsorted(self.grams, own)
        found = at < len(self.grams)
        found[found] = self.grams[at[found]] == own[found]
        ranks = self.ranks[np.where(found, at, len(self.grams))]
        apart = np.abs(ranks - np.arange(len(own))[:, None])
        distance = np.where(ranks < 0, self.size, apart).sum(axis=0)
        best = int(np.argmin(distance))
        return self.labels[best], 1.0 - float(distance[best]) / (len(own) * self.size)


def predict_language(
    docs: DataFrame,
    profiles: dict[str, np.ndarray],
    text_col: str = "text",
    profile_size: int = PROFILE_SIZE,
) -> DataFrame:
    """The rows with ``lang_pred`` and ``score``, which replace columns of those names.

    Only the text decides.
    """
    judge = OutOfPlace(profiles, profile_size) if profiles else None
    docs = docs.drop("lang_pred", "score")
    found = [StructField("lang_pred", StringType()), StructField("score", DoubleType())]
    schema = StructType([*docs.schema.fields, *found])

    def convert(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column(text_col).to_pylist()
        found = [judge.predict(t) if judge else (UNDETERMINED, 0.0) for t in texts]
        labels, scores = zip(*found)
        return pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(labels, pa.string()), pa.array(scores, pa.float64())],
            [*batch.schema.names, "lang_pred", "score"],
        )

    return docs.mapInArrow(per_batch(convert), schema)
