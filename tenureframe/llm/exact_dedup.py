"""Exact dedup against a history held in minimal perfect hash tables.

History is reduced to its distinct text digests with their winner and size. The
digests are dealt into buckets; each bucket gets a minimal perfect hash function,
and the slot it assigns to a digest holds the full digest, the winner's id and the
number of rows. An incoming digest is looked up in its bucket: it is a repeat only
if all bytes of the slot's digest agree. Digests that history lacks form groups of
their own.

Only digests travel, never texts. Incoming rows are summed per digest before the
look-up, so that a text with very many copies is one row there; a bucket is bounded
by ``per_bucket`` distinct digests on average.

Defined results: a NULL text equals the empty text; a NULL id is smaller than any
other; of rows that share both text and id exactly one is kept; an empty table
gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tenureframe.functions import row_count
from tenureframe.llm.common import bucket_count, staged, text_or_empty

# The lowest id stands for a missing one inside the tables.
NO_ID = -(2**63)
# Bits per key that is still without a slot, on each level of the hash function.
BITS_PER_KEY = 2
_INDEX = "bucket long, levels array<binary>, digests binary, winners binary, sizes binary"
_GROUPS = "digest binary, keep long, size long"


def _words(digests: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit words of each 32-byte digest."""
    words = digests.view("<u8").reshape(len(digests), 4)
    return words[:, 0], words[:, 1]


def _positions(digests: np.ndarray, level: int, size: int) -> np.ndarray:
    """Where each digest falls on a level of ``size`` bits."""
    first, second = _words(digests)
    mixed = first + np.uint64(2 * level + 1) * second
    mixed ^= mixed >> np.uint64(32)
    mixed *= np.uint64(0x9E3779B97F4A7C15)
    return ((mixed >> np.uint64(20)) % np.uint64(size)).astype(np.int64)


def build_levels(digests: np.ndarray) -> list[np.ndarray]:
    """Bit arrays that give each of the distinct digests a position of its own.

    A digest is placed on the first level where no other one shares its position;
    levels are added until all are placed.
    """
    levels, left = [], digests
    while len(left):
        size = max(8, BITS_PER_KEY * len(left))
        at = _positions(left, len(levels), size)
        alone = np.bincount(at, minlength=size) == 1
        levels.append(alone)
        left = left[~alone[at]]
    return levels


def slots_of(levels: list[np.ndarray], digests: np.ndarray) -> np.ndarray:
    """The slot of each digest, gapless from 0 for members; -1 for sure nonmembers.

    Another nonmember may get a member's slot, so the slot's digest must be compared.
    """
    slots = np.full(len(digests), -1, np.int64)
    open_ = np.arange(len(digests))
    before = 0
    for level, bits in enumerate(levels):
        at = _positions(digests[open_], level, len(bits))
        hit = bits[at]
        rank = np.cumsum(bits) - 1
        slots[open_[hit]] = before + rank[at[hit]]
        before += int(rank[-1]) + 1
        open_ = open_[~hit]
    return slots


def _digest_array(values: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(values), np.uint8).reshape(-1, 32)


def _build_bucket(key: tuple, groups: pd.DataFrame) -> pd.DataFrame:
    digests = _digest_array(groups["digest"])
    levels = build_levels(digests)
    order = np.argsort(slots_of(levels, digests))
    return pd.DataFrame(
        {
            "bucket": [key[0]],
            "levels": [[np.packbits(x).tobytes() + bytes([-len(x) % 8]) for x in levels]],
            "digests": [digests[order].tobytes()],
            "winners": [groups["keep"].to_numpy(np.int64)[order].tobytes()],
            "sizes": [groups["size"].to_numpy(np.int64)[order].tobytes()],
        }
    )


def _unpack(level: bytes) -> np.ndarray:
    bits = np.unpackbits(np.frombuffer(level, np.uint8, len(level) - 1))
    return bits[: len(bits) - level[-1]].astype(bool)


def _look_up(key: tuple, index: pd.DataFrame, incoming: pd.DataFrame) -> pd.DataFrame:
    """All groups of a bucket: its slots with their repeats added, then the nonmembers."""
    if index.empty:
        return incoming[["digest", "keep", "size"]]
    bucket = index.iloc[0]
    held = np.frombuffer(bucket["digests"], np.uint8).reshape(-1, 32)
    winners = np.frombuffer(bucket["winners"], np.int64).copy()
    sizes = np.frombuffer(bucket["sizes"], np.int64).copy()
    digest = list(map(bytes, held))
    if incoming.empty:
        return pd.DataFrame({"digest": digest, "keep": winners, "size": sizes})
    asked = _digest_array(incoming["digest"])
    slots = slots_of([_unpack(x) for x in bucket["levels"]], asked)
    member = slots >= 0
    member[member] = (held[slots[member]] == asked[member]).all(axis=1)
    np.maximum.at(winners, slots[member], incoming["keep"].to_numpy(np.int64)[member])
    np.add.at(sizes, slots[member], incoming["size"].to_numpy(np.int64)[member])
    known = pd.DataFrame({"digest": digest, "keep": winners, "size": sizes})
    return pd.concat([known, incoming.loc[~member, ["digest", "keep", "size"]]])


def _grouped(rows: DataFrame, buckets: int) -> DataFrame:
    return (
        rows.groupBy("digest")
        .agg(F.max("id").alias("keep"), row_count().alias("size"))
        .withColumn("bucket", F.pmod(F.xxhash64("digest"), F.lit(buckets)))
    )


def build_index(rows: DataFrame, buckets: int) -> DataFrame:
    """The perfect hash tables of history rows (``digest``, ``id``), one row per bucket."""
    built = _grouped(rows, buckets).groupBy("bucket").applyInPandas(_build_bucket, _INDEX)
    return staged(built, "digest-index")


def look_up(index: DataFrame, rows: DataFrame, buckets: int) -> DataFrame:
    """Groups (``digest``, ``keep``, ``size``) of history and incoming rows together."""
    incoming = _grouped(rows, buckets)
    return (
        index.groupBy("bucket")
        .cogroup(incoming.groupBy("bucket"))
        .applyInPandas(_look_up, _GROUPS)
    )


def exact_groups(
    docs: DataFrame,
    history: Column | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    per_bucket: int = 50_000,
) -> DataFrame:
    """One row per document: its id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    ``history`` tells which rows were there before; by default those above the
    middle id, so that the winner of most groups is already in the index.
    """
    if history is None:
        middle = docs.agg(F.percentile_approx(id_col, 0.5).alias("middle")).scalar()
        history = F.coalesce(F.col(id_col) > middle, F.lit(False))
    same_row = Window.partitionBy("digest", "id").orderBy("old")
    rows = staged(
        docs.select(
            F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"),
            F.unhex(F.sha2(text_or_empty(text_col), 256)).alias("digest"),
            history.alias("old"),
        ).withColumn("copy", F.row_number().over(same_row)),
        "digests",
    )
    buckets = bucket_count(rows.count(), per_bucket)
    index = build_index(rows.filter("old"), buckets)
    groups = look_up(index, rows.filter("NOT old"), buckets)

    def shown(column: str) -> Column:
        return F.when(F.col(column) != NO_ID, F.col(column))

    return rows.join(groups, "digest").select(
        shown("id").alias(id_col),
        shown("keep").alias("keep_id"),
        F.col("size").alias("group_size"),
        ((F.col("id") == F.col("keep")) & (F.col("copy") == 1)).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
