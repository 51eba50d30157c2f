"""Sharding by vector bin packing over bytes, tokens and rows.

Equal texts form a group, a vector of bytes, tokens and rows. Groups go, largest first, to
the shard where the dot product of the group's vector with what is left of the shard's
capacity is highest; both are measured in shares of the total.

The driver places the heavy groups, those above ``1 / heavy`` of a shard in some measure:
there are at most ``3 * shards * heavy`` of them. The others are dealt by hash into parts of
about ``per_part`` groups, and each part is placed by a task, in an equal share of the
capacity that the heavy ones left; parts take equally good shards in different order, so
that they do not all fill the same one first. Every group is thus placed as a whole by its
own vector, but for one that alone exceeds a whole shard in some measure (at most
``3 * shards``): it cannot stay whole under the law, and its rows are dealt into
``PIECES`` items.

Rows are numbered within one of ``RUNS`` parts of a shard by a window, and the part's first
place in the shard comes from the driver, which sees a count for each shard and part.

Defined results: a NULL text has no bytes and no tokens and groups with other NULL
and empty texts; repeated rows get places of their own; an empty table gives an
empty result; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tenureframe.functions import row_count
from tenureframe.llm.common import bucket_count, staged, text_or_empty

MEASURES = ("bytes", "tokens", "rows")
PIECES = 64
HEAVY = 500
PER_PART = 50_000
# Parts of a shard in which its rows are numbered.
RUNS = 64
_PLACED = "group_hash long, piece long, shard int"


def place(
    vectors: np.ndarray,
    shards: int,
    weights: tuple[float, ...] = (1.0, 1.0, 1.0),
    left: np.ndarray | None = None,
    turn: int = 0,
) -> np.ndarray:
    """The shard of each item, from vectors of (bytes, tokens, rows).

    ``left`` is what is left of each shard, in the unit of the vectors, and is brought up to
    date; without it the vectors are taken for all there is. Of equally good shards the
    first one from ``turn`` on is taken.
    """
    if left is None:
        vectors = vectors / np.maximum(vectors.sum(axis=0), 1) * shards
        left = np.ones((shards, vectors.shape[1]))
    chosen = np.zeros(len(vectors), np.int64)
    order = (np.arange(shards) + turn) % shards
    for item in np.lexsort((np.arange(len(vectors)), -vectors.max(axis=1, initial=0))):
        best = order[np.argmax(left[order] @ (vectors[item] * weights))]
        chosen[item] = best
        left[best] -= vectors[item]
    return chosen


def word_count(text: str) -> Column:
    """Words between white space, the default measure of tokens."""
    return F.regexp_count(text_or_empty(text), F.lit(r"\S+"))


def shard_groups(
    groups: DataFrame,
    pieces: DataFrame,
    capacity: dict[str, float],
    shards: int,
    weights: tuple[float, ...],
    heavy: int = HEAVY,
    per_part: int = PER_PART,
) -> tuple[DataFrame, DataFrame]:
    """Two tables (group_hash, piece, shard): the heavy groups, of bounded number, and all
    others. ``pieces`` are the items of groups that exceed a shard."""
    spark = groups.sparkSession
    unit = np.array([max(capacity[m], 1e-9) for m in MEASURES])
    above = " OR ".join(f"{m} > {max(capacity[m] / heavy, 0)}" for m in MEASURES)
    columns = ["group_hash", F.lit(-1).cast("long").alias("piece"), *MEASURES]
    whole = " AND ".join(f"{m} <= {capacity[m]}" for m in MEASURES)
    large = groups.filter(above).filter(whole).select(*columns).unionByName(pieces)
    first = large.orderBy("group_hash", "piece").collect()
    left = np.ones((shards, len(MEASURES)))
    vectors = np.array([[r[m] for m in MEASURES] for r in first], float).reshape(-1, len(MEASURES))
    chosen = place(vectors / unit, shards, weights, left)
    table = [(r["group_hash"], r["piece"], int(s)) for r, s in zip(first, chosen)]
    by_driver = spark.createDataFrame(table, _PLACED)

    small = groups.filter(f"NOT ({above})")
    parts = bucket_count(small.count(), per_part)
    share = left / parts

    def place_part(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("group_hash")
        own, turn = frame[list(MEASURES)].to_numpy(float) / unit, int(frame["part"].iloc[0])
        found = place(own, shards, weights, share.copy(), turn).astype(np.int32)
        return pd.DataFrame({"group_hash": frame["group_hash"], "piece": -1, "shard": found})

    part = F.pmod(F.xxhash64("group_hash", F.lit(parts)), F.lit(parts)).cast("int")
    by_tasks = (
        small.withColumn("part", part)
        .groupBy("part")
        .applyInPandas(place_part, _PLACED)
    )
    return by_driver, by_tasks


def shard_documents(
    docs: DataFrame,
    shards: int = 8,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokens: Column | None = None,
    weights: tuple[float, ...] = (1.0, 1.0, 1.0),
    heavy: int = HEAVY,
    per_part: int = PER_PART,
) -> DataFrame:
    """One row per document: id, its measures, ``text_crc32``, ``shard`` and ``slot``."""
    spark, text = docs.sparkSession, text_or_empty(text_col)
    tokens = word_count(text_col) if tokens is None else tokens
    rows = staged(
        docs.select(
            F.col(id_col).alias("id"),
            F.octet_length(text).cast("long").alias("text_bytes"),
            tokens.cast("long").alias("tokens"),
            F.crc32(text.cast("binary")).alias("crc"),
            F.xxhash64(F.sha2(text, 256)).alias("group_hash"),
            F.monotonically_increasing_id().alias("row"),
        ).withColumn("bytes", F.col("text_bytes") + 1),
        "measures",
    ).withColumn("rows", F.lit(1).cast("long"))

    sums = [F.sum(m).alias(m) for m in MEASURES]
    groups = staged(rows.groupBy("group_hash").agg(*sums), "groups")
    total = groups.agg(*sums).first()
    capacity = {m: (total[m] or 0) / shards for m in MEASURES}
    beyond = " OR ".join(f"{m} > {capacity[m]}" for m in MEASURES)
    # At most ``3 * shards`` groups can exceed a shard.
    split = sorted(r["group_hash"] for r in groups.filter(beyond).select("group_hash").collect())
    number = F.lit(-1)
    if split:
        dealt = F.pmod(F.xxhash64("row"), F.lit(PIECES))
        number = F.when(F.col("group_hash").isin(split), dealt).otherwise(-1)
    rows = rows.withColumn("piece", number.cast("long"))
    pieces = rows.filter("piece >= 0").groupBy("group_hash", "piece").agg(*sums)
    by_driver, by_tasks = shard_groups(groups, pieces, capacity, shards, weights, heavy, per_part)

    # Bounded by ``heavy`` and ``PIECES``; rows of hot groups stay where they are.
    near = F.broadcast(by_driver)
    key = ["group_hash", "piece"]
    light = rows.join(F.broadcast(by_driver.select("group_hash").distinct()), "group_hash", "left_anti")
    columns = ["id", *MEASURES, "crc", "row", "shard"]
    placed = staged(
        rows.join(near, key).select(*columns).unionByName(light.join(by_tasks, key).select(*columns)),
        "placed",
    )

    run = F.pmod(F.xxhash64("row", F.lit(RUNS)), F.lit(RUNS)).alias("run")
    placed = placed.select("*", run)
    sizes = placed.groupBy("shard", "run").agg(row_count().alias("n")).orderBy("shard", "run").collect()
    first, table = [0] * shards, []
    for r in sizes:
        table.append((r["shard"], r["run"], first[r["shard"]]))
        first[r["shard"]] += r["n"]
    starts = F.broadcast(spark.createDataFrame(table, "shard int, run long, first long"))
    within = F.row_number().over(Window.partitionBy("shard", "run").orderBy("id", "row"))
    return (
        placed.withColumn("within", within - 1)
        .join(starts, ["shard", "run"])
        .select(
            F.col("id").alias(id_col),
            F.col("bytes").alias("size"),
            "tokens",
            F.col("crc").alias("text_crc32"),
            "shard",
            (F.col("first") + F.col("within")).cast("long").alias("slot"),
        )
    )
