"""SimHash near-dedup over a byte-position inverted index with count filtering.

A text's fingerprint has 64 bits, eight bytes. Fingerprints that differ in at most
``max_bits`` bits have at least ``8 - max_bits`` bytes in common, in place. Lists of
single bytes would be far too long, so the index lists fingerprints by several
bytes at a time, the sets chosen so that every pair with the guaranteed number of
shared bytes meets in a list. Within a list the shared bytes of each pair are
tallied, pairs below the guaranteed number go, and the others are verified bit by
bit.

Equal fingerprints are one entry, so copies form no pairs. Entries of a list are
linked to one that they reach, so a list gives fewer links than entries,
and lists with more than ``list_size`` entries are dealt into cells of two blocks
each, which together hold every pair. Components of the links are found in rounds.

Defined results: a NULL text is empty; a text of fewer words than a shingle is one
shingle; a text without words has fingerprint zero and is linked like any other; a
NULL id never names a component unless all its members lack one; repeated rows are
returned each; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from hashlib import sha256
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenureframe.functions import row_count
from tenureframe.llm.common import per_batch, staged, text_or_empty
from tenureframe.llm.components import connected_components

SEED = 42
SHINGLE_WORDS = 3
MAX_BITS = 3
LIST_SIZE = 2000
BYTES = 8


def shingle_hashes(text: bytes, words_per_shingle: int = SHINGLE_WORDS) -> np.ndarray:
    """Hashes of a text's word runs; only A to Z are lower-cased, words end at ASCII
    white space."""
    words = text.lower().split()
    if not words:
        return np.empty(0, "<u8")
    if len(words) < words_per_shingle:
        shingles: Iterable[bytes] = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(words_per_shingle))))
    digest = xxhash.xxh64_intdigest
    return np.array([digest(shingle, SEED) for shingle in shingles], "<u8")


def fingerprint(hashes: np.ndarray) -> int:
    """Unsigned fingerprint: a bit is set where it is in over half of the hashes."""
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, BYTES), axis=1, bitorder="little")
    most = 2 * bits.sum(axis=0, dtype=np.int64) > len(hashes)
    return int(np.packbits(most, bitorder="little").view("<u8")[0])


def fingerprints(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words_per_shingle: int = SHINGLE_WORDS,
) -> DataFrame:
    """One row per document: ``id``, the ``digest`` of its text, and its fingerprint
    ``fp`` as a signed integer."""

    def convert(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [text.encode("utf-8", "replace") for text in batch.column("text").to_pylist()]
        found = [fingerprint(shingle_hashes(text, words_per_shingle)) for text in texts]
        fps = pa.array(np.array(found, np.uint64).view(np.int64))
        digests = pa.array([sha256(text).digest() for text in texts], pa.binary())
        return pa.RecordBatch.from_arrays(
            [batch.column("id"), digests, fps], ["id", "digest", "fp"]
        )

    rows = docs.select(
        F.col(id_col).cast("long").alias("id"), text_or_empty(text_col).alias("text")
    )
    return rows.mapInArrow(per_batch(convert), "id long, digest binary, fp long")


def byte_sets(max_bits: int = MAX_BITS) -> list[tuple[int, ...]]:
    """Sets of byte positions, one of which every pair of near fingerprints shares.

    Three differing bits leave five shared bytes of eight, and any five positions
    contain four whose numbers have the exclusive or zero: fourteen sets. In general
    all sets of the guaranteed size are taken.
    """
    if not 0 <= max_bits < BYTES:
        raise ValueError(f"max_bits must be from 0 to {BYTES - 1}, not {max_bits}")
    if max_bits == 3:
        return [s for s in combinations(range(BYTES), 4) if s[0] ^ s[1] ^ s[2] ^ s[3] == 0]
    return list(combinations(range(BYTES), BYTES - max_bits))


def _mask(positions: tuple[int, ...]) -> int:
    mask = sum(0xFF << (8 * p) for p in positions)
    return mask - 2**64 if mask >= 2**63 else mask


def linked(
    values: np.ndarray, nodes: np.ndarray, max_bits: int = MAX_BITS
) -> tuple[np.ndarray, np.ndarray]:
    """Links between the nodes of a list whose values are near: each to one of the
    nodes it reaches. Nodes of equal values are linked to the smallest of them."""
    order = np.lexsort((nodes, values))
    values, nodes = values[order], nodes[order]
    first = np.ones(len(values), bool)
    first[1:] = values[1:] != values[:-1]
    holder = nodes[first][np.cumsum(first) - 1]
    ends, roots = [nodes[holder != nodes]], [holder[holder != nodes]]
    left, names = values[first], nodes[first]
    while len(left) > 1:
        root, waiting = names[0], [left[0]]
        left, names = left[1:], names[1:]
        while waiting and len(left):
            apart = left ^ waiting.pop()
            shared = (apart.view(np.uint8).reshape(-1, BYTES) == 0).sum(axis=1)
            near = shared >= BYTES - max_bits
            near[near] = np.bitwise_count(apart[near]) <= max_bits
            if near.any():
                ends.append(names[near])
                roots.append(np.full(int(near.sum()), root))
                waiting.extend(left[near])
                left, names = left[~near], names[~near]
    return np.concatenate(ends), np.concatenate(roots)


def _link_lists(max_bits: int):
    """Links within each list; rows come sorted, a list may go on in the next batch."""

    def links(rows: np.ndarray, cuts: np.ndarray) -> pa.RecordBatch:
        found = [
            linked(part[:, 4].copy().view(np.uint64), part[:, 4], max_bits)
            for part in np.split(rows, cuts)
        ]
        u, v = (np.concatenate([pair[i] for pair in found]) for i in (0, 1))
        return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("positions", "shared", "first", "second", "fp")
        held = np.empty((0, len(names)), np.int64)
        for batch in batches:
            rows = np.stack([batch.column(n).to_numpy().astype(np.int64) for n in names], axis=1)
            held = np.concatenate((held, rows))
            new = np.flatnonzero((held[1:, :4] != held[:-1, :4]).any(axis=1)) + 1
            if len(new):
                yield links(held[: new[-1]], new[:-1])
                held = held[new[-1] :]
        if len(held):
            yield links(held, np.empty(0, np.int64))

    return run


def near_links(nodes: DataFrame, max_bits: int = MAX_BITS, list_size: int = LIST_SIZE) -> DataFrame:
    """Links (``u``, ``v``) that connect all distinct ``fp`` within ``max_bits``."""
    masks = [F.lit(_mask(s)) for s in byte_sets(max_bits)]
    # A node becomes many entries: small inputs must not be merged into few tasks.
    tasks = 4 * int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = nodes.repartition(tasks, "fp")
    shared = F.array(*[F.col("fp").bitwiseAND(mask) for mask in masks])
    entries = spread.select("fp", F.posexplode(shared).alias("positions", "shared"))
    key = ["positions", "shared"]
    # Lists of one entry have no pairs; blocks are counted for the long ones.
    sizes = entries.groupBy(*key).agg(row_count().alias("n")).filter("n > 1")
    blocks = F.ceil(F.col("n") / list_size).cast("int")
    own = F.pmod(F.xxhash64("fp", F.lit(SEED)), F.col("blocks")).cast("int")

    def cell(other: Column) -> Column:
        return F.struct(
            F.least("own", other).alias("first"), F.greatest("own", other).alias("second")
        )

    others = F.sequence(F.lit(0), F.col("blocks") - 1)
    cells = (
        entries.join(sizes.withColumn("blocks", blocks), key)
        .withColumn("own", own)
        .select(*key, "fp", F.inline(F.transform(others, cell)))
    )
    group = [*key, "first", "second"]
    return (
        cells.repartition(*group)
        .sortWithinPartitions(*group, "fp")
        .mapInArrow(_link_lists(max_bits), "u long, v long")
        .distinct()
    )


def near_components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words_per_shingle: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
    list_size: int = LIST_SIZE,
) -> DataFrame:
    """One row per document: ``id``, ``digest`` of its text, ``fp``, ``root`` (a name of its
    component that does not rest on ids), and ``component_id``, its smallest id."""
    rows = staged(fingerprints(docs, id_col, text_col, words_per_shingle), "fingerprints")
    nodes = rows.groupBy("fp").agg(F.min("id").alias("least"))
    links = near_links(nodes.select("fp"), max_bits, list_size)
    roots = connected_components(links).withColumnRenamed("node", "fp")
    rooted = nodes.join(roots, "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    rooted = staged(rooted, "roots")
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    members = rooted.join(named, "root").select("fp", "root", "component_id")
    return rows.join(members, "fp").select("id", "digest", "fp", "root", "component_id")
