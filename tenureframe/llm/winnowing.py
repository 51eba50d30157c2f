"""Document fingerprints by winnowing.

Every run of ``GRAM`` code points is hashed; of every ``WINDOW`` consecutive hashes
the smallest is chosen, the rightmost of equals. Chosen hashes are kept with their
positions. Any passage of ``WINDOW + GRAM - 1`` code points that two texts share
leaves at least one hash in both fingerprints. A text shorter than a gram has the
hash of the whole text; an empty text has none.

The likeness of two fingerprints is the share of their distinct hashes that both
have; two empty ones are alike.

``compare_with_next`` needs each document's successor by id. Ids are cut into ranges
at approximate quantiles, and the first document of each range also goes, as a
guest, to the range before it: one shuffle of the texts, sorted within ranges and
streamed, without a window over everything. The driver holds range bounds and
first ids, at most ``max_ranges`` of each.

Defined results: a NULL text is empty; a NULL id comes first; rows with equal ids
follow each other in order of their texts; the document after the last is the
first, so a single one follows itself; an empty table gives an empty result;
further columns are ignored.
"""

from __future__ import annotations

from base64 import b64encode
from collections.abc import Iterable, Iterator
from hashlib import sha256

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenureframe.llm.common import bucket_count, per_batch, text_or_empty

GRAM = 16
WINDOW = 32
BASE = 0x9E3779B97F4A7C15
_NO_ID = -(2**63)
_LIST = "id long, hashes array<long>, positions array<long>"
_COMPARED = (
    "id long, n_chars long, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)


def _code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def rolling_hashes(codes: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """32-bit hashes of all runs of ``gram`` code points, a power of two.

    The hash of a run is put together from those of its halves.
    """
    hashes, size, power = codes.astype(np.uint64) + np.uint64(1), 1, BASE
    while size < gram:
        hashes = hashes[:-size] * np.uint64(power) + hashes[size:]
        size, power = size * 2, power * power % 2**64
    hashes ^= hashes >> np.uint64(29)
    return (hashes * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(32)


def winnow(text: str, gram: int = GRAM, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Chosen hashes and their positions; ``gram`` and ``window`` are powers of two."""
    codes = _code_points(text)
    if not len(codes):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    if len(codes) < gram:
        whole = int.from_bytes(sha256(text.encode("utf-8", "surrogatepass")).digest()[:4], "little")
        return np.array([whole], np.uint64), np.zeros(1, np.int64)
    hashes = rolling_hashes(codes, gram)
    # Small hash first, then the position farthest to the right.
    last = np.uint64(0xFFFFFFFF)
    least = (hashes << np.uint64(32)) | (last - np.arange(len(hashes), dtype=np.uint64))
    if len(least) < window:
        least = least.min(keepdims=True)
    else:
        size = 1
        while size < window:
            least = np.minimum(least[:-size], least[size:])
            size *= 2
    chosen = least[np.concatenate(([True], least[1:] != least[:-1]))]
    return chosen >> np.uint64(32), (last - (chosen & last)).astype(np.int64)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Shared over all distinct hashes; both sorted and distinct."""
    if not len(a) and not len(b):
        return 1.0
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return shared / (len(a) + len(b) - shared)


def as_text(hashes: np.ndarray, positions: np.ndarray) -> str:
    """Pairs of position and hash as base64 of little-endian 32-bit integers."""
    pairs = np.stack((positions.astype("<u4"), hashes.astype("<u4")), axis=1)
    return b64encode(pairs.tobytes()).decode()


def edited(text: str, following: str) -> str:
    """The text, its last half replaced by the start of the following document."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``id``, chosen ``hashes`` and their ``positions``."""

    def convert(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [winnow(text) for text in batch.column("text").to_pylist()]
        longs = pa.list_(pa.int64())
        return pa.RecordBatch.from_arrays(
            [
                batch.column("id"),
                pa.array([x.astype(np.int64) for x, _ in found], longs),
                pa.array([x for _, x in found], longs),
            ],
            ["id", "hashes", "positions"],
        )

    rows = docs.select(
        F.col(id_col).cast("long").alias("id"), text_or_empty(text_col).alias("text")
    )
    return rows.mapInArrow(per_batch(convert), _LIST)


class _Print:
    def __init__(self, text: str):
        hashes, positions = winnow(text)
        self.distinct = np.unique(hashes)
        self.shown = as_text(hashes, positions)


def _compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by range, guests last, so each row's successor follows it."""
    rows: list[tuple] = []
    waiting = None

    def finish(text: str, own: _Print) -> None:
        before_id, before, mark = waiting
        changed = edited(before, text)
        other = _Print(changed)
        rows.append(
            (
                before_id if before_id != _NO_ID else None,
                len(before),
                sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(),
                mark.shown,
                other.shown,
                likeness(mark.distinct, other.distinct),
                likeness(mark.distinct, own.distinct),
            )
        )

    def flush() -> pa.RecordBatch:
        types = (pa.int64(), pa.int64(), *[pa.string()] * 3, pa.float64(), pa.float64())
        columns = [pa.array(column, kind) for column, kind in zip(zip(*rows), types)]
        rows.clear()
        names = [field.split()[0] for field in _COMPARED.split(", ")]
        return pa.RecordBatch.from_arrays(columns, names)

    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("guest", "id", "text"))
        for guest, id_, text in zip(*columns):
            # Rows with the same id as the guest's follow it and are not needed.
            if waiting is None and guest:
                continue
            mark = _Print(text)
            if waiting is not None:
                finish(text, mark)
            waiting = None if guest else (id_, text, mark)
        if len(rows) >= 1000:
            yield flush()
    if rows:
        yield flush()


def compare_with_next(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    rows_per_range: int = 1000,
    max_ranges: int = 10_000,
) -> DataFrame:
    """Fingerprints of each text and its edited text, and their likenesses.

    Ranges are cut at approximate quantiles of the ids, ``rows_per_range`` rows each up to
    ``max_ranges`` ranges; beyond ten million rows at the given values ranges grow with the
    table. That changes how rows are dealt, not the result: a range is a stream, of which a
    task holds one text and its successor.
    """
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(_NO_ID))
    ranges = min(max_ranges, bucket_count(docs.count(), rows_per_range))
    shares = [i / ranges for i in range(1, ranges)]
    bounds = np.empty(0, np.int64)
    if shares:
        quantiles = F.percentile_approx(key, shares, 100 * ranges)
        bounds = np.unique(np.array(docs.agg(quantiles).first()[0] or [], np.int64))

    @F.pandas_udf("long")
    def range_of(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, ids.to_numpy(np.int64), side="right"))

    heads = sorted(
        (row["range"], row["head"])
        for row in docs.select(key.alias("id"))
        .groupBy(range_of("id").alias("range"))
        .agg(F.min("id").alias("head"))
        .collect()
    )
    # Each range's first document is a guest of the range before; the very first of the last.
    head_ids = np.array([head for _, head in heads], np.int64)
    hosts = np.array([heads[i - 1][0] for i in range(len(heads))], np.int64)

    @F.pandas_udf("long")
    def host_of(ids: pd.Series) -> pd.Series:
        ids = ids.to_numpy(np.int64)
        at = np.minimum(np.searchsorted(head_ids, ids), len(head_ids) - 1)
        return pd.Series(np.where(head_ids[at] == ids, hosts[at], -1))

    def place(where, guest: bool):
        return F.struct(where.alias("range"), F.lit(guest).alias("guest"))

    rows = docs.select(key.alias("id"), text_or_empty(text_col).alias("text")).withColumns(
        {"own": range_of("id"), "host": host_of("id")}
    )
    places = F.when(
        F.col("host") >= 0, F.array(place(F.col("own"), False), place(F.col("host"), True))
    ).otherwise(F.array(place(F.col("own"), False)))
    dealt = (
        rows.select("id", "text", F.inline(places))
        .repartition("range")
        .sortWithinPartitions("range", "guest", "id", "text")
    )
    return dealt.select("range", "guest", "id", "text").mapInArrow(_compare, _COMPARED)
