"""Removal of repeated byte strings with suffix arrays built by two-stage sorting.

A byte goes if a string of ``length`` bytes that covers it also starts earlier: in a
document before, or before it in the same document.

Equal strings are brought together first. Every window of ``length`` bytes has an
anchor, its smallest ``GRAM``-byte hash (the rightmost of equals), so equal windows
have equal anchors. Neighbouring windows with the same anchor form a stretch, and
every window lies in exactly one stretch. Stretches are dealt by their anchor's
hash; a copy of a whole stretch (128-bit digest) is a repeat of the first one. Where
different stretches share an anchor, a window has half of its further bytes on the
anchor's left, or more than half on its right: a stretch whose left and right half (hashed)
no other one of the anchor has holds no repeat, and of all others the bytes are fetched
and sorted.

The suffix arrays of a task's stretches are built in two stages: suffixes smaller
than their successors are sorted directly, to the depth of a window; all others are
induced by scanning the buckets of first bytes from the left. Common prefixes of
adjacent suffixes then show which windows are equal, and all but the earliest of
those are repeats.

Copies within a portion of a task's texts are found before the shuffle, so that a
stretch found in very many documents leaves one row per portion. Rows of one anchor
stream through one task sorted; a suffix array takes stretches of whole anchors up
to about ``CHUNK`` bytes. Stretches of an anchor with more than ``CROWD`` different ones
are cut into pieces of up to ``SLICE`` windows whose anchor lies about as deep in the
window, and pieces are dealt by the bytes that all their windows share. Pieces of one
such key that are larger than a suffix array are taken in runs that keep the earliest.

Defined results: a NULL text is empty; nothing goes from a text shorter than
``length``; a NULL id comes first; rows that share an id are ordered by a checksum
of their texts, and rows that also share the text are one document, whose result
each of them gets; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenureframe.functions import row_count
from tenureframe.llm.common import shuffles_dropped, staged, text_or_empty

LENGTH = 100
GRAM = 16
BASE = 0x9E3779B97F4A7C15
NO_ID = -(2**63)
# Bytes of text whose stretches are compared before the shuffle; bytes of a suffix array.
PORTION = 8_000_000
CHUNK = 4_000_000
# Different stretches up to which an anchor's are compared together.
CROWD = 10_000
# Windows of a piece of a stretch of a crowded anchor.
SLICE = 8
# Different stretches of one anchor that wait for its last one; beyond, all go on.
HELD = 250_000
# Ends a stretch inside a suffix array; UTF-8 does not use this byte.
STOP = 0xFF

_STRETCHES = (
    "anchor long, digest1 long, digest2 long, doc long, tag long, start long, shape long, "
    "sides long, repeated boolean"
)
_FOUND = "anchor long, doc long, tag long, start long, shape long, repeated boolean"
_BYTES = "anchor long, doc long, tag long, start long, bytes binary"
_RANGES = "doc long, tag long, start long, n long"
_REMOVED = "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _columns(batch: pa.RecordBatch, names: Iterable[str]) -> np.ndarray:
    """Integer columns as one array, a row each."""
    return np.stack([batch.column(n).to_numpy().astype(np.int64) for n in names], axis=1)


def _distinct(rows: np.ndarray) -> np.ndarray:
    """Without rows equal to the one before: rows of one document that is there twice."""
    return rows[_differs(rows)]


def _differs(rows: np.ndarray) -> np.ndarray:
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]).any(axis=1)
    return new


def _batch(columns: dict[str, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.ascontiguousarray(c)) for c in columns.values()], list(columns)
    )


# Stretches


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """64-bit hashes of all runs of ``GRAM`` bytes, each put together from its halves."""
    hashes, size, power = data.astype(np.uint64) + np.uint64(1), 1, BASE
    while size < GRAM:
        hashes = hashes[:-size] * np.uint64(power) + hashes[size:]
        size, power = size * 2, power * power % 2**64
    hashes ^= hashes >> np.uint64(29)
    hashes *= np.uint64(0xBF58476D1CE4E5B9)
    return hashes ^ (hashes >> np.uint64(32))


def _side_keys(
    hashes: np.ndarray, at: np.ndarray, places: np.ndarray, counts: np.ndarray, length: int
) -> np.ndarray:
    """Hashes of the bytes left (upper half) and right of each anchor, zero where no window
    of the stretch has so many on that side."""
    half = (length - GRAM + 1) // 2
    steps = np.arange(half, 0, -GRAM)
    factors = np.uint64(BASE) * np.arange(1, 2 * len(steps) + 1, 2, dtype=np.uint64)
    around = hashes.take(at[:, None] + np.concatenate((-steps, steps)), mode="clip")
    keys = (around.reshape(len(at), 2, len(steps)) * factors).sum(axis=2) >> np.uint64(32)
    left = (keys[:, 0] | np.uint64(1)) * (places >= half)
    right = (keys[:, 1] | np.uint64(1)) * (places - counts + 1 < half)
    return ((left << np.uint64(32)) | right).view(np.int64)


def stretches(data: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """Anchor hash, first window, shape and keys of the anchor's sides of every stretch of a
    text. The shape is the anchor's place in the first window times ``length``, plus the
    number of windows: one number, as it is shuffled with each stretch."""
    hashes = gram_hashes(data)
    last = np.uint64(0xFFFFFFFF)
    least = (hashes & ~last) | (last - np.arange(len(hashes), dtype=np.uint64))
    width, size = length - GRAM + 1, 1
    while size * 2 <= width:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if size < width:
        least = np.minimum(least[: size - width], least[width - size :])
    at = (last - (least & last)).astype(np.int64)
    starts = np.concatenate(([0], np.flatnonzero(at[1:] != at[:-1]) + 1))
    counts = np.diff(np.append(starts, len(at)))
    at = at[starts]
    sides = _side_keys(hashes, at, at - starts, counts, length)
    return hashes[at].view(np.int64), starts, (at - starts) * length + counts, sides


def _anywhere(docs: np.ndarray, starts: np.ndarray) -> np.ndarray:
    mixed = (docs.view(np.uint64) * np.uint64(BASE)) ^ starts.astype(np.uint64)
    return (mixed * np.uint64(0xBF58476D1CE4E5B9)).view(np.int64)


def _portion_rows(docs: list[tuple[int, int, bytes]], length: int) -> pa.RecordBatch | None:
    """Stretches of some documents; a copy of an earlier one among them is marked."""
    seen: set[bytes] = set()
    parts, repeated, digests = [], [], []
    for doc, tag, text in sorted(set(docs)):
        if len(text) < length:
            continue
        anchors, starts, shapes, sides = stretches(np.frombuffer(text, np.uint8), length)
        ends = starts + shapes % length + (length - 1)
        digest = [
            xxhash.xxh3_128_digest(text[i:j]) for i, j in zip(starts.tolist(), ends.tolist())
        ]
        repeated += [d in seen or seen.add(d) is not None for d in digest]
        digests += digest
        same = np.ones(len(starts), np.int64)
        columns = (anchors, same * doc, same * tag, starts, shapes, sides)
        parts.append(np.stack(columns, axis=1))
    if not parts:
        return None
    rows = np.concatenate(parts)
    pairs = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
    marks = np.array(repeated)
    return _batch(
        {
            # A marked row has nothing left to meet; it goes anywhere, spread by its place.
            "anchor": np.where(marks, _anywhere(rows[:, 1].copy(), rows[:, 3]), rows[:, 0]),
            "digest1": pairs[:, 0],
            "digest2": pairs[:, 1],
            "doc": rows[:, 1],
            "tag": rows[:, 2],
            "start": rows[:, 3],
            "shape": rows[:, 4],
            "sides": rows[:, 5],
            "repeated": marks,
        }
    )


def _find_stretches(length: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("doc", "tag", "text")]
            docs, size = [], 0
            for doc, tag, text in zip(*columns):
                docs.append((doc, tag, text.encode("utf-8", "surrogatepass")))
                size += len(docs[-1][2])
                if size >= PORTION:
                    if (rows := _portion_rows(docs, length)) is not None:
                        yield rows
                    docs, size = [], 0
            if (rows := _portion_rows(docs, length)) is not None:
                yield rows

    return run


def _shared(groups: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Rows whose key, if not zero, another row of their group has as well."""
    order = np.lexsort((keys, groups))
    pairs = np.stack((groups[order], keys[order]), axis=1)
    new = _differs(pairs)
    shared = np.zeros(len(groups), bool)
    shared[order] = (~new | ~np.append(new[1:], True)) & (pairs[:, 1] != 0)
    return shared


def _comparable(rows: np.ndarray) -> np.ndarray:
    """Those of the different stretches of whole anchors that may share a window."""
    anchor = np.cumsum(_differs(rows[:, :1])) - 1
    several = np.bincount(anchor)[anchor] > 1
    rows, anchor, sides = rows[several], anchor[several], rows[several, -1]
    return rows[_shared(anchor, sides >> 32) | _shared(anchor, sides & 0xFFFFFFFF)]


def _meet_stretches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repeated stretches, and first ones of each digest that may share a window with others.

    Rows come sorted by anchor, digest, document and place. The first stretches of the last
    anchor are carried to the next batch; beyond ``HELD``, they go on and only the last one is.
    """
    names = ("anchor", "digest1", "digest2", "doc", "tag", "start", "shape", "sides")

    def shown(firsts: np.ndarray, copies: np.ndarray) -> pa.RecordBatch:
        found = np.concatenate((firsts, copies))
        return _batch(
            {
                "anchor": found[:, 0],
                **{n: found[:, i] for i, n in enumerate(names[3:7], 3)},
                "repeated": np.arange(len(found)) >= len(firsts),
            }
        )

    none = np.empty((0, len(names)), np.int64)
    held, gone = none, False
    for batch in batches:
        marks = batch.column("repeated").to_numpy(zero_copy_only=False)
        rows = _columns(batch, names)
        marked, rows = rows[marks], _distinct(np.concatenate((held, rows[~marks])))
        firsts = copies = none
        if len(rows):
            new = _differs(rows[:, :3])
            firsts, copies = rows[new], rows[~new]
            begin = int(np.flatnonzero(_differs(firsts[:, :1]))[-1])
            firsts, last = firsts[:begin], firsts[begin:]
            if gone and begin:
                # The anchor that went on has ended.
                end = int(np.argmax(firsts[:, 0] != firsts[0, 0])) or len(firsts)
                ended, firsts, gone = firsts[1:end], firsts[end:], False
            else:
                ended = none
            firsts = np.concatenate((ended, _comparable(firsts)))
            if gone or len(last) > HELD:
                firsts = np.concatenate((firsts, last[int(gone) :]))
                last, gone = last[-1:], True
            held = last
        if len(firsts) + len(copies) + len(marked):
            yield shown(firsts, np.concatenate((copies, marked)))
    if not gone and len(held):
        yield shown(_comparable(held), none)


# Suffix arrays


def _words(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on as one number that sorts like them."""
    word = np.zeros(len(data) - 7, np.uint64)
    for i in range(8):
        word = (word << np.uint64(8)) | data[i : i + len(word)]
    return word


def _sorted_directly(at: np.ndarray, words: np.ndarray, depth: int) -> np.ndarray:
    """Suffix positions in order of their first ``depth`` bytes at least.

    Only suffixes that are still tied go on, each time with as many of their next bytes as
    go into one number with the number of their group.
    """
    order = at[np.argsort(words[at])]
    new, tied, offset = _differs(words[order][:, None]), np.arange(len(order)), 8
    while offset < depth:
        open_ = ~new
        open_[:-1] |= open_[1:]
        tied, group = tied[open_], np.cumsum(new[open_], dtype=np.uint64)
        if not len(tied):
            break
        size = (64 - int(group[-1]).bit_length()) // 8
        following = words[order[tied] + offset] >> np.uint64(64 - 8 * size)
        key = (group << np.uint64(8 * size)) | following
        by = np.argsort(key)
        order[tied] = order[tied][by]
        new, offset = _differs(key[by][:, None]), offset + size
    return order


def suffix_array(data: bytes, depth: int = LENGTH) -> np.ndarray:
    """Positions of all suffixes, in order of their first ``depth`` bytes at least."""
    n = len(data)
    text = np.frombuffer(data + bytes(depth + 16), np.uint8)
    words = _words(text)
    # +1: smaller than its successor. Equal bytes have the kind of the next one.
    step = np.sign(text[1 : n + 1].astype(np.int16) - text[:n]).astype(np.int8)
    step[n - 1] = -1
    following = np.where(step != 0, np.arange(n), n)
    following = np.minimum.accumulate(following[::-1])[::-1]
    rising = step[following] > 0
    sizes = np.bincount(text[:n], minlength=256)
    ends = np.cumsum(sizes)
    heads = ends - sizes
    first_of = heads.copy()
    array = np.empty(n, np.int64)

    # First stage: suffixes smaller than their successors stand last in their bucket.
    direct = _sorted_directly(np.flatnonzero(rising), words, depth)
    counts = np.bincount(text[direct], minlength=256)
    shift = ends - np.cumsum(counts)
    array[np.arange(len(direct)) + shift[text[direct]]] = direct

    # Second stage: the others, from the suffix behind them, bucket by bucket.
    def append(found: np.ndarray) -> None:
        byte = text[found]
        by = np.argsort(byte, kind="stable")
        found, byte = found[by], byte[by]
        number = np.bincount(byte, minlength=256)
        place = np.arange(len(found)) - (np.cumsum(number) - number)[byte]
        array[heads[byte] + place] = found
        heads[:] += number

    append(np.array([n - 1]))
    for byte in np.flatnonzero(sizes):
        done = first_of[byte]
        while done < heads[byte]:
            # Runs of one byte stay in its bucket.
            before = array[done : heads[byte]] - 1
            done = heads[byte]
            before = before[before >= 0]
            append(before[(text[before] == byte) & ~rising[before]])
        before = array[first_of[byte] : ends[byte]] - 1
        before = before[before >= 0]
        append(before[(text[before] > byte) & ~rising[before]])
    return array


def common_prefixes(data: bytes, array: np.ndarray, limit: int = LENGTH) -> np.ndarray:
    """Common prefix of each suffix with the one before it, in whole words, up to ``limit``."""
    words = _words(np.frombuffer(data + bytes(limit + 16), np.uint8))
    prefix = np.zeros(len(array), np.int64)
    open_ = np.arange(1, len(array))
    for end in [*range(8, limit, 8), limit]:
        offset = end - 8
        same = words[array[open_] + offset] == words[array[open_ - 1] + offset]
        open_ = open_[same]
        prefix[open_] = end
    return prefix


def repeated_windows(
    strings: list[bytes], length: int = LENGTH
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(string, first window, windows) of runs of windows that also start earlier.

    Earlier is by the order of the strings, then by place.
    """
    empty = np.empty(0, np.int64)
    if not strings:
        return empty, empty, empty
    stop = bytes([STOP])
    data = stop.join(strings) + stop
    sizes = np.fromiter(map(len, strings), np.int64, len(strings))
    begins = np.cumsum(sizes + 1) - sizes - 1
    whole = np.zeros(len(data) + 1, np.int64)
    usable = sizes >= length
    whole[begins[usable]] += 1
    whole[begins[usable] + sizes[usable] - length + 1] -= 1
    whole = np.cumsum(whole[:-1]) > 0
    array = suffix_array(data, length)
    array = array[whole[array]]
    if not len(array):
        return empty, empty, empty
    new = np.flatnonzero(common_prefixes(data, array, length) < length)
    earliest = np.minimum.reduceat(array, new)
    later = np.ones(len(data), bool)
    later[~whole] = False
    later[earliest] = False
    at = np.flatnonzero(later)
    string = np.searchsorted(begins, at, side="right") - 1
    apart = (np.diff(at) != 1) | (np.diff(string) != 0)
    runs = np.concatenate(([0], np.flatnonzero(apart) + 1)) if len(at) else at
    return string[runs], (at - begins[string])[runs], np.diff(np.append(runs, len(at)))


def _sort_stretches(length: int):
    """Repeats among the stretches of whole anchors, taken in chunks."""
    names = ("anchor", "doc", "tag", "start")

    def chunk(
        rows: np.ndarray, strings: list[bytes], whole: bool = True
    ) -> tuple[pa.RecordBatch, np.ndarray]:
        """Repeated windows, and the places of strings that also have others. A string that is
        alone under a whole anchor, or the key of a piece, shares no window."""
        places = np.flatnonzero(_differs(rows))
        if whole:
            places = places[_shared(rows[places, 0], np.ones(len(places), np.int64))]
        rows, strings = rows[places], [strings[i] for i in places]
        string, first, n = repeated_windows(strings, length)
        found = {
            "doc": rows[string, 1],
            "tag": rows[string, 2],
            "start": rows[string, 3] + first,
            "n": n,
        }
        windows = np.fromiter(map(len, strings), np.int64, len(strings)) - (length - 1)
        repeated = np.bincount(string, n, len(strings)).astype(np.int64)
        return _batch(found), places[repeated < windows]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, strings, size = np.empty((0, 4), np.int64), [], 0
        for batch in batches:
            rows = np.concatenate((rows, _columns(batch, names)))
            new = batch.column("bytes").to_pylist()
            strings += new
            size += sum(map(len, new))
            if size < CHUNK:
                continue
            # The last anchor may go on in the next batch.
            cut = int(np.searchsorted(rows[:, 0], rows[-1, 0], side="left"))
            if cut:
                yield chunk(rows[:cut], strings[:cut])[0]
                rows, strings = rows[cut:], strings[cut:]
            else:
                # One anchor fills the array: what stays has a window not seen earlier.
                found, stay = chunk(rows, strings, whole=False)
                yield found
                rows, strings = rows[stay], [strings[i] for i in stay]
            size = sum(map(len, strings))
        if strings:
            yield chunk(rows, strings)[0]

    return run


# Documents


def _pieces(data: bytes, start: int, n: int, place: int, length: int) -> Iterator[tuple]:
    """Key, first window and bytes of the pieces of a stretch: the windows in which the
    anchor's place is the same but for its last digit to the base ``SLICE``, under a hash of
    the bytes that all such windows share."""
    anchor, end = start + place, start + n
    while start < end:
        low = (anchor - start) // SLICE * SLICE
        next_ = min(anchor - low + 1, end)
        shared = data[anchor - low : anchor - low + length - SLICE + 1]
        key = xxhash.xxh3_64_intdigest(shared, low) - 2**63
        yield key, start, data[start : next_ + length - 1]
        start = next_


def _cut_stretches(length: int):
    """The bytes of the wanted stretches of each document, of crowded anchors in pieces."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("doc", "tag", "text", "wanted")
        for batch in batches:
            rows: list[tuple] = []
            for doc, tag, text, wanted in zip(*(batch.column(c).to_pylist() for c in names)):
                data = text.encode("utf-8", "surrogatepass")
                for w in wanted:
                    start, (place, n) = w["start"], divmod(w["shape"], length)
                    if w["crowded"]:
                        pieces = _pieces(data, start, n, place, length)
                        rows += [(key, doc, tag, at, piece) for key, at, piece in pieces]
                    else:
                        end = start + n + length - 1
                        rows.append((w["anchor"], doc, tag, start, data[start:end]))
            if rows:
                columns = list(zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(c, pa.int64()) for c in columns[:4]), pa.array(columns[4])],
                    ["anchor", "doc", "tag", "start", "bytes"],
                )

    return run


def removed_runs(ranges: list[dict] | None, length: int = LENGTH) -> list[tuple[int, int]]:
    """Maximal runs of bytes under any of the repeated windows."""
    runs: list[tuple[int, int]] = []
    for start, n in sorted((r["start"], r["n"]) for r in ranges or ()):
        end = start + n + length - 1
        if runs and start <= runs[-1][1]:
            runs[-1] = (runs[-1][0], max(end, runs[-1][1]))
        else:
            runs.append((start, end))
    return runs


def kept_bytes(data: bytes, runs: list[tuple[int, int]]) -> bytes:
    parts, at = [], 0
    for start, end in runs:
        parts.append(data[at:start])
        at = end
    return b"".join([*parts, data[at:]])


def _summarise(length: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            names = ("doc", "text", "ranges")
            for doc, text, ranges in zip(*(batch.column(c).to_pylist() for c in names)):
                data = text.encode("utf-8", "surrogatepass")
                runs = removed_runs(ranges, length)
                kept = kept_bytes(data, runs)
                rows.append(
                    (
                        doc if doc != NO_ID else None,
                        len(data),
                        len(data) - len(kept),
                        len(runs),
                        sha256(kept).hexdigest(),
                    )
                )
            if rows:
                columns = list(zip(*rows))
                types = (*[pa.int64()] * 4, pa.string())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, types)],
                    [field.split()[0] for field in _REMOVED.split(", ")],
                )

    return run


def repeated_ranges(texts: DataFrame, length: int = LENGTH, crowd: int = CROWD) -> DataFrame:
    """Runs of repeated windows of ``texts`` (``doc``, ``tag``, ``text``)."""
    order = ["anchor", "digest1", "digest2", "doc", "tag", "start"]
    with shuffles_dropped(texts.sparkSession):
        found = staged(
            texts.mapInArrow(_find_stretches(length), _STRETCHES)
            .repartition("anchor")
            .sortWithinPartitions(*order)
            .mapInArrow(_meet_stretches, _FOUND),
            "stretches",
        )
    different = found.filter("NOT repeated")
    crowded = (
        different.groupBy("anchor").agg(row_count().alias("rows")).filter(F.col("rows") > crowd)
    )
    wanted = (
        different.join(crowded, "anchor", "left")
        .withColumn("crowded", F.col("rows").isNotNull())
        .groupBy("doc", "tag")
        .agg(F.collect_list(F.struct("anchor", "start", "shape", "crowded")).alias("wanted"))
    )
    by_suffix = (
        texts.join(wanted, ["doc", "tag"])
        .select("doc", "tag", "text", "wanted")
        .mapInArrow(_cut_stretches(length), _BYTES)
        .repartition("anchor")
        .sortWithinPartitions("anchor", "doc", "tag", "start")
        .mapInArrow(_sort_stretches(length), _RANGES)
    )
    copies = found.filter("repeated").withColumn("n", F.col("shape") % length)
    return copies.select("doc", "tag", "start", "n").unionByName(by_suffix)


def remove_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    crowd: int = CROWD,
) -> DataFrame:
    """One row per document: ``id``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256``."""
    text = text_or_empty(text_col)
    texts = docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("doc"),
        F.crc32(text.cast("binary")).alias("tag"),
        text.alias("text"),
    )
    ranges = (
        repeated_ranges(texts, length, crowd)
        .groupBy("doc", "tag")
        .agg(F.collect_list(F.struct("start", "n")).alias("ranges"))
    )
    return (
        texts.join(ranges, ["doc", "tag"], "left")
        .select("doc", "text", "ranges")
        .mapInArrow(_summarise(length), _REMOVED)
    )
