"""Packing by concatenate and cut.

The documents' ids, each document ended by ``end_id``, form one stream that is cut
every ``length`` ids. The first pass encodes and keeps, per document, its ids and
how many ids its partition had before it. Partition totals are summed up to global
offsets. The second pass cuts every document where its place in the stream crosses
a window's end. Windows that lie in one task are complete there; the windows at
the edges of a task leave boundary records, and only these are shuffled to put
sequences together.

Encoding is done per unit, the white space before a word with the word: the
splitting pattern of byte-level vocabularies never looks back, so a unit encodes
alone as it does in its text. Each task keeps the ids of a bounded number of units.
A text is first cut at the strings of special tokens, which become their ids as the
tokenizer has it; the stretches between are encoded like texts of their own.

Defined results: a NULL or empty text is its end id alone; repeated rows are packed
each; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tenureframe.llm.common import LONG_NAME, forget, forget_long, portions, staged, text_or_empty

LENGTH = 2048
END_ID = 1

# What the vocabulary's pattern takes for white space.
SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_UNIT = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")
# White space other than blanks and line ends.
_OTHER = re.compile("[\t\x0b-\r\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")

# Marks that may follow a letter; an apostrophe is left out, as it may take letters along.
MARKS = ".,;:!?"

_STORED = "part int, id long, before long, n_tokens long, ids binary"
_PIECES = (
    "id long, start long, length long, ids binary, doc_tokens long, "
    "sequence_id long, offset long"
)


class Words:
    """Names with their ids, in Arrow and numpy: few bytes each, looked up many at a time."""

    def __init__(self, dtype: np.dtype):
        self.names = pa.array([], pa.large_string())
        self.ids = np.empty(0, dtype)
        self.sizes = np.empty(0, np.int64)

    def __len__(self) -> int:
        return len(self.names)

    def places(self, names: pa.Array) -> np.ndarray:
        """Where each name is; -1 where it is not."""
        return pc.index_in(names, value_set=self.names).fill_null(-1).to_numpy()

    def add(self, names: pa.Array, ids: np.ndarray, sizes: np.ndarray) -> None:
        self.names = pa.concat_arrays([self.names, names])
        self.ids = np.concatenate((self.ids, ids))
        self.sizes = np.concatenate((self.sizes, sizes))

    def keep(self, wanted: np.ndarray) -> None:
        self.ids = self.ids[np.repeat(wanted, self.sizes)]
        self.names, self.sizes = self.names.filter(pa.array(wanted)), self.sizes[wanted]


class UnitEncoder:
    """Ids of whole texts as little-endian bytes, with a memory of ``remember`` units."""

    def __init__(self, path: str, remember: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # Units hold ordinary text only: special tokens are cut out before.
        self.tokenizer.encode_special_tokens = True
        self.remember = remember
        size = self.tokenizer.get_vocab_size()
        self.dtype = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        # A byte-level vocabulary writes each byte as one character.
        self.id_bytes = np.array([len(self.tokenizer.id_to_token(i) or "") for i in range(size)])
        # By unit, and by word for the usual unit of a blank or line end and a word.
        self.units: dict[str, bytes] = {}
        self.known = Words(self.dtype)
        self.special: dict[str, bytes] = {}
        for id_, token in self.tokenizer.get_added_tokens_decoder().items():
            if token.lstrip or token.rstrip or token.single_word:
                raise ValueError(f"{token.content} takes text around it along")
            self.special[token.content] = np.array([id_], self.dtype).tobytes()
        longest_first = sorted(self.special, key=len, reverse=True)
        self.at_special = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")")

    @property
    def words(self) -> list[str]:
        return self.known.names.to_pylist()

    def _learn_units(self, units: set[str]) -> None:
        new = [unit for unit in units if unit not in self.units]
        found = self.tokenizer.encode_batch_fast(new, add_special_tokens=False)
        self.units.update((n, np.array(e.ids, self.dtype).tobytes()) for n, e in zip(new, found))

    def _learn_each(self, names: pa.Array) -> None:
        """Words encoded as one text and told apart by the number of their bytes: each begins
        with white space and does not end with it, but for a blank or line end alone."""
        alone = pc.is_in(names, value_set=pa.array(["", "\n"], pa.large_string()))
        for name in names.filter(alone).to_pylist():
            self._learn_units({_unit_of(name)})
            ids = np.frombuffer(self.units[_unit_of(name)], self.dtype)
            self.known.add(pa.array([name], pa.large_string()), ids, np.array([len(ids)]))
        names = names.filter(pc.invert(alone))
        if not len(names):
            return
        text = "".join(map(_unit_of, names.to_pylist()))
        (encoding,) = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)
        ids = np.array(encoding.ids, self.dtype)
        ends = np.cumsum(self.id_bytes[ids])
        blank = pc.invert(pc.starts_with(names, "\n")).cast(pa.int64())
        wanted = np.cumsum(pc.add(pc.binary_length(names), blank).to_numpy())
        cuts = np.searchsorted(ends, wanted)
        if (ends[cuts] != wanted).any():
            raise ValueError("an id crosses two units")
        self.known.add(names, ids, np.diff(cuts, prepend=-1))

    def _places(self, names: pa.Array) -> np.ndarray:
        """Where each of the distinct names is among the known words, which learn the new
        ones. A letter and a punctuation mark are never in one id, so a word's last marks go
        apart, and a word that is known without them is not encoded again."""
        stems = pc.utf8_rtrim(names, MARKS)
        letter = pc.utf8_is_alpha(pc.utf8_slice_codeunits(stems, -1))
        longer = pc.greater(pc.binary_length(names), pc.binary_length(stems))
        marked = pc.and_(letter, longer).to_numpy(False)
        stem_at = np.flatnonzero(marked)
        found = self.known.places(pa.concat_arrays([names, stems.take(stem_at)]))
        places, stem_places = found[: len(names)].astype(np.int64), np.full(len(names), -1)
        stem_places[stem_at] = found[len(names) :]
        new = places < 0
        whole, cut = np.flatnonzero(new & ~marked), np.flatnonzero(new & marked)
        fresh = cut[stem_places[cut] < 0]
        wanted = pa.concat_arrays([names.take(whole), stems.take(fresh)])
        before = len(self.known)
        self._learn_each(wanted.unique())
        learned = pc.index_in(wanted, value_set=self.known.names[before:]).to_numpy(False)
        places[whole] = before + learned[: len(whole)]
        stem_places[fresh] = before + learned[len(whole) :]
        if len(cut):
            pairs = zip(names.take(cut).to_pylist(), stems.take(cut).to_pylist())
            marks = [name[len(stem) :] for name, stem in pairs]
            distinct = {mark: at for at, mark in enumerate(dict.fromkeys(marks))}
            self._learn_units(set(distinct))
            parts = np.empty(2 * len(cut), np.int64)
            parts[::2] = stem_places[cut]
            parts[1::2] = [len(self.known) + distinct[mark] for mark in marks]
            ids, sizes = self._gathered([self.units[mark] for mark in distinct], parts)
            places[cut] = len(self.known) + np.arange(len(cut))
            self.known.add(names.take(cut), ids, sizes.reshape(-1, 2).sum(axis=1))
        return places

    def _gathered(self, more: list[bytes], places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids at ``places`` in a row, and their number each; places beyond the known
        words are those of ``more``."""
        width = self.dtype.itemsize
        ids = np.concatenate((self.known.ids, np.frombuffer(b"".join(more), self.dtype)))
        sizes = np.concatenate((self.known.sizes, [len(x) // width for x in more])).astype(np.int64)
        begins = (np.cumsum(sizes) - sizes)[places]
        wanted = sizes[places]
        ends = np.cumsum(wanted)
        total = int(ends[-1]) if len(ends) else 0
        return ids[np.repeat(begins - ends + wanted, wanted) + np.arange(total)], wanted

    def encode_whole(self, texts: list[str]) -> list[bytes]:
        """Every text's ids, with those of the special tokens whose strings are in it."""
        if not any(string in text for string in self.special for text in texts):
            return self.encode_all(texts)
        cut = [self.at_special.split(text) for text in texts]
        ids = iter(self.encode_all([stretch for parts in cut for stretch in parts[::2]]))
        return [
            b"".join(self.special[part] if i % 2 else next(ids) for i, part in enumerate(parts))
            for parts in cut
        ]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Every text's ids as ordinary text; what is new in any of them is encoded first,
        together. Texts of words with one blank or line end before each are cut in Arrow,
        and only their distinct words are looked up."""
        forget(self.units, self.remember)
        if len(self.known) > self.remember:
            # The oldest stay: what is common comes early.
            self.known.keep(np.arange(len(self.known)) < self.remember // 2)
        found: list[bytes] = [b""] * len(texts)
        plain, spaced, cut = [], [], {}
        for at, text in enumerate(texts):
            marked = text.replace("\n", " \n")
            if "  " in marked or "\n " in marked or _OTHER.search(text):
                cut[at] = _UNIT.findall(text)
            else:
                plain.append(at)
                spaced.append(marked)
        # The first word of a text has no blank before it: a unit of its own.
        first = [text.partition(" ")[0] for text in spaced]
        self._learn_units(set(first).union(*cut.values()))
        if plain:
            words = pc.split_pattern(pa.array(spaced, pa.large_string()), " ")
            starts = words.offsets.to_numpy()
            coded = words.flatten().dictionary_encode()
            before = len(self.known)
            places = self._places(coded.dictionary)[coded.indices.to_numpy()]
            places[starts[:-1]] = len(self.known) + np.arange(len(first))
            ids, sizes = self._gathered([self.units[unit] for unit in first], places)
            ends = np.concatenate(([0], np.cumsum(sizes))) * self.dtype.itemsize
            data, bounds = ids.tobytes(), ends[starts].tolist()
            for at, begin, end in zip(plain, bounds, bounds[1:]):
                found[at] = data[begin:end]
            short = pc.less_equal(pc.utf8_length(self.known.names[before:]), LONG_NAME).to_numpy(False)
            if not short.all():
                self.known.keep(np.concatenate((np.ones(before, bool), short)))
        for at, units in cut.items():
            found[at] = b"".join(map(self.units.__getitem__, units))
        forget_long(self.units, [*first, *(unit for units in cut.values() for unit in units)])
        return found


def _unit_of(word: str) -> str:
    return word if word[:1] == "\n" else " " + word


# Units that a task remembers, by default; about 200 bytes each.
REMEMBER = 800_000
_encoders: dict[tuple[str, int], UnitEncoder] = {}


def _encoder(path: str, remember: int = REMEMBER) -> UnitEncoder:
    if (path, remember) not in _encoders:
        _encoders[path, remember] = UnitEncoder(path, remember)
    return _encoders[path, remember]


def _id_type(path: str) -> str:
    return _encoder(path, 1).dtype.str


def encode_documents(
    docs: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = END_ID,
    remember: int = REMEMBER,
) -> DataFrame:
    """First pass: the ids of every document and the ids before it in its partition."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, before = _encoder(path, remember), TaskContext.get().partitionId(), 0
        end = np.array([end_id], encoder.dtype).tobytes()
        for batch in batches:
            texts = portions(batch.column("text").to_pylist())
            ids = [found + end for some in texts for found in encoder.encode_whole(some)]
            sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // encoder.dtype.itemsize
            starts = before + np.cumsum(sizes) - sizes
            before += int(sizes.sum())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(ids), part, np.int32)),
                    batch.column("id"),
                    pa.array(starts),
                    pa.array(sizes),
                    pa.array(ids, pa.binary()),
                ],
                ["part", "id", "before", "n_tokens", "ids"],
            )

    rows = docs.select(
        F.col(id_col).cast("long").alias("id"), text_or_empty(text_col).alias("text")
    )
    return staged(rows.mapInArrow(run, _STORED), "token-ids", compression="zstd")


def with_offsets(encoded: DataFrame) -> DataFrame:
    """Each document's first place in the stream, from sums over partition totals.

    There is one total per partition, so the window without a key is small; as a
    stored table it is broadcast only below Spark's own size limit.
    """
    totals = encoded.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    up_to = F.sum("total").over(Window.orderBy("part"))
    offsets = staged(totals.select("part", (up_to - F.col("total")).alias("offset")), "offsets")
    return encoded.join(offsets, "part").select(
        "id", (F.col("offset") + F.col("before")).alias("start"), "n_tokens", "ids"
    )


def _cutter(dtype: str, length: int):
    """Second pass: one row per document and window, ids as unsigned 32-bit integers."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            columns = (batch.column(c).to_pylist() for c in ("id", "start", "n_tokens", "ids"))
            for id_, start, n_tokens, stored in zip(*columns):
                ids = np.frombuffer(stored, dtype).astype("<u4")
                at = 0
                while at < n_tokens:
                    sequence, offset = divmod(start + at, length)
                    size = min(length - offset, n_tokens - at)
                    piece = ids[at : at + size].tobytes()
                    rows.append((id_, at, size, piece, n_tokens, sequence, offset))
                    at += size
            names = ("id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset")
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(column, pa.binary() if name == "ids" else pa.int64())
                        for name, column in zip(names, zip(*rows))
                    ],
                    names,
                )

    return run


def packed_pieces(
    docs: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    end_id: int = END_ID,
    remember: int = REMEMBER,
) -> DataFrame:
    """All pieces of all documents with their ids and their place in the sequences."""
    encoded = encode_documents(docs, path, id_col, text_col, end_id, remember)
    return with_offsets(encoded).mapInArrow(_cutter(_id_type(path), length), _PIECES)


def packed_sequences(
    docs: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    end_id: int = END_ID,
    remember: int = REMEMBER,
) -> DataFrame:
    """Sequences (``sequence_id``, ``ids``, ``doc_ids``, ``length``) of all documents.

    Documents are cut and their pieces joined in one task. Runs of pieces that fill a
    window leave as they are; boundary records, the runs that do not, are put together
    by sequence.
    """
    schema = "sequence_id long, offset long, length long, ids binary, doc_ids array<long>"
    encoded = encode_documents(docs, path, id_col, text_col, end_id, remember)
    cut = _cutter(_id_type(path), length)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in cut(batches):
            runs: list[list] = []
            columns = ("sequence_id", "offset", "length", "ids", "id")
            for sequence, offset, size, ids, id_ in zip(
                *(batch.column(c).to_pylist() for c in columns)
            ):
                last = runs[-1] if runs else None
                if last and last[0] == sequence and last[1] + last[2] == offset:
                    last[2] += size
                    last[3].append(ids)
                    last[4].append(id_)
                else:
                    runs.append([sequence, offset, size, [ids], [id_]])
            if runs:
                sequence, offset, size, ids, doc_ids = zip(*runs)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(sequence, pa.int64()),
                        pa.array(offset, pa.int64()),
                        pa.array(size, pa.int64()),
                        pa.array([b"".join(x) for x in ids], pa.binary()),
                        pa.array(doc_ids, pa.list_(pa.int64())),
                    ],
                    ["sequence_id", "offset", "length", "ids", "doc_ids"],
                )

    runs = with_offsets(encoded).mapInArrow(run, schema)
    whole = runs.filter(F.col("length") == length).drop("offset")
    # At most ``length`` records meet here, with ``length`` ids together.
    ordered = F.array_sort(F.collect_list(F.struct("offset", "ids", "doc_ids")))
    merged = (
        runs.filter(F.col("length") < length)
        .groupBy("sequence_id")
        .agg(F.sum("length").alias("length"), ordered.alias("runs"))
        .select(
            "sequence_id",
            "length",
            F.aggregate("runs.ids", F.lit(b""), lambda a, b: F.concat(a, b)).alias("ids"),
            F.flatten("runs.doc_ids").alias("doc_ids"),
        )
    )
    return whole.unionByName(merged)
