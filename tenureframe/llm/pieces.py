"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies.

A text is cut into units: a run of blanks with the word that follows, and again
before each line end. No piece of a fitting vocabulary crosses such a cut, so units
are encoded one by one, and their ids are remembered up to a bounded number. Within
a unit, adjacent symbol pairs that form a piece wait in an agenda ordered by score,
then from left to right; the best pair is merged and its new neighbours join the
agenda: a heap, or in a short unit the list of its pairs. Symbols are numbers, and the
pairs that form a piece are looked up by both. Characters without a piece become byte
pieces. In every Arrow batch the units that are new to the task are also given to the
sentencepiece library, and a difference in ids or decoded text raises an error. Ids of
a unit are decoded when it is learned; a decoded text is remembered where it is not the
unit's own.

Defined results: a NULL or empty text has no ids and decodes to the empty text;
repeated rows are encoded each; an empty table gives an empty result; further
columns are ignored.
"""

from __future__ import annotations

import heapq
import re
from hashlib import sha256
from itertools import pairwise

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenureframe.llm.common import LONG_NAME, forget, forget_long, per_batch, portions, text_or_empty

BLANK = "▁"
_CROSSING = re.compile(f"[^{BLANK}]{BLANK}|\n")
_UNIT = re.compile(f"\n[^{BLANK}\n]*|{BLANK}+[^{BLANK}\n]*")
_UNUSUAL = re.compile(f"{BLANK}|^ |  | \n| $")
_BYTE = re.compile(r"<0x([0-9A-F]{2})>")
_ENCODED = "id long, ids array<int>, decoded string"
_DIGESTS = "id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
# Symbols are ids of pieces, or code points counted on from there; two make a pair's key.
SYMBOL_BITS = 21
# Up to this many symbols, the agenda is the list of pairs, and beyond it a heap.
SHORT = 40


class _Characters(dict):
    """Symbols of characters; one without a piece is counted on from the last id."""

    def __init__(self, ids: dict[str, int], size: int):
        super().__init__({piece: i for piece, i in ids.items() if len(piece) == 1})
        self.size = size

    def __missing__(self, character: str) -> int:
        return self.size + ord(character)


class PieceEncoder:
    """Encodes and decodes whole texts with a memory of ``remember`` units."""

    def __init__(self, path: str, remember: int = 700_000):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        size = self.library.get_piece_size()
        self.pieces = [self.library.id_to_piece(i) for i in range(size)]
        self.byte_ids: dict[int, int] = {}
        self.byte_of: dict[int, int] = {}
        self.ids: dict[str, int] = {}
        score: dict[str, float] = {}
        for i, piece in enumerate(self.pieces):
            if self.library.is_byte(i):
                value = int(_BYTE.fullmatch(piece)[1], 16)
                self.byte_ids[value], self.byte_of[i] = i, value
            elif not (self.library.is_control(i) or self.library.is_unknown(i)):
                self.ids[piece] = i
                score[piece] = self.library.get_score(i)
        self.size = size
        self.decimal = [str(i) for i in range(size)]
        self.spelled = [
            bytes([self.byte_of[i]]) if i in self.byte_of else piece.replace(BLANK, " ").encode()
            for i, piece in enumerate(self.pieces)
        ]
        self.characters = _Characters(self.ids, size)
        self._learn_pairs(score)
        if crossing := next(filter(_CROSSING.search, self.ids), None):
            raise ValueError(f"a piece crosses the cuts between units: {crossing!r}")
        if len(self.byte_ids) != 256 or self.library.encode("a  b ") != self.merge(
            f"{BLANK}a{BLANK}{BLANK}b{BLANK}"
        ):
            raise ValueError("the model must keep blanks, add one in front, and have byte pieces")
        # Two characters that stand together in no piece part a unit further.
        self.together = {pair for piece in self.ids for pair in pairwise(piece)}
        self.remember = remember
        # By unit: ids as text, and the decoded text if it is not the unit's own; by part of
        # a unit: ids.
        self.known: dict[str, str] = {}
        self.shown: dict[str, str] = {}
        self.parts: dict[str, list[int]] = {}

    def _symbol(self, text: str) -> int | None:
        return self.characters[text] if len(text) == 1 else self.ids.get(text)

    def _learn_pairs(self, score: dict[str, float]) -> None:
        """Rank and merged symbol of every two symbols that form a piece."""
        place = {x: i for i, x in enumerate(sorted(set(score.values()), reverse=True))}
        self.never = len(place)
        self.rank: dict[int, int] = {}
        self.merged: dict[int, int] = {}
        for piece, i in self.ids.items():
            for cut in range(1, len(piece)):
                a, b = self._symbol(piece[:cut]), self._symbol(piece[cut:])
                if a is not None and b is not None:
                    key = a << SYMBOL_BITS | b
                    self.rank[key], self.merged[key] = place[score[piece]], i

    def unit_ids(self, unit: str) -> list[int]:
        """Ids of one unit, part by part; parts that are known are not merged again."""
        ids: list[int] = []
        start = 0
        apart = map(self.together.__contains__, pairwise(unit))
        for i in [i for i, inside in enumerate(apart, 1) if not inside]:
            ids += self._part_ids(unit[start:i])
            start = i
        return ids + self._part_ids(unit[start:])

    def _part_ids(self, part: str) -> list[int]:
        ids = self.parts.get(part)
        if ids is None:
            ids = self.merge(part)
            if len(part) <= LONG_NAME:
                self.parts[part] = ids
        return ids

    def merge(self, unit: str) -> list[int]:
        """Ids of adjacent symbols, by the agenda of their pairs."""
        symbols = [*map(self.characters.__getitem__, unit)]
        symbols = self._merge_short(symbols) if len(symbols) <= SHORT else self._merge_long(symbols)
        if max(symbols, default=0) < self.size:
            return symbols
        ids: list[int] = []
        for symbol in symbols:
            if symbol < self.size:
                ids.append(symbol)
            else:
                ids.extend(self.byte_ids[x] for x in chr(symbol - self.size).encode())
        return ids

    def _merge_short(self, symbols: list[int]) -> list[int]:
        """The agenda is the list of the pairs' ranks; the first of the best is merged."""
        rank, never, merged = self.rank.get, self.never, self.merged
        agenda = [rank(a << SYMBOL_BITS | b, never) for a, b in pairwise(symbols)]
        # The last symbol has no pair; its entry is never the best.
        agenda.append(never)
        while (best := min(agenda)) != never:
            i = agenda.index(best)
            new = symbols[i] = merged[symbols[i] << SYMBOL_BITS | symbols.pop(i + 1)]
            del agenda[i]
            if i + 1 < len(symbols):
                agenda[i] = rank(new << SYMBOL_BITS | symbols[i + 1], never)
            if i:
                agenda[i - 1] = rank(symbols[i - 1] << SYMBOL_BITS | new, never)
        return symbols

    def _merge_long(self, symbols: list[int]) -> list[int]:
        """The agenda is a heap; entries of pairs that are no more are passed over."""
        rank, gone = self.rank, -1
        after = list(range(1, len(symbols) + 1))
        before = list(range(-1, len(symbols) - 1))
        agenda = []
        for i, (a, b) in enumerate(pairwise(symbols)):
            key = a << SYMBOL_BITS | b
            if key in rank:
                agenda.append((rank[key], i, i + 1, key))
        heapq.heapify(agenda)
        while agenda:
            _, left, right, key = heapq.heappop(agenda)
            # Either side may have been merged into another pair meanwhile.
            if symbols[left] == gone or symbols[left] << SYMBOL_BITS | symbols[right] != key:
                continue
            symbols[left], symbols[right] = self.merged[key], gone
            following = after[left] = after[right]
            if following < len(symbols):
                before[following] = left
                key = symbols[left] << SYMBOL_BITS | symbols[following]
                if key in rank:
                    heapq.heappush(agenda, (rank[key], left, following, key))
            previous = before[left]
            if previous >= 0:
                key = symbols[previous] << SYMBOL_BITS | symbols[left]
                if key in rank:
                    heapq.heappush(agenda, (rank[key], previous, left, key))
        return [symbol for symbol in symbols if symbol != gone]

    def decode(self, ids: list[int]) -> str:
        """The text of the ids, the blank that encoding puts in front included."""
        return b"".join(map(self.spelled.__getitem__, ids)).decode("utf-8", "replace")

    def units(self, text: str) -> list[str]:
        """Units as they are, or the bare word where one blank stands before it."""
        if not text:
            return []
        if _UNUSUAL.search(text):
            return _UNIT.findall(BLANK + text.replace(" ", BLANK))
        return text.replace("\n", " \n").split(" ")

    def learn(self, new: list[str]) -> None:
        """Encode new units, and hold ids and texts against the library's."""
        # The library puts a blank in front; a unit that starts with a line end has none.
        plain = [n[1:].replace(BLANK, " ") if n[:1] == BLANK else n for n in new]
        expected = self.library.encode(plain, num_threads=1)
        texts = self.library.decode(expected, num_threads=1) if expected else []
        blank, decimal = self.ids[BLANK], self.decimal.__getitem__
        for name, given, told, text in zip(new, plain, expected, texts):
            starts_line = name[:1] == "\n"
            ids = self.unit_ids(name if starts_line or name[:1] == BLANK else BLANK + name)
            shown = self.decode(ids)
            with_blank = [blank, *ids] if starts_line else ids
            back = shown if starts_line else shown[1:]
            # An empty text has no ids; a unit of nothing but one blank has the blank's.
            if not (told or back) and ids == [blank]:
                told = ids
            if told != with_blank or text != back:
                raise ValueError(f"ids differ from the library's for {name!r}")
            self.known[name] = ",".join(map(decimal, ids))
            if back != given:
                self.shown[name] = shown

    def encode_batch(self, texts: list[str]) -> tuple[list[str], list[str]]:
        """Ids as decimal numbers joined by commas, and decoded texts."""
        cut = [self.units(text) for text in texts]
        names = set().union(*cut)
        if len(self.known) > self.remember:
            forget(self.known, self.remember)
            self.shown = {name: text for name, text in self.shown.items() if name in self.known}
        forget(self.parts, self.remember)
        new = sorted(names.difference(self.known))
        if new:
            self.learn(new)
        ids = [",".join(map(self.known.__getitem__, units)) for units in cut]
        decoded = [self._decoded(text, units) for text, units in zip(texts, cut)]
        forget_long(self.known, new)
        forget_long(self.shown, new)
        return ids, decoded

    def _decoded(self, text: str, units: list[str]) -> str:
        """The units' decoded texts, put together."""
        shown = self.shown
        if shown and not shown.keys().isdisjoint(units):
            return "".join(shown[u] if u in shown else self._own(u) for u in units)[1:]
        return text.replace(BLANK, " ")

    @staticmethod
    def _own(unit: str) -> str:
        return unit.replace(BLANK, " ") if unit[:1] in (BLANK, "\n") else " " + unit


_encoders: dict[str, PieceEncoder] = {}


def _encoder(path: str) -> PieceEncoder:
    if path not in _encoders:
        _encoders[path] = PieceEncoder(path)
    return _encoders[path]


def _over_texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(
        F.col(id_col).cast("long").alias("id"), text_or_empty(text_col).alias("text")
    )


def encode_pieces(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: ``id``, its ``ids`` and the text ``decoded`` from them."""

    def convert(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, decoded = [], []
        for texts in portions(batch.column("text").to_pylist()):
            found, back = _encoder(path).encode_batch(texts)
            ids += [[int(i) for i in x.split(",")] if x else [] for x in found]
            decoded += back
        return pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array(ids, pa.list_(pa.int32())), pa.array(decoded, pa.string())],
            ["id", "ids", "decoded"],
        )

    return _over_texts(docs, id_col, text_col).mapInArrow(per_batch(convert), _ENCODED)


def piece_digests(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The same encoding and decoding, reduced in the task to counts and digests."""

    def convert(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts, of_ids, of_texts = [], [], []
        for texts in portions(batch.column("text").to_pylist()):
            for ids, text in zip(*_encoder(path).encode_batch(texts)):
                counts.append(ids.count(",") + 1 if ids else 0)
                of_ids.append(sha256(ids.encode()).hexdigest())
                of_texts.append(sha256(text.encode()).hexdigest())
        return pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array(counts, pa.int64()), pa.array(of_ids), pa.array(of_texts)],
            ["id", "n_tokens", "ids_sha256", "decoded_sha256"],
        )

    return _over_texts(docs, id_col, text_col).mapInArrow(per_batch(convert), _DIGESTS)
