"""Source divergence audit with late string materialization.

How far is the vocabulary of one source from that of the others in its language, and
which terms set it apart? Terms are counted in the tasks per language and source, and
written there once. What is shuffled from then on are digests of fixed width with
counts; texts stay where they were written. A language keeps digests that enough of its
documents have (a digest that two terms share has no fewer documents than either). For
kept digests only, the smallest and the largest text are found: where they differ, terms
have collided, and the counts of that digest are split by text. All later steps use the
digest (with the text where it was split), and texts are joined back for the rows of the
result.

Shares are whole numbers: ``1 + floor(SCALE * (count + PRIOR) / (N + PRIOR * V))``.
Distances between sources are summed without pairing rows: terms are dealt to tasks by
digest, a task holds one term's shares of up to ``2 * block`` sources as a vector, and
adds up absolute differences of all pairs in a matrix. More sources than ``block`` are
dealt into cells of two blocks. A pair's terms that neither source has add up to a
product, so only terms that occur are visited.

Defined results: NULL text, language or source is empty; a document without terms counts
for its group only; repeated rows count as documents each, whatever their id; a language
without kept terms has distances of zero and no term rows; a language with one source has
no pairs; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tenureframe.functions import row_count
from tenureframe.llm.common import staged, text_or_empty

# Letters are A to Z, lower-cased, and every byte from 0x80; the rest parts.
_TERM_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
SCALE = 1_000_000_000
PRIOR = 5
LEAST_DOCUMENTS = 30
TOP_TERMS = 50
# Sources in a block of the distance matrix, and parts over which a cell's terms are dealt:
# each part gives one row for every pair of the cell.
BLOCK = 256
PARTS = 32
# Distinct terms that a task holds at once.
HELD_TERMS = 400_000
DIGEST_BITS = 64
# Kept digests travel to the texts up to this number (about 30 bytes each), beyond it both
# are shuffled.
BROADCAST_ROWS = 1_000_000

_PORTION = "lang string, source string, term string, n long, docs long, first boolean"


def _count_terms(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents of each term by language and source, per portion of
    the input; one row without a term for each group. ``first`` marks one row for each
    term of a language, so that a portion gives each text away once."""
    seen: dict[tuple, Counter] = {}
    documents: dict[tuple, Counter] = {}

    def portion() -> Iterator[pa.RecordBatch]:
        given: dict[str, set[bytes]] = {}
        for (lang, source), counts in seen.items():
            docs = documents[lang, source]
            terms = [None, *(term.decode("utf-8", "replace") for term in counts)]
            known = given.setdefault(lang, set())
            first = [False, *(term not in known for term in counts)]
            known.update(counts)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * len(terms), pa.string()),
                    pa.array([source] * len(terms), pa.string()),
                    pa.array(terms, pa.string()),
                    pa.array([0, *counts.values()], pa.int64()),
                    pa.array([0, *map(docs.__getitem__, counts)], pa.int64()),
                    pa.array(first, pa.bool_()),
                ],
                ["lang", "source", "term", "n", "docs", "first"],
            )
        seen.clear()
        documents.clear()

    for batch in batches:
        columns = [batch.column(name).to_pylist() for name in ("lang", "source", "text")]
        for lang, source, text in zip(*columns):
            terms = text.translate(_TERM_BYTES).split()
            group = (lang, source)
            if group not in seen:
                seen[group], documents[group] = Counter(), Counter()
            seen[group].update(terms)
            documents[group].update(set(terms))
        if sum(map(len, seen.values())) + 100 * len(seen) > HELD_TERMS:
            yield from portion()
    yield from portion()


def _share(count: Column) -> Column:
    """A term's share of its group, ``count`` of ``total`` with ``terms`` kept, exactly."""
    scaled = (count + F.lit(PRIOR)).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)")
    whole = (F.col("total") + F.lit(PRIOR) * F.col("terms")).cast("decimal(20,0)")
    return ((scaled - scaled % whole) / whole + 1).cast("long")


def kept_counts(
    docs: DataFrame,
    lang_col: str = "lang",
    source_col: str = "source",
    text_col: str = "text",
    least_documents: int = LEAST_DOCUMENTS,
    digest_bits: int = DIGEST_BITS,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Three tables: ``counts`` (lang, source, digest, split, n) of the kept terms,
    ``names`` (lang, digest, split, term) of them, and ``groups`` (lang, source).

    ``split`` is empty but for digests that several terms share, where it is the term.
    A lower ``digest_bits`` makes such digests more frequent, for tests.
    """
    rows = docs.select(
        text_or_empty(lang_col).alias("lang"),
        text_or_empty(source_col).alias("source"),
        text_or_empty(text_col).cast("binary").alias("text"),
    )
    portions = staged(rows.mapInArrow(_count_terms, _PORTION), "portions")
    digest = F.shiftrightunsigned(F.xxhash64("term"), 64 - digest_bits)
    terms = portions.filter("term IS NOT NULL").withColumn("digest", digest)

    groups = portions.filter("term IS NULL").select("lang", "source").distinct()
    totals = staged(
        terms.groupBy("lang", "source", "digest").agg(
            F.sum("n").alias("n"), F.sum("docs").alias("docs")
        ),
        "totals",
    )
    enough = F.sum("docs") >= least_documents
    frequent = totals.groupBy("lang", "digest").agg(enough.alias("kept")).filter("kept").drop("kept")
    frequent = staged(frequent, "frequent")
    if frequent.count() <= BROADCAST_ROWS:
        frequent = F.broadcast(frequent)
    edges = staged(
        terms.filter("first")
        .select("lang", "digest", "term")
        .join(frequent, ["lang", "digest"], "left_semi")
        .groupBy("lang", "digest")
        .agg(F.min("term").alias("low"), F.max("term").alias("high")),
        "edges",
    )
    collided = edges.filter("low <> high").select("lang", "digest")
    names = edges.filter("low = high").select(
        "lang", "digest", F.lit("").alias("split"), F.col("low").alias("term")
    )
    counts = totals.join(names.drop("term"), ["lang", "digest"]).select(
        "lang", "source", "digest", "split", "n"
    )
    # Hardly ever with 64 bits; without any, the texts of all terms need not be read again.
    if not collided.isEmpty():
        parted = (
            terms.join(collided, ["lang", "digest"], "left_semi")
            .groupBy("lang", "source", "digest", F.col("term").alias("split"))
            .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
        )
        own = parted.groupBy("lang", "digest", "split").agg(enough.alias("kept"))
        own = own.filter("kept").drop("kept")
        parted = parted.join(own, ["lang", "digest", "split"], "left_semi")
        counts = counts.unionByName(parted.drop("docs"))
        names = names.unionByName(own.withColumn("term", F.col("split")))
    return staged(counts, "kept"), staged(names, "names"), staged(groups, "groups")


class _Cell:
    """Sums of absolute differences of all pairs of sources in two blocks."""

    def __init__(self, key: tuple, block: int):
        self.lang, self.first, self.second, _ = key
        self.block = block
        # Shares of a term that a source does not have, by block.
        self.none: tuple[list[int], list[int]] = [], []
        self.sums: np.ndarray | None = None
        self.term, self.here = None, 0

    def _in_second(self, number: int) -> bool:
        return self.first != self.second and (number - 1) // self.block == self.second

    def head(self, number: int, share: int) -> None:
        self.none[self._in_second(number)].append(share)

    def start(self) -> None:
        """All heads are there: before the first term, or at the end of a cell without."""
        left, right = (np.array(shares, np.int64) for shares in self.none)
        self.left = len(left)
        self.plain = np.concatenate((left, right))
        right = left if self.first == self.second else right
        self.base = np.abs(left[:, None] - right[None, :])
        self.sums = np.zeros(self.base.shape, np.int64)
        self.waiting = np.tile(self.plain, (max(1, 2**20 // max(1, len(self.plain))), 1))

    def put(self, term: tuple, number: int, share: int) -> None:
        if self.sums is None:
            self.start()
        if term != self.term:
            if self.here == len(self.waiting):
                self.add()
            self.term, self.here = term, self.here + 1
        at = (number - 1) % self.block + (self.left if self._in_second(number) else 0)
        self.waiting[self.here - 1, at] = share

    def add(self) -> None:
        """The waiting terms join the sums, a few at a time for bounded memory."""
        left = self.waiting[: self.here, : self.left]
        right = left if self.first == self.second else self.waiting[: self.here, self.left :]
        step = max(1, 2**21 // max(1, self.sums.size))
        for at in range(0, self.here, step):
            apart = left[at : at + step, :, None] - right[at : at + step, None, :]
            self.sums += np.abs(apart).sum(axis=0)
        self.sums -= self.here * self.base
        self.waiting[: self.here] = self.plain
        self.term, self.here = None, 0

    def result(self) -> pa.RecordBatch:
        if self.sums is None:
            self.start()
        self.add()
        wanted = np.ones(self.sums.shape, bool)
        u, v = np.nonzero(np.triu(wanted, 1) if self.first == self.second else wanted)
        columns = [
            pa.array([self.lang] * len(u), pa.string()),
            pa.array(self.first * self.block + u + 1),
            pa.array(self.second * self.block + v + 1),
            pa.array(self.sums[u, v]),
        ]
        return pa.RecordBatch.from_arrays(columns, ["lang", "u", "v", "apart"])


def _distances(block: int):
    """Each cell's sums; rows come sorted by cell and term, heads before terms."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, cell = None, None
        for batch in batches:
            columns = [batch.column(name).to_pylist() for name in _ENTRY]
            for *found, digest, split, number, share in zip(*columns):
                if found != key:
                    if cell:
                        yield cell.result()
                    key, cell = found, _Cell(found, block)
                if digest is None:
                    cell.head(number, share)
                else:
                    cell.put((digest, split), number, share)
        if cell:
            yield cell.result()

    return run


_ENTRY = ("lang", "first", "second", "salt", "digest", "split", "number", "p")


def pair_distances(
    shares: DataFrame, sources: DataFrame, block: int = BLOCK, parts: int = PARTS
) -> DataFrame:
    """Per language and pair of source numbers (``u`` < ``v``) the distance over the
    terms that occur, beyond that of as many terms which neither source has.

    ``sources`` has (lang, number, last, none): numbers from 1, the language's last
    number, and the share of a term that the source does not have (NULL: no terms).
    ``shares`` has (lang, digest, split, number, last, p) of terms that occur.
    """
    def block_of(number: str) -> Column:
        return F.floor((F.col(number) - 1) / block).cast("int")

    def cells(df: DataFrame, salt: Column) -> DataFrame:
        """Each row goes to its block's cell with every block."""
        other = F.explode(F.sequence(F.lit(0), block_of("last"))).alias("other")
        return df.withColumn("own", block_of("number")).select("*", other).select(
            "lang",
            F.least("own", "other").alias("first"),
            F.greatest("own", "other").alias("second"),
            salt.alias("salt"),
            "digest",
            "split",
            F.col("number").cast("long"),
            "p",
        )

    heads = sources.select(
        "lang", "number", "last", F.coalesce("none", F.lit(0).cast("long")).alias("p"),
        F.lit(None).cast("long").alias("digest"), F.lit("").alias("split"),
    )
    every = F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    entries = cells(shares, F.pmod(F.xxhash64("digest", "split"), F.lit(parts)).cast("int"))
    group = ["lang", "first", "second", "salt"]
    return (
        entries.unionByName(cells(heads, every))
        .repartition(*group)
        .sortWithinPartitions(*group, "digest", "split", "number")
        .mapInArrow(_distances(block), "lang string, u long, v long, apart long")
        .groupBy("lang", "u", "v")
        .agg(F.sum("apart").alias("apart"))
    )


def source_divergence(
    docs: DataFrame,
    lang_col: str = "lang",
    source_col: str = "source",
    text_col: str = "text",
    least_documents: int = LEAST_DOCUMENTS,
    top_terms: int = TOP_TERMS,
    block: int = BLOCK,
    digest_bits: int = DIGEST_BITS,
) -> DataFrame:
    """Rows (lang, source, part, item, value, rank).

    Part ``pair``: the distance to each other source of the language. Part ``term``: the
    terms that the source has more of than its language, by how much, the first
    ``top_terms``.
    """
    counts, names, groups = kept_counts(
        docs, lang_col, source_col, text_col, least_documents, digest_bits
    )
    term = ["lang", "digest", "split"]
    in_lang = counts.groupBy(*term).agg(F.sum("n").alias("lang_n"))
    langs = in_lang.groupBy("lang").agg(row_count().alias("terms"), F.sum("lang_n").alias("lang_total"))
    sums = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    number = F.row_number().over(Window.partitionBy("lang").orderBy("source"))
    last = row_count().over(Window.partitionBy("lang"))
    zero = F.lit(0).cast("long")
    sources = staged(
        groups.join(sums, ["lang", "source"], "left")
        .join(langs, "lang", "left")
        .withColumns({"total": F.coalesce("total", zero), "number": number, "last": last})
        .withColumn("none", F.when(F.col("terms") > 0, _share(zero))),
        "sources",
    )
    shares = staged(
        counts.join(sources.drop("none", "lang_total"), ["lang", "source"])
        .withColumn("p", _share(F.col("n")))
        .select(*term, "source", "number", "last", "p"),
        "shares",
    )

    found = pair_distances(shares, sources, block)
    pairs = found.unionByName(
        found.select("lang", F.col("v").alias("u"), F.col("u").alias("v"), "apart")
    )
    mine = sources.select("lang", F.col("number").alias("u"), "source", "terms", "none")
    others = sources.select(
        "lang", F.col("number").alias("v"), F.col("source").alias("item"), F.col("none").alias("other")
    )
    beyond = F.coalesce(F.col("terms") * F.abs(F.col("none") - F.col("other")), zero)
    pairs = (
        pairs.join(mine, ["lang", "u"])
        .join(others, ["lang", "v"])
        .select("lang", "source", F.lit("pair").alias("part"), "item", (F.col("apart") + beyond).alias("value"))
    )

    whole = langs.withColumnRenamed("lang_total", "total")
    usual = in_lang.join(whole, "lang").select(*term, _share(F.col("lang_n")).alias("q"))
    group = Window.partitionBy("lang", "source")
    # Texts come back for the first ranks alone; ties at the last rank are settled by text.
    ahead = (
        shares.join(usual, term)
        .filter("p > q")
        .select(*term, "source", (F.col("p") - F.col("q")).alias("value"))
        .withColumn("place", F.rank().over(group.orderBy(F.col("value").desc())))
        .filter(F.col("place") <= top_terms)
        .join(names, term)
        .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value")
    )
    place = F.row_number().over(
        Window.partitionBy("lang", "source", "part").orderBy(F.col("value").desc(), "item")
    )
    ranked = pairs.unionByName(ahead).withColumn("rank", place)
    return ranked.filter((F.col("part") == "pair") | (F.col("rank") <= top_terms))
