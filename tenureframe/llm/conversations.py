"""Conversation structure repair by a grammar-compressed dynamic program.

A turn's part in the repair is one letter: the class of its role's initial and its first
fault. A conversation is then a string of letters, and very many conversations share
strings or long parts of them. Re-Pair replaces the most frequent pairs of neighbouring
symbols by new ones, round after round: pairs are counted in the tasks over all distinct
strings, and a round takes the most frequent pairs that cannot overlap. Each symbol has
one min-plus transfer matrix: for each state of the role grammar before and after, the
least cost and the audit of the edits, a rope of the audits of the two symbols it stands
for. Matrices are made once, from the bottom of the grammar up, and shared by all
conversations, whose repair is a product of few of them.

Edits: keep (0), change the role to user or assistant (2), delete (3, required for blank
and repeated turns), insert an empty turn before another or at the end (2); a turn that is
cut off and not deleted adds 1. Repaired roles are an optional system turn, then user and
assistant in turn, ending with the assistant; or nothing. Of repairs with equal cost the
one whose audit is least in ASCII is taken. Insertions belong to the turn that follows
them, so audits of equal cost between two states are never prefixes of each other, and
the least of a whole is put together from the least of its parts.

Letters are read from rows sorted by range over conversation, turn, role and digest: one
conversation may spread over many tasks, and its strings are put together from them.
Texts are shuffled once, to apply the audits; they stream through a task in order.

Defined results: a NULL role or text is one space; turns sort NULL first, and turns of one
number by role, then by digest of role and text; a repeated row repeats its turn; a role
with another initial than s, u or a (also an empty one) cannot be kept; conversations with
a NULL id are one; a conversation without rows after damage is repaired at no cost to
nothing; an empty table gives an empty result; further columns are ignored. An audit, a
byte for a turn, is one value of the result and is held whole by one task; the number of
rules bounds the grammar, not the result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tenureframe.functions import row_count
from tenureframe.llm.common import per_batch, staged

# Initials of roles, faults in their order, blanks, ends of sentences, costs.
INITIALS = "sua"
FINE, BLANK, DUPLICATE, TRUNCATED = range(4)
BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"
ENDS = (".", "!", "?")
LEGAL_PAIRS = ("su", "ua", "au")
REROLE, DELETE, INSERT, CUT_OFF = 2, 3, 2, 1

# States of the role grammar: at the start, after a system turn, after a user, after an
# assistant. From each state the next state by role; repairs end at the start or after an
# assistant.
STATES = range(4)
NEXT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
FINAL = (0, 3)
ROLES = {"u": "user", "a": "assistant"}

MAX_RULES = 192
RULES_A_ROUND = 24
# First symbol of a rule: private use of Unicode, with room for 6,400 rules.
FIRST_RULE = 0xE000
REMEMBER = 50_000

Entry = tuple[int, int]
Matrix = list[list[Entry | None]]


def letter(initial: int, fault: int) -> str:
    """The letter of a role class (0 to 3, 3 for other roles) and a fault."""
    return chr(ord("A") + 4 * initial + fault)


LETTERS = [letter(initial, fault) for initial in range(4) for fault in range(4)]


class Ropes:
    """Audits as pairs of shared parts; rope 0 is empty."""

    def __init__(self, nodes: list | None = None):
        self.nodes: list[str | tuple[int, int]] = nodes or [""]

    def leaf(self, text: str) -> int:
        self.nodes.append(text)
        return len(self.nodes) - 1

    def join(self, left: int, right: int) -> int:
        if not left or not right:
            return left or right
        self.nodes.append((left, right))
        return len(self.nodes) - 1

    def _leaves(self, rope: int) -> Iterator[str]:
        waiting = [rope]
        while waiting:
            node = self.nodes[waiting.pop()]
            if isinstance(node, str):
                yield node
            else:
                waiting.extend((node[1], node[0]))

    def text(self, rope: int) -> str:
        return "".join(self._leaves(rope))

    def less(self, one: int, other: int) -> bool:
        """Whether ``one`` comes first; read only up to the first difference."""
        if one == other:
            return False
        left = (sign for leaf in self._leaves(one) for sign in leaf)
        right = (sign for leaf in self._leaves(other) for sign in leaf)
        for a, b in zip(left, right):
            if a != b:
                return a < b
        return next(left, "") < next(right, "")


def _better(ropes: Ropes, new: Entry, old: Entry | None) -> bool:
    return old is None or new[0] < old[0] or (new[0] == old[0] and ropes.less(new[1], old[1]))


def _inserted(state: int) -> Iterator[tuple[int, int]]:
    """States that insertions reach, with their least number; a system turn is none."""
    count, seen = 0, set()
    while state not in seen:
        seen.add(state)
        yield state, count
        step = NEXT[state]
        state, count = step["u"] if "u" in step else step["a"], count + 1


def letter_matrix(ropes: Ropes, sign: str) -> Matrix:
    """Costs and audits of one turn, with insertions before it, from state to state."""
    initial, fault = divmod(ord(sign) - ord("A"), 4)
    own = INITIALS[initial : initial + 1]
    extra = CUT_OFF if fault == TRUNCATED else 0
    matrix: Matrix = [[None for _ in STATES] for _ in STATES]
    for start in STATES:
        for state, count in _inserted(start):
            edits = [(DELETE, state, "D")]
            if fault not in (BLANK, DUPLICATE):
                edits += [(extra, to, "K") for role, to in NEXT[state].items() if role == own]
                edits += [(REROLE + extra, to, "R") for role, to in NEXT[state].items() if role in ROLES]
            for cost, to, edit in edits:
                new = (cost + INSERT * count, ropes.leaf("I" * count + edit))
                if _better(ropes, new, matrix[start][to]):
                    matrix[start][to] = new
    return matrix


def product(ropes: Ropes, left: Matrix, right: Matrix) -> Matrix:
    """The matrix of two symbols in a row."""
    matrix: Matrix = [[None for _ in STATES] for _ in STATES]
    for start in STATES:
        for end in STATES:
            for middle in STATES:
                a, b = left[start][middle], right[middle][end]
                if a and b:
                    cost, best = a[0] + b[0], matrix[start][end]
                    if best is None or cost <= best[0]:
                        new = (cost, ropes.join(a[1], b[1]))
                        if _better(ropes, new, best):
                            matrix[start][end] = new
    return matrix


class Repairs:
    """The grammar's rules with their matrices, and the repair of strings of letters."""

    def __init__(self, rules: Iterable[str]):
        self.rules = list(rules)
        ropes = Ropes()
        self.matrices = {sign: letter_matrix(ropes, sign) for sign in LETTERS}
        for at, pair in enumerate(self.rules):
            left, right = (self.matrices[sign] for sign in pair)
            self.matrices[chr(FIRST_RULE + at)] = product(ropes, left, right)
        # At the end of a conversation only insertions are left.
        self.end: list[Entry | None] = [None for _ in STATES]
        for start in STATES:
            for state, count in _inserted(start):
                new = (INSERT * count, ropes.leaf("I" * count))
                if state in FINAL and _better(ropes, new, self.end[start]):
                    self.end[start] = new
        self.ropes = ropes.nodes
        self.known: dict[str, tuple] = {}

    def compressed(self, letters: str) -> str:
        for at, pair in enumerate(self.rules):
            if pair in letters:
                letters = letters.replace(pair, chr(FIRST_RULE + at))
        return letters

    def repair(self, letters: str) -> tuple[int, str]:
        """Least cost and its audit: a product of matrices from the last to the first."""
        if letters not in self.known:
            if len(self.known) >= REMEMBER:
                self.known.clear()
            ropes, ahead = Ropes(self.ropes.copy()), self.end
            for symbol in reversed(self.compressed(letters)):
                matrix, best = self.matrices[symbol], [None for _ in STATES]
                for start in STATES:
                    for middle in STATES:
                        a, b = matrix[start][middle], ahead[middle]
                        if a and b and (best[start] is None or a[0] + b[0] <= best[start][0]):
                            new = (a[0] + b[0], ropes.join(a[1], b[1]))
                            if _better(ropes, new, best[start]):
                                best[start] = new
                ahead = best
            cost, rope = ahead[0]
            self.known[letters] = cost, ropes.text(rope)
        return self.known[letters]


def counted(letters: str) -> tuple[int, int, int, int]:
    """Blank, repeated and cut off turns, and neighbours that must not follow each other."""
    faults = [sum(letters.count(letter(i, fault)) for i in range(4)) for fault in (1, 2, 3)]
    classes = [(ord(sign) - ord("A")) // 4 for sign in letters]
    legal = {(INITIALS.index(a), INITIALS.index(b)) for a, b in LEGAL_PAIRS}
    illegal = sum(pair not in legal for pair in zip(classes, classes[1:]))
    return (*faults, illegal)


def learn_rules(
    strings: DataFrame, max_rules: int = MAX_RULES, a_round: int = RULES_A_ROUND
) -> list[str]:
    """Re-Pair over all ``letters``: rules as pairs of symbols, in order.

    Every round counts the pairs of all strings as the rules so far leave them, and
    takes the most frequent ones, of which none can overlap another. Only those reach
    the driver.
    """
    rules: list[str] = []
    while len(rules) < max_rules:
        former = Repairs(rules) if rules else None

        def pairs(batches: Iterable[pa.RecordBatch], former=former) -> Iterator[pa.RecordBatch]:
            found: Counter = Counter()
            for batch in batches:
                for letters in batch.column("letters").to_pylist():
                    symbols = former.compressed(letters) if former else letters
                    for pair in {a + b for a, b in zip(symbols, symbols[1:])}:
                        found[pair] += symbols.count(pair)
            columns = [pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["pair", "n"])

        # As many rows as can be needed: a chosen pair excludes those that share a sign.
        most = (
            strings.mapInArrow(pairs, "pair string, n long")
            .groupBy("pair")
            .agg(F.sum("n").alias("n"))
            .filter("n > 1")
            .orderBy(F.col("n").desc(), "pair")
            .limit(8 * a_round)
            .collect()
        )
        chosen: list[str] = []
        for row in most:
            pair = row["pair"]
            apart = all(pair[0] != other[1] and pair[1] != other[0] for other in chosen)
            if apart and len(chosen) < min(a_round, max_rules - len(rules)):
                chosen.append(pair)
        if not chosen:
            break
        rules += chosen
    return rules


def _id_type(df: DataFrame) -> tuple[pa.DataType, str]:
    """The type of conversation ids, for Arrow and for a schema."""
    kind = df.schema["conv"].dataType
    return to_arrow_type(kind), kind.simpleString()


def _turns(rows: DataFrame, conv: str, turn: str, role: str, text: str, copies: Column) -> DataFrame:
    """Rows as ``conv``, ``turn``, ``role``, ``text``, ``digest`` and ``copies``."""
    space = F.lit(" ")
    named = rows.select(
        F.col(conv).alias("conv"),
        F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role).cast("string"), space).alias("role"),
        F.coalesce(F.col(text).cast("string"), space).alias("text"),
        copies.cast("int").alias("copies"),
    )
    told = F.concat(F.length("role").cast("string"), F.lit(":"), "role", F.lit(":"), "text")
    return named.withColumn("digest", F.unhex(F.sha2(told, 256)))


_ORDER = ("turn", "role", "digest")


def _strings(kind: pa.DataType):
    """From sorted rows, for each conversation in a task: its letters, first and last
    turn, and how many turns differ."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        started, conv, before = False, None, None
        letters: list[str] = []
        turns: list[int] = []
        differ = 0
        done: list[tuple] = []

        def close() -> None:
            if started:
                ends = (turns[0], turns[1]) if turns else (None, None)
                done.append((conv, "".join(letters), *ends, differ))

        def out() -> pa.RecordBatch:
            types = (kind, pa.string(), pa.int64(), pa.int64(), pa.int64())
            columns = [pa.array(list(c), t) for c, t in zip(zip(*done), types)]
            done.clear()
            return pa.RecordBatch.from_arrays(columns, ["conv", "letters", "first", "last", "differ"])

        names = ("conv", "turn", "role", "digest", "copies", "fault", "seen")
        for batch in batches:
            for at, turn, role, digest, copies, fault, seen in zip(
                *(batch.column(name).to_pylist() for name in names)
            ):
                if not started or at != conv:
                    close()
                    started, conv, before = True, at, None
                    letters, turns, differ = [], [], 0
                if not copies:
                    continue
                initial = INITIALS.find(role[0]) if role else -1
                initial = initial if initial >= 0 else 3
                # Equal rows are neighbours: of the first turn, the first one is new.
                new = not seen and before != (turn, role, digest)
                before = (turn, role, digest)
                again = fault if fault == BLANK else DUPLICATE
                letters.append(letter(initial, fault if new else again))
                letters.extend([letter(initial, again)] * (copies - 1))
                if turn is not None and (not turns or turns[1] != turn):
                    differ += 1
                    turns = [turns[0] if turns else turn, turn]
            if len(done) >= 4096:
                yield out()
        close()
        if done:
            yield out()

    return run


def conversation_strings(turns: DataFrame) -> DataFrame:
    """One row per conversation: ``conv``, ``letters`` and ``gaps``."""
    bare = F.rtrim("text", F.lit(BLANKS))
    fault = (
        F.when(bare == "", BLANK).when(~F.right(bare, F.lit(1)).isin(*ENDS), TRUNCATED).otherwise(FINE)
    )
    light = staged(
        turns.select("conv", *_ORDER, "copies", fault.alias("fault")), "turns"
    )
    # Turns that a conversation has said before; few, so the join's small side.
    place = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    said = (
        light.filter("copies > 0")
        .groupBy("conv", "digest")
        .agg(F.min(place).alias("origin"), F.max(place).alias("latest"))
        .filter("origin <> latest")
        .select(F.col("conv").alias("said_in"), F.col("digest").alias("said"), "origin")
    )
    same = (F.col("conv").eqNullSafe(F.col("said_in"))) & (F.col("digest") == F.col("said"))
    seen = F.coalesce(F.col("origin") < place, F.lit(False))
    marked = staged(
        light.join(said, same, "left").select(*light.columns, seen.alias("seen")), "marked"
    )
    arrow, kind = _id_type(marked)
    parts = (
        marked.repartitionByRange("conv", *_ORDER)
        .sortWithinPartitions("conv", *_ORDER)
        .mapInArrow(
            _strings(arrow),
            f"conv {kind}, letters string, first long, last long, differ long",
        )
    )
    parts = parts.withColumn("part", F.monotonically_increasing_id())
    # A conversation cut between two tasks may have one turn in both.
    earlier = F.max("last").over(
        Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    )
    shared = F.when(F.col("first") == earlier, 1).otherwise(0)
    pieces = F.array_sort(F.collect_list(F.struct("part", "letters")))
    gaps = F.max("last") - F.min("first") + 1 - F.sum(F.col("differ") - F.col("shared"))
    return parts.withColumn("shared", shared).groupBy("conv").agg(
        F.array_join(F.transform(pieces, lambda p: p["letters"]), "").alias("letters"),
        F.coalesce(gaps, F.lit(0)).cast("long").alias("gaps"),
    )


def repair_conversations(
    rows: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    copies: Column | None = None,
    max_rules: int = MAX_RULES,
) -> tuple[DataFrame, DataFrame]:
    """Two tables: ``repairs``, one row per conversation (conv, gaps, blank, duplicate,
    truncated, illegal, cost, audit), and ``turns``, the repaired turns (conv, place, edit,
    role, text), in order within their partitions.

    ``copies`` says how often a row stands in its conversation: 0 leaves the row out, but
    not its conversation.
    """
    copies = F.lit(1) if copies is None else copies
    turns = _turns(rows, conv_col, turn_col, role_col, text_col, copies)
    strings = staged(conversation_strings(turns), "strings")
    distinct = staged(strings.groupBy("letters").agg(row_count().alias("n")), "letters")
    repairs = Repairs(learn_rules(distinct.select("letters"), max_rules))

    def evaluate(batch: pa.RecordBatch) -> pa.RecordBatch:
        letters = batch.column("letters").to_pylist()
        found = [(*counted(x), *repairs.repair(x)) for x in letters]
        types = (pa.int64(),) * 5 + (pa.string(),)
        columns = [pa.array(list(c), t) for c, t in zip(zip(*found), types)]
        names = ["blank", "duplicate", "truncated", "illegal", "cost", "audit"]
        return pa.RecordBatch.from_arrays(
            [batch.column("conv"), batch.column("gaps"), *columns], ["conv", "gaps", *names]
        )

    _, kind = _id_type(strings)
    found = strings.mapInArrow(
        per_batch(evaluate),
        f"conv {kind}, gaps long, blank long, duplicate long, truncated long, illegal long, "
        "cost long, audit string",
    )
    found = staged(found, "repairs")
    return found, repaired_turns(turns, found)


def _apply(kind: pa.DataType):
    """Audits applied to sorted rows: a conversation's audit, then its turns."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, audit, at, state, place = None, "", 0, 0, 0
        out: list[tuple] = []

        def insertions() -> None:
            nonlocal at, state, place
            while at < len(audit) and audit[at] == "I":
                role = "u" if "u" in NEXT[state] else "a"
                out.append((conv, place, "I", ROLES[role], ""))
                state, at, place = NEXT[state][role], at + 1, place + 1

        def take(role: str, text: str) -> None:
            nonlocal at, state, place
            insertions()
            edit, at = audit[at], at + 1
            if edit == "D":
                return
            sign = role[:1]
            if edit == "R":
                sign = "u" if "u" in NEXT[state] else "a"
                role = ROLES[sign]
            out.append((conv, place, edit, role, text))
            state, place = NEXT[state][sign], place + 1

        def batch_of() -> pa.RecordBatch:
            types = (kind, pa.int64(), pa.string(), pa.string(), pa.string())
            columns = [pa.array(list(c), t) for c, t in zip(zip(*out), types)]
            out.clear()
            return pa.RecordBatch.from_arrays(columns, ["conv", "place", "edit", "role", "text"])

        for batch in batches:
            columns = [batch.column(n).to_pylist() for n in ("conv", "audit", "role", "text", "copies")]
            for this, edits, role, text, copies in zip(*columns):
                if edits is not None:
                    insertions()
                    conv, audit, at, state, place = this, edits, 0, 0, 0
                    continue
                for _ in range(copies):
                    take(role, text)
            if out:
                yield batch_of()
        insertions()
        if out:
            yield batch_of()

    return run


def repaired_turns(turns: DataFrame, repairs: DataFrame) -> DataFrame:
    """The turns that the audits leave, in order: (conv, place, edit, role, text)."""
    wanted = ["conv", "audit", "turn", "role", "digest", "text", "copies"]
    nothing = {name: F.lit(None).cast(turns.schema[name].dataType) for name in wanted[2:]}
    heads = repairs.select("conv", "audit").withColumns(nothing)
    given = turns.filter("copies > 0").withColumn("audit", F.lit(None).cast("string"))
    arrow, kind = _id_type(turns)
    together = heads.select(*wanted).unionByName(given.select(*wanted))
    return (
        together.repartition("conv")
        .sortWithinPartitions("conv", F.col("audit").desc_nulls_last(), *_ORDER)
        .mapInArrow(
            _apply(arrow), f"conv {kind}, place long, edit string, role string, text string"
        )
    )


def turn_digests(turns: DataFrame) -> DataFrame:
    """``repaired_sha256`` per conversation of turns in order: ``role:text`` by lines.

    A digest is a chain over the conversation's texts, so they stream through one task;
    their turns come sorted from ``repaired_turns``.
    """
    arrow, kind = _id_type(turns)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, chain = None, None
        for batch in batches:
            done = []
            columns = [batch.column(n).to_pylist() for n in ("conv", "place", "role", "text")]
            for this, place, role, text in zip(*columns):
                if place == 0:
                    if chain:
                        done.append((conv, chain.hexdigest()))
                    conv, chain = this, sha256()
                line = f"{role}:{text}" if place == 0 else f"\n{role}:{text}"
                chain.update(line.encode("utf-8", "replace"))
            if done:
                convs, digests = zip(*done)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(convs, arrow), pa.array(digests)], ["conv", "repaired_sha256"]
                )
        if chain:
            yield pa.RecordBatch.from_arrays(
                [pa.array([conv], arrow), pa.array([chain.hexdigest()])], ["conv", "repaired_sha256"]
            )

    return turns.mapInArrow(run, f"conv {kind}, repaired_sha256 string")


def damaged(
    rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """Rows with planted faults, by a checksum of conversation and turn: some are emptied,
    lose the ends of their sentences or get the role user; ``copies`` is 0 for those that
    go and 2 for those that are repeated. Further columns go."""
    space = F.lit(" ")
    key = F.concat(
        F.coalesce(F.col(conv_col).cast("string"), space),
        F.lit(":"),
        F.coalesce(F.col(turn_col).cast("string"), space),
    )
    fault = F.crc32(key) % 20
    role, text = (F.coalesce(F.col(c).cast("string"), space) for c in (role_col, text_col))
    return rows.select(
        F.col(conv_col).alias("conv_id"),
        F.col(turn_col).alias("turn"),
        F.when(fault == 4, "user").otherwise(role).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1).alias("copies"),
    )
