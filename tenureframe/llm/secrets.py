"""Secret scans with assignment-aware lexing.

Three patterns give the base spans. Beyond them, lines with an assignment are lexed
as source or configuration: a name (dotted, quoted or in camel case), perhaps its type,
before it or after a colon, an operator, and a literal or another name. Which of two
words before an operator is the type is not known, so both count as names. Quoted
literals may have a prefix, or three quotes and then several lines. A value without
quotes ends at white space or a comma, bracket or quote; where it is all that a line
assigns, at white space only. Without a digit it is a literal only if it is no name of
source code: on lines ``KEY=VALUE`` without blanks, if it has other signs than a name,
or in a text with ``[section]`` lines. Several targets take their values by position, a
literal may be put together from quoted parts and names, and a block value is the
lines indented below its name. Names and literals also meet in attributes of one tag, in calls that
set something, in ``Authorization`` headers and in addresses with a password.

Literals assigned to a name are remembered in the text and propagated when the name is
assigned on, through any number of steps; a name that is assigned on before it has a
literal passes on the first one that it gets later. Each literal is scored by how
sensitive the names are that it reaches and by how much it looks like a secret; names
that end in a measure or a place (``token_count``, ``key_path``) count little. Literals
at or above ``threshold`` become spans of the kind ``literal``, one for each part.

Spans are in code points, the end exclusive. Whole texts are read; rows are
independent of each other, so nothing is shuffled.

Defined results: a NULL or empty text has no spans; repeated rows are scanned each;
an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import sha256
from math import log2

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenureframe.llm.common import per_batch, text_or_empty

# The base patterns and kinds.
KINDS = ("assign", "access", "hex", "literal")
ASSIGN = re.compile(
    r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"
    r"|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = re.compile("AKIA[A-Z0-9]+")
HEX = re.compile("[0-9a-f]{32,}")
LEAST_ASSIGNED, LEAST_ACCESS = 8, 16

# Parts of names and how sensitive each makes its target.
SENSITIVE = {
    "password": 1.0,
    "passwd": 1.0,
    "passphrase": 1.0,
    "pwd": 1.0,
    "pass": 0.7,
    "secret": 1.0,
    "token": 0.9,
    "bearer": 0.9,
    "apikey": 1.0,
    "credential": 0.9,
    "credentials": 0.9,
    "privatekey": 1.0,
    "signing": 0.6,
    "auth": 0.6,
    "key": 0.5,
    "access": 0.3,
    "private": 0.4,
    "client": 0.2,
    "api": 0.4,
    "db": 0.1,
}
THRESHOLD = 1.4

# Last parts of names that tell of a secret but do not hold it.
ABOUT = frozenset(
    "at budget bytes count counts date expires expiry file id ids index len length limit max min"
    " name names num number offset path size timeout total ttl type uri url usage version".split()
)
ABOUT_SHARE = 0.3

_WORD = r"[A-Za-z_][A-Za-z0-9_]*(?:(?:\.|::)[A-Za-z_][A-Za-z0-9_]*){0,9}"
_TYPE = (
    r"[&*]{0,2}(?:'[a-z_]+[ \t]+)?(?:(?:mut|const|dyn)[ \t]+)?[&*]?"
    rf"(?P<type>{_WORD})(?:[<\[][A-Za-z0-9_ .,:|&<>\[\]]{{0,80}}[>\]])?(?:\[\])?"
    rf"(?:[ \t]*\|[ \t]*{_WORD}){{0,9}}[*?!]?"
)
_QUOTED = (
    r"""(?:"(?P<double>(?:[^"\\\n]|\\.)*)"|'(?P<single>(?:[^'\\\n]|\\.)*)'|`(?P<tick>[^`\n]*)`)"""
)
_PAIR = re.compile(
    # A name begins where its word begins, so a long word is read once.
    r"""(?:(?P<open>["'])|(?<![A-Za-z0-9_])[0-9]*+)"""
    r"""(?P<name>[A-Za-z_][A-Za-z0-9_.-]*)(?(open)(?P=open))(?:\]|\[[0-9]{0,9}\])?"""
    # A type is followed by an assignment, a plain name by a colon as well.
    rf"""(?:(?:[?!]?[ \t]*:[ \t]*|[ \t]+){_TYPE}[ \t]*(?::=|=(?![=>]))[ \t]*"""
    r"""|[ \t]*(?::=|=>|=|:)[ \t]*)"""
    r"""(?:(?:[bBfFrRuU]{1,2}(?=["']))?"""
    rf"""(?:(?P<three>\"\"\"|''')|{_QUOTED})"""
    r"""|(?P<bare>[A-Za-z0-9_$][A-Za-z0-9_.$/+=!@#%^~?*-]*))"""
)
# A line that is a whole assignment of a value without quotes.
_SETTING = re.compile(
    r"""[ \t]*(?:(?:export|set|ENV|-)[ \t]+)?(?P<open>["'])?(?P<name>[A-Za-z_][A-Za-z0-9_.-]*)"""
    r"""(?(open)(?P=open))(?P<operator>=|[ \t]*(?:=|:)[ \t]+|[ \t]+=|:)"""
    r"""(?P<bare>[^\s"'`=:(\[{<][^\s]*)[ \t\r]*(?:[ \t](?:[#;]|//)[^\n]*)?(?=\n|\Z)"""
)
# The next part of a literal that is put together.
_PLUS = re.compile(rf"[ \t]*+(?:\+|\.{{1,2}}|&)?[ \t]*+{_QUOTED}|[ \t]*+\+[ \t]*+(?P<name>{_WORD})(?![\w(\[])")
# Several targets, and one value of several.
_TARGETS = re.compile(
    rf"[ \t]*+(?:(?:const|final|let|local|my|val|var)[ \t]++)?[\[({{]?(?P<names>{_WORD}"
    rf"(?:[ \t]*+,[ \t]*+{_WORD})++)[ \t]*+[\])}}]?[ \t]*+(?::=|=(?![=>]))[ \t]*+[\[({{]?"
)
_VALUE = re.compile(
    rf"""[ \t]*+(?:[bBfFrRuU]{{1,2}}(?=["']))?(?:{_QUOTED}|(?P<bare>[^\s,;"'`()\[\]{{}}]++))[ \t]*+(?P<more>,)?"""
)
# A block of lines below its name.
_BLOCK = re.compile(
    r"""(?P<indent>[ \t]*+)(?:-[ \t]++)?(?P<open>["'])?(?P<name>[A-Za-z_][A-Za-z0-9_.-]*+)"""
    r"""(?(open)(?P=open))[ \t]*+:[ \t]*+[|>][+-]?[0-9]?[+-]?[ \t\r]*+\n"""
)
# Forms without an operator between name and literal.
_TAG = re.compile("<[A-Za-z][^<>]*+>")
_ATTRIBUTE = re.compile(
    r"""(?<![A-Za-z0-9_:.-])(?P<what>key|name|id|value)[ \t]*+=[ \t]*+(?:"(?P<double>[^"\n]*+)"|'(?P<single>[^'\n]*+)')""",
    re.A | re.I,
)
_CALL = re.compile(
    r"""(?<![A-Za-z0-9_])(?P<name>(?:set|with|use|put|add|change|update)[A-Za-z0-9_]*+)\("""
    r"""(?:[ \t]*+["'](?P<key>[A-Za-z_][A-Za-z0-9_.-]*+)["'][ \t]*+,)?[ \t]*+"""
    rf"""(?:(?:[bBfFrRuU]{{1,2}}(?=["']))?{_QUOTED}|(?P<bare>{_WORD}))[ \t]*+[,)]"""
)
_HEADER = re.compile(
    r"""authorization["']?[ \t]*+[:=,][ \t]*+[bfru]?["'`]?(?:Bearer|Basic|Token|ApiKey)[ \t]++"""
    r"""(?P<bare>[A-Za-z0-9._~+/=-]++)""",
    re.A | re.I,
)
_ADDRESS = re.compile(r"""://[^\s:/?#@"'`<>]*+:(?P<bare>[^\s/@"'`<>]++)@""")
_SECTION = re.compile(r"^[ \t]*\[[A-Za-z][^\]\n]*\][ \t\r]*$", re.M)
# Values that are expressions: with a literal in quotes, or a call or an item.
_EXPRESSION = re.compile(
    r"""[^\n]*(["'])[^\n]*\1[^\n]*|[bBfFrRuU]{1,2}["'][^\n]*"""
    r"""|[A-Za-z_][A-Za-z0-9_.]*[(\[{][^\n]*[)\]}][;,]?"""
)
_REFERENCE = re.compile(r"\$\{?[A-Za-z_][A-Za-z0-9_]*\}?|%[A-Za-z_][A-Za-z0-9_]*%")
_PART = re.compile("[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")
_IDENTIFIER = re.compile("[A-Za-z_][A-Za-z0-9_.]*")
_LINE = re.compile("^[^\n:=]*+[:=][^\n]*+", re.M)

Span = tuple[int, int, int]
# The places of the parts of a literal; names stand in for parts that are not known yet.
Literal = tuple[tuple[int, int], ...]


def base_spans(text: str) -> list[Span]:
    """(start, kind, end) by the fixed patterns, leftmost and not overlapping per kind."""
    spans = []
    if ":" in text or "=" in text:
        for match in ASSIGN.finditer(text):
            if match.end(2) - match.start(2) >= LEAST_ASSIGNED:
                spans.append((match.start(), 0, match.end()))
    if "AKIA" in text:
        for match in ACCESS.finditer(text):
            if match.end() - match.start() >= LEAST_ACCESS:
                spans.append((match.start(), 1, match.end()))
    # A run below the least length holds no longer one, so the length can be matched.
    spans += [(match.start(), 2, match.end()) for match in HEX.finditer(text)]
    return sorted(spans)


def name_weight(name: str) -> float:
    """How sensitive a target is, from the parts of its name."""
    parts = [p.lower() for p in _PART.findall(name)]
    joined = [a + b for a, b in zip(parts, parts[1:])]
    weight = min(1.0, sum(SENSITIVE.get(p, 0.0) for p in {*parts, *joined}))
    return weight * ABOUT_SHARE if parts and parts[-1] in ABOUT else weight


def literal_weight(value: str) -> float:
    """How much a literal looks like a secret: long, mixed, and without blanks."""
    if len(value) < 8 or any(c.isspace() for c in value):
        return 0.0
    n = len(value)
    entropy = -sum(c / n * log2(c / n) for c in map(value.count, set(value)))
    classes = sum(
        any(test(c) for c in value)
        for test in (str.islower, str.isupper, str.isdigit, lambda c: not c.isalnum())
    )
    return min(1.0, entropy / 4.5) * 0.6 + min(classes, 3) / 3 * 0.4


# How a value stands: in quotes, without, or as all that a line assigns, there with
# blanks beside the operator or without.
QUOTED, BARE, SPACED, SETTING = range(4)

# Names, the places of the value's parts, and how it stands. A part that is a name of
# another literal is a text.
Assignment = tuple[list[str], list, int]


def _quoted(match: re.Match) -> tuple[int, int] | None:
    """The place of the literal in quotes, without them."""
    group = next((g for g in ("double", "single", "tick") if match[g] is not None), None)
    return group and match.span(group)


def _parts(text: str, at: int, end: int) -> tuple[list, int]:
    """What follows a literal and is put together with it, and where that ends."""
    parts = []
    while more := _PLUS.match(text, at, end):
        parts.append(more["name"] or _quoted(more))
        at = more.end()
    return parts, at


def _block(text: str, head: re.Match) -> tuple[list, int]:
    """The lines below a name that are indented deeper, and where they end."""
    parts, at, least = [], head.end(), len(head["indent"])
    while at < len(text):
        end = text.find("\n", at)
        end = len(text) if end < 0 else end
        line = text[at:end]
        inside = line.strip()
        if inside:
            indent = len(line) - len(line.lstrip())
            if indent <= least:
                break
            parts.append((at + indent, at + indent + len(inside)))
        at = end + 1
    return parts, min(at, len(text))


def _several(text: str, targets: re.Match, end: int) -> tuple[list[Assignment], int]:
    """Targets and values by position, as far as the values are literals or words."""
    found, at = [], targets.end()
    for name in re.split(r"[ \t]*,[ \t]*", targets["names"]):
        value = _VALUE.match(text, at, end)
        if value is None:
            break
        at = value.end()
        bare = value["bare"] is not None
        found.append(([name], [value.span("bare") if bare else _quoted(value)], BARE if bare else QUOTED))
        if not value["more"]:
            break
    return found, at


def _on_lines(text: str) -> Iterator[Assignment]:
    """Assignments with an operator."""
    done = 0
    for line in _LINE.finditer(text):
        if line.start() < done:
            continue
        at, end = line.span()
        if head := _BLOCK.match(text, at):
            parts, done = _block(text, head)
            yield [head["name"]], parts, QUOTED
            continue
        setting = _SETTING.match(text, at, end)
        if setting and not _EXPRESSION.fullmatch(setting["bare"]):
            kind = SETTING if setting["operator"] == "=" else SPACED
            yield [setting["name"]], [setting.span("bare")], kind
            # A value may hold assignments of its own, as addresses do.
            at = setting.start("bare")
        elif targets := _TARGETS.match(text, at, end):
            found, at = _several(text, targets, end)
            yield from found
        while pair := _PAIR.search(text, at, end):
            at = pair.end()
            names = [pair["name"], *filter(None, [pair["type"]])]
            if pair["three"]:
                close = text.find(pair["three"], at)
                close = end if close < 0 else close
                inside = text[at:close]
                start = at + len(inside) - len(inside.lstrip())
                yield names, [(start, max(start, at + len(inside.rstrip())))], QUOTED
                at = done = max(at, close + 3)
                if at > end:
                    break
                continue
            first = _quoted(pair)
            if first is None:
                first = pair.span("bare")
                word = text[slice(*first)].removesuffix("+")
                joins = text[at - 1] == "+" or text[at : at + 3].lstrip(" \t")[:1] == "+"
                if joins and _IDENTIFIER.fullmatch(word):
                    parts, after = _parts(text, first[0] + len(word), end)
                    if parts:
                        at = after
                        yield names, [word, *parts], QUOTED
                        continue
                yield names, [first], BARE
                continue
            parts, at = _parts(text, at, end)
            yield names, [first, *parts], QUOTED


def _elsewhere(text: str) -> Iterator[Assignment]:
    """Names and literals that meet without an operator."""
    if "<" in text and "=" in text:
        for tag in _TAG.finditer(text):
            given = {}
            for match in _ATTRIBUTE.finditer(text, *tag.span()):
                group = "double" if match["double"] is not None else "single"
                given.setdefault(match["what"].lower(), match.span(group))
            value = given.pop("value", None)
            if value and given:
                yield [text[slice(*span)] for span in given.values()], [value], QUOTED
    if "(" in text:
        for call in _CALL.finditer(text):
            names = [call["name"], *filter(None, [call["key"]])]
            yield names, [call["bare"] or _quoted(call)], QUOTED
    if "://" in text:
        for match in _ADDRESS.finditer(text):
            yield ["password"], [match.span("bare")], QUOTED
    if "uthorization" in text.lower():
        for match in _HEADER.finditer(text):
            yield ["bearer_token"], [match.span("bare")], QUOTED


def _assignments(text: str) -> list[Assignment]:
    """All assignments in the order of their values."""
    found, last = [], 0
    for assignment in _on_lines(text):
        last = next((part[0] for part in assignment[1] if not isinstance(part, str)), last)
        found.append((last, assignment))
    others = list(_elsewhere(text))
    if others:
        last = 0
        for assignment in others:
            last = next((part[0] for part in assignment[1] if not isinstance(part, str)), last)
            found.append((last, assignment))
        found.sort(key=lambda pair: pair[0])
    return [assignment for _, assignment in found]


class _Names:
    """What literal every name holds, and how sensitive the names are it has reached."""

    def __init__(self):
        self.held: dict[str, Literal] = {}
        self.reached: dict[Literal, float] = {}
        # Names that were assigned from one that had no literal yet.
        self.waiting: dict[str, list[str]] = {}

    def assign(self, names: list[str], literal: Literal) -> None:
        todo = list(names)
        while todo:
            name = todo.pop()
            self.held[name] = literal
            self.reached[literal] = max(self.reached.get(literal, 0.0), name_weight(name))
            todo += [n for n in self.waiting.pop(name, ()) if n not in self.held]

    def clear(self, names: list[str], source: str | None) -> None:
        """The names have no literal; they get that of ``source`` once it has one."""
        for name in names:
            self.held.pop(name, None)
            if source and source != name:
                self.waiting.setdefault(source, []).append(name)


def literal_spans(text: str, threshold: float = THRESHOLD) -> list[Span]:
    """Literals whose own score plus that of the most sensitive name they reach is high."""
    sections: bool | None = None
    known = _Names()
    for names, parts, kind in _assignments(text):
        if kind == QUOTED:
            literal: list[tuple[int, int]] = []
            for part in parts:
                literal += known.held.get(part, ()) if isinstance(part, str) else (part,)
            if literal:
                known.assign(names, tuple(literal))
            else:
                known.clear(names, next((p for p in parts if isinstance(p, str)), None))
            continue
        (span,) = parts
        value = text[slice(*span)]
        # What ends a statement is no part of a name.
        bare = value.rstrip(";,")
        identifier = bool(_IDENTIFIER.fullmatch(bare))
        if identifier and bare in known.held:
            known.assign(names, known.held[bare])
            continue
        literal = any(c.isdigit() for c in value)
        if not literal and kind != BARE and not _REFERENCE.fullmatch(value):
            literal = not identifier or (kind == SETTING and bare == value)
            if not literal:
                if sections is None:
                    sections = bool(_SECTION.search(text))
                literal = sections
        if literal:
            known.assign(names, (span,))
        else:
            # A word of prose, or a name without a literal so far.
            known.clear(names, bare if identifier else None)
    spans = set()
    for literal, weight in known.reached.items():
        if weight and weight + literal_weight("".join(text[a:b] for a, b in literal)) >= threshold:
            spans.update((start, 3, end) for start, end in literal if end > start)
    return sorted(spans)


def find_spans(text: str, threshold: float = THRESHOLD) -> tuple[list[Span], list[Span]]:
    """Base spans, and all spans: a literal is added where no base span covers it."""
    base = base_spans(text)
    if not (":" in text or "=" in text or "(" in text):
        return base, base
    added = [
        span
        for span in literal_spans(text, threshold)
        if not any(start <= span[0] and span[2] <= end for start, _, end in base)
    ]
    return base, sorted(base + added)


def joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def redact(text: str, spans: list[Span], mark: str = "[SECRET]") -> str:
    """The text with each run of overlapping spans replaced by ``mark``."""
    out, at = [], 0
    for start, _, end in sorted(spans):
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join(out) + text[at:]


_SPANS = (
    "id long, n_assign long, n_access long, n_hex long, base_sha256 string, "
    "spans string, redacted string"
)


def scan_secrets(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = THRESHOLD,
    with_text: bool = False,
) -> DataFrame:
    """One row per document: counts and digest of base spans, all ``spans``, and, with
    ``with_text``, the text without its secrets as ``redacted``."""

    def convert(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for text in batch.column("text").to_pylist():
            base, spans = find_spans(text, threshold)
            kinds = [kind for _, kind, _ in base]
            rows.append(
                (
                    *(kinds.count(k) for k in range(3)),
                    sha256(joined(base).encode()).hexdigest(),
                    joined(spans),
                    redact(text, spans) if with_text else None,
                )
            )
        types = (pa.int64(),) * 3 + (pa.string(),) * 3
        columns = [pa.array(column, kind) for column, kind in zip(zip(*rows), types)]
        names = ["id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "redacted"]
        return pa.RecordBatch.from_arrays([batch.column("id"), *columns], names)

    rows = docs.select(
        F.col(id_col).cast("long").alias("id"), text_or_empty(text_col).alias("text")
    )
    found = rows.mapInArrow(per_batch(convert), _SPANS)
    return found if with_text else found.drop("redacted")


def redact_documents(
    docs: DataFrame,
    text_col: str = "text",
    length_col: str = "n_chars",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """The documents with their secrets replaced in the text and its length brought up
    to date; all other columns, and texts without secrets, stay as they are."""

    def convert(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column(text_col).to_pylist()
        spans = [find_spans(text, threshold)[1] if text else [] for text in texts]
        if not any(spans):
            return batch
        new = [redact(text, found) if found else text for text, found in zip(texts, spans)]
        columns = dict(zip(batch.schema.names, batch.columns))
        columns[text_col] = pa.array(new, batch.schema.field(text_col).type)
        if length_col in columns:
            kind = batch.schema.field(length_col).type
            old = columns[length_col].to_pylist()
            lengths = [len(n) if found else o for n, found, o in zip(new, spans, old)]
            columns[length_col] = pa.array(lengths, kind)
        return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return docs.mapInArrow(per_batch(convert), docs.schema)
