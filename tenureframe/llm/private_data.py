"""Personal data by anchor expansion.

An Aho-Corasick automaton runs once over a text and reports anchors: at-signs, plus
signs, digits, schemes of addresses, and cues of identifiers ("iban", "account no").
At each anchor a local parser expands to the boundaries of an e-mail address, a network
address, a card or phone number, an address with a user in it, or an account, and
validates what it found. Parsers read on from where the last match of their kind ended,
so every character is read a few times at most and long texts take linear time.

E-mail, ip, card and phone are the base kinds; their spans are those of four fixed
patterns, leftmost and without overlap per kind, failing ones dropped. ``link`` (an
address with a user, or a number to call) and ``account`` (a number that its cue names
and that passes the cue's check) are added where no base span covers them. A cue counts
as a whole word in lower case, upper case, or with a capital.

Spans are in code points, the end exclusive. Rows are independent of each other, so
nothing is shuffled.

Defined results: a NULL or empty text has no spans; repeated rows are scanned each; rows
with a NULL id are returned; an empty table gives an empty result; further columns,
whatever their names, are ignored by ``scan_private`` and kept by ``mask_documents``.
"""

from __future__ import annotations

import re
from functools import cache
from hashlib import sha256

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenureframe.llm.common import per_batch, text_or_empty

# Kinds in the order of the digest, characters, and bounds.
KINDS = ("email", "ip", "card", "phone", "link", "account")
EMAIL, IP, CARD, PHONE, LINK, ACCOUNT = range(6)
BASE_KINDS = 4
DIGITS = "0123456789"
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_NETWORK = re.compile(r"([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_RUN = re.compile(r"[0-9]++")
_CHAIN = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_CALL = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_SEPARATORS = str.maketrans("", "", " ().+-")

# Schemes and cues, with the check that an identifier after the cue has to pass.
SCHEMES = ("://", "tel:")
CUES = {
    "iban": "iban",
    "ssn": "ssn",
    "social security": "ssn",
    "routing": "routing",
    "account": "account",
    "acct": "account",
    "passport": "account",
    "konto": "account",
    "compte": "account",
    "cuenta": "account",
}
# Between a cue and its identifier: a word for "number", signs, blanks.
_BETWEEN = re.compile(
    r"[\x20\t]{0,3}(?:(?:no|nr|num|number|nummer|numero|id|is)\b\.?)?[\x20\t]{0,3}[:=#]?[\x20\t]{0,3}", re.I
)
_IDENTIFIER = re.compile(r"[A-Za-z0-9](?:[\x20-]?[A-Z0-9]){5,33}+(?![A-Za-z0-9])")
_SCHEME_SIGNS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+.-")
_AUTHORITY = re.compile(r"[^\s/?#\"'<>@]{1,256}@[A-Za-z0-9.-]{1,253}(?::[0-9]{1,5})?")
_TO_CALL = re.compile(r"\+?[0-9](?:[().-]?[0-9]){6,14}+(?![0-9])")

Span = tuple[int, int, int]


@cache
def _anchors() -> ahocorasick.Automaton:
    """Needle to what it stands for; one automaton a worker."""
    automaton = ahocorasick.Automaton()
    automaton.add_word("@", ("email", 1, ""))
    automaton.add_word("+", ("phone", 1, ""))
    for digit in DIGITS:
        automaton.add_word(digit, ("number", 1, ""))
    for scheme in SCHEMES:
        automaton.add_word(scheme, ("scheme", len(scheme), scheme))
    for cue, check in CUES.items():
        for form in {cue, cue.upper(), cue.capitalize()}:
            automaton.add_word(form, ("cue", len(cue), check))
    automaton.make_automaton()
    return automaton


def luhn(digits: str) -> bool:
    """Whether the check digit at the end fits."""
    doubled = (sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (sum(map(int, digits[::-2])) + sum(doubled)) % 10 == 0


def identifies(check: str, value: str) -> bool:
    """Whether an identifier without blanks and dashes passes the check of its cue."""
    digits = sum(c.isdigit() for c in value)
    if check == "iban":
        if not re.fullmatch("[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}", value):
            return False
        return int("".join(str(int(c, 36)) for c in value[4:] + value[:4])) % 97 == 1
    if check == "ssn":
        return len(value) == digits == 9 and not (
            value[:3] in ("000", "666") or value[0] == "9" or value[3:5] == "00" or value[5:] == "0000"
        )
    if check == "routing":
        weighted = sum(int(c) * w for c, w in zip(value, (3, 7, 1) * 3)) if digits == len(value) else 1
        return len(value) == 9 and weighted % 10 == 0
    return digits >= 6 and len(value) <= 20


class _Scan:
    """One text's spans; for each kind, where the last match ended."""

    def __init__(self, text: str):
        self.text = text
        self.spans: list[Span] = []
        self.email = self.network = self.card = self.number = 0

    def at_sign(self, at: int) -> None:
        text, start = self.text, at
        while start > self.email and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (domain := _DOMAIN.match(text, at + 1)):
            self.email = domain.end()
            self.spans.append((start, EMAIL, self.email))

    def at_plus(self, at: int) -> None:
        if found := _CALL.match(self.text, at):
            if 9 <= len(found[0].translate(_SEPARATORS)) <= 15:
                self.spans.append((at, PHONE, found.end()))

    def at_digit(self, at: int) -> None:
        """The first digit of a run: later ones lie before ``number``."""
        if at >= self.network:
            if found := _NETWORK.match(self.text, at):
                self.network = found.end()
                # Leading zeros do not count; more digits than three are too many.
                parts = [part.lstrip("0") for part in found.groups()]
                if all(len(part) <= 3 and int(part or "0") <= 255 for part in parts):
                    self.spans.append((at, IP, self.network))
            else:
                self.network = _RUN.match(self.text, at).end()
        if at >= self.card:
            if found := _CHAIN.match(self.text, at):
                self.card = found.end()
                digits = found[0].translate(_SEPARATORS)
                if 12 <= len(digits) <= 19 and luhn(digits):
                    self.spans.append((at, CARD, self.card))
            else:
                self.card = at + 1
        self.number = min(self.network, self.card)

    def at_scheme(self, start: int, end: int, scheme: str) -> None:
        text, first = self.text, start
        if scheme == "tel:":
            if (not start or not text[start - 1].isalnum()) and (found := _TO_CALL.match(text, end)):
                self.spans.append((start, LINK, found.end()))
            return
        while first and start - first < 32 and text[first - 1] in _SCHEME_SIGNS:
            first -= 1
        while first < start and not ("A" <= text[first] <= "Z" or "a" <= text[first] <= "z"):
            first += 1
        if first < start and (found := _AUTHORITY.match(text, end)):
            self.spans.append((first, LINK, found.end()))

    def at_cue(self, start: int, end: int, check: str) -> None:
        text = self.text
        if start and text[start - 1].isalnum():
            return
        found = _IDENTIFIER.match(text, _BETWEEN.match(text, end).end())
        if found and found.start() > end and identifies(check, found[0].translate(_SEPARATORS)):
            self.spans.append((found.start(), ACCOUNT, found.end()))


def find_spans(text: str) -> tuple[list[Span], list[Span]]:
    """Base spans as (start, kind, end), sorted, and all spans."""
    scan = _Scan(text)
    for last, (what, length, detail) in _anchors().iter(text):
        if what == "number":
            if last >= scan.number:
                scan.at_digit(last)
        elif what == "email":
            scan.at_sign(last)
        elif what == "phone":
            scan.at_plus(last)
        elif what == "scheme":
            scan.at_scheme(last - length + 1, last + 1, detail)
        else:
            scan.at_cue(last - length + 1, last + 1, detail)
    base = sorted(span for span in scan.spans if span[1] < BASE_KINDS)
    if len(base) == len(scan.spans):
        return base, base
    added = {span for span in scan.spans if span[1] >= BASE_KINDS}
    added = [
        (start, kind, end)
        for start, kind, end in added
        if not any(first <= start and end <= last for first, _, last in base)
    ]
    return base, sorted(base + added)


def joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def mask(text: str, spans: list[Span]) -> str:
    """The text with each run of overlapping spans replaced by its first span's kind."""
    out, at = [], 0
    for start, kind, end in sorted(spans):
        if start >= at:
            out += [text[at:start], f"[{KINDS[kind].upper()}]"]
        at = max(at, end)
    return "".join(out) + text[at:]


_FOUND = (
    "id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"
)


def scan_private(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: counts and digest of its base spans, and all ``spans``."""
    nothing = sha256(b"").hexdigest()

    def convert(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = []
        for text in batch.column("text").to_pylist():
            base, spans = find_spans(text)
            if not spans:
                found.append((0, 0, 0, 0, nothing, ""))
                continue
            kinds = [kind for _, kind, _ in base]
            counts = (kinds.count(kind) for kind in range(BASE_KINDS))
            found.append((*counts, sha256(joined(base).encode()).hexdigest(), joined(spans)))
        types = (pa.int64(),) * BASE_KINDS + (pa.string(),) * 2
        columns = [pa.array(column, kind) for column, kind in zip(zip(*found), types)]
        names = ["id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]
        return pa.RecordBatch.from_arrays([batch.column("id"), *columns], names)

    rows = docs.select(
        F.col(id_col).cast("long").alias("id"), text_or_empty(text_col).alias("text")
    )
    return rows.mapInArrow(per_batch(convert), _FOUND)


def mask_documents(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents with their personal data replaced in the text by its kind; all other
    columns, and texts without personal data, stay as they are."""

    def convert(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column(text_col).to_pylist()
        new = [mask(text, find_spans(text)[1]) if text else text for text in texts]
        columns = dict(zip(batch.schema.names, batch.columns))
        columns[text_col] = pa.array(new, batch.schema.field(text_col).type)
        return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return docs.mapInArrow(per_batch(convert), docs.schema)
