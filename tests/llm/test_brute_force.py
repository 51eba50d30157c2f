"""Fingerprints, languages and secrets of whole tables against second implementations in
plain Python, which share no code with the operators."""

import re
import zlib
from base64 import b64encode
from collections import Counter
from hashlib import sha256
from struct import pack

import duckdb
import pytest

from tenureframe.llm.queries import LLM_QUERIES

MOD = 2**64


def table(sf_dir, columns):
    return duckdb.execute(f"SELECT {columns} FROM '{sf_dir}/documents.parquet' ORDER BY doc_id").fetchall()


# Winnowing: hashes as polynomials, one by one.

BASE, MIX = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9


def gram_hashes(text, gram):
    codes = [ord(c) + 1 for c in text]
    if len(codes) < gram:
        return []
    first = 0
    for code in codes[:gram]:
        first = (first * BASE + code) % MOD
    values, highest = [first], pow(BASE, gram - 1, MOD)
    for out, new in zip(codes, codes[gram:]):
        values.append(((values[-1] - out * highest) * BASE + new) % MOD)
    return [((v ^ (v >> 29)) * MIX % MOD) >> 32 for v in values]


def winnowed(text, gram, window):
    if not text:
        return []
    hashes = gram_hashes(text, gram)
    if not hashes:
        return [(0, int.from_bytes(sha256(text.encode()).digest()[:4], "little"))]
    chosen = []
    for at in range(max(1, len(hashes) - window + 1)):
        inside = hashes[at : at + window]
        least = min(inside)
        place = at + max(i for i, h in enumerate(inside) if h == least)
        if not chosen or chosen[-1][0] != place:
            chosen.append((place, least))
    return chosen


def shown(chosen):
    return b64encode(b"".join(pack("<II", place, value) for place, value in chosen)).decode()


def jaccard(one, other):
    a, b = {h for _, h in one}, {h for _, h in other}
    return len(a & b) / len(a | b) if a or b else 1.0


def test_winnowing_by_polynomials(spark, small_dir):
    from tenureframe.llm.winnowing import GRAM, WINDOW

    docs = [(i, t or "") for i, t in table(small_dir, "doc_id, text")]
    found = {r["doc_id"]: r for r in LLM_QUERIES["op2_winnowing"](spark, small_dir).collect()}
    assert len(found) == len(docs)
    for at, (doc_id, text) in enumerate(docs):
        after = docs[(at + 1) % len(docs)][1]
        half = len(text) // 2
        changed = text[: len(text) - half] + after[:half]
        own, other, following = (winnowed(t, GRAM, WINDOW) for t in (text, changed, after))
        r = found[doc_id]
        assert (r["fingerprint"], r["edited_fingerprint"]) == (shown(own), shown(other))
        assert r["n_chars"] == len(text) and r["edited_sha256"] == sha256(changed.encode()).hexdigest()
        assert r["near_edited"] == pytest.approx(jaccard(own, other))
        assert r["near_next"] == pytest.approx(jaccard(own, following))


# Languages: profiles as lists of n-grams, distances summed one by one.


def ranked_grams(counts, size=400):
    def number(gram):
        value = 0
        for sign in gram:
            value = value << 21 | (ord(sign) if sign != " " else 0)
        return value

    return sorted(counts, key=lambda g: (-counts[g], number(g)))[:size]


def letter_grams(text):
    words = "".join(c if c.isalpha() else " " for c in text.lower()).split()
    line = f" {' '.join(words)} "
    counts = Counter(c for c in line if c != " ")
    # An n-gram that begins a word counts with the shorter one behind the gap.
    counts.update((a + b).lstrip() for a, b in zip(line, line[1:]))
    counts.update((a + b + c).lstrip() for a, b, c in zip(line, line[1:], line[2:]) if b != " ")
    return counts if words else Counter()


def test_languages_by_lists(spark, small_dir):
    docs = table(small_dir, "doc_id, text, lang")
    out = {i for i, *_ in docs if zlib.crc32(str(i).encode()) % 4 == 2}
    sums = {}
    for doc_id, text, lang in docs:
        if doc_id not in out and lang is not None and text is not None:
            sums.setdefault(lang, Counter()).update(letter_grams(text))
    profiles = {lang: {g: n for n, g in enumerate(ranked_grams(counts))} for lang, counts in sums.items()}
    found = {r["doc_id"]: r for r in LLM_QUERIES["op9_language"](spark, small_dir).collect()}
    for doc_id, text, _ in docs:
        own = ranked_grams(letter_grams(text or ""))
        r = found[doc_id]
        assert r["held_out"] == (doc_id in out)
        if not own:
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
            continue
        distances = {
            lang: sum(abs(ranks[g] - n) if g in ranks else 400 for n, g in enumerate(own))
            for lang, ranks in profiles.items()
        }
        best = min(sorted(distances), key=distances.get)
        assert r["lang_pred"] == best
        assert r["score"] == pytest.approx(1 - distances[best] / (400 * len(own)))


# Secrets: the base patterns as they are given, over a whole table.

PATTERNS = (
    re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A),
    re.compile("AKIA[A-Z0-9]+"),
    re.compile("[0-9a-f]+"),
)


def base_secrets(text):
    spans = []
    for kind, (pattern, least) in enumerate(zip(PATTERNS, (8, 16, 32))):
        for match in pattern.finditer(text):
            if len(match[2] if kind == 0 else match[0]) >= least:
                spans.append((match.start(), kind, match.end()))
    return sorted(spans)


def test_secrets_by_the_given_patterns(spark):
    sf_dir = "/root/testdata/sf0.01"
    texts = {i: t or "" for i, t in table(sf_dir, "doc_id, text")}
    found = LLM_QUERIES["op6_secret_scan"](spark, sf_dir).collect()
    assert len(found) == len(texts)
    kinds = ("assign", "access", "hex")
    for r in found:
        base = base_secrets(texts[r["doc_id"]])
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == tuple(
            sum(kind == k for _, kind, _ in base) for k in range(3)
        )
        joined = [f"{kinds[kind]}:{start}:{end}" for start, kind, end in base]
        assert r["base_sha256"] == sha256(",".join(joined).encode()).hexdigest()
        spans = r["spans"].split(",") if r["spans"] else []
        assert [s for s in spans if not s.startswith("literal")] == joined
        # What is added lies in no base span, and in order with them.
        added = [tuple(map(int, s.split(":")[1:])) for s in spans if s.startswith("literal")]
        assert not any(a <= start and end <= b for start, end in added for a, _, b in base)
        starts = [int(s.split(":")[1]) for s in spans]
        assert starts == sorted(starts)
    assert sum(r["n_assign"] for r in found)
