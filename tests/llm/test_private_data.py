"""Personal data by anchors against the base patterns, and the kinds that are added."""

import random
import re
import time
from hashlib import sha256

import pytest

from tenureframe.llm import private_data as pd
from tenureframe.llm.queries import LLM_QUERIES
from tests.llm.conftest import ODD

PATTERNS = (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
)


def passes_luhn(digits):
    total = 0
    for i, digit in enumerate(reversed(digits)):
        d = int(digit) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def brute_base(text):
    spans = []
    for kind, pattern in enumerate(PATTERNS):
        for match in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", match[0])
            good = (
                True,
                all(int(part) <= 255 for part in match[0].split(".")) if kind == 1 else None,
                12 <= len(digits) <= 19 and passes_luhn(digits),
                9 <= len(digits) <= 15,
            )[kind]
            if good:
                spans.append((match.start(), kind, match.end()))
    return sorted(spans)


@pytest.mark.parametrize(
    "signs", ["a@.-1 ", "0123456789- .", "+1234567890() .-", "ab@c.d-é😀İ1+", "0. -@+", "+-.01"]
)
def test_base_spans_are_those_of_the_patterns(signs):
    rng = random.Random(signs)
    found = 0
    for _ in range(12_000):
        text = "".join(rng.choices(signs, k=rng.randrange(40)))
        base = pd.find_spans(text)[0]
        assert base == brute_base(text), text
        found += len(base)
    assert found


def test_long_runs_of_digits():
    assert pd.find_spans("0" * 9000 + "1.2.3.4")[0] == [(0, pd.IP, 9007)]
    assert pd.find_spans("9" * 9000 + ".2.3.4")[0] == []


@pytest.mark.parametrize(
    "text, expected",
    [
        ("IBAN: DE89 3704 0044 0532 0130 00 ok", "account:6:33"),
        ("iban DE89 3704 0044 0532 0130 01", ""),
        ("SSN 123-45-6789.", "account:4:15"),
        ("ssn 666-45-6789.", ""),
        ("routing number: 021000021", "account:16:25"),
        ("routing number: 021000022", ""),
        ("Account no. 12345678", "account:12:20"),
        ("account of 1234, recount 12345678", ""),
        ("Konto 12 345 678", "account:6:16"),
        ("passport number X1234567", "account:16:24"),
        ("http://bob:pw@host.org/x", "link:0:22,email:11:22"),
        ("see http://host.org/x@y", ""),
        ("call tel:555-123-4567 now", "link:5:21"),
        ("hotel:5551234567", ""),
        ("account +1 (017) 555-7713", "phone:8:25"),
    ],
)
def test_added_kinds(text, expected):
    base, spans = pd.find_spans(text)
    assert pd.joined(spans) == expected and set(base) <= set(spans)


def test_masks():
    text = "Ask bob@example.org or 97.51.17.173, account 12345678."
    assert pd.mask(text, pd.find_spans(text)[1]) == "Ask [EMAIL] or [IP], account [ACCOUNT]."
    assert pd.mask("", []) == ""


def test_query_against_the_patterns(spark):
    """All documents of a table."""
    sf_dir = "/root/testdata/sf0.01"
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    found = LLM_QUERIES["op12_private_data"](spark, sf_dir).collect()
    assert len(found) == len(texts)
    for r in found:
        base = brute_base(texts[r["doc_id"]])
        counts = tuple(sum(kind == k for _, kind, _ in base) for k in range(4))
        assert (r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]) == counts
        assert r["base_sha256"] == sha256(pd.joined(base).encode()).hexdigest()
        assert set(pd.joined(base).split(",")) <= set(r["spans"].split(","))
    assert sum(r["n_email"] for r in found) and sum(r["n_phone"] for r in found)


def test_odd_rows(odd, none):
    found = pd.scan_private(odd).collect()
    assert len(found) == len(ODD) and all(r["spans"] == "" for r in found)
    assert pd.scan_private(none).count() == pd.mask_documents(none).count() == 0
    assert sorted(map(str, pd.mask_documents(odd).collect())) == sorted(map(str, odd.collect()))


def test_long_texts_take_linear_time():
    begin = time.process_time()
    for text in ("a@" * 100_000, "1 " * 100_000, "a" * 300_000 + "@" + "b" * 300_000, "+1" * 100_000,
                 "account " * 50_000, "1.1.1-" * 60_000, "http://" * 50_000, "+1((((((((" * 30_000):
        pd.find_spans(text)
    assert time.process_time() - begin < 20
