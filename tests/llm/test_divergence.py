"""Source divergence against plain counts, with and without collisions of digests."""

import random
import re
from collections import Counter, defaultdict

import pytest

from tenureframe.llm import divergence as dv

LETTERS = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "text string, lang string, source string"
RESULT = ("lang", "source", "part", "item", "value", "rank")


def brute(rows, least=30, top=50):
    frequency, counts, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in rows:
        text, lang, source = text or "", lang or "", source or ""
        words = [w.translate(LOWER) for w in LETTERS.findall(text)]
        groups.add((lang, source))
        frequency[lang].update(set(words))
        counts[lang, source].update(words)
    out = []
    for lang in {g[0] for g in groups}:
        kept = [w for w, n in frequency[lang].items() if n >= least]

        def shares(count, kept=kept):
            total = sum(count[w] for w in kept)
            return {w: 1 + 10**9 * (count[w] + 5) // (total + 5 * len(kept)) for w in kept}

        sources = sorted(s for other, s in groups if other == lang)
        p = {s: shares(counts[lang, s]) for s in sources}
        q = shares(sum((counts[lang, s] for s in sources), Counter()))
        for s in sources:
            pairs = [(o, sum(abs(p[s][w] - p[o][w]) for w in kept)) for o in sources if o != s]
            terms = [(w, p[s][w] - q[w]) for w in kept if counts[lang, s][w] and p[s][w] > q[w]]
            for part, found in (("pair", pairs), ("term", terms)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                found = found[:top] if part == "term" else found
                out += [(lang, s, part, item, value, rank) for rank, (item, value) in enumerate(found, 1)]
    return sorted(out)


def rows_of(df):
    return sorted(map(tuple, df.select(*RESULT).collect()))


def random_docs(seed, sources=9, docs=260):
    rng = random.Random(seed)
    words = ["The", "the", "été", "ÉTÉ", "한국어", "x1y", "a-b", "don't", "zz z", *(f"w{chr(97 + i)}" for i in range(26))]
    rows = []
    for i in range(docs):
        lang, source = rng.choice(["en", "de", None]), f"s{rng.randrange(sources)}"
        bias = words[rng.randrange(6) :]
        rows.append((" ".join(rng.choices(bias, k=rng.randrange(30))), lang, source))
    return rows + [(None, "en", None), ("", "fr", "alone"), (None, None, None), ("1 2 3", "de", "digits")]


@pytest.mark.parametrize("bits, block", [(64, 256), (4, 256), (64, 2), (6, 3)])
def test_against_plain_counts(spark, bits, block):
    """Few bits make digests collide; small blocks deal sources into cells."""
    rows = random_docs(bits + block)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    found = dv.source_divergence(df, least_documents=20, top_terms=7, digest_bits=bits, block=block)
    expected = brute(rows, 20, 7)
    assert rows_of(found) == expected and any(r[2] == "term" for r in expected)


def test_ties_at_the_last_rank(spark):
    """Many terms of one count: those that are first as texts are ranked."""
    ties = " ".join(f"t{chr(97 + i // 20)}{chr(97 + i % 20)}" for i in range(90))
    rows = [(ties, "en", "a")] * 30 + [("common word", "en", "b")] * 40
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert rows_of(dv.source_divergence(df)) == brute(rows)


def test_portions_of_few_terms(spark, monkeypatch):
    monkeypatch.setattr(dv, "HELD_TERMS", 10)
    rows = random_docs(8)
    df = spark.createDataFrame(rows, SCHEMA).coalesce(1)
    assert rows_of(dv.source_divergence(df)) == brute(rows)


def test_no_kept_terms_odd_and_empty_tables(odd, none):
    rows = [(r["text"], r["lang"], r["source"]) for r in odd.collect()]
    found = rows_of(dv.source_divergence(odd))
    assert found == brute(rows) and {r[4] for r in found} == {0}
    assert rows_of(dv.source_divergence(odd, least_documents=1)) == brute(rows, 1)
    assert dv.source_divergence(none).count() == 0
