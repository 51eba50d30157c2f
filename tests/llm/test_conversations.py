"""Conversation repair against shortest paths over all edits, and its parts."""

import random
import re
import zlib
from hashlib import sha256
from heapq import heappop, heappush

import pytest
from pyspark.sql import functions as F

from tenureframe.llm import conversations as cv
from tenureframe.llm.queries import LLM_QUERIES

GRAMMAR = re.compile("(s?(ua)+)?")
SCHEMA = "conv_id long, turn long, role string, text string"


def brute_repair(turns):
    """Cheapest first, then least audit, over whole sequences of edits. ``turns`` has
    (role, text, fault); returns cost, audit and the repaired turns."""
    waiting = [(0, "", 0, ())]
    seen = set()
    while waiting:
        cost, audit, at, out = heappop(waiting)
        roles = "".join(role[:1] for role, _ in out)
        if at == len(turns) and GRAMMAR.fullmatch(roles):
            return cost, audit, list(out)
        if (at, roles[-1:], len(roles) > 0, audit) in seen:
            continue
        seen.add((at, roles[-1:], len(roles) > 0, audit))
        steps = []
        if audit[-3:] != "III":
            steps += [(2, "I", at, (role, "")) for role in ("user", "assistant")]
        if at < len(turns):
            role, text, fault = turns[at]
            steps.append((3, "D", at + 1, None))
            if fault not in ("blank", "duplicate"):
                extra = int(fault == "truncated")
                steps.append((extra, "K", at + 1, (role, text)))
                steps += [(2 + extra, "R", at + 1, (r, text)) for r in ("user", "assistant")]
        for price, edit, then, turn in steps:
            now = out + (turn,) if turn else out
            ahead = "".join(role[:1] for role, _ in now)
            # What has begun must still be the beginning of something allowed.
            if len(ahead) == len(now) and re.fullmatch("s?(ua)*u?", ahead):
                heappush(waiting, (cost + price, audit + edit, then, now))
    raise AssertionError("no repair")


def faults(turns):
    found, seen = [], set()
    for role, text in turns:
        bare = text.rstrip(" \t\n\x0b\x0c\r")
        if not bare:
            fault = "blank"
        elif (role, text) in seen:
            fault = "duplicate"
        else:
            fault = "" if bare[-1] in ".!?" else "truncated"
        seen.add((role, text))
        found.append((role, text, fault))
    return found


def brute(rows, damage):
    """Expected result of the query (with ``damage``), by conversation."""
    kept = {}
    for conv, turn, role, text in rows:
        kept.setdefault(conv, [])
        role, text = (" " if x is None else x for x in (role, text))
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        h = zlib.crc32(key.encode()) % 20 if damage else 19
        role = "user" if h == 4 else role
        text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
        kept[conv] += [(turn, role, text)] * {0: 0, 3: 2}.get(h, 1)
    expected = {}
    for conv, turns in kept.items():
        digest = {t: sha256(f"{len(t[1])}:{t[1]}:{t[2]}".encode()).digest() for t in turns}
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1], digest[t]))
        numbers = [t[0] for t in turns if t[0] is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        judged = faults([t[1:] for t in turns])
        cost, audit, repaired = brute_repair(judged)
        counts = [sum(f == name for *_, f in judged) for name in ("blank", "duplicate", "truncated")]
        pairs = [a[0][:1] + b[0][:1] for a, b in zip(judged, judged[1:])]
        illegal = sum(p not in ("su", "ua", "au") for p in pairs)
        whole = "\n".join(f"{role}:{text}" for role, text in repaired)
        expected[conv] = (gaps, *counts, illegal, cost, audit, sha256(whole.encode()).hexdigest())
    return expected


def random_rows(seed, convs, longest=7):
    rng = random.Random(seed)
    rows = []
    for conv in range(convs):
        for turn in range(rng.randrange(1, longest)):
            role = rng.choices(["user", "assistant", "system", "tool", "", None], [8, 8, 3, 1, 1, 1])[0]
            text = rng.choice(["One.", "Two!", "Why? \n", "cut", "", " \t", None, "é 한", "One."])
            rows.append((conv, rng.choice([turn, turn, turn, 2 * turn, None]), role, text))
    return rows


def test_repairs_are_the_cheapest_and_least():
    """Random strings, with grammars of no, few and many rules."""
    rng = random.Random(3)
    roles = ["system", "user", "assistant", "tool"]
    names = ["", "blank", "duplicate", "truncated"]
    strings = []
    for _ in range(250):
        codes = [(rng.choices(range(4), [2, 5, 5, 1])[0], rng.choices(range(4), [5, 1, 1, 2])[0])
                 for _ in range(rng.randrange(8))]
        strings.append(codes)
    rules = ["IE", "EI", "", "A", "KI", "E"]
    for repairs in (cv.Repairs([]), cv.Repairs(rules)):
        for codes in strings:
            letters = "".join(cv.letter(i, f) for i, f in codes)
            expected = brute_repair([(roles[i], "x", names[f]) for i, f in codes])[:2]
            assert repairs.repair(letters) == expected, codes


def test_long_strings_agree_with_and_without_a_grammar(spark):
    rng = random.Random(4)
    strings = ["".join(rng.choices("EIEIEIAHBN", k=rng.randrange(300, 3000))) for _ in range(6)]
    df = spark.createDataFrame([(s,) for s in strings], "letters string").repartition(3)
    rules = cv.learn_rules(df, max_rules=60, a_round=10)
    assert len(rules) == 60 == len(set(rules))
    plain, grammar = cv.Repairs([]), cv.Repairs(rules)
    for s in strings:
        assert len(grammar.compressed(s)) < 0.6 * len(s)
        assert plain.repair(s) == grammar.repair(s)


def test_rules_are_the_most_frequent_pairs(spark):
    df = spark.createDataFrame([("ABABAB",), ("ABCC",), ("CCCC",)], "letters string")
    assert cv.learn_rules(df, max_rules=1) == ["AB"]
    # AB four times, CC three times; then the pair of two AB, which occurs once, is no rule.
    assert cv.learn_rules(df) == ["AB", "CC"]
    assert cv.learn_rules(df.filter("false")) == []


@pytest.mark.parametrize("partitions", [1, 4])
def test_query_against_brute_force(spark, tmp_path, partitions):
    rows = random_rows(5, 150) + [(None, None, None, None), (None, 1, "user", "No id.")]
    rows += [(900, 3, "user", "Same."), (900, 3, "user", "Same."), (901, None, "system", "s.")]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("cost", F.lit(1))
    df.repartition(partitions).write.parquet(f"{tmp_path}/conversations.parquet")
    found = LLM_QUERIES["op11_conversations"](spark, str(tmp_path)).collect()
    assert {r["conv_id"]: tuple(r)[1:] for r in found} == brute(rows, damage=True)
    assert len(found) == len({r[0] for r in rows})


def test_one_conversation_over_many_tasks(spark):
    """A conversation that is cut between tasks, some of them within one turn."""
    rng = random.Random(6)
    rows = [(1, i // 3, rng.choice(["user", "assistant"]), f"Text {i}{rng.choice('.!? x')}")
            for i in range(600)]
    rows += [(2, i, "user", "Same.") for i in range(50)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(8)
    repairs, turns = cv.repair_conversations(df)
    found = {r["conv"]: r for r in repairs.collect()}
    assert found[1]["gaps"] == 0 and found[2]["duplicate"] == 49
    assert found[2]["audit"] == "K" + "D" * 49 + "I"
    letters = {r["conv"]: r["letters"] for r in cv.conversation_strings(
        cv._turns(df, "conv_id", "turn", "role", "text", F.lit(1))).collect()}
    order = sorted(rows[:600], key=lambda r: (
        r[1], r[2], sha256(f"{len(r[2])}:{r[2]}:{r[3]}".encode()).digest()))
    codes = {"": 0, "truncated": 3}
    assert letters[1] == "".join(
        cv.letter("sua".index(role[0]), codes[fault]) for role, _, fault in faults([r[2:] for r in order]))
    plain = cv.Repairs([])
    assert plain.repair(letters[1]) == (found[1]["cost"], found[1]["audit"])
    kept = turns.filter("conv = 1").orderBy("place").collect()
    assert "".join(r["role"][0] for r in kept) == "ua" * (len(kept) // 2)
    texts = iter([r[3] for r, edit in zip(order, found[1]["audit"].replace("I", "")) if edit != "D"])
    assert all(r["text"] == (next(texts) if r["edit"] != "I" else "") for r in kept)


def test_odd_and_empty_tables(spark):
    long = "word " * 200_000 + "."
    rows = [(1, 0, "user", long), (1, 1, "assistant", long), (2, None, None, None), (3, 0, "", "Hm.")]
    df = spark.createDataFrame([(*r, 1, 2, "x") for r in rows], SCHEMA + ", conv int, copies int, letters string")
    repairs, turns = cv.repair_conversations(df)
    found = {r["conv"]: r["audit"] for r in repairs.collect()}
    assert found == {1: "KK", 2: "D", 3: "D"}
    assert turns.count() == 2
    repairs, turns = cv.repair_conversations(df.filter("false"))
    assert repairs.count() == turns.count() == cv.turn_digests(turns).count() == 0
