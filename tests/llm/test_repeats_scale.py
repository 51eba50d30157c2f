"""What the repeats operator sends on to its suffix arrays, and that nothing is lost by it."""

import random
import time
from collections import Counter

import pyarrow as pa
import pytest

from tenureframe.llm import repeats

LETTERS = "abcdefghijklmnopqrstuvwxyz "


def stretch_table(docs, length, portions):
    """The stretches of all documents as they arrive: sorted, each portion by itself."""
    parts = [
        repeats._portion_rows([(doc, 0, text) for doc, text in docs[i::portions]], length)
        for i in range(portions)
    ]
    order = ("anchor", "digest1", "digest2", "doc", "tag", "start")
    table = pa.Table.from_batches([part for part in parts if part is not None])
    return table.sort_by([(name, "ascending") for name in order])


def met(table, size):
    batches = iter(table.to_batches(max_chunksize=size))
    return [r for batch in repeats._meet_stretches(batches) for r in batch.to_pylist()]


def cut_and_sorted(docs, wanted, length, size):
    texts = dict(docs)
    rows = [
        {"doc": doc, "tag": 0, "text": texts[doc].decode(), "wanted": found}
        for doc, found in wanted.items()
    ]
    cut = pa.Table.from_batches(repeats._cut_stretches(length)(iter([pa.RecordBatch.from_pylist(rows)])))
    cut = cut.sort_by([(name, "ascending") for name in ("anchor", "doc", "tag", "start")])
    batches = iter(cut.to_batches(max_chunksize=size))
    return [r for batch in repeats._sort_stretches(length)(batches) for r in batch.to_pylist()]


def brute_windows(docs, length):
    seen, found = set(), set()
    for doc, text in docs:
        for at in range(len(text) - length + 1):
            window = text[at : at + length]
            if window in seen:
                found.add((doc, at))
            seen.add(window)
    return found


def test_a_short_common_phrase_sends_nothing_on():
    """Windows that share 45 bytes of 100 may have one anchor, but nothing to compare."""
    rng = random.Random(3)
    phrase = "".join(rng.choices(LETTERS, k=45))
    around = [["".join(rng.choices(LETTERS, k=300)) for _ in range(2)] for _ in range(200)]
    docs = [(i, (a + phrase + b).encode()) for i, (a, b) in enumerate(around)]
    table = stretch_table(docs, 100, 4)
    assert max(Counter(table.column("anchor").to_pylist()).values()) > 100
    assert met(table, 50) == []


def test_pieces_of_crowded_anchors_are_much_smaller_than_their_windows():
    text = "".join(random.Random(4).choices(LETTERS, k=5000)).encode()
    names = ("anchor", "start", "n", "shape")
    wanted = [
        {**{name: r[name] for name in names if name in r}, "crowded": True}
        for r in repeats._portion_rows([(1, 0, text)], 100).to_pylist()
    ]
    rows = [{"doc": 1, "tag": 0, "text": text.decode(), "wanted": wanted}]
    (cut,) = repeats._cut_stretches(100)(iter([pa.RecordBatch.from_pylist(rows)]))
    windows = Counter()
    for r in cut.to_pylist():
        assert text[r["start"] : r["start"] + len(r["bytes"])] == r["bytes"]
        windows.update(range(r["start"], r["start"] + len(r["bytes"]) - 99))
    assert sorted(windows) == list(range(len(text) - 99)) and max(windows.values()) == 1
    assert sum(len(b) for b in cut.column("bytes").to_pylist()) < 25 * len(text)


def test_staged_stretches_leave_no_shuffle_files(spark, small_dir):
    """Otherwise they stay on disk until the driver collects its garbage."""
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager()

    def files():
        names = [f.split("/")[-1] for f in manager.diskBlockManager().getAllFiles().mkString("\n").split("\n")]
        return {name for name in names if name.startswith("shuffle_")}

    docs = spark.read.parquet(f"{small_dir}/documents.parquet").repartition(3)
    before = files()
    repeats.remove_repeats(docs)
    end = time.time() + 20
    while (left := files() - before) and time.time() < end:
        time.sleep(0.2)
    assert not left


@pytest.mark.parametrize("seed", range(30))
def test_no_repeat_is_lost_where_anchors_go_over_batches(seed, monkeypatch):
    rng = random.Random(seed)
    monkeypatch.setattr(repeats, "HELD", rng.choice([1, 2, 20, 250_000]))
    monkeypatch.setattr(repeats, "CHUNK", rng.choice([300, 2000, 4_000_000]))
    length, size = rng.choice([16, 17, 20, 31, 57, 100]), rng.choice([1, 3, 50, 10_000])
    letters = LETTERS[: rng.choice([2, 4, 16])]
    passages = ["".join(rng.choices(letters, k=rng.randrange(5, 3 * length))) for _ in range(4)]
    docs = []
    for doc in range(40):
        parts = [
            rng.choice(passages) if rng.random() < 0.5 else "".join(rng.choices(letters, k=15))
            for _ in range(rng.randrange(1, 6))
        ]
        docs.append((doc, "".join(parts).encode()))
    rows, crowd = met(stretch_table(docs, length, 3), size), rng.choice([1, 3, 1000])
    different = [r for r in rows if not r["repeated"]]
    per_anchor, wanted = Counter(r["anchor"] for r in different), {}
    for r in different:
        crowded = per_anchor[r["anchor"]] > crowd
        wanted.setdefault(r["doc"], []).append(r | {"crowded": crowded})
    ranges = [r | {"n": r["shape"] % length} for r in rows if r["repeated"]]
    ranges += cut_and_sorted(docs, wanted, length, size) if wanted else []
    found = {(r["doc"], r["start"] + i) for r in ranges for i in range(r["n"])}
    assert found == brute_windows(docs, length)
