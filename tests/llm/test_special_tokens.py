"""Packing against the tokenizer as it comes from the file."""

import numpy as np
from tokenizers import Tokenizer

from tenureframe.llm import packing
from tests.llm.test_llm_operators import BYTES, noise

END = "<|endoftext|>"
TEXTS = [
    END, f"a{END}", f"{END} b", f"a {END}  b\n{END}{END} c ", f"a  {END}\n\n", "<|endoftext |>",
    f"<|endof{END}text|>", "no special token", "",
]


def as_it_comes(texts):
    tokenizer = Tokenizer.from_file(BYTES)
    return [tokenizer.encode(text, add_special_tokens=False).ids for text in texts]


def test_special_tokens_are_single_ids():
    encoder = packing.UnitEncoder(BYTES, remember=50)
    texts = [*TEXTS, *noise(1, 1500)]
    for start in range(0, len(texts), 30):
        some = texts[start : start + 30]
        for text, found, ids in zip(some, encoder.encode_whole(some), as_it_comes(some)):
            assert np.frombuffer(found, encoder.dtype).tolist() == ids, repr(text)


def test_packed_ids_are_those_of_the_tokenizer(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    found = packing.packed_pieces(df.coalesce(1), BYTES).collect()
    ids = {r["id"]: np.frombuffer(r["ids"], "<u4").tolist() for r in found}
    assert ids == {i: [*x, 1] for i, x in enumerate(as_it_comes(TEXTS))}
    assert all(r["doc_tokens"] == len(ids[r["id"]]) for r in found)
