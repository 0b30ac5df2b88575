from __future__ import annotations

import random
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from corpora import ODD_TEXTS, prose
from creditloom.llm import arrays, token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
TEXTS = [
    *ODD_TEXTS,
    "It's we'll don't 's' x'y ''s 's's\n's !'s 'llama 'Re 'VE we're I'd I'm they've'",
    "a<|endoftext|> b <|endoftext|><|endoftext|>  c<|endoftext|",
    "<|endoftext|>",
    "  two  spaces\t\ttabs \n\n lines  ",
    "x　y  z \x85 \x1c q   ",
    "123 4a5 ½ x́ ÀÉ×÷ ªº \U0001f600\U0001f600 ไทย 한국어 \U00020000",
    "'",
    "' ' '",
    *(" ".join(prose(k, 60)) for k in range(10)),
]


def expected(text):
    return len(LIBRARY.encode(text or "", add_special_tokens=False).ids)


def counts(df):
    return Counter((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in df.collect())


@pytest.mark.parametrize("head", [0, 20, 40, token_counts.HEAD])
def test_counts_are_those_of_the_library(spark, make_docs, head):
    rows = [(k - 3, text) for k, text in enumerate(TEXTS)] + [(None, "no id"), (1, "twice it's"), (1, "twice it's")]
    found = counts(token_counts.count_tokens(make_docs(rows).repartition(4), PATH, limit=50, head=head))
    want = Counter((i, len((t or "").encode()), expected(t), expected(t) > 50) for i, t in rows)
    assert found == want


def test_empty_table(spark, make_docs):
    assert token_counts.count_tokens(make_docs([]), PATH).collect() == []


def test_a_text_of_some_megabytes(spark, make_docs):
    text = " ".join(prose(5, 600_000, 100_000))
    assert len(text) > 3 << 20
    row = token_counts.count_tokens(make_docs([(1, text)]), PATH, head=100).first()
    assert (row.n_tokens, row.n_bytes, row.over_limit) == (expected(text), len(text), True)


def test_pre_tokens_are_those_of_the_library():
    """Random strings of signs that meet at every rule, split at special strings as the library does."""
    rnd = random.Random(4)
    signs = [" ", " ", "'", "s", "t", "re", "ve", "m", "ll", "d", "S", "7", "!", "\n", "\t", "　", "é", "٣", "漢", "<|endoftext|>", "<|", "՘"]
    texts = ["".join(rnd.choice(signs) for _ in range(rnd.randrange(12))) for _ in range(4000)]
    cutter = token_counts.Splitter(PATH)
    data, offsets = arrays.text_bytes(pa.array(texts))
    begins, ends, special = cutter.split(data, offsets)
    doc = np.searchsorted(offsets, begins, side="right") - 1
    found = [[] for _ in texts]
    for k, a, b, s in zip(doc.tolist(), begins.tolist(), ends.tolist(), special.tolist(), strict=True):
        found[k].append((data[a:b].tobytes().decode(), s))
    for text, cuts in zip(texts, found, strict=True):
        want = []
        for n, part in enumerate(text.split("<|endoftext|>")):
            want += [("<|endoftext|>", True)] if n else []
            want += [(part[a:b], False) for _, (a, b) in LIBRARY.pre_tokenizer.pre_tokenize_str(part)]
        assert cuts == want


def test_only_byte_level_tokenizers():
    with pytest.raises(ValueError, match="byte-level"):
        token_counts.Splitter(public_tokenizers.path("word_bpe_49k.json"))
