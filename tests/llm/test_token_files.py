from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from corpora import ODD_TEXTS, prose
from creditloom.llm import token_files

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [
    *ODD_TEXTS,
    "It's we'll don't 's' x'y  <|endoftext|> foo<|startoftext|>bar 1234",
    "İ ΣΑΣ é à\x1cb ½ x́ ÀÉ×÷ ªº  zero​width Straße ŒUVRE œuvre",
    "##!?%% a&b <b> <|x|>",
    *(" ".join(prose(k, 60)) for k in range(20)),
]


def expected(rows, end=2):
    library = Tokenizer.from_file(PATH)
    out, start = [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, *([] if end is None else [end])], "<u4")
        out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes()), ids.tobytes()))
        start += len(ids)
    return out


def written(spark, docs, tmp_path, end=2):
    token_files.write_ids(docs, str(tmp_path / "files"), PATH, end)
    found = token_files.read_ids(spark, str(tmp_path / "files"), with_ids=True).collect()
    return sorted(((r.doc_id, r.start, r.n_tokens, r.ids_crc32, bytes(r.ids)) for r in found), key=lambda r: r[1])


def test_files_give_back_the_library_s_ids(spark, make_docs, tmp_path):
    rows = [(k * 7 - 30, text) for k, text in enumerate(TEXTS)]
    assert written(spark, make_docs(rows).repartition(4), tmp_path) == expected(rows)


def test_documents_larger_than_a_block(spark, make_docs, tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "BLOCK_TOKENS", 50)
    rows = [(None, "first of all"), *((k, text) for k, text in enumerate(TEXTS))]
    assert written(spark, make_docs(rows), tmp_path) == expected(rows)
    assert max(r.tokens for r in spark.read.parquet(str(tmp_path / "files" / "blocks")).collect()) <= 50


def test_no_end_id_and_empty_table(spark, make_docs, tmp_path):
    rows = [(1, None), (2, ""), (3, "three")]
    assert [r for r in written(spark, make_docs(rows), tmp_path / "a", end=None) if r[0] == 3] == expected(rows, end=None)[2:]
    assert written(spark, make_docs([]), tmp_path / "b") == []


def test_rows_that_repeat_an_id(spark, make_docs, tmp_path):
    found = written(spark, make_docs([(5, "one"), (5, "one"), (5, "two words")]), tmp_path)
    assert [r[1] for r in found] == sorted(r[1] for r in found) and sum(r[2] for r in found) == 7


@pytest.mark.parametrize("count", [1, 2, 255, 256, 257, 5000, 70_000])
@pytest.mark.parametrize("symbols", [1, 3, 5000])
def test_blocks_round_trip(count, symbols):
    rnd = np.random.default_rng(count)
    ids = np.minimum(rnd.geometric(3 / symbols, count) if symbols > 1 else np.ones(count, int), symbols).astype(np.uint32)
    seen = np.flatnonzero(np.bincount(ids))
    table = token_files.Table(seen, token_files.Table.scaled(np.bincount(ids)[seen]))
    assert (token_files.decode_block(token_files.encode_block(ids, table), table) == ids).all()


def test_a_damaged_block_fails():
    ids = np.arange(2000, dtype=np.uint32) % 700
    table = token_files.Table(np.arange(700), token_files.Table.scaled(np.bincount(ids)))
    payload = bytearray(token_files.encode_block(ids, table))
    payload[32 + 16 + 2] ^= 1  # the first lane's state
    with pytest.raises(ValueError, match="checksum"):
        token_files.decode_block(bytes(payload), table)


def test_more_symbols_than_the_scale_holds(monkeypatch):
    monkeypatch.setattr(token_files, "SCALE_BITS", 4)
    ids = np.arange(3000, dtype=np.uint32)
    table = token_files.Table(ids.astype(int), token_files.Table.scaled(np.ones(3000, int)))
    assert (token_files.decode_block(token_files.encode_block(ids, table), table) == ids).all()


def test_joined_checksums():
    rnd = random.Random(1)
    for _ in range(20):
        a, b = rnd.randbytes(rnd.randrange(50)), rnd.randbytes(rnd.randrange(5000))
        assert token_files.crc32_joined(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)


def test_other_tokenizers_encode_whole_texts():
    coder = token_files.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert not coder.by_word
    for text in filter(None, TEXTS):
        assert np.frombuffer(coder.encode(pa.array([text]))[0].tobytes(), coder.dtype).tolist() == library.encode(text, add_special_tokens=False).ids
