from __future__ import annotations

import random
import zlib

import public_tokenizers
import pytest

from corpora import ODD_TEXTS, prose
from creditloom.llm import piece_scan
from creditloom.llm.piece_scan import BLANK, START, backtrace, boundaries, packed, product, transfer

PATH = public_tokenizers.path("piece_bpe_32k.model")


def chunked(vocabulary, text, size):
    text, longest = BLANK + text.replace(" ", BLANK), vocabulary.longest
    out = []
    for low in range(0, len(text), size):
        left, high = max(0, low - longest), min(len(text), low + size)
        out.append((text[left : high + longest], low - left, high - left))
    return out


def samples(seed=5, count=150):
    rnd = random.Random(seed)
    runs = ["    ", "========", "the", "******", "aaaa", " ", "representations", "▁", "\n", "漢字", "é"]
    for k in range(count):
        if k % 3 == 0:
            yield " ".join(rnd.choice(["international", "Größe", "the", "x=1;", "naïve", "  "]) for _ in range(rnd.randrange(1, 60)))
        elif k % 3 == 1:
            yield "".join(rnd.choice("abcdest ionrgé 漢\n\t=-*  ") for _ in range(rnd.randrange(1, 200)))
        else:
            yield "".join(rnd.choice(runs) for _ in range(rnd.randrange(1, 40)))


@pytest.mark.parametrize("size", [17, 18, 23, 64])
def test_chunks_give_the_library_s_encoding(size):
    vocabulary = piece_scan.pieces(PATH)
    for text in samples(size):
        chunks = chunked(vocabulary, text, size)
        found = boundaries([transfer(vocabulary, part, a, b, k == 0) for k, (part, a, b) in enumerate(chunks)])
        ids = [i for chunk, states in zip(chunks, found, strict=True) for i in backtrace(vocabulary, *chunk, *states)]
        assert ids == vocabulary.library.encode(text), text


def test_products_are_associative():
    vocabulary = piece_scan.pieces(PATH)
    text = "thequickbrownfoxjumpsoverthelazydogrepresentationsinternationally" * 2
    a, b, c, *_ = [transfer(vocabulary, part, low, high, k == 0) for k, (part, low, high) in enumerate(chunked(vocabulary, text, 30))]
    assert product(product(a, b), c) == product(a, product(b, c)) and START in product(product(a, b), c)


@pytest.mark.parametrize("fan", [2, 3, 64])
def test_a_tree_of_fans_gives_the_states_of_the_whole(make_docs, monkeypatch, fan):
    monkeypatch.setattr(piece_scan, "FAN", fan)
    library = piece_scan.Pieces(PATH).library
    rows = [(k, text * 6) for k, text in enumerate(samples(9, 9))] + [(100, "representations of " * 400), (101, "x")]
    found = piece_scan.encode_pieces(make_docs(rows), PATH, giant=30, chunk=20).collect()
    assert {r._id: bytes(r.ids) for r in found} == {k: packed(library.encode(t)) for k, t in rows}


def test_boundaries_between_given_states():
    vocabulary = piece_scan.pieces(PATH)
    text = "the representations of internationally known 漢字 things " * 4
    matrices = [transfer(vocabulary, part, a, b, k == 0) for k, (part, a, b) in enumerate(chunked(vocabulary, text, 20))]
    whole = boundaries(matrices)
    for a, b in ((0, 4), (3, 9), (5, 6), (8, len(matrices))):
        assert boundaries(matrices[a:b], whole[a][0], whole[b - 1][1]) == whole[a:b]


def test_documents(make_docs):
    library = piece_scan.Pieces(PATH).library
    texts = [*ODD_TEXTS, *samples(1, 12), " ".join(prose(1, 900)), "nospaces" * 60, " " * 300]
    rows = [(k - 4, text) for k, text in enumerate(texts)] + [(None, texts[-2]), (500, texts[-2]), (500, texts[-2])]
    encoded = piece_scan.encode_pieces(make_docs(rows).repartition(3), PATH, giant=100, chunk=40)
    got = sorted(((r._id, bytes(r.ids)) for r in encoded.collect()), key=repr)
    assert got == sorted(((piece_scan_id(k), packed(library.encode(t or ""))) for k, t in rows), key=repr)
    report = piece_scan.piece_report(make_docs(rows), PATH, giant=100, chunk=40).collect()
    assert len(report) == len(rows)
    by_id = {r.doc_id: r for r in report}
    for doc_id, text in rows:
        ids = library.encode(text or "")
        r = by_id[doc_id]
        assert (r.n_pieces, r.ids_crc32, r.n_chars) == (len(ids), zlib.crc32(packed(ids)), len(library.decode(ids)))
        assert r.round_trip == (library.decode(ids) == (text or "")), text


def piece_scan_id(doc_id):
    return -(1 << 63) if doc_id is None else doc_id


def test_empty_table_and_bounds(make_docs):
    assert piece_scan.piece_report(make_docs([]), PATH).count() == 0
    with pytest.raises(ValueError, match="longer"):
        piece_scan.encode_pieces(make_docs([(1, "a")]), PATH, chunk=5)
