from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from corpora import ASCII_LOWER, ODD_TEXTS, SPACE
from creditloom.llm import line_dedup


def brute(rows, min_chars=40, min_docs=5):
    key = lambda line: line.strip(SPACE).translate(ASCII_LOWER)
    holders = {}
    for doc_id, text in rows:
        for k in {key(x) for x in (text or "").split("\n")}:
            if len(k) >= min_chars:
                holders.setdefault(k, []).append(doc_id)
    keeper = {k: max(v) for k, v in holders.items() if len(v) >= min_docs}
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if keeper.get(key(x), doc_id) == doc_id]
        out.append((doc_id, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out)


def corpus(count=400, seed=1):
    rnd = random.Random(seed)
    shared = [f"Shared line number {k} with enough characters to count, ü" for k in range(30)]
    rows = []
    for doc_id in range(count):
        lines = [f"own line {doc_id} {k} " + "z" * rnd.randrange(60) for k in range(rnd.randrange(6))]
        if doc_id % 3 == 0:
            lines.append("\t " + shared[0].upper().replace("Ü", "ü") + " \r")  # in a third of all documents
        for _ in range(rnd.randrange(3)):
            lines.append(rnd.choice(shared))
        rnd.shuffle(lines)
        rows.append((doc_id * 3, "\n".join(lines)))
    return rows + [(10_000 + k, text) for k, text in enumerate(ODD_TEXTS)]


def report(df):
    return sorted(tuple(r) for r in line_dedup.line_report(df).collect())


def test_equals_brute_force(make_docs):
    rows = corpus()
    assert report(make_docs(rows).repartition(5)) == brute(rows)


def test_small_batches_and_ranges_give_the_same(spark, make_docs):
    rows = corpus(150, seed=2)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        assert report(make_docs(rows).repartition(3)) == brute(rows)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_ties_of_the_largest_id_and_repeated_rows_keep_their_lines(make_docs):
    line = "a line that is long enough to be counted at all"
    rows = [(1, line), (1, line), (2, line), (9, line), (9, line), (9, "other\n" + line)]
    found = report(make_docs(rows))
    assert [r[2] for r in found] == [1, 1, 1, 0, 0, 0]


def test_null_id_is_the_smallest(make_docs):
    line = "a line that is long enough to be counted at all"
    found = line_dedup.line_report(make_docs([(None, line), *((k, line) for k in range(-2, 3))])).collect()
    assert {r.doc_id: r.n_dropped for r in found} == {None: 1, -2: 1, -1: 1, 0: 1, 1: 1, 2: 0}


def test_empty_table(make_docs):
    assert report(make_docs([])) == []
    assert line_dedup.drop_shared_lines(make_docs([])).count() == 0


def test_texts_and_other_columns(make_docs):
    rows = corpus(60, seed=3)
    docs = make_docs(rows)
    out = line_dedup.drop_shared_lines(docs)
    assert out.schema == docs.schema
    expected = {r[0]: r[3] for r in brute(rows)}
    got = {r.doc_id: hashlib.sha256((r.text or "").encode()).hexdigest() for r in out.collect()}
    assert got == expected
    assert [r.text for r in out.where("doc_id = 10000").collect()] == [None]


def test_bitmaps(make_docs):
    line = "a line that is long enough to be counted at all"
    rows = [(k, f"first {k}\n{line}\nlast {k}") for k in range(6)]
    found = line_dedup.shared_line_bitmaps(make_docs(rows)).collect()
    assert sorted(r._id for r in found) == [0, 1, 2, 3, 4]
    for r in found:
        bits = np.unpackbits(np.frombuffer(zlib.decompress(bytes(r.keep)), np.uint8), count=r.n_lines, bitorder="little")
        assert bits.tolist() == [1, 0, 1] and r.n_dropped == 1


@pytest.mark.parametrize("min_docs", [1, 2])
def test_low_bounds(make_docs, min_docs):
    rows = [(1, "abc\nabc\nd"), (2, "ABC"), (3, "d")]
    found = sorted(tuple(r)[:2] for r in line_dedup.drop_shared_lines(make_docs(rows), min_chars=1, min_docs=min_docs).select("doc_id", "text").collect())
    assert found == [(1, ""), (2, "ABC"), (3, "d")]


def test_settled_copies_spread_over_the_keys():
    text = "a line that is long enough to count as one that many documents share"
    columns = {"_id": pa.array(range(300), pa.int64()), "_copy": pa.array([7] * 300, pa.int64()), "_text": pa.array([text] * 300)}
    out = list(line_dedup.map_lines(40, 5)(iter([pa.RecordBatch.from_pydict(columns)])))
    keys = [h for batch in out for h, holders in zip(*(batch.column(c).to_pylist() for c in ("h1", "holders")), strict=True) if not holders]
    assert len(keys) == 299 and len(set(keys)) == 299
