from __future__ import annotations

import hashlib
import random

import pyarrow as pa
import pytest

from corpora import ODD_TEXTS, prose, words_of
from creditloom.llm import substring_dedup


def brute(rows, window=20):
    first = {}
    for doc_id, text in rows:
        w = words_of(text)
        for k in range(len(w) - window + 1):
            key, place = tuple(w[k : k + window]), (doc_id, k)
            first[key] = min(first.get(key, place), place)
    out = []
    for doc_id, text in rows:
        w = words_of(text)
        gone = set()
        for k in range(len(w) - window + 1):
            if first[tuple(w[k : k + window])] < (doc_id, k):
                gone.update(range(k, k + window))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((doc_id, len(w), len(gone), kept, hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


def corpus(seed=1, count=150):
    rnd = random.Random(seed)
    passages = [prose(k, rnd.randrange(15, 90)) for k in range(8)]
    rows = []
    for k in range(count):
        words = prose(1000 + k, rnd.randrange(0, 80))
        if k % 3 == 0:
            words += passages[0]
        for _ in range(rnd.randrange(3)):
            passage = rnd.choice(passages)
            a, b = sorted(rnd.sample(range(len(passage) + 1), 2))
            at = rnd.randrange(len(words) + 1)
            words[at:at] = passage[a:b]
        rows.append((k * 3 + 1, " ".join(words)))
    rows += [(2, rows[5][1]), (3, rows[0][1] + " tail"), (5000, "a b c " * 40), (5003, "same " * 100)]
    return rows + [(9000 + k, text) for k, text in enumerate(ODD_TEXTS)]


def found(df, **options):
    return sorted(tuple(r) for r in substring_dedup.without_repeats(df, **options).collect())


@pytest.mark.parametrize("window", [20, 8, 5])
def test_equals_brute_force(make_docs, window):
    rows = corpus()
    assert found(make_docs(rows).repartition(5), window=window) == brute(rows, window)


def test_small_batches_and_many_groups(make_docs, monkeypatch):
    monkeypatch.setattr(substring_dedup, "BATCH_BYTES", 500)
    monkeypatch.setattr(substring_dedup, "GROUP_BYTES", 300)
    rows = corpus(seed=2, count=80)
    assert found(make_docs(rows).repartition(4)) == brute(rows)


def test_a_hot_anchor_is_split(make_docs, monkeypatch):
    """A phrase of eight words that is the anchor of all windows around it, in otherwise different texts."""
    most = 9000
    monkeypatch.setattr(substring_dedup, "GROUP_BYTES", most)
    phrases = [prose(k, 8) for k in range(300)]
    phrase = min(phrases, key=lambda x: substring_dedup.suffixes(pa.array([" ".join(x)]), 8).anchor[0])
    rows = [(k, " ".join(prose(1000 + k, 20) + phrase + prose(5000 + k, 20))) for k in range(400)]
    rows += [(1000 + k, text + " end") for k, (_, text) in enumerate(rows[:50])]
    subtree = substring_dedup.subtree

    def bounded(window, parts):
        run = subtree(window, parts)

        def checked(table):
            labels = [x for a, x in zip(table.column("anchors").to_pylist(), table.column("labels").to_pylist(), strict=True) if a is not None]
            size = sum(map(len, labels)) // 8 * 9
            assert size <= 2.5 * most, size
            return run(table)

        return checked

    monkeypatch.setattr(substring_dedup, "subtree", bounded)
    assert found(make_docs(rows).repartition(4)) == brute(rows)


def test_copies_spread_over_the_parts(make_docs, monkeypatch):
    whole_documents, subtree = substring_dedup.whole_documents, substring_dedup.subtree

    def documents(column):
        return sum(len(x) for x in column.to_pylist()) // 16

    def bounded(table):
        assert documents(table.column("docs")) <= 150
        return whole_documents(table)

    def bounded_subtree(window, parts):
        run = subtree(window, parts)

        def checked(table):
            settled = table.filter(table.column("anchors").is_null())
            assert documents(settled.column("docs")) <= 150
            return run(table)

        return checked

    monkeypatch.setattr(substring_dedup, "whole_documents", bounded)
    monkeypatch.setattr(substring_dedup, "subtree", bounded_subtree)
    text = " ".join(prose(1, 60))
    rows = [(k, text) for k in range(300)] + [(1000 + k, " ".join(prose(50 + k, 40))) for k in range(50)]
    assert found(make_docs(rows).repartition(4)) == brute(rows)


def test_repeated_rows_and_null_ids(make_docs):
    text = " ".join(prose(3, 30))
    rows = [(4, text), (4, text), (9, text), (None, text)]
    got = {(r.doc_id, r.n_removed) for r in substring_dedup.without_repeats(make_docs(rows)).collect()}
    assert got == {(None, 0), (4, 30), (9, 30)}
    got = [(r.doc_id, r.n_removed) for r in substring_dedup.without_repeats(make_docs(rows[:3])).collect()]
    assert sorted(got) == [(4, 0), (4, 0), (9, 30)]


def test_empty_table(make_docs):
    assert found(make_docs([])) == []


def test_spans(make_docs):
    passage = prose(1, 40)
    rows = [(1, " ".join(passage)), (2, " ".join(["x", *passage, "y"]))]
    spans = substring_dedup.repeated_spans(make_docs(rows)).collect()
    assert [r._id for r in spans] == [2]
    assert substring_dedup.covered(bytes(spans[0].spans), 42).tolist() == [False, *[True] * 40, False]
