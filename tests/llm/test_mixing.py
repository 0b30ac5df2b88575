from __future__ import annotations

import math
import random
import struct

import numpy as np
import pytest
import xxhash

from corpora import ODD_TEXTS, prose, words_of
from creditloom.llm import mixing


def corpus(seed=1, hot=150, sources=8):
    rnd = random.Random(seed)
    rows = []
    for k in range(hot + 12 * sources):
        source = "hot" if k < hot else f"s{k % sources}"
        rows.append((k, " ".join(prose(k, rnd.randrange(1, 60))), "en", source))
    return rows


def tokens(rows):
    out = {}
    for row in rows:
        source = row[3] if len(row) > 3 else None
        out[source] = out.get(source, 0) + len(words_of(row[1]))
    return out


def weights(sizes, exponent):
    total = sum(sizes.values())
    powers = {k: (n / total) ** exponent for k, n in sizes.items() if n}
    return {k: p / sum(powers.values()) for k, p in powers.items()}


def entropy(shares):
    return -sum(w * math.log(w) for w in shares.values())


def test_wanted_entropy(make_docs):
    rows = corpus()
    sizes = tokens(rows)
    found = mixing.mixture(make_docs(rows), entropy=0.97)
    got = {r.source: r.weight for r in found.sources.collect()}
    assert got == pytest.approx(weights(sizes, found.exponent))
    assert entropy(got) == pytest.approx(0.97 * math.log(len(sizes)), abs=1e-8)


def test_wanted_repetition(make_docs):
    rows = corpus()
    found = mixing.mixture(make_docs(rows), max_epochs=2.5)
    epochs = [r.epochs for r in found.sources.collect()]
    assert max(epochs) == pytest.approx(2.5, abs=1e-6) and min(epochs) == pytest.approx(1, abs=1e-6)
    found = mixing.mixture(make_docs(rows), max_epochs=1.0)
    assert found.exponent == pytest.approx(1, abs=2e-9)
    found = mixing.mixture(make_docs(rows), max_epochs=1000.0)
    assert found.exponent == 0


def test_budget_is_spent(make_docs):
    rows = corpus()
    sizes = tokens(rows)
    budget = 1.3 * sum(sizes.values())
    plan = mixing.schedule(make_docs(rows), max_epochs=3.0, budget=budget).collect()
    assert len(plan) == len(rows)
    spent = {}
    for r in plan:
        spent[r.source] = spent.get(r.source, 0) + r.copies * r.n_tokens
        assert math.floor(r.epochs) <= r.copies <= math.ceil(r.epochs)
    longest = max(len(words_of(r[1])) for r in rows)
    for r in {(r.source, r.weight) for r in plan}:
        assert 0 <= spent[r[0]] - r[1] * budget <= longest


def test_blocks_are_permuted_and_sources_read_alongside(make_docs, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_DOCS", 10)
    rows = corpus()
    report = mixing.mixing_report(make_docs(rows), max_epochs=2.0).collect()
    assert {r.doc_id for r in report} == {r[0] for r in rows}
    report.sort(key=lambda r: r.place)
    assert all(0 <= r.place <= 1 for r in report)
    half = report[: len(report) // 2]
    for source, weight in {(r.source, r.weight) for r in report}:
        share = sum(r.n_tokens for r in half if r.source == source) / sum(r.n_tokens for r in half)
        assert share == pytest.approx(weight, rel=0.35)
    hot = [r.doc_id for r in report if r.source == "hot" and r.epoch == 0]
    assert hot != sorted(hot)


def hashed(*values):
    """Spark's 64-bit hash of columns: of each value with the hash of those before as the seed."""
    seed = 42
    for value in values:
        packed = value if isinstance(value, bytes) else struct.pack("<i" if isinstance(value, np.int32) else "<q", value)
        seed = xxhash.xxh64_intdigest(packed, seed)
    return struct.unpack("<q", struct.pack("<Q", seed))[0]


def brute_schedule(rows, max_epochs, block_docs, seed=3):
    """(doc_id, source, tokens, epoch, place) of every reading, source by source and document by document."""
    sizes, seed = tokens(rows), np.int32(seed)
    total = sum(sizes.values())

    def spread(exponent):
        gains = [(n / total) ** (exponent - 1) for n in sizes.values()]
        return max(gains) / min(gains)

    low, high = 0.0, 1.0
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (low, middle) if spread(middle) <= max_epochs else (middle, high)
    exponent = math.ceil((0.0 if spread(0.0) <= max_epochs else high) * 1e9) / 1e9
    weight = weights(sizes, exponent)
    spent = max(n / weight[s] for s, n in sizes.items())
    out = []
    for source, size in sizes.items():
        own = [(k, hashed((text or "").encode()), len(words_of(text))) for k, text, _, s in rows if s == source]
        epochs = round(round(weight[source], 12) * spent / size, 9)
        whole, n_blocks = math.floor(epochs), -(-len(own) // block_docs)
        block = {k: hashed(k, copy, seed) % n_blocks for k, copy, _ in own}
        outer = {b: (hashed(seed, whole, b), b) for b in set(block.values())}
        own.sort(key=lambda d: (outer[block[d[0]]], hashed(seed, whole, d[0], d[1]), d[0], d[1]))
        before = 0
        for k, _, n in own:
            copies = whole + (before < (epochs - whole) * size)
            out += [(k, source, n, e, round(before / size / epochs + e / epochs, 7)) for e in range(copies)]
            before += n
    return sorted(out)


@pytest.mark.parametrize("max_epochs", [1.0, 1.7, 3.0, 50.0])
def test_schedule_equals_brute_force(make_docs, monkeypatch, max_epochs):
    monkeypatch.setattr(mixing, "BLOCK_DOCS", 10)
    rows = corpus(seed=4)
    report = mixing.mixing_report(make_docs(rows).repartition(3), max_epochs=max_epochs).collect()
    assert sorted((r.doc_id, r.source, r.n_tokens, r.epoch, round(r.place, 7)) for r in report) == brute_schedule(rows, max_epochs, 10)


def test_same_rows_on_every_run(make_docs):
    rows = corpus(seed=2)
    one = sorted(map(tuple, mixing.mixing_report(make_docs(rows).repartition(2), max_epochs=1.7).collect()))
    two = sorted(map(tuple, mixing.mixing_report(make_docs(rows).repartition(7), max_epochs=1.7).collect()))
    assert [r[:5] for r in one] == [r[:5] for r in two]


def test_rows_keep_their_columns_and_none_is_left_out(make_docs):
    rows = corpus(seed=3)
    docs = make_docs(rows)
    out = mixing.mix(docs, max_epochs=2.0)
    assert out.schema == docs.schema
    seen = [r.doc_id for r in out.collect()]
    assert set(seen) == {r[0] for r in rows} and max(seen.count(k) for k in set(seen)) == 2


def test_odd_rows(make_docs):
    rows = [(k, text, None, None) for k, text in enumerate(ODD_TEXTS)] + [(50, "a b", None, "a"), (50, "a b", None, "a"), (None, "c", None, "a"), (60, None, None, "empty")]
    plan = mixing.schedule(make_docs(rows), max_epochs=3000.0).collect()
    assert len(plan) == len(rows)
    assert {r.copies for r in plan if r.source == "empty"} == {0}
    assert all(r.copies >= 1 for r in plan if r.source != "empty")


def test_without_rows_or_words(make_docs):
    assert mixing.mixing_report(make_docs([]), max_epochs=2.0).count() == 0
    assert mixing.mix(make_docs([(1, None)]), max_epochs=2.0).count() == 0


def test_targets_that_cannot_be_met(make_docs):
    docs = make_docs(corpus())
    with pytest.raises(ValueError, match="either"):
        mixing.mixture(docs)
    with pytest.raises(ValueError, match="closer"):
        mixing.mixture(docs, entropy=0.1)
    with pytest.raises(ValueError, match="limit"):
        mixing.mixture(docs, max_epochs=1.0, budget=1e9)


def test_no_python_in_the_plan(make_docs):
    plan = mixing.mix(make_docs(corpus()), max_epochs=2.0)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
