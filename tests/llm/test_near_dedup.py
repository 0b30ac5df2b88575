from __future__ import annotations

import random
import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpora import ASCII_LOWER, ODD_TEXTS, prose, words_of
from creditloom.llm import near_dedup
from creditloom.llm.components import components


def shingles(text, words):
    w = words_of((text or "").translate(ASCII_LOWER))
    if 0 < len(w) < words:
        return {tuple(w)}
    return {tuple(w[i : i + words]) for i in range(len(w) - words + 1)}


def brute(rows, words=5, percent=80):
    sets = [shingles(text, words) for _, text in rows]
    top = list(range(len(rows)))

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                if a != b:
                    top[max(a, b)] = min(a, b)
    out = []
    for i, (doc_id, _) in enumerate(rows):
        group = min(rows[k][0] for k in range(len(rows)) if find(k) == find(i))
        out.append((doc_id, len(sets[i]), group, group == doc_id))
    return sorted(out)


def edited(rnd, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rnd.randrange(len(words))] = f"e{rnd.randrange(10_000)}"
    return words


def corpus(seed=1, singles=60, groups=12, large=0):
    rnd = random.Random(seed)
    banner = prose(99, 14)
    rows = [prose(rnd.randrange(1 << 30), rnd.randrange(1, 120), 3000) for _ in range(singles)]
    rows = [x + banner if k % 3 == 0 else x for k, x in enumerate(rows)]
    for _ in range(groups):
        base = prose(rnd.randrange(1 << 30), rnd.randrange(8, 200), 3000)
        rows += [edited(rnd, base, rnd.randrange(0, 1 + len(base) // 18)) for _ in range(rnd.randrange(2, 6))]
        rows.append(base)
    base = prose(5, 120, 3000)
    rows += [edited(rnd, base, rnd.randrange(1, 6)) for _ in range(large)]
    rnd.shuffle(rows)
    texts = [" ".join(x) for x in rows] + ODD_TEXTS + ["One", "ONE \n", "Two Words"]
    return [(k * 2 + 5, text) for k, text in enumerate(texts)]


def found(df, **options):
    return sorted(tuple(r) for r in near_dedup.near_duplicates(df, **options).collect())


@pytest.mark.parametrize("words", [4, 5])
def test_equals_brute_force(make_docs, words):
    rows = corpus()
    assert found(make_docs(rows).repartition(3), words=words) == brute(rows, words)


def test_large_home_in_several_blocks(make_docs, monkeypatch):
    """A group of near copies that only hold together through each other, in blocks of eight."""
    monkeypatch.setattr(near_dedup, "BLOCK", 8)
    rows = corpus(seed=4, singles=30, groups=4, large=90)
    expected = brute(rows)
    assert max(np.unique([r[2] for r in expected], return_counts=True)[1]) > 30
    assert found(make_docs(rows).repartition(4)) == expected


def test_documents_of_a_template_part_before_the_last_round(make_docs, monkeypatch):
    """Half of each text is a template; only pairs that are near each other are left for the comparison of blocks."""
    monkeypatch.setattr(near_dedup, "BLOCK", 8)
    across_blocks = near_dedup.across_blocks

    def few(percent):
        run = across_blocks(percent)

        def checked(rows):
            assert rows["rep"].nunique() <= 4, len(rows)
            return run(rows)

        return checked

    monkeypatch.setattr(near_dedup, "across_blocks", few)
    rnd = random.Random(3)
    template = prose(77, 120, 3000)
    texts = [template + prose(200 + k, 80, 3000) for k in range(70)]
    texts += [edited(rnd, x, 2) for x in texts[:25]]
    rnd.shuffle(texts)
    rows = [(k, " ".join(x)) for k, x in enumerate(texts)]
    expected = brute(rows)
    assert max(np.unique([r[2] for r in expected], return_counts=True)[1]) == 2
    assert found(make_docs(rows).repartition(4)) == expected


def test_short_documents_that_share_half_are_not_fetched(make_docs, monkeypatch):
    """Two thirds of their shingles are less than sets of 33 and of the similarity have in common for certain."""

    def none(percent):
        def run(rows):
            raise AssertionError(f"{len(rows)} sets")

        return run

    monkeypatch.setattr(near_dedup, "within_block", none)
    shared = prose(7, 26, 3000)
    rows = [(k, " ".join(shared + prose(100 + k, 11, 3000))) for k in range(12)]
    expected = brute(rows)
    assert [r[1] for r in expected] == [33] * 12 and all(r[3] for r in expected)
    assert found(make_docs(rows)) == expected


@pytest.mark.parametrize("percent", [50, 80, 95])
def test_values_shared_for_certain(spark, percent):
    """Sets that just reach the similarity, with the values of one alone below all others, hold as many values together as each is taken to."""
    least = spark.range(1, 150).select("id", near_dedup.least_shared(F.col("id"), percent).alias("least"))
    least = {r.id: r.least for r in least.collect()}
    accident = max(1, int(near_dedup.INDEXED * near_dedup.least_share(near_dedup.INDEXED, percent / 100)))
    assert all(near_dedup.INDEXED >= least[n] >= min(accident, -(-percent * n // 100)) for n in least)
    for n in least:
        for m in range(n, min(100 * n // percent, 149) + 1):
            both = -(-percent * (n + m) // (100 + percent))  # the least intersection
            if both > n:
                continue
            for low in (np.arange(m - both), np.arange(n - both)):  # in the larger or in the smaller set
                shared = np.arange(1000, 1000 + both)
                rest = np.arange(5000, 5000 + n + m - 2 * both - len(low))
                one, two = np.concatenate([low, shared])[: near_dedup.INDEXED], np.concatenate([shared, rest])[: near_dedup.INDEXED]
                together = len(np.intersect1d(one, two))
                assert all(together >= least[x] or least[x] <= accident for x in (n, m)), (n, m)


def test_last_round_sends_a_class_to_few_blocks(make_docs, monkeypatch, tmp_path):
    """Copies of one text that are tied but no two of which are near: each meets all others, in blocks that grow with the home."""
    monkeypatch.setattr(near_dedup, "BLOCK", 4)
    across_blocks = near_dedup.across_blocks

    def counted(percent):
        run = across_blocks(percent)

        def noted(rows):
            (tmp_path / uuid.uuid4().hex).write_text(f"{len(rows)} {rows['rep'].nunique()}")
            return run(rows)

        return noted

    monkeypatch.setattr(near_dedup, "across_blocks", counted)
    rnd = random.Random(8)
    base = prose(9, 200, 3000)
    rows = [(k, " ".join(edited(rnd, base, 6))) for k in range(160)]
    expected = brute(rows)
    assert found(make_docs(rows).repartition(4)) == expected
    sent = [tuple(map(int, x.read_text().split())) for x in tmp_path.iterdir()]
    assert max(x[1] for x in sent) > 8
    assert sum(x[0] for x in sent) < 40 * len(rows)


def test_bitmap_holds_all_ids_and_few_others(spark):
    ids = spark.range(5, 50_000, 50).select(F.col("id").alias("rep")).union(spark.createDataFrame([(-3,)], "rep long"))
    rows = spark.range(-100, 50_000).select(F.col("id").alias("_id"), F.lit("x").alias("_text"))
    kept = near_dedup.perhaps_among(rows, ids)
    assert kept.columns == ["_id", "_text"]
    kept = [r._id for r in kept.collect()]
    assert {-3, *range(5, 50_000, 50)} <= set(kept)
    assert len(kept) == len(set(kept)) < 15_000
    assert near_dedup.perhaps_among(rows, ids.where("false")).count() == 0


def test_copies_and_repeated_rows(make_docs):
    text = " ".join(prose(1, 50))
    rows = [(9, text), (4, text.upper()), (4, text.upper()), (7, text + " more"), (None, text), (1, None)]
    got = [tuple(r) for r in near_dedup.near_duplicates(make_docs(rows)).collect()]
    assert sorted(got, key=repr) == sorted(
        [(9, 46, 4, False), (4, 46, 4, True), (4, 46, 4, True), (7, 47, 4, False), (None, 46, None, True), (1, 0, 1, True)], key=repr
    )


def test_kept_rows_have_all_columns(make_docs):
    text = " ".join(prose(1, 50))
    docs = make_docs([(3, text), (2, text), (5, "other"), (6, None), (None, text)])
    out = near_dedup.drop_near_duplicates(docs)
    assert out.schema == docs.schema
    assert sorted((r.doc_id for r in out.collect()), key=repr) == [2, 5, 6, None]


def test_empty_table(make_docs):
    assert found(make_docs([])) == []
    assert near_dedup.drop_near_duplicates(make_docs([])).count() == 0


def test_estimate_of_the_union(spark):
    rnd = np.random.default_rng(1)
    a = np.unique(rnd.integers(0, 1 << 63, 900, dtype=np.uint64))
    b = np.unique(np.concatenate([a[:800], rnd.integers(0, 1 << 63, 100, dtype=np.uint64)]))
    estimate = near_dedup.estimates(a[None, : near_dedup.SKETCH], b[None, : near_dedup.SKETCH])[0]
    union = np.union1d(a, b)[: near_dedup.SKETCH]
    assert estimate == np.isin(union, np.intersect1d(a, b)).mean()


def test_components_of_a_chain_and_a_star(spark):
    links = [(k, k + 1) for k in range(100, 160)] + [(500, k) for k in range(501, 560)] + [(7, 7), (160, 159)]
    rows = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r.node: r.component for r in rows} == {**{k: 100 for k in range(101, 161)}, **{k: 500 for k in range(501, 560)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
