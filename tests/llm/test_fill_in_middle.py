from __future__ import annotations

import hashlib
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpora import ODD_TEXTS, prose
from creditloom.llm.fill_in_middle import RankIndex, fill_in_middle, original

TEXTS = [*ODD_TEXTS, "has <P> inside", "<M>", "ends with <", "<S", "naïve Größe, 漢字!\r\n\U0001f600x", *(" ".join(prose(k, 80)) for k in range(60))]


def brute(doc_id, text, plain_from=90, spm_below=20):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    n = len(units)
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    before, inside, after = ("".join(x) for x in (units[:low], units[low:high], units[high:]))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= plain_from:
        return doc_id, n, "plain", None, None, text
    if h[3] % 100 < spm_below:
        return doc_id, n, "spm", len(before), len(inside), f"<S>{after}<P>{before}<M>{inside}"
    return doc_id, n, "psm", len(before), len(inside), f"<P>{before}<S>{after}<M>{inside}"


@pytest.mark.parametrize("error", [1, 100])
@pytest.mark.parametrize("shares", [(90, 20), (100, 50)])
def test_outputs_equal_brute_force_and_round_trip(spark, make_docs, error, shares):
    rows = [(k * 3 - 9, text) for k, text in enumerate(TEXTS)] + [(None, "no id here"), (4, "twice"), (4, "twice")]
    made = fill_in_middle(make_docs(rows).repartition(3), plain_from=shares[0], spm_below=shares[1], error=error)
    found = made.withColumn("text", original(F.col("form"), F.col("output"))).collect()
    assert Counter(tuple(r)[:6] for r in found) == Counter(brute(*row, *shares) for row in rows)
    assert Counter((r.doc_id, r.text) for r in found) == Counter((i, t or "") for i, t in rows)
    assert {r.form for r in found} == {"plain", "psm", "spm"}


def test_empty_table(spark, make_docs):
    assert fill_in_middle(make_docs([])).collect() == []


def test_a_text_of_some_megabytes(spark, make_docs):
    text = " ".join(prose(3, 500_000)) + "é" * 100_000
    row = fill_in_middle(make_docs([(2, text)]), plain_from=100).first()
    assert tuple(row) == brute(2, text, 100)


@pytest.mark.parametrize("error", [1, 3, 100, 500])
@pytest.mark.parametrize("longest", [1, 2, 9, 5000])
def test_every_place_is_exact_and_segments_are_bounded(error, longest):
    places = np.cumsum(np.random.default_rng(longest).integers(1, longest + 1, 3000))
    index = RankIndex(places, error)
    assert [index.place(k) for k in range(len(places))] == places.tolist()
    assert abs(index.residuals.astype(int)).max() <= error + 1
    if longest == 1:
        assert len(index.first) == 1  # a straight line is one segment


def test_places_on_few_segments():
    places = np.cumsum(np.random.default_rng(1).integers(1, 8, 50_000))
    assert len(RankIndex(places, 100).first) < len(places) / 200
