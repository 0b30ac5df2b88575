from __future__ import annotations

import re

from corpora import ASCII_LOWER, ODD_TEXTS, prose
from creditloom.llm import license_scan
from creditloom.llm.license_scan import NOTICES, PHRASES, Notice, fuzzy_places


def brute(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(ASCII_LOWER))
    places = []
    for phrase, label in PHRASES.items():
        wanted = phrase.split()
        places += [(k, label) for k in range(len(words)) if words[k : k + len(wanted)] == wanted]
    starts = [k for k, _ in places]
    labels = ",".join(sorted({x for _, x in places}))
    return len(words), len(places), min(starts, default=None), max(starts, default=None), labels


TEXTS = [
    *ODD_TEXTS,
    "Licensed under CC BY-NC 4.0. cc-by cc by CC  by",
    "GNU General Public License v3, general public license",
    "All rights reserved; all rights-reserved ALL RIGHTS RESERVED",
    "CC_BY ccby cc by, all rights reservedx general public licenses",
    "Tous droits: été 2020 cc by été",
    " ".join(prose(1, 200)) + " Permission is hereby granted, free of charge " + " ".join(prose(2, 50)),
]


def test_base_columns_equal_brute_force(make_docs):
    rows = [(k, text) for k, text in enumerate(TEXTS)]
    found = {r.doc_id: r for r in license_scan.scan_licenses(make_docs(rows).repartition(3)).collect()}
    for k, text in rows:
        r = found[k]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute(text), text
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
        assert 0 <= r.score <= 1


def labels(make_docs, text):
    r = license_scan.scan_licenses(make_docs([(1, text)])).first()
    return r.labels, r.score, [(s.label, s.edits) for s in r.spans]


def test_notices_with_errors(make_docs):
    noise = " ".join(prose(3, 30))
    assert labels(make_docs, f"{noise} Permision is herby granted free of charge {noise}")[0] == "mit"
    assert labels(make_docs, f"{noise} Gneral Public Licence {noise}")[0] == "near-gpl"
    assert labels(make_docs, f"{noise} al rights reservd {noise}")[0] == "near-reserved"
    text, score, spans = labels(make_docs, f"{noise} all rights reserved {noise}")
    assert (text, score, spans) == ("reserved", 1.0, [("near-reserved", 0)])
    assert labels(make_docs, noise) == ("", 0.0, [])


def test_notices_inside_longer_words_have_their_labels(make_docs):
    noise = " ".join(prose(3, 30))
    for text, label in [
        ("general public licenses", "near-gpl"),
        ("all rights reservedx", "near-reserved"),
        ("all rights reserved2024", "near-reserved"),
        ("overall rights reserved", "near-reserved"),
    ]:
        assert labels(make_docs, f"{noise} {text} {noise}")[:2] == (label, 1.0), text
    both = labels(make_docs, f"general public license {noise} general public licenses")
    assert both[0] == "gpl,near-gpl"
    assert labels(make_docs, f"all rights reserved {noise} all rights reserved")[0] == "reserved"


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_every_place_within_the_bound_is_found():
    import random

    rnd = random.Random(1)
    for notice in NOTICES:
        for _ in range(20):
            text = list(notice.text)
            for _ in range(rnd.randrange(notice.edits + 1)):
                kind, at = rnd.randrange(3), rnd.randrange(len(text))
                if kind == 0:
                    text[at] = "q"
                elif kind == 1:
                    del text[at]
                else:
                    text.insert(at, "q")
            words = "start " + "".join(text) + " end"
            found = fuzzy_places(words, (notice,))
            assert len(found) == 1 and found[0][3] <= notice.edits, (notice, words)
            assert distance(words[found[0][1] : found[0][2]], notice.text) == found[0][3]
        assert fuzzy_places("nothing of the kind here", (notice,)) == []


def test_pieces_cover_the_notice():
    for notice in (*NOTICES, Notice("x", "abcdefgh", 3)):
        assert "".join(p for _, p in notice.pieces()) == notice.text and len(notice.pieces()) == notice.edits + 1


def test_repeated_rows_null_ids_and_no_rows(make_docs):
    rows = [(1, "cc by"), (1, "cc by"), (None, "cc by")]
    assert [r.base_labels for r in license_scan.scan_licenses(make_docs(rows)).collect()] == ["cc-by"] * 3
    assert license_scan.scan_licenses(make_docs([])).count() == 0
