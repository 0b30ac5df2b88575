from __future__ import annotations

import math
import random

import numpy as np
import pytest

from corpora import ODD_TEXTS, SPACE, words_of
from creditloom.llm import quality_rules
from creditloom.llm.quality_rules import RULES, fit_votes

VOCABULARY = [f"{a}{b}{c}" for a in ("ma", "ri", "to", "ne") for b in ("la", "ko", "su", "") for c in ("n", "re", "t", "vi")]


def brute(rows):
    out = []
    for doc_id, text in rows:
        text = text or ""
        words = words_of(text)
        lines, seen, dup = text.split("\n"), set(), 0
        for line in lines:
            if line.strip(SPACE):
                dup += line in seen
                seen.add(line)
        windows = {}
        for k in range(len(words) - 2):
            windows.setdefault(tuple(words[k : k + 3]), []).append(k)
        repeated = {k + i for ks in windows.values() if len(ks) > 1 for k in ks for i in range(3)}
        failed = len(words) < 50 or 100 * len(repeated) > 50 * len(words)
        out.append((doc_id, len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(repeated), failed))
    return sorted(out, key=repr)


def prose_text(rnd, sentences):
    lines = []
    for _ in range(sentences):
        words = [rnd.choice(VOCABULARY) + rnd.choice(VOCABULARY) for _ in range(rnd.randrange(6, 14))]
        lines.append(" ".join(words).capitalize() + ".")
    return "\n".join(lines)


def junk_text(rnd, kind):
    words = prose_text(rnd, 12).split()
    if kind == 0:
        return " ".join(f"{w}{rnd.choice(['%%%', '###', '&&'])}" for w in words)
    if kind == 1:
        return " ".join(w.upper() + "!!" for w in words)
    return " | ".join(words)


def corpus(seed=1, count=200):
    rnd = random.Random(seed)
    rows = [(k, junk_text(rnd, k % 3) if k % 8 == 0 else prose_text(rnd, rnd.randrange(9, 20))) for k in range(count)]
    lines = "one line of text\nanother line\n" * 30
    return rows + [(1000, lines), (1001, "spam " * 80)] + [(2000 + k, text) for k, text in enumerate(ODD_TEXTS)]


def test_base_columns_equal_brute_force(make_docs):
    rows = corpus()
    found = quality_rules.quality_report(make_docs(rows).repartition(3)).collect()
    got = sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in found), key=repr)
    assert got == brute(rows)
    assert all(not r.kept for r in found if r.base_failed)
    assert all(0 <= r.quality <= 1 for r in found)


def test_prose_stays_and_junk_goes(make_docs):
    found = {r.doc_id: r.kept for r in quality_rules.quality_report(make_docs(corpus())).collect()}
    assert all(found[k] == (k % 8 != 0) for k in range(200))


def test_rates_are_learned_from_votes_alone():
    rnd = np.random.default_rng(1)
    good = rnd.random(20_000) < 0.8
    right = [0.95, 0.9, 0.85, 0.7, 0.6]
    votes = np.where(rnd.random((20_000, 5)) < right, 1, -1) * np.where(good, 1, -1)[:, None]
    votes[rnd.random(votes.shape) < 0.3] = 0
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    model = fit_votes(patterns, counts.astype(float))
    assert model.prior == pytest.approx(0.8, abs=0.03)
    assert model.on_good == pytest.approx(right, abs=0.04)
    assert ((model.posterior(votes) >= 0.5) == good).mean() > 0.94


def brute_votes(text):
    """What each rule says of a text, from the text itself."""
    words, letters = words_of(text), [c for c in text if c.isascii() and c.isalpha()]
    lines = [line.strip(SPACE) for line in text.split("\n") if line.strip(SPACE)]
    good = lambda w: all(c in "'-" or not c.isascii() or c.isalnum() for c in w)
    plain = sum(good(w) or len(w.encode()) > 1 and w[-1] in ".,;:?!" and good(w[:-1]) for w in words)
    shouted = sum(len(w) > 2 and w[-1] in "!?" and w[-2] in "!?" for w in words)
    repeated = brute([(0, text)])[0][5]
    parts = {
        "symbols": (sum(c in "#*$%&|<>" for c in text), len(words)),
        "plain_words": (plain, len(words)),
        "ended_lines": (sum(line[-1] in ".?!:;\"')" for line in lines), len(lines)),
        "repeated_words": (repeated, len(words)),
        "capitals": (sum(c.isupper() for c in letters), len(letters) if len(letters) >= 20 else 0),
        "repeated_lines": (len(lines) - len(set(text_lines(text))), len(lines) if len(lines) >= 4 else 0),
        "vocabulary": (len(set(words)), len(words) if len(words) <= 2000 else 0),
        "shouting": (shouted, len(words)),
        "word_length": (sum(map(len, words)), len(words)),
    }
    bad = {
        "symbols": lambda x: x > 0.3, "plain_words": lambda x: x < 0.7, "ended_lines": lambda x: x < 0.2, "repeated_words": lambda x: x > 0.3,
        "capitals": lambda x: x > 0.5, "repeated_lines": lambda x: x > 0.3, "vocabulary": lambda x: x < 0.15, "shouting": lambda x: x > 0.2,
        "word_length": lambda x: x < 2.5 or x > 14,
    }
    praise = {"symbols": lambda x: x < 0.05, "plain_words": lambda x: x > 0.9, "ended_lines": lambda x: x > 0.8}
    votes = []
    for name, (part, whole) in parts.items():
        if not whole:
            votes.append(0)
        elif bad[name](part / whole):
            votes.append(-1)
        else:
            votes.append(int(praise[name](part / whole)) if name in praise else 1)
    return votes


def text_lines(text):
    return [line for line in text.split("\n") if line.strip(SPACE)]


def brute_quality(votes, rounds=200):
    """The posterior of each document by the same estimate, document by document."""
    alarm = [rule.good is None for rule in RULES]
    prior, weight = 0.9, max(1.0, 0.02 * len(votes))
    start = [[ring if a else 0.9 for a in alarm] for ring in (0.98, 0.3)]
    right = [list(start[0]), list(start[1])]

    def posterior(row):
        odds = math.log(prior / (1 - prior))
        for k, vote in enumerate(row):
            if vote > 0:
                odds += math.log(right[0][k] / (1 - right[1][k]))
            elif vote < 0:
                odds += math.log((1 - right[0][k]) / right[1][k])
        return 1 / (1 + math.exp(-odds))

    for _ in range(rounds):
        good = [posterior(row) for row in votes]
        rates = [[], []]
        for side, sign in ((0, 1), (1, -1)):
            for k in range(len(RULES)):
                mass = [g if side == 0 else 1 - g for g in good]
                hits = sum(m for m, row in zip(mass, votes, strict=True) if row[k] == sign)
                cast = sum(m for m, row in zip(mass, votes, strict=True) if row[k])
                rates[side].append(min(0.999, max(0.001, (hits + weight * start[side][k]) / (cast + weight))))
        rates[1] = [min(0.999, max(1.001 - a, b)) for a, b in zip(*rates, strict=True)]
        right, prior = rates, min(0.99, max(0.01, sum(good) / len(votes)))
    return [posterior(row) for row in votes]


def test_verdicts_equal_brute_force(make_docs):
    rows = corpus(seed=7, count=120)
    judged = {r.doc_id: (r.base_failed, r.kept, r.quality) for r in quality_rules.quality_report(make_docs(rows).repartition(3)).collect()}
    passed = [(k, text) for k, text in rows if not brute([(k, text)])[0][6]]
    quality = brute_quality([brute_votes(text) for _, text in passed])
    assert {k for k, (failed, _, _) in judged.items() if not failed} == {k for k, _ in passed}
    for (k, _), want in zip(passed, quality, strict=True):
        assert judged[k][2] == pytest.approx(want, abs=1e-6) and judged[k][1] == (want >= 0.5)
    assert not any(kept for failed, kept, _ in judged.values() if failed)


def test_one_vote_does_not_outweigh_the_others():
    # Alarms keep still throughout, which is a weak vote for good.
    patterns = np.array([[sign if rule.good else 1 for rule in RULES] for sign in (1, 1, -1)])
    patterns[1, 0] = -1
    model = fit_votes(patterns, np.array([900.0, 50.0, 50.0]), tuple(rule.good is None for rule in RULES))
    assert (model.posterior(patterns) >= 0.5).tolist() == [True, True, False]


def test_rules_that_do_not_apply_abstain(make_docs):
    """Above 2,000 words the vocabulary says nothing, nor do capitals of a few letters; a silent alarm that applies votes."""
    words = [f"w{'abcdefghij'[k % 10]}{'klmnopqrst'[k // 10 % 10]}" for k in range(100)]
    texts = {1: " ".join(words * 30), 2: " ".join(words * 2), 3: " ".join("1234567" for _ in range(60))}
    votes = {r._id: dict(zip((rule.name for rule in RULES), r.votes, strict=True)) for r in quality_rules.judge(make_docs(list(texts.items()))).collect()}
    assert (votes[1]["vocabulary"], votes[2]["vocabulary"]) == (0, 1)
    assert (votes[1]["capitals"], votes[3]["capitals"]) == (1, 0)
    assert votes[1]["repeated_lines"] == 0 and votes[2]["shouting"] == 1


def test_an_abstention_says_nothing():
    model = fit_votes(np.zeros((1, 3), int), np.array([10.0]))
    assert model.posterior(np.zeros((1, 3), int))[0] == pytest.approx(model.prior)


def test_kept_rows_have_all_columns(make_docs):
    rows = corpus(seed=2, count=40)
    docs = make_docs([*rows, rows[1], (None, rows[2][1]), (rows[3][0], None)])
    out = quality_rules.keep_good(docs)
    assert out.schema == docs.schema
    ids = [r.doc_id for r in out.collect()]
    assert ids.count(rows[1][0]) == 2 and None in ids and ids.count(rows[3][0]) == 1


def test_without_rows(make_docs):
    assert quality_rules.quality_report(make_docs([])).count() == 0
    assert quality_rules.keep_good(make_docs([])).count() == 0
    assert quality_rules.quality_report(make_docs([(1, None)])).first().kept is False
