from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict
from functools import lru_cache

import pytest

from creditloom.llm import conversation_repair as repair

SCHEMA = "conv_id long, turn long, role string, text string, _id long, pos int, value string, rows int"
SPACE = " \t\n\x0b\x0c\r"


def table(spark, rows):
    return spark.createDataFrame([(*row, 1, 2, "x", 3) for row in rows], SCHEMA)


def damage(rows):
    """Rows after damage by conversation."""
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fate = zlib.crc32(key.encode()) % 20
        role, text = (" " if x is None else x for x in (role, text))
        out[conv] += []
        if fate:
            row = (turn, "user" if fate == 4 else role, "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text)
            out[conv] += [row] * (2 if fate == 3 else 1)
    return out


def cheapest(rows):
    """(cost, audit, lines) by trying every edit at every row; rows are (role, text, must go, late)."""

    @lru_cache(maxsize=None)
    def best(k, state, inserted):
        found = []
        if k == len(rows):
            if state in "-a":
                found.append((0, "", ()))
        else:
            role, text, must, late = rows[k]
            found.append(add(4, "D", (), best(k + 1, state, 0)))
            if not must:
                following = "a" if state == "u" else "u"
                name = {"u": "user", "a": "assistant"}[following]
                found.append(add(3 + late, "R", (f"{name}:{text}",), best(k + 1, following, 0)))
                if role[:1] == following:
                    found.append(add(late, "K", (f"{role}:{text}",), best(k + 1, following, 0)))
                if role[:1] == "s" and state == "-":
                    found.append(add(late, "K", (f"{role}:{text}",), best(k + 1, "s", 0)))
        if inserted < 3:
            following = "a" if state == "u" else "u"
            found.append(add(3, "I", (f"{'user' if following == 'u' else 'assistant'}:",), best(k, following, inserted + 1)))
        return min(filter(None, found), default=None)

    def add(cost, edit, lines, rest):
        return rest and (cost + rest[0], edit + rest[1], lines + rest[2])

    return best(0, "-", 0)


def expected(rows, damaged=True):
    out = []
    by_conversation = damage(rows) if damaged else defaultdict(list)
    if not damaged:
        for conv, turn, role, text in rows:
            by_conversation[conv].append((turn, *(" " if x is None else x for x in (role, text))))
    for conv, turns in by_conversation.items():
        turns.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, judged, counts = set(), [], [0, 0, 0]
        for _, role, text in turns:
            blank, again = not text.strip(SPACE), (role, text) in seen
            cut = not blank and text.rstrip(SPACE)[-1] not in ".!?"
            seen.add((role, text))
            counts[0] += blank
            counts[1] += again and not blank
            counts[2] += cut and not again
            judged.append((role, text, blank or again, 3 if cut else 0))
        initials = [r[1][:1] for r in turns]
        known = [r[0] for r in turns if r[0] is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
        cost, audit, lines = cheapest(tuple(judged))
        assert re.fullmatch("(s?(ua)+)?", "".join(line[0] for line in lines))
        out.append((conv, gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=repr)


def found(report):
    return sorted((tuple(r) for r in report.collect()), key=repr)


def conversations(seed, count, longest=12):
    rnd = random.Random(seed)
    texts = ["Yes.", "no", "What? ", "", " \t", "Well!\n", "x.y", None, "a\x1c", "é。", "1.", "2.", "3."]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None, "usher", "an"]
    rows = []
    for conv in range(count):
        for turn in range(rnd.randrange(1, longest)):
            place = rnd.choice([turn, turn, turn, turn + 3, 2, None])
            rows.append((conv * 3 - 9, place, rnd.choice(roles), rnd.choice([*texts, f"turn {turn}.", f"turn {turn}."])))
    return rows


ODD = [
    (None, 1, "user", "whose?"),
    (None, None, None, None),
    (500, 1, "user", "long " * 400_000),
    (501, 1, "user", "Hi."),
    (501, 1, "user", "Hi."),
    (501, 1, "user", "Hi."),
    (502, None, "system", "Only."),
    (503, 1, "system", "Be kind."),
    (503, 2, "user", "Hi."),
    (503, 2**40, "assistant", "Hello."),
]


@pytest.mark.parametrize("partitions", [1, 5])
def test_report_equals_every_edit_tried(spark, partitions):
    rows = conversations(1, 150) + ODD
    df = table(spark, rows).repartition(partitions)
    assert found(repair.repair_report(repair.damaged(df), times="times")) == expected(rows)
    assert found(repair.repair_report(df)) == expected(rows, damaged=False)


@pytest.mark.parametrize("block, fan", [(1, 2), (3, 2), (7, 256)])
def test_blocks_of_split_conversations(spark, monkeypatch, block, fan):
    """One conversation holds most rows, so that it spans tasks, blocks and fans."""
    monkeypatch.setattr(repair, "BLOCK_ROWS", block)
    monkeypatch.setattr(repair, "FAN", fan)
    hot = [(7, k // 2, *row[2:]) for k, row in enumerate(conversations(2, 40))]
    rows = conversations(3, 10) + hot
    assert found(repair.repair_report(repair.damaged(table(spark, rows)), times="times")) == expected(rows)


def test_everything_is_dropped_and_empty_table(spark):
    gone = next((c, t) for c in range(100) for t in range(100) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0)
    df = repair.damaged(table(spark, [(*gone, "user", "Hi.")]))
    nothing = hashlib.sha256(b"").hexdigest()
    assert found(repair.repair_report(df, times="times")) == [(gone[0], 0, 0, 0, 0, 0, 0, "", nothing)]
    assert found(repair.repair_report(table(spark, []))) == []


def test_turns_are_those_of_the_digest(spark, monkeypatch):
    monkeypatch.setattr(repair, "BLOCK_ROWS", 4)
    rows = conversations(5, 60)
    digests = {r.conv_id: r.repaired_sha256 for r in repair.repair_report(table(spark, rows)).collect()}
    lines = defaultdict(list)
    for r in sorted(repair.repaired_turns(table(spark, rows)).collect(), key=lambda r: (r.part, r.place)):
        lines[r.conv_id].append(f"{r.role}:{r.text}")
    assert {c: hashlib.sha256("\n".join(lines[c]).encode()).hexdigest() for c in digests} == digests


def some_rows(seed, count):
    rnd = random.Random(seed)
    return [repair.Row(rnd.choice(["user", "assistant", "system", "x"]), "", rnd.randrange(1, 3), rnd.random() < 0.8, rnd.choice([0, 3])) for _ in range(count)]


def test_only_checkpoints_are_kept():
    rows = some_rows(1, 1000)
    walk = repair.Walk(rows, repair.LAST)
    assert len(walk.marks) <= 1000 / 31 + 2
    costs = [repair.LAST]
    for row in reversed(rows):
        costs.append(repair.before(row, costs[-1]))
    costs.reverse()
    assert [c for k in range(0, 1000, walk.step) for c in walk.stretch(k)[:-1]] == costs[:-1]
    piece = repair.Piece()
    repair.finish(walk.run(repair.NOTHING, piece), piece)
    assert piece.cost == costs[0][repair.NOTHING]


def test_products_of_blocks_are_those_of_all_rows():
    rows = some_rows(2, 60)
    parts = [repair.transfer(rows[k : k + 20]) for k in (0, 20, 40)]
    left = repair.costs_product(repair.costs_product(parts[0], parts[1]), parts[2])
    right = repair.costs_product(parts[0], repair.costs_product(parts[1], parts[2]))
    assert left == right
    after = repair.LAST
    for row in reversed(rows):
        after = repair.before(row, after)
    assert repair.costs_before(left, list(repair.LAST)) == list(after)
