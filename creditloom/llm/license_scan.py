"""Search for short licence notices with spelling errors.

A text is reduced to its words, lower-cased and joined by one blank. Phrases that must stand word by word are counted
there. A notice may have some edits: cut into one piece more than that, at least one piece stands unchanged in every
occurrence. One Aho-Corasick pass finds all pieces of all notices, and only where one is found does the regex library
look for the notice within its bound of edits, in a window of the notice's length.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from creditloom.llm import arrays
from creditloom.llm.common import keyed, restored

#: Characters that don't belong to a word become blanks, A-Z become a-z; bytes from 0x80 on belong to words.
TO_WORDS = bytes(
    b + 0x20 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)

#: Phrases that count word by word, with their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}


@dataclass(frozen=True)
class Notice:
    label: str
    text: str  # words joined by one blank
    edits: int

    def pieces(self) -> list[tuple[int, str]]:
        """One piece more than edits, with its place."""
        cuts = [len(self.text) * k // (self.edits + 1) for k in range(self.edits + 2)]
        return [(a, self.text[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


#: Notices and the edits they may have: about one in ten characters, and pieces of six characters or more.
NOTICES = (
    Notice("near-gpl", "general public license", 2),
    Notice("near-reserved", "all rights reserved", 2),
    Notice("near-cc", "creative commons attribution", 3),
    Notice("apache", "licensed under the apache license", 3),
    Notice("mit", "permission is hereby granted free of charge", 4),
    Notice("mit", "released under the mit license", 3),
    Notice("bsd", "redistribution and use in source and binary forms", 5),
    Notice("mpl", "mozilla public license", 2),
    Notice("public-domain", "dedicated to the public domain", 3),
    Notice("proprietary", "proprietary and confidential", 3),
    Notice("no-warranty", "without warranty of any kind", 3),
)


@lru_cache(maxsize=8)
def searcher(notices: tuple[Notice, ...]):
    seeds: dict[str, list[tuple[int, int]]] = {}
    for k, notice in enumerate(notices):
        for place, piece in notice.pieces():
            seeds.setdefault(piece, []).append((k, place))
    automaton = ahocorasick.Automaton()
    for piece, uses in seeds.items():
        automaton.add_word(piece, (len(piece), uses))
    automaton.make_automaton()
    patterns = [regex.compile(f"(?b)(?:{regex.escape(n.text)}){{e<={n.edits}}}") for n in notices]
    return automaton, patterns


def normal(text: str | None) -> str:
    return b" ".join((text or "").encode().translate(TO_WORDS).split()).decode()


def exact_places(words: str, phrases: dict[str, str]) -> list[tuple[int, str]]:
    """First word and label of each place where a phrase's words stand consecutively."""
    found, framed = [], f" {words} "
    for phrase, label in phrases.items():
        wanted = f" {phrase} "
        at = framed.find(wanted)
        while at >= 0:
            found.append((framed.count(" ", 0, at), label))
            at = framed.find(wanted, at + 1)
    return found


def exact_spans(words: str, phrases: dict[str, str]) -> set[tuple[int, str]]:
    """First character and text of each place where a phrase's words stand consecutively."""
    found, framed = set(), f" {words} "
    for phrase in phrases:
        at = framed.find(f" {phrase} ")
        while at >= 0:
            found.add((at, phrase))
            at = framed.find(f" {phrase} ", at + 1)
    return found


def fuzzy_places(words: str, notices: tuple[Notice, ...]) -> list[tuple[str, int, int, int, float]]:
    """Label, first and last character plus one, edits, and likeness of each notice found, the exact ones included."""
    automaton, patterns = searcher(notices)
    begins: dict[int, set[int]] = {}
    for end, (size, uses) in automaton.iter(words):
        for k, place in uses:
            begins.setdefault(k, set()).add(end + 1 - size - place)
    found = []
    for k, places in sorted(begins.items()):
        notice, until = notices[k], -1
        for begin in sorted(places):
            low, high = max(0, begin - notice.edits, until), begin + len(notice.text) + notice.edits
            match = patterns[k].search(words, low, high) if high > low else None
            if match:
                until = match.end()
                edits = sum(match.fuzzy_counts)
                found.append((notice.label, match.start(), match.end(), edits, 1 - edits / len(notice.text)))
    return found


SPANS = "array<struct<label: string, first: int, last: int, edits: int, likeness: double>>"
SCHEMA = (
    "_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
    f"score double, spans {SPANS}"
)


def scan(phrases: dict[str, str], notices: tuple[Notice, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = pa.struct([("label", pa.string()), ("first", pa.int32()), ("last", pa.int32()), ("edits", pa.int32()), ("likeness", pa.float64())])
        types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), pa.list_(fields)]
        names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"]
        for batch in arrays.text_slices(batches, "_text"):
            rows = []
            for text in batch.column("_text").to_pylist():
                words = normal(text)
                exact, fuzzy = exact_places(words, phrases), fuzzy_places(words, notices)
                base = {label for _, label in exact}
                whole = exact_spans(words, phrases) if exact else ()
                # An exact phrase has its base label; a likeness label adds finds with edits or inside longer words.
                own = {
                    label
                    for label, first, last, edits, _ in fuzzy
                    if edits or not label.startswith("near-") or (first, words[first:last]) not in whole
                }
                places = [place for place, _ in exact]
                rows.append(
                    (
                        words.count(" ") + 1 if words else 0,
                        len(exact),
                        min(places, default=None),
                        max(places, default=None),
                        ",".join(sorted(base)),
                        ",".join(sorted(base | own)),
                        1.0 if exact else max((x[-1] for x in fuzzy), default=0.0),
                        [dict(zip(("label", "first", "last", "edits", "likeness"), x, strict=True)) for x in fuzzy],
                    )
                )
            columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("_id"), *columns], names=["_id", *names])

    return run


def scan_licenses(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", phrases: dict[str, str] = PHRASES, notices: tuple[Notice, ...] = NOTICES) -> DataFrame:
    """Per row: `doc_id`, word count, places and labels of the exact phrases, all labels, `score` and `spans`.

    Words are runs of 0-9, A-Z, a-z and characters beyond ASCII, with A-Z lower-cased; labels are distinct, sorted and joined by
    commas. `score` is 1 if a phrase stands exactly, else the largest share of a notice's characters without an edit, or 0. `spans` are the notices in the
    text reduced to its words, overlapping finds of one notice counted once. A null text is empty: no words, no labels,
    null places. Rows that repeat are scanned each; other columns are not read. An empty table gives no rows.
    """
    found = keyed(docs, text, doc_id).drop("_copy").mapInArrow(scan(phrases, notices), SCHEMA)
    return found.select(restored("_id").alias("doc_id"), *[c for c in found.columns if c != "_id"])
