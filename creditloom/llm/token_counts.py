"""Token counts without ids: pieces are counted once for each distinct pre-token of the corpus.

A byte-level tokenizer cuts a text at its special strings, then into pre-tokens, and merges bytes within a pre-token only. The
number of a text's tokens is therefore the sum, over its distinct pre-tokens, of how often each stands there times its pieces.

Three steps: distinct pre-tokens of the corpus with their frequencies, each through the tokenizer once; per document the
frequencies of its pre-tokens; the join of both. The `head` most frequent pre-tokens, a bounded list, travel to every task and
are joined there, so that no key of the shuffled join is a frequent one.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from creditloom.llm import arrays
from creditloom.llm.common import keyed, restored, staged

#: At most so many of the most frequent pre-tokens are joined without a shuffle: 20 bytes each on the driver and in every task.
HEAD = 1 << 18
SLICE_BYTES = 2 << 20

LETTER, DIGIT, OTHER, BLANK, SPACE, SPECIAL = range(6)
UNKNOWN = 255

#: What the pre-tokenizer cuts off after a letter, a digit or a blank, whatever follows.
CONTRACTIONS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")


class Splitter:
    """Pre-tokens of many texts at once, as the library of a byte-level tokenizer cuts them."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        with open(path, encoding="utf-8") as file:
            config = json.load(file)
        cut = config.get("pre_tokenizer") or {}
        added = config.get("added_tokens") or []
        if (
            cut.get("type") != "ByteLevel"
            or cut.get("add_prefix_space")
            or not cut.get("use_regex", True)
            or config.get("normalizer")
            or config["model"]["type"] != "BPE"
            or any(x["single_word"] or x["lstrip"] or x["rstrip"] for x in added)
        ):
            raise ValueError("counting by pre-tokens needs a byte-level tokenizer without normalizer and prefix space")
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        # Where one special string is the start of another, the longer one counts.
        self.specials = sorted((x["content"].encode() for x in added), key=len, reverse=True)
        self.classes = np.full(0x110000, UNKNOWN, np.uint8)
        self.learn(np.arange(128))

    def learn(self, codes: np.ndarray) -> None:
        """Asks the library for the class of characters: its Unicode tables are its own."""
        split = self.tokenizer.pre_tokenizer.pre_tokenize_str
        for code in codes.tolist():
            char = chr(code)
            # A letter joins the letters before it, a digit the digits after it, other signs neither; blanks fall apart.
            cuts = [span for _, span in split(f"a{char}{char}1")]
            kinds = {((0, 3), (3, 4)): LETTER, ((0, 1), (1, 4)): DIGIT, ((0, 1), (1, 3), (3, 4)): OTHER}
            self.classes[code] = kinds.get(tuple(cuts), BLANK)
        self.classes[ord(" ")] = SPACE

    def class_of(self, data: np.ndarray, chars: np.ndarray) -> np.ndarray:
        """The class of each character; `chars` are the places of their first bytes."""
        lead = data[chars].astype(np.int32)
        wide = np.flatnonzero(lead >= 0x80)
        if len(wide):
            at = chars[wide]
            tail = [data[np.minimum(at + k, len(data) - 1)].astype(np.int32) & 0x3F for k in (1, 2, 3)]
            first = lead[wide]
            two = (first & 0x1F) << 6 | tail[0]
            three = (first & 0x0F) << 12 | tail[0] << 6 | tail[1]
            four = (first & 0x07) << 18 | tail[0] << 12 | tail[1] << 6 | tail[2]
            lead[wide] = np.where(first < 0xE0, two, np.where(first < 0xF0, three, four))
        found = self.classes[lead]
        new = np.unique(lead[found == UNKNOWN])
        if len(new):
            self.learn(new)
            found = self.classes[lead]
        return found

    def special_spans(self, data: np.ndarray) -> list[tuple[int, int]]:
        """Special strings from left to right, the longest where several begin."""
        raw, found, until = data.tobytes(), [], 0
        for special in self.specials:
            at = raw.find(special)
            while at >= 0:
                found.append((at, -len(special)))
                at = raw.find(special, at + 1)
        out = []
        for at, size in sorted(found):
            if at >= until:
                until = at - size
                out.append((at, until))
        return out

    def split(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends in bytes of all pre-tokens, and of all special strings (end before start)."""
        size = len(data)
        if not size:
            none = np.zeros(0, np.int64)
            return none, none, np.zeros(0, bool)
        chars = np.flatnonzero(data & 0xC0 != 0x80)
        kind = self.class_of(data, chars)
        fresh = np.zeros(len(chars) + 1, bool)  # a stretch begins: a text, a special string, or what follows one
        fresh[np.searchsorted(chars, offsets)] = True
        for begin, end in self.special_spans(data):
            a, b = np.searchsorted(chars, (begin, end))
            if fresh[a + 1 : b].any():
                continue  # the end of one text and the start of the next make no special string
            kind[a:b] = SPECIAL
            fresh[[a, b]] = True
        blank = (kind == BLANK) | (kind == SPACE)
        start = np.ones(len(chars), bool)
        after = kind[:-1]
        # Blanks: the first of a run, and the last one if something else follows. Others: a change of class, but a single space
        # before them is theirs.
        start[1:] = np.where(blank[1:], ~blank[:-1], (kind[1:] != after) & (after != SPACE))
        start[:-1] |= blank[:-1] & ~blank[1:] & ~fresh[1:-1]
        start |= fresh[:-1]
        self.contractions(data, chars, kind, fresh, start)
        at = np.flatnonzero(start)
        begins = chars[at]
        return begins, np.append(begins[1:], size), kind[at] == SPECIAL

    @staticmethod
    def contractions(data: np.ndarray, chars: np.ndarray, kind: np.ndarray, fresh: np.ndarray, start: np.ndarray) -> None:
        mark = np.flatnonzero((data[chars] == ord("'")) & start & (kind == OTHER))
        for short in CONTRACTIONS:
            length = len(short)
            at = mark[mark + length <= len(chars)]
            for k in range(1, length):
                at = at[(data[chars[at + k]] == ord(short[k])) & (kind[at + k] == LETTER) & ~fresh[at + k]]
            start[at + 1] = False
            # What follows begins a pre-token of its own.
            start[(at + length)[at + length < len(chars)]] = True

    def pieces(self, pretokens: list[str]) -> np.ndarray:
        """How many pieces each pre-token has; alone it's cut as it was in its text."""
        found = self.tokenizer.encode_batch_fast(pretokens, add_special_tokens=False)
        return np.fromiter((len(x) for x in found), np.int64, len(pretokens))


@lru_cache(maxsize=2)
def splitter(path: str) -> Splitter:
    return Splitter(path)


def hashed(data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent hashes of each span, of 64 and of 32 bits."""
    check = arrays.span_hashes(data, begins, ends, 1) >> np.uint64(32)
    return arrays.span_hashes(data, begins, ends, 0).view(np.int64), check.astype(np.uint32).view(np.int32)


def distinct(path: str):
    """Distinct pre-tokens of each slice of text with their frequencies."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter = splitter(path)
        for batch in arrays.text_slices(batches, "_text", SLICE_BYTES):
            data, offsets = arrays.text_bytes(batch.column("_text"))
            begins, ends, special = cutter.split(data, offsets)
            begins, ends = begins[~special], ends[~special]
            _, first, counts = np.unique(hashed(data, begins, ends)[0], return_index=True, return_counts=True)
            raw = data.tobytes()
            tokens = [raw[a:b] for a, b in zip(begins[first].tolist(), ends[first].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(tokens, pa.binary()).cast(pa.string()), pa.array(counts, pa.int64())], names=["token", "n"])

    return run


def count_pieces(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter = splitter(path)
        for batch in arrays.text_slices(batches, "token", SLICE_BYTES):
            data, offsets = arrays.text_bytes(batch.column("token"))
            columns = [*hashed(data, offsets[:-1], offsets[1:]), cutter.pieces(batch.column("token").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("n"), *map(pa.array, columns)], names=["n", "h1", "h2", "pieces"])

    return run


PER_DOCUMENT = "row long, _id long, n_bytes long, n_head long, h1 array<long>, h2 array<int>, times array<int>"


def frequencies(path: str, head: np.ndarray, head_check: np.ndarray, head_pieces: np.ndarray):
    """Per document: bytes, special strings and pieces of frequent pre-tokens, frequencies of all other pre-tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter = splitter(path)
        row = TaskContext.get().partitionId() << 40
        for batch in arrays.text_slices(batches, "_text", SLICE_BYTES):
            data, offsets = arrays.text_bytes(batch.column("_text"))
            count = batch.num_rows
            begins, ends, special = cutter.split(data, offsets)
            doc = np.searchsorted(offsets, begins, side="right") - 1
            total = np.bincount(doc[special], minlength=count)
            begins, ends, doc = begins[~special], ends[~special], doc[~special]
            h1, h2 = hashed(data, begins, ends)
            values, first, code = np.unique(h1, return_index=True, return_inverse=True)
            check = h2[first]
            place = np.minimum(np.searchsorted(head, values), max(0, len(head) - 1))
            known = (head[place] == values) & (head_check[place] == check) if len(head) else np.zeros(len(values), bool)
            pieces = np.where(known, head_pieces[place] if len(head) else 0, 0)
            upto = np.concatenate(([0], np.cumsum(pieces[code])))
            edges = np.searchsorted(doc, np.arange(count + 1))
            total = total + upto[edges[1:]] - upto[edges[:-1]]
            rare = np.flatnonzero(~known[code])
            pairs, times = np.unique(doc[rare] * len(values) + code[rare], return_counts=True)
            owner, which = np.divmod(pairs, max(1, len(values)))
            lists = pa.array(np.searchsorted(owner, np.arange(count + 1)), pa.int32())
            columns = [
                pa.array(row + np.arange(count)),
                batch.column("_id"),
                pa.array(np.diff(offsets)),
                pa.array(total),
                *(pa.ListArray.from_arrays(lists, pa.array(x)) for x in (values[which], check[which], times.astype(np.int32))),
            ]
            row += count
            yield pa.RecordBatch.from_arrays(columns, names=["row", "_id", "n_bytes", "n_head", "h1", "h2", "times"])

    return run


def frequent(vocabulary: DataFrame, head: int) -> np.ndarray:
    """Hashes and pieces of at most `head` pre-tokens, all that occur more often than some number, by ascending first hash.

    The number comes from a histogram of the frequencies, eight bins for each doubling, so the driver sees its bins and the head only.
    """
    level = F.floor(F.log2("n") * 8).cast("int")
    sizes = sorted(vocabulary.groupBy(level.alias("level")).agg(F.count("n").alias("size")).collect(), reverse=True)
    taken, lowest = 0, None
    for row in sizes:
        if taken + row.size > head:
            break
        taken, lowest = taken + row.size, row.level
    rows = vocabulary.where(level >= lowest).select("h1", "h2", "pieces").collect() if lowest is not None else []
    columns = np.array([tuple(r) for r in rows], np.int64).reshape(-1, 3)
    return columns[np.argsort(columns[:, 0], kind="stable")]


def count_tokens(docs: DataFrame, tokenizer: str, limit: int = 1024, head: int = HEAD, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Per row: `doc_id`, `n_bytes`, `n_tokens` of the whole text without begin or end, `over_limit` (more tokens than `limit`).

    Special strings inside a text are one token each, as the library reads them by default. A null text is empty: no bytes, no
    tokens. Rows that repeat, and rows without an id, are counted each; other columns are not read. An empty table gives no rows.
    A text of any length is split as a whole; one with many rare pre-tokens spreads them over the tasks of the join. Pre-tokens are told
    apart by 96 bits of hashes, within a slice of text by the first 64.
    """
    rows = keyed(docs, text, doc_id).drop("_copy")
    seen = rows.select("_text").mapInArrow(distinct(tokenizer), "token string, n long").groupBy("token").agg(F.sum("n").alias("n"))
    vocabulary = staged(seen.mapInArrow(count_pieces(tokenizer), "n long, h1 long, h2 int, pieces long"))
    columns = frequent(vocabulary, head)
    found = staged(rows.mapInArrow(frequencies(tokenizer, *map(np.ascontiguousarray, columns.T)), PER_DOCUMENT))
    rare = found.select("row", F.explode(F.arrays_zip("h1", "h2", "times")).alias("x")).select("row", "x.h1", "x.h2", "x.times")
    counted = rare.join(vocabulary.select("h1", "h2", "pieces"), ["h1", "h2"]).select(
        "row", F.lit(None).cast("long").alias("_id"), F.lit(None).cast("long").alias("n_bytes"), (F.col("times") * F.col("pieces")).alias("n")
    )
    parts = found.select("row", "_id", "n_bytes", F.col("n_head").alias("n")).unionByName(counted)
    whole = parts.groupBy("row").agg(F.max("_id").alias("_id"), F.max("n_bytes").alias("n_bytes"), F.sum("n").alias("n_tokens"))
    return whole.select(restored("_id").alias("doc_id"), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
