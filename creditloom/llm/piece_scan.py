"""SentencePiece encoding and decoding, with giant documents cut into chunks that are encoded in parallel.

An encoding by merges has a local test: a sequence of pieces is the encoding of its text just if each piece, and each
two neighbours, are the encoding of theirs. For a merge across two pieces would have been due in the text of the two
alone as well, as what lies further off takes no part in the order of merges within them. So an
encoding is the best path of a max-plus product: a step from piece to piece weighs 0 if the two are an encoding and
minus infinity if not, and just one path from the start to any place is finite.

A chunk is cut off at any character. The state at a boundary is the last piece that begins before it: how far back it begins and
how far it reaches over. A chunk's transfer matrix holds the weight of the best path from each state at its
beginning to each at its end. Products are associative, so they are taken up a tree, a fan of neighbouring matrices at a time and all fans in
parallel; down the same tree go the states at the boundaries, and each chunk then traces its own path back. No piece of the vocabulary goes on with a blank after
another character, so paths in a chunk meet at such places; between the first and the last of them the library encodes the chunk.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditloom.llm import arrays
from creditloom.llm.common import keyed, restored, staged

GIANT = 32768  # characters beyond which a document is cut into chunks
CHUNK = 16384
FAN = 64  # matrices that are multiplied in one group
BLANK = "▁"  # what the library writes for a blank
NONE = float("-inf")
START = -1  # the state before the first piece

Matrix = dict[int, dict[int, float]]  # from state, to state, weight


class Pieces:
    """The vocabulary of a model file of the merging kind whose texts aren't normalised."""

    def __init__(self, path: str):
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        special = (self.library.is_byte, self.library.is_control, self.library.is_unknown, self.library.is_unused)
        ids = [i for i in range(self.library.get_piece_size()) if not any(f(i) for f in special)]
        self.scores = {self.library.id_to_piece(i): self.library.get_score(i) for i in ids}
        self.longest = max(map(len, self.scores))
        if any(p[k] == BLANK != p[k - 1] for p in self.scores for k in range(1, len(p))):
            raise ValueError("a piece goes on with a blank after another character")
        probe = "ﬁ  x\ń "
        if self.library.normalize(probe) != BLANK + probe.replace(" ", BLANK):
            raise ValueError("the model normalises its texts")
        self.pairs: dict[tuple[str, str], bool] = {}

    def ids(self, piece: str) -> list[int]:
        if piece in self.scores:
            return [self.library.piece_to_id(piece)]
        return [self.library.piece_to_id(f"<0x{b:02X}>") for b in piece.encode()]

    def merged(self, text: str) -> list[str]:
        """The encoding of a short text: of all neighbours whose union is a piece, the best merges, the leftmost of equal ones."""
        parts = list(text)
        while True:
            best, at = NONE, -1
            for k in range(len(parts) - 1):
                score = self.scores.get(parts[k] + parts[k + 1], NONE)
                if score > best:
                    best, at = score, k
            if at < 0:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def follows(self, one: str, two: str) -> bool:
        found = self.pairs.get((one, two))
        if found is None:
            if len(self.pairs) > 200_000:
                self.pairs.clear()
            parts = [x for x in (one, two) if x]
            found = self.pairs[one, two] = self.merged(one + two) == parts
        return found


@lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    return Pieces(path)


def state(back: int, over: int) -> int:
    return back << 8 | over


def cut_places(text: str, low: int, high: int) -> tuple[int, int]:
    """The first and the last place from `low` to `high` where a blank follows another character; -1 if there is none."""
    first = text.find(BLANK, low, high + 1)
    while first >= 0 and text[first - 1] == BLANK:
        first = text.find(BLANK, first + 1, high + 1)
    last = text.rfind(BLANK, low, high + 1)
    while last >= 0 and text[last - 1] == BLANK:
        last = text.rfind(BLANK, low, last)
    return first, last


Found = dict[tuple[int, int], tuple[float, tuple[int, int] | None]]


def walk(vocabulary: Pieces, text: str, begin: int, before: str, stop: int) -> Found:
    """All pieces on paths from `begin` that begin before `stop`: (begin, end) with the best weight and the piece before.

    `before` is the piece that ends at `begin`, or empty if none matters.
    """
    found: Found = {}
    ending: dict[int, list[tuple[int, int] | None]] = {begin: [None]}
    for place in range(begin, stop):
        for source in ending.get(place, ()):
            last = text[slice(*source)] if source else before
            weight = found[source][0] if source else 0.0
            for end in range(place + 1, min(len(text), place + vocabulary.longest) + 1):
                piece = text[place:end]
                if (end - place > 1 and piece not in vocabulary.scores) or not vocabulary.follows(last, piece):
                    continue
                if (place, end) not in found:
                    ending.setdefault(end, []).append((place, end))
                if weight > found.get((place, end), (NONE, None))[0]:
                    found[place, end] = (weight, source)
    return found


def traced(found: Found, last: tuple[int, int] | None) -> list[tuple[int, int]]:
    out = []
    while last:
        out.append(last)
        last = found[last][1]
    return out[::-1]


def in_states(vocabulary: Pieces, text: str, at: int) -> list[tuple[int, int, int]]:
    """State, begin and end of the pieces that could be the last to begin before `at`."""
    out = []
    for begin in range(max(0, at - vocabulary.longest), at):
        for end in range(at, min(len(text), begin + vocabulary.longest) + 1):
            if end - begin == 1 or text[begin:end] in vocabulary.scores:
                out.append((state(at - begin, end - at), begin, end))
    return out


def ends_at(found: Found, high: int) -> dict[int, float]:
    """The states at `high` of pieces that reach it."""
    return {state(high - a, b - high): w for (a, b), (w, _) in found.items() if b >= high}


def transfer(vocabulary: Pieces, text: str, low: int, high: int, is_first: bool) -> Matrix:
    """The matrix of the chunk text[low:high]; the text goes on on both sides by the longest piece, or ends."""
    starts = [(START, low, low)] if is_first else in_states(vocabulary, text, low)
    first, last = cut_places(text, low + 1, high - 1)
    out: Matrix = {}
    # From the last cut on there is one set of ends for all paths.
    tail = ends_at(walk(vocabulary, text, last, "", high), high) if first >= 0 else {}
    for source, begin, end in starts:
        if first < 0:
            row = ends_at(walk(vocabulary, text, end, text[begin:end], high), high) if end < high else {state(high - begin, end - high): 0.0}
        elif end == first:
            row = tail
        else:
            found = walk(vocabulary, text, end, text[begin:end], first) if end < first else {}
            reached = max((w for (_, b), (w, _) in found.items() if b == first), default=NONE)
            row = {target: reached + w for target, w in tail.items()} if reached > NONE else {}
        if row:
            out[source] = row
    return out


def product(one: Matrix, two: Matrix) -> Matrix:
    """The max-plus product of two matrices; it is associative."""
    out: Matrix = {}
    for source, row in one.items():
        best: dict[int, float] = {}
        for middle, weight in row.items():
            for target, more in two.get(middle, {}).items():
                best[target] = max(best.get(target, NONE), weight + more)
        if best:
            out[source] = best
    return out


def boundaries(matrices: list[Matrix], source: int = START, target: int | None = None) -> list[tuple[int, int]]:
    """The states before and after each chunk on the best path from a state to another, by default to the best one."""
    fronts: list[Matrix] = [{source: {source: 0.0}}]
    for matrix in matrices:
        fronts.append(product(fronts[-1], matrix))
    ends = fronts[-1][source]
    last = max(ends, key=ends.get) if target is None else target
    out = []
    for matrix, front in zip(reversed(matrices), reversed(fronts[:-1]), strict=True):
        begun = front[source]
        middle = max((s for s in begun if last in matrix.get(s, {})), key=lambda s: begun[s] + matrix[s][last])
        out.append((middle, last))
        last = middle
    return out[::-1]


def backtrace(vocabulary: Pieces, text: str, low: int, high: int, source: int, target: int) -> list[int]:
    """Ids of the pieces that begin in text[low:high], given the states on both sides."""
    if source == START:
        begin, end = low, low
    else:
        begin, end = low - (source >> 8), low + (source & 255)
    goal = (high - (target >> 8), high + (target & 255))
    if goal[0] < low:
        return []  # a piece that began earlier reaches over all of it
    before = text[begin:end]
    first, last = cut_places(text, low + 1, high - 1)
    if first < 0:
        return [i for a, b in traced(walk(vocabulary, text, end, before, high), goal) for i in vocabulary.ids(text[a:b])]
    ids = []
    if end < first:
        found = walk(vocabulary, text, end, before, first)
        reached = next(x for x in found if x[1] == first)
        ids += [i for a, b in traced(found, reached) for i in vocabulary.ids(text[a:b])]
    if last > first:
        ids += vocabulary.library.encode(text[first + 1 : last])  # the library puts the blank before it
    return ids + [i for a, b in traced(walk(vocabulary, text, last, "", high), goal) for i in vocabulary.ids(text[a:b])]


CHUNKS = "_id long, _copy long, chunk long, low int, high int, part string"


def packed(ids: list[int]) -> bytes:
    return np.array(ids, "<u4").tobytes()


def split_giants(longest: int, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["_id", "_copy", "chunk", "low", "high", "part"]
        types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.string()]
        for batch in batches:
            for doc_id, copy, text in zip(*(batch.column(c) for c in ("_id", "_copy", "_text")), strict=True):
                text = BLANK + text.as_py().replace(" ", BLANK)
                rows = []
                for k, low in enumerate(range(0, len(text), size)):
                    left, high = max(0, low - longest), min(len(text), low + size)
                    rows.append((doc_id.as_py(), copy.as_py(), k, low - left, high - left, text[left : high + longest]))
                columns = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    return run


CELLS = pa.list_(pa.struct([("source", pa.int32()), ("target", pa.int32()), ("weight", pa.float64())]))
MATRICES = "_id long, _copy long, chunk long, cells array<struct<source: int, target: int, weight: double>>"
STATES = "_id long, _copy long, chunk long, source int, target int"


def flat(matrix: Matrix) -> list[dict]:
    return [{"source": s, "target": t, "weight": w} for s, row in matrix.items() for t, w in row.items()]


def unflat(cells: list[dict]) -> Matrix:
    matrix: Matrix = {}
    for cell in cells:
        matrix.setdefault(cell["source"], {})[cell["target"]] = cell["weight"]
    return matrix


def chunk_matrices(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = pieces(path)
        for batch in batches:
            rows = []
            for k, low, high, part in zip(*(batch.column(c).to_pylist() for c in ("chunk", "low", "high", "part")), strict=True):
                rows.append(flat(transfer(vocabulary, part, low, high, k == 0)))
            kept = [batch.column(c) for c in ("_id", "_copy", "chunk")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(rows, CELLS)], names=["_id", "_copy", "chunk", "cells"])

    return run


def fan_product(rows: pa.Table) -> pa.Table:
    """The product of a fan of matrices, which may be taken without the others as products are associative."""
    rows = rows.sort_by("chunk").to_pydict()
    total = unflat(rows["cells"][0])
    for cells in rows["cells"][1:]:
        total = product(total, unflat(cells))
    columns = {"_id": rows["_id"][:1], "_copy": rows["_copy"][:1], "chunk": rows["fan"][:1]}
    return pa.table({**{c: pa.array(x, pa.int64()) for c, x in columns.items()}, "cells": pa.array([flat(total)], CELLS)})


def fan_states(rows: pa.Table) -> pa.Table:
    """The states at the boundaries within a fan, from those before and after it; before the first fan and after the last the best."""
    rows = rows.sort_by("chunk").to_pydict()
    found = boundaries([unflat(cells) for cells in rows["cells"]], rows["source"][0], rows["target"][0])
    columns = {c: pa.array(rows[c], pa.int64()) for c in ("_id", "_copy", "chunk")}
    states = {"source": [s for s, _ in found], "target": [t for _, t in found]}
    return pa.table({**columns, **{c: pa.array(x, pa.int32()) for c, x in states.items()}})


def scan(matrices: DataFrame, most: int) -> DataFrame:
    """States before and after every chunk: products up a tree of fans, and states down again. `most` is the largest chunk number."""
    keys = ["_id", "_copy", "fan"]
    tasks = int(matrices.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    levels = [matrices]
    while most:
        dealt = levels[-1].withColumn("fan", F.expr(f"chunk div {FAN}")).repartition(tasks, *keys)
        levels.append(staged(dealt.groupBy(*keys).applyInArrow(fan_product, MATRICES)))
        most //= FAN
    down = levels[-1].select("_id", "_copy", F.col("chunk").alias("fan"), F.lit(START).alias("source"), F.lit(None).cast("int").alias("target"))
    if len(levels) == 1:
        return matrices.withColumn("fan", F.col("chunk")).join(down, keys).groupBy(*keys).applyInArrow(fan_states, STATES)
    for below in reversed(levels[:-1]):
        told = below.withColumn("fan", F.expr(f"chunk div {FAN}")).join(down, keys).repartition(tasks, *keys)
        states = staged(told.groupBy(*keys).applyInArrow(fan_states, STATES))
        down = states.withColumnRenamed("chunk", "fan")
    return states


def chunk_ids(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = pieces(path)
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("part", "low", "high", "source", "target"))
            ids = [packed(backtrace(vocabulary, *row)) for row in zip(*columns, strict=True)]
            kept = [batch.column(c) for c in ("_id", "_copy", "chunk")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(ids, pa.binary())], names=["_id", "_copy", "chunk", "ids"])

    return run


def join_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = [b"".join(parts.as_py()) for parts in batch.column("parts")]
        yield pa.RecordBatch.from_arrays([batch.column("_id"), batch.column("_copy"), pa.array(ids, pa.binary())], names=["_id", "_copy", "ids"])


REPORT = "_id long, _copy long, n_pieces long, ids_crc32 long, decoded string"


def described(library: sentencepiece.SentencePieceProcessor, batch: pa.RecordBatch, ids: list[list[int]]) -> pa.RecordBatch:
    """Rows of a batch with the number of ids, their checksum, and the text they decode to."""
    crc = [zlib.crc32(packed(x)) for x in ids]
    columns = [pa.array([len(x) for x in ids], pa.int64()), pa.array(crc, pa.int64()), pa.array([library.decode(x) for x in ids], pa.string())]
    kept = [batch.column("_id"), batch.column("_copy")]
    return pa.RecordBatch.from_arrays([*kept, *columns], names=["_id", "_copy", "n_pieces", "ids_crc32", "decoded"])


def encode_plain(path: str, describe: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = pieces(path).library
        for batch in arrays.text_slices(batches, "_text"):
            ids = library.encode([x or "" for x in batch.column("_text").to_pylist()], num_threads=1)
            if describe:
                yield described(library, batch, ids)
                continue
            found = pa.array([packed(x) for x in ids], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("_id"), batch.column("_copy"), found], names=["_id", "_copy", "ids"])

    return run


def giant_ids(rows: DataFrame, model: str, chunk: int) -> DataFrame:
    """`_id`, `_copy`, `ids` of each distinct row, chunk by chunk."""
    size = Pieces(model).longest
    if chunk <= size:
        raise ValueError("a chunk must be longer than the longest piece")
    spread = rows.mapInArrow(split_giants(size, chunk), CHUNKS)
    chunks = staged(spread)
    keys = ["_id", "_copy", "chunk"]
    matrices = staged(chunks.dropDuplicates(keys).repartition(*keys).mapInArrow(chunk_matrices(model), MATRICES))
    states = scan(matrices, matrices.agg(F.max("chunk")).first()[0] or 0)
    placed = chunks.dropDuplicates(keys).join(states, keys)
    encoded = placed.mapInArrow(chunk_ids(model), "_id long, _copy long, chunk long, ids binary")
    whole = encoded.groupBy("_id", "_copy").agg(F.array_sort(F.collect_list(F.struct("chunk", "ids"))).alias("parts"))
    return whole.select("_id", "_copy", F.col("parts.ids").alias("parts")).mapInArrow(join_ids, "_id long, _copy long, ids binary")


def encode_pieces(docs: DataFrame, model: str, text: str = "text", doc_id: str = "doc_id", giant: int = GIANT, chunk: int = CHUNK, describe: bool = False) -> DataFrame:
    """`_id`, `_copy` and `ids` (unsigned 32-bit integers in little-endian order) of every row, as the library encodes the text.

    A null or empty text has no ids. Texts of more than `giant` characters are cut into chunks of `chunk`. Rows that repeat are encoded
    each; other columns are not read. An empty table gives no rows. `describe` gives what decode_pieces does instead of the ids.
    """
    rows = keyed(docs, text, doc_id)
    long = F.coalesce(F.length("_text"), F.lit(0)) > giant
    plain = rows.where(~long).mapInArrow(encode_plain(model, describe), REPORT if describe else "_id long, _copy long, ids binary")
    giants = staged(rows.where(long))
    found = giant_ids(giants.dropDuplicates(["_id", "_copy"]), model, chunk)
    found = giants.select("_id", "_copy").join(found, ["_id", "_copy"])
    return plain.union(decode_pieces(found, model) if describe else found)


def decode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = pieces(path).library
        for batch in batches:
            for row in range(0, batch.num_rows, 64):
                part = batch.slice(row, 64)
                yield described(library, part, [np.frombuffer(x, "<u4").tolist() for x in part.column("ids").to_pylist()])

    return run


def decode_pieces(encoded: DataFrame, model: str) -> DataFrame:
    """`_id`, `_copy`, `n_pieces`, `ids_crc32` and `decoded`, the text of the ids."""
    return encoded.mapInArrow(decode(model), REPORT)


def piece_report(docs: DataFrame, model: str, **sizes) -> DataFrame:
    """Per row: its number of pieces, the checksum of their ids, the length of the text, and whether decoding gives it back."""
    found = encode_pieces(docs, model, describe=True, **sizes)
    same = F.xxhash64("decoded") == F.col("_copy")
    # The hash of a null text is the seed; it decodes to the empty text.
    null = F.col("_copy") == F.xxhash64(F.lit(None).cast("string"))
    return found.select(
        restored("_id").alias("doc_id"), "n_pieces", "ids_crc32", F.length("decoded").cast("bigint").alias("n_chars"), (same | null).alias("round_trip")
    )
