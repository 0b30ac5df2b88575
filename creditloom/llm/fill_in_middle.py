"""Fill-in-the-middle: a text's middle part moves to its end, cut by a learned rank index over the text's units.

A unit is a run of ASCII letters or any other single character. A cut is given by rank, so its place in the text is the end of the
unit of that rank. The index learns the map from rank to place: straight segments, each within `ERROR` bytes of all places it
covers, and for every rank a residual of one byte that says how far the segment is off. A place is the segment's prediction plus
the residual, exactly.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditloom.llm import arrays
from creditloom.llm.common import keyed, restored

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARKS = (PREFIX, SUFFIX, MIDDLE)
ERROR = 100  # residuals, at most one more for rounding, fit into a signed byte

LETTER = np.zeros(256, bool)
LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True


class RankIndex:
    """Places by rank. `places` ascend, the first is that of rank 0."""

    def __init__(self, places: np.ndarray, error: int = ERROR):
        self.first, self.base, self.slope = self.fit(places, error)
        sizes = np.diff(np.append(self.first, len(places)))
        steps = np.arange(len(places)) - np.repeat(self.first, sizes)
        predicted = np.rint(np.repeat(self.slope, sizes) * steps).astype(np.int64) + np.repeat(self.base, sizes)
        self.residuals = (places - predicted).astype(np.int8 if error < 127 else np.int64)

    @staticmethod
    def fit(places: np.ndarray, error: int) -> tuple[list[int], list[int], list[float]]:
        """First rank, its place and the slope of each segment, each as long as one line through its first place allows.

        Every place narrows the slopes that pass within `error` of it; a segment ends before the one that leaves none.
        """
        first, base, slope = [], [], []
        start, reach, count = 0, 64, len(places)
        while start < count:
            stop = min(count, start + reach)
            steps = np.arange(1, stop - start)
            rise = places[start + 1 : stop] - places[start]
            low = np.maximum.accumulate((rise - error) / steps)
            high = np.minimum.accumulate((rise + error) / steps)
            fits = int(np.searchsorted(low > high, True))
            if fits == len(steps) and stop < count:
                reach *= 2  # the segment may go on
                continue
            first.append(start)
            base.append(int(places[start]))
            slope.append(float(low[fits - 1] + high[fits - 1]) / 2 if fits else 0.0)
            start += fits + 1
            reach = max(64, 2 * fits)
        return first, base, slope

    def place(self, rank: int) -> int:
        k = bisect_right(self.first, rank) - 1
        predicted = int(np.rint(self.slope[k] * (rank - self.first[k]))) + self.base[k]
        return predicted + int(self.residuals[rank])


def unit_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The bytes at which a unit begins."""
    letter = LETTER[data]
    starts = data & 0xC0 != 0x80
    inner = letter[1:] & letter[:-1]
    edges = offsets[1:-1]
    inner[edges[(edges > 0) & (edges < len(data))] - 1] = False
    starts[1:] &= ~inner
    return np.flatnonzero(starts)


SCHEMA = "_id long, n long, form string, prefix_chars long, middle_chars long, output string"


def transform(plain_from: int, spm_below: int, error: int):
    def characters(raw: bytes) -> int:
        return len(raw.decode())

    def one(raw: bytes, places: np.ndarray, draws: list[int]) -> tuple[str, int | None, int | None, bytes]:
        n = len(places) - 1
        if not n or any(mark.encode() in raw for mark in MARKS) or draws[2] % 100 >= plain_from:
            return "plain", None, None, raw
        index = RankIndex(places, error)
        low, high = (index.place(rank) for rank in sorted(draw % (n + 1) for draw in draws[:2]))
        before, inside, after = raw[:low], raw[low:high], raw[high:]
        prefix, suffix, middle = (mark.encode() for mark in MARKS)
        if draws[3] % 100 < spm_below:
            return "spm", characters(before), characters(inside), b"".join((suffix, after, prefix, before, middle, inside))
        return "psm", characters(before), characters(inside), b"".join((prefix, before, suffix, after, middle, inside))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrays.text_slices(batches, "_text"):
            data, offsets = arrays.text_bytes(batch.column("_text"))
            starts, raw = unit_starts(data, offsets) if len(data) else offsets[:0], data.tobytes()
            edges = np.searchsorted(starts, offsets)
            rows, units = [], np.diff(edges)
            draws = np.stack([batch.column(f"_h{k}").to_numpy() for k in range(1, 5)], axis=1).tolist()
            for k, (begin, end) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
                places = np.append(starts[edges[k] : edges[k + 1]], end) - begin
                rows.append(one(raw[begin:end], places, draws[k]))
            form, before, inside, output = zip(*rows, strict=True)
            columns = [
                batch.column("_id"),
                pa.array(units, pa.int64()),
                pa.array(form, pa.string()),
                pa.array(before, pa.int64()),
                pa.array(inside, pa.int64()),
                pa.array(output, pa.binary()).cast(pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    return run


def draws(doc_id: Column, seed: int) -> dict[str, Column]:
    """Four unsigned 32-bit numbers from the SHA-256 of the seed and the id; a missing id reads as nothing."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return {f"_h{k}": F.conv(F.substring(digest, 8 * k - 7, 8), 16, 10).cast("long") for k in range(1, 5)}


def fill_in_middle(
    docs: DataFrame,
    seed: int = 1,
    plain_from: int = 90,
    spm_below: int = 20,
    error: int = ERROR,
    text: str = "text",
    doc_id: str = "doc_id",
) -> DataFrame:
    """Per row: `doc_id`, `n` units, `form` (plain, psm, spm), characters of prefix and middle (null if plain), `output`.

    Of each hundred draws those from `plain_from` on stay plain, and of the others those below `spm_below` have the suffix first. Texts that
    hold a mark stay plain. A null text is empty: no units, plain, an empty output. The cuts depend on the id alone, so rows that
    repeat are cut alike; a null id is an id of its own. A text of any length is one row of one task. Other columns are not read;
    an empty table gives no rows.
    """
    rows = keyed(docs, text, doc_id).drop("_copy")
    cut = rows.withColumns(draws(restored("_id"), seed)).mapInArrow(transform(plain_from, spm_below, error), SCHEMA)
    return cut.select(restored("_id").alias("doc_id"), "n", "form", "prefix_chars", "middle_chars", "output")


def original(form: Column, output: Column) -> Column:
    """The text from an output and its form: marks stand in no text that was cut, so the first of each is the one put in."""
    size = len(PREFIX)
    at = F.when(form == "psm", F.instr(output, F.lit(SUFFIX))).otherwise(F.instr(output, F.lit(PREFIX)))
    last = F.instr(output, F.lit(MIDDLE))
    head = F.substr(output, F.lit(size + 1), at - size - 1)
    inner = F.substr(output, at + size, last - at - size)
    middle = F.substr(output, last + size)
    return F.when(form == "plain", output).when(form == "psm", F.concat(head, middle, inner)).otherwise(F.concat(inner, middle, head))
