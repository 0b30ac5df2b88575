"""Removal of lines that many documents share.

Every line long enough to count becomes a row (128-bit hash of its key, document, line numbers). The rows are
range-partitioned by hash and sorted by hash and then by document, the largest first, so that one pass over a
partition meets the document that keeps a line before those that lose it. The result is one compressed bitmap
of kept lines for each document that loses any; texts don't travel until a bitmap is applied.

A line in a third of all documents doesn't gather in one task: each map batch settles what it can. Once a batch
has seen a key in enough documents, all of them but its largest lose their lines for sure, whatever other
batches hold, so only that largest one goes on, with the number of documents it stands for.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditloom.llm import arrays
from creditloom.llm.common import keyed, named, numbered, restored, staged

ROWS = "h1 long, h2 long, holders int, _id long, _copy long, n_lines int, lines array<int>"
FIELDS = ("h1", "h2", "holders", "_id", "_copy", "n_lines")
TYPES = dict(zip(FIELDS, (np.int64, np.int64, np.int32, np.int64, np.int64, np.int32), strict=True))
DROPS = "_id long, _copy long, n_lines int, lines array<int>"
BITMAP = "keep binary, n_lines int, n_dropped int"


class Rows:
    """Columns of line rows; the line numbers of row i are flat[offsets[i]:offsets[i + 1]]."""

    def __init__(self, columns: dict[str, np.ndarray], offsets: np.ndarray, flat: np.ndarray):
        self.columns, self.offsets, self.flat = columns, offsets.astype(np.int64), flat

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def __getitem__(self, name: str) -> np.ndarray:
        return self.columns[name]

    def take(self, rows: np.ndarray) -> Rows:
        counts = np.diff(self.offsets)[rows]
        offsets = np.concatenate(([0], np.cumsum(counts)))
        flat = np.repeat(self.offsets[rows] - offsets[:-1], counts) + np.arange(offsets[-1])
        return Rows({k: v[rows] for k, v in self.columns.items()}, offsets, self.flat[flat])

    def arrow(self, names: tuple[str, ...]) -> pa.RecordBatch:
        lists = pa.ListArray.from_arrays(pa.array(self.offsets, pa.int32()), pa.array(self.flat, pa.int32()))
        columns = [pa.array(self.columns[n].astype(TYPES[n])) for n in names]
        return pa.RecordBatch.from_arrays([*columns, lists], names=[*names, "lines"])

    @staticmethod
    def joined(parts: list[Rows]) -> Rows:
        shift = np.cumsum([0, *(len(p.flat) for p in parts)])
        offsets = [p.offsets[:-1] + at for p, at in zip(parts, shift[:-1], strict=True)]
        return Rows(
            {k: np.concatenate([p[k] for p in parts]) for k in FIELDS},
            np.concatenate([*offsets, shift[-1:]]),
            np.concatenate([p.flat for p in parts]),
        )

    @staticmethod
    def of(batch: pa.RecordBatch) -> Rows:
        lists = batch.column("lines")
        offsets = np.asarray(lists.offsets)
        columns = {k: batch.column(k).to_numpy(zero_copy_only=False) for k in FIELDS}
        return Rows(columns, offsets - offsets[0], np.asarray(lists.values)[offsets[0] : offsets[-1]])


def line_rows(batch: pa.RecordBatch, min_chars: int) -> Rows:
    """A row for each document and line key of at least `min_chars` code points."""
    data, offsets = arrays.text_bytes(batch.column("_text"))
    breaks = np.flatnonzero(data == 0x0A)
    texts = len(offsets) - 1
    starts = np.sort(np.concatenate([offsets[:-1], breaks + 1]), kind="stable")
    first = np.arange(texts + 1) + np.searchsorted(breaks, offsets)
    ends = np.empty(len(starts), np.int64)
    ends[:-1] = starts[1:] - 1
    ends[first[1:] - 1] = offsets[1:]
    text = np.repeat(np.arange(texts), np.diff(first))
    number = np.arange(len(starts)) - first[text]
    solid = np.flatnonzero(~arrays.SPACE[data])
    low, high = np.searchsorted(solid, starts), np.searchsorted(solid, ends)
    points = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    some = np.flatnonzero(high > low)
    starts, ends, text, number = solid[low[some]], solid[high[some] - 1] + 1, text[some], number[some]
    counted = np.flatnonzero(points[ends] - points[starts] >= min_chars)
    starts, ends, text, number = starts[counted], ends[counted], text[counted], number[counted]
    data = arrays.LOWER[data]
    h1, h2 = (arrays.span_hashes(data, starts, ends, k).view(np.int64) for k in (0, 1))
    order = np.lexsort((number, h2, h1, text))
    h1, h2, text, number = h1[order], h2[order], text[order], number[order]
    new = np.ones(len(h1), bool)
    new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1]) | (text[1:] != text[:-1])
    at = np.flatnonzero(new)
    text = text[at]
    return Rows(
        {
            "h1": h1[at],
            "h2": h2[at],
            "holders": np.ones(len(at), np.int64),
            "_id": batch.column("_id").to_numpy()[text],
            "_copy": batch.column("_copy").to_numpy()[text],
            "n_lines": np.diff(first)[text],
        },
        np.append(at, len(h1)),
        number,
    )


def settle(rows: Rows, min_docs: int) -> tuple[Rows, Rows]:
    """Rows that lose their lines for sure; and the others, sorted, of keys in `min_docs` documents the largest only."""
    rows = rows.take(np.lexsort((~rows["_id"], rows["h2"], rows["h1"])))
    if not len(rows):
        return rows, rows
    new = np.ones(len(rows), bool)
    new[1:] = (rows["h1"][1:] != rows["h1"][:-1]) | (rows["h2"][1:] != rows["h2"][:-1])
    at = np.flatnonzero(new)
    group = np.cumsum(new) - 1
    total = np.add.reduceat(rows["holders"], at)
    loses = (total[group] >= min_docs) & (rows["_id"] < rows["_id"][at][group])
    # The first row of a key stands for all that went.
    gone = np.bincount(group, weights=np.where(loses, rows["holders"], 0), minlength=len(at)).astype(np.int64)
    rows.columns["holders"] = rows["holders"].astype(np.int64)
    rows.columns["holders"][at] += gone
    return rows.take(np.flatnonzero(loses)), rows.take(np.flatnonzero(~loses))


def per_document(rows: Rows) -> Rows:
    """One row for each document, with all its lines."""
    rows = rows.take(np.lexsort((rows["_copy"], rows["_id"])))
    new = np.ones(len(rows), bool)
    new[1:] = (rows["_id"][1:] != rows["_id"][:-1]) | (rows["_copy"][1:] != rows["_copy"][:-1])
    at = np.flatnonzero(new)
    return Rows({k: v[at] for k, v in rows.columns.items()}, np.append(rows.offsets[at], len(rows.flat)), rows.flat)


def map_lines(min_chars: int, min_docs: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [line_rows(x, min_chars) for x in arrays.text_slices(iter([batch]), "_text")]
            if not parts:
                continue
            sure, open_ = settle(Rows.joined(parts), min_docs)
            if len(sure):
                sure = per_document(sure)
                # No key of theirs is needed any more; a hash of the document, its id included, spreads them and copies of a text.
                sure.columns["h1"] = arrays.mix(arrays.mix(sure["_id"].view(np.uint64)) ^ sure["_copy"].view(np.uint64)).view(np.int64)
                sure.columns["holders"] = np.zeros(len(sure), np.int64)
                yield sure.arrow(FIELDS)
            yield open_.arrow(FIELDS)

    return run


def stream_first(min_docs: int):
    """Over rows sorted by key and by document, the largest first: the lines that each document loses."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = Rows.of(batch)
            sure = rows["holders"] == 0
            losers = [rows.take(np.flatnonzero(sure))]
            open_ = rows.take(np.flatnonzero(~sure))
            if left is not None:
                open_ = Rows.joined([left, open_])
            if len(open_):
                gone, rest = settle(open_, min_docs)
                losers.append(gone)
                # Only the last key can go on in the next batch.
                left = rest.take(np.flatnonzero((rest["h1"] == rest["h1"][-1]) & (rest["h2"] == rest["h2"][-1])))
            found = Rows.joined(losers)
            if len(found):
                yield per_document(found).arrow(("_id", "_copy", "n_lines"))

    return run


def bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Kept lines as a compressed bitmap, the first line in the lowest bit of the first byte."""
    for batch in batches:
        keeps, dropped = [], []
        for n_lines, lines in zip(batch.column("n_lines").to_pylist(), batch.column("lines"), strict=True):
            keep = np.ones(n_lines, np.uint8)
            keep[np.asarray(lines.values, dtype=np.int64)] = 0
            keeps.append(zlib.compress(np.packbits(keep, bitorder="little").tobytes()))
            dropped.append(n_lines - int(keep.sum()))
        yield pa.RecordBatch.from_arrays(
            [batch.column("_id"), batch.column("_copy"), pa.array(keeps, pa.binary()), batch.column("n_lines"), pa.array(dropped, pa.int32())],
            names=["_id", "_copy", "keep", "n_lines", "n_dropped"],
        )


def shared_line_bitmaps(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """Bitmaps of the lines that stay, for the documents that lose any: `_id`, `_copy`, `keep`, `n_lines`, `n_dropped`.

    A line's key is the line without white space at its ends and with A-Z lower-cased. A key of at least `min_chars`
    code points in at least `min_docs` documents stays in the document with the largest id only; ties stay in
    each of them. A null id is smaller than all others, a null text is one empty line, and a repeated row counts as a
    document of its own. Other columns are not read. An empty table gives no rows.
    """
    lines = staged(keyed(docs, text, doc_id).mapInArrow(map_lines(min_chars, min_docs), ROWS))
    ordered = lines.repartitionByRange("h1", "h2").sortWithinPartitions("h1", "h2", F.desc("_id"))
    drops = ordered.mapInArrow(stream_first(min_docs), DROPS)
    whole = drops.groupBy("_id", "_copy").agg(
        F.first("n_lines").alias("n_lines"), F.array_distinct(F.flatten(F.collect_list("lines"))).alias("lines")
    )
    return whole.mapInArrow(bitmaps, f"_id long, _copy long, {BITMAP}")


def apply_bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Puts the kept lines in the place of `_text`."""
    for batch in batches:
        texts = []
        for text, keep, n_lines in zip(*(batch.column(c).to_pylist() for c in ("_text", "keep", "n_lines")), strict=True):
            if keep is not None:
                bits = np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8), count=n_lines, bitorder="little")
                text = "\n".join(line for line, bit in zip((text or "").split("\n"), bits.tolist(), strict=True) if bit)
            texts.append(text)
        at = batch.schema.get_field_index("_text")
        yield batch.set_column(at, "_text", pa.array(texts, pa.string())).drop_columns(["keep", "n_lines"])


def drop_shared_lines(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """The rows and columns of `docs`, shared lines removed from their texts. See shared_line_bitmaps."""
    maps = shared_line_bitmaps(docs, text, doc_id, min_chars, min_docs).drop("n_dropped")
    rows, text, _ = numbered(docs, text, doc_id)
    joined = rows.withColumnRenamed(text, "_text").join(maps, ["_id", "_copy"], "left").drop("_id", "_copy")
    kept = joined.mapInArrow(apply_bitmaps, joined.drop("keep", "n_lines").schema)
    return named(kept.withColumnRenamed("_text", text), docs)


def line_report(docs: DataFrame) -> DataFrame:
    """Per document: lines before, lines dropped, and the hash of what is left."""
    rows = keyed(docs)
    maps = shared_line_bitmaps(docs).withColumnRenamed("n_lines", "lines")
    joined = rows.join(maps, ["_id", "_copy"], "left")
    text = F.coalesce("_text", F.lit(""))
    counted = joined.select(
        "_id",
        text.alias("_text"),
        "keep",
        F.col("lines").alias("n_lines"),
        F.coalesce("n_dropped", F.lit(0)).cast("bigint").alias("n_dropped"),
        (F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1).cast("bigint").alias("all_lines"),
    )
    kept = counted.mapInArrow(apply_bitmaps, "_id long, _text string, n_dropped long, all_lines long")
    return kept.select(
        restored("_id").alias("doc_id"),
        F.col("all_lines").alias("n_lines"),
        "n_dropped",
        F.sha2("_text", 256).alias("kept_sha256"),
    )
