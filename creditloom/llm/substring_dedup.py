"""Removal of repeated word sequences by prefix-partitioned suffix trees.

A suffix is a place in a text with the words that follow; as windows of `window` words are judged, the trees are cut
off at that depth. Suffixes are split by prefixes of variable length: the prefix of a suffix runs up to the end of its
anchor, the `ANCHOR` consecutive words of the window with the smallest hash. Equal windows have equal anchors at the
same place, so all suffixes that can share a deep node meet in the group of their anchor, and the anchor's hash
says to which group a suffix goes. A first pass counts the suffixes of each group, and one that is too large for memory is split by path
labels, as only leaves with equal labels have to meet. Some seven neighbouring suffixes share an anchor and travel as one
entry of a packed block: anchor, document, place, and a 64-bit label of each suffix's path.

Within a group, suffixes sorted by path label stand as the leaves of the subtree. Leaves with one label hang below an
internal node of full depth: a maximal repeat. Its earliest leaf stays and the others are covered. Leaves meet on a label of
64 bits within an anchor of 32 more, which is what tells different windows apart.

Hot nodes are thinned out before the shuffle. Of the leaves of a node that one map batch sees, the earliest alone goes
on; the others start later than it, so they are covered whatever other batches hold. A group so holds a leaf of each
node and batch at most, whether a passage stands in ten documents or in a third of all.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditloom.llm import arrays
from creditloom.llm.common import groups_for, keyed, restored

ANCHOR = 8  # words
LEAF_BYTES = 9  # what a suffix takes in a packed block, its share of the anchor included
BATCH_BYTES = 8 << 20  # text whose repeats are settled before the shuffle
GROUP_BYTES = 24 << 20  # packed leaves that a group should hold

BLOCKS = "bucket int, docs binary, anchors binary, labels binary"
PARTS = "part int, docs binary, spans binary"
SPANS = "_id long, _copy long, spans binary"
#: A document of a block.
DOC = np.dtype([("id", "<i8"), ("copy", "<i8")])
#: An entry: low half of the anchor's hash, number of its document in the block, first suffix, and how many follow.
ENTRY = np.dtype([("anchor", "<u4"), ("doc", "<u4"), ("start", "<u4"), ("count", "u1")])


class Suffixes:
    """Suffixes of a batch as columns: place in the text, document, anchor, label."""

    def __init__(self, start, doc, anchor, label):
        self.start, self.doc, self.anchor, self.label = start, doc, anchor, label

    def take(self, rows: np.ndarray) -> Suffixes:
        return Suffixes(self.start[rows], self.doc[rows], self.anchor[rows], self.label[rows])

    @staticmethod
    def joined(parts: list[Suffixes]) -> Suffixes:
        return Suffixes(*(np.concatenate([getattr(p, k) for p in parts]) for k in ("start", "doc", "anchor", "label")))


def suffixes(texts: pa.Array, window: int) -> Suffixes:
    data, offsets = arrays.text_bytes(texts)
    starts, ends, first = arrays.words(data, offsets)
    hashes = arrays.span_hashes(data, starts, ends)
    at = arrays.gram_starts(first, window)
    size = min(ANCHOR, window)
    grams = np.arange(max(0, len(hashes) - size + 1))
    grams = arrays.gram_hashes(hashes, grams, grams + size)
    anchor = np.zeros(len(at), np.int64)
    for low in range(0, len(at), 1 << 16):
        some = at[low : low + (1 << 16)]
        views = np.lib.stride_tricks.sliding_window_view(grams, window - size + 1)
        anchor[low : low + (1 << 16)] = some + views[some].argmin(axis=1)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(first))[at]
    return Suffixes(at - first[text], text, grams[anchor], arrays.gram_hashes(hashes, at, at + window))


def earliest(label: np.ndarray, anchor: np.ndarray, start: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Whether each leaf starts no later than all others with its label and anchor; leaves that tie all do."""
    out = np.ones(len(label), bool)
    order = np.argsort(label)
    ordered = label[order]
    same = np.zeros(len(label), bool)
    same[1:] = ordered[1:] == ordered[:-1]
    same[:-1] |= same[1:].copy()
    rows = order[same]  # all others are alone below their node
    if not len(rows):
        return out
    rows = rows[np.lexsort((start[rows], ids[rows], anchor[rows], label[rows]))]
    new = np.ones(len(rows), bool)
    new[1:] = (label[rows][1:] != label[rows][:-1]) | (anchor[rows][1:] != anchor[rows][:-1])
    head = rows[np.flatnonzero(new)][np.cumsum(new) - 1]
    out[rows] = (ids[rows] == ids[head]) & (start[rows] == start[head])
    return out


def spans(ids: np.ndarray, copies: np.ndarray, start: np.ndarray, window: int) -> pa.RecordBatch:
    """Covered words of each document, as pairs of first and last word plus one; runs of suffixes make one pair."""
    order = np.lexsort((start, copies, ids))
    ids, copies, start = ids[order], copies[order], start[order].astype(np.int64)
    other = np.ones(len(ids), bool)
    other[1:] = (ids[1:] != ids[:-1]) | (copies[1:] != copies[:-1])
    begins = other.copy()
    begins[1:] |= start[1:] > start[:-1] + 1
    at = np.flatnonzero(begins)
    last = np.append(at[1:], len(ids)) - 1
    pairs = np.stack([start[at], start[last] + window], axis=1).astype("<u4")
    docs = np.flatnonzero(other)
    bounds = np.append(np.searchsorted(at, docs), len(at))
    packed = [pairs[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    return pa.RecordBatch.from_arrays(
        [pa.array(ids[docs]), pa.array(copies[docs]), pa.array(packed, pa.binary())], names=["_id", "_copy", "spans"]
    )


def packed_parts(found: pa.RecordBatch, parts: int) -> list[tuple[int, bytes, bytes]]:
    """Spans of documents as one row for each part: the documents, then the sizes of their spans and the spans themselves.

    All spans of a document go to the same part, by its id and the hash of its text; so copies of a text spread over the parts.
    """
    ids, copies = (found.column(c).to_numpy().view(np.uint64) for c in ("_id", "_copy"))
    part = arrays.mix(arrays.mix(ids) ^ copies) % np.uint64(parts)
    order = np.argsort(part, kind="stable")
    table = np.zeros(len(order), DOC)
    table["id"], table["copy"] = found.column("_id").to_numpy()[order], found.column("_copy").to_numpy()[order]
    spans_ = found.column("spans").to_pylist()
    at = np.searchsorted(part[order], np.arange(parts + 1, dtype=np.uint64))
    rows = []
    for k in np.flatnonzero(np.diff(at)):
        some = [spans_[x] for x in order[at[k] : at[k + 1]]]
        sizes = np.array([len(x) for x in some], "<u4").tobytes()
        rows.append((int(k), table[at[k] : at[k + 1]].tobytes(), sizes + b"".join(some)))
    return rows


def unpacked_parts(docs: bytes, packed: bytes) -> tuple[np.ndarray, list[bytes]]:
    table = np.frombuffer(docs, DOC)
    at = np.concatenate(([0], np.cumsum(np.frombuffer(packed, "<u4", len(table)), dtype=np.int64))) + 4 * len(table)
    return table, [packed[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]


def block(bucket: int, ids: np.ndarray, copies: np.ndarray, found: Suffixes) -> tuple:
    """Suffixes in the order of their texts, packed."""
    docs, doc = np.unique(found.doc, return_inverse=True)
    table = np.zeros(len(docs), DOC)
    table["id"], table["copy"] = ids[docs], copies[docs]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (found.anchor[1:] != found.anchor[:-1]) | (found.start[1:] != found.start[:-1] + 1)
    run = np.cumsum(new) - 1
    new |= (np.arange(len(doc)) - np.flatnonzero(new)[run]) % 255 == 0  # the count has one byte
    at = np.flatnonzero(new)
    entries = np.zeros(len(at), ENTRY)
    entries["anchor"] = (found.anchor[at] & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    entries["doc"], entries["start"] = doc[at], found.start[at]
    entries["count"] = np.diff(np.append(at, len(doc)))
    return bucket, table.tobytes(), entries.tobytes(), found.label.tobytes()


def thinned(batches: Iterator[pa.RecordBatch], window: int, batch_bytes: int) -> Iterator[tuple[pa.RecordBatch, Suffixes, np.ndarray]]:
    """Each batch with its suffixes, and whether each of them goes on."""
    for batch in arrays.text_slices(batches, "_text", batch_bytes):
        parts, row = [], 0
        for piece in arrays.text_slices(iter([batch]), "_text"):
            part = suffixes(piece.column("_text"), window)
            part.doc = part.doc + row
            row += piece.num_rows
            parts.append(part)
        if parts:
            found = Suffixes.joined(parts)
            yield batch, found, earliest(found.label, found.anchor, found.start, batch.column("_id").to_numpy()[found.doc])


def anchor_buckets(anchor: np.ndarray, buckets: int) -> np.ndarray:
    return ((arrays.mix(anchor) >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)


def split_buckets(found: Suffixes, buckets: int, pieces: np.ndarray) -> np.ndarray:
    """The bucket of each suffix by its anchor; of those in several pieces, the first keeps the number and the others follow after all buckets."""
    bucket = anchor_buckets(found.anchor, buckets)
    piece = (arrays.mix(found.label) % pieces[bucket].astype(np.uint64)).astype(np.int64)
    follow = buckets + np.cumsum(pieces - 1) - (pieces - 1)
    return np.where(piece > 0, follow[bucket] + piece - 1, bucket)


def map_sizes(window: int, buckets: int, batch_bytes: int):
    """How many suffixes go on to each bucket, counted by task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = np.zeros(buckets, np.int64)
        for _, found, stays in thinned(batches, window, batch_bytes):
            sizes += np.bincount(anchor_buckets(found.anchor[stays], buckets), minlength=buckets)
        some = np.flatnonzero(sizes)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(sizes[some])], names=["bucket", "n"])

    return run


def map_suffixes(window: int, buckets: int, batch_bytes: int, large: dict[int, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = np.ones(buckets, np.int64)
        pieces[list(large)] = list(large.values())
        total = int(pieces.sum())
        for batch, found, stays in thinned(batches, window, batch_bytes):
            ids, copies = (batch.column(c).to_numpy() for c in ("_id", "_copy"))
            rows = []
            if not stays.all():
                # Settled already: spans of a document, in a bucket of its own choice, without anchors.
                gone = np.flatnonzero(~stays)
                done = spans(ids[found.doc[gone]], copies[found.doc[gone]], found.start[gone], window)
                rows += [(k, docs, None, packed) for k, docs, packed in packed_parts(done, buckets)]
                found = found.take(np.flatnonzero(stays))
            bucket = split_buckets(found, buckets, pieces)
            order = np.argsort(bucket, kind="stable")
            at = np.searchsorted(bucket[order], np.arange(total + 1))
            for k in np.flatnonzero(np.diff(at)):
                rows.append(block(int(k), ids, copies, found.take(order[at[k] : at[k + 1]])))
            columns = list(zip(*rows, strict=True)) or [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int32()), *(pa.array(c, pa.binary()) for c in columns[1:])],
                names=["bucket", "docs", "anchors", "labels"],
            )

    return run


def subtree(window: int, parts: int):
    """Over the blocks of one bucket: spans of the leaves that aren't the earliest of their node, by part."""

    def run(table: pa.Table) -> pa.Table:
        rows, leaves = [], []
        for docs, entries, labels in zip(*(table.column(c).to_pylist() for c in ("docs", "anchors", "labels")), strict=True):
            if entries is None:
                rows.append((table.column("bucket")[0].as_py(), docs, labels))  # settled, and in its part already
                continue
            docs, entries = np.frombuffer(docs, DOC), np.frombuffer(entries, ENTRY)
            count = entries["count"].astype(np.int64)
            begin = np.cumsum(count) - count
            step = (np.arange(int(count.sum())) - np.repeat(begin, count)).astype(np.uint32)
            leaves.append(
                (
                    np.repeat(entries["start"], count) + step,
                    np.repeat(docs["id"][entries["doc"]], count),
                    np.repeat(docs["copy"][entries["doc"]], count),
                    np.repeat(entries["anchor"], count),
                    np.frombuffer(labels, "<u8"),
                )
            )
        if leaves:
            start, ids, copies, anchor, label = (np.concatenate(x) for x in zip(*leaves, strict=True))
            gone = np.flatnonzero(~earliest(label, anchor, start, ids))
            if len(gone):
                rows += packed_parts(spans(ids[gone], copies[gone], start[gone], window), parts)
        columns = list(zip(*rows, strict=True)) or [[]] * 3
        return pa.table({"part": pa.array(columns[0], pa.int32()), "docs": pa.array(columns[1], pa.binary()), "spans": pa.array(columns[2], pa.binary())})

    return run


def whole_documents(table: pa.Table) -> pa.Table:
    """All spans of each document of a part."""
    found: dict[tuple[int, int], list[bytes]] = {}
    for docs, packed in zip(table.column("docs").to_pylist(), table.column("spans").to_pylist(), strict=True):
        names, pieces = unpacked_parts(docs, packed)
        for name, piece in zip(names.tolist(), pieces, strict=True):
            found.setdefault(name, []).append(piece)
    ids, copies = zip(*found, strict=True) if found else ([], [])
    joined = pa.array([b"".join(x) for x in found.values()], pa.binary())
    return pa.table({"_id": pa.array(ids, pa.int64()), "_copy": pa.array(copies, pa.int64()), "spans": joined})


def repeated_spans(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", window: int = 20) -> DataFrame:
    """`_id`, `_copy` and `spans` of the documents that repeat something: words covered by windows that start earlier too.

    A window is `window` consecutive words of one document. It is covered if the same words also start in a document
    with a smaller id, or earlier in the same one. `spans` holds unsigned 32-bit pairs (first word, last word plus one) that
    may overlap. A null text has no words, a null id is smaller than all others. Rows that share an id are copies of one document: none of
    them is earlier than another at the same place. Other columns are not read. An empty table gives no rows.
    """
    rows = keyed(docs, text, doc_id)
    size = docs.agg(F.sum(F.length(text))).first()[0] or 0  # at most one suffix for two characters, mostly for six
    buckets = groups_for(docs.sparkSession, size / 6 * LEAF_BYTES, GROUP_BYTES)
    large = {}
    if size / 2 * LEAF_BYTES > 2 * GROUP_BYTES:  # else no group can be too large
        sizes = rows.mapInArrow(map_sizes(window, buckets, BATCH_BYTES), "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
        too_large = sizes.where(F.col("n") * LEAF_BYTES > 2 * GROUP_BYTES).collect()  # some of the groups' numbers at most
        large = {r.bucket: math.ceil(r.n * LEAF_BYTES / GROUP_BYTES) for r in too_large}
    blocks = rows.mapInArrow(map_suffixes(window, buckets, BATCH_BYTES, large), BLOCKS)
    parts = blocks.groupBy("bucket").applyInArrow(subtree(window, buckets), PARTS)
    return parts.groupBy("part").applyInArrow(whole_documents, SPANS)


def covered(spans: bytes | None, n_words: int) -> np.ndarray:
    """Whether each word stands in a span."""
    edges = np.zeros(n_words + 1, np.int64)
    if spans:
        pairs = np.frombuffer(spans, "<u4").reshape(-1, 2)
        np.add.at(edges, pairs[:, 0], 1)
        np.add.at(edges, pairs[:, 1], -1)
    return np.cumsum(edges)[:n_words] > 0


def kept_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Word counts, and the words that no span covers, joined by one space."""
    for batch in arrays.text_slices(batches, "_text"):
        data, offsets = arrays.text_bytes(batch.column("_text"))
        starts, ends, first = arrays.words(data, offsets)
        raw = data.tobytes()
        n_removed, texts, hashes = [], [], []
        for k, spans_ in enumerate(batch.column("spans").to_pylist()):
            a, b = first[k], first[k + 1]
            if spans_:
                gone = covered(spans_, b - a)
                keep = a + np.flatnonzero(~gone)
                n_removed.append(int(gone.sum()))
                text = b" ".join([raw[x:y] for x, y in zip(starts[keep].tolist(), ends[keep].tolist(), strict=True)])
            else:
                n_removed.append(0)
                text = b" ".join(raw[offsets[k] : offsets[k + 1]].split())  # bytes split at the same six characters
            texts.append(text.decode())
            hashes.append(hashlib.sha256(text).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column("_id"), pa.array(np.diff(first)), pa.array(n_removed, pa.int64()), pa.array(texts, pa.string()), pa.array(hashes, pa.string())],
            names=["_id", "n_words", "n_removed", "kept", "kept_sha256"],
        )


def without_repeats(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", window: int = 20) -> DataFrame:
    """Per row: `doc_id`, `n_words`, `n_removed`, `kept` (the words left, joined by one space) and `kept_sha256`.

    See repeated_spans for what is removed.
    """
    rows = keyed(docs, text, doc_id).join(repeated_spans(docs, text, doc_id, window), ["_id", "_copy"], "left")
    schema = "_id long, n_words long, n_removed long, kept string, kept_sha256 string"
    kept = rows.select("_id", "_text", "spans").mapInArrow(kept_words, schema)
    return kept.select(restored("_id").alias("doc_id"), "n_words", "n_removed", "kept", "kept_sha256")
