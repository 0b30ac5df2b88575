"""Token ids in compressed files that decode in parallel: static range asymmetric numeral systems (rANS).

One table of symbol frequencies, counted over the whole corpus, is shared by all blocks. A block holds the ids of
consecutive documents, dealt in turn to `LANES` coder states that advance together (a step is one numpy operation on all
lanes). Every `STEPS` steps the states and the place in the stream are written down as a checkpoint with the
checksum of the ids up to the next one, so blocks, and the stretches between checkpoints, decode independently.

Files lie in a folder: `table` (symbol, frequency) and `blocks` (shard, block, documents and their token counts,
payload), both written by Spark's Parquet writer, whose commit makes a lost task's file vanish as a whole. Shards ascend by
document id and so do blocks in a shard.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

from creditloom.llm import arrays
from creditloom.llm.common import importable, keyed, restored, staged

LANES = 1024
STEPS = 128  # between checkpoints
BLOCK_TOKENS = 1 << 18
SCALE_BITS = 20  # frequencies add up to 2**SCALE_BITS, or to more if there are so many symbols
LOW = np.uint64(1 << 31)  # states stay in [LOW, 2**63)
WORD = np.uint64(32)
WORD_MASK = np.uint64(0xFFFFFFFF)
CACHED = 400_000  # parts of words whose ids a worker remembers
SLICE_BYTES = 2 << 20  # text whose distinct parts are looked up at a time

#: The steps before merging of a tokenizer that lower-cases and drops white space. Its ids of a text
#: are those of the text's words in turn.
WORD_NORMALIZER = [
    {"type": "NFC"},
    {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "},
    {"type": "Lowercase"},
]
WORD_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

#: Kinds of bytes. Runs of letters and of signs are parts of a word, and each digit is one. ODD is all else: an apostrophe, a
#: bracket that could open a special token, control characters, and characters beyond Latin-1, whose words the library takes whole.
GAP, LETTER, DIGIT, SIGN, ODD = range(5)
KINDS = np.full(256, ODD, np.uint8)
KINDS[0x21:0x7F] = SIGN
KINDS[0x30:0x3A] = DIGIT
KINDS[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = LETTER
KINDS[[ord("'"), ord("<")]] = ODD
KINDS[arrays.SPACE] = GAP
#: The second bytes of Latin-1 letters, and of those among them that are capitals.
LATIN, LATIN_CAPITAL = np.zeros((2, 256), bool)
LATIN[0x80:0xC0] = True
LATIN_CAPITAL[0x80:0x9F] = True
LATIN[[0x97, 0xB7]] = LATIN_CAPITAL[0x97] = False


def parts_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Parts of the words of many texts: their bytes in lower case without gaps, where each begins there, whether it is an odd
    word as a whole (as it stands in the text), and the number of the first part of each text."""
    kind = KINDS[data]
    second = np.flatnonzero((data[:-1] == 0xC3) & LATIN[data[1:]]) + 1
    kind[second] = kind[second - 1] = LETTER
    small = arrays.LOWER[data]
    small[second[LATIN_CAPITAL[data[second]]]] += 0x20
    if (kind == ODD).any():
        starts, ends, _ = arrays.runs(kind != GAP, offsets)
        upto = np.concatenate(([0], np.cumsum(kind == ODD, dtype=np.int32)))
        holds = upto[ends] > upto[starts]
        marks = np.zeros(len(data) + 1, np.int8)
        marks[starts[holds]] += 1
        marks[ends[holds]] -= 1
        odd = np.cumsum(marks[:-1], dtype=np.int8).view(bool)
        kind[odd] = ODD
        small[odd] = data[odd]
    begins = (kind != GAP) & (kind != ODD)
    begins[1:] = (kind[1:] != GAP) & ((kind[1:] != kind[:-1]) | (kind[1:] == DIGIT))
    edges = offsets[offsets < len(data)]
    begins[edges] = kind[edges] != GAP
    at = np.flatnonzero(begins)
    inside = kind != GAP
    before = np.cumsum(inside, dtype=np.int32) - inside
    return small[inside], before[at], kind[at] == ODD, np.searchsorted(at, offsets)


class Encoder:
    """Texts to ids. With a word tokenizer, distinct parts of words are looked up, and their ids are remembered."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            config = json.load(file)
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        split = (config.get("pre_tokenizer") or {}).get("pretokenizers") or [{}, {}]
        self.by_word = (
            (config.get("normalizer") or {}).get("normalizers") == WORD_NORMALIZER
            and len(split) == 2
            and split[0].get("pattern") == {"Regex": WORD_SPLIT}
            and split[1].get("type") == "ByteLevel"
            and not config.get("truncation")
        )
        self.model = self.tokenizer.model
        bytes_of = ByteLevel(add_prefix_space=False, use_regex=False)
        self.letters = str.maketrans({c: bytes_of.pre_tokenize_str(c)[0][0] for c in map(chr, range(0xDF, 0x100))})
        self.forget()

    def forget(self) -> None:
        self.known = pa.array([], pa.binary())
        self.ids, self.sizes = np.zeros(0, self.dtype), np.zeros(0, np.int64)

    def whole(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def look_up(self, parts: pa.Array, odd: np.ndarray) -> np.ndarray:
        """Places in `known` of distinct parts; those not there yet go through the tokenizer."""
        place = pc.index_in(parts, value_set=self.known)
        if place.null_count and len(self.known) + place.null_count > CACHED:
            self.forget()
            place = pc.index_in(parts, value_set=self.known)
        new = np.flatnonzero(place.is_null().to_numpy(zero_copy_only=False))
        if len(new):
            tokenize, letters = self.model.tokenize, self.letters
            texts = parts.take(pa.array(new)).cast(pa.string()).to_pylist()
            plain = [[t.id for t in tokenize(x if x.isascii() else x.translate(letters))] for x, o in zip(texts, odd[new].tolist(), strict=True) if not o]
            found, others = iter(plain), iter(self.whole([texts[k] for k in np.flatnonzero(odd[new])]))
            ids = [next(others if o else found) for o in odd[new].tolist()]
            self.ids = np.concatenate((self.ids, np.fromiter(chain.from_iterable(ids), self.dtype)))
            self.sizes = np.concatenate((self.sizes, np.fromiter(map(len, ids), np.int64, len(ids))))
            out = place.fill_null(0).to_numpy().astype(np.int64)
            out[new] = len(self.known) + np.arange(len(new))
            self.known = pa.concat_arrays([self.known, parts.take(pa.array(new))])
            return out
        return place.to_numpy().astype(np.int64)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after another, and how many each has. A null text is empty."""
        if not self.by_word:
            ids = self.whole(pc.fill_null(texts, "").to_pylist())
            return np.fromiter(chain.from_iterable(ids), self.dtype), np.array([len(x) for x in ids])
        data, offsets = arrays.text_bytes(texts)
        if not len(data):
            return np.zeros(0, self.dtype), np.zeros(len(texts), np.int64)
        small, begins, odd, first = parts_of(data, offsets)
        ends = np.append(begins[1:], len(small)).astype(np.int32)
        buffers = [None, pa.py_buffer(np.concatenate(([0], ends)).astype(np.int32)), pa.py_buffer(small)]
        parts = pa.Array.from_buffers(pa.binary(), len(begins), buffers).dictionary_encode()
        code = parts.indices.to_numpy()
        strange = np.zeros(len(parts.dictionary), bool)
        strange[code[odd]] = True
        place = self.look_up(parts.dictionary, strange)[code]
        counts = self.sizes[place]
        ends = np.cumsum(counts)
        shift = (np.cumsum(self.sizes) - self.sizes)[place] - (ends - counts)
        found = self.ids[np.repeat(shift, counts) + np.arange(ends[-1] if len(ends) else 0)]
        return found, np.diff(np.concatenate(([0], ends))[first])


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def tokenize(path: str, end_id: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path)
        for batch in arrays.text_slices(batches, "_text", SLICE_BYTES):
            ids, counts = coder.encode(batch.column("_text"))
            if end_id is not None:
                ids = np.insert(ids, np.cumsum(counts), end_id)
                counts = counts + 1
            offsets = np.concatenate(([0], np.cumsum(counts))) * coder.dtype.itemsize
            found = pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(ids)])
            yield pa.RecordBatch.from_arrays([batch.column("_id"), batch.column("_copy"), found], names=["_id", "_copy", "ids"])

    return run


def count_symbols(dtype: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1, np.int64)
        for batch in batches:
            ids = pa.concat_arrays([batch.column("ids")])
            edges = np.frombuffer(ids.buffers()[1], np.int32)[[ids.offset, ids.offset + len(ids)]]
            packed = np.frombuffer(ids.buffers()[2] or b"", np.uint8)[edges[0] : edges[1]]
            found = np.bincount(packed.view(dtype), minlength=len(total))
            found[: len(total)] += total
            total = found
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["symbol", "n"])

    return run


class Table:
    """Frequencies of the symbols that occur, scaled to a power of two, each at least one."""

    def __init__(self, symbols: np.ndarray, frequencies: np.ndarray):
        self.bits = np.uint64(int(frequencies.sum()).bit_length() - 1) if len(frequencies) else np.uint64(0)
        size = int(symbols.max()) + 1 if len(symbols) else 0
        self.frequency, self.begin = np.zeros(size, np.uint64), np.zeros(size, np.uint64)
        self.frequency[symbols] = frequencies
        self.begin[symbols] = np.cumsum(frequencies) - frequencies
        self.symbols = np.repeat(symbols, frequencies).astype(np.uint32)

    @staticmethod
    def scaled(counts: np.ndarray) -> np.ndarray:
        if not len(counts):
            return counts
        total = 1 << max(SCALE_BITS, int(len(counts) * 4).bit_length())
        shares = counts * (total / counts.sum())
        out = np.maximum(1, np.floor(shares)).astype(np.int64)
        # What rounding left over goes to, or is taken from, the most frequent symbols, whose codes it changes least.
        order = np.argsort(-out, kind="stable")
        rest = total - int(out.sum())
        while rest:
            step = order[out[order] > 1][: abs(rest)] if rest < 0 else order[: abs(rest)]
            out[step] += 1 if rest > 0 else -1
            rest = total - int(out.sum())
        return out


def encode_block(ids: np.ndarray, table: Table) -> bytes:
    """Header (tokens, lanes, checkpoints, words), checkpoints (place, checksum, states), words."""
    lanes = min(LANES, len(ids))
    steps = -(-len(ids) // lanes)
    frequency, begin = table.frequency[ids], table.begin[ids]
    limit = frequency << (np.uint64(63) - table.bits)
    states = np.full(lanes, LOW, np.uint64)
    words, sizes, saved = [], np.zeros(steps, np.int64), {}
    for step in range(steps - 1, -1, -1):
        a, b = step * lanes, min((step + 1) * lanes, len(ids))
        x, f = states[: b - a], frequency[a:b]
        full = x >= limit[a:b]
        out = (x[full] & WORD_MASK).astype("<u4")
        words.append(out)
        sizes[step] = len(out)
        x = np.where(full, x >> WORD, x)
        quotient = x // f
        states[: b - a] = (quotient << table.bits) + (x - quotient * f) + begin[a:b]
        if step % STEPS == 0:
            saved[step] = states.copy()
    places = np.cumsum(sizes) - sizes
    head = np.array([len(ids), lanes, len(saved), sizes.sum()], "<u8").tobytes()
    plain = ids.astype("<u4")
    marks = []
    for step in sorted(saved):
        stretch = plain[step * lanes : (step + STEPS) * lanes].tobytes()
        marks += [np.array([places[step], zlib.crc32(stretch)], "<u8").tobytes(), saved[step].astype("<u8").tobytes()]
    return head + b"".join(marks) + b"".join(x.tobytes() for x in reversed(words))


def decode_block(payload: bytes, table: Table) -> np.ndarray:
    """The ids of a block. All stretches between checkpoints advance together, each from its own."""
    count, lanes, n_marks, _ = (int(x) for x in np.frombuffer(payload, "<u8", 4))
    marks = np.frombuffer(payload, "<u8", n_marks * (2 + lanes), 32).reshape(n_marks, 2 + lanes)
    words = np.frombuffer(payload, "<u4", offset=32 + marks.nbytes)
    place, states = marks[:, 0].astype(np.int64), marks[:, 2:].astype(np.uint64)
    mask = np.uint64((1 << int(table.bits)) - 1)
    ids = np.zeros((n_marks, STEPS, lanes), np.uint32)
    lane = np.arange(lanes)
    for step in range(STEPS):
        left = count - (np.arange(n_marks) * STEPS + step) * lanes
        rows = int((left > 0).sum())  # only the last stretch can be shorter
        if not rows:
            break
        x = states[:rows]
        slot = x & mask
        symbol = table.symbols[slot]
        ids[:rows, step] = symbol
        x = table.frequency[symbol] * (x >> table.bits) + slot - table.begin[symbol]
        low = x < LOW
        if left[rows - 1] < lanes:
            low[-1] &= lane < left[rows - 1]
        at = np.cumsum(low, axis=1)
        x[low] = (x[low] << WORD) | words[(place[:rows, None] + at - 1)[low]]
        states[:rows] = x
        place[:rows] += at[:, -1]
    for k in range(n_marks):
        stretch = ids[k].reshape(-1)[: max(0, count - k * STEPS * lanes)]
        if zlib.crc32(stretch.tobytes()) != int(marks[k, 1]):
            raise ValueError("a block's ids don't match their checksum")
    return ids.reshape(-1)[:count]


#: `begin` is how many ids of the shard come before the block; `pieces` numbers the documents of the shard.
BLOCKS = "shard int, block int, begin long, tokens long, ids array<long>, copies array<long>, pieces array<long>, sizes array<long>, payload binary"


def write_blocks(symbols: np.ndarray, frequencies: np.ndarray, dtype: str, most: int):
    """Over documents in order: blocks of whole documents as far as they fit, a larger document in several blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Table(symbols, frequencies)
        shard, number, n_docs, begin = TaskContext.get().partitionId(), 0, -1, 0
        held: list[tuple[int, int, int, np.ndarray]] = []

        def block() -> pa.RecordBatch:
            ids = np.concatenate([x[3] for x in held])
            columns = [[shard], [number], [begin], [len(ids)], *([[x[k] for x in held]] for k in range(3)), [[len(x[3]) for x in held]]]
            types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), *[pa.list_(pa.int64())] * 4]
            payload = encode_block(ids, table) if len(ids) else b""
            return pa.RecordBatch.from_arrays(
                [*(pa.array(c, t) for c, t in zip(columns, types, strict=True)), pa.array([payload], pa.binary())],
                names=["shard", "block", "begin", "tokens", "ids", "copies", "pieces", "sizes", "payload"],
            )

        size = 0
        for batch in batches:
            rows = zip(batch.column("_id").to_pylist(), batch.column("_copy").to_pylist(), batch.column("ids"), strict=True)
            for doc_id, copy, ids in rows:
                ids = np.frombuffer(ids.as_buffer(), dtype)
                n_docs += 1
                for low in range(0, max(1, len(ids)), most):
                    piece = ids[low : low + most]
                    if held and size + len(piece) > most:
                        yield block()
                        held, size, number, begin = [], 0, number + 1, begin + size
                    held.append((doc_id, copy, n_docs, piece.copy()))
                    size += len(piece)
        if held:
            yield block()

    return run


def write_ids(docs: DataFrame, path: str, tokenizer: str, end_id: int | None, text: str = "text", doc_id: str = "doc_id") -> None:
    """Encodes every text, appends `end_id` to each document, and writes the files in ascending order of ids.

    A null text is empty. Rows without an id come first; rows that repeat an id follow each other. Other columns are not read.
    An empty table writes an empty table of frequencies and no blocks.
    """
    spark = docs.sparkSession
    dtype = Encoder(tokenizer).dtype.str
    tokens = staged(keyed(docs, text, doc_id).mapInArrow(tokenize(tokenizer, end_id), "_id long, _copy long, ids binary"))
    counted = tokens.select("ids").mapInArrow(count_symbols(dtype), "symbol long, n long").groupBy("symbol").agg(F.sum("n").alias("n"))
    # One row for each symbol of the vocabulary at most.
    rows = counted.orderBy("symbol").collect()
    symbols = np.array([r.symbol for r in rows], np.int64)
    frequencies = Table.scaled(np.array([r.n for r in rows], np.int64))
    table = spark.createDataFrame(list(zip(symbols.tolist(), frequencies.tolist(), strict=True)), "symbol long, frequency long")
    table.coalesce(1).write.parquet(f"{path}/table")
    ordered = tokens.repartitionByRange("_id", "_copy").sortWithinPartitions("_id", "_copy")
    blocks = ordered.mapInArrow(write_blocks(symbols, frequencies, dtype, BLOCK_TOKENS), BLOCKS)
    blocks.write.option("compression", "none").parquet(f"{path}/blocks")


def crc32_joined(one: int, two: int, length: int) -> int:
    """Checksum of two byte strings in a row from theirs; `length` is that of the second."""
    # A zero bit is a linear map of the 32 checksum bits; squared again and again it makes those for all powers of two.
    power = [0xEDB88320] + [1 << k for k in range(31)]

    def apply(matrix: list[int], x: int) -> int:
        out = 0
        for row in matrix:
            if not x:
                break
            if x & 1:
                out ^= row
            x >>= 1
        return out

    bits = 8 * length
    while bits:
        if bits & 1:
            one = apply(power, one)
        power = [apply(power, row) for row in power]
        bits >>= 1
    return one ^ two


PIECES = "shard int, block int, doc long, _id long, _copy long, begin long, size long, crc long"


def read_blocks(symbols: np.ndarray, frequencies: np.ndarray, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Table(symbols, frequencies)
        for batch in batches:
            for row in range(batch.num_rows):
                fields = ("shard", "block", "begin", "ids", "copies", "pieces", "sizes")
                shard, block, begin, ids, copies, docs, sizes = (batch.column(c)[row].as_py() for c in fields)
                payload = batch.column("payload")[row].as_buffer()
                tokens = decode_block(payload, table) if payload.size else np.zeros(0, np.uint32)
                ends = np.cumsum(sizes)
                parts = [tokens[b - n : b].tobytes() for b, n in zip(ends.tolist(), sizes, strict=True)]
                begins = begin + ends - sizes
                columns = [pa.array(c, pa.int64()) for c in (docs, ids, copies, begins, sizes, [zlib.crc32(x) for x in parts])]
                head = [pa.array([x] * len(ids), pa.int32()) for x in (shard, block)]
                names = ["shard", "block", "doc", "_id", "_copy", "begin", "size", "crc"]
                if with_ids:
                    columns.append(pa.array(parts, pa.binary()))
                    names.append("part")
                yield pa.RecordBatch.from_arrays([*head, *columns], names=names)

    return run


def join_pieces(with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            checksums, ids = [], []
            for pieces in batch.column("pieces").to_pylist():
                crc = pieces[0]["crc"]
                for piece in pieces[1:]:
                    crc = crc32_joined(crc, piece["crc"], 4 * piece["size"])
                checksums.append(crc)
                if with_ids:
                    ids.append(b"".join(piece["part"] for piece in pieces))
            batch = batch.drop_columns(["pieces"]).append_column("ids_crc32", pa.array(checksums, pa.int64()))
            yield batch.append_column("ids", pa.array(ids, pa.binary())) if with_ids else batch

    return run


def read_ids(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """Per document of the files: `doc_id`, `start` (ids of all documents before it), `n_tokens`, `ids_crc32`.

    `with_ids` adds `ids`, unsigned 32-bit integers in little-endian order. A block whose ids don't match their checksums fails.
    """
    importable(spark)
    table = spark.read.schema("symbol long, frequency long").parquet(f"{path}/table").orderBy("symbol").collect()
    symbols, frequencies = (np.array([r[k] for r in table], np.int64) for k in (0, 1))
    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    schema = PIECES + (", part binary" if with_ids else "")
    pieces = blocks.mapInArrow(read_blocks(symbols, frequencies, with_ids), schema)
    fields = ["block", "size", "crc", *(["part"] if with_ids else [])]
    whole = pieces.groupBy("shard", "doc").agg(
        F.first("_id").alias("_id"),
        F.min("begin").alias("inside"),
        F.sum("size").alias("n_tokens"),
        F.array_sort(F.collect_list(F.struct(*fields))).alias("pieces"),
    )
    kept = [f"{c} {'int' if c == 'shard' else 'long'}" for c in whole.columns if c != "pieces"]
    whole = whole.mapInArrow(join_pieces(with_ids), ", ".join([*kept, "ids_crc32 long", *["ids binary"] * with_ids]))
    # There is one row for each shard, the output of a task.
    sizes = blocks.groupBy("shard").agg(F.sum("tokens").alias("tokens"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("shard", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("base"))
    placed = whole.join(bases, "shard")
    extra = ["ids"] if with_ids else []
    start = (F.col("base") + F.col("inside")).alias("start")
    return placed.select(restored("_id").alias("doc_id"), start, "n_tokens", "ids_crc32", *extra)
