"""Language identification with a string kernel.

A text is the set of its byte n-grams of one to five bytes, hashed into `BINS` bins; the kernel of two texts is the size of the
intersection over the geometric mean of both sizes. A bounded sample of labelled texts is fitted: some of them are
Nystroem landmarks, and one ridge regression for each language against the rest has its weights on these. As the kernel
is linear in the bins, weights and landmarks fold into one matrix of bins and languages, and scoring a batch is the product
of its presence matrix with that one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creditloom.llm import arrays
from creditloom.llm.common import importable, keyed, restored

ORDERS = (1, 2, 3, 4, 5)
BINS = 1 << 15
ROWS = 64  # texts of a presence matrix
UNKNOWN = "und"

#: ASCII letters in lower case, other ASCII characters as blanks, bytes of other characters as they are.
PLAIN = np.arange(256, dtype=np.uint8)
PLAIN[:0x80] = 0x20
PLAIN[0x61:0x7B] = np.arange(0x61, 0x7B)
PLAIN[0x41:0x5B] = np.arange(0x61, 0x7B)


def bins(text: bytes) -> np.ndarray:
    """Bins of the n-grams of a text, with repetitions. Runs of blanks count as one."""
    codes = PLAIN[np.frombuffer(text, np.uint8)]
    blank = codes == 0x20
    keep = ~blank
    keep[1:] |= ~blank[:-1]
    codes = codes[keep].astype(np.uint32)
    out, value = [], np.zeros(len(codes), np.uint32)
    for n in ORDERS:
        if len(codes) < n:
            break
        # Multiplicative hashing; the top bits are the bin.
        value = (value[: len(codes) - n + 1] * np.uint32(0x01000193)) ^ (codes[n - 1 :] + np.uint32(n))
        out.append((value * np.uint32(0x9E3779B1)) >> np.uint32(17))
    return np.concatenate(out) if out else np.zeros(0, np.uint32)


def presence(texts: list[bytes]) -> np.ndarray:
    table = np.zeros((len(texts), BINS), np.float32)
    for row, text in zip(table, texts, strict=True):
        row[bins(text)] = 1
    return table


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


@dataclass(frozen=True)
class KernelModel:
    languages: list[str]
    weights: np.ndarray  # bins x languages

    def scores(self, table: np.ndarray) -> np.ndarray:
        return (table @ self.weights) / np.sqrt(np.maximum(table.sum(axis=1), 1))[:, None]


def fit_kernel(tables: np.ndarray, labels: list[str], landmarks: int, ridge: float) -> KernelModel:
    """`tables` holds presence vectors, packed eight bins a byte, of labelled texts in a random order."""
    languages = sorted(set(labels))
    if not languages:
        return KernelModel([], np.zeros((BINS, 0), np.float32))

    def unpacked(rows: np.ndarray) -> np.ndarray:
        x = np.unpackbits(rows, axis=1).astype(np.float32)
        return x / np.sqrt(np.maximum(x.sum(axis=1, keepdims=True), 1))

    # As many landmarks of each language, so that rare ones are represented.
    names = np.array(labels)
    each = max(1, landmarks // len(languages))
    chosen = np.concatenate([np.flatnonzero(names == x)[:each] for x in languages])
    marks = unpacked(tables[chosen])
    kernel = np.concatenate([unpacked(tables[i : i + ROWS]) @ marks.T for i in range(0, len(tables), ROWS)]).astype(np.float64)
    among = (marks @ marks.T).astype(np.float64)
    targets = np.where(names[:, None] == np.array(languages)[None, :], 1.0, -1.0)
    system = kernel.T @ kernel + ridge * len(tables) * among + 1e-9 * len(tables) * np.eye(len(chosen))
    alpha = np.linalg.solve(system, kernel.T @ targets)
    return KernelModel(languages, (marks.T @ alpha).astype(np.float32))


def packed_bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [np.packbits(presence([(x or "").encode()])[0] > 0).tobytes() for x in batch.column("_text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("lang"), batch.column("draw"), pa.array(rows, pa.binary())], names=["lang", "draw", "bits"])


def held_out(doc_id: str) -> Column:
    """Whether the checksum of the id as text leaves 1 modulo 3."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1


def learn(docs: DataFrame, text: str, lang: str, doc_id: str, sample_rows: int = 2048, landmarks: int = 256, ridge: float = 1e-5) -> KernelModel:
    """A model of at most `sample_rows` texts, as many of each language as there are, drawn by a hash of the id.

    Learns from rows with a language, an id and a text with letters, and not from those held out. Rows that repeat id, text and language
    are one draw wherever draws are counted, ranked or read, so neither do they crowd out other texts nor come to the driver twice.
    """
    importable(docs.sparkSession)
    usable = docs.where(F.col(lang).isNotNull() & F.col(doc_id).isNotNull() & F.col(text).rlike(r"\p{L}") & ~held_out(doc_id))
    rows = usable.select(F.col(lang).alias("lang"), F.xxhash64(F.lit(8), F.col(doc_id), F.col(text)).alias("draw"), F.col(text).alias("_text"))
    sizes = rows.groupBy("lang").agg(F.approx_count_distinct("draw", 0.02).alias("n")).limit(sample_rows + 1).collect()
    if len(sizes) > sample_rows:
        raise ValueError(f"more than {sample_rows} languages; raise sample_rows")
    each = max(1, sample_rows // max(1, len(sizes)))
    # About twice as many draws of each language pass as are wanted, so the choice among them is small at any size. Only
    # hashes travel to it; the texts of the chosen draws are found by a broadcast of at most sample_rows of them.
    shares = docs.sparkSession.createDataFrame([(r.lang, min(1.0, (2 * each + 20) / r.n)) for r in sizes], "lang string, share double")
    place = F.shiftrightunsigned("draw", 11) / float(1 << 53)
    few = rows.select("lang", "draw").join(F.broadcast(shares), "lang").where(place < F.col("share")).select("lang", "draw").distinct()
    first = Window.partitionBy("lang").orderBy(place, "draw")
    chosen = few.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= each).select("lang", "draw")
    found = rows.join(F.broadcast(chosen), ["lang", "draw"]).dropDuplicates(["lang", "draw"])
    sample = found.mapInArrow(packed_bins, "lang string, draw long, bits binary").collect()
    sample = sorted((r.draw, r.lang, bytes(r.bits)) for r in sample)
    tables = np.array([np.frombuffer(r[2], np.uint8) for r in sample]).reshape(-1, BINS // 8)
    return fit_kernel(tables, [r[1] for r in sample], landmarks, ridge)


def predict(model: KernelModel):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrays.text_slices(batches, "_text"):
            names, best = [], []
            texts = batch.column("_text").to_pylist()
            for i in range(0, len(texts), ROWS):
                some = texts[i : i + ROWS]
                if not model.languages:
                    names += [UNKNOWN] * len(some)
                    best += [0.0] * len(some)
                    continue
                scores = model.scores(presence([(x or "").encode() for x in some])).astype(np.float64)
                odds = np.exp(4 * (scores - scores.max(axis=1, keepdims=True)))
                odds /= odds.sum(axis=1, keepdims=True)
                for x, k, row in zip(some, scores.argmax(axis=1), odds, strict=True):
                    spoken = has_letter(x)
                    names.append(model.languages[k] if spoken else UNKNOWN)
                    best.append(float(row[k]) if spoken else 0.0)
            yield pa.RecordBatch.from_arrays([batch.column("_id"), pa.array(names, pa.string()), pa.array(best, pa.float64())], names=["_id", "lang_pred", "score"])

    return run


def identify(docs: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id", **fit) -> DataFrame:
    """Per row: `doc_id`, `held_out`, `lang_pred` and `score` (0 to 1), from the text alone.

    A null text, or one without a letter, is `und` with score 0, as is every text if nothing can be learned. Ties go to
    the first language by name. A row without an id isn't held out and nothing is learned from it. Repeated rows are predicted
    each; other columns are not read. `fit` are the bounds of `learn`. An empty table gives no rows.
    """
    model = learn(docs, text, lang, doc_id, **fit)
    rows = keyed(docs, text, doc_id).drop("_copy")
    found = rows.mapInArrow(predict(model), "_id long, lang_pred string, score double")
    shown = found.select(restored("_id").alias("doc_id"), "lang_pred", "score")
    return shown.select("doc_id", F.coalesce(held_out("doc_id"), F.lit(False)).alias("held_out"), "lang_pred", "score")
