"""Document quality by weak supervision: rules vote or abstain, and their accuracies are estimated without labels.

Each rule looks at one trait of a text and votes good (1), bad (-1) or abstains (0). Documents are counted by their
pattern of votes, at most 3 ** len(RULES) of them, so the driver sees a bounded table whatever the corpus. On it,
expectation-maximisation alternates between the probability that documents of a pattern are good and each rule's
rates of right votes on good and on bad documents. The posterior of a document's pattern is its quality.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditloom.llm import arrays
from creditloom.llm.common import keyed, named, numbered, restored, staged

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
UPPER = np.zeros(256, bool)
UPPER[0x41:0x5B] = True
LETTER = UPPER.copy()
LETTER[0x61:0x7B] = True
ENDING = np.zeros(256, bool)
ENDING[list(b".?!:;\"')")] = True
#: What a plain word is made of: letters, digits, apostrophe, hyphen, characters beyond ASCII; and what may follow it.
PLAIN = LETTER.copy()
PLAIN[list(b"0123456789'-")] = True
PLAIN[0x80:] = True
POINT = np.zeros(256, bool)
POINT[list(b".,;:?!")] = True

TRAITS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_ended_lines", "n_upper",
    "n_letters", "n_distinct", "n_shouted", "n_plain",
)


def traits(texts: pa.Array) -> list[np.ndarray]:
    """The traits of each text, in the order of TRAITS.

    Lines count if they hold a word. A shouted word ends in two exclamation or question marks; a plain one has no
    special characters but one stop at its end.
    """
    data, offsets = arrays.text_bytes(texts)
    count = len(offsets) - 1
    starts, ends, first = arrays.words(data, offsets)
    n_words = np.diff(first)
    text = np.repeat(np.arange(count), n_words)

    def per_text(mask: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(mask)))
        return total[offsets[1:]] - total[offsets[:-1]]

    def distinct(values: np.ndarray, owner: np.ndarray) -> np.ndarray:
        return np.diff(arrays.distinct_per_text(values, owner, count)[1])

    solid = ~arrays.SPACE[data]
    points = (data & 0xC0) != 0x80
    line_starts, line_ends, first_line = arrays.runs(data != 0x0A, offsets)
    at = np.concatenate(([0], np.cumsum(solid)))
    real = at[line_ends] > at[line_starts]
    line_text = np.repeat(np.arange(count), np.diff(first_line))[real]
    line_starts, line_ends = line_starts[real], line_ends[real]
    lines = arrays.span_hashes(data, line_starts, line_ends)
    n_lines = np.bincount(line_text, minlength=count)
    tail = np.flatnonzero(solid)[at[line_ends] - 1] if len(line_ends) else line_ends
    ended = np.bincount(line_text[ENDING[data[tail]]], minlength=count)

    hashes = arrays.span_hashes(data, starts, ends)
    grams = arrays.gram_starts(first, 3)
    values = arrays.gram_hashes(hashes, grams, grams + 3)
    order = np.lexsort((values, text[grams]))
    same = np.zeros(len(order) + 1, bool)
    if len(order) > 1:
        a, b = order[1:], order[:-1]
        same[1:-1] = (values[a] == values[b]) & (text[grams[a]] == text[grams[b]])
    again = grams[order[same[1:] | same[:-1]]]
    repeated = np.zeros(len(hashes), bool)
    for k in range(3):
        repeated[again + k] = True
    last, before = data[ends - 1], data[np.maximum(ends - 2, 0)]
    plain = np.concatenate(([0], np.cumsum(PLAIN[data])))
    special = (ends - starts) - (plain[ends] - plain[starts])
    clean = (special == 0) | ((special == 1) & POINT[last] & (ends - starts > 1))
    mark = np.isin(last, [0x21, 0x3F]) & np.isin(before, [0x21, 0x3F]) & (ends - starts > 2)
    return [
        n_words,
        per_text(solid & points),
        per_text(SYMBOLS[data]),
        n_lines - distinct(lines, line_text),
        np.bincount(text[repeated], minlength=count),
        n_lines,
        ended,
        per_text(UPPER[data]),
        per_text(LETTER[data]),
        distinct(hashes, text),
        np.bincount(text[mark], minlength=count),
        np.bincount(text[clean], minlength=count),
    ]


def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in arrays.text_slices(batches, "_text"):
        columns = [pa.array(x.astype(np.int64)) for x in traits(batch.column("_text"))]
        yield pa.RecordBatch.from_arrays([batch.column("_id"), batch.column("_copy"), *columns], names=["_id", "_copy", *TRAITS])


@dataclass(frozen=True)
class Rule:
    """Votes bad above (or below) one bound of a trait and good beyond the other; between them, or unless `applies`, it abstains.

    A rule without a `good` bound is an alarm: it votes bad or abstains.
    """

    name: str
    value: Callable[[], Column]
    good: Callable[[Column], Column] | None
    bad: Callable[[Column], Column]
    applies: Callable[[], Column] = lambda: F.lit(True)

    def vote(self) -> Column:
        value = self.value()
        good = self.good(value) if self.good else F.lit(False)
        silent = 0 if self.good else 1
        return F.when(~self.applies() | value.isNull(), 0).when(self.bad(value), -1).when(good, 1).otherwise(silent)


def share(part: str, whole: str) -> Callable[[], Column]:
    return lambda: F.try_divide(F.col(part), F.col(whole))


#: That a text doesn't shout or repeat itself says little for it, so most rules are alarms.
RULES = (
    Rule("symbols", share("n_symbols", "n_words"), lambda x: x < 0.05, lambda x: x > 0.3),
    Rule("plain_words", share("n_plain", "n_words"), lambda x: x > 0.9, lambda x: x < 0.7),
    Rule("ended_lines", share("n_ended_lines", "n_lines"), lambda x: x > 0.8, lambda x: x < 0.2),
    Rule("repeated_words", share("n_repeat_words", "n_words"), None, lambda x: x > 0.3),
    Rule("capitals", share("n_upper", "n_letters"), None, lambda x: x > 0.5, lambda: F.col("n_letters") >= 20),
    Rule("repeated_lines", share("n_dup_lines", "n_lines"), None, lambda x: x > 0.3, lambda: F.col("n_lines") >= 4),
    Rule("vocabulary", share("n_distinct", "n_words"), None, lambda x: x < 0.15, lambda: F.col("n_words") <= 2000),
    Rule("shouting", share("n_shouted", "n_words"), None, lambda x: x > 0.2),
    Rule("word_length", share("word_chars", "n_words"), None, lambda x: (x < 2.5) | (x > 14)),
)


@dataclass(frozen=True)
class VoteModel:
    """Share of good documents, and each rule's rates of right votes on good and on bad ones. An abstention says nothing."""

    prior: float
    on_good: tuple[float, ...]
    on_bad: tuple[float, ...]

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        good, bad, votes = np.array(self.on_good), np.array(self.on_bad), votes
        odds = np.where(votes > 0, np.log(good) - np.log1p(-bad), np.where(votes < 0, np.log1p(-good) - np.log(bad), 0.0))
        return 1 / (1 + np.exp(-(math.log(self.prior) - math.log1p(-self.prior) + odds.sum(axis=1))))


def fit_votes(
    votes: np.ndarray, counts: np.ndarray, alarms: tuple[bool, ...] | None = None, belief: float = 0.9, weight: float = 0.02, rounds: int = 200
) -> VoteModel:
    """Expectation-maximisation over patterns of votes and how many documents have each.

    It starts from rules that are right with probability `belief`, and alarms that ring on a third of the bad documents and hardly on
    good ones. Each rate keeps a prior of `weight` of the documents around its start. A rule may turn out to say nothing of good or of bad documents, but not to be wrong more often than right:
    its two rates add up to more than 1. Without documents the start is the result.
    """
    total = counts.sum()
    alarms = alarms or (False,) * votes.shape[1]
    starts = [np.where(alarms, ring, belief) for ring in (0.98, 0.3)]
    model = VoteModel(belief, *(tuple(x.tolist()) for x in starts))
    if not total:
        return model
    prior = max(1.0, weight * total)
    for _ in range(rounds):
        good = model.posterior(votes)
        rates = []
        for mass, right, start in ((good * counts, votes > 0, starts[0]), ((1 - good) * counts, votes < 0, starts[1])):
            hits, cast = (right * mass[:, None]).sum(axis=0), ((votes != 0) * mass[:, None]).sum(axis=0)
            rates.append(np.clip((hits + prior * start) / (cast + prior), 0.001, 0.999))
        rates[1] = np.clip(rates[1], 1.001 - rates[0], 0.999)
        share_good = float(np.clip((good * counts).sum() / total, 0.01, 0.99))
        now = VoteModel(share_good, *(tuple(x.tolist()) for x in rates))
        moved = max(abs(now.prior - model.prior), *(abs(a - b) for a, b in zip(now.on_good + now.on_bad, model.on_good + model.on_bad, strict=True)))
        model = now
        if moved < 1e-9:
            break
    return model


def judge(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", least: float = 0.5, min_words: int = 50, most_repeated: int = 50) -> DataFrame:
    """Per row: `_id`, `_copy`, its traits, `base_failed`, the rules' votes, `quality` (0 to 1) and `kept`.

    A text with fewer than `min_words` words, or with more than `most_repeated` percent of its words in repeated 3-word windows, fails the
    base rules. Others are kept if the posterior probability of being good is `least` or more. The rates are
    estimated over the documents that pass the base rules. A null text has no words. Rows that repeat are judged each; other
    columns are not read. An empty table gives no rows.
    """
    measured = keyed(docs, text, doc_id).mapInArrow(measure, f"_id long, _copy long, {', '.join(f'{t} long' for t in TRAITS)}")
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > most_repeated * F.col("n_words"))
    votes = F.array(*[rule.vote().cast("int") for rule in RULES])
    judged = staged(measured.select("*", failed.alias("base_failed"), votes.alias("votes")))
    patterns = judged.where("NOT base_failed").groupBy("votes").agg(F.count("_copy").alias("n")).orderBy("votes").collect()
    table = np.array([p.votes for p in patterns], int).reshape(-1, len(RULES))
    model = fit_votes(table, np.array([p.n for p in patterns], float), tuple(rule.good is None for rule in RULES))
    # At most 3 ** len(RULES) rows, whatever the corpus.
    rows = [(p.votes, float(q)) for p, q in zip(patterns, model.posterior(table), strict=True)]
    schema = T.StructType([T.StructField("votes", T.ArrayType(T.IntegerType())), T.StructField("quality", T.DoubleType())])
    scores = docs.sparkSession.createDataFrame(rows, schema)
    scored = judged.join(F.broadcast(scores), "votes", "left")
    quality = F.when(F.col("base_failed"), 0.0).otherwise(F.col("quality"))
    return scored.withColumn("quality", quality).withColumn("kept", ~F.col("base_failed") & (quality >= least))


def quality_report(docs: DataFrame) -> DataFrame:
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return judge(docs).select(restored("_id").alias("doc_id"), *counts, "base_failed", "kept", "quality")


def keep_good(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The rows of `docs` that are kept; see judge."""
    kept = judge(docs, text, doc_id).where("kept").select("_id", "_copy").distinct()
    rows, _, _ = numbered(docs, text, doc_id)
    return named(rows.join(kept, ["_id", "_copy"], "left_semi"), docs)
