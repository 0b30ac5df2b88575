"""Near-duplicate documents by bottom-k sketches from one hash function.

1. A document's set is the hashes of its distinct word shingles; its sketch is the smallest `SKETCH` of them, of which `INDEXED` are
   stored for step 2. Documents of equal sets are one class, and only the class with its smallest id goes on.
2. Inverted lists of the smallest `INDEXED` values. Two sets of similarity 0.8 share some 26 of 32 of them and fewer than 13
   about once in ten million pairs, so it is enough to list each class under its rarest 32 - 13 + 1 values: whoever
   shares 13 values shares one of these. Sets of fewer than 76 values share more than 13 for certain, up to all that are looked up, and
   are listed under fewer (`least_shared`). What many documents hold (a passage, a banner) is seldom among the rarest,
   and a class with too few values that others hold leaves at once.
3. Lists tie classes into homes (connected components of the lists). Sets are computed again for classes in a home of two or more
   (a bitmap of them tells most other texts apart before the shuffle) and meet there, in blocks of at most `BLOCK` classes. Within a block all pairs on a common list are estimated
   from the sketch of the union, and those left are verified on the full sets.
4. A home of several blocks gets a second round with other blocks, in which the parts of the first grow together.
5. What is still in several parts is divided more closely, on full sets. Two sets of similarity 0.8 share one of the first fifth of their values in
   any order, so classes are listed under these, with the values that are common in their home ordered last, and
   the lists that tie two parts make closer homes. Classes that share a template, but less than four fifths of their shingles, so part without a comparison.
6. In a last round all classes outside the largest part of a closer home meet every block of it. So all pairs that could join two
   parts are compared, and pairs inside a part, as of thousands of near copies, are not. A class is sent once for each block it meets,
   so these blocks grow with the root of the home, up to `WIDE` classes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditloom.llm import arrays
from creditloom.llm.common import NO_ID, keyed, known, named, numbered, restored, staged
from creditloom.llm.components import components

SKETCH = 64  # values kept of each set
INDEXED = 32  # of these, the values that are looked up
DEVIATIONS = 5.5  # how far below its mean a number of shared values may lie before a pair is given up
BLOCK = 256  # classes that meet in one task
WIDE = 8  # times as many at most, in the last round
BITS = 1 << 24  # of the bitmap of classes whose sets are computed again, at most
COMMON = 1 << 14  # values of a home that are known as common
CELLS = 1 << 22  # cells of a matrix of classes and values


def least_share(values: int, similarity: float) -> float:
    """The share of so many values of the union that sets of a similarity have in common but for the rarest accidents."""
    return similarity - DEVIATIONS * math.sqrt(similarity * (1 - similarity) / values)


def shingle_sets(texts: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, one after another; and where those of each text begin.

    Words are A-Z lower-cased. Fewer words than a shingle make one shingle; a text without words has none.
    """
    data, offsets = arrays.text_bytes(texts)
    data = arrays.LOWER[data]
    starts, ends, first = arrays.words(data, offsets)
    hashes = arrays.span_hashes(data, starts, ends)
    counts = np.diff(first)
    grams = arrays.gram_starts(first, words)
    short = np.flatnonzero((counts > 0) & (counts < words))
    begins = np.concatenate([grams, first[short]])
    stops = np.concatenate([grams + words, first[short + 1]])
    text = np.concatenate([np.repeat(np.arange(len(counts)), counts)[grams], short])
    return arrays.distinct_per_text(arrays.gram_hashes(hashes, begins, stops), text, len(counts))


def signatures(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrays.text_slices(batches, "_text"):
            values, bounds = shingle_sets(batch.column("_text"), words)
            sizes = np.diff(bounds)
            other = np.concatenate(([0], np.cumsum(arrays.mix(values ^ arrays.GRAM_BASE))))
            plain = np.concatenate(([0], np.cumsum(arrays.mix(values))))
            kept = np.minimum(sizes, INDEXED)
            offsets = np.concatenate(([0], np.cumsum(kept)))
            sketch = values[np.repeat(bounds[:-1] - offsets[:-1], kept) + np.arange(offsets[-1])].view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_id"),
                    pa.array(sizes, pa.int64()),
                    pa.array((plain[bounds[1:]] - plain[bounds[:-1]]).view(np.int64)),
                    pa.array((other[bounds[1:]] - other[bounds[:-1]]).view(np.int64)),
                    pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(sketch)),
                ],
                names=["_id", "n", "h1", "h2", "sketch"],
            )

    return run


def least_shared(n: F.Column, percent: int) -> F.Column:
    """How many of the smallest `INDEXED` values a set of `n` values has in common with any other set of the similarity.

    Of sets that share all but d values of the larger one, the k-th shared value is the (k + d)-th of either at most. So they have all shared
    values in common, or `INDEXED` - d of them; for small sets that is more than what is left but for the rarest accidents.
    """
    accident = max(1, math.floor(INDEXED * least_share(INDEXED, percent / 100)))
    all_shared = F.ceil(n * percent / 100)
    largest = F.floor(n * 100 / max(1, percent))
    certain = F.least(all_shared, INDEXED - F.floor(largest * (100 - percent) / 100))
    return F.greatest(F.least(F.lit(accident), all_shared), certain).cast("int")


def indexed(classes: DataFrame, percent: int) -> DataFrame:
    """`value` and `rep`: each class under its rarest values that other classes hold too."""
    postings = classes.select("rep", "n", F.explode("sketch").alias("value"))
    held = staged(postings.groupBy("value").agg(F.count("rep").alias("held")).where("held > 1"), compact=True)
    by_class = (
        postings.join(held, "value")
        .groupBy("rep")
        .agg(F.first("n").alias("n"), F.array_sort(F.collect_list(F.struct("held", "value"))).alias("found"))
    )
    needed = least_shared(F.col("n"), percent)
    rarest = F.slice("found", 1, F.size("found") - needed + 1)
    values = by_class.where(F.size("found") >= needed).select("rep", F.explode(rarest).alias("x"))
    return staged(values.select("rep", F.col("x.value").alias("value")), compact=True)


def estimates(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Share of the union's smallest values that both sketches hold, for pairs of sketches.

    Sketches are rows padded with the largest value; it is not counted.
    """
    both = np.sort(np.concatenate([one, two], axis=1), axis=1)
    pad = np.iinfo(np.uint64).max
    new = np.ones(both.shape, bool)
    new[:, 1:] = both[:, 1:] != both[:, :-1]
    new &= both != pad
    rank = np.cumsum(new, axis=1)
    again = np.zeros(both.shape, bool)
    again[:, 1:] = both[:, 1:] == both[:, :-1]
    again &= (both != pad) & (rank <= SKETCH)
    return again.sum(axis=1) / np.maximum(np.minimum(rank[:, -1], SKETCH), 1)


def overlaps(left: list[np.ndarray], right: list[np.ndarray] | None = None) -> np.ndarray:
    """Sizes of the intersections of each left with each right set (or left set), as products of 0/1 matrices."""
    every = [*left, *(right or ())]
    values, codes, counts = np.unique(np.concatenate(every), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(every)), [len(x) for x in every])
    shared = counts > 1
    sizes = np.diag([len(x) for x in left]) if right is None else 0
    code = np.where(shared, np.cumsum(shared) - 1, -1)[codes]
    owner, code = owner[code >= 0], code[code >= 0]
    order = np.argsort(code, kind="stable")
    owner, code = owner[order], code[order]
    rows, cols = slice(0, len(left)), slice(0 if right is None else len(left), len(every))
    out = np.zeros((len(left), len(every) - cols.start), np.float32)
    width = max(1, min(CELLS // len(every), int(shared.sum())))
    for low in range(0, int(shared.sum()), width):
        a, b = np.searchsorted(code, [low, low + width])
        cells = np.zeros((len(every), width), np.float32)
        cells[owner[a:b], code[a:b] - low] = 1
        out += cells[rows] @ cells[cols].T
    return np.maximum(out.astype(np.int64), sizes)


def compare(left: pd.DataFrame, right: pd.DataFrame | None, percent: int) -> pd.DataFrame:
    """Links `a`, `b` that hold the classes of a block together as all their links do; of two blocks, the parts they are in."""
    none = pd.DataFrame({"a": np.zeros(0, np.int64), "b": np.zeros(0, np.int64)})
    same = right is None
    if not len(left) or not (same or len(right)):
        return none
    unpack = lambda column: [np.frombuffer(x, np.uint64) for x in column]
    if same:
        lists = np.triu(overlaps(unpack(left["lists"])) > 0, 1)
        right = left
    else:
        lists = overlaps(unpack(left["lists"]), unpack(right["lists"])) > 0
        lists &= left["part"].to_numpy()[:, None] != right["part"].to_numpy()[None, :]
    i, j = np.nonzero(lists)
    n, m = left["n"].to_numpy(), right["n"].to_numpy()
    near = 100 * np.minimum(n[i], m[j]) >= percent * np.maximum(n[i], m[j])
    i, j = i[near], j[near]
    if not len(i):
        return none
    sets = unpack(left["values"]), unpack(right["values"])
    sketches = []
    for side in sets:
        table = np.full((len(side), SKETCH), np.iinfo(np.uint64).max, np.uint64)
        for row, x in zip(table, side, strict=True):
            row[: min(SKETCH, len(x))] = x[:SKETCH]
        sketches.append(table)
    likely = np.concatenate(
        [
            estimates(sketches[0][i[k : k + 8192]], sketches[1][j[k : k + 8192]]) >= least_share(SKETCH, percent / 100)
            for k in range(0, len(i), 8192)
        ]
    )
    i, j = i[likely], j[likely]
    if not len(i):
        return none
    if same:
        rows = cols = np.union1d(i, j)
        common = overlaps([sets[0][x] for x in rows])
    else:
        rows, cols = np.unique(i), np.unique(j)
        common = overlaps([sets[0][x] for x in rows], [sets[1][x] for x in cols])
    shared = common[np.searchsorted(rows, i), np.searchsorted(cols, j)]
    linked = 100 * shared >= percent * (n[i] + m[j] - shared)
    name = "rep" if same else "part"
    return joining(left[name].to_numpy()[i[linked]], right[name].to_numpy()[j[linked]])


def joining(a: np.ndarray, b: np.ndarray) -> pd.DataFrame:
    """Of the links, those that join two parts when taken in turn; each class is tied to its part's first one."""
    top: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := top.setdefault(x, x)) != x:
            top[x] = x = top.setdefault(up, up)
        return x

    kept = []
    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        one, two = find(x), find(y)
        if one != two:
            top[max(one, two)] = min(one, two)
            kept.append((x, y))
    return pd.DataFrame(kept, columns=["a", "b"]).astype("int64")


def within_block(percent: int):
    return lambda rows: compare(rows.sort_values("rep", ignore_index=True), None, percent)


def across_blocks(percent: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("rep", ignore_index=True)
        outside, every = (rows[x].reset_index(drop=True) for x in (rows["outside"], ~rows["outside"]))
        # A few at a time, so that the pairs of a wide block needn't all be held.
        parts = [outside[k : k + BLOCK].reset_index(drop=True) for k in range(0, max(1, len(outside)), BLOCK)]
        return pd.concat([compare(x, every, percent) for x in parts], ignore_index=True)

    return run


def full_sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrays.text_slices(batches, "_text"):
            values, bounds = shingle_sets(batch.column("_text"), words)
            packed = [values[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            lists = [np.asarray(x.values).tobytes() for x in batch.column("lists")]
            kept = [batch.column(c) for c in ("_id", "home", "size")]
            found = [pa.array(np.diff(bounds)), pa.array(lists, pa.binary()), pa.array(packed, pa.binary())]
            yield pa.RecordBatch.from_arrays([*kept, *found], names=["rep", "home", "size", "n", "lists", "values"])

    return run


def perhaps_among(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows whose `_id` is a `rep` of `ids`, and few others: a bitmap by hash tells, so the other texts needn't be shuffled."""
    bits = min(BITS, 8 << ids.count().bit_length())
    place = lambda column: F.pmod(F.xxhash64(column), F.lit(bits))
    word, bit = (lambda x: F.shiftright(x, 6)), (lambda x: x.bitwiseAND(63).cast("int"))
    words = ids.select(place("rep").alias("at")).groupBy(word(F.col("at")).alias("_word")).agg(F.bit_or(F.expr("shiftleft(1L, int(at & 63))")).alias("_bits"))
    found = rows.withColumn("_word", word(place("_id"))).join(F.broadcast(words), "_word")
    return found.where(F.getbit("_bits", bit(place("_id"))) == 1).drop("_word", "_bits")


def salt(column: str, seed: int, count) -> F.Column:
    return F.pmod(F.xxhash64(F.col(column), F.lit(seed)), count)


def common_values(rows: pd.DataFrame) -> pd.DataFrame:
    """The values that several classes of a sample hold, the most common last."""
    values, counts = np.unique(np.concatenate([np.frombuffer(x, np.uint64) for x in rows["values"]]), return_counts=True)
    order = np.lexsort((values, counts))
    order = order[counts[order] > 2][-COMMON:]
    return pd.DataFrame({"home": rows["home"].iloc[:1], "all": rows["all"].iloc[:1], "common": [values[order].tobytes()]})


def prefixes(percent: int):
    """The first values of each class, one of which it shares with every class of the similarity."""

    def run(rows: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        common = np.frombuffer(known["common"].iloc[0], np.uint64) if len(known) else np.zeros(0, np.uint64)
        order = np.argsort(common)
        ordered, found = common[order], []
        for packed in rows["values"]:
            values = np.frombuffer(packed, np.uint64)
            rank = np.zeros(len(values), np.int64)
            if len(common):
                at = np.minimum(np.searchsorted(ordered, values), len(common) - 1)
                rank = np.where(ordered[at] == values, order[at] + 1, 0)
            needed = -(-percent * len(values) // 100)
            found.append(values[np.lexsort((values, rank))[: len(values) - needed + 1]].view(np.int64))
        counts = [len(x) for x in found]
        columns = {c: np.repeat(rows[c].to_numpy(np.int64), counts) for c in ("home", "rep", "part")}
        return pd.DataFrame({**columns, "value": np.concatenate([np.zeros(0, np.int64), *found])})

    return run


def closer_homes(apart: DataFrame, percent: int) -> DataFrame:
    """`rep` and `home` of the classes that could be linked with one of another part: components of the lists of their first values.

    Any order of values gives the same links; common ones are last so that few are listed under them. A sample of one block tells them.
    """
    blocks = F.ceil(F.col("all") / BLOCK)
    sample = apart.select("home", "rep", "all", "values").where(salt("rep", 6, blocks) == 0).drop("rep")
    common = staged(sample.groupBy("home").applyInPandas(common_values, "home long, all long, common binary"))
    common = common.select("home", "common", F.explode(F.sequence(F.lit(0).cast("bigint"), blocks - 1)).alias("block")).groupBy("home", "block")
    classes = apart.select("home", "rep", "part", "values", salt("rep", 5, blocks).alias("block")).groupBy("home", "block")
    postings = staged(classes.cogroup(common).applyInPandas(prefixes(percent), "home long, rep long, part long, value long"))
    lists = postings.groupBy("home", "value").agg(F.min("part").alias("low"), F.max("part").alias("high"), F.min("rep").alias("leader"))
    lists = staged(lists.where("low < high").select("home", "value", "leader"), compact=True)
    homes = components(postings.join(lists, ["home", "value"]).select(F.col("rep").alias("a"), F.col("leader").alias("b")))
    return homes.union(homes.select("component", "component").distinct()).toDF("rep", "home")


def class_components(rows: DataFrame, classes: DataFrame, words: int, percent: int) -> DataFrame:
    """`rep` and `component` of the classes that are linked with others, but perhaps not of the smallest of a component."""
    lists = indexed(classes, percent)
    leaders = lists.groupBy("value").agg(F.min("rep").alias("leader"), F.count("rep").alias("size")).where("size > 1")
    listed = staged(lists.join(staged(leaders, compact=True), "value"), compact=True)
    homes = components(listed.select(F.col("rep").alias("a"), F.col("leader").alias("b")))
    homes = homes.union(homes.select("component", "component").distinct()).toDF("rep", "home")
    sizes = staged(homes.groupBy("home").agg(F.count("rep").alias("size")), compact=True)
    held = listed.groupBy("rep").agg(F.collect_list("value").alias("lists"))
    wanted = staged(homes.join(sizes, "home").join(held, "rep"))
    packed = "rep long, home long, size long, n long, lists binary, values binary"
    texts = perhaps_among(rows, wanted).join(wanted.withColumnRenamed("rep", "_id"), "_id").dropDuplicates(["_id"])
    sets = staged(texts.select("_id", "home", "size", "lists", "_text").mapInArrow(full_sets(words), packed))
    blocks = F.ceil(F.col("size") / BLOCK)

    def inside(table: DataFrame, seed: int) -> DataFrame:
        grouped = table.withColumn("block", salt("rep", seed, blocks)).groupBy("home", "block")
        return staged(grouped.applyInPandas(within_block(percent), "a long, b long"))

    large = sets.where(F.col("size") > BLOCK)
    found = components(inside(sets, 1).union(inside(large, 2))).toDF("rep", "part")
    # In a home of one block all pairs have been compared; in the others, those that would join two parts are left.
    placed = large.join(found, "rep", "left").withColumn("part", F.coalesce("part", "rep"))
    several = placed.groupBy("home").agg(F.min("part").alias("low"), F.max("part").alias("high"), F.count("rep").alias("all")).where("low < high")
    apart = placed.join(staged(several.select("home", "all"), compact=True), "home")
    placed = apart.drop("home", "all").join(staged(closer_homes(apart, percent)), "rep")
    members = staged(placed.groupBy("home", "part").agg(F.count("rep").alias("members")), compact=True)
    totals = members.groupBy("home").agg(
        F.max_by("part", F.struct("members", "part")).alias("main"), F.sum("members").alias("all"), F.max("members").alias("most")
    )
    plan = staged(totals.withColumn("others", F.col("all") - F.col("most")).where("others > 0"), compact=True)
    columns = ["home", "rep", "n", "lists", "values", "part"]
    split = placed.join(plan, "home")
    wide = F.least(F.lit(BLOCK * WIDE), F.greatest(F.lit(BLOCK), F.ceil(F.sqrt(F.col("all") * BLOCK) / 2)))
    n_all, n_others = F.ceil(F.col("all") / wide), F.ceil(F.col("others") / wide)
    zero = F.lit(0).cast("bigint")
    every = split.select(*columns, salt("rep", 3, n_all).alias("block"), F.explode(F.sequence(zero, n_others - 1)).alias("with"), F.lit(False).alias("outside"))
    outside = split.where("part <> main").select(*columns, F.explode(F.sequence(zero, n_all - 1)).alias("block"), salt("rep", 4, n_others).alias("with"), F.lit(True).alias("outside"))
    met = every.union(outside).groupBy("home", "block", "with").applyInPandas(across_blocks(percent), "a long, b long")
    joined = components(met).toDF("part", "whole")
    return found.join(joined, "part", "left").select("rep", F.coalesce("whole", "part").alias("component")).union(joined.toDF("rep", "component"))


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", words: int = 5, percent: int = 80) -> DataFrame:
    """Per row: `doc_id`, `n_shingles`, `component_id` (the smallest id reachable over links) and `kept`.

    Two documents are linked if 100 * |intersection| >= percent * |union| of their sets of `words`-word shingles. A document
    without words has an empty set and is linked with nothing. A null id takes part in no link, its component is null
    and it is kept. Rows that repeat an id are one document; should their texts differ, the links of one of them
    are found for sure. Other columns are not read. An empty table gives no rows.
    """
    rows = keyed(docs, text, doc_id).drop("_copy")
    signed = staged(rows.mapInArrow(signatures(words), "_id long, n long, h1 long, h2 long, sketch array<long>"))
    usable = signed.where((F.col("n") > 0) & (F.col("_id") != NO_ID))
    class_ids = staged(usable.groupBy("h1", "h2").agg(F.min("_id").alias("rep")), compact=True)
    classes = usable.join(class_ids, ["h1", "h2"]).where("_id = rep").select("rep", "n", "sketch").dropDuplicates(["rep"])
    found = class_components(rows, staged(classes), words, percent).groupBy("rep").agg(F.min("component").alias("component"))
    of_class = staged(class_ids.join(found, "rep", "left").select("h1", "h2", F.coalesce("component", "rep").alias("component")), compact=True)
    shown = signed.drop("sketch").join(of_class, ["h1", "h2"], "left")
    linked = F.when((F.col("n") > 0) & (F.col("_id") != NO_ID), F.col("component")).otherwise(restored("_id"))
    return shown.select(
        restored("_id").alias("doc_id"),
        F.col("n").alias("n_shingles"),
        linked.alias("component_id"),
        F.coalesce(linked == F.col("_id"), F.lit(True)).alias("kept"),
    )


def drop_near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of `docs` that are kept: of each component the document with the smallest id. See near_duplicates."""
    kept = near_duplicates(docs, text, doc_id, words, percent).where("kept")
    kept = kept.select(known("doc_id").alias("_id")).distinct()
    rows, _, _ = numbered(docs, text, doc_id)
    return named(rows.join(kept, "_id", "left_semi"), docs)
