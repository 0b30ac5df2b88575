"""Repair of conversations at least cost: an edit sequence that makes roles alternate, by a checkpointed dynamic program.

A conversation in order is edited row by row: Keep, Rerole to user or assistant, Delete, and Insert an empty turn anywhere, so that the
role initials become `(s?(ua)+)?`. Walking backward, a vector holds the least cost from a row on for each of four states (nothing yet, after a
system turn, after a user's, after an assistant's). Vectors are kept at checkpoints only, a square root of the rows apart; the walk
forward recomputes the rows between two checkpoints and takes, of the edits that are tight, the one with the least initial.

Rows are sorted over the cluster by conversation and order, and cut into blocks of one conversation. Most conversations are one block, repaired where it
is cut. A conversation that spans blocks or tasks has a transfer matrix (least cost from state to state) for each block. Their products, a
fan of blocks at a time, give the vectors at all block ends; with these each block tells which state it leaves for each it is entered
in, and products of these maps give the states at all block starts. So no task ever holds more than one block of rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditloom.llm.common import NO_ID, importable, known, restored, staged

BLOCK_ROWS = 4096
BLOCK_CHARS = 1 << 20
FAN = 256

NOTHING, SYSTEM, USER, ASSISTANT = range(4)
STATES = 4
DELETE, INSERT, REROLE, CUT_OFF = 4, 3, 3, 3  # costs; the last is that of a truncated row that stays
NEVER = 1 << 60
#: What is left to pay after the last row: turns inserted until an assistant's is the last one.
LAST = (0, 2 * INSERT, INSERT, 0)
LEGAL = {"su", "ua", "au"}

#: White space of the texts.
BLANK = r"\x20\x09-\x0D"


def damaged(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Conversations with planted faults: `conv_id`, `turn`, `role`, `text` and `times`, how often the row stands there.

    The CRC-32 of `conv_id:turn` modulo 20 says what happens: 0 the row goes (`times` 0, so that its conversation is still known), 1 its text is emptied, 2 loses
    its ends of sentences, 3 the row is repeated, 4 its role becomes user. A null reads as one space.
    """
    read = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (conv_id, turn, role, text)]
    fate = F.crc32(F.concat(read[0], F.lit(":"), read[1]).cast("binary")) % 20
    rows = conversations.select(F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"), read[2].alias("role"), read[3].alias("text"), fate.alias("fate"))
    gone = F.col("fate") == 0
    words = F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return rows.select(
        "conv_id",
        F.when(~gone, F.col("turn")).alias("turn"),
        F.when(gone, "").when(F.col("fate") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(gone, "").otherwise(words).alias("text"),
        F.when(gone, 0).when(F.col("fate") == 3, 2).otherwise(1).alias("times"),
    )


class Row:
    """Like rows of a conversation that follow each other: `free` says that the first of `times` may stay; all others go."""

    __slots__ = ("free", "late", "role", "text", "times")

    def __init__(self, role: str, text: str, times: int, free: bool, late: int):
        self.role, self.text, self.times, self.free, self.late = role, text, times, free, late


def before(row: Row, c: tuple) -> tuple:
    """Costs from a row on, by state, from those after it. They are closed: an insertion never makes them less."""
    gone = DELETE * (row.times - row.free)
    nothing, system, user, assistant = (x + gone for x in c)
    if not row.free:
        return nothing, system, user, assistant
    kind = row.role[:1]
    to_user = user + row.late + (0 if kind == "u" else REROLE)
    to_assistant = assistant + row.late + (0 if kind == "a" else REROLE)
    b0 = min(nothing + DELETE, to_user, system + row.late if kind == "s" else NEVER)
    b1 = min(system + DELETE, to_user)
    b2 = min(user + DELETE, to_assistant)
    b3 = min(assistant + DELETE, to_user)
    closed = min(b2, b3 + INSERT)
    return min(b0, closed + INSERT), min(b1, closed + INSERT), closed, min(b3, b2 + INSERT)


class Walk:
    """The edits of a block, from the state it is entered in and the costs after it."""

    def __init__(self, rows: list[Row], after: tuple):
        self.rows = rows
        self.step = max(1, isqrt(len(rows)))
        self.marks = {len(rows): after}
        c = after
        for k in range(len(rows) - 1, -1, -1):
            c = before(rows[k], c)
            if k % self.step == 0:
                self.marks[k] = c

    def stretch(self, k: int) -> list[tuple]:
        """Costs before the rows from checkpoint `k` to the next one, and after the last of them, recomputed."""
        stop = min(len(self.rows), k + self.step)
        out = [self.marks[stop]]
        for row in reversed(self.rows[k:stop]):
            out.append(before(row, out[-1]))
        return out[::-1]

    def run(self, state: int, emit=None) -> int:
        """The state after the block; `emit` takes each edit, the role it leaves, the row (None if inserted) and the cost."""
        emit = emit or (lambda *edit: None)
        for begin in range(0, len(self.rows), self.step):
            costs = self.stretch(begin)
            for k, (here, after) in enumerate(zip(costs, costs[1:], strict=False)):
                row = self.rows[begin + k]
                extra = row.times - row.free
                if row.free:
                    after = tuple(x + DELETE * extra for x in after)
                    state = self.choose(row, state, here, after, emit)
                for _ in range(extra):
                    emit("D", None, row, DELETE)
        return state

    @staticmethod
    def choose(row: Row, state: int, here: tuple, after: tuple, emit) -> int:
        kind = row.role[:1]
        while here[state] != after[state] + DELETE:
            following = ASSISTANT if state == USER else USER
            name = "assistant" if state == USER else "user"
            if here[state] == here[following] + INSERT:
                emit("I", name, None, INSERT)
                state = following
            elif kind == name[0] and here[state] == after[following] + row.late:
                emit("K", row.role, row, row.late)
                return following
            elif kind == "s" and state == NOTHING and here[state] == after[SYSTEM] + row.late:
                emit("K", row.role, row, row.late)
                return SYSTEM
            else:
                emit("R", name, row, REROLE + row.late)
                return following
        emit("D", None, row, DELETE)
        return state


def finish(state: int, emit) -> None:
    while state in (SYSTEM, USER):
        emit("I", "assistant" if state == USER else "user", None, INSERT)
        state = ASSISTANT if state == USER else USER


def transfer(rows: list[Row]) -> list[int]:
    """Least costs from each state before the rows to each state after them, one row of the matrix after another."""
    columns = []
    for state in range(STATES):
        c = tuple(0 if k == state else NEVER for k in range(STATES))
        for row in reversed(rows):
            c = before(row, c)
        columns.append([min(x, NEVER) for x in c])
    return [columns[j][i] for i in range(STATES) for j in range(STATES)]


class Block:
    """Rows of one conversation, and what can be said of them without their neighbours."""

    def __init__(self):
        self.rows: list[Row] = []
        self.chars = self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.initials: list[str] = []  # of the first and of the last row
        self.span: list[int] = []  # first and last turn

    def add(self, turn: int, role: str, text: str, times: int, blank: bool, truncated: bool, later: bool) -> None:
        if not times:
            return
        free = not blank and not later
        self.rows.append(Row(role, text, times, free, CUT_OFF if truncated else 0))
        self.chars += len(role) + len(text)
        self.blank += times if blank else 0
        self.duplicate += 0 if blank else times - free
        self.truncated += free and truncated
        kind = role[:1]
        self.illegal += times - 1 + bool(self.initials and self.initials[1] + kind not in LEGAL)
        self.initials = [self.initials[0] if self.initials else kind, kind]
        if turn != NO_ID:
            self.turns += not self.span or self.span[1] != turn
            self.span = [self.span[0] if self.span else turn, turn]

    def full(self) -> bool:
        return len(self.rows) >= BLOCK_ROWS or self.chars >= BLOCK_CHARS


class Piece:
    """What the edits of a block leave."""

    def __init__(self):
        self.audit: list[str] = []
        self.repaired: list[tuple[str, str]] = []
        self.cost = 0

    def __call__(self, edit: str, role: str | None, row: Row | None, cost: int) -> None:
        self.audit.append(edit)
        self.cost += cost
        if role is not None:
            self.repaired.append((role, row.text if row else ""))

    def lines(self) -> bytes:
        return "\n".join(f"{role}:{text}" for role, text in self.repaired).encode()


TURNS = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
ROWS = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string()), ("times", pa.int64()), ("free", pa.bool_()), ("late", pa.int64())]))
COUNTS = {c: pa.int64() for c in ("blank", "duplicate", "truncated", "illegal", "turns")}
EDGES = {"initials": pa.list_(pa.string()), "span": pa.list_(pa.int64())}
MADE = {"audit": pa.string(), "cost": pa.int64(), "repaired": TURNS}
CUT = {"_id": pa.int64(), "shard": pa.int64(), "block": pa.int64(), "whole": pa.bool_(), **COUNTS, **EDGES, **MADE, "rows": ROWS, "matrix": pa.list_(pa.int64())}
PIECE = {"_id": pa.int64(), "pos": pa.int64(), **COUNTS, **EDGES, **MADE}
REPORT = {"_id": pa.int64(), "gaps": pa.int64(), **{c: COUNTS[c] for c in ("blank", "duplicate", "truncated", "illegal")}, "cost": pa.int64(), "audit": pa.string(), "repaired_sha256": pa.string()}

SQL_NAMES = {pa.int64(): "long", pa.string(): "string", pa.bool_(): "boolean"}


def sql_type(kind: pa.DataType) -> str:
    if pa.types.is_list(kind):
        return f"array<{sql_type(kind.value_type)}>"
    if pa.types.is_struct(kind):
        return f"struct<{', '.join(f'{kind.field(k).name}: {sql_type(kind.field(k).type)}' for k in range(kind.num_fields))}>"
    return SQL_NAMES[kind]


def schema(types: dict) -> str:
    return ", ".join(f"{c} {sql_type(t)}" for c, t in types.items())


def batch_of(rows: list[dict], types: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r.get(c) for r in rows], t) for c, t in types.items()], names=list(types))


def in_batches(rows: Iterator[dict], types: dict, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Rows of a task's output a few megabytes at a time."""
    held, size = [], 0
    for row, chars in rows:
        held.append(row)
        size += chars + 200
        if size >= most:
            yield batch_of(held, types)
            held, size = [], 0
    if held:
        yield batch_of(held, types)


def made(piece: Piece) -> dict:
    turns = [{"role": role, "text": text} for role, text in piece.repaired]
    return {"audit": "".join(piece.audit), "cost": piece.cost, "repaired": turns}


def described(block: Block) -> dict:
    return {c: getattr(block, c) for c in (*COUNTS, *EDGES)}


def cut_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows to blocks. A conversation that can't go on in another task and fits a block is repaired at once."""
    shard = TaskContext.get().partitionId()

    def blocks() -> Iterator[tuple[dict, int]]:
        conversation, number, block, first = None, 0, Block(), True

        def closed(last: bool) -> tuple[dict, int]:
            whole = last and not number and not first
            row = {"_id": conversation, "shard": shard, "block": number, "whole": whole, **described(block)}
            if whole:
                piece = Piece()
                finish(Walk(block.rows, LAST).run(NOTHING, piece), piece)
                row |= made(piece)
            else:
                row["rows"] = [{c: getattr(r, c) for c in ("role", "text", "times", "free", "late")} for r in block.rows]
                row["matrix"] = transfer(block.rows)
            return row, 2 * block.chars

        for batch in batches:
            for now, *row in zip(*(batch.column(c).to_pylist() for c in ("_id", "_turn", "role", "text", "times", "blank", "truncated", "later")), strict=True):
                if now != conversation:
                    if conversation is not None:
                        yield closed(last=True)
                        first = False
                    conversation, number, block = now, 0, Block()
                elif block.full():
                    yield closed(last=False)
                    number, block = number + 1, Block()
                block.add(*row)
        if conversation is not None:
            first = True  # it may go on in the next task
            yield closed(last=True)

    yield from in_batches(blocks(), CUT)


def rows_of(values: list[dict]) -> list[Row]:
    return [Row(r["role"], r["text"], r["times"], r["free"], r["late"]) for r in values]


def exits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The state after each block for every state before it."""

    def found() -> Iterator[tuple[dict, int]]:
        for batch in batches:
            for key, pos, rows, after in zip(*(batch.column(c) for c in ("_id", "pos", "rows", "after")), strict=True):
                walk = Walk(rows_of(rows.as_py()), tuple(after.as_py()))
                yield {"_id": key.as_py(), "pos": pos.as_py(), "value": [walk.run(s) for s in range(STATES)]}, 0

    yield from in_batches(found(), VALUE)


def repair_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [*COUNTS, *EDGES]

    def found() -> Iterator[tuple[dict, int]]:
        for batch in batches:
            for k in range(batch.num_rows):
                get = {c: batch.column(c)[k].as_py() for c in ("_id", "pos", "rows", "after", "state", "ends", *names)}
                piece = Piece()
                state = Walk(rows_of(get["rows"]), tuple(get["after"])).run(get["state"], piece)
                if get["ends"]:
                    finish(state, piece)
                row = {c: get[c] for c in ("_id", "pos", *names)} | made(piece)
                yield row, sum(len(a) + len(b) for a, b in piece.repaired) + len(piece.audit)

    yield from in_batches(found(), PIECE)


VALUE = {"_id": pa.int64(), "pos": pa.int64(), "value": pa.list_(pa.int64())}


def costs_product(first: list[int], second: list[int]) -> list[int]:
    a, b = np.array(first).reshape(STATES, STATES), np.array(second).reshape(STATES, STATES)
    return np.minimum((a[:, :, None] + b[None, :, :]).min(axis=1), NEVER).ravel().tolist()


def costs_before(matrix: list[int], after: list[int]) -> list[int]:
    return (np.array(matrix).reshape(STATES, STATES) + np.array(after)[None, :]).min(axis=1).tolist()


def maps_product(first: list[int], second: list[int]) -> list[int]:
    return [second[s] for s in first]


def _sorted(table: pa.Table) -> dict[str, list]:
    return table.sort_by("pos").to_pydict()


def folded(product):
    """The product of a fan of values, in order."""

    def run(table: pa.Table) -> pa.Table:
        rows = _sorted(table)
        total = rows["value"][0]
        for value in rows["value"][1:]:
            total = product(total, value)
        return pa.Table.from_batches([batch_of([{"_id": rows["_id"][0], "pos": rows["above"][0], "value": total}], VALUE)])

    return run


def spread_back(table: pa.Table) -> pa.Table:
    """The costs after each member of a fan, from those after the fan."""
    rows = _sorted(table)
    after, out = rows["given"][0], []
    for key, pos, matrix in reversed(list(zip(rows["_id"], rows["pos"], rows["value"], strict=True))):
        out.append({"_id": key, "pos": pos, "value": after})
        after = costs_before(matrix, after)
    return pa.Table.from_batches([batch_of(out, VALUE)])


def spread_forward(table: pa.Table) -> pa.Table:
    """The state before each member of a fan, from that before the fan."""
    rows = _sorted(table)
    state, out = rows["given"][0][0], []
    for key, pos, exit_of in zip(rows["_id"], rows["pos"], rows["value"], strict=True):
        out.append({"_id": key, "pos": pos, "value": [state]})
        state = exit_of[state]
    return pa.Table.from_batches([batch_of(out, VALUE)])


def scanned(values: DataFrame, top: int, product, spread, given: list[int]) -> DataFrame:
    """For each value what `spread` makes of all others of its conversation on one side: up and down a tree of fans.

    `top` is the largest `pos`; a task holds `FAN` values of a conversation at a time.
    """
    above = F.expr(f"pos div {FAN}").alias("above")
    levels = [values]
    while top:
        grouped = levels[-1].select("*", above).groupBy("_id", "above")
        levels.append(staged(grouped.applyInArrow(folded(product), schema(VALUE))))
        top //= FAN
    down = levels.pop().select("_id", "pos", F.lit(given).cast("array<long>").alias("value"))
    while levels:
        told = down.select("_id", F.col("pos").alias("above"), F.col("value").alias("given"))
        joined = levels.pop().select("*", above).join(told, ["_id", "above"])
        down = staged(joined.groupBy("_id", "above").applyInArrow(spread, schema(VALUE)))
    return down


def report_row(key: int, counts: dict, span: list[int], cost: int, audit: str, digest: str) -> dict:
    gaps = span[1] - span[0] + 1 - counts["turns"] if span else 0
    return {"_id": key, "gaps": gaps, **counts, "cost": cost, "audit": audit, "repaired_sha256": digest}


def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of conversations in order to one row each; texts pass through the digest and aren't held."""

    def found() -> Iterator[tuple[dict, int]]:
        key, counts, audit = None, {}, []
        for batch in batches:
            for k in range(batch.num_rows):
                get = {c: batch.column(c)[k].as_py() for c in PIECE}
                if get["_id"] != key:
                    if key is not None:
                        yield report_row(key, counts, span, cost, "".join(audit), digest.hexdigest()), len(audit)
                    key, counts, audit, digest, cost, span, last, begun = get["_id"], dict.fromkeys(COUNTS, 0), [], hashlib.sha256(), 0, [], None, False
                for c in COUNTS:
                    counts[c] += get[c]
                if get["initials"]:
                    counts["illegal"] += bool(last is not None and last + get["initials"][0] not in LEGAL)
                    last = get["initials"][1]
                if get["span"]:
                    counts["turns"] -= bool(span and span[1] == get["span"][0])
                    span = [span[0] if span else get["span"][0], get["span"][1]]
                cost += get["cost"]
                audit.append(get["audit"])
                for turn in get["repaired"]:
                    digest.update(f"{chr(10) if begun else ''}{turn['role']}:{turn['text']}".encode())
                    begun = True
        if key is not None:
            yield report_row(key, counts, span, cost, "".join(audit), digest.hexdigest()), len(audit)

    yield from in_batches(found(), REPORT)


def ordered_rows(conversations: DataFrame, conv_id: str, turn: str, role: str, text: str, times: str | None) -> DataFrame:
    """Rows in order over the cluster, like ones folded, with their faults."""
    read = {c: F.coalesce(F.col(name).cast("string"), F.lit(" ")).alias(c) for c, name in (("role", role), ("text", text))}
    often = F.lit(1) if times is None else F.col(times)
    rows = conversations.select(known(conv_id).alias("_id"), known(turn).alias("_turn"), *read.values(), often.cast("long").alias("times"))
    like = rows.groupBy("_id", "_turn", "role", "text").agg(F.sum("times").alias("times"))
    like = staged(like.withColumns({"blank": ~F.col("text").rlike(f"[^{BLANK}]"), "k1": F.xxhash64(F.lit(1), "role", "text"), "k2": F.xxhash64(F.lit(2), "role", "text")}))
    said = like.where(~F.col("blank")).groupBy("_id", "k1", "k2").agg(F.min("_turn").alias("earliest"), F.count("k1").alias("n"))
    # Written first, so that the join knows its size and moves the texts only where it is large.
    again = staged(said.where("n > 1").drop("n"))
    later = F.coalesce(F.col("_turn") > F.col("earliest"), F.lit(False))
    truncated = ~F.col("text").rlike(rf"[.!?][{BLANK}]*\z")
    judged = like.join(again, ["_id", "k1", "k2"], "left").select("_id", "_turn", "role", "text", "times", "blank", truncated.alias("truncated"), later.alias("later"))
    order = ("_id", "_turn", "role", "text")
    return judged.repartitionByRange(*order).sortWithinPartitions(*order)


def repaired_pieces(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", times: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Conversations repaired in one piece, and the pieces of all others by `pos`; both with what `repair_report` adds up."""
    importable(conversations.sparkSession)
    cut = staged(ordered_rows(conversations, conv_id, turn, role, text, times).mapInArrow(cut_blocks, schema(CUT)))
    split = cut.where(~F.col("whole"))
    most, last_shard = split.agg(F.max("block"), F.max("shard")).first()
    width = (most or 0) + 1
    split = split.withColumn("pos", F.col("shard") * width + F.col("block"))
    top = (last_shard or 0) * width + (most or 0)
    after = scanned(split.select("_id", "pos", F.col("matrix").alias("value")), top, costs_product, spread_back, list(LAST))
    known_after = split.join(after.withColumnRenamed("value", "after"), ["_id", "pos"])
    maps = staged(known_after.select("_id", "pos", "rows", "after").mapInArrow(exits, schema(VALUE)))
    entered = scanned(maps, top, maps_product, spread_forward, [NOTHING]).select("_id", "pos", F.col("value")[0].alias("state"))
    ends = split.groupBy("_id").agg(F.max("pos").alias("end"))
    told = known_after.join(entered, ["_id", "pos"]).join(ends, "_id").withColumn("ends", F.col("pos") == F.col("end"))
    pieces = staged(told.select("_id", "pos", "rows", "after", "state", "ends", *COUNTS, *EDGES).mapInArrow(repair_blocks, schema(PIECE)))
    return cut.where("whole"), pieces


def digest_of(turns: Column) -> Column:
    return F.sha2(F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "\n"), 256)


def repair_report(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", times: str | None = None) -> DataFrame:
    """Per conversation: `conv_id`, `gaps`, `blank`, `duplicate`, `truncated`, `illegal`, `cost`, `audit`, `repaired_sha256`.

    Rows stand in order of turn (nulls first), then of role and text, so that ties have one order and like rows follow each other. A null role or text reads as
    one space, a null conversation is one of its own. `times` is a column of how often a row stands there; a conversation whose rows all
    stand nowhere has zeros, an empty audit and the digest of nothing. Each row's first fault counts: blank, duplicate (role and text seen earlier, told apart
    by two 64-bit hashes), truncated. Blank and duplicate rows have to go. A role by which nothing begins is no legal one. Other columns are not read; an
    empty table gives no rows. A conversation of any size is repaired block by block; only its digest, its audit and the counts
    of its blocks pass through one task.
    """
    whole, pieces = repaired_pieces(conversations, conv_id, turn, role, text, times)
    gaps = F.when(F.size("span") > 0, F.col("span")[F.size("span") - 1] - F.col("span")[0] + 1 - F.col("turns")).otherwise(F.lit(0)).cast("long")
    names = [c for c in REPORT if c not in ("gaps", "repaired_sha256")]
    at_once = whole.withColumns({"gaps": gaps, "repaired_sha256": digest_of(F.col("repaired"))}).select(*REPORT)
    joined = pieces.repartition("_id").sortWithinPartitions("_id", "pos").mapInArrow(assemble, schema(REPORT))
    rows = at_once.unionByName(joined)
    return rows.select(restored("_id").alias("conv_id"), "gaps", *[c for c in names if c not in ("_id", "cost", "audit")], "cost", "audit", "repaired_sha256")


def repaired_turns(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", times: str | None = None) -> DataFrame:
    """The repaired conversations: `conv_id`, `part`, `place`, `role`, `text`, in order of `part` and then `place`."""
    whole, pieces = repaired_pieces(conversations, conv_id, turn, role, text, times)
    rows = whole.select("_id", F.lit(0).cast("long").alias("part"), "repaired").unionByName(pieces.select("_id", F.col("pos").alias("part"), "repaired"))
    turns = rows.select("_id", "part", F.posexplode("repaired").alias("place", "x"))
    return turns.select(restored("_id").alias("conv_id"), "part", "place", "x.role", "x.text")
