"""Left joins that stay balanced when single keys hold a large share of the rows of either side.

Adaptive execution splits a skewed partition only on the outer side of a left join, and only where the
result is not needed in the same partitioning further up. The mart chains joins on one key, so hot keys are
spread here. Each hot key is owned by the side on which it has most rows. The owner deals its rows for the
key out over a number of salts by a hash of the row; every other side repeats its rows for the key once per
salt; the join is on key and salt. The salt depends on the data only, so a recomputed task gives the same
rows. Rows of the left side with a NULL key match nothing and are dealt out too.

Where the right side owns a key, some salts may have no row on the right. The copies of a left row on such
salts are dropped: the key does occur on the right, so the left row has its matches on other salts.

Hot keys are found by an exact count, combined per task before its shuffle. There are at most as many as rows over
`rows_per_task`; up to `LISTED_KEYS` of them are listed and broadcast, and longer lists stay a table that is
joined as any other. Without hot keys the joins are plain ones.

Rows of hot keys that are alike in all columns are counted first, combined per task, and dealt out in pieces, so a group of copies spreads too.
Aggregations need no salt: `grouped` splits hot keys off and combines them per task.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditloom.functions.casts import backticked

ROWS_PER_TASK = 1_000_000  # a key with more rows than this on one side is hot
ALIKE_ROWS = 10_000  # like rows of a hot key that share a salt
LISTED_KEYS = 100_000  # hot keys that are broadcast, some megabytes; more are joined as a table

CODE = "__key"
OWNER = "__owner"
SALTS = "__salts"
SALT = "__salt"
MATCHED = "__matched"
TIMES = "__times"
PIECE = "__piece"


@dataclass(frozen=True)
class HotKeys:
    """Hot keys of a join with owner and salts; `listed` if the table is small enough to broadcast."""

    keys: tuple[str, ...]
    table: DataFrame
    owners: frozenset[str]
    null_salts: dict[str, int]
    listed: bool = True

    def small(self, df: DataFrame) -> DataFrame:
        """A table of hot keys, with a broadcast hint if their number has been checked."""
        return F.broadcast(df) if self.listed else df


def find_hot_keys(
    *joins: tuple[Sequence[str], Mapping[str, DataFrame]],
    rows_per_task: int = ROWS_PER_TASK,
    listed_keys: int = LISTED_KEYS,
) -> list[HotKeys | None]:
    """Hot keys of each join, given as its keys and its sides by name; None for a join without any.

    One job counts the rows of every key of all sides and keeps those above `rows_per_task`. It reads the key
    columns only. The list is fixed here, so all sides of a join use the same one.
    """
    frames: dict[int, tuple[DataFrame, list[Column]]] = {}
    for i, (keys, sides) in enumerate(joins):
        for side, df in sides.items():
            part = F.struct(F.lit(i).alias("join"), F.lit(side).alias("side"), key_code(keys).alias(CODE))
            frames.setdefault(id(df), (df, []))[1].append(part)
    # A table that takes part in several joins is read once.
    coded = [
        df.select((parts[0] if len(parts) == 1 else F.explode(F.array(*parts))).alias("part")).select("part.*")
        for df, parts in frames.values()
    ]
    counted = reduce(DataFrame.unionAll, coded).groupBy("join", "side", CODE).agg(F.count(F.lit(1)).alias("rows"))
    return choose_hot_keys(counted, joins, rows_per_task, listed_keys)


def choose_hot_keys(
    counted: DataFrame,
    joins: Sequence[tuple[Sequence[str], Iterable[str]]],
    rows_per_task: int = ROWS_PER_TASK,
    listed_keys: int = LISTED_KEYS,
) -> list[HotKeys | None]:
    """Hot keys of each join from row counts by number of the join, side and key. A join is given as its keys and sides."""
    counted = counted.where(F.col("rows") > rows_per_task)
    found = counted.limit(listed_keys + 1).collect()
    if len(found) > listed_keys:
        return [_unlisted(counted.where(F.col("join") == i), keys, sides, rows_per_task) for i, (keys, sides) in enumerate(joins)]
    return [_listed(counted, keys, [row for row in found if row["join"] == i], rows_per_task) for i, (keys, _) in enumerate(joins)]


def _listed(counted: DataFrame, keys: Sequence[str], found: list, rows_per_task: int) -> HotKeys | None:
    """Give every hot key to the side with most rows."""
    if not found:
        return None
    null_salts = {row.side: _salts(row.rows, rows_per_task) for row in found if row[CODE] is None}
    owners: dict[str, tuple[int, str]] = {}
    for row in found:
        if row[CODE] is not None:
            owners[row[CODE]] = max(owners.get(row[CODE], (0, row.side)), (row.rows, row.side))
    listed = [(key, side, _salts(count, rows_per_task)) for key, (count, side) in owners.items()]
    table = counted.sparkSession.createDataFrame(listed, f"{CODE} string, {OWNER} string, {SALTS} int")
    return HotKeys(tuple(keys), table, frozenset(side for _, side, _ in listed), null_salts)


def _unlisted(counted: DataFrame, keys: Sequence[str], sides: Iterable[str], rows_per_task: int) -> HotKeys:
    """The same as a table, for more keys than may be listed. Any side may own one."""
    most = F.max(F.struct("rows", "side")).alias("most")
    salts = F.ceil(F.col("most.rows") / rows_per_task).cast("int")
    known = counted.where(F.col(CODE).isNotNull()).groupBy(CODE).agg(most)
    table = known.select(CODE, F.col("most.side").alias(OWNER), salts.alias(SALTS))
    missing = counted.where(F.col(CODE).isNull()).collect()  # one row for a side at most
    null_salts = {row.side: _salts(row.rows, rows_per_task) for row in missing}
    return HotKeys(tuple(keys), table, frozenset(sides), null_salts, listed=False)


def key_code(keys: Sequence[str]) -> Column:
    """The key as one text, different for different keys; NULL if any part is NULL."""
    *front, last = [F.col(k).cast("string") for k in keys]
    parts = [part for k in front for part in (F.length(k).cast("string"), F.lit(":"), k)]
    return F.concat(*parts, last) if parts else last


def spread(df: DataFrame, side: str, hot: HotKeys | None, by: Sequence[str] | None = None) -> DataFrame:
    """Add salt and owner to one side. `by` names columns that vary within a key; default all hashable ones."""
    if hot is None:
        return df
    by = list(by) if by is not None else _hashable(df)
    marked = df.join(hot.small(hot.table), key_code(hot.keys) == F.col(CODE), "left").drop(CODE)
    missing = key_code(hot.keys).isNull()
    all_salts = F.sequence(F.lit(0), F.coalesce(F.col(SALTS), F.lit(1)) - 1)
    repeated = F.lit(0) if hot.owners <= {side} else F.explode(all_salts)
    own = F.lit(False)
    if side in hot.owners:
        own = own | F.coalesce(F.col(OWNER) == side, F.lit(False))
    if side in hot.null_salts:
        own = own | missing
        marked = marked.withColumn(SALTS, F.when(missing, hot.null_salts[side]).otherwise(F.col(SALTS)))
    if side not in hot.owners and side not in hot.null_salts:
        return marked.withColumn(SALT, repeated).drop(SALTS)
    dealt = _deal(marked.where(own), by)
    return marked.where(~own).withColumn(SALT, repeated).drop(SALTS).unionByName(dealt)


def _deal(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows of hot keys with a salt below `SALTS`, from a hash of the row. Like rows are counted, cut into pieces of at most `ALIKE_ROWS`, and
    dealt by piece, so that a group of copies spreads as well as rows that differ do."""
    values = [backticked(c) for c in by]
    if len(_hashable(rows)) < len(rows.columns):
        return rows.withColumn(SALT, F.pmod(F.xxhash64(*values), F.col(SALTS)).cast("int")).drop(SALTS)
    columns = [backticked(c) for c in rows.columns]
    counted = rows.groupBy(*columns).agg(F.count(F.lit(1)).alias(TIMES)).withColumn(PIECE, F.lit(0).cast("bigint"))
    cut = F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr(f"({TIMES} - 1) div {ALIKE_ROWS}")))
    many = counted.where(F.col(TIMES) > ALIKE_ROWS).withColumn(PIECE, cut)
    many = many.withColumn(TIMES, F.least(F.lit(ALIKE_ROWS), F.col(TIMES) - F.col(PIECE) * ALIKE_ROWS)).repartition(*columns, PIECE)
    pieces = counted.where(F.col(TIMES) <= ALIKE_ROWS).unionByName(many)
    salted = pieces.withColumn(SALT, F.pmod(F.xxhash64(*values, PIECE), F.col(SALTS)).cast("int"))
    each = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col(TIMES)))
    return salted.withColumn(TIMES, each).drop(TIMES, PIECE, SALTS)


def attach(left: DataFrame, right: DataFrame, side: str, keys: Sequence[str], hot: HotKeys | None) -> DataFrame:
    """Left join of an already spread frame to `right`, the side named `side`."""
    if hot is None:
        return left.join(right, list(keys), "left")
    salted = spread(right, side, hot).drop(OWNER)
    if side not in hot.owners:
        return left.join(salted, [*keys, SALT], "left")
    joined = left.join(salted.withColumn(MATCHED, F.lit(True)), [*keys, SALT], "left")
    no_row_on_salt = F.col(MATCHED).isNull() & F.col(OWNER).eqNullSafe(F.lit(side))
    return joined.where(~no_row_on_salt).drop(MATCHED)


def balanced_left_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    unique_right: bool = False,
    by: Sequence[str] | None = None,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """`left` joined to `right` with hot keys of both spread over tasks.

    `unique_right` tells that keys do not repeat on the right, so only the left is searched for hot ones.
    """
    added = [c for c in right.columns if c not in keys]
    shared = set(left.columns) & set(added)
    if shared:
        raise ValueError(f"both sides have columns {sorted(shared)}")
    sides = {"left": left} if unique_right else {"left": left, "right": right}
    (hot,) = find_hot_keys((keys, sides), rows_per_task=rows_per_task)
    joined = attach(spread(left, "left", hot, by), right, "right", keys, hot)
    return joined.select([backticked(c) for c in [*left.columns, *added]])


def grouped(
    df: DataFrame,
    key: str,
    aggregates: Sequence[Column],
    rows_per_task: int = ROWS_PER_TASK,
    hot: HotKeys | None | bool = True,
    tasks: int | None = None,
    placed: bool = False,
) -> DataFrame:
    """`aggregates` per value of `key`, for results that are wider than a row or can't be combined by hash.

    Rows are shuffled and then aggregated in one go, as a task of snapshots seldom holds two rows of a key and
    partial results would be larger than the rows. Rows of hot keys, a NULL one included, are combined per task
    before their shuffle instead, however alike they are. `hot` are keys found before, None for none.

    Without hot keys, `tasks` is how many tasks the rows go to, as many as the session says if not given; rows that are `placed` lie in
    buckets of the key and stay where they are.
    """
    if hot is True:
        (hot,) = find_hot_keys(([key], {"rows": df}), rows_per_task=rows_per_task)
    if not hot:
        if not placed:
            df = df.repartition(tasks, key) if tasks else df.repartition(key)
        return df.groupBy(key).agg(*aggregates)
    listed = hot.small(hot.table.select(CODE))
    code = key_code([key])
    is_hot = code == F.col(CODE)
    rest, many = df.join(listed, is_hot, "left_anti"), df.join(listed, is_hot, "left_semi")
    if "rows" in hot.null_salts:
        rest, many = rest.where(F.col(key).isNotNull()), many.unionAll(df.where(F.col(key).isNull()))
    few = rest.repartition(key).groupBy(key).agg(*aggregates)
    return few.unionAll(many.groupBy(key).agg(*aggregates))


def _salts(rows: int, rows_per_task: int) -> int:
    return max(ceil(rows / rows_per_task), 1)


def _hashable(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
