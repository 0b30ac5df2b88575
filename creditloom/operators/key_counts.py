"""Row counts of frequent keys, stored beside the tables, so that joins over stored tables need no count of their own.

A month keeps the counts of its keys with more than `floor` rows; they are few, at most the month's rows over `floor`. A key that a month
doesn't list has at most `floor` rows in it, so the listed counts bound every key's total from above: with `months` months
in all, keys listed nowhere have at most `floor * months` rows. As long as that is not above the rows a task may hold, the
stored counts tell all hot keys. Months are replaced one by one, as those of the tables are. A month without frequent keys has no
file, so where no key is frequent the folder listing alone says so and no job runs.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from creditloom.operators.skew import CODE, LISTED_KEYS, ROWS_PER_TASK, HotKeys, choose_hot_keys, key_code
from creditloom.sources.readers import Day, between_snapshots, children, file_system, literal, stored_months, within
from creditloom.sources.schemas import SNAPSHOT

MONTHS = 240  # of which the default floor lets frequent keys be told
COUNT_FLOOR = ROWS_PER_TASK // MONTHS
SLOTS = 1 << 14  # slots of keys of a month
SLOT = "__slot"


def write_key_counts(
    rows: DataFrame,
    root: str,
    keys: Mapping[str, str],
    floor: int = COUNT_FLOOR,
    start: Day = None,
    end: Day = None,
    monthly: bool = True,
) -> None:
    """Store the counts of the frequent keys of `rows`, by month if they are `monthly`; `keys` are columns by name.

    Keys are counted by slot first, many keys to a slot, as such counts combine per task to a few; only keys in slots with more than `floor`
    rows can be frequent and are counted one by one. Both passes read the key columns only. Months between `start`
    and `end` are replaced, also those that have no frequent key any more; a table without months is replaced as a whole.
    """
    by = [SNAPSHOT] if monthly else []
    parts = [F.struct(F.lit(name).alias("key"), F.col(column).cast("string").alias("code")) for name, column in keys.items()]
    listed = rows.select(*by, F.explode(F.array(*parts)).alias("part")).select(*by, "part.*")
    candidates = _in_full_slots(listed, [*by, "key"], floor)
    counted = candidates.groupBy(*by, "key", "code").agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > floor)
    seen, spark = Observation(), rows.sparkSession
    written = F.collect_set(SNAPSHOT) if by else F.count(F.lit(1))
    out = counted.observe(seen, written.alias("written")).write.mode("overwrite")
    if by:
        held = {month for month in stored_months(spark, root) if within(month, start, end)}
        out.partitionBy(SNAPSHOT).option("partitionOverwriteMode", "dynamic").parquet(root)
        for month in held - set(seen.get["written"]):
            remove(spark, f"{root}/{SNAPSHOT}={month}")
    else:
        out.parquet(root)
        if not seen.get["written"]:
            remove(spark, root)


def _in_full_slots(listed: DataFrame, by: Sequence[str], floor: int) -> DataFrame:
    """Rows whose slot holds more than `floor` rows. Where more slots do than may be broadcast, all rows."""
    slot = F.pmod(F.xxhash64("code"), F.lit(SLOTS)).cast("int")
    slotted = listed.withColumn(SLOT, slot)
    full = slotted.groupBy(*by, SLOT).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > floor).select(*by, SLOT)
    found = full.limit(LISTED_KEYS + 1).collect()
    if len(found) > LISTED_KEYS:
        return listed
    if not found:
        return listed.where(F.lit(False))
    known = listed.sparkSession.createDataFrame(found, full.schema)
    same = reduce(Column.__and__, [F.col(f"rows.{c}").eqNullSafe(F.col(f"full.{c}")) for c in [*by, SLOT]])
    return slotted.alias("rows").join(F.broadcast(known.alias("full")), same, "left_semi").drop(SLOT)


def remove(spark: SparkSession, folder: str) -> None:
    system, path = file_system(spark, folder)
    system.delete(path, True)


@dataclass(frozen=True)
class StoredCounts:
    """Where a table's counts are, the months of the table that are read, and how the counts were cut off."""

    root: str
    months: int = 1
    floor: int = COUNT_FLOOR
    start: Day = None
    end: Day = None

    def tell_all(self, rows_per_task: int) -> bool:
        """Whether no key can be hot that isn't listed."""
        return self.floor * self.months <= rows_per_task

    def read(self, spark: SparkSession, key: str) -> DataFrame | None:
        """Counts of one kind of key, by month if the table has months; None if there are none."""
        files = [x.getPath().getName() for x in children(spark, self.root)]
        months = [name for name in files if name.startswith(f"{SNAPSHOT}=")]
        if not files or months and not any(within(day, self.start, self.end) for day in stored_months(spark, self.root)):
            return None
        schema = f"key string, code string, rows long{f', {SNAPSHOT} date' if months else ''}"
        stored = spark.read.schema(schema).parquet(literal(self.root))
        stored = between_snapshots(stored, self.start, self.end) if months else stored
        return stored.where(F.col("key") == key).drop("key")


def by_month(counts: DataFrame, column: str) -> DataFrame:
    """Counts of the key made of a column and the month."""
    named = counts.withColumnRenamed("code", column)
    return named.select(key_code([column, SNAPSHOT]).alias(CODE), "rows")


def over_months(counts: DataFrame, stored: StoredCounts) -> DataFrame:
    """At least as many rows as each listed key has: months that don't list it may hold up to the floor."""
    most = F.sum("rows") + stored.floor * (stored.months - F.count("rows"))
    return counts.groupBy(F.col("code").alias(CODE)).agg(most.alias("rows"))


def stored_hot_keys(
    spark: SparkSession,
    joins: Sequence[tuple[Sequence[str], Mapping[str, tuple[StoredCounts, str]]]],
    rows_per_task: int = ROWS_PER_TASK,
) -> list[HotKeys | None] | None:
    """Hot keys of each join, from stored counts; None if these can't tell them all.

    A join is given as its keys, of which the last may be the month, and its sides by name, each with its counts and the name of its
    key there. Merging the counts reads nothing of the tables; without any count no job runs.
    """
    parts = []
    for i, (keys, sides) in enumerate(joins):
        for side, (stored, key) in sides.items():
            monthly = keys[-1] == SNAPSHOT
            if not monthly and not stored.tell_all(rows_per_task) or monthly and stored.floor > rows_per_task:
                return None
            counts = stored.read(spark, key)
            if counts is not None:
                merged = by_month(counts, keys[0]) if monthly else over_months(counts, stored)
                parts.append(merged.select(F.lit(i).alias("join"), F.lit(side).alias("side"), CODE, "rows"))
    if not parts:
        return [None] * len(joins)
    return choose_hot_keys(reduce(DataFrame.unionAll, parts), joins, rows_per_task)
