"""Tables laid out by customer: bucketed Parquet, so that joins on the customer read matching buckets and shuffle nothing.

Spark knows buckets from its catalog only, so every session enters a table anew from what is stored: a description beside its
folder and the names of the month folders. Months are replaced one by one; the data are plain Parquet and can be read by path as well, which is
the way for tables whose hot customers would fill a bucket.
"""

from __future__ import annotations

import zlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditloom.functions.casts import backticked
from creditloom.sources.files import read_json, write_json
from creditloom.sources.readers import Day, between_snapshots, file_system, stored_months, within
from creditloom.sources.schemas import CUSTOMER, SNAPSHOT
from creditloom.sources.writers import WriteAudit

DYNAMIC = "spark.sql.sources.partitionOverwriteMode"


def write_buckets(
    df: DataFrame,
    path: str,
    count: int,
    by: str = CUSTOMER,
    start: Day = None,
    end: Day = None,
    sort_by: Sequence[str] = (),
    monthly: bool = True,
) -> WriteAudit:
    """Write `df` in `count` buckets by a column, each month in its folder if it is `monthly`; replaces what it covers.

    One shuffle brings every bucket to one task, which writes one file a month, in the order of `sort_by`. Joins need the same
    `count` on all sides. Months between `start` and `end` without rows any more are removed.
    """
    spark = df.sparkSession
    if monthly:
        df = df.select(*[backticked(c) for c in df.columns if c != SNAPSHOT], SNAPSHOT)
    held = {m for m in stored_months(spark, path) if within(m, start, end)} if monthly and start is not None else set()
    write_json(spark, description(path), {"schema": df.schema.jsonValue(), "count": count, "by": by, "monthly": monthly})
    name = enter(spark, path)
    months = F.collect_set(SNAPSHOT) if monthly else F.array()
    seen = Observation()
    rows = df.repartition(count, by).sortWithinPartitions(*[SNAPSHOT] * monthly, *sort_by or [by])
    rows = rows.observe(seen, F.count(F.lit(1)).alias("rows"), months.alias("months"))
    before = spark.conf.get(DYNAMIC)
    spark.conf.set(DYNAMIC, "dynamic")
    try:
        rows.write.insertInto(name, overwrite=True)
    finally:
        spark.conf.set(DYNAMIC, before)
    written = sorted(seen.get["months"]) if monthly else []
    for month in held - set(written):
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({SNAPSHOT} = '{month}')")
        system, folder = file_system(spark, f"{path}/{SNAPSHOT}={month}")
        system.delete(folder, True)
    return WriteAudit(seen.get["rows"], snapshots=written)


def read_buckets(spark: SparkSession, path: str, start: Day = None, end: Day = None) -> DataFrame:
    """A bucketed table as stored now, of the months between `start` and `end`. No job runs."""
    df = spark.table(enter(spark, path))
    return between_snapshots(df, start, end)


def bucket_schema(spark: SparkSession, path: str) -> T.StructType:
    """The columns of a bucketed table, also where it has no rows."""
    return T.StructType.fromJson(read_json(spark, description(path))["schema"])


def description(path: str) -> str:
    """The file beside a table's folder, hidden from Spark's readers, as a whole table's write replaces its folder."""
    above, _, name = path.rstrip("/").rpartition("/")
    return f"{above}/_{name}.buckets.json"


def enter(spark: SparkSession, path: str) -> str:
    """Enter the table into the session's catalog with its buckets and stored months; its name there."""
    system, folder = file_system(spark, path)
    place = system.makeQualified(folder).toString()
    table = read_json(spark, description(path))
    schema = T.StructType.fromJson(table["schema"])
    name = f"buckets_{zlib.crc32(place.encode()):08x}"
    columns = ", ".join(f"{backticked(f.name)} {f.dataType.simpleString()}" for f in schema.fields)
    monthly = table["monthly"]
    quoted = place.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet {f'PARTITIONED BY ({SNAPSHOT})' if monthly else ''} "
        f"CLUSTERED BY ({backticked(table['by'])}) INTO {table['count']} BUCKETS LOCATION '{quoted}'"
    )
    months = sorted(stored_months(spark, path)) if monthly else []
    if months:
        parts = " ".join(f"PARTITION ({SNAPSHOT} = '{month}')" for month in months)
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {parts}")
    return name
