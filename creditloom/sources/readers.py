"""Scans: raw CSV, partitioned snapshots, and named relations for SQL."""

from __future__ import annotations

import csv
import datetime as dt
import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditloom.functions.casts import backticked, quoted
from creditloom.sources.schemas import SNAPSHOT

Day = str | dt.date | None


def read_raw(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType | str | None = None,
    infer: bool = False,
) -> DataFrame:
    """CSV with a header and lower-cased names. All columns are text unless a schema or `infer` is given.

    Inference reads the whole input once more, so it is off by default.
    """
    reader = spark.read.option("header", True)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", infer)
    return lower_names(reader.csv(path if isinstance(path, str) else list(path)))


def lower_names(df: DataFrame) -> DataFrame:
    """Lower-case every column name; two names that then coincide are an error."""
    names = [name.lower() for name in df.columns]
    twice = sorted({name for name in names if names.count(name) > 1})
    if twice:
        raise ValueError(f"columns coincide when lower-cased: {twice}")
    return df.toDF(*names)


def text_schema(columns: Sequence[str], partition: str = SNAPSHOT) -> T.StructType:
    """All-text schema with a date partition column, for reading raw snapshots without inference."""
    fields = [T.StructField(c, T.DateType() if c == partition else T.StringType()) for c in columns]
    return T.StructType(fields)


def read_snapshots(
    spark: SparkSession,
    root: str,
    start: Day = None,
    end: Day = None,
    fmt: str = "parquet",
    columns: Sequence[str] | None = None,
    merge_schema: bool = False,
    schema: T.StructType | None = None,
) -> DataFrame:
    """Snapshots between `start` and `end` (both included) of a dataset partitioned by `snapshot_date`.

    The range is a filter on the partition column, so other months are never listed for reading.
    `merge_schema` unites months whose columns differ, for formats that store a schema. CSV has none, so its months are
    grouped by their headers, read a group at a time, and united by name, with NULL for the columns a month doesn't have;
    `columns` (all text) or `schema` assert instead that all months have just these. All files of a month have its header, or the read fails.
    """
    if fmt == "csv" and columns is None and schema is None:
        return _csv_snapshots(spark, root, start, end)
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True).option("enforceSchema", False)
    if schema is not None or columns is not None:
        reader = reader.schema(schema if schema is not None else text_schema(columns))
    elif merge_schema:
        reader = reader.option("mergeSchema", True)
    return between_snapshots(reader.load(root), start, end)


def stored_months(spark: SparkSession, root: str) -> set[dt.date]:
    """Months that a dataset holds, from the names of its partition folders."""
    return set(_month_folders(spark, root))


def _month_folders(spark: SparkSession, root: str) -> dict[dt.date, str]:
    paths = [x.getPath() for x in children(spark, root) if x.isDirectory()]
    named = {p.getName().removeprefix(f"{SNAPSHOT}="): p.toString() for p in paths if p.getName().startswith(f"{SNAPSHOT}=")}
    return {dt.date.fromisoformat(day): path for day, path in sorted(named.items()) if day[:1].isdigit()}


def within(month: dt.date, start: Day, end: Day) -> bool:
    return (start is None or str(month) >= str(start)) and (end is None or str(month) <= str(end))


def month_headers(spark: SparkSession, root: str, start: Day = None, end: Day = None) -> dict[dt.date, tuple[str, ...]]:
    """Columns of every stored CSV month, from the first line of one of its files; a month without files has none."""
    folders = {month: path for month, path in _month_folders(spark, root).items() if within(month, start, end)}
    return {month: csv_header(spark, first_file(spark, path)) for month, path in folders.items()}


def csv_header(spark: SparkSession, file: str | None) -> tuple[str, ...]:
    """The names in the first line of a file, compressed or not."""
    if file is None:
        return ()
    system, path = file_system(spark, file)
    java = spark._jvm
    codec = java.org.apache.hadoop.io.compress.CompressionCodecFactory(spark._jsc.hadoopConfiguration()).getCodec(path)
    stream = system.open(path)
    lines = java.java.io.BufferedReader(java.java.io.InputStreamReader(codec.createInputStream(stream) if codec else stream, "UTF-8"))
    line = lines.readLine()
    lines.close()
    return tuple(next(csv.reader([line.removeprefix("\ufeff")], escapechar="\\"))) if line else ()


def _csv_snapshots(spark: SparkSession, root: str, start: Day, end: Day) -> DataFrame:
    headers = month_headers(spark, root, start, end) or month_headers(spark, root)
    groups: dict[tuple[str, ...], list[dt.date]] = {}
    for month, header in headers.items():
        if header:
            groups.setdefault(header, []).append(month)
    if not groups:
        raise FileNotFoundError(f"no months in {root}")
    folders = _month_folders(spark, root)
    parts = []
    for header, months in groups.items():
        reader = spark.read.option("header", True).option("enforceSchema", False).schema(text_schema([*header, SNAPSHOT]))
        # One group is the whole dataset, and its months are left to the filter below.
        paths = [literal(root)] if len(groups) == 1 else [literal(folders[month]) for month in months]
        parts.append(reader.option("basePath", root).csv(paths))
    united = reduce(lambda one, other: one.unionByName(other, allowMissingColumns=True), parts)
    rows = between_snapshots(united, start, end)
    return rows.select(*[backticked(c) for c in rows.columns if c != SNAPSHOT], SNAPSHOT)


def between_snapshots(df: DataFrame, start: Day = None, end: Day = None, column: str = SNAPSHOT) -> DataFrame:
    if start is not None:
        df = df.where(F.col(column) >= F.lit(start).cast("date"))
    if end is not None:
        df = df.where(F.col(column) <= F.lit(end).cast("date"))
    return df


def at_snapshot(df: DataFrame, day: str | dt.date, column: str = SNAPSHOT) -> DataFrame:
    """Rows of one snapshot; NULL dates never match."""
    return df.where(F.col(column) == F.lit(day).cast("date"))


def register(relations: Mapping[str, DataFrame]) -> None:
    """Make frames visible to SQL under the given names."""
    for name, df in relations.items():
        df.createOrReplaceTempView(backticked(name))


MAX_TABLES = 10_000  # tables a folder may hold, as each becomes a view on the driver
GLOB_SIGNS = re.compile(r"([{}\[\]*?\\])")


def literal(path: str) -> str:
    """A path as Spark's readers take it for just this file or folder, whatever signs its name has."""
    return GLOB_SIGNS.sub(r"\\\1", path)


def file_system(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and the path."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def hidden(name: str) -> bool:
    """Names that Spark's readers pass over; a partition folder is never one."""
    return name[:1] in ("_", ".") and "=" not in name


def children(spark: SparkSession, folder: str) -> list:
    """Statuses of what a folder holds, without hidden names; nothing if there is no such folder."""
    system, path = file_system(spark, folder)
    found = system.listStatus(path) if system.exists(path) else []
    return [x for x in found if not hidden(x.getPath().getName())]


def first_file(spark: SparkSession, folder: str, suffix: str = "") -> str | None:
    """Some data file at any depth of a folder; the listing stops there."""
    system, path = file_system(spark, folder)
    above = len(system.makeQualified(path).toString())
    files = system.listFiles(path, True)
    while files.hasNext():
        name = files.next().getPath().toString()
        if name.endswith(suffix) and not any(map(hidden, name[above + 1 :].split("/"))):
            return name
    return None


def list_tables(spark: SparkSession, folder: str, fmt: str = "csv", limit: int = MAX_TABLES) -> dict[str, str]:
    """{name: path} of the tables in a folder on any file system Spark reads.

    A file of the format is a table, and so is a sub-folder with such files at any depth, as Spark writes them,
    partition folders included. The name is without extension; two tables of one name are an error, more than `limit`
    as well. Only the folder itself is listed, and of each sub-folder as much as it takes to find a file. Paths are as
    Spark's readers take them, whatever signs the names have.
    """
    suffix = f".{fmt}"
    system, path = file_system(spark, folder)
    if not system.exists(path):
        raise FileNotFoundError(folder)
    found: dict[str, str] = {}
    for child in children(spark, folder):
        path, name = child.getPath().toString(), child.getPath().getName()
        holds = first_file(spark, path, suffix) is not None if child.isDirectory() else name.endswith(suffix)
        if not holds:
            continue
        table = name.removesuffix(suffix)
        if table in found:
            raise ValueError(f"several tables are named {table!r} in {folder}")
        found[table] = literal(path)
        if len(found) > limit:
            raise ValueError(f"more than {limit} tables in {folder}")
    return dict(sorted(found.items()))


def load_catalog(
    spark: SparkSession,
    folder: str,
    fmt: str = "csv",
    names: Sequence[str] | None = None,
    limit: int = MAX_TABLES,
) -> dict[str, DataFrame]:
    """Every table of a folder as a frame and a temp view of the same name."""
    paths = (
        {name: literal(f"{folder}/{name}.{fmt}") for name in names}
        if names is not None
        else list_tables(spark, folder, fmt, limit)
    )
    frames = {
        name: read_raw(spark, path) if fmt == "csv" else spark.read.format(fmt).load(path)
        for name, path in paths.items()
    }
    register(frames)
    return frames


def lookup(df: DataFrame, column: str, value: object) -> DataFrame:
    """Rows whose column equals a value."""
    return df.where(quoted(column) == F.lit(value))
