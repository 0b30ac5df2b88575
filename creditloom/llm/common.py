"""What several of the operators need: staged tables, and keys that survive nulls and repeated rows."""

from __future__ import annotations

import math
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import creditloom
from creditloom.session import shared_folder

#: Stands for a null doc_id while rows are sorted and joined; smaller than every real one.
NO_ID = -(1 << 63)


def staged(df: DataFrame, compact: bool = False) -> DataFrame:
    """The rows written to the shared folder and read back: computed once, and not lost with an executor.

    `compact` is for joins and aggregations of narrow rows, as links are: an eighth of a shuffle's partitions, or a few tasks for each core,
    do them and write few files. A shuffle has the more partitions the larger the data, so the tasks don't grow.
    """
    if compact:
        spark = df.sparkSession
        df = df.coalesce(max(2 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")) // 8))
    path = f"{shared_folder(df.sparkSession)}/rows"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_shipped: set[str] = set()


def importable(spark: SparkSession) -> None:
    """Sends this package's source to the executors, whose Python needn't have it installed; once for an application."""
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    package = Path(creditloom.__file__).parent
    target = Path(tempfile.mkdtemp(prefix="creditloom-")) / "creditloom.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for file in sorted(package.rglob("*.py")):
            archive.write(file, file.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(target))
    _shipped.add(application)


def known(column: str = "doc_id") -> Column:
    return F.coalesce(F.col(column).cast("bigint"), F.lit(NO_ID))


def restored(column: str) -> Column:
    return F.when(F.col(column) != NO_ID, F.col(column))


def keyed(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """`_id`, `_copy` and `_text` of each row. `_copy` tells rows apart that share an id but not the text."""
    importable(docs.sparkSession)
    return docs.select(known(doc_id).alias("_id"), F.xxhash64(text).alias("_copy"), F.col(text).alias("_text"))


def numbered(docs: DataFrame, text: str, doc_id: str) -> tuple[DataFrame, str, str]:
    """The rows with columns c0, c1, ... so that no name clashes, besides `_id` and `_copy`; and the new names of both columns."""
    at = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    rows = docs.toDF(*at.values())
    return rows.withColumns({"_id": known(at[doc_id]), "_copy": F.xxhash64(at[text])}), at[text], at[doc_id]


def named(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """Back to the columns of `docs`."""
    return rows.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])


def groups_for(spark: SparkSession, size: float, most: float) -> int:
    """How many groups hold `size` in all with about `most` in each; at least one for each shuffle partition."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(size / most))


def document_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
