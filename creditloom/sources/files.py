"""Small JSON files on the file system of the data: descriptions, versions and manifests."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession

from creditloom.sources.readers import children, file_system


def read_json(spark: SparkSession, path: str):
    """The content of a file, None if there is none."""
    system, file = file_system(spark, path)
    if not system.exists(file):
        return None
    stream = system.open(file)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def write_json(spark: SparkSession, path: str, value, replace: bool = True) -> None:
    """Write a file beside its place and then move it there, so that no reader meets half of it.

    Without `replace` a file that is there already is an error, and so is one that another writer moves there first.
    """
    above, _, name = path.rpartition("/")
    system, file = file_system(spark, path)
    _, beside = file_system(spark, f"{above}/.{name}.{uuid.uuid4().hex}")
    stream = system.create(beside, False)
    stream.write(json.dumps(value, indent=1, sort_keys=True).encode())
    stream.close()
    if system.exists(file):
        if not replace:
            system.delete(beside, False)
            raise FileExistsError(path)
        system.delete(file, False)
    if not system.rename(beside, file):
        raise FileExistsError(path)


def newest(spark: SparkSession, folder: str) -> tuple[int, str | None]:
    """Number and path of the last of the numbered files in a folder; 0 and None if there are none."""
    found = {x.getPath().getName(): x.getPath().toString() for x in children(spark, folder)}
    last = max((name for name in found if name.removesuffix(".json").isdigit()), default=None)
    return (0, None) if last is None else (int(last.removesuffix(".json")), found[last])


def numbered(folder: str, number: int) -> str:
    return f"{folder}/{number:08d}.json"
