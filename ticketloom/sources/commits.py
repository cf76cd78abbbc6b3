"""Numbered commits of one small JSON row each: writers that meet do not overwrite one another."""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

ATTEMPTS = 1_000


def _located(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def numbers(spark: SparkSession, folder: str) -> list[int]:
    """The numbers committed so far, ascending; none if the folder does not exist."""
    where, files = _located(spark, folder)
    if not files.exists(where):
        return []
    names = (status.getPath().getName() for status in files.listStatus(where))
    return sorted(int(name.removesuffix(".json")) for name in names if name.removesuffix(".json").isdigit())


def put_if_absent(spark: SparkSession, folder: str, number: int, row: dict) -> bool:
    """Write a commit whole, unless its number is taken; says whether it was written.

    The row goes to a hidden file first. On a local disk a hard link gives it its name,
    elsewhere a rename; both fail if the name is taken. The rename must be atomic, as on
    HDFS: an object store whose client only imitates it needs a lock of its own.
    """
    where, files = _located(spark, f"{folder}/{number:012d}.json")
    hidden, _ = _located(spark, f"{folder}/.{uuid.uuid4().hex}")
    files.mkdirs(where.getParent())
    line = (json.dumps(row, sort_keys=True) + "\n").encode()
    if files.getScheme() == "file":
        held, name = hidden.toUri().getPath(), where.toUri().getPath()
        with open(held, "wb") as file:
            file.write(line)
        try:
            os.link(held, name)
        except FileExistsError:
            return False
        finally:
            os.unlink(held)
        return True
    out = files.create(hidden, False)
    out.write(bytearray(line))
    out.close()
    won = not files.exists(where) and files.rename(hidden, where)
    if not won:
        files.delete(hidden, False)
    return won


def append(spark: SparkSession, folder: str, row: Callable[[int], dict]) -> int:
    """Commit ``row(number)`` under the first number that is free and return the number."""
    for _ in range(ATTEMPTS):
        number = max(numbers(spark, folder), default=0) + 1
        if put_if_absent(spark, folder, number, row(number)):
            return number
    raise RuntimeError(f"{folder} is written to by others all the time")


def read(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """All commits as rows; no rows if there are none."""
    if not numbers(spark, folder):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("mode", "FAILFAST").json(folder)
