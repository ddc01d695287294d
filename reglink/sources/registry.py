"""Numbered one-line entries in a shared folder, each of which exactly one writer can create.

Claims and id ranges are agreed on by such entries: a writer reads those there are, decides, and adds the next
number; if another writer was first, it reads again.  An entry is written elsewhere and renamed without
overwriting, so it is seen whole or not at all (one atomic step on HDFS).
"""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def exists(spark: SparkSession, path: str) -> bool:
    p = _path(spark, path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def entries(spark: SparkSession, folder: str) -> list[str]:
    """The entries in order (one short line per claim or load)."""
    if not exists(spark, folder):
        return []
    rows = spark.read.option("pathGlobFilter", "[0-9]*").text(folder).select(F.col("_metadata.file_name").alias("n"), "value").collect()
    return [r.value for r in sorted(rows, key=lambda r: r.n)]


def latest(spark: SparkSession, folder: str) -> tuple[int, str]:
    """The last entry and its number (0 and an empty line before the first one)."""
    if not exists(spark, folder):
        return 0, ""
    p = _path(spark, folder)
    found = p.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(p)
    numbers = [int(name) for name in (f.getPath().getName() for f in found) if name.isdigit()]
    if not numbers:
        return 0, ""
    return max(numbers), spark.read.text(f"{folder.rstrip('/')}/{max(numbers):012d}").first().value


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder, if it is there."""
    p = _path(spark, path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def add(spark: SparkSession, folder: str, number: int, line: str) -> bool:
    """Create entry ``number`` (from 1); False if it is there already."""
    fs_of = spark._jvm.org.apache.hadoop.fs
    folder = folder.rstrip("/")
    target, draft = _path(spark, f"{folder}/{number:012d}"), _path(spark, f"{folder}/_draft-{uuid.uuid4().hex}")
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    out = fs.create(draft)
    out.write(f"{line}\n".encode())
    out.close()
    options = spark._sc._gateway.new_array(getattr(fs_of, "Options$Rename"), 0)
    try:
        files = fs_of.FileContext.getFileContext(fs.makeQualified(target).toUri(), spark._jsc.hadoopConfiguration())
        files.rename(fs.makeQualified(draft), fs.makeQualified(target), options)
        return True
    except Py4JJavaError as e:
        fs.delete(draft, False)
        if "FileAlreadyExistsException" in str(e.java_exception):
            return False
        raise
