"""Tables that are replaced as a whole, and the few file operations that takes.

A table is a folder with one folder per version and a pointer file. A load writes a new version
beside the others and moves the pointer as its last step, so readers see the old rows or the new
ones and a load that fails half-way changes nothing. The pointer also names the versions before it
that are kept for queries that still read them.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

POINTER = "CURRENT"
VERSION = "version-"


def _hadoop(spark: SparkSession, path: str):
    """The file system of ``path`` as Spark itself reaches it, and the path in its terms."""
    configuration = spark._jsc.hadoopConfiguration()
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(configuration), found


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of data files; nothing happens if it is gone."""
    files, found = _hadoop(spark, path)
    files.delete(found, True)


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    """Replace a small file in one step: written beside it and renamed over it."""
    jvm = spark._jvm
    files, target = _hadoop(spark, path)
    draft = jvm.org.apache.hadoop.fs.Path(f"{path}-{uuid.uuid4().hex}")
    out = files.create(draft, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        files.makeQualified(target).toUri(), spark._jsc.hadoopConfiguration()
    )
    kinds = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    over = spark.sparkContext._gateway.new_array(kinds, 1)
    over[0] = kinds.OVERWRITE
    context.rename(files.makeQualified(draft), files.makeQualified(target), over)


def versions(spark: SparkSession, path: str) -> list[str]:
    """The versions that the pointer names, current one first; empty where nothing was loaded."""
    files, pointer = _hadoop(spark, f"{path}/{POINTER}")
    if not files.exists(pointer):
        return []
    source = files.open(pointer)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8").split()
    finally:
        source.close()


def replace(
    df: DataFrame, path: str, keep: int = 1, options: Mapping[str, str] | None = None
) -> None:
    """Make ``df`` the table's rows; a plan that reads the table itself may replace it. ``options``
    go to the Parquet writer.

    ``keep`` versions before the new one stay for readers that started on them. A failed load
    removes what it wrote and raises. Of two loads at the same time the later pointer wins; its
    loser's rows are an unnamed version that ``vacuum`` removes.
    """
    spark = df.sparkSession
    fresh = f"{VERSION}{uuid.uuid4().hex}"
    try:
        df.write.options(**(options or {})).parquet(f"{path}/{fresh}")
    except BaseException:
        remove(spark, f"{path}/{fresh}")
        raise
    known = versions(spark, path)
    _write_text(spark, f"{path}/{POINTER}", "\n".join([fresh, *known[:keep]]))
    for old in known[keep:]:
        remove(spark, f"{path}/{old}")


def read_current(spark: SparkSession, path: str) -> DataFrame:
    """The table's current rows; a folder without a pointer is read as plain Parquet."""
    known = versions(spark, path)
    return spark.read.parquet(f"{path}/{known[0]}" if known else path)


def vacuum(spark: SparkSession, path: str, older_than_seconds: float = 7 * 86400) -> list[str]:
    """Remove versions that the pointer does not name and that nothing has written to for that long:
    the remains of drivers that died during a load."""
    files, folder = _hadoop(spark, path)
    if not files.exists(folder):
        return []
    known, limit, gone = versions(spark, path), time.time() - older_than_seconds, []
    for entry in files.listStatus(folder):
        name = entry.getPath().getName()
        if name.startswith(VERSION) and name not in known:
            if entry.getModificationTime() / 1000 <= limit:
                files.delete(entry.getPath(), True)
                gone.append(name)
    return gone
