"""Readers for exports, lookups and landed payloads."""

from __future__ import annotations

import logging
from functools import reduce
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from omnishelf.sources.schemas import CSV_EXPORTS, LOOKUPS, PAYLOADS
from omnishelf.sources.versions import read_current

log = logging.getLogger(__name__)


# Above any file's size: each file is a partition of its own.
WHOLE_FILE = str(1 << 50)


def _files_by_header(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """The files at ``path``, grouped by their first line that is not blank; found in one job.

    Every file is read by a task of its own, which stops at that line, so the work is one open and
    one block read per file, spread over the cluster, whatever the files' number and size. Paths and
    header lines reach the driver, which lists the files anyway to plan the read.
    """

    def first_line(batches):
        # The task's one file; a batch holds one line, so ending here ends the read. Being local, the
        # function travels whole, and the workers need no package of ours.
        for batch in batches:
            if batch.num_rows:
                yield batch.slice(0, 1)
                return

    reading = spark.newSession()
    for key, value in {
        "spark.sql.files.maxPartitionBytes": WHOLE_FILE,
        "spark.sql.files.openCostInBytes": WHOLE_FILE,
        "spark.sql.execution.arrow.maxRecordsPerBatch": "1",
    }.items():
        reading.conf.set(key, value)
    lines = reading.read.text(path).select(F.col("_metadata.file_path").alias("file"), "value")
    firsts = lines.filter(F.trim("value") != "").mapInArrow(first_line, lines.schema)
    groups: dict[str, list[str]] = {}
    for file, line in sorted(tuple(row) for row in firsts.collect()):
        # The path comes as a URI; readers take it as it is called.
        groups.setdefault(line.lstrip("\ufeff"), []).append(unquote(file))
    return groups


def _typed(value: Column, field: T.StructField) -> Column:
    """The value in its declared type; text that is none of it fails the load."""
    if field.dataType == T.StringType():
        return value
    wrong = F.concat(F.lit(f"{field.name} is no {field.dataType.simpleString()}: "), value)
    failed = F.when(value.isNotNull(), F.raise_error(wrong).cast(field.dataType))
    return F.coalesce(value.try_cast(field.dataType), failed)


def _read_csv(
    spark: SparkSession, path: str, schema: T.StructType, required: bool, multi_line: bool
) -> DataFrame:
    """The declared columns by each file's own header; an absent column is NULL, an extra one is
    not read.

    All fields arrive as text, so only header lines are looked at before the query runs, in one job
    over all files; files with one header are read together. With ``multi_line`` quoted fields may span lines, which keeps
    Spark from splitting one file: write large exports as a directory of files, or give up line
    breaks in fields. A missing file is an empty table, or an error where it is ``required``.
    """
    try:
        groups = _files_by_header(spark, path)
    except AnalysisException as error:
        if required or error.getCondition() != "PATH_NOT_FOUND":
            raise
        log.warning("skipped, no file at %s", path)
        groups = {}
    parts = []
    for files in groups.values():
        raw = spark.read.csv(files, header=True, quote='"', escape='"', multiLine=multi_line)
        present = {c.lower(): c for c in raw.columns}
        columns = []
        for field in schema.fields:
            name = present.get(field.name.lower())
            value = F.lit(None).cast("string") if name is None else F.col(f"`{name}`")
            columns.append(_typed(value, field).cast(field.dataType).alias(field.name))
        parts.append(raw.select(*columns))
    if not parts:
        return spark.createDataFrame([], schema)
    return reduce(DataFrame.unionByName, parts)


def read_exports(
    spark: SparkSession, folder: str, multi_line: bool = True
) -> dict[str, DataFrame]:
    """All CSV exports ``<folder>/<source>.csv``, each a file or a directory of files; an export
    that is not there is empty."""
    return {
        name: _read_csv(spark, f"{folder}/{name}.csv", schema, False, multi_line)
        for name, schema in CSV_EXPORTS.items()
    }


def read_lookups(
    spark: SparkSession, folder: str, multi_line: bool = True
) -> dict[str, DataFrame]:
    """All lookup tables ``<folder>/<lookup>.csv``; empty fields are NULL. A missing table or a
    malformed field fails."""
    return {
        name: _read_csv(spark, f"{folder}/{name}.csv", T.StructType.fromDDL(ddl), True, multi_line)
        for name, ddl in LOOKUPS.items()
    }


def read_payload(
    spark: SparkSession, path: str, payload: str, multi_line: bool = False
) -> DataFrame:
    """Landed JSON of one kind. One document per line splits across tasks; ``multi_line`` reads
    pretty-printed documents and files that hold one JSON array."""
    return spark.read.json(path, schema=PAYLOADS[payload], multiLine=multi_line)


def read_tables(spark: SparkSession, folder: str, names) -> dict[str, DataFrame]:
    """The current rows of landed tables."""
    return {name: read_current(spark, f"{folder}/{name}") for name in names}
