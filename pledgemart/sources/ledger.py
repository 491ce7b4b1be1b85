"""A landed day that comes in parts: files already read are remembered, a rerun reads the new ones only.

The ledger of a day lists the files its rows were made of, with size and time. The rows of a day are held with
their ``read_order``, so a file that comes later but is read earlier in order loses to what is there, as it
would if the whole day were read anew.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from pledgemart.operators.dedup import keep_last
from pledgemart.sources import landing

_LEDGER = "path string, size bigint, modified timestamp"


def list_files(spark: SparkSession, base: str, table: str, dt: str) -> DataFrame:
    """``path, size, modified`` of the day's files; their contents stay unread."""
    reader = spark.read.format("binaryFile").options(pathGlobFilter=landing.NAMES, recursiveFileLookup=True)
    try:
        files = reader.load(landing.day_folders(base, table, dt))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _LEDGER)
    about = {"path": "file_path", "size": "file_size", "modified": "file_modification_time"}
    return files.select(*(F.col(f"_metadata.{field}").alias(name) for name, field in about.items()))


@dataclass
class Day:
    """One row per key with ``read_order``, the ledger to keep beside it, and how many files this run reads."""

    rows: DataFrame
    ledger: DataFrame
    files_read: int


def update_day(
    spark: SparkSession, base: str, table: str, dt: str, keys: Sequence[str], conform: Callable[[DataFrame], DataFrame],
    held: DataFrame | None = None, ledger: DataFrame | None = None,
) -> Day:
    """The day's rows after a rerun: those ``held`` merged with the files that ``ledger`` does not know.

    ``conform`` makes rows of records and leaves ``read_order``. If a known file has changed or is gone, rows of
    it may have displaced others, so the day is read as a whole.
    """
    listed = list_files(spark, base, table, dt)
    # One listing for both the rows and the ledger; it is as long as the day has files.
    found = spark.createDataFrame(listed.collect(), _LEDGER)
    read = found
    if ledger is not None and held is not None and ledger.join(found, ["path", "size", "modified"], "left_anti").isEmpty():
        read = found.join(ledger, ["path", "size", "modified"], "left_anti")
    else:
        held = None
    paths = [r.path for r in read.select("path").collect()]
    rows = conform(landing.read_records(spark, base, table, dt, files=paths))
    if held is not None:
        rows = held.unionByName(rows)
    return Day(keep_last(rows, keys), found, len(paths))
