"""Marts read back from CSV extracts.

A quoted field may hold line ends, so a line is no record, and Spark by itself reads such a file in one
task. Here files are split like any text. Whether a line begins within quotes is told by the number of
quotes before it: each split's quotes are counted, the counts of the splits before it give its
beginning, and lines are put together to records within the split. The few records that go over the
border of splits are put together from their parts.
"""

from __future__ import annotations

import csv
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from pledgemart import fixed_values as fv
from pledgemart.functions.casts import blank_to_null, strip
from pledgemart.functions.times import parse_instant
from pledgemart.operators.conform import strip_column_names

# Above this share of 8-digit values a column is read as yyyyMMdd.
COMPACT_SHARE = 0.8


def is_date_like(name: str) -> bool:
    return name.lower() in fv.DATE_LIKE_COLUMNS or name.lower().endswith(fv.DATE_LIKE_SUFFIXES)


def coerce_dates(df: DataFrame) -> DataFrame:
    """Text columns named like dates become timestamps; unreadable values become NULL.

    One aggregate over all of them decides per column between yyyyMMdd and general parsing.
    """
    names = [f.name for f in df.schema.fields if is_date_like(f.name) and isinstance(f.dataType, T.StringType)]
    if not names:
        return df
    compact = lambda c: F.avg(blank_to_null(F.col(c)).rlike(r"^\d{8}$").cast("double"))
    shares = df.agg(*[compact(c).alias(c) for c in names]).first()
    parsed = {}
    for c in names:
        if (shares[c] or 0.0) > COMPACT_SHARE:
            value = F.try_to_timestamp(F.when(strip(F.col(c)).rlike(r"^\d{8}$"), strip(F.col(c))), F.lit("yyyyMMdd"))
        else:
            value = parse_instant(F.col(c))
        parsed[c] = value.cast("timestamp_ntz")
    return df.withColumns(parsed)


def _numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with their file and split; only ``\\n`` ends a line here, so that joined lines are what they were."""
    return spark.read.text(path, lineSep="\n").select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")
    )


def _record_maker(begins_quoted: dict[tuple[str, int], bool]):
    """A function from lines in their order to records and parts of records; it travels by value."""

    def make(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        names = ["file", "block", "number", "kind", "record"]

        def out(rows):
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.string()))], names=names
            )

        # held: lines of the record that is not at its end yet; whole: it began in this split.
        split, held, whole, quoted, number = None, [], True, False, 0
        for batch in batches:
            texts = batch.column(0).fill_null("")
            odd = pc.count_substring(texts, '"').to_numpy(zero_copy_only=False) % 2 == 1
            rows, files, blocks = [], batch.column(1).to_pylist(), batch.column(2).to_pylist()
            for text, flips, file, block in zip(texts.to_pylist(), odd.tolist(), files, blocks):
                if (file, block) != split:
                    if held:
                        rows.append((*split, number, 3 if whole else 2, "\n".join(held)))
                    split, held, number = (file, block), [], 0
                    quoted = begins_quoted.get(split, False)
                    whole = not quoted
                held.append(text)
                quoted ^= flips
                if not quoted:
                    rows.append((*split, number, 0 if whole else 1, "\n".join(held)))
                    held, whole, number = [], True, number + 1
            if rows:
                yield out(rows)
        if held:
            yield out([(*split, number, 3 if whole else 2, "\n".join(held))])

    return make


# Records; ends, middles and beginnings of records that go over a split's border.
_WHOLE, _END, _MIDDLE, _BEGIN = range(4)


def csv_records(spark: SparkSession, path: str) -> DataFrame | None:
    """``record, is_first`` (of its file) of quoted CSV files; None if a file has an odd number of quotes.

    The driver gets one number per split that begins within quotes, of those that it deals out anyway.
    """
    lines = _numbered_lines(spark, path)
    quotes = F.octet_length("value") - F.octet_length(F.replace("value", F.lit('"'), F.lit("")))
    per_split = lines.groupBy("file", "block").agg((F.sum(quotes) % 2).alias("odd"))
    before = Window.partitionBy("file").orderBy("block")
    borders = per_split.select(
        "file", "block", ((F.sum("odd").over(before) - F.col("odd")) % 2).alias("begins"), (F.sum("odd").over(before) % 2).alias("ends"),
        (F.row_number().over(Window.partitionBy("file").orderBy(F.desc("block"))) == 1).alias("last"),
    ).where("begins = 1 OR (last AND ends = 1)").collect()
    if any(r.last and r.ends for r in borders):
        return None
    made = lines.mapInArrow(
        _record_maker({(r.file, r.block): True for r in borders if r.begins}), "file string, block long, number long, kind int, record string"
    )
    first = ((F.col("block") == 0) & (F.col("number") == 0)).alias("is_first")
    done = made.where(F.col("kind") == _WHOLE).select("record", first)
    # A few rows per split: each beginning opens a record, up to the end that follows.
    in_order = Window.partitionBy("file").orderBy("block", "kind")
    parts = made.where(F.col("kind") != _WHOLE).withColumn("opened", F.sum((F.col("kind") == _BEGIN).cast("int")).over(in_order))
    piece = F.struct("block", "kind", "record")
    joined = parts.groupBy("file", "opened").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(piece)), lambda p: p["record"]), "\n").alias("record"),
        F.min_by(F.struct("block", "number"), F.struct("block", "kind")).alias("at"),
    )
    return done.union(joined.select("record", ((F.col("at.block") == 0) & (F.col("at.number") == 0)).alias("is_first")))


def read_quoted_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV files with a header each and quotes that are doubled within fields, as text columns.

    A file with an odd number of quotes is not of that kind; then all are read by Spark's own reader, a task per file.
    """
    records = csv_records(spark, path)
    head = records.where("is_first").select("record").sort("record").first() if records is not None else None
    if head is None:
        return spark.read.csv(path, header=True, escape='"', multiLine=True)
    # A header that ends with \r is of files with such line ends, also within quotes.
    text = F.col("record")
    if head.record.endswith("\r"):
        text = F.replace(F.rtrim("record", F.lit("\r")), F.lit("\r\n"), F.lit("\n"))
    names = next(csv.reader([head.record.rstrip("\r").removeprefix("\ufeff")]))
    schema = ", ".join(f"_c{i} STRING" for i in range(len(names)))
    fields = F.from_csv("record", schema, {"escape": '"', "maxCharsPerColumn": "-1"})
    rows = records.where(~F.col("is_first")).select(text.alias("record")).where("record != ''")
    return rows.select(fields.alias("row")).select("row.*").toDF(*names)


def read_csv_mart(spark: SparkSession, base: str, name: str) -> DataFrame:
    """A mart's CSV as text columns with dates parsed; a frame without columns if it is missing."""
    try:
        df = read_quoted_csv(spark, f"{base.rstrip('/')}/{name}.csv")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], T.StructType([]))
    return coerce_dates(strip_column_names(df))


def read_csv_marts(spark: SparkSession, base: str, names: Sequence[str]) -> dict[str, DataFrame]:
    return {name: read_csv_mart(spark, base, name) for name in names}
