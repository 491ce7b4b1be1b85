"""Landed JSON files of one table and day, as one row per record.

A record row is ``record VARIANT, parent MAP<STRING,STRING>, source_key STRING, read_order
STRUCT``. ``read_order`` follows the order in which files, lines and list items are read:
compact ``dt=`` folder before dashed one, then path, then position. The keep-last dedup
relies on it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pledgemart import fixed_values as fv
from pledgemart.functions.casts import strip
from pledgemart.functions.times import dashed_dt, normalize_dt

# The most bytes of JSON that Spark holds in one VARIANT.
MAX_DOCUMENT_BYTES = 128 << 20

#: Names of landed files.
NAMES = "*.{json,json.gz,jsonl}"
_FILES = "text string, source_key string, path_rank int, block_start bigint, line_no bigint"


def day_folders(base: str, table: str, dt: str) -> str:
    return f"{base.rstrip('/')}/{table}/dt={{{normalize_dt(dt)},{dashed_dt(dt)}}}"


def read_files(spark: SparkSession, base: str, table: str, dt: str, files: Sequence[str] | None = None) -> DataFrame:
    """Text of the day's ``.json``, ``.jsonl`` and ``.json.gz`` files below both spellings of ``dt``.

    The first line of a file decides how it is read, not its ending or size. A file whose first line
    stands alone as a document is read by line, so that Spark can split it and holds a line at a time;
    every other file is one row. Files are told apart by one look at their first lines; then each is
    read in its own way only, as a filter on the file's name never opens the others. ``files`` limits
    the day to some of its files.
    """
    if files is not None and not files:
        return spark.createDataFrame([], _FILES)
    root = day_folders(base, table, dt)
    path = F.col("_metadata.file_path")
    shared = [
        F.try_url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))).alias("source_key"),
        F.when(path.contains(f"/dt={dashed_dt(dt)}/"), 1).otherwise(0).alias("path_rank"),
    ]
    whole_place = [F.lit(-1).cast("bigint").alias("block_start"), F.lit(0).cast("bigint").alias("line_no")]
    # Within a split, ids grow with the line; splits of a file are told apart by their start.
    line_place = [F.col("_metadata.file_block_start").alias("block_start"), F.monotonically_increasing_id().alias("line_no")]

    def text(**options) -> DataFrame:
        return spark.read.options(pathGlobFilter=NAMES, recursiveFileLookup=True).text(root, **options)

    try:
        by_line, whole = text(), text(wholetext=True)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _FILES)
    if files is not None:
        by_line, whole = (df.where(path.isin(list(files))) for df in (by_line, whole))
    # As many names as there are files that are one document; the file listing holds all names anyway.
    documents = [row.path for row in _documents(by_line.select(F.col("value").alias("text"), path.alias("path"), *line_place)).collect()]
    one = path.isin(documents) if documents else F.lit(False)
    lines = by_line.where(~one) if documents else by_line
    return lines.select(F.col("value").alias("text"), *shared, *line_place).unionByName(
        whole.where(one).select(F.col("value").alias("text"), *shared, *whole_place)
    )


def _documents(lines: DataFrame) -> DataFrame:
    """``path`` of files whose first line that is not blank is no document of its own."""
    first = F.min_by("text", F.struct("block_start", "line_no"))
    heads = lines.where(F.col("text").rlike(r"\S")).groupBy("path").agg(first.alias("head"))
    # A column of its own, so that the filter is not pushed below the parsing.
    return heads.select("path", _only(_as_items(F.make_valid_utf8("head"))).isNull().alias("odd")).where("odd").select("path")


def _as_items(text: Column) -> Column:
    """The text as the items of a JSON list; NULL if that is not JSON.

    Parsing stops silently after the first document. In a list, a second document or trailing
    junk breaks the list or makes it longer, so only a list of one stands for a sound text.
    """
    return F.try_parse_json(F.concat(F.lit("["), text, F.lit("]"))).try_cast("array<variant>")


def _only(items: Column) -> Column:
    return F.when(F.size(items) == 1, F.get(items, F.lit(0)))


def _padded(text: Column) -> Column:
    """Whether a field name may have spaces around it, which is rare, and worth a rewrite only then."""
    return text.rlike(r'\s"\s*:|"\s[^"]*"\s*:')


def _units_of(texts: Column) -> Column:
    """(doc, padded) per text; ``doc`` is NULL where a text is not exactly one JSON document."""
    read = F.transform(texts, lambda t: F.struct(_as_items(t).alias("items"), _padded(t).alias("padded")))
    return F.transform(read, lambda u: F.struct(_only(u["items"]).alias("doc"), u["padded"].alias("padded")))


def parse_documents(files: DataFrame, keep_bad: bool = False, max_document_bytes: int = MAX_DOCUMENT_BYTES) -> DataFrame:
    """One row per JSON document: the whole text if it is one document, else one per line.

    Blank lines are skipped and unreadable lines dropped, or kept with a NULL ``doc`` on request. A
    text that may be one document but is too large to be held as such stops the job with its file's
    name: it is as a whole above the limit, or a line of it is.

    All that is told of a unit is told from its own text before the units become rows: behind that, an
    expression over the text would run once per row and cost the square of a file's lines.
    """
    by_line = F.col("block_start") >= 0
    unit = "struct<doc:variant,padded:boolean>"
    located = files.withColumn("text", F.make_valid_utf8("text"))
    parsed = located.withColumn("whole", _only(_as_items(F.col("text"))))
    # Spaces around a document are left to the parser: trimming a large text is costly. The lines are a column
    # of their own, split once, and only of a text that is not a document.
    lines = F.filter(F.split("text", r"\r\n|\n|\r"), lambda line: line.rlike(r"\S"))
    parsed = parsed.withColumn("lines", F.when(F.col("whole").isNull() & ~by_line, lines))
    too_large = F.raise_error(F.concat(F.lit("a JSON document above Spark's size limit, land it in parts: "), "source_key"))
    # Only what one VARIANT could not hold is looked at closer: lines stand alone, a document does not.
    is_large = F.octet_length("text") > max_document_bytes
    first_stands = _only(_as_items(F.get("lines", F.lit(0)))).isNotNull() & (F.size("lines") > 1)
    long_line = F.exists("lines", lambda line: F.octet_length(line) > max_document_bytes)
    units = (
        F.when(F.col("whole").isNotNull(), F.array(F.struct(F.col("whole").alias("doc"), _padded(F.col("text")).alias("padded"))))
        .when(is_large & (by_line | ~first_stands | long_line), too_large.cast(f"array<{unit}>"))
        .when(by_line & ~F.col("text").rlike(r"\S"), F.array().cast(f"array<{unit}>"))
        .when(by_line, F.array(F.lit(None).cast(unit)))
        .otherwise(_units_of(F.col("lines")))
    )
    docs = parsed.select("source_key", "path_rank", "block_start", "line_no", F.posexplode(units).alias("unit", "held"))
    docs = docs.select("source_key", "path_rank", "block_start", "line_no", F.coalesce("held.padded", F.lit(False)).alias("padded"), "unit", F.col("held.doc").alias("doc"))
    return docs if keep_bad else docs.where(F.col("doc").isNotNull())


def _wrapped_list(item: str, fields: list[str]) -> Column:
    return F.coalesce(*[F.try_variant_get(item, f"$.{f}", "array<variant>") for f in fields])


def _is_nested(value: Column) -> Column:
    return value.try_cast("array<variant>").isNotNull() | value.try_cast("struct<x:string>").isNotNull()


def _scalars(item: Column, fields: Sequence[str] | None) -> Column:
    """The scalar fields of an object as text: the named ones, or all of them."""
    if fields is None:
        flat = F.map_filter(item.try_cast("map<string,variant>"), lambda _, v: ~_is_nested(v))
        return F.transform_values(flat, lambda _, v: v.try_cast("string"))
    pairs = []
    for name in fields:
        value = F.try_variant_get(item, f"$.{name}", "variant")
        pairs += [F.lit(name), F.when(~_is_nested(value), value.try_cast("string"))]
    return F.create_map(*pairs)


def unwrap_records(
    docs: DataFrame, *, unwrap_items: bool = False, parent_fields: Sequence[str] | None = None
) -> DataFrame:
    """Documents to records.

    A list gives its items. An object gives the items of its first wrapper field that holds a
    list, each with the object's scalars as ``parent``; else the object itself. A scalar becomes
    ``{"raw_value": x}``. With ``unwrap_items`` the objects inside a list are unwrapped too.
    ``parent_fields`` limits the context to the scalars a table reads.
    """
    items = docs.withColumn("items", F.col("doc").try_cast("array<variant>"))
    items = items.select(
        "source_key", "path_rank", "block_start", "line_no", "unit", "padded",
        F.col("items").isNull().alias("is_single"),
        F.posexplode(F.coalesce("items", F.array("doc"))).alias("item_no", "item"),
    )
    # All wrapper fields in one pass over the item, in a projection of its own; then the first list.
    held = F.col("item").try_cast("struct<" + ",".join(f"{f}:variant" for f in fv.WRAPPER_LIST_FIELDS) + ">")
    items = items.withColumn("held", held if unwrap_items else F.when(F.col("is_single"), held))
    lists = [F.col(f"held.{f}").try_cast("array<variant>") for f in fv.WRAPPER_LIST_FIELDS]
    items = items.withColumn("children", F.coalesce(*lists))
    records = items.select(
        "source_key", "padded",
        F.when(F.col("children").isNotNull(), _scalars(F.col("item"), parent_fields)).alias("parent"),
        F.struct("path_rank", "source_key", "block_start", "line_no", "unit", "item_no").alias("place"),
        F.posexplode(F.coalesce("children", F.array("item"))).alias("child_no", "value"),
    )
    is_object = F.col("value").try_cast("struct<raw_value:string>").isNotNull()
    fields = F.col("value").try_cast("map<string,variant>")
    trimmed = F.parse_json(F.to_json(F.transform_keys(fields, lambda k, _: strip(k))))
    scalar = F.parse_json(F.to_json(F.struct(F.col("value").alias("raw_value"))))
    record = F.when(~is_object, scalar).when(F.col("padded"), trimmed).otherwise(F.col("value"))
    return records.select(
        record.alias("record"),
        "parent",
        "source_key",
        F.struct("place.*", "child_no").alias("read_order"),
    )


def with_file_position(df: DataFrame) -> DataFrame:
    """Give any frame of ``text, source_key`` the position columns of ``read_files``."""
    return df.select(
        "text", "source_key", F.lit(0).alias("path_rank"),
        F.lit(-1).cast("bigint").alias("block_start"), F.lit(0).cast("bigint").alias("line_no"),
    )


def read_records(spark: SparkSession, base: str, table: str, dt: str, files: Sequence[str] | None = None) -> DataFrame:
    """Records of one landed table and day, or of some of its files."""
    return records_of_table(parse_documents(read_files(spark, base, table, dt, files)), table)


def records_of_table(docs: DataFrame, table: str) -> DataFrame:
    """Records with the unwrapping and the parent context the table's transform expects."""
    return unwrap_records(
        docs, unwrap_items=table in fv.TABLES_OF_WRAPPERS, parent_fields=fv.PARENT_FIELDS
    )


def count_bad_lines(spark: SparkSession, base: str, table: str, dt: str) -> DataFrame:
    """Unreadable lines per file."""
    docs = parse_documents(read_files(spark, base, table, dt), keep_bad=True)
    return docs.where(F.col("doc").isNull()).groupBy("source_key").agg(F.count(F.lit(1)).alias("bad_lines"))
