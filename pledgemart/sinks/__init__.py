"""Writers: day partitions, marts, public views, extracts and landed fixtures."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from pledgemart import fixed_values as fv
from pledgemart.functions.times import normalize_dt
from pledgemart.operators.dedup import sort_for_write
from pledgemart.registry import get_schema


def partition_path(base: str, table: str, dt: str) -> str:
    return f"{base.rstrip('/')}/{table}/dt={normalize_dt(dt)}"


def overwrite_partition(
    df: DataFrame, base: str, table: str, dt: str, sort_keys: Sequence[str] = (), max_rows_per_file: int = 0
) -> str:
    """Replace one day of a table.

    The day's own folder is overwritten: a dynamic partition overwrite would leave the old day
    in place when the new one is empty.
    """
    path = partition_path(base, table, dt)
    rows = sort_for_write(df, sort_keys) if sort_keys else df
    rows.drop("dt").write.mode("overwrite").option("maxRecordsPerFile", max_rows_per_file).parquet(path)
    return path


def read_partitioned(spark: SparkSession, base: str, table: str) -> DataFrame:
    """All days of a daily table, with ``dt`` as text from the path."""
    return spark.read.schema(get_schema(table).struct()).parquet(f"{base.rstrip('/')}/{table}")


def register_daily_table(spark: SparkSession, database: str, base: str, table: str) -> None:
    """Declare a daily table over its folder and pick up its days."""
    schema = get_schema(table)
    columns = ", ".join(f"{c} {t}" for c, t in schema.types.items())
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {database}.{table} ({columns}) USING parquet "
        f"PARTITIONED BY (dt) LOCATION '{base.rstrip('/')}/{table}'"
    )
    spark.sql(f"MSCK REPAIR TABLE {database}.{table}")


def write_mart(df: DataFrame, base: str, mart: str, database: str | None = None) -> str:
    """Rebuild a mart as a whole, as files only or also as a table of the database."""
    path = f"{base.rstrip('/')}/{mart}"
    writer = df.write.mode("overwrite").format("parquet")
    if database is None:
        writer.save(path)
    else:
        df.sparkSession.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
        writer.option("path", path).saveAsTable(f"{database}.{mart}")
    return path


def publish_mart(df: DataFrame, base: str, mart: str, database: str) -> str:
    """Rebuild a mart so that no reader sees it half done, nor fails because files went away under it.

    The rows go to a folder of their own; then one change of the catalogue points the table there. A reader that
    has planned its query keeps the old folder, which ``drop_old_versions`` removes later. A mart whose columns
    change is declared anew, which takes two changes of the catalogue.
    """
    spark, table = df.sparkSession, f"{database}.{mart}"
    path = f"{base.rstrip('/')}/{mart}/version={uuid.uuid4().hex}"
    df.write.parquet(path)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    same = spark.catalog.tableExists(table) and [(f.name, f.dataType) for f in spark.table(table).schema] == [(f.name, f.dataType) for f in df.schema]
    if same:
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
        spark.catalog.refreshTable(table)
    else:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        spark.catalog.createTable(table, path, source="parquet")
    return path


def publish_day(df: DataFrame, base: str, table: str, dt: str, database: str) -> str:
    """Replace one day of a registered daily table in the same way: write aside, then point the day there.

    Such days are read through the catalogue; the folder of the table itself only has days of ``overwrite_partition``.
    """
    spark, day = df.sparkSession, normalize_dt(dt)
    path = f"{base.rstrip('/')}/_versions/{table}/{day}-{uuid.uuid4().hex}"
    df.drop("dt").write.parquet(path)
    spark.sql(f"ALTER TABLE {database}.{table} ADD IF NOT EXISTS PARTITION (dt='{day}') LOCATION '{path}'")
    spark.sql(f"ALTER TABLE {database}.{table} PARTITION (dt='{day}') SET LOCATION '{path}'")
    spark.catalog.refreshTable(f"{database}.{table}")
    return path


def drop_old_versions(spark: SparkSession, base: str, mart: str, database: str) -> list[str]:
    """Remove the folders of a mart that its table does not point at; call it when no reader needs them any more."""
    rows = spark.sql(f"DESCRIBE FORMATTED {database}.{mart}").where("col_name = 'Location'").collect()
    now = rows[0].data_type.rstrip("/").rsplit("/", 1)[-1]
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{base.rstrip('/')}/{mart}")
    files, gone = folder.getFileSystem(spark._jsc.hadoopConfiguration()), []
    for status in files.listStatus(folder):
        name = status.getPath().getName()
        if name.startswith("version=") and name != now:
            files.delete(status.getPath(), True)
            gone.append(name)
    return gone


def create_public_views(spark: SparkSession, database: str, marts: Sequence[str]) -> list[str]:
    names = []
    for mart in marts:
        columns = ", ".join(fv.PUBLIC_CAMPAIGN_COLUMNS) if mart == "campaign_kpi" else "*"
        name = f"{database}.{mart}_public"
        spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT {columns} FROM {database}.{mart}")
        names.append(name)
    return names


def as_text(df: DataFrame) -> DataFrame:
    """Every column as text, NULL as ''."""
    return df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in df.columns])


def export_extract(df: DataFrame, path: str) -> str:
    """A CSV extract with a header, replacing the one before."""
    options = {"header": True, "emptyValue": "", "escape": '"'}  # quotes are doubled, as readers of CSV expect
    as_text(df).write.mode("overwrite").options(**options).csv(path)
    return path


def export_campaign(df: DataFrame, campaign_id: str, path: str) -> str:
    """A CSV extract of one campaign's rows."""
    from pledgemart.plans.present import for_campaign

    return export_extract(for_campaign({"t": df}, campaign_id)["t"], path)


def land_records(
    df: DataFrame, base: str, table: str, dt: str, hour: str = "00", rows_per_file: int = 50000
) -> str:
    """Land rows as JSON lines under ``dt`` and ``hour``, in files of a bounded number of rows."""
    path = f"{base.rstrip('/')}/{table}"
    placed = df.withColumns({"dt": F.lit(normalize_dt(dt)), "hour": F.lit(hour)})
    placed.write.mode("append").partitionBy("dt", "hour").option("maxRecordsPerFile", rows_per_file).json(path)
    return path
