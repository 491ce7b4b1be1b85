"""The daily jobs: one table and day to its partition, all marts, and the extracts."""

from __future__ import annotations

import argparse
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from pledgemart import sinks
from pledgemart.functions.text import DEFAULT_LEXICON, Lexicon
from pledgemart.functions.times import normalize_dt
from pledgemart.operators.dedup import keep_last
from pledgemart.operators.quality import (
    lacks_required_key, null_counts, split_valid_and_error, validation_metrics,
)
from pledgemart.plans import gold
from pledgemart.plans.silver import Settings, load_transform
from pledgemart.registry import get_schema
from pledgemart.session import build_session, configure, require_utc
from pledgemart.sources.landing import read_records

AUTOMATED_TABLES = ["preorder", "comments", "supporter", "fundings", "wishes", "user_info"]
EMPTY_INPUT = 2


def shared_folder(spark: SparkSession) -> str:
    """Where intermediate tables go: the folder the session names."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    return named.rstrip("/")


def _remove(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@dataclass(frozen=True)
class SilverRun:
    table: str
    dt: str
    exit_code: int
    metrics: dict = field(default_factory=dict)
    output_path: str | None = None
    error_path: str | None = None


def _observed(df: DataFrame, metrics: list[Column]) -> tuple[DataFrame, Observation]:
    observation = Observation(uuid.uuid4().hex)
    return df.observe(observation, *metrics), observation


def run_silver(
    spark: SparkSession,
    *,
    table: str,
    dt: str,
    landing_base: str,
    silver_base: str,
    error_base: str,
    hash_salt: str = "",
    lexicon: Lexicon = DEFAULT_LEXICON,
    processed_at: datetime | None = None,
    dry_run: bool = False,
    allow_empty: bool = False,
    write_errors: bool = True,
) -> SilverRun:
    """Read one landed day, build its table, set rows without keys aside, replace the partitions.

    The landed files are parsed once. The result goes to an intermediate table, which survives
    lost executors and feeds both writes; the metrics are taken along in that same job. Of them
    ``read_rows``, ``duplicate_rows`` and ``keyless_rows_before_dedup`` may count rows of a
    repeated task twice; ``operators.quality.quality_metrics`` gives exact ones.
    """
    configure(spark)
    require_utc(spark)
    dt, schema = normalize_dt(dt), get_schema(table)
    records = read_records(spark, landing_base, table, dt)
    settings = Settings(hash_salt=hash_salt, lexicon=lexicon, processed_at=processed_at)
    conformed = load_transform(table)(records, dt, settings)
    conformed, before = _observed(
        conformed,
        [
            F.count(F.lit(1)).alias("read_rows"),
            F.count_if(lacks_required_key(conformed, schema)).alias("keyless_rows_before_dedup"),
        ],
    )
    rows = keep_last(conformed, schema.dedup_keys).select(*schema.columns)
    rows, after = _observed(rows, validation_metrics(rows, schema) + null_counts(rows))

    staging = None
    if dry_run:
        rows.write.format("noop").mode("overwrite").save()
    else:
        staging = f"{shared_folder(spark)}/silver-{table}-{dt}-{uuid.uuid4().hex}"
        rows.write.parquet(staging)
    try:
        metrics = {**before.get, **after.get}
        metrics["duplicate_rows"] = metrics["read_rows"] - metrics["input_rows"]
        if metrics["read_rows"] == 0 and not allow_empty:
            return SilverRun(table, dt, EMPTY_INPUT, metrics)
        if dry_run:
            return SilverRun(table, dt, 0, metrics)
        staged = spark.read.schema(schema.struct()).parquet(staging)
        valid, errors = split_valid_and_error(staged, schema)
        output = sinks.overwrite_partition(valid, silver_base, table, dt, schema.sort_keys)
        error_path = None
        if write_errors:
            # Also when there are none, so that errors of an earlier run do not stay behind.
            error_path = sinks.overwrite_partition(errors, error_base, table, dt)
        return SilverRun(table, dt, 0, metrics, output, error_path)
    finally:
        if staging is not None:
            _remove(spark, staging)


def run_gold(
    spark: SparkSession,
    *,
    silver: Callable[[str], DataFrame],
    gold_base: str,
    database: str | None = None,
    as_of_dt: str | None = None,
) -> dict[str, str]:
    """Rebuild the six marts. The two that build on the campaign mart read it as written."""
    configure(spark)
    paths = {}

    def write(mart: str, df: DataFrame) -> None:
        paths[mart] = sinks.write_mart(df, gold_base, mart, database)

    preorder, comments = silver("preorder"), silver("comments")
    write("campaign_kpi", gold.campaign_kpi(preorder, silver("supporter"), silver("wishes"), comments, as_of_dt))
    campaign_kpi = spark.read.parquet(paths["campaign_kpi"])
    write("campaign_daily_kpi", gold.campaign_daily_kpi(preorder, as_of_dt))
    write("campaign_conversion_kpi", gold.campaign_conversion_kpi(campaign_kpi, silver("fundings"), as_of_dt))
    write("comment_nlp_kpi", gold.comment_nlp_kpi(comments, as_of_dt))
    write("campaign_response_performance", gold.campaign_response_performance(comments, as_of_dt))
    write("campaign_category_benchmark", gold.campaign_category_benchmark(campaign_kpi))
    if database is not None:
        sinks.create_public_views(spark, database, gold.MARTS)
    return paths


def run_export(spark: SparkSession, *, gold_base: str, export_base: str) -> dict[str, str]:
    """Extract every public view as text."""
    out = {}
    for mart in gold.MARTS:
        view = gold.public_view(mart, spark.read.parquet(f"{gold_base.rstrip('/')}/{mart}"))
        out[mart] = sinks.export_extract(view, f"{export_base.rstrip('/')}/{mart}")
    return out


def main(argv: list[str] | None = None) -> int:
    """``spark-submit`` entry: ``jobs.py silver|gold|export --…``."""
    parser = argparse.ArgumentParser(description="Run a daily job.")
    steps = parser.add_subparsers(dest="step", required=True)
    one_day = steps.add_parser("silver")
    one_day.add_argument("--table", required=True, choices=AUTOMATED_TABLES)
    one_day.add_argument("--dt", required=True)
    for name in ("landing-base", "silver-base", "error-base"):
        one_day.add_argument(f"--{name}", required=True)
    one_day.add_argument("--hash-salt", default="")
    one_day.add_argument("--dry-run", action="store_true")
    one_day.add_argument("--allow-empty", action="store_true")
    one_day.add_argument("--no-error-rows", action="store_true")
    marts = steps.add_parser("gold")
    marts.add_argument("--silver-base", required=True)
    marts.add_argument("--gold-base", required=True)
    marts.add_argument("--database")
    marts.add_argument("--as-of-dt", help="only days up to this one")
    extract = steps.add_parser("export")
    extract.add_argument("--gold-base", required=True)
    extract.add_argument("--export-base", required=True)
    args = parser.parse_args(argv)

    spark = build_session(f"pledgemart-{args.step}")
    if args.step == "silver":
        run = run_silver(
            spark, table=args.table, dt=args.dt, landing_base=args.landing_base, silver_base=args.silver_base,
            error_base=args.error_base, hash_salt=args.hash_salt, dry_run=args.dry_run,
            allow_empty=args.allow_empty, write_errors=not args.no_error_rows,
        )
        print(run)
        return run.exit_code
    if args.step == "gold":
        print(run_gold(
            spark, silver=lambda table: sinks.read_partitioned(spark, args.silver_base, table),
            gold_base=args.gold_base, database=args.database, as_of_dt=args.as_of_dt,
        ))
    else:
        print(run_export(spark, gold_base=args.gold_base, export_base=args.export_base))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
