"""Ingestion job: an incremental extract, landed, checked, logged, and its watermark moved."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakecare.functions.clock import AsOf, run_date_folder
from lakecare.operators.quality import EmptySourceError
from lakecare.sinks.tables import RUN_LOG, log_run, logged_copy, path_exists
from lakecare.sources.control import load_watermark, store_watermark
from lakecare.sources.rescue import convert

#: What tells landed rows apart: a digest of all source columns as they were extracted.
ROW_DIGEST = "_row_digest"


def rows_logged(spark: SparkSession, log: str, pipeline: str, run_id: str) -> int | None:
    """Rows that a successful run copied; None if it has no such record."""
    if not path_exists(spark, log):
        return None
    done = succeeded(spark, log, pipeline).where(F.col("run_id") == run_id)
    return done.agg(F.max("rows_copied").alias("rows")).first()["rows"]


def succeeded(spark: SparkSession, log: str, pipeline: str) -> DataFrame:
    done = (F.col("pipeline_name") == pipeline) & (F.col("status") == "Succeeded")
    return spark.read.schema(RUN_LOG).parquet(log).where(done)


def overlap_start(watermark: object, days: int) -> object:
    """The watermark moved back; text that holds no date stays as it is."""
    if isinstance(watermark, str):
        try:
            moved = date.fromisoformat(watermark[:10]) - timedelta(days=days)
        except ValueError:
            return watermark
        return f"{moved}{watermark[10:]}"
    return watermark - timedelta(days=days)


def row_digest(columns: list[str]) -> Column:
    """The same for rows that agree in every column, nulls included."""
    return F.md5(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}))


def _in_overlap(column: str, start: object) -> Column:
    """Rows at or past the start, and those without a stamp, which no watermark can tell old from new."""
    return F.col(column).isNull() | (F.col(column) >= F.lit(start))


def landed_digests(spark: SparkSession, bronze: str, log: str, table: str, column: str, start: object) -> DataFrame:
    """(digest, landed) of the rows that successful runs have landed from ``start`` on."""
    root = f"{bronze}/{table}"
    if not (path_exists(spark, root) and path_exists(spark, log)):
        return spark.createDataFrame([], f"{ROW_DIGEST} string, landed bigint")
    rows = spark.read.option("recursiveFileLookup", "true").parquet(root)
    run = F.regexp_extract(F.col("_metadata.file_path"), r"/run_id=([^/]+)/", 1)
    kept = rows.where(_in_overlap(f"_stamp_{column}", start)).select(ROW_DIGEST, run.alias("run_id"))
    ended = succeeded(spark, log, table).select("run_id").distinct()
    return kept.join(ended, "run_id", "left_semi").groupBy(ROW_DIGEST).agg(F.count(F.lit(1)).alias("landed"))


def only_new(batch: DataFrame, landed: DataFrame) -> DataFrame:
    """Rows of ``batch`` beyond the copies already landed, with their digest.

    Equal rows are counted before they are shuffled, so a row that comes a million times travels once per task.
    """
    columns = batch.columns
    counted = batch.groupBy(*columns).agg(F.count(F.lit(1)).alias("_copies")).withColumn(ROW_DIGEST, row_digest(columns))
    left = counted.join(landed, ROW_DIGEST, "left").withColumn("_left", F.col("_copies") - F.coalesce("landed", F.lit(0)))
    spread = left.where("_left > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_left"))))
    return spread.select(*columns, ROW_DIGEST)


def ingest_increment(
    spark: SparkSession,
    source: DataFrame,
    table: str,
    column: str,
    bronze: str,
    control: str,
    log: str,
    run_date: AsOf,
    run_id: str,
    at: datetime,
    types: Mapping[str, str] | None = None,
    allow_empty: bool = False,
    lookback_days: int = 0,
) -> int:
    """Land the rows of ``source`` that no run has landed yet; returns their number.

    Rows are extracted from ``lookback_days`` before the table's watermark on, and those without a stamp
    always; of them, rows that a successful run has landed already are left out by their digest. So a row
    committed late is read once, as long as its stamp lies within the lookback, and rows at the
    watermark itself are not landed twice. Without a new row the gate raises, and logs the failure.

    Typed landing, copy check, run record and watermark follow in this order. Every run lands in a
    folder of its own below the run date's. A run that failed is repeated with its id; one that
    succeeded is not copied again, only its watermark is stored once more, which mends a stop between
    the two and never moves it back. ``types`` converts columns on landing; cells that do not
    convert are null and kept as text in ``_rescued``.
    """
    path = f"{bronze}/{table}/{run_date_folder(run_date)}/run_id={run_id}"
    copied = rows_logged(spark, log, table, run_id)
    stamp = f"_stamp_{column}"
    if copied is None:
        watermark = load_watermark(spark, control, table)
        batch = source
        if watermark is not None:
            start = overlap_start(watermark, lookback_days)
            landed = landed_digests(spark, bronze, log, table, column, start)
            batch = only_new(source.where(_in_overlap(column, start)), landed)
        else:
            batch = batch.withColumn(ROW_DIGEST, row_digest(source.columns))
        batch = batch.withColumn(stamp, F.col(column))
        if not allow_empty and batch.isEmpty():
            log_run(spark, log, table, run_id, "Failed", 0, at)
            raise EmptySourceError(table)
        if types:
            batch = convert(batch, types)
        copied = logged_copy(batch, path, log, table, run_id, at)
    if copied:
        store_watermark(spark, control, spark.read.parquet(path), table, stamp)
    return copied
