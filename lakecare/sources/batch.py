"""Batch readers: declared schemas, run-date folders, incremental extracts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from lakecare.functions.clock import AsOf, run_date_folder

CORRUPT = "_corrupt_record"


def bind_by_name(df: DataFrame, schema: StructType) -> DataFrame:
    """Declared columns in declared order; a column the source lacks is null."""
    present = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def read_csv(spark: SparkSession, path: str, schema: StructType, lineage: bool = False) -> DataFrame:
    """Headered CSV. The header must agree with the schema, and the word NULL is null.

    A directory is one scan, split over tasks by size; ``lineage`` adds the source file.
    """
    df = (
        spark.read.schema(schema)
        .option("header", "true")
        .option("enforceSchema", "false")
        .option("nullValue", "NULL")
        .csv(path)
    )
    return df.withColumn("_source_file", F.col("_metadata.file_path")) if lineage else df


def read_bronze(
    spark: SparkSession, base: str, table: str, run_date: date | str, schema: StructType, fmt: str = "csv"
) -> DataFrame:
    """One run-date folder of a landed table, as CSV or Parquet."""
    path = f"{base}/{table}/{run_date_folder(run_date)}"
    if fmt == "csv":
        return read_csv(spark, path, schema)
    return bind_by_name(spark.read.format(fmt).load(path), schema)


def read_landed_json(
    spark: SparkSession, base: str, run_date: date | str, schema: StructType, source: str | None = None
) -> DataFrame:
    """Landed API payloads; a record that does not parse is kept in ``_corrupt_record``."""
    folder = f"{base}/source={source}" if source else base
    kept = StructType([*schema.fields, StructField(CORRUPT, StringType())])
    return (
        spark.read.schema(kept)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .json(f"{folder}/{run_date_folder(run_date)}")
    )


def incremental_filter(df: DataFrame, column: str, watermark: object | None, inclusive: bool = False) -> DataFrame:
    """Rows past the watermark; no watermark yet means a full load.

    ``inclusive`` rereads rows at the watermark itself: where it is a day, more rows may have
    been stamped with it after the last extract, and an upsert absorbs the repeated ones.
    """
    if watermark is None:
        return df
    return df.where(F.col(column) >= F.lit(watermark) if inclusive else F.col(column) > F.lit(watermark))


def jdbc_options(
    url: str, table: str, column: str, lower: AsOf, upper: AsOf, tasks: int, extra: Mapping[str, str] | None = None
) -> dict[str, str]:
    """Options of a JDBC scan read by ``tasks`` parallel queries over the watermark column."""
    return {
        "url": url,
        "dbtable": table,
        "partitionColumn": column,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(tasks),
        "pushDownPredicate": "true",
        **(extra or {}),
    }


def read_jdbc_increment(
    spark: SparkSession,
    url: str,
    table: str,
    columns: Sequence[str],
    column: str,
    watermark: AsOf | None,
    until: AsOf,
    floor: AsOf = "2000-01-01",
    tasks: int = 32,
    extra: Mapping[str, str] | None = None,
) -> DataFrame:
    """Changed rows of a relational table. Projection and filter are pushed to the database;
    the bounds (``floor`` on a first, full load) only place rows in tasks and drop none."""
    lower = floor if watermark is None else watermark
    options = jdbc_options(url, table, column, lower, until, tasks, extra)
    scan = spark.read.format("jdbc").options(**options).load()
    return incremental_filter(scan.select(*columns), column, watermark)
