"""Control table: how far each incremental extract has read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakecare.functions import rules
from lakecare.sinks.tables import read_table, table_exists, upsert_table


def watermark_lookup(control: DataFrame, table_name: str) -> DataFrame:
    """One row ``last_watermark``; null when the table was never loaded."""
    return control.where(F.col("table_name") == table_name).agg(
        F.max("last_modified_date").alias("last_watermark")
    )


def batch_watermark(batch: DataFrame, table_name: str, column: str) -> DataFrame:
    """The control row after a batch: the newest row time it holds, not the time of the run.

    The run time would skip rows stamped before it but committed after the extract. Text
    that is no date never becomes the watermark.
    """
    text = dict(batch.dtypes)[column] == "string"
    readable = rules.parsed_date(F.col(column)).isNotNull() if text else F.col(column).isNotNull()
    return (
        batch.where(readable).agg(F.max(column).alias("last_modified_date"))
        .where("last_modified_date is not null")
        .select(F.lit(table_name).alias("table_name"), "last_modified_date")
    )


def load_watermark(spark: SparkSession, path: str, table_name: str) -> object | None:
    if not table_exists(spark, path):
        return None
    return watermark_lookup(read_table(spark, path), table_name).first()["last_watermark"]


def store_watermark(spark: SparkSession, path: str, batch: DataFrame, table_name: str, column: str) -> None:
    """An empty batch leaves the control table as it is, and an older one too: a watermark never moves back."""
    moved = batch_watermark(batch, table_name, column)
    upsert_table(spark, path, moved, ["table_name"], newer_by="last_modified_date", unique=True)
