"""Data-quality measures; each is one pass over its input."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, StructType

from lakecare.functions.rules import date_shaped


class EmptySourceError(RuntimeError):
    """A gated source delivered no rows."""


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column: nulls found and whether that deserves a warning."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_count")) for c in columns])
    return counted.select(F.inline(pairs)).withColumn("warn", F.col("null_count") > 0)


def drop_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(keys))


def date_format_flags(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Add ``<column>_valid`` per column."""
    return df.withColumns({f"{c}_valid": date_shaped(F.col(c)) for c in columns})


def non_empty_gate(sources: Mapping[str, DataFrame]) -> DataFrame:
    """Row count per named source and whether it passes; one job for all sources."""
    counted = [
        df.agg(F.count(F.lit(1)).alias("rows_copied")).select(F.lit(name).alias("source"), "rows_copied")
        for name, df in sources.items()
    ]
    return reduce(DataFrame.unionAll, counted).withColumn("passed", F.col("rows_copied") > 0)


def gate_alerts(gate: DataFrame, pipeline: str, run_id: str) -> DataFrame:
    """Alert rows for the sources that failed the gate."""
    return gate.where(~F.col("passed")).select(
        F.lit(pipeline).alias("pipeline"),
        F.concat(F.lit("No data ingested from "), "source").alias("message"),
        F.lit(run_id).alias("run_id"),
    )


def require_non_empty(sources: Mapping[str, DataFrame]) -> None:
    failed = [r["source"] for r in non_empty_gate(sources).where(~F.col("passed")).collect()]
    if failed:
        raise EmptySourceError(", ".join(sorted(failed)))


def row_hash(schema: StructType) -> Column:
    """A hash of a whole row; a null counts by its place, not only by its absence, a map by its sorted entries."""
    columns = [F.col(f"`{f.name}`") for f in schema.fields]
    shown = [
        F.array_sort(F.map_entries(c)) if isinstance(f.dataType, MapType) else c
        for c, f in zip(columns, schema.fields, strict=True)
    ]
    return F.xxhash64(*shown, *[c.isNull() for c in columns])


def content_measures(schema: StructType) -> list[Column]:
    """Row count and an order-free checksum."""
    return [F.count(F.lit(1)).alias("rows"), F.sum(row_hash(schema).cast("decimal(20,0)")).alias("checksum")]
