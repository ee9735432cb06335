"""Cells that do not convert are kept beside the row, and rows that cannot do without them are set apart."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType, StructField, StructType

RESCUED = "_rescued"
MALFORMED = "_malformed_line"
#: Folders of one two-way write.
SPLIT = "_set"
GOOD, QUARANTINED = "good", "quarantined"


def convert(df: DataFrame, types: Mapping[str, str | DataType]) -> DataFrame:
    """Convert the columns of ``types``, all in one pass; other columns stay as they are.

    ``_rescued`` maps each column whose cell did not convert to its raw text, and is null where all
    did. A null cell is no failure. A map that ``df`` brings along is added to.
    """
    failed = []
    for name, kind in types.items():
        raw = F.col(name)
        lost = raw.isNotNull() & raw.try_cast(kind).isNull()
        failed.append(F.struct(F.lit(name).alias("key"), F.when(lost, raw.cast("string")).alias("value")))
    found = F.map_from_entries(F.filter(F.array(*failed), lambda e: e["value"].isNotNull())) if failed else None
    none = F.lit(None).cast("map<string,string>")
    before = F.col(RESCUED) if RESCUED in df.columns else none
    if found is not None:
        both = F.map_concat(F.coalesce(before, F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))), found)
        before = F.when(F.size(found) > 0, both).otherwise(before)
    kept = [c for c in df.columns if c != RESCUED]
    return df.select(*[F.col(c).try_cast(types[c]).alias(c) if c in types else F.col(c) for c in kept], before.alias(RESCUED))


def read_csv_rescued(spark: SparkSession, path: str | Sequence[str], schema: StructType) -> DataFrame:
    """Headered CSV as ``read_csv`` reads it, with ``_rescued`` cells and ``_malformed_line``.

    The reader hands over text alone, so it drops no cell; a line with more or fewer cells than
    the header is kept whole in ``_malformed_line``, its cells bound as far as they go.
    """
    text = StructType([*[StructField(f.name, StringType()) for f in schema.fields], StructField(MALFORMED, StringType())])
    rows = (
        spark.read.schema(text)
        .option("header", "true")
        .option("enforceSchema", "false")
        .option("nullValue", "NULL")
        .option("columnNameOfCorruptRecord", MALFORMED)
        .csv(path)
    )
    typed = {f.name: f.dataType for f in schema.fields if not isinstance(f.dataType, StringType)}
    return convert(rows, typed).select(*schema.names, RESCUED, MALFORMED)


def unfit(df: DataFrame, required: Sequence[str]) -> Column:
    """Whether a row lost a required cell, or its line was malformed."""
    lost = F.coalesce(F.arrays_overlap(F.map_keys(RESCUED), F.array(*map(F.lit, required))), F.lit(False)) if required else F.lit(False)
    return lost | F.col(MALFORMED).isNotNull() if MALFORMED in df.columns else lost


@dataclass(frozen=True)
class Split:
    """What a two-way write has counted."""

    rows: int
    quarantined: int
    rescued: dict[str, int]


def write_split(df: DataFrame, path: str, required: Sequence[str] = (), columns: Sequence[str] = ()) -> Split:
    """Write fit and unfit rows of ``df`` to ``<path>/_set=good`` and ``<path>/_set=quarantined`` in one job.

    Counted where they are written: rows, quarantined rows and rescued cells of ``columns``. The path
    is replaced, so a job that failed is repeated. A side without rows has no folder.
    """
    seen = Observation(f"split-{uuid.uuid4().hex}")
    marked = df.withColumn(SPLIT, F.when(unfit(df, required), QUARANTINED).otherwise(GOOD))
    counts = [F.count(F.lit(1)).alias("rows"), F.count_if(F.col(SPLIT) == QUARANTINED).alias("quarantined")]
    counts += [F.count_if(F.col(RESCUED)[c].isNotNull()).alias(f"cells_{i}") for i, c in enumerate(columns)]
    marked.observe(seen, *counts).write.mode("overwrite").partitionBy(SPLIT).parquet(path)
    got = seen.get
    return Split(got["rows"], got["quarantined"], {c: got[f"cells_{i}"] for i, c in enumerate(columns)})


def rescued_cells(df: DataFrame, *carried: str) -> DataFrame:
    """One row per rescued cell: the carried columns, ``column_name`` and ``raw``."""
    return df.select(*carried, F.explode(RESCUED).alias("column_name", "raw"))


def rescued_counts(df: DataFrame) -> DataFrame:
    return rescued_cells(df).groupBy("column_name").agg(F.count(F.lit(1)).alias("cells"))
