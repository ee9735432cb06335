"""Interleaved clustering: files whose ranges are narrow in every column at once.

Each column's values are cut into ranges by sampled bounds; a row's rank among them is spread over the
bits of one key, taking the columns' bits in turn. Rows near each other in the key are near in
every column, so files of consecutive keys prune alike for each. For ``files`` files and ``d``
columns, a search for one value opens about ``files ** ((d - 1) / d)`` of them.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakecare.sinks.tables import publish_version, read_table

#: Bits of a column's rank, and rows that its bounds are taken from.
RANK_BITS, SAMPLE_ROWS = 10, 200_000
PLACE, NUMBER = "_place", "_number"


@dataclass(frozen=True)
class Bounds:
    """Ascending bounds of one column; a value's rank is the number of bounds not above it, spread over all bits."""

    column: str
    kind: str
    values: tuple
    bits: int = RANK_BITS

    def rank(self) -> Column:
        """By halving over the constant array; nulls come first, with rank 0. Few bounds use the high bits too."""
        table = F.lit(list(self.values)).cast(f"array<{self.kind}>") if self.values else F.array().cast(f"array<{self.kind}>")
        steps = F.array(*[F.lit(1 << k) for k in reversed(range(len(self.values).bit_length()))])
        found = F.aggregate(
            steps,
            F.lit(0),
            lambda at, step: F.when(F.coalesce(F.get(table, at + step - 1) <= F.col(self.column), F.lit(False)), at + step).otherwise(at),
        )
        spread = F.floor(found * F.lit((1 << self.bits) / (len(self.values) + 1))).cast("int")
        return F.when(F.col(self.column).isNull(), F.lit(0)).otherwise(spread) if self.values else F.lit(0)


def sampled_bounds(df: DataFrame, columns: Sequence[str], bits: int = RANK_BITS, rows: int = SAMPLE_ROWS) -> list[Bounds]:
    """Bounds that cut a bounded sample of each column into ranges of equal weight; a frequent value is one bound."""
    total = df.count()
    sample = df.select(*columns)
    if total > rows:
        place = F.pmod(F.xxhash64(*columns, F.monotonically_increasing_id()), F.lit(1 << 30))
        sample = sample.where(place < F.lit(int((1 << 30) * rows / total)))
    drawn = sample.limit(2 * rows).toPandas()
    kinds = dict(df.dtypes)
    found = []
    for c in columns:
        ordered = sorted(v for v in drawn[c].dropna().tolist())
        cuts = [ordered[len(ordered) * i // (1 << bits)] for i in range(1, 1 << bits)] if ordered else []
        found.append(Bounds(c, kinds[c], tuple(dict.fromkeys(cuts)), bits))
    return found


def interleaved(ranks: Sequence[Column], bits: int = RANK_BITS) -> Column:
    """One key that takes a bit of each rank in turn, the highest first."""
    key = F.lit(0).cast("long")
    for bit in reversed(range(bits)):
        for rank in ranks:
            key = F.shiftleft(key, 1).bitwiseOR(F.shiftright(rank, bit).bitwiseAND(F.lit(1)).cast("long"))
    return key


def cluster_interleaved(spark: SparkSession, path: str, columns: Sequence[str], files: int, bits: int = RANK_BITS) -> str:
    """Rewrite a versioned table as ``files`` files of consecutive interleaved keys; returns the version's name.

    A key that very many rows share is cut on by their number, so no file outgrows the others.
    """
    if len(columns) * bits > 62:
        bits = 62 // len(columns)
    live = read_table(spark, path)
    ranks = [b.rank() for b in sampled_bounds(live, columns, bits)]
    placed = live.withColumn(PLACE, interleaved(ranks, bits))
    numbered = placed.withColumn(NUMBER, F.monotonically_increasing_id())
    dealt = numbered.repartitionByRange(files, PLACE, NUMBER).sortWithinPartitions(PLACE, *columns)
    return publish_version(dealt.drop(PLACE, NUMBER), path, gather=False)


def file_ranges(spark: SparkSession, path: str, column: str) -> DataFrame:
    """(file, rows, low, high) of one column of a table."""
    rows = read_table(spark, path).withColumn("_file", F.col("_metadata.file_path"))
    return rows.groupBy(F.col("_file").alias("file")).agg(
        F.count(F.lit(1)).alias("rows"), F.min(column).alias("low"), F.max(column).alias("high")
    )


def files_opened(spark: SparkSession, path: str, column: str, values: DataFrame) -> DataFrame:
    """One row: column_name, files, and how many of them a search for one of ``values(value)`` opens, on average and at most.

    Only the files' ranges, one row each, are sent to all tasks.
    """
    ranges = file_ranges(spark, path, column)
    files = ranges.count()
    met = values.join(F.broadcast(ranges), F.col("value").between(F.col("low"), F.col("high")))
    opened = met.groupBy("value").agg(F.count(F.lit(1)).alias("opened"))
    return opened.agg(
        F.lit(column).alias("column_name"), F.lit(files).alias("files"), F.avg("opened").alias("opened"), F.max("opened").alias("most")
    )
