"""Ordinal and successor of each row within its key, also for keys too large for one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakecare.operators.joins import hot_keys, hot_threshold, small
from lakecare.session import stage

#: Rows of a range slice, unless a key may hold more.
SLICE_ROWS = 500_000


def _plain(df: DataFrame, keys: list[str], order: list[str], ordinal: str, successors: dict[str, str]) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*order)
    columns: dict[str, Column] = {ordinal: F.row_number().over(window).cast("long")}
    columns.update({new: F.lead(old).over(window) for old, new in successors.items()})
    return df.withColumns(columns)


def _sliced(
    df: DataFrame, keys: list[str], order: list[str], ordinal: str, successors: dict[str, str], slices: int
) -> DataFrame:
    """Range-partition by (key, order), number inside each slice, then shift by what came before.

    Slices are cut without regard to keys: one holds many small keys or a part of a large one.
    The slice number comes from range bounds, so the placement is written before it is used twice. The edge table has one row per key and slice.
    """
    dealt = df.repartitionByRange(slices, *keys, *order).withColumn("_slice", F.spark_partition_id())
    placed = stage(dealt, "slices")
    head = F.min(F.struct(*order, *[F.col(c).alias(f"_s_{c}") for c in successors]))
    edges = placed.groupBy(*keys, "_slice").agg(F.count(F.lit(1)).alias("_size"), head.alias("_head"))
    by_slice = Window.partitionBy(*keys).orderBy("_slice")
    edges = edges.select(
        *keys,
        "_slice",
        "_size",
        F.coalesce(F.sum("_size").over(by_slice.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
        F.lead("_head").over(by_slice).alias("_next"),
    )
    local = Window.partitionBy(*keys, "_slice").orderBy(*order)
    numbered = placed.withColumns(
        {"_at": F.row_number().over(local), **{f"_n_{c}": F.lead(c).over(local) for c in successors}}
    ).join(edges, [*keys, "_slice"])
    result: dict[str, Column] = {ordinal: F.col("_before") + F.col("_at")}
    for old, new in successors.items():
        at_edge = F.col("_at") == F.col("_size")
        result[new] = F.when(at_edge, F.col(f"_next._s_{old}")).otherwise(F.col(f"_n_{old}"))
    return numbered.select(*[F.col(c) for c in df.columns], *[c.alias(n) for n, c in result.items()])


def number_in_order(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    ordinal: str = "visit_num",
    successors: dict[str, str] | None = None,
    threshold: int | None = None,
) -> DataFrame:
    """Add ``row_number()`` and ``lead()`` per key, ordered ascending by ``order``.

    ``order`` must be a total order of non-null columns within a key. Keys of at most
    ``threshold`` rows use one window; larger keys are cut into range slices, so no task
    ever holds a whole hot key. The slices follow the rows to be cut, not the number of hot
    keys: a low threshold makes many keys hot, and a task for every few rows would be all overhead.
    """
    keys, order, successors = list(keys), list(order), dict(successors or {})
    threshold = hot_threshold(df, threshold)
    hot, n_hot = hot_keys(df, keys, threshold)
    if n_hot == 0:
        return _plain(df, keys, order, ordinal, successors)
    hot_rows = hot.agg(F.sum("_rows")).first()[0]
    enough = max(df.sparkSession.sparkContext.defaultParallelism, -(-hot_rows // SLICE_ROWS))
    slices = max(2, min(-(-hot_rows // threshold) * 2, enough))
    wanted = small(hot.select(*keys), n_hot)
    cold = _plain(df.join(wanted, keys, "left_anti"), keys, order, ordinal, successors)
    split = _sliced(df.join(wanted, keys, "left_semi"), keys, order, ordinal, successors, slices)
    return cold.unionByName(split)


def ranked(df: DataFrame, order: Sequence[str], name: str = "rank") -> DataFrame:
    """Add the 0-based rank of each row in the total ``order``, nulls first; no task holds more than a range of rows.

    Rows are written once in sorted ranges, so that ranks stay what they are on every later use. Only one
    count per range passes through a single task.
    """
    row_bits = 33  # of the ids that are given out within one partition
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = stage(dealt.withColumn("_at", F.monotonically_increasing_id()), "ranked")
    placed = placed.withColumn("_part", F.shiftright("_at", row_bits))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
    offsets = counts.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    within = F.col("_at").bitwiseAND(F.lit((1 << row_bits) - 1))
    return placed.join(F.broadcast(offsets), "_part").select(*df.columns, (F.col("_before") + within).alias(name))
