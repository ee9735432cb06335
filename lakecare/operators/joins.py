"""Left join whose right side may hold a third of its rows under one key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakecare.session import stage

HOT_ROWS = 2_000_000
HOT_ROWS_SETTING = "lakecare.hotRows"
BROADCAST_KEYS = 200_000
CELLS = 1 << 16  # hash cells that bound the rows of a key from above


def hot_threshold(df: DataFrame, given: int | None) -> int:
    """Rows one key may hold before it is split: the argument, the session setting, or the default."""
    return given or int(df.sparkSession.conf.get(HOT_ROWS_SETTING, str(HOT_ROWS)))


def fullest_cell(df: DataFrame, keys: Sequence[str]) -> int:
    """The most rows in one of ``CELLS`` hash cells of the key: no key has more.

    One pass over the key columns that ships a count per cell and task, however many keys there are.
    """
    cell = F.pmod(F.xxhash64(*keys), F.lit(CELLS)).alias("_cell")
    return df.groupBy(cell).agg(F.count(F.lit(1)).alias("_rows")).agg(F.max("_rows")).first()[0] or 0


def hot_keys(df: DataFrame, keys: Sequence[str], threshold: int) -> tuple[DataFrame | None, int]:
    """Keys with more than ``threshold`` rows, with their row counts; None and 0 if there are none.

    Where hash cells show that no key can have as many, the keys are not counted one by one.
    Otherwise counts combine on the map side, and at most rows/threshold keys can qualify. This is one
    counting pass over the key columns; the hot keys are written by it.
    """
    if threshold >= CELLS and fullest_cell(df, keys) <= threshold:
        return None, 0
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > threshold)
    found = stage(counted, "hot-keys")
    return found, found.count()


def small(df: DataFrame, rows: int) -> DataFrame:
    """Broadcast only a counted, bounded frame; a larger one is left to shuffle."""
    return F.broadcast(df) if rows <= BROADCAST_KEYS else df


def left_join_skewed(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    spread_by: Sequence[str],
    threshold: int | None = None,
) -> DataFrame:
    """``left LEFT JOIN right USING (keys)``, exact for any key distribution.

    Adaptive execution cannot split the right side of a left join, so the hot keys are
    salted here: right rows of a hot key spread over ``rows / threshold`` salts by the
    hash of ``spread_by``, and the left rows of that key are repeated once per salt. A
    hot key has matches by definition, so its unmatched salts are dropped. Cold keys
    keep one salt and plain left-join behaviour.
    """
    keys, threshold = list(keys), hot_threshold(right, threshold)
    hot, n_hot = hot_keys(right.where(F.col(keys[0]).isNotNull()), keys, threshold)
    if n_hot == 0:
        return left.join(right, keys, "left")

    salts = small(
        hot.select(*keys, F.ceil(F.col("_rows") / F.lit(threshold)).cast("int").alias("_salts")), n_hot
    )
    n_salts = F.coalesce(F.col("_salts"), F.lit(1))
    salted_right = (
        right.join(salts, keys, "left")
        .withColumn("_salt", F.pmod(F.xxhash64(*spread_by), n_salts).cast("int"))
        .withColumn("_matched", F.lit(True))
        .drop("_salts")
    )
    salted_left = (
        left.join(salts, keys, "left")
        .withColumn("_hot", F.col("_salts").isNotNull())
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), n_salts - 1)))
        .drop("_salts")
    )
    joined = salted_left.join(salted_right, [*keys, "_salt"], "left")
    return joined.where(~F.col("_hot") | F.col("_matched")).drop("_salt", "_hot", "_matched")
