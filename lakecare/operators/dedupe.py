"""Latest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def ranking(
    df: DataFrame, newest_by: Sequence[str], tie_breakers: Sequence[str | Column] | None, keys: Sequence[str]
) -> list[Column]:
    """Newest first, nulls last, then a tie-break that makes the order total."""
    if tie_breakers is None:
        rest = [c for c in df.columns if c not in {*keys, *newest_by}]
        tie_breakers = [F.col(c).asc_nulls_last() for c in rest]
    newest = [F.col(c).desc_nulls_last() for c in newest_by]
    return newest + [F.col(t).asc_nulls_last() if isinstance(t, str) else t for t in tie_breakers]


def dedupe_latest(
    df: DataFrame,
    keys: Sequence[str],
    newest_by: Sequence[str] = ("last_modified_date",),
    tie_breakers: Sequence[str | Column] | None = None,
) -> DataFrame:
    """Keep one row per key: the newest one.

    Filtering ``row_number() = 1`` lets the optimizer cut each map task down to one row
    per key before the shuffle (WindowGroupLimit), so a hot key ships at most one row per
    map task. Without ``tie_breakers`` every other column breaks ties, which keeps the
    choice the same on a retry.
    """
    window = Window.partitionBy(*keys).orderBy(*ranking(df, newest_by, tie_breakers, keys))
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")
