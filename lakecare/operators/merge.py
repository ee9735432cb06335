"""Keyed upsert as a DataFrame operation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class DuplicateKeyError(ValueError):
    """An upsert source holds a key more than once."""


def require_unique(df: DataFrame, keys: Sequence[str]) -> None:
    """Raise when a key repeats; counts combine on the map side and one example is fetched."""
    repeated = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).where("_rows > 1").limit(1).collect()
    if repeated:
        raise DuplicateKeyError(f"source key repeats: {repeated[0].asDict()}")


def merge_upsert(
    target: DataFrame, source: DataFrame, keys: Sequence[str], newer_by: str | None = None
) -> DataFrame:
    """Matched keys take all columns of ``source``; unmatched source rows are added.

    With ``newer_by`` a source row only replaces a target row that is not newer: keys are
    unique on both sides, so one full outer join reads each input once. Without it the
    anti-join keeps the target side splittable when a key is hot, and a small source is
    broadcast by the optimizer once its size is known.
    """
    keys = list(keys)
    if newer_by is not None:
        old = target.select(F.struct(*target.columns).alias("_old"), *keys)
        new = source.select(F.struct(*target.columns).alias("_new"), *keys)
        stale = F.coalesce(F.col(f"_old.{newer_by}") > F.col(f"_new.{newer_by}"), F.lit(False))
        picked = F.when(F.col("_new").isNull() | stale, F.col("_old")).otherwise(F.col("_new"))
        return old.join(new, keys, "full").select(picked.alias("_row")).select("_row.*")
    kept = target.join(source.select(*keys), keys, "left_anti")
    return kept.unionByName(source)
