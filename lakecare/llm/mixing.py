"""Mixing of sources to target weights, in DataFrame operations only.

Each source's words are counted, its target is its weight's share of all words, and no target
exceeds ``most`` times what the source has; what is cut off goes to the other sources by
weight. A document is then taken floor(rate) times, and once more if a number drawn from a hash
of its id, its text and its place among equal rows falls below the rate's fraction, so a rerun
takes the same copies.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakecare.session import stage

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1.0, 2.0, 3.0)
MOST = 3.0
SEED = "mix-1"


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def text_digest(text: Column) -> Column:
    return F.md5(F.coalesce(text, F.lit("")))


def draw(doc_id: Column, digest: Column, place: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) from the first 52 bits of an MD5 of the seed, the id (a null one is empty), the digest and the place."""
    shown = F.concat_ws(":", F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit("")), digest, place.cast("string"))
    return F.conv(F.substring(F.md5(shown), 1, 13), 16, 10).cast("double") / F.lit(float(2**52))


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, most: float = MOST) -> DataFrame:
    """One row per source of ``sizes(source, size)``: source, source_size, target, rate.

    Sources in code point order, null last, take the weights in turn. A source is at its limit
    if the common level (words per weight) is above its own; as the limits are met in order of
    ``limit / weight``, running sums over the sources give the level without iteration: it is the first, and so the
    highest, that the source it was reckoned for can take. Only
    the table of sources passes through one task.
    """
    each = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = ((F.row_number().over(by_name) - 1) % len(weights)).cast("int")
    limited = each.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), turn + 1)).withColumn(
        "limit", F.col("source_size") * F.lit(most)
    )
    order = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    before, onward = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("limit").over(before), F.lit(0.0))
    levels = limited.withColumn("level", left / F.sum("weight").over(onward))
    free = levels.withColumn(
        "common", F.max(F.when(F.col("limit") / F.col("weight") >= F.col("level"), F.col("level"))).over(everything)
    )
    target = F.least(F.col("limit"), F.col("common") * F.col("weight"))
    return free.withColumn("target", F.coalesce(target, F.col("limit"))).select(
        "source",
        "source_size",
        "target",
        F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0).alias("rate"),
    )


def copies(rate: Column, drawn: Column) -> Column:
    return (F.floor(rate) + F.when(drawn < rate - F.floor(rate), 1).otherwise(0)).cast("int")


#: What equal rows share; the source is part of it, as each has a rate of its own.
EQUAL = ("doc_id", "source", "digest")


def place_among_equals() -> Column:
    return F.row_number().over(Window.partitionBy(*EQUAL).orderBy(F.lit(1)))


def mix(documents: DataFrame, weights: Sequence[float] = WEIGHTS, most: float = MOST, seed: str = SEED) -> DataFrame:
    """(doc_id, source, size, source_size, target, rate, copies) for every row of ``documents``.

    Null texts have size 0, as have blank ones; a source without words has target 0; a null
    source is a source of its own. Rows that agree in id, source and text are drawn one by one.
    Very long texts count whole; an empty table gives no rows; other columns are not read.
    """
    text = F.col("text")
    sizes = stage(documents.select("doc_id", "source", words(text).alias("size"), text_digest(text).alias("digest")), "mix-sizes")
    targets = stage(source_targets(sizes, weights, most), "mix-targets")
    placed = sizes.withColumn("place", place_among_equals())
    joined = placed.alias("d").join(targets.alias("s"), F.col("d.source").eqNullSafe(F.col("s.source")))
    return joined.select(
        "d.doc_id",
        "d.source",
        "d.size",
        "s.source_size",
        "s.target",
        "s.rate",
        copies(F.col("s.rate"), draw(F.col("d.doc_id"), F.col("d.digest"), F.col("d.place"), seed)).alias("copies"),
    )


def emit(documents: DataFrame, weights: Sequence[float] = WEIGHTS, most: float = MOST, seed: str = SEED) -> DataFrame:
    """The rows of ``documents``, each as often as ``mix`` takes it.

    All columns are kept, whatever their names; an empty table stays empty. Only rows that have
    equals are shuffled, to be numbered among them; they are found by their ids, sources and digests alone.
    """
    text = F.col("text")
    sizes = stage(documents.select("doc_id", "source", words(text).alias("size"), text_digest(text).alias("digest")), "mix-sizes")
    targets = stage(source_targets(sizes, weights, most), "mix-targets").select(F.col("source").alias("of"), "rate")
    doubled = stage(sizes.groupBy(*EQUAL).count().where("count > 1").select(*EQUAL), "mix-repeated")
    packed = documents.select(F.struct("*").alias("doc"), "doc_id", "source", text_digest(text).alias("digest"))
    if doubled.isEmpty():
        placed = packed.withColumn("place", F.lit(1))
    else:
        p, d = packed.alias("p"), doubled.alias("d")
        same = [F.col(f"p.{c}").eqNullSafe(F.col(f"d.{c}")) for c in EQUAL]
        several = p.join(d, same, "left_semi").withColumn("place", place_among_equals())
        placed = p.join(d, same, "left_anti").withColumn("place", F.lit(1)).unionByName(several)
    joined = placed.join(targets, F.col("source").eqNullSafe(F.col("of")))
    drawn = draw(F.col("doc_id"), F.col("digest"), F.col("place"), seed)
    times = joined.withColumn("copies", copies(F.col("rate"), drawn)).where("copies > 0")
    return times.select("doc", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("doc.*")
