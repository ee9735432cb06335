"""How well a score ranks: curves and areas by distributed prefix sums over groups of tied scores."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakecare.session import stage


def tie_groups(scored: DataFrame, label: str, score: str) -> DataFrame:
    """(score, pos, neg): labels per distinct score; rows without a score or a label are left out.

    Counts combine on the map side, so a score that many rows share is one row of each task.
    """
    positive = F.col(label).cast("boolean")
    return (
        scored.where(F.col(score).isNotNull() & ~F.isnan(F.col(score).cast("double")) & positive.isNotNull())
        .groupBy(F.col(score).alias("score"))
        .agg(F.count_if(positive).alias("pos"), F.count_if(~positive).alias("neg"))
    )


def curve(scored: DataFrame, label: str, score: str) -> DataFrame:
    """(score, pos, neg, pos_before, neg_before, all_pos, all_neg) per distinct score, the highest first.

    Distinct scores are cut into ranges; sums run inside each, and one row per range carries them on,
    so no task ever sorts more than a range.
    """
    sliced = tie_groups(scored, label, score).repartitionByRange(F.desc("score")).withColumn("part", F.spark_partition_id())
    placed = stage(sliced, "rank-groups")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    totals = placed.groupBy("part").agg(F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    offsets = totals.select(
        "part",
        F.coalesce(F.sum("p").over(before), F.lit(0)).alias("p_before"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n_before"),
        F.sum("p").over(everything).alias("all_pos"),
        F.sum("n").over(everything).alias("all_neg"),
    )
    within = Window.partitionBy("part").orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, -1)

    def earlier(column: str):
        return F.coalesce(F.sum(column).over(within), F.lit(0))

    run = placed.withColumns({"pos_in": earlier("pos"), "neg_in": earlier("neg")})
    return run.join(F.broadcast(offsets), "part").select(  # a row per range
        "score",
        "pos",
        "neg",
        (F.col("p_before") + F.col("pos_in")).alias("pos_before"),
        (F.col("n_before") + F.col("neg_in")).alias("neg_before"),
        "all_pos",
        "all_neg",
    )


def rank_metrics(scored: DataFrame, label: str, score: str) -> DataFrame:
    """One row: positives, negatives, area_under_roc, area_under_pr, best_ks.

    The area under the ROC curve is the share of pairs of a positive and a negative that the score
    ranks rightly, ties counting half; it is summed in whole numbers, so the order of rows plays no
    part. The area under the precision-recall curve is cut into trapezoids between distinct scores and
    begins at the first one's precision. ``best_ks`` is the largest gap between the two classes'
    shares. Areas are null if a class is missing.
    """
    at = curve(scored, label, score)
    hits, seen = F.col("pos_before") + F.col("pos"), F.col("pos_before") + F.col("neg_before") + F.col("pos") + F.col("neg")
    reached = F.col("pos_before") + F.col("neg_before")
    precision = hits / seen
    last = F.when(reached > 0, F.col("pos_before") / reached).otherwise(precision)
    twice = F.col("neg").cast("decimal(19,0)") * (2 * F.col("pos_before") + F.col("pos")).cast("decimal(19,0)")
    false_hits = F.col("neg_before") + F.col("neg")
    gap = F.abs(F.try_divide(hits, F.col("all_pos")) - F.try_divide(false_hits, F.col("all_neg")))
    summed = at.agg(
        F.max("all_pos").alias("positives"),
        F.max("all_neg").alias("negatives"),
        F.sum(twice).alias("twice"),
        F.sum(F.col("pos") * (precision + last) / 2).alias("area"),
        F.max(gap).alias("gap"),
    )
    pairs = F.col("positives").cast("double") * F.col("negatives").cast("double")
    both = (F.col("positives") > 0) & (F.col("negatives") > 0)
    return summed.select(
        F.coalesce("positives", F.lit(0)).alias("positives"),
        F.coalesce("negatives", F.lit(0)).alias("negatives"),
        F.when(both, F.round(F.try_divide(F.col("twice").cast("double") / 2, pairs), 9)).alias("area_under_roc"),
        F.when(both, F.round(F.try_divide(F.col("area"), F.col("positives")), 9)).alias("area_under_pr"),
        F.when(both, F.round("gap", 9)).alias("best_ks"),
    )
