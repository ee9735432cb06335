"""Hard-negative mining by segment summaries: bounds on inner products, refined before exact scoring.

A vector is cut into segments, and each segment is summarised by its mean and its deviation (the
length of what is left once the mean is taken off). For two segments of ``n`` components the inner
product is ``n`` times the product of the means, give or take at most the product of the
deviations. Summed over the segments this bounds a score from both sides. Coarse segments decide
most rows cheaply; those left are bounded anew with segments of half the length, and so on, and
only what no bound decides is scored exactly.

Rows are dealt to blocks and anchors to batches; every block meets every batch in a task of its
own, so a label that holds a third of the rows makes no task larger. Each task keeps only its
best few rows for an anchor.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakecare.llm.common import ship
from lakecare.session import stage

POSITIVES, NEGATIVES = 5, 10
#: A negative's score lies between these hundredths of the positive's.
LEAST_SHARE, MOST_SHARE = 30, 90
SCALE = 256
#: Components of the finest segments that are stored; coarser ones are merged from them.
FINEST = 4
#: Most rows of a block, rows that a block is worth, and most anchors of a batch.
BLOCK_ROWS, WORTH_ROWS, BATCH_ANCHORS = 32_768, 256, 4096
#: Whole numbers below this are exact as doubles.
EXACT = 2.0**53
LONGEST = 2**63 - 1


def segment_summaries(vectors: np.ndarray, finest: int = FINEST) -> tuple[np.ndarray, np.ndarray]:
    """Means and deviations of each row's segments; the last segment is filled up with zeros."""
    rows, width = vectors.shape
    filled = np.zeros((rows, -(-width // finest) * finest))
    filled[:, :width] = vectors
    parts = filled.reshape(rows, -1, finest)
    means = parts.mean(2)
    return means, np.sqrt(((parts - means[:, :, None]) ** 2).sum(2))


def merged(means: np.ndarray, deviations: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Summaries of segments twice as long, from those of ``length`` components; an odd one is joined with zeros."""
    if means.shape[1] % 2:
        means, deviations = (np.pad(a, ((0, 0), (0, 1))) for a in (means, deviations))
    left, right = means[:, ::2], means[:, 1::2]
    squares = deviations[:, ::2] ** 2 + deviations[:, 1::2] ** 2 + length * (left - right) ** 2 / 2
    return (left + right) / 2, np.sqrt(squares)


@dataclass
class Level:
    length: int
    means: np.ndarray
    deviations: np.ndarray


def levels_of(means: np.ndarray, deviations: np.ndarray, finest: int = FINEST) -> list[Level]:
    """From one segment for the whole vector down to the finest."""
    found = [Level(finest, means, deviations)]
    while found[-1].means.shape[1] > 1:
        last = found[-1]
        found.append(Level(2 * last.length, *merged(last.means, last.deviations, last.length)))
    return found[::-1]


class Block:
    """Vectors of one meeting with their summaries, as wide as the widest of either side."""

    def __init__(self, rows: pd.DataFrame, width: int) -> None:
        self.row, self.unnamed, self.id = (rows[c].to_numpy() for c in ("row", "unnamed", "vec_id"))
        self.label = rows["label"].to_numpy()
        self.vectors = padded(rows["vector"], width)
        segments = -(-width // FINEST)
        self.levels = levels_of(padded(rows["means"], segments), padded(rows["deviations"], segments))
        self.norms = np.sqrt((self.vectors**2).sum(1))
        self.largest = float(np.abs(self.vectors).max(initial=0.0))


def padded(lists: pd.Series, width: int) -> np.ndarray:
    """The lists as one matrix; short ones end in zeros."""
    if len(lists) and all(len(x) == width for x in lists):
        return np.stack(lists.to_numpy()).astype(float)
    out = np.zeros((len(lists), max(width, 1)))
    for i, x in enumerate(lists):
        out[i, : len(x)] = x
    return out


def exact_scores(block: Block, rows: np.ndarray, vector: np.ndarray, largest: float) -> np.ndarray:
    """Inner products of whole numbers, in doubles if none can lose a digit, else as Python's integers."""
    if block.largest * largest * vector.shape[0] < EXACT:
        return block.vectors[rows] @ vector
    own = [int(x) for x in vector]
    return np.array([sum(int(a) * b for a, b in zip(block.vectors[r], own, strict=True)) for r in rows], object)


def best_rows(
    block: Block, anchors: Block, at: int, rows: np.ndarray, bands: list[tuple[float, float]], k: int
) -> list[tuple[int, int, int]]:
    """(band, row of the block, score) of the ``k`` highest scores within each closed band.

    Ties go to the smaller id, rows without one last. Per level a row stays while its bounds reach into some
    band, and reach the k-th highest lower bound among the rows surely inside that band.
    """
    low, high = (np.array(side, float)[:, None] for side in zip(*bands, strict=True))
    floor = low.copy()
    for level, query in zip(block.levels, anchors.levels, strict=True):
        if len(rows) <= k:
            break
        middle = level.length * (level.means[rows] @ query.means[at])
        spread = level.deviations[rows] @ query.deviations[at]
        slack = 1e-9 * (1.0 + block.norms[rows] * anchors.norms[at])  # rounding never drops a row
        under, over = middle - spread - slack, middle + spread + slack
        inside = (under >= low) & (over <= high)
        for band in np.flatnonzero(inside.sum(1) >= k):
            sure = under[inside[band]]
            floor[band] = max(floor[band, 0], np.partition(sure, len(sure) - k)[len(sure) - k])
        rows = rows[((over >= floor) & (under <= high)).any(0)]
    if not len(rows):
        return []
    scores = exact_scores(block, rows, anchors.vectors[at], anchors.largest)
    if scores.dtype == object:
        order = sorted(range(len(rows)), key=lambda i: (-scores[i], block.unnamed[rows[i]], block.id[rows[i]]))
    else:
        order = np.lexsort((block.id[rows], block.unnamed[rows], -scores))
    rows, scores = rows[order], scores[order]
    found = []
    for band, (least, most) in enumerate(bands):
        fits = np.flatnonzero((scores >= least) & (scores <= most))[:k]
        found += [(band, int(rows[i]), int(scores[i])) for i in fits]
    return found


def clipped(score: int) -> int:
    return max(-LONGEST - 1, min(LONGEST, score))


def band_of(positive: int, least: int, most: int) -> tuple[int, int]:
    """Whole scores ``n`` with ``least * positive <= 100 * n <= most * positive``."""
    return -(-least * positive // 100), most * positive // 100


def usable(vectors: DataFrame, scale: int) -> DataFrame:
    """(vec_id, label, vector) of distinct rows that take part, components scaled and rounded down."""
    scaled = F.transform(F.col("vector").cast("array<double>"), lambda x: F.lit(float(scale)) * x)
    rows = vectors.select("vec_id", F.col("label").cast("string").alias("label"), scaled.alias("vector"))
    odd = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    # -0.0 and 0.0 are one value
    floor = F.transform("vector", lambda x: F.when(F.abs(x) < 2.0**53, F.floor(x).cast("double")).otherwise(x) + F.lit(0.0))
    taking = rows.where(F.col("label").isNotNull() & F.col("vector").isNotNull() & ~odd)
    return taking.select(F.col("vec_id").cast("long").alias("vec_id"), "label", floor.alias("vector")).distinct()


ROWS = "row long, unnamed boolean, vec_id long, label string, vector array<double>, means array<double>, deviations array<double>"


def summarised(rows: DataFrame) -> DataFrame:
    """Number the rows and store every vector's segment summaries beside it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.float64())
        for batch in batches:
            means, deviations = [], []
            for vector in batch.column(4).to_pylist():
                mean, deviation = segment_summaries(np.array([vector], float)) if vector else (np.zeros((1, 0)),) * 2
                means.append(mean[0])
                deviations.append(deviation[0])
            names = [part.split()[0] for part in ROWS.split(", ")]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(means, kind), pa.array(deviations, kind)], names)

    return rows.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("vec_id").isNull().alias("unnamed"),
        F.coalesce("vec_id", F.lit(0).cast("long")).alias("vec_id"),
        "label",
        "vector",
    ).mapInArrow(run, ROWS)


FOUND = "anchor long, anchor_id long, band int, row long, unnamed boolean, vec_id long, score long"
FOUND_KINDS = ["int64", "int64", "int32", "int64", "bool", "int64", "int64"]


def _search(blocks: DataFrame, anchors: DataFrame, same: bool, k: int, least: int, most: int) -> DataFrame:
    """The ``k`` best rows of every block for each anchor and band, of the anchor's label or of others.

    The bands of other labels follow from the anchor's positive ``scores``; its own label has one, open, band.
    """

    def run(data: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple] = []
        if len(data) and len(asked):
            width = max(max(map(len, data["vector"])), max(map(len, asked["vector"])), 1)
            block, anchors = Block(data, width), Block(asked, width)
            groups = {label: np.flatnonzero(block.label == label) for label in set(anchors.label.tolist())}
            every = np.arange(len(block.row))
            for at, scores in enumerate(asked["scores"]):
                rows = groups[anchors.label[at]]
                if same:
                    rows, bands = rows[block.row[rows] != anchors.row[at]], [(-np.inf, np.inf)]
                else:
                    rows = np.setdiff1d(every, rows, assume_unique=True)
                    bands = [band_of(int(s), least, most) for s in scores]
                for band, i, score in best_rows(block, anchors, at, rows, bands, k):
                    own = (int(anchors.row[at]), int(anchors.id[at]), band)
                    out.append((*own, int(block.row[i]), bool(block.unnamed[i]), int(block.id[i]), clipped(score)))
        columns = list(zip(*out, strict=True)) or [()] * len(FOUND_KINDS)
        names = [part.split()[0] for part in FOUND.split(", ")]
        return pd.DataFrame({n: np.array(c, t) for n, c, t in zip(names, columns, FOUND_KINDS, strict=True)})

    keys = ["block", "batch"]
    return blocks.groupBy(*keys).cogroup(anchors.groupBy(*keys)).applyInPandas(run, FOUND)


def _best(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The ``k`` best per key; a task's own best come first, so few rows are shuffled."""
    order = Window.partitionBy(*keys).orderBy(F.col("score").desc(), "unnamed", "vec_id", "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long, positive_rank int"


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    least: int = LEAST_SHARE,
    most: int = MOST_SHARE,
    scale: int = SCALE,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """The best ``negatives`` rows of another label for each anchor and each of its best ``positives`` of its own.

    ``vectors(vec_id, label, vector)``; ``is_anchor`` is a condition on ``vec_id``. Components are
    scaled and rounded down, scores are inner products of these whole numbers. A negative's score is
    between ``least`` and ``most`` hundredths of the positive's, so a positive below zero has none.
    Higher scores come first, ties go to the smaller vec_id, a null vec_id after all others.

    Rows with a null label, a null vector or a component that is null or not finite (scaled) take no
    part. Wholly equal rows count once; rows that share only their vec_id are rows of their own, and
    each is a candidate for the other. Vectors of unequal length are compared as if the shorter ended
    in zeros; an empty one scores 0. Scores beyond 64 bits are given as the nearest long. An anchor
    without positives, or a positive without negatives, gives no row; an empty table none at all.
    Other columns are not read.
    """
    spark = vectors.sparkSession
    ship(spark)
    rows = stage(summarised(usable(vectors, scale)), "negatives-rows")
    asked = stage(rows.where(is_anchor & ~F.col("unnamed")), "negatives-anchors")
    total, anchors = rows.count(), asked.count()
    if not anchors:
        return spark.createDataFrame([], RESULT)
    parallel = 4 * spark.sparkContext.defaultParallelism
    n_blocks = max(-(-total // block_rows), min(-(-total // WORTH_ROWS), parallel))
    n_batches = -(-anchors // BATCH_ANCHORS)
    blocks = rows.withColumn("block", F.pmod(F.hash("row"), F.lit(n_blocks))).withColumn(
        "batch", F.explode(F.sequence(F.lit(0), F.lit(n_batches - 1)))
    )
    meeting = asked.withColumn("batch", F.pmod(F.hash("row"), F.lit(n_batches))).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)))
    )
    own = _search(blocks, meeting.withColumn("scores", F.array().cast("array<long>")), True, positives, least, most)
    first = stage(
        _best(own, ["anchor"], positives).select(
            "anchor", "rank", "unnamed", "vec_id", "score", (F.col("rank") - 1).alias("band")
        ),
        "negatives-positives",
    )
    scores = first.groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct("rank", "score")))["score"].alias("scores"))
    bounded = meeting.join(scores, F.col("row") == F.col("anchor")).drop("anchor")
    others = _best(_search(blocks, bounded, False, negatives, least, most), ["anchor", "band"], negatives)
    n, p = others.alias("n"), first.alias("p")
    return n.join(p, (F.col("n.anchor") == F.col("p.anchor")) & (F.col("n.band") == F.col("p.band"))).select(
        "n.anchor_id",
        F.when(~F.col("p.unnamed"), F.col("p.vec_id")).alias("positive_id"),
        F.col("n.rank").cast("int").alias("rank"),
        F.when(~F.col("n.unnamed"), F.col("n.vec_id")).alias("negative_id"),
        F.col("p.score").alias("positive_score"),
        F.col("n.score").alias("negative_score"),
        F.col("p.rank").cast("int").alias("positive_rank"),
    )
