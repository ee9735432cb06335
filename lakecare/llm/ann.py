"""Approximate nearest neighbours: low-dimensional stable projections in a kd-tree, with a chi-square stop.

Vectors are projected on a few Gaussian directions. For two vectors at distance ``d`` the squared
projected distance over ``d * d`` follows a chi-square law, so once the next projected neighbour
is so far away that anything beyond is unlikely to be among the best found, a search stops.

The upper levels of the kd-tree come from a bounded sample of the projections and deal every
vector to a leaf; inside its task a leaf is a kd-tree of its own. A query first searches its
home leaf, then only the leaves whose box passes the same test against its tenth-best distance.
Crowded leaves are cut into blocks, and the queries of a leaf into batches, by their counts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from math import exp, factorial

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakecare.llm.common import ship
from lakecare.session import stage

DIMENSIONS = 8
NEIGHBOURS = 10
#: Chance that a search must have of holding any one true neighbour before it stops.
CERTAINTY = 0.98
SEED = 11
#: Rows the upper tree is fitted on, rows it aims at per leaf, and its most leaves.
SAMPLE_ROWS, LEAF_ROWS, MOST_LEAVES = 20_000, 16_384, 4096
#: Most vectors and queries that meet in one task.
BLOCK_ROWS, BATCH_QUERIES = 65_536, 8192
BUCKET = 64


def projection(width: int, dimensions: int = DIMENSIONS, seed: int = SEED) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((width, dimensions))


@cache
def chi_square_quantile(certainty: float, degrees: int) -> float:
    """By bisection on the closed form for even degrees of freedom."""

    def below(x: float) -> float:
        return 1 - exp(-x / 2) * sum((x / 2) ** i / factorial(i) for i in range(degrees // 2))

    low, high = 0.0, 1000.0
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if below(middle) < certainty else (low, middle)
    return high


@dataclass
class UpperTree:
    """Median splits, level by level; node ``i`` has the children ``2i + 1`` and ``2i + 2``."""

    axis: np.ndarray
    at: np.ndarray
    depth: int

    @staticmethod
    def fit(points: np.ndarray, leaves: int) -> UpperTree:
        depth = max(0, (max(leaves, 1) - 1).bit_length())
        axis, at = np.zeros((1 << depth) - 1, int), np.zeros((1 << depth) - 1)
        groups = [points]
        for level in range(depth):
            after = []
            for i, group in enumerate(groups):
                node = (1 << level) - 1 + i
                spread = np.ptp(group, 0) if len(group) else np.zeros(points.shape[1])
                axis[node] = int(spread.argmax())
                at[node] = float(np.median(group[:, axis[node]])) if len(group) else 0.0
                left = group[:, axis[node]] < at[node]
                after += [group[left], group[~left]]
            groups = after
        return UpperTree(axis, at, depth)

    def leaf(self, points: np.ndarray) -> np.ndarray:
        node = np.zeros(len(points), int)
        for _ in range(self.depth):
            right = points[np.arange(len(points)), self.axis[node]] >= self.at[node]
            node = 2 * node + 1 + right
        return node - ((1 << self.depth) - 1)


class LeafTree:
    """A kd-tree over one block: buckets of neighbouring projections with their boxes."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, points: np.ndarray) -> None:
        parts = [np.arange(len(points))]
        while parts and max(map(len, parts)) > BUCKET:
            after = []
            for part in parts:
                if len(part) <= BUCKET:
                    after.append(part)
                    continue
                axis = int(np.ptp(points[part], 0).argmax())
                half = len(part) // 2
                order = part[np.argpartition(points[part, axis], half)]
                after += [order[:half], order[half:]]
            parts = after
        order = np.concatenate(parts) if parts else np.zeros(0, int)
        self.ids, self.vectors, self.points = ids[order], vectors[order], points[order]
        self.ends = np.cumsum([len(p) for p in parts])
        self.starts = self.ends - [len(p) for p in parts]
        self.low = np.array([points[p].min(0) for p in parts])
        self.high = np.array([points[p].max(0) for p in parts])

    def search(self, own: int, vector: np.ndarray, point: np.ndarray, k: int, limit: float, stop: float) -> list[tuple]:
        """Up to ``k`` (distance, id), nearest first, at most ``limit`` away.

        Buckets come in the order of their projected distance; the search ends with the first
        whose squared distance exceeds ``stop`` times that of the k-th best vector so far.
        """
        gap = np.maximum(np.maximum(self.low - point, point - self.high), 0)
        nearest = (gap * gap).sum(1)
        best_d, best_id = np.zeros(0), np.zeros(0, np.int64)
        reach = limit
        for b in np.argsort(nearest, kind="stable"):
            if nearest[b] > stop * reach * reach:
                break
            rows = slice(self.starts[b], self.ends[b])
            apart = self.vectors[rows] - vector
            d = np.sqrt((apart * apart).sum(1))
            good = (self.ids[rows] != own) & (d <= reach)
            if good.any():
                best_d, best_id = np.append(best_d, d[good]), np.append(best_id, self.ids[rows][good])
                if len(best_d) > k:
                    order = np.lexsort((best_id, best_d))[:k]
                    best_d, best_id = best_d[order], best_id[order]
                if len(best_d) == k:
                    reach = min(limit, float(best_d.max()))
        order = np.lexsort((best_id, best_d))
        return list(zip(best_d[order].tolist(), best_id[order].tolist(), strict=True))


def usable(embeddings: DataFrame) -> DataFrame:
    """(vec_id, vector) of the rows that take part: ids and vectors without nulls, finite, not zero, all as wide as the widest.

    A shorter vector is filled up with zeros.
    """
    vector = F.col("embedding").cast("array<double>")
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), vector.alias("vector")).where(
        "vec_id IS NOT NULL AND vector IS NOT NULL AND size(vector) > 0"
    )
    odd = F.exists(
        "vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    )
    rows = rows.where(~odd & F.exists("vector", lambda x: x != 0))
    least, most = rows.agg(F.min(F.size("vector")), F.max(F.size("vector"))).first()
    if least == most:
        return rows
    missing = F.array_repeat(F.lit(0.0), F.lit(most) - F.size("vector"))
    return rows.withColumn("vector", F.concat("vector", missing))


def _salted(rows: DataFrame, counts: list[int], most: int, key: Column, name: str) -> DataFrame:
    """Number the parts of at most about ``most`` rows that each leaf's rows fall into."""
    parts = F.get(F.array(*[F.lit(max(1, -(-n // most))) for n in counts]), F.col("leaf"))
    return rows.withColumn(name, F.pmod(F.xxhash64(key), parts).cast("int"))


FOUND = "query_id long, vec_id long, score double"


def _search(blocks: DataFrame, queries: DataFrame, k: int, stop: float, width: int, dimensions: int, seed: int) -> DataFrame:
    """Search every (leaf, block, batch) of vectors for the queries that visit it."""

    def run(data: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        rows: list[tuple] = []
        if len(data) and len(asked):
            basis = projection(width, dimensions, seed)
            vectors, wanted = np.stack(data["vector"].to_numpy()), np.stack(asked["vector"].to_numpy())
            tree = LeafTree(data["vec_id"].to_numpy(), vectors, vectors @ basis)
            for own, vector, point, limit in zip(
                asked["query_id"].tolist(), wanted, wanted @ basis, asked["reach"].tolist(), strict=True
            ):
                rows += [(own, i, d) for d, i in tree.search(own, vector, point, k, limit, stop)]
        return pd.DataFrame(rows, columns=["query_id", "vec_id", "score"]).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})

    keys = ["leaf", "block", "batch"]
    return blocks.groupBy(*keys).cogroup(queries.groupBy(*keys)).applyInPandas(run, FOUND)


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _meet(blocks: DataFrame, visits: DataFrame, sizes: list[int]) -> tuple[DataFrame, DataFrame]:
    """Vectors and visiting queries under the keys (leaf, block, batch) that bring them together."""
    asked = [0] * len(sizes)
    for row in visits.groupBy("leaf").count().collect():
        asked[row["leaf"]] = row["count"]
    batches = F.get(F.array(*[F.lit(-(-n // BATCH_QUERIES)) for n in asked]), F.col("leaf"))
    parts = F.get(F.array(*[F.lit(max(1, -(-n // BLOCK_ROWS))) for n in sizes]), F.col("leaf"))
    data = blocks.where(batches > 0).withColumn("batch", F.explode(F.sequence(F.lit(0), batches - 1)))
    queries = _salted(visits, asked, BATCH_QUERIES, F.col("query_id"), "batch")
    return data, queries.withColumn("block", F.explode(F.sequence(F.lit(0), parts - 1)))


def nearest(
    embeddings: DataFrame,
    is_query: Column,
    k: int = NEIGHBOURS,
    certainty: float = CERTAINTY,
    dimensions: int = DIMENSIONS,
    leaf_rows: int = LEAF_ROWS,
    seed: int = SEED,
) -> DataFrame:
    """(query_id, rank, vec_id, score) of the ``k`` nearest rows found for each row that ``is_query`` selects.

    ``is_query`` is a condition on ``vec_id``. All other rows are candidates, by Euclidean
    distance in double precision, ties to the smaller vec_id. Rows whose vector is null, empty, zero,
    not finite or holds a null take no part; of unequal lengths, the shorter vector is compared as if it
    ended in zeros. Of exactly equal vectors only the ``k + 1`` smallest ids can be among anyone's
    nearest, so others of them are left out. Rows equal in id and vector count once. Rows that share
    only their id are candidates of their own, but none for that id's query, which is made with the
    smallest of their vectors. An empty table gives no rows. Other columns are not read.
    """
    spark = embeddings.sparkSession
    ship(spark)
    # k + 1 ids of a group of equal vectors: the window keeps few per task before it shuffles
    same = Window.partitionBy("vector").orderBy("vec_id")
    rows = usable(embeddings)
    few = rows.withColumn("n", F.dense_rank().over(same)).where(F.col("n") <= k + 1).drop("n")
    points = stage(few.dropDuplicates(["vector", "vec_id"]), "ann-vectors")
    total = points.count()
    if total == 0:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    sample = points.where(F.pmod(F.xxhash64("vec_id"), F.lit(1 << 30)) < F.lit(int((1 << 30) * min(1.0, SAMPLE_ROWS / total))))
    width = points.select(F.size("vector")).first()[0]

    def project(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        plane = projection(width, dimensions, seed)
        for batch in batches:
            if len(batch):
                yield pd.DataFrame({"point": list(np.stack(batch["vector"].to_numpy()) @ plane)})

    def projected(chosen: DataFrame, most: int) -> np.ndarray:
        """A few numbers for each of at most ``most`` rows; the vectors stay where they are."""
        found = chosen.select("vector").mapInPandas(project, "point array<double>").limit(most).toPandas()["point"]
        return np.stack(found.to_numpy()) if len(found) else np.zeros((0, dimensions))

    drawn = projected(sample, 2 * SAMPLE_ROWS)
    tree = UpperTree.fit(drawn if len(drawn) else projected(points, 1), min(MOST_LEAVES, -(-total // leaf_rows)))

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        plane = projection(width, dimensions, seed)
        for batch in batches:
            if len(batch):
                point = np.stack(batch["vector"].to_numpy()) @ plane
                yield batch.assign(leaf=tree.leaf(point), point=list(point))

    dealt = stage(points.mapInPandas(deal, "vec_id long, vector array<double>, leaf int, point array<double>"), "ann-leaves")
    edge = [f(F.get("point", F.lit(i))).alias(f"{f.__name__}{i}") for i in range(dimensions) for f in (F.min, F.max)]
    leaves = 1 << tree.depth
    sizes, low, high = [0] * leaves, np.full((leaves, dimensions), np.inf), np.full((leaves, dimensions), np.inf)
    for row in dealt.groupBy("leaf").agg(F.count(F.lit(1)).alias("n"), *edge).collect():
        sizes[row["leaf"]] = row["n"]
        low[row["leaf"]] = [row[f"min{i}"] for i in range(dimensions)]
        high[row["leaf"]] = [row[f"max{i}"] for i in range(dimensions)]
    stop = chi_square_quantile(certainty, dimensions)
    blocks = _salted(dealt.select("leaf", "vec_id", "vector"), sizes, BLOCK_ROWS, F.col("vec_id"), "block")
    # queries are all selected rows, also those beyond the k + 1 of a group of equal vectors
    asking = rows.where(is_query).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    queries = stage(asking.mapInPandas(deal, "vec_id long, vector array<double>, leaf int, point array<double>"), "ann-queries")
    queries = queries.withColumnRenamed("vec_id", "query_id")

    home = queries.select("leaf", "query_id", "vector", F.lit(float("inf")).alias("reach"))
    first = stage(_best(_search(*_meet(blocks, home, sizes), k, stop, width, dimensions, seed), k), "ann-home")
    reach = first.groupBy("query_id").agg(F.when(F.count(F.lit(1)) == k, F.max("score")).alias("reach"))
    bound = queries.join(reach, "query_id", "left").withColumn("reach", F.coalesce("reach", F.lit(float("inf"))))

    def visit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                point = np.array(row.point)
                gap = np.maximum(np.maximum(low - point, point - high), 0)
                near = (gap * gap).sum(1) <= stop * row.reach**2
                near &= np.isfinite(low[:, 0])
                near[row.leaf] = False
                if near.any():
                    to = np.flatnonzero(near)
                    yield pd.DataFrame(
                        {"leaf": to, "query_id": row.query_id, "vector": [row.vector] * len(to), "reach": row.reach}
                    )

    found = first.select("query_id", "vec_id", "score")
    if leaves > 1:
        visits = stage(bound.mapInPandas(visit, "leaf int, query_id long, vector array<double>, reach double"), "ann-visits")
        found = found.unionByName(_search(*_meet(blocks, visits, sizes), k, stop, width, dimensions, seed))
    return _best(found, k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
