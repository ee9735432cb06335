"""Merkle manifest of a dataset with nested-interval labels, in DataFrame operations only.

Rows are leaves, ranked by group and key. Every node of a group's tree is labelled with the
interval ``[lo, hi)`` of leaf ranks that it covers, so containment of intervals is ancestry. A
node's place among its level's nodes is the bucket in which it meets its parent: the containment
join is a hash join on (tree, bucket) and no range join. What a parent covers besides a node's
own interval are the node's siblings. The roots of the groups are the leaves of one more tree.

Trees are built upwards, ``fanout`` nodes to a group; ancestors are attached downwards, level by
level, so the long sibling texts are kept once for each run of nodes and not once for each leaf.
No task holds more than a range of leaves or a run of nodes, whatever the size of a group.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakecare.operators.joins import small
from lakecare.session import stage

FANOUT = 16
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
#: Bits that ``monotonically_increasing_id`` gives to the rows of one partition.
ROW_BITS = 33
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PATH = "array<struct<left:string,right:string>>"


def digest(text: Column) -> Column:
    return F.sha2(text, 256)


def leaf_digest(values: Sequence[Column]) -> Column:
    """Digest of the values in turn, each as its UTF-8 byte count, a colon and itself; a null one as ``-``."""
    parts = []
    for value in values:
        shown = value.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(shown).cast("string"), F.lit(":"), shown), F.lit("-")))
    return digest(F.concat(*parts))


def ranked(rows: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """``rows`` with their 0-based rank, nulls first, cut into sorted ranges of about equal size.

    Only one number for each range passes through a single task. ``order`` must be total.
    """
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = stage(dealt.withColumn("_at", F.monotonically_increasing_id()), f"merkle-{name}")
    part = F.shiftright("_at", ROW_BITS)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(part.alias("_part"))
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    )
    within = F.col("_at").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    joined = placed.withColumn("_part", part).join(F.broadcast(offsets), "_part")  # a row per partition
    return joined.select(*rows.columns, (F.col("_before") + within).alias(name))


@dataclass
class Tree:
    """Levels of one or many trees: the leaves, then each level of runs with its children."""

    levels: list[DataFrame]

    @property
    def top(self) -> DataFrame:
        return self.levels[-1]


def grow(leaves: DataFrame, most: int, fanout: int, name: str) -> Tree:
    """Build upwards from ``leaves(tree, count, place, lo, hi, digest)``; ``most`` is the largest count.

    Trees that have only one node left keep it unchanged up to the common height.
    """
    levels, nodes, height = [leaves], leaves, 0
    while height == 0 or fanout**height < most:
        child = F.struct("lo", "hi", "digest")
        runs = nodes.groupBy("tree", "count", F.floor(F.col("place") / fanout).alias("place")).agg(
            F.array_sort(F.collect_list(child)).alias("children")
        )
        joined = F.array_join(F.col("children.digest"), "")
        nodes = stage(
            runs.select(
                "tree",
                "count",
                "place",
                "children",
                F.get("children", F.lit(0))["lo"].alias("lo"),
                F.element_at("children", -1)["hi"].alias("hi"),
                F.when(F.col("count") > fanout**height, digest(joined))
                .otherwise(F.get("children", F.lit(0))["digest"])
                .alias("digest"),
            ),
            f"merkle-{name}-{height + 1}",
        )
        levels.append(nodes)
        height += 1
    return Tree(levels)


def descend(tree: Tree, above: DataFrame, carried: Sequence[str], fanout: int) -> DataFrame:
    """The leaves of ``tree`` with the path from each up to the top: the siblings left and right of it, level by level.

    ``above`` is the top level with the path that goes on beyond it in ``path``.
    """
    parents = above
    for height in reversed(range(len(tree.levels) - 1)):
        nodes = tree.levels[height].withColumn("bucket", F.floor(F.col("place") / fanout))
        n, p = nodes.alias("n"), parents.alias("p")
        contained = (
            (F.col("n.tree") == F.col("p.tree"))
            & (F.col("n.bucket") == F.col("p.place"))
            & (F.col("p.lo") <= F.col("n.lo"))
            & (F.col("n.hi") <= F.col("p.hi"))
        )

        def siblings(side: Column) -> Column:
            return F.array_join(side["digest"], "")

        left = siblings(F.filter("p.children", lambda c: c["hi"] <= F.col("n.lo")))
        right = siblings(F.filter("p.children", lambda c: c["lo"] >= F.col("n.hi")))
        own = F.array(F.struct(left.alias("left"), right.alias("right")))
        hashed = F.when(F.col("n.count") > fanout**height, own).otherwise(F.array().cast(PATH))
        parents = n.join(p, contained).select(
            *[F.col(f"n.{c}") for c in tree.levels[height].columns],
            *[F.col(f"p.{c}") for c in carried],
            F.concat(hashed, F.col("p.path")).alias("path"),
        )
    return parents


def folded(path: Column, leaf: Column) -> Column:
    """The root that a leaf's digest leads to along its path."""
    return F.aggregate(path, leaf, lambda own, step: digest(F.concat(step["left"], own, step["right"])))


def proofs(
    documents: DataFrame,
    columns: Sequence[str] = COLUMNS,
    group: str = "source",
    key: str = "doc_id",
    changed: Column | None = None,
    fanout: int = FANOUT,
) -> DataFrame:
    """One row per row of ``documents``: (key, lo, leaf, changed_leaf, subroot, root, path).

    A leaf's digest covers ``columns`` in turn. Groups come in byte order, null first; within one,
    leaves ascend by key, null first, and rows of equal key by digest, so repeated rows are
    neighbouring leaves and the roots do not depend on the order of the input. ``changed_leaf`` is
    the digest with ``changed`` in place of the text column. A run is closed by its digest as long
    as its level has more than one node, also if the run has one node alone; a group of one leaf
    is its own subroot, a single group its own root. Texts are read once, whole, and never moved.
    Nulls and empty texts differ. An empty table gives no rows. Other columns are not read.
    """
    values = [F.col(c) for c in columns]
    leaf = leaf_digest(values)
    other = leaf if changed is None else F.coalesce(
        leaf_digest([changed if c == "text" else F.col(c) for c in columns]), leaf
    )
    read = documents.select(
        F.col(key).alias("key"), F.col(group).alias("group"), leaf.alias("leaf"), other.alias("changed_leaf")
    )
    read = stage(read.withColumn("copy", F.monotonically_increasing_id()), "merkle-read")
    order = ranked(read, ["group", "key", "leaf", "copy"], "lo")
    groups = stage(order.groupBy("group").agg(F.min("lo").alias("tree"), F.count(F.lit(1)).alias("count")), "merkle-groups")
    size, most = groups.agg(F.count(F.lit(1)), F.max("count")).first()
    if not size:
        empty = "key long, lo long, leaf string, changed_leaf string, subroot string, root string"
        return documents.sparkSession.createDataFrame([], f"{empty}, path {PATH}").withColumn("key", F.lit(None).cast(documents.schema[key].dataType))
    spans = small(groups.select(F.col("group").alias("_group"), "tree", "count"), size)
    leaves = stage(
        order.join(spans, F.col("group").eqNullSafe(F.col("_group"))).select(
            "tree",
            "count",
            (F.col("lo") - F.col("tree")).alias("place"),
            "lo",
            (F.col("lo") + 1).alias("hi"),
            F.col("leaf").alias("digest"),
            "key",
            "changed_leaf",
        ),
        "merkle-leaves",
    )
    trees = grow(leaves, most, fanout, "group")
    subroots = ranked(trees.top.select("tree", "lo", "hi", "digest"), ["tree"], "place")
    crown = grow(
        stage(
            subroots.select(
                F.lit(0).cast("long").alias("tree"), F.lit(size).cast("long").alias("count"), "place", "lo", "hi", "digest", F.col("tree").alias("group_tree")
            ),
            "merkle-subroots",
        ),
        size,
        fanout,
        "crown",
    )
    root = crown.top.withColumn("root", F.col("digest")).withColumn("path", F.array().cast(PATH))
    tops = descend(crown, root, ["root"], fanout).select(
        F.col("group_tree").alias("tree"), F.col("digest").alias("subroot"), "root", "path"
    )
    above = trees.top.join(tops, "tree")
    return descend(trees, above, ["subroot", "root"], fanout).select(
        "key", "lo", F.col("digest").alias("leaf"), "changed_leaf", "subroot", "root", "path"
    )


def checked(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, leaf, subroot, root, proof_sha256, folded_root, verified) from ``proofs``.

    The proof is the digest of all siblings from the leaf up to the root. The folded root is
    recomputed from the changed leaf; it verifies if it is the root.
    """
    steps = F.transform("path", lambda step: F.concat(step["left"], step["right"]))
    again = found.withColumn("folded_root", folded(F.col("path"), F.col("changed_leaf")))
    return again.select(
        F.col("key").alias(key),
        "leaf",
        "subroot",
        "root",
        digest(F.array_join(steps, "")).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)
