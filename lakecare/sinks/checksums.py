"""Where two copies differ: checksums over ranges of key hashes, compared from coarse to fine.

The leaves of the tree are ranges of the key's hash; a node's checksum is the sum of its rows' hashes,
so parents follow from children and the order of rows plays no part. Each side is read once, to the
finest level; only nodes that differ are followed, and only rows in differing leaves are compared.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakecare.operators.quality import row_hash
from lakecare.session import stage

#: Levels below the root and bits per level: 4 * 4 bits are 65,536 leaves.
DEPTH, BITS = 4, 4


def leaf_of(keys: Sequence[str], depth: int = DEPTH, bits: int = BITS) -> Column:
    """The range that a key's hash falls into; rows with a null key are in ranges as well."""
    return F.shiftrightunsigned(F.xxhash64(*keys), 64 - depth * bits)


def leaves(df: DataFrame, keys: Sequence[str], depth: int = DEPTH, bits: int = BITS) -> DataFrame:
    """(node, rows, checksum) of the finest level, counted on the map side first."""
    return df.groupBy(leaf_of(keys, depth, bits).alias("node")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(row_hash(df.schema).cast("decimal(20,0)")).alias("checksum")
    )


def level_of(finest: DataFrame, level: int, depth: int = DEPTH, bits: int = BITS) -> DataFrame:
    """The nodes of a level (0 is the root) out of the leaves."""
    node = F.shiftrightunsigned("node", (depth - level) * bits) if level else F.lit(0).cast("long")
    return finest.groupBy(node.alias("node")).agg(F.sum("rows").alias("rows"), F.sum("checksum").alias("checksum"))


def differing(one: DataFrame, two: DataFrame) -> DataFrame:
    """(node, rows, other_rows) of the nodes whose rows or checksums disagree; a missing node has none."""
    a, b = one.alias("a"), two.alias("b")
    apart = ~(F.col("a.rows").eqNullSafe(F.col("b.rows")) & F.col("a.checksum").eqNullSafe(F.col("b.checksum")))
    return a.join(b, F.col("a.node") == F.col("b.node"), "full").where(apart).select(
        F.coalesce("a.node", "b.node").alias("node"),
        F.coalesce("a.rows", F.lit(0)).alias("rows"),
        F.coalesce("b.rows", F.lit(0)).alias("other_rows"),
    )


def mismatch_path(one: DataFrame, two: DataFrame, keys: Sequence[str], depth: int = DEPTH, bits: int = BITS) -> DataFrame:
    """(level, node, first_hash, last_hash, rows, other_rows) of every differing node, level by level from the root.

    A level is compared only below the nodes that differ above it. Empty if the copies agree.
    """
    sides = [stage(leaves(df, keys, depth, bits), "checksums") for df in (one, two)]
    found = None
    open_nodes = None
    for level in range(depth + 1):
        nodes = [level_of(s, level, depth, bits) for s in sides]
        if open_nodes is not None:
            above = open_nodes.select(F.col("node").alias("_above"))
            parent = F.shiftrightunsigned("node", bits) if level > 1 else F.lit(0).cast("long")
            nodes = [n.join(above, parent == F.col("_above"), "left_semi") for n in nodes]
        open_nodes = stage(differing(*nodes), "differing")
        # ranges of the hash as the signed number that xxhash64 gives
        width = 64 - level * bits
        first = F.shiftleft("node", width) if level else F.lit(-(2**63)).cast("long")
        last = first + F.lit(2**width - 1).cast("long") if level else F.lit(2**63 - 1).cast("long")
        shown = open_nodes.select(F.lit(level).alias("level"), "node", first.alias("first_hash"), last.alias("last_hash"), "rows", "other_rows")
        found = shown if found is None else found.unionByName(shown)
        if open_nodes.isEmpty():
            break
    return found


def differing_rows(one: DataFrame, two: DataFrame, keys: Sequence[str], depth: int = DEPTH, bits: int = BITS) -> DataFrame:
    """The rows of either side that the other lacks, with ``side`` (one, two) and ``copies``, out of differing leaves alone."""
    sides = [leaves(df, keys, depth, bits) for df in (one, two)]
    nodes = stage(differing(*sides).select(F.col("node").alias("_node")), "differing-leaves")
    counted = []
    for sign, df in ((1, one), (-1, two)):
        part = df.withColumn("_leaf", leaf_of(keys, depth, bits)).join(nodes, F.col("_leaf") == F.col("_node"), "left_semi")
        counted.append(part.select(*df.columns, F.lit(sign).alias("_sign")))
    net = counted[0].unionByName(counted[1]).groupBy(*one.columns).agg(F.sum("_sign").alias("_net")).where("_net <> 0")
    side = F.when(F.col("_net") > 0, "one").otherwise("two")
    return net.select(*one.columns, side.alias("side"), F.abs("_net").alias("copies"))
