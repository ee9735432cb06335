"""SimHash near-duplicates by the generalised pigeonhole principle.

Fingerprints within ``distance`` bits are linked. The 64 bits are split into parts, correlated
bits together, and each part gets its own threshold so that ``sum(threshold + 1) = distance + 1``:
two linked fingerprints then differ by no more than the threshold in at least one part. A
dynamic program picks the thresholds, and the number of parts, by estimated candidates and
probes. A part is probed with every change of its bits up to the threshold; candidates are
verified on all bits.

The work is done on distinct fingerprints. A crowded bucket, such as a large group of near
copies, would give all its pairs; its members go another, exact way: each sends itself and all
its one-bit (for a distance of three or four, two-bit) changes, and fingerprints that share one
are linked through the smallest of them. So rows stay proportional to the fingerprints.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakecare.llm.common import ship, whole_text
from lakecare.session import stage

BITS = 64
SHINGLE = 3
DISTANCE = 2
SEED = 42
#: Members of a bucket that are still paired with each other; larger buckets take the other way.
CROWD = 32
#: A probe row costs about as much as this many candidate pairs.
PROBE_COST = 1.0


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """Bit by bit majority over the hashes of the text's word shingles, as an unsigned number."""
    words = text.encode().lower().split()  # bytes: only A-Z and only ASCII white space
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        ends = np.cumsum([len(w) + 1 for w in words])
        starts = [0, *ends[: -shingle].tolist()]
        stops = (ends[shingle - 1 :] - 1).tolist()
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b], SEED) for a, b in zip(starts, stops, strict=True)]
    counts = np.zeros(BITS, np.int64)
    values = np.array(hashes, dtype="<u8")
    for at in range(0, len(values), 1 << 16):
        part = values[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = 2 * counts > len(values)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(documents: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, text_hash, fp) for every row; ``fp`` is the fingerprint as a signed long."""
    ship(documents.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_signed(fingerprint(t.as_py(), shingle)) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found, pa.int64())], ["doc_id", "text_hash", "fp"]
            )

    rows = documents.select("doc_id", F.xxhash64("text").alias("text_hash"), whole_text().alias("text"))
    return rows.mapInArrow(run, "doc_id long, text_hash long, fp long")


# Parts and thresholds -------------------------------------------------------------------


def bit_table(points: DataFrame) -> tuple[int, np.ndarray]:
    """How many fingerprints there are, and for each pair of bits how many set both: a fixed 64 by 64 table."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, both = 0, np.zeros((BITS, BITS))
        for batch in batches:
            values = np.ascontiguousarray(batch["fp"].to_numpy()).view(np.uint8).reshape(-1, 8)
            bits = np.unpackbits(values, axis=1, bitorder="little").astype(np.float32)
            n, both = n + len(bits), both + bits.T @ bits
        rows, columns = np.indices((BITS, BITS))
        yield pd.DataFrame({"a": rows.ravel(), "b": columns.ravel(), "n": n, "both": both.ravel()})

    summed = points.mapInPandas(count, "a int, b int, n long, both double").groupBy("a", "b")
    found = summed.agg(F.sum("n").alias("n"), F.sum("both").alias("both")).toPandas()
    both = np.zeros((BITS, BITS))
    both[found["a"], found["b"]] = found["both"]
    return int(found["n"].max()) if len(found) else 0, both


def agreement(n: int, both: np.ndarray) -> np.ndarray:
    """Chance that two fingerprints agree on both bits of a pair (on the diagonal: on that bit)."""
    ones = np.diag(both) / max(n, 1)
    p11 = both / max(n, 1)
    p10, p01 = ones[:, None] - p11, ones[None, :] - p11
    p00 = 1 - p11 - p10 - p01
    joint = p11**2 + p10**2 + p01**2 + p00**2
    np.fill_diagonal(joint, ones**2 + (1 - ones) ** 2)
    return joint


def group_bits(joint: np.ndarray, parts: int) -> list[list[int]]:
    """Chains of bits: each next bit is the one whose agreement depends most on the last."""
    single = np.diag(joint)
    pull = np.abs(joint - np.outer(single, single))
    np.fill_diagonal(pull, -1)
    free, chain = set(range(1, BITS)), [0]
    while free:
        chain.append(max(sorted(free), key=lambda b: pull[chain[-1], b]))
        free.discard(chain[-1])
    return [x.tolist() for x in np.array_split(np.array(chain), parts)]


def part_chance(joint: np.ndarray, part: list[int], threshold: int) -> float:
    """Estimated chance that two fingerprints differ by ``threshold`` bits or fewer in a part.

    Agreement on all its bits follows the chain of the part; differing bits are taken as independent.
    """
    single = np.diag(joint)
    same = float(np.prod([single[part[0]], *(joint[a, b] / single[a] for a, b in zip(part, part[1:], strict=False))]))
    odds = np.ones(1)
    for b in part:
        odds = np.convolve(odds, [1, (1 - single[b]) / single[b]])[: threshold + 1]
    return min(1.0, same * float(odds.sum()))


def allocate(
    n: int, joint: np.ndarray, distance: int, probe_cost: float = PROBE_COST
) -> list[tuple[list[int], int]]:
    """Parts with thresholds of least estimated cost; parts that need no probing (threshold -1) are left out."""
    best: tuple[float, list[tuple[list[int], int]]] | None = None
    for count in range(1, distance + 3):
        parts = group_bits(joint, count)
        costs = [
            [0.0]
            + [
                probe_cost * n * sum(comb(len(part), i) for i in range(t + 1))
                + n * n * part_chance(joint, part, t) / 2
                for t in range(distance + 1)
            ]
            for part in parts
        ]
        # least[s]: cheapest way to spend s = sum(threshold + 1) on the parts so far
        least: list[tuple[float, list[int]]] = [(0.0, [])] + [(np.inf, [])] * (distance + 1)
        for cost in costs:
            least = [
                min(((least[s - k][0] + cost[k], [*least[s - k][1], k - 1]) for k in range(s + 1)), key=lambda x: x[0])
                for s in range(distance + 2)
            ]
        total, thresholds = least[distance + 1]
        chosen = [(p, t) for p, t in zip(parts, thresholds, strict=True) if t >= 0]
        if best is None or total < best[0]:
            best = (total, chosen)
    return best[1]


# Search ---------------------------------------------------------------------------------


def _mask(bits: tuple[int, ...] | list[int]) -> int:
    return _signed(sum(1 << b for b in bits))


def _changes(bits: list[int], most: int) -> list[int]:
    return [_mask(x) for k in range(most + 1) for x in combinations(bits, k)]


def _flipped(value: Column, masks: list[int]) -> Column:
    return F.explode(F.transform(F.array(*map(F.lit, masks)), lambda m: value.bitwiseXOR(m)))


def links(points: DataFrame, distance: int = DISTANCE, crowd: int = CROWD) -> DataFrame:
    """(a, b), a < b, over distinct ``points(fp)``: the same connected groups as all pairs within ``distance``.

    ``points`` must be stored, as it is read several times.
    """
    n, both = bit_table(points)
    if n < 2:
        return points.select(F.col("fp").alias("a"), F.col("fp").alias("b")).limit(0)
    plan = allocate(n, agreement(n, both), distance)
    keyed = [
        points.select(
            "fp",
            F.lit(i).alias("part"),
            F.col("fp").bitwiseAND(_mask(part)).alias("key"),
        )
        for i, (part, _) in enumerate(plan)
    ]
    index = stage(_union(keyed), "simhash-index")
    crowded = stage(
        index.groupBy("part", "key").count().where(F.col("count") > crowd).select("part", "key"), "simhash-crowded"
    )
    probes = _union(
        [
            index.where(F.col("part") == i).select(
                "fp", "part", _flipped(F.col("key"), _changes(part, threshold)).alias("key")
            )
            for i, (part, threshold) in enumerate(plan)
        ]
    )
    calm = index.join(crowded, ["part", "key"], "left_anti")
    near = (
        probes.withColumnRenamed("fp", "a")
        .join(calm.withColumnRenamed("fp", "b"), ["part", "key"])
        .where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance)
        .where("a <> b")
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    )
    hot = probes.join(crowded, ["part", "key"]).select("fp")
    hot = hot.unionByName(index.join(crowded, ["part", "key"], "left_semi").select("fp")).distinct()
    return near.unionByName(shared_changes(hot, distance)).distinct()


def shared_changes(points: DataFrame, distance: int) -> DataFrame:
    """Links of all ``points(fp)`` within ``distance``, through the changes they share; no bucket is paired out.

    For an even distance, sharing a change of half as many bits means lying within the
    distance. For an odd one the changes of one side are one bit longer, and only those of the
    other side are gathered.
    """
    half, longer = distance // 2, distance - distance // 2
    everything = list(range(BITS))
    short = points.select("fp", _flipped(F.col("fp"), _changes(everything, half)).alias("key"))
    centre = short.groupBy("key").agg(F.min("fp").alias("centre"))
    far = (
        short
        if longer == half
        else points.select("fp", _flipped(F.col("fp"), _changes(everything, longer)).alias("key"))
    )
    return (
        far.join(centre, "key")
        .where("fp <> centre")
        .select(F.least("fp", "centre").alias("a"), F.greatest("fp", "centre").alias("b"))
        .distinct()
    )


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def components(edges: DataFrame, most_rounds: int = 64) -> DataFrame:
    """(node, component): each node of ``edges(a, b)`` with the smallest node it is connected to.

    Large-star and small-star rounds in turn; each round's edges are written to the shared
    folder, so a lost executor costs one round at most.
    """

    def both_ways(e: DataFrame) -> DataFrame:
        return e.select("a", "b").unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))

    def star(e: DataFrame, larger: bool) -> DataFrame:
        sides = both_ways(e)
        lowest = sides.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        around = sides.where("b > a") if larger else sides.where("b <= a").unionByName(lowest.select("a", F.col("a").alias("b")))
        return around.join(lowest, "a").select(F.col("m").alias("a"), "b").where("a <> b").distinct()

    current = stage(edges, "simhash-edges")
    total = None
    for _ in range(most_rounds):
        after = stage(star(star(current, larger=True), larger=False), "simhash-edges")
        now = after.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        current = after
        if now == total:
            break
        total = now
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    return both_ways(current).groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("component"))


def near_duplicates(
    documents: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, crowd: int = CROWD
) -> DataFrame:
    """(doc_id, text_hash, fp, component_id) for every row of ``documents(doc_id, text)``.

    ``component_id`` is the smallest doc_id connected by links of ``distance`` bits or fewer.
    Null and blank texts have fingerprint zero and are linked like any other. A null doc_id
    stays and never names a component (which is null if it has no other id). Repeated rows
    are documents of one fingerprint.
    """
    docs = stage(fingerprints(documents, shingle), "simhash-docs")
    groups = stage(docs.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-groups")
    linked = components(links(groups.select("fp"), distance, crowd))
    member = groups.join(linked, groups["fp"] == linked["node"], "left").select(
        "fp", "first_id", F.coalesce("component", "fp").alias("component")
    )
    member = stage(member, "simhash-members")
    smallest = member.groupBy("component").agg(F.min("first_id").alias("component_id"))
    return docs.join(member.join(smallest, "component").select("fp", "component_id"), "fp").select(
        "doc_id", "text_hash", "fp", "component_id"
    )


def keep_first(documents: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """One row of each group of near-duplicates: its smallest doc_id (null last), then text hash.

    Of rows with that id and text any one stays. Null and empty texts are one group with blank ones.
    All columns are kept, whatever their names; an empty table stays empty.
    """
    found = near_duplicates(documents, shingle, distance)
    group = F.struct(F.col("component_id").alias("id"), F.when(F.col("component_id").isNull(), F.col("fp")).alias("fp"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_hash")).alias("first")
    kept = found.groupBy(group.alias("group")).agg(first).select("first.doc_id", "first.text_hash").distinct()
    kept = stage(kept.select(*_key(F.col("doc_id")), "text_hash"), "simhash-kept")
    # the id in two columns without nulls, so that joining and deduplicating share one shuffle
    packed = documents.select(F.struct("*").alias("doc"), *_key(F.col("doc_id")), F.xxhash64("text").alias("text_hash"))
    key = ["id", "unnamed", "text_hash"]
    return packed.join(kept, key, "left_semi").dropDuplicates(key).select("doc.*")


def _key(doc_id: Column) -> list[Column]:
    return [F.coalesce(doc_id, F.lit(0)).alias("id"), doc_id.isNull().alias("unnamed")]
