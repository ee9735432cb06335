"""Threshold-scaled document sketches: every shingle hash below a fixed fraction of the hash space is kept.

A sketch grows with its document, so containment can be estimated between documents of very
unequal length, and the sketch of a union follows from the sketches. The ``LEAST_KEPT`` smallest
hashes are kept in any case, so that short texts can be compared as well. A fingerprint is the kept
hashes in base64 after a digest of them and a colon: a merged one is written like any other.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakecare.llm.common import ship, whole_text

SHINGLE = 5
FRACTION = 1 / 8
#: Smallest hashes that a sketch keeps whatever the threshold.
LEAST_KEPT = 16
#: Rows of one bucket of neighbouring ids, and the most buckets (larger tables get larger buckets).
BUCKET_ROWS, MOST_BUCKETS = 4000, 20_000


def threshold(fraction: float) -> int:
    return min(int(fraction * 2**64), 2**64 - 1)


@dataclass
class Sketch:
    """Sorted distinct hashes: all up to the threshold, and the smallest ones in any case."""

    kept: np.ndarray
    limit: int  # the threshold

    @staticmethod
    def of(hashes: np.ndarray, limit: int) -> Sketch:
        """The sketch of a set of hashes, or of the kept hashes of several sketches together."""
        values = np.unique(hashes)
        below = int(np.searchsorted(values, np.uint64(limit), "right"))
        return Sketch(values[: max(below, min(LEAST_KEPT, len(values)))], limit)

    @property
    def reach(self) -> int:
        """Up to here the sketch holds every hash of its text."""
        if len(self.kept) < LEAST_KEPT:
            return 2**64 - 1  # all there are
        return max(self.limit, int(self.kept[-1]))

    @property
    def digest(self) -> int:
        return xxhash.xxh64_intdigest(self.kept.astype("<u8").tobytes())

    def text(self) -> str:
        return f"{self.digest:016x}:{base64.b64encode(self.kept.astype('<u8').tobytes()).decode()}"

    @staticmethod
    def parse(text: str, fraction: float = FRACTION) -> Sketch:
        return Sketch(np.frombuffer(base64.b64decode(text.partition(":")[2]), "<u8"), threshold(fraction))

    def contained_in(self, other: Sketch) -> float:
        """Estimated share of this document's shingles that the other one has.

        Only hashes that both sketches would hold are compared. Two texts without a shingle contain
        each other; a short text none of whose hashes a longer one's sketch reaches gives 0.
        """
        own = self.kept[self.kept <= np.uint64(min(self.reach, other.reach))]
        if not len(own):
            return float(np.array_equal(self.kept, other.kept))
        return float(np.isin(own, other.kept, assume_unique=True).mean())

    def merge(self, other: Sketch) -> Sketch:
        """The sketch of both documents' shingles together, in any order and grouping."""
        return Sketch.of(np.concatenate([self.kept, other.kept]), min(self.limit, other.limit))


def shingle_hashes(words: list[str], shingle: int) -> list[int]:
    """XXH64 of each run of ``shingle`` words joined by spaces (of all words, if they are fewer)."""
    if not words:
        return []
    parts = [w.encode("utf-8", "surrogatepass") for w in words]
    joined = b" ".join(parts)
    if len(parts) <= shingle:
        return [xxhash.xxh64_intdigest(joined)]
    ends = np.cumsum([len(p) + 1 for p in parts])
    digest = xxhash.xxh64_intdigest
    starts = [0, *ends[:-shingle].tolist()]
    return [digest(joined[a:b]) for a, b in zip(starts, (ends[shingle - 1 :] - 1).tolist(), strict=True)]


def sketch_of(hashes: list[int], fraction: float) -> Sketch:
    return Sketch.of(np.array(hashes, np.uint64), threshold(fraction))


@dataclass
class Document:
    """One text with its words and shingle hashes, so that an edit rehashes only what it changes."""

    text: str
    words: list[str]
    hashes: list[int]
    sketch: Sketch

    @staticmethod
    def of(text: str, shingle: int, fraction: float) -> Document:
        words = text.split()
        hashes = shingle_hashes(words, shingle)
        return Document(text, words, hashes, sketch_of(hashes, fraction))

    def edited(self, tail: str, kept: int, shingle: int, fraction: float) -> tuple[str, Sketch]:
        """The text with all after ``kept`` code points replaced by ``tail``, and its sketch."""
        text = self.text[:kept] + tail
        same = max(len(self.text[:kept].split()) - 1, 0)  # the last word may go on in the tail
        reused = max(same - shingle + 1, 0)
        if reused == 0:
            return text, sketch_of(shingle_hashes(text.split(), shingle), fraction)
        # words before ``same`` are those of the text; the rest begins with the word at ``same``
        rest = text.split(maxsplit=reused)[-1].split() if len(self.words) > reused else []
        return text, sketch_of(self.hashes[:reused] + shingle_hashes(rest, shingle), fraction)


def _listed(values: list, kind: str) -> Column:
    """A constant array, sent as one text; empty entries are null."""
    if not values:
        return F.array().cast(f"array<{kind}>")
    text = F.split(F.lit(",".join("" if v is None else str(v) for v in values)), ",")
    return F.transform(text, lambda v: F.when(v != "", v)).cast(f"array<{kind}>")


def _bucket(doc_id: Column, h: Column, bounds: list[int], unnamed: int) -> Column:
    """How many of the sorted bounds are not above the id, by halving; rows without an id follow, by ranges of ``h``."""
    table = _listed(bounds, "long")
    steps = [1 << k for k in reversed(range(len(bounds).bit_length()))]
    found = F.aggregate(
        _listed(steps, "int"),
        F.lit(0),
        lambda at, step: F.when(F.coalesce(F.get(table, at + step - 1) <= doc_id, F.lit(False)), at + step).otherwise(at),
    )
    share = F.floor((h.cast("double") / 2.0**64 + 0.5) * unnamed)
    behind = F.lit(len(bounds) + 1) + F.greatest(F.lit(0), F.least(F.lit(unnamed - 1), share)).cast("int")
    return F.when(doc_id.isNull(), behind).otherwise(found)


def with_next(documents: DataFrame, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(bucket, halo, doc_id, h, text), dealt by ranges of ``doc_id`` and sorted, each range closed by the first row of the next.

    Rows without an id come last, by ranges of their text's hash. The ranges' bounds and first rows,
    a few numbers per range, pass through the driver. The texts move once.
    """
    ids = documents.select("doc_id")
    total, named = ids.agg(F.count(F.lit(1)), F.count("doc_id")).first()
    wanted = max(1, min(MOST_BUCKETS, named // bucket_rows))
    unnamed = max(1, min(MOST_BUCKETS, (total - named) // bucket_rows))
    shares = [i / wanted for i in range(1, wanted)]
    bounds = sorted({int(x) for x in ids.where("doc_id IS NOT NULL").approxQuantile("doc_id", shares, 0.1 / wanted)} if shares else [])
    rows = documents.select("doc_id", whole_text().alias("text")).withColumn("h", F.xxhash64("text"))
    rows = rows.withColumn("bucket", _bucket(F.col("doc_id"), F.col("h"), bounds, unnamed))
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "h")
    firsts = sorted(rows.groupBy("bucket").agg(F.min(order).alias("first")).collect())
    if not firsts:
        return rows.withColumn("halo", F.lit(False))
    before = {b["bucket"]: firsts[i - 1]["bucket"] for i, b in enumerate(firsts)}
    size = len(bounds) + 1 + unnamed
    first = {b["bucket"]: b["first"] for b in firsts}

    def lookup(values: list, kind: str) -> Column:
        return F.get(_listed(values, kind), F.col("bucket"))

    closing = (
        F.col("doc_id").eqNullSafe(lookup([first[b]["doc_id"] if b in first else None for b in range(size)], "long"))
    ) & (F.col("h") == lookup([first[b]["h"] if b in first else None for b in range(size)], "long"))
    own = F.struct("bucket", F.lit(False).alias("halo"))
    other = F.struct(lookup([before.get(b) for b in range(size)], "int").alias("bucket"), F.lit(True).alias("halo"))
    places = F.when(closing, F.array(own, other)).otherwise(F.array(own))
    dealt = rows.withColumn("place", F.explode(places)).select("place.bucket", "place.halo", "doc_id", "h", "text")
    # one partition to a bucket: hashing would leave some empty and give others several
    return dealt.repartitionById(size, "bucket").sortWithinPartitions("bucket", "halo", F.col("doc_id").asc_nulls_last(), "h")


RESULT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def document_fingerprints(
    documents: DataFrame, shingle: int = SHINGLE, fraction: float = FRACTION, bucket_rows: int = BUCKET_ROWS
) -> DataFrame:
    """Fingerprint of every text and of its edited text, and how much of it the edited and the next text contain.

    The edited text has its last ``n_chars // 4`` code points replaced by as many of the next
    document's first (or all it has). Documents follow by ascending doc_id, rows with equal ids by
    a hash of their text, rows without an id last; the first follows the last. A null text
    counts as empty; a table of one row is its own successor; an empty table gives no rows. Texts of
    any length are read whole, one at a time; other columns are not read.
    """
    ship(documents.sparkSession)
    dealt = with_next(documents, bucket_rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[int, int | None, Document] | None = None
        for batch in batches:
            rows = []
            for bucket, halo, doc_id, text in zip(
                batch["bucket"].to_pylist(), batch["halo"].to_pylist(), batch["doc_id"].to_pylist(), batch["text"], strict=True
            ):
                if halo and (held is None or held[0] != bucket):
                    continue  # a second copy of a closing row
                now = Document.of(text.as_py(), shingle, fraction)
                if held is not None and held[0] == bucket:
                    rows.append(compare(held[1], held[2], now, shingle, fraction))
                held = None if halo else (bucket, doc_id, now)
            columns = list(zip(*rows, strict=True)) or [[]] * 7
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            names = [part.split()[0] for part in RESULT.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    return dealt.select("bucket", "halo", "doc_id", "text").mapInArrow(run, RESULT)


def compare(doc_id: int | None, own: Document, following: Document, shingle: int, fraction: float) -> tuple:
    count = len(own.text) // 4
    kept = len(own.text) - count
    text, sketch = own.edited(following.text[:count], kept, shingle, fraction)
    return (
        doc_id,
        len(own.text),
        hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest(),
        own.sketch.text(),
        sketch.text(),
        own.sketch.contained_in(sketch),
        own.sketch.contained_in(following.sketch),
    )
