"""Few large files for each closed hour of a stream's output, swapped in by a pointer.

A stream writes many small files into folders by date and hour. Once an hour is closed, its rows are
packed into files of a target size, descending sizes to the first bin with room, in a new folder; a
pointer names the folder that stands for each hour, and is switched last. Readers that go through
the pointer see the small files or the packed ones, never both; the small ones stay until ``sweep``.
"""

from __future__ import annotations

import json
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakecare.session import delete_path
from lakecare.sinks.tables import pointer_text, switch_pointer
from lakecare.streaming.landing import Folder

TARGET_BYTES = 128 << 20
PACKED = "_packed"


@dataclass(frozen=True)
class Hour:
    date: str
    hour: str

    @property
    def folder(self) -> str:
        return f"date={self.date}/hour={self.hour}"


def packed_bins(files: Iterable[tuple[str, int]], target: int) -> list[list[str]]:
    """First-fit decreasing: files in bins of at most ``target`` bytes; a larger file has a bin of its own."""
    bins: list[tuple[int, list[str]]] = []
    for name, size in sorted(files, key=lambda f: (-f[1], f[0])):
        for i, (used, names) in enumerate(bins):
            if used + size <= target:
                bins[i] = (used + size, [*names, name])
                break
        else:
            bins.append((size, [name]))
    return [names for _, names in bins]


def _packs(spark: SparkSession, path: str) -> dict[str, dict]:
    """Hour folder -> the packed folder that stands for it and the small files that went into it."""
    return json.loads(pointer_text(spark, path) or "{}")


def _committed(spark: SparkSession, path: str) -> set[str] | None:
    """The files that the stream's own log counts; None without such a log. A stopped batch may leave others."""
    if not Folder(spark, path).exists("_spark_metadata"):
        return None
    return {uri[uri.index("/date=") + 1 :] for uri in spark.read.parquet(path).inputFiles()}


def hours_of(spark: SparkSession, path: str) -> dict[str, list[tuple[str, int]]]:
    """Hour folder -> (name, size) of the files that the stream has put there."""
    found: dict[str, list[tuple[str, int]]] = {}
    committed = _committed(spark, path)
    for name, (size, _) in Folder(spark, path).files().items():
        folder, _, file = name.rpartition("/")
        counts = file.endswith(".parquet") and folder.startswith("date=")
        if counts and (committed is None or name in committed):
            found.setdefault(folder, []).append((name, size))
    return found


def compact_hours(spark: SparkSession, path: str, closed_before: Hour, target: int = TARGET_BYTES) -> list[str]:
    """Pack every hour before ``closed_before`` that has files not packed yet and would come to fewer; returns the hours.

    Files that come for an hour already packed (a late window) are packed together with its packed ones.
    One writer at a time; a stop before the switch leaves the small files in force.
    """
    live, done = _packs(spark, path), []
    base = Folder(spark, path)
    for folder, files in sorted(hours_of(spark, path).items()):
        known = live.get(folder, {"files": [], "folder": None})
        fresh = [f for f in files if f[0] not in known["files"]]
        if folder >= closed_before.folder or not fresh:
            continue
        old = [(f"{known['folder']}/{n}", s) for n, (s, _) in Folder(spark, f"{path}/{known['folder']}").files().items()] if known["folder"] else []
        bins = packed_bins([*fresh, *old], target)
        if len(bins) >= len(fresh) + len(old):
            continue
        number = 1 + (int(known["folder"].rsplit("-", 1)[1]) if known["folder"] else 0)
        into = f"{PACKED}/{folder}/pack-{number}"
        delete_path(spark, f"{path}/{into}")
        rows = spark.read.parquet(*[f"{base.root}/{n}" for names in bins for n in names])
        # the small files were gathered by key; a bin is a partition, so none is ever held whole
        rows.coalesce(len(bins)).write.parquet(f"{path}/{into}")
        live[folder] = {"folder": into, "files": sorted({*known["files"], *(n for n, _ in fresh)})}
        switch_pointer(spark, path, json.dumps(live))
        done.append(folder)
    return done


def read_compacted(spark: SparkSession, path: str) -> DataFrame:
    """All rows, from packed folders where the pointer names one, else from the small files; with date and hour."""
    live, base = _packs(spark, path), Folder(spark, path)
    paths = [f"{base.root}/{known['folder']}" for known in live.values()]
    for folder, files in hours_of(spark, path).items():
        taken = live[folder]["files"] if folder in live else ()
        paths += [f"{base.root}/{n}" for n, _ in files if n not in taken]
    rows = spark.read.parquet(*paths).withColumn("_path", F.col("_metadata.file_path"))
    date = F.regexp_extract("_path", "/date=([^/]+)/", 1)
    hour = F.regexp_extract("_path", "/hour=([^/]+)/", 1)
    return rows.withColumns({"date": date, "hour": hour.cast("int")}).drop("_path")


def sweep(spark: SparkSession, path: str) -> int:
    """Delete the small files that packed ones stand for; run it when no reader holds an older view. Returns their number."""
    base, count = Folder(spark, path), 0
    for known in _packs(spark, path).values():
        for name in known["files"]:
            if base.exists(name):
                base.fs.delete(base.at(name), False)
                count += 1
    return count


def file_counts(spark: SparkSession, path: str) -> dict[str, int]:
    """Hour folder -> files that a reader opens for it."""
    live, counts = _packs(spark, path), {}
    for folder, files in hours_of(spark, path).items():
        known = live.get(folder)
        loose = [n for n, _ in files if not known or n not in known["files"]]
        counts[folder] = len(loose) + (len([n for n in Folder(spark, f"{path}/{known['folder']}").files() if n.endswith(".parquet")]) if known else 0)
    return counts
