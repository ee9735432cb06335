"""Landing folder to bronze by a manifest: each delivered file is converted once, then archived.

A delivery is a file as it lay in the landing folder: its name, size, time stamp and a digest of
its lines. A name that comes again with another stamp or content is another delivery, and the
age of a file plays no part. The manifest is a log of what became of each; only files it holds as
converted are moved, and only if they are still the delivery that was converted.

A batch takes four steps, and a run stopped after any of them is mended by the next run:

1. its rows are written to a staging folder of its number, which a repeated batch replaces;
2. the manifest records its files as converted: from here on the batch counts;
3. the staging folder is renamed into the run date's folder;
4. its files are moved to the archive, and the manifest records that.

One run at a time.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from lakecare.functions.clock import AsOf, run_date_folder
from lakecare.session import delete_path
from lakecare.sources.rescue import GOOD, MALFORMED, QUARANTINED, RESCUED, SPLIT, read_csv_rescued, write_split

MANIFEST = (
    "batch bigint, name string, size bigint, modified bigint, digest string, rows bigint, "
    "quarantined bigint, state string, folder string"
)
CONVERTED, ARCHIVED, REPLACED, GONE = "converted", "archived", "replaced", "gone"
QUARANTINE = "_quarantine"
SOURCE_FILE = "_source_file"
FILES_PER_BATCH = 1000


def land_csv_files(
    spark: SparkSession,
    landing: str,
    schema: StructType,
    bronze: str,
    run_date: AsOf,
    checkpoint: str,
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Convert the CSV files not seen before to Parquet in the run-date folder, then stop.

    For folders in which no name comes twice and nothing is moved: the checkpoint knows files by
    their path. ``land_and_archive`` takes deliveries of any kind.
    """
    reader = (
        spark.readStream.schema(schema)
        .option("header", "true")
        .option("enforceSchema", "false")
        .option("nullValue", "NULL")
    )
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    rows = reader.csv(landing).withColumn(SOURCE_FILE, F.col("_metadata.file_name"))
    return (
        rows.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .option("path", f"{bronze}/{run_date_folder(run_date)}")
        .trigger(availableNow=True)
        .start()
    )


class Folder:
    """The few file-system calls that landing needs."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.path_of = spark._jvm.org.apache.hadoop.fs.Path
        self.fs = self.path_of(path).getFileSystem(spark._jsc.hadoopConfiguration())
        self.root = self.fs.makeQualified(self.path_of(path)).toString().rstrip("/")

    def files(self) -> dict[str, tuple[int, int]]:
        """Name below the root -> (size, modification time in ms) of all visible files."""
        found, entries = {}, self.fs.listFiles(self.path_of(self.root), True) if self.exists("") else None
        while entries is not None and entries.hasNext():
            entry = entries.next()
            name = entry.getPath().toString()[len(self.root) + 1 :]
            if not any(part.startswith(("_", ".")) for part in name.split("/")):
                found[name] = (entry.getLen(), entry.getModificationTime())
        return found

    def stat(self, name: str) -> tuple[int, int] | None:
        if not self.exists(name):
            return None
        entry = self.fs.getFileStatus(self.at(name))
        return entry.getLen(), entry.getModificationTime()

    def at(self, name: str):
        return self.path_of(f"{self.root}/{name}" if name else self.root)

    def uri(self, name: str) -> str:
        """As ``_metadata.file_path`` shows it."""
        return self.at(name).toUri().toString()

    def exists(self, name: str) -> bool:
        return self.fs.exists(self.at(name))

    def move(self, name: str, target: str) -> None:
        to = self.path_of(target)
        self.fs.mkdirs(to.getParent())
        if not self.fs.rename(self.at(name), to):
            raise OSError(f"{name} could not be moved to {target}")


def read_manifest(spark: SparkSession, manifest: str) -> DataFrame:
    """The log of deliveries; empty before the first one."""
    return spark.read.schema(MANIFEST).parquet(manifest) if Folder(spark, manifest).exists("") else spark.createDataFrame([], MANIFEST)


def deliveries(log: DataFrame) -> DataFrame:
    """One row per delivery, with what became of it last."""
    settled = F.when(F.col("state") == CONVERTED, 0).otherwise(1)
    return log.groupBy(*[c for c in log.columns if c != "state"]).agg(F.max_by("state", settled).alias("state"))


def _record(spark: SparkSession, manifest: str, rows: Sequence[tuple]) -> None:
    spark.createDataFrame(list(rows), MANIFEST).coalesce(1).write.mode("append").parquet(manifest)


def _digests(spark: SparkSession, paths: Sequence[str]) -> dict[str, str]:
    """An order-free digest of each file's lines; a large file is read by many tasks."""
    lines = spark.read.text(list(paths)).select(F.col("_metadata.file_path").alias("path"), F.xxhash64("value").alias("h"))
    summed = lines.groupBy("path").agg(F.sum(F.col("h").cast("decimal(20,0)")).alias("digest"))
    return {r["path"]: str(r["digest"]) for r in summed.collect()}  # one row per file of the batch


def _convert(
    spark: SparkSession, source: Folder, names: Sequence[str], schema: StructType, staging: str, required: Sequence[str]
) -> list[tuple]:
    """Write the rows of the named files to ``staging``; (name, size, stamp, digest, rows, quarantined) of each.

    A file that changes while it is read is left out, and the others are read again.
    """
    listed = source.files()
    names = [n for n in names if n in listed]
    while names:
        before = {n: listed[n] for n in names}
        paths = [source.at(n).toString() for n in names]
        rows = read_csv_rescued(spark, paths, schema).withColumn("_path", F.col("_metadata.file_path"))
        named = rows.withColumn(SOURCE_FILE, F.element_at(F.split("_path", "/"), -1))
        write_split(named, staging, required)
        digests = _digests(spark, paths)
        listed = source.files()
        same = [n for n in names if listed.get(n) == before[n]]
        if same == names:
            counted = (
                spark.read.parquet(staging).groupBy("_path")
                .agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col(SPLIT) == QUARANTINED).alias("quarantined"))
                .collect()
            )
            found = {r["_path"]: r for r in counted}
            none = Row(rows=0, quarantined=0)
            return [
                (n, *before[n], digests.get(uri, "0"), found.get(uri, none)["rows"], found.get(uri, none)["quarantined"])
                for n in names
                for uri in [source.uri(n)]
            ]
        names = same
    delete_path(spark, staging)
    return []


def _publish(spark: SparkSession, bronze: str, batch: int, folder: str) -> None:
    """Rename both sides of a staged batch to where readers look; what is there already stays."""
    base = Folder(spark, bronze)
    for side, target in ((GOOD, folder), (QUARANTINED, f"{QUARANTINE}/{folder}")):
        staged = f"_staging/batch={batch}/{SPLIT}={side}"
        if base.exists(staged):
            base.move(staged, f"{base.root}/{target}/batch={batch}")


def _settle(spark: SparkSession, source: Folder, manifest: str, bronze: str, archive: str) -> list[str]:
    """Publish and archive every converted delivery that is still waiting for it; returns the names moved."""
    waiting = deliveries(read_manifest(spark, manifest)).where(F.col("state") == CONVERTED).collect()
    moved, records = [], []
    target = Folder(spark, archive)
    for batch, folder in sorted({(r["batch"], r["folder"]) for r in waiting}):
        _publish(spark, bronze, batch, folder)
    for r in waiting:
        kept = f"{r['folder']}/batch={r['batch']}/{r['name']}"
        now = source.stat(r["name"])
        if now is None:
            state = ARCHIVED if target.exists(kept) else GONE
        elif now != (r["size"], r["modified"]):
            state = REPLACED  # another delivery lies there by now, and has its own turn
        else:
            source.move(r["name"], f"{target.root}/{kept}")
            state = ARCHIVED
            moved.append(r["name"])
        records.append((r["batch"], r["name"], r["size"], r["modified"], r["digest"], r["rows"], r["quarantined"], state, r["folder"]))
    if records:
        _record(spark, manifest, records)
    return moved


def _chunks(names: Sequence[str], size: int) -> Iterator[list[str]]:
    at = iter(names)
    while chunk := list(itertools.islice(at, size)):
        yield chunk


def land_and_archive(
    spark: SparkSession,
    landing: str,
    schema: StructType,
    bronze: str,
    run_date: AsOf,
    checkpoint: str,
    archive: str,
    files_per_batch: int | None = None,
    required: Sequence[str] = (),
) -> list[str]:
    """Convert every file that lies in ``landing`` and move it to the archive; returns the names moved.

    Good rows lie in ``<bronze>/<run date>/batch=<n>``; rows that lost a ``required`` cell, or whose
    line is malformed, in ``<bronze>/_quarantine/<run date>/batch=<n>``. Both keep the raw text of
    cells that did not convert, and the file they came from. The archive has a folder for
    each run date and batch, so a name may come any number of times. ``checkpoint`` holds the manifest.
    A file that comes or changes during the run waits for the next one.
    """
    source, manifest, folder = Folder(spark, landing), f"{checkpoint}/manifest", run_date_folder(run_date)
    moved = _settle(spark, source, manifest, bronze, archive)
    batch = (read_manifest(spark, manifest).agg(F.max("batch")).first()[0] or 0) + 1
    for names in _chunks(sorted(source.files()), files_per_batch or FILES_PER_BATCH):
        files = _convert(spark, source, names, schema, f"{bronze}/_staging/batch={batch}", required)
        if not files:
            continue
        _record(
            spark,
            manifest,
            [(batch, name, size, at, digest, rows, bad, CONVERTED, folder) for name, size, at, digest, rows, bad in files],
        )
        moved += _settle(spark, source, manifest, bronze, archive)
        batch += 1
    return sorted(moved)


def read_landed(spark: SparkSession, bronze: str, checkpoint: str, schema: StructType, quarantined: bool = False) -> DataFrame:
    """The rows of all batches that count, with their lineage, rescued cells, run date folder and batch."""
    base = Folder(spark, bronze)
    done = read_manifest(spark, f"{checkpoint}/manifest").select("batch", "folder").distinct().collect()
    prefix = f"{QUARANTINE}/" if quarantined else ""
    # a batch recorded and not yet renamed is published first
    for r in done:
        _publish(spark, bronze, r["batch"], r["folder"])
    paths = [p for r in done if base.exists(p := f"{prefix}{r['folder']}/batch={r['batch']}")]
    columns = [f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields]
    layout = ", ".join([*columns, f"{RESCUED} map<string,string>", f"{MALFORMED} string", f"{SOURCE_FILE} string"])
    if not paths:
        return spark.createDataFrame([], layout)
    return spark.read.schema(layout).parquet(*[f"{base.root}/{p}" for p in paths])
