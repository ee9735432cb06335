"""Parquet tables: overwrite, upsert, clustering, run log, checked copies.

A versioned table is a folder with one sub-folder per published version and a small
``CURRENT`` file naming the live one. A version is written completely before the name
changes, so a lost executor or a failed job leaves readers on the old version. One
writer at a time.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from datetime import datetime
from functools import reduce
from math import ceil, sqrt

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from lakecare.operators.merge import merge_upsert, require_unique
from lakecare.operators.quality import content_measures
from lakecare.session import freed_shuffles, owned_scratch, stage
from lakecare.sinks.evolution import column_history, conform, declared, merged_layout
from lakecare.sources.rescue import Split, convert, write_split

POINTER = "CURRENT"
BUCKET = "_bucket"
SLICE = "_slice"
CODEC = "zstd"  # of stored Parquet tables; about a quarter smaller than by default


class CopyMismatchError(RuntimeError):
    """What was read back differs from what was written."""


class TableLayoutError(ValueError):
    """A table exists in another layout, or with other buckets or keys."""


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, target = _fs(spark, path)
    return fs.exists(target)


def table_exists(spark: SparkSession, path: str) -> bool:
    """True for a published version or a folder holding data (not just staging leftovers)."""
    fs, folder = _fs(spark, path)
    if not fs.exists(folder):
        return False
    names = [entry.getPath().getName() for entry in fs.listStatus(folder)]
    if POINTER in names:
        return True
    return any(not n.startswith(("_", ".")) or n.startswith(f"{BUCKET}=") for n in names if n != "versions")


def pointer_text(spark: SparkSession, path: str) -> str | None:
    pointer = f"{path}/{POINTER}"
    return spark.read.text(pointer, wholetext=True).first()[0] if path_exists(spark, pointer) else None


def _bucket_map(pointer: str | None) -> dict | None:
    """Bucket count, keys and live folder per bucket of a bucketed table; None for any other."""
    return json.loads(pointer) if pointer and pointer.startswith("{") else None


def current_path(spark: SparkSession, path: str) -> str:
    name = pointer_text(spark, path)
    return path if name is None else f"{path}/versions/{name}"


def _layout_of(live: dict, folder: str) -> str:
    """The columns that the files of a version folder were written with."""
    return live.get("layouts", {}).get(folder, live["schema"])


def _read_buckets(spark: SparkSession, path: str, live: dict, buckets: Sequence[int] | None = None) -> DataFrame:
    """The live folders in the table's present layout: one scan for each layout that is still in use."""
    present = StructType.fromDDL(live["schema"])
    by_layout: dict[str, list[str]] = {}
    for b in live["folders"] if buckets is None else [str(b) for b in buckets if str(b) in live["folders"]]:
        folder = live["folders"][b]
        by_layout.setdefault(_layout_of(live, folder), []).append(f"{path}/versions/{folder}/{BUCKET}={b}")
    scans = [conform(spark.read.schema(layout).parquet(*paths), present) for layout, paths in by_layout.items()]
    return reduce(DataFrame.unionByName, scans) if scans else spark.createDataFrame([], present)


def table_columns(spark: SparkSession, path: str) -> list[dict]:
    """(name, type, since) of a bucketed table's columns; ``since`` counts its upserts from 1."""
    live = _bucket_map(pointer_text(spark, path))
    return live.get("columns", []) if live else []


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The live version, the live folder of each bucket, or the folder itself for a plain table."""
    pointer = pointer_text(spark, path)
    live = _bucket_map(pointer)
    if live is not None:
        return _read_buckets(spark, path, live)
    return spark.read.format(fmt).load(path if pointer is None else f"{path}/versions/{pointer}")


def overwrite_table(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    dynamic: bool = False,
    fmt: str = "parquet",
    gather: bool = True,
    count_into: Observation | None = None,
    sort_by: Sequence[str] = (),
) -> None:
    """Replace the table and its schema, or with ``dynamic`` only the partitions present in ``df``.

    Rows are gathered per partition value before the write, so a partition is a few
    files instead of one per task; the rebalance hint splits a partition that is too big.
    ``sort_by`` orders the rows of each file, so that its row groups hold narrow ranges.
    ``count_into`` receives ``rows``, counted in the writing tasks themselves, where a
    repeated task is counted once.
    """
    if partition_by and gather:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    if sort_by:
        df = df.sortWithinPartitions(*partition_by, *sort_by)
    if count_into is not None:
        df = df.observe(count_into, F.count(F.lit(1)).alias("rows"))
    writer = df.write.format(fmt).mode("overwrite")
    if fmt == "parquet":
        writer = writer.option("compression", CODEC)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if dynamic:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    with freed_shuffles(df.sparkSession):
        writer.save(path)


def switch_pointer(spark: SparkSession, path: str, name: str) -> None:
    """Write the pointer beside the live one and rename it over: readers see the old or the new, never part of one."""
    fs, pointer = _fs(spark, f"{path}/{POINTER}")
    _, side = _fs(spark, f"{path}/_{POINTER}-{uuid.uuid4().hex}")
    out = fs.create(side, True)
    out.write(bytearray(name.encode()))
    out.close()
    options = spark._jvm.org.apache.hadoop.fs.Options.Rename
    renames = spark.sparkContext._gateway.new_array(options, 1)
    renames[0] = options.OVERWRITE
    spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(pointer.toUri(), spark._jsc.hadoopConfiguration()).rename(
        side, pointer, renames
    )


def publish_version(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), gather: bool = True, sort_by: Sequence[str] = ()
) -> str:
    """Write a new version beside the live one, then switch the pointer to it."""
    name = uuid.uuid4().hex
    overwrite_table(df, f"{path}/versions/{name}", partition_by, gather=gather, sort_by=sort_by)
    switch_pointer(df.sparkSession, path, name)
    return name


def upsert_table(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    keys: Sequence[str],
    partition_by: Sequence[str] = (),
    newer_by: str | None = None,
    unique: bool = False,
    sort_by: Sequence[str] = (),
    evolve: bool = False,
) -> None:
    """Create the table on the first run, merge by key afterwards (new version each time).

    A repeated source key raises; ``unique`` skips that check for a deduplicated source. With
    ``evolve`` the new version has the columns of both sides, each as wide as either needs it;
    what a row does not bring is null. A source that is used more than once, by the check or by both
    sides of a merge, is written once first instead of being computed each time.
    """
    if _bucket_map(pointer_text(spark, path)) is not None:
        raise TableLayoutError(f"{path} holds a bucketed table")
    exists = table_exists(spark, path)
    with owned_scratch(spark):
        if not unique or (exists and newer_by is None):
            source = stage(source, "upsert")
        if not unique:
            require_unique(source, keys)
        if exists:
            live = read_table(spark, path)
            if evolve:
                layout = merged_layout(live.schema, source.schema)
                live, source = conform(live, layout), conform(source, layout)
            source = merge_upsert(live, source, keys, newer_by)
        publish_version(source, path, partition_by, sort_by=sort_by)


def upsert_bucketed(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    keys: Sequence[str],
    buckets: int = 256,
    newer_by: str | None = None,
    unique: bool = False,
    sort_by: Sequence[str] = (),
    evolve: bool = False,
    gather: bool = True,
) -> None:
    """Upsert that rewrites only the key buckets the source touches, each sorted by ``sort_by``.

    The touched buckets are written as new folders and the pointer, which names one folder per
    bucket, is switched last: a run stopped at any step leaves the old table, and repeating it
    gives the same result. The bucket count is stored with the table; another one, another key
    or a versioned table at the path is refused. Old folders stay until ``vacuum``. Choose
    ``buckets`` so that one holds a few gigabytes, since that is the unit rewritten.

    Without ``evolve`` a source of another layout is refused. With it, columns are added and types
    grow; untouched buckets keep their files, whose own layout the pointer remembers, and are read
    in the table's present one. A row takes all columns of its source, so what that lacks is null.
    Key columns keep their type, which decides their bucket. Without ``gather`` a task writes the rows of
    each bucket it holds instead of dealing them out by bucket first: one shuffle less, more files.
    """
    pointer = pointer_text(spark, path)
    live = _bucket_map(pointer)
    if pointer is not None and live is None:
        raise TableLayoutError(f"{path} holds a versioned table")
    if live is not None and (live["buckets"], live["keys"]) != (buckets, list(keys)):
        raise TableLayoutError(f"{path} has {live['buckets']} buckets of {live['keys']}")
    layout = StructType([StructField(f.name, f.dataType) for f in source.schema.fields])
    if live is not None:
        present = StructType.fromDDL(live["schema"])
        layout = _agreed_layout(path, present, layout, keys, evolve)
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
    incoming = conform(source, layout).withColumn(BUCKET, bucket)
    folders = dict(live["folders"]) if live else {}
    name = uuid.uuid4().hex
    if not folders and unique:  # nothing to check or merge: used once, and the files written tell the buckets
        overwrite_table(incoming, f"{path}/versions/{name}", [BUCKET], gather=gather, sort_by=sort_by)
        touched = _written_buckets(spark, f"{path}/versions/{name}")
        if live is not None and not touched:
            return
    else:
        incoming = stage(incoming, "upsert")
        if not unique:
            require_unique(incoming, keys)
        touched = sorted(r[0] for r in incoming.select(BUCKET).distinct().collect())  # at most ``buckets`` values
        if live is not None and not touched:
            return
        if any(str(b) in folders for b in touched):
            target = conform(_read_buckets(spark, path, live, touched), layout).withColumn(BUCKET, bucket)
            incoming = merge_upsert(target, incoming, keys, newer_by)
        overwrite_table(incoming, f"{path}/versions/{name}", [BUCKET], gather=gather, sort_by=sort_by)
    layouts = {f: _layout_of(live, f) for f in set(folders.values())} if live else {}
    folders |= {str(b): name for b in touched}
    change = (live.get("change", 0) if live else 0) + 1
    written = declared(layout)
    switch_pointer(
        spark,
        path,
        json.dumps(
            {
                "buckets": buckets,
                "keys": list(keys),
                "schema": written,
                "change": change,
                "columns": column_history(live.get("columns", []) if live else [], layout, change),
                "folders": folders,
                "layouts": {f: layouts.get(f, written) for f in sorted(set(folders.values()))},
            }
        ),
    )


def _written_buckets(spark: SparkSession, version: str) -> list[int]:
    """The buckets that a written version has files of."""
    fs, folder = _fs(spark, version)
    names = [entry.getPath().getName() for entry in fs.listStatus(folder)]
    return sorted(int(n.removeprefix(f"{BUCKET}=")) for n in names if n.startswith(f"{BUCKET}="))


def _agreed_layout(path: str, present: StructType, brought: StructType, keys: Sequence[str], evolve: bool) -> StructType:
    """The layout of a table after an upsert of ``brought``."""
    if {f.name: f.dataType for f in present} == {f.name: f.dataType for f in brought}:
        return present
    if not evolve:
        raise TableLayoutError(f"{path} has the columns {declared(present)}; the source has {declared(brought)}")
    layout = merged_layout(present, brought)
    if any(layout[k].dataType != side[k].dataType for k in keys for side in (present, brought)):
        raise TableLayoutError(f"{path}: a key column changes its type")
    return layout


def vacuum(spark: SparkSession, path: str) -> list[str]:
    """Delete the version folders that the pointer no longer names; run it when no reader holds an older one."""
    pointer = pointer_text(spark, path)
    if pointer is None:
        return []
    live = _bucket_map(pointer)
    named = set(live["folders"].values()) if live else {pointer}
    fs, folder = _fs(spark, f"{path}/versions")
    gone = [e.getPath() for e in fs.listStatus(folder) if e.getPath().getName() not in named]
    for old in gone:
        fs.delete(old, True)
    return sorted(old.getName() for old in gone)


def cluster_table(spark: SparkSession, path: str, columns: Sequence[str], files: int, partition_by: Sequence[str] = ()) -> str:
    """Rewrite a table so that files hold narrow ranges of each of ``columns`` (min/max file skipping).

    Coarse ranges of the first column come first, about the square root of ``files``; inside
    each the rows are cut into ranges of the other columns. Values too frequent for one file
    are cut on by the other columns and a hash of the row.
    """
    pointer = pointer_text(spark, path)
    if _bucket_map(pointer) is not None:
        raise TableLayoutError(f"{path} is bucketed; sort its buckets as they are written")
    live = read_table(spark, path)
    first, *others = columns
    row = F.xxhash64(*live.columns)
    coarse = ceil(sqrt(files)) if others else files
    sliced = live.repartitionByRange(coarse, *partition_by, *columns, row).withColumn(SLICE, F.spark_partition_id())
    if others:
        sliced = sliced.repartitionByRange(files, SLICE, *partition_by, *others, first, row)
    clustered = sliced.sortWithinPartitions(*partition_by, SLICE, *others, first).drop(SLICE)
    return publish_version(clustered, path, partition_by, gather=False)


def land(df: DataFrame, path: str, columns: dict[str, str]) -> None:
    """Typed landing copy: each column is converted, a value that does not convert becomes null."""
    df.select(*[F.col(c).try_cast(t).alias(c) for c, t in columns.items()]).write.mode("overwrite").parquet(path)


def land_rescued(df: DataFrame, path: str, columns: dict[str, str], required: Sequence[str] = ()) -> Split:
    """Typed landing copy that loses nothing: ``<path>/_set=good`` and, for rows that lost a required cell,
    ``<path>/_set=quarantined``. Cells that do not convert stay as text in ``_rescued``; counts come from the write."""
    return write_split(convert(df.select(*columns), columns), path, required, list(columns))


def checked_copy(df: DataFrame, path: str, name: str) -> DataFrame:
    """Write ``df`` and compare rows and content checksum with what is read back.

    The written side is measured while it is written, so the source is read once.
    """
    spark = df.sparkSession
    seen = Observation(f"copy-{uuid.uuid4().hex}")
    measures = content_measures(df.schema)
    df.observe(seen, *measures).write.mode("overwrite").parquet(path)
    written = seen.get
    checksum = F.lit(str(written["checksum"])).cast("decimal(30,0)") if written["checksum"] is not None else F.lit(None)
    back = spark.read.schema(df.schema).parquet(path).agg(*content_measures(df.schema))
    same = (F.col("rows") == F.lit(written["rows"])) & F.col("checksum").eqNullSafe(checksum)
    return back.select(
        F.lit(name).alias("table_name"),
        F.lit(written["rows"]).cast("bigint").alias("rows_read"),
        F.col("rows").alias("rows_written"),
        same.alias("consistent"),
    )


def require_copy(df: DataFrame, path: str, name: str) -> int:
    """``checked_copy`` that raises on a difference; returns the rows copied."""
    outcome = checked_copy(df, path, name).first()
    if not outcome["consistent"]:
        raise CopyMismatchError(f"{name}: {outcome.asDict()}")
    return outcome["rows_written"]


def logged_copy(
    df: DataFrame, path: str, log: str, pipeline: str, run_id: str, at: datetime
) -> int:
    """A checked copy with its run record, written on success and on failure alike."""
    try:
        rows = require_copy(df, path, pipeline)
    except Exception:
        log_run(df.sparkSession, log, pipeline, run_id, "Failed", None, at)
        raise
    log_run(df.sparkSession, log, pipeline, run_id, "Succeeded", rows, at)
    return rows


RUN_LOG = "pipeline_name string, run_id string, status string, rows_copied bigint, run_time timestamp"


def log_run(spark: SparkSession, path: str, pipeline: str, run_id: str, status: str, rows: int | None, at: datetime) -> None:
    """Append one run record; also called when a copy failed."""
    spark.createDataFrame([(pipeline, run_id, status, rows, at)], RUN_LOG).write.mode("append").parquet(path)
