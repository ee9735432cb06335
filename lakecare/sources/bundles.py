"""Nested API payloads: bundles of entries to typed rows, with nothing of an entry lost.

A landed bundle is one JSON document per line with a list of entries somewhere inside. It is parsed
once into a variant; entries become rows, declared fields become typed columns by their paths, and what
is not declared, or does not convert, is kept as text beside them.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakecare.sources.rescue import RESCUED

CORRUPT, UNKNOWN, POSITION = "_corrupt_record", "_unknown", "_position"

#: Column -> (path within the entry, type).
Fields = Mapping[str, tuple[str, str]]


def read_bundles(spark: SparkSession, path: str, whole_files: bool = False) -> DataFrame:
    """(bundle, _corrupt_record, _source_file) of each landed document; one that is no JSON is kept as it came.

    ``whole_files`` is for documents that span lines, one to a file.
    """
    rows = spark.read.text(path, wholetext=whole_files).where(F.length(F.trim("value")) > 0)
    parsed = F.try_parse_json("value")
    corrupt = F.when(parsed.isNull(), F.col("value")).alias(CORRUPT)
    return rows.select(parsed.alias("bundle"), corrupt, F.col("_metadata.file_name").alias("_source_file"))


def _top(path: str) -> str:
    """The entry's own field that a path begins with: ``$.claim.id`` -> ``claim``."""
    return path.removeprefix("$.").split(".")[0].split("[")[0]


def _or_null(found: Column) -> Column:
    """A map, or null for an empty one; the map is built once for the test and the result."""
    return F.get(F.filter(F.array(found), lambda m: F.size(m) > 0), F.lit(0))


def typed_fields(rows: DataFrame, entry: str, fields: Fields) -> DataFrame:
    """``rows`` with the declared columns of the column ``entry``, its rescued cells and its undeclared fields as
    JSON text in its place.

    Values are taken in a step of their own, so that each path is followed once and the generated code stays
    small enough to be compiled. Only undeclared fields become text and are read again.
    """
    kept = [c for c in rows.columns if c != entry]
    taken = [F.try_variant_get(entry, path, kind).alias(f"_field_{i}") for i, (path, kind) in enumerate(fields.values())]
    raw = [
        F.struct(F.lit(name).alias("key"), F.when(F.col(f"_field_{i}").isNull(), F.try_variant_get(entry, path, "variant")).alias("value"))
        for i, (name, (path, _)) in enumerate(fields.items())
    ]
    lost = F.filter(F.array(*raw), lambda e: e["value"].isNotNull() & ~F.is_variant_null(e["value"]))
    rescued = F.map_from_entries(F.transform(lost, lambda e: F.struct(e["key"], F.to_json(e["value"]))))
    known = F.array(*map(F.lit, sorted({_top(path) for path, _ in fields.values()})))
    rest = F.map_filter(F.try_variant_get(entry, "$", "map<string,variant>"), lambda k, v: ~F.array_contains(known, k))
    return rows.select(*kept, entry, *taken).select(
        *kept,
        *[F.col(f"_field_{i}").alias(name) for i, name in enumerate(fields)],
        _or_null(rescued).alias(RESCUED),
        F.from_json(F.to_json(_or_null(rest)), "map<string,string>").alias(UNKNOWN),
    )


def bundle_entries(bundles: DataFrame, entries: str, fields: Fields, header: Fields | None = None) -> DataFrame:
    """One row per entry of the list at the path ``entries``: header columns of its bundle, its place, its own columns.

    A bundle without the list, or with an empty one, gives no row; so does a corrupt document, which
    ``corrupt_bundles`` has. Its bundle is null, so it needs no filter, which would parse each document again.
    """
    spark = bundles.sparkSession
    listed = bundles.select(
        *[F.try_variant_get("bundle", path, kind).alias(name) for name, (path, kind) in (header or {}).items()],
        "_source_file",
        F.try_variant_get("bundle", entries, "variant").alias("_entries"),
    )
    each = listed.lateralJoin(spark.tvf.variant_explode(F.col("_entries").outer()))
    kept = [*(header or {}), "_source_file"]
    return typed_fields(each.select(*kept, F.col("pos").alias(POSITION), F.col("value").alias("_entry")), "_entry", fields)


def corrupt_bundles(bundles: DataFrame) -> DataFrame:
    return bundles.where(F.col(CORRUPT).isNotNull()).select(CORRUPT, "_source_file")
