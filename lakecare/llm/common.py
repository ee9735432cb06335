"""What the corpus operators share: table access and module shipping to executors."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import lakecare

_SHIPPED: set[str] = set()


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def whole_text(column: str = "text") -> Column:
    """The text as it is; a null one counts as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def remainder(column: str, divisor: int) -> Column:
    """crc32 of the id written as decimal text, modulo ``divisor``; null ids fall into 0."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % divisor, F.lit(0))


def ship(spark: SparkSession) -> None:
    """Give executors this package, as functions in Python workers import it by name.

    Only the package's own source goes out, once per application, by Spark's file service.
    """
    application = spark.sparkContext.applicationId
    if application in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(lakecare.__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="lakecare-code-"), "lakecare-src.zip")
    with zipfile.ZipFile(path, "w") as bundle:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    bundle.write(full, os.path.relpath(full, os.path.dirname(root)))
    spark.sparkContext.addPyFile(path)
    _SHIPPED.add(application)
