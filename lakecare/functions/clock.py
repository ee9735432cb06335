"""The as-of instant. Nothing in the library reads the wall clock by itself."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

AsOf = date | datetime | str


def as_of_timestamp(as_of: AsOf) -> Column:
    """The as-of instant as a timestamp; a bare date means midnight."""
    return F.lit(str(as_of)).cast("timestamp")


def as_of_date(as_of: AsOf) -> Column:
    return F.lit(str(as_of)[:10]).cast("date")


def run_date_folder(run_date: date | str) -> str:
    """``2024-01-05`` -> ``2024/01/05``, the folder layout of landed files."""
    return "/".join(str(run_date)[:10].split("-"))
