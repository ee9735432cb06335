"""Layouts that change: columns that come later, and types that grow."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Each type and the wider ones that hold all its values.
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}
#: Digits that a double keeps of any whole number.
_DOUBLE_DIGITS = 15


class LayoutChangeError(ValueError):
    """A column changes to a type that cannot hold its old values."""


def wider(old: T.DataType, new: T.DataType) -> T.DataType | None:
    """The narrower of the types that hold all values of both; None if neither side can grow into one."""
    if old == new:
        return old
    for a, b in ((old, new), (new, old)):
        if isinstance(a, _WHOLE) and isinstance(b, _WHOLE):
            return b if _WHOLE.index(type(b)) > _WHOLE.index(type(a)) else a
        if isinstance(a, T.FloatType) and isinstance(b, T.DoubleType):
            return b
        if isinstance(a, _WHOLE) and isinstance(b, T.DoubleType):
            return b if _DIGITS[type(a)] <= _DOUBLE_DIGITS else None
        if isinstance(a, (T.DecimalType, *_WHOLE)) and isinstance(b, T.DecimalType):
            whole = a.precision - a.scale if isinstance(a, T.DecimalType) else _DIGITS[type(a)]
            scale = max(b.scale, a.scale if isinstance(a, T.DecimalType) else 0)
            precision = max(whole, b.precision - b.scale) + scale
            return T.DecimalType(precision, scale) if precision <= 38 else None
        if isinstance(a, T.DateType) and isinstance(b, (T.TimestampType, T.TimestampNTZType)):
            return b
    return None


def merged_layout(old: T.StructType, new: T.StructType) -> T.StructType:
    """The old columns in their order, as wide as either side needs them, then the new ones. All may be null."""
    later = {f.name: f for f in new.fields}
    fields = []
    for f in old.fields:
        kind = wider(f.dataType, later[f.name].dataType) if f.name in later else f.dataType
        if kind is None:
            raise LayoutChangeError(f"{f.name}: {f.dataType.simpleString()} and {later[f.name].dataType.simpleString()}")
        fields.append(T.StructField(f.name, kind))
    known = set(old.names)
    return T.StructType(fields + [T.StructField(f.name, f.dataType) for f in new.fields if f.name not in known])


def conform(df: DataFrame, layout: T.StructType) -> DataFrame:
    """The columns of ``layout`` in its order and types; one that ``df`` lacks is null."""
    present = {f.name: f.dataType for f in df.schema.fields}
    columns = []
    for f in layout.fields:
        value = F.col(f"`{f.name}`") if f.name in present else F.lit(None)
        columns.append((value if present.get(f.name) == f.dataType else value.cast(f.dataType)).alias(f.name))
    return df.select(*columns)


def declared(layout: T.StructType) -> str:
    """Plain column declarations, readable by ``StructType.fromDDL``."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in layout.fields)


def column_history(before: list[dict], layout: T.StructType, change: int) -> list[dict]:
    """(name, type, since) of each column; ``since`` is the change that gave the column its present type."""
    known = {c["name"]: c for c in before}
    found = []
    for f in layout.fields:
        kind, old = f.dataType.simpleString(), known.get(f.name)
        found.append(old if old and old["type"] == kind else {"name": f.name, "type": kind, "since": change})
    return found
