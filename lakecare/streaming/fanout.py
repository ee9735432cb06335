"""One read of the message stream, many sinks: window states, alerts, rejected and late messages.

Every micro-batch is read and decoded once, kept, and written to one folder per sink, named by the
batch: a repeated batch replaces its own folders and nothing else. Windows are kept as mergeable
states (sums, counts, extremes), one row per batch and window, so a window is the merge of its
states whenever they arrived. A reading that comes after its window was closed is kept as a
late row, and the window it corrects is written anew to the table of closed windows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lakecare.sinks.tables import path_exists, read_table, table_exists, upsert_bucketed
from lakecare.streaming.vitals import LATE_BY, WINDOW, WINDOW_KEYS, decode_vitals, rejected_messages, vitals_alerts

ALERTS, REJECTS, LATE, STATES, CLOSED = "alerts", "rejects", "late", "states", "windows"
BATCH = "batch"
#: Averaged readings, and those whose extremes a window shows.
AVERAGED = {
    "heart_rate": "avg_heart_rate",
    "blood_pressure_systolic": "avg_bp_systolic",
    "blood_pressure_diastolic": "avg_bp_diastolic",
    "spo2": "avg_spo2",
    "temperature": "avg_temperature",
}


@dataclass(frozen=True)
class Sinks:
    """Where a stream writes, and how its windows are cut."""

    base: str
    width: str = WINDOW
    keys: tuple[str, ...] = WINDOW_KEYS
    late_by: str = LATE_BY
    column: str = "value"
    buckets: int = 64

    def path(self, sink: str, batch: int | None = None) -> str:
        return f"{self.base}/{sink}" if batch is None else f"{self.base}/{sink}/{BATCH}={batch}"


def window_end(width: str) -> Column:
    return F.window("event_time", width)["end"]


def window_states(readings: DataFrame, keys: Sequence[str], width: str) -> DataFrame:
    """Mergeable state per key and window: a sum and a count of each averaged reading, extremes, rows, newest time."""
    parts = [f(F.col(c)).alias(f"{f.__name__}_{c}") for c in AVERAGED for f in (F.sum, F.count)]
    return readings.groupBy(*keys, window_end(width).alias("window_end_time")).agg(
        *parts,
        F.max("heart_rate").alias("max_heart_rate"),
        F.min("heart_rate").alias("min_heart_rate"),
        F.count(F.lit(1)).alias("reading_count"),
        F.max("event_time").alias("newest"),
    )


def merged_windows(states: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The windows that any number of states of each add up to."""
    averages = [(F.sum(f"sum_{c}") / F.sum(f"count_{c}")).alias(name) for c, name in AVERAGED.items()]
    return states.groupBy(*keys, "window_end_time").agg(
        *averages,
        F.max("max_heart_rate").alias("max_heart_rate"),
        F.min("min_heart_rate").alias("min_heart_rate"),
        F.sum("reading_count").alias("reading_count"),
    )


def read_sink(spark: SparkSession, sinks: Sinks, sink: str) -> DataFrame | None:
    """All rows of a sink with their batch; None before it has any."""
    if sink == CLOSED:
        return read_table(spark, sinks.path(CLOSED)) if table_exists(spark, sinks.path(CLOSED)) else None
    return spark.read.parquet(sinks.path(sink)) if path_exists(spark, sinks.path(sink)) else None


def watermark_before(spark: SparkSession, sinks: Sinks, batch: int | None) -> datetime | None:
    """The newest event time of all batches before ``batch`` (of all, if None), less the allowed lateness."""
    states = read_sink(spark, sinks, STATES)
    if states is None:
        return None
    earlier = states if batch is None else states.where(F.col(BATCH) < batch)
    return earlier.agg((F.max("newest") - F.expr(f"INTERVAL {sinks.late_by}")).alias("at")).first()["at"]


def take_batch(messages: DataFrame, batch: int, sinks: Sinks) -> None:
    """Write one micro-batch to all sinks and bring the closed windows up to date.

    All of it depends on this batch and those before it alone, so a repeated batch changes nothing.
    """
    spark = messages.sparkSession
    kept = messages.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        readings = decode_vitals(kept, sinks.column)
        before = watermark_before(spark, sinks, batch)
        end = window_end(sinks.width)
        late = readings.where(end <= F.lit(before)) if before is not None else readings.where(F.lit(False))
        outputs = {
            ALERTS: vitals_alerts(readings),
            REJECTS: rejected_messages(kept, sinks.column),
            LATE: late.withColumn("window_end_time", end),
            STATES: window_states(readings, sinks.keys, sinks.width),
        }
        for sink, rows in outputs.items():
            rows.write.mode("overwrite").parquet(sinks.path(sink, batch))
    finally:
        kept.unpersist()
    _close_windows(spark, sinks, batch, before)


def _close_windows(spark: SparkSession, sinks: Sinks, batch: int, before: datetime | None) -> None:
    """Upsert the windows that this batch closes, and the closed ones that its late rows correct."""
    after = watermark_before(spark, sinks, batch + 1)
    if after is None:
        return
    keys = [*sinks.keys, "window_end_time"]
    states = read_sink(spark, sinks, STATES).where((F.col(BATCH) <= batch) & (F.col("window_end_time") <= F.lit(after)))
    fresh = states if before is None else states.where(F.col("window_end_time") > F.lit(before))
    due = merged_windows(fresh, sinks.keys)
    if before is not None:
        touched = read_sink(spark, sinks, LATE).where(F.col(BATCH) == batch).select(*keys).distinct()
        old = states.where(F.col("window_end_time") <= F.lit(before))
        same = [old[k].eqNullSafe(touched[k]) for k in keys]
        due = due.unionByName(merged_windows(old.join(touched, same, "left_semi"), sinks.keys))
    upsert_bucketed(spark, sinks.path(CLOSED), due, keys, buckets=sinks.buckets, unique=True)


def open_windows(spark: SparkSession, sinks: Sinks) -> DataFrame:
    """The windows that the watermark has not reached yet, as they stand."""
    states, reached = read_sink(spark, sinks, STATES), watermark_before(spark, sinks, None)
    still = states if reached is None else states.where(F.col("window_end_time") > F.lit(reached))
    return merged_windows(still, sinks.keys)


def start_fan_out(messages: DataFrame, sinks: Sinks, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Run ``take_batch`` on every micro-batch of a message stream."""
    writer = messages.writeStream.option("checkpointLocation", checkpoint).foreachBatch(
        lambda batch, number: take_batch(batch, number, sinks)
    )
    return (writer.trigger(availableNow=True) if once else writer).start()
