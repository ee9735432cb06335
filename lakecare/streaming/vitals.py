"""Vitals: windowed aggregates and threshold alerts.

The transformations take batch and streaming frames alike. Every streaming query gets its
own checkpoint, so each reads the source at its own pace.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from lakecare.schemas import VITALS_EVENT

# Window width, keys, alert thresholds (first match names the alert).
WINDOW = "5 minutes"
WINDOW_KEYS = ("patient_id", "device_id", "ward_id")
HEART_RATE_HIGH, HEART_RATE_LOW = 150, 40
SPO2_LOW, SYSTOLIC_HIGH, TEMPERATURE_HIGH = 90, 180, 39.5
ALERT_HEART, ALERT_SPO2, ALERT_PRESSURE, ALERT_FEVER = "CRITICAL_HR", "CRITICAL_SPO2", "CRITICAL_BP", "HIGH_FEVER"
ALERT_OTHER = "WARNING"
LATE_BY = "5 minutes"


def read_vitals_kafka(
    spark: SparkSession, servers: str, topic: str, starting: str = "earliest", options: Mapping[str, str] | None = None
) -> DataFrame:
    """JSON messages of one topic (vitals, wearables or any other of this layout).

    Needs the Kafka connector on the class path. One task per topic partition.
    """
    raw = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .options(**(options or {}))
        .load()
    )
    return decode_vitals(raw, "value")


def decode_vitals(messages: DataFrame, column: str, schema: StructType = VITALS_EVENT) -> DataFrame:
    """UTF-8 JSON to columns. Messages without an event time are left to ``rejected_messages``."""
    parsed = messages.select(F.from_json(F.col(column).cast("string"), schema).alias("v"))
    return parsed.select("v.*").where(F.col("event_time").isNotNull())


def rejected_messages(messages: DataFrame, column: str, schema: StructType = VITALS_EVENT) -> DataFrame:
    """The messages that ``decode_vitals`` passes over, all their columns and a ``reason``.

    ``empty`` messages are null, ``unparsed`` ones no JSON of the layout, ``no_event_time`` ones
    lack the time alone. Takes batch and streaming frames, so a stream can keep them in files.
    """
    layout = StructType([*schema.fields, StructField("_corrupt", StringType())])
    text = F.col(column).cast("string")
    parsed = F.from_json(text, layout, {"columnNameOfCorruptRecord": "_corrupt"})
    reason = (
        F.when(text.isNull(), "empty").when(F.col("_parsed._corrupt").isNotNull(), "unparsed").otherwise("no_event_time")
    )
    return (
        messages.withColumn("_parsed", parsed)
        .where(F.col("_parsed.event_time").isNull())
        .withColumn("reason", reason)
        .drop("_parsed")
    )


def read_vitals_files(
    spark: SparkSession, path: str, schema: StructType = VITALS_EVENT, fmt: str = "json", files_per_batch: int | None = None
) -> DataFrame:
    """Stream of files landing in a folder.

    ``files_per_batch`` is for files that arrive in order of event time. In a backfill of older
    files the order in which they are read would decide which rows are late: leave it out, so
    that one batch reads them all.
    """
    reader = spark.readStream.format(fmt).schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def with_event_time(df: DataFrame, late_by: str = LATE_BY) -> DataFrame:
    return df.withWatermark("event_time", late_by)


def vitals_windows(
    df: DataFrame, width: str = WINDOW, keys: tuple[str, ...] = WINDOW_KEYS, closed: str = "left", late_by: str | None = None
) -> DataFrame:
    """Tumbling-window aggregates, labelled by the window end.

    ``closed="left"`` gives [start, end) windows. ``closed="right"`` gives (start, end]:
    shifting the event time back by one microsecond puts a boundary event in the window
    it ends. A stream needs ``late_by``; later rows are dropped from closed windows.
    """
    if closed not in ("left", "right"):
        raise ValueError(f"unknown window closing: {closed}")
    timed = df
    if closed == "right":
        timed = timed.withColumn("event_time", F.col("event_time") - F.expr("INTERVAL 1 MICROSECOND"))
    if late_by is not None:
        timed = with_event_time(timed, late_by)
    return (
        timed.groupBy(*keys, F.window("event_time", width))
        .agg(
            F.avg("heart_rate").alias("avg_heart_rate"),
            F.max("heart_rate").alias("max_heart_rate"),
            F.min("heart_rate").alias("min_heart_rate"),
            F.avg("blood_pressure_systolic").alias("avg_bp_systolic"),
            F.avg("blood_pressure_diastolic").alias("avg_bp_diastolic"),
            F.avg("spo2").alias("avg_spo2"),
            F.avg("temperature").alias("avg_temperature"),
            F.count(F.lit(1)).alias("reading_count"),
        )
        .withColumn("window_end_time", F.col("window.end"))
        .drop("window")
    )


def _breaches() -> dict[str, Column]:
    rate = F.col("heart_rate")
    return {
        ALERT_HEART: (rate > HEART_RATE_HIGH) | (rate < HEART_RATE_LOW),
        ALERT_SPO2: F.col("spo2") < SPO2_LOW,
        ALERT_PRESSURE: F.col("blood_pressure_systolic") > SYSTOLIC_HIGH,
        ALERT_FEVER: F.col("temperature") > TEMPERATURE_HIGH,
    }


def vitals_alerts(df: DataFrame) -> DataFrame:
    """Readings past a threshold, stateless and emitted at once. A missing metric breaches nothing."""
    anything, kind = F.lit(False), F
    for name, breached in _breaches().items():
        anything = anything | breached
        kind = kind.when(breached, name)
    return df.where(anything).select(
        *WINDOW_KEYS,
        "heart_rate",
        "spo2",
        "blood_pressure_systolic",
        "temperature",
        "event_time",
        kind.otherwise(ALERT_OTHER).alias("alert_type"),
    )


def _begin(writer, once: bool) -> StreamingQuery:
    return (writer.trigger(availableNow=True) if once else writer).start()


def _by_hour(windows: DataFrame, files_per_hour: int | None) -> DataFrame:
    files = files_per_hour or max(1, windows.sparkSession.sparkContext.defaultParallelism // 8)
    placed = windows.withColumns(
        {
            "date": F.date_format("window_end_time", "yyyy-MM-dd"),
            "hour": F.date_format("window_end_time", "HH"),
        }
    )
    return placed.repartition("date", "hour", F.pmod(F.xxhash64(*windows.columns), F.lit(files)))


def start_window_files(
    windows: DataFrame, path: str, checkpoint: str, once: bool = False, files_per_hour: int | None = None
) -> StreamingQuery:
    """Closed windows to Parquet, foldered by date and hour of the window end.

    Rows of an hour are gathered into ``files_per_hour`` files by key hash, instead of one
    file per hour from every task; the default grows with the cores of the cluster.
    """
    writer = (
        _by_hour(windows, files_per_hour)
        .writeStream.format("parquet")
        .partitionBy("date", "hour")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .option("path", path)
    )
    return _begin(writer, once)


def start_alert_files(alerts: DataFrame, path: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    writer = (
        alerts.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .option("path", path)
    )
    return _begin(writer, once)


def as_messages(alerts: DataFrame) -> DataFrame:
    """Key and JSON value for a message topic; one patient's alerts keep their order, times their microseconds."""
    value = F.to_json(F.struct("*"), {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"})
    return alerts.select(F.col("patient_id").alias("key"), value.alias("value"))


def start_alert_topic(alerts: DataFrame, servers: str, topic: str, checkpoint: str) -> StreamingQuery:
    """Alerts to a Kafka topic. Needs the Kafka connector on the class path."""
    return (
        as_messages(alerts)
        .writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
        .start()
    )


def start_vitals(
    source: DataFrame,
    windows_path: str,
    alerts_path: str,
    checkpoints: str,
    late_by: str = LATE_BY,
    once: bool = False,
    width: str = WINDOW,
    keys: tuple[str, ...] = WINDOW_KEYS,
    closed: str = "left",
    files_per_hour: int | None = None,
) -> tuple[StreamingQuery, StreamingQuery]:
    """One source, two independent queries: window files and alerts."""
    windows = vitals_windows(source, width, keys, closed, late_by)
    return (
        start_window_files(windows, windows_path, f"{checkpoints}/windows", once, files_per_hour),
        start_alert_files(vitals_alerts(source), alerts_path, f"{checkpoints}/alerts", once),
    )


def write_open_windows(
    events: DataFrame,
    query: StreamingQuery,
    path: str,
    width: str = WINDOW,
    keys: tuple[str, ...] = WINDOW_KEYS,
    closed: str = "left",
    files_per_hour: int | None = None,
) -> None:
    """The windows that a finished run holds open, so that nothing it read is missing.

    A stream writes a window once the watermark has passed its end. ``events`` is the source of
    ``query`` as a batch; only what lies behind the last watermark is read. The folder is
    replaced by each run, as a later run closes these windows itself.
    """
    progress = query.lastProgress
    reached = ((progress and progress["eventTime"]) or {}).get("watermark", "1970-01-01T00:00:00.000Z")
    watermark = F.to_timestamp(F.lit(reached))
    recent = events.where(F.col("event_time") >= watermark - F.expr(f"INTERVAL {width}"))
    still_open = vitals_windows(recent, width, keys, closed).where(F.col("window_end_time") > watermark)
    _by_hour(still_open, files_per_hour).write.mode("overwrite").partitionBy("date", "hour").parquet(path)


def late_rows(events: DataFrame, windows: DataFrame) -> int:
    """Rows that came too late for their window: readings in ``events`` less those in ``windows``.

    ``windows`` are all windows of the same events, the open ones too.
    """
    counted = windows.agg(F.coalesce(F.sum("reading_count"), F.lit(0))).first()[0]
    return events.where(F.col("event_time").isNotNull()).count() - counted


def late_groups(query: StreamingQuery) -> int:
    """Partial groups (not rows) dropped behind the watermark, over the retained progress reports."""
    return sum(
        state.get("numRowsDroppedByWatermark", 0)
        for progress in query.recentProgress
        for state in progress["stateOperators"]
    )
