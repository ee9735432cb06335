"""One read, many sinks: a repeated batch changes nothing, late rows correct their windows."""

import json
import os

import pytest
from pyspark.sql import functions as F

from lakecare.schemas import VITALS_EVENT
from lakecare.streaming import fanout, vitals
from tests.test_streaming import event, rows

DELIVERIES = [
    [event(0), event(1, heart_rate=200), "junk"],
    [event(12, patient="P2", spo2=80.0), event(30), {"patient_id": "timeless"}],
    [event(2, heart_rate=30), event(31), event(3, patient="P3"), event(29, patient="P2")],
    ["more junk"],
    [event(90)],
]


def text(message):
    return message if isinstance(message, str) else json.dumps(message)


def deliver(folder, number):
    os.makedirs(f"{folder}/in", exist_ok=True)
    with open(f"{folder}/in/{number}.txt", "w") as out:
        out.writelines(text(m) + "\n" for m in DELIVERIES[number])


def streamed(spark, folder, sinks, numbers):
    for number in numbers:
        deliver(folder, number)
        source = spark.readStream.schema("value string").text(f"{folder}/in")
        fanout.start_fan_out(source, sinks, f"{folder}/c", once=True).awaitTermination()


def content(spark, sinks):
    found = {s: rows(fanout.read_sink(spark, sinks, s)) for s in (fanout.ALERTS, fanout.REJECTS, fanout.LATE, fanout.STATES)}
    return found | {"closed": rows(fanout.read_sink(spark, sinks, fanout.CLOSED)), "open": rows(fanout.open_windows(spark, sinks))}


@pytest.fixture
def sinks(folder):
    return fanout.Sinks(f"{folder}/out", buckets=4)


def expected(spark, folder):
    events = [m for d in DELIVERIES for m in d if not isinstance(m, str) and "event_time" in m]
    os.makedirs(f"{folder}/all", exist_ok=True)
    with open(f"{folder}/all/a.json", "w") as out:
        out.writelines(json.dumps(e) + "\n" for e in events)
    return spark.read.schema(VITALS_EVENT).json(f"{folder}/all")


def test_windows_after_correction_equal_the_batch_result(spark, folder, sinks):
    streamed(spark, folder, sinks, range(5))
    events = expected(spark, folder)
    got = content(spark, sinks)
    columns = fanout.open_windows(spark, sinks).columns
    assert got["closed"] + got["open"] and sorted(got["closed"] + got["open"], key=repr) == rows(vitals.vitals_windows(events).select(*columns))
    assert len(got["open"]) == 1
    alerts = fanout.read_sink(spark, sinks, fanout.ALERTS).drop("batch")
    assert rows(alerts) == rows(vitals.vitals_alerts(events))
    assert sorted(r["reason"] for r in fanout.read_sink(spark, sinks, fanout.REJECTS).collect()) == ["no_event_time", "unparsed", "unparsed"]
    late = fanout.read_sink(spark, sinks, fanout.LATE)
    assert sorted((r["patient_id"], r["heart_rate"], r["batch"]) for r in late.collect()) == [("P1", 30, 2), ("P3", 80, 2)]


def test_a_repeated_batch_changes_nothing(spark, folder, sinks):
    streamed(spark, folder, sinks, range(5))
    before = content(spark, sinks)
    for number in (2, 4, 0):
        again = spark.createDataFrame([(text(m),) for m in DELIVERIES[number]], "value string")
        fanout.take_batch(again, number, sinks)
        assert content(spark, sinks) == before


def test_a_batch_stopped_between_its_sinks_is_mended_by_its_repetition(spark, folder, sinks, monkeypatch):
    streamed(spark, folder, sinks, range(2))
    with monkeypatch.context() as patch:
        patch.setattr(fanout, "_close_windows", lambda *args: 1 / 0)
        with pytest.raises(Exception, match="division"):
            streamed(spark, folder, sinks, [2])
    streamed(spark, folder, sinks, [3, 4])
    columns = fanout.open_windows(spark, sinks).columns
    got = content(spark, sinks)
    assert sorted(got["closed"] + got["open"], key=repr) == rows(vitals.vitals_windows(expected(spark, folder)).select(*columns))


def test_only_junk_gives_rejects_alone(spark, folder, sinks):
    junk = spark.createDataFrame([("x",), (None,)], "value string")
    fanout.take_batch(junk, 0, sinks)
    assert fanout.read_sink(spark, sinks, fanout.REJECTS).count() == 2
    assert fanout.read_sink(spark, sinks, fanout.CLOSED) is None
    assert fanout.open_windows(spark, sinks).count() == 0
    assert fanout.watermark_before(spark, sinks, None) is None
    assert junk.where(F.col("value").isNull()).count() == 1
