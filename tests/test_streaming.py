import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from lakecare.schemas import BRONZE_PATIENTS, VITALS_EVENT
from lakecare.session import streaming_session
from lakecare.streaming import vitals
from lakecare.streaming.landing import land_and_archive


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def event(minute, second=0, patient="P1", **metrics):
    base = {"heart_rate": 80, "blood_pressure_systolic": 120, "blood_pressure_diastolic": 80, "spo2": 98.0, "temperature": 36.8}
    at = dt.datetime(2024, 1, 15, 10) + dt.timedelta(minutes=minute, seconds=second)
    return {
        "patient_id": patient, "device_id": "D1", "ward_id": "W1", "hospital_id": "H1", "event_time": at.strftime("%Y-%m-%dT%H:%M:%SZ"),
        "respiratory_rate": 16, "glucose_level": 95, **base, **metrics,
    }


def land(folder, name, events):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}.json", "w") as out:
        out.writelines(json.dumps(e) + "\n" for e in events)


@pytest.fixture(scope="module")
def session(spark):
    return streaming_session(spark, 2)


def test_sibling_session_leaves_the_callers_settings(spark, session):
    assert spark.conf.get("spark.sql.shuffle.partitions") == "8"
    assert session.conf.get("spark.sql.shuffle.partitions") == "2"


def test_window_edges(spark, folder):
    land(folder, "a", [event(0), event(5), event(9, 59)])
    df = spark.read.schema(VITALS_EVENT).json(folder)
    ends = lambda closed: [(r.window_end_time.minute, r.reading_count) for r in vitals.vitals_windows(df, closed=closed).orderBy("window_end_time").collect()]
    assert ends("left") == [(5, 1), (10, 2)]
    assert ends("right") == [(0, 1), (5, 1), (10, 1)]
    with pytest.raises(ValueError):
        vitals.vitals_windows(df, closed="both")


def test_stream_equals_batch_and_fans_out(spark, session, folder):
    src = f"{folder}/in"
    events = [event(m, patient=f"P{m % 3}", heart_rate=30 + 10 * m) for m in range(20)]
    land(src, "a", [*events, event(120, patient="closing")])
    source = vitals.read_vitals_files(session, src)
    queries = vitals.start_vitals(source, f"{folder}/w", f"{folder}/a", f"{folder}/c", once=True)
    for q in queries:
        q.awaitTermination()
    everything = spark.read.schema(VITALS_EVENT).json(src)
    windows = spark.read.parquet(f"{folder}/w")
    assert set(windows.columns) >= {"date", "hour"} and os.path.isdir(f"{folder}/w/date=2024-01-15/hour=10")
    batch = vitals.vitals_windows(everything.where("patient_id <> 'closing'"))
    assert rows(windows.select(*batch.columns)) == rows(batch)
    alerts = vitals.vitals_alerts(everything)
    assert rows(spark.read.parquet(f"{folder}/a").select(*alerts.columns)) == rows(alerts)
    assert vitals.late_groups(queries[0]) == 0
    vitals.write_open_windows(everything, queries[0], f"{folder}/open")
    complete = windows.unionByName(spark.read.parquet(f"{folder}/open"))
    assert rows(complete.select(*batch.columns)) == rows(vitals.vitals_windows(everything))
    assert vitals.late_rows(everything, complete) == 0


def test_late_rows_are_dropped_and_counted(spark, session, folder):
    src, paths = f"{folder}/in", (f"{folder}/w", f"{folder}/c")

    def run():
        query = vitals.start_window_files(vitals.vitals_windows(vitals.read_vitals_files(session, src), late_by="5 minutes"), *paths, once=True)
        query.awaitTermination()
        return query

    land(src, "a", [event(0), event(60)])
    run()
    land(src, "b", [event(1), event(2), event(3), event(62), event(180)])
    again = run()  # restarts from the checkpoint
    everything = spark.read.schema(VITALS_EVENT).json(src)
    vitals.write_open_windows(everything, again, f"{folder}/open")
    written = spark.read.parquet(paths[0]).unionByName(spark.read.parquet(f"{folder}/open"))
    assert vitals.late_rows(everything, written) == 3  # one group of the late rows was dropped
    assert vitals.late_groups(again) == 1
    counts = {(r.window_end_time.hour, r.window_end_time.minute): r.reading_count for r in spark.read.parquet(paths[0]).collect()}
    assert counts == {(10, 5): 1, (11, 5): 2}


def test_alert_precedence_and_missing_metrics(spark, folder):
    land(
        folder, "a",
        [
            event(0, patient="hr", heart_rate=151, spo2=80.0),
            event(1, patient="low", heart_rate=39),
            event(2, patient="o2", spo2=89.9, temperature=41.0),
            event(3, patient="bp", blood_pressure_systolic=181, temperature=41.0),
            event(4, patient="fever", temperature=39.6, heart_rate=None),
            event(5, patient="edge", heart_rate=150, spo2=90.0, blood_pressure_systolic=180, temperature=39.5),
            event(6, patient="nulls", heart_rate=None, spo2=None, blood_pressure_systolic=None, temperature=None),
        ],
    )
    alerts = vitals.vitals_alerts(spark.read.schema(VITALS_EVENT).json(folder))
    assert {r.patient_id: r.alert_type for r in alerts.collect()} == {
        "hr": "CRITICAL_HR", "low": "CRITICAL_HR", "o2": "CRITICAL_SPO2", "bp": "CRITICAL_BP", "fever": "HIGH_FEVER",
    }
    message = vitals.as_messages(alerts).where("key = 'hr'").first()
    assert json.loads(message.value)["alert_type"] == "CRITICAL_HR"


def test_messages_decode(spark):
    raw = spark.createDataFrame([(bytearray(json.dumps(event(0)).encode()),), (bytearray(b"junk"),)], "value binary")
    got = vitals.decode_vitals(raw, "value").select("patient_id", F.unix_timestamp("event_time"), "spo2").collect()
    assert [tuple(g) for g in got] == [("P1", 1705312800, 98.0)]


def test_passed_over_messages_are_kept_with_a_reason(spark):
    timeless = {k: v for k, v in event(0).items() if k != "event_time"}
    values = [json.dumps(event(0)), "junk", json.dumps(timeless), None]
    raw = spark.createDataFrame([(i, v and bytearray(v.encode())) for i, v in enumerate(values)], "at int, value binary")
    got = vitals.rejected_messages(raw, "value").select("at", "reason")
    assert rows(got) == [(1, "unparsed"), (2, "no_event_time"), (3, "empty")]


def test_landing_converts_each_file_once_and_archives(spark, folder):
    head = ",".join(BRONZE_PATIENTS.names)

    def drop(name, patient):
        os.makedirs(f"{folder}/in", exist_ok=True)
        with open(f"{folder}/in/{name}.csv", "w") as out:
            out.write(f"{head}\n{patient}{',' * (len(BRONZE_PATIENTS.names) - 1)}\n")

    def run(day):
        return land_and_archive(spark, f"{folder}/in", BRONZE_PATIENTS, f"{folder}/bronze", day, f"{folder}/c", f"{folder}/archive", 1)

    drop("a", "P1")
    drop("b", "P2")
    assert run("2024-01-05") == ["a.csv", "b.csv"]
    assert run("2024-01-05") == []
    first = spark.read.parquet(f"{folder}/bronze/2024/01/05")
    assert rows(first.select("patient_id", "_source_file")) == [("P1", "a.csv"), ("P2", "b.csv")]
    archived = [f for _, _, fs in os.walk(f"{folder}/archive") for f in fs if f.endswith(".csv")]
    assert sorted(archived) == ["a.csv", "b.csv"] and not os.listdir(f"{folder}/in")
