"""Interleaved clustering, compaction of stream output, and the place where two copies differ."""

import pytest
from pyspark.sql import functions as F

from lakecare.sinks import checksums, clustering, tables
from lakecare.streaming import compaction, vitals
from tests.test_streaming import event, land
from lakecare.schemas import VITALS_EVENT
from lakecare.session import streaming_session


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_every_clustered_column_prunes_alike(spark, folder):
    def mixed(seed, most):
        return F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(most))

    wide = spark.range(30000).select(mixed(1, 5000).alias("a"), mixed(2, 60).cast("string").alias("b"), F.when(mixed(3, 3) > 0, mixed(4, 900)).alias("c"))
    tables.publish_version(wide, f"{folder}/t")
    before = rows(tables.read_table(spark, f"{folder}/t"))
    clustering.cluster_interleaved(spark, f"{folder}/t", ["a", "b"], 64)
    assert rows(tables.read_table(spark, f"{folder}/t")) == before
    for column in ("a", "b"):
        values = wide.select(F.col(column).alias("value")).distinct()
        got = clustering.files_opened(spark, f"{folder}/t", column, values).first()
        assert got["files"] >= 60 and got["opened"] <= 20
    sizes = [r["rows"] for r in clustering.file_ranges(spark, f"{folder}/t", "a").collect()]
    assert max(sizes) < 3 * 30000 / len(sizes)
    clustering.cluster_interleaved(spark, f"{folder}/t", ["a", "b", "c"], 27)
    assert rows(tables.read_table(spark, f"{folder}/t")) == before


def test_a_value_in_a_third_of_all_rows_does_not_swell_a_file(spark, folder):
    hot = spark.range(9000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("a"), F.lit(1).alias("b"))
    tables.publish_version(hot, f"{folder}/t")
    clustering.cluster_interleaved(spark, f"{folder}/t", ["a", "b"], 18)
    sizes = [r["rows"] for r in clustering.file_ranges(spark, f"{folder}/t", "a").collect()]
    assert sum(sizes) == 9000 and max(sizes) < 2000
    tables.publish_version(hot.limit(0), f"{folder}/e")
    clustering.cluster_interleaved(spark, f"{folder}/e", ["a"], 4)
    assert tables.read_table(spark, f"{folder}/e").count() == 0


def test_bins_hold_all_files_and_no_more_than_the_target():
    files = [(f"f{i}", s) for i, s in enumerate([70, 10, 50, 50, 30, 20, 200, 40])]
    bins = compaction.packed_bins(files, 100)
    size = dict(files)
    assert sorted(n for b in bins for n in b) == sorted(size)
    assert all(sum(size[n] for n in b) <= 100 or len(b) == 1 for b in bins) and len(bins) == 4


def test_closed_hours_are_packed_and_late_files_join_them(spark, folder):
    session = streaming_session(spark, 4)
    src, out = f"{folder}/in", f"{folder}/w"

    def stream(name, events):
        land(src, name, events)
        windows = vitals.vitals_windows(vitals.read_vitals_files(session, src), late_by="2 hours")
        vitals.start_window_files(windows, out, f"{folder}/c", once=True, files_per_hour=3).awaitTermination()

    stream("a", [event(m, patient=f"P{m % 7}") for m in range(0, 120, 2)] + [event(400)])
    before = rows(spark.read.parquet(out).withColumn("hour", F.col("hour").cast("int")).withColumn("date", F.col("date").cast("string")))
    counts = compaction.file_counts(spark, out)
    assert max(counts.values()) > 1
    done = compaction.compact_hours(spark, out, compaction.Hour("2024-01-15", "12"))
    assert done == ["date=2024-01-15/hour=10", "date=2024-01-15/hour=11"]
    columns = spark.read.parquet(out).columns
    assert rows(compaction.read_compacted(spark, out).select(*columns)) == before
    assert all(compaction.file_counts(spark, out)[h] == 1 for h in done)
    assert compaction.compact_hours(spark, out, compaction.Hour("2024-01-15", "12")) == []
    # a file that comes late for a packed hour is read at once, and packed with the next run
    late = spark.read.parquet(out).where("hour = 10").limit(1).drop("date", "hour")
    late.coalesce(1).write.mode("append").parquet(f"{folder}/late")
    plain = f"{folder}/plain"
    spark.read.parquet(out).write.partitionBy("date", "hour").parquet(plain)
    compaction.compact_hours(spark, plain, compaction.Hour("2024-01-16", "00"))
    late.withColumn("date", F.lit("2024-01-15")).withColumn("hour", F.lit("10")).write.mode("append").partitionBy("date", "hour").parquet(plain)
    assert compaction.read_compacted(spark, plain).count() == len(before) + 1
    compaction.compact_hours(spark, plain, compaction.Hour("2024-01-16", "00"))
    assert compaction.read_compacted(spark, plain).count() == len(before) + 1
    assert compaction.sweep(spark, plain) > 0
    assert compaction.read_compacted(spark, plain).count() == len(before) + 1


def test_a_stop_before_the_switch_leaves_the_small_files(spark, folder, monkeypatch):
    base = spark.createDataFrame([("2024-01-01", "01", i) for i in range(40)], "date string, hour string, x int")
    base.repartition(8).write.partitionBy("date", "hour").parquet(f"{folder}/o")
    with monkeypatch.context() as patch:
        patch.setattr(compaction, "switch_pointer", lambda *args: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            compaction.compact_hours(spark, f"{folder}/o", compaction.Hour("2024-01-02", "00"))
    assert compaction.read_compacted(spark, f"{folder}/o").count() == 40
    assert compaction.compact_hours(spark, f"{folder}/o", compaction.Hour("2024-01-02", "00"))
    assert compaction.read_compacted(spark, f"{folder}/o").select("x").distinct().count() == 40


def test_checksums_name_the_changed_row(spark):
    one = spark.range(5000).select("id", F.col("id").cast("string").alias("s"), F.when(F.col("id") % 5 > 0, F.col("id")).alias("n"))
    assert checksums.mismatch_path(one, one.repartition(3), ["id"]).count() == 0
    two = one.withColumn("s", F.when(F.col("id") == 1234, "x").otherwise(F.col("s")))
    path = checksums.mismatch_path(one, two, ["id"], 3, 4).orderBy("level").collect()
    assert [r["level"] for r in path] == [0, 1, 2, 3] and all(r["rows"] == r["other_rows"] for r in path)
    h = spark.range(1234, 1235).select(F.xxhash64("id")).first()[0]
    assert all(r["first_hash"] <= h <= r["last_hash"] for r in path)
    got = checksums.differing_rows(one, two, ["id"]).collect()
    assert sorted((r["id"], r["s"], r["side"], r["copies"]) for r in got) == [(1234, "1234", "one", 1), (1234, "x", "two", 1)]


def test_missing_and_repeated_rows_and_null_keys_are_found(spark):
    one = spark.createDataFrame([(1, "a"), (1, "a"), (None, "n"), (2, "b")], "id int, s string")
    two = spark.createDataFrame([(1, "a"), (None, None), (2, "b"), (3, "c")], "id int, s string")
    got = checksums.differing_rows(one, two, ["id"]).collect()
    assert sorted(((r["id"], r["s"], r["side"], r["copies"]) for r in got), key=repr) == sorted(
        [(1, "a", "one", 1), (None, "n", "one", 1), (None, None, "two", 1), (3, "c", "two", 1)], key=repr
    )
    assert checksums.differing_rows(one.limit(0), two.limit(0), ["id"]).count() == 0
    assert VITALS_EVENT.names
