import datetime as dt
import json
import os
import time
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakecare import session
from lakecare.operators.merge import DuplicateKeyError
from lakecare.operators.quality import EmptySourceError
from lakecare.plans import ingest
from lakecare.schemas import BRONZE_CLAIMS, BRONZE_PATIENTS
from lakecare.session import owned_scratch, scratch_path, shared_folder
from lakecare.sinks import evolution, tables
from lakecare.sources import batch, control


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_shared_folder_is_the_named_one(spark):
    first = shared_folder(spark)
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert shared_folder(spark) == first and spark.sparkContext.getCheckpointDir()
    assert named is None or first == named.rstrip("/")
    assert scratch_path(spark, "x").startswith(first) and scratch_path(spark, "x") != scratch_path(spark, "x")


def test_overwrite_replaces_rows_and_schema(spark, folder):
    path = f"{folder}/t"
    tables.overwrite_table(spark.createDataFrame([(1, "a")], "k int, v string"), path)
    tables.overwrite_table(spark.createDataFrame([(2, 3.0)], "k int, w double"), path)
    assert rows(tables.read_table(spark, path)) == [(2, 3.0)]


def test_dynamic_overwrite_keeps_other_partitions(spark, folder):
    path = f"{folder}/t"
    tables.overwrite_table(spark.createDataFrame([(1, "a"), (2, "b")], "k int, p string"), path, ["p"])
    tables.overwrite_table(spark.createDataFrame([(9, "b")], "k int, p string"), path, ["p"], dynamic=True)
    assert rows(spark.read.parquet(path)) == [(1, "a"), (9, "b")]


@pytest.mark.parametrize("layout", ["versioned", "bucketed"])
def test_upsert_creates_merges_and_repeats(spark, folder, layout):
    path = f"{folder}/t"

    def upsert(data):
        source = spark.createDataFrame(data, "k int, p string, v int")
        if layout == "versioned":
            tables.upsert_table(spark, path, source, ["k"], ["p"])
        else:
            tables.upsert_bucketed(spark, path, source, ["k"], buckets=4)

    def content():
        return rows(tables.read_table(spark, path).select("k", "p", "v"))

    assert not tables.table_exists(spark, path)
    upsert([(1, "x", 10), (2, "x", 20), (3, "y", 30)])
    assert tables.table_exists(spark, path)
    for _ in range(2):
        upsert([(2, "y", 21), (4, "z", 40)])
        assert content() == [(1, "x", 10), (2, "y", 21), (3, "y", 30), (4, "z", 40)]
    upsert([])
    assert len(content()) == 4
    with pytest.raises(DuplicateKeyError):
        upsert([(7, "x", 1), (7, "x", 2)])
    assert len(content()) == 4


def test_bucketed_upsert_leaves_untouched_buckets_alone(spark, folder):
    path = f"{folder}/t"
    tables.upsert_bucketed(spark, path, spark.range(100).withColumn("v", F.lit(0)), ["id"], buckets=8)
    before = {f: os.path.getmtime(f) for f in _data_files(path)}
    tables.upsert_bucketed(spark, path, spark.range(1).withColumn("v", F.lit(1)), ["id"], buckets=8)
    assert all(os.path.getmtime(f) == t for f, t in before.items())
    assert len({os.path.dirname(f) for f in _data_files(path)}) - len({os.path.dirname(f) for f in before}) == 1
    assert tables.read_table(spark, path).where("v = 1").count() == 1
    assert tables.read_table(spark, path).count() == 100


def test_first_bucketed_upsert_of_unique_rows_computes_them_once(spark, folder):
    path, computed = f"{folder}/t", spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            computed.add(batch.num_rows)
            yield batch

    rows = spark.range(100).mapInArrow(counted, "id bigint").withColumn("v", F.col("id") % 3)
    with owned_scratch(spark):
        tables.upsert_bucketed(spark, path, rows, ["id"], buckets=8, unique=True, sort_by=["id"])
        assert not session._OWNED.get() and computed.value == 100
    assert sorted(r.id for r in tables.read_table(spark, path).collect()) == list(range(100))
    live = json.loads(tables.pointer_text(spark, path))
    found = {r[0] for r in spark.range(100).select(F.pmod(F.xxhash64("id"), F.lit(8))).distinct().collect()}
    assert {int(b) for b in live["folders"]} == found and live["change"] == 1
    tables.upsert_bucketed(spark, path, spark.range(100, 101).withColumn("v", F.lit(7).cast("long")), ["id"], buckets=8, unique=True)
    assert tables.read_table(spark, path).count() == 101
    tables.upsert_bucketed(spark, f"{folder}/none", rows.where("id < 0"), ["id"], buckets=8, unique=True)
    assert tables.read_table(spark, f"{folder}/none").count() == 0


def test_bucketed_upsert_survives_a_stop_and_refuses_other_buckets(spark, folder, monkeypatch):
    path = f"{folder}/t"
    tables.upsert_bucketed(spark, path, spark.range(100).withColumn("v", F.lit(0)), ["id"], buckets=8)
    batch_rows = spark.range(90, 120).withColumn("v", F.lit(1))
    with monkeypatch.context() as stopped:
        stopped.setattr(tables, "switch_pointer", lambda *_: (_ for _ in ()).throw(RuntimeError("stopped")))
        with pytest.raises(RuntimeError, match="stopped"):
            tables.upsert_bucketed(spark, path, batch_rows, ["id"], buckets=8)
    assert tables.read_table(spark, path).where("v = 0").count() == 100
    tables.upsert_bucketed(spark, path, batch_rows, ["id"], buckets=8)
    assert tables.read_table(spark, path).count() == 120 and tables.read_table(spark, path).where("v = 1").count() == 30
    for other in (lambda: tables.upsert_bucketed(spark, path, batch_rows, ["id"], buckets=16), lambda: tables.upsert_table(spark, path, batch_rows, ["id"])):
        with pytest.raises(tables.TableLayoutError):
            other()
    assert len(tables.vacuum(spark, path)) == 2
    assert tables.read_table(spark, path).count() == 120


def test_a_moved_null_changes_the_checksum(spark):
    sums = [
        spark.createDataFrame([row], "a string, b string").agg(*tables.content_measures(StructType.fromDDL("a string, b string"))).first()["checksum"]
        for row in ((None, "x"), ("x", None))
    ]
    assert sums[0] != sums[1]


def test_unreadable_text_is_no_watermark(spark, folder):
    control.store_watermark(spark, folder + "/w", spark.createDataFrame([("2024-01-03",), ("unknown",)], "m string"), "t", "m")
    assert control.load_watermark(spark, folder + "/w", "t") == "2024-01-03"


def _data_files(path):
    return [os.path.join(d, f) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")]


def test_clustered_files_hold_narrow_ranges(spark, folder):
    path = f"{folder}/t"
    tables.publish_version(spark.range(2000).withColumn("k", F.pmod(F.xxhash64("id"), F.lit(1000))).repartition(8), path)
    tables.cluster_table(spark, path, ["k"], files=4)
    per_file = (
        tables.read_table(spark, path).groupBy(F.input_file_name().alias("f")).agg(F.min("k").alias("lo"), F.max("k").alias("hi")).orderBy("lo").collect()
    )
    assert len(per_file) == 4 and tables.read_table(spark, path).count() == 2000
    assert all(a.hi <= b.lo for a, b in zip(per_file, per_file[1:]))


def test_landing_converts_or_nulls(spark, folder):
    tables.land(spark.createDataFrame([("1", "2024-01-01"), ("x", "bad")], "n string, d string"), folder + "/t", {"n": "int", "d": "date"})
    assert rows(spark.read.parquet(folder + "/t")) == [(1, dt.date(2024, 1, 1)), (None, None)]


def test_checked_copy(spark, folder):
    df = spark.range(10).withColumn("s", F.col("id").cast("string"))
    assert rows(tables.checked_copy(df, folder + "/c", "ids")) == [("ids", 10, 10, True)]
    assert tables.require_copy(df.where("id < 0"), folder + "/e", "none") == 0
    unstable = df.withColumn("r", F.rand())
    fixed = tables.checked_copy(unstable, folder + "/u", "u").first()
    assert fixed.rows_written == 10


def test_run_log_appends(spark, folder):
    at = dt.datetime(2024, 1, 1, 12)
    tables.log_run(spark, folder + "/log", "ehr", "r1", "Succeeded", 5, at)
    tables.log_run(spark, folder + "/log", "ehr", "r2", "Failed", None, at)
    assert rows(spark.read.parquet(folder + "/log").select("run_id", "status", "rows_copied")) == [("r1", "Succeeded", 5), ("r2", "Failed", None)]


def test_failed_copy_is_logged_too(spark, folder):
    at = dt.datetime(2024, 1, 1, 12)
    broken = spark.range(3).select(F.raise_error(F.lit("source broke")).cast("int").alias("x"))
    with pytest.raises(Exception, match="source broke"):
        tables.logged_copy(broken, folder + "/t", folder + "/log", "ehr", "r1", at)
    assert tables.logged_copy(spark.range(3), folder + "/t", folder + "/log", "ehr", "r2", at) == 3
    assert rows(spark.read.parquet(folder + "/log").select("status", "rows_copied")) == [("Failed", None), ("Succeeded", 3)]


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as out:
        out.write(text)


def test_csv_reads_null_words_and_rejects_foreign_headers(spark, folder):
    head = ",".join(BRONZE_CLAIMS.names)
    line = "C1,P1,H1,2024-01-01,2024-01-02,E11,99,visit,10,9,1,PENDING,2024-01-02,NULL,Ins,INPATIENT"
    _write(f"{folder}/claims/2024/01/05/a.csv", f"{head}\n{line}\n")
    got = batch.read_bronze(spark, folder, "claims", "2024-01-05", BRONZE_CLAIMS).first()
    assert (got.claim_id, got.total_amount, got.processed_date) == ("C1", 10.0, None)
    lineage = batch.read_csv(spark, f"{folder}/claims/2024/01/05", BRONZE_CLAIMS, lineage=True).first()
    assert lineage["_source_file"].endswith("a.csv")
    _write(f"{folder}/claims/2024/01/06/a.csv", "patient_id,claim_id," + head.split(",", 2)[2] + f"\n{line}\n")
    with pytest.raises(Exception, match="header|schema"):
        batch.read_bronze(spark, folder, "claims", "2024-01-06", BRONZE_CLAIMS).collect()


def test_parquet_bronze_binds_by_name_and_fills_missing(spark, folder):
    spark.createDataFrame([("M", "P1")], "gender string, patient_id string").write.parquet(f"{folder}/patients/2024/01/05")
    got = batch.read_bronze(spark, folder, "patients", "2024-01-05", BRONZE_PATIENTS, "parquet")
    assert got.columns == BRONZE_PATIENTS.names
    assert (got.first().patient_id, got.first().gender, got.first().ward) == ("P1", "M", None)


def test_landed_json_keeps_corrupt_records(spark, folder):
    _write(f"{folder}/source=cdc/2024/01/05/a.json", '{"claim_id": "C1", "total_amount": 2.5}\nnot json\n')
    got = batch.read_landed_json(spark, folder, "2024-01-05", BRONZE_CLAIMS, "cdc").select("claim_id", "total_amount", batch.CORRUPT)
    assert rows(got) == [("C1", 2.5, None), (None, None, "not json")]


def test_incremental_filter_and_jdbc_options(spark):
    df = spark.createDataFrame([("2024-01-01",), ("2024-01-02",), (None,)], "m string")
    assert rows(batch.incremental_filter(df, "m", "2024-01-01")) == [("2024-01-02",)]
    assert batch.incremental_filter(df, "m", None).count() == 3
    options = batch.jdbc_options("jdbc:x", "dbo.Patients", "m", "2024-01-01", "2024-02-01", 4, {"user": "u"})
    assert (options["lowerBound"], options["numPartitions"], options["user"]) == ("2024-01-01", "4", "u")


def test_watermark_moves_with_the_data(spark, folder):
    path = folder + "/control"
    layout = "m string"
    assert control.load_watermark(spark, path, "t") is None
    control.store_watermark(spark, path, spark.createDataFrame([("2024-01-03",), ("2024-01-02",)], layout), "t", "m")
    control.store_watermark(spark, path, spark.createDataFrame([("2023-01-03",)], layout), "other", "m")
    assert control.load_watermark(spark, path, "t") == "2024-01-03"
    control.store_watermark(spark, path, spark.createDataFrame([], layout), "t", "m")
    assert control.load_watermark(spark, path, "t") == "2024-01-03"
    control.store_watermark(spark, path, spark.createDataFrame([("2024-02-01",)], layout), "t", "m")
    assert control.load_watermark(spark, path, "t") == "2024-02-01"


def _run(spark, folder, source, run_id, **more):
    return ingest.ingest_increment(
        spark, source, "T", "m", f"{folder}/bronze", f"{folder}/control", f"{folder}/log", "2024-01-05", run_id,
        datetime(2024, 1, 5), **more,
    )


def test_ingestion_moves_the_watermark_and_repeats_safely(spark, folder):
    data = [("a", "2024-01-01"), ("b", "2024-01-02"), ("c", "unknown")]
    source = spark.createDataFrame(data, "id string, m string")
    assert _run(spark, folder, source, "r1", types={"id": "string"}) == 3
    assert control.load_watermark(spark, f"{folder}/control", "T") == "2024-01-02"
    more = source.unionByName(spark.createDataFrame([("d", "2024-01-02"), ("e", "2024-01-03")], "id string, m string"))
    assert _run(spark, folder, more, "r2") == 2  # the newest day and the row without a date are landed already
    assert control.load_watermark(spark, f"{folder}/control", "T") == "2024-01-03"
    assert _run(spark, folder, more.limit(0), "r2") == 2  # a run that succeeded is not copied again
    assert _run(spark, folder, more.limit(0), "r1") == 3  # nor does its repetition move the watermark back
    assert control.load_watermark(spark, f"{folder}/control", "T") == "2024-01-03"
    landed = spark.read.parquet(f"{folder}/bronze/T/2024/01/05")
    assert landed.count() == 5 and {r.run_id for r in landed.select("run_id").distinct().collect()} == {"r1", "r2"}
    with pytest.raises(EmptySourceError):
        _run(spark, folder, more, "r3")  # a source without news does not pass the gate


def test_late_rows_and_repeated_rows_are_landed_once(spark, folder):
    layout = "id string, m string, n string"
    first = spark.createDataFrame([("a", "2024-01-10", "1"), ("b", "2024-01-20", "x"), ("b", "2024-01-20", "x"), ("n", None, None)], layout)
    assert _run(spark, folder, first, "r1", types={"n": "int"}) == 4
    late = [("late", "2024-01-15", "2"), ("older", "2024-01-01", "2"), ("b", "2024-01-20", "x"), ("n", None, None), ("m", None, None)]
    second = first.unionByName(spark.createDataFrame(late, layout))
    assert _run(spark, folder, second, "r2", lookback_days=7, types={"n": "int"}) == 4  # late, a third b, a second n, m
    assert _run(spark, folder, second, "r3", lookback_days=7, allow_empty=True) == 0
    landed = spark.read.parquet(f"{folder}/bronze/T/2024/01/05").where("run_id = 'r2'")
    assert sorted(r["id"] for r in landed.collect()) == ["b", "late", "m", "n"]
    assert [r["_rescued"] for r in landed.where("id = 'b'").collect()] == [{"n": "x"}]
    assert control.load_watermark(spark, f"{folder}/control", "T") == "2024-01-20"


def test_rows_of_a_failed_run_are_landed_by_the_next(spark, folder, monkeypatch):
    source = spark.createDataFrame([("a", "2024-01-10")], "id string, m string")
    assert _run(spark, folder, source, "r1") == 1
    more = source.unionByName(spark.createDataFrame([("b", "2024-01-11")], "id string, m string"))

    def broken(df, path, name):
        df.write.mode("overwrite").parquet(path)
        raise tables.CopyMismatchError(name)

    with monkeypatch.context() as patch:
        patch.setattr(tables, "require_copy", broken)
        with pytest.raises(tables.CopyMismatchError):
            _run(spark, folder, more, "r2")
    assert _run(spark, folder, more, "r3") == 1


def test_ingestion_gate_logs_the_failure(spark, folder):
    empty = spark.createDataFrame([], "id string, m string")
    with pytest.raises(EmptySourceError):
        _run(spark, folder, empty, "r1")
    assert rows(spark.read.schema(tables.RUN_LOG).parquet(f"{folder}/log").select("run_id", "status", "rows_copied")) == [("r1", "Failed", 0)]
    assert control.load_watermark(spark, f"{folder}/control", "T") is None
    assert _run(spark, folder, empty, "r2", allow_empty=True) == 0


def test_clustering_serves_both_columns_and_refuses_buckets(spark, folder):
    wide = spark.range(20000).select(F.pmod(F.xxhash64("id"), F.lit(1000)).alias("a"), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1000)).alias("b"))
    hot = wide.withColumn("a", F.when(F.col("b") % 3 == 0, 7).otherwise(F.col("a")))  # a value in a third of all rows
    tables.publish_version(hot, f"{folder}/t")
    tables.cluster_table(spark, f"{folder}/t", ["a", "b"], files=16)
    live = tables.read_table(spark, f"{folder}/t").withColumn("file", F.col("_metadata.file_path"))
    spans = live.groupBy("file").agg(F.count(F.lit(1)).alias("n"), *[f(c).alias(f"{f.__name__}_{c}") for c in "ab" for f in (F.min, F.max)]).collect()
    assert sum(s.n for s in spans) == 20000 and max(s.n for s in spans) < 3 * 20000 / len(spans)
    for c in "ab":
        assert sum(s[f"max_{c}"] - s[f"min_{c}"] for s in spans) / len(spans) < 600
    tables.upsert_bucketed(spark, f"{folder}/u", hot.distinct(), ["a", "b"], buckets=2, sort_by=["b"])
    with pytest.raises(tables.TableLayoutError):
        tables.cluster_table(spark, f"{folder}/u", ["a"], files=2)


def test_owned_scratch_is_deleted_at_the_end(spark):
    kept = session.stage(spark.range(3), "kept")
    with pytest.raises(RuntimeError), session.owned_scratch(spark):
        inner = session.stage(spark.range(3), "inner").inputFiles()[0]
        assert os.path.exists(inner.removeprefix("file://"))
        raise RuntimeError
    assert not os.path.exists(os.path.dirname(inner.removeprefix("file://")))
    assert kept.count() == 3


def test_upserts_add_columns_and_widen_types(spark, folder):
    path = f"{folder}/t"
    first = spark.range(200).select("id", F.col("id").cast("int").alias("n"), F.lit("2024-01-01").cast("date").alias("d"))
    tables.upsert_bucketed(spark, path, first, ["id"], buckets=8)
    before = {f for f in os.listdir(f"{path}/versions")}
    more = spark.createDataFrame([(3, 2**40, "new"), (500, 1, "new")], "id bigint, n bigint, s string")
    with pytest.raises(tables.TableLayoutError):
        tables.upsert_bucketed(spark, path, more, ["id"], buckets=8)
    tables.upsert_bucketed(spark, path, more, ["id"], buckets=8, evolve=True)
    narrow = spark.createDataFrame([(7, 9)], "id bigint, n int")
    tables.upsert_bucketed(spark, path, narrow, ["id"], buckets=8, evolve=True)
    got = {r["id"]: (r["n"], r["d"], r["s"]) for r in tables.read_table(spark, path).collect()}
    assert len(got) == 201 and got[3] == (2**40, None, "new") and got[500] == (1, None, "new") and got[7] == (9, None, None)
    assert got[8] == (8, dt.date(2024, 1, 1), None)
    assert [(c["name"], c["type"], c["since"]) for c in tables.table_columns(spark, path)] == [
        ("id", "bigint", 1), ("n", "bigint", 2), ("d", "date", 1), ("s", "string", 2)
    ]
    assert before <= set(os.listdir(f"{path}/versions"))  # untouched buckets keep their files
    tables.vacuum(spark, path)
    assert tables.read_table(spark, path).count() == 201
    with pytest.raises(ValueError, match="date"):
        tables.upsert_bucketed(spark, path, spark.createDataFrame([(1, "x")], "id bigint, d string"), ["id"], buckets=8, evolve=True)
    with pytest.raises(tables.TableLayoutError, match="key"):
        tables.upsert_bucketed(spark, path, spark.createDataFrame([(1, 1)], "id int, n int"), ["id"], buckets=8, evolve=True)


def test_versioned_upsert_evolves_too(spark, folder):
    path = f"{folder}/v"
    tables.upsert_table(spark, path, spark.createDataFrame([(1, 1.5), (2, 2.5)], "id int, x float"), ["id"])
    tables.upsert_table(spark, path, spark.createDataFrame([(2, 0.1, "y")], "id int, x double, s string"), ["id"], evolve=True)
    assert rows(tables.read_table(spark, path)) == [(1, 1.5, None), (2, 0.1, "y")]


@pytest.mark.parametrize(
    "old,new,both",
    [
        ("int", "bigint", "bigint"), ("bigint", "smallint", "bigint"), ("int", "double", "double"), ("bigint", "double", None),
        ("decimal(10,2)", "decimal(8,4)", "decimal(12,4)"), ("bigint", "decimal(10,2)", "decimal(21,2)"), ("date", "timestamp", "timestamp"),
        ("string", "int", None), ("decimal(38,0)", "decimal(38,10)", None),
    ],
)
def test_wider_types(old, new, both):
    kinds = [StructType.fromDDL(f"x {t}")["x"].dataType for t in (old, new)]
    for a, b in (kinds, kinds[::-1]):
        got = evolution.wider(a, b)
        assert (got and got.simpleString()) == both


def test_versioned_upsert_computes_its_source_once(spark, folder):
    path, seen = f"{folder}/t", spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    for first in (0, 50):
        source = spark.range(first, first + 100).select(F.col("id").alias("k"), F.lit(first).alias("v"))
        tables.upsert_table(spark, path, source.mapInArrow(counted, source.schema), ["k"])
    assert seen.value == 200
    assert rows(tables.read_table(spark, path)) == sorted([(k, 0 if k < 50 else 50) for k in range(150)], key=repr)


def _shuffle_files(spark):
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    names = spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(manager.getAllFiles())
    return {f.getName() for f in names if f.getName().startswith("shuffle_")}


def test_written_tables_leave_no_shuffle_files(spark, folder):
    before, setting = _shuffle_files(spark), spark.conf.get(session.SHUFFLE_CLEANUP, None)
    dealt = spark.range(1000).groupBy((F.col("id") % 50).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    with owned_scratch(spark):
        assert session.stage(dealt, "counts").count() == 50
        tables.publish_version(dealt, f"{folder}/t", ["n"])
        until = time.time() + 20
        while (left := _shuffle_files(spark) - before) and time.time() < until:
            time.sleep(0.2)
    written = {name for name in left if name.startswith("shuffle_") and name.endswith(".data")}
    assert len(written) <= 8  # at most those of the count
    assert spark.conf.get(session.SHUFFLE_CLEANUP, None) == setting


def test_ungathered_buckets_hold_the_same_rows(spark, folder):
    dealt = spark.range(500).select((F.col("id") % 90).alias("id"), F.col("id").alias("v")).groupBy("id").agg(F.max("v").alias("v"))
    for gather in (True, False):
        path = f"{folder}/{gather}"
        tables.upsert_bucketed(spark, path, dealt, ["id"], buckets=4, unique=True, sort_by=["id"], gather=gather)
        tables.upsert_bucketed(spark, path, spark.range(3).withColumn("v", F.lit(7).cast("long")), ["id"], buckets=4, unique=True, gather=gather)
    assert rows(tables.read_table(spark, f"{folder}/True")) == rows(tables.read_table(spark, f"{folder}/False"))
