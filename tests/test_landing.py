"""Landing by manifest: redelivered, old and changing files, and a stop at every step; rescued cells."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegerType, StringType, StructField, StructType

from lakecare.session import delete_path
from lakecare.sources import rescue
from lakecare.streaming import landing

SCHEMA = StructType([StructField("id", StringType()), StructField("n", IntegerType()), StructField("d", DateType())])


class Site:
    def __init__(self, spark, folder):
        self.spark, self.folder = spark, folder
        os.makedirs(f"{folder}/in")

    def drop(self, name, *lines, age=0, head="id,n,d"):
        path = f"{self.folder}/in/{name}"
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "w") as out:
            out.write("\n".join([head, *lines]) + "\n")
        stamp = 1_700_000_000 - age
        os.utime(path, (stamp, stamp))

    def run(self, day="2024-01-05", **more):
        return landing.land_and_archive(
            self.spark, f"{self.folder}/in", SCHEMA, f"{self.folder}/bronze", day, f"{self.folder}/c", f"{self.folder}/archive", **more
        )

    def landed(self, quarantined=False):
        df = landing.read_landed(self.spark, f"{self.folder}/bronze", f"{self.folder}/c", SCHEMA, quarantined)
        return sorted(r["id"] for r in df.collect())

    def states(self):
        log = landing.deliveries(landing.read_manifest(self.spark, f"{self.folder}/c/manifest"))
        return sorted((r["name"], r["batch"], r["rows"], r["state"]) for r in log.collect())

    def archived(self):
        top = f"{self.folder}/archive"
        return sorted(os.path.relpath(f"{d}/{f}", top) for d, _, fs in os.walk(top) for f in fs if f.endswith(".csv"))

    def left(self):
        return sorted(f for f in os.listdir(f"{self.folder}/in") if not f.startswith("."))


@pytest.fixture
def site(spark, folder):
    return Site(spark, folder)


def test_every_delivery_lands_once(site):
    site.drop("a.csv", "a1,1,2024-01-01")
    site.drop("sub/b b.csv", "b1,2,2024-01-02", "b2,3,2024-01-03")
    site.drop("empty.csv")
    assert site.run() == ["a.csv", "empty.csv", "sub/b b.csv"]
    site.drop("a.csv", "a2,1,2024-01-01", age=-60)  # the old name again
    site.drop("c.csv", "c1,1,2024-01-01", age=30 * 86400)  # an old time stamp
    assert site.run("2024-01-06") == ["a.csv", "c.csv"]
    assert site.run("2024-01-06") == []
    site.drop("a.csv", "a2,1,2024-01-01", age=-60)  # the very same delivery restored: delivered once more
    assert site.run("2024-01-06") == ["a.csv"]
    assert site.landed() == ["a1", "a2", "a2", "b1", "b2", "c1"]
    assert site.left() == ["sub"] and len(site.archived()) == 6
    assert site.states() == [
        ("a.csv", 1, 1, "archived"), ("a.csv", 2, 1, "archived"), ("a.csv", 3, 1, "archived"), ("c.csv", 2, 1, "archived"),
        ("empty.csv", 1, 0, "archived"), ("sub/b b.csv", 1, 2, "archived"),
    ]
    plain = site.spark.read.parquet(f"{site.folder}/bronze/2024/01/06")
    assert sorted(r["id"] for r in plain.collect()) == ["a2", "a2", "c1"]


@pytest.mark.parametrize("step", ["write_split", "_record", "_publish", "move", "second_record"])
def test_a_run_stopped_at_any_step_is_mended_by_the_next(site, monkeypatch, step):
    site.drop("a.csv", "a1,1,2024-01-01")
    site.drop("b.csv", "b1,1,2024-01-01")
    calls = []

    def stop(real, at):
        def broken(*args, **kwargs):
            calls.append(1)
            if len(calls) == at:
                raise RuntimeError("stopped")
            return real(*args, **kwargs)

        return broken

    with monkeypatch.context() as patch:
        if step == "move":  # the first move of a file, after the batch folder's own rename
            patch.setattr(landing.Folder, "move", stop(landing.Folder.move, 3))
        elif step == "second_record":
            patch.setattr(landing, "_record", stop(landing._record, 2))
        else:
            patch.setattr(landing, step, stop(getattr(landing, step), 1))
        with pytest.raises(RuntimeError, match="stopped"):
            site.run()
    site.drop("c.csv", "c1,1,2024-01-01")
    site.run("2024-01-06")
    assert site.landed() == ["a1", "b1", "c1"]
    assert site.left() == [] and len(site.archived()) == 3
    assert {s[3] for s in site.states()} == {"archived"}
    assert site.run("2024-01-06") == []


def test_a_file_replaced_after_its_conversion_has_its_own_turn(site, monkeypatch):
    site.drop("a.csv", "a1,1,2024-01-01")
    real = landing._publish

    def replace(*args):
        monkeypatch.setattr(landing, "_publish", real)
        site.drop("a.csv", "a2,1,2024-01-01", age=-60)
        return real(*args)

    monkeypatch.setattr(landing, "_publish", replace)
    assert site.run() == []
    assert site.run() == ["a.csv"]
    assert site.landed() == ["a1", "a2"]
    assert [s[3] for s in site.states()] == ["replaced", "archived"]


def test_a_file_that_changes_while_it_is_read_waits(site, monkeypatch):
    site.drop("a.csv", "a1,1,2024-01-01")
    site.drop("b.csv", "b1,1,2024-01-01")
    real = landing.write_split

    def change(*args):
        monkeypatch.setattr(landing, "write_split", real)
        got = real(*args)
        site.drop("b.csv", "b1,1,2024-01-01", "b2,1,2024-01-01", age=-60)
        return got

    monkeypatch.setattr(landing, "write_split", change)
    assert site.run() == ["a.csv"]
    assert site.landed() == ["a1"]
    assert site.run() == ["b.csv"]
    assert site.landed() == ["a1", "b1", "b2"]


def test_batches_of_few_files_and_none_at_all(site):
    assert site.run() == [] and site.landed() == []
    for i in range(5):
        site.drop(f"f{i}.csv", f"x{i},1,2024-01-01")
    assert len(site.run(files_per_batch=2)) == 5
    assert sorted({s[1] for s in site.states()}) == [1, 2, 3] and len(site.landed()) == 5


def test_bad_cells_are_kept_and_bad_rows_set_apart(site):
    site.drop("a.csv", "ok,1,2024-01-01", "soft,x,2024-01-01", "hard,1,yesterday", "null,NULL,NULL", "long,1,2024-01-01,more", "short,1")
    site.run(required=["d"])
    assert site.landed() == ["null", "ok", "soft"]
    assert site.landed(quarantined=True) == ["hard", "long", "short"]
    good = landing.read_landed(site.spark, f"{site.folder}/bronze", f"{site.folder}/c", SCHEMA)
    assert [tuple(r) for r in rescue.rescued_cells(good, "id").collect()] == [("soft", "n", "x")]
    manifest = landing.read_manifest(site.spark, f"{site.folder}/c/manifest")
    assert {(r["rows"], r["quarantined"]) for r in manifest.collect()} == {(6, 3)}


def test_a_wrong_header_stops_the_run_and_loses_nothing(site):
    site.drop("a.csv", "a1,1,2024-01-01", head="id,d,n")
    with pytest.raises(Exception, match="header|schema"):
        site.run()
    assert site.left() == ["a.csv"] and site.landed() == []


def test_converted_cells(spark, folder):
    df = spark.createDataFrame([("1", " 2 ", None), ("x", "2.5", "z"), (None, None, "y")], "a string, b string, c string")
    got = rescue.convert(df, {"a": "int", "b": "int"})
    rows = sorted(((r["a"], r["b"], r["c"], r["_rescued"]) for r in got.collect()), key=repr)
    assert rows == sorted([(1, 2, None, None), (None, None, "z", {"a": "x", "b": "2.5"}), (None, None, "y", None)], key=repr)
    again = rescue.convert(got, {"c": "int"}).where("c IS NULL AND _rescued IS NOT NULL").select("_rescued").collect()
    assert sorted((r[0] for r in again), key=repr) == sorted([{"a": "x", "b": "2.5", "c": "z"}, {"c": "y"}], key=repr)
    split = rescue.write_split(got, folder + "/s", ["a"], ["a", "b"])
    assert (split.rows, split.quarantined, split.rescued) == (3, 1, {"a": 1, "b": 1})
    assert {r["column_name"]: r["cells"] for r in rescue.rescued_counts(got).collect()} == {"a": 1, "b": 1}
    delete_path(spark, folder + "/s")
    assert spark.range(1).where(F.lit(False)).count() == 0
