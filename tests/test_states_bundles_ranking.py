"""Incremental metrics, nested payloads and rank metrics."""

import datetime as dt

import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from lakecare.ml import ranking
from lakecare.operators.sequence import ranked
from lakecare.plans import gold, incremental
from lakecare.sinks import tables
from lakecare.sources import bundles, rescue

ADMISSIONS = (
    "hospital_id string, admission_date date, patient_id string, diagnosis_code string, attending_physician string, "
    "length_of_stay int, readmission_flag boolean"
)


def admissions(spark, count, seed):
    random = np.random.default_rng(seed)
    rows = []
    for _ in range(count):
        hospital = None if random.random() < 0.1 else f"H{int(random.integers(0, 3)) if random.random() < 0.6 else 0}"
        day = None if random.random() < 0.05 else dt.date(2024, int(random.integers(1, 4)), 5)
        rows.append(
            (
                hospital, day, f"P{random.integers(0, 400)}" if random.random() < 0.95 else None, f"D{random.integers(0, 9)}",
                f"Dr {random.integers(0, 5)}" if random.random() < 0.9 else None, int(random.integers(0, 9)) if random.random() < 0.9 else None,
                None if random.random() < 0.1 else bool(random.integers(0, 2)),
            )
        )
    return spark.createDataFrame(rows, ADMISSIONS)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_states_of_batches_equal_the_recomputation(spark, folder, monkeypatch):
    batches = [admissions(spark, n, seed) for seed, n in enumerate((300, 1, 200, 0))]
    everything = None
    for number, batch in enumerate(batches):
        if number == 2:  # a stop between dictionary and states
            with monkeypatch.context() as patch:
                patch.setattr(incremental, "batch_states", lambda *args: 1 / 0)
                with pytest.raises(ZeroDivisionError):
                    incremental.fold_batch(spark, folder, batch, number, buckets=4)
        assert incremental.fold_batch(spark, folder, batch, number, buckets=4)
        assert not incremental.fold_batch(spark, folder, batch, number, buckets=4)
        everything = batch if everything is None else everything.unionByName(batch)
    got = incremental.current_metrics(spark, folder, "2024-02-01", "2024-02-01")
    assert rows(got) == rows(gold.agg_hospital_metrics(everything, "2024-02-01", "2024-02-01"))
    ids = tables.read_table(spark, f"{folder}/dictionary")
    assert ids.count() == ids.select("id").distinct().count() == ids.agg(F.max("id")).first()[0] + 1


def test_ranks_are_dense_and_ordered(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("x"), F.lit(1).alias("hot")).unionByName(
        spark.createDataFrame([(None, 1)], "x bigint, hot int")
    )
    got = ranked(df.repartition(9), ["hot", "x"], "r").orderBy("r").collect()
    assert [r["r"] for r in got] == list(range(5001)) and [r["x"] for r in got] == [None, *range(5000)]


def landed(spark, folder, *documents):
    spark.createDataFrame([(d,) for d in documents], "value string").coalesce(1).write.text(folder + "/b")
    return bundles.read_bundles(spark, folder + "/b")


FIELDS = {"id": ("$.a.id", "string"), "n": ("$.a.n", "int"), "d": ("$.d", "date"), "first": ("$.l[0]", "int")}


def test_bundles_become_typed_rows(spark, folder):
    got = landed(
        spark, folder,
        '{"who":"x","data":[{"a":{"id":"1","n":5,"more":1},"d":"2024-01-02","l":[7,8],"extra":{"k":[1]}},{"a":{"id":2,"n":"y"},"d":null}]}',
        '{"who":"y","data":[]}', '{"who":"z"}', "broken {", "[1,2]", '{"data":"text"}', "  ",
    )
    out = bundles.bundle_entries(got, "$.data", FIELDS, {"who": ("$.who", "string")}).orderBy("_position").collect()
    assert [(r["who"], r["id"], r["n"], r["d"], r["first"]) for r in out if r["id"]] == [
        ("x", "1", 5, dt.date(2024, 1, 2), 7), ("x", "2", None, None, None)
    ]
    first, second = (r for r in out if r["id"])
    assert first[rescue.RESCUED] is None and first[bundles.UNKNOWN] == {"extra": '{"k":[1]}'}
    assert second[rescue.RESCUED] == {"n": '"y"'} and second[bundles.UNKNOWN] is None
    assert [r[0] for r in bundles.corrupt_bundles(got).collect()] == ["broken {"]


def test_each_path_is_followed_once(spark, folder):
    """Every more call made the generated code larger, at last too large to be compiled."""
    got = landed(spark, folder, '{"data":[{"a":{"id":"1","n":"y"},"d":null,"x":null,"y":1.50,"z":"q"}, 5, null, [{"x":1}]]}')
    out = bundles.bundle_entries(got, "$.data", FIELDS)
    rows = out.orderBy("_position").collect()
    assert rows[0][rescue.RESCUED] == {"n": '"y"'} and rows[0][bundles.UNKNOWN] == {"x": None, "y": "1.5", "z": "q"}
    assert all(r[bundles.UNKNOWN] is None and r[rescue.RESCUED] is None for r in rows[1:])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("$.a.id, StringType") == 1 and plan.count("$.a.n, IntegerType") == 1


def scored(spark, pairs):
    return spark.createDataFrame(pairs, "label int, score double")


def evaluated(df, metric):
    at = df.select(F.col("label").cast("double").alias("label"), F.col("score").alias("rawPrediction"))
    return BinaryClassificationEvaluator(metricName=metric, numBins=0).evaluate(at)


def test_areas_equal_the_librarys(spark):
    random = np.random.default_rng(2)
    labels = random.integers(0, 2, 2000)
    scores = np.round(labels * 0.3 + random.random(2000), 2)  # many ties
    df = scored(spark, [(int(a), float(b)) for a, b in zip(labels, scores, strict=True)]).repartition(7)
    got = ranking.rank_metrics(df, "label", "score").first()
    assert abs(got["area_under_roc"] - evaluated(df, "areaUnderROC")) < 1e-8
    assert abs(got["area_under_pr"] - evaluated(df, "areaUnderPR")) < 1e-8
    pairs = [(x > y) + 0.5 * (x == y) for x in scores[labels == 1] for y in scores[labels == 0]]
    assert abs(got["area_under_roc"] - np.mean(pairs)) < 1e-8


def test_rank_metrics_of_awkward_scores(spark):
    ends = [(1, 0.9), (0, 0.1), (None, 0.5), (1, None), (0, float("nan"))]
    got = ranking.rank_metrics(scored(spark, ends), "label", "score").first()
    assert tuple(got) == (1, 1, 1.0, 1.0, 1.0)
    same = ranking.rank_metrics(scored(spark, [(1, 0.5), (0, 0.5)]), "label", "score").first()
    assert tuple(same) == (1, 1, 0.5, 0.5, 0.0)
    assert tuple(ranking.rank_metrics(scored(spark, [(1, 0.5)]), "label", "score").first())[:3] == (1, 0, None)
    assert tuple(ranking.rank_metrics(scored(spark, []), "label", "score").first())[:3] == (0, 0, None)
