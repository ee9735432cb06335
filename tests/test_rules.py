"""Rule cases: each list is one frame, evaluated in one job."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lakecare.functions import rules
from lakecare.functions.clock import run_date_folder
from lakecare.functions.exact import exact_avg, exact_sum, share_pct


def outcomes(spark, rows, layout, *columns):
    return [tuple(r) for r in spark.createDataFrame(rows, "i int, " + layout).orderBy("i").select(*columns).collect()]


def numbered(values):
    return [(i, *v) if isinstance(v, tuple) else (i, v) for i, v in enumerate(values)]


def test_gender(spark):
    cases = {"M": "Male", "male": "Male", "m": "Male", "F": "Female", "FEMALE": "Female", "  F  ": "Female", "Other": "Unknown", "": "Unknown"}
    got = outcomes(spark, numbered([*cases, None]), "g string", rules.gender(F.col("g")))
    assert got == [(v,) for v in cases.values()] + [("Unknown",)]


@pytest.mark.parametrize(
    "born, as_of, years",
    [
        ("1980-01-01", "2024-01-01", 44),
        ("1990-12-31", "2024-06-15", 33),
        ("1990-06-15", "2024-06-15", 34),
        ("2024-01-01", "2024-06-01", 0),
        ("2000-02-29", "2001-02-28", 0),
        ("2000-02-29", "2001-03-01", 1),
    ],
)
def test_calendar_age(spark, born, as_of, years):
    row = spark.range(1).select(rules.age(F.lit(born).cast("date"), as_of, "calendar").alias("a")).first()
    assert row.a == years


def test_elapsed_age_may_differ_from_calendar(spark):
    born = F.lit("1999-08-01").cast("date")
    row = spark.range(1).select(rules.age(born, "2001-08-01").alias("e"), rules.age(born, "2001-08-01", "calendar").alias("c")).first()
    assert (row.e, row.c) == (2, 2)
    born = F.lit("2000-08-01").cast("date")
    row = spark.range(1).select(rules.age(born, "2001-08-01").alias("e"), rules.age(born, "2001-08-01", "calendar").alias("c")).first()
    assert (row.e, row.c) == (0, 1)
    with pytest.raises(ValueError):
        rules.age(F.lit(None), "2001-08-01", "lunar")


def test_age_group(spark):
    cases = {10: "Pediatric", 17: "Pediatric", 18: "Young Adult", 25: "Young Adult", 40: "Middle Aged", 50: "Middle Aged", 70: "Senior", 80: "Elderly", 85: "Elderly"}
    got = outcomes(spark, numbered([*cases, None]), "a int", rules.age_group(F.col("a")))
    assert got == [(v,) for v in cases.values()] + [("Elderly",)]


def test_risk_score(spark):
    rows = [
        (25, 2, False, "Young Adult"),
        (82, 14, True, "Elderly"),
        (40, 5, False, "Middle Aged"),
        (40, 5, True, "Middle Aged"),
        (80, 5, False, "Senior"),
        (80, 5, False, "Elderly"),
        (200, 100, True, "Elderly"),
        (40, None, False, "Middle Aged"),
        (40, 5, None, "Middle Aged"),
    ]
    inputs = [F.col(c) for c in ("a", "s", "r", "g")]
    got = outcomes(
        spark, numbered(rows), "a int, s int, r boolean, g string",
        rules.risk_score(*inputs), rules.risk_score(*inputs, null_policy="null"),
    )
    scores = [g[0] for g in got]
    assert scores[0] == 12.5 and scores[1] == 89.6
    assert scores[3] - scores[2] == 20.0 and scores[5] - scores[4] == 5.0
    assert scores[6] == 100.0
    assert got[7] == (100.0, None)
    assert scores[8] == scores[2]
    with pytest.raises(ValueError):
        rules.risk_score(*inputs, null_policy="other")


def test_risk_category(spark):
    cases = {75.0: "High Risk", 70.0: "High Risk", 55.0: "Medium Risk", 40.0: "Medium Risk", 39.9: "Low Risk", 20.0: "Low Risk"}
    got = outcomes(spark, numbered([*cases, None]), "s double", rules.risk_category(F.col("s")))
    assert got == [(v,) for v in cases.values()] + [("Low Risk",)]


def test_coverage_ratio(spark):
    rows = [(100000.0, 100000.0), (90000.0, 100000.0), (0.0, 0.0), (256500.0, 285000.0), (None, 5.0), (5.0, None)]
    got = outcomes(spark, numbered(rows), "c double, t double", rules.coverage_ratio(F.col("c"), F.col("t")))
    assert [g[0] for g in got] == [1.0, 0.9, 0.0, 0.9, None, None]


def test_code_check(spark):
    cases = {"E11": True, "E11.9": True, "I25.10": True, " e11.9 ": True, "111.9": False, "": False, "E1": False, "E11.12345": False}
    got = outcomes(spark, numbered([*cases, None]), "c string", rules.valid_code(F.col("c")))
    assert got == [(v,) for v in cases.values()] + [(False,)]


def test_dates(spark):
    texts = ["2024-01-05", "NULL", "2024-13-01", "2024-1-5", "2024-02-30", "05-01-2024", None]
    got = outcomes(spark, numbered(texts), "d string", rules.parsed_date(F.col("d")), rules.date_shaped(F.col("d")))
    assert [g[0] for g in got] == [dt.date(2024, 1, 5)] + [None] * 6
    assert [g[1] for g in got] == [True, False, True, False, True, False, None]


def test_other_buckets(spark):
    got = outcomes(spark, numbered([3, 4, 7, 8, 14, 15, None]), "d int", rules.stay_bucket(F.col("d")))
    assert [g[0] for g in got] == ["Short", "Medium", "Medium", "Long", "Long", "Very Long", "Very Long"]
    got = outcomes(spark, numbered([14.01, 14.0, 7.0, None]), "d double", rules.disease_severity(F.col("d")))
    assert [g[0] for g in got] == ["Severe", "Moderate", "Mild", "Mild"]
    got = outcomes(spark, numbered([0.7, 0.69, 0.5, 0.3, 0.29]), "p double", rules.risk_band(F.col("p")))
    assert [g[0] for g in got] == ["Very High", "High", "High", "Medium", "Low"]
    got = outcomes(spark, numbered([500000.0, 500000.01, None]), "t double", rules.high_value(F.col("t")))
    assert [g[0] for g in got] == [False, True, False]
    days = [dt.date(2024, 1, 6), dt.date(2024, 1, 7), dt.date(2024, 1, 8)]
    got = outcomes(spark, numbered(days), "d date", rules.weekend_flag(F.col("d")))
    assert [g[0] for g in got] == [1, 1, 0]


def test_case_insensitive_text(spark):
    got = outcomes(spark, numbered(["Approved", "APPROVED", "denied"]), "s string", rules.same_text(F.col("s"), "approved"))
    assert [g[0] for g in got] == [True, True, False]


def test_run_date_folder():
    assert run_date_folder("2024-01-05") == run_date_folder(dt.date(2024, 1, 5)) == "2024/01/05"


def test_exact_averages_keep_ties(spark):
    df = spark.createDataFrame([(10.0,), (10.01,), (None,)], "v double").repartition(3)
    row = df.agg(
        exact_avg(F.col("v"), 2, 2).alias("tie"), exact_sum(F.col("v")).alias("total"), exact_avg(F.col("v"), 2, 1, factor=100).alias("pct")
    ).first()
    assert (row.tie, row.total, row.pct) == (10.01, 20.01, 1000.5)
    empty = df.where("v < 0").agg(exact_avg(F.col("v"), 2, 2).alias("a"), share_pct(F.count("v"), F.count("v"), 1).alias("s")).first()
    assert (empty.a, empty.s) == (None, None)
