import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakecare.operators import joins
from lakecare.operators.dedupe import dedupe_latest
from lakecare.operators.joins import left_join_skewed
from lakecare.operators.merge import DuplicateKeyError, merge_upsert, require_unique
from lakecare.operators.quality import (
    EmptySourceError, date_format_flags, drop_null_keys, gate_alerts, non_empty_gate, null_counts, require_non_empty,
)
from lakecare.operators import sequence
from lakecare.operators.sequence import number_in_order
from lakecare.plans.serving import readmission_root_cause

RELAXED = settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@RELAXED
@given(st.lists(st.tuples(st.integers(0, 4), st.one_of(st.none(), st.integers(0, 3)), st.integers(0, 99)), max_size=30))
def test_dedupe_matches_plain_python_and_is_idempotent(spark, data):
    df = spark.createDataFrame(data, "k int, t int, v int")
    once = dedupe_latest(df, ["k"], ["t"])
    best = {}
    for k, t, v in data:
        rank = (0, -t, v) if t is not None else (1, 0, v)
        if k not in best or rank < best[k][0]:
            best[k] = (rank, (k, t, v))
    assert rows(once) == sorted((b[1] for b in best.values()), key=repr)
    assert rows(dedupe_latest(once, ["k"], ["t"])) == rows(once)


def test_dedupe_limits_each_map_task_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").alias("t"))
    text = plan(dedupe_latest(df, ["k"], ["t"]))
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the claims belong to one patient, another key is hot as well."""
    draw = random.Random(5)
    claims = [(f"P{0 if i % 3 == 0 else 1 if i % 7 == 0 else draw.randrange(2, 60)}", f"C{i}") for i in range(900)]
    claims += [(None, "C-null")]
    people = [(f"P{i}", i) for i in range(70)] + [("P0", 1000), (None, 7)]
    return spark.createDataFrame(people, "p string, a int"), spark.createDataFrame(claims, "p string, c string")


@pytest.mark.parametrize("threshold", [40, 250, 10_000])
def test_skewed_left_join_equals_left_join(skewed, threshold):
    people, claims = skewed
    ours = left_join_skewed(people, claims, ["p"], ["c"], threshold).select("p", "a", "c")
    assert rows(ours) == rows(people.join(claims, "p", "left").select("p", "a", "c"))


def test_skewed_left_join_with_few_distinct_spread_values(spark):
    """All right rows of the hot key share one salt: the empty salts must leave no null rows."""
    people = spark.createDataFrame([("A", 1), ("B", 2)], "p string, a int")
    claims = spark.createDataFrame([("A", "same")] * 50, "p string, c string")
    ours = left_join_skewed(people, claims, ["p"], ["c"], 5)
    assert rows(ours.select("p", "a", "c")) == [("A", 1, "same")] * 50 + [("B", 2, None)]


@pytest.mark.parametrize("threshold", [20, 150, 10_000])
def test_numbering_of_hot_keys_equals_window(spark, threshold):
    draw = random.Random(11)
    data = [(f"P{0 if i % 3 == 0 else draw.randrange(1, 9)}", draw.randrange(20), i) for i in range(600)]
    df = spark.createDataFrame(data, "p string, d int, i int").repartition(5)
    ours = number_in_order(df, ["p"], ["d", "i"], "n", {"d": "next_d", "i": "next_i"}, threshold)
    expected, by_patient = [], {}
    for row in sorted(data):
        by_patient.setdefault(row[0], []).append(row)
    for group in by_patient.values():
        for n, (row, after) in enumerate(zip(group, [*group[1:], (None, None, None)]), 1):
            expected.append((*row, n, after[1], after[2]))
    assert rows(ours) == sorted(expected, key=repr)


def test_slices_follow_rows_not_hot_keys(spark, monkeypatch):
    """With a threshold of three nearly every key is hot, which must not make a task for every few rows."""
    df = spark.range(6000).select((F.col("id") % 1000).alias("k"), F.col("id").alias("at"))
    slices, sliced = [], sequence._sliced
    monkeypatch.setattr(sequence, "_sliced", lambda *given: slices.append(given[-1]) or sliced(*given))
    got = number_in_order(df, ["k"], ["at"], "n", {"at": "after"}, 3)
    assert 2 <= slices[0] <= spark.sparkContext.defaultParallelism
    later = F.when(F.col("at") < 5000, F.col("at") + 1000)
    wrong = got.where((F.col("n") != F.floor(F.col("at") / 1000) + 1) | ~F.col("after").eqNullSafe(later))
    assert got.count() == 6000 and wrong.count() == 0


@pytest.mark.parametrize("threshold", [30, 10_000])
def test_root_cause_equals_self_join(spark, threshold):
    draw = random.Random(3)
    data = [
        (f"P{0 if i % 3 == 0 else draw.randrange(1, 40)}", i, draw.randrange(2000), draw.choice("AB"), draw.choice("XY"), draw.randrange(9), float(draw.randrange(99)))
        for i in range(400)
    ]
    layout = "patient_id string, v int, day int, diagnosis_code string, ward string, length_of_stay int, total_amount double"
    visits = spark.createDataFrame(data, layout).select(
        "*", F.date_add(F.lit("2000-01-01").cast("date"), F.col("day")).alias("admission_date"), (F.col("v") % 5 != 0).alias("readmission_flag")
    ).drop("day")
    visits.createOrReplaceTempView("visits_under_test")
    joined = spark.sql(
        """
        WITH n AS (SELECT *, row_number() OVER (PARTITION BY patient_id ORDER BY admission_date, v) AS k
                   FROM visits_under_test WHERE readmission_flag)
        SELECT a.diagnosis_code, a.ward, count(*) AS readmission_count, round(avg(a.length_of_stay), 1) AS los,
               round(avg(a.total_amount), 0) AS cost, floor(avg(datediff(b.admission_date, a.admission_date))) AS gap
        FROM n a JOIN n b ON a.patient_id = b.patient_id AND b.k = a.k + 1
             AND datediff(b.admission_date, a.admission_date) <= 30
        GROUP BY a.diagnosis_code, a.ward
        """
    )
    assert rows(readmission_root_cause(visits, ["v"], threshold=threshold)) == rows(joined)


@RELAXED
@given(
    st.dictionaries(st.integers(0, 9), st.integers(0, 9), max_size=8),
    st.dictionaries(st.integers(0, 9), st.integers(0, 9), max_size=8),
)
def test_upsert_is_dictionary_update_and_idempotent(spark, target, source):
    t = spark.createDataFrame(list(target.items()), "k int, v int")
    s = spark.createDataFrame(list(source.items()), "k int, v int")
    merged = merge_upsert(t, s, ["k"])
    assert rows(merged) == sorted({**target, **source}.items(), key=repr)
    assert rows(merge_upsert(merged, s, ["k"])) == rows(merged)
    newer = {k: max(v, target.get(k, v)) for k, v in source.items()}
    assert rows(merge_upsert(t, s, ["k"], newer_by="v")) == sorted({**target, **newer}.items(), key=repr)


def test_repeated_source_key_is_rejected(spark):
    with pytest.raises(DuplicateKeyError):
        require_unique(spark.createDataFrame([(1,), (1,)], "k int"), ["k"])


def test_quality_measures(spark):
    df = spark.createDataFrame([("a", None), (None, "2024-01-01"), ("b", "x")], "k string, d string")
    assert rows(null_counts(df, ["k", "d"])) == [("d", 1, True), ("k", 1, True)]
    assert rows(drop_null_keys(df, ["k"])) == [("a", None), ("b", "x")]
    assert rows(date_format_flags(df, ["d"]).select("d_valid")) == [(False,), (None,), (True,)]
    gate = non_empty_gate({"full": df, "empty": df.where("k = 'zz'")})
    assert rows(gate) == [("empty", 0, False), ("full", 3, True)]
    assert rows(gate_alerts(gate, "p", "r")) == [("p", "No data ingested from empty", "r")]
    with pytest.raises(EmptySourceError, match="empty"):
        require_non_empty({"full": df, "empty": df.where("k = 'zz'")})


def test_keys_are_counted_one_by_one_only_where_a_hash_cell_is_too_full(spark, monkeypatch):
    written = []
    monkeypatch.setattr(joins, "stage", lambda df, name: written.append(name) or df)
    df = spark.range(1000).select(F.concat(F.lit("P"), F.col("id") % 300).alias("p"), F.lit(1).alias("c"))
    assert joins.hot_keys(df, ["p"], joins.HOT_ROWS) == (None, 0) and not written
    assert joins.hot_keys(df.limit(0), ["p"], joins.HOT_ROWS) == (None, 0) and not written
    hot = df.unionByName(spark.range(500).select(F.lit("P7").alias("p"), F.lit(1).alias("c")))
    for cells, threshold in ((16, 400), (1 << 16, 400)):  # bounded by cells first, and counted at once
        monkeypatch.setattr(joins, "CELLS", cells)
        found, n = joins.hot_keys(hot, ["p"], threshold)
        assert n == 1 and rows(found) == [("P7", 504)] and written.pop() == "hot-keys"
