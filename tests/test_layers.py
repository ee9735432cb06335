"""Silver, gold, serving and model on small hand-made tables."""

import os

import pytest
from pyspark.sql import functions as F

from lakecare.catalog import queries
from lakecare.ml import readmission
from lakecare.plans import gold, jobs, serving, silver
from lakecare.schemas import BRONZE_CLAIMS, BRONZE_PATIENTS, GOLD
from lakecare.session import stage
from lakecare.sinks import tables

AS_OF, RUN = "2024-02-01", "2024-02-01"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def patient(key, admitted="2024-01-05", discharged="2024-01-10", born="1960-01-01", gender="F", code=" e11.9", modified="2024-01-10", flag=0, ward="Cardio"):
    return (key, "Ann", "Lee", born, gender, code, "text", admitted, discharged, "Dr. A", " h-1 ", "Ins", "I1", ward, flag, modified)


def claim(key, owner, total=100.0, covered=90.0, status=" approved", kind="inpatient", processed="2024-01-13"):
    return (key, owner, "H-1", "2024-01-05", "2024-01-10", "e11.9", "99", "visit", total, covered, total - covered, status, "2024-01-10", processed, "Ins", kind)


PATIENTS = [
    patient("P1"),
    patient("P1", modified="2024-01-20", flag=1, admitted="2024-01-15", discharged="2024-01-31"),
    patient("P2", gender="male", born="bad"),
    patient("P3", discharged=None),
    patient("P4", admitted="NULL"),
    patient(None),
]
CLAIMS = [
    claim("C1", "P1"),
    claim("C1", "P1", status="pending", processed="NULL"),
    claim("C2", "P1", total=600000.0, covered=540000.0, status="DENIED"),
    claim("C3", "P2", total=0.0, covered=0.0, kind="Outpatient"),
    claim(None, "P1"),
    claim("C9", None),
]


@pytest.fixture(scope="module")
def layers(spark):
    raw_patients = spark.createDataFrame(PATIENTS, BRONZE_PATIENTS)
    raw_claims = spark.createDataFrame(CLAIMS, BRONZE_CLAIMS)
    return silver.silver_patients(raw_patients, AS_OF, RUN), silver.silver_claims(raw_claims, AS_OF, RUN)


def test_silver_patients(layers):
    got = {r.patient_id: r for r in layers[0].collect()}
    assert set(got) == {"P1", "P2", "P3"}
    assert (got["P1"].readmission_flag, got["P1"].length_of_stay, got["P1"].first_name) == (True, 16, "***")
    assert (got["P1"].hospital_id, got["P1"].diagnosis_code, got["P1"].gender) == ("H-1", "E11.9", "Female")
    assert (got["P2"].age, got["P2"].age_group, got["P2"].gender) == (None, "Elderly", "Male")
    assert got["P3"].length_of_stay is None
    assert (got["P1"]["_run_date"], got["P1"]["_source_layer"], got["P1"]["_is_current"]) == (RUN, "bronze", True)


def test_silver_claims(layers):
    got = {r.claim_id: r for r in layers[1].collect()}
    assert set(got) == {"C1", "C2", "C3"}
    assert (got["C1"].claim_status, got["C1"].processing_days, got["C1"].coverage_ratio) == ("APPROVED", 3, 0.9)
    assert (got["C2"].high_value_flag, got["C3"].coverage_ratio, got["C3"].claim_type) == (True, 0.0, "OUTPATIENT")


def test_dim_and_fact(layers):
    patients, claims = layers
    dim = {r.patient_id: r for r in gold.dim_patient(patients).collect()}
    assert dim["P1"].risk_category == "High Risk" and dim["P1"].risk_score == round(64 * 0.3 + 16 * 2.5 + 20 + 5, 1)
    assert (dim["P3"].risk_score, dim["P3"].risk_category) == (100.0, "High Risk")
    assert rows(gold.dim_patient(patients, unique=True)) == rows(gold.dim_patient(patients))
    fact = gold.fact_admissions(patients, claims)
    assert fact.columns == GOLD["fact_admissions"].names
    assert rows(fact.select("patient_id", "claim_id")) == [("P1", "C1"), ("P1", "C2"), ("P2", "C3"), ("P3", None)]
    assert rows(gold.fact_admissions(patients, claims, threshold=1)) == rows(fact)


def test_aggregates_and_reports(layers):
    patients, claims = layers
    metrics, financial = gold.agg_hospital_metrics(patients, AS_OF, RUN), gold.agg_financial_summary(claims, AS_OF, RUN)
    m = metrics.first()
    assert (m.total_admissions, m.readmission_count, m.readmission_rate_pct, m.avg_length_of_stay) == (3, 1, 33.33, 10.5)
    board = serving.hospital_monthly_dashboard(metrics, financial).first()
    assert (board.total_revenue_inr, board.claim_count, board.high_value_claims) == (600100.0, 3, 1)
    month = serving.hospital_monthly_dashboard_by_period(metrics, gold.financial_by_period(claims)).first()
    assert month.total_revenue_inr == 600100.0
    assert serving.hospital_overview(serving.hospital_monthly_dashboard(metrics, financial), "2023-06-01").count() == 0
    insurance = {r.claim_type: r for r in serving.insurance_analysis(financial).collect()}
    assert (insurance["INPATIENT"].approved_claims, insurance["INPATIENT"].denied_claims, insurance["INPATIENT"].approval_rate_pct) == (1, 1, 50.0)
    fact, dim = gold.fact_admissions(patients, claims), gold.dim_patient(patients)
    followup = serving.high_risk_followup(serving.patient_risk_summary(dim, fact), AS_OF)
    assert [r.patient_id for r in followup.collect()] == ["P2", "P1"]  # unknown age scores the cap
    ward = serving.ward_efficiency(fact).first()
    assert (ward.total_patients, ward.avg_claim_per_patient) == (3, 150025.0)
    burden = gold.by_patient_count(gold.agg_disease_burden(patients, AS_OF)).first()
    assert (burden.patient_count, burden.disease_severity) == (3, "Moderate")


def test_followup_day_thirty_counts_only_from_midnight(spark):
    summary = spark.createDataFrame([("High Risk", "2024-01-02", 90.0, "P1")], "risk_category string, d string, risk_score double, patient_id string")
    summary = summary.select("risk_category", F.to_date("d").alias("discharge_date"), "risk_score", "patient_id")
    assert serving.high_risk_followup(summary, "2024-02-01 00:00:00").count() == 1
    assert serving.high_risk_followup(summary, "2024-02-01 00:00:01").count() == 0


def test_diagnosis_fan_out_equals_join_first(spark):
    fact = spark.createDataFrame(
        [("P1", "A", "W", 3, 40, True, 10.0), ("P1", "A", "W", 3, 40, True, None), ("P2", "B", "W", 5, 50, None, 7.0), ("P3", None, "W", 1, 9, False, 1.0)],
        "patient_id string, diagnosis_code string, ward string, length_of_stay int, age int, readmission_flag boolean, total_amount double",
    )
    dim = spark.createDataFrame([("A", "one"), ("A", "two"), ("A", None), (None, "lost")], "diagnosis_code string, diagnosis_description string")
    ours = serving.diagnosis_analytics(fact, dim).select("diagnosis_code", "diagnosis_description", "patient_count", "total_revenue")
    joined = fact.join(dim.distinct(), "diagnosis_code", "left").groupBy("diagnosis_code", "diagnosis_description", "ward").agg(
        F.count_distinct("patient_id").alias("n"), F.sum(F.coalesce("total_amount", F.lit(0.0))).alias("t")
    )
    assert rows(ours) == rows(joined.drop("ward"))


@pytest.mark.parametrize("layout", ["bucketed", "versioned"])
def test_jobs_end_to_end(spark, folder, layout):
    bronze, silver_base, gold_base = f"{folder}/bronze", f"{folder}/silver", f"{folder}/gold"
    for name, data, schema in (("patients", PATIENTS, BRONZE_PATIENTS), ("claims", CLAIMS, BRONZE_CLAIMS)):
        frame = spark.createDataFrame(data, schema)
        frame.write.option("header", "true").option("nullValue", "NULL").csv(f"{bronze}/{name}/2024/02/01")
    for _ in range(2):
        measures = jobs.bronze_to_silver(spark, bronze, silver_base, RUN, AS_OF, layout=layout, buckets=4)
        assert measures["patients"] == {"rows": 6, "patient_id": 1, "date_of_birth": 0, "admission_date": 1}
    assert tables.read_table(spark, f"{silver_base}/patients").count() == 3
    written = jobs.silver_to_gold(spark, silver_base, gold_base, RUN, AS_OF)
    assert written == {"dim_patient": 3, "fact_admissions": 4, "agg_hospital_metrics": 1, "agg_disease_burden": 1, "agg_financial_summary": 3}
    registered = serving.register_gold(spark, gold_base)
    assert registered["fact_admissions"].schema.names == GOLD["fact_admissions"].names
    serving.register_views(registered)
    assert spark.sql("SELECT max(claim_count) AS n FROM vw_hospital_monthly_dashboard").first().n == 3
    assert spark.sql("SELECT count(*) AS n FROM vw_patient_risk_summary").first().n == 3


def test_scoring_job_publishes_predictions_and_replaces_its_log_entries(spark, features, folder):
    inputs = set(readmission.FACT_INPUTS)
    features.select(*inputs).write.parquet(f"{folder}/gold/fact_admissions")
    features.select("patient_id", *readmission.PERSON_INPUTS).distinct().write.parquet(f"{folder}/gold/dim_patient")
    for _ in range(2):
        metrics = jobs.score_readmissions(
            spark, f"{folder}/gold", f"{folder}/model", "r1", AS_OF, grid_trees=(3,), grid_depth=(3,), folds=2
        )
    assert set(metrics) == {"auc_roc", "auc_pr", "accuracy", "f1_score"}
    assert tables.read_table(spark, f"{folder}/gold/{jobs.PREDICTIONS}").count() == features.count()
    assert spark.read.parquet(f"{folder}/gold/{jobs.RUN_METRICS}").count() == 7


def test_unknown_source_is_refused(spark, folder):
    with pytest.raises(ValueError):
        jobs.bronze_to_silver(spark, folder, folder, RUN, AS_OF, source="public_health")


@pytest.fixture(scope="module")
def features(spark):
    ids = spark.range(600)
    n = F.col("id")
    fact = ids.select(
        F.concat(F.lit("P"), n).alias("patient_id"), F.lit("H").alias("hospital_id"),
        F.date_add(F.lit("2024-01-01").cast("date"), (n % 60).cast("int")).alias("admission_date"), (n % 20).cast("int").alias("length_of_stay"),
        F.lit("A").alias("diagnosis_code"), F.concat(F.lit("W"), n % 3).alias("ward"), (20 + n % 70).cast("int").alias("age"),
        F.when(n % 2 == 0, "Senior").otherwise("Elderly").alias("age_group"), (n * 1.5).alias("total_amount"), F.lit(0.9).alias("coverage_ratio"),
        F.when(n % 5 == 0, None).otherwise("INPATIENT").alias("claim_type"), (n % 20 > 9).alias("readmission_flag"),
    )
    dim = ids.select(F.concat(F.lit("P"), n).alias("patient_id"), (n % 100).cast("double").alias("risk_score"), F.lit("Male").alias("gender"), F.lit("I").alias("insurance_provider"))
    return readmission.ml_features(fact, dim).cache()


def test_split_is_stable_and_complete(features):
    first = readmission.split(features)
    second = readmission.split(features.repartition(3))
    assert rows(first[0]) == rows(second[0])
    assert first[0].count() + first[1].count() == features.count()
    assert 0.7 < first[0].count() / features.count() < 0.9


def test_forests_see_few_partitions_however_many_the_rows_lie_in(features, monkeypatch):
    seen, fit = [], readmission.RandomForestClassifier.fit

    def watched(self, rows, *params):
        seen.append(rows.rdd.getNumPartitions())
        return fit(self, rows, *params)

    monkeypatch.setattr(readmission.RandomForestClassifier, "fit", watched)
    spread = features.repartition(200)
    training, _ = readmission.split(spread)
    chosen = readmission.fit_sample(training, training.count() // 2)
    assert chosen.exceptAll(training).count() == 0 and 0 < chosen.count() < training.count()
    assert rows(readmission.fit_sample(training, 10**6)) == rows(training)
    readmission.train(spread, grid_trees=(2,), grid_depth=(3,), folds=2, drop_leaky=True, fit_rows=training.count() // 2)
    assert len(seen) == 3 and max(seen) <= readmission.FIT_PARTS


def test_model_trains_scores_and_reloads(spark, features, folder):
    trained = readmission.train(features, grid_trees=(5,), grid_depth=(3, 4), folds=2, drop_leaky=True)
    few = readmission.train(features, grid_trees=(2,), grid_depth=(3,), folds=2, drop_leaky=True, fit_rows=40).params
    assert 0 < int(few["train_size"]) < int(trained.params["train_size"]) and few["test_size"] == trained.params["test_size"]
    assert set(trained.metrics) == {"auc_roc", "auc_pr", "accuracy", "f1_score"} and trained.metrics["auc_roc"] > 0.9
    assert len(trained.fold_auc) == 2
    scored = readmission.score(trained.model, features, AS_OF)
    assert tuple(scored.columns) == readmission.SCORES and scored.count() == features.count()
    assert scored.where("readmission_probability NOT BETWEEN 0 AND 1").count() == 0
    readmission.save_model(trained.model, f"{folder}/model")
    assert rows(readmission.score(readmission.load_model(f"{folder}/model"), features, AS_OF)) == rows(scored)
    weights = readmission.feature_importances(trained.model, features).collect()
    assert weights[0].feature == "length_of_stay" and abs(sum(w.importance for w in weights) - 1) < 1e-6
    assert not any("risk_score" in w.feature for w in weights)
    log = readmission.metrics_table(spark, trained, "r", AS_OF)
    assert log.where("kind = 'param'").count() == 3 and log.where("kind = 'metric'").count() == 4
    assert sum(r.patients for r in readmission.risk_band_distribution(scored).collect()) == features.count()


def test_calendar_of_the_facts_is_read_off_below_the_join(layers):
    text = gold.fact_admissions(*layers)._jdf.queryExecution().optimizedPlan().toString()
    assert text.index("Join") < text.index("year(")


def test_large_batches_are_not_dealt_out_by_bucket_again(spark, folder, monkeypatch):
    seen, write = [], jobs.upsert_bucketed
    monkeypatch.setattr(jobs, "upsert_bucketed", lambda *a, **b: (seen.append(b["gather"]), write(*a, **b)))
    for name, data, schema in (("patients", PATIENTS, BRONZE_PATIENTS), ("claims", CLAIMS, BRONZE_CLAIMS)):
        spark.createDataFrame(data, schema).write.parquet(f"{folder}/bronze/{name}/2024/02/01")
    stored = []
    for size in (10_000, 0):
        monkeypatch.setattr(jobs, "FILE_ROWS", size)
        jobs.bronze_to_silver(spark, f"{folder}/bronze", f"{folder}/silver-{size}", RUN, AS_OF, fmt="parquet", buckets=4)
        stored.append([rows(tables.read_table(spark, f"{folder}/silver-{size}/{name}")) for name in ("patients", "claims")])
    assert seen == [True, True, False, False] and stored[0] == stored[1]


def test_layers_are_deleted_once_the_next_one_is_written(spark, folder):
    lake = queries.Lake(spark, folder)
    lake.raw_patients = spark.createDataFrame([(*r, i) for i, r in enumerate(PATIENTS)], f"{spark_ddl(BRONZE_PATIENTS)}, record_id long")
    lake.raw_claims = spark.createDataFrame([(*r, str(i)) for i, r in enumerate(CLAIMS)], f"{spark_ddl(BRONZE_CLAIMS)}, record_id string")
    base = queries._ran_layers(lake)
    assert os.listdir(base) == ["gold"] and tables.read_table(spark, f"{base}/gold/dim_patient").count() == 3


def spark_ddl(schema):
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)


def test_forests_are_fitted_on_all_training_rows(features, monkeypatch):
    def refused(*_):
        raise AssertionError("rows were chosen")

    fitted, fit = [], readmission.RandomForestClassifier.fit
    monkeypatch.setattr(readmission, "fit_sample", refused)
    monkeypatch.setattr(readmission.RandomForestClassifier, "fit", lambda self, rows, *p: (fitted.append(rows.count()), fit(self, rows, *p))[1])
    trained = readmission.train(features, grid_trees=(2,), grid_depth=(3,), folds=2, parallelism=1)
    whole = readmission.split(features)[0].count()
    assert trained.params["train_size"] == str(whole) and fitted[0] + fitted[1] == whole == fitted[2]


def test_vectors_of_many_rows_are_written_to_scratch_and_forests_fitted_in_turn(spark, features, monkeypatch):
    together = features.coalesce(1)  # one file of the same order, so that forests draw the same rows
    few = readmission.train(together, grid_trees=(2,), grid_depth=(2, 3), folds=2)
    staged, running, fit = [], [], readmission.RandomForestClassifier.fit

    def watched(self, rows, *params):
        running.append(1)
        assert len(running) == 1 and staged and not rows.storageLevel.useMemory
        found = fit(self, rows, *params)
        running.pop()
        return found

    def noted(df, name):
        staged.append(stage(df, name))
        return staged[-1]

    monkeypatch.setattr(readmission, "CACHED_ROWS", 10)
    monkeypatch.setattr(readmission, "stage", noted)
    monkeypatch.setattr(readmission.RandomForestClassifier, "fit", watched)
    many = readmission.train(together, grid_trees=(2,), grid_depth=(2, 3), folds=2)
    assert (many.fold_auc, many.metrics, many.params) == (few.fold_auc, few.metrics, few.params)
    assert len(staged) == 5 and not any(tables.path_exists(spark, f.rsplit("/", 1)[0]) for df in staged for f in df.inputFiles())
