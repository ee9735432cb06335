"""One query per operator, each computed from the tables in ``folder`` alone."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, LongType, StringType, StructField, StructType

from lakecare.functions import rules
from lakecare.functions.clock import run_date_folder
from lakecare.ml import ranking, readmission
from lakecare.operators.dedupe import dedupe_latest
from lakecare.operators.merge import merge_upsert
from lakecare.operators.quality import EmptySourceError, date_format_flags, drop_null_keys, gate_alerts, non_empty_gate, null_counts
from lakecare.plans import gold, incremental, ingest, jobs, serving, silver
from lakecare.schemas import BRONZE_CLAIMS, BRONZE_PATIENTS, EXTRACT_COLUMNS, GOLD_PARTITIONS, VITALS_EVENT
from lakecare.session import delete_path, scratch_path, stage, streaming_session
from lakecare.sinks import checksums, clustering, tables
from lakecare.sources import batch, bundles, control, rescue, retail
from lakecare.streaming import compaction, fanout, landing, vitals as streams

AS_OF, RUN_DATE = "2001-08-01 00:00:00", "2001-08-01"
EXTRACT_SINCE = "2001-06-01"
PATIENT_TIES = ["record_id"]

Query = Callable[[SparkSession, str], DataFrame]


class Lake:
    """The layers of one folder of test tables, derived lazily."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder

    @cached_property
    def raw_patients(self) -> DataFrame:
        return retail.bronze_patients(self.spark, self.folder)

    @cached_property
    def raw_claims(self) -> DataFrame:
        return retail.bronze_claims(self.spark, self.folder)

    @cached_property
    def vitals(self) -> DataFrame:
        return retail.vitals(self.spark, self.folder)

    @cached_property
    def admissions(self) -> DataFrame:
        return silver.standardized_patients(self.raw_patients, AS_OF)

    @cached_property
    def patients(self) -> DataFrame:
        return silver.silver_patients(self.raw_patients, AS_OF, RUN_DATE, PATIENT_TIES)

    @cached_property
    def claims(self) -> DataFrame:
        ties = [F.desc_nulls_last("total_amount"), "record_id"]
        return silver.silver_claims(self.raw_claims, AS_OF, RUN_DATE, ties)

    @cached_property
    def dim(self) -> DataFrame:
        return gold.dim_patient(self.patients, unique=True)

    @cached_property
    def fact_claims(self) -> DataFrame:
        """Claims are used twice (hot-key count, join), so they are written once first."""
        return stage(self.claims.select(*gold.CLAIM_SIDE), "claims")

    @cached_property
    def fact(self) -> DataFrame:
        return gold.fact_admissions(self.patients, self.fact_claims)

    @cached_property
    def metrics(self) -> DataFrame:
        return gold.agg_hospital_metrics(self.patients, AS_OF, RUN_DATE)

    @cached_property
    def financial(self) -> DataFrame:
        return gold.agg_financial_summary(self.claims, AS_OF, RUN_DATE)

    @cached_property
    def dashboard(self) -> DataFrame:
        return serving.hospital_monthly_dashboard(self.metrics, self.financial)

    @cached_property
    def features(self) -> DataFrame:
        """Facts meet the stored dimension: with plain shuffles on both sides, adaptive
        execution can split a patient who owns a large share of the facts."""
        return readmission.ml_features(self.fact, stage(self.dim, "dim"))


QUERIES: dict[str, Query] = {}


def query(build: Callable[[Lake], DataFrame]) -> Callable[[Lake], DataFrame]:
    QUERIES[build.__name__] = lambda spark, folder: build(Lake(spark, folder))
    return build


# Sources ------------------------------------------------------------------------------


def _control(lake: Lake) -> DataFrame:
    """Load history: one control row per loaded month of each raw table."""

    def history(df: DataFrame, name: str, column: str) -> DataFrame:
        day = rules.parsed_date(F.col(column))
        return (
            df.groupBy(F.trunc(day, "month").alias("loaded"))
            .agg(F.max(day).alias("last_modified_date"))
            .select(F.lit(name).alias("table_name"), "last_modified_date")
        )

    return history(lake.raw_patients, "EHR_Patients", "last_modified_date").unionByName(
        history(lake.raw_claims, "Claims", "submitted_date")
    )


@query
def watermark_lookup(lake: Lake) -> DataFrame:
    return control.watermark_lookup(_control(lake), "EHR_Patients")


@query
def incremental_extract(lake: Lake) -> DataFrame:
    columns = lake.raw_patients.select(*EXTRACT_COLUMNS, "record_id")
    return batch.incremental_filter(columns, "last_modified_date", EXTRACT_SINCE)


@query
def watermark_update(lake: Lake) -> DataFrame:
    path = scratch_path(lake.spark, "control")
    control.store_watermark(lake.spark, path, lake.raw_patients, "EHR_Patients", "last_modified_date")
    control.store_watermark(lake.spark, path, lake.raw_claims, "Claims", "submitted_date")
    return tables.read_table(lake.spark, path)


#: Rows whose key is a multiple are committed to the source only after the first run.
LATE_KEYS, LOOKBACK_DAYS = 13, 30


def _ingested(lake: Lake) -> str:
    """Four runs of the ingestion job: rows known then, all rows with late ones, the second again, and no news."""
    base, at = scratch_path(lake.spark, "ingest"), datetime.fromisoformat(AS_OF)
    source = lake.raw_patients.select(*EXTRACT_COLUMNS, "record_id")
    known = source.where((F.col("last_modified_date") < EXTRACT_SINCE) & (F.col("record_id") % LATE_KEYS != 0))
    for run_id, rows in (("run-1", known), ("run-2", source), ("run-2", source.limit(0)), ("run-3", source)):
        try:
            ingest.ingest_increment(
                lake.spark, rows, "EHR_Patients", "last_modified_date", f"{base}/bronze", f"{base}/control", f"{base}/log",
                RUN_DATE, run_id, at, {"record_id": "bigint", "date_of_birth": "date"}, lookback_days=LOOKBACK_DAYS,
            )
        except EmptySourceError:  # the gate's verdict is in the log
            pass
    return base


@query
def ingest_job_control(lake: Lake) -> DataFrame:
    """The run log of four runs and the final watermark."""
    base = _ingested(lake)
    log = lake.spark.read.schema(tables.RUN_LOG).parquet(f"{base}/log").drop("run_time")
    moved = tables.read_table(lake.spark, f"{base}/control")
    return log.join(moved, F.col("pipeline_name") == F.col("table_name")).drop("table_name")


@query
def ingest_overlap_rows(lake: Lake) -> DataFrame:
    """Every row that the runs have landed, with its run: late ones within the lookback, none twice."""
    landed = lake.spark.read.parquet(f"{_ingested(lake)}/bronze/EHR_Patients/{run_date_folder(RUN_DATE)}")
    return landed.select("record_id", "last_modified_date", "date_of_birth", F.col("_rescued")["date_of_birth"].alias("raw_birth"), "run_id")


@query
def csv_bronze_scan(lake: Lake) -> DataFrame:
    base = scratch_path(lake.spark, "bronze-csv")
    _write_csv(lake.raw_claims.select(*BRONZE_CLAIMS.names), f"{base}/claims/{run_date_folder(RUN_DATE)}")
    return batch.read_bronze(lake.spark, base, "claims", RUN_DATE, BRONZE_CLAIMS)


def _write_csv(df: DataFrame, path: str) -> None:
    df.write.options(
        header="true", nullValue="NULL", ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false"
    ).csv(path)


@query
def json_landed_scan(lake: Lake) -> DataFrame:
    base = scratch_path(lake.spark, "bronze-json")
    stamped = lake.vitals.withColumn("event_time", F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
    stamped.write.json(f"{base}/source=vitals/{run_date_folder(RUN_DATE)}")
    rows = batch.read_landed_json(lake.spark, base, RUN_DATE, VITALS_EVENT, "vitals")
    return rows.withColumn("event_time", F.col("event_time").cast("timestamp_ntz"))


#: Declared fields of a claim in a landed bundle.
CLAIM_FIELDS = {
    "claim_id": ("$.claim.id", "string"),
    "total_amount": ("$.claim.amount.total", "double"),
    "insurance_covered": ("$.claim.amount.covered", "double"),
    "submitted_date": ("$.submitted", "date"),
    "processed_date": ("$.processed", "date"),
    "first_code": ("$.codes[0].code", "string"),
}


def _bundles(lake: Lake) -> DataFrame:
    """Claims as landed bundles, one per patient and admission day, some documents cut short."""
    base = scratch_path(lake.spark, "bundles")
    amount = F.struct(F.col("total_amount").alias("total"), F.col("insurance_covered").alias("covered"))
    entry = F.struct(
        F.struct(F.col("claim_id").alias("id"), amount.alias("amount")).alias("claim"),
        F.col("submitted_date").alias("submitted"),
        F.col("processed_date").alias("processed"),
        F.array(F.struct(F.trim("diagnosis_code").alias("code")), F.struct(F.col("procedure_code").alias("code"))).alias("codes"),
        F.struct(F.col("claim_type").alias("type")).alias("extra"),
    )
    grouped = lake.raw_claims.groupBy("patient_id", "admission_date").agg(F.collect_list(entry).alias("entry"))
    whole = F.to_json(F.struct(F.lit("Bundle").alias("resourceType"), "patient_id", "admission_date", F.struct("entry").alias("data")))
    cut = F.when(F.col("admission_date").endswith("-13"), whole.substr(F.lit(1), F.length(whole) - 2)).otherwise(whole)
    grouped.select(cut.alias("value")).write.text(base, compression="snappy")
    return bundles.read_bundles(lake.spark, base)


@query
def nested_bundle_claims(lake: Lake) -> DataFrame:
    """Typed claims out of nested bundles, with the cells that no type could hold and the undeclared fields."""
    header = {"patient_id": ("$.patient_id", "string"), "admission_date": ("$.admission_date", "date")}
    rows = bundles.bundle_entries(_bundles(lake), "$.data.entry", CLAIM_FIELDS, header)
    raw, rest = F.col(rescue.RESCUED)["processed_date"], F.col(bundles.UNKNOWN)["extra"]
    return rows.select(*header, *CLAIM_FIELDS, raw.alias("raw_processed"), rest.alias("extra"))


@query
def nested_bundle_rejects(lake: Lake) -> DataFrame:
    """Documents that are no JSON, counted by the admission month they still show."""
    text = F.col(bundles.CORRUPT)
    month = F.regexp_extract(text, '"admission_date":"([0-9]{4}-[0-9]{2})', 1)
    return bundles.corrupt_bundles(_bundles(lake)).groupBy(month.alias("month")).agg(F.count(F.lit(1)).alias("documents"))


@query
def csv_landing_stream(lake: Lake) -> DataFrame:
    base = scratch_path(lake.spark, "landing")
    _write_csv(lake.raw_patients.select(*BRONZE_PATIENTS.names), f"{base}/in")
    landing.land_and_archive(
        lake.spark, f"{base}/in", BRONZE_PATIENTS, f"{base}/bronze", RUN_DATE, f"{base}/checkpoint", f"{base}/archive"
    )
    rows = landing.read_landed(lake.spark, f"{base}/bronze", f"{base}/checkpoint", BRONZE_PATIENTS)
    return rows.select(*BRONZE_PATIENTS.names)


#: The raw patients as a source should declare them: dates that do not parse have to be rescued.
TYPED_PATIENTS = StructType(
    [
        StructField(f.name, DateType() if f.name in ("date_of_birth", "admission_date", "discharge_date") else f.dataType)
        for f in BRONZE_PATIENTS.fields
    ]
    + [StructField("record_id", LongType())]
)


def _deliver(lake: Lake, rows: DataFrame, base: str, name: str, age_days: int = 0) -> None:
    """Put the rows into the landing folder as the files ``<name>-<i>.csv``, stamped as old as asked for."""
    staged = f"{base}/sent-{name}-{uuid.uuid4().hex}"
    _write_csv(rows.repartition(2, "record_id"), staged)
    sent, into = landing.Folder(lake.spark, staged), landing.Folder(lake.spark, f"{base}/in")
    for i, file in enumerate(sorted(sent.files())):
        sent.move(file, f"{into.root}/{name}-{i}.csv")
        if age_days:
            stamp = into.stat(f"{name}-{i}.csv")[1] - age_days * 86_400_000
            into.fs.setTimes(into.at(f"{name}-{i}.csv"), stamp, -1)


def _landed(lake: Lake) -> str:
    """Two days of deliveries: the second day brings the first one's file names again, and old files."""
    base = scratch_path(lake.spark, "manifest")
    rows = lake.raw_patients.select(*TYPED_PATIENTS.names)
    part = F.col("record_id") % 3

    def run(day: str) -> None:
        landing.land_and_archive(
            lake.spark, f"{base}/in", TYPED_PATIENTS, f"{base}/bronze", day, f"{base}/checkpoint", f"{base}/archive",
            required=["admission_date"],
        )

    _deliver(lake, rows.where(part == 0), base, "a")
    run("2001-07-31")
    _deliver(lake, rows.where(part == 1), base, "a")
    _deliver(lake, rows.where(part == 2), base, "c", age_days=30)
    run(RUN_DATE)
    run(RUN_DATE)
    return base


@query
def landing_manifest(lake: Lake) -> DataFrame:
    """What became of each delivery, beside the rows found in its archived files."""
    base = _landed(lake)
    name = F.regexp_replace("name", "-[0-9]+[.]csv$", "")
    log = landing.deliveries(landing.read_manifest(lake.spark, f"{base}/checkpoint/manifest"))
    told = log.groupBy("folder", name.alias("delivery"), "state").agg(
        F.sum("rows").alias("rows"), F.sum("quarantined").alias("quarantined")
    )
    kept = lake.spark.read.option("recursiveFileLookup", "true").option("header", "true").csv(f"{base}/archive")
    where = F.regexp_extract_all("path", F.lit("/([0-9]+/[0-9]+/[0-9]+)/batch=[0-9]+/([a-z]+)-"), F.lit(1))[0]
    of = F.regexp_extract("path", "/batch=[0-9]+/([a-z]+)-", 1)
    archived = (
        kept.select(F.col("_metadata.file_path").alias("path"))
        .groupBy(where.alias("folder"), of.alias("delivery")).agg(F.count(F.lit(1)).alias("archived_rows"))
    )
    return told.join(archived, ["folder", "delivery"], "left")


@query
def landing_rows(lake: Lake) -> DataFrame:
    """All rows landed by the two days, good or set apart, with the raw text of unreadable dates."""
    base = _landed(lake)
    parts = [
        landing.read_landed(lake.spark, f"{base}/bronze", f"{base}/checkpoint", TYPED_PATIENTS, apart).withColumn("apart", F.lit(apart))
        for apart in (False, True)
    ]
    rescued = [F.col("_rescued")[c].alias(f"raw_{c}") for c in ("date_of_birth", "admission_date")]
    return parts[0].unionByName(parts[1]).select("record_id", "admission_date", "date_of_birth", "apart", *rescued)


@query
def csv_rescued_cells(lake: Lake) -> DataFrame:
    """Every cell of the raw CSV that its declared type cannot hold."""
    path = scratch_path(lake.spark, "rescued-csv")
    _write_csv(lake.raw_patients.select(*TYPED_PATIENTS.names), path)
    return rescue.rescued_cells(rescue.read_csv_rescued(lake.spark, path, TYPED_PATIENTS), "record_id")


@query
def typed_landing_rescued(lake: Lake) -> DataFrame:
    """Typed copy of the raw claims: rescued cells per column, good and quarantined rows, as the write counted them."""
    types = {"claim_id": "string", "processed_date": "date", "submitted_date": "date", "procedure_code": "int", "total_amount": "double"}
    split = tables.land_rescued(lake.raw_claims, scratch_path(lake.spark, "typed-rescued"), types, ["processed_date"])
    counts = [(c, n, split.rows, split.quarantined) for c, n in split.rescued.items()]
    return lake.spark.createDataFrame(counts, "column_name string, cells bigint, rows bigint, quarantined bigint")


# Quality ------------------------------------------------------------------------------


@query
def null_count_report(lake: Lake) -> DataFrame:
    columns = [*silver.CRITICAL_PATIENT_COLUMNS, "gender", "discharge_date", "readmission_flag"]
    return null_counts(lake.raw_patients, columns)


@query
def drop_null_key_rows(lake: Lake) -> DataFrame:
    kept = drop_null_keys(lake.raw_patients, ["patient_id", "discharge_date"])
    return kept.select("record_id", "patient_id", "discharge_date")


@query
def date_format_validity(lake: Lake) -> DataFrame:
    columns = ["date_of_birth", "admission_date", "discharge_date"]
    flagged = date_format_flags(lake.raw_patients, columns)
    return flagged.select("record_id", *[f"{c}_valid" for c in columns])


@query
def code_validity(lake: Lake) -> DataFrame:
    code = F.col("diagnosis_code")
    return (
        lake.raw_patients.groupBy("diagnosis_code")
        .agg(F.count(F.lit(1)).alias("rows"))
        .select("diagnosis_code", rules.valid_code(code).alias("is_valid"), "rows")
    )


@query
def nonempty_gate(lake: Lake) -> DataFrame:
    return non_empty_gate(_gated(lake))


def _gated(lake: Lake) -> dict[str, DataFrame]:
    return {
        "patients": lake.raw_patients,
        "claims": lake.raw_claims,
        "vitals": lake.vitals,
        "future_vitals": lake.vitals.where(F.col("event_time") > F.lit("2100-01-01")),
    }


@query
def nonempty_gate_alerts(lake: Lake) -> DataFrame:
    return gate_alerts(non_empty_gate(_gated(lake)), "public_health", "run-1")


@query
def dedupe_latest_claims(lake: Lake) -> DataFrame:
    dated = lake.raw_claims.withColumn("processed_date", rules.parsed_date(F.col("processed_date")))
    ties = [F.desc_nulls_last("total_amount"), "record_id"]
    latest = dedupe_latest(dated, ["claim_id"], ["processed_date", "submitted_date"], ties)
    return latest.select("claim_id", "processed_date", "submitted_date", "total_amount", "record_id")


# Rules --------------------------------------------------------------------------------


@query
def gender_standardized(lake: Lake) -> DataFrame:
    return (
        lake.raw_patients.groupBy(F.col("gender").alias("raw_gender"), rules.gender(F.col("gender")).alias("gender"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )


@query
def age_years(lake: Lake) -> DataFrame:
    born = rules.parsed_date(F.col("date_of_birth"))
    return lake.raw_patients.select(
        "record_id",
        rules.age(born, AS_OF).alias("age_elapsed"),
        rules.age(born, AS_OF, "calendar").alias("age_calendar"),
    )


@query
def age_group_counts(lake: Lake) -> DataFrame:
    return lake.admissions.groupBy("age_group").agg(F.count(F.lit(1)).alias("admissions"))


@query
def risk_scores(lake: Lake) -> DataFrame:
    inputs = [F.col(c) for c in ("age", "length_of_stay", "readmission_flag", "age_group")]
    capped = rules.risk_score(*inputs)
    return lake.admissions.select(
        "record_id",
        capped.alias("risk_score"),
        rules.risk_category(capped).alias("risk_category"),
        rules.risk_score(*inputs, null_policy="null").alias("risk_score_known"),
    )


@query
def coverage_ratios(lake: Lake) -> DataFrame:
    return lake.raw_claims.select(
        "claim_id",
        "record_id",
        rules.coverage_ratio(F.col("insurance_covered"), F.col("total_amount")).alias("coverage_ratio"),
    )


@query
def high_value_claims(lake: Lake) -> DataFrame:
    return (
        lake.raw_claims.withColumn("high_value_flag", rules.high_value(F.col("total_amount")))
        .groupBy("high_value_flag")
        .agg(F.count(F.lit(1)).alias("claims"))
    )


@query
def case_insensitive_status(lake: Lake) -> DataFrame:
    status = F.trim("claim_status")
    return lake.raw_claims.agg(
        *[
            F.count_if(rules.same_text(status, name)).alias(f"{name}_rows")
            for name in ("approved", "denied", "pending")
        ]
    )


@query
def pii_mask(lake: Lake) -> DataFrame:
    return lake.patients.select("patient_id", "first_name", "last_name")


@query
def stay_bucket_counts(lake: Lake) -> DataFrame:
    return (
        lake.admissions.groupBy(rules.stay_bucket(F.col("length_of_stay")).alias("los_bucket"))
        .agg(F.count(F.lit(1)).alias("admissions"))
    )


# Silver and gold ----------------------------------------------------------------------


@query
def silver_patients(lake: Lake) -> DataFrame:
    return lake.patients


@query
def silver_claims(lake: Lake) -> DataFrame:
    return lake.claims


@query
def dim_patient(lake: Lake) -> DataFrame:
    return lake.dim


@query
def dim_patient_latest_admission(lake: Lake) -> DataFrame:
    stamped = lake.admissions.withColumns(rules.audit_columns(AS_OF, RUN_DATE))
    return gold.dim_patient(stamped, PATIENT_TIES)


@query
def fact_admissions(lake: Lake) -> DataFrame:
    return lake.fact


@query
def agg_hospital_metrics(lake: Lake) -> DataFrame:
    return lake.metrics


@query
def hospital_metrics_by_admission(lake: Lake) -> DataFrame:
    return gold.agg_hospital_metrics(lake.admissions, AS_OF, RUN_DATE)


@query
def hospital_metrics_incremental(lake: Lake) -> DataFrame:
    """The metrics of all admissions, folded into stored states in two batches, one of them sent twice."""
    path = scratch_path(lake.spark, "states")
    for number in (0, 1, 1):
        part = lake.admissions.where(F.col("record_id") % 2 == number)
        incremental.fold_batch(lake.spark, path, part, number, buckets=8)
    return incremental.current_metrics(lake.spark, path, AS_OF, RUN_DATE)


@query
def agg_disease_burden(lake: Lake) -> DataFrame:
    return gold.by_patient_count(gold.agg_disease_burden(lake.patients, AS_OF))


@query
def agg_financial_summary(lake: Lake) -> DataFrame:
    return lake.financial


# Views and reports --------------------------------------------------------------------


@query
def hospital_monthly_dashboard(lake: Lake) -> DataFrame:
    return lake.dashboard


@query
def hospital_monthly_dashboard_by_period(lake: Lake) -> DataFrame:
    return serving.hospital_monthly_dashboard_by_period(lake.metrics, gold.financial_by_period(lake.claims))


@query
def patient_risk_summary(lake: Lake) -> DataFrame:
    return serving.patient_risk_summary(lake.dim, lake.fact)


@query
def diagnosis_analytics(lake: Lake) -> DataFrame:
    return serving.diagnosis_analytics(lake.fact, lake.dim)


@query
def insurance_analysis(lake: Lake) -> DataFrame:
    return serving.insurance_analysis(lake.financial)


@query
def hospital_overview(lake: Lake) -> DataFrame:
    return serving.hospital_overview(lake.dashboard, AS_OF)


@query
def monthly_trend(lake: Lake) -> DataFrame:
    return serving.monthly_trend(lake.dashboard)


@query
def top_diagnoses(lake: Lake) -> DataFrame:
    return serving.top_diagnoses(serving.diagnosis_analytics(lake.fact, lake.dim))


@query
def high_risk_followup(lake: Lake) -> DataFrame:
    return serving.high_risk_followup(serving.patient_risk_summary(lake.dim, lake.fact), AS_OF)


@query
def insurer_comparison(lake: Lake) -> DataFrame:
    return serving.insurer_comparison(serving.insurance_analysis(lake.financial))


@query
def ward_efficiency(lake: Lake) -> DataFrame:
    return serving.ward_efficiency(lake.fact)


@query
def visit_sequence(lake: Lake) -> DataFrame:
    visits = lake.admissions.select("patient_id", "admission_date", "record_id", "ward", "readmission_flag")
    return serving.visit_sequence(visits, PATIENT_TIES).drop("readmission_flag")


#: Rows a key may have before the hot-key plans treat it apart; low, so that these queries take them.
HOT_HERE = 3


@query
def fact_admissions_hot_keys(lake: Lake) -> DataFrame:
    claims = stage(lake.claims.select(*gold.CLAIM_SIDE), "claims")
    return gold.fact_admissions(lake.patients, claims, HOT_HERE)


@query
def visit_sequence_hot_keys(lake: Lake) -> DataFrame:
    visits = lake.admissions.select("patient_id", "admission_date", "record_id", "ward", "readmission_flag")
    return serving.visit_sequence(visits, PATIENT_TIES, HOT_HERE).drop("readmission_flag")


@query
def readmission_root_cause(lake: Lake) -> DataFrame:
    fact = lake.fact.withColumn("visit_key", F.coalesce("claim_id", F.lit("")))
    return serving.readmission_root_cause(fact, ["visit_key"])


@query
def readmission_root_cause_by_admission(lake: Lake) -> DataFrame:
    return serving.readmission_root_cause(lake.admissions, PATIENT_TIES)


@query
def external_gold_tables(lake: Lake) -> DataFrame:
    """Counts per hospital from all four catalog tables, which are dropped again."""
    base = _stored_gold(lake)
    database = f"lakecare_gold_{uuid.uuid4().hex}"
    dim, fact, metrics, money = (
        lake.spark.table(name) for name in serving.create_gold_tables(lake.spark, base, database)
    )
    counted = (
        metrics.groupBy("hospital_id").agg(F.sum("total_admissions").alias("admissions"))
        .join(money.groupBy("hospital_id").agg(F.sum("claim_count").alias("claims")), "hospital_id", "left")
        .join(dim.groupBy("hospital_id").agg(F.count(F.lit(1)).alias("patients")), "hospital_id", "left")
        .join(fact.groupBy("hospital_id").agg(F.count("claim_id").alias("claimed")), "hospital_id", "left")
    )
    found = stage(counted, "gold-counts")
    lake.spark.sql(f"DROP DATABASE {database} CASCADE")
    return found


def _stored_gold(lake: Lake) -> str:
    """The four gold tables as files, from silver tables that are written once first."""
    base = scratch_path(lake.spark, "gold")
    lake.patients = stage(lake.patients.select(*gold.PATIENT_COLUMNS), "patients")
    lake.claims = lake.fact_claims = stage(lake.claims.select(*gold.CLAIM_COLUMNS), "claims")
    frames = {
        "dim_patient": lake.dim,
        "fact_admissions": lake.fact,
        "agg_hospital_metrics": lake.metrics,
        "agg_financial_summary": lake.financial,
    }
    for name, frame in frames.items():
        tables.overwrite_table(frame, f"{base}/{name}", GOLD_PARTITIONS.get(name, ()))
    return base


@query
def external_gold_views(lake: Lake) -> DataFrame:
    serving.register_views(serving.register_gold(lake.spark, _stored_gold(lake)))
    return lake.spark.sql(
        """
        SELECT d.hospital_id, d.admission_year, d.admission_month, d.total_admissions, d.total_revenue_inr,
               r.patients, r.high_risk
        FROM vw_hospital_monthly_dashboard d
        LEFT JOIN (SELECT hospital_id, count(*) AS patients, count_if(risk_category = 'High Risk') AS high_risk
                   FROM vw_patient_risk_summary GROUP BY hospital_id) r
          ON d.hospital_id = r.hospital_id
        """
    )


# Sinks --------------------------------------------------------------------------------


def _claim_versions(lake: Lake) -> tuple[DataFrame, DataFrame]:
    """Target: the first version of each claim. Source: the last one, for claims submitted since 1998."""
    columns = ["claim_id", "submitted_date", "claim_status", "total_amount", "record_id"]
    rows = stage(lake.raw_claims.select(*columns), "claim-rows")  # used for both
    last = dedupe_latest(rows, ["claim_id"], ["submitted_date"], ["record_id"])
    back = [F.asc("submitted_date"), F.desc("record_id")]
    first = dedupe_latest(rows, ["claim_id"], [], back)
    return first.where("submitted_date < '1999-06-01'"), last.where("submitted_date >= '1998-01-01'")


@query
def merge_upsert_claims(lake: Lake) -> DataFrame:
    target, source = _claim_versions(lake)
    return merge_upsert(target, source, ["claim_id"])


@query
def merge_upsert_newer_only(lake: Lake) -> DataFrame:
    target, source = _claim_versions(lake)
    return merge_upsert(source, target, ["claim_id"], newer_by="submitted_date")


@query
def bucketed_table_upsert(lake: Lake) -> DataFrame:
    target, source = _claim_versions(lake)
    path = scratch_path(lake.spark, "upsert")
    for rows in (target, source):
        tables.upsert_bucketed(lake.spark, path, rows, ["claim_id"], buckets=16)
    return tables.read_table(lake.spark, path)


@query
def schema_change_upsert(lake: Lake) -> DataFrame:
    """Three upserts: the second widens a column and adds one, the third, of few keys, adds another to few buckets."""
    path = scratch_path(lake.spark, "evolved")
    claims = dedupe_latest(lake.raw_claims, ["claim_id"], ["submitted_date"], ["record_id"])
    claims = stage(claims.select("claim_id", "submitted_date", "procedure_description", "claim_type", "total_amount"), "claims")
    size = F.length("procedure_description")
    first = claims.select("claim_id", "submitted_date", size.alias("units"), F.col("total_amount").cast("int").alias("amount"))
    later = claims.where("submitted_date >= '1998-01-01'").select(
        "claim_id", "submitted_date", (size * F.lit(10_000_000_000)).alias("units"), F.trim("claim_type").alias("claim_type"),
        F.col("total_amount").alias("amount"),
    )
    few = claims.where("claim_id LIKE 'CLM-1-%'").select("claim_id", size.alias("units"), F.lit("seen").alias("note"))
    for rows in (first, later, few):
        tables.upsert_bucketed(lake.spark, path, rows, ["claim_id"], buckets=16, unique=True, evolve=True)
    return tables.read_table(lake.spark, path)


@query
def versioned_table_upsert(lake: Lake) -> DataFrame:
    target, source = _claim_versions(lake)
    path = scratch_path(lake.spark, "versions")
    for rows in (target, source):
        tables.upsert_table(lake.spark, path, rows, ["claim_id"], ["claim_status"])
    return tables.read_table(lake.spark, path)


@query
def copy_consistency(lake: Lake) -> DataFrame:
    base = scratch_path(lake.spark, "copies")
    patients = tables.checked_copy(lake.raw_patients, f"{base}/patients", "patients")
    return patients.unionByName(tables.checked_copy(lake.raw_claims, f"{base}/claims", "claims"))


@query
def copy_run_log(lake: Lake) -> DataFrame:
    base = scratch_path(lake.spark, "logged")
    at = datetime.fromisoformat(AS_OF)
    tables.logged_copy(lake.raw_patients, f"{base}/patients", f"{base}/log", "ehr_ingestion", "run-1", at)
    tables.logged_copy(lake.vitals, f"{base}/vitals", f"{base}/log", "vitals_ingestion", "run-2", at)
    return lake.spark.read.schema(tables.RUN_LOG).parquet(f"{base}/log").drop("run_time")


@query
def typed_landing(lake: Lake) -> DataFrame:
    path = scratch_path(lake.spark, "typed")
    types = {
        "record_id": "bigint", "patient_id": "string", "date_of_birth": "date", "admission_date": "date",
        "discharge_date": "date", "readmission_flag": "int", "attending_physician": "int",
    }
    tables.land(lake.raw_patients, path, types)
    return lake.spark.read.parquet(path)


@query
def partitioned_overwrite(lake: Lake) -> DataFrame:
    path = scratch_path(lake.spark, "partitioned")
    columns = ["claim_id", "total_amount", "claim_type", "claim_status"]
    tables.overwrite_table(lake.claims.select(*columns), path, ["claim_type", "claim_status"])
    return lake.spark.read.parquet(path)


@query
def clustered_rewrite(lake: Lake) -> DataFrame:
    path = scratch_path(lake.spark, "clustered")
    tables.publish_version(lake.claims.select("claim_id", "patient_id", "total_amount"), path)
    tables.cluster_table(lake.spark, path, ["claim_id", "patient_id"], files=8)
    return tables.read_table(lake.spark, path)


@query
def clustered_file_ranges(lake: Lake) -> DataFrame:
    """How many of the files a search for one value must open, on average, in each clustered column.

    Reported as whether both columns stay well below all files.
    """
    path, files = scratch_path(lake.spark, "clustered"), 16
    tables.publish_version(lake.claims.select("claim_id", "patient_id", "total_amount"), path)
    tables.cluster_table(lake.spark, path, ["claim_id", "patient_id"], files=files)
    rows = stage(tables.read_table(lake.spark, path).withColumn("file", F.col("_metadata.file_path")), "located")
    parts = []
    for column in ("claim_id", "patient_id"):
        ranges = rows.groupBy("file").agg(F.min(column).alias("low"), F.max(column).alias("high"))
        values = rows.select(column).distinct().join(F.broadcast(ranges), F.col(column).between(F.col("low"), F.col("high")))
        opened = values.groupBy(column).agg(F.count(F.lit(1)).alias("opened"))
        parts.append(
            opened.agg(
                F.lit(column).alias("column_name"), F.count(F.lit(1)).alias("distinct_values"),
                (F.avg("opened") < files / 2).alias("narrow"),
            )
        )
    return parts[0].unionByName(parts[1])


@query
def interleaved_file_ranges(lake: Lake) -> DataFrame:
    """Files that a search for one value opens, per clustered column: at most three times the square root of all."""
    path, files = scratch_path(lake.spark, "interleaved"), 64
    claims = lake.claims.select("claim_id", "patient_id", "total_amount")
    tables.publish_version(claims, path)
    clustering.cluster_interleaved(lake.spark, path, ["claim_id", "patient_id"], files)
    parts = []
    for column in ("claim_id", "patient_id"):
        values = tables.read_table(lake.spark, path).select(F.col(column).alias("value")).distinct()
        opened = clustering.files_opened(lake.spark, path, column, values)
        parts.append(opened.select("column_name", (F.col("opened") <= 3 * F.sqrt("files")).alias("narrow"), (F.col("files") > 1).alias("cut")))
    return parts[0].unionByName(parts[1])


@query
def copy_mismatches(lake: Lake) -> DataFrame:
    """Two copies of the raw patients, one with a changed, a missing and a repeated row: what the checksum tree names."""
    one = stage(lake.raw_patients.drop("total_amount"), "copy-one")
    key = F.col("record_id")
    changed = one.withColumn("ward", F.when(key % 1009 == 3, "moved").otherwise(F.col("ward"))).where(key % 1013 != 5)
    two = stage(changed.unionByName(changed.where(key % 1019 == 7)), "copy-two")
    rows = checksums.differing_rows(one, two, ["record_id"])
    return rows.select("record_id", "ward", "side", "copies")


@query
def copy_mismatch_levels(lake: Lake) -> DataFrame:
    """One changed row among all: one differing node on every level, each with a sixteenth of the range above."""
    one = stage(lake.raw_patients, "copy-one")
    changed = one.select(F.min("record_id").alias("changed"))
    two = one.join(F.broadcast(changed)).withColumn("ward", F.when(F.col("record_id") == F.col("changed"), "moved").otherwise(F.col("ward")))
    path = checksums.mismatch_path(one, two.drop("changed"), ["record_id"])
    return path.groupBy("level").agg(
        F.count(F.lit(1)).alias("nodes"), F.max(F.col("rows") == F.col("other_rows")).alias("as_many"),
        F.round(F.log2(F.max(F.col("last_hash").cast("decimal(20,0)") - F.col("first_hash") + 1).cast("double"))).cast("int").alias("bits"),
    )


@query
def vitals_compacted_windows(lake: Lake) -> DataFrame:
    """The stream's window files, written small, packed per closed hour and read through the pointer."""
    base = scratch_path(lake.spark, "compacted")
    windows = streams.vitals_windows(lake.vitals)
    placed = windows.withColumns({c: F.date_format("window_end_time", f) for c, f in (("date", "yyyy-MM-dd"), ("hour", "HH"))})
    for part in (0, 1):  # two batches, so that every hour has small files of both
        half = placed.where(F.pmod(F.xxhash64("patient_id", "window_end_time"), F.lit(2)) == part)
        half.repartition(4).write.mode("append").partitionBy("date", "hour").parquet(base)
        compaction.compact_hours(lake.spark, base, compaction.Hour("2024-01-03", "00"))
    compaction.sweep(lake.spark, base)
    rows = compaction.read_compacted(lake.spark, base)
    return rows.withColumn("window_end_time", F.col("window_end_time").cast("timestamp_ntz"))


@query
def layered_jobs_dashboard(lake: Lake) -> DataFrame:
    """Landed raw Parquet, both jobs, and the dashboard over the written gold tables."""
    base = _ran_layers(lake)
    serving.register_views(serving.register_gold(lake.spark, f"{base}/gold"))
    return lake.spark.table(serving.VIEWS[0])


def _ran_layers(lake: Lake) -> str:
    """Both jobs over the raw tables as they are: repeated keys, malformed dates and the word NULL.

    A layer is deleted once the next one is written from it.
    """
    base, day = scratch_path(lake.spark, "layers"), run_date_folder(RUN_DATE)
    tables.overwrite_table(lake.raw_patients, f"{base}/bronze/patients/{day}")
    tables.overwrite_table(lake.raw_claims, f"{base}/bronze/claims/{day}")
    jobs.bronze_to_silver(
        lake.spark, f"{base}/bronze", f"{base}/silver", RUN_DATE, AS_OF, fmt="parquet", buckets=16,
        ties={"patients": PATIENT_TIES, "claims": [F.desc_nulls_last("total_amount"), "record_id"]},
        schemas={
            "patients": StructType([*BRONZE_PATIENTS.fields, StructField("record_id", LongType())]),
            "claims": StructType([*BRONZE_CLAIMS.fields, StructField("record_id", StringType())]),
        },
    )
    delete_path(lake.spark, f"{base}/bronze")
    jobs.silver_to_gold(lake.spark, f"{base}/silver", f"{base}/gold", RUN_DATE, AS_OF)
    delete_path(lake.spark, f"{base}/silver")
    return base


# Streaming ----------------------------------------------------------------------------


@query
def vitals_tumbling(lake: Lake) -> DataFrame:
    return streams.vitals_windows(lake.vitals)


@query
def vitals_hourly_by_ward(lake: Lake) -> DataFrame:
    return streams.vitals_windows(lake.vitals, "1 hour", ("ward_id",))


@query
def vitals_right_closed(lake: Lake) -> DataFrame:
    return streams.vitals_windows(lake.vitals, closed="right")


@query
def vitals_alerts(lake: Lake) -> DataFrame:
    return streams.vitals_alerts(lake.vitals)


def _vitals_stream(lake: Lake) -> DataFrame:
    layout = retail.table(lake.spark, lake.folder, "events").schema
    session = streaming_session(lake.spark)
    events = streams.read_vitals_files(session, retail.stream_path(lake.folder, "events"), layout, "parquet")
    return retail.vitals_of(events).withColumn("event_time", F.col("event_time").cast("timestamp"))


def _streamed_windows(lake: Lake, closed: str) -> DataFrame:
    """Both stream queries over one source, to their end; all window files are returned."""
    base = scratch_path(lake.spark, "stream")
    source = _vitals_stream(lake)
    running = streams.start_vitals(
        source, f"{base}/windows", f"{base}/alerts", f"{base}/checkpoints", once=True, closed=closed
    )
    for each in running:
        each.awaitTermination()
    events = lake.vitals.withColumn("event_time", F.col("event_time").cast("timestamp"))
    streams.write_open_windows(events, running[0], f"{base}/open", closed=closed)
    windows = lake.spark.read.parquet(f"{base}/windows").unionByName(lake.spark.read.parquet(f"{base}/open"))
    return windows.withColumns(
        {
            "window_end_time": F.col("window_end_time").cast("timestamp_ntz"),
            "date": F.col("date").cast("string"),
            "hour": F.col("hour").cast("int"),
        }
    )


@query
def vitals_windows_stream(lake: Lake) -> DataFrame:
    return _streamed_windows(lake, "left")


@query
def vitals_windows_stream_right_closed(lake: Lake) -> DataFrame:
    return _streamed_windows(lake, "right")


@query
def alert_messages(lake: Lake) -> DataFrame:
    """Alerts as keyed messages for a topic, read back from their JSON."""
    value = F.from_json("value", "heart_rate int, spo2 double, alert_type string, device_id string, event_time timestamp")
    sent = streams.as_messages(streams.vitals_alerts(lake.vitals.withColumn("event_time", F.col("event_time").cast("timestamp"))))
    back = sent.select("key", value.alias("v")).select("key", "v.*")
    return back.withColumn("event_time", F.col("event_time").cast("timestamp_ntz"))


@query
def rejected_messages(lake: Lake) -> DataFrame:
    """Event messages of which some are cut short, some lack the time, some are missing."""
    key = F.col("event_id")
    timed = F.when(key % 7 != 1, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    whole = F.to_json(F.struct(F.concat(F.lit("P-"), "user_id").alias("patient_id"), timed.alias("event_time")))
    cut = F.when(key % 5 == 1, whole.substr(F.lit(1), F.length(whole) - 1)).when(key % 11 != 1, whole)
    messages = retail.table(lake.spark, lake.folder, "events").select("event_id", cut.alias("value"))
    return streams.rejected_messages(messages, "value").select("event_id", "reason")


def _fanned_out(lake: Lake) -> fanout.Sinks:
    """The readings as JSON messages in three deliveries, a micro-batch each, some cut short.

    The last delivery holds readings of the whole time, which come after their windows are closed.
    """
    base, key = scratch_path(lake.spark, "fan-out"), F.col("event_id")
    events = retail.table(lake.spark, lake.folder, "events")
    stamp = F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    rows = retail.vitals_of(events, "event_id", "ts").withColumn("event_time", stamp)
    whole = F.to_json(F.struct(*VITALS_EVENT.names))
    cut = F.when(key % 50 == 1, whole.substr(F.lit(1), F.length(whole) - 1)).otherwise(whole)
    turn = F.when(key % 5 == 0, 2).when(F.col("ts") >= "2024-01-16", 1).otherwise(0)
    messages = stage(rows.select(cut.alias("value"), turn.alias("turn")), "fan-out-messages")
    sinks = fanout.Sinks(f"{base}/out", buckets=8)
    session = streaming_session(lake.spark)
    for turn in range(3):
        messages.where(F.col("turn") == turn).select("value").write.mode("append").text(f"{base}/in")
        source = session.readStream.schema("value string").text(f"{base}/in")
        fanout.start_fan_out(source, sinks, f"{base}/checkpoint", once=True).awaitTermination()
    return sinks


@query
def vitals_corrected_windows(lake: Lake) -> DataFrame:
    """Closed windows, corrected by late readings, and those still open."""
    sinks = _fanned_out(lake)
    windows = fanout.read_sink(lake.spark, sinks, fanout.CLOSED).unionByName(fanout.open_windows(lake.spark, sinks))
    return windows.withColumn("window_end_time", F.col("window_end_time").cast("timestamp_ntz"))


@query
def vitals_fan_out_sinks(lake: Lake) -> DataFrame:
    """Rows of each sink that the one read of the messages has filled, per micro-batch."""
    sinks = _fanned_out(lake)
    parts = [
        fanout.read_sink(lake.spark, sinks, sink).groupBy(F.lit(sink).alias("sink"), fanout.BATCH).agg(F.count(F.lit(1)).alias("rows"))
        for sink in (fanout.ALERTS, fanout.REJECTS, fanout.LATE)
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).withColumn(fanout.BATCH, F.col(fanout.BATCH).cast("int"))


@query
def vitals_alerts_stream(lake: Lake) -> DataFrame:
    base = scratch_path(lake.spark, "stream")
    alerting = streams.vitals_alerts(_vitals_stream(lake))
    streams.start_alert_files(alerting, f"{base}/alerts", f"{base}/checkpoint", once=True).awaitTermination()
    alerts = lake.spark.read.parquet(f"{base}/alerts")
    return alerts.withColumn("event_time", F.col("event_time").cast("timestamp_ntz"))


# Model --------------------------------------------------------------------------------


@query
def ml_features(lake: Lake) -> DataFrame:
    return lake.features


@query
def label_distribution(lake: Lake) -> DataFrame:
    return readmission.label_distribution(lake.features)


@query
def category_index(lake: Lake) -> DataFrame:
    return readmission.category_index(stage(lake.features, "features"))


@query
def scaler_summary(lake: Lake) -> DataFrame:
    found = readmission.scaler_summary(stage(lake.features, "features"))
    return found.select("feature", F.round("mean", 6).alias("mean"), F.round("deviation", 6).alias("deviation"))


@query
def train_test_split(lake: Lake) -> DataFrame:
    """Both sides of the split: rows, keys found on both, and whether the training side is near its share."""
    features = stage(lake.features, "features")
    training, testing = readmission.split(features)
    key = list(readmission.ROW_KEY)
    shared = training.select(*key).distinct().intersect(testing.select(*key).distinct())
    sizes = training.select(F.lit(1).alias("train")).unionByName(testing.select(F.lit(0).alias("train")))
    share = F.avg("train") * 100
    near = F.abs(share - readmission.TRAIN_PERCENT) < 5
    return sizes.agg(F.count(F.lit(1)).alias("rows"), near.alias("near")).join(shared.agg(F.count(F.lit(1)).alias("on_both")))


@query
def feature_vector_slots(lake: Lake) -> DataFrame:
    """Every slot of the assembled feature vectors by name: rows in which it is set, and the sum of its values."""
    return readmission.vector_slots(stage(lake.features, "features"))


@query
def rank_metrics(lake: Lake) -> DataFrame:
    """How well the rule-based risk score ranks readmitted patients."""
    return ranking.rank_metrics(lake.dim, "readmission_flag", "risk_score")


@query
def risk_band_distribution(lake: Lake) -> DataFrame:
    scored = lake.dim.select(rules.risk_band(F.col("risk_score") / 100).alias("risk_band"))
    return readmission.risk_band_distribution(scored)


@query
def readmission_predictions(lake: Lake) -> DataFrame:
    features = stage(lake.features, "features")
    return readmission.score(readmission.train(features).model, features, AS_OF)


@query
def readmission_model_report(lake: Lake) -> DataFrame:
    features = stage(lake.features, "features")
    trained = readmission.train(features)
    weights = readmission.feature_importances(trained.model, features).select(
        F.lit("importance").alias("kind"), F.col("feature").alias("name"), F.col("importance").alias("value")
    )
    run = readmission.metrics_table(lake.spark, trained, "run-1", AS_OF)
    return run.where("kind = 'metric'").select("kind", "name", "value").unionByName(weights)


def _scored(lake: Lake) -> str:
    """The scoring job over the gold tables, with a small grid."""
    base = _ran_layers(lake)
    jobs.score_readmissions(
        lake.spark, f"{base}/gold", f"{base}/model", "run-1", AS_OF, grid_trees=(10,), grid_depth=(4,), folds=2
    )
    return f"{base}/gold"


@query
def ml_predictions_table(lake: Lake) -> DataFrame:
    """The stored predictions per label: rows, and of them those with a sound probability and its band."""
    scored = tables.read_table(lake.spark, f"{_scored(lake)}/{jobs.PREDICTIONS}")
    chance = F.col("readmission_probability")
    return scored.groupBy("label").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(chance.between(0, 1)).alias("sound"),
        F.count_if(F.col("risk_band") == rules.risk_band(chance)).alias("banded"),
        F.countDistinct("patient_id").alias("patients"),
    )


@query
def run_metrics_log(lake: Lake) -> DataFrame:
    """The logged run: its parameters and metrics, and the rows they were reckoned on."""
    log = lake.spark.read.parquet(f"{_scored(lake)}/{jobs.RUN_METRICS}")
    sizes = F.when(F.col("name").isin("train_size", "test_size"), F.col("text_value").cast("bigint"))
    return log.groupBy("run_id").agg(
        F.count_if(F.col("kind") == "param").alias("params"),
        F.count_if(F.col("kind") == "metric").alias("metrics"),
        F.sum(sizes).alias("rows"),
        F.count_if(F.col("value").between(0, 1)).alias("sound"),
    )
