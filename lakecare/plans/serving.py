"""Serving layer: typed gold tables, four views and the reports built on them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakecare.functions.clock import AsOf, as_of_date, as_of_timestamp
from lakecare.functions.exact import exact_avg, exact_millions, exact_sum, share_pct
from lakecare.operators.dedupe import dedupe_latest
from lakecare.operators.sequence import number_in_order
from lakecare.schemas import GOLD, GOLD_PARTITIONS
from lakecare.sinks.tables import current_path
from lakecare.sources.batch import bind_by_name

# External table suffix, view names, report parameters.
EXTERNAL_SUFFIX = "_ext"
VIEWS = (
    "vw_hospital_monthly_dashboard",
    "vw_patient_risk_summary",
    "vw_diagnosis_analytics",
    "vw_insurance_analysis",
)
FOLLOWUP_DAYS, FOLLOWUP_CATEGORIES = 30, ("High Risk",)
TOP_DIAGNOSES = 10
READMISSION_WINDOW_DAYS = 30
STATUS_COLUMNS = {"APPROVED": "approved_claims", "DENIED": "denied_claims", "PENDING": "pending_claims"}

_METRIC_ROLLUP = (
    ("total_billed", "total_revenue_inr", 0),
    ("total_covered", "insurance_covered_inr", 0),
    ("total_copay", "patient_copay_inr", 0),
    ("claim_count", "claim_count", None),
    ("high_value_claims", "high_value_claims", None),
    ("avg_coverage_pct", "avg_coverage_pct", 1),
    ("avg_processing_days", "avg_claim_processing_days", 1),
)


def external_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """A gold table over its files, with the declared column names and types; a missing column raises."""
    files = spark.read.parquet(current_path(spark, f"{base}/{name}"))
    missing = set(GOLD[name].names) - set(files.columns)
    if missing:
        raise ValueError(f"{name} lacks {', '.join(sorted(missing))}")
    return bind_by_name(files, GOLD[name])


def register_gold(spark: SparkSession, base: str) -> dict[str, DataFrame]:
    """(Re)create one view per gold table; an older view of that name is dropped first."""
    tables = {}
    for name in GOLD:
        spark.catalog.dropTempView(name + EXTERNAL_SUFFIX)
        tables[name] = external_table(spark, base, name)
        tables[name].createOrReplaceTempView(name + EXTERNAL_SUFFIX)
    return tables


def create_gold_tables(
    spark: SparkSession, base: str, database: str = "gold", names: Sequence[str] = tuple(GOLD)
) -> list[str]:
    """Catalog tables over the gold files, with declared types; dropping one leaves its files alone."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{base}'")
    made = []
    for name in names:
        full = f"{database}.{name}{EXTERNAL_SUFFIX}"
        spark.sql(f"DROP TABLE IF EXISTS {full}")
        path = current_path(spark, f"{base}/{name}")
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in GOLD[name].fields)
        partitions = GOLD_PARTITIONS.get(name, ())
        parted = f"PARTITIONED BY ({', '.join(partitions)})" if partitions else ""
        spark.sql(f"CREATE TABLE {full} ({columns}) USING parquet {parted} LOCATION '{path}'")
        if partitions:
            spark.catalog.recoverPartitions(full)
        made.append(full)
    return made


def register_views(gold: Mapping[str, DataFrame]) -> None:
    """The four serving views, for use from SQL."""
    frames = (
        hospital_monthly_dashboard(gold["agg_hospital_metrics"], gold["agg_financial_summary"]),
        patient_risk_summary(gold["dim_patient"], gold["fact_admissions"]),
        diagnosis_analytics(gold["fact_admissions"], gold["dim_patient"]),
        insurance_analysis(gold["agg_financial_summary"]),
    )
    for name, frame in zip(VIEWS, frames):
        frame.createOrReplaceTempView(name)


def _month_start(year: Column, month: Column) -> Column:
    return F.make_date(year, month, F.lit(1))


def _dashboard(metrics: DataFrame, money: DataFrame, on: list[str]) -> DataFrame:
    rolled = [
        (F.col(source) if digits is None else F.round(source, digits)).alias(shown)
        for source, shown, digits in _METRIC_ROLLUP
    ]
    return metrics.join(money, on, "left").select(
        "hospital_id",
        "admission_year",
        "admission_month",
        _month_start(F.col("admission_year"), F.col("admission_month")).alias("period_start"),
        "total_admissions",
        "unique_patients",
        F.round("avg_length_of_stay", 1).alias("avg_los_days"),
        "readmission_count",
        F.round("readmission_rate_pct", 2).alias("readmission_rate_pct"),
        "active_physicians",
        "unique_diagnoses",
        *rolled,
    )


def hospital_monthly_dashboard(metrics: DataFrame, financial: DataFrame) -> DataFrame:
    """Monthly metrics beside the hospital's all-time claim totals, repeated every month."""
    money = financial.groupBy("hospital_id").agg(
        *[exact_sum(F.col(c)).alias(c) for c in ("total_billed", "total_covered", "total_copay")],
        *[F.sum(c).alias(c) for c in ("claim_count", "high_value_claims")],
        exact_avg(F.col("avg_coverage_pct"), 2).alias("avg_coverage_pct"),
        exact_avg(F.col("avg_processing_days"), 1).alias("avg_processing_days"),
    )
    return _dashboard(metrics, money, ["hospital_id"])


def hospital_monthly_dashboard_by_period(metrics: DataFrame, by_period: DataFrame) -> DataFrame:
    """The same with the claim totals of that month only."""
    return _dashboard(metrics, by_period, ["hospital_id", "admission_year", "admission_month"])


def patient_risk_summary(dim: DataFrame, fact: DataFrame) -> DataFrame:
    """Each patient with the newest admission row; ties go to the lowest claim id."""
    details = ("admission_date", "discharge_date", "length_of_stay", "attending_physician", "total_amount", "claim_status")
    latest = dedupe_latest(
        fact.select("patient_id", "claim_id", *details), ["patient_id"], ["admission_date"], ["claim_id"]
    ).drop("claim_id")
    person = [c for c in GOLD["dim_patient"].names if c not in ("date_of_birth", "_processed_at")]
    return dim.select(*person).join(latest, "patient_id", "left")


def diagnosis_analytics(fact: DataFrame, dim: DataFrame) -> DataFrame:
    """Figures per diagnosis, description and ward.

    Every fact row of a code meets each description of that code once, so the figures of
    (code, ward) are the figures of (code, description, ward): aggregate first, join the
    small result afterwards.
    """
    amount = F.coalesce("total_amount", F.lit(0.0))
    figures = fact.groupBy("diagnosis_code", "ward").agg(
        F.count_distinct("patient_id").alias("patient_count"),
        F.round(F.avg("length_of_stay"), 1).alias("avg_los"),
        F.round(F.avg("age"), 1).alias("avg_patient_age"),
        F.count_if(F.col("readmission_flag")).alias("readmissions"),
        share_pct(F.count_if(F.col("readmission_flag")), F.count("patient_id"), 1).alias("readmission_rate_pct"),
        exact_sum(amount, 2, 0).alias("total_revenue"),
        exact_avg(amount, 2, 0).alias("avg_claim_amount"),
    )
    names = dim.select("diagnosis_code", "diagnosis_description").distinct()
    return figures.join(names, "diagnosis_code", "left")


def insurance_analysis(financial: DataFrame) -> DataFrame:
    """Claim outcomes per insurer and claim type."""
    by_status = [
        F.coalesce(F.sum(F.when(F.col("claim_status") == status, F.col("claim_count"))), F.lit(0)).alias(column)
        for status, column in STATUS_COLUMNS.items()
    ]
    return (
        financial.groupBy("insurance_provider", "claim_type")
        .agg(
            F.sum("claim_count").alias("total_claims"),
            *by_status,
            *[exact_sum(F.col(c), 2, 0).alias(c) for c in ("total_billed", "total_covered", "total_copay")],
            exact_avg(F.col("avg_processing_days"), 1, 1).alias("avg_processing_days"),
            F.sum("high_value_claims").alias("high_value_claims"),
        )
        .withColumn("approval_rate_pct", share_pct(F.col("approved_claims"), F.nullif("total_claims", F.lit(0)), 1))
    )


# Reports -----------------------------------------------------------------------------


def hospital_overview(dashboard: DataFrame, as_of: AsOf) -> DataFrame:
    """Year-to-date figures per hospital."""
    return (
        dashboard.where(F.col("admission_year") == F.year(as_of_date(as_of)))
        .groupBy("hospital_id")
        .agg(
            F.sum("total_admissions").alias("ytd_admissions"),
            exact_avg(F.col("avg_los_days"), 1, 1).alias("avg_los"),
            exact_avg(F.col("readmission_rate_pct"), 2, 2).alias("avg_readmission_rate"),
            exact_millions(F.col("total_revenue_inr"), 0).alias("total_revenue_million_inr"),
            exact_avg(F.col("avg_coverage_pct"), 1, 1).alias("avg_insurance_coverage_pct"),
        )
        .orderBy(F.desc("ytd_admissions"), "hospital_id")
    )


def monthly_trend(dashboard: DataFrame) -> DataFrame:
    return (
        dashboard.groupBy("admission_year", "admission_month")
        .agg(
            F.sum("total_admissions").alias("total_admissions"),
            F.sum("readmission_count").alias("total_readmissions"),
            exact_avg(F.col("readmission_rate_pct"), 2, 2).alias("readmission_rate_pct"),
            exact_avg(F.col("avg_los_days"), 1, 1).alias("avg_los_days"),
        )
        .withColumn("month_start", _month_start(F.col("admission_year"), F.col("admission_month")))
        .orderBy("admission_year", "admission_month")
    )


def top_diagnoses(diagnoses: DataFrame, n: int = TOP_DIAGNOSES) -> DataFrame:
    """The ``n`` diagnoses with most patients; ties go by name."""
    return (
        diagnoses.orderBy(F.desc("patient_count"), "diagnosis_code", "diagnosis_description", "ward")
        .limit(n)
        .select(
            "diagnosis_code",
            "diagnosis_description",
            "patient_count",
            "avg_los",
            "avg_patient_age",
            "readmission_rate_pct",
            F.round(F.col("total_revenue") / F.lit(1e6), 2).alias("revenue_million_inr"),
        )
    )


def high_risk_followup(summary: DataFrame, as_of: AsOf, days: int = FOLLOWUP_DAYS) -> DataFrame:
    """High-risk patients discharged since ``days`` before the as-of instant."""
    since = as_of_timestamp(as_of) - F.make_interval(days=F.lit(days))
    recent = F.col("risk_category").isin(*FOLLOWUP_CATEGORIES) & (F.col("discharge_date") >= since)
    return (
        summary.where(recent)
        .drop("insurance_provider", "readmission_flag", "total_amount", "claim_status")
        .orderBy(F.desc("risk_score"), "patient_id")
    )


def insurer_comparison(insurance: DataFrame) -> DataFrame:
    return (
        insurance.groupBy("insurance_provider")
        .agg(
            F.sum("total_claims").alias("total_claims"),
            F.sum("approved_claims").alias("approved"),
            F.sum("denied_claims").alias("denied"),
            F.sum("pending_claims").alias("pending"),
            exact_avg(F.col("approval_rate_pct"), 1, 1).alias("avg_approval_rate_pct"),
            exact_millions(F.col("total_billed"), 0).alias("total_billed_million"),
            exact_millions(F.col("total_covered"), 0).alias("total_covered_million"),
            exact_avg(F.col("avg_processing_days"), 1, 1).alias("avg_processing_days"),
            F.sum("high_value_claims").alias("high_value_claims"),
        )
        .orderBy(F.desc("total_claims"), "insurance_provider")
    )


def ward_efficiency(fact: DataFrame) -> DataFrame:
    return (
        fact.groupBy("ward")
        .agg(
            F.count_distinct("patient_id").alias("total_patients"),
            F.round(F.avg("length_of_stay"), 1).alias("avg_los"),
            F.count_if(F.col("readmission_flag")).alias("readmissions"),
            share_pct(F.count_if(F.col("readmission_flag")), F.count("patient_id"), 1).alias("readmission_rate_pct"),
            exact_avg(F.coalesce("total_amount", F.lit(0.0)), 2, 0).alias("avg_claim_per_patient"),
            F.count_distinct("attending_physician").alias("physician_count"),
        )
        .orderBy(F.desc("total_patients"), "ward")
    )


def visit_sequence(visits: DataFrame, tie_breakers: list[str], threshold: int | None = None) -> DataFrame:
    """Readmitted visits numbered per patient, with the date of the next one."""
    flagged = visits.where("readmission_flag")
    return number_in_order(
        flagged,
        ["patient_id"],
        ["admission_date", *tie_breakers],
        successors={"admission_date": "next_admission_date"},
        threshold=threshold,
    )


def readmission_root_cause(
    visits: DataFrame, tie_breakers: list[str], within_days: int = READMISSION_WINDOW_DAYS, threshold: int | None = None
) -> DataFrame:
    """Visits followed by another one of the same patient within the window.

    The next visit comes from one ordered pass instead of a self-join. The average gap is
    cut to whole days, as an integer average in the warehouse is.
    """
    needed = ["patient_id", "admission_date", "diagnosis_code", "ward", "length_of_stay", "total_amount", "readmission_flag"]
    ordered = visit_sequence(visits.select(*dict.fromkeys([*needed, *tie_breakers])), tie_breakers, threshold)
    gap = F.datediff("next_admission_date", "admission_date")
    return (
        ordered.where(gap <= within_days)
        .groupBy("diagnosis_code", "ward")
        .agg(
            F.count(F.lit(1)).alias("readmission_count"),
            F.round(F.avg("length_of_stay"), 1).alias("avg_initial_los"),
            exact_avg(F.col("total_amount"), 2, 0).alias("avg_initial_cost"),
            F.floor(F.avg(gap)).cast("double").alias("avg_days_to_readmission"),
        )
        .orderBy(F.desc("readmission_count"), "diagnosis_code", "ward")
    )
