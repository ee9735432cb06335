"""Bronze to silver. Keys and order columns first, then one row per key, then the rest:
everything derived is computed on the surviving rows only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakecare.functions import rules
from lakecare.functions.clock import AsOf
from lakecare.operators.dedupe import dedupe_latest
from lakecare.operators.quality import drop_null_keys

PATIENT_KEY, CLAIM_KEY = ["patient_id"], ["claim_id"]
CRITICAL_PATIENT_COLUMNS = ("patient_id", "date_of_birth", "admission_date")
PATIENT_NEWEST = ("last_modified_date",)
# Claims carry no modification date; a processed claim is newer than a pending one.
CLAIM_NEWEST = ("processed_date", "submitted_date")


def _parse(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: rules.parsed_date(F.col(c)) for c in columns})


def standardized_patients(raw: DataFrame, as_of: AsOf, age_mode: str = "elapsed") -> DataFrame:
    """Row-wise patient rules, without deduplication (admission grain)."""
    dated = _parse(
        drop_null_keys(raw, PATIENT_KEY),
        ("date_of_birth", "admission_date", "discharge_date", "last_modified_date"),
    )
    return _derive_patients(drop_null_keys(dated, ["admission_date"]), as_of, age_mode)


def _derive_patients(dated: DataFrame, as_of: AsOf, age_mode: str) -> DataFrame:
    years = rules.age(F.col("date_of_birth"), as_of, age_mode)
    return dated.withColumns(
        {
            "gender": rules.gender(F.col("gender")),
            "first_name": rules.masked(),
            "last_name": rules.masked(),
            "diagnosis_code": rules.normalized(F.col("diagnosis_code")),
            "hospital_id": rules.normalized(F.col("hospital_id")),
            "readmission_flag": F.col("readmission_flag").cast("boolean"),
            "age": years,
            "length_of_stay": F.datediff("discharge_date", "admission_date"),
            "age_group": rules.age_group(years),
        }
    )


def silver_patients(
    raw: DataFrame,
    as_of: AsOf,
    run_date: AsOf,
    tie_breakers: Sequence[str | Column] | None = None,
    age_mode: str = "elapsed",
) -> DataFrame:
    """One current row per patient."""
    dated = _parse(drop_null_keys(raw, PATIENT_KEY), ("admission_date", "last_modified_date"))
    latest = dedupe_latest(drop_null_keys(dated, ["admission_date"]), PATIENT_KEY, PATIENT_NEWEST, tie_breakers)
    derived = _derive_patients(_parse(latest, ("date_of_birth", "discharge_date")), as_of, age_mode)
    return derived.withColumns(rules.audit_columns(as_of, run_date))


def silver_claims(
    raw: DataFrame, as_of: AsOf, run_date: AsOf, tie_breakers: Sequence[str | Column] | None = None
) -> DataFrame:
    """One current row per claim."""
    dated = _parse(drop_null_keys(raw, [*CLAIM_KEY, "patient_id"]), CLAIM_NEWEST)
    latest = dedupe_latest(dated, CLAIM_KEY, CLAIM_NEWEST, tie_breakers)
    return _parse(latest, ("admission_date", "discharge_date")).withColumns(
        {
            "claim_status": rules.normalized(F.col("claim_status")),
            "claim_type": rules.normalized(F.col("claim_type")),
            "diagnosis_code": rules.normalized(F.col("diagnosis_code")),
            "coverage_ratio": rules.coverage_ratio(F.col("insurance_covered"), F.col("total_amount")),
            "processing_days": F.datediff("processed_date", "submitted_date"),
            "high_value_flag": rules.high_value(F.col("total_amount")),
            **rules.audit_columns(as_of, run_date),
        }
    )
