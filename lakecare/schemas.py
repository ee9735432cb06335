"""Declared table layouts. File schemas are never inferred."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
}


def _layout(columns: str) -> T.StructType:
    """``name type, ...`` as a schema, without needing a session."""
    pairs = (column.split() for column in columns.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# Column names and types of the raw, stream and serving tables.
BRONZE_PATIENTS = _layout(
    "patient_id string, first_name string, last_name string, date_of_birth string, gender string, "
    "diagnosis_code string, diagnosis_description string, admission_date string, discharge_date string, "
    "attending_physician string, hospital_id string, insurance_provider string, insurance_id string, "
    "ward string, readmission_flag int, last_modified_date string"
)
BRONZE_CLAIMS = _layout(
    "claim_id string, patient_id string, hospital_id string, admission_date string, discharge_date string, "
    "diagnosis_code string, procedure_code string, procedure_description string, total_amount double, "
    "insurance_covered double, patient_copay double, claim_status string, submitted_date string, "
    "processed_date string, insurance_provider string, claim_type string"
)
VITALS_EVENT = _layout(
    "patient_id string, device_id string, ward_id string, hospital_id string, event_time timestamp, "
    "heart_rate int, blood_pressure_systolic int, blood_pressure_diastolic int, spo2 double, "
    "temperature double, respiratory_rate int, glucose_level int"
)
# The relational extract carries only these patient columns.
EXTRACT_COLUMNS = (
    "patient_id", "first_name", "last_name", "date_of_birth", "gender", "diagnosis_code",
    "admission_date", "discharge_date", "attending_physician", "hospital_id",
    "insurance_provider", "last_modified_date",
)
# Counts are BIGINT: a monthly count over a third of a 100 TB table does not fit INT.
GOLD = {
    "dim_patient": _layout(
        "patient_id string, gender string, date_of_birth date, age int, age_group string, hospital_id string, "
        "ward string, insurance_provider string, diagnosis_code string, diagnosis_description string, "
        "risk_score double, risk_category string, readmission_flag boolean, _processed_at timestamp"
    ),
    "fact_admissions": _layout(
        "patient_id string, hospital_id string, admission_date date, discharge_date date, length_of_stay int, "
        "diagnosis_code string, ward string, attending_physician string, age int, age_group string, "
        "readmission_flag boolean, claim_id string, total_amount double, insurance_covered double, "
        "patient_copay double, claim_status string, claim_type string, coverage_ratio double, "
        "admission_year int, admission_month int, admission_quarter int"
    ),
    "agg_hospital_metrics": _layout(
        "hospital_id string, admission_year int, admission_month int, total_admissions bigint, "
        "unique_patients bigint, avg_length_of_stay double, max_length_of_stay int, readmission_count bigint, "
        "readmission_rate_pct double, unique_diagnoses bigint, active_physicians bigint, "
        "_processed_at timestamp, _run_date date"
    ),
    "agg_financial_summary": _layout(
        "hospital_id string, insurance_provider string, claim_type string, claim_status string, "
        "claim_count bigint, total_billed double, total_covered double, total_copay double, "
        "avg_claim_amount double, avg_coverage_pct double, avg_processing_days double, "
        "high_value_claims bigint, _processed_at timestamp, _run_date date"
    ),
}
# Partition columns of the stored gold tables.
GOLD_PARTITIONS = {"fact_admissions": ("admission_year", "admission_month")}
