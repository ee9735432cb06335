"""SQL counterparts of the registered queries, for an independent engine.

Written against the raw test tables. Roundings of averages use whole numbers, so both
engines round the same exact fraction half up.
"""

from __future__ import annotations

import re

AS_OF_DATE, AS_OF_TS = "DATE '2001-08-01'", "TIMESTAMP '2001-08-01 00:00:00'"


def rounded(num: str, den: str, digits: int) -> str:
    """``num / den`` of whole, non-negative numbers, rounded half up to ``digits``."""
    unit = 10**digits
    n, d = f"CAST({num} AS HUGEINT)", f"CAST({den} AS HUGEINT)"
    return f"(CAST((2 * {unit} * {n} + {d}) // nullif(2 * {d}, 0) AS DOUBLE) / {unit})"


def units(value: str, scale: int) -> str:
    """A double with ``scale`` decimals as a whole number of its smallest units."""
    return f"CAST(round({value} * {10**scale}) AS HUGEINT)"


def avg_of(value: str, scale: int, digits: int) -> str:
    return rounded(f"sum({units(value, scale)})", f"count({value}) * {10**scale}", digits)


CODE = (
    "CASE WHEN c_custkey % 11 = 0 THEN lower(c_mktsegment) ELSE "
    "' ' || lower(left(c_mktsegment, 1)) || lpad(CAST(c_nationkey AS VARCHAR), 2, '0') || '.' || (c_custkey % 3) || ' ' END"
)
EMPTY_CLAIM = "l_linenumber = 7 AND l_quantity = 1"
PRICE = "CAST(l_extendedprice AS DECIMAL(12,2)) * 10"
SHARE = "CAST(l_discount AS DECIMAL(4,2))"


def _money(amount: str) -> str:
    return f"CASE WHEN {EMPTY_CLAIM} THEN 0.0::DOUBLE ELSE CAST(CAST({amount} AS DECIMAL(18,4)) AS DOUBLE) END"


CTES: dict[str, str] = {
    "raw_patients": f"""
        SELECT 'P-' || c_custkey AS patient_id, 'First ' || c_custkey AS first_name, c_name AS last_name,
               CASE WHEN c_custkey % 251 = 0 THEN 'unknown'
                    ELSE CAST(DATE '1910-01-01' + CAST((c_custkey * 37) % 33000 AS INTEGER) AS VARCHAR) END AS date_of_birth,
               CASE WHEN c_custkey % 17 = 0 THEN NULL
                    ELSE ([' m', 'FEMALE', 'F ', 'male', 'x'])[1 + c_custkey % 5] END AS gender,
               {CODE} AS diagnosis_code, c_mktsegment || ' condition ' || (c_custkey % 2) AS diagnosis_description,
               CASE WHEN o_orderkey % 997 = 5 THEN 'not-a-date' ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS admission_date,
               CASE WHEN o_orderkey % 53 <> 7
                    THEN CAST(CAST(o_orderdate AS DATE) + CAST(o_orderkey % 21 AS INTEGER) AS VARCHAR) END AS discharge_date,
               'Dr. ' || (o_orderkey % 97) AS attending_physician, ' hosp-' || c_nationkey || ' ' AS hospital_id,
               'Insurer ' || (c_custkey % 8) AS insurance_provider, 'INS-' || c_custkey AS insurance_id,
               o_orderpriority AS ward, CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 0 END AS readmission_flag,
               CAST(CAST(o_orderdate AS DATE) + CAST(o_orderkey % 30 AS INTEGER) AS VARCHAR) AS last_modified_date,
               o_totalprice AS total_amount, o_orderkey AS record_id
        FROM orders JOIN customer ON o_custkey = c_custkey""",
    "raw_claims": f"""
        SELECT 'CLM-' || l_orderkey || '-' || l_linenumber AS claim_id, 'P-' || o_custkey AS patient_id,
               'HOSP-' || c_nationkey AS hospital_id, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS admission_date,
               CAST(CAST(o_orderdate AS DATE) + CAST(l_orderkey % 21 AS INTEGER) AS VARCHAR) AS discharge_date,
               {CODE} AS diagnosis_code, 'PX-' || p_size AS procedure_code, p_type AS procedure_description,
               {_money(PRICE)} AS total_amount, {_money(f'{PRICE} * (1 - {SHARE})')} AS insurance_covered,
               {_money(f'{PRICE} * {SHARE}')} AS patient_copay,
               CASE l_returnflag WHEN 'A' THEN ' approved' WHEN 'R' THEN 'Denied ' ELSE 'PENDING' END AS claim_status,
               CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS submitted_date,
               CASE l_returnflag WHEN 'N' THEN 'NULL'
                    ELSE CAST(CAST(l_shipdate AS DATE) + CAST(l_quantity AS INTEGER) % 15 AS VARCHAR) END AS processed_date,
               p_brand AS insurance_provider, CASE l_linestatus WHEN 'F' THEN 'inpatient ' ELSE 'Outpatient' END AS claim_type,
               l_partkey || ':' || l_suppkey || ':' || CAST(l_quantity AS INTEGER) AS record_id
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
             JOIN part ON l_partkey = p_partkey""",
    "vitals": """
        SELECT 'P-' || user_id AS patient_id, 'DEV-' || (event_id % 20) AS device_id, event_type AS ward_id,
               'HOSP-' || (user_id % 25) AS hospital_id, ts AS event_time,
               CASE WHEN event_id % 37 <> 0 THEN CAST(35 + event_id % 130 AS INTEGER) END AS heart_rate,
               CAST(90 + event_id % 100 AS INTEGER) AS blood_pressure_systolic,
               CAST(55 + event_id % 50 AS INTEGER) AS blood_pressure_diastolic,
               CASE WHEN event_id % 41 <> 0 THEN CAST(85 + event_id % 16 AS DOUBLE) END AS spo2,
               36 + (event_id % 10) / 2 AS temperature, CAST(10 + event_id % 20 AS INTEGER) AS respiratory_rate,
               CAST(70 + event_id % 120 AS INTEGER) AS glucose_level
        FROM events""",
    "admissions": f"""
        SELECT * REPLACE ('***' AS first_name, '***' AS last_name, upper(trim(diagnosis_code)) AS diagnosis_code,
                          upper(trim(hospital_id)) AS hospital_id, CAST(readmission_flag AS BOOLEAN) AS readmission_flag,
                          CASE WHEN upper(trim(gender)) IN ('M', 'MALE') THEN 'Male'
                               WHEN upper(trim(gender)) IN ('F', 'FEMALE') THEN 'Female' ELSE 'Unknown' END AS gender),
               CASE WHEN age < 18 THEN 'Pediatric' WHEN age < 40 THEN 'Young Adult' WHEN age < 60 THEN 'Middle Aged'
                    WHEN age < 80 THEN 'Senior' ELSE 'Elderly' END AS age_group
        FROM (SELECT *, CAST(floor(({AS_OF_DATE} - date_of_birth) / 365.25) AS INTEGER) AS age,
                     CAST(discharge_date - admission_date AS INTEGER) AS length_of_stay
              FROM (SELECT * REPLACE (TRY_CAST(date_of_birth AS DATE) AS date_of_birth,
                                      TRY_CAST(admission_date AS DATE) AS admission_date,
                                      TRY_CAST(discharge_date AS DATE) AS discharge_date,
                                      TRY_CAST(last_modified_date AS DATE) AS last_modified_date)
                    FROM raw_patients))
        WHERE admission_date IS NOT NULL AND patient_id IS NOT NULL""",
    "patients": f"""
        SELECT *, 'bronze' AS _source_layer, 'silver' AS _target_layer, {AS_OF_TS} AS _processed_at,
               '2001-08-01' AS _run_date, TRUE AS _is_current
        FROM admissions
        QUALIFY row_number() OVER (PARTITION BY patient_id ORDER BY last_modified_date DESC NULLS LAST, record_id) = 1""",
    "claims": f"""
        SELECT *, CASE WHEN total_amount = 0 THEN 0.0::DOUBLE ELSE round(insurance_covered / total_amount, 4) END AS coverage_ratio,
               CAST(processed_date - submitted_date AS INTEGER) AS processing_days,
               coalesce(total_amount > 500000, FALSE) AS high_value_flag,
               'bronze' AS _source_layer, 'silver' AS _target_layer, {AS_OF_TS} AS _processed_at,
               '2001-08-01' AS _run_date, TRUE AS _is_current
        FROM (SELECT * REPLACE (TRY_CAST(admission_date AS DATE) AS admission_date, TRY_CAST(discharge_date AS DATE) AS discharge_date,
                                TRY_CAST(submitted_date AS DATE) AS submitted_date, TRY_CAST(processed_date AS DATE) AS processed_date,
                                upper(trim(claim_status)) AS claim_status, upper(trim(claim_type)) AS claim_type,
                                upper(trim(diagnosis_code)) AS diagnosis_code)
              FROM raw_claims)
        QUALIFY row_number() OVER (PARTITION BY claim_id ORDER BY processed_date DESC NULLS LAST, submitted_date DESC NULLS LAST,
                                   total_amount DESC NULLS LAST, record_id) = 1""",
    "scored": """
        SELECT *, CASE WHEN known IS NULL OR known > 100 THEN 100.0::DOUBLE ELSE known END AS risk_score,
               CASE WHEN known > 100 THEN 100.0::DOUBLE ELSE known END AS risk_score_known
        FROM (SELECT *, round(age * 0.3::DOUBLE + length_of_stay * 2.5::DOUBLE + CASE WHEN readmission_flag THEN 20 ELSE 0 END
                              + CASE age_group WHEN 'Elderly' THEN 10 WHEN 'Senior' THEN 5 ELSE 0 END, 1) AS known
              FROM admissions)""",
    "risk": """
        SELECT *, CASE WHEN risk_score >= 70 THEN 'High Risk' WHEN risk_score >= 40 THEN 'Medium Risk' ELSE 'Low Risk' END
               AS risk_category
        FROM scored""",
    "dim": f"""
        SELECT patient_id, gender, date_of_birth, age, age_group, hospital_id, ward, insurance_provider, diagnosis_code,
               diagnosis_description, risk_score, risk_category, readmission_flag, {AS_OF_TS} AS _processed_at
        FROM risk
        QUALIFY row_number() OVER (PARTITION BY patient_id ORDER BY last_modified_date DESC NULLS LAST, record_id) = 1""",
    "fact": """
        SELECT p.patient_id, p.hospital_id, p.admission_date, p.discharge_date, p.length_of_stay, p.diagnosis_code, p.ward,
               p.attending_physician, p.age, p.age_group, p.readmission_flag, c.claim_id, c.total_amount, c.insurance_covered,
               c.patient_copay, c.claim_status, c.claim_type, c.coverage_ratio,
               CAST(year(p.admission_date) AS INTEGER) AS admission_year, CAST(month(p.admission_date) AS INTEGER) AS admission_month,
               CAST(quarter(p.admission_date) AS INTEGER) AS admission_quarter
        FROM patients p LEFT JOIN claims c ON c.patient_id = p.patient_id""",
    "financial": f"""
        SELECT hospital_id, insurance_provider, claim_type, claim_status, __MONEY__,
               {AS_OF_TS} AS _processed_at, {AS_OF_DATE} AS _run_date
        FROM claims GROUP BY ALL""",
    "financial_month": """
        SELECT hospital_id, year(admission_date) AS admission_year, month(admission_date) AS admission_month, __MONEY__
        FROM claims GROUP BY ALL""",
    "rollup_money": f"""
        SELECT hospital_id, {rounded(f"sum({units('total_billed', 2)})", '100', 0)} AS total_revenue_inr,
               {rounded(f"sum({units('total_covered', 2)})", '100', 0)} AS insurance_covered_inr,
               {rounded(f"sum({units('total_copay', 2)})", '100', 0)} AS patient_copay_inr,
               CAST(sum(claim_count) AS BIGINT) AS claim_count, CAST(sum(high_value_claims) AS BIGINT) AS high_value_claims,
               {avg_of('avg_coverage_pct', 2, 1)} AS avg_coverage_pct,
               {avg_of('avg_processing_days', 1, 1)} AS avg_claim_processing_days
        FROM financial GROUP BY hospital_id""",
    "diagnoses": f"""
        SELECT f.diagnosis_code, d.diagnosis_description, f.ward, count(DISTINCT f.patient_id) AS patient_count,
               {rounded('sum(f.length_of_stay)', 'count(f.length_of_stay)', 1)} AS avg_los,
               {rounded('sum(f.age)', 'count(f.age)', 1)} AS avg_patient_age,
               count(*) FILTER (WHERE f.readmission_flag) AS readmissions,
               {rounded('100 * count(*) FILTER (WHERE f.readmission_flag)', 'count(f.patient_id)', 1)} AS readmission_rate_pct,
               {rounded(f"sum({units('coalesce(f.total_amount, 0)', 2)})", '100', 0)} AS total_revenue,
               {rounded(f"sum({units('coalesce(f.total_amount, 0)', 2)})", 'count(*) * 100', 0)} AS avg_claim_amount
        FROM fact f LEFT JOIN (SELECT DISTINCT diagnosis_code, diagnosis_description FROM dim) d
             ON d.diagnosis_code = f.diagnosis_code
        GROUP BY f.diagnosis_code, d.diagnosis_description, f.ward""",
    "insurance": f"""
        SELECT insurance_provider, claim_type, CAST(sum(claim_count) AS BIGINT) AS total_claims,
               CAST(coalesce(sum(claim_count) FILTER (WHERE claim_status = 'APPROVED'), 0) AS BIGINT) AS approved_claims,
               CAST(coalesce(sum(claim_count) FILTER (WHERE claim_status = 'DENIED'), 0) AS BIGINT) AS denied_claims,
               CAST(coalesce(sum(claim_count) FILTER (WHERE claim_status = 'PENDING'), 0) AS BIGINT) AS pending_claims,
               {rounded("100 * coalesce(sum(claim_count) FILTER (WHERE claim_status = 'APPROVED'), 0)", 'sum(claim_count)', 1)}
                   AS approval_rate_pct,
               {rounded(f"sum({units('total_billed', 2)})", '100', 0)} AS total_billed,
               {rounded(f"sum({units('total_covered', 2)})", '100', 0)} AS total_covered,
               {rounded(f"sum({units('total_copay', 2)})", '100', 0)} AS total_copay,
               {avg_of('avg_processing_days', 1, 1)} AS avg_processing_days,
               CAST(sum(high_value_claims) AS BIGINT) AS high_value_claims
        FROM financial GROUP BY insurance_provider, claim_type""",
    "person_risk": """
        SELECT d.patient_id, d.age, d.age_group, d.gender, d.hospital_id, d.ward, d.insurance_provider, d.diagnosis_code,
               d.diagnosis_description, d.risk_score, d.risk_category, d.readmission_flag, a.admission_date, a.discharge_date,
               a.length_of_stay, a.attending_physician, a.total_amount, a.claim_status
        FROM dim d LEFT JOIN (
             SELECT * FROM fact
             QUALIFY row_number() OVER (PARTITION BY patient_id ORDER BY admission_date DESC, claim_id) = 1) a
             ON a.patient_id = d.patient_id""",
    "versions": """
        SELECT claim_id, submitted_date, claim_status, total_amount, record_id,
               row_number() OVER (PARTITION BY claim_id ORDER BY submitted_date DESC, record_id) AS newest,
               row_number() OVER (PARTITION BY claim_id ORDER BY submitted_date, record_id DESC) AS oldest
        FROM raw_claims""",
    "first_versions": "SELECT * EXCLUDE (newest, oldest) FROM versions WHERE oldest = 1 AND submitted_date < '1999-06-01'",
    "last_versions": "SELECT * EXCLUDE (newest, oldest) FROM versions WHERE newest = 1 AND submitted_date >= '1998-01-01'",
    "features": """
        SELECT f.patient_id, f.hospital_id, f.admission_date, f.length_of_stay, f.diagnosis_code, f.ward, f.age, f.age_group,
               coalesce(f.total_amount, 0) AS total_amount, coalesce(f.coverage_ratio, 0) AS coverage_ratio, f.claim_type,
               f.readmission_flag, coalesce(d.risk_score, 0) AS risk_score, d.gender, d.insurance_provider,
               CAST(f.readmission_flag AS INTEGER) AS label, f.admission_month,
               CAST(1 + dayofweek(f.admission_date) AS INTEGER) AS admission_dayofweek,
               CASE WHEN dayofweek(f.admission_date) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend_admission,
               __STAY__ AS los_bucket
        FROM fact f LEFT JOIN dim d ON d.patient_id = f.patient_id
        WHERE f.readmission_flag IS NOT NULL AND f.age IS NOT NULL AND f.length_of_stay IS NOT NULL""",
}
_MONEY = f"""count(claim_id) AS claim_count,
               {rounded(f"sum({units('total_amount', 2)})", '100', 2)} AS total_billed,
               {rounded(f"sum({units('insurance_covered', 4)})", '10000', 2)} AS total_covered,
               {rounded(f"sum({units('patient_copay', 4)})", '10000', 2)} AS total_copay,
               {avg_of('total_amount', 2, 2)} AS avg_claim_amount,
               {rounded(f"100 * sum({units('coverage_ratio', 4)})", 'count(coverage_ratio) * 10000', 2)} AS avg_coverage_pct,
               {rounded('sum(processing_days)', 'count(processing_days)', 1)} AS avg_processing_days,
               count(*) FILTER (WHERE high_value_flag) AS high_value_claims"""
_STAY = (
    "CASE WHEN length_of_stay <= 3 THEN 'Short' WHEN length_of_stay <= 7 THEN 'Medium' "
    "WHEN length_of_stay <= 14 THEN 'Long' ELSE 'Very Long' END"
)


def _hospital_metrics(rows: str) -> str:
    flagged = "count(*) FILTER (WHERE readmission_flag)"
    return f"""
        SELECT hospital_id, CAST(year(admission_date) AS INTEGER) AS admission_year,
               CAST(month(admission_date) AS INTEGER) AS admission_month, count(patient_id) AS total_admissions,
               count(DISTINCT patient_id) AS unique_patients,
               {rounded('sum(length_of_stay)', 'count(length_of_stay)', 2)} AS avg_length_of_stay,
               max(length_of_stay) AS max_length_of_stay, {flagged} AS readmission_count,
               {rounded(f'100 * {flagged}', 'count(patient_id)', 2)} AS readmission_rate_pct,
               count(DISTINCT diagnosis_code) AS unique_diagnoses, count(DISTINCT attending_physician) AS active_physicians,
               {AS_OF_TS} AS _processed_at, {AS_OF_DATE} AS _run_date
        FROM {rows} GROUP BY hospital_id, year(admission_date), month(admission_date)"""


def _dashboard(money: str, on: str, columns: str) -> str:
    return f"""
        SELECT m.hospital_id, m.admission_year, m.admission_month, make_date(m.admission_year, m.admission_month, 1) AS period_start,
               m.total_admissions, m.unique_patients, {rounded(units('m.avg_length_of_stay', 2), '100', 1)} AS avg_los_days,
               m.readmission_count, m.readmission_rate_pct, m.active_physicians, m.unique_diagnoses, {columns}
        FROM metrics m LEFT JOIN {money} r ON {on}"""


CTES["ingested"] = """
    SELECT *, CASE WHEN known THEN 'run-1' ELSE 'run-2' END AS run_id
    FROM (SELECT *, last_modified_date < '2001-06-01' AND record_id % 13 <> 0 AS known FROM raw_patients)
    WHERE known OR last_modified_date >= (
        SELECT CAST(CAST(max(last_modified_date) AS DATE) - 30 AS VARCHAR) FROM raw_patients
        WHERE last_modified_date < '2001-06-01' AND record_id % 13 <> 0)"""
_TURN = "CASE WHEN event_id % 5 = 0 THEN 2 WHEN ts >= '2024-01-16' THEN 1 ELSE 0 END"
CTES["told"] = CTES["vitals"].replace("FROM events", f"FROM events WHERE event_id % 50 <> 1").replace(
    "ts AS event_time", f"ts AS event_time, {_TURN} AS batch"
)
CTES["metrics"] = _hospital_metrics("patients")
CTES["dashboard"] = _dashboard(
    "rollup_money",
    "r.hospital_id = m.hospital_id",
    "r.total_revenue_inr, r.insurance_covered_inr, r.patient_copay_inr, r.claim_count, r.high_value_claims, "
    "r.avg_coverage_pct, r.avg_claim_processing_days",
)
CTES["dashboard_month"] = _dashboard(
    "financial_month",
    "r.hospital_id = m.hospital_id AND r.admission_year = m.admission_year AND r.admission_month = m.admission_month",
    f"{rounded(units('r.total_billed', 2), '100', 0)} AS total_revenue_inr, "
    f"{rounded(units('r.total_covered', 2), '100', 0)} AS insurance_covered_inr, "
    f"{rounded(units('r.total_copay', 2), '100', 0)} AS patient_copay_inr, r.claim_count, r.high_value_claims, "
    f"{rounded(units('r.avg_coverage_pct', 2), '100', 1)} AS avg_coverage_pct, "
    "r.avg_processing_days AS avg_claim_processing_days",
)
CTES = {k: v.replace("__MONEY__", _MONEY).replace("__STAY__", _STAY) for k, v in CTES.items()}


def _root_cause(rows: str, tie: str) -> str:
    """Consecutive visits by self-join on the visit number."""
    return f"""
        , numbered AS (
            SELECT *, row_number() OVER (PARTITION BY patient_id ORDER BY admission_date, {tie}) AS visit
            FROM {rows} WHERE readmission_flag)
        SELECT a.diagnosis_code, a.ward, count(*) AS readmission_count,
               {rounded('sum(a.length_of_stay)', 'count(a.length_of_stay)', 1)} AS avg_initial_los,
               {avg_of('a.total_amount', 2, 0)} AS avg_initial_cost,
               floor(avg(b.admission_date - a.admission_date)) AS avg_days_to_readmission
        FROM numbered a JOIN numbered b ON b.patient_id = a.patient_id AND b.visit = a.visit + 1
             AND b.admission_date - a.admission_date <= 30
        GROUP BY a.diagnosis_code, a.ward"""


def _windows(width: str, keys: str, back: str = "", source: str = "vitals") -> str:
    return f"""
        SELECT {keys}, avg(heart_rate) AS avg_heart_rate, max(heart_rate) AS max_heart_rate, min(heart_rate) AS min_heart_rate,
               avg(blood_pressure_systolic) AS avg_bp_systolic, avg(blood_pressure_diastolic) AS avg_bp_diastolic,
               avg(spo2) AS avg_spo2, avg(temperature) AS avg_temperature, count(*) AS reading_count,
               time_bucket(INTERVAL '{width}', event_time{back}) + INTERVAL '{width}' AS window_end_time
        FROM {source} GROUP BY {keys}, time_bucket(INTERVAL '{width}', event_time{back})"""


_VISITS = """
    SELECT patient_id, admission_date, record_id, ward,
           row_number() OVER (PARTITION BY patient_id ORDER BY admission_date, record_id) AS visit_num,
           lead(admission_date) OVER (PARTITION BY patient_id ORDER BY admission_date, record_id) AS next_admission_date
    FROM admissions WHERE readmission_flag"""


def _by_hour(windows: str) -> str:
    return f"""
        SELECT *, strftime(window_end_time, '%Y-%m-%d') AS date, CAST(hour(window_end_time) AS INTEGER) AS hour
        FROM ({windows})"""


_ALERTS = """
    SELECT patient_id, device_id, ward_id, heart_rate, spo2, blood_pressure_systolic, temperature, event_time,
           CASE WHEN heart_rate > 150 OR heart_rate < 40 THEN 'CRITICAL_HR' WHEN spo2 < 90 THEN 'CRITICAL_SPO2'
                WHEN blood_pressure_systolic > 180 THEN 'CRITICAL_BP' ELSE 'HIGH_FEVER' END AS alert_type
    FROM vitals
    WHERE heart_rate NOT BETWEEN 40 AND 150 OR spo2 < 90 OR blood_pressure_systolic > 180 OR temperature > 39.5"""
_BRONZE_PATIENTS = "SELECT * EXCLUDE (record_id, total_amount) FROM raw_patients"
_GATE = """
    SELECT 'patients' AS source, count(*) AS rows_copied, count(*) > 0 AS passed FROM raw_patients
    UNION ALL SELECT 'claims', count(*), count(*) > 0 FROM raw_claims
    UNION ALL SELECT 'vitals', count(*), count(*) > 0 FROM vitals
    UNION ALL SELECT 'future_vitals', count(*), count(*) > 0 FROM vitals WHERE event_time > TIMESTAMP '2100-01-01'"""
_UPSERTED = """
    SELECT * FROM last_versions
    UNION ALL SELECT f.* FROM first_versions f WHERE NOT EXISTS (SELECT 1 FROM last_versions l WHERE l.claim_id = f.claim_id)"""

FINAL: dict[str, str] = {
    "watermark_lookup": "SELECT max(TRY_CAST(last_modified_date AS DATE)) AS last_watermark FROM raw_patients",
    "incremental_extract": """
        SELECT patient_id, first_name, last_name, date_of_birth, gender, diagnosis_code, admission_date, discharge_date,
               attending_physician, hospital_id, insurance_provider, last_modified_date, record_id
        FROM raw_patients WHERE last_modified_date > '2001-06-01'""",
    "watermark_update": """
        SELECT 'EHR_Patients' AS table_name, max(last_modified_date) AS last_modified_date FROM raw_patients
        UNION ALL SELECT 'Claims', max(submitted_date) FROM raw_claims""",
    "csv_bronze_scan": """
        SELECT * EXCLUDE (record_id) REPLACE (nullif(processed_date, 'NULL') AS processed_date) FROM raw_claims""",
    "json_landed_scan": "SELECT *, CAST(NULL AS VARCHAR) AS _corrupt_record FROM vitals",
    "csv_landing_stream": _BRONZE_PATIENTS,
    "null_count_report": " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS null_count, count(*) > count({c}) AS warn FROM raw_patients"
        for c in ("patient_id", "date_of_birth", "admission_date", "gender", "discharge_date", "readmission_flag")
    ),
    "drop_null_key_rows": """
        SELECT record_id, patient_id, discharge_date FROM raw_patients
        WHERE patient_id IS NOT NULL AND discharge_date IS NOT NULL""",
    "date_format_validity": "SELECT record_id, "
    + ", ".join(
        f"regexp_full_match({c}, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') AS {c}_valid"
        for c in ("date_of_birth", "admission_date", "discharge_date")
    )
    + " FROM raw_patients",
    "code_validity": """
        SELECT diagnosis_code, coalesce(regexp_full_match(upper(trim(diagnosis_code)), '[A-Z][0-9]{2}([.][0-9]{1,4})?'), FALSE)
               AS is_valid, count(*) AS rows
        FROM raw_patients GROUP BY diagnosis_code""",
    "nonempty_gate": _GATE,
    "nonempty_gate_alerts": f"""
        SELECT 'public_health' AS pipeline, 'No data ingested from ' || source AS message, 'run-1' AS run_id
        FROM ({_GATE}) WHERE NOT passed""",
    "dedupe_latest_claims": "SELECT claim_id, processed_date, CAST(submitted_date AS VARCHAR) AS submitted_date, total_amount, record_id FROM claims",
    "gender_standardized": """
        SELECT gender AS raw_gender, CASE lower(trim(gender)) WHEN 'm' THEN 'Male' WHEN 'male' THEN 'Male' WHEN 'f' THEN 'Female'
               WHEN 'female' THEN 'Female' ELSE 'Unknown' END AS gender, count(*) AS rows
        FROM raw_patients GROUP BY ALL""",
    "age_years": f"""
        SELECT record_id, CAST(floor(({AS_OF_DATE} - TRY_CAST(date_of_birth AS DATE)) / 365.25) AS INTEGER) AS age_elapsed,
               CAST(date_part('year', age({AS_OF_TS}, CAST(TRY_CAST(date_of_birth AS DATE) AS TIMESTAMP))) AS INTEGER) AS age_calendar
        FROM raw_patients""",
    "age_group_counts": "SELECT age_group, count(*) AS admissions FROM admissions GROUP BY age_group",
    "risk_scores": "SELECT record_id, risk_score, risk_category, risk_score_known FROM risk",
    "coverage_ratios": """
        SELECT claim_id, record_id, CASE WHEN total_amount = 0 THEN 0.0::DOUBLE ELSE round(insurance_covered / total_amount, 4) END
               AS coverage_ratio FROM raw_claims""",
    "high_value_claims": """
        SELECT total_amount > 500000 AS high_value_flag, count(*) AS claims FROM raw_claims GROUP BY ALL""",
    "case_insensitive_status": "SELECT "
    + ", ".join(
        f"count(*) FILTER (WHERE lower(trim(claim_status)) = '{s}') AS {s}_rows" for s in ("approved", "denied", "pending")
    )
    + " FROM raw_claims",
    "pii_mask": "SELECT DISTINCT patient_id, '***' AS first_name, '***' AS last_name FROM admissions",
    "stay_bucket_counts": f"SELECT {_STAY} AS los_bucket, count(*) AS admissions FROM admissions GROUP BY ALL",
    "silver_patients": "SELECT * FROM patients",
    "silver_claims": "SELECT * FROM claims",
    "dim_patient": "SELECT * FROM dim",
    "dim_patient_latest_admission": f"""
        SELECT patient_id, gender, date_of_birth, age, age_group, hospital_id, ward, insurance_provider, diagnosis_code,
               diagnosis_description, risk_score, risk_category, readmission_flag, {AS_OF_TS} AS _processed_at
        FROM risk QUALIFY row_number() OVER (PARTITION BY patient_id ORDER BY admission_date DESC, record_id) = 1""",
    "fact_admissions": "SELECT * FROM fact",
    "fact_admissions_hot_keys": "SELECT * FROM fact",
    "agg_hospital_metrics": "SELECT * FROM metrics",
    "hospital_metrics_by_admission": _hospital_metrics("admissions"),
    "hospital_metrics_incremental": _hospital_metrics("admissions"),
    "agg_disease_burden": f"""
        SELECT *, CASE WHEN avg_length_of_stay > 14 THEN 'Severe' WHEN avg_length_of_stay > 7 THEN 'Moderate' ELSE 'Mild' END
               AS disease_severity, {AS_OF_TS} AS _processed_at
        FROM (SELECT diagnosis_code, diagnosis_description, ward, count(patient_id) AS patient_count,
                     {rounded('sum(length_of_stay)', 'count(length_of_stay)', 2)} AS avg_length_of_stay,
                     {rounded('sum(age)', 'count(age)', 1)} AS avg_patient_age,
                     count(*) FILTER (WHERE readmission_flag) AS readmission_count,
                     {rounded('100 * count(*) FILTER (WHERE readmission_flag)', 'count(patient_id)', 2)} AS readmission_rate_pct
              FROM patients GROUP BY ALL)""",
    "agg_financial_summary": "SELECT * FROM financial",
    "hospital_monthly_dashboard": "SELECT * FROM dashboard",
    "hospital_monthly_dashboard_by_period": "SELECT * FROM dashboard_month",
    "patient_risk_summary": "SELECT * FROM person_risk",
    "diagnosis_analytics": "SELECT * FROM diagnoses",
    "insurance_analysis": "SELECT * FROM insurance",
    "hospital_overview": f"""
        SELECT hospital_id, CAST(sum(total_admissions) AS BIGINT) AS ytd_admissions, {avg_of('avg_los_days', 1, 1)} AS avg_los,
               {avg_of('readmission_rate_pct', 2, 2)} AS avg_readmission_rate,
               {rounded('sum(CAST(total_revenue_inr AS HUGEINT))', '1000000', 2)} AS total_revenue_million_inr,
               {avg_of('avg_coverage_pct', 1, 1)} AS avg_insurance_coverage_pct
        FROM dashboard WHERE admission_year = year({AS_OF_DATE}) GROUP BY hospital_id""",
    "monthly_trend": f"""
        SELECT admission_year, admission_month, make_date(admission_year, admission_month, 1) AS month_start,
               CAST(sum(total_admissions) AS BIGINT) AS total_admissions, CAST(sum(readmission_count) AS BIGINT) AS total_readmissions,
               {avg_of('readmission_rate_pct', 2, 2)} AS readmission_rate_pct, {avg_of('avg_los_days', 1, 1)} AS avg_los_days
        FROM dashboard GROUP BY admission_year, admission_month""",
    "top_diagnoses": f"""
        SELECT diagnosis_code, diagnosis_description, patient_count, avg_los, avg_patient_age, readmission_rate_pct,
               {rounded('total_revenue', '1000000', 2)} AS revenue_million_inr
        FROM (SELECT * FROM diagnoses ORDER BY patient_count DESC, diagnosis_code, diagnosis_description, ward LIMIT 10)""",
    "high_risk_followup": f"""
        SELECT patient_id, hospital_id, ward, age, age_group, gender, diagnosis_code, diagnosis_description, risk_score,
               risk_category, length_of_stay, attending_physician, admission_date, discharge_date
        FROM person_risk WHERE risk_category = 'High Risk' AND discharge_date >= {AS_OF_TS} - INTERVAL 30 DAY""",
    "insurer_comparison": f"""
        SELECT insurance_provider, CAST(sum(total_claims) AS BIGINT) AS total_claims, CAST(sum(approved_claims) AS BIGINT) AS approved,
               CAST(sum(denied_claims) AS BIGINT) AS denied, CAST(sum(pending_claims) AS BIGINT) AS pending,
               {avg_of('approval_rate_pct', 1, 1)} AS avg_approval_rate_pct,
               {rounded('sum(CAST(total_billed AS HUGEINT))', '1000000', 2)} AS total_billed_million,
               {rounded('sum(CAST(total_covered AS HUGEINT))', '1000000', 2)} AS total_covered_million,
               {avg_of('avg_processing_days', 1, 1)} AS avg_processing_days, CAST(sum(high_value_claims) AS BIGINT) AS high_value_claims
        FROM insurance GROUP BY insurance_provider""",
    "ward_efficiency": f"""
        SELECT ward, count(DISTINCT patient_id) AS total_patients,
               {rounded('sum(length_of_stay)', 'count(length_of_stay)', 1)} AS avg_los,
               count(*) FILTER (WHERE readmission_flag) AS readmissions,
               {rounded('100 * count(*) FILTER (WHERE readmission_flag)', 'count(patient_id)', 1)} AS readmission_rate_pct,
               {rounded(f"sum({units('coalesce(total_amount, 0)', 2)})", 'count(*) * 100', 0)} AS avg_claim_per_patient,
               count(DISTINCT attending_physician) AS physician_count
        FROM fact GROUP BY ward""",
    "visit_sequence": _VISITS,
    "visit_sequence_hot_keys": _VISITS,
    "readmission_root_cause": _root_cause("fact", "claim_id"),
    "readmission_root_cause_by_admission": _root_cause("admissions", "record_id"),
    "external_gold_tables": """
        SELECT h.hospital_id, h.admissions, c.claims, d.patients, f.claimed
        FROM (SELECT hospital_id, count(*) AS admissions FROM patients GROUP BY hospital_id) h
        LEFT JOIN (SELECT hospital_id, count(*) AS claims FROM claims GROUP BY hospital_id) c ON c.hospital_id = h.hospital_id
        LEFT JOIN (SELECT hospital_id, count(*) AS patients FROM dim GROUP BY hospital_id) d ON d.hospital_id = h.hospital_id
        LEFT JOIN (SELECT hospital_id, count(claim_id) AS claimed FROM fact GROUP BY hospital_id) f ON f.hospital_id = h.hospital_id""",
    "external_gold_views": """
        SELECT h.hospital_id, h.admission_year, h.admission_month, h.total_admissions, h.total_revenue_inr, r.patients, r.high_risk
        FROM dashboard h LEFT JOIN (
             SELECT hospital_id, count(*) AS patients, count(*) FILTER (WHERE risk_category = 'High Risk') AS high_risk
             FROM dim GROUP BY hospital_id) r ON r.hospital_id = h.hospital_id""",
    "merge_upsert_claims": _UPSERTED,
    "merge_upsert_newer_only": """
        SELECT l.* FROM last_versions l
        WHERE NOT EXISTS (SELECT 1 FROM first_versions f WHERE f.claim_id = l.claim_id AND f.submitted_date >= l.submitted_date)
        UNION ALL SELECT f.* FROM first_versions f
        WHERE NOT EXISTS (SELECT 1 FROM last_versions l WHERE l.claim_id = f.claim_id AND l.submitted_date > f.submitted_date)""",
    "bucketed_table_upsert": _UPSERTED,
    "schema_change_upsert": """
        SELECT claim_id, CASE WHEN NOT few THEN submitted_date END AS submitted_date,
               CASE WHEN few OR submitted_date < '1998-01-01' THEN size ELSE size * 10000000000 END AS units,
               CASE WHEN few THEN NULL WHEN submitted_date < '1998-01-01' THEN trunc(total_amount) ELSE total_amount END AS amount,
               CASE WHEN NOT few AND submitted_date >= '1998-01-01' THEN trim(claim_type) END AS claim_type,
               CASE WHEN few THEN 'seen' END AS note
        FROM (SELECT *, claim_id LIKE 'CLM-1-%' AS few, length(procedure_description) AS size FROM raw_claims
              QUALIFY row_number() OVER (PARTITION BY claim_id ORDER BY submitted_date DESC NULLS LAST, record_id) = 1)""",
    "versioned_table_upsert": _UPSERTED,
    "copy_consistency": """
        SELECT 'patients' AS table_name, count(*) AS rows_read, count(*) AS rows_written, TRUE AS consistent FROM raw_patients
        UNION ALL SELECT 'claims', count(*), count(*), TRUE FROM raw_claims""",
    "copy_run_log": """
        SELECT 'ehr_ingestion' AS pipeline_name, 'run-1' AS run_id, 'Succeeded' AS status, count(*) AS rows_copied FROM raw_patients
        UNION ALL SELECT 'vitals_ingestion', 'run-2', 'Succeeded', count(*) FROM vitals""",
    "typed_landing": """
        SELECT record_id, patient_id, TRY_CAST(date_of_birth AS DATE) AS date_of_birth,
               TRY_CAST(admission_date AS DATE) AS admission_date, TRY_CAST(discharge_date AS DATE) AS discharge_date,
               readmission_flag, TRY_CAST(attending_physician AS INTEGER) AS attending_physician
        FROM raw_patients""",
    "partitioned_overwrite": "SELECT claim_id, total_amount, claim_type, claim_status FROM claims",
    "clustered_rewrite": "SELECT claim_id, patient_id, total_amount FROM claims",
    "clustered_file_ranges": """
        SELECT 'claim_id' AS column_name, count(DISTINCT claim_id) AS distinct_values, TRUE AS narrow FROM claims
        UNION ALL SELECT 'patient_id', count(DISTINCT patient_id), TRUE FROM claims""",
    "ingest_job_control": """
        SELECT 'EHR_Patients' AS pipeline_name, run_id, 'Succeeded' AS status, count(*) AS rows_copied,
               (SELECT max(last_modified_date) FROM raw_patients) AS last_modified_date
        FROM ingested GROUP BY run_id
        UNION ALL SELECT 'EHR_Patients', 'run-3', 'Failed', 0, (SELECT max(last_modified_date) FROM raw_patients)""",
    "ingest_overlap_rows": """
        SELECT record_id, last_modified_date, TRY_CAST(date_of_birth AS DATE) AS date_of_birth,
               CASE WHEN TRY_CAST(date_of_birth AS DATE) IS NULL THEN date_of_birth END AS raw_birth, run_id FROM ingested""",
    "landing_manifest": """
        SELECT folder, delivery, 'archived' AS state, count(*) AS rows,
               count(*) FILTER (WHERE TRY_CAST(admission_date AS DATE) IS NULL) AS quarantined, count(*) AS archived_rows
        FROM (SELECT *, CASE WHEN record_id % 3 = 0 THEN '2001/07/31' ELSE '2001/08/01' END AS folder,
                     CASE WHEN record_id % 3 = 2 THEN 'c' ELSE 'a' END AS delivery FROM raw_patients)
        GROUP BY folder, delivery""",
    "landing_rows": """
        SELECT record_id, TRY_CAST(admission_date AS DATE) AS admission_date, TRY_CAST(date_of_birth AS DATE) AS date_of_birth,
               TRY_CAST(admission_date AS DATE) IS NULL AS apart,
               CASE WHEN TRY_CAST(date_of_birth AS DATE) IS NULL THEN date_of_birth END AS raw_date_of_birth,
               CASE WHEN TRY_CAST(admission_date AS DATE) IS NULL THEN admission_date END AS raw_admission_date
        FROM raw_patients""",
    "csv_rescued_cells": " UNION ALL ".join(
        f"SELECT record_id, '{c}' AS column_name, {c} AS raw FROM raw_patients WHERE {c} IS NOT NULL AND TRY_CAST({c} AS DATE) IS NULL"
        for c in ("date_of_birth", "admission_date", "discharge_date")
    ),
    "typed_landing_rescued": """
        SELECT column_name, cells, (SELECT count(*) FROM raw_claims) AS rows,
               (SELECT count(*) FROM raw_claims WHERE TRY_CAST(processed_date AS DATE) IS NULL) AS quarantined
        FROM (SELECT 'claim_id' AS column_name, 0 AS cells UNION ALL SELECT 'total_amount', 0
              UNION ALL SELECT 'submitted_date', count(*) FROM raw_claims WHERE TRY_CAST(submitted_date AS DATE) IS NULL
              UNION ALL SELECT 'processed_date', count(*) FROM raw_claims WHERE TRY_CAST(processed_date AS DATE) IS NULL
              UNION ALL SELECT 'procedure_code', count(*) FROM raw_claims WHERE TRY_CAST(procedure_code AS INTEGER) IS NULL)""",
    "ml_predictions_table": """
        SELECT label, count(*) AS rows, count(*) AS sound, count(*) AS banded, count(DISTINCT patient_id) AS patients
        FROM features GROUP BY label""",
    "run_metrics_log": "SELECT 'run-1' AS run_id, 3 AS params, 4 AS metrics, count(*) AS rows, 4 AS sound FROM features",
    "interleaved_file_ranges": "SELECT unnest(['claim_id', 'patient_id']) AS column_name, TRUE AS narrow, TRUE AS cut",
    "copy_mismatches": """
        SELECT record_id, ward, 'one' AS side, 1 AS copies FROM raw_patients WHERE record_id % 1009 = 3 AND record_id % 1013 <> 5 AND ward <> 'moved'
        UNION ALL SELECT record_id, ward, 'one', 1 FROM raw_patients WHERE record_id % 1013 = 5
        UNION ALL SELECT record_id, 'moved', 'two', CASE WHEN record_id % 1019 = 7 THEN 2 ELSE 1 END FROM raw_patients
                  WHERE record_id % 1009 = 3 AND record_id % 1013 <> 5
        UNION ALL SELECT record_id, ward, 'two', 1 FROM raw_patients WHERE record_id % 1019 = 7 AND record_id % 1013 <> 5 AND record_id % 1009 <> 3""",
    "copy_mismatch_levels": "SELECT level, 1 AS nodes, TRUE AS as_many, 64 - 4 * level AS bits FROM range(5) t(level)",
    "vitals_compacted_windows": _by_hour(_windows("5 minutes", "patient_id, device_id, ward_id")),
    "layered_jobs_dashboard": "SELECT * FROM dashboard",
    "vitals_tumbling": _windows("5 minutes", "patient_id, device_id, ward_id"),
    "vitals_hourly_by_ward": _windows("1 hour", "ward_id"),
    "vitals_right_closed": _windows("5 minutes", "patient_id, device_id, ward_id", " - INTERVAL 1 MICROSECOND"),
    "vitals_alerts": _ALERTS,
    "vitals_windows_stream": _by_hour(_windows("5 minutes", "patient_id, device_id, ward_id")),
    "vitals_windows_stream_right_closed": _by_hour(
        _windows("5 minutes", "patient_id, device_id, ward_id", " - INTERVAL 1 MICROSECOND")
    ),
    "rejected_messages": """
        SELECT event_id, CASE WHEN event_id % 5 = 1 THEN 'unparsed' WHEN event_id % 11 = 1 THEN 'empty' ELSE 'no_event_time' END AS reason
        FROM events WHERE event_id % 5 = 1 OR event_id % 11 = 1 OR event_id % 7 = 1""",
    "vitals_alerts_stream": _ALERTS,
    "vitals_corrected_windows": _windows("5 minutes", "patient_id, device_id, ward_id", source="told"),
    "vitals_fan_out_sinks": f"""
        SELECT 'alerts' AS sink, batch, count(*) AS rows FROM ({_ALERTS.replace("alert_type", "alert_type, batch").replace("FROM vitals", "FROM told")}) GROUP BY batch
        UNION ALL SELECT 'rejects', {_TURN}, count(*) FROM events WHERE event_id % 50 = 1 GROUP BY ALL
        UNION ALL SELECT 'late', batch, count(*) FROM told
        WHERE time_bucket(INTERVAL '5 minutes', event_time) + INTERVAL '5 minutes'
              <= (SELECT max(event_time) - INTERVAL '5 minutes' FROM told AS earlier WHERE earlier.batch < told.batch)
        GROUP BY batch""",
    "ml_features": "SELECT * FROM features",
    "label_distribution": "SELECT label, count(*) AS rows FROM features GROUP BY label",
    "category_index": " UNION ALL ".join(
        f"""
        SELECT '{c}' AS feature, {c} AS category, row_number() OVER (ORDER BY count(*) DESC, {c}) - 1 AS position
        FROM features WHERE {c} IS NOT NULL GROUP BY {c}"""
        for c in ("gender", "age_group", "ward", "los_bucket", "claim_type")
    ),
    "scaler_summary": " UNION ALL ".join(
        f"""
        SELECT '{c}' AS feature, round(avg(CAST({c} AS DOUBLE)), 6) AS mean, round(stddev_samp(CAST({c} AS DOUBLE)), 6) AS deviation
        FROM features"""
        for c in (
            "age", "length_of_stay", "total_amount", "coverage_ratio", "risk_score", "admission_month", "is_weekend_admission",
        )
    ),
    "train_test_split": "SELECT count(*) AS rows, TRUE AS near, 0 AS on_both FROM features",
    "feature_vector_slots": " UNION ALL ".join(
        [
            f"SELECT '{c}_ohe_' || {c} AS slot, count(*) AS rows_set, CAST(count(*) AS DOUBLE) AS total FROM features WHERE {c} IS NOT NULL GROUP BY {c}"
            for c in ("gender", "age_group", "ward", "los_bucket", "claim_type")
        ]
        + [
            f"SELECT '{c}', count(*) FILTER (WHERE {c} <> 0), round(CAST(sum(CAST({c} AS DECIMAL(28,8))) AS DOUBLE), 2) FROM features"
            for c in ("age", "length_of_stay", "total_amount", "coverage_ratio", "risk_score", "admission_month", "is_weekend_admission")
        ]
    ),
    "alert_messages": f"SELECT patient_id AS key, heart_rate, spo2, alert_type, device_id, event_time FROM ({_ALERTS})",
    "rank_metrics": """
        SELECT max(p) AS positives, max(n) AS negatives, round(CAST(sum(neg * (2 * pos_before + pos)) AS DOUBLE) / 2 / (max(p) * max(n)), 9) AS area_under_roc,
               round(sum(pos * (precision + last) / 2) / max(p), 9) AS area_under_pr,
               round(max(abs((pos_before + pos) / p - (neg_before + neg) / n)), 9) AS best_ks
        FROM (SELECT *, (pos_before + pos) / (pos_before + pos + neg_before + neg) AS precision,
                     CASE WHEN pos_before + neg_before > 0 THEN pos_before / (pos_before + neg_before)
                          ELSE pos / (pos + neg) END AS last
              FROM (SELECT *, sum(pos) OVER o - pos AS pos_before, sum(neg) OVER o - neg AS neg_before,
                           sum(pos) OVER () AS p, sum(neg) OVER () AS n
                    FROM (SELECT risk_score, count(*) FILTER (WHERE readmission_flag) AS pos, count(*) FILTER (WHERE NOT readmission_flag) AS neg
                          FROM dim WHERE readmission_flag IS NOT NULL AND risk_score IS NOT NULL GROUP BY risk_score)
                    WINDOW o AS (ORDER BY risk_score DESC)))""",
    "nested_bundle_claims": """
        SELECT patient_id, CAST(admission_date AS DATE) AS admission_date, claim_id, total_amount, insurance_covered,
               CAST(submitted_date AS DATE) AS submitted_date, TRY_CAST(processed_date AS DATE) AS processed_date, trim(diagnosis_code) AS first_code,
               CASE WHEN TRY_CAST(processed_date AS DATE) IS NULL THEN '"' || processed_date || '"' END AS raw_processed,
               '{"type":"' || claim_type || '"}' AS extra
        FROM raw_claims WHERE admission_date NOT LIKE '%-13'""",
    "nested_bundle_rejects": """
        SELECT left(admission_date, 7) AS month, count(*) AS documents
        FROM (SELECT DISTINCT patient_id, admission_date FROM raw_claims WHERE admission_date LIKE '%-13') GROUP BY month""",
    "risk_band_distribution": """
        SELECT CASE WHEN risk_score / 100 >= 0.7 THEN 'Very High' WHEN risk_score / 100 >= 0.5 THEN 'High'
                    WHEN risk_score / 100 >= 0.3 THEN 'Medium' ELSE 'Low' END AS risk_band, count(*) AS patients
        FROM dim GROUP BY ALL""",
}


def _needed(text: str) -> list[str]:
    """The CTEs a text uses, each after those it builds on."""
    ordered: list[str] = []
    for name in CTES:
        if re.search(rf"\b(FROM|JOIN)\s+{name}\b", text) and name not in ordered:
            for inner in [*_needed(CTES[name]), name]:
                if inner not in ordered:
                    ordered.append(inner)
    return ordered


def _assemble(final: str) -> str:
    parts = [f"{name} AS ({CTES[name]}\n)" for name in _needed(final)]
    if not parts:
        return final.lstrip()
    head = "WITH " + ",\n".join(parts)
    tail = final.lstrip()
    return f"{head}\n{tail}" if not tail.startswith(",") else f"{head}{tail}"


ORACLE: dict[str, str] = {name: _assemble(final) for name, final in FINAL.items()}
