"""Business rules as native column expressions (no Python per row)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakecare.functions.clock import AsOf, as_of_date, as_of_timestamp

# Fixed values of the rule book: labels, thresholds, weights and patterns.
GENDER_SPELLINGS = {"Male": ("M", "MALE"), "Female": ("F", "FEMALE")}
GENDER_OTHER = "Unknown"
AGE_STEPS = ((18, "Pediatric"), (40, "Young Adult"), (60, "Middle Aged"), (80, "Senior"))
AGE_TOP = "Elderly"
DAYS_PER_YEAR = 365.25
RISK_AGE_WEIGHT, RISK_STAY_WEIGHT = 0.3, 2.5
RISK_READMITTED, RISK_GROUP_BONUS, RISK_CAP = 20, {"Elderly": 10, "Senior": 5}, 100
RISK_STEPS = ((70, "High Risk"), (40, "Medium Risk"))
RISK_BOTTOM = "Low Risk"
SEVERITY_STEPS = ((14, "Severe"), (7, "Moderate"))
SEVERITY_BOTTOM = "Mild"
STAY_STEPS = ((3, "Short"), (7, "Medium"), (14, "Long"))
STAY_TOP = "Very Long"
BAND_STEPS = ((0.70, "Very High"), (0.50, "High"), (0.30, "Medium"))
BAND_BOTTOM = "Low"
HIGH_VALUE_ABOVE = 500000
PII_MASK = "***"
DATE_SHAPE = r"^\d{4}-\d{2}-\d{2}$"
CODE_SHAPE = r"^[A-Z]\d{2}(\.\d{1,4})?$"
WEEKEND_DAYS = (1, 7)  # Sunday and Saturday

_COMPARE = {
    "<": Column.__lt__,
    "<=": Column.__le__,
    ">": Column.__gt__,
    ">=": Column.__ge__,
}


def bucketize(value: Column, op: str, steps: Sequence[tuple[float, str]], rest: str) -> Column:
    """First step whose comparison holds names the bucket. A null value falls to ``rest``."""
    holds = _COMPARE[op]
    case = F
    for bound, label in steps:
        case = case.when(holds(value, bound), label)
    return case.otherwise(rest)


def normalized(text: Column) -> Column:
    return F.upper(F.trim(text))


def parsed_date(text: Column) -> Column:
    """Date from text; anything malformed (also the word NULL) becomes null."""
    return F.when(text.rlike(DATE_SHAPE), text.try_cast("date"))


def gender(raw: Column) -> Column:
    spelled = normalized(raw)
    case = F
    for label, forms in GENDER_SPELLINGS.items():
        case = case.when(spelled.isin(*forms), label)
    return case.otherwise(GENDER_OTHER)


def age(born: Column, as_of: AsOf, mode: str = "elapsed") -> Column:
    """Whole years. ``elapsed`` divides days by 365.25; ``calendar`` counts birthdays."""
    today = as_of_date(as_of)
    if mode == "elapsed":
        return F.floor(F.datediff(today, born) / F.lit(DAYS_PER_YEAR)).cast("int")
    if mode == "calendar":
        before_birthday = F.date_format(today, "MMdd") < F.date_format(born, "MMdd")
        return F.year(today) - F.year(born) - before_birthday.cast("int")
    raise ValueError(f"unknown age mode: {mode}")


def age_group(years: Column) -> Column:
    return bucketize(years, "<", AGE_STEPS, AGE_TOP)


def risk_score(
    years: Column, stay: Column, readmitted: Column, group: Column, null_policy: str = "capped"
) -> Column:
    """0-100 score. With ``capped`` an unknown age or stay scores the cap, since the cap is
    the least of the known values; with ``null`` it stays unknown."""
    bonus = F.lit(0)
    for label, points in RISK_GROUP_BONUS.items():
        bonus = bonus + F.coalesce((group == label).cast("int"), F.lit(0)) * points
    readmission = F.coalesce(readmitted.cast("int"), F.lit(0)) * RISK_READMITTED
    points = F.round(years * RISK_AGE_WEIGHT + stay * RISK_STAY_WEIGHT + readmission + bonus, 1)
    capped = F.least(F.lit(float(RISK_CAP)), points)
    if null_policy == "capped":
        return capped
    if null_policy == "null":
        return F.when(points.isNotNull(), capped)
    raise ValueError(f"unknown null policy: {null_policy}")


def risk_category(score: Column) -> Column:
    return bucketize(score, ">=", RISK_STEPS, RISK_BOTTOM)


def disease_severity(avg_stay: Column) -> Column:
    return bucketize(avg_stay, ">", SEVERITY_STEPS, SEVERITY_BOTTOM)


def stay_bucket(days: Column) -> Column:
    return bucketize(days, "<=", STAY_STEPS, STAY_TOP)


def risk_band(probability: Column) -> Column:
    return bucketize(probability, ">=", BAND_STEPS, BAND_BOTTOM)


def coverage_ratio(covered: Column, total: Column) -> Column:
    """Covered share to four decimals; a zero total counts as 0.0."""
    return F.when(total == 0, F.lit(0.0)).otherwise(F.round(F.try_divide(covered, total), 4))


def high_value(total: Column) -> Column:
    return F.coalesce(total > HIGH_VALUE_ABOVE, F.lit(False))


def valid_code(code: Column) -> Column:
    return F.coalesce(normalized(code).rlike(CODE_SHAPE), F.lit(False))


def date_shaped(text: Column) -> Column:
    """True/false for text, null for null (a missing date is not a malformed one)."""
    return text.rlike(DATE_SHAPE)


def weekend_flag(day: Column) -> Column:
    return F.coalesce(F.dayofweek(day).isin(*WEEKEND_DAYS).cast("int"), F.lit(0))


def masked() -> Column:
    return F.lit(PII_MASK)


def same_text(left: Column, right: Column | str) -> Column:
    """Case-insensitive equality, as a case-insensitive database collation gives it."""
    other = F.lit(right) if isinstance(right, str) else right
    return F.collate(left, "UTF8_LCASE") == F.collate(other, "UTF8_LCASE")


def audit_columns(
    as_of: AsOf, run_date: AsOf, source: str = "bronze", target: str = "silver"
) -> dict[str, Column]:
    return {
        "_source_layer": F.lit(source),
        "_target_layer": F.lit(target),
        "_processed_at": as_of_timestamp(as_of),
        "_run_date": F.lit(str(run_date)[:10]),
        "_is_current": F.lit(True),
    }
