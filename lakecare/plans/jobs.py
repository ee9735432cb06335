"""Jobs: bronze files to silver tables, silver tables to gold tables, gold tables to predictions.

Each job reads stored tables and writes stored tables, each output once, and deletes what it staged.
"""

from __future__ import annotations

import logging
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakecare.functions.clock import AsOf
from lakecare.ml import readmission
from lakecare.plans import gold, silver
from lakecare.schemas import BRONZE_CLAIMS, BRONZE_PATIENTS, GOLD_PARTITIONS
from lakecare.session import owned_scratch, stage
from lakecare.sinks.tables import overwrite_table, publish_version, read_table, upsert_bucketed, upsert_table
from lakecare.sources.batch import read_bronze

SILVER_SOURCES = ("patients", "claims")
BUCKETS = 256
FILE_ROWS = 10_000  # rows a file of a bucket holds on average where buckets are not gathered, at least
# The columns that stored tables are clustered by.
SILVER_CLUSTERS = {"patients": ("patient_id", "admission_date"), "claims": ("claim_id", "patient_id")}
GOLD_CLUSTERS = {"dim_patient": ("patient_id",), "fact_admissions": ("patient_id", "admission_date")}
PREDICTIONS, RUN_METRICS = "ml_readmission_predictions", "ml_run_metrics"

logger = logging.getLogger(__name__)


def bronze_quality(raw: DataFrame, columns: Sequence[str]) -> dict[str, int]:
    """Rows and nulls per critical column in one pass; nulls are logged as warnings."""
    nulls = [F.count_if(F.col(c).isNull()).alias(c) for c in columns]
    found = raw.agg(F.count(F.lit(1)).alias("rows"), *nulls).first().asDict()
    for column in columns:
        if found[column]:
            logger.warning("%d rows without %s", found[column], column)
    return found


def bronze_to_silver(
    spark: SparkSession,
    bronze: str,
    silver_base: str,
    run_date: AsOf,
    as_of: AsOf,
    source: str = "all",
    fmt: str = "csv",
    layout: str = "bucketed",
    buckets: int = BUCKETS,
    ties: Mapping[str, Sequence[str | Column]] | None = None,
    schemas: Mapping[str, StructType] | None = None,
) -> dict[str, dict[str, int]]:
    """Transform and upsert the chosen source; returns the bronze measures per table.

    ``bucketed`` tables rewrite only the key buckets a batch touches. ``versioned`` ones
    are partitioned by business columns and rewritten as a whole. ``ties`` names, per table, what
    decides between rows of one key that are equally new; ``schemas`` replaces the declared
    layout of a table that carries further columns.
    """
    if source not in (*SILVER_SOURCES, "all"):
        raise ValueError(f"no silver job for source {source!r}")
    if layout not in ("bucketed", "versioned"):
        raise ValueError(f"unknown table layout {layout!r}")
    chosen = SILVER_SOURCES if source == "all" else (source,)
    layouts = {"patients": BRONZE_PATIENTS, "claims": BRONZE_CLAIMS, **(schemas or {})}
    measures = {}
    for name in chosen:
        raw = read_bronze(spark, bronze, name, run_date, layouts[name], fmt)
        breakers = (ties or {}).get(name)
        if name == "patients":
            measures[name] = bronze_quality(raw, silver.CRITICAL_PATIENT_COLUMNS)
            rows, keys = silver.silver_patients(raw, as_of, run_date, breakers), silver.PATIENT_KEY
            partition_by: Sequence[str] = ("admission_year", "admission_month")
        else:
            measures[name] = bronze_quality(raw, (*silver.CLAIM_KEY, "patient_id"))
            rows, keys = silver.silver_claims(raw, as_of, run_date, breakers), silver.CLAIM_KEY
            partition_by = ("claim_type", "claim_status")
        path, order = f"{silver_base}/{name}", SILVER_CLUSTERS[name]
        with owned_scratch(spark):
            if layout == "bucketed":
                # The deduplication has just dealt the rows out by key; large batches are not dealt out once more.
                tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
                gather = measures[name]["rows"] < buckets * tasks * FILE_ROWS
                upsert_bucketed(spark, path, rows, keys, buckets, unique=True, sort_by=order, gather=gather)
            else:
                if name == "patients":
                    day = F.col("admission_date")
                    rows = rows.withColumns({"admission_year": F.year(day), "admission_month": F.month(day)})
                upsert_table(spark, path, rows, keys, partition_by, unique=True, sort_by=order)
    return measures


def silver_to_gold(
    spark: SparkSession, silver_base: str, gold_base: str, run_date: AsOf, as_of: AsOf
) -> dict[str, int]:
    """Rebuild the five gold tables; returns rows written per table."""
    patients = read_table(spark, f"{silver_base}/patients")
    claims = read_table(spark, f"{silver_base}/claims")
    outputs: dict[str, DataFrame] = {
        "dim_patient": gold.dim_patient(patients, unique=True).repartitionByRange("patient_id"),
        "agg_hospital_metrics": gold.agg_hospital_metrics(patients, as_of, run_date),
        "agg_disease_burden": gold.agg_disease_burden(patients, as_of),
        "agg_financial_summary": gold.agg_financial_summary(claims, as_of, run_date),
    }
    written = {}
    with owned_scratch(spark):
        outputs["fact_admissions"] = gold.fact_admissions(patients, claims)
        for name, df in outputs.items():
            seen = Observation(f"rows-{uuid.uuid4().hex}")
            order = GOLD_CLUSTERS.get(name, ())
            overwrite_table(df, f"{gold_base}/{name}", GOLD_PARTITIONS.get(name, ()), count_into=seen, sort_by=order)
            written[name] = seen.get["rows"]
    return written


def score_readmissions(
    spark: SparkSession, gold_base: str, model_path: str, run_id: str, as_of: AsOf, **training: object
) -> dict[str, float]:
    """Train on the stored gold tables, save the model, publish predictions of all rows and log the run.

    Predictions are a versioned table. A repeated run replaces its own entries in the metrics
    table. ``training`` goes to ``readmission.train``. Returns the metrics.
    """
    with owned_scratch(spark):
        facts, people = (read_table(spark, f"{gold_base}/{t}") for t in ("fact_admissions", "dim_patient"))
        features = stage(readmission.ml_features(facts, people), "features")
        trained = readmission.train(features, **training)
        readmission.save_model(trained.model, model_path)
        publish_version(readmission.score(readmission.load_model(model_path), features, as_of), f"{gold_base}/{PREDICTIONS}")
        log = readmission.metrics_table(spark, trained, run_id, as_of)
        overwrite_table(log.coalesce(1), f"{gold_base}/{RUN_METRICS}", ["run_id"], dynamic=True, gather=False)
    return trained.metrics
