"""Hospital metrics kept up to date by mergeable states, instead of a full recomputation per run.

A state has one row of sums, counts and the longest stay per hospital and month, and for each
counted column bitmaps over a dictionary that numbers its values densely. A batch of new admissions
is folded into states of its own, merged with the stored ones of the same keys, and upserted with a
record of the batch in one step: a batch that is repeated is known and changes nothing. Distinct
counts stay exact, as bits are joined by OR, and a row is never read again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakecare.functions.clock import AsOf, as_of_timestamp
from lakecare.functions.exact import share_pct
from lakecare.operators.sequence import ranked
from lakecare.schemas import GOLD
from lakecare.session import stage
from lakecare.sinks.tables import read_table, table_exists, upsert_bucketed

#: Counted column -> its name in the metrics.
COUNTED = {"patient_id": "unique_patients", "diagnosis_code": "unique_diagnoses", "attending_physician": "active_physicians"}
GROUP = ("hospital_id", "admission_year", "admission_month")
STATE_KEYS = ("key", "part", "slot")
MEASURES, DONE = "measures", "batch"
SUMS = ("admissions", "stay_sum", "stay_count", "readmissions")


def value_ids(spark: SparkSession, path: str, values: DataFrame, buckets: int) -> DataFrame:
    """Number the (name, value) pairs that the dictionary at ``path`` lacks after those it has; returns the dictionary."""
    wanted = values.select("name", "value").distinct()
    first = 0
    if table_exists(spark, path):
        known = read_table(spark, path)
        first = known.agg(F.max("id")).first()[0] + 1
        wanted = wanted.join(known, ["name", "value"], "left_anti")
    fresh = ranked(wanted, ["name", "value"], "id").withColumn("id", F.col("id") + F.lit(first).cast("long"))
    upsert_bucketed(spark, path, fresh, ["name", "value"], buckets=buckets, unique=True)
    return read_table(spark, path)


def _keyed(rows: DataFrame) -> DataFrame:
    """The group as one text that is never null, so that states meet by plain equality."""
    return rows.withColumn("key", F.to_json(F.struct(*GROUP), {"ignoreNullFields": "false"}))


def batch_states(rows: DataFrame, dictionary: DataFrame, pairs: DataFrame) -> DataFrame:
    """States of one batch: a row of measures per group, and a bitmap per group, counted column and slot."""
    measures = rows.groupBy("key", *GROUP).agg(
        F.count("patient_id").alias("admissions"),
        F.sum(F.col("length_of_stay").cast("long")).alias("stay_sum"),
        F.count("length_of_stay").alias("stay_count"),
        F.count_if("readmission_flag").alias("readmissions"),
        F.max("length_of_stay").alias("max_stay"),
    )
    ids = pairs.join(dictionary, ["name", "value"])
    bitmaps = ids.groupBy(
        "key", F.col("name").alias("part"), F.call_function("bitmap_bucket_number", "id").alias("slot")
    ).agg(F.call_function("bitmap_construct_agg", F.call_function("bitmap_bit_position", "id")).alias("bits"))
    return measures.withColumns({"part": F.lit(MEASURES), "slot": F.lit(0).cast("long")}).unionByName(
        bitmaps, allowMissingColumns=True
    )


def merged_states(states: DataFrame) -> DataFrame:
    """One state per key, part and slot, whatever number of them there was."""
    return states.groupBy(*STATE_KEYS).agg(
        *[F.max(c).alias(c) for c in GROUP],
        *[F.sum(c).alias(c) for c in SUMS],
        F.max("max_stay").alias("max_stay"),
        F.call_function("bitmap_or_agg", "bits").alias("bits"),
    )


def fold_batch(spark: SparkSession, path: str, admissions: DataFrame, batch: int, buckets: int = 256) -> bool:
    """Fold new ``admissions`` into the states at ``path``; False if the batch was folded before.

    The dictionary grows first: entries of a batch that then stops are found again by its repetition.
    """
    table, known = f"{path}/states", None
    if table_exists(spark, table):
        known = read_table(spark, table)
        if not known.where((F.col("part") == DONE) & (F.col("slot") == batch)).isEmpty():
            return False
    columns = ["length_of_stay", "readmission_flag", *COUNTED]
    rows = stage(
        _keyed(
            admissions.select(
                "hospital_id",
                F.year("admission_date").alias("admission_year"),
                F.month("admission_date").alias("admission_month"),
                *columns,
            )
        ),
        "fold",
    )
    named = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).alias("value")) for c in COUNTED])
    pairs = rows.select("key", F.inline(named)).where("value IS NOT NULL").distinct()
    pairs = stage(pairs, "fold-values")
    states = batch_states(rows, value_ids(spark, f"{path}/dictionary", pairs, buckets), pairs)
    marker = spark.createDataFrame([("", DONE, batch)], "key string, part string, slot bigint")
    states = states.unionByName(marker, allowMissingColumns=True)
    if known is not None:
        same = known.join(states.select(*STATE_KEYS).distinct(), list(STATE_KEYS), "left_semi")
        states = merged_states(states.unionByName(same))
    upsert_bucketed(spark, table, states.select(*STATE_KEYS, *GROUP, *SUMS, "max_stay", "bits"), STATE_KEYS, buckets, unique=True)
    return True


def current_metrics(spark: SparkSession, path: str, as_of: AsOf, run_date: AsOf) -> DataFrame:
    """The hospital metrics over all batches folded so far."""
    states = read_table(spark, f"{path}/states").where(F.col("part") != DONE)
    bits = F.call_function("bitmap_count", "bits")

    def measure(name: str) -> Column:
        return F.max(F.when(F.col("part") == MEASURES, F.col(name)))

    found = states.groupBy("key").agg(
        *[measure(c).alias(c) for c in (*GROUP, *SUMS, "max_stay")],
        *[F.coalesce(F.sum(F.when(F.col("part") == c, bits)), F.lit(0)).alias(name) for c, name in COUNTED.items()],
    )
    return found.withColumns(
        {
            "total_admissions": F.col("admissions"),
            "avg_length_of_stay": F.round(F.col("stay_sum") / F.when(F.col("stay_count") > 0, F.col("stay_count")), 2),
            "max_length_of_stay": F.col("max_stay"),
            "readmission_count": F.col("readmissions"),
            "readmission_rate_pct": share_pct(F.col("readmissions"), F.col("admissions"), 2),
            "_processed_at": as_of_timestamp(as_of),
            "_run_date": F.lit(str(run_date)[:10]).cast("date"),
        }
    ).select(*GOLD["agg_hospital_metrics"].names)
