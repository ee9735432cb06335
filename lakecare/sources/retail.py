"""Raw clinical tables derived from the retail test tables.

Each retail order is an admission of its customer, each line item a claim and each event a
vitals reading. The raw text is deliberately untidy: padded and mixed-case codes,
misspelled genders, missing discharges, the word NULL and dates that do not parse.
``record_id`` identifies a raw row and breaks ties.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


ORDERS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
LINES = (
    "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
    "l_returnflag", "l_linestatus", "l_shipdate",
)
EVENTS = ("event_id", "ts", "user_id", "event_type")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread_table(
    spark: SparkSession, folder: str, name: str, columns: tuple[str, ...], by: tuple[str, ...]
) -> DataFrame:
    """The columns of a large table, on all cores.

    A file of one row group is read by one task however many cores wait, and everything up
    to the first shuffle stays there. A table with fewer splits than cores, at most a few hundred
    megabytes, is redistributed by a hash of the columns that tell its rows apart.
    """
    rows = table(spark, folder, name).select(*columns)
    cores = spark.sparkContext.defaultParallelism
    return rows if rows.rdd.getNumPartitions() >= cores else rows.repartition(cores, *by)


def stream_path(folder: str, name: str) -> str:
    """A glob for the table: a file stream takes a single file only through a glob."""
    return f"{folder}/{name}.parque[t]"


def _text(*parts: Column | str) -> Column:
    return F.concat(*[p.cast("string") if isinstance(p, Column) else F.lit(p) for p in parts])


def _iso(day: Column) -> Column:
    return day.cast("string")


def _cycle(values: Column, n: int) -> Column:
    return (values % n).cast("int")


def _units(amount: Column, scale: int, kind: str) -> Column:
    """An amount as a whole number of its last decimal place; conversion as to the decimal ``kind``."""
    return (amount.cast(kind) * 10**scale).cast("long")


def _raw_code() -> Column:
    proper = _text(
        " ",
        F.lower(F.substring("c_mktsegment", 1, 1)),
        F.lpad(F.col("c_nationkey").cast("string"), 2, "0"),
        ".",
        F.col("c_custkey") % 3,
        " ",
    )
    return F.when(F.col("c_custkey") % 11 == 0, F.lower("c_mktsegment")).otherwise(proper)


def bronze_patients(spark: SparkSession, folder: str) -> DataFrame:
    customer, key = F.col("c_custkey"), F.col("o_orderkey")
    admitted = F.to_date("o_orderdate")
    born = F.date_add(F.lit("1910-01-01").cast("date"), _cycle(customer * 37, 33000))
    gender = (
        F.when(customer % 17 == 0, F.lit(None).cast("string"))
        .when(customer % 5 == 0, " m")
        .when(customer % 5 == 1, "FEMALE")
        .when(customer % 5 == 2, "F ")
        .when(customer % 5 == 3, "male")
        .otherwise("x")
    )
    visits = spread_table(spark, folder, "orders", ORDERS, ("o_orderkey",)).join(
        table(spark, folder, "customer"), F.col("o_custkey") == customer
    )
    return visits.select(
        _text("P-", customer).alias("patient_id"),
        _text("First ", customer).alias("first_name"),
        F.col("c_name").alias("last_name"),
        F.when(customer % 251 == 0, "unknown").otherwise(_iso(born)).alias("date_of_birth"),
        gender.alias("gender"),
        _raw_code().alias("diagnosis_code"),
        _text(F.col("c_mktsegment"), " condition ", customer % 2).alias("diagnosis_description"),
        F.when(key % 997 == 5, "not-a-date").otherwise(_iso(admitted)).alias("admission_date"),
        F.when(key % 53 != 7, _iso(F.date_add(admitted, _cycle(key, 21)))).alias("discharge_date"),
        _text("Dr. ", key % 97).alias("attending_physician"),
        _text(" hosp-", F.col("c_nationkey"), " ").alias("hospital_id"),
        _text("Insurer ", customer % 8).alias("insurance_provider"),
        _text("INS-", customer).alias("insurance_id"),
        F.col("o_orderpriority").alias("ward"),
        F.when(F.col("o_orderstatus") == "F", 1).when(F.col("o_orderstatus") == "O", 0).alias("readmission_flag"),
        _iso(F.date_add(admitted, _cycle(key, 30))).alias("last_modified_date"),
        F.col("o_totalprice").alias("total_amount"),
        key.alias("record_id"),
    )


def bronze_claims(spark: SparkSession, folder: str) -> DataFrame:
    empty = (F.col("l_linenumber") == 7) & (F.col("l_quantity") == 1)
    admitted, shipped = F.to_date("o_orderdate"), F.to_date("l_shipdate")
    # Orders meet their customers before the lines come in: the many rows are not dealt out once more for it,
    # and what customer, order or part alone decides is made once for each of them.
    people = table(spark, folder, "customer").select(
        "c_custkey",
        _text("P-", F.col("c_custkey")).alias("patient_id"),
        _text("HOSP-", F.col("c_nationkey")).alias("hospital_id"),
        _raw_code().alias("diagnosis_code"),
    )
    visits = table(spark, folder, "orders").join(people, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey",
        "patient_id",
        "hospital_id",
        _iso(admitted).alias("admission_date"),
        _iso(F.date_add(admitted, _cycle(F.col("o_orderkey"), 21))).alias("discharge_date"),
        "diagnosis_code",
    )
    parts = table(spark, folder, "part").select(
        "p_partkey",
        _text("PX-", F.col("p_size")).alias("procedure_code"),
        F.col("p_type").alias("procedure_description"),
        F.col("p_brand").alias("insurance_provider"),
    )
    # Money in whole cents and shares in whole hundredths: converted once, exact in a long, divided once.
    price, discount = _units(F.col("l_extendedprice"), 2, "decimal(12,2)"), _units(F.col("l_discount"), 2, "decimal(4,2)")
    rows = (
        spread_table(spark, folder, "lineitem", LINES, LINES[:4])
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .join(visits, F.col("l_orderkey") == F.col("o_orderkey"))
        .withColumns({c: F.when(empty, F.lit(0)).otherwise(units) for c, units in (("cents", price), ("share", discount))})
    )
    cents, share = F.col("cents"), F.col("share")

    def money(units: Column, per: int) -> Column:
        return F.when(empty, 0.0).otherwise(units.cast("double") / F.lit(float(per)))

    return rows.select(
        _text("CLM-", F.col("l_orderkey"), "-", F.col("l_linenumber")).alias("claim_id"),
        "patient_id",
        "hospital_id",
        "admission_date",
        "discharge_date",
        "diagnosis_code",
        "procedure_code",
        "procedure_description",
        money(cents, 10).alias("total_amount"),
        money(cents * (100 - share), 1000).alias("insurance_covered"),
        money(cents * share, 1000).alias("patient_copay"),
        F.when(F.col("l_returnflag") == "A", " approved")
        .when(F.col("l_returnflag") == "R", "Denied ")
        .otherwise("PENDING")
        .alias("claim_status"),
        _iso(shipped).alias("submitted_date"),
        F.when(F.col("l_returnflag") == "N", "NULL")
        .otherwise(_iso(F.date_add(shipped, _cycle(F.col("l_quantity"), 15))))
        .alias("processed_date"),
        "insurance_provider",
        F.when(F.col("l_linestatus") == "F", "inpatient ").otherwise("Outpatient").alias("claim_type"),
        _text(F.col("l_partkey"), ":", F.col("l_suppkey"), ":", F.col("l_quantity").cast("int")).alias("record_id"),
    )


def vitals_of(events: DataFrame, *carried: str) -> DataFrame:
    """Vitals readings of an events frame, batch or streaming, after the carried columns."""
    key = F.col("event_id")
    return events.select(
        *carried,
        _text("P-", F.col("user_id")).alias("patient_id"),
        _text("DEV-", key % 20).alias("device_id"),
        F.col("event_type").alias("ward_id"),
        _text("HOSP-", F.col("user_id") % 25).alias("hospital_id"),
        F.col("ts").alias("event_time"),
        F.when(key % 37 != 0, 35 + _cycle(key, 130)).alias("heart_rate"),
        (90 + _cycle(key, 100)).alias("blood_pressure_systolic"),
        (55 + _cycle(key, 50)).alias("blood_pressure_diastolic"),
        F.when(key % 41 != 0, (85 + _cycle(key, 16)).cast("double")).alias("spo2"),
        (36 + (key % 10) / 2).cast("double").alias("temperature"),
        (10 + _cycle(key, 20)).alias("respiratory_rate"),
        (70 + _cycle(key, 120)).alias("glucose_level"),
    )


def vitals(spark: SparkSession, folder: str) -> DataFrame:
    return vitals_of(spread_table(spark, folder, "events", EVENTS, ("event_id",)))
