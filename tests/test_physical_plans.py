"""What must show in the physical plans, whatever the data size."""

import os

import pytest
from pyspark.sql import functions as F

from lakecare.catalog.queries import AS_OF, RUN_DATE, Lake
from lakecare.plans import gold, serving
from lakecare.sources import retail
from lakecare.sources.batch import incremental_filter

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scans(df):
    return [line for line in plan(df).splitlines() if "FileScan" in line]


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("gold"))
    lake = Lake(spark, FOLDER)
    lake.patients.write.parquet(f"{base}/patients")
    lake.fact.write.partitionBy("admission_year", "admission_month").parquet(f"{base}/fact")
    return base


def test_metrics_read_only_their_columns(spark, stored):
    patients = spark.read.parquet(f"{stored}/patients")
    (scan,) = scans(gold.agg_hospital_metrics(patients, AS_OF, RUN_DATE))
    read = set(scan.split("ReadSchema: struct<")[1].rstrip(">").replace("...", "").split(","))
    assert not any(c.startswith(("first_name", "date_of_birth", "insurance_id")) for c in read)
    assert "first_name" not in scan


def test_filters_reach_the_scan(spark, stored):
    patients = spark.read.parquet(f"{stored}/patients")
    since = incremental_filter(patients.select("patient_id", "attending_physician"), "attending_physician", "Dr. 5")
    (scan,) = scans(since)
    assert "GreaterThan(attending_physician,Dr. 5)" in scan
    (scan,) = scans(serving.ward_efficiency(spark.read.parquet(f"{stored}/fact").where("admission_year = 2000")))
    assert "PartitionFilters: [isnotnull(admission_year" in scan


def test_distinct_counts_spread_before_the_group_key(spark, stored):
    """The first shuffle of a distinct count is keyed by the counted value as well."""
    fact = spark.read.parquet(f"{stored}/fact")
    text = plan(fact.groupBy("ward").agg(F.count_distinct("patient_id").alias("n"), F.max("age").alias("m")))
    exchanges = [line for line in text.splitlines() if "Exchange hashpartitioning" in line]
    assert any("patient_id" in line and "ward" in line for line in exchanges)
    text = plan(serving.ward_efficiency(fact))
    exchanges = [line for line in text.splitlines() if "Exchange hashpartitioning" in line]
    assert any("patient_id" in line and "attending_physician" in line for line in exchanges)


@pytest.mark.parametrize("view", ["dashboard", "fact", "financial", "features"])
def test_no_cross_or_nested_loop_joins(spark, view):
    text = plan(getattr(Lake(spark, FOLDER), view))
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_only_tables_with_too_few_splits_are_redistributed(spark, tmp_path):
    few = retail.spread_table(spark, FOLDER, "orders", retail.ORDERS, ("o_orderkey",))
    assert "Exchange" in plan(few)
    retail.table(spark, FOLDER, "orders").repartition(40).write.parquet(f"{tmp_path}/orders.parquet")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        many = retail.spread_table(spark, str(tmp_path), "orders", retail.ORDERS, ("o_orderkey",))
        assert "Exchange" not in plan(many)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
