"""Raw claims from hand-made retail tables: exact money, gaps, and what is made once an order or part."""

import datetime as dt
from decimal import ROUND_HALF_UP, Decimal

import pytest

from lakecare.sources import retail

DAY = dt.datetime(1995, 2, 28)
LINES = [  # order, line, quantity, price, discount
    (1, 1, 2.0, 901.05, 0.04), (1, 1, 2.0, 901.05, 0.04), (1, 7, 1.0, 55.5, 0.1), (2, 2, 17.0, 104949.995, 0.005),
    (2, 3, None, 33.33, None), (2, 4, 3.0, None, 0.07), (3, 7, 1.0, 1e12, 0.0), (9, 1, 1.0, 1e12, 0.0), (2, 6, 1.0, -0.05, 0.0),
]


@pytest.fixture
def tables(spark, folder):
    def put(name, rows, layout):
        spark.createDataFrame(rows, layout).write.parquet(f"{folder}/{name}.parquet")

    put("customer", [(5, "c5", 3, "BUILDING"), (11, "c11", None, "auto")], "c_custkey long, c_name string, c_nationkey int, c_mktsegment string")
    put(
        "orders",
        [(1, 5, "F", 1.0, DAY, "1-URGENT"), (2, 11, "O", 2.0, None, "2-HIGH"), (3, 5, "P", 3.0, DAY, None)],
        "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string",
    )
    put("part", [(4, "b", "t", None)], "p_partkey long, p_brand string, p_type string, p_size int")
    put(
        "lineitem",
        [(o, 4, 8, n, q, p, d, "N", "F", DAY) for o, n, q, p, d in LINES],
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
        "l_discount double, l_returnflag string, l_linestatus string, l_shipdate timestamp",
    )
    return folder


def exact(line):
    """Ten times the price to cents, times the covered and the own share, as decimals."""
    _, n, q, price, discount = line
    if n == 7 and q == 1:
        return 0.0, 0.0, 0.0
    cents = Decimal("0.01")
    total = None if price is None else Decimal(str(price)).quantize(cents, ROUND_HALF_UP) * 10
    share = None if discount is None else Decimal(str(discount)).quantize(cents, ROUND_HALF_UP)
    parts = (None, None) if total is None or share is None else (float(total * (1 - share)), float(total * share))
    return (None if total is None else float(total), *parts)


def test_claims_keep_exact_money_gaps_and_copies(spark, tables):
    got = retail.bronze_claims(spark, tables).collect()
    want = [(f"CLM-{line[0]}-{line[1]}", *exact(line)) for line in LINES if line[0] != 9]
    found = [(r.claim_id, r.total_amount, r.insurance_covered, r.patient_copay) for r in got]
    assert sorted(found, key=repr) == sorted(want, key=repr)
    first = next(r for r in got if r.claim_id == "CLM-1-1")
    assert (first.patient_id, first.hospital_id, first.admission_date, first.discharge_date) == ("P-5", "HOSP-3", "1995-02-28", "1995-03-01")
    assert (first.procedure_code, first.insurance_provider, first.record_id, first.processed_date) == (None, "b", "4:8:2", "NULL")
    second = next(r for r in got if r.claim_id == "CLM-2-2")
    assert (second.patient_id, second.hospital_id, second.admission_date, second.diagnosis_code) == ("P-11", None, None, "auto")


def test_money_is_converted_once_and_visits_are_written_out_below_the_lines(spark, tables):
    text = retail.bronze_claims(spark, tables)._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("as decimal(12,2)") == 1 and text.count("as decimal(4,2)") == 1
    assert text.index("Join") < text.index("AS patient_id")
