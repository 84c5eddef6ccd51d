"""A cross-section of registered queries against their SQL on the smallest data."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from catalog import base
from catalog.compare import check, connect

SF = "/root/testdata/sf0.001"
NAMES = [
    "j5_payments_fact", "j6_attendance_fact", "q5_top_events_by_revenue", "t1_flatten_events",
    "t6_flatten_guests", "t11_flatten_payments", "j9_ticket_sales_view", "j11_crossover_fuzzy",
    "a26_sales_summary", "x1_split_iso", "s3_s6_s13_snapshots",
]
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, duck, name):
    assert check(spark, duck, name, queries()[name], oracle_sql()[name], SF) == ""


def test_every_query_has_sql():
    queries()
    assert set(base.QUERIES) == set(base.ORACLES)


def test_entry_runs(spark):
    assert entry(spark).count() > 0


def test_latest_export_keeps_its_parts(spark, tmp_path):
    names = {"supplier": "s_suppkey long, s_name string", "customer": "c_custkey long, c_name string"}
    for name, columns in names.items():
        rows = spark.createDataFrame([(i, f"{name} {i}") for i in range(40)], columns)
        rows.repartition(4).write.parquet(f"{tmp_path}/{name}.parquet")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        found = queries()["s6_latest_file"](spark, str(tmp_path))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(found.inputFiles()) > 1
    assert sorted(map(tuple, found.collect())) == [(i, f"customer {i}") for i in range(40)]
