"""Reports from one scan against the same reports from a scan each."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from salesmart.operators import reports, sales

ALONE = {
    "daily_revenue": sales.daily_revenue_weekend_split,
    "category_performance": sales.category_performance,
    "top_items": sales.top_items_ranked,
    "payment_split": sales.payment_split,
    "monthly_trend": sales.monthly_trend_all_years,
}


def rows(df):
    columns = sorted(df.columns)
    return columns, sorted(map(repr, df.select(columns).collect()))


@pytest.fixture(scope="module")
def awkward(fact):
    """Null groups, null measures and repeated rows."""
    part = fact.limit(300)
    nulls = ["venue_name", "payment_method", "item_name", "transaction_date", "month", "net_amount", "quantity", "is_weekend"]
    blank = [part.limit(20).withColumn(c, F.lit(None).cast(part.schema[c].dataType)) for c in nulls]
    for one in blank:
        part = part.union(one.select(part.columns))
    return part.union(part.limit(50))


@pytest.mark.parametrize("name", ALONE)
def test_equal_to_a_scan_each(fact, name):
    found = reports.all_reports(fact)[name]
    assert rows(found) == rows(ALONE[name](fact))
    assert {f.name: f.dataType for f in found.schema} == {f.name: f.dataType for f in ALONE[name](fact).schema}


def test_null_groups_and_repeated_rows(spark, awkward, tmp_path):
    awkward.write.parquet(str(tmp_path / "sales"))
    fact = spark.read.parquet(str(tmp_path / "sales"))
    found = reports.all_reports(fact)
    for name, alone in ALONE.items():
        assert rows(found[name]) == rows(alone(fact)), name


def test_one_scan_one_shuffle(fact):
    plan = reports.grouped(fact)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1
    raw = set(fact.inputFiles())
    for found in reports.all_reports(fact).values():
        assert not raw & set(found.inputFiles())


def test_no_sales(fact):
    for name, found in reports.all_reports(fact.limit(0)).items():
        assert found.collect() == [], name
