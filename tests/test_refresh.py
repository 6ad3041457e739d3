"""Reports refreshed by touched parts against rebuilds."""

import random
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from salesmart.operators.guests import fct_retention, visit_history_by_customer
from salesmart.operators.marts import fct_venue_performance
from salesmart.operators.sales import daily_revenue_weekend_split
from salesmart.operators.sequences import CUSTOMERS
from salesmart.operators.staging import stg_transactions
from salesmart.plans import refresh
from salesmart.sources import tables


def rows_of(df):
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=repr)


def files(folder):
    return {str(p.relative_to(folder)) for p in Path(folder).rglob("*.parquet")}


def same(spark, base, raw):
    assert rows_of(refresh.read_daily_revenue(spark, f"{base}/daily")) == rows_of(daily_revenue_weekend_split(raw))
    assert rows_of(refresh.read_venue_performance(spark, f"{base}/venues")) == rows_of(fct_venue_performance(stg_transactions(raw)))
    assert rows_of(refresh.read_retention(spark, f"{base}/retention")) == rows_of(fct_retention(visit_history_by_customer(raw)))


def test_equal_to_a_rebuild_after_each_load(spark, make_sales, tmp_path):
    draw, base, start = random.Random(8), str(tmp_path / "reports"), datetime(2023, 1, 30)
    tables.replace_sales_table(spark, "refreshed_sales")
    for load in range(10):
        stamp = datetime(2024, 5, 1 + load, 6)
        rows = [
            {
                # Ids repeat on other days of the same weekday and month, and within a day.
                "transaction_id": f"T{draw.randrange(30)}",
                "customer_id": f"C{draw.randrange(6)}",
                "venue_id": f"V{draw.randrange(2)}",
                "quantity": draw.randrange(1, 4),
                "transaction_ts": start + timedelta(days=7 * draw.randrange(4) + load % 3 + 365 * (draw.random() < 0.2), hours=draw.randrange(4)),
                "loaded_at": stamp,
            }
            for _ in range(12)
        ]
        tables.append_rows(make_sales(*rows), "refreshed_sales")
        spark.catalog.refreshTable("refreshed_sales")
        raw = tables.read_sales_table(spark, "refreshed_sales", load_day=True)
        before = files(base)
        days = refresh.refresh_all(raw, base, CUSTOMERS, since=stamp)
        assert days == sorted({r["transaction_ts"].date() for r in rows})
        after = files(base)
        touched = {f"daily/transaction_date={d}" for d in days} | {f"venues/part_month={d.month}/part_weekday={d.weekday()}" for d in days}
        gone = {f for f in before - after if not f.startswith("retention")}
        assert all(any(f.startswith(t + "/") for t in touched) for f in gone)
        if load in (0, 4, 9):
            same(spark, base, raw.drop("loaded_on"))
    # A refresh that is done again changes no row.
    refresh.refresh_all(raw, base, CUSTOMERS, since=stamp)
    same(spark, base, raw.drop("loaded_on"))


def test_only_touched_days_are_read(spark, make_sales, tmp_path):
    tables.replace_sales_table(spark, "read_sales")
    tables.append_rows(make_sales(*[{"transaction_ts": datetime(2024, 3, d, 9)} for d in range(1, 20)]), "read_sales")
    raw = tables.read_sales_table(spark, "read_sales")
    month, weekday = refresh._venue_parts(F.col("transaction_date"))
    plan = raw.filter((month * 7 + weekday).isin(25))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "month(transaction_date" in plan.split("PartitionFilters: ")[1].split("]")[0]
    assert refresh.touched_days(make_sales({"loaded_at": datetime(2024, 1, 1)}), datetime(2024, 1, 2)) == []


def test_a_lost_refresh_is_done_again(spark, make_sales, tmp_path, monkeypatch):
    base, stamp = str(tmp_path / "reports"), datetime(2024, 5, 1)
    raw = make_sales(*[{"customer_id": f"C{i % 2}", "loaded_at": stamp, "transaction_ts": datetime(2024, 3, 1 + i)} for i in range(4)])
    for step in ("refresh_venue_performance", "refresh_retention"):
        with monkeypatch.context() as patch, pytest.raises(KeyError):
            patch.setattr(refresh, step, lambda *a, **k: {}["lost"])
            refresh.refresh_all(raw, base, CUSTOMERS, since=stamp)
    refresh.refresh_all(raw, base, CUSTOMERS, since=stamp)
    same(spark, base, raw)
