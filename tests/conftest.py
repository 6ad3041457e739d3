from __future__ import annotations

import sys
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from salesmart.schema import SALES  # noqa: E402
from salesmart.session import local_session  # noqa: E402
from salesmart.sources.harness import sales_from_orders  # noqa: E402

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("spark")
    session = local_session(
        8,
        **{
            "spark.sql.warehouse.dir": str(folder / "warehouse"),
            "spark.checkpoint.dir": str(folder / "shared"),
            # Whole filter lists in printed plans.
            "spark.sql.maxMetadataStringLength": "2000",
        },
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def fact(spark, tmp_path_factory):
    """The fact over the sf0.01 tables, written once."""
    path = str(tmp_path_factory.mktemp("fact") / "sales.parquet")
    sales_from_orders(spark, SF_DIR).repartition(8).write.parquet(path)
    return spark.read.schema(SALES).parquet(path)


BASE = {
    "transaction_id": "T1",
    "customer_id": "CUST00001",
    "venue_id": "V1",
    "venue_name": "Venue 1",
    "venue_type": "Pub",
    "city": "Hull",
    "region": "North",
    "transaction_date": date(2024, 3, 1),
    "transaction_time": "12:00:00",
    "transaction_ts": datetime(2024, 3, 1, 12),
    "item_name": "Soup",
    "category": "Starters",
    "quantity": 1,
    "unit_price": Decimal("10.00"),
    "gross_amount": Decimal("10.00"),
    "discount_pct": 0,
    "discount_amount": Decimal("0.00"),
    "net_amount": Decimal("10.00"),
    "payment_method": "Card",
    "is_weekend": False,
    "day_of_week": "Friday",
    "month": "March",
    "month_num": 3,
    "loaded_at": datetime(2024, 3, 2, 6),
}


@pytest.fixture(scope="session")
def make_sales(spark):
    """Sales from a few changed fields per row; calendar fields follow ``ts``."""
    from pyspark.sql import types as T

    nullable = T.StructType([T.StructField(f.name, f.dataType) for f in SALES.fields])

    def make(*rows: dict):
        full = []
        for i, changes in enumerate(rows, start=1):
            row = BASE | {"transaction_id": f"T{i}"} | changes
            ts = row["transaction_ts"]
            if ts is not None:
                row["transaction_date"] = ts.date()
                row["transaction_time"] = ts.strftime("%H:%M:%S")
                row["day_of_week"] = ts.strftime("%A")
                row["month"] = ts.strftime("%B")
                row["month_num"] = ts.month
                row["is_weekend"] = ts.weekday() >= 5
            for column in ("unit_price", "gross_amount", "discount_amount", "net_amount"):
                if isinstance(row[column], (int, str)):
                    row[column] = Decimal(row[column])
            full.append(tuple(row[c] for c in SALES.names))
        return spark.createDataFrame(full, nullable)

    return make
