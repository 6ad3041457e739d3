"""What the joins and shuffles of large tables carry."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_DIR
from salesmart.operators import sequences
from salesmart.operators.marts import fct_venue_performance
from salesmart.operators.sequences import CUSTOMERS, NUMBER, ORDER
from salesmart.operators.staging import stg_transactions
from salesmart.plans import catalog
from salesmart.schema import LOAD_COLUMNS
from salesmart.sources import csv_sales
from salesmart.sources.harness import sales_from_orders


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows_of(df):
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=repr)


def test_lines_are_shuffled_as_numbers(spark):
    plan = plan_of(sales_from_orders(spark, SF_DIR))
    assert plan.count("SortMergeJoin") == 2 and plan.count("BroadcastHashJoin") == 3
    assert "hashpartitioning(l_suppkey" not in plan and "hashpartitioning(s_suppkey" not in plan
    # The join to the parts comes after that to the orders, so nothing with a name moves.
    assert plan.index("hashpartitioning(l_partkey") < plan.index("hashpartitioning(l_orderkey")


def test_small_tables_take_the_plan_of_large_ones(spark):
    plan = plan_of(catalog.queries()["dash_category"](spark, SF_DIR))
    assert plan.count("SortMergeJoin") == 2 and plan.count("BroadcastHashJoin") == 3


def test_the_venue_mart_moves_rows_once(fact):
    assert plan_of(fct_venue_performance(stg_transactions(fact))).count("Exchange") == 1
    assert plan_of(fct_venue_performance(stg_transactions(fact), pieces=3)).count("Exchange") == 1


def test_the_venue_mart_in_pieces(make_sales):
    rows = [
        {"transaction_id": f"T{i % 7}", "venue_id": f"V{i % 3}", "item_name": [None, "Soup"][i % 2], "city": ["Hull", None][i % 5 == 0]}
        for i in range(40)
    ]
    staged = stg_transactions(make_sales(*rows))
    whole = fct_venue_performance(staged)
    assert rows_of(fct_venue_performance(staged, pieces=3)) == rows_of(whole)
    keys = {(r["venue_id"], r["item_name"], r["city"]) for r in rows}
    assert whole.count() == len(keys)
    for row in whole.collect():
        ids = {r["transaction_id"] for r in rows if (r["venue_id"], r["item_name"], r["city"]) == (row.venue_id, row.item_name, row.city)}
        assert row.total_transactions == len(ids)


@pytest.fixture
def shuffled_joins(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_a_load_is_shuffled_once_for_its_numbers(spark, make_sales, shuffled_joins):
    batch = CUSTOMERS.visits(make_sales({"customer_id": None}, {"customer_id": ""}, {"customer_id": "C1"}, {"customer_id": "C1"}))
    state = sequences.state_of(CUSTOMERS.visits(make_sales({"customer_id": "C1"}, {"customer_id": None})), "customer_id").localCheckpoint()
    numbered = sequences.continued(batch, state, None, CUSTOMERS)
    assert plan_of(numbered).count("Exchange") == 2
    assert sorted((r.customer_id or repr(r.customer_id), r[NUMBER]) for r in numbered.collect()) == [("''", 1), ("C1", 2), ("C1", 3), ("None", 2)]


def test_joins_of_visits_carry_no_place(make_sales, shuffled_joins):
    visits = CUSTOMERS.visits(make_sales({"customer_id": "C1"}, {"customer_id": None})).withColumn("version", F.lit(1))
    late = visits.select(sequences.name_of("customer_id").alias("name"), sequences.place().alias("since"))
    moved = sequences.moved_visits(visits.select(*ORDER, "customer_id"), late, "customer_id")
    kept = sequences.live(visits, late.withColumn("version", F.lit(2)), "customer_id")
    for df in (moved, kept):
        assert "__place" not in plan_of(df)
    assert moved.isEmpty() and kept.count() == 2


def test_the_csv_round_trip_is_compressed(spark, fact, tmp_path, monkeypatch):
    written = []
    real = csv_sales.read_sales_csv
    monkeypatch.setattr(csv_sales, "read_sales_csv", lambda s, path: written.append(path) or real(s, path))
    some = fact.filter("venue_id = 'V7'")
    back = catalog._through_csv(some)
    assert rows_of(back) == rows_of(some.select(*LOAD_COLUMNS))
    assert written and all(f.endswith(".csv.gz") for f in spark.read.text(written[0]).inputFiles())


def test_compressed_files_are_bounded(spark, fact, tmp_path, monkeypatch):
    monkeypatch.setattr(csv_sales, "ROWS_PER_FILE", 10)
    some = fact.limit(35).select(*LOAD_COLUMNS).coalesce(1)
    csv_sales.write_sales_csv(some, str(tmp_path / "out"), compression="gzip")
    assert len(spark.read.text(str(tmp_path / "out")).inputFiles()) == 4
    assert csv_sales.read_sales_csv(spark, str(tmp_path / "out")).count() == 35
