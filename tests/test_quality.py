"""Data-quality tests and the summary row."""

import pytest

from salesmart.operators import quality


@pytest.mark.parametrize(
    "rows,expected",
    [
        ([{}, {}], (2, 0, 0, 0, "PASSED")),
        ([], (0, None, 0, None, "FAILED")),
        ([{"net_amount": None}, {}], (2, 1, 0, 0, "FAILED")),
        ([{"net_amount": "-1.00"}, {}], (2, 0, 0, 1, "FAILED")),
        ([{"transaction_id": "T"}, {"transaction_id": "T"}], (2, 0, 1, 0, "FAILED")),
    ],
)
def test_summary(make_sales, rows, expected):
    assert tuple(quality.dq_summary(make_sales(*rows)).first()) == expected


def test_unique_ignores_null(make_sales):
    rows = make_sales(*[{"transaction_id": i} for i in ("A", "A", "B", None, None)])
    assert [tuple(r) for r in quality.unique(rows, "transaction_id").collect()] == [("A", 2)]


def test_not_null_names_each_column(make_sales):
    rows = make_sales({}, {"net_amount": None, "transaction_ts": None}, {"transaction_id": None})
    found = sorted((r.column_name, r.item_name) for r in quality.not_null(rows).collect())
    assert [name for name, _ in found] == ["net_amount", "transaction_id", "transaction_ts"]


def test_missing_values_are_looked_for_in_the_scan(fact):
    plan = quality.not_null(fact)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or(Or(IsNull(transaction_id),IsNull(transaction_ts)),IsNull(net_amount))]" in plan


def test_accepted_values_let_null_pass(make_sales):
    rows = make_sales({"venue_type": "Bar"}, {"venue_type": None}, {"venue_type": "Pub"})
    assert [tuple(r) for r in quality.accepted_values(rows, "venue_type").collect()] == [("Bar", 1)]


def test_source_tests(make_sales):
    rows = make_sales({"venue_type": "Bar"}, {"net_amount": None}, {"transaction_id": "T1"})
    assert {r.test_name: (r.failures, r.status) for r in quality.source_tests(rows).collect()} == {
        "unique_transaction_id": (1, "FAIL"),
        "not_null_transaction_id": (0, "PASS"),
        "not_null_transaction_ts": (0, "PASS"),
        "not_null_net_amount": (1, "FAIL"),
        "accepted_values_venue_type": (1, "FAIL"),
    }


def test_loaded_fact_passes(fact):
    assert {r.status for r in quality.source_tests(fact).collect()} == {"PASS"}
    assert quality.dq_summary(fact).first().check_status == "PASSED"
