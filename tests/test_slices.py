"""Loads and refreshes done slice by slice, and what they leave on disk."""

from datetime import datetime, timedelta

import pytest

from salesmart.operators.guests import fct_retention, visit_history_by_customer
from salesmart.operators.marts import MART_COLUMNS, fct_venue_performance
from salesmart.operators.sequences import CUSTOMERS
from salesmart.operators.staging import stg_transactions
from salesmart.plans import catalog, refresh, visit_store
from salesmart.sources import shared, versions


def rows_of(df):
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=repr)


def sold(i, month, year=2024):
    # Guests repeat, one has no id, some visits have equal times.
    guest = None if i % 7 == 6 else f"C{i % 7}"
    return {"transaction_id": f"T{i % 9}", "customer_id": guest, "venue_id": f"V{i % 2}", "transaction_ts": datetime(year, month, 1 + i % 5)}


@pytest.fixture(scope="module")
def loads(make_sales):
    months = [(5, 8), (2, 6), (3, 3)]
    rows = [[sold(i, m) for i in range(14) for m in range(a, b + 1)] for a, b in months]
    # A guest who is never late, beside those who are.
    rows[0] += [{"customer_id": f"in time {i}", "transaction_ts": datetime(2024, 8, 2)} for i in range(9)]
    return [make_sales(*r) for r in rows]


def test_many_late_guests_leave_nothing_to_join(spark, tmp_path, loads, monkeypatch):
    monkeypatch.setattr(visit_store, "BROADCAST_ROWS", 3)
    monkeypatch.setattr(visit_store, "ROWS_PER_SLICE", 60)
    base, so_far = str(tmp_path / "visits"), None
    for n, load in enumerate(loads, 1):
        assert visit_store.extend(load, base, CUSTOMERS) == n
        so_far = load if so_far is None else so_far.unionByName(load)
    history, full = visit_store.history(spark, base, CUSTOMERS), rows_of(visit_history_by_customer(so_far))
    assert rows_of(history) == full
    assert "Join" not in history._jdf.queryExecution().executedPlan().toString()
    _, contents = versions.current(spark, base)
    assert "moves" not in contents and len(contents["rewritten"]) == 2
    # One late guest is noted as before, beside folders written anew.
    late = loads[0].where("customer_id = 'C1'").limit(1).withColumn("transaction_ts", loads[0]["transaction_ts"] - timedelta(days=70))
    visit_store.extend(late, base, CUSTOMERS)
    assert versions.current(spark, base)[1]["moved_keys"] == 1
    full = rows_of(visit_history_by_customer(so_far.unionByName(late)))
    assert rows_of(visit_store.history(spark, base, CUSTOMERS)) == full
    visit_store.compact(spark, base, CUSTOMERS)
    assert "rewritten" not in versions.current(spark, base)[1]
    assert rows_of(visit_store.history(spark, base, CUSTOMERS)) == full


def test_parts_of_a_load():
    assert visit_store._slices(1) == [list(range(visit_store.PARTS))]
    for n in (2, 3, 8, 100):
        slices = visit_store._slices(n)
        assert len(slices) == min(n, visit_store.PARTS) and sorted(sum(slices, [])) == list(range(visit_store.PARTS))


def test_retention_in_slices_of_months(spark, tmp_path, loads, monkeypatch):
    monkeypatch.setattr(refresh, "ROWS_PER_SLICE", 30)
    written, real = [], refresh._replace_parts
    monkeypatch.setattr(refresh, "_replace_parts", lambda *a, **k: written.append(a) or real(*a, **k))
    visits, folder = str(tmp_path / "visits"), str(tmp_path / "retention")
    refresh.refresh_retention(spark, visits, folder, CUSTOMERS, [visit_store.extend(loads[0], visits, CUSTOMERS)])
    # Months of 14, 14, 14 and 23 visits.
    assert len(written) in (2, 3)
    assert rows_of(refresh.read_retention(spark, folder)) == rows_of(fct_retention(visit_history_by_customer(loads[0])))


def test_venues_in_slices_of_parts(spark, tmp_path, loads, monkeypatch):
    written, real = [], refresh._replace_parts
    monkeypatch.setattr(refresh, "_replace_parts", lambda *a, **k: written.append(a) or real(*a, **k))
    raw = loads[0].select(*MART_COLUMNS, "transaction_date")
    days = [r[0] for r in raw.select("transaction_date").distinct().collect()]
    monkeypatch.setattr(refresh, "ROWS_PER_SLICE", 30)
    refresh.refresh_venue_performance(raw, str(tmp_path / "venues"), days)
    assert len(written) > 1
    assert rows_of(refresh.read_venue_performance(spark, str(tmp_path / "venues"))) == rows_of(fct_venue_performance(stg_transactions(loads[0])))


def test_parts_fill_slices(monkeypatch):
    monkeypatch.setattr(refresh, "ROWS_PER_SLICE", 10)
    assert refresh._slices({"a": 4, "b": 6, "c": 1, "d": 12, None: 3}) == [["a", "b"], ["c"], ["d"], [None]]


def test_refreshed_venues_store_what_the_mart_needs_and_drop_it(spark, loads, monkeypatch):
    stored, real = [], shared.new_path
    monkeypatch.setattr(shared, "new_path", lambda s, name: stored.append(real(s, name)) or stored[-1])
    monkeypatch.setattr(catalog, "LOADS", [(2024, 2024)])
    mart = catalog._refreshed_venues(loads[0])
    assert len(stored) == 1 and not versions.exists(spark, stored[0])
    assert rows_of(mart) == rows_of(fct_venue_performance(stg_transactions(loads[0])))


def test_shuffled_files_go_with_their_query(spark):
    before = spark.conf.get(shared.DROP_SHUFFLES)
    with shared.scratch(spark):
        assert spark.conf.get(shared.DROP_SHUFFLES) == "true"
        with shared.scratch(spark):
            pass
        assert spark.conf.get(shared.DROP_SHUFFLES) == "true"
    assert spark.conf.get(shared.DROP_SHUFFLES) == before
