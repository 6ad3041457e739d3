"""Visit histories extended load by load against full runs."""

import random
import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from salesmart.operators.guests import visit_history, visit_history_by_customer
from salesmart.operators.sequences import CUSTOMERS, SEGMENTS
from salesmart.plans import visit_store
from salesmart.sources import versions

FULL = {"customer_id": visit_history_by_customer, "customer_surrogate_id": visit_history}


def rows_of(df):
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=repr)


@pytest.fixture(scope="module")
def loads(make_sales):
    """Loads in mixed order: late rows, equal times, exact copies, new and repeated ids."""
    draw = random.Random(6)
    start = datetime(2024, 1, 1)
    out = []
    for day in (10, 20, 20, 5):
        rows = []
        for _ in range(60):
            rows.append({
                "transaction_id": f"T{draw.randrange(40)}",
                "customer_id": f"CUST{draw.choice([1, 1, 1, 2, 3, draw.randrange(4, 60)])}",
                "payment_method": draw.choice(["Card", "Cash"]),
                "city": draw.choice(["Hull", "York"]),
                "net_amount": draw.choice(["5.00", "7.00"]),
                "transaction_ts": start + timedelta(days=day + draw.randrange(3), hours=draw.randrange(3)),
            })
        rows += rows[:5] + (out[0][:4] if out else [])
        out.append(rows)
    return [make_sales(*rows) for rows in out]


@pytest.mark.parametrize("how", [CUSTOMERS, SEGMENTS], ids=["customer", "segment"])
@pytest.mark.parametrize("order", [(0, 1, 2, 3), (3, 2, 1, 0)], ids=["mixed", "backwards"])
def test_equal_to_a_full_run(spark, tmp_path, loads, how, order):
    base, so_far = str(tmp_path / "visits"), None
    for n, k in enumerate(order, 1):
        assert visit_store.extend(loads[k], base, how, rows_per_task=40) == n
        so_far = loads[k] if so_far is None else so_far.unionByName(loads[k])
    got = visit_store.history(spark, base, how)
    full = FULL[how.key_name](so_far)
    assert dict(got.dtypes) == dict(full.dtypes)
    assert rows_of(got) == rows_of(full)
    visit_store.compact(spark, base, how)
    assert rows_of(visit_store.history(spark, base, how)) == rows_of(full)
    visit_store.extend(loads[1], base, how)
    assert rows_of(visit_store.history(spark, base, how)) == rows_of(FULL[how.key_name](so_far.unionByName(loads[1])))


def test_a_load_in_time_reads_no_visits(spark, tmp_path, make_sales, monkeypatch):
    base = str(tmp_path / "visits")
    day = datetime(2024, 1, 1)
    visit_store.extend(make_sales(*[{"customer_id": f"C{i}", "transaction_ts": day} for i in range(50)]), base, CUSTOMERS)
    read = []
    real = visit_store._visits
    monkeypatch.setattr(visit_store, "_visits", lambda *a: read.append(a) or real(*a))
    visit_store.extend(make_sales({"customer_id": "C7", "transaction_ts": day + timedelta(days=1)}, {"customer_id": "new"}), base, CUSTOMERS)
    assert not read
    visit_store.extend(make_sales({"customer_id": "C7", "transaction_ts": day - timedelta(days=40)}), base, CUSTOMERS)
    assert len(read) == 1
    numbers = visit_store.history(spark, base, CUSTOMERS).where("customer_id = 'C7'").orderBy("transaction_ts")
    assert [(r.customer_visit_number, r.days_since_last_visit) for r in numbers.collect()] == [(1, None), (2, 40), (3, 1)]


def test_a_late_visit_reads_its_part_and_later_months(spark, tmp_path, make_sales):
    base = str(tmp_path / "visits")
    months = [datetime(2024, m, 3) for m in range(1, 7)]
    visit_store.extend(make_sales(*[{"customer_id": f"C{i}", "transaction_ts": t} for i in range(40) for t in months]), base, CUSTOMERS)
    batch = CUSTOMERS.visits(make_sales({"customer_id": "C7", "transaction_ts": datetime(2024, 4, 1)}))
    _, contents = versions.current(spark, base)
    state = visit_store._read(spark, base, contents["state"], visit_store._STATE)
    late = visit_store.sequences.late_keys(batch, state, "customer_id")
    known = visit_store.moved_candidates(spark, base, contents, CUSTOMERS, late, 1)
    plan = known._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: .*part#\d+ = \d+.*month#\d+ >= 2024-04-01", plan)
    assert "EqualTo(name,kC7)" in plan or "In(name" in plan
    files = {f.rsplit("/", 3)[1:3] and tuple(f.rsplit("/", 3)[1:3]) for f in known.inputFiles()}
    assert known.select("customer_id").distinct().count() == 1
    assert {r.customer_id for r in known.collect()} == {"C7"} and files


def test_a_failed_load_leaves_the_version_before(spark, tmp_path, make_sales):
    base = str(tmp_path / "visits")
    visit_store.extend(make_sales({"customer_id": "C1"}), base, CUSTOMERS)
    before = rows_of(visit_store.history(spark, base, CUSTOMERS))
    broken = make_sales({"customer_id": "C1"}).withColumn("net_amount", F.raise_error(F.lit("lost")).cast("decimal(8,2)"))
    with pytest.raises(Exception, match="lost"):
        visit_store.extend(broken, base, CUSTOMERS)
    assert rows_of(visit_store.history(spark, base, CUSTOMERS)) == before
    assert visit_store.extend(make_sales().limit(0), base, CUSTOMERS) == 1


def test_of_two_writers_one_is_refused(spark, tmp_path):
    base = str(tmp_path / "v")
    assert versions.current(spark, base) == (0, {})
    versions.commit(spark, base, 1, {"a": ["é"]})
    with pytest.raises(versions.Conflict):
        versions.commit(spark, base, 1, {"a": []})
    assert versions.current(spark, base) == (1, {"a": ["é"]})
