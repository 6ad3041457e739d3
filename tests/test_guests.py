"""Visit sequences, loyalty bands, retention and the dashboard."""

from datetime import date, datetime, timedelta
from decimal import Decimal

from pyspark.sql import functions as F

from salesmart.functions.guests import segment_key
from salesmart.operators import dashboard
from salesmart.operators.guests import fct_retention, visit_history, visit_history_by_customer
from salesmart.operators.marts import fct_venue_performance
from salesmart.operators.staging import stg_transactions

DAY = timedelta(days=1)
START = datetime(2024, 1, 1, 12)


def visits_after(make_sales, *gaps, **changes):
    moments = [START]
    for gap in gaps:
        moments.append(moments[-1] + gap)
    return make_sales(*[{"transaction_ts": m} | changes for m in moments])


def by_number(df, *columns):
    return [tuple(r) for r in df.orderBy("customer_visit_number").select(*columns).collect()]


def test_segments(make_sales):
    rows = visits_after(make_sales, 0 * DAY, 7 * DAY, 8 * DAY, 30 * DAY, 31 * DAY)
    history = visit_history(stg_transactions(rows))
    assert by_number(history, "days_since_last_visit", "customer_loyalty_segment") == [
        (None, "New Guest"),
        (0, "High-Frequency Loyal"),
        (7, "High-Frequency Loyal"),
        (8, "Standard Returning"),
        (30, "Standard Returning"),
        (31, "Churned / Reactivated Guest"),
    ]


def test_customer_bands(make_sales):
    rows = visits_after(make_sales, 30 * DAY, 31 * DAY, 90 * DAY, 91 * DAY, 180 * DAY, 181 * DAY)
    history = visit_history_by_customer(rows)
    bands = [r[0] for r in by_number(history, "customer_loyalty_segment")]
    assert bands == ["New Guest", "<=30d", "<=90d", "<=90d", "<=180d", "<=180d", ">180d"]


def test_midnight_between_visits_is_a_day(make_sales):
    rows = make_sales(
        {"transaction_ts": datetime(2024, 1, 1, 23, 59)}, {"transaction_ts": datetime(2024, 1, 2, 0, 1)}
    )
    assert by_number(visit_history(stg_transactions(rows)), "days_since_last_visit") == [(None,), (1,)]


def test_equal_times_are_ordered_by_id(make_sales):
    rows = make_sales({"transaction_id": "B"}, {"transaction_id": "A"})
    history = visit_history(stg_transactions(rows))
    assert by_number(history, "transaction_id", "customer_visit_number") == [("A", 1), ("B", 2)]


def test_key_has_no_separator_and_passes_null_on(make_sales):
    rows = make_sales({}, {"city": None})
    keys = [r[0] for r in rows.orderBy("transaction_id").select(segment_key()).collect()]
    assert keys[0] == rows.select(F.md5(F.lit("CardHullPub"))).first()[0]
    assert keys[1] is None


def test_numbers_have_no_gaps(fact):
    for history, key in (
        (visit_history(stg_transactions(fact)), "customer_surrogate_id"),
        (visit_history_by_customer(fact), "customer_id"),
    ):
        per_key = history.groupBy(key).agg(
            F.count("*").alias("n"),
            F.count_distinct("customer_visit_number").alias("numbers"),
            F.min("customer_visit_number").alias("low"),
            F.max("customer_visit_number").alias("high"),
            F.count_if(F.col("customer_loyalty_segment") == "New Guest").alias("new"),
        )
        assert per_key.filter("low != 1 OR high != n OR numbers != n OR new != 1").isEmpty()


def test_retention(make_sales):
    rows = visits_after(make_sales, 1 * DAY, 2 * DAY, 40 * DAY, net_amount="10.01")
    mart = fct_retention(visit_history(stg_transactions(rows)))
    assert [tuple(r) for r in mart.collect()] == [
        (date(2024, 2, 1), "Pub", "Churned / Reactivated Guest", 1, Decimal("10.01"), 40.0, Decimal("10.01")),
        (date(2024, 1, 1), "Pub", "High-Frequency Loyal", 2, Decimal("20.02"), 1.5, Decimal("10.01")),
        (date(2024, 1, 1), "Pub", "New Guest", 1, Decimal("10.01"), None, Decimal("10.01")),
    ]


def test_retention_keeps_all_revenue(fact):
    mart = fct_retention(visit_history(stg_transactions(fact)))
    assert mart.agg(F.sum("realized_revenue")).first()[0] == fact.agg(F.sum("net_amount")).first()[0]


def test_dashboard(make_sales):
    rows = make_sales(
        {"net_amount": "4.00"},
        {"net_amount": "6.00", "city": "Leeds", "category": "Mains", "transaction_ts": START},
        {"net_amount": "2.00", "city": "York", "region": "South", "venue_type": "Hotel"},
    )
    venues = fct_venue_performance(stg_transactions(rows))

    def kpis(**chosen):
        return tuple(dashboard.dash_kpis(venues, **chosen).first())

    assert kpis() == (Decimal("12.00"), 3, Decimal("0.00"))
    assert kpis(region="North") == (Decimal("10.00"), 2, Decimal("0.00"))
    assert kpis(region="North", city="Leeds")[0] == Decimal("6.00")
    assert kpis(city="Nowhere") == (None, None, None)
    categories = {tuple(r) for r in dashboard.dash_category(venues).collect()}
    assert categories == {("Starters", Decimal("6.00")), ("Mains", Decimal("6.00"))}
    assert dashboard.dash_city_type(venues).count() == 3


def test_dashboard_weighs_by_visits(make_sales):
    rows = visits_after(make_sales, 1 * DAY, 1 * DAY, net_amount="1.00")
    last = make_sales({"transaction_id": "X", "net_amount": "5.00", "transaction_ts": START, "city": "Leeds"})
    history = visit_history(stg_transactions(rows.union(last)))
    mart = fct_retention(history)
    trend = dashboard.dash_revenue_trend(history).first()
    # Segment averages are 3.00 and 1.00; per visit it is 8.00 / 4.
    assert trend.customer_lifetime_value_increment == Decimal("2.00")
    shares = {tuple(r) for r in dashboard.dash_loyalty_share(mart).collect()}
    assert shares == {("New Guest", 2, 50.0), ("High-Frequency Loyal", 2, 50.0)}


def test_repeated_ids_do_not_raise_the_average(make_sales):
    amounts = [("A", "10.00"), ("B", "90.00"), ("B", "90.00")]
    rows = make_sales(*[{"transaction_id": i, "net_amount": n} for i, n in amounts])
    trend = dashboard.dash_revenue_trend(stg_transactions(rows)).first()
    assert tuple(trend)[1:] == (Decimal("190.00"), Decimal("63.33"))


def test_charts_for_one_region_or_city(make_sales):
    rows = make_sales(
        {"net_amount": "4.00"},
        {"net_amount": "6.00", "city": "Leeds", "category": "Mains"},
        {"net_amount": "2.00", "city": "York", "region": "South", "venue_type": "Hotel"},
    )
    venues = fct_venue_performance(stg_transactions(rows))
    north = {tuple(r) for r in dashboard.dash_category(venues, region="North").collect()}
    assert north == {("Starters", Decimal("4.00")), ("Mains", Decimal("6.00"))}
    assert {tuple(r) for r in dashboard.dash_city_type(venues, city="York").collect()} == {("York", "Hotel", Decimal("2.00"))}
    assert dashboard.dash_category(venues, region="South", city="Leeds").isEmpty()
