"""CSV files, stored tables, logs, the daily copy and published results."""

import re
from datetime import date, datetime, timedelta
from decimal import Decimal
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from salesmart.operators.guests import visit_history
from salesmart.operators.increments import incremental_extract, latest_per_transaction
from salesmart.operators.sales import daily_revenue
from salesmart.operators.staging import stg_transactions
from salesmart.plans import daily_copy, warehouse
from salesmart.plans.load import load_csv
from salesmart.schema import LOAD_COLUMNS, SALES, SALES_CSV
from salesmart.sources import csv_sales, shared, tables

AS_OF = datetime(2024, 3, 3, 6)

LINE = (
    "{id},CUST00001,V1,{venue},Pub,Hull,North,2024-03-01,12:00:00,2024-03-01 12:00:00,Soup,Starters,1,{price},"
    "10.0,0,0.0,10.0,Card,False,Friday,March,3"
)


def line(id="T1", venue="Venue 1", price="10.0"):
    return LINE.format(id=id, venue=venue, price=price)


def write_file(path, *lines):
    path.parent.mkdir(exist_ok=True)
    path.write_text("\n".join([",".join(LOAD_COLUMNS), *lines]) + "\n")
    return str(path.parent)


def test_csv_reads_quoted_fields(spark, tmp_path):
    folder = write_file(tmp_path / "in" / "a.csv", line(venue='"Crown, The"'))
    df = csv_sales.read_sales_csv(spark, folder)
    assert [f.dataType for f in df.schema] == [f.dataType for f in SALES_CSV]
    row = df.first()
    assert row.venue_name == "Crown, The"
    assert (row.transaction_ts, row.transaction_date, row.transaction_time) == (
        datetime(2024, 3, 1, 12),
        date(2024, 3, 1),
        "12:00:00",
    )
    assert (row.unit_price, row.is_weekend, row.quantity) == (Decimal("10.00"), False, 1)


def test_csv_fails_on_a_bad_value(spark, tmp_path):
    folder = write_file(tmp_path / "in" / "a.csv", line(price="cheap"))
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        csv_sales.read_sales_csv(spark, folder).collect()


def test_csv_round_trip(spark, fact, tmp_path):
    some = fact.filter(F.col("venue_id") == "V7").select(*LOAD_COLUMNS)
    csv_sales.write_sales_csv(some, str(tmp_path / "out"))
    back = csv_sales.read_sales_csv(spark, str(tmp_path / "out"))
    assert back.count() == some.count() and back.exceptAll(some).isEmpty()


@pytest.mark.parametrize(
    "bad",
    [line("T3", price="cheap"), line("T3", price="12345678.00"), line("T3", venue=""), "T3,too,short"],
    ids=["no number", "too large", "empty", "short"],
)
@pytest.mark.parametrize("limit", [0, 10])
def test_whole_file_is_skipped(spark, tmp_path, monkeypatch, bad, limit):
    monkeypatch.setattr(csv_sales, "BROADCAST_FILES", limit)
    write_file(tmp_path / "in" / "good.csv", line("T1"))
    folder = write_file(tmp_path / "in" / "bad.csv", line("T2"), bad)
    rows, rejected = csv_sales.read_good_files(spark, folder)
    assert [r.transaction_id for r in rows.collect()] == ["T1"]
    assert [(r.source_file.rsplit("/", 1)[1], r.bad_rows) for r in rejected.collect()] == [("bad.csv", 1)]


def test_no_file_is_skipped_without_need(spark, tmp_path):
    folder = write_file(tmp_path / "in" / "good.csv", line("T1"), line("T2"))
    rows, rejected = csv_sales.read_good_files(spark, folder)
    assert rows.columns == LOAD_COLUMNS and rows.count() == 2 and rejected.isEmpty()


def shuffled(columns, values):
    """A header of ``columns`` and a line with the values of the standard line."""
    known = dict(zip(LOAD_COLUMNS, values.split(","), strict=True))
    return ",".join(columns), ",".join(known.get(c, "extra") for c in columns)


def put(folder, name, *lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")
    return str(folder)


@pytest.mark.parametrize("checked", [False, True])
def test_columns_are_found_by_name(spark, tmp_path, checked):
    swapped = ["customer_id", "transaction_id", *reversed(LOAD_COLUMNS[2:])]
    wider = ["note", *LOAD_COLUMNS, "more"]
    put(tmp_path / "in", "a.csv", *shuffled(LOAD_COLUMNS, line("T1")))
    put(tmp_path / "in", "b.csv", *shuffled(swapped, line("T2")))
    folder = put(tmp_path / "in", "c.csv", *shuffled(wider, line("T3")))
    rows = csv_sales.read_good_files(spark, folder).rows if checked else csv_sales.read_sales_csv(spark, folder)
    assert rows.columns == LOAD_COLUMNS
    found = {(r.transaction_id, r.customer_id, r.net_amount, r.month_num) for r in rows.collect()}
    assert found == {(t, "CUST00001", Decimal("10.00"), 3) for t in ("T1", "T2", "T3")}


def test_a_file_without_a_column_is_rejected(spark, tmp_path):
    put(tmp_path / "in", "good.csv", *shuffled(LOAD_COLUMNS, line("T1")))
    folder = put(tmp_path / "in", "less.csv", *shuffled(LOAD_COLUMNS[1:], line("T2")), "x")
    rows, rejected = csv_sales.read_good_files(spark, folder)
    assert [r.transaction_id for r in rows.collect()] == ["T1"]
    assert [(r.source_file.rsplit("/", 1)[1], r.bad_rows) for r in rejected.collect()] == [("less.csv", 2)]
    with pytest.raises(ValueError, match="columns are missing in .*less.csv"):
        csv_sales.read_sales_csv(spark, folder)


QUOTED = [
    ('"The ""Big"" one"', 'The "Big" one'),
    ('"6"" Sub, ""large"""', '6" Sub, "large"'),
    ("ends in \\", "ends in \\"),
    ('"a, b\\"', "a, b\\"),
]


@pytest.mark.parametrize(("written", "meant"), QUOTED)
def test_doubled_quotes_and_backslashes(spark, tmp_path, written, meant):
    folder = write_file(tmp_path / "in" / "a.csv", line(venue=written), line("T2"))
    assert {r.venue_name for r in csv_sales.read_sales_csv(spark, folder).collect()} == {meant, "Venue 1"}
    rows, rejected = csv_sales.read_good_files(spark, folder)
    assert rows.count() == 2 and rejected.isEmpty()


def test_quotes_are_doubled_when_written(spark, make_sales, tmp_path):
    names = [meant for _, meant in QUOTED] + ["plain"]
    rows = make_sales(*[{"venue_name": n} for n in names]).select(*LOAD_COLUMNS)
    csv_sales.write_sales_csv(rows.coalesce(1), str(tmp_path / "out"))
    text = next((tmp_path / "out").glob("part-*")).read_text()
    assert '"6"" Sub, ""large"""' in text
    back = csv_sales.read_sales_csv(spark, str(tmp_path / "out"))
    assert sorted(r.venue_name for r in back.collect()) == sorted(names)


def test_line_breaks_in_quotes(spark, tmp_path):
    folder = write_file(tmp_path / "in" / "a.csv", line(venue='"two\nlines"'), line("T2"))
    assert {r.venue_name for r in csv_sales.read_sales_csv(spark, folder, multiline=True).collect()} == {"two\nlines", "Venue 1"}
    assert csv_sales.read_good_files(spark, folder, multiline=True).rows.count() == 2


@pytest.mark.parametrize(("text", "flag"), [("0", False), ("1", True), ("TRUE", True), ("false", False)])
def test_flags_as_numbers(spark, tmp_path, text, flag):
    folder = write_file(tmp_path / "in" / "a.csv", line().replace("False", text))
    assert csv_sales.read_sales_csv(spark, folder).first().is_weekend is flag
    assert csv_sales.read_good_files(spark, folder).rows.first().is_weekend is flag


@pytest.mark.parametrize("bad", [line("T2").replace(",1,", ",x,"), line("T2").replace("False", "maybe")])
def test_bad_values_are_errors_whatever_is_asked_for(spark, tmp_path, bad):
    folder = write_file(tmp_path / "in" / "a.csv", line(), bad)
    for use in (lambda d: d.count(), lambda d: d.select("transaction_id").collect(), lambda d: d.filter("month_num = 3").count()):
        with pytest.raises(Exception, match="MALFORMED_RECORD"):
            use(csv_sales.read_sales_csv(spark, folder))


def test_replace_waits_for_good_rows(spark, tmp_path):
    good = write_file(tmp_path / "in" / "good.csv", line("T1"))
    bad = write_file(tmp_path / "bad" / "bad.csv", line("T2", price="cheap"))
    assert load_csv(spark, good, "kept_sales", replace=True, as_of=AS_OF).rows == 1
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        load_csv(spark, str(tmp_path / "nowhere"), "kept_sales", replace=True)
    refused = load_csv(spark, bad, "kept_sales", replace=True)
    assert refused.rows == 0 and refused.rejected.count() == 1
    assert [r.transaction_id for r in tables.read_sales_table(spark, "kept_sales").collect()] == ["T1"]


def files_below(folder):
    return sum(1 for p in Path(folder.removeprefix("file:")).rglob("*") if p.is_file())


def test_scratch_is_deleted(spark, fact, tmp_path):
    folder = shared.shared_dir(spark)
    write_file(tmp_path / "in" / "good.csv", line("T1"))
    before = files_below(folder)
    for _ in range(2):
        with shared.scratch(spark) as own:
            assert visit_history(stg_transactions(fact), store_input=True, rows_per_task=1000).count() == 60_000
            assert files_below(own) > 0
        load_csv(spark, str(tmp_path / "in"), "scratch_sales", replace=True, as_of=AS_OF)
    with pytest.raises(KeyError), shared.scratch(spark):
        shared.store(fact.limit(1), "check")
        raise KeyError
    assert files_below(folder) == before


def test_executors_apart_need_a_shared_folder():
    context = SimpleNamespace(master="local-cluster[2,1,1024]", getCheckpointDir=lambda: None)
    session = SimpleNamespace(conf=SimpleNamespace(get=lambda *_: None), sparkContext=context)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared.shared_dir(session)


def test_views_show_rows_appended_later(spark, raw, make_sales):
    tables.append_rows(make_sales({"net_amount": "10.00"}), raw)
    warehouse.publish_views(tables.read_sales_table(spark, raw))
    tables.append_rows(make_sales({"transaction_id": "T2", "net_amount": "90.00"}), raw)
    spark.catalog.refreshTable(raw)
    for view, column in (("vw_category_performance", "total_revenue"), ("vw_daily_revenue", "net_revenue")):
        assert spark.sql(f"SELECT sum({column}) FROM {view}").first()[0] == Decimal("100.00")


def test_a_row_stamped_again_counts_once(spark, raw, make_sales):
    day = AS_OF + timedelta(days=1)
    daily_copy.copy_increment(make_sales({"net_amount": "5.00", "loaded_at": AS_OF}), raw, as_of=AS_OF, dedupe=True)
    again = make_sales({"net_amount": "7.00", "loaded_at": AS_OF + timedelta(hours=2)})
    assert daily_copy.copy_increment(again, raw, as_of=day, dedupe=True) == 1
    marts = warehouse.build_marts(spark, raw, newest_only=True)
    assert marts["fct_venue_performance"].agg(F.sum("total_net_revenue")).first()[0] == Decimal("7.00")


def test_sums_have_38_digits(fact):
    assert dict(daily_revenue(fact).dtypes)["net_revenue"] == "decimal(38,2)"


def test_load_files(spark, tmp_path):
    write_file(tmp_path / "in" / "good.csv", line("T1"), line("T2"))
    folder = write_file(tmp_path / "in" / "bad.csv", line("T3", price="cheap"))
    for _ in range(2):
        loaded = load_csv(spark, folder, "loaded_sales", replace=True, as_of=AS_OF)
        assert loaded.rows == 2 and loaded.rejected.count() == 1
    rows = tables.read_sales_table(spark, "loaded_sales").collect()
    assert sorted((r.transaction_id, r.loaded_at) for r in rows) == [("T1", AS_OF), ("T2", AS_OF)]


@pytest.fixture
def raw(spark):
    tables.replace_sales_table(spark, "raw_sales")
    return "raw_sales"


def test_append_counts_and_stamps(spark, raw, make_sales):
    rows = make_sales({}, {"transaction_ts": datetime(2024, 3, 2, 9)}).drop("loaded_at")
    assert tables.append_rows(rows, raw, as_of=AS_OF) == 2
    assert tables.append_rows(make_sales({"transaction_id": "T9"}), raw) == 1
    stored = tables.read_sales_table(spark, raw)
    assert stored.dtypes == [(f.name, f.dataType.simpleString()) for f in SALES]
    loaded = {r.transaction_id: r.loaded_at for r in stored.collect()}
    assert loaded == {"T1": AS_OF, "T2": AS_OF, "T9": datetime(2024, 3, 2, 6)}


def test_append_without_a_time_stamps_now(spark, raw, make_sales):
    tables.append_rows(make_sales({}).drop("loaded_at"), raw)
    age = datetime.now() - tables.read_sales_table(spark, raw).first().loaded_at
    assert abs(age) < timedelta(days=1)


def test_append_refuses_missing_values(raw, make_sales):
    with pytest.raises(Exception, match="net_amount must not be NULL"):
        tables.append_rows(make_sales({"net_amount": None}), raw)


def test_replace_empties_the_table(spark, raw, make_sales):
    tables.append_rows(make_sales({}), raw)
    tables.replace_sales_table(spark, raw)
    assert tables.read_sales_table(spark, raw).isEmpty()


def test_days_are_partitions(spark, raw, make_sales):
    tables.append_rows(make_sales({}, {"transaction_ts": datetime(2024, 3, 2, 9)}), raw)
    day = tables.read_sales_table(spark, raw).filter("transaction_date = DATE '2024-03-02'")
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[\(transaction_date#\d+ = 2024-03-02\)", plan)
    assert day.count() == 1


def test_extract_opens_two_load_days(spark, raw, make_sales):
    tables.append_rows(make_sales(*[{"loaded_at": AS_OF - timedelta(hours=h)} for h in (1, 24, 26, 60)]), raw)
    stored = tables.read_sales_table(spark, raw, load_day=True)
    extract = incremental_extract(stored, as_of=AS_OF)
    assert extract.columns == SALES.names
    assert sorted(r.transaction_id for r in extract.collect()) == ["T1", "T2"]
    plan = extract._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^]]*\(loaded_on#\d+ >= 2024-03-02\)", plan)


def test_window_includes_its_first_moment(make_sales):
    rows = make_sales(
        {"loaded_at": AS_OF - timedelta(hours=25)},
        {"loaded_at": AS_OF - timedelta(hours=25, seconds=1)},
        {"loaded_at": AS_OF + timedelta(days=9)},
    )
    assert sorted(r.transaction_id for r in incremental_extract(rows, as_of=AS_OF).collect()) == ["T1", "T3"]


def test_extract_reaches_the_scan(fact):
    plan = incremental_extract(fact, as_of=AS_OF)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(loaded_at,2024-03-02T05:00)" in plan


def test_latest_row_per_id(make_sales):
    rows = make_sales(
        {"transaction_id": "A", "quantity": 1},
        {"transaction_id": "A", "quantity": 2, "loaded_at": datetime(2024, 3, 9)},
        {"transaction_id": "B"},
        {"transaction_id": "B"},
    )
    latest = latest_per_transaction(rows)
    assert latest.columns == SALES.names
    assert sorted((r.transaction_id, r.quantity) for r in latest.collect()) == [("A", 2), ("B", 1)]


def test_overlap_is_copied_twice_unless_told(spark, raw, make_sales):
    source = make_sales({"loaded_at": AS_OF - timedelta(minutes=30)}, {"loaded_at": AS_OF - timedelta(hours=30)})
    tomorrow = AS_OF + timedelta(days=1)
    assert daily_copy.copy_increment(source, raw, as_of=AS_OF) == 1
    assert daily_copy.copy_increment(source, raw, as_of=tomorrow, dedupe=True) == 0
    assert daily_copy.copy_increment(source, raw, as_of=tomorrow) == 1
    assert tables.read_sales_table(spark, raw).count() == 2


def test_daily_copy_logs_its_run(spark, raw, make_sales):
    spark.sql("DROP TABLE IF EXISTS run_log")
    tables.create_run_log(spark, "run_log")
    tables.create_run_log(spark, "run_log")
    source = make_sales({"loaded_at": AS_OF}, {"loaded_at": AS_OF})
    first = daily_copy.daily_copy(source, raw, "run_log", name="daily", as_of=AS_OF).first()
    assert tuple(first) == (1, "daily", AS_OF, 2, "SUCCESS", None)
    later = AS_OF + timedelta(days=1)
    second = tables.log_run(spark, "run_log", pipeline_name="daily", run_status="FAILED", notes="late", as_of=later)
    assert tuple(second.first()) == (2, "daily", later, None, "FAILED", "late")
    assert [r.log_id for r in tables.run_history(spark, "run_log").collect()] == [2, 1]


def test_quality_log_grows(spark, make_sales):
    spark.sql("DROP TABLE IF EXISTS quality_log")
    tables.create_quality_log(spark, "quality_log")
    tables.log_quality(make_sales({}), "quality_log", as_of=AS_OF)
    tables.log_quality(make_sales(), "quality_log", as_of=AS_OF + timedelta(days=1))
    rows = spark.table("quality_log").orderBy("check_timestamp").collect()
    assert [tuple(r) for r in rows] == [
        (AS_OF, 1, 0, 0, 0, "PASSED"),
        (AS_OF + timedelta(days=1), 0, None, 0, None, "FAILED"),
    ]


def test_schema_names():
    assert tables.schema_name(" analytics ") == "ANALYTICS"
    assert tables.schema_name(None) == "default"
    assert tables.schema_name(None, "Raw") == "Raw"


def test_build_all(spark, raw, fact):
    assert tables.append_rows(fact, raw) == 60_000
    spark.sql("DROP TABLE IF EXISTS build_log")
    report = warehouse.build_all(spark, raw, quality_log="build_log", as_of=AS_OF)
    assert {r.status for r in report.collect()} == {"PASS"}
    assert [tuple(r) for r in spark.table("build_log").collect()] == [(AS_OF, 60_000, 0, 0, 0, "PASSED")]
    assert spark.sql("SELECT sum(total_bookings) FROM ANALYTICS.fct_retention_by_customer").first()[0] == 60_000
    assert spark.sql("SELECT count(*) FROM ANALYTICS.fct_venue_performance").first()[0] == 59_356
    assert spark.sql("SELECT sum(total_bookings) FROM ANALYTICS.fct_retention").first()[0] == 60_000
    assert spark.sql("SELECT count(*) FROM stg_transactions").first()[0] == 60_000
    warehouse.build_marts(spark, raw)  # a second build replaces the first
    assert spark.table("ANALYTICS.fct_retention").count() == 715
    views = warehouse.publish_views(fact)
    assert set(views) == {
        "vw_daily_revenue",
        "vw_category_performance",
        "vw_top_items",
        "vw_payment_split",
        "vw_monthly_trend",
    }
    assert spark.sql("SELECT count(*) FROM vw_daily_revenue").first()[0] == daily_revenue(fact).count()


def test_stored_tables_go_to_the_named_folder(spark, make_sales):
    folder = spark.conf.get(shared.CHECKPOINT_DIR)
    stored = shared.store(make_sales({}), "check")
    assert stored.inputFiles()[0].removeprefix("file://").startswith(folder)
