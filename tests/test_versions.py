"""Loads, copies and logs that are repeated, lost on the way or done by several at once."""

from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from salesmart.plans import daily_copy
from salesmart.plans.load import load_csv
from salesmart.sources import tables, versions
from test_storage import line, write_file

AS_OF = datetime(2024, 3, 3, 6)


class Lost(RuntimeError):
    pass


def failing(monkeypatch, module, name, at=1):
    """Let the call number ``at`` of a function fail before it does anything."""
    real, calls = getattr(module, name), []

    def call(*args, **kwargs):
        calls.append(args)
        if len(calls) == at:
            raise Lost(name)
        return real(*args, **kwargs)

    monkeypatch.setattr(module, name, call)


STEPS = [
    (tables, "_write_days", 1),
    (tables, "files_below", 1),
    (tables, "publish_file", 1),
    (tables, "move_file", 1),
    (tables, "move_file", 2),
    (daily_copy, "log_run", 1),
    (tables, "publish_file", 2),
]


@pytest.mark.parametrize("dedupe", [False, True])
def test_a_copy_lost_at_any_step(spark, make_sales, monkeypatch, dedupe):
    source = make_sales(*[{"loaded_at": AS_OF - timedelta(hours=h), "transaction_ts": AS_OF - timedelta(days=2 + h % 2)} for h in (1, 2, 3)])
    for step, (module, name, at) in enumerate(STEPS):
        tables.replace_sales_table(spark, "copied_sales")
        spark.sql("DROP TABLE IF EXISTS copy_log")
        tables.create_run_log(spark, "copy_log")
        with monkeypatch.context() as patch, pytest.raises(Lost):
            failing(patch, module, name, at)
            daily_copy.daily_copy(source, "copied_sales", "copy_log", name="daily", as_of=AS_OF, dedupe=dedupe)
        for _ in range(2):
            logged = daily_copy.daily_copy(source, "copied_sales", "copy_log", name="daily", as_of=AS_OF, dedupe=dedupe)
            assert [tuple(r) for r in logged.collect()] == [(1, "daily", AS_OF, 3, "SUCCESS", None)], step
        spark.catalog.refreshTable("copied_sales")
        assert sorted(r.transaction_id for r in tables.read_sales_table(spark, "copied_sales").collect()) == ["T1", "T2", "T3"], step
        assert spark.table("copy_log").count() == 1
    # What was left half-way is finished by the next batch, whichever that is.
    later = AS_OF + timedelta(days=1)
    with monkeypatch.context() as patch, pytest.raises(Lost):
        failing(patch, tables, "move_file", 2)
        daily_copy.daily_copy(make_sales({"transaction_id": "T8", "loaded_at": later}, {"transaction_id": "T9", "loaded_at": later, "transaction_ts": later}), "copied_sales", "copy_log", name="daily", as_of=later)
    daily_copy.daily_copy(make_sales().limit(0), "copied_sales", "copy_log", name="other", as_of=later)
    assert sorted(r.transaction_id for r in tables.read_sales_table(spark, "copied_sales").collect()) == ["T1", "T2", "T3", "T8", "T9"]


def test_a_failed_replacement_leaves_the_rows(spark, make_sales, tmp_path, monkeypatch):
    folder = write_file(tmp_path / "in" / "a.csv", line("T1"))
    load_csv(spark, folder, "swapped_sales", replace=True, as_of=AS_OF)
    reader = tables.read_sales_table(spark, "swapped_sales")
    broken = make_sales({}).withColumn("city", F.raise_error(F.lit("disk")))
    with pytest.raises(Exception, match="disk"):
        tables.replace_rows(broken, "swapped_sales")
    with monkeypatch.context() as patch, pytest.raises(Lost):
        failing(patch, tables, "_switch")
        load_csv(spark, write_file(tmp_path / "in2" / "b.csv", line("T2")), "swapped_sales", replace=True, as_of=AS_OF)
    assert [r.transaction_id for r in tables.read_sales_table(spark, "swapped_sales").collect()] == ["T1"]
    load_csv(spark, str(tmp_path / "in2"), "swapped_sales", replace=True, as_of=AS_OF)
    assert [r.transaction_id for r in tables.read_sales_table(spark, "swapped_sales").collect()] == ["T2"]
    # Who began before the switch reads the version before to the end.
    assert [r.transaction_id for r in reader.collect()] == ["T1"]
    tables.append_rows(make_sales({"transaction_id": "T5"}), "swapped_sales")
    assert tables.read_sales_table(spark, "swapped_sales").count() == 2


def test_published_results_switch(spark, make_sales, monkeypatch):
    def mart(n):
        return spark.range(n).select("id", F.lit(n).alias("n"))

    old = tables.publish_table(mart(3), "switching", schema="analytics")
    with pytest.raises(Exception, match="half"):
        tables.publish_table(spark.range(9).select("id", F.raise_error(F.lit("half")).cast("int").alias("n")), "switching", schema="analytics")
    assert spark.table("ANALYTICS.switching").count() == 3
    new = tables.publish_table(mart(5), "switching", schema="analytics")
    assert (old.count(), new.count(), spark.table("ANALYTICS.switching").count()) == (3, 5, 5)
    folder = tables.table_folder(spark, "ANALYTICS.switching")
    tables.publish_table(mart(6), "switching", schema="analytics")
    kept = versions.names_in(spark, folder.rsplit("/", 1)[0])
    assert len(kept) == 2 and folder.rsplit("/", 1)[1] in kept
    wider = tables.publish_table(mart(2).withColumn("more", F.lit("x")), "switching", schema="analytics")
    assert wider.columns == ["id", "n", "more"] and wider.count() == 2


def test_ids_of_several_writers(spark):
    spark.sql("DROP TABLE IF EXISTS busy_log")
    tables.create_run_log(spark, "busy_log")

    def write(k):
        return [tables.log_run(spark, "busy_log", pipeline_name=f"w{k}", notes="a 'quoted' \"note\" é", as_of=AS_OF) for _ in range(100)]

    with ThreadPoolExecutor(8) as pool:
        list(pool.map(write, range(8)))
    spark.catalog.refreshTable("busy_log")
    rows = tables.run_history(spark, "busy_log").collect()
    assert sorted(r.log_id for r in rows) == list(range(1, 801))
    assert {(r.run_timestamp, r.notes) for r in rows} == {(AS_OF, "a 'quoted' \"note\" é")}


def test_log_without_a_time_has_microseconds_or_none(spark):
    spark.sql("DROP TABLE IF EXISTS now_log")
    tables.create_run_log(spark, "now_log")
    row = tables.log_run(spark, "now_log", pipeline_name="x").first()
    assert abs(row.run_timestamp - datetime.now()) < timedelta(days=1) and row.rows_copied is None
