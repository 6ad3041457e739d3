"""Groups too large for a task must be numbered as one window would."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from salesmart.operators import numbering
from salesmart.operators.guests import visit_history, visit_history_by_customer
from salesmart.operators.numbering import rank_descending, visit_numbers
from salesmart.operators.sales import category_performance
from salesmart.operators.staging import stg_transactions

COLUMNS = ["k", "ts", "id", "amount"]


@pytest.fixture(autouse=True)
def many_slices(spark):
    """Keep small inputs in as many slices as large ones would have."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def visits(spark, rows):
    return spark.createDataFrame(rows, "k string, ts timestamp_ntz, id string, amount int")


def with_one_window(rows):
    w = Window.partitionBy("k").orderBy("ts", "id", "amount")
    return rows.select(
        "*", F.row_number().over(w).cast("bigint").alias("n"), F.lag("ts").over(w).alias("before")
    )


def numbered(rows, limit, few_keys=False):
    return visit_numbers(
        rows, key="k", ts="ts", ties=["id"], number="n", previous="before", few_keys=few_keys, rows_per_task=limit
    ).select(*COLUMNS, "n", "before")


def same(left, right):
    key = lambda r: tuple(str(v) for v in r)
    assert sorted(map(tuple, left.collect()), key=key) == sorted(map(tuple, right.collect()), key=key)


START = datetime(2024, 1, 1, 12)


@pytest.mark.parametrize("limit", [3, 400, 10_000])
def test_hot_key_hot_piece_and_copies(spark, limit):
    rows = []
    for i in range(400):  # one key over many pieces
        rows.append(("hot", START + timedelta(minutes=37 * i), f"a{i % 7}", i))
    for i in range(300):  # many rows of one moment
        rows.append(("hot", START + timedelta(days=2), f"b{i}", 1))
    rows += [("hot", START + timedelta(days=3), "copy", 1)] * 350  # exact copies
    rows += [("other", START + timedelta(days=1), "copy", 1)] * 2
    rows += [(None, START + timedelta(hours=i), f"c{i}", 1) for i in range(60)]  # no key
    rows += [("", START, "d", 1), ("single", START, "e", 1)]
    df = visits(spark, rows).repartition(5)
    same(numbered(df, limit), with_one_window(df))
    same(numbered(df, limit, few_keys=True), with_one_window(df))


def test_copies_are_restored_in_steps(spark, monkeypatch):
    monkeypatch.setattr(numbering, "COPIES_PER_STEP", 7)
    rows = [("hot", START, "copy", 1)] * 50 + [("hot", START, "a", 1), ("hot", START, "z", 1)] * 7
    df = visits(spark, rows)
    same(numbered(df, 10), with_one_window(df))


def test_small_groups_use_one_window(spark):
    df = visits(spark, [("a", START, "1", 1), ("a", START + timedelta(1), "2", 1), ("b", START, "3", 1)])
    result = numbered(df, 2)
    same(result, with_one_window(df))
    plan = result._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan


@pytest.mark.parametrize("limit", [1, 200])
def test_history_of_large_segments(fact, limit):
    staged = stg_transactions(fact)
    plain, cut = visit_history(staged), visit_history(staged, rows_per_task=limit)
    assert cut.columns == plain.columns
    assert cut.exceptAll(plain).isEmpty() and plain.exceptAll(cut).isEmpty()


def test_history_of_large_customers(fact):
    third = fact.withColumn(
        "customer_id", F.when(F.crc32("transaction_id") % 3 == 0, "WALK-IN").otherwise(F.col("customer_id"))
    )
    plain, cut = visit_history_by_customer(third), visit_history_by_customer(third, rows_per_task=1000)
    assert cut.exceptAll(plain).isEmpty() and plain.exceptAll(cut).isEmpty()


def test_slices_are_many(spark):
    rows = visits(spark, [("hot", START, f"{i:04d}", 1) for i in range(500)])
    rows = rows.select("*", F.lit(2).cast("bigint").alias("w"))
    result = numbering._first_numbers(rows, ["k"], [F.asc("ts"), F.asc("id")], "w", "n")
    assert result.select("n").orderBy("n").collect() == [(2 * i + 1,) for i in range(500)]
    plan = result._jdf.queryExecution().optimizedPlan().toString()
    assert "__slice" in plan
    sizes = numbering.store(rows.repartitionByRange("k", "ts", "id"), "check").groupBy(F.input_file_name()).count()
    assert sizes.count() == 8


@pytest.mark.parametrize("per_e", [1, 1000])
def test_rank_with_ties(spark, monkeypatch, per_e):
    monkeypatch.setattr(numbering, "BANDS_PER_E", per_e)
    rows = [("Pub", v % 11) for v in range(60)] + [("Pub", 3)] * 200 + [("Hotel", v) for v in range(5)]
    rows += [("Pub", None), (None, 4), (None, 4), (None, 9), ("Pub", -5), ("Pub", -5), ("Pub", -700), ("Pub", 10**9)]
    df = spark.createDataFrame(rows, "t string, v int")
    plain = df.withColumn("r", F.rank().over(Window.partitionBy("t").orderBy(F.desc("v"))))
    same(rank_descending(df, group="t", measure="v", rank="r").select("t", "v", "r"), plain)


def test_category_performance_is_one_rank(spark, fact):
    ranked = category_performance(fact)
    best_first = Window.partitionBy("venue_type").orderBy(F.desc("total_revenue"))
    plain = ranked.withColumn("revenue_rank_in_venue_type", F.rank().over(best_first))
    assert ranked.dtypes == plain.dtypes
    assert ranked.exceptAll(plain).isEmpty() and plain.exceptAll(ranked).isEmpty()


def test_ranking_starts_no_job(spark, fact):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("ranking", "call only")
    category_performance(fact)
    assert list(tracker.getJobIdsForGroup("ranking")) == []
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_slices_have_the_asked_size(spark, monkeypatch):
    stored = []
    keep = numbering.store

    def kept(df, name):
        stored.append((name, keep(df, name)))
        return stored[-1][1]

    monkeypatch.setattr(numbering, "store", kept)
    df = visits(spark, [("hot", START, f"{i:05d}", i) for i in range(20_000)])
    numbered(df, 1000).count()
    sizes = [r["count"] for name, t in stored if name == "slices" for r in t.groupBy("__slice").count().collect()]
    assert len(sizes) >= 18 and max(sizes) < 1500


def test_low_broadcast_limit_gives_equal_rows(spark, monkeypatch):
    rows = [(f"k{i % 3}", START + timedelta(minutes=i % 40), f"a{i}", 1) for i in range(900)] + [("k0", START, "c", 1)] * 60
    df = visits(spark, rows)
    monkeypatch.setattr(numbering, "BROADCAST_ROWS", 0)
    result = numbered(df, 50)
    assert "ResolvedHint" not in result._jdf.queryExecution().analyzed().toString()
    same(result, with_one_window(df))


def test_rows_are_counted_while_stored(spark):
    ids = spark.range(100)
    assert numbering.store_counted(ids, "check")[1] == 100
    for empty in (ids.filter("id < 0"), ids.groupBy("id").count().filter("count > 1"), ids.limit(0)):
        stored, n = numbering.store_counted(empty, "check")
        assert n == 0 and stored.isEmpty()
