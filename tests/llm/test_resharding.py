from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from salesmart.llm import resharding as rs


def check(rows, shards):
    sizes, slots = Counter(), defaultdict(list)
    for r in rows:
        assert r["size"] == len((r["text"] or "").encode()) + 16
        assert r["text_crc32"] == zlib.crc32((r["text"] or "").encode())
        sizes[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert set(sizes) <= set(range(shards))
    return sizes


def test_flow_moves_the_least():
    draw = random.Random(1)
    for _ in range(30):
        old = {i: draw.randrange(1, 100) for i in range(draw.randrange(1, 6))}
        n = draw.randrange(1, 8)
        share = -(-sum(old.values()) // n)
        flow = rs.transfers(old, dict.fromkeys(range(n), share))
        out, into = Counter(), Counter()
        for (a, b), amount in flow.items():
            out[a] += amount
            into[b] += amount
        assert dict(out) == old and max(into.values()) <= share
        # What exceeds a shard's capacity must go, and nothing else.
        least = sum(max(0, size - (share if i < n else 0)) for i, size in old.items())
        assert sum(v for (a, b), v in flow.items() if a != b) == least


def test_costs_choose_the_path():
    flow = rs.Flow(4)
    dear, cheap = flow.add(0, 1, 5, 4), flow.add(0, 2, 3, 1)
    flow.add(1, 3, 9, 0)
    flow.add(2, 3, 9, 0)
    flow.run(0, 3)
    assert (flow.used(dear), flow.used(cheap)) == (5, 3)


@pytest.mark.parametrize("spread", [1, 40])
def test_even_shards_with_few_moves(make_docs, spread):
    draw = random.Random(spread)
    docs = make_docs([(i, "x" * draw.choice([10, 50, 50 * spread]), None, None, None) for i in range(4000)])
    rows = rs.reshard(docs, shards=10, old_shard=rs.hashed_shard(8)).collect()
    sizes = check(rows, 10)
    mean = sum(sizes.values()) / 10
    assert max(sizes.values()) < 1.01 * mean and min(sizes.values()) > 0.99 * mean
    moved = sum(r["size"] for r in rows if r["shard"] != r["old_shard"])
    old = Counter()
    for r in rows:
        old[r["old_shard"]] += r["size"]
    assert moved < sum(max(0, s - mean) for s in old.values()) + 0.05 * sum(old.values())


def test_fewer_shards_and_reruns(make_docs):
    docs = make_docs([(i, "y" * (i % 90), None, None, None) for i in range(1000)])
    first = rs.reshard(docs, shards=3, old_shard=F.pmod("doc_id", F.lit(7)).cast("int"))
    second = rs.reshard(docs.repartition(6), shards=3, old_shard=F.pmod("doc_id", F.lit(7)).cast("int"))
    check(first.collect(), 3)
    columns = ["doc_id", "shard", "slot"]
    assert sorted(first.select(columns).collect()) == sorted(second.select(columns).collect())


def test_only_affected_files_are_written_anew(make_docs, tmp_path, spark):
    docs = make_docs([(i, "z" * 84, None, None, None) for i in range(90)])
    old = F.when(F.col("doc_id") < 30, 0).when(F.col("doc_id") < 45, 1).when(F.col("doc_id") < 85, 2).otherwise(3)
    path = str(tmp_path / "shards")
    docs.withColumn("shard", old).write.partitionBy("shard").parquet(path)
    before = {p.name for p in (tmp_path / "shards" / "shard=0").iterdir()}
    resharded = rs.reshard(docs, shards=3, old_shard=old)
    assert rs.affected(resharded) == [1, 2, 3]
    assert rs.rewrite(resharded, path) == [1, 2, 3]
    assert {p.name for p in (tmp_path / "shards" / "shard=0").iterdir()} == before
    counts = spark.read.parquet(path).where("shard < 3").groupBy("shard").count().collect()
    assert {r["shard"]: r["count"] for r in counts} == {0: 30, 1: 30, 2: 30}


def test_drained_shards_leave_no_files(make_docs, tmp_path, spark):
    docs = make_docs([(i, "z" * 84, None, None, None) for i in range(90)])
    path = str(tmp_path / "shards")
    rs.write_layout(docs, path, F.pmod("doc_id", F.lit(5)).cast("int"))
    old = rs.read_layout(docs, path)
    assert sorted(check(old.collect(), 5)) == [0, 1, 2, 3, 4]
    assert {3, 4} <= set(rs.rewrite(rs.reshard(old, 3, F.col("shard")), path))
    assert sorted(r["doc_id"] for r in spark.read.parquet(path).collect()) == list(range(90))
    assert set(check(rs.read_layout(docs, path).collect(), 3)) == {0, 1, 2}


def test_results_come_from_rewritten_files(awkward, clashing, no_docs):
    found = rs.reshard_files(awkward)
    files = {f.rpartition("/shard=")[0] for f in found.inputFiles()}
    assert len(files) == 1 and all(files)
    assert len(found.collect()) == awkward.count()
    check(found.collect(), 40)
    assert rs.reshard_files(clashing).count() == awkward.count()
    assert rs.reshard_files(no_docs).collect() == []


def test_query_moves_the_texts(spark, tables, make_docs):
    from salesmart.llm.queries import QUERIES

    found = QUERIES["op6_reshard"](spark, tables(documents=make_docs([(i, "z" * i, None, None, None) for i in range(90)])))
    assert all("/shard=" in f for f in found.inputFiles())


def test_awkward_rows(awkward, clashing, no_docs):
    rows = rs.reshard(awkward).collect()
    assert len(rows) == awkward.count()
    check(rows, 40)
    again = rs.reshard(clashing)
    assert again.columns.count("size") == again.columns.count("shard") == 1
    assert again.count() == len(rows)
    assert rs.reshard(no_docs).collect() == []


def test_ids_that_repeat_or_are_missing(make_docs):
    draw = random.Random(5)
    text = lambda i: f"{i} " + "x" * draw.randrange(100)
    for shared in (None, 7):
        docs = make_docs([(shared if i % 3 == 0 else i, text(i), None, None, None) for i in range(6000)])
        sizes = check(rs.reshard(docs).collect(), 40)
        assert max(sizes.values()) - min(sizes.values()) <= 120


def test_each_piece_is_a_task_and_shuffled_once(make_docs, monkeypatch):
    monkeypatch.setattr(rs, "PIECE_BYTES", 5_000)
    found = rs.reshard(make_docs([(i, "x" * 50, None, None, None) for i in range(2000)]), shards=5)
    held = found.withColumn("task", F.spark_partition_id()).groupBy("task").agg(F.sum("size").alias("n"), F.count_distinct("shard").alias("k")).collect()
    assert len(held) > 20 and all(r["n"] <= 5_000 and r["k"] == 1 for r in held)
    assert found._jdf.queryExecution().executedPlan().toString().count("Exchange ShufflePartitionIdPassThrough") <= 1
    assert found._jdf.queryExecution().executedPlan().toString().count("hashpartitioning") == 0


@pytest.mark.parametrize("lost", ["before the switch", "after the switch", "deleting", "moving"])
def test_lost_rewrite(make_docs, tmp_path, spark, monkeypatch, lost):
    docs = make_docs([(i, "z" * 84, None, None, None) for i in range(90)])
    path = str(tmp_path / "shards")
    rs.write_layout(docs, path, F.pmod("doc_id", F.lit(5)).cast("int"))
    resharded = rs.reshard(rs.read_layout(docs, path), 3, F.col("shard"))

    class Lost(Exception):
        pass

    def fails(after, call):
        left = [after]

        def step(*args):
            if not left[0]:
                raise Lost
            left[0] -= 1
            return call(*args)

        return step

    with monkeypatch.context() as patched:
        if lost == "before the switch":
            patched.setattr(rs.versions, "publish_file", fails(0, rs.versions.publish_file))
        elif lost == "moving":
            patched.setattr(rs.versions, "move_file", fails(1, rs.versions.move_file))
        else:
            patched.setattr(rs, "delete", fails(0 if lost == "after the switch" else 2, rs.delete))
        with pytest.raises(Lost):
            rs.rewrite(resharded, path)
    rows = rs.read_layout(docs, path).collect()
    assert sorted(r["doc_id"] for r in rows) == list(range(90))
    assert sorted(check(rows, 5)) == ([0, 1, 2, 3, 4] if lost == "before the switch" else [0, 1, 2])
    rs.rewrite(rs.reshard(rs.read_layout(docs, path), 2, F.col("shard")), path)
    assert set(check(rs.read_layout(docs, path).collect(), 2)) == {0, 1}
