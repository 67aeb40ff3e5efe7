"""Plans and forms that only matter at size: joins with nothing, few duplicates in many rows, files bounded by rows."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from millrace.operators import merge, position
from millrace.operators.position import POSITION, land, lost_positions, no_rows
from millrace.plans import feed

ORDER = ["file_path", "row_block", "row_seq"]


def plan_of(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture(scope="module")
def batch(spark):
    """Keys within and across two files, some of them incomplete."""
    rows = [(f"/in/{f}.csv", 0, i, (f - 1 << 33) + i, None if i % 7 == 0 else f"k{i % 9 + 3 * f}", i, f"c{f}-{i}") for f in (1, 2) for i in range(24)]
    return spark.createDataFrame(rows, f"file_path string, row_block long, row_seq long, {POSITION} long, k string, v int, note string")


def test_a_first_merge_joins_nothing(spark, batch):
    target = no_rows(spark, batch.schema)
    source = feed.collapse_files(batch.drop(POSITION), ["k"], ["v"])
    plan = plan_of(merge.upsert(target.drop(POSITION), source, ["k"], ["v"], ORDER).snapshot)
    assert "Join" not in plan
    assert target.schema == batch.schema and target.count() == 0


def test_last_wins_is_never_broadcast_by_estimate(spark, batch):
    stored = land(batch.drop(POSITION).withColumn("v", F.col("v") + 1), "stored")
    landed = land(batch, "rows")
    for order in (ORDER, [POSITION]):
        result = merge.last_wins(stored, landed, ["k"], ["v"], ["file_path", "note", "row_block", "row_seq"], order)
        plan = result.snapshot._jdf.queryExecution().sparkPlan().toString()
        wide = [line for line in plan.splitlines() if "BroadcastHashJoin" in line and "_h" not in line]
        assert not wide and "SortMergeJoin" in plan


def test_last_wins_by_positions(spark, batch):
    lineage, target = ["file_path", "note", "row_block", "row_seq"], no_rows(spark, batch.drop(POSITION).schema)
    a, b = (sorted(map(str, merge.last_wins(target, batch, ["k"], ["v"], lineage, o).snapshot.collect())) for o in (ORDER, [POSITION]))
    assert a == b and a


@pytest.mark.parametrize("most", [0, 1000])
def test_collapse_files(batch, monkeypatch, most):
    monkeypatch.setattr(feed, "BROADCAST_KEYS", most)
    want = feed.collapse_files(batch.drop(POSITION), ["k"], ["v"])
    got = feed.collapse_files(batch, ["k"], ["v"])
    rows = lambda df: sorted(map(str, df.select(want.columns).collect()))
    assert rows(got) == rows(want)


def test_actions_by_positions(spark, batch, monkeypatch):
    target = no_rows(spark, batch.schema)
    fast = merge.ordered_actions(batch, target, ["k"], [POSITION])
    monkeypatch.setattr(position, "BROADCAST_LOST", -1)
    slow = merge.ordered_actions(batch, target, ["k"], [POSITION])
    assert sorted(map(str, fast.collect())) == sorted(map(str, slow.collect()))


@pytest.mark.parametrize("rule", ["first", "last"])
def test_lost_positions(batch, rule, monkeypatch):
    rows = batch.collect()
    best = min if rule == "first" else max
    kept = {best((r[POSITION] for r in rows if (r["k"], r["file_path"]) == key)) for key in {(r["k"], r["file_path"]) for r in rows}}
    got = {r[0] for r in lost_positions(batch, ["k", "file_path"], rule).collect()}
    assert got == {r[POSITION] for r in rows} - kept and got
    monkeypatch.setattr(position, "BROADCAST_LOST", len(got) - 1)
    assert lost_positions(batch, ["k", "file_path"], rule) is None


def test_files_are_bounded_by_rows(spark, monkeypatch):
    monkeypatch.setattr(position, "FILE_ROWS", 10)
    landed = land(spark.range(35).coalesce(1), "bounded")
    per_file = landed.groupBy("_metadata.file_name").count().agg(F.max("count"), F.count("*")).first()
    assert tuple(per_file) == (10, 4)
